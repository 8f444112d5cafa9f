from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gaugeline.llm import ss_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, ids string, offset int"


def padding(windows, size):
    return sum(size - n for n in windows if n & (n - 1))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60), st.integers(1, 6))
def test_packer_keeps_every_id_once_without_padding(sizes, most_open):
    packer = ss_packing.Packer(32, most_open)
    for doc, n in enumerate(sizes):
        packer.add(doc, np.arange(n, dtype=np.uint32))
    packer.close_all()
    docs, windows = defaultdict(list), defaultdict(list)
    for doc, start, ids, total, window, offset in packer.done:
        assert total == sizes[doc] and len(ids)
        docs[doc].append((start, ids))
        windows[window].append((offset, len(ids)))
    for doc, parts in docs.items():
        at = 0
        for start, ids in sorted(parts, key=lambda p: p[0]):
            assert start == at and ids.tolist() == list(range(at, at + len(ids)))
            at += len(ids)
        assert at == sizes[doc]
    assert len(docs) == len(sizes)
    filled = []
    for parts in windows.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        filled.append(at)
    assert max(filled, default=0) <= 32 and padding(filled, 32) == 0


def test_choice_leaves_the_least_sum_of_squares():
    rng = random.Random(1)
    packer = ss_packing.Packer(16, 10_000)
    for doc in range(300):
        size = rng.randint(1, 15)
        before = packer.level[:16].copy()
        packer.add(doc, np.zeros(size, np.uint32))
        options = []
        for h in range(17 - size):
            if h == 0 or before[h]:
                after = before.copy()
                after[h] -= h > 0
                if h + size < 16:
                    after[h + size] += 1
                options.append(int((after[1:] ** 2).sum()))
        assert int((packer.level[1:16] ** 2).sum()) == min(options)
        assert [len(x) for x in packer.open[1:]] == packer.level[1:16].tolist()


def test_ids_are_those_of_the_tokenizer(spark):
    texts = ["Hello world", "été  spaces\n\n tabs\t", "<|endoftext|> don't 123 ## ünïcode 漢字 🙂", "x" * 3000, " " * 500, None, "", "a b " * 20_000]
    rows = [(i, t, "clash", 0) for i, t in enumerate(texts)] + [(0, texts[0], "clash", 0), (None, "null id", "clash", 0)]
    pieces = ss_packing.pack(spark.createDataFrame(rows, DOCS).repartition(3), PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    got = defaultdict(list)
    for p in sorted(pieces, key=lambda p: p["start"]):
        got[p["doc_id"]] += np.frombuffer(p["ids"], "<u4").tolist()
        assert p["length"] == len(p["ids"]) // 4
    for i, t in [*enumerate(texts), (None, "null id")]:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        assert sorted(got[i]) == sorted(ids * (2 if i == 0 else 1))
        if i:
            assert got[i] == ids
    filled = defaultdict(int)
    for p in pieces:
        filled[p["sequence_id"]] += p["length"]
    assert max(filled.values()) <= 1024 and padding(filled.values(), 1024) == 0
    assert ss_packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0


def test_added_tokens_are_those_of_the_unchanged_tokenizer(spark):
    texts = ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> <|endoftext|>\n\nx", "<|endoftext|", "no mark", "don't<|endoftext|>  's"]
    docs = spark.createDataFrame([(i, t, "clash", 0) for i, t in enumerate(texts)], DOCS).repartition(2)
    tokenizer = Tokenizer.from_file(PATH)
    got = defaultdict(list)
    for p in sorted(ss_packing.pack(docs, PATH, added=True).collect(), key=lambda p: p["start"]):
        got[p["doc_id"]] += np.frombuffer(p["ids"], "<u4").tolist()
    assert dict(got) == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}


def test_long_runs_have_the_tokenizer_s_ids(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = ss_packing._encoder(tuple(ss_packing.read_ranks(path).items()), tuple(ss_packing.read_added(path).items()))
    tokenizer = Tokenizer.from_file(path)
    same = lambda text: ss_packing.token_ids(encoder, text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    million = 1_000_000
    assert same(" " * million + "a") and same("b" + "\n" * million) and same(" \t" * million + "7")
    assert same("x" * million) and same("!" * million) and same("ab " * million)
    # Short runs taken for long ones: every way in which a run can begin and end.
    monkeypatch.setattr(ss_packing, "_RUNS", re.compile(f"[{ss_packing.WHITE}]{{2,}}"))
    monkeypatch.setattr(ss_packing, "LONG_RUN", 1)
    rng = random.Random(9)
    parts = [" ", "  ", "\n", "\n \n", "\x85", "\xa0 ", " 　", "\x1c", "​", "a", "Don't", " 12", "é", "!?", "<|endoftext|>", "'s"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(8)))
        assert same(text), repr(text)


def test_open_windows_do_not_hold_whole_documents():
    packer = ss_packing.Packer(32)
    for doc in range(20):
        packer.add(doc, np.arange(100_001 + doc, dtype=np.uint32))
    packer.done = []  # handed on
    waiting = [piece[2] for level in packer.open for pieces in level for piece in pieces]
    assert waiting and all((ids if ids.base is None else ids.base).nbytes <= 4 * 32 for ids in waiting)


def test_pieces_are_handed_on_in_small_batches(spark, monkeypatch):
    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 0

    docs, taken = spark.createDataFrame([], "doc_id long, text string"), []
    monkeypatch.setattr(ss_packing, "TaskContext", Context)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, work, schema: taken.append(work))  # the task's function, to be run here
    ss_packing.pack(docs, PATH)
    batch = ss_packing.pa.RecordBatch.from_pydict({"doc_id": list(range(5000)), "text": ["some words"] * 5000})
    sizes = [len(x) for x in taken[0](iter([batch]))]
    assert sum(sizes) >= 5000 and max(sizes) <= 512
