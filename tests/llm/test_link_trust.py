from __future__ import annotations

import pytest

from gaugeline.llm import link_trust

PAGES = "page_id long, url string, html string, host string, rank double, verdict string"


def judged(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "clash", 0.0, "x") for r in rows], PAGES).repartition(3)
    return link_trust.judge(frame, **more).collect()


def brute_ranks(seeds, links, damping, rounds=200):
    ranks, sent = dict(seeds), dict(seeds)
    out = {}
    for (s, _), n in links.items():
        out[s] = out.get(s, 0) + n
    for _ in range(rounds):
        moved = {}
        for (s, d), n in links.items():
            if s in sent:
                moved[d] = moved.get(d, 0) + damping * sent[s] * n / out[s]
        for k, v in moved.items():
            ranks[k] = ranks.get(k, 0) + v
        sent = moved
    total = sum(ranks.values())
    return {k: v / total for k, v in ranks.items()}


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("HTTP://Sub.Example.NET/en/1?x#y", "sub.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.net/de/1", "example.net", "/de/1", "net/", "block"),
        ("https://badexample.net/en/1", "badexample.net", "/en/1", "net/", "block"),
        ("http://net", "net", "", None, "allow"),
        ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
        ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("http://a.org/fr/x", "a.org", "/fr/x", "org/fr/", "allow"),
        ("http://a.org?q=/fr/", "a.org", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("x://É.org/fr/://", "É.org", "/fr/://", "org/fr/", "allow"),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    (row,) = judged(spark, [(1, url, None)])
    assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, rule, verdict)


def test_trust_and_distrust_spread(spark):
    link = lambda *hosts: "".join(f'<a href="https://{h}/p">x</a>' for h in hosts)
    rows = [
        (1, "http://good.org/fr/1", link("Friend.com", "friend.com", "good.org")),
        (2, "http://friend.com/", link("second.com") + "<a href='//third.com'>x</a>"),
        (3, "http://second.com/x", link("bad.net")),
        (4, "http://spammer.com/", link("bad.net", "friend.com")),
        (5, "http://bad.net/", link("friend.com")),
        (6, "http://third.com/", "<a href=/local>y</a>"),
        (6, "http://third.com/", None),
        (None, "http://bad.net", None),
    ]
    got = judged(spark, rows)
    assert len(got) == len(rows)
    by_host = {r["host"]: r for r in got}
    links = {("good.org", "friend.com"): 1, ("friend.com", "second.com"): 1, ("friend.com", "third.com"): 1, ("second.com", "bad.net"): 1, ("spammer.com", "bad.net"): 1, ("spammer.com", "friend.com"): 1, ("bad.net", "friend.com"): 1}
    trust = brute_ranks({"good.org": 1.0}, links, link_trust.DAMPING)
    back = {(d, s): n for (s, d), n in links.items()}
    # bad.net blocks one page by rule and has one of two pages without a path: no majority, so it is no seed.
    assert all(r["distrust"] == 0 for r in got)
    for host, r in by_host.items():
        assert r["trust"] == pytest.approx(trust.get(host, 0), abs=2e-3)
    rows = rows[:-1]
    got = {r["host"]: r for r in judged(spark, rows)}
    distrust = brute_ranks({"bad.net": 1.0}, back, link_trust.DAMPING)
    for host, r in got.items():
        assert r["distrust"] == pytest.approx(distrust.get(host, 0), abs=2e-3)
    assert got["spammer.com"]["verdict"] == "block" and got["friend.com"]["verdict"] == "allow"


def test_empty_table(spark):
    assert judged(spark, [(1, "http://a.com/", "")])[0]["verdict"] == "allow"
    assert link_trust.judge(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("kind", ["trust", "distrust"])
def test_many_seeds_without_links_do_not_cut_the_others_off(spark, kind):
    alone = [(kind, f"alone{i}", 1.0) for i in range(20_000)]
    seeds = spark.createDataFrame([*alone, ("distrust", "bad", 1.0)], "kind string, host string, rank double")
    chain = [("distrust", "bad" if k == 0 else f"h{k}", f"h{k + 1}", 1.0) for k in range(6)]
    links = spark.createDataFrame(chain, "kind string, src string, dst string, share double")
    ranks = {r["host"]: r["rank"] for r in link_trust.spread(seeds, links).collect() if r["kind"] == "distrust"}
    assert all(ranks[f"h{k + 1}"] == pytest.approx(0.85 ** (k + 1) * ranks["bad"]) for k in range(6))


def test_a_long_chain_of_hosts_is_followed_to_its_end(spark):
    seeds = spark.createDataFrame([("distrust", "h0", 1.0), ("trust", "good", 1.0)], "kind string, host string, rank double")
    chain = [("distrust", f"h{k}", f"h{k + 1}", 1.0) for k in range(70)]
    links = spark.createDataFrame(chain, "kind string, src string, dst string, share double")
    ranks = {r["host"]: r["rank"] for r in link_trust.spread(seeds, links).collect() if r["kind"] == "distrust"}
    assert set(ranks) == {f"h{k}" for k in range(71)}
    assert all(ranks[f"h{k}"] == pytest.approx(0.85**k * ranks["h0"]) for k in range(71))
