"""Fixity audit of archive replicas by Merkle trees.

Every record is hashed with its offset and length. A leaf covers a fixed range of offsets of an archive file (so it
holds a bounded number of records and needs no numbering of rows), an inner node covers `fanout` ranges of the level
below, and the root the whole file. Replicas whose roots agree are the same; below differing roots only the children of
differing nodes are compared, down to the records. All levels of both replicas are built by plain grouping on (file,
range) and written to shared scratch; descending reads from each level only the children of what differs.

Records at the same offset of a file (damaged indexes, repeated rows) are first reduced to their number and the sums of
the four 64-bit parts of their digests, which depend on every one of them but not on their order, so that a node's input
stays bounded by its range.

Defined results: null content counts as empty; a null archive or offset is a place of its own; an empty replica makes
every record missing; two empty tables give an empty result; other columns are ignored, but for those named in `keep`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import own, stored

LEAF_BYTES = 65_536
FANOUT = 16


def fingerprint(content: Column) -> tuple[Column, Column]:
    """Length and hash of a content; null counts as empty."""
    known = F.coalesce(content, F.lit("").cast("binary"))
    return F.length(known).cast("long"), F.sha2(known, 256)


def _digests(records: DataFrame, side: int, keep: tuple[str, ...]) -> DataFrame:
    """A row per (archive, offset) with one hash for what stands there."""
    if "content" in records.columns:
        rows = own(records, "archive", "offset", "content", *keep)
        length, sha = fingerprint(F.col("content"))
        rows = rows.select("archive", "offset", *keep, length.alias("length"), sha.alias("sha"))
    else:
        rows = own(records, "archive", "offset", *keep, "length", "sha")
    text = F.concat_ws(":", F.coalesce(F.col("offset"), F.lit(-1)), "length", "sha")
    hashed = rows.withColumn("digest", F.sha2(text.cast("binary"), 256))
    parts = [F.conv(F.substring("digest", 16 * k + 1, 16), 16, 10).cast("decimal(20,0)") for k in range(4)]
    sums = [F.sum(part.cast("decimal(28,0)")).alias(f"sum{k}") for k, part in enumerate(parts)]
    summed = hashed.groupBy("archive", "offset").agg(
        F.count("*").alias("n"), F.min("digest").alias("low"), *sums, *[F.max(c).alias(c) for c in keep]
    )
    several = F.concat_ws(":", "n", *[F.col(f"sum{k}").cast("string") for k in range(4)])
    alone = F.when(F.col("n") == 1, F.col("low")).otherwise(F.sha2(several.cast("binary"), 256))
    return summed.select(F.lit(side).alias("side"), "archive", "offset", alone.alias("digest"), *keep)


def _parent(level: DataFrame, node, at: str) -> DataFrame:
    """Nodes over the ordered children `at`: the hash of their places and hashes, one after the other."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(at).alias("at"), "digest")))
    joined = F.concat_ws(",", F.transform(parts, lambda x: F.concat_ws("=", x["at"].cast("string"), x["digest"])))
    return level.groupBy("side", "archive", node.alias("node")).agg(F.sha2(joined.cast("binary"), 256).alias("digest"))


def _differing(level: DataFrame, *at: str) -> DataFrame:
    """Places of which the two sides have different hashes, or one has none."""
    sides = [F.max(F.when(F.col("side") == s, F.col("digest"))).alias(name) for s, name in ((0, "primary"), (1, "replica"))]
    return level.groupBy(*at).agg(*sides).filter(~F.col("primary").eqNullSafe(F.col("replica")))


def _below(level: DataFrame, differing: DataFrame, node) -> DataFrame:
    """The nodes of a level whose parent differs."""
    marked = differing.select(F.col("archive").alias("_archive"), F.col("node").alias("_node"))
    same = level["archive"].eqNullSafe(marked["_archive"]) & node.eqNullSafe(marked["_node"])
    return level.join(marked, same, "left_semi")


def audit(primary: DataFrame, replica: DataFrame, keep: tuple[str, ...] = (), leaf_bytes: int = LEAF_BYTES,
          fanout: int = FANOUT) -> DataFrame:
    """A row per record (archive, offset) that is `changed`, `missing` from the replica or `extra` there.

    Records have a `content`, or the `length` and `sha` that `fingerprint` makes of it.
    """
    sides = _digests(primary, 0, keep).unionByName(_digests(replica, 1, keep))
    records = stored(sides, "record-digests")
    leaf = F.floor(F.col("offset") / leaf_bytes)
    levels = [stored(_parent(records, leaf, "offset"), "merkle-level")]
    top = levels[0].agg(F.max("node")).first()[0] or 0
    up = F.floor(F.col("node") / fanout)
    while top > 0:
        levels.append(stored(_parent(levels[-1], up, "node"), "merkle-level"))
        top //= fanout
    differing = _differing(levels[-1], "archive", "node")
    for level in reversed(levels[:-1]):
        differing = _differing(_below(level, differing, F.floor(level["node"] / fanout)), "archive", "node")
    damaged = _below(records, differing, F.floor(records["offset"] / leaf_bytes))
    sides = [F.max(F.when(F.col("side") == s, F.col("digest"))).alias(name) for s, name in ((0, "primary"), (1, "replica"))]
    found = damaged.groupBy("archive", "offset").agg(*sides, *[F.max(c).alias(c) for c in keep])
    found = found.filter(~F.col("primary").eqNullSafe(F.col("replica")))
    status = F.when(F.col("replica").isNull(), "missing").when(F.col("primary").isNull(), "extra").otherwise("changed")
    return found.select("archive", "offset", *keep, status.alias("status"))


PAGES_PER_ARCHIVE = 500


def as_records(pages: DataFrame) -> DataFrame:
    """Pages as response records of archive files of 500 page ids each; ids name the file, null ids by content."""
    html = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"),
    )
    content = F.concat(head, html, F.lit("\r\n\r\n")).cast("binary")
    by_content = -1 - F.pmod(F.xxhash64("url", "html"), F.lit(1 << 40))
    archive = F.coalesce(F.floor(F.col("page_id") / PAGES_PER_ARCHIVE), by_content)
    return own(pages, "page_id", "url", "html").select("page_id", archive.alias("archive"), content.alias("content"))


def placed(records: DataFrame) -> DataFrame:
    """Records with the `offset` at which each begins in its archive, in order of id, from their `length` and `sha`."""
    before = Window.partitionBy("archive").orderBy("page_id", "sha").rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))


def archived(pages: DataFrame) -> DataFrame:
    """Pages as records with their content and offset, to be written as archives."""
    records = as_records(pages)
    length, sha = fingerprint(F.col("content"))
    return placed(records.withColumns({"length": length, "sha": sha})).drop("length", "sha")


def with_damaged_copy(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records of pages, and a replica with known faults, by page id: a changed last byte, a record cut in half, a
    record lost. Contents are read and hashed once, for both; only lengths and hashes are shuffled."""
    size = F.length("content")
    content = F.when(F.col("page_id") % 97 == 5, F.concat(F.substring("content", F.lit(1), size - 1), F.lit("X").cast("binary")))
    content = content.when(F.col("page_id") % 389 == 11, F.substring("content", F.lit(1), F.floor(size / 2).cast("int")))
    length, sha = fingerprint(F.col("content"))
    copied_length, copied_sha = fingerprint(content.otherwise(F.col("content")))
    measured = as_records(pages).select(
        "page_id", "archive", length.alias("length"), sha.alias("sha"), copied_length.alias("copied_length"), copied_sha.alias("copied_sha")
    )
    both = stored(placed(measured), "archive-index")
    kept = both.filter(F.coalesce(F.col("page_id") % 211 != 7, F.lit(True)))
    replica = kept.select("page_id", "archive", "offset", F.col("copied_length").alias("length"), F.col("copied_sha").alias("sha"))
    return both.drop("copied_length", "copied_sha"), replica


#: What the audit of `with_damaged_copy` must find, by comparing all records, in DuckDB.
SQL = f"""
WITH r AS (SELECT page_id, page_id // {PAGES_PER_ARCHIVE} AS archive,
    octet_length(encode('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
      || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: '
      || octet_length(encode(coalesce(html, ''))) || repeat(chr(13) || chr(10), 2) || coalesce(html, '')
      || repeat(chr(13) || chr(10), 2))) AS size FROM pages),
 o AS (SELECT page_id, archive, coalesce(sum(size) OVER (PARTITION BY archive ORDER BY page_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM r)
SELECT archive, "offset", page_id, CASE WHEN page_id % 211 = 7 THEN 'missing' ELSE 'changed' END AS status FROM o
WHERE page_id % 211 = 7 OR page_id % 97 = 5 OR page_id % 389 = 11"""
