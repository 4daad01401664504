"""WARC fixity audit with Merkle trees.

The records of an archive are numbered in archive order; each has its byte range.
Leaf hashes cover a record's number, length and bytes, a node's hash covers its
``FANOUT`` children in order, so a node stands for a range of offsets. Two replicas
are compared from the root: equal hashes end the comparison of a range, and only the
children of mismatching nodes are read further, down to the records.

Trees are built level by level with grouped aggregates; record bytes are hashed where
they are read and never shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm import common
from kestrel.llm.common import cut

FANOUT = 32
PER_FILE = 1024  # records of an archive file


def record(page_id: Column, url: Column, body: Column) -> Column:
    """A WARC resource record as text; nulls count as empty."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "),
                    F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def numbered(rows: DataFrame, order: list[str], length: str) -> DataFrame:
    """``rows`` with ``number`` (0 on, in the given order) and ``start`` (sum of the
    lengths before). Rows equal in the order are interchangeable; they are spread over
    the tasks by their place in the input. One total for each task is combined."""
    spread = rows.withColumn("tie", F.monotonically_increasing_id())
    ordered = spread.repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie").drop("tie")
    fields = ordered.select(*rows.columns, F.lit(0).cast("int").alias("task"), F.lit(0).cast("bigint").alias("number"),
                            F.lit(0).cast("bigint").alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        n = at = 0
        task = TaskContext.get().partitionId()
        for b in batches:
            size = b.column(length).to_numpy().astype(np.int64)
            stop = at + np.cumsum(size)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(size), task, np.int32)), pa.array(n + np.arange(len(size))),
                 pa.array(stop - size)], names=[*b.schema.names, "task", "number", "start"])
            n += len(size)
            at = int(stop[-1]) if len(size) else at

    local = cut(ordered.mapInArrow(run, fields.schema))
    total = local.groupBy("task").agg(F.count("*").alias("n"), F.sum(length).alias("bytes"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    base = F.broadcast(total.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                                    F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("b0")))
    return local.join(base, "task").withColumn("number", F.col("number") + F.col("n0")) \
        .withColumn("start", F.col("start") + F.col("b0")).drop("task", "n0", "b0")


def tree(leaves: DataFrame, height: int) -> list[DataFrame]:
    """Levels of a Merkle tree over (number, length, digest), leaves first: (node,
    parent, hash). Numbers that occur more than once make one leaf of all their records."""
    own = F.concat_ws(":", F.col("number").cast("string"), F.col("length").cast("string"), "digest")
    levels = [leaves.groupBy(F.col("number").alias("node")).agg(F.sort_array(F.collect_list(own)).alias("x"))
              .select("node", F.sha2(F.array_join("x", "|"), 256).alias("hash"))]
    for _ in range(height):
        below = levels[-1]
        levels.append(cut(below.groupBy(F.expr(f"node DIV {FANOUT}").alias("node")).agg(
            F.sort_array(F.collect_list(F.struct("node", "hash"))).alias("x")).select(
            "node", F.sha2(F.array_join(F.transform("x", lambda c: F.concat_ws(":", c["node"].cast("string"), c["hash"])), "|"),
                           256).alias("hash"))))
    return [x.withColumn("parent", F.expr(f"node DIV {FANOUT}")) for x in levels]


def height_of(count: int) -> int:
    """Levels above the leaves until one node is left."""
    h, n = 0, max(count, 1)
    while n > 1:
        n, h = -(-n // FANOUT), h + 1
    return h


def mismatches(a: list[DataFrame], b: list[DataFrame]) -> DataFrame:
    """Numbers of the leaves on which two trees of equal height differ."""
    def differing(x: DataFrame, y: DataFrame) -> DataFrame:
        return x.select("node", F.col("hash").alias("ha")).join(y.select("node", F.col("hash").alias("hb")), "node", "full") \
            .where(~F.col("ha").eqNullSafe(F.col("hb"))).select("node")

    found = differing(a[-1], b[-1])
    for x, y in zip(a[-2::-1], b[-2::-1], strict=True):
        open_ = cut(found).withColumnRenamed("node", "parent")
        found = differing(x.join(open_, "parent", "left_semi"), y.join(open_, "parent", "left_semi"))
    return found


def audit(good: DataFrame, replica: DataFrame) -> DataFrame:
    """Damage in a replica: number, kind (changed, missing, extra).

    Both have (number, length, digest), one row for each record. Records of the replica
    are matched by their number. An empty replica misses all, two empty ones agree."""
    good, replica = (cut(x.select("number", "length", "digest")) for x in (good, replica))
    top = max(x.agg(F.coalesce(F.max("number"), F.lit(-1))).first()[0] for x in (good, replica)) + 1
    height = height_of(top)
    at = cut(mismatches(tree(good, height), tree(replica, height))).withColumnRenamed("node", "number")
    in_good = good.join(at, "number", "left_semi").select("number", F.lit(True).alias("a")).distinct()
    in_replica = replica.join(at, "number", "left_semi").select("number", F.lit(True).alias("b")).distinct()
    return at.join(in_good, "number", "left").join(in_replica, "number", "left").select(
        "number", F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed").alias("kind"))


def _damaged(rec: Column, draw: Column) -> Column:
    """What a faulty store made of a record: one byte changed, the end cut off, or
    nothing left, each for one record in 256 by its draw."""
    return F.when(draw == "00", F.concat(F.lit("w"), F.substring(rec, 2, F.length(rec)))) \
        .when(draw == "01", F.substring(rec, 1, F.length(rec) - 2)).when(draw == "02", F.lit(None)).otherwise(rec)


def page_audit(pages: DataFrame) -> DataFrame:
    """Archive the pages as WARC records, audit a replica in which records were damaged
    by a rule on their id and URL, and locate the damage: file, record (in the file),
    page_id, start (offset in the file), length, kind.

    Records are in the order of page_id, URL and digest; ``PER_FILE`` make a file. Nulls
    count as empty, repeated rows are records of their own, other columns are not read."""
    rec = record(F.col("page_id"), F.col("url"), F.col("html"))
    draw = F.substring(F.md5(F.concat_ws("#", F.coalesce("url", F.lit("")),
                                         F.coalesce(F.col("page_id").cast("string"), F.lit("")))), 1, 2)
    hashed = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                          rec.alias("rec"), _damaged(rec, draw).alias("bad")).select(
        "page_id", "url", F.octet_length("rec").cast("bigint").alias("length"), F.sha2("rec", 256).alias("digest"),
        F.octet_length("bad").cast("bigint").alias("bad_length"), F.sha2("bad", 256).alias("bad_digest"))
    archive = cut(numbered(hashed, ["page_id", "url", "digest"], "length").drop("url"))
    replica = archive.where("bad_digest IS NOT NULL").select("number", F.col("bad_length").alias("length"),
                                                             F.col("bad_digest").alias("digest"))
    found = audit(archive, replica)
    file = F.expr(f"number DIV {PER_FILE}")
    origin = archive.where(F.col("number") % PER_FILE == 0).select(file.alias("file"), F.col("start").alias("origin"))
    return archive.select("number", file.alias("file"), "page_id", "start", "length").join(found, "number") \
        .join(origin, "file").select("file", (F.col("number") % PER_FILE).alias("record"), "page_id",
                                     (F.col("start") - F.col("origin")).alias("start"), "length", "kind")


def read_records(files: DataFrame) -> DataFrame:
    """(path, record, start, length, digest) of the records of WARC files given as
    (path, content), as Spark's ``binaryFile`` reader has them; uncompressed, or with
    one gzip member for each record (start and length then are those of the member).
    Bytes that are no record make one last record up to the file's end. Null or empty
    content has no records."""
    def parts(raw: bytes) -> Iterator[tuple[int, int, bytes]]:
        at = 0
        while at < len(raw):
            if raw[at:at + 2] == b"\x1f\x8b":
                d = zlib.decompressobj(31)
                try:
                    body = d.decompress(raw[at:])
                except zlib.error:
                    body = None
                stop = len(raw) - len(d.unused_data) if body is not None and d.eof else len(raw)
                yield at, stop - at, body if body is not None else raw[at:stop]
            else:
                head = raw.find(b"\r\n\r\n", at)
                size = next((int(v) for k, _, v in (line.partition(b":") for line in raw[at:max(head, at)].split(b"\r\n"))
                             if k.strip().lower() == b"content-length" and v.strip().isdigit()), None)
                stop = min(len(raw), head + 8 + size) if head >= 0 and size is not None else len(raw)
                yield at, stop - at, raw[at:stop]
            at = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = [(path, k, at, n, hashlib.sha256(x).hexdigest())
                        for k, (at, n, x) in enumerate(parts(content.as_py() or b""))]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), *[pa.int64()] * 3, pa.string()),
                                                        strict=True)],
                        names=["path", "record", "start", "length", "digest"])

    return common.map_arrow(files.select("path", "content"), run,
                            "path string, record bigint, start bigint, length bigint, digest string")


#: DuckDB SQL of ``page_audit`` over ``pages``.
ORACLE_SQL = r"""
WITH rec AS (SELECT page_id, coalesce(url, '') AS url, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: '
    || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
    || strlen(coalesce(html, ''))::VARCHAR || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
    || chr(13) || chr(10) || chr(13) || chr(10) AS r,
    left(md5(coalesce(url, '') || '#' || coalesce(page_id::VARCHAR, '')), 2) AS draw FROM pages),
n AS (SELECT page_id, draw, strlen(r) AS length,
      row_number() OVER w - 1 AS number, sum(strlen(r)) OVER w - strlen(r) AS start
      FROM rec WINDOW w AS (ORDER BY page_id NULLS FIRST, url, sha256(r) ROWS UNBOUNDED PRECEDING)),
f AS (SELECT *, number // 1024 AS file, start - min(start) OVER (PARTITION BY number // 1024) AS at_ FROM n)
SELECT file::BIGINT AS file, (number % 1024)::BIGINT AS record, page_id, at_::BIGINT AS start, length::BIGINT AS length,
       CASE draw WHEN '02' THEN 'missing' ELSE 'changed' END AS kind
FROM f WHERE draw IN ('00', '01', '02')
"""
