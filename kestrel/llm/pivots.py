"""Near-duplicate vectors through a pivot-permutation index.

1. Equal vectors of a label are one class; only classes are compared.
2. Pivots are spread reference vectors of a bounded sample. A class is described by
   its nearest pivots, nearest first (a prefix of its permutation).
3. Inverted lists: a list holds the classes of one label that have the same two pivots
   in their prefixes, so a pair of classes meets exactly when it shares two pivots or
   more. It is taken up once, in the list of its two smallest shared pivots, and only
   if it shares enough of them.
4. Pairs taken up are verified by their exact cosine. A list larger than a bound is cut
   into blocks, every two blocks meet in a task of their own, and a task gives out
   counts and only such links as join what it has not joined yet: never more rows than
   it has members.
5. Components of the links, by shuffles.

Fitting reads a sample of bounded size; all rows are indexed and verified. A pair at
the threshold is missed only where its two prefixes share fewer than two pivots.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm import common
from kestrel.llm.common import cut, shuffled
from kestrel.llm.components import connected_components, stars


@dataclass(frozen=True)
class Settings:
    """sample and sample_bytes bound what pivots are chosen from; per_root: pivots for
    each root of the number of rows, between least and most, and most_bytes at most (they are
    broadcast); prefix: pivots that describe a vector; shared: pivots a pair shares to be
    verified; part: members of a list that are compared at once."""

    sample: int = 20_000
    sample_bytes: int = 64 << 20
    per_root: int = 4
    least: int = 16
    most: int = 4096
    most_bytes: int = 32 << 20
    prefix: int = 6
    shared: int = 2
    part: int = 1024


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; first by their largest component, so that no square
    over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def spread_pivots(x: np.ndarray, wanted: int) -> np.ndarray:
    """Up to ``wanted`` rows of ``x`` far from each other: rows in order whose cosine with
    all chosen before stays low; the bound is relaxed until there are enough."""
    chosen = np.empty((min(wanted, len(x)), x.shape[1]))
    n = 0
    for bound in (0.7, 0.8, 0.9, 0.95):
        for lo in range(0, len(x), 512):
            block = x[lo:lo + 512]
            far = np.flatnonzero((block @ chosen[:n].T).max(axis=1, initial=-1.0) < bound)
            start = n
            for row in block[far]:
                if n < len(chosen) and (chosen[start:n] @ row).max(initial=-1.0) < bound:
                    chosen[n] = row
                    n += 1
            if n == len(chosen):
                return chosen
    return chosen[:n]


def prefixes(x: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest pivots of each row, nearest first; ties to the smaller number."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :k]


def usable(v: Column) -> Column:
    """Whether a vector (array<double>) is neither null nor empty nor zero and all its components are finite."""
    return F.coalesce(v.isNotNull() & (F.size(v) > 0)
                      & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
                      & F.exists(v, lambda e: e != 0), F.lit(False))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one batch, shorter ones with zeros behind (no cosine changes by that)."""
    size = np.diff(col.offsets.to_numpy())
    out = np.zeros((len(col), dim))
    out[np.arange(dim) < size[:, None]] = col.flatten().to_numpy(zero_copy_only=False)
    return out


def near_vectors(df: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", settings: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id, kept, one row for each row of ``df``.

    Rows are linked if their labels are equal and not null and the cosine of their
    vectors, in double precision, is at least ``threshold``. n_links counts the other
    rows linked directly, component_id is the smallest id reachable, itself included;
    kept: whether that is its own. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, nor do vectors of different lengths with each
    other. Rows that are repeated or share an id are rows of their own, each judged by
    its own vector. A row without an id takes no part: no links, no component, kept.
    Other columns of ``df`` are not read."""
    s, spark = settings, df.sparkSession
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"),
                     F.col(vector_col).cast("array<double>").alias("v"))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"))
    # Classes by a digest of the vector, by which its rows find their class again.
    digest = F.sha2(F.array_join(F.transform("v", lambda e: (e + F.lit(0.0)).cast("string")), ","), 256)
    drawn = rows.where(ok).withColumn("digest", digest)
    classes = cut(drawn.groupBy("label", "digest")
                  .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("v").alias("v"))
                  .withColumn("node", F.monotonically_increasing_id()))
    counted = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    total, dim = counted[0], counted[1] or 1
    most = max(2, min(s.sample, s.sample_bytes // (8 * dim)))
    sample = classes.orderBy(F.xxhash64("digest", "label"), "digest", "label").limit(most).select("v").toArrow()
    x = _matrix(sample.column("v").combine_chunks(), dim) if total else np.zeros((0, dim))
    wanted = min(s.most, max(2, s.most_bytes // (8 * dim)), max(s.least, int(s.per_root * total ** 0.5)))
    pivots = spread_pivots(unit_rows(x), wanted) if total else x
    shared = spark.sparkContext.broadcast(pivots)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(16, (16 << 20) // (8 * (len(shared.value) + dim)))
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                batch = whole.slice(lo, step)
                near = prefixes(unit_rows(_matrix(batch.column("v"), dim)), shared.value, s.prefix)
                tops = pa.ListArray.from_arrays(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1],
                                                pa.array(near.astype(np.int16).ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "label", "copies", "v")), tops],
                                                 names=["node", "label", "copies", "v", "tops"])

    kind = df.schema[label_col].dataType.simpleString()
    known = cut(common.map_arrow(classes.select("node", "label", "copies", "v"), described,
                                 f"node bigint, label {kind}, copies bigint, v array<double>, tops array<smallint>"))
    # A list's key: its two pivots, the smaller first; with a single pivot there is one list.
    two = list(combinations(range(min(s.prefix, len(pivots))), 2)) or [(0, 0)]
    low = [F.least(F.col("tops")[i], F.col("tops")[j]).cast("int") for i, j in two]
    high = [F.greatest(F.col("tops")[i], F.col("tops")[j]).cast("int") for i, j in two]
    posted = known.select("node", "label", F.size("v").alias("width"), F.explode(F.array(
        *[(p * F.lit(1 << 16) + q).cast("bigint") for p, q in zip(low, high, strict=True)])).alias("list"))
    key = ["label", "width", "list"]
    lists = posted.groupBy(*key).agg(F.ceil(F.count("*") / s.part).cast("int").alias("blocks"), F.count("*").alias("size")) \
        .where("size > 1").drop("size")
    members = posted.join(shuffled(lists), key).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiles = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *key, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node")
    met = tiles.join(shuffled(known.select("node", "copies", "v", "tops")), "node")
    at = [*key, "lo", "hi"]
    found = cut(common.map_arrow(met.repartition(common.shuffle_partitions(spark), *at).sortWithinPartitions(*at),
                                 _verifier(threshold, dim, s), "a bigint, b bigint, n bigint"))

    more = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("more"))
    groups = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    placed = classes.select("node", "label", "digest", "first", "copies") \
        .join(shuffled(groups.withColumnRenamed("id", "node")), "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    judged = placed.join(shuffled(smallest), "component").join(shuffled(more), "node", "left") \
        .select("label", "digest", "component_id", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"))
    out = drawn.drop("v").join(shuffled(judged), ["label", "digest"]).select("vec_id", "n_links", "component_id") \
        .union(rows.where(~ok).select("vec_id", F.lit(0).cast("bigint"), "vec_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _verifier(threshold: float, dim: int, s: Settings):
    """Of rows sorted by tile: (a, null, links of a found here) and (a, b, 0) for links that join."""

    def tile(lo: int, hi: int, pivot: int, node, copies, v, tops, block) -> list[np.ndarray]:
        own = np.flatnonzero(block == lo)
        other = own if lo == hi else np.flatnonzero(block == hi)
        cosine = unit_rows(v[own]) @ (unit_rows(v[other]).T)
        near = cosine >= threshold
        near &= (node[own][:, None] < node[other][None, :]) if lo == hi else True
        i, j = np.nonzero(near)
        if not len(i):
            return []
        # Of the lists a pair shares, this is the one of its two smallest pivots; and it shares enough.
        both = np.zeros(len(i), dtype=np.int64)
        before = np.zeros(len(i), dtype=np.int64)
        for c in range(tops.shape[1]):
            mine = tops[own[i], c]
            has = (tops[other[j]] == mine[:, None]).any(axis=1)
            both += has
            before += has & (mine < pivot)
        take = (before <= 1) & (both >= min(s.shared, tops.shape[1]))
        x, y = own[i[take]], other[j[take]]
        links = np.bincount(x, copies[y], len(node)) + np.bincount(y, copies[x], len(node))
        some = np.flatnonzero(links)
        out = [np.stack([node[some], np.full(len(some), -1), links[some].astype(np.int64)])]
        a, b = stars(x, y)
        out.append(np.stack([node[a], node[b], np.zeros(len(a), np.int64)]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> list[np.ndarray]:
            whole = [np.concatenate(c) for c in zip(*held, strict=True)]
            return tile(now[3], now[4], now[2] & 0xFFFF, *whole) if len(whole[0]) > 1 else []

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c) for c in ("label", "width", "list", "lo", "hi")]
            codes = np.stack([k.dictionary_encode().indices.to_numpy() for k in keys])
            edge = np.flatnonzero(np.concatenate([[True], (codes[:, 1:] != codes[:, :-1]).any(axis=0)]))
            v = _matrix(batch.column("v"), dim)
            tops = batch.column("tops").flatten().to_numpy().reshape(batch.num_rows, -1)
            cols = [batch.column(c).to_numpy() for c in ("node", "copies")] + [v, tops, batch.column("block").to_numpy()]
            out = []
            for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), batch.num_rows], strict=True):
                at = tuple(k[lo].as_py() for k in keys)
                if at != now:
                    if held:
                        out += done()
                    now, held = at, []
                held.append([c[lo:hi] for c in cols])
            if out:
                yield _as_batch(np.concatenate(out, axis=1))
        if held:
            out = done()
            if out:
                yield _as_batch(np.concatenate(out, axis=1))

    return run


def _as_batch(x: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1], mask=x[1] < 0), pa.array(x[2])], names=["a", "b", "n"])



ORACLE_SQL = """
WITH RECURSIVE u AS (
    SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS v,
           coalesce(vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
                    AND len([x for x in embedding if x <> 0]) > 0, false) AS ok
    FROM embeddings),
v AS (SELECT rid, vec_id, label, CASE WHEN ok THEN [coalesce(x, 0) for x in v] ELSE [0.0] END AS v, ok FROM u),
links AS (SELECT a.rid AS a, b.rid AS b FROM v AS a JOIN v AS b ON a.label = b.label AND len(a.v) = len(b.v) AND a.rid <> b.rid
          WHERE a.ok AND b.ok AND CASE WHEN a.ok AND b.ok AND len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) END >= 0.98),
reach AS (SELECT rid, rid AS other FROM v UNION SELECT reach.rid, links.b FROM reach JOIN links ON links.a = reach.other),
component AS (SELECT reach.rid, min(v.vec_id) AS component_id FROM reach JOIN v ON v.rid = reach.other GROUP BY reach.rid)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.rid)::BIGINT AS n_links, component_id,
       coalesce(v.vec_id = component_id, true) AS kept
FROM v JOIN component USING (rid)
"""
