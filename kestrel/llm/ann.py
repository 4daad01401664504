"""Approximate nearest neighbours by cosine, with balanced posting lists.

1. Centroids come from a bounded sample, halved again and again at the median of its
   widest direction, so that all leaves hold equally many sample vectors.
2. A graph over the centroids is searched in memory, best first, for all vectors of a
   batch at once.
3. Every vector is indexed: in the list of its nearest centroid and, near a boundary,
   also in those of others not much further away, unless a list already chosen lies
   nearer to that centroid than the vector does.
4. A query searches the lists whose centroid is within a ratio of the nearest one's
   distance. Lists larger than a bound are split, and queries go to every part.
5. Within a list all members are compared; each query keeps its best of every part,
   and the best of all parts are its result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm import common
from kestrel.llm.common import cut


@dataclass(frozen=True)
class Settings:
    """sample: vectors the centroids are fitted on at most (a bound in rows and, by
    sample_bytes, in size); per_list: wanted members of a list; most_lists bounds the
    centroids that are broadcast; beam: width of the graph search; degree: edges of a
    centroid; near: a vector also joins lists up to this ratio of its nearest
    distance, at most ``replicas`` in all; ratio: a query searches lists up to this
    ratio, at least ``least_lists`` (as many as the beam holds, if the ratio allows);
    part: members of a list part."""

    sample: int = 20_000
    sample_bytes: int = 64 << 20
    per_list: int = 100
    most_lists: int = 8192
    beam: int = 128
    degree: int = 32
    near: float = 1.1
    replicas: int = 4
    ratio: float = 1.3
    least_lists: int = 16
    part: int = 4096


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def balanced_centroids(x: np.ndarray, lists: int) -> np.ndarray:
    """Centroids (unit length) of about ``lists`` equally large leaves."""
    leaves, todo = [], [(x, lists)]
    rng = np.random.default_rng(11)
    while todo:
        part, want = todo.pop()
        if want < 2 or len(part) < 4:
            leaves.append(part.mean(axis=0))
            continue
        # Two centres by a few rounds of 2-means, then a cut at the median between them.
        a, b = part[rng.choice(len(part), 2, replace=False)]
        for _ in range(6):
            side = part @ (a - b) > 0
            if side.all() or not side.any():
                break
            a, b = part[side].mean(axis=0), part[~side].mean(axis=0)
        order = np.argsort(part @ (a - b), kind="stable")
        half = len(part) * (want // 2) // want
        todo += [(part[order[:half]], want // 2), (part[order[half:]], want - want // 2)]
    c = np.array(leaves)
    length = np.sqrt((c * c).sum(axis=1))
    return c[length > 1e-9] / length[length > 1e-9, None]


class Graph:
    """Nearest-neighbour graph over centroids, with a best-first search."""

    def __init__(self, centroids: np.ndarray, degree: int) -> None:
        self.centroids = centroids
        k = len(centroids)
        degree = min(degree, k - 1)
        near = np.empty((k, degree), dtype=np.int64)
        for lo in range(0, k, 1024):
            dots = centroids[lo:lo + 1024] @ centroids.T
            dots[np.arange(len(dots)), np.arange(lo, lo + len(dots))] = -2
            near[lo:lo + 1024] = np.argsort(-dots, axis=1, kind="stable")[:, :degree]
        # Long edges keep the graph connected: a ring over all, and a ring of strides.
        ring = (np.arange(k) + 1) % k
        stride = (np.arange(k) * 1 + max(1, int(np.sqrt(k)))) % k
        self.edges = np.concatenate([near, ring[:, None], stride[:, None]], axis=1) if k > 1 else near
        self.entries = np.unique(np.linspace(0, k - 1, min(k, 16)).astype(np.int64))

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row the ids and cosines of the best centroids found, best first."""
        n, k = len(x), len(self.centroids)
        beam = min(beam, k)
        seen = np.zeros((n, k), dtype=bool)
        best = np.full((n, beam), -np.inf)
        ids = np.full((n, beam), -1)
        open_ = np.zeros((n, beam), dtype=bool)
        rows = np.arange(n)

        def take(who: np.ndarray, new: np.ndarray) -> None:
            """Offer centroids ``new`` (one row for each of ``who``) to their beams."""
            fresh = ~seen[who[:, None], new]
            order = np.argsort(new, axis=1, kind="stable")  # an id offered twice in a row counts once
            ranked = np.take_along_axis(new, order, 1)
            twice = np.zeros_like(fresh)
            np.put_along_axis(twice, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
            fresh &= ~twice
            seen[who[:, None], new] = True
            dots = np.where(fresh, np.einsum("nd,nmd->nm", x[who], self.centroids[new]), -np.inf)
            all_dots = np.concatenate([best[who], dots], axis=1)
            all_ids = np.concatenate([ids[who], new], axis=1)
            all_open = np.concatenate([open_[who], fresh], axis=1)
            top = np.argsort(-all_dots, axis=1, kind="stable")[:, :beam]
            best[who] = np.take_along_axis(all_dots, top, 1)
            ids[who] = np.take_along_axis(all_ids, top, 1)
            open_[who] = np.take_along_axis(all_open, top, 1)

        take(rows, np.repeat(self.entries[None, :], n, axis=0))
        while True:
            active = np.flatnonzero(open_.any(axis=1))
            if not len(active):
                break
            at = np.argmax(open_[active], axis=1)  # best first: rows are sorted
            open_[active, at] = False
            take(active, self.edges[ids[active, at]])
        return ids, best


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def lists_of(x: np.ndarray, graph: Graph, s: Settings) -> list[np.ndarray]:
    """Lists each vector is a member of."""
    ids, cos = graph.search(x, min(s.beam, 4 * s.replicas))
    dist = _distance(cos)
    out = []
    for own, d in zip(ids, dist, strict=True):
        chosen: list[int] = []
        for c, dc in zip(own.tolist(), d.tolist(), strict=True):
            if c < 0 or dc > s.near * d[0] + 1e-12 or len(chosen) == s.replicas:
                break
            if chosen and _distance(graph.centroids[chosen] @ graph.centroids[c]).min() < dc:
                continue
            chosen.append(c)
        out.append(np.array(chosen))
    return out


def lists_for(x: np.ndarray, graph: Graph, s: Settings) -> list[np.ndarray]:
    """Lists each query searches."""
    ids, cos = graph.search(x, s.beam)
    dist = _distance(cos)
    keep = (ids >= 0) & ((dist <= s.ratio * dist[:, :1] + 1e-12) | (np.arange(ids.shape[1]) < s.least_lists))
    return [own[k] for own, k in zip(ids, keep, strict=True)]


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows of ``b`` with the vector ``a``; equal rows get equal values."""
    return (b * a).sum(axis=1) / (np.sqrt((b * b).sum(axis=1)) * np.sqrt((a * a).sum()))


def _vectors(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _usable(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(vec_id, v) of the vectors that take part, and their dimension."""
    x = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    ok = x.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
                 & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
                 & F.exists("v", lambda e: e != 0))
    dims = ok.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    dim = dims[0]["dim"] if dims else 0
    return ok.where(F.size("v") == dim), dim


def nearest(df: DataFrame, queries: DataFrame | None = None, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding", every: int = 50, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each query among all
    other rows, by cosine in double precision, ties to the smaller vec_id.

    queries: rows of the same columns; by default those of ``df`` whose id is
    divisible by ``every``. Vectors that are null, empty, zero, hold null or
    non-finite components or are not of the most frequent dimension take no part, nor
    do rows without an id. A row listed more than once is one candidate; an id with
    several vectors is searched by each and found by its best. Other columns are not
    read."""
    spark, s = df.sparkSession, settings
    vectors, dim = _usable(df, id_col, vector_col)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if not dim:
        return spark.createDataFrame([], schema)
    asked = vectors.where(F.col("vec_id") % every == 0) if queries is None else \
        _usable(queries, id_col, vector_col)[0].where(F.size("v") == dim)
    total = vectors.count()
    most = max(2, min(s.sample, s.sample_bytes // (8 * dim)))
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).toArrow()
    x = unit(_vectors(sample.column("v").combine_chunks(), dim))
    lists = max(1, min(s.most_lists, total // s.per_list, len(x) // 4))
    graph = Graph(balanced_centroids(x[np.lexsort(x.T[::-1])], lists), s.degree)
    if not len(graph.centroids):
        graph = Graph(x[:1], s.degree)
    shared = spark.sparkContext.broadcast(graph)

    def placed(kind: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g = shared.value
            step = max(16, (16 << 20) // (8 * dim * (s.degree + 2) + len(g.centroids)))
            for whole in batches:
                for lo in range(0, whole.num_rows, step):
                    batch = whole.slice(lo, step)
                    own = unit(_vectors(batch.column("v"), dim))
                    found = (lists_for if kind == 0 else lists_of)(own, g, s)
                    n = np.array([len(f) for f in found])
                    at = pa.array(np.repeat(np.arange(len(found)), n))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(found).astype(np.int32)), batch.column("vec_id").take(at),
                         batch.column("v").take(at)], names=["list", "vec_id", "v"])
        return run

    place = "list int, vec_id bigint, v array<double>"
    members = cut(common.map_arrow(vectors, placed(1), place))
    # One row for each list: at most ``most_lists``.
    size = F.broadcast(members.groupBy("list").agg(F.ceil(F.count("*") / s.part).cast("int").alias("parts")))
    entries = members.join(size, "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"), "vec_id", "v")
    probes = common.map_arrow(asked, placed(0), place).join(size, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "vec_id", "v")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, asked_v, chosen = None, [], None, []
        waiting: list[np.ndarray] = []

        def result() -> pa.RecordBatch:
            rows = [(q, v, c) for q, best in zip(ids, chosen, strict=True) for c, v in best]
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                               pa.array(cols[2], pa.float64())], names=["query_id", "vec_id", "score"])

        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("list", "part", "kind")], axis=1)
            edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
            for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(key)], strict=True):
                at, kind = tuple(key[lo, :2].tolist()), int(key[lo, 2])
                v = _vectors(batch.column("v").slice(lo, hi - lo), dim)
                own = batch.column("vec_id").slice(lo, hi - lo).to_numpy()
                if at != now:
                    if ids:
                        yield result()
                    now, ids, chosen, waiting, asked_v = at, [], [], [], None
                if kind == 0:
                    ids += own.tolist()
                    waiting.append(v)
                    chosen += [[] for _ in own]
                    continue
                if not ids:
                    continue
                if asked_v is None:
                    asked_v = np.concatenate(waiting)
                    units = unit(asked_v)
                for q0 in range(0, len(ids), 512):
                    dots = units[q0:q0 + 512] @ unit(v).T
                    dots[np.array(ids[q0:q0 + 512])[:, None] == own[None, :]] = -2
                    for q, row in enumerate(dots, q0):
                        # A slack far above rounding: ties and near ties are decided on exact values.
                        least = max(np.partition(row, -k)[-k] if len(row) > k else -1.5,
                                    chosen[q][k - 1][0] if len(chosen[q]) >= k else -1.5, -1.5)
                        cand = np.flatnonzero(row >= least - 1e-9)
                        if not len(cand):
                            continue
                        fresh = zip(exact_cosine(asked_v[q], v[cand]).tolist(), own[cand].tolist(), strict=True)
                        best = {}
                        for c, i in sorted([*chosen[q], *fresh], key=lambda r: (-r[0], r[1])):
                            if best.setdefault(i, c) == c and len(best) == k:
                                break
                        chosen[q] = [(c, i) for i, c in best.items()]
        if ids:
            yield result()

    met = entries.unionByName(probes).repartition(common.shuffle_partitions(spark), "list", "part") \
        .sortWithinPartitions("list", "part", "kind")
    found = common.map_arrow(met, scan, "query_id bigint, vec_id bigint, score double") \
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
