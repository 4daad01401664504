"""Connected components of an edge list, distributed.

Every task reduces the edges it holds to a forest of stars before they are sent, and
again after all edges of a larger end have met; then each star's centre is replaced by
its own centre. A task sends a star as one row, so a centre with a third of all nodes
is one row per task in that join, and rounds get few because a task contracts whole paths at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import cut, map_arrow, shuffle_partitions, shuffled

HELD = 1 << 20  # edges a task holds before it reduces them
FEW = 1 << 18  # edges that one task is left with: 4 MB


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) for all other nodes of the edges (a, b)."""
    node, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    root = np.arange(len(node))
    while True:
        rx, ry = root[x], root[y]
        apart = np.flatnonzero(rx != ry)
        if not len(apart):
            break
        x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further
    leaf = np.flatnonzero(root != np.arange(len(node)))
    return node[leaf], node[root[leaf]]


def _reduced(edges: DataFrame) -> DataFrame:
    """The edges (a, b) as stars (u, vs): the centre and its larger nodes, task by task, in bounded memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def joined() -> tuple[np.ndarray, np.ndarray]:
            return stars(*(np.concatenate(c) for c in zip(*held, strict=True)))

        def rows(v: np.ndarray, u: np.ndarray) -> Iterator[pa.RecordBatch]:
            order = np.argsort(u, kind="stable")
            v, u = v[order], u[order]
            for lo in range(0, len(u), HELD // 8):  # a star larger than that is several rows
                own, first = np.unique(u[lo:lo + HELD // 8], return_index=True)
                ends = np.append(first, min(HELD // 8, len(u) - lo)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.ListArray.from_arrays(pa.array(ends), pa.array(v[lo:lo + HELD // 8]))], names=["u", "vs"])

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy() for c in ("a", "b")))
            n += batch.num_rows
            if n >= HELD:
                held = [joined()]
                n = len(held[0][0])
                if n >= HELD // 2:  # more nodes than are held at once: pass the forest on
                    yield from rows(*held[0])
                    held, n = [], 0
        if held:
            yield from rows(*joined())

    return map_arrow(edges, run, "u bigint, vs array<bigint>")


def _joined(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of the edges (a, b) of each task, which hold only few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [tuple(batch.column(c).to_numpy() for c in ("a", "b")) for batch in batches]
        if not held:
            return
        v, u = stars(*(np.concatenate(c) for c in zip(*held, strict=True)))
        roots = np.unique(u)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in ((v, roots), (u, roots))],
                                         names=["id", "component"])

    return map_arrow(edges, run, "id bigint, component bigint")


def connected_components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """(id, component) for every end of the edges (a, b) that lead to another node; the
    component is the smallest id reachable. Edges with a null end lead nowhere.

    Rounds end when no node moves, or as soon as the tasks' forests have at most ``few``
    edges: one task then holds them all. Each task of a round gets about so many."""
    parts = shuffle_partitions(edges.sparkSession)
    now = edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).where("a <> b")
    while True:
        stars_ = cut(_reduced(now))
        n = stars_.agg(F.sum(F.size("vs"))).first()[0] or 0
        sent = stars_.select(F.explode("vs").alias("a"), F.col("u").alias("b"))
        if n <= few:
            return cut(_joined(sent.coalesce(1)))
        tasks = min(parts, -(-n // few))
        met = cut(_reduced(sent.repartition(parts, "a").coalesce(tasks)))
        above = shuffled(met.select(F.explode("vs").alias("v"), F.col("u").alias("up")).groupBy(F.col("v").alias("u")).agg(F.min("up").alias("up")))
        pointers = cut(met.join(above, "u", "left").select(
            F.explode("vs").alias("v"), F.coalesce("up", "u").alias("u"), F.col("up").isNotNull().alias("moved")).coalesce(tasks))
        ends = pointers.groupBy("v").agg(F.min("u").alias("u"), F.max("u").alias("other"), F.max("moved").alias("moved"))
        if not ends.agg(F.count_if(F.col("moved") | (F.col("u") != F.col("other")))).first()[0]:
            roots = pointers.select("u").distinct().select(F.col("u").alias("id"), F.col("u").alias("component"))
            return cut(ends.select(F.col("v").alias("id"), F.col("u").alias("component")).union(roots))
        now = pointers.select(F.col("v").alias("a"), F.col("u").alias("b"))
