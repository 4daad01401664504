"""Near-duplicate documents by SetSketch registers.

Each document's set of word shingles is sketched into registers: for register i
every shingle draws an exponential variable from its hash, the register keeps the
smallest, on an exponentially spaced, truncated scale:
K_i = clip(floor(1 - log_b(min)), 0, q + 1). Registers of a union are the maxima of
the registers, and equal registers are as likely as two sets are alike.

1. Documents with the same set are one class; only classes are compared.
2. Bands of register values are bucketed. At first a bucket links each member with
   its smallest one, the pivot, so a group of copies costs its size, not the square.
   Buckets whose other members then still lie in different components are compared in
   full: tiles of bounded weight compute all intersections of two blocks at once and
   give out only links that join components. Every pair that shares a bucket is either
   linked through others or tested; none is given up.
3. A pivot pair's similarity is estimated jointly by likelihood from the counts of
   greater, smaller and equal registers and both set sizes; pairs far below the
   threshold (over five standard errors) are put aside.
4. The rest is confirmed on the full sets: 100 * intersection >= 75 * union.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import common
from kestrel.llm.common import cut, shuffled
from kestrel.llm.components import connected_components
from kestrel.llm.shingles import mix, shingle_sets

ROWS = 4  # registers of a band
BANDS = 40  # a pair at the threshold shares no band with a chance of (1 - 0.75**4)**40 = 2.5e-7
REGISTERS = ROWS * BANDS
BASE = 1.001
TOP = (1 << 16) - 2

_RNG = np.random.default_rng(20240301)
_XOR = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_MUL = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)


def registers(prints: np.ndarray, sizes: np.ndarray, block: int = 4096) -> np.ndarray:
    """SetSketch registers (uint16, one row per set) of sets that lie one after the
    other. A set larger than a block is sketched in parts, which merge by minimum."""
    lowest = np.full((len(sizes), REGISTERS), np.uint32(0xFFFFFFFF))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    short = (prints >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(short), block):
        own = owner[lo:lo + block]
        drawn = (short[lo:lo + block, None] ^ _XOR) * _MUL
        head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        np.minimum.at(lowest, own[head], np.minimum.reduceat(drawn, head, axis=0))
    uniform = (lowest.astype(np.float64) + 0.5) / 2.0 ** 32
    spaced = np.floor(1 - np.log(-np.log1p(-uniform)) / np.log(BASE)) + (TOP >> 1)
    return np.clip(spaced, 0, TOP + 1).astype(np.uint16)


def likely_similarity(greater: np.ndarray, smaller: np.ndarray, equal: np.ndarray,
                      size_u: np.ndarray, size_v: np.ndarray) -> np.ndarray:
    """Jaccard similarity of greatest likelihood, on a grid of hundredths."""
    u = size_u / (size_u + size_v)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    best, best_at = np.full(len(u), -np.inf), np.zeros(len(u))

    def order_chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    for j in np.arange(0, 1.0001, 0.01):
        jj = np.minimum(j, most)
        p, q = order_chance(u - v * jj), order_chance(v - u * jj)
        like = greater * np.log(np.maximum(p, 1e-12)) + smaller * np.log(np.maximum(q, 1e-12)) \
            + equal * np.log(np.maximum(1 - p - q, 1e-12))
        better = like > best
        best, best_at = np.where(better, like, best), np.where(better, jj, best_at)
    return best_at


def sketch(docs: DataFrame, piece_bytes: int = 1 << 18) -> DataFrame:
    """doc_id, n (set size), s1, s2 (fingerprint of the set), regs, one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.pieces(batch, piece_bytes):
                prints, sizes = shingle_sets(*common.text_bytes(part.column("text")))
                regs = registers(prints, sizes)
                head = np.cumsum(sizes) - sizes
                some = sizes > 0
                sums = np.zeros((2, len(sizes)), dtype=np.uint64)
                if some.any():
                    for k, form in enumerate((prints, mix(prints + np.uint64(0x51ED270B)))):
                        sums[k, some] = np.add.reduceat(form, head[some])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sums[0].view(np.int64)),
                     pa.array(sums[1].view(np.int64)), pa.array([r.astype("<u2").tobytes() for r in regs], pa.binary())],
                    names=["doc_id", "n", "s1", "s2", "regs"])

    return common.map_arrow(docs, run, "doc_id bigint, n bigint, s1 bigint, s2 bigint, regs binary")


def _full_sets(docs: DataFrame, piece_bytes: int = 1 << 18) -> DataFrame:
    """rep, members (the sorted 64-bit fingerprints of its set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.pieces(batch, piece_bytes):
                prints, sizes = shingle_sets(*common.text_bytes(part.column("text")))
                ends = np.cumsum(sizes).tolist()
                sets = [prints[e - s:e].tobytes() for e, s in zip(ends, sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(sets, pa.binary())],
                                                 names=["rep", "members"])

    return common.map_arrow(docs, run, "rep bigint, members binary")


def _estimated(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose likely similarity is at least ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ka, kb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS)
                      for c in ("regs_a", "regs_b"))
            na, nb = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            more, less = (ka > kb).sum(axis=1), (ka < kb).sum(axis=1)
            ok = likely_similarity(more, less, REGISTERS - more - less, na, nb) >= least
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return common.map_arrow(pairs, run, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([p, q])
                both.sort(kind="stable")  # two sorted runs
                common_ = int((both[1:] == both[:-1]).sum())
                ok.append(100 * common_ >= percent * (len(p) + len(q) - common_))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return common.map_arrow(pairs, run, "a bigint, b bigint")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
                    tile: int = 200_000) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row for each row of ``df``.

    Null and empty texts and texts without words have an empty set and are linked
    with nothing. A row whose id is null takes no part: its component is null and it
    is kept. Rows that share an id are judged each by its own text. Other columns of
    ``df`` are not read."""
    docs = common.narrow(df, id_col, text_col)
    drawn = cut(sketch(docs))
    classes = cut(drawn.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2", "n")
                  .agg(F.min("doc_id").alias("rep"), F.first("regs").alias("regs")))

    bands = classes.select("rep", "n", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.xxhash64(k, F.substring(F.col("regs"), k * (2 * ROWS) + 1, F.lit(2 * ROWS))))).alias("key"))
    buckets = bands.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last"), F.count("*").alias("size")) \
        .where("pivot <> last").select("key", "pivot", "size")
    members = cut(bands.join(shuffled(buckets), "key"))

    nodes = members.select("rep").distinct()
    texts = docs.withColumnRenamed("doc_id", "rep")
    sets = cut(_full_sets(texts.join(shuffled(nodes), "rep", "left_semi")))
    sizes = classes.select("rep", "n", "regs")

    def confirm(pairs: DataFrame) -> DataFrame:
        ends = sizes.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("regs").alias("regs_a"))
        other = sizes.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("regs").alias("regs_b"))
        likely = _estimated(pairs.distinct().join(shuffled(ends), "a").join(shuffled(other), "b"), percent / 100 - 0.2)
        a, b = (shuffled(sets.select(F.col("rep").alias(c), F.col("members").alias(f"set_{c}"))) for c in ("a", "b"))
        return _confirmed(likely.join(a, "a").join(b, "b"), percent)

    # Round 1: every bucket's smallest member is its pivot.
    links = cut(confirm(members.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b"))))
    labels = connected_components(links)

    # Round 2: buckets in which members that are no pivot still lie in different components.
    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(shuffled(labels.withColumnRenamed("id", "rep")), "rep", "left") \
            .withColumn("component", F.coalesce("component", "rep"))

    rest = labelled(members.where("size > 2 AND rep <> pivot").select("key", "rep"))
    undone = rest.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.min("rep").alias("first")).where("lo <> hi").select("key", "first")
    undone = cut(rest.join(shuffled(undone), "key").select("rep", "first", "component").distinct())
    groups = connected_components(undone.select(F.col("rep").alias("a"), F.col("first").alias("b")))
    more = cut(_tiled(undone.select("rep", "component").distinct()
                      .join(shuffled(groups.select(F.col("id").alias("rep"), F.col("component").alias("group"))), "rep")
                      .join(shuffled(sets), "rep"), percent, tile))
    if not more.isEmpty():
        # Components so far are the nodes now; only the new links are followed.
        of = labels.select(F.col("id").alias("node"), "component")
        ends = [of.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in ("a", "b")]
        joined = more.join(shuffled(ends[0]), "a", "left").join(shuffled(ends[1]), "b", "left") \
            .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        met = connected_components(joined).select(F.col("id").alias("component"), F.col("component").alias("joined"))
        every = labels.select("component").union(more.select("a")).union(more.select("b"))
        labels = cut(labels.union(every.select("component", "component")).distinct().join(shuffled(met), "component", "left")
                     .groupBy("id").agg(F.min(F.coalesce("joined", "component")).alias("component")))

    firsts = classes.select("s1", "s2", "n", "rep").join(shuffled(labels.withColumnRenamed("id", "rep")), "rep", "left") \
        .select("s1", "s2", "n", F.coalesce("component", "rep").alias("class_component"))
    return drawn.drop("regs").join(shuffled(firsts), ["s1", "s2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id")).alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _tiled(rows: DataFrame, percent: int, tile: int) -> DataFrame:
    """Links (a, b) that join different components of one group; rows: rep,
    component, group, members.

    A group is cut into blocks of bounded weight, every two blocks meet in a task of
    their own (a tile), and a tile gives out only links that join components it has
    not joined yet: never more than it has members."""
    weight = F.greatest(F.length("members") / 8, F.lit(100))
    parts = common.shuffle_partitions(rows.sparkSession)
    # Only groups of several blocks need their number; one copy of it a part, so that the
    # rows of a large group meet it in as many tasks.
    total = rows.groupBy("group").agg(F.ceil(F.sum(weight) / tile).cast("int").alias("blocks")).where("blocks > 1") \
        .select("group", "blocks", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(parts)).cast("int"))
    placed = dealt.join(shuffled(total), ["group", "part"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))) \
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "group", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "rep", "component", "members")
    keys = ["group", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None
        for batch in batches:
            tiles = zip(*(batch.column(k).to_pylist() for k in keys), strict=True)
            for at, rep, component, raw in zip(tiles, batch.column("rep").to_pylist(),
                                               batch.column("component").to_pylist(), batch.column("members"), strict=True):
                if at != now and held:
                    yield _joining_links(held, percent)
                    held = []
                now = at
                held.append((rep, component, np.frombuffer(raw.as_py(), np.uint64)))
        if held:
            yield _joining_links(held, percent)

    return common.map_arrow(met.repartition(parts, *keys).sortWithinPartitions(*keys),
                            run, "a bigint, b bigint")


def _intersections(sets: list[np.ndarray], often: int = 32, columns: int = 2048) -> np.ndarray:
    """Sizes of all intersections of some sets. Members that many sets have are
    counted by products of membership matrices, the others pair by pair."""
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    value, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    many = np.flatnonzero(count >= often)
    number = np.full(len(value), -1)
    number[many] = np.arange(len(many))
    at = number[place]
    for lo in range(0, len(many), columns):
        inside = (at >= lo) & (at < lo + columns)
        has = np.zeros((len(sets), min(columns, len(many) - lo)), dtype=np.float32)
        has[owner[inside], at[inside] - lo] = 1
        for k in range(0, len(sets), 256):  # a product of all rows would be another matrix of all pairs
            out[k:k + 256] += has[k:k + 256] @ has.T
    few = np.flatnonzero((count[place] > 1) & (at < 0))
    few = few[np.argsort(place[few], kind="stable")]
    who, what = owner[few], place[few]
    for step in range(1, often):
        if len(who) <= step:
            break
        same = what[step:] == what[:-step]
        x, y = who[:-step][same], who[step:][same]
        np.add.at(out, (x, y), 1)
        np.add.at(out, (y, x), 1)
    return out


def _joining_links(rows: list[tuple], percent: int) -> pa.RecordBatch:
    rows = sorted({r[0]: r for r in rows}.values(), key=lambda r: r[0])
    size = np.array([len(r[2]) for r in rows])
    component = np.array([r[1] for r in rows])
    both = _intersections([r[2] for r in rows])
    parent = {c: c for c in component.tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    a, b = [], []
    for lo in range(0, len(rows), 256):
        own = slice(lo, lo + 256)
        near = 100 * both[own] >= percent * (size[own, None] + size[None, :] - both[own])
        near &= component[own, None] != component[None, :]
        for i, j in zip(*np.nonzero(np.triu(near, lo)), strict=True):
            i += lo
            x, y = root(int(component[i])), root(int(component[j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                a.append(rows[i][0])
                b.append(rows[j][0])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those that a smaller document of their group stands
    for. Of rows that agree in id and text one stays; rows without an id stay."""
    found = cut(near_duplicates(docs, id_col, text_col).select("doc_id", "component_id", "kept"))
    gone = found.where("NOT kept").select(F.col("doc_id").alias(id_col)).distinct()
    twice = found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    left = docs.join(gone, id_col, "left_anti")
    if twice.isEmpty():
        return left
    # Rows without an id are never repeats of each other: each gets a number of its own.
    mark = next(c for c in (f"row{k}" for k in range(len(docs.columns) + 1)) if c not in docs.columns)
    return left.withColumn(mark, F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())) \
        .dropDuplicates([id_col, text_col, mark]).drop(mark)
