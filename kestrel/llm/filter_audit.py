"""Audit of how document filters interact, from a sparse document-term matrix.

1. Words are encoded by a global dictionary: a word's code is the same in every task.
   Codes are 64-bit fingerprints; the dictionary holds every code with its word, and a
   code that two words share is found there and mended by another seed.
2. Documents become CSR shards of bounded size: for each row the codes of its words and
   their counts. A row's sum is its number of words, its nonzero entries are its
   distinct words; they decide the filters A and B.
3. C and D are read off the bytes of the same shard, E follows from the smallest id of
   each text. Flags are equal for equal texts, so rows are combined by text, part and
   label before anything is compared: a text that a third of all rows hold is a few rows.
4. What is left is one row of counts per part, from which all orders are worked out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm import common
from kestrel.llm.shingles import _SEPARATOR, mix
from kestrel.operators import left_join_spread_nulls

FILTERS = "ABCDE"
_RNG = np.random.default_rng(20240613)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPECIAL = np.zeros(256, dtype=bool)
_SPECIAL[[ord(ch) for ch in "#$%&*|"]] = True


@dataclass
class Shard:
    """CSR rows: document i holds codes[indptr[i]:indptr[i + 1]] with these counts."""

    indptr: np.ndarray
    codes: np.ndarray
    counts: np.ndarray

    def row_sums(self) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(self.counts)])
        return total[self.indptr[1:]] - total[self.indptr[:-1]]

    def nonzero(self) -> np.ndarray:
        return np.diff(self.indptr)


def word_places(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, size and text of each word of the texts that lie one after the other."""
    inside = np.concatenate([[False], ~_SEPARATOR[data], [False]])
    border = np.zeros(len(data) + 1, dtype=bool)
    border[ends] = True
    begins = inside[1:-1] & (~inside[:-2] | border[:-1])
    stops = inside[1:-1] & (~inside[2:] | border[1:])
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(stops) + 1 - first, np.searchsorted(ends, first, side="right")


_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_kept: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """1, s, s**2, ... and their inverses; those for usual shards are kept."""
    if len(_kept.get("up", ())) < n:
        up, down = np.full(n, _STEP), np.full(n, _BACK)
        up[0] = down[0] = 1
        np.cumprod(up, out=up)
        np.cumprod(down, out=down)
        if n > 1 << 22:
            return up, down
        _kept["up"], _kept["down"] = up, down
    return _kept["up"][:n], _kept["down"][:n]


def word_codes(data: np.ndarray, first: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """The dictionary's code of each word: a fingerprint of its bytes in order."""
    if not len(first):
        return np.empty(0, np.uint64)
    up, down = _powers(len(data))
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(mix(_BYTE + np.uint64(seed))[data] * up, out=total[1:])
    return mix((total[first + size] - total[first]) * down[first] + size.astype(np.uint64))


def shard(data: np.ndarray, ends: np.ndarray, seed: int = 0) -> Shard:
    first, size, row = word_places(data, ends)
    codes = word_codes(data, first, size, seed)
    order = np.lexsort((codes, row))
    codes, row = codes[order], row[order]
    fresh = np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (row[1:] != row[:-1])])[:len(codes)])
    return Shard(np.searchsorted(row[fresh], np.arange(len(ends) + 1)), codes[fresh],
                 np.diff(np.append(fresh, len(codes))))


def _texts(df: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def dictionary(docs: DataFrame, text_col: str = "text", seed: int = 0, seen_bits: int = 20) -> DataFrame:
    """code, word, last: every code of the corpus with its smallest and largest word (one
    word, unless the code is shared). A task remembers about 2 ** seen_bits words it has
    sent, with a second fingerprint, so that it sends most words once; a word whose code it
    knows from another word is always sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, seen_check = (np.zeros(1 << seen_bits, dtype=np.uint64) for _ in range(2))
        for batch in batches:
            for part in common.pieces(batch, 1 << 20):
                data, ends = common.text_bytes(part.column("text"))
                first, size, _ = word_places(data, ends)
                codes, check = (word_codes(data, first, size, x) for x in (seed, seed + (1 << 32)))
                slot = (codes & np.uint64(len(seen) - 1)).astype(np.int64)
                new = np.flatnonzero((seen[slot] != codes) | (seen_check[slot] != check))
                # Of equal words here one is sent.
                order = new[np.lexsort((check[new], codes[new]))]
                fresh = order[np.concatenate([[True], (codes[order][1:] != codes[order][:-1]) | (check[order][1:] != check[order][:-1])])[:len(order)]]
                seen[slot[fresh]], seen_check[slot[fresh]] = codes[fresh], check[fresh]
                stop = np.concatenate([[0], np.cumsum(size[fresh])])
                letters = data[np.repeat(first[fresh] - stop[:-1], size[fresh]) + np.arange(stop[-1])]
                words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(fresh), [None, pa.py_buffer(stop.astype(np.int64)), pa.py_buffer(letters)])
                yield pa.RecordBatch.from_arrays([pa.array(codes[fresh].view(np.int64)), words.cast(pa.binary())], names=["code", "word"])

    rows = common.map_arrow(docs.select(F.col(text_col).cast("string").alias("text")), run, "code bigint, word binary")
    return rows.groupBy("code").agg(F.min("word").alias("word"), F.max("word").alias("last"))


def term_matrix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 0,
                shard_bytes: int = 1 << 20) -> DataFrame:
    """The matrix as CSR shards, one row each: ids, indptr, codes, counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.pieces(batch, shard_bytes):
                own = shard(*common.text_bytes(part.column("text")), seed)
                cols = [part.column("doc_id"), pa.array(own.indptr), pa.array(own.codes.view(np.int64)), pa.array(own.counts)]
                yield pa.RecordBatch.from_arrays([pa.array([c.to_pylist()], pa.list_(pa.int64())) for c in cols],
                                                 names=["ids", "indptr", "codes", "counts"])

    return common.map_arrow(common.narrow(docs, id_col, text_col), run,
                            "ids array<bigint>, indptr array<bigint>, codes array<bigint>, counts array<bigint>")


def flagged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", seed: int = 0,
            shard_bytes: int = 1 << 20) -> DataFrame:
    """doc_id, part, digest (of the text), n_words, n_distinct, failed (bits of A to D), one row for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces(batch, shard_bytes):
                data, ends = common.text_bytes(piece.column("text"))
                own = shard(data, ends, seed)
                words, distinct = own.row_sums(), own.nonzero()
                bounds = np.concatenate([[0], ends])

                def per_text(marks: np.ndarray, bounds: np.ndarray = bounds) -> np.ndarray:
                    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
                    return total[bounds[1:]] - total[bounds[:-1]]

                upper, points = per_text((data >= 65) & (data <= 90)), per_text((data & 0xC0) != 0x80)
                failed = (words < 50) * 1 + (100 * distinct < 65 * words) * 2 + (100 * upper > 5 * points) * 4 \
                    + (per_text(_SPECIAL[data]) > 0) * 8
                raw = memoryview(data)
                digests = [hashlib.sha256(raw[lo:hi]).digest() for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("part"), pa.array(digests, pa.binary()), pa.array(words),
                     pa.array(distinct.astype(np.int64)), pa.array(failed.astype(np.int32))],
                    names=["doc_id", "part", "digest", "n_words", "n_distinct", "failed"])

    return common.map_arrow(_texts(docs, id_col, text_col, part_col), run,
                            "doc_id bigint, part string, digest binary, n_words bigint, n_distinct bigint, failed int")


def _seed(docs: DataFrame, text_col: str) -> int:
    """The first seed by which no two words of the corpus share a code."""
    seed = 0
    while not dictionary(docs, text_col, seed).where("word <> last").isEmpty():
        seed += 1
    return seed


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley: for each part, order of the filters and step.

    A null text is empty, a null part the empty string. E: the text stands under a
    smaller id; a row without an id neither fails E nor lets others fail, rows of one id
    do not fail by each other. A document is good (toxic) if any of its rows in ``labels``
    says so; without one it is neither. Repeated rows count as often as they stand
    there. Without documents there are no parts. Other columns are not read."""
    rows = flagged(docs, id_col, text_col, part_col, _seed(docs, text_col))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("labelled")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    marked = left_join_spread_nulls(rows, marks, "doc_id", "labelled", spread_by=["digest", "part"])
    kind = ["digest", "part", "failed", "good", "toxic"]
    # Rows of one id first, so that a text's rows combine by kind to their number and those of the smallest id.
    each = marked.groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
    held = each.groupBy(*kind).agg(F.sum("n").alias("n"), F.min("doc_id").alias("low"),
                                   F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without_id"),
                                   F.min_by("n", "doc_id").alias("n_low"))
    first = F.min("low").over(Window.partitionBy("digest"))
    free = F.col("without_id") + F.when(F.col("low") == F.col("first"), F.col("n_low")).otherwise(0)
    split = held.withColumn("first", first).select("part", "failed", "good", "toxic", F.explode(F.array(
        F.struct(free.alias("n"), F.lit(0).alias("copy")), F.struct((F.col("n") - free).alias("n"), F.lit(16).alias("copy")))).alias("x"))
    masks = split.select("part", (F.col("failed") + F.col("x.copy")).alias("mask"), F.col("x.n").alias("n"),
                         F.when(F.col("good"), F.col("x.n")).otherwise(0).alias("n_good"),
                         F.when(F.col("toxic"), F.col("x.n")).otherwise(0).alias("n_toxic"))

    def by_mask(name: str) -> Column:
        """Counts of documents by the filters they fail, as one array of a part."""
        return F.array(*[F.sum(F.when(F.col("mask") == m, F.col(name)).otherwise(0)) for m in range(1 << len(FILTERS))]).alias(name)

    parts = masks.groupBy("part").agg(*[by_mask(c) for c in ("n", "n_good", "n_toxic")])
    bits = {f: 1 << k for k, f in enumerate(FILTERS)}
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for k, f in enumerate(order, 1):
            steps.append(f"struct('{''.join(order)}' AS filter_order, {k} AS step, {before} AS before, {bits[f]} AS bit)")
            before |= bits[f]

    def total(name: str, wanted) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1)), F.lit(0).cast("bigint"),
                           lambda acc, m: acc + F.when(wanted(m), F.col(name)[m]).otherwise(0))

    before, bit = F.col("at.before"), F.col("at.bit")

    def fails(m: Column) -> Column:
        return m.bitwiseAND(bit) != 0

    def earlier(m: Column) -> Column:
        return m.bitwiseAND(before) != 0

    out = parts.withColumn("at", F.explode(F.expr(f"array({', '.join(steps)})"))).select(
        "part", "at.filter_order", "at.step", bit.alias("bit"),
        total("n", lambda m: ~earlier(m) & ~fails(m)).alias("kept"),
        total("n", lambda m: ~earlier(m) & fails(m)).alias("removed"),
        total("n", lambda m: earlier(m) & fails(m)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("n_good", lambda m: ~earlier(m) & fails(m)).alias("good_lost"),
        total("n_toxic", lambda m: ~earlier(m) & fails(m)).alias("toxic_lost"))
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
firsts AS (SELECT text, min(doc_id) AS first FROM t GROUP BY text),
w AS (SELECT t.*, regexp_extract_all(t.text, '[^\x20\x09-\x0D]+') AS words, firsts.first,
             coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
      FROM t JOIN firsts USING (text) LEFT JOIN l ON l.doc_id = t.doc_id),
f AS (SELECT part, good, toxic,
             [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
              100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
              regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > first, false)] AS fail FROM w),
letters(x) AS (VALUES (1), (2), (3), (4), (5)),
orders AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, array_to_string([substr('ABCDE', x, 1) for x in o], '') AS filter_order, s.x AS step, o[s.x] AS own, o[:s.x - 1] AS before
          FROM orders, letters s),
kinds AS (SELECT part, fail, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM f GROUP BY part, fail),
m AS (SELECT part, filter_order, step, own, n, n_good, n_toxic, fail[own] AS fails,
             len([x for x in before if fail[x]]) > 0 AS gone, len([x for x in fail if x]) AS failures
      FROM kinds, steps),
r AS (SELECT part, filter_order, step, own,
             coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept,
             coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed,
             coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant,
             coalesce(sum(n) FILTER (fails AND failures = 1), 0) AS unique_fails,
             coalesce(sum(n_good) FILTER (NOT gone AND fails), 0) AS good_lost,
             coalesce(sum(n_toxic) FILTER (NOT gone AND fails), 0) AS toxic_lost
      FROM m GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""
