"""Benchmark decontamination with SimHash windows and a multi-index.

Every document is seen through windows of each benchmark item's own word count. A
window's fingerprint is the SimHash of its 5-word shingles, each with its number of
occurrences as weight, 256 bits. The items' fingerprints are indexed by blocks of a
byte: two fingerprints within the radius differ by more than BLOCK_BITS in at most
RADIUS // (BLOCK_BITS + 1) blocks, so an item that is close to the window in fewer than
the other blocks is out, and all items within the radius stay. Unrelated items agree
that well in a few per cent of cases at most. Candidates are verified by the exact weighted similarity of window and item,
sum of minima / sum of maxima of the shingles' counts >= 0.75.

A window that holds fewer shingles of the items of its size than the threshold
takes cannot be alike to any of them; no fingerprint is drawn up for it. This spares nearly all
windows and loses none.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased, so
punctuation and spacing make no difference.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import common
from kestrel.llm.common import cut
from kestrel.llm.shingles import NOT_ALNUM, mix, shingle_sums, word_hashes

WIDTH = 5
BLOCKS = 32  # bytes of a fingerprint
#: Of 256 bits. Two windows at the threshold differ in 44 bits on average, with a
#: standard deviation of 6.
RADIUS = 68
BLOCK_BITS = 2  # a block is close if it differs in no more bits
CLOSE_BLOCKS = BLOCKS - RADIUS // (BLOCK_BITS + 1)  # at least, of fingerprints within the radius
_BITS = np.array([v.bit_count() for v in range(256)], dtype=np.uint8)
_CLOSE = _BITS <= BLOCK_BITS
_SEEDS = np.array([0x2545F491, 0x9E3779B9, 0xC2B2AE35, 0x27D4EB2F], dtype=np.uint64)


def sim_signs(prints: np.ndarray) -> np.ndarray:
    """256 signs (+1, -1) of every shingle."""
    bits = np.unpackbits(mix(prints[:, None] + _SEEDS).astype("<u8").view(np.uint8).reshape(-1, BLOCKS), axis=1)
    return bits.astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """SimHash of rows of summed signs, BLOCKS bytes each."""
    return np.packbits(sums > 0, axis=1)


@dataclass
class Item:
    item_id: int
    words: int
    counts: Counter
    print: np.ndarray


class Index:
    """Items by word count, with the blocks of their fingerprints."""

    def __init__(self, rows: list[tuple[int, bytes]], threshold: float) -> None:
        self.threshold = threshold
        self.by_words: dict[int, list[Item]] = {}
        known: dict[int, set[int]] = {}  # shingle: word counts of the items that have it
        for item_id, text in rows:
            words, count = word_hashes(np.frombuffer(text, np.uint8), np.array([len(text)]), NOT_ALNUM)
            if len(words) < WIDTH:
                continue
            prints = mix(shingle_sums(words, count, WIDTH)[0])
            counts = Counter(prints.tolist())
            for p in counts:
                known.setdefault(p, set()).add(len(words))
            self.by_words.setdefault(len(words), []).append(
                Item(item_id, len(words), counts, fingerprints(sim_signs(prints).sum(axis=0, keepdims=True))[0]))
        self.known = np.array(sorted(known), dtype=np.uint64)
        self.sizes = [known[p] for p in self.known.tolist()]
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(self.known & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.blocks = {n: np.array([i.print for i in items]) for n, items in self.by_words.items()}
        self.repeats = {n: np.array([max(i.counts.values()) > 1 for i in items]) for n, items in self.by_words.items()}
        self.lengths = sorted(self.by_words)

    def candidates(self, words: int, print_: np.ndarray) -> np.ndarray:
        """Items of that word count close to the fingerprint in enough blocks."""
        return np.flatnonzero(_CLOSE[self.blocks[words] ^ print_].sum(axis=1) >= CLOSE_BLOCKS)

    def within(self, words: int, print_: np.ndarray, repeated: bool = False) -> list[Item]:
        """All items of that word count whose fingerprint is within the radius; and, as a
        shingle's weight can outweigh all others in a fingerprint, whatever theirs: those with
        repeated shingles, and all for a window with ``repeated`` ones."""
        if repeated:
            return self.by_words[words]
        near = np.zeros(len(self.blocks[words]), dtype=bool)
        found = self.candidates(words, print_)
        near[found] = _BITS[self.blocks[words][found] ^ print_].sum(axis=1) <= RADIUS
        return [self.by_words[words][k] for k in np.flatnonzero(near | self.repeats[words]).tolist()]

    def hits(self, prints: np.ndarray) -> np.ndarray:
        """Which of the shingles occur in some item."""
        out = self.bits[(prints & np.uint64((1 << 20) - 1)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at) and len(self.known):
            place = np.minimum(np.searchsorted(self.known, prints[at]), len(self.known) - 1)
            out[at] = self.known[place] == prints[at]
        return out

    def matches(self, prints: np.ndarray, hit: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Best window for each item that one document (its shingles in order) holds:
        item_id: (similarity, first word, words)."""
        best: dict[int, tuple[float, int, int]] = {}
        at = np.flatnonzero(hit)
        if not len(at) or not self.lengths:
            return best
        longest = self.lengths[-1]
        edge = np.flatnonzero(np.diff(at) > longest)
        for lo, hi in zip(at[np.concatenate([[0], edge + 1])], at[np.concatenate([edge, [len(at) - 1]])], strict=True):
            # No window with a hit of this stretch has one of another stretch.
            a, b = max(0, int(lo) - longest), min(len(prints), int(hi) + longest + 1)
            spots: dict[int, list[int]] = {}
            own = at[np.searchsorted(at, lo):np.searchsorted(at, hi, side="right")]
            for i, k in zip((own - a).tolist(), np.searchsorted(self.known, prints[own]).tolist(), strict=True):
                for words in self.sizes[k]:
                    spots.setdefault(words, []).append(i)
            signs = None
            for words in sorted(spots):
                full = words - WIDTH + 1
                size = min(full, len(prints))  # a shorter document is one window as a whole
                if b - a < size:
                    continue
                need = int(np.ceil(self.threshold * (full + size) / (1 + self.threshold) - 1e-9))
                if len(spots[words]) < need:
                    continue
                marked = np.zeros(b - a + 1, dtype=np.int64)
                marked[np.array(spots[words]) + 1] = 1
                total = np.cumsum(marked)
                starts = np.flatnonzero(total[size:] - total[:-size] >= need)
                if not len(starts):
                    continue
                if signs is None:
                    signs = np.concatenate([np.zeros((1, 8 * BLOCKS), np.int32), np.cumsum(sim_signs(prints[a:b]), axis=0)])
                marks = fingerprints(signs[starts + size] - signs[starts])
                for start, mark in zip((starts + a).tolist(), marks, strict=True):
                    window = Counter(prints[start:start + size].tolist())
                    near = self.within(words, mark, len(window) < size)
                    if not near:
                        continue
                    for item in near:
                        both = sum(min(n, window[s]) for s, n in item.counts.items() if s in window)
                        alike = both / (full + size - both)
                        if alike >= self.threshold and (alike, -start) > (best.get(item.item_id, (0.0, 0))[0],
                                                                         -best.get(item.item_id, (0.0, 0))[1]):
                            best[item.item_id] = (alike, start, size + WIDTH - 1)
        return best


def _found(index: Index, part: pa.RecordBatch, text_col: str) -> list[dict[int, tuple[float, int, int]]]:
    data, ends = common.text_bytes(part.column(text_col))
    words, count = word_hashes(data, ends, NOT_ALNUM)
    sums, _, owner = shingle_sums(words, count, WIDTH)
    prints = mix(sums)
    hit = index.hits(prints)
    edge = np.searchsorted(owner, np.arange(len(ends) + 1))
    some = np.add.reduceat(np.append(hit, False), np.minimum(edge[:-1], len(hit))) if len(ends) else []
    return [index.matches(prints[lo:hi], hit[lo:hi]) if hi > lo and n else {}
            for lo, hi, n in zip(edge[:-1].tolist(), edge[1:].tolist(), some, strict=True)]


def _portions(benchmark: DataFrame, portion_bytes: int) -> Iterator[tuple[list[tuple[int, bytes]], bool]]:
    """The benchmark's items in portions of bounded size for the driver, and whether there
    are several; a benchmark within the bound is one portion."""
    items = common.narrow(benchmark, "item_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-2 * total // portion_bytes)) if total > portion_bytes else 1
    for k in range(n):
        own = items if n == 1 else items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)) == k)
        yield [(r[0], r[1].encode()) for r in own.orderBy("doc_id", "text").collect()], n > 1


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = 0.75, portion_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: for each document and item
    it holds, the window most alike (of equal ones the first).

    Items with fewer than five words, null items and null ids are not searched for.
    Null, empty and shorter documents hold nothing; a document shorter than an item
    is one window. Repeated rows each give their matches, a null doc_id stays null.
    An item id with several texts matches by any. The benchmark is broadcast in
    portions of at most ``portion_bytes``, one pass over the documents for each."""
    out = None
    for rows, several in _portions(benchmark, portion_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, threshold)
            for batch in batches:
                for part in common.pieces(batch, 2 << 20):
                    ids = part.column("doc_id").to_pylist()
                    found = [(d, item, *m) for d, got in zip(ids, _found(index, part, "text"), strict=True)
                             for item, m in sorted(got.items())]
                    cols = list(zip(*found, strict=True)) or [[]] * 5
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()),
                                                        strict=True)],
                        names=["doc_id", "item_id", "similarity", "first_word", "n_words"])

        own = common.map_arrow(common.narrow(docs, id_col, text_col), run,
                               "doc_id bigint, item_id bigint, similarity double, first_word bigint, n_words bigint")
        if several:  # one portion at a time is held
            own = cut(own)
            shared.destroy()
        out = own if out is None else out.union(own)
    return out


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = 0.75,
                        portion_bytes: int = 32 << 20) -> DataFrame:
    """The rows that hold no benchmark item, with all their columns."""
    for rows, several in _portions(benchmark, portion_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, threshold)
            for batch in batches:
                clean = [not got for part in common.pieces(batch, 2 << 20, text_col) for got in _found(index, part, text_col)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if several:
            docs = cut(docs)
            shared.destroy()
    return docs
