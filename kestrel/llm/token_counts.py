"""Token counts by rank-synchronous array merging.

The distinct pre-tokens of an Arrow batch are laid out as ragged numpy arrays of
symbol ids. In each round every sequence applies its own lowest-rank pair, at
all its places at once; sequences without a mergeable pair leave the arrays.
The number of symbols that survive is the pre-token's token count.

Applying all places of the lowest pair at once gives the same result as merging
one place at a time, because a pair that a merge newly creates always ranks
below (is younger than) the merge that created its symbol.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kestrel.llm import common
from kestrel.llm.pretokens import PreTokenizer, per_worker

NO_RANK = np.int64(1 << 40)


class MergeTable:
    """Merge ranks of a vocabulary as sorted arrays of pair keys."""

    def __init__(self, model: dict) -> None:
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab = vocab
        left = np.array([vocab[a] for a, _ in model["merges"]], dtype=np.int64)
        right = np.array([vocab[b] for _, b in model["merges"]], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in model["merges"]], dtype=np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made[order]

    def initial(self, word: str) -> list[int]:
        """Symbol ids of a pre-token over the byte alphabet, before any merge."""
        if not word:
            return []
        get = self.vocab.get
        syms = [get(c) for c in word[:-1]]
        syms.append(get(word[-1] + self.suffix))
        return [s for s in syms if s is not None]  # the library leaves out unknown symbols, too

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return np.where(hit, self.rank[at], NO_RANK), self.made[at]


def surviving_symbols(words: list[list[int]], merges: MergeTable) -> np.ndarray:
    """How many symbols remain of each sequence after all merges."""
    size = np.array([len(w) for w in words], dtype=np.int64)
    out = size.copy()
    live = np.flatnonzero(size > 1)
    ids = np.array([s for k in live.tolist() for s in words[k]], dtype=np.int64)
    size = size[live]
    while len(live):
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        seq = np.repeat(np.arange(len(live)), size)
        rank = np.full(len(ids), NO_RANK)
        rank[:-1], made = merges.lookup(ids[:-1], ids[1:])
        rank[start + size - 1] = NO_RANK  # no pair reaches into the next sequence
        lowest = np.minimum.reduceat(rank, start)
        pick = (rank == lowest[seq]) & (rank < NO_RANK)
        # Of places that overlap (a run of one symbol) every second one merges, from the left.
        at = np.flatnonzero(pick)
        if len(at):
            fresh = np.concatenate([[True], np.diff(at) != 1])
            first = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
            at = at[(at - first) % 2 == 0]
        ids[at] = made[at]
        keep = np.ones(len(ids), dtype=bool)
        keep[at + 1] = False
        size = size - np.bincount(seq[at], minlength=len(live))
        done = (lowest >= NO_RANK) | (size < 2)
        out[live[done]] = size[done]
        keep &= ~done[seq]
        ids, live, size = ids[keep], live[~done], size[~done]
    return out


class Counter:
    """Token counts of texts, with a bounded table of pre-tokens already counted."""

    def __init__(self, spec: str, most_kept: int = 400_000) -> None:
        self.pre = PreTokenizer(spec)
        self.merges = MergeTable(self.pre.model)
        self.known: dict = {}
        self.most_kept = most_kept

    def counts(self, texts: list[str | None]) -> list[int]:
        cut = [self.pre.split(t or "") for t in texts]
        if len(self.known) > self.most_kept:
            self.known = {}
        known = self.known
        fresh = list(set().union(*cut).difference(known)) if cut else []
        words = [t for t in fresh if not isinstance(t, int)]
        known.update((t, 1) for t in fresh if isinstance(t, int))
        n = surviving_symbols([self.merges.initial(self.pre.symbols(w)) for w in words], self.merges)
        known.update(zip(words, n.tolist(), strict=True))
        get = known.__getitem__
        return [sum(map(get, tokens)) for tokens in cut]


def count_tokens(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048, piece_bytes: int = 4 << 20) -> DataFrame:
    """Token count of every whole text: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    A null or empty text has 0 bytes and 0 tokens. Every row gives one row, also a
    repeated or null id. Other columns of ``df`` are not read. The vocabulary file
    is read on the driver and broadcast (its size, about 2 MB, does not grow with
    the data); there is no shuffle.
    """
    with open(vocab_path, encoding="utf-8") as fh:
        spec = fh.read()
    shared = df.sparkSession.sparkContext.broadcast(spec)
    tag = hashlib.sha256(spec.encode()).hexdigest()
    json.loads(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = per_worker(("token_counts", tag), lambda: Counter(shared.value))
        for batch in batches:
            for part in common.pieces(batch, piece_bytes):
                n = counter.counts(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(common.text_lengths(part.column("text")), pa.int64()),
                     pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return common.map_arrow(common.narrow(df, id_col, text_col), run,
                            "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
