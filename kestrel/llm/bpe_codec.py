"""BPE encoding and decoding with a backtracking encoder.

Encoding: an Aho-Corasick automaton over all tokens gives, for every place, the
tokens that start there. The encoder walks left to right, takes the longest
token that may follow the last one taken, and on a dead end takes the last one
back and tries its next shorter match. A place that proved to be a dead end is
never entered again, so the work is linear in the text. Which token may follow
which is looked up in the pair-compatibility table: (a, b) is compatible when no
merge crosses their border while both are built, and a sequence all of whose
neighbours are compatible is exactly the result of running the merges.

Decoding: all tokens' bytes lie in one array; an offset table gives each id's
slice, and a ragged gather copies all slices at once.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kestrel.llm import common
from kestrel.llm.pretokens import PreTokenizer, byte_alphabet, per_worker


class Codec:
    """Encoder and decoder of one byte-level vocabulary without a word-end suffix."""

    def __init__(self, spec: str, most_kept: int = 300_000) -> None:
        self.pre = PreTokenizer(spec)
        model = self.pre.model
        vocab: dict[str, int] = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token: its two halves and the rank that joins them
        for r, (a, b) in enumerate(model["merges"]):
            pair = vocab[a], vocab[b]
            self.rank[pair] = r
            self.parts.setdefault(vocab[a + b], (*pair, r))
        made = {t: i for t, i in vocab.items() if len(t) == 1 or i in self.parts}  # others no merge ever makes
        self.words = ahocorasick.Automaton()
        for t, i in made.items():
            self.words.add_word(t, (len(t) - 1, i))
        self.words.make_automaton()
        size = max([*vocab.values(), *self.pre.special.values()]) + 1
        self.symbols_of = [0] * size  # length of each token in symbols
        self.shorter = [-1] * size  # the longest token that is a proper prefix of it
        for t, i in made.items():
            self.symbols_of[i] = len(t)
            self.shorter[i] = next((made[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in made), -1)
        self.compatible: dict[int, bool] = {}  # by first id << 20 | second id
        self.spines: tuple[dict, dict] = ({}, {})
        self.most_kept = most_kept
        self._forget()

        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        out = [b""] * size
        for t, i in vocab.items():
            out[i] = bytes(byte_of[c] for c in t)
        for t, i in self.pre.special.items():
            out[i] = t.encode()
        self.ends = np.cumsum([len(x) for x in out])
        self.lengths = np.array([len(x) for x in out])
        self.bytes = np.frombuffer(b"".join(out), dtype=np.uint8)

    # ---- pair compatibility

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """Symbols that stand at the token's left (0) or right (1) border while it is
        built, each with the rank of the merge that takes it up (whole token: none)."""
        got = self.spines[side].get(token)
        if got is None:
            got, until, t = [], float("inf"), token
            while True:
                got.append((t, until))
                if t not in self.parts:
                    break
                until, t = self.parts[t][2], self.parts[t][side]
            self.spines[side][token] = got
        return got

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the two tokens' bytes leaves exactly a, b: no pair of
        border symbols that stand side by side at some time has a merge of its own
        then. At equal rank the place further left merges first."""
        rank, right = self.rank, self._spine(b, 0)
        for x, x_until in self._spine(a, 1):
            for y, y_until in right:
                r = rank.get((x, y))
                if r is not None and r < x_until and r <= y_until:
                    return False
        return True

    # ---- encoding

    def _walk(self, longest: list[int], base: int, n: int) -> list[int]:
        """Tokens of the n symbols from ``base`` on; longest: for each place the
        longest token that starts there."""
        size, shorter, table = self.symbols_of, self.shorter, self.compatible
        dead: set[int] = set()
        taken: list[int] = []
        at, stop, last, token = base, base + n, -1, longest[base]
        while at < stop:
            while token >= 0:
                if at + size[token] not in dead:
                    if last < 0:
                        break
                    key = last << 20 | token
                    ok = table.get(key)
                    if ok is None:
                        ok = table[key] = self.may_follow(last, token)
                    if ok:
                        break
                token = shorter[token]
            if token >= 0:
                taken.append(token)
                at += size[token]
                last = token
                token = longest[at] if at < stop else -1
            else:
                # No token fits here after the ones taken: the exact encoding of what lies
                # before ends with just the last of them, so this place is dead for good.
                dead.add(at)
                token = taken.pop()
                at -= size[token]
                last = taken[-1] if taken else -1
                token = shorter[token]
        return taken

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of pre-tokens over the byte alphabet."""
        if len(self.compatible) > 2_000_000:  # a bound on memory; entries are made again when needed
            self.compatible = {}
        joined = "\n".join(words)  # a line feed is no symbol of the alphabet
        longest = [-1] * (len(joined) + 1)
        for end, (before, token) in self.words.iter(joined):
            longest[end - before] = token  # of one start, longer matches end later
        out, base = [], 0
        for w in words:
            out.append(self._walk(longest, base, len(w)) if w else [])
            base += len(w) + 1
        return out

    def _forget(self) -> None:
        self.known: dict = {}  # pre-token: its row in what follows
        self.forms: list[bytes] = []
        self.flat = array("i")
        self.counts = array("i")

    def _learn(self, tokens: list, encoded: list[list[int]]) -> None:
        for t, ids in zip(tokens, encoded, strict=True):
            self.known[t] = len(self.forms)
            self.forms.append(",".join(map(str, ids)).encode())
            self.flat.extend(ids)
            self.counts.append(len(ids))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Ids of all texts one after the other, the number of ids of each, and each
        text's ids in decimal, joined by commas."""
        cut = [self.pre.split(t or "") for t in texts]
        if len(self.known) > self.most_kept:
            self._forget()
        fresh = list(set().union(*cut).difference(self.known)) if cut else []
        special = [t for t in fresh if isinstance(t, int)]
        self._learn(special, [[t] for t in special])
        group: list = []
        size = 0
        for w in [*(t for t in fresh if not isinstance(t, int)), None]:
            if group and (w is None or size > 1 << 20):  # matches are held for a bounded stretch at a time
                self._learn(group, self.encode_words([self.pre.symbols(x) for x in group]))
                group, size = [], 0
            if w is not None:
                group.append(w)
                size += len(w)
        get, form = self.known.__getitem__, self.forms.__getitem__
        rows: list[int] = []
        shown, upto = [], []
        for tokens in cut:
            own = list(map(get, tokens))
            shown.append(b",".join(map(form, own)))
            rows += own
            upto.append(len(rows))
        row = np.array(rows, dtype=np.int64)
        counts = np.array(self.counts, dtype=np.int64)
        n = counts[row]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = _gather(np.array(self.flat, dtype=np.int64), np.cumsum(counts)[row] - n, n)
        return ids, np.diff(total[[0, *upto]]), shown

    # ---- decoding

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids' tokens one after the other."""
        if not len(ids):
            return b""
        n = self.lengths[ids]
        return _gather(self.bytes, self.ends[ids] - n, n).tobytes()


def _gather(values: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The slices values[start:start + n] one after the other."""
    total = np.cumsum(n)
    if not len(total) or not total[-1]:
        return values[:0]
    return values[np.repeat(start - (total - n), n) + np.arange(total[-1])]


def _codec(shared, tag: str) -> Codec:
    return per_worker(("bpe_codec", tag), lambda: Codec(shared.value))


def _load(df: DataFrame, vocab_path: str):
    with open(vocab_path, encoding="utf-8") as fh:
        spec = fh.read()
    return df.sparkSession.sparkContext.broadcast(spec), hashlib.sha256(spec.encode()).hexdigest()


def encode(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
           piece_bytes: int = 1 << 20) -> DataFrame:
    """Token ids of every whole text: doc_id, ids (array<int>). Null or empty text:
    no ids. One row for each row, also for repeated and null ids."""
    shared, tag = _load(df, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, tag)
        for batch in batches:
            for part in common.pieces(batch, piece_bytes):
                flat, n, _ = codec.encode(part.column("text").to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()),
                                               pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    return common.map_arrow(common.narrow(df, id_col, text_col), run, "doc_id bigint, ids array<int>")


def decode(df: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Text of every row of token ids: doc_id, text. Bytes that are no UTF-8 become
    U+FFFD. Null or empty ids: empty text."""
    shared, tag = _load(df, vocab_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, tag)
        for batch in batches:
            texts = [codec.decode(np.array(x or [], dtype=np.int64)).decode("utf-8", "replace")
                     for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return common.map_arrow(df.selectExpr(f"`{id_col}` AS doc_id", f"`{ids_col}` AS ids"), run,
                            "doc_id bigint, text string")


def round_trip(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
               piece_bytes: int = 1 << 20) -> DataFrame:
    """Encode every whole text, decode the ids and digest both: doc_id, n_tokens,
    ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the decoded
    text in UTF-8), exact (the decoded text is the text).

    A null text counts as empty. Every row gives one row, also with a repeated or
    null id; other columns are not read. No shuffle; the vocabulary (2 MB, fixed)
    is broadcast."""
    shared, tag = _load(df, vocab_path)
    sha = hashlib.sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, tag)
        for batch in batches:
            for part in common.pieces(batch, piece_bytes):
                texts = part.column("text").to_pylist()
                flat, n, shown = codec.encode(texts)
                data = codec.decode(flat)
                sizes = np.concatenate([[0], np.cumsum(codec.lengths[flat])])
                ends = sizes[np.cumsum(n)] if len(n) else n
                decoded, same, start = [], [], 0
                for text, end in zip(texts, ends.tolist(), strict=True):
                    got = data[start:end].decode("utf-8", "replace").encode()
                    decoded.append(sha(got).hexdigest())
                    same.append(got == (text or "").encode())
                    start = end
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()),
                     pa.array([sha(s).hexdigest() for s in shown], pa.string()), pa.array(decoded, pa.string()),
                     pa.array(same, pa.bool_())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "exact"])

    return common.map_arrow(common.narrow(df, id_col, text_col), run,
                            "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, exact boolean")
