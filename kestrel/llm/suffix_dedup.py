"""Removal of repeated passages by a distributed, prefix-aware suffix merge.

A byte goes when a string of ``length`` bytes that covers it also starts earlier
(in a smaller document, or earlier in the same one). Strings are judged on the
input; documents are never joined.

Sorting every suffix of every document would move a hundred times the text, so
suffixes are sparse. Each string of ``length`` bytes has an anchor: the start of
its ``GRAM``-byte piece of least hash, leftmost among equals. The anchor follows
from the string's own bytes, so equal strings have it at the same place.
Consecutive strings with one anchor are a block. The steps:

1. Every block is sent as (hash of the anchor's piece, hash of the block, place).
   Blocks equal as a whole are settled by order of place, at first within a task,
   then over all: the first stays, all strings of the others are repeats. A piece
   that occurs in one form only needs nothing else.
2. For blocks whose anchor piece occurs in other blocks that are not equal, the
   suffix from the anchor on is cut out of the text. Each task sorts its suffixes,
   and sends them as front-coded runs (shared prefix length and the rest), dealt by
   the anchor piece's hash, which is also the head of the sort key.
3. Runs are combined by loser trees that never compare a known common prefix again
   (``loser_tree``). Suffixes of one anchor piece come out side by side; the shared
   prefix lengths of the merge and the bytes left of the anchor say which strings of
   the blocks are equal. The first by place stays, the others are repeats.
4. Each document's repeats are united and cut out.

A piece with very many different blocks (where a common passage begins or ends in
different surroundings) is sent string by string, each as a 128-bit hash and its place,
dealt by that hash; equal strings meet in one in every task before they are sent, so
that neither the passage nor its borders gather in one task. Such strings are many (a
block has up to 69), so they are handled as columns and their bytes stay where they are.
What tasks exchange are compressed batches, one for each range of the keys; nothing is
collected by key.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm import common, loser_tree
from kestrel.llm.common import cut

GRAM = 32
HOT = 256  # different blocks of one anchor piece from which on its strings are settled one by one
SLICE = 2 << 20  # a longer text is worked on in overlapping slices
PIECE = 1 << 18  # texts worked on at once, whose hashes stay in the cache
NO_ID = np.int64((1 << 63) - 1)  # a null id counts as the largest

U = np.uint64
_RNG = np.random.default_rng(20240315)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD = _RNG.integers(1, 1 << 63, 32, dtype=np.uint64) | U(1)
# Of the second half of a string's hash.
_BYTE_2 = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_ODD_2 = _RNG.integers(1, 1 << 63, 32, dtype=np.uint64) | U(1)
BLOB = "part int, kind int, blob binary"
BLOCKS, GONE, WANTED, TEXTS, RUNS, STRINGS = range(6)


# ---- anchors and blocks


def _fold(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> U(31))


def _window_hashes(data: np.ndarray, widths: tuple[int, ...], byte: np.ndarray = _BYTE, odd: np.ndarray = _ODD
                   ) -> dict[int, np.ndarray]:
    """Hash of the bytes in every window of each width (powers of two)."""
    h, k, i, out = byte[data], 1, 0, {}
    while k < max(widths):
        h = _fold(h[:len(h) - k] * odd[i] + h[k:] * odd[i + 8])
        k, i = 2 * k, i + 1
        if k in widths:
            out[k] = h
    return out


def blocks(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Blocks of the texts that lie one after the other in ``data``: hash of the
    anchor's piece, hash of the block, text, start in the text, number of strings,
    anchor's distance from the start. At most 16 MB."""
    none = tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    if len(data) < length:
        return none
    assert len(data) < 1 << 24
    hashes = _window_hashes(data, (GRAM, 64))
    piece = hashes[GRAM] * _ODD[20]
    piece ^= piece >> U(29)
    low = U((1 << 24) - 1)
    least = (piece & ~low) | np.arange(len(piece), dtype=np.uint64)  # ties: the leftmost
    width, k = length - GRAM + 1, 1
    while 2 * k <= width:
        least = np.minimum(least[:len(least) - k], least[k:])
        k *= 2
    if k < width:
        least = np.minimum(least[:len(least) - (width - k)], least[width - k:])
    anchor = (least & low).astype(np.int64)
    n = len(anchor)  # strings
    sizes = np.diff(np.concatenate([[0], ends]))
    text = np.repeat(np.arange(len(ends)), sizes)[:n]
    whole = np.arange(n) + length <= ends[text]
    head = np.ones(n, dtype=bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(head)
    count = np.diff(np.append(first, n))
    ok = whole[first]
    first, count = first[ok], count[ok]
    if not len(first):
        return none
    span, at = count + length - 1, anchor[first]
    h64 = hashes[64]
    block = _fold((h64[first] * _ODD[24] + h64[first + (span - 64) // 2]) * _ODD[25]
                  + h64[first + span - 64] * _ODD[26] + span.astype(np.uint64))
    block ^= (at - first).astype(np.uint64) * _ODD[27]
    # The least hashes of windows are small numbers; mixed, they are even over the ranges.
    return _fold(_fold(piece[at] * _ODD[21]) * _ODD[22]) * _ODD[23], block, text[first], first - (ends - sizes)[text[first]], count, at - first


def _string_hashes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the ``length`` bytes from each place on."""
    n, out = len(data) - length + 1, []
    width = 1 << length.bit_length() - 1  # the windows at a string's begin and end cover it
    for byte, odd in ((_BYTE, _ODD), (_BYTE_2, _ODD_2)):
        h = _window_hashes(data, (width,), byte, odd)[width]
        # Mixed, so that the ranges of the first are even.
        out.append(_fold(_fold(h[:n] * odd[20] + h[length - width:length - width + n] * odd[21]) * odd[22]) * odd[23])
    return out[0], out[1]


# ---- compressed batches

_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _pack(*columns: np.ndarray) -> bytes:
    """Columns byte plane by byte plane, compressed."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns]
    return struct.pack("<q", len(columns[0])) + _COMPRESSOR.compress(b"".join(planes))


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    n = struct.unpack_from("<q", blob)[0]
    raw = np.frombuffer(_DECOMPRESSOR.decompress(blob[8:], max_output_size=1 << 31), np.uint8)
    out, at = [], 0
    for kind in kinds:
        size = np.dtype(kind).itemsize
        planes = raw[at:at + n * size].reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * size
    return out


def _by_key(key: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Part of a hash that is sorted by: one range of its values for each part."""
    return parts[((key >> U(32)) * U(len(parts)) >> U(32)).astype(np.int64)]


def _by_doc(doc: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Part of a document; mixed, as ids are not."""
    x = doc.view(np.uint64) * _ODD[28]
    return _by_key(_fold(x) * _ODD[29], parts)


def _parts(docs: DataFrame, partitions: int, part_bytes: int = 1 << 20) -> np.ndarray:
    """Labels of the parts that batches are dealt to: one for each MB of text, at most
    one for each shuffle partition. A label is a number that repartition() sends to a
    partition of its own, so that parts fall evenly on tasks; the numbers tried are
    a few for each partition."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    wanted = max(1, min(partitions, -(-size // part_bytes)))
    tried = docs.sparkSession.range(32 * partitions).select(F.col("id").cast("int").alias("part"))
    label = tried.groupBy(F.pmod(F.hash("part"), F.lit(partitions)).alias("at")).agg(F.min("part").alias("part"))
    return np.array(sorted(r["part"] for r in label.collect())[:wanted], dtype=np.int32)


def _rows(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, blob = zip(*found, strict=True) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()),
                                       pa.array(blob, pa.binary())], names=["part", "kind", "blob"])


def _few(found: Iterator[tuple[int, int, bytes]], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in Arrow batches of about a MB: one for each would cost more than what it holds."""
    held, size = [], 0
    for one in found:
        held.append(one)
        size += len(one[2])
        if size > most:
            yield _rows(held)
            held, size = [], 0
    if held:
        yield _rows(held)


def _split(kind: int, part: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    """One batch for each part, in the columns' order."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    part = part[order]
    head = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    for lo, hi in zip(head, [*head[1:], len(part)], strict=True):
        take = order[lo:hi]
        yield int(part[lo]), kind, _pack(*(c[take] for c in columns))


_GONE = ("i8", "u4", "i8", "i8")  # doc, tag, start, length


def _gone(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, size: np.ndarray, parts: np.ndarray
          ) -> Iterator[tuple[int, int, bytes]]:
    """Byte ranges to remove, united where they touch, dealt by document."""
    if not len(doc):
        return
    doc, tag, start, stop = _united(doc, tag, start, start + size)
    yield from _split(GONE, _by_doc(doc, parts), [doc, tag, start, stop - start])


def _united(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.lexsort((start, tag, doc))
    doc, tag, start, stop = doc[order], tag[order], start[order], stop[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    # Furthest end so far within each document, by a running maximum over shifted ends.
    base = (np.cumsum(new) - 1) * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + base) - base
    new[1:] |= start[1:] > reach[:-1]
    head = np.flatnonzero(new)
    return doc[head], tag[head], start[head], np.maximum.reduceat(stop, head)


# ---- documents


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(batch.column("doc_id"), int(NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)


def _tag(text: bytes) -> int:
    """Tells texts of one id apart; rows that agree in both count as one document."""
    return int.from_bytes(hashlib.sha256(text).digest()[:4], "little")


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    data, ends = common.text_bytes(batch.column("text"))
    raw = data.tobytes()
    e = ends.tolist()
    return [raw[a:b] for a, b in zip([0, *e[:-1]], e, strict=True)]


def _slices(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, ids, tags, offset of each text): pieces of a quarter of a MB; a text
    longer than a slice comes in slices that overlap by one byte less than a string."""
    for part in common.pieces(batch, PIECE):
        texts, ids = _texts(part), _ids(part)
        tags = np.array([_tag(t) for t in texts], dtype=np.uint32)
        if len(texts) == 1 and len(texts[0]) > SLICE:
            for lo in range(0, len(texts[0]) - length + 1, SLICE):
                x = np.frombuffer(texts[0][lo:lo + SLICE + length - 1], np.uint8)
                yield x, np.array([len(x)]), ids, tags, np.array([lo])
        else:
            yield (np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts]), ids, tags,
                   np.zeros(len(texts), np.int64))


_BLOCK = ("u8", "u8", "i8", "u4", "i8", "u1", "u1")  # piece, block, doc, tag, start, strings, anchor


def _settle(rec: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Records sorted by piece, block, place; whether each is the first of its block;
    and the number of different blocks of its piece."""
    piece, block, doc, tag, start = rec[:5]
    order = np.lexsort((start, tag, doc, block, piece))
    rec = [c[order] for c in rec]
    if len(order):  # a document listed more than once has each place once
        other = np.ones(len(order), dtype=bool)
        other[1:] = np.any([c[1:] != c[:-1] for c in rec[:5]], axis=0)
        rec = [c[other] for c in rec]
    piece, block = rec[0], rec[1]
    new = np.ones(len(piece), dtype=bool)
    new[1:] = piece[1:] != piece[:-1]
    first = new.copy()
    first[1:] |= block[1:] != block[:-1]
    group = np.cumsum(new) - 1
    forms = np.bincount(group, weights=first).astype(np.int64)[group] if len(group) else group
    return rec, first, forms


def _block_task(length: int, parts: np.ndarray, most: int = 1 << 19):
    def flush(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        rec, first, _ = _settle([np.concatenate(c) for c in zip(*held, strict=True)])
        found = list(_split(BLOCKS, _by_key(rec[0][first], parts), [c[first] for c in rec]))
        again = ~first
        found += _gone(rec[2][again], rec[3][again], rec[4][again], rec[5][again].astype(np.int64) + length - 1, parts)
        return _rows(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            for data, ends, ids, tags, offset in _slices(batch, length):
                piece, block, text, start, count, anchor = blocks(data, ends, length)
                held.append([piece, block, ids[text], tags[text], start + offset[text],
                             count.astype(np.uint8), anchor.astype(np.uint8)])
                size += len(piece)
                if size > most:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return run


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
    for batch in batches:
        yield from zip(batch.column("part").to_pylist(), batch.column("kind").to_pylist(),
                       (x.as_py() for x in batch.column("blob")), strict=True)


_WANTED = ("i8", "u4", "i8", "u1", "u1", "u1", "u8")  # doc, tag, start, strings, anchor, hot, piece


def _settle_task(length: int, parts: np.ndarray):
    """Blocks that are repeats as a whole; blocks whose bytes are wanted."""

    def done(held: list[bytes]) -> list[tuple[int, int, bytes]]:
        rec, first, forms = _settle([np.concatenate(c) for c in
                                     zip(*(_unpack(b, *_BLOCK) for b in held), strict=True)])
        piece, _, doc, tag, start, count, anchor = rec
        again = ~first
        out = list(_gone(doc[again], tag[again], start[again], count[again].astype(np.int64) + length - 1, parts))
        want = first & (forms > 1)
        hot = (forms > HOT).astype(np.uint8)
        cols = [doc, tag, start, count, anchor, hot, piece]
        out += _split(WANTED, _by_doc(doc[want], parts), [c[want] for c in cols])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _few(each(batches))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        held: list[bytes] = []
        now = -1
        for part, kind, blob in _by_part(batches):
            if kind != BLOCKS:
                yield part, kind, blob
                continue
            if part != now and held:
                yield from done(held)
                held = []
            now = part
            held.append(blob)
        if held:
            yield from done(held)

    return run


def _text_task(parts: np.ndarray, most: int = 32 << 20):
    """Whole rows, as compressed Arrow batches dealt by document."""
    def flush(rows: pa.Table) -> pa.RecordBatch:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
        ids = pc.fill_null(rows.column("doc_id"), int(NO_ID)).to_numpy().astype(np.int64)
        part = _by_doc(ids, parts)
        order = np.argsort(part, kind="stable")
        part = part[order]
        # Texts are copied into the parts' order once; take() for each part would copy all of them each time.
        rows = rows.combine_chunks().take(pa.array(order)).combine_chunks()
        head = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist()
        found = []
        for lo, hi in zip(head, [*head[1:], len(part)], strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
                out.write_table(rows.slice(lo, hi - lo))
            found.append((int(part[lo]), TEXTS, sink.getvalue().to_pybytes()))
        return _rows(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for piece in common.pieces(batch, most):
                held.append(piece)
                size += int(common.text_lengths(piece.column("text")).sum()) + 64 * piece.num_rows
                if size > most:
                    yield flush(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield flush(pa.Table.from_batches(held))

    return run


def _text_batches(blob: bytes) -> Iterator[pa.RecordBatch]:
    with pa.ipc.open_stream(blob) as stream:
        yield from stream


def _part_texts(batches: Iterator[pa.RecordBatch], kind: int, most: int = 1 << 20
                ) -> Iterator[tuple[list[bytes], pa.RecordBatch]]:
    """The rows of each part, joined to batches of about a MB, each beside all the part's
    batches of ``kind`` (for one part the same list)."""
    def joined() -> Iterator[tuple[list[bytes], pa.RecordBatch]]:
        for batch in pa.Table.from_batches(rows).combine_chunks().to_batches() if rows else ():
            yield held, batch

    held: list[bytes] = []
    rows: list[pa.RecordBatch] = []
    now, size = -1, 0
    for part, what, blob in _by_part(batches):
        if part != now or size > most:
            yield from joined()
            rows, size = [], 0
        if part != now:
            held, now = [], part
        if what == kind:
            held.append(blob)
            continue
        for batch in _text_batches(blob):
            rows.append(batch)
            size += batch.nbytes
    yield from joined()


def _spots(doc: np.ndarray, tag: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
    """Where each document's rows lie in columns sorted by (doc, tag)."""
    if not len(doc):
        return {}
    head = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]))
    keys = zip(doc[head].tolist(), tag[head].tolist(), strict=True)
    return dict(zip(keys, zip(head.tolist(), [*head[1:].tolist(), len(doc)], strict=True), strict=True))


def _collected(held: list[bytes], kinds: tuple[str, ...]) -> list[np.ndarray]:
    cols = [np.concatenate(c) for c in zip(*(_unpack(b, *kinds) for b in held), strict=True)] if held \
        else [np.empty(0, k) for k in kinds]
    order = np.lexsort((cols[2], cols[1], cols[0]))
    return [c[order] for c in cols]


# ---- sorted runs of suffixes

_RUN = ("u2", "u2", "u2", "i8", "u4", "i8", "u1", "u1")  # shared, rest, left, doc, tag, start, strings, anchor


def _front_coded(keys: list[bytes], lefts: list[bytes], cols: list[np.ndarray]) -> bytes:
    shared = [0] * len(keys)
    for i in range(1, len(keys)):
        shared[i] = loser_tree.shared_prefix(keys[i - 1], keys[i])
    rest = [k[s:] for k, s in zip(keys, shared, strict=True)]
    body = b"".join(rest) + b"".join(lefts)
    head = _pack(np.array(shared, np.uint16), np.array([len(r) for r in rest], np.uint16),
                 np.array([len(x) for x in lefts], np.uint16), *cols)
    return struct.pack("<q", len(head)) + head + _COMPRESSOR.compress(body)


def _decoded(blob: bytes) -> tuple[list[bytes], list[int], list[bytes], list[np.ndarray]]:
    size = struct.unpack_from("<q", blob)[0]
    shared, rest, left, *cols = _unpack(blob[8:8 + size], *_RUN)
    body = _DECOMPRESSOR.decompress(blob[8 + size:], max_output_size=1 << 31)
    keys, at, last = [], 0, b""
    for s, r in zip(shared.tolist(), rest.tolist(), strict=True):
        last = last[:s] + body[at:at + r]
        at += r
        keys.append(last)
    lefts = []
    for n in left.tolist():
        lefts.append(body[at:at + n])
        at += n
    return keys, shared.tolist(), lefts, cols


# ---- strings of hot pieces

_STRING = ("u8", "u8", "i8", "u4", "i8")  # hash, its second half, doc, tag, start


def _first_strings(rec: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Strings sorted by hash and place; whether each is the first of its hash."""
    order = np.lexsort(rec[::-1])
    rec = [c[order] for c in rec]
    first = np.ones(len(order), dtype=bool)
    first[1:] = (rec[0][1:] != rec[0][:-1]) | (rec[1][1:] != rec[1][:-1])
    return rec, first


def _hot_strings(blocks_: list[tuple[int, int, int, int, bytes]], length: int, parts: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Every string of the blocks (doc, tag, start, strings, bytes): the first of equal ones
    is sent by its hash, the others are repeats."""
    doc, tag, start, count = (np.array([b[k] for b in blocks_], t) for k, t in
                              enumerate((np.int64, np.uint32, np.int64, np.int64)))
    data = np.frombuffer(b"".join(b[4] for b in blocks_), np.uint8)
    left, right = _string_hashes(data, length)
    base = np.cumsum(count + length - 1) - (count + length - 1)
    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(base, count) + step
    rec, first = _first_strings([left[at], right[at], np.repeat(doc, count), np.repeat(tag, count),
                                 np.repeat(start, count) + step])
    found = list(_split(STRINGS, _by_key(rec[0][first], parts), [c[first] for c in rec]))
    return found + _later(rec, first, length, parts)


def _later(rec: list[np.ndarray], first: np.ndarray, length: int, parts: np.ndarray) -> list[tuple[int, int, bytes]]:
    doc, tag, start = (c[~first] for c in rec[2:])
    return list(_gone(doc, tag, start, np.full(len(start), length), parts))


def _run_task(length: int, parts: np.ndarray, most: int = 150_000, most_bytes: int = SLICE):
    """Cut wanted suffixes out of the texts and send them as sorted runs, and the strings
    of hot pieces by their hashes."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort()
        keep, again = [], []
        for i, r in enumerate(rows):  # equal suffixes with equal left sides: the first stands for all
            if keep and keep[-1][0] == r[0] and keep[-1][5] == r[5] and keep[-1][4] == r[4]:
                again.append(i)
            else:
                keep.append(r)
        found = []
        if again:
            g = [rows[i] for i in again]
            found += _gone(np.array([r[1] for r in g], np.int64), np.array([r[2] for r in g], np.uint32),
                           np.array([r[3] for r in g], np.int64),
                           np.array([r[4] for r in g], np.int64) + length - 1, parts)
        head = np.array([int.from_bytes(r[0][:8], "big") for r in keep], np.uint64)
        part = _by_key(head, parts)
        edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist()
        for lo, hi in zip(edge, [*edge[1:], len(keep)], strict=True):
            own = keep[lo:hi]
            cols = [np.array([r[k] for r in own], t) for k, t in
                    ((1, np.int64), (2, np.uint32), (3, np.int64), (4, np.uint8), (6, np.uint8))]
            found.append((int(part[lo]), RUNS, _front_coded([r[0] for r in own], [r[5] for r in own], cols)))
        return _rows(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        strings: list[tuple[int, int, int, int, bytes]] = []
        size = 0
        last, spots, cols = None, {}, []
        for held, batch in _part_texts(batches, WANTED):
            if held is not last:
                last, wanted = held, _collected(held, _WANTED)
                spots = _spots(wanted[0], wanted[1])
                cols = [c.tolist() for c in wanted]
            if not spots:
                continue
            for doc, text in zip(_ids(batch).tolist(), _texts(batch), strict=True):
                if (doc, tag := _tag(text)) not in spots:
                    continue
                lo, hi = spots.pop((doc, tag))  # a repeated row is the same document
                for i in range(lo, hi):
                    start, n, anchor, hot = cols[2][i], cols[3][i], cols[4][i], cols[5][i]
                    if hot:
                        strings.append((doc, tag, start, n, text[start:start + n + length - 1]))
                        size += n + length - 1
                    else:
                        key = cols[6][i].to_bytes(8, "big")
                        a = start + anchor
                        rows.append((key + text[a:start + n + length - 1], doc, tag, start, n, text[start:a], anchor))
                if len(rows) > most:
                    yield flush(rows)
                    rows = []
                if size > most_bytes:
                    yield _rows(_hot_strings(strings, length, parts))
                    strings, size = [], 0
        if rows:
            yield flush(rows)
        if strings:
            yield _rows(_hot_strings(strings, length, parts))

    return run


def _merge_task(length: int, parts: np.ndarray):
    """Merge the runs of a range and find the strings that occur earlier; of equal
    strings of hot pieces all but the first."""

    def resolve(group: list[tuple], out: list[tuple[int, int, int, int]]) -> None:
        """group: (doc, tag, start, strings, anchor, key, left, prefix shared with the
        suffix before), in sorted order of the suffixes."""
        if len(group) == 2:
            (d, t, s, n, a, _, left, _), (d2, t2, s2, n2, a2, _, left2, shared) = group
            right = shared - 8  # bytes that both have from the anchor on
            back = 0
            most = min(len(left), len(left2))
            while back < most and left[-1 - back] == left2[-1 - back]:
                back += 1
            if (d2, t2, s2 + a2) > (d, t, s + a):
                d, t, s, n, a, d2, t2, s2, n2, a2 = d2, t2, s2, n2, a2, d, t, s, n, a
            # Strings by how far they reach left of the anchor; the later block's go.
            lo = max(length - right, a - n + 1, a2 - n2 + 1, 0)
            hi = min(back, a, a2)
            if lo <= hi:
                out.append((d, t, s + a - hi, hi - lo + length))
            return
        seen: set[bytes] = set()
        for d, t, s, n, _, key, left, _ in sorted(group, key=lambda g: (g[0], g[1], g[2])):
            whole = left + key[8:]
            first = -1
            for k in range(n):
                string = whole[k:k + length]
                if string in seen:
                    if first < 0:
                        first = k
                else:
                    seen.add(string)
                    if first >= 0:
                        out.append((d, t, s + first, k - first + length - 1))
                        first = -1
            if first >= 0:
                out.append((d, t, s + first, n - first + length - 1))

    def done(held: list[bytes]) -> list[tuple[int, int, bytes]]:
        runs = [_decoded(b) for b in held]
        cols = [[c.tolist() for c in r[3]] for r in runs]
        out: list[tuple[int, int, int, int]] = []
        group: list[tuple] = []
        for r, i, shared in loser_tree.merge([(x[0], x[1]) for x in runs]):
            if shared < 8 and group:  # another anchor piece
                if len(group) > 1:
                    resolve(group, out)
                group = []
            group.append((*(c[i] for c in cols[r]), runs[r][0][i], runs[r][2][i], shared))
        if len(group) > 1:
            resolve(group, out)
        doc, tag, start, size = (np.array([o[k] for o in out], t) for k, t in
                                 enumerate((np.int64, np.uint32, np.int64, np.int64)))
        return list(_gone(doc, tag, start, size, parts))

    def settled(held: list[bytes]) -> list[tuple[int, int, bytes]]:
        rec, first = _first_strings([np.concatenate(c) for c in
                                     zip(*(_unpack(b, *_STRING) for b in held), strict=True)])
        return _later(rec, first, length, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _few(each(batches))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        held: list[bytes] = []
        now = (-1, RUNS)
        for part, kind, blob in _by_part(batches):
            if kind not in (RUNS, STRINGS):
                yield part, kind, blob
                continue
            if (part, kind) != now and held:
                yield from done(held) if now[1] == RUNS else settled(held)
                held = []
            now = (part, kind)
            held.append(blob)
        if held:
            yield from done(held) if now[1] == RUNS else settled(held)

    return run


# ---- the result


def _cut_task(form: str, text_type: pa.DataType | None = None):
    """Apply the ranges to the texts; form 'digest' or 'rows'."""

    def apply(text: bytes, spans: list[tuple[int, int]]) -> bytes:
        out, at = [], 0
        for lo, hi in spans:
            out.append(text[at:lo])
            at = hi
        return b"".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, spots, start, stop = None, {}, [], []
        for held, batch in _part_texts(batches, GONE):
            if held is not last:
                last = held
                doc, tag, lo, size = _collected(held, _GONE)
                if len(doc):
                    doc, tag, lo, hi = _united(doc, tag, lo, lo + size)
                    start, stop = lo.tolist(), hi.tolist()
                spots = _spots(doc, tag)
            texts = _texts(batch)
            spans = []
            for d, t in zip(_ids(batch).tolist(), texts, strict=True):
                a, b = spots.get((d, _tag(t)), (0, 0)) if spots else (0, 0)
                spans.append(list(zip(start[a:b], stop[a:b], strict=True)))
            kept = [apply(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
            if form == "digest":
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array([len(t) - len(k) for t, k in zip(texts, kept, strict=True)], pa.int64()),
                     pa.array([len(s) for s in spans], pa.int64()),
                     pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
            else:
                new = [k.decode("utf-8", "ignore") if has else None
                       for has, k in zip(batch.column("text").is_valid().to_pylist(), kept, strict=True)]
                out = batch.set_column(batch.schema.get_field_index("text"), batch.schema.field("text"),
                                       pa.array(new, batch.schema.field("text").type))
                pairs = [[{"start": a, "stop": b} for a, b in s] for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(pairs, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
                    names=[*out.schema.names, "removed"])

    return run


def _meet(df: DataFrame, partitions: int) -> DataFrame:
    """The batches of each part in one task, small kinds before texts."""
    return df.repartition(partitions, "part").sortWithinPartitions("part", "kind")


def _gone_batches(docs: DataFrame, length: int) -> tuple[DataFrame, np.ndarray, int]:
    """GONE batches of all documents (doc_id, text); the parts and the number of partitions."""
    spark = docs.sparkSession
    partitions = common.shuffle_partitions(spark)
    parts = _parts(docs, partitions)
    first = common.map_arrow(docs, _block_task(length, parts), BLOB)
    settled = cut(common.map_arrow(_meet(first, partitions), _settle_task(length, parts), BLOB))
    texts = common.map_arrow(docs, _text_task(parts), BLOB)
    runs = common.map_arrow(_meet(settled.where(F.col("kind") == WANTED).union(texts), partitions),
                            _run_task(length, parts), BLOB)
    merged = cut(common.map_arrow(_meet(runs, partitions), _merge_task(length, parts), BLOB))
    return settled.where(F.col("kind") == GONE).union(merged.where(F.col("kind") == GONE)), parts, partitions


def repeat_digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row for each row.

    Null and empty texts have no bytes; texts shorter than ``length`` lose nothing.
    Rows that agree in id and text are one document listed more than once and get the
    same result; different texts of one id are in the order of their digests; a null
    id counts as the largest. Other columns are not read."""
    docs = common.narrow(df, id_col, text_col)
    gone, parts, partitions = _gone_batches(docs, length)
    texts = common.map_arrow(docs, _text_task(parts), BLOB)
    return common.map_arrow(_meet(gone.union(texts), partitions), _cut_task("digest"),
                            "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """All rows and columns of ``df``, the text without its repeated passages, and as last
    column ``removed`` (another name, ``removed_ranges`` first, if there is a column of that name):
    the byte ranges cut out (start, stop). A character that a cut went through goes as a whole."""
    names = {id_col: "doc_id", text_col: "text"}
    inner = [names.get(c, f"c{k}") for k, c in enumerate(df.columns)]
    docs = df.toDF(*inner)
    gone, parts, partitions = _gone_batches(common.narrow(docs, "doc_id", "text"), length)
    texts = common.map_arrow(docs, _text_task(parts), BLOB)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    schema = T.StructType([*docs.schema.fields, T.StructField("removed", T.ArrayType(span))])
    out = _meet(gone.union(texts), partitions).mapInArrow(_cut_task("rows"), schema)
    free = ("removed", "removed_ranges", *(f"removed_ranges_{k}" for k in range(len(df.columns))))
    return out.toDF(*df.columns, next(name for name in free if name not in df.columns))
