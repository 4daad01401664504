"""Removal of repeated strings against brute force over all strings."""
import hashlib
import os
import random

import pytest

from kestrel.llm import loser_tree, suffix_dedup

LENGTH = 100


def brute(rows):
    """Covered bytes of each (id, text), in order of id and text digest; rows that agree
    in both are one document."""
    order = lambda r: (r[0] is None, r[0] or 0, int.from_bytes(hashlib.sha256(r[1]).digest()[:4], "little"))
    seen, out = set(), {}
    for i, b in sorted(set(rows), key=order):
        cover = bytearray(len(b))
        for s in range(len(b) - LENGTH + 1):
            x = b[s:s + LENGTH]
            if x in seen:
                cover[s:s + LENGTH] = b"\1" * LENGTH
            seen.add(x)
        out[i, b] = cover
    return out


def expected(rows):
    cover = brute(rows)
    out = []
    for i, b in rows:
        c = cover[i, b]
        kept = bytes(x for x, m in zip(b, c, strict=True) if not m)
        spans = sum(1 for k in range(len(b)) if c[k] and (k == 0 or not c[k - 1]))
        out.append((str(i), len(b), sum(c), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def pairs(df):
    return [(r["doc_id"], (r["text"] or "").encode()) for r in df.collect()]


def test_odd_rows(odd_docs, no_docs):
    assert result(suffix_dedup.repeat_digest(odd_docs)) == expected(pairs(odd_docs))
    assert suffix_dedup.repeat_digest(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_passages(spark, seed):
    """Passages in many surroundings (a hot anchor), of lengths around the limit,
    overlapping, periodic, in and across documents."""
    rng = random.Random(seed)

    def noise(n):
        return "".join(rng.choice("abcdefgh ijklmnop éñ") for _ in range(n))

    common_ = [noise(n) for n in (98, 99, 100, 101, 130, 400)]
    rows = [(i, noise(rng.randrange(0, 120)) + "".join(
        rng.choice(common_)[rng.randrange(0, 3):] + noise(rng.choice([0, 1, 5, 60])) for _ in range(rng.randrange(0, 4))))
        for i in rng.sample(range(10_000), 420)]
    rows += [(20_000 + k, p * 60) for k, p in enumerate(["a", "ab", "abc" * 20, noise(37)])]
    rows += [(30_000, noise(50_000) + common_[5] * 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert result(suffix_dedup.repeat_digest(df)) == expected([(i, t.encode()) for i, t in rows])


def test_long_text_in_slices(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 5000)
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh") for _ in range(23_000))
    b = (text + text[4000:9000] + text[100:400]).encode()
    import numpy as np
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([b.decode()])], names=["doc_id", "text"])
    whole = 0
    for data, ends, _, _, offset in suffix_dedup._slices(batch, LENGTH):
        _, _, _, start, count, _ = suffix_dedup.blocks(data, ends, LENGTH)
        assert data.tobytes() == b[offset[0]:offset[0] + len(data)]
        whole += int(count.sum())
        assert (np.diff(start) > 0).all()
    assert whole == len(b) - LENGTH + 1  # every string in exactly one block


def test_rows_keep_their_columns(spark, odd_docs):
    out = suffix_dedup.remove_repeats(odd_docs)
    assert out.columns == [*odd_docs.columns, "removed"]
    cover = brute(pairs(odd_docs))
    for r in out.collect():
        spans = [(s["start"], s["stop"]) for s in r["removed"]]
        assert all(a < b for a, b in spans) and spans == sorted(spans)
    got = sorted(sum(s["stop"] - s["start"] for s in r["removed"]) for r in out.collect())
    assert got == sorted(sum(cover[p]) for p in pairs(odd_docs))
    assert sum(r["text"] is None for r in out.collect()) == sum(r["text"] is None for r in odd_docs.collect())
    assert sorted(str(r["kind"]) for r in out.collect()) == sorted(str(r["kind"]) for r in odd_docs.collect())


def test_loser_tree():
    rng = random.Random(3)
    for _ in range(1500):
        runs = []
        for _ in range(rng.randint(1, 9)):
            s = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 8)))
            runs.append((s, [0] + [loser_tree.shared_prefix(s[i - 1], s[i]) for i in range(1, len(s))]))
        out = list(loser_tree.merge(runs))
        got = [runs[r][0][p] for r, p, _ in out]
        assert [(got[i], out[i][0]) for i in range(len(out))] == sorted((x, r) for r, (s, _) in enumerate(runs) for x in s)
        for i in range(1, len(out)):
            assert out[i][2] == len(os.path.commonprefix(got[i - 1:i + 1]))


def through(tasks, batches):
    """What the tasks make of the batches, one after the other; the parts meet in order between them."""
    import pyarrow as pa
    for task in tasks:
        found = [x for b in task(iter(batches)) for x in zip(*(b.column(c).to_pylist() for c in ("part", "kind", "blob")), strict=True)]
        batches = [suffix_dedup._rows(sorted(found, key=lambda x: x[:2]))] if found else []
    return batches or [pa.RecordBatch.from_pylist([], suffix_dedup._rows([]).schema)]


def test_hot_strings_are_columns(monkeypatch):
    """Strings of a piece with many different blocks are sent as hashes and places, not with
    their bytes; the result is that of brute force."""
    import numpy as np
    import pyarrow as pa
    monkeypatch.setattr(suffix_dedup, "HOT", 8)
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh ijklmnopq") for _ in range(n))
    common_ = noise(160)
    rows = [(i, noise(80) + common_[rng.randrange(4):] + noise(80)) for i in range(400)]
    rows.append((1, rows[0][1]))  # one id, another text
    rows.append(rows[5])  # listed twice
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["doc_id", "text"])
    parts = np.arange(3, dtype=np.int32)
    settled = through([suffix_dedup._block_task(LENGTH, parts), suffix_dedup._settle_task(LENGTH, parts)],
                      [batch.slice(0, 150), batch.slice(150)])[0].to_pylist()
    texts = [r for b in suffix_dedup._text_task(parts)(iter([batch])) for r in b.to_pylist()]
    wanted = [r for r in settled if r["kind"] == suffix_dedup.WANTED]
    cols = [np.concatenate(c) for c in zip(*(suffix_dedup._unpack(r["blob"], *suffix_dedup._WANTED) for r in wanted), strict=True)]
    hot = cols[5].astype(bool)
    strings = int(cols[3][hot].astype(int).sum())
    assert strings > 10_000
    met = sorted((r["part"], r["kind"], r["blob"]) for r in [*wanted, *texts])
    runs = through([suffix_dedup._run_task(LENGTH, parts)], [suffix_dedup._rows(met)])
    rows_sent = sum(len(suffix_dedup._decoded(r["blob"])[0]) for r in runs[0].to_pylist() if r["kind"] == suffix_dedup.RUNS)
    assert rows_sent <= (~hot).sum()
    assert sum(len(r["blob"]) for r in runs[0].to_pylist()) < 40 * strings
    merged = through([suffix_dedup._merge_task(LENGTH, parts)], runs)[0].to_pylist()
    gone = [r for r in [*settled, *merged] if r["kind"] == suffix_dedup.GONE]
    met = sorted((r["part"], r["kind"], r["blob"]) for r in [*gone, *texts])
    got = pa.Table.from_batches(list(suffix_dedup._cut_task("digest")(iter([suffix_dedup._rows(met)])))).to_pylist()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) \
        == expected([(i, t.encode()) for i, t in rows])


def test_work_does_not_grow_with_the_parts():
    """Texts dealt to many parts: no copy of all of them for each part, and no Arrow batch for each
    part and task after that."""
    import time

    import numpy as np
    import pyarrow as pa
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(400)) * 20 for _ in range(1500)]
    batches = pa.Table.from_arrays([pa.array(range(1500)), pa.array(texts)], names=["doc_id", "text"]).to_batches(max_chunksize=100)

    def seconds(n):
        began = time.process_time()
        found = [r for b in suffix_dedup._text_task(np.arange(n, dtype=np.int32))(iter(batches)) for r in b.to_pylist()]
        return time.process_time() - began, found

    few, _ = seconds(3)
    many, found = seconds(1000)
    assert len(found) > 500
    assert many < 3 * few + 0.5
    one = [(0, r["kind"], r["blob"]) for r in found]
    out = list(suffix_dedup._cut_task("digest")(iter([suffix_dedup._rows(one)])))
    assert sum(b.num_rows for b in out) == 1500 and len(out) < 30
