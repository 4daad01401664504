"""Toxicity by cumulative-link ordinal regression.

Severity grades are ordered: 0 clean, 1 toxic, 2 toxic and of low quality. With a
text's sparse features x, one weight vector w serves all thresholds:
P(grade > k) = sigmoid(w.x - t_k), t_0 < t_1. Expected severity is the sum of these
probabilities; a document is rejected when P(grade > 0) reaches the cut.

Features are the words and 5-character pieces of a text, each counted once however
often it occurs, so that repetition does not add up to toxicity. The model holds them
as strings: only the selected words and pieces themselves count, never others of the
same hash, however many different words a text has. Weights are not negative, so no amount of clean text around it makes up
for a toxic passage; an L1 penalty sets those of pieces that tell nothing to 0.

The model is fitted on a bounded sample of labelled rows (``per_class`` for each
class, the rows of smallest hash, within ``sample_bytes`` of text); scoring covers
every row and whole texts.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import common
from kestrel.llm.common import cut

_WORD = re.compile(r"[^\W_]+")


def word_features(word: str, n: int = 5) -> set[str]:
    """Features of one lower-case word: itself and its n-character pieces with the
    word's borders marked."""
    shown = f"<{word}>"
    return {shown, *(shown[i:i + n] for i in range(len(shown) - n + 1))}


def _hash(feature: str) -> int:
    """64 bits; counts features, which are then told apart by their strings."""
    return int.from_bytes(blake2b(feature.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass
class OrdinalModel:
    """Shared weights (features whose weight is not 0) and ordered thresholds.
    ``levels`` are the grades above each threshold."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)
    levels: list[int] = field(default_factory=list)

    def severity(self, index: np.ndarray) -> np.ndarray:
        """Expected severity of texts whose w.x is ``index``."""
        out = np.zeros(len(index))
        below = 0
        for t, grade in zip(self.thresholds, self.levels, strict=True):
            out += (grade - below) * _sigmoid(index - t)
            below = grade
        return out

    def rejects(self, index: np.ndarray, cut: float) -> np.ndarray:
        """Texts whose P(grade > 0) reaches the cut by features of their own: a text without
        any weighted feature (w.x = 0) is kept, however many of the labels are toxic."""
        if not self.thresholds:
            return np.zeros(len(index), dtype=bool)
        return (index > 0) & (_sigmoid(index - self.thresholds[0]) >= cut)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


STRENGTH = 0.05
LEAST_DOCS = 4


def _noise(weight: np.ndarray, excess: np.ndarray) -> float:
    """What 1 / sqrt(rows) is for rows of equal weight: the noise of a weighted mean slope
    in units of the spread."""
    return float(np.sqrt((weight ** 2 * excess ** 2).sum() / (weight * excess ** 2).sum() / weight.sum()))


def fit(rows: list[np.ndarray], grades: np.ndarray, strength: float = STRENGTH, rounds: int = 500,
        least_docs: int = LEAST_DOCS, weight: np.ndarray | None = None, names: list[str] | None = None) -> OrdinalModel:
    """Cumulative-link fit by proximal AdaGrad over all rows (places of the features in
    ``names`` per row, and the number of rows that each stands for).

    The L1 penalty is strength / sqrt(rows), as the noise of a feature's mean slope
    shrinks. Only features whose slope at weight 0 exceeds it enter the fit. With fewer than two different grades there is nothing to learn: no thresholds,
    severity 0 everywhere."""
    seen = sorted(set(grades.tolist()))
    if len(seen) < 2:
        return OrdinalModel()
    n = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if n.sum() else np.empty(0, np.int32)
    row_of = np.repeat(np.arange(len(rows), dtype=np.int32), n)
    weight = np.ones(len(rows)) if weight is None else weight
    names = [str(k) for k in range(int(flat.max(initial=-1)) + 1)] if names is None else names
    width = len(names)
    share_of = weight / weight.sum()
    step_of = np.searchsorted(seen, grades)  # grade's place among those seen
    excess = step_of - share_of @ step_of
    penalty = strength * _noise(weight, excess)
    docs, slopes = np.zeros(width, dtype=np.int64), np.zeros(width)
    for lo in range(0, len(flat), 1 << 20):  # without temporary copies of all places
        some = flat[lo:lo + (1 << 20)]
        docs += np.bincount(some, minlength=width)
        np.add.at(slopes, some, (share_of * excess)[row_of[lo:lo + (1 << 20)]])
    held = (docs >= least_docs) & (slopes > penalty)
    cuts = len(seen) - 1
    above = step_of[:, None] > np.arange(cuts)[None, :]
    share = np.clip(share_of @ above, 1e-3, 1 - 1e-3)
    t = -np.log(share / (1 - share))
    # The penalty selects features and shrinks their weights; a second fit of those
    # selected, under a fiftieth of it, takes the shrinkage back.
    for weaker, speed in ((1.0, 0.3), (0.02, 1.0)):
        used = np.flatnonzero(held)
        place = np.zeros(width, dtype=np.int64)
        place[used] = np.arange(len(used))
        keep = held[flat]
        w, t = _descend(place[flat[keep]], row_of[keep], len(used), step_of, share_of, t, weaker * penalty, rounds, speed)
        held[used[w == 0]] = False
    found = np.flatnonzero(w)
    return OrdinalModel({names[used[k]]: float(w[k]) for k in found}, t.tolist(), seen[1:])


def _descend(col: np.ndarray, row: np.ndarray, features: int, step_of: np.ndarray, share_of: np.ndarray, t: np.ndarray,
             penalty: float, rounds: int, speed: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by proximal AdaGrad; (row, col): the features' places;
    share_of: each row's share of the loss."""
    m, cuts = len(step_of), len(t)
    row = row.astype(np.int64)
    each = np.empty(len(col))  # what a round gathers at every place
    w, w_sum, t_sum = np.zeros(features), np.full(features, 1e-8), np.full(cuts, 1e-8)
    for _ in range(rounds):
        x = np.bincount(row, weights=np.take(w, col, out=each, mode="clip"), minlength=m)
        # P(step = j) = s_{j-1} - s_j with s_k = sigmoid(x - t_k)
        s = _sigmoid(x[:, None] - t[None, :])
        padded = np.concatenate([np.ones((m, 1)), s, np.zeros((m, 1))], axis=1)
        at = np.arange(m)
        p = np.maximum(padded[at, step_of] - padded[at, step_of + 1], 1e-9)
        slope = padded * (1 - padded)
        d_upper, d_lower = slope[at, step_of] / p, slope[at, step_of + 1] / p  # of s_{j-1} and s_j
        g = -(d_upper - d_lower) * share_of  # gradient of the mean loss by x
        grad_w = np.bincount(col, weights=np.take(g, row, out=each, mode="clip"), minlength=features)
        grad_t = np.zeros(cuts)
        np.add.at(grad_t, step_of[step_of > 0] - 1, (d_upper * share_of)[step_of > 0])
        np.add.at(grad_t, step_of[step_of < cuts], -(d_lower * share_of)[step_of < cuts])
        w_sum += grad_w ** 2
        t_sum += grad_t ** 2
        rate = speed / np.sqrt(w_sum)
        w = w - rate * grad_w
        w = np.maximum(w - rate * penalty, 0)
        t = np.sort(t - speed / np.sqrt(t_sum) * grad_t)
    return w, t


def _scorer(model: OrdinalModel):
    """Function from texts to w.x; what a word adds is looked up once per word."""
    weight = model.weights
    known: dict[str, tuple[str, ...]] = {}

    def index(texts: list[str | None]) -> np.ndarray:
        nonlocal known
        if len(known) > 100_000:  # bounds memory, which a worker keeps for later stages; entries are made again when needed
            known = {}
        out = np.zeros(len(texts))
        for k, text in enumerate(texts):
            found: set[str] = set()
            for word in words(text):
                own = known.get(word)
                if own is None:
                    own = known[word] = tuple(f for f in word_features(word) if f in weight)
                if own:
                    found.update(own)
            out[k] = sum(weight[f] for f in sorted(found))
        return out

    return index


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          per_class: int = 4000, sample_bytes: int = 48 << 20) -> OrdinalModel:
    """Fit on at most ``per_class`` clean and ``per_class`` toxic labelled documents: of
    each class those that fit into half of ``sample_bytes`` of text in hash order, where
    one that does not fit is skipped and uses up nothing; the smallest if none fits.
    A row of the sample weighs as many labelled rows as it stands for, so that the share
    of each grade is that of the whole table, whatever its size.

    Rows whose toxic label or id is null are left out; an id labelled more than once
    takes its worst labels; a null quality counts as good. The sample's ids (at most
    2 x per_class) are broadcast. Features are counted on the executors; those that the
    fit's bounds admit (some hundreds or thousands) enter it, in one task."""
    graded = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.min(F.coalesce("quality", F.lit(1))).alias("quality")).select(
        F.col("doc_id").alias("label_id"),
        F.when(F.col("toxic") > 0, 1 + (F.col("quality") <= 0).cast("int")).otherwise(0).alias("grade"))
    graded_rows = {r["grade"]: r["n"] for r in graded.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("label_id")
    parts = [graded.where(c).orderBy(order, "label_id").limit(per_class)
             for c in (F.col("grade") > 0, F.col("grade") == 0)]
    asked = cut(parts[0].unionByName(parts[1]))
    texts = common.narrow(docs, id_col, text_col)
    sizes = texts.join(F.broadcast(asked), F.col("doc_id") == F.col("label_id")) \
        .groupBy("label_id", "grade").agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("rows")) \
        .orderBy(F.xxhash64("label_id"), "label_id").collect()
    total, chosen = {True: 0, False: 0}, []
    for r in sizes:
        toxic = r["grade"] > 0
        if total[toxic] + (r["size"] or 0) <= sample_bytes // 2:
            chosen.append(r)
            total[toxic] += r["size"] or 0
    for toxic in (True, False):  # documents that are all too large: the smallest
        own = [r for r in sizes if (r["grade"] > 0) == toxic]
        if own and not any((r["grade"] > 0) == toxic for r in chosen):
            chosen.append(min(own, key=lambda r: (r["size"], r["label_id"])))
    # Rows of the whole table that a row of the sample stands for, by grade: what
    # per_class and sample_bytes have left out of its class counts in the fit.
    stands_for = {}
    for g in {r["grade"] for r in chosen}:
        own = sum(n for k, n in graded_rows.items() if (k > 0) == (g > 0))
        found, taken = (sum(r["rows"] for r in x if r["grade"] == g) for x in (sizes, chosen))
        stands_for[g] = own / min(own, per_class) * found / taken
    rows_of = [r["rows"] for r in chosen]
    chosen = [(r["label_id"], r["grade"]) for r in chosen]
    seen = sorted({g for _, g in chosen})
    if len(seen) < 2:
        return OrdinalModel()
    sample = docs.sparkSession.createDataFrame(chosen, "label_id bigint, grade int")
    rows = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).select("doc_id", "grade", "text")

    # Of the features, only those that the fit can use come to the driver.
    mass = np.array([n * stands_for[g] for n, (_, g) in zip(rows_of, chosen, strict=True)])
    steps = np.array([seen.index(g) for _, g in chosen])
    mean = float(mass @ steps / mass.sum())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.pieces(batch, 1 << 20):
                held = list(_features([part]))
                ids, where = np.unique(np.concatenate([f for f, _ in held]), return_inverse=True)
                slope = np.repeat([(seen.index(g) - mean) * stands_for[g] for _, g in held], [len(f) for f, _ in held])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(np.bincount(where, minlength=len(ids)), pa.int64()),
                     pa.array(np.bincount(where, weights=slope, minlength=len(ids)), pa.float64())],
                    names=["feature", "n", "excess"])

    each = np.repeat([stands_for[g] for _, g in chosen], rows_of)
    least = 0.9 * STRENGTH * _noise(each, np.repeat(steps - mean, rows_of))  # fit() applies the exact bound
    useful = common.map_arrow(rows, counted, "feature bigint, n bigint, excess double").groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("excess").alias("excess")).where((F.col("n") >= LEAST_DOCS) & (
            F.col("excess") / float(mass.sum()) > float(least)))
    keep = np.sort(np.array([r["feature"] for r in useful.select("feature").collect()], dtype=np.int64))
    kept = docs.sparkSession.sparkContext.broadcast(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places in ``keep`` for each row; last, in a row without grade, the strings found
        and their places."""
        wanted = kept.value
        names: dict[int, str] = {}
        place_of = {h: k for k, h in enumerate(wanted.tolist())}
        for batch in batches:
            for part in common.pieces(batch, 1 << 20):
                found = [np.flatnonzero(np.isin(wanted, ids, assume_unique=True)) for ids, _ in _features([part], place_of, names)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("grade"), pa.array(found, pa.list_(pa.int32())),
                                                  pa.nulls(len(found), pa.list_(pa.string()))], names=["doc_id", "grade", "f", "names"])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([list(names)], pa.list_(pa.int32())),
             pa.array([list(names.values())], pa.list_(pa.string()))], names=["doc_id", "grade", "f", "names"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = [""] * len(kept.value), []
        for batch in batches:
            ends, places = batch.column("f").offsets.to_numpy(), batch.column("f").values.to_numpy()
            for k, (doc, grade) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "grade")), strict=True)):
                f = places[ends[k]:ends[k + 1]]
                if grade is None:
                    for at, name in zip(f.tolist(), batch.column("names")[k].as_py(), strict=True):
                        names[at] = min(name, names[at] or name)
                else:
                    held.append((doc, grade, f.copy()))
        # The same model whatever order the rows came in; the bytes are ordered as the places are.
        held.sort(key=lambda r: (r[0], r[1], r[2].astype(">i4").tobytes()))
        m = fit([f for _, _, f in held], np.array([g for _, g, _ in held]),
                weight=np.array([stands_for[g] for _, g, _ in held]), names=names)
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(m.weights)], pa.list_(pa.string())), pa.array([list(m.weights.values())], pa.list_(pa.float64())),
             pa.array([m.thresholds], pa.list_(pa.float64())), pa.array([m.levels], pa.list_(pa.int32()))],
            names=["names", "weights", "thresholds", "levels"])

    # One task fits the bounded sample; the driver gets the weights that are not 0.
    got = common.map_arrow(common.map_arrow(
        rows, run, "doc_id bigint, grade int, f array<int>, names array<string>").repartition(1), fitted,
                           "names array<string>, weights array<double>, thresholds array<double>, levels array<int>").collect()
    if not got or not got[0]["thresholds"]:
        return OrdinalModel()
    m = got[0]
    return OrdinalModel(dict(zip(m["names"], m["weights"], strict=True)), list(m["thresholds"]), list(m["levels"]))


def _features(batches: Iterable[pa.RecordBatch], place_of: dict[int, int] | None = None,
              names: dict[int, str] | None = None) -> Iterator[tuple[np.ndarray, int]]:
    """(sorted feature hashes, grade) of each row (text, grade). With ``place_of`` only
    hashes in it count, and ``names`` gets the strings by place."""
    known: dict[str, tuple[int, ...]] = {}
    for batch in batches:
        for part in common.pieces(batch, 4 << 20):
            for text, grade in zip(part.column("text").to_pylist(), part.column("grade").to_pylist(), strict=True):
                if len(known) > 50_000:
                    known = {}
                found = array("q")
                for word in words(text):
                    own = known.get(word)
                    if own is None:
                        hashed = {_hash(f): f for f in word_features(word)}
                        if place_of is not None:
                            hashed = {h: f for h, f in hashed.items() if h in place_of}
                            names.update((place_of[h], f) for h, f in hashed.items())
                        own = known[word] = tuple(hashed)
                    found.extend(own)
                yield np.unique(np.frombuffer(found, dtype=np.int64)), grade


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text",
          cut: float = 0.3) -> DataFrame:
    """doc_id, severity (expected grade), toxic (rejected), one row for each row.
    A text without any weighted feature, null and empty ones included, is not rejected;
    its severity is that of the thresholds alone. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index_of = _scorer(model)
        for batch in batches:
            for part in common.pieces(batch, 1 << 20):
                x = index_of(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(model.severity(x), pa.float64()),
                     pa.array(model.rejects(x, cut), pa.bool_())], names=["doc_id", "severity", "toxic"])

    return common.map_arrow(common.narrow(docs, id_col, text_col), run, "doc_id bigint, severity double, toxic boolean")


def keep_clean(docs: DataFrame, model: OrdinalModel, text_col: str = "text", cut: float = 0.3) -> DataFrame:
    """The rows that are not rejected, with all their columns as they are; null and empty
    texts, and all others without any weighted feature, stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index_of = _scorer(model)
        for batch in batches:
            x = np.concatenate([np.zeros(0), *(index_of(part.column(text_col).to_pylist())
                                               for part in common.pieces(batch, 1 << 20, text_col))])
            yield batch.filter(pa.array(~model.rejects(x, cut)))

    return common.map_arrow(docs, run, docs.schema)
