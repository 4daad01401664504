"""The ordinal fit against a plain minimiser, the scorer against a naive one, and what a high share of toxic labels keeps."""
import random
import re
import tracemalloc

import numpy as np
import pytest

import corpus_pipeline
from kestrel.llm import toxicity


def loss(w, t, x, step, penalty):
    """Mean negative log-likelihood of the cumulative-link model, plus the L1 penalty."""
    z = x @ w
    above = 1 / (1 + np.exp(-(z[:, None] - t[None, :])))
    padded = np.concatenate([np.ones((len(z), 1)), above, np.zeros((len(z), 1))], axis=1)
    at = np.arange(len(z))
    return -np.log(np.maximum(padded[at, step] - padded[at, step + 1], 1e-12)).mean() + penalty * w.sum()


def minimised(x, step, penalty, rounds=6000):
    """Full-gradient descent on numeric slopes, weights kept non-negative."""
    k, cuts = x.shape[1], int(step.max())
    p = np.concatenate([np.zeros(k), np.arange(cuts) * 1.0])
    f = lambda q: loss(q[:k], q[k:], x, step, penalty)
    eye = np.eye(len(p)) * 1e-5
    for _ in range(rounds):
        p = p - 0.8 * np.array([(f(p + e) - f(p - e)) / 2e-5 for e in eye])
        p[:k] = np.maximum(p[:k], 0)
        p[k:] = np.sort(p[k:])
    return p[:k], p[k:]


def test_fit_equals_a_plain_minimiser():
    rng = np.random.default_rng(6)
    x = (rng.random((400, 4)) < [0.3, 0.25, 0.4, 0.2]).astype(float)
    z = x @ np.array([2.0, 1.5, 0.8, 2.5]) + rng.logistic(size=400)
    grades = np.array([0, 1, 2])[(z > 1.2).astype(int) + (z > 3.0)]
    model = toxicity.fit([np.flatnonzero(r) for r in x], grades, names=list("abcd"))
    assert set(model.weights) == set("abcd") and model.levels == [1, 2]
    w = np.array([model.weights[n] for n in "abcd"])
    t = np.array(model.thresholds)
    excess = grades - grades.mean()
    penalty = 0.02 * toxicity.STRENGTH * toxicity._noise(np.ones(400), excess)
    best_w, best_t = minimised(x, grades, penalty)
    assert loss(w, t, x, grades, penalty) < loss(best_w, best_t, x, grades, penalty) + 1e-4
    assert np.abs(w - best_w).max() < 0.1 and np.abs(t - best_t).max() < 0.1
    naive = [sum(1 / (1 + np.exp(-(z - c))) for c in best_t) for z in x @ best_w]
    assert np.abs(model.severity(x @ w) - naive).max() < 0.02


def test_scorer_equals_a_naive_one(spark, odd_docs):
    model = toxicity.OrdinalModel({"<changed>": 1.5, "lamp1": 0.7, "<stone": 0.2, "<a>": 0.4, "é": 9.0}, [1.0, 2.5], [1, 2])

    def naive(text):
        found = set()
        for word in re.findall(r"[^\W_]+", (text or "").lower()):
            shown = f"<{word}>"
            found |= {shown} | {shown[i:i + 5] for i in range(len(shown) - 4)}
        z = sum(model.weights.get(f, 0.0) for f in found)
        p = [1 / (1 + np.exp(-(z - t))) for t in model.thresholds]
        return p[0] + p[1], z > 0 and p[0] >= 0.3

    want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, round(naive(r["text"])[0], 9), bool(naive(r["text"])[1])) for r in odd_docs.collect())
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, round(r["severity"], 9), r["toxic"]) for r in toxicity.score(odd_docs, model).collect())
    assert got == want and any(r[3] for r in got)


@pytest.mark.parametrize("share", [0.4, 0.9])
def test_many_toxic_labels_keep_clean_texts(spark, tmp_path, share):
    """Null, empty and clean texts stay whatever share of the labels is toxic, also if there is no useful feature."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(6))
    for useful in (True, False):
        rows, labels = [], []
        for i in range(300):
            bad = rng.random() < share
            # Words that no four texts share leave no feature to fit.
            text = " ".join(word() for _ in range(12)) + (" zzyzx quuux" if bad else "") if useful else \
                " ".join("".join(rng.choice("0123456789abcdefghij") for _ in range(14)) for _ in range(8))
            rows.append((i, text, "en", "s", len(text)))
            labels.append((i, 1, int(bad)))
        rows += [(900, None, "en", "s", None), (901, "", "en", "s", 0), (902, "plain water", "en", "s", 11)]
        path = f"{tmp_path}/{useful}"
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, path).collect()}
        assert {900, 901, 902} <= kept
        if useful:
            assert kept == {900, 901, 902} | {i for i, _, t in labels if not t}
        else:
            assert kept == {r[0] for r in rows}


def test_fit_memory():
    """The fit holds the places a few times, whatever the number of features in use."""
    rng = np.random.default_rng(4)
    grades = (rng.random(4000) < 0.4).astype(np.int64)
    rows = [np.flatnonzero(rng.random(3000) < (0.45 if g else 0.3)).astype(np.int32) for g in grades]
    places = sum(map(len, rows))
    tracemalloc.start()
    model = toxicity.fit(rows, grades, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.thresholds and peak < 37 * places
