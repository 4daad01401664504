"""Pivot-permutation index, ranked search and filter audit against brute force and SQL."""
import itertools
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kestrel.llm import filter_audit, pivots, ranked_search
from kestrel.llm.common import text_bytes
from tests.llm.test_filters import against_sql, bag


def brute_links(rows, threshold=0.98):
    """(vec_id, n_links, component) of rows (vec_id, vector, label)."""
    def usable(r):
        return r[0] is not None and r[2] is not None and r[1] is not None and len(r[1]) > 0 \
            and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    n = [0] * len(rows)
    for i, j in itertools.combinations([k for k, r in enumerate(rows) if usable(r)], 2):
        a, b = rows[i], rows[j]
        if a[2] != b[2] or len(a[1]) != len(b[1]):
            continue
        x, y = np.array(a[1], float), np.array(b[1], float)
        x, y = x / np.abs(x).max(), y / np.abs(y).max()
        if (x @ y) / np.sqrt((x @ x) * (y @ y)) >= threshold:
            n[i], n[j] = n[i] + 1, n[j] + 1
            parent[root(i)] = root(j)
    low = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            low[root(k)] = min(r[0], low.get(root(k), r[0]))
    return sorted(((r[0], n[k], low[root(k)]) for k, r in enumerate(rows) if r[0] is not None))


def vectors(spark, rows, kind="array<double>"):
    return spark.createDataFrame([(*r, "x", 0) for r in rows],
                                 f"vec_id bigint, embedding {kind}, label int, kept string, n_links int").repartition(3)


def found_links(df):
    return sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in df.collect() if r["vec_id"] is not None)


def clustered(rng, groups, noise, dim=16):
    rows = []
    for size, spread in zip(groups, noise, strict=True):
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        label = int(rng.integers(3))
        rows += [((centre + rng.normal(size=dim) * spread) * rng.uniform(0.1, 9), label) for _ in range(size)]
    return [(int(i), x.tolist(), label) for i, (x, label) in zip(rng.permutation(len(rows)) + 1, rows, strict=True)]


def test_near_vectors_equal_brute_force(spark):
    """Groups near the threshold, one of them a third of all rows and larger than a block."""
    rng = np.random.default_rng(3)
    rows = clustered(rng, [150, 40, 40, 60, *[3] * 40], [0.03, 0.02, 0.04, 0.05, *[0.035] * 40])
    want = brute_links(rows)
    assert sum(n for _, n, _ in want) > 1000
    got = pivots.near_vectors(vectors(spark, rows), settings=pivots.Settings(part=32))
    assert found_links(got) == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.collect())


def test_near_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    base = [1.0, 2.0, -3.0, 0.5]
    odd = [None, [], [0.0] * 4, [1.0, None, 2.0, 3.0], [nan, 1.0, 1.0, 1.0], [inf, 0.0, 0.0, 1.0]]
    rows = [(100 + k, v, 1) for k, v in enumerate(odd)] * 2
    rows += [(9, base, 1), (8, base, 1), (8, base, 1), (7, [2 * x for x in base], 1), (6, [-x for x in base], 1), (5, base, 2),
             (4, base, None), (None, base, 1), (None, base, 1), (3, [1e-200 * x for x in base], 1), (2, [1e200 * x for x in base], 1),
             (11, base[:3], 1), (12, base[:3], 1), (9, [5.0, -1.0, 0.0, 0.0], 1), (20, [5.0, -1.0, -0.0, 0.0], 1), (21, [5.0, -1.0, 0.0, 0.0], 1)]
    df = vectors(spark, rows)
    assert found_links(pivots.near_vectors(df)) == brute_links(rows)
    none = [r for r in pivots.near_vectors(df).collect() if r["vec_id"] is None]
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in none] == [(0, None, True)] * 2
    assert pivots.near_vectors(df.limit(0)).count() == 0
    assert found_links(pivots.near_vectors(vectors(spark, rows[:6]))) == brute_links(rows[:6])
    usual = [r for r in rows if r[0] not in (2, 3)]  # no components whose squares leave the doubles
    against_sql(pivots.near_vectors(vectors(spark, usual)), pivots.ORACLE_SQL,
                embeddings=pd.DataFrame(usual, columns=["vec_id", "embedding", "label"]).astype({"vec_id": "Int64", "label": "Int64"}))


@pytest.mark.parametrize("n", [3000, 12000])
def test_near_vectors_recall(spark, n):
    """At two sizes, most of them alone; pairs at the threshold."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    turn = rng.normal(size=(n // 6, 64))
    turn -= (turn * x[:n // 6]).sum(axis=1)[:, None] * x[:n // 6]
    turn /= np.linalg.norm(turn, axis=1)[:, None]
    angle = np.arccos(rng.uniform(0.98, 0.985, n // 6))[:, None]
    x[n // 2:n // 2 + n // 6] = np.cos(angle) * x[:n // 6] + np.sin(angle) * turn
    near = (x @ x.T >= 0.98).sum(axis=1) - 1
    got = pivots.near_vectors(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]))
    links = {r["vec_id"]: r["n_links"] for r in got.collect()}
    assert all(links[i] <= near[i] for i in range(n))
    assert sum(links.values()) >= 0.99 * near.sum() > 0


def test_prefixes_of_a_narrow_cone():
    """Pivots are found even where all vectors point nearly the same way."""
    rng = np.random.default_rng(5)
    x = pivots.unit_rows(np.ones(64) + 0.3 * rng.normal(size=(2000, 64)))
    assert (x @ x.T).min() > 0.8
    assert len(pivots.spread_pivots(x, 100)) >= 16


TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def search_sql(got, docs, items):
    against_sql(got, ranked_search.ORACLE_SQL, documents=docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}),
                benchmark=items.select("item_id", "text").toPandas().astype({"item_id": "Int64"}))


def test_ranked_search(spark, odd_docs, no_docs):
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(60)]
    weight = [1 / (k + 1) for k in range(60)]
    rows = [(i, " ".join(rng.choices(vocab, weight, k=rng.randrange(0, 90))), "x") for i in range(600)]
    rows += [(i, rows[5][1], "y") for i in range(600, 900)]  # a third of all rows: ties
    rows += [(900, None, None), (901, " ?! ", "z"), (None, "w1 w59", "z"), (7, "W59 w58-w57", "again"), (7, "W59 w58-w57", "again")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, rank string").repartition(4)
    items = [(k, " ".join(rng.choices(vocab, k=rng.randrange(1, 12)))) for k in range(25)]
    items += [(50, "unknown words"), (51, ""), (52, None), (53, "w59 W59, w59"), (53, "w59 W59, w59"), (None, "w3"), (54, rows[5][1])]
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    for postings in (1 << 22, 700):
        search_sql(ranked_search.search(docs, asked, shard_postings=postings), docs, asked)
    search_sql(ranked_search.search(docs, asked, portion_bytes=300), docs, asked)
    odd_items = odd_docs.select(F.col("doc_id").alias("item_id"), "text", "kind")
    search_sql(ranked_search.search(odd_docs, odd_items), odd_docs, odd_items)
    assert ranked_search.search(no_docs, asked).count() == 0
    assert ranked_search.search(docs, asked.limit(0)).count() == 0


def test_reading_stops_early():
    """Selective queries read a part of their lists, and find what a full reading finds."""
    rng = np.random.default_rng(4)
    n, terms = 20000, 5
    doc = np.concatenate([np.sort(rng.choice(n, 8000, replace=False)) for _ in range(terms)])
    term = np.repeat(np.arange(terms), 8000)
    impact = (rng.pareto(1.5, len(doc)) * 1000).astype(np.int64) + 1
    shard = ranked_search.Shard(rng.permutation(n), doc, term, impact, terms)
    times = np.array([5, 1, 3, 2, 4])
    docs, scores = shard.search(np.arange(terms), times, 10)
    full = np.zeros(n, dtype=np.int64)
    np.add.at(full, doc, impact * times[term])
    best = np.lexsort((shard.ids, -full))[:10]
    assert docs.tolist() == best.tolist() and scores.tolist() == full[best].tolist()
    assert (shard.seen == 1).mean() < 0.5


def audit_sql(got, docs, labels):
    against_sql(got, filter_audit.ORACLE_SQL, documents=docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}),
                labels=labels.toPandas().astype({"doc_id": "Int64", "quality": "Int64", "toxic": "Int64"}))


def test_filter_audit(spark, odd_docs, no_docs):
    rng = random.Random(8)
    texts = ["word " * 60, " ".join(f"w{k}" for k in range(70)), "SHOUT " * 80, "a b c", "", None, "x#y " * 55, "Été ÀÉ " * 40 + "Z" * 30,
             " ".join(f"{k}%" for k in range(60)), "\t\n ", " ".join(f"w{k}" for k in range(50)), " ".join(["w"] * 35 + [f"v{k}" for k in range(64)])]
    rows = [(i, rng.choice(texts) if i % 3 else texts[1], rng.choice(["web", "web", "book", "", None]), "t") for i in range(400)]
    rows += [(5, rows[5][1], "web", "t"), (None, texts[1], "web", "t"), (None, texts[1], "book", "t"), (900, "alone " * 3, "one", "t")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, failed string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2, int(i % 7 == 0)) for i in range(0, 420, 2)] + [(4, None, 1), (4, 1, None), (None, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(docs, labels)
    audit_sql(got, docs, labels)
    parts = got.groupBy("part", "filter_order").agg(F.sum("removed").alias("r"), F.min("kept").alias("k")).collect()
    number = {r["source"]: r["n"] for r in docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n")).collect()}
    assert len(parts) == 120 * len(number) and all(r["r"] + r["k"] == number[r["part"]] for r in parts)
    odd = odd_docs.withColumn("source", F.col("kind"))
    audit_sql(filter_audit.audit(odd, labels), odd, labels)
    assert filter_audit.audit(no_docs.withColumn("source", F.lit("a")), labels).count() == 0
    audit_sql(filter_audit.audit(docs, labels.limit(0)), docs, labels.limit(0))


def test_matrix_and_dictionary(spark, odd_docs):
    words = re.compile("[^\x20\x09-\x0D]+")
    want = bag((r["doc_id"], tuple(sorted(np.unique(words.findall(r["text"] or ""), return_counts=True)[1].tolist())))
               for r in odd_docs.collect())
    known = {r["code"]: (bytes(r["word"]), bytes(r["last"])) for r in filter_audit.dictionary(odd_docs).collect()}
    assert all(a == b for a, b in known.values())
    assert len({a for a, _ in known.values()}) == len(known) == len({w for r in odd_docs.collect() for w in words.findall(r["text"] or "")})
    got = []
    for s in filter_audit.term_matrix(odd_docs, shard_bytes=500).collect():
        for k, doc in enumerate(s["ids"]):
            own = slice(s["indptr"][k], s["indptr"][k + 1])
            assert all(c in known for c in s["codes"][own])
            got.append((doc, tuple(sorted(s["counts"][own]))))
    assert bag(got) == want


def test_codes_follow_words_and_seed():
    data, ends = text_bytes(pa.array(["ab ba", "ba xy", "ab"]))
    first, size, row = filter_audit.word_places(data, ends)
    assert (first.tolist(), size.tolist(), row.tolist()) == ([0, 3, 5, 8, 10], [2] * 5, [0, 0, 1, 1, 2])
    codes = filter_audit.word_codes(data, first, size)
    assert codes[0] == codes[4] and codes[1] == codes[2] and len(set(codes.tolist())) == 3
    assert set(codes.tolist()).isdisjoint(filter_audit.word_codes(data, first, size, 1).tolist())
