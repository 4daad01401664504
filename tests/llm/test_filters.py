"""Decontamination, toxicity, URL filter, licence scan, fixity audit, neighbours."""
import collections
import gzip
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import ann, decontamination, license_scan, toxicity, url_filter, warc_audit
from tests.conftest import SF_SMALL

LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def bag(rows):
    return collections.Counter(tuple(None if v is None else v for v in r) for r in rows)


def against_sql(got, sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(got.columns)
    assert bag(got.select(*cols).collect()) == bag(cur.fetchall())


# ---- decontamination

ALNUM = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def brute_matches(docs, items):
    def shingles(t):
        w = ALNUM.findall((t or "").translate(LOWER))
        return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]

    best = {}
    for d, t in docs:
        s = shingles(t)
        for i, u in items:
            ci = collections.Counter(shingles(u))
            m = sum(ci.values())
            z = min(m, len(s))
            if i is None or not m or not z:
                continue
            for a in range(len(s) - z + 1):
                both = sum((collections.Counter(s[a:a + z]) & ci).values())
                alike = both / (m + z - both)
                if alike >= 0.75 and alike > best.get((d, i), (0,))[0]:
                    best[d, i] = (alike, a, z + 4)
    return best


def test_decontamination(spark, odd_docs, no_docs):
    rng = random.Random(6)
    vocab = [f"word{k}" for k in range(300)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, text(n)) for k, n in enumerate([5, 6, 12, 15, 30, 31, 59, 200])] + [(20, ["x"] * 20), (21, ["one", "two"])]
    docs = []
    for k, (_, w) in enumerate(items):
        docs.append((100 + k, " ".join(text(40) + w + text(30))))
        changed = list(w)
        changed[len(w) // 2] = "other"
        docs.append((200 + k, " ".join(text(40) + changed + text(300))))
        docs.append((300 + k, "; ".join(x.upper() for x in w) + "!"))
        docs.append((400 + k, " ".join(w[: max(1, len(w) * 9 // 10)])))
        docs.append((500 + k, " ".join(w[1:] + w[:1] + w)))
    docs += [(600, None), (601, ""), (602, "x " * 400), (603, " ".join(text(3000)))]
    rows = [(i, " ".join(w)) for i, w in items] + [(30, None), (31, ""), (None, items[3][1][0])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame(rows, "item_id bigint, text string")
    want = brute_matches(docs, [r for r in rows if r[0] is not None])
    for portion in (32 << 20, 600):  # one portion, and several
        got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["first_word"], r["n_words"])
               for r in decontamination.contaminated(df, bench, portion_bytes=portion).collect()}
        assert got == want
    clean = decontamination.keep_uncontaminated(df, bench)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(d for d, _ in docs if d not in {k for k, _ in want})
    assert decontamination.contaminated(no_docs, bench).count() == 0
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.contaminated(odd_docs, empty).count() == 0
    kept = decontamination.keep_uncontaminated(odd_docs, empty)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(8)
    items = [(k, " ".join(f"t{x}" for x in rng.integers(0, 60, 12)).encode()) for k in range(300)]
    index = decontamination.Index(items, 0.75)
    for _ in range(200):
        mark = index.by_words[12][rng.integers(300)].print.copy()
        for bit in rng.choice(64, rng.integers(0, 30), replace=False):
            mark[bit // 8] ^= 1 << (bit % 8)
        near = {i.item_id for i in index.by_words[12]
                if int(np.unpackbits(i.print ^ mark).sum()) <= decontamination.RADIUS}
        assert {i.item_id for i in index.within(12, mark)} == near


def test_index_selects():
    """Of 10,000 equally long items fewer than a tenth are compared with a window, and none within the radius is lost."""
    rng = np.random.default_rng(9)
    items = [(k, " ".join(f"t{x}" for x in rng.integers(0, 5000, 20)).encode()) for k in range(10_000)]
    index = decontamination.Index(items, 0.75)
    prints = np.array([i.print for i in index.by_words[20]])
    share = []
    for _ in range(50):
        mark = prints[rng.integers(10_000)].copy()
        for bit in rng.choice(256, rng.integers(0, 75), replace=False):
            mark[bit // 8] ^= 1 << (bit % 8)
        found = index.candidates(20, mark)
        share.append(len(found) / 10_000)
        near = np.flatnonzero(np.unpackbits(prints ^ mark, axis=1).sum(axis=1) <= decontamination.RADIUS)
        assert set(near.tolist()) <= set(found.tolist())
    assert max(share) < 0.1 and np.mean(share) < 0.03


def test_decontamination_of_odd_rows(spark, odd_docs):
    """Null ids and texts, clashing columns, very long texts, and a benchmark in several portions."""
    rows = odd_docs.collect()
    text_of = {r["doc_id"]: r["text"] for r in rows if r["kind"] == "kept"}
    long = text_of[11].split()
    items = [(k, " ".join(long[1000 * k:1000 * k + 12 + k])) for k in range(8)] + [
        (20, " ".join(text_of[0].split()[30:60])), (21, "a b c"), (22, ""), (None, text_of[0])]
    bench = spark.createDataFrame([*items, (23, None)], "item_id bigint, text string")
    want = brute_matches(enumerate(r["text"] for r in rows), [i for i in items if i[0] is not None])  # by row
    assert {item for _, item in want} == {*range(8), 20}
    for portion in (32 << 20, 400):
        got = decontamination.contaminated(odd_docs, bench, portion_bytes=portion).collect()
        assert bag((r["doc_id"], r["item_id"]) for r in got) == bag((rows[k]["doc_id"], item) for k, item in want)
        kept = decontamination.keep_uncontaminated(odd_docs, bench, portion_bytes=portion)
        assert kept.columns == odd_docs.columns
        assert bag(kept.collect()) == bag(r for k, r in enumerate(rows) if k not in {d for d, _ in want})


# ---- toxicity


def test_toxicity_held_out(spark):
    rng = random.Random(7)
    plain = [f"w{k}a" for k in range(400)]
    bad = ["grobnix", "fiezel", "ungustl", "schlimmo"]
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        words = [rng.choice(plain) for _ in range(rng.choice([8, 40, 900]))]
        if toxic:
            stem = rng.choice(bad)
            for _ in range(2 + len(words) // 60):
                words.insert(rng.randrange(len(words)), stem + rng.choice(["", "e", "en", "."]))
        rows.append((i, " ".join(words), "x"))
        if i % 3:
            labels.append((i, rng.randrange(2), 0))
        elif i < 600:
            labels.append((i, None if i % 9 == 0 else rng.randrange(2), int(toxic)))
    labels += [(5, 1, None), (None, 1, 1), (123456, 1, 1), (1, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, marks)
    assert len(model.thresholds) == 2 and model.thresholds == sorted(model.thresholds)
    assert min(model.weights.values()) > 0
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(900) if i % 6 == 0 and i >= 600]
    assert sum(got[i]["toxic"] for i in held) >= 0.95 * len(held)
    assert sum(got[i]["toxic"] for i in range(900) if i % 6) <= 3
    assert all(0 <= r["severity"] <= 2 for r in got.values())
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in got.items() if not r["toxic"])


def test_toxicity_without_labels(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one = spark.createDataFrame([(0, 1, 0), (3, 0, 0)], "doc_id bigint, quality int, toxic int")
    for labels in (none, one):
        model = toxicity.train(odd_docs, labels)
        rows = toxicity.score(odd_docs, model).collect()
        assert len(rows) == odd_docs.count()
        assert all(r["severity"] == 0 and not r["toxic"] for r in rows)
        assert toxicity.keep_clean(odd_docs, model).count() == odd_docs.count()
    both = spark.createDataFrame([(0, 1, 0), (9, 0, 1), (3, 1, 1), (11, 0, 0)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(odd_docs, both)
    assert toxicity.score(odd_docs, model).count() == odd_docs.count()
    assert toxicity.score(no_docs, model).count() == 0


@pytest.mark.parametrize("toxic", [0, 1])
def test_toxicity_with_an_oversized_document_first(spark, toxic):
    """A labelled document larger than its class's share of the sample comes first in hash order."""
    rng = random.Random(11)
    text = lambda bad, n: " ".join([rng.choice(["ri", "la", "och"]) + str(rng.randrange(90)) for _ in range(n)] + ["grobnix"] * bad)
    order = [r[0] for r in spark.range(300).orderBy(F.xxhash64("id"), "id").collect()]
    marks = [(i, 1, toxic if i == order[0] else int(i % 5 == 0)) for i in range(300)]
    docs = spark.createDataFrame([(i, text(t, 30 if i != order[0] else 9000)) for i, _, t in marks], "doc_id bigint, text string")
    model = toxicity.train(docs, spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int"), sample_bytes=60_000)
    got = {r["doc_id"]: r["toxic"] for r in toxicity.score(docs, model).collect()}
    assert got == {i: bool(t) for i, _, t in marks}


def test_toxicity_with_and_without_the_cap_of_a_class(spark):
    """Clean documents hold a word of toxic ones now and then; eleven of twelve are clean."""
    rng = random.Random(13)
    rows, marks = [], []
    for i in range(2400):
        toxic = int(i % 12 == 0)
        words = [rng.choice(["ri", "la", "och"]) + str(rng.randrange(90)) for _ in range(25)]
        words += ["grobnix"] * (rng.random() < (0.7 if toxic else 0.05))
        rows.append((i, " ".join(words)))
        marks.append((i, 1, toxic))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    asked = spark.createDataFrame([(0, "la1 la2 moss"), (1, "la1 grobnix moss"), (2, "")], "doc_id bigint, text string")
    whole, capped = ({r["doc_id"]: r for r in toxicity.score(asked, toxicity.train(docs, labels, per_class=n)).collect()}
                     for n in (4000, 200))
    for k in whole:
        assert abs(whole[k]["severity"] - capped[k]["severity"]) < 0.15
        assert whole[k]["toxic"] == capped[k]["toxic"]


def test_toxicity_of_clean_documents_with_many_words(spark):
    """Words that the model has never seen add nothing, however many there are."""
    rng = random.Random(17)
    bad = ["".join(rng.choice("bcdfghklmnprstvz") for _ in range(9)) for _ in range(60)]
    rows = [(i, " ".join([f"ri{rng.randrange(90)}" for _ in range(20)] + ([rng.choice(bad) for _ in range(6)] if i % 2 else [])))
            for i in range(800)]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id bigint, text string"),
                           spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id bigint, quality int, toxic int"))
    many = ["".join(rng.choice("0123456789") for _ in range(9)) for _ in range(60_000)]
    asked = spark.createDataFrame([(0, "moss"), (1, " ".join(many[:20_000])), (2, " ".join(many)), (3, " ".join([*many, *bad[:6]]))],
                                  "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in toxicity.score(asked, model).collect()}
    assert got[1]["severity"] == got[2]["severity"] == got[0]["severity"] and not got[2]["toxic"]
    assert got[3]["toxic"]


# ---- URL filter

URLS = [None, "", "no scheme", "http://", "http://a.com", "http://a.com/", "HTTP://A.Com/X?y=/z#w", "http://com/x",
        "https://example.com/en/1", "https://www.example.com/en/1", "https://x.www.example.com/en/2/",
        "https://notexample.com/en/3", "http://b.net/es/1", "http://b.net/fr/1#t", "http://b.net/frx", "http://net/es/",
        "http://b.net?/es/", "ftp://b.org/a://c.com/", "://q.net/es/ü", "http://ü.de/straße/1", "http://a.com:80/x",
        "http://b.org/" + "a" * 5000, "x://y\n.com/z\n/w"]


def test_url_filter(spark):
    rng = random.Random(1)
    hosts = ["a.com", "b.net", "www.example.com", "example.com", "c.org", "d.example.net"]
    rows = [(k, u, "h") for k, u in enumerate(URLS * 2)] + [
        (100 + k, f"http://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randrange(1000)}", None)
        for k in range(200)] + [(None, "http://c.org/en/1", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string").repartition(3)
    got = url_filter.judge(pages, url_filter.PAGE_RULES).drop("score")
    against_sql(got, url_filter.ORACLE_SQL, pages=pages.toPandas().astype({"page_id": "Int64"}))
    by = {r["page_id"]: r for r in got.collect()}
    assert [by[k]["rule"] for k in range(len(URLS))] == [
        None, None, None, None, None, "com/", "com/", "com/", "example.com/en/", "www.example.com/en/", "www.example.com/en/",
        "com/", "net/es/", "net/fr/", None, "net/es/", None, None, "net/es/", None, None, None, "com/"] or \
        by[22]["rule"] is None
    assert by[6]["host"] == "a.com" and by[6]["path"] == "/X"
    assert url_filter.judge(pages.limit(0), url_filter.PAGE_RULES).count() == 0
    unruled = url_filter.judge(pages, [("allow", "nowhere", "/")]).collect()
    assert all(r["verdict"] == ("allow" if r["host"] + r["path"] else "block") for r in unruled)


def test_url_model_tells_languages_apart(spark):
    """Held-out accuracy: URLs of two kinds, judged without their rule."""
    rng = random.Random(2)
    good = lambda: "".join(rng.choice(["news", "blog", "arti", "cle", "post"]) for _ in range(4))
    poor = lambda: "".join(rng.choice(["xxq", "zzk", "win", "$$", "qqz"]) for _ in range(4))
    rows = [(k, f"http://{'ok' if k % 2 else 'no'}{'.org' if k < 400 else '.test'}/{good() if k % 2 else poor()}") for k in range(800)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    got = url_filter.judge(pages, [("allow", "ok.org", "/"), ("block", "no.org", "/")]).where("rule IS NULL").collect()
    assert len(got) == 400
    assert sum((r["verdict"] == "allow") == bool(r["page_id"] % 2) for r in got) >= 390


# ---- licence scan


def test_license_scan(spark, odd_docs, no_docs):
    rng = random.Random(3)
    noise = lambda n: " ".join(rng.choice(["stone", "under", "the", "license", "mit", "cc", "public", "of"]) for _ in range(n))
    texts = ["Under the MIT License.", "under the mit license under the mit license", "CC BY-NC 4.0 cc by nc", "", None, "...",
             "the Apache License, Version 2.0; Apache-License version 2", "underthe mit license", "É cc by nc É under  the\nMIT-license",
             "This work is licensed under the GNU General Public License, version 3.",
             "this work is licensed under the gnu special public license version 3",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
             "license mozilla public terms", "All rights reserved. No part of this publication may be reproduced",
             "cc by nc " * 3000]
    for t in license_scan.TEMPLATES:
        w = t.text.split()
        texts += [noise(20) + " " + t.text + " " + noise(9), t.text.upper().replace(" ", ", "), " ".join(w[1:]),
                  " ".join(w[:4] + ["zzz"] + w[5:]), t.text + " " + t.text]
    texts += [noise(rng.randrange(40)) for _ in range(60)]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(0, texts[0], None), (None, texts[1], None), (3, "under the mit license", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, labels string").repartition(3)
    got = license_scan.scan(docs)
    against_sql(got, license_scan.oracle_sql(), documents=docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    by = {r["doc_id"]: r for r in got.collect() if r["doc_id"] not in (0, 3, None)}
    assert (by[1]["n_base"], by[1]["first_word"], by[1]["last_word"], by[1]["base_labels"]) == (2, 0, 4, "mit")
    assert by[9]["labels"] == "gpl-3" and by[9]["base_labels"] == "" and by[9]["score"] == 1.0
    assert by[10]["labels"] == "" and by[4]["n_words"] == 0 and by[4]["first_word"] is None
    assert by[14]["n_base"] == 3000
    assert license_scan.scan(odd_docs).count() == odd_docs.count()
    assert license_scan.scan(no_docs).count() == 0


def test_license_scan_of_many_notices(spark):
    """All ten notices in one file, whatever else it holds and however frequent their words are."""
    texts = {t.label: t.text for t in license_scan.TEMPLATES}
    every = " stone ".join(texts.values())
    rare = " ".join(sorted({w for t in texts.values() for w in t.split()} - {"all", "rights", "reserved", "cc", "by", "sa"}))
    rows = [(1, every), (2, every + " " + every), (3, " ".join(["grain"] * 50) + " " + " moss ".join(reversed(texts.values()))),
            (4, rare + " moss " + texts["cc-by-sa"] + " moss " + texts["proprietary"]), (5, "all rights stone reserved no part of this")]
    rows += [(100 + k, "licensed under cc by sa 4 0") for k in range(40)] + [(200, "licensed under cc reserved rights all"), (201, "moss")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    against_sql(license_scan.scan(docs), license_scan.oracle_sql(), documents=docs.toPandas())
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    for k in (1, 2, 3):
        assert got[k]["labels"] == ",".join(sorted(texts)) and got[k]["score"] == 1.0
    assert got[4]["labels"] == "cc-by-sa,proprietary" and got[4]["n_base"] == 0 and got[4]["score"] == 1.0
    assert all(got[100 + k]["labels"] == "cc-by-sa" for k in range(40))
    assert all(got[k]["labels"] == "" and got[k]["score"] == 0.0 for k in (5, 200, 201))


def test_license_scan_of_files_that_begin_within_a_notice(spark):
    rows = [(1, "Licensed under the GNU General Public License version 3"), (2, "Subject to the terms of the Mozilla Public License"),
            (3, "Licensed under a Creative Commons Attribution 4.0 International License"), (4, "public license version 3"),
            (5, "terms of the Mozilla Public License")]
    rows += [(10 + k, "stone moss " + t) for k, t in rows]
    rows += [(100 + k, "this work source code form is v 2 0 4") for k in range(40)]  # frequent words, as in a corpus
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    against_sql(license_scan.scan(docs), license_scan.oracle_sql(), documents=docs.toPandas())
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    for k, label, n, size in ((1, "gpl-3", 9, 12), (2, "mpl-2", 9, 17), (3, "cc-by", 10, 13), (4, "", 0, 1), (5, "mpl-2", 6, 17)):
        assert (got[k]["labels"], got[k]["score"]) == (label, n / size)
        assert (got[10 + k]["labels"], got[10 + k]["score"]) == (label, n / size)


# ---- fixity audit


def test_page_audit(spark):
    rows = [(k, f"http://h{k}.example.org/{k}", "<html>" + "é" * (k % 50)) for k in range(3000)]
    rows += [(7, "http://h7.example.org/7", "<html>" + "é" * 7)] * 40 + [(None, None, None)] * 5 + [(5, None, ""), (9, "", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(7)
    got = warc_audit.page_audit(pages)
    assert got.count() > 10
    against_sql(got, warc_audit.ORACLE_SQL, pages=pages.toPandas().astype({"page_id": "Int64"}))
    assert warc_audit.page_audit(pages.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 33, 1500])
def test_audit_finds_changed_missing_extra(spark, n):
    good = [(k, 10 + k, f"d{k}") for k in range(n)]
    bad = [(k, size, d) for k, size, d in good if k % 97 != 5]
    bad = [(k, size, "x" if k % 101 == 3 else d) for k, size, d in bad] + [(n + 2, 1, "new")]
    schema = "number bigint, length bigint, digest string"
    got = {r["number"]: r["kind"] for r in warc_audit.audit(spark.createDataFrame(good, schema), spark.createDataFrame(bad, schema)).collect()}
    want = {k: "missing" for k in range(n) if k % 97 == 5}
    want |= {k: "changed" for k in range(n) if k % 101 == 3 and k % 97 != 5} | {n + 2: "extra"}
    assert got == want
    assert warc_audit.audit(spark.createDataFrame(good, schema), spark.createDataFrame(good, schema)).count() == 0


def test_only_mismatching_branches_are_read(spark):
    good = [(k, 1, f"d{k}") for k in range(2000)]
    bad = [(k, 1, "x" if k in (700, 701) else d) for k, _, d in good]
    schema = "number bigint, length bigint, digest string"
    a, b = (warc_audit.tree(spark.createDataFrame(x, schema), warc_audit.height_of(2000)) for x in (good, bad))
    assert len(a) == 4 and a[-1].count() == 1
    open_ = [x.select("node", "hash").exceptAll(y.select("node", "hash")).count() for x, y in zip(a, b, strict=True)]
    assert open_ == [2, 1, 1, 1]  # one node a level leads to both
    assert sorted(r["node"] for r in warc_audit.mismatches(a, b).collect()) == [700, 701]


def test_read_records(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "x" * 10), (2, None, "é\r\n\r\n")], "page_id bigint, url string, html string")
    recs = [r[0].encode() for r in pages.select(warc_audit.record(F.col("page_id"), F.col("url"), F.col("html"))).collect()]
    plain, packed = b"".join(recs), b"".join(gzip.compress(r, mtime=0) for r in recs)
    files = spark.createDataFrame([("p", bytearray(plain)), ("z", bytearray(packed)), ("e", bytearray(b"")), ("n", None),
                                   ("t", bytearray(plain[:-7]))], "path string, content binary")
    got = sorted(map(tuple, warc_audit.read_records(files).collect()))
    assert [g[:4] for g in got if g[0] == "p"] == [("p", 0, 0, len(recs[0])), ("p", 1, len(recs[0]), len(recs[1]))]
    assert [g[4] for g in got if g[0] == "p"] == [g[4] for g in got if g[0] == "z"]
    assert [g[4] for g in got if g[0] == "t"][0] == [g[4] for g in got if g[0] == "p"][0]
    assert not [g for g in got if g[0] in "en"]


# ---- nearest neighbours


def brute_nearest(ids, x, q, k):
    cos = ann.exact_cosine(x[q], x)
    cand = [(-c, i) for c, i in zip(cos.tolist(), ids, strict=True) if i != ids[q]]
    return [(i, -c) for c, i in sorted(cand)[:k]]


def test_neighbours_recall_and_scores(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = sorted((r["vec_id"], r["embedding"]) for r in df.collect())
    ids, x = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.float64)
    for every, settings in ((50, ann.Settings()), (3, ann.Settings(per_list=8, beam=64, ratio=1.6, least_lists=16, part=20))):
        got = collections.defaultdict(list)
        for r in sorted(ann.nearest(df, every=every, settings=settings).collect(), key=lambda r: (r["query_id"], r["rank"])):
            got[r["query_id"]].append((r["vec_id"], r["score"]))
        asked = [k for k, i in enumerate(ids) if i % every == 0]
        assert set(got) == {ids[k] for k in asked}
        hits = 0
        for k in asked:
            want = brute_nearest(ids, x, k, 5)
            exact = dict(brute_nearest(ids, x, k, len(ids)))
            assert all(exact[i] == s for i, s in got[ids[k]])
            hits += len({i for i, _ in want} & {i for i, _ in got[ids[k]]})
        assert hits >= 0.9 * 5 * len(asked)


def test_neighbours_odd_rows(spark):
    rng = np.random.default_rng(3)
    same = [1.0, 2.0, -1.0]
    rows = [(k, same) for k in range(0, 400)] + [(400 + k, rng.normal(size=3).tolist()) for k in range(100)]
    rows += [(1000, None), (1050, []), (1100, [0.0, 0.0, 0.0]), (1150, [1.0, None, 2.0]), (1200, [1.0, float("nan"), 0.0]),
             (1250, [1.0, float("inf"), 0.0]), (1300, [1.0, 2.0]), (None, same), (50, same), (1350, [2.0, 4.0, -2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("x")).repartition(4)
    out = ann.nearest(df, settings=ann.Settings(part=64))
    got = collections.defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {*range(0, 500, 50), 1350}
    assert all([r for r, _, _ in v] == [1, 2, 3, 4, 5] for v in got.values())
    assert [i for _, i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for _, i, _ in got[50]] == [0, 1, 2, 3, 4]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (50, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert sorted((r["query_id"], r["vec_id"]) for r in ann.nearest(few).collect()) == [(0, 1), (0, 50), (50, 0), (50, 1)]
    assert ann.nearest(few.limit(1)).count() == 0
    assert ann.nearest(df.limit(0)).count() == 0
