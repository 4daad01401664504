"""Registered queries, their SQL, and the pipeline against brute force."""
import hashlib
import os
import random
import subprocess
import sys

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from kestrel.llm import queries
from tests.conftest import ROOT, SF_SMALL
from tests.llm.test_filters import bag, brute_matches
from tests.llm.test_near_dedup import brute as brute_groups
from tests.llm.test_suffix_dedup import brute as brute_repeats


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(names)


def test_entry_without_the_package():
    code = ("import sys; sys.modules['kestrel.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e\n"
            "q = e.queries(); assert q and 'pipeline' not in q and not any(x.startswith('op1_') for x in q)\n"
            "assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    got = entry.queries()[name](spark, SF_SMALL)
    assert sorted(cols) == sorted(got.columns)
    assert bag(got.select(*cols).collect()) == bag(cur.fetchall())


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with planted cases, labels and a benchmark, written as tables."""
    rng = random.Random(12)
    vocab = [f"{a}{b}" for a in ("sto", "ri", "la", "och", "ti", "fe") for b in ("ne", "ver", "mp", "re", "rn", "ll", "é")]
    vocab = [f"{w}{k}" for w in vocab for k in range(9)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    insults = ["grobnix", "fiezel", "ungustl"]
    items = [(k, " ".join(text(18 + k))) for k in range(6)]
    passage = " ".join(text(70))
    rows, labels, toxic = [], [], set()
    for i in range(400):
        words = text(rng.randrange(30, 200))
        if i % 5 == 0:
            toxic.add(i)
            insult = rng.choice(insults)
            for _ in range(3):
                words.insert(rng.randrange(len(words)), insult)
        elif i % 17 == 1:
            words[10:10] = items[i % 6][1].split()
        elif i % 13 == 1:
            words[5:5] = passage.split()
        rows.append([i, " ".join(words)])
        if i % 4:
            labels.append((i, i % 2, int(i in toxic)))
    for i in (7, 8, 9, 11):
        rows.append([1000 + i, rows[i][1]])  # exact copies
        near = rows[i][1].split()
        near[len(near) // 2] = "zzz"
        rows.append([500 + i, " ".join(near)])
    rows += [[2000, ""], [2001, None], [2002, "a b c"], [2003, rows[3][1]], [2003, rows[3][1]]]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in rows],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint") \
        .repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, [tuple(r) for r in rows], toxic, items


def test_pipeline_stage_by_stage(spark, corpus):
    path, rows, toxic, items = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    now = list(rows)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, path)
        got = docs.collect()
        if k == 0:
            now = [r for r in now if r[0] not in toxic]
        elif k == 1:
            comp = {(i, n): c for i, n, c in brute_groups(now)}
            keep = {i for (i, _), c in comp.items() if i == c}
            now = [r for r in dict.fromkeys(now) if r[0] in keep]
        elif k == 2:
            cover = brute_repeats([(i, (t or "").encode()) for i, t in now])
            after = []
            for i, t in now:
                b = (t or "").encode()
                c = cover[i, b]
                kept = bytes(x for x, m in zip(b, c, strict=True) if not m).decode("utf-8", "ignore")
                if not any(c) or kept:
                    after.append((i, kept if t is not None else None))
            now = after
        elif k == 3:
            dirty = {d for d, _ in brute_matches(now, items)}
            now = [r for r in now if r[0] not in dirty]
        if k < 4:
            assert docs.columns == columns
            assert sorted((r["doc_id"], r["text"] or "") for r in got) == sorted((i, t or "") for i, t in now)
            assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)
            out = f"{path}/stage{k}"
            docs.write.parquet(out)
            docs = spark.read.parquet(out)
    want = []
    for i, t in now:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(tuple(r)[:4] for r in got) == sorted(want)
    assert sorted(tuple(r)[:4] for r in corpus_pipeline.run(spark, path).collect()) == sorted(want)


def test_pipeline_on_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id bigint, text string, lang string, source string, n_chars bigint"),
                         ("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], schema).write.parquet(os.path.join(tmp_path, f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
