"""Stages of the pipeline on rows without ids and on columns named like the operators' own."""
import random

from pyspark.sql import functions as F

import corpus_pipeline
from kestrel.llm import near_dedup, suffix_dedup


def test_repeats_are_dropped_among_rows_with_an_id_only(spark):
    """Two equal rows without an id stay beside a repeated id."""
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(None, text, "a"), (None, text, "b"), (None, None, "c"), (None, None, "d"), (1, "x", "e"), (1, "x", "f"), (2, "y", "g"), (2, "z", "h")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, row0 string").repartition(3)
    kept = near_dedup.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["row0"] for r in kept.where("doc_id IS NULL").collect()) == ["a", "b", "c", "d"]
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id IS NOT NULL").collect()) == [(1, "x"), (2, "y"), (2, "z")]


def test_pipeline_with_clashing_columns(spark, tmp_path):
    """Columns called removed, removed_ranges, kept, severity: they come through as they are."""
    rng = random.Random(3)
    text = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    passage = text(60)
    rows = [(i, text(40) + (" " + passage if i % 4 == 0 else ""), i % 7, [i], "k", 0.5) for i in range(24)]
    rows += [(None, rows[1][1], 5, None, None, None)] * 2 + [(3, rows[3][1], 3, [3], "k", 0.5), (40, None, 1, None, None, None)]
    docs = spark.createDataFrame([(r[0], r[1], "en", "s", None if r[1] is None else len(r[1]), *r[2:]) for r in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                 "removed int, removed_ranges array<bigint>, kept string, severity double")
    for name, frame in (("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], frame).write.parquet(f"{tmp_path}/{name}.parquet")
    assert suffix_dedup.remove_repeats(docs).columns == [*docs.columns, "removed_ranges_0"]
    now = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        now.write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
    got = {(r["doc_id"], r["removed"]) for r in now.collect()}
    assert {(i, i % 7) for i in range(24)} <= got and (40, 1) in got
    cut = now.where((F.col("doc_id") % 4 == 0) & (F.col("doc_id") > 0) & (F.col("doc_id") < 24)).collect()
    assert len(cut) == 5 and all(r["n_chars"] == len(r["text"]) < 400 for r in cut)
    assert corpus_pipeline.STAGES[4][1](spark, now, str(tmp_path)).count() == now.count()


def test_batches_are_bounded_in_bytes(spark):
    """Few long texts make a batch, not ten thousand."""
    import pyarrow as pa

    from kestrel.llm import common

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    df = spark.range(60).selectExpr("id AS doc_id", "repeat('long text ', 100000) AS text").coalesce(1)
    got = [r["n"] for r in common.map_arrow(df, sizes, "n bigint").collect()]
    assert sum(got) >= 60 * 1_000_000 and max(got) < 2 * common.BATCH_BYTES
