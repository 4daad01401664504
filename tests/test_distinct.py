"""Mergeable exact distinct counts."""
import random

from pyspark.sql import functions as F

from kestrel.operators import dense_ids, distinct_bitmaps, merged_counts


def rows(spark):
    rng = random.Random(1)
    data = [(rng.randrange(40), rng.choice("ab"), None if rng.random() < 0.1 else rng.choice([rng.randrange(300), 10 ** 12 + rng.randrange(50), -rng.randrange(9)]))
            for _ in range(4000)]
    data += [(7, "a", 5)] * 3000 + [(99, "b", None), (None, "a", 1)]  # a hot group, one without ids, one without a key
    return spark.createDataFrame(data, "day int, kind string, id bigint").repartition(5)


def test_merged_counts_equal_count_distinct(spark):
    df = rows(spark)
    daily = distinct_bitmaps(df, ["day", "kind"], "id")
    week = F.floor(F.col("day") / 7).alias("week")
    got = merged_counts(daily, [week], {"n": None, "n_a": F.col("kind") == "a", "n_none": F.col("kind") == "z"})
    want = df.where("id IS NOT NULL").groupBy(week).agg(F.count_distinct("id").alias("n"), F.count_distinct(F.when(F.col("kind") == "a", F.col("id"))).alias("n_a"),
                                 F.lit(0).cast("bigint").alias("n_none"))
    assert got.columns == ["week", "n", "n_a", "n_none"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    whole = merged_counts(daily, [F.lit(1).alias("all")], {"n": None}).first()["n"]
    assert whole == df.agg(F.count_distinct("id")).first()[0]
    assert merged_counts(distinct_bitmaps(df.limit(0), ["day"], "id"), ["day"], {"n": None}).count() == 0


def test_no_row_is_sent_twice(spark):
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        daily = distinct_bitmaps(rows(spark), ["day", "kind"], "id")
        plan = merged_counts(daily, ["day"], {"n": None, "n_a": F.col("kind") == "a"})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)
    assert "Expand" not in plan and "partial_bitmap_construct_agg" in plan


def test_dense_ids(spark):
    words = ["pear", "fig", None, "kiwi", "apple", "fig", "pear", "é"] * 30
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(6)
    got = {r["w"]: r["id"] for r in dense_ids(df, "w").collect()}
    assert got == {w: k for k, w in enumerate(sorted(set(filter(None, words))), 1)}
    numbered = df.join(dense_ids(df, "w"), "w", "left")
    assert merged_counts(distinct_bitmaps(numbered, ["w"], "id"), [F.lit(1).alias("all")], {"n": None}).first()["n"] == 5
    assert dense_ids(df.limit(0), "w").count() == 0


def test_bitmaps_of_far_apart_ids_take_a_few_bytes_each(spark):
    """One id in each of 2,000 pieces: lists of places, not 4 KB each; a full piece is bits."""
    far = spark.range(2000).selectExpr("'far' AS k", "id * 40000 + 5 AS id")
    full = spark.range(1, 30001).selectExpr("'full' AS k", "id")
    daily = distinct_bitmaps(far.union(full), ["k"], "id")
    size = F.coalesce(F.size("__ids.ids") * 4, F.length("__ids.bits"))
    got = {r["k"]: (r["n"], r["size"]) for r in daily.groupBy("k").agg(F.count("*").alias("n"), F.sum(size).alias("size")).collect()}
    assert got == {"far": (2000, 8000), "full": (1, 4096)}
    counts = {r["k"]: r["n"] for r in merged_counts(daily, ["k"], {"n": None}).collect()}
    assert counts == {"far": 2000, "full": 30000}
    assert merged_counts(daily, [F.lit(1).alias("all")], {"n": None}).first()["n"] == 31999  # 5 is in both


def test_no_bitmap_is_sorted_or_sent(spark):
    """Rows meet as places; bits are built after the last sort and shuffle of the daily bitmaps."""
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = distinct_bitmaps(rows(spark), ["day", "kind"], "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)
    lines = plan.splitlines()
    last = max(i for i, x in enumerate(lines) if "bitmap_construct_agg" in x)
    assert not any("Exchange" in x or "Sort [" in x for x in lines[:last + 1])
