"""Operators and column functions on tiny literal frames (edge cases the
test data does not reach: ties, NULL orderings, DST, JSON nulls, exact
rounding, hot keys)."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import Window

from kestrel.functions import (
    days_between, exact_avg, json_has_key, json_text, pct, seconds_between, utc_wall_to_eastern, within_days,
)
from kestrel.operators import (
    asof_both, first_in_group_rows, full_outer_merge, latest_by, left_join_spread_nulls,
)
from kestrel.operators.quality import Check, accepted_values, run_checks, unique, unique_combination


def T(s):
    return dt.datetime.fromisoformat(s)


def test_latest_by_keeps_null_value_and_breaks_ties_by_id(spark):
    df = spark.createDataFrame(
        [(1, T("2024-01-01 10:00"), 1, "a"), (1, T("2024-01-02 10:00"), 2, None), (1, T("2024-01-02 10:00"), 3, "c"),
         (2, T("2024-01-01 00:00"), 4, "x")],
        "k int, ts timestamp_ntz, id int, v string")
    got = {r.k: (r.id, r.v) for r in latest_by(df, ["k"], ["ts", "id"], ["id", "v"]).collect()}
    assert got == {1: (3, "c"), 2: (4, "x")}
    # a NULL value at the latest row is returned, not skipped
    df2 = df.where("id <> 3")
    got2 = {r.k: r.v for r in latest_by(df2, ["k"], ["ts", "id"], ["v"]).collect()}
    assert got2[1] is None


def test_latest_by_null_time_first_like_desc_nulls_first(spark):
    df = spark.createDataFrame([(1, None, 1), (1, T("2024-01-01 00:00"), 2)], "k int, ts timestamp_ntz, id int")
    r = latest_by(df, ["k"], [F.col("ts").isNull(), "ts", "id"], ["id"]).first()
    assert r.id == 1


def test_latest_by_hot_key(spark):
    rows = [(0, i, i) for i in range(3000)] + [(k, k, k) for k in range(1, 6001)]
    df = spark.createDataFrame(rows, "k int, o int, v int").repartition(8)
    got = {r.k: r.v for r in latest_by(df, ["k"], ["o"], ["v"]).collect()}
    assert got[0] == 2999 and len(got) == 6001


def test_asof_both_directions_and_deletions(spark):
    left = spark.createDataFrame([(1, T("2024-02-01 05:05"))], "k int, snap timestamp_ntz")
    right = spark.createDataFrame(
        [(1, T("2024-01-20 00:00"), 10, "A", "B"),
         (1, T("2024-01-31 00:00"), 11, "B", None),        # logged deletion: NULL new value
         (1, T("2024-02-01 05:05"), 12, "BOUND", "X"),     # exactly at the snapshot counts as after
         (1, T("2024-02-03 00:00"), 13, "X", "Y"),
         (2, T("2024-01-01 00:00"), 20, "Q", "R")],
        "k int, ts timestamp_ntz, id int, old string, new string")
    r = asof_both(left, right, "k", "snap", "ts", "id", before_value="new", after_value="old",
                  before_alias="b", after_alias="a").collect()
    assert len(r) == 1
    assert r[0].b is None and r[0].a == "BOUND"
    # the reference's resolution: coalesce(last before, first after, current)
    assert (r[0].b or r[0].a or "current") == "BOUND"


def test_left_join_spread_nulls_equals_plain_left_join(spark):
    left = spark.createDataFrame([(i, None if i % 2 else i % 5) for i in range(200)], "id int, k int")
    right = spark.createDataFrame([(k, f"n{k}") for k in range(3)], "rk int, name string")
    a = sorted(tuple(r) for r in left_join_spread_nulls(left, right, "k", "rk", ["id"]).collect())
    b = sorted(tuple(r) for r in left.join(right, left.k == right.rk, "left").collect())
    assert a == b


def test_full_outer_merge_keeps_null_keys_apart(spark):
    a = spark.createDataFrame([(None, 1), (1, 2)], "k int, x int")
    b = spark.createDataFrame([(None, 3), (1, 4)], "k int, y int")
    rows = sorted(full_outer_merge([a, b], ["k"]).collect(), key=lambda r: (r.k is not None, r.k, r.x or 0))
    assert [tuple(r) for r in rows] == [(None, None, 3), (None, 1, None), (1, 2, 4)]


def test_first_in_group_rows_matches_row_number(spark):
    rows = [(i % 7, dt.date(2024, 1 + i % 3, 1 + i % 20), i) for i in range(300)]
    df = spark.createDataFrame(rows, "c int, d date, id int")
    ours = sorted(tuple(r) for r in first_in_group_rows(df, ["c", F.trunc("d", "month")], ["d", "id"],
                                                        ["c", "d", "id"]).collect())
    w = Window.partitionBy("c", F.trunc("d", "month")).orderBy("d", "id")
    ref = sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(w)).where("rn = 1")
                 .select("c", "d", "id").collect())
    assert ours == ref


def test_pct_is_exact_half_up(spark):
    df = spark.createDataFrame([(1, 8), (1, 800), (3, 20000), (1, 0), (2, 3)], "n long, d long")
    got = [r.p for r in df.select(pct("n", "d").alias("p")).collect()]
    assert got == [Decimal("12.50"), Decimal("0.13"), Decimal("0.02"), None, Decimal("66.67")]


def test_exact_avg_half_up(spark):
    df = spark.createDataFrame([(Decimal("1.0001"),)] + [(Decimal("0"),)] * 7, "x decimal(18,4)")
    assert df.agg(exact_avg("x").alias("a")).first().a == Decimal("0.125013")


def test_seconds_between_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(T("2024-01-01 00:00:01.5"), T("2024-01-01 00:00:00")),
                                (T("2024-01-01 00:00:00"), T("2024-01-01 00:00:01.5"))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert [r.s for r in df.select(seconds_between("a", "b").alias("s")).collect()] == [2, -2]


def test_utc_to_eastern_across_clock_changes(spark):
    df = spark.createDataFrame([(T("2024-03-10 06:30"),), (T("2024-03-10 07:30"),), (T("2024-11-03 05:30"),),
                                (T("2024-11-03 06:30"),)], "ts timestamp_ntz")
    got = [r.e for r in df.select(utc_wall_to_eastern("ts").alias("e")).collect()]
    assert got == [T("2024-03-10 01:30"), T("2024-03-10 03:30"), T("2024-11-03 01:30"), T("2024-11-03 01:30")]


def test_json_key_exists_even_for_json_null(spark):
    df = spark.createDataFrame([('{"duns":null}',), ('{"awlCampaign":" X "}',), (None,)], "j string")
    r = df.select(json_has_key("j", "duns").alias("h"), json_text("j", "duns").alias("t"),
                  json_text("j", "awlCampaign").alias("c")).collect()
    assert (r[0].h, r[0].t) == (True, None)
    assert (r[1].h, r[1].c) == (False, " X ")
    assert r[2].h is None


def test_within_days_has_no_lower_bound_and_null_is_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 9)), (dt.date(2024, 1, 9), dt.date(2024, 1, 1)),
                                (None, dt.date(2024, 1, 1))], "m date, b date")
    got = [r.f for r in df.select(within_days(days_between("m", "b"), 7).alias("f")).collect()]
    assert got == [1, 0, 0]


def test_three_valued_not_and(spark):
    df = spark.createDataFrame([(None, True), (None, False), (True, True), (False, True)], "flag boolean, late boolean")
    kept = [tuple(r) for r in df.where(~(F.col("flag") & F.col("late"))).collect()]
    assert kept == [(None, False), (False, True)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, None, "x"), (None, None, "bad"), (None, None, None)],
                               "id int, name string, kind string")
    assert unique(df, "id").count() == 1
    assert unique(df, "name").count() == 0
    assert unique_combination(df, ["name"]).count() == 1       # NULLs group together
    assert accepted_values(df, "kind", ["x"]).count() == 1      # NULL passes
    checks = [Check("t", "not_null", ("id",)), Check("t", "unique", ("id",)),
              Check("t", "accepted_values", ("kind",), ("x",)), Check("t", "not_null", ("name",), severity="warn")]
    got = {r.test: (r.failures, r.status) for r in run_checks({"t": df}, checks).collect()}
    assert got == {"not_null__t__id": (2, "fail"), "unique__t__id": (1, "fail"),
                   "accepted_values__t__kind": (1, "fail"), "not_null__t__name": (3, "warn")}
