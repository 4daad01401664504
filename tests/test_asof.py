"""As-of scan against brute force: many instants a key, ties, hot keys cut into cells."""
import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kestrel.operators import asof_both, asof_scan, time_splits

BASE = dt.datetime(2024, 1, 30)


def brute(left, right, strict=True):
    out = []
    for i, k, t in left:
        own = [r for r in right if r[0] == k and k is not None and t is not None and r[1] is not None]
        before = [r for r in own if (r[1] < t if strict else r[1] <= t)]
        after = [r for r in own if not (r[1] < t if strict else r[1] <= t)]
        b = max(before, key=lambda r: (r[1], r[2])) if before else None
        a = min(after, key=lambda r: (r[1], r[2])) if after else None
        out.append((i, b and b[3], a and a[4], b is not None, a is not None))
    return sorted(out)


def scan(spark, left, right, **kw):
    lf = spark.createDataFrame(left, "row int, k int, at timestamp_ntz").repartition(3)
    rf = spark.createDataFrame(right, "k int, ts timestamp_ntz, id int, new string, old string").repartition(3)
    out = asof_scan(lf, rf, "k", "at", "ts", "id", "new", "old", "b", "a", **kw)
    assert out.columns == ["row", "k", "at", "b", "a", "has_before", "has_after"]
    return sorted((r["row"], r["b"], r["a"], r["has_before"], r["has_after"]) for r in out.collect())


instants = st.one_of(st.none(), st.integers(0, 40))
keys = st.one_of(st.none(), st.integers(0, 2))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(st.tuples(keys, instants), max_size=12),
       right=st.lists(st.tuples(keys, instants, st.one_of(st.none(), st.sampled_from("xyz"))), max_size=25), strict=st.booleans())
def test_scan_equals_brute_force(spark, left, right, strict):
    at = lambda h: None if h is None else BASE + dt.timedelta(hours=6 * h)
    lrows = [(i, k, at(h)) for i, (k, h) in enumerate(left)]
    rrows = [(k, at(h), i, v, None if v is None else v * 2) for i, (k, h, v) in enumerate(right)]
    if lrows and rrows:
        assert scan(spark, lrows, rrows, strict_before=strict) == brute(lrows, rrows, strict)


@pytest.fixture(scope="module")
def hot():
    """Key 0 holds a third of the log, all within two days; every key has many instants."""
    rng = random.Random(2)
    at = lambda k: BASE + dt.timedelta(seconds=rng.randrange(2 * 86400) if k == 0 else rng.randrange(90 * 86400))
    right = [(k, at(k), i, f"n{i}", f"o{i}") for i in range(3000) for k in [0 if i % 3 == 0 else rng.randrange(1, 40)]]
    right += [(r[0], r[1], 9000 + i, "tie", "tied") for i, r in enumerate(right[:200])]
    left = [(i, k, right[rng.randrange(3000)][1] if i % 4 == 0 else at(k)) for i in range(400) for k in [rng.randrange(0, 41)]]
    return left, right


def test_hot_key_is_cut_into_cells(spark, hot):
    left, right = hot
    log = spark.createDataFrame(right, "k int, ts timestamp_ntz, id int, new string, old string")
    splits = time_splits(log, "ts", 16)
    assert len(splits) == 15
    want = brute(left, right)
    assert scan(spark, left, right, splits=splits) == want
    assert scan(spark, left, right) == want and scan(spark, left, right, splits=[]) == want
    # By these splits no cell holds more than an eighth of the log, though one key has a third.
    from kestrel.operators.asof import _cell
    most = log.groupBy("k", _cell(F.col("ts"), splits).alias("cell")).count().agg(F.max("count")).first()[0]
    assert most < len(right) / 8 < log.where("k = 0").count()


def test_log_is_reduced_before_it_meets_the_left(spark, hot):
    """The raw log is sent once, by (key, instant); nothing is joined."""
    left, right = hot
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lf = spark.createDataFrame(left, "row int, k int, at timestamp_ntz")
        rf = spark.createDataFrame(right, "k int, ts timestamp_ntz, id int, new string, old string")
        plan = asof_scan(lf, rf, "k", "at", "ts", "id", "new", "old")._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "partial_max_by" in plan
        month = lambda ts: F.year(ts) * 12 + F.month(ts)
        one = lf.groupBy("k").agg(F.min("at").alias("at"))
        grid = asof_both(one, rf, "k", "at", "ts", "id", "new", "old", grid=month)._jdf.queryExecution().executedPlan().toString()
        below = grid[grid.index("SortMergeJoin"):] if "SortMergeJoin" in grid else grid
        assert "partial_max_by" in below
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)


def test_grid_equals_the_plain_lookup(spark, hot):
    _, right = hot
    rf = spark.createDataFrame(right, "k int, ts timestamp_ntz, id int, new string, old string")
    lf = spark.createDataFrame([(k, dt.datetime(2024, 2 + k % 3, 1)) for k in range(45)], "k int, at timestamp_ntz")
    month = lambda ts: F.year(ts) * 12 + F.month(ts)
    rows = [sorted(tuple(r) for r in asof_both(lf, rf, "k", "at", "ts", "id", "new", "old", grid=g).collect()) for g in (None, month)]
    assert rows[0] == rows[1] and len(rows[0]) > 30
    with pytest.raises(ValueError):
        asof_both(lf, rf, "k", "at", "ts", "id", "new", "old", strict_before=False, grid=month)
