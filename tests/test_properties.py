"""Property tests: the custom operators against brute force on random inputs."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kestrel.operators import asof_both, latest_by, left_join_spread_nulls

BASE = dt.datetime(2024, 1, 1)
rows_strategy = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 6), st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
    min_size=1, max_size=25)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(rows=rows_strategy)
def test_latest_by_matches_brute_force(spark, rows):
    data = [(k, BASE + dt.timedelta(hours=t), i, v) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz, id int, v string")
    got = {r.k: (r.id, r.v) for r in latest_by(df, ["k"], ["ts", "id"], ["id", "v"]).collect()}
    want = {}
    for k, ts, i, v in data:
        if k not in want or (ts, i) > want[k][0]:
            want[k] = ((ts, i), (i, v))
    assert got == {k: w[1] for k, w in want.items()}


@SETTINGS
@given(rows=rows_strategy, snaps=st.lists(st.integers(0, 6), min_size=4, max_size=4))
def test_asof_both_matches_brute_force(spark, rows, snaps):
    left = spark.createDataFrame([(k, BASE + dt.timedelta(hours=snaps[k])) for k in range(4)],
                                 "k int, snap timestamp_ntz")
    data = [(k, BASE + dt.timedelta(hours=t), i, v, v) for i, (k, t, v) in enumerate(rows)]
    right = spark.createDataFrame(data, "k int, ts timestamp_ntz, id int, old string, new string")
    got = {r.k: (r.b, r.a) for r in asof_both(left, right, "k", "snap", "ts", "id", before_value="new",
                                               after_value="old", before_alias="b", after_alias="a").collect()}
    want = {}
    for k in {d[0] for d in data}:
        snap = BASE + dt.timedelta(hours=snaps[k])
        before = [d for d in data if d[0] == k and d[1] < snap]
        after = [d for d in data if d[0] == k and d[1] >= snap]
        b = max(before, key=lambda d: (d[1], d[2]))[4] if before else None
        a = min(after, key=lambda d: (d[1], d[2]))[3] if after else None
        want[k] = (b, a)
    assert got == want


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.integers(0, 5)), min_size=1, max_size=40))
def test_spread_null_join_matches_plain_left_join(spark, keys):
    left = spark.createDataFrame(list(enumerate(keys)), "id int, k int")
    right = spark.createDataFrame([(k, f"n{k}") for k in range(0, 6, 2)], "rk int, name string")
    got = sorted(tuple(r) for r in left_join_spread_nulls(left, right, "k", "rk", ["id"]).collect())
    names = {k: f"n{k}" for k in range(0, 6, 2)}
    want = sorted((i, k, k if k in names else None, names.get(k)) for i, k in enumerate(keys))
    assert got == want
