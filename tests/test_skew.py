"""Hot keys: one business holds a third of all policies and one policy a third
of the ledger. Results must stay whole and equal to the oracle on the same data."""
import collections
import datetime
import decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from kestrel.plans import Build
from kestrel.plans.contract import conform
from kestrel.settings import fixture_settings
from kestrel.sources import SOURCE_NAMES, DataFrameSources, FixtureSources
from oracle.contracts import CONTRACTS
from oracle.duck_models import CTES, _order
from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def skewed(spark, duck):
    fx = FixtureSources(spark, SF_SMALL)
    tables = {n: fx.table(n) for n in SOURCE_NAMES}
    tables["Policy"] = tables["Policy"].withColumn(
        "businessId", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("businessId")))
    tables["PolicyTransaction"] = tables["PolicyTransaction"].withColumn(
        "policyId", F.when(F.col("id") % 3 == 0, F.lit(3)).otherwise(F.col("policyId")))
    for name in ("Policy", "PolicyTransaction"):
        duck.register(f"skewed_{name}", tables[name].toPandas())
    return Build(spark, DataFrameSources(spark, tables), fixture_settings())


def _oracle(duck, name):
    order: list[str] = []
    _order(name, set(), order)
    body = []
    for n in order:
        sql = CTES[n][1]
        if n in ("src_Policy", "src_PolicyTransaction"):
            sql = f"SELECT * FROM skewed_{n[4:]}"
        body.append(f"{n} AS (\n{sql}\n)")
    cols = ", ".join(f'CAST("{c}" AS {t}) AS "{c}"' for c, t in CONTRACTS[name])
    cur = duck.execute(f"WITH {', '.join(body)} SELECT {cols} FROM {name}")
    return [d[0] for d in cur.description], cur.fetchall()


@pytest.mark.parametrize("name", ["int_business", "wt_tracker_daily", "nb_sales_daily", "int_ae_sales_policy",
                                  "business_funnel_daily", "policy_revenue_summary"])
def test_hot_keys_keep_results_whole(skewed, duck, name):
    df = conform(skewed.ref(name), CONTRACTS[name])
    rows = [tuple(r) for r in df.collect()]
    ocols, orows = _oracle(duck, name)
    assert len(rows) == len(orows)
    assert _bag(df.columns, rows) == _bag(ocols, orows)


def test_hot_business_really_is_hot(skewed):
    p = skewed.ref("stg_policy")
    n0 = p.where("business_id = 0").count()
    assert n0 * 3 >= p.count() - 3


def test_null_keys_spread_over_partitions(spark):
    """The NULL-key salt is part of the hash partitioning, and no partition gets most NULL rows."""
    from pyspark.sql import functions as F

    from kestrel.operators import left_join_spread_nulls
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(keep, ("-1", "false"), strict=True):
            spark.conf.set(k, v)
        left = spark.range(8000).select(F.col("id"), F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"))
        right = spark.range(8000).select(F.col("id").alias("rk"), F.lit("x").alias("v"))
        out = left_join_spread_nulls(left, right, "k", "rk", ["id"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("hashpartitioning(k") and "__salt_l" in plan.split("hashpartitioning(k", 1)[1][:40]
        nulls = [r["n"] for r in out.where("k IS NULL").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(nulls) == 6000 and max(nulls) < 2 * 6000 / len(nulls) and len(nulls) >= 8
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
