"""Generations of published tables, checks in the write pass, bucketed tables."""
import os
import tempfile
import threading

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as E
from kestrel.operators.quality import ROW_KINDS, bad_rows
from kestrel.plans import MODELS, Build
from kestrel.plans import generations as G
from kestrel.plans.publish import (
    ALL_LAYERS, ChecksFailed, check_results, publish, published_build, published_models, read_current, sources_of,
)
from kestrel.plans.quality_checks import CHECKS
from kestrel.settings import fixture_settings
from kestrel.sources import FixtureSources, SOURCE_NAMES, DataFrameSources, materialize_sources
from tests.conftest import SF_SMALL


def folder(name):
    return tempfile.mkdtemp(prefix=f"kestrel-test-{name}-")


def commit(spark, root, run, frames, database):
    entries = []
    for name, df in frames.items():
        e = G.entry(name, f"{root}/{name}/run={run}", df.schema)
        df.write.parquet(e.path)
        entries.append(e)
    return G.commit(spark, root, run, entries, database)


def versions(spark, database):
    return [tuple(r) for r in spark.sql(
        f"SELECT 'a', max(v), min(v) FROM {database}.a UNION ALL SELECT 'b', max(v), min(v) FROM {database}.b").collect()]


def test_readers_never_see_two_generations(spark):
    """Queries over two tables while a publisher switches ten times; a query sees one run."""
    root, db = folder("switch"), "kestrel_test_switch"

    def put(v):
        df = spark.range(50).select("id", F.lit(v).alias("v"))
        commit(spark, root, f"r{v}", {"a": df, "b": df}, db)

    put(0)
    stop, broken = threading.Event(), []

    def publisher():
        try:
            for v in range(1, 11):
                put(v)
        except Exception as e:  # noqa: BLE001
            broken.append(e)
        stop.set()

    t = threading.Thread(target=publisher)
    t.start()
    seen = set()
    while not stop.is_set():
        (_, hi, lo), (_, hi_b, lo_b) = versions(spark, db)
        assert hi == lo == hi_b == lo_b
        seen.add(hi)
    t.join()
    assert not broken and len(seen) > 1
    assert versions(spark, db) == [("a", 10, 10), ("b", 10, 10)]
    files = spark.table(f"{db}.a").inputFiles()
    assert files and all("/run=r10/" in f for f in files)
    # The pointer is a literal after planning: one partition is listed, by a static filter.
    plan = spark.table(f"{db}.a")._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "PartitionFilters: [isnotnull(run" in plan and "= r10)" in plan


def test_switch_is_one_write_and_carries_other_models(spark):
    root, db = folder("carry"), "kestrel_test_carry"
    one = spark.range(3).select("id", F.lit(1).alias("v"))
    commit(spark, root, "r1", {"a": one, "b": one}, db)
    a_view = spark.sql(f"SHOW CREATE TABLE {db}.a").first()[0]
    held = G.current(spark, root)
    commit(spark, root, "r2", {"b": one.withColumn("v", F.lit(2))}, db)
    assert spark.sql(f"SHOW CREATE TABLE {db}.a").first()[0] == a_view  # only the pointer moved
    assert versions(spark, db) == [("a", 1, 1), ("b", 2, 2)]
    now = G.current(spark, root)
    assert set(now.entries) == {"a", "b"} and now.entries["a"].path.endswith("run=r1")
    assert held.table("b").first()["v"] == 1 and now.table("b").first()["v"] == 2


def test_columns_that_change_with_a_generation(spark):
    """The view has the new columns before the switch, with the old rows until it."""
    root, db = folder("shape"), "kestrel_test_shape"
    commit(spark, root, "r1", {"a": spark.sql("SELECT 1 AS id, '7' AS x, 5 AS gone")}, db)
    new = spark.sql("SELECT 2 AS id, 8L AS x, true AS fresh")
    e = G.entry("a", f"{root}/a/run=r2", new.schema)
    new.write.parquet(e.path)
    G.prepare(spark, db, root, "r2", {"a": e})
    assert [tuple(r) for r in spark.table(f"{db}.a").collect()] == [(1, 7, None)]
    G.commit(spark, root, "r2", [e], db)
    assert [tuple(r) for r in spark.table(f"{db}.a").collect()] == [(2, 8, True)]
    commit(spark, root, "r3", {"a": new}, db)
    assert G.retire(spark, root, keep=2, grace_seconds=0, database=db) == ["r1"]
    assert len([t for t in spark.catalog.listTables(db) if t.name.startswith("a__")]) == 1
    assert [tuple(r) for r in spark.table(f"{db}.a").collect()] == [(2, 8, True)]


def test_retention(spark):
    """Old files go after the grace period only, and not while a kept generation names them."""
    root, db = folder("retire"), "kestrel_test_retire"
    df = spark.range(3).select("id", F.lit(1).alias("v"))
    commit(spark, root, "r1", {"a": df, "b": df}, db)
    commit(spark, root, "r2", {"b": df}, db)
    commit(spark, root, "r3", {"b": df}, db)
    late_reader = spark.table(f"{db}.b").join(spark.table(f"{db}.a"), "id")
    commit(spark, root, "r4", {"b": df.withColumn("v", F.lit(4))}, db)
    assert G.retire(spark, root, keep=2, grace_seconds=3600, database=db) == []
    assert G.retire(spark, root, keep=2, grace_seconds=0, database=db) == ["r1", "r2"]
    assert [g.run for g in G.generations(spark, root)] == ["r4", "r3"]
    assert not os.path.exists(f"{root}/b/run=r1") and not os.path.exists(f"{root}/b/run=r2")
    assert os.path.exists(f"{root}/a/run=r1") and os.path.exists(f"{root}/b/run=r3")
    assert late_reader.count() == 3 and versions(spark, db) == [("a", 1, 1), ("b", 4, 4)]
    assert G.retire(spark, root, keep=1, grace_seconds=0, database=db) == ["r3"]
    assert os.path.exists(f"{root}/a/run=r1") and read_current(spark, root, "a").count() == 3
    with pytest.raises(ValueError):
        G.retire(spark, root, keep=0)


@pytest.fixture(scope="module")
def stored(spark):
    return materialize_sources(FixtureSources(spark, SF_SMALL), folder("sources"))


@pytest.fixture(scope="module")
def full(spark, stored):
    """One publish of everything, with a catalog and buckets."""
    root = folder("full")
    timings = publish(Build(spark, stored, fixture_settings()), root, run_id="r1", parallel=4, database="kestrel_test_full")
    return root, timings


def test_full_publish_runs_all_checks(spark, full):
    """36 tables; all 119 declared checks, sources included, with the counts of the checks run one by one."""
    root, timings = full
    assert len(timings) == len(published_models()) == 36 and {MODELS[n].layer for n in timings} == set(ALL_LAYERS)
    got = {r["test"]: (r["failures"], r["status"]) for r in check_results(spark, root, "r1").collect()}
    assert len(got) == len(CHECKS) == 119
    now = G.current(spark, root)
    for ck in CHECKS:
        if not ck.model.startswith("source:"):
            assert got[ck.name][0] == ck.failures(now.table(ck.model)).count(), ck.name
    assert not [t for t, (_, s) in got.items() if s == "fail"]


def test_published_rows_equal_the_models(spark, stored, full):
    root, _ = full
    b = Build(spark, stored, fixture_settings())
    now = G.current(spark, root)
    for name in ("stg_policy", "int_business", "nb_sales_daily", "wt_pings_daily"):
        want, got = b.ref(name), spark.table(f"kestrel_test_full.{name}")
        assert got.columns == want.columns and got.count() == want.count()
        assert got.exceptAll(want).isEmpty() and now.table(name).exceptAll(want).isEmpty()


def test_layers(spark):
    assert len(published_models(("intermediate", "marts"))) == 16
    with pytest.raises(ValueError):
        publish(E.build(spark, SF_SMALL), folder("bad"), ["stg_partner"], run_id="7")
    assert set(sources_of(E.build(spark, SF_SMALL), ["policy_revenue_summary"])) == {"Policy", "Business"}


def test_source_checks_stop_the_build_before_any_table(spark, stored):
    """A null source key stops the run; a null where only a warning is declared does not."""
    tables = {n: stored.table(n) for n in SOURCE_NAMES}
    lead = tables["Lead"]
    tables["Lead"] = lead.withColumn("businessId", F.when(F.col("id") % 2 == 0, F.col("businessId")))
    root = folder("source-checks")
    publish(Build(spark, DataFrameSources(spark, tables), fixture_settings()), root, ["stg_lead"], run_id="r1")
    warned = check_results(spark, root, "r1").where("status = 'warn'").collect()
    assert [r["test"] for r in warned] == ["not_null__source:Lead__businessId"] and warned[0]["failures"] > 0
    some = lead.agg(F.min("id")).first()[0]
    tables["Lead"] = lead.withColumn("id", F.when(F.col("id") != some, F.col("id")))
    with pytest.raises(ChecksFailed, match="not_null__source:Lead__id"):
        publish(Build(spark, DataFrameSources(spark, tables), fixture_settings()), root, ["stg_lead"], run_id="r2")
    assert not os.path.exists(f"{root}/stg_lead/run=r2") and G.current(spark, root).run == "r1"


def test_a_failed_model_is_not_built_upon(spark, stored):
    """Its readers are skipped, the rest is written, nothing is committed."""
    tables = {n: stored.table(n) for n in SOURCE_NAMES}
    tables["Carrier"] = tables["Carrier"].withColumn("name", F.lit("x"))
    log = tables["ChangeLog"]
    tables["ChangeLog"] = log.union(log.where("entityType = 'POLICY'"))
    root = folder("skipped")
    names = ["stg_policy_status_change", "int_ae_sales_policy", "stg_partner"]
    with pytest.raises(ChecksFailed, match="unique__stg_policy_status_change__change_log_id"):
        publish(Build(spark, DataFrameSources(spark, tables), fixture_settings()), root, names, run_id="r1")
    assert os.path.exists(f"{root}/stg_partner/run=r1") and not os.path.exists(f"{root}/int_ae_sales_policy")
    assert G.current(spark, root) is None
    assert check_results(spark, root, "r1").where("status = 'fail'").count() == 1


def test_row_checks_cost_no_scan(spark, stored):
    """Row checks are metrics of the write: the same scans and exchanges as without them."""
    assert {ck.kind for ck in CHECKS if ck.model == "business_funnel_daily"} <= set(ROW_KINDS)
    b = Build(spark, stored, fixture_settings())
    obs = Observation()
    own = [ck for ck in CHECKS if ck.model == "business_funnel_daily"]
    df = b.ref("business_funnel_daily").observe(obs, *[bad_rows(ck).alias(f"c{i}") for i, ck in enumerate(own)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    bare = b.ref("business_funnel_daily")._jdf.queryExecution().executedPlan().toString()
    assert "CollectMetrics" in plan and plan.count("Scan parquet") == bare.count("Scan parquet") \
        and plan.count("Exchange") == bare.count("Exchange")


@pytest.fixture
def plain_joins(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    yield lambda: [spark.conf.set(k, v) for k, v in zip(keep, ("-1", "false"), strict=True)]
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_bucketed_tables_join_without_an_exchange(spark, stored, full, plain_joins):
    root, _ = full
    now = G.current(spark, root)
    assert {n for n, e in now.entries.items() if e.buckets} == {
        "stg_business", "int_business", "stg_policy", "int_policy_revenue", "int_ae_sales_policy"}
    b = published_build(Build(spark, stored, fixture_settings()), "kestrel_test_full", "r1", now.entries)
    plain = Build(spark, stored, fixture_settings(), lambda n: now.table(n) if n.startswith("stg_") else None)
    rollup = b.ref("int_business_close_status")
    plain_joins()
    joined = b.ref("stg_business").join(rollup, "business_id", "left")
    unbucketed = plain.ref("stg_business").join(plain.ref("int_business_close_status"), "business_id", "left")
    plans = [d._jdf.queryExecution().executedPlan().toString() for d in (joined, unbucketed)]
    assert "Bucketed: true" in plans[0] and plans[0].count("Exchange") == plans[1].count("Exchange") - 1 == 1
    assert joined.exceptAll(unbucketed).isEmpty() and joined.count() == unbucketed.count()
    by_policy = b.ref("stg_policy").join(b.ref("int_policy_revenue"), "policy_id").join(b.ref("int_ae_sales_policy"), "policy_id")
    p = by_policy._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in p and "Exchange" not in p
    views = spark.table("kestrel_test_full.stg_policy").join(spark.table("kestrel_test_full.int_policy_revenue"), "policy_id")
    p = views._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in p and "Exchange" not in p and views.count() == now.table("int_policy_revenue").count()
    # The wide join of a published build: the business table and its rollups keep one partitioning.
    fresh = Build(spark, stored, fixture_settings(), lambda n: None if n.startswith("int_business") else b.ref(n))
    wide = [d.ref("int_business_joined")._jdf.queryExecution().executedPlan().toString() for d in (fresh, plain)]
    assert wide[0].count("Exchange") < wide[1].count("Exchange")
