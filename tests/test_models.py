"""Model-level behaviour: literal overrides of single sources, cross-mart
invariants, publishing."""
import datetime
import datetime as dt
import decimal
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from kestrel.plans import Build
from kestrel.plans.publish import ChecksFailed, publish, read_current
from kestrel.settings import fixture_settings
from kestrel.sources import DataFrameSources, FixtureSources, SOURCE_NAMES
from tests.conftest import SF_MID, SF_SMALL


def T(s):
    return dt.datetime.fromisoformat(s)


@pytest.fixture(scope="module")
def mid(spark):
    return E.build(spark, SF_MID)


def _with_override(spark, name, df):
    fx = FixtureSources(spark, SF_SMALL)
    tables = {n: fx.table(n) for n in SOURCE_NAMES}
    tables[name] = df
    return Build(spark, DataFrameSources(spark, tables), fixture_settings())


def test_ae_sales_status_resolution_falls_through_deletions(spark):
    fx = FixtureSources(spark, SF_SMALL)
    pol = fx.table("Policy").where("id = 7").select("id", "createdAt").first()
    snap = dt.datetime(pol.createdAt.year + (pol.createdAt.month == 12), pol.createdAt.month % 12 + 1, 1, 5, 5)
    log = spark.createDataFrame(
        [(1, "POLICY", "status", 7, "BOUND", None, "u", snap - dt.timedelta(days=1)),      # deletion before
         (2, "POLICY", "status", 7, "CANCELLED", "BOUND", "u", snap),                       # first at/after
         (3, "POLICY", "status", 7, "BOUND", "EXPIRED", "u", snap + dt.timedelta(days=3))],
        "id long, entityType string, fieldName string, entityId long, oldValue string, newValue string, "
        "changedBy string, createdAt timestamp_ntz")
    b = _with_override(spark, "ChangeLog", log)
    r = b.ref("int_ae_sales_policy").where("policy_id = 7").first()
    assert r.snapshot_at == snap
    assert r.status_at_snapshot == "CANCELLED"
    assert r.is_ae_sales_policy is False


def test_rejection_buckets_first_match_wins(spark):
    fx = FixtureSources(spark, SF_SMALL)
    base = fx.table("WarmTransfer").limit(1).drop("rejectionReason")
    reasons = ["No available AEs, daily cap", "Outside rejection hours", "Revenue below minimum",
               "Missing legal_entity_id", "Invalid phone", None, "something"]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(reasons)], "i int, rejectionReason string")
    wt = base.drop("id").crossJoin(rows).withColumn("id", F.col("i").cast("long")).drop("i")
    b = _with_override(spark, "WarmTransfer", wt)
    got = dict(b.ref("stg_warm_transfer").select("rejection_reason", "rejection_reason_category").collect())
    assert got["No available AEs, daily cap"] == "Daily cap reached"
    assert got["Outside rejection hours"] == "Outside acceptance hours"
    assert got["Revenue below minimum"] == "Did not meet lead requirements"
    assert got["Missing legal_entity_id"] == "Did not meet lead requirements"
    assert got["Invalid phone"] == "Missing or invalid data"
    assert got[None] is None
    assert got["something"] == "Other"


def test_tracker_counts_every_non_test_business(mid):
    total = mid.ref("wt_tracker_daily").agg(F.sum("business_count")).first()[0]
    assert total == mid.ref("int_business").where(~F.col("is_test_business")).count()


def test_nb_sales_revenue_reconciles_with_ledger(mid):
    nb = mid.ref("nb_sales_daily")
    spine = mid.ref("dim_date").agg(F.min("date_day").alias("lo"), F.max("date_day").alias("hi")).first()
    ledger = mid.ref("int_nb_revenue_transaction").where(F.col("booked_date").between(spine.lo, spine.hi)) \
        .join(mid.ref("stg_business").select("business_id"), "business_id")
    assert nb.agg(F.sum("nb_net_revenue")).first()[0] == ledger.agg(F.sum("signed_amount")).first()[0]
    parts = F.coalesce(F.col("commission"), F.lit(0)) + F.coalesce(F.col("tech_fee"), F.lit(0)) \
        + F.coalesce(F.col("endorsement"), F.lit(0)) + F.coalesce(F.col("cancellation"), F.lit(0))
    assert nb.where(parts != F.col("nb_net_revenue")).count() == 0


def test_calls_split_into_routed_and_unrouted(mid):
    c = mid.ref("ringba_calls_daily")
    assert c.where(F.col("calls") != F.col("routed_calls") + F.col("unrouted_calls")).count() == 0


def test_declared_checks_pass_except_warnings(mid):
    from kestrel.plans.quality_checks import model_checks
    bad = model_checks(mid).where("status = 'fail'").collect()
    assert bad == []


def test_publish_and_read_back(spark):
    b = E.build(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="kestrel-test-publish-")
    timings = publish(b, root, ["int_policy_revenue", "policy_revenue_summary"], parallel=2)
    assert set(timings) == {"int_policy_revenue", "policy_revenue_summary"}
    got = read_current(spark, root, "policy_revenue_summary")
    assert got.count() == E.build(spark, SF_SMALL).ref("policy_revenue_summary").count()


def test_publish_repoints_catalog_views(spark):
    """SNK-01..03 for catalog readers: each model is a view in one database that
    moves to the new version only after a complete run."""
    root = tempfile.mkdtemp(prefix="kestrel-test-catalog-")
    names = ["int_policy_revenue", "policy_revenue_summary"]
    publish(E.build(spark, SF_SMALL), root, names, run_id="r1", parallel=2, database="kestrel_test_reporting")
    first = spark.table("kestrel_test_reporting.policy_revenue_summary").count()
    assert first == read_current(spark, root, "policy_revenue_summary").count()
    publish(E.build(spark, SF_SMALL), root, names, run_id="r2", parallel=2, database="kestrel_test_reporting")
    views = {t.name for t in spark.catalog.listTables("kestrel_test_reporting")}
    assert set(names) <= views
    files = spark.table("kestrel_test_reporting.int_policy_revenue").inputFiles()
    assert files and all("/run=r2/" in f for f in files)
    assert spark.table("kestrel_test_reporting.policy_revenue_summary").count() == first


def test_failed_run_keeps_previous_version(spark):
    """A run whose job fails part-way writes no manifest: readers keep the last
    complete version and nothing points at the broken run's folders."""
    root = tempfile.mkdtemp(prefix="kestrel-test-failed-run-")
    names = ["int_policy_revenue", "policy_revenue_summary"]
    publish(E.build(spark, SF_SMALL), root, names, run_id="r1", parallel=2)
    good = read_current(spark, root, "policy_revenue_summary").count()
    policy = FixtureSources(spark, SF_SMALL).table("Policy")
    broken = policy.withColumn("premium", F.raise_error(F.lit("input lost")).cast("double"))
    with pytest.raises(Exception, match="input lost"):
        publish(_with_override(spark, "Policy", broken), root, names, run_id="r2", parallel=2)
    assert read_current(spark, root, "policy_revenue_summary").count() == good
    assert spark.read.parquet(f"{root}/_manifest").where("run = 'r2'").count() == 0


def test_newest_is_the_run_committed_last(spark):
    """r10 is published after r9: readers get r10, whatever the text order of the ids."""
    root = tempfile.mkdtemp(prefix="kestrel-test-order-")
    for run in ("r9", "r10"):
        publish(E.build(spark, SF_SMALL), root, ["stg_partner"], run_id=run)
    assert all("/run=r10/" in f for f in read_current(spark, root, "stg_partner").inputFiles())
    assert read_current(spark, root + "/nothing", "stg_partner") is None


def test_failing_check_keeps_previous_version(spark):
    root = tempfile.mkdtemp(prefix="kestrel-test-checks-")
    publish(E.build(spark, SF_SMALL), root, ["stg_partner"], run_id="r1")
    partner = FixtureSources(spark, SF_SMALL).table("Partner")
    with pytest.raises(ChecksFailed, match="unique__stg_partner__partner_id"):
        publish(_with_override(spark, "Partner", partner.union(partner)), root, ["stg_partner"], run_id="r2")
    assert all("/run=r1/" in f for f in read_current(spark, root, "stg_partner").inputFiles())


def test_stored_order(spark):
    root = tempfile.mkdtemp(prefix="kestrel-test-stored-")
    publish(E.build(spark, SF_SMALL), root, ["int_policy_revenue", "policy_revenue_summary"])
    rows = [(r["bound_month"], r["gross_written_premium"]) for r in read_current(spark, root, "policy_revenue_summary").collect()]
    key = lambda r: tuple((v is not None, -(v.toordinal() if hasattr(v, "toordinal") else v) if v is not None else 0) for v in r)
    assert rows == sorted(rows, key=key)


def test_settings_defaults():
    """Eastern today at 02:00 UTC is the day before; the brand and the in-house channels are required."""
    from kestrel.settings import Settings, eastern_today
    assert eastern_today(datetime.datetime(2026, 3, 2, 2, 0, tzinfo=datetime.timezone.utc)) == datetime.date(2026, 3, 1)
    with pytest.raises(TypeError):
        Settings()
    with pytest.raises(ValueError):
        Settings(house_brand=" ", other_non_partner_licenses=())


def test_no_source_row_is_cut(spark, duck):
    b = E.build(spark, SF_SMALL)
    n = lambda t: duck.execute(f"SELECT count(*) FROM {t}").fetchone()[0]
    assert b.ref("stg_policy_transaction").count() == b.ref("stg_opportunity_status_history").count() == n("lineitem")
    assert b.ref("stg_warm_transfer").count() == n("events")


def test_rates_keep_their_digits(spark):
    from pyspark.sql import functions as F

    from kestrel.plans.marts import exact_mean
    df = spark.sql("SELECT CAST(0.123456 AS DECIMAL(18,6)) AS r FROM range(2)")
    assert float(df.agg(exact_mean("r").alias("m")).first()["m"]) == 0.123456
    row = E.build(spark, SF_SMALL).ref("stg_policy").where(F.col("premium") * F.col("commission_rate") > 1) \
        .select("premium", "commission_rate", "estimated_commission").first()
    assert abs(row["premium"] * row["commission_rate"] - row["estimated_commission"]) < decimal.Decimal("0.00000001")


def test_dim_date_matches_oracle(spark, duck):
    """The calendar spine (not registered as a query: it reads no table)."""
    from oracle.contracts import CONTRACTS
    from oracle.duck_models import query_sql
    from kestrel.plans.contract import conform
    df = conform(E.build(spark, SF_SMALL).ref("dim_date"), CONTRACTS["dim_date"])
    got = sorted(tuple(map(str, r)) for r in df.collect())
    cols = ", ".join(f'CAST("{c}" AS {t}) AS "{c}"' for c, t in CONTRACTS["dim_date"])
    exp = sorted(tuple(map(str, r)) for r in duck.execute(f"SELECT {cols} FROM ({query_sql('dim_date')})").fetchall())
    assert got == exp and len(got) == 1826


def test_jdbc_sources_options(spark):
    """JDBC reads are not run here (no database server); the read options are."""
    from kestrel.sources import JdbcSources
    src = JdbcSources(spark, "jdbc:postgresql://db:5432/app", "public", {"user": "reader"},
                      {"PolicyTransaction": ("id", 0, 1000, 8)})
    o = src.options("PolicyTransaction")
    assert o["dbtable"] == '"public"."PolicyTransaction"' and o["numPartitions"] == "8"
    assert o["partitionColumn"] == '"id"' and o["user"] == "reader"
    assert "partitionColumn" not in src.options("Carrier")
