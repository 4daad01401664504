"""How often the models read their sources, and that payloads are parsed once."""
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from kestrel.functions import json_has_key, json_text, parsed_json, variant_has_key, variant_text
from kestrel.plans import Build
from kestrel.settings import fixture_settings
from kestrel.sources import FixtureSources, materialize_sources
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def stored(spark):
    return materialize_sources(FixtureSources(spark, SF_SMALL), tempfile.mkdtemp(prefix="kestrel-test-scans-"))


@pytest.fixture
def plain_joins(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    yield lambda: [spark.conf.set(k, v) for k, v in zip(keep, ("-1", "false"), strict=True)]
    for k, v in keep.items():
        spark.conf.set(k, v)


def scans(df, source):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"FileScan parquet .*?/{source}\]", plan)), plan


@pytest.mark.parametrize("model, sources", [
    ("int_business", {"Policy": 1, "Business": 2, "PolicyTransaction": 1}),
    ("nb_sales_daily", {"PolicyTransaction": 1}),
    ("business_funnel_daily", {"Business": 1, "Policy": 1, "Quote": 1, "ApplicationSubmission": 1}),
])
def test_sources_are_read_once(spark, stored, plain_joins, model, sources):
    df = Build(spark, stored, fixture_settings()).ref(model)
    plain_joins()
    for name, n in sources.items():
        assert scans(df, name)[0] == n, name


def test_null_campaigns_are_spread(spark, stored, plain_joins):
    """The campaign join's key of the pings includes the salt."""
    b = Build(spark, stored, fixture_settings())
    df = b.ref("int_warm_transfer")
    plain_joins()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(campaign_status_id#\d+L, __salt_l#\d+L", plan)


def test_payload_is_parsed_once(spark, stored):
    plan = Build(spark, stored, fixture_settings()).ref("stg_warm_transfer")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"parseJson|parse_json", plan)) == 1
    narrow = Build(spark, stored, fixture_settings()).ref("stg_warm_transfer").select("warm_transfer_id")
    assert "parse" not in narrow._jdf.queryExecution().executedPlan().toString().lower()


def test_variant_reads_equal_json_reads(spark):
    texts = ['{"duns": null}', '{"duns": 1, "awlCampaign": " X "}', '{"awlCampaign": null}', '{"awlCampaign": ""}', '{}', '[]', '[{"duns": 1}]',
             '"duns"', "null", "7", "no json", "", None, '{"awlCampaign": 12}', '{"awlCampaign": true}', '{"awlCampaign": "a\\"b\\u00e9"}',
             '{"awlCampaign": {"a": [1, null]}}', '{"x": {"duns": 1}}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, j string").withColumn("v", parsed_json("j"))
    rows = df.select("i", F.coalesce(json_has_key("j", "duns"), F.lit(False)).alias("h0"), F.coalesce(variant_has_key("v", "duns"), F.lit(False)).alias("h1"),
                     json_text("j", "awlCampaign").alias("t0"), variant_text("v", "awlCampaign").alias("t1")).collect()
    assert [r["h0"] for r in rows] == [r["h1"] for r in rows] and sum(r["h1"] for r in rows) == 2
    assert [(r["i"], r["t0"]) for r in rows] == [(r["i"], r["t1"]) for r in rows]
    twice = spark.createDataFrame([('{"awlCampaign": "a", "awlCampaign": "b"}',)], "j string")
    assert twice.select(variant_text(parsed_json("j"), "awlCampaign").alias("t")).first()["t"] == "b"


def test_products_keep_eight_decimals(spark):
    """premium (4 decimals) times rate (6) is compared at 8; a mean keeps what its column has."""
    from kestrel.plans.contract import canonical_type
    from kestrel.plans.marts import exact_mean
    from oracle.contracts import CONTRACTS
    assert dict(CONTRACTS["stg_policy"])["estimated_commission"] == "DECIMAL(38,8)"
    df = spark.sql("SELECT CAST(0.12345679 AS DECIMAL(24,8)) AS r FROM range(3)")
    assert canonical_type(df.schema["r"].dataType) == "DECIMAL(38,8)"
    assert str(df.agg(exact_mean("r", 8).cast("decimal(38,8)").alias("m")).first()["m"]) == "0.12345679"


def test_dimensions_meet_narrow_rows(spark, stored, plain_joins):
    """int_business_joined: NULL keys of every dimension are spread, and no dimension is joined to the
    rows that hold the rollups, which are sorted for no join."""
    b = Build(spark, stored, fixture_settings())
    df = b.ref("int_business_joined")
    plain_joins()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for key in ("credited_account_executive", "business_classification_id", "user_id", "warm_transfer_campaign_status_id"):
        assert re.search(rf"hashpartitioning\({key}#\d+L?, __salt_l#\d+L", plan), key
    first = next(x for x in plan.splitlines() if "Join" in x)
    assert "[business_id#" in first, first


def test_partitions_are_merged_to_a_bounded_size(spark):
    """Some 40 MB of a shuffle in 8 partitions do not become one task."""
    flag = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    keep = spark.conf.get(flag)
    spark.conf.set(flag, "false")
    try:
        rows = spark.range(0, 600000, 1, 4).select("id", *[F.xxhash64("id", F.lit(i)).alias(f"h{i}") for i in range(8)])
        assert 3 <= rows.repartition("id").rdd.getNumPartitions() <= 8
    finally:
        spark.conf.set(flag, keep)


def test_models_are_checked_one_after_the_other(spark, stored):
    """What model_checks returns is each model's kept result rows, not one plan of all models."""
    from kestrel.operators.quality import Check, run_checks
    from kestrel.plans.quality_checks import model_checks
    b = Build(spark, stored, fixture_settings())
    checks = [Check("stg_lead", "unique", ("lead_id",)), Check("source:Lead", "not_null", ("businessId",), severity="warn"),
              Check("stg_lead", "not_null", ("lead_id",))]
    got = model_checks(b, checks)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Aggregate" not in plan
    frames = {"stg_lead": b.ref("stg_lead"), "source:Lead": b.source("Lead")}
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, run_checks(frames, checks).collect()))
