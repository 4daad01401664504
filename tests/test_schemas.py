"""Declared source schemas."""
import tempfile

import pytest
from pyspark.sql import functions as F

from kestrel.plans import Build
from kestrel.plans.quality_checks import CHECKS
from kestrel.settings import fixture_settings
from kestrel.sources import SCHEMAS, SOURCE_NAMES, DataFrameSources, FixtureSources, ParquetSources, SourceSchemaError, materialize_sources
from tests.conftest import SF_SMALL


def test_every_source_is_declared(spark):
    assert set(SCHEMAS) == set(SOURCE_NAMES)
    src = FixtureSources(spark, SF_SMALL)
    for name in SOURCE_NAMES:
        assert [(f.name, f.dataType) for f in src.table(name).schema] == [(f.name, f.dataType) for f in SCHEMAS[name]]
    keys = {(ck.model.split(":")[1], ck.columns[0]) for ck in CHECKS
            if ck.model.startswith("source:") and ck.kind == "not_null" and ck.severity == "error"}
    assert {(n, f.name) for n, s in SCHEMAS.items() for f in s if not f.nullable} == keys


def test_missing_and_retyped_columns_fail_before_any_job(spark):
    """One error names every column at fault; no job runs, from files as from frames."""
    root = tempfile.mkdtemp(prefix="kestrel-test-schemas-")
    materialize_sources(FixtureSources(spark, SF_SMALL), root, names=("Carrier", "Lead"))
    lead = spark.read.parquet(f"{root}/Lead")
    lead.drop("score").withColumnRenamed("isJunk", "isjunk").withColumn("createdAt", F.col("createdAt").cast("string")) \
        .write.mode("overwrite").parquet(f"{root}/Broken/Lead")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    with pytest.raises(SourceSchemaError) as e:
        Build(spark, ParquetSources(spark, f"{root}/Broken"), fixture_settings()).ref("stg_lead")
    text = str(e.value)
    assert "Lead.score int: missing" in text and "Lead.isJunk boolean: missing (there is 'isjunk')" in text
    assert "Lead.createdAt timestamp_ntz: is string" in text and "Lead.id" not in text
    with pytest.raises(SourceSchemaError, match="Lead.id bigint NOT NULL: is string"):
        DataFrameSources(spark, {"Lead": lead.withColumn("id", F.col("id").cast("string"))}).table("Lead")
    # Reading a Parquet footer is Spark's own job; the check itself adds none.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) - len(before) <= 1
    with pytest.raises(KeyError):
        ParquetSources(spark, root).table("Nothing")


def test_wider_types_and_other_columns(spark):
    rows = spark.sql("SELECT 1 AS id, 'c' AS name, true AS isWholesaler, false AS agencyBill, 'x' AS more")
    got = DataFrameSources(spark, {"Carrier": rows}).table("Carrier")
    assert got.schema.simpleString() == "struct<id:bigint,name:string,isWholesaler:boolean,agencyBill:boolean>" and got.count() == 1
