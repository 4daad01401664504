"""Physical-plan properties the design relies on (checked with explain)."""
import contextlib
import io
import tempfile

import pytest

from kestrel.plans import MODELS, Build
from kestrel.settings import fixture_settings
from kestrel.sources import SOURCE_NAMES, DataFrameSources, FixtureSources, materialize_sources
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def pq_build(spark):
    root = tempfile.mkdtemp(prefix="kestrel-test-sources-")
    src = materialize_sources(FixtureSources(spark, SF_SMALL), root)
    return lambda: Build(spark, src, fixture_settings())


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_changelog_predicates_reach_the_scan(pq_build):
    p = plan(pq_build().ref("stg_policy_status_change"))
    assert "PushedFilters" in p
    assert "EqualTo(entityType,POLICY)" in p and "EqualTo(fieldName,status)" in p


def test_partitioned_changelog_is_pruned_with_same_rows(spark, pq_build):
    """With the audit log partitioned by entityType / fieldName (the production
    layout), the status models read only their partition and return the same rows."""
    from kestrel.sources import PRODUCTION_LAYOUT
    root = tempfile.mkdtemp(prefix="kestrel-test-layout-")
    src = materialize_sources(FixtureSources(spark, SF_SMALL), root, names=("ChangeLog",),
                              partition_by=PRODUCTION_LAYOUT)
    flat = pq_build()
    tables = {n: flat.source(n) for n in SOURCE_NAMES}
    tables["ChangeLog"] = src.table("ChangeLog")
    laid_out = Build(spark, DataFrameSources(spark, tables), fixture_settings())
    for name in ("stg_policy_status_change", "stg_business_close_status_change"):
        p = plan(laid_out.ref(name))
        scan = [ln for ln in p.splitlines() if "PartitionFilters" in ln]
        assert scan and "entityType" in scan[0] and "fieldName" in scan[0], p
        got = laid_out.ref(name).exceptAll(flat.ref(name)).count() + flat.ref(name).exceptAll(laid_out.ref(name)).count()
        assert got == 0


def test_scans_read_only_needed_columns(pq_build):
    p = plan(pq_build().ref("policy_revenue_summary"))
    policy_scans = [ln for ln in p.splitlines() if "ReadSchema" in ln and "saleType" in ln]
    assert policy_scans, p
    # the Policy source has 44 columns; the mart reads a handful
    assert all("cancellationReason" not in ln and "borAwayStatus" not in ln for ln in policy_scans)


@pytest.mark.parametrize("name", ["int_business", "nb_sales_daily", "int_ae_sales_policy", "int_warm_transfer"])
def test_no_window_sort_over_hot_keys(pq_build, name):
    p = plan(pq_build().ref(name))
    assert "Window" not in p


def test_no_cartesian_or_nested_loop_joins(pq_build):
    b = pq_build()
    for name in MODELS:
        p = plan(b.ref(name))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_aggregations_are_partial_before_the_shuffle(pq_build):
    p = plan(pq_build().ref("int_business_warm_transfer"))
    assert "partial_max_by" in p and "partial_count" in p
