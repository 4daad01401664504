"""Benchmark: full build of every model, plus headline marts run end to end.

Reads the driver tables at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line.

1. source prep (reported as ``source_prep_sec``, not in ``value``): the 19
   application tables are derived from the driver tables and written once as
   Parquet, the state production starts from (ChangeLog partitioned by
   entityType / fieldName, ``PRODUCTION_LAYOUT``);
2. a full build as the reference runs it: all 36 models (20 staging, 7 intermediate, 9
   marts) written as Parquet tables with all 119 checks, sources included, before the
   commit. The first build (``cold_build_sec``) pays JVM JIT and code-generation warm-up;
   it is followed by $BENCH_WARM_RUNS (default 3) warm builds, each with fresh plans and
   nothing cached or reused, and ``value`` is their median (``warm_build_sec`` lists
   them all). ``marts_build_sec`` is one more build of the 16 intermediate and mart models
   alone, staging inside their plans and without checks (the ``value`` of earlier rounds);
3. ``queries``: each headline mart run end to end from the source tables
   (nothing reused), executed with the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from kestrel.plans import Build  # noqa: E402
from kestrel.plans.publish import check_results, publish  # noqa: E402
from kestrel.session import local_session  # noqa: E402
from kestrel.settings import fixture_settings  # noqa: E402
from kestrel.sources import PRODUCTION_LAYOUT, FixtureSources, materialize_sources  # noqa: E402

HEADLINE = ("wt_tracker_daily", "wt_pings_daily", "nb_sales_daily", "business_funnel_daily",
            "ae_performance_monthly", "policy_revenue_summary", "ringba_calls_daily", "ringba_ae_calls_daily")


def output_root(spark) -> str:
    """A new folder for this run's tables: under $BENCH_OUT_DIR, else under the
    shared folder the cluster names in ``spark.checkpoint.dir``; a local scratch
    folder only when neither is set (a local run)."""
    base = os.environ.get("BENCH_OUT_DIR") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/kestrel-bench-{time.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:6]}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set BENCH_OUT_DIR or spark.checkpoint.dir: executors share no local folder")
    return tempfile.mkdtemp(prefix="kestrel-bench-")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")  # summarise with tools/eventlog.py
    if log_dir and "://" not in log_dir:
        os.makedirs(log_dir, exist_ok=True)  # Spark needs the folder to exist
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir} if log_dir else None
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="kestrel-bench", extra_conf=extra)
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # JVM warm-up, not timed

    out_root = output_root(spark)
    t0 = time.time()
    sources = materialize_sources(FixtureSources(spark, sf_dir), f"{out_root}/sources", records_per_file=20_000,
                                  partition_by=PRODUCTION_LAYOUT)
    source_prep = time.time() - t0

    parallel = int(os.environ.get("BENCH_PARALLEL", "8"))
    t0 = time.time()
    publish(Build(spark, sources, fixture_settings()), f"{out_root}/cold", parallel=parallel)
    cold_build = time.time() - t0

    warm: list[float] = []
    per_model: dict[str, float] = {}
    for i in range(max(1, int(os.environ.get("BENCH_WARM_RUNS", "3")))):
        t0 = time.time()
        per_model = publish(Build(spark, sources, fixture_settings()), f"{out_root}/warm{i}", run_id=f"warm{i}", parallel=parallel)
        warm.append(round(time.time() - t0, 3))
    full_build = statistics.median(warm)
    checks = check_results(spark, f"{out_root}/warm0", "warm0").count()

    t0 = time.time()
    publish(Build(spark, sources, fixture_settings()), f"{out_root}/marts", parallel=parallel, checks=False,
            layers=("intermediate", "marts"))
    marts_build = time.time() - t0

    queries: dict[str, float] = {}
    for name in HEADLINE:
        fresh = Build(spark, sources, fixture_settings())
        t1 = time.time()
        fresh.ref(name).write.format("noop").mode("overwrite").save()
        queries[name] = round(time.time() - t1, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "full_build_all_models", "value": round(full_build, 3), "unit": "sec",
        "queries": queries, "cold_build_sec": round(cold_build, 3), "warm_build_sec": warm,
        "tables": len(per_model), "checks": checks, "marts_build_sec": round(marts_build, 3),
        "source_prep_sec": round(source_prep, 3),
        "build_model_sec": {k: round(v, 3) for k, v in per_model.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
