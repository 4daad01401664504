"""Publishing models as tables (SNK-01..SNK-03) with their quality checks (DQ-01..DQ-05).

Every model is written in full to a new versioned folder
``<root>/<model>/run=<id>``; only after every write and check of the run succeeds does
one commit make the run current (``generations``). A reader therefore never sees a
half-written table, all models switch together, and a failed run leaves the
previous version current.
Downstream models of the same run read the just-written table, which also
cuts the lineage (an executor lost later recomputes from that table, not from
the sources). ``root`` must be shared storage on a cluster.

Checks run where they cost least: those of the sources before anything is built; the
row checks of a model (not null, accepted values) are counted while its table is
written; its key checks read only the key columns of the written table. A model that
fails a check of severity error is not built upon.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators.quality import KEY_KINDS, ROW_KINDS, Check, bad_rows, run_checks
from ..session import configure
from ..sources import Sources
from . import generations as G
from .marts import ordered
from .quality_checks import CHECKS
from .registry import MODELS, Build, dependency_order

# Every model is a table. layers=("intermediate", "marts") keeps the staging models as
# plans inside their readers: the sources are then not written a second time.
ALL_LAYERS = ("staging", "intermediate", "marts")
# int_business stages are computed inside int_business; only real models are published.
INTERNAL = {n for n in MODELS if n.startswith("int_business_") or n in (
    "int_ae_sales_snapshot_status", "int_ringba_call_events")}
# Tables with one row per key, stored in buckets of it when there is a catalog: a join or
# aggregation on the key reads them without an exchange. Only such tables: a fact's hot
# key would be one bucket, which no reader can split.
BUCKET_KEYS = {"stg_business": "business_id", "int_business": "business_id", "stg_policy": "policy_id",
               "int_policy_revenue": "policy_id", "int_ae_sales_policy": "policy_id"}
_RUN_ID = re.compile(r"[A-Za-z][A-Za-z0-9_.-]*")


class ChecksFailed(RuntimeError):
    """Quality checks of severity error failed; the run is not published."""


def published_models(layers: Sequence[str] = ALL_LAYERS) -> list[str]:
    return [n for n in dependency_order() if MODELS[n].layer in layers and n not in INTERNAL]


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The current version of ``name`` (None if it was never published). To read several
    models of one generation take them from ``generations.current``."""
    now = G.current(spark, root)
    return now.table(name) if now and name in now.entries else None


def published_build(b: Build, database: str, run_id: str, entries: dict[str, G.Entry]) -> Build:
    """A build that reads the models of one generation from the catalog (buckets included)."""
    def table(name: str) -> DataFrame | None:
        return _read_back(b.spark, database, run_id, entries[name]) if name in entries else None
    return Build(b.spark, b.sources, b.cfg, table)


class _Noted(Sources):
    """Sources that note what is read from them."""

    def __init__(self, sources: Sources):
        super().__init__(sources.spark)
        self.sources, self.noted = sources, []

    def table(self, name: str) -> DataFrame:
        if name not in self.noted:
            self.noted.append(name)
        return self.sources.table(name)


def sources_of(b: Build, models: Sequence[str]) -> list[str]:
    """The sources that the staging models behind ``models`` read."""
    noted = _Noted(b.sources)
    probe = Build(b.spark, noted, b.cfg)
    for n in dependency_order(list(models)):
        if MODELS[n].layer == "staging":
            probe.ref(n)
    return noted.noted


def _read_back(spark: SparkSession, database: str | None, run_id: str, e: G.Entry) -> DataFrame:
    if not e.buckets:
        return spark.read.parquet(e.path)
    return spark.table(f"`{database}`.`{e.table}`").where(f"run = '{run_id}'").drop("run")


def _write(b: Build, df: DataFrame, root: str, name: str, run_id: str, pool: str | None, database: str | None,
           buckets: int, checks: Sequence[Check]) -> tuple[G.Entry, list[tuple], float]:
    """Write one model, counting its row checks on the way, and check the keys of the
    written table. Returns its entry, (check, failures) and seconds."""
    if pool:
        # FAIR scheduling (when enabled): models many others wait on get a larger share
        b.spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
    t0 = time.time()
    key = BUCKET_KEYS.get(name, "") if database and buckets else ""
    e = G.entry(name, f"{root}/{name}/run={run_id}", df.schema, key, buckets if key else 0)
    out = ordered(name, df) if not key else df.repartition(buckets, key)
    by_row = [ck for ck in checks if ck.kind in ROW_KINDS]
    seen = Observation()
    if by_row:
        # Above the sort or exchange, so that every row is counted exactly once.
        out = out.observe(seen, *[bad_rows(ck).alias(f"c{i}") for i, ck in enumerate(by_row)])
    if key:
        # A folder of the run that is no partition yet is invisible: nobody reads this run before its commit.
        out.selectExpr("*", f"'{run_id}' AS run").write.insertInto(G.create_table(b.spark, database, root, e))
    else:
        out.write.mode("errorifexists").parquet(e.path)
    table = _read_back(b.spark, database, run_id, e)
    b.pin(name, table)
    results = [(ck, seen.get[f"c{i}"]) for i, ck in enumerate(by_row)]
    by_key = {ck.name: ck for ck in checks if ck.kind in KEY_KINDS}
    if by_key:
        results += [(by_key[r["test"]], r["failures"]) for r in run_checks({name: table}, list(by_key.values())).collect()]
    return e, results, time.time() - t0


def publish(b: Build, root: str, models: Sequence[str] | None = None, run_id: str | None = None, parallel: int = 4,
            database: str | None = None, checks: bool = True, layers: Sequence[str] = ALL_LAYERS,
            buckets: int | None = None) -> dict[str, float]:
    """Build and publish ``models`` (default: every model of ``layers``) in dependency order.

    A model is submitted as soon as every model it reads is published; up to
    ``parallel`` run at once as separate Spark jobs sharing the cluster (as a
    warehouse build runs several models at once). DataFrames are constructed
    on the calling thread, one at a time, in priority order (Python holds one
    lock anyway): the model most others wait on gets its plan first instead
    of sharing the driver with every leaf model.

    With ``checks``, the declared checks of the sources read, and of every model written,
    run (module docstring); their results are stored beside the tables
    (``check_results``). A failing check of severity error raises ``ChecksFailed``:
    sources before any model is written, a model's before any model that reads it, and
    readers stay on the generation before. A failing warning does not stop the run.

    With ``database``, tables with one row per key are stored in ``buckets`` (default:
    the number of shuffle partitions; 0: none), and the catalog's views move to the run in
    one write. Models that are not rebuilt stay as they were. ``run_id`` begins with a
    letter. Returns seconds per model."""
    configure(b.spark)
    run_id = run_id or time.strftime("r%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:6]
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"run_id {run_id!r}: a letter, then letters, digits, '_', '.' or '-'")
    if buckets is None:
        buckets = int(b.spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = set(models or published_models(layers)) - INTERNAL
    results: list[tuple] = []
    if checks:
        read = {f"source:{n}" for n in sources_of(b, sorted(wanted))}
        declared = {ck.name: ck for ck in CHECKS if ck.model in read}
        if declared:
            frames = {m: b.source(m.split(":", 1)[1]) for m in sorted(read)}
            results = [(declared[r["test"]], r["failures"]) for r in run_checks(frames, list(declared.values())).collect()]
        _stop_on_errors(results)
    todo = [n for n in dependency_order(sorted(wanted)) if n in wanted]
    needs = {n: {d for d in _deps_closure(n) if d in wanted} for n in todo}
    waiting_on = {n: _descendants(n, needs) for n in todo}
    pool = {n: f"w{min(8, 1 + len(waiting_on[n]))}" for n in todo}
    # among ready models, submit the ones most others wait on first
    todo = sorted(todo, key=lambda n: -len(waiting_on[n]))
    done: set[str] = set()
    skipped: set[str] = set()  # a model they read failed a check
    entries: list[G.Entry] = []
    timings: dict[str, float] = {}
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as executor:
        running = {}
        while len(done | skipped) < len(todo):
            for n in todo:
                if n not in done | skipped and n not in running.values() and needs[n] <= done:
                    t0 = time.time()
                    df = b.ref(n)
                    timings[n] = time.time() - t0
                    own = [ck for ck in CHECKS if ck.model == n] if checks else []
                    running[executor.submit(_write, b, df, root, n, run_id, pool[n], database, buckets, own)] = n
            finished, _ = wait(list(running), return_when=FIRST_COMPLETED)
            for f in finished:
                e, found, secs = f.result()
                name = running.pop(f)
                entries.append(e)
                results += found
                timings[name] += secs
                done.add(name)
                if any(n and ck.severity == "error" for ck, n in found):
                    skipped |= waiting_on[name]
    if checks and results:
        rows = [(ck.model, ck.name, ck.severity, n, "pass" if not n else "warn" if ck.severity == "warn" else "fail") for ck, n in results]
        b.spark.createDataFrame(rows, "model string, test string, severity string, failures bigint, status string") \
            .coalesce(1).write.mode("errorifexists").parquet(f"{root}/_checks/run={run_id}")
    _stop_on_errors(results)
    G.commit(b.spark, root, run_id, entries, database)
    return timings


def check_results(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """model, test, severity, failures, status of every check of a run, published or not."""
    return spark.read.parquet(f"{root}/_checks/run={run_id}")


def _stop_on_errors(results: Sequence[tuple]) -> None:
    failed = sorted(ck.name for ck, n in results if n and ck.severity == "error")
    if failed:
        raise ChecksFailed(", ".join(failed))


def _descendants(name: str, needs: dict[str, set[str]]) -> set[str]:
    out: set[str] = set()
    frontier = [name]
    while frontier:
        cur = frontier.pop()
        for n, deps in needs.items():
            if cur in deps and n not in out:
                out.add(n)
                frontier.append(n)
    return out


def _deps_closure(name: str) -> set[str]:
    """Published models ``name`` reads, looking through internal stages."""
    out: set[str] = set()
    for d in MODELS[name].deps:
        out |= _deps_closure(d) if d in INTERNAL else {d}
    return out
