"""Generations of published tables (SNK-02): one commit moves all of them.

Every model lies in versioned folders ``<root>/<model>/run=<id>``. A generation maps
each model to one folder; its manifest ``<root>/_manifest/run=<id>`` is written last and
lists models that were not rebuilt at the folder they had before, so the newest
manifest always names every model.

In the catalog a model's folders are the partitions of one table
``<model>__<shape>`` (``run`` is the partition column, the shape stands for columns and
buckets), and readers use the view ``<model>``: that table where ``run`` is the one
value of the view ``current_generation``. Replacing that one-row view is a single
catalog write and moves every name at once. A query resolves it once, however many
models it reads, so it never mixes two generations; the value is a literal after
planning, so only one partition is listed and read.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTER = "current_generation"
_MANIFEST = "model string, path string, committed_at bigint, shape string, columns string, bucket_by string, buckets int"


@dataclass(frozen=True)
class Entry:
    """One model of a generation. shape: its table in the catalog; buckets = 0: not bucketed."""

    model: str
    path: str
    shape: str
    columns: str
    bucket_by: str = ""
    buckets: int = 0

    @property
    def table(self) -> str:
        return f"{self.model}__{self.shape}"


@dataclass(frozen=True)
class Generation:
    """A complete run; ``table`` reads all its models consistently, whatever is published meanwhile."""

    spark: SparkSession
    run: str
    committed_at: int  # microseconds
    entries: dict[str, Entry]

    def table(self, model: str) -> DataFrame:
        return self.spark.read.parquet(self.entries[model].path)


def _ddl(kind: T.DataType) -> str:
    # "timestamp" in SQL text means the session's choice; an instant stays one.
    return "timestamp_ltz" if isinstance(kind, T.TimestampType) else kind.simpleString()


def entry(model: str, path: str, schema: T.StructType, bucket_by: str = "", buckets: int = 0) -> Entry:
    columns = ", ".join(f"`{f.name}` {_ddl(f.dataType)}" for f in schema.fields)
    shape = hashlib.sha256(f"{columns}|{bucket_by}|{buckets}".encode()).hexdigest()[:8]
    return Entry(model, path, shape, columns, bucket_by, buckets)


def generations(spark: SparkSession, root: str) -> list[Generation]:
    """All complete generations, newest first."""
    try:
        rows = spark.read.schema(f"{_MANIFEST}, run string").parquet(f"{root}/_manifest").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    runs: dict[str, dict[str, Entry]] = {}
    at: dict[str, int] = {}
    for r in rows:
        runs.setdefault(r["run"], {})[r["model"]] = Entry(r["model"], r["path"], r["shape"], r["columns"], r["bucket_by"], r["buckets"])
        at[r["run"]] = r["committed_at"]
    return [Generation(spark, run, at[run], runs[run]) for run in sorted(runs, key=lambda x: (at[x], x), reverse=True)]


def current(spark: SparkSession, root: str) -> Generation | None:
    """The generation committed last."""
    found = generations(spark, root)
    return found[0] if found else None


def commit(spark: SparkSession, root: str, run_id: str, entries: Sequence[Entry], database: str | None = None) -> Generation:
    """Make ``entries`` and, for all other models, what the generation before had the
    current generation. One publisher at a time: two commits at once keep the later one."""
    before = current(spark, root)
    whole = {**(before.entries if before else {}), **{e.model: e for e in entries}}
    committed_at = time.time_ns() // 1000
    if database:
        prepare(spark, database, root, run_id, whole)
    rows = [(e.model, e.path, committed_at, e.shape, e.columns, e.bucket_by, e.buckets) for e in whole.values()]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{root}/_manifest/run={run_id}")
    if database:
        switch(spark, database, run_id, committed_at)
    return Generation(spark, run_id, committed_at, whole)


# --- catalog -----------------------------------------------------------------

def create_table(spark: SparkSession, database: str, root: str, e: Entry) -> str:
    """The catalog table whose partitions are the model's folders of this shape."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    name = f"`{database}`.`{e.table}`"
    bucketed = f"CLUSTERED BY (`{e.bucket_by}`) SORTED BY (`{e.bucket_by}`) INTO {e.buckets} BUCKETS" if e.buckets else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({e.columns}, run STRING) USING parquet PARTITIONED BY (run) {bucketed} "
              f"LOCATION '{root}/{e.model}'")
    return name


def prepare(spark: SparkSession, database: str, root: str, run_id: str, entries: dict[str, Entry]) -> None:
    """Everything a switch to ``run_id`` needs, invisible to readers: its partitions, and
    views that know every shape in use. A view is only replaced when its columns change."""
    for e in entries.values():
        name = create_table(spark, database, root, e)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (run = '{run_id}') LOCATION '{e.path}'")
    if not spark.catalog.tableExists(f"{database}.{POINTER}"):
        spark.sql(f"CREATE VIEW `{database}`.`{POINTER}` AS {_pointer('', 0)}")
    for e in entries.values():
        define_view(spark, database, e)


def define_view(spark: SparkSession, database: str, e: Entry, only: bool = False) -> None:
    """The reader's view of a model: with ``only`` one shape, else also rows of
    generations that have another shape, in the columns of this one."""
    have = {r["tableName"] for r in spark.sql(f"SHOW TABLES IN `{database}`").collect()}
    shapes = [e.table] + ([] if only else sorted(t for t in have if t.startswith(f"{e.model}__") and t != e.table))
    view = f"`{database}`.`{e.model}`"
    if e.model in have:
        known = spark.sql(f"SHOW TBLPROPERTIES {view}('kestrel.tables')").first()["value"]
        if known == ",".join(shapes):
            return
    wanted = spark.table(f"`{database}`.`{e.table}`").schema.fields[:-1]
    branches = []
    for table in shapes:
        old = {f.name: f.dataType for f in spark.table(f"`{database}`.`{table}`").schema.fields}
        cols = [f"`{f.name}`" if old.get(f.name) == f.dataType else
                f"try_cast({f'`{f.name}`' if f.name in old else 'NULL'} AS {_ddl(f.dataType)}) AS `{f.name}`" for f in wanted]
        branches.append(f"SELECT {', '.join(cols)} FROM `{database}`.`{table}` WHERE run = (SELECT run FROM `{database}`.`{POINTER}`)")
    body, tables = " UNION ALL ".join(branches), f"('kestrel.tables' = '{','.join(shapes)}')"
    if e.model in have:
        spark.sql(f"ALTER VIEW {view} AS {body}")
        spark.sql(f"ALTER VIEW {view} SET TBLPROPERTIES {tables}")
    else:
        spark.sql(f"CREATE VIEW {view} TBLPROPERTIES {tables} AS {body}")


def _pointer(run_id: str, committed_at: int) -> str:
    at = dt.datetime.fromtimestamp(committed_at / 1e6, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return f"SELECT '{run_id}' AS run, TIMESTAMP_NTZ '{at}' AS committed_at"


def switch(spark: SparkSession, database: str, run_id: str, committed_at: int) -> None:
    """Move every model's view to ``run_id``: one catalog write. (ALTER VIEW replaces the definition
    in place; CREATE OR REPLACE would drop the view first, and readers could miss it.)"""
    spark.sql(f"ALTER VIEW `{database}`.`{POINTER}` AS {_pointer(run_id, committed_at)}")


# --- retention ---------------------------------------------------------------

def retire(spark: SparkSession, root: str, keep: int = 2, grace_seconds: float = 3600.0, database: str | None = None) -> list[str]:
    """Remove generations beyond the newest ``keep``, each once the one after it has been
    current for ``grace_seconds`` (queries that began on it have ended). A folder that a
    kept generation still names stays. Returns the removed runs, oldest first.

    The manifest goes first, then the catalog's partitions, then the files: a stop in
    between leaves unnamed files, never a generation without its files."""
    if keep < 1:
        raise ValueError("keep must be at least 1: the current generation is never removed")
    found = generations(spark, root)
    now = time.time_ns() // 1000
    doomed = [g for k, g in enumerate(found) if k >= keep and now - found[k - 1].committed_at >= grace_seconds * 1e6]
    kept = [g for g in found if g not in doomed]
    alive = {e.path for g in kept for e in g.entries.values()}
    for g in reversed(doomed):
        _delete(spark, f"{root}/_manifest/run={g.run}")
        for e in g.entries.values():
            if database and spark.catalog.tableExists(f"{database}.{e.table}"):
                spark.sql(f"ALTER TABLE `{database}`.`{e.table}` DROP IF EXISTS PARTITION (run = '{g.run}')")
        for path in sorted({e.path for e in g.entries.values()} - alive):
            _delete(spark, path)
    if database and doomed:
        used = {e.table for g in kept for e in g.entries.values()}
        for e in kept[0].entries.values():
            tables = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN `{database}` LIKE '{e.model}__*'").collect()]
            gone = [t for t in tables if t.startswith(f"{e.model}__") and t not in used]
            if gone:
                define_view(spark, database, e, only=not [t for t in tables if t in used and t != e.table])
                for t in gone:
                    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{t}`")
    return [g.run for g in reversed(doomed)]


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
