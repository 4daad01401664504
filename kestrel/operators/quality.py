"""Declarative data-quality checks (DQ-01..DQ-05).

Each check returns a DataFrame of failing rows / keys; a check passes when it
is empty. ``run_checks`` turns a list of declarations into one summary
DataFrame (one row per check with its failure count), computed by Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values seen more than once (NULLs ignored, as SQL unique tests do)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column).count()
            .where(F.col("count") > 1).withColumnRenamed("count", "n_records"))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose non-NULL value is outside ``values``."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations seen more than once; NULL parts group together."""
    return (df.groupBy(*columns).count().where(F.col("count") > 1)
            .withColumnRenamed("count", "n_records"))


ROW_KINDS = ("not_null", "accepted_values")
KEY_KINDS = ("unique", "unique_combination")


@dataclass(frozen=True)
class Check:
    model: str
    kind: str  # not_null | unique | accepted_values | unique_combination
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()
    severity: str = "error"  # or "warn"

    @property
    def name(self) -> str:
        return f"{self.kind}__{self.model}__{'__'.join(self.columns)}"

    def failures(self, df: DataFrame) -> DataFrame:
        if self.kind == "not_null":
            return not_null(df, self.columns[0])
        if self.kind == "unique":
            return unique(df, self.columns[0])
        if self.kind == "accepted_values":
            return accepted_values(df, self.columns[0], self.values)
        if self.kind == "unique_combination":
            return unique_combination(df, self.columns)
        raise ValueError(self.kind)


def bad_rows(ck: Check) -> Column:
    """Aggregate: rows that fail a row check."""
    col = F.col(ck.columns[0])
    return F.count_if(col.isNull() if ck.kind == "not_null" else col.isNotNull() & ~col.isin(*ck.values))


def _row_checks(model: str, df: DataFrame, cks: Sequence[Check]) -> DataFrame:
    """Every not_null / accepted_values check of a model in one aggregation pass."""
    counts = [bad_rows(ck).alias(f"c{i}") for i, ck in enumerate(cks)]
    return _stack(model, df.agg(*counts), cks)


def _key_checks(model: str, df: DataFrame, cks: Sequence[Check]) -> DataFrame:
    """Every unique / unique_combination check of a model in one grouping-sets
    aggregation (one scan, one shuffle; partial counts combine map-side), then
    one pass counting the duplicated keys of each set."""
    sets = list(dict.fromkeys(tuple(ck.columns) for ck in cks))
    cols = sorted({c for s in sets for c in s})
    grouped = df.groupingSets([list(s) for s in sets], *cols).agg(
        F.count(F.lit(1)).alias("__n"), F.grouping_id().alias("__gid"))

    def gid(s):  # grouping_id bit is 1 for a column not in the set
        return sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s)

    counts = []
    for i, ck in enumerate(cks):
        dup = (F.col("__gid") == gid(ck.columns)) & (F.col("__n") > 1)
        if ck.kind == "unique":  # NULL values are ignored by unique tests
            dup = dup & F.col(ck.columns[0]).isNotNull()
        counts.append(F.count_if(dup).alias(f"c{i}"))
    return _stack(model, grouped.agg(*counts), cks)


def _stack(model: str, one_row: DataFrame, cks: Sequence[Check]) -> DataFrame:
    stacked = F.stack(F.lit(len(cks)), *[x for i, ck in enumerate(cks)
                                         for x in (F.lit(ck.name), F.lit(ck.severity), F.col(f"c{i}"))])
    return one_row.select(stacked.alias("test", "severity", "failures")).select(
        F.lit(model).alias("model"), "test", "severity", "failures")


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL of many frames as a balanced tree: each union call re-checks
    the plan it builds, so a left-deep chain of n unions costs O(n^2).
    ``allow_missing``: a column that a frame lacks is NULL there."""
    frames = list(frames)
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1], allow_missing) if i + 1 < len(frames) else frames[i]
                  for i in range(0, len(frames), 2)]
    return frames[0]


def run_checks(frames: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: model, test, severity, failures, status.

    Each model is read twice whatever its number of checks: one aggregation
    for all row-level checks, one grouping-sets aggregation for all key
    checks. Results are stacked with a union, computed by Spark."""
    parts = []
    by_model: dict[str, list[Check]] = {}
    for ck in checks:
        by_model.setdefault(ck.model, []).append(ck)
    for model, cks in by_model.items():
        row = [ck for ck in cks if ck.kind in ROW_KINDS]
        key = [ck for ck in cks if ck.kind in KEY_KINDS]
        if row:
            parts.append(_row_checks(model, frames[model], row))
        if key:
            parts.append(_key_checks(model, frames[model], key))
    out = union_all(parts)
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return out.withColumn("status", status)
