"""As-of lookups (JN-06, JN-07): for each left row, the last right row before
its instant and the first right row at or after it, matched on a key.

``asof_scan`` is the general one. Both sides are one table, cut into cells: a key's
stretch of time. Each cell is one ordered pass that carries the last state along; what the
cells before and after it hold comes in as two more rows, from a small table of one
row per key and cell. So a key that holds a third of the log is as many tasks as it
has cells, a key may have many instants, and the log is reduced to one row per (key,
instant) in the map tasks. Nothing is joined on the key alone.

``asof_both`` takes one instant per key and needs no order: one equi-join and two
filtered ``max_by`` / ``min_by``. Where all instants lie on a grid (month ends), the log is
first reduced to one row per key and grid cell, by partial aggregates, and only
those rows are joined.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_both(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
              right_order_tiebreak: str, before_value: str, after_value: str,
              before_alias: str = "before_value", after_alias: str = "after_value",
              strict_before: bool = True, grid: Callable[[Column], Column] | None = None) -> DataFrame:
    """Return ``key, before_alias, after_alias, has_before, has_after`` for
    every ``left`` key that has at least one ``right`` row.

    before: ``before_value`` of the latest right row with ts < left ts
    (``<=`` when ``strict_before`` is False); after: ``after_value`` of the
    earliest right row with ts >= left ts. Ties on ts resolve by
    ``right_order_tiebreak``. ``left`` must be unique on ``key``. ``grid`` numbers the
    cells between the instants a left row can have: every left instant is the first
    of its cell (``strict_before`` only)."""
    l2 = left.select(F.col(key).alias("__k"), F.col(left_ts).alias("__snap"))
    r2 = right.select(F.col(key).alias("__k"), F.col(right_ts).alias("__ts"),
                      F.col(right_order_tiebreak).alias("__id"),
                      F.col(before_value).alias("__bv"), F.col(after_value).alias("__av"))
    order = F.struct("__ts", "__id")
    if grid is not None:
        if not strict_before:
            raise ValueError("a grid needs strict_before: a right row at an instant comes after it")
        l2 = l2.withColumn("__snap", grid(F.col("__snap")))
        r2 = r2.groupBy("__k", grid(F.col("__ts")).alias("__ts")).agg(
            F.max_by("__bv", order).alias("__bv"), F.min_by("__av", order).alias("__av")).withColumn("__id", F.lit(0))
    j = r2.join(l2, "__k", "inner")
    is_before = (F.col("__ts") < F.col("__snap")) if strict_before else (F.col("__ts") <= F.col("__snap"))
    return j.groupBy(F.col("__k").alias(key)).agg(
        F.max_by("__bv", F.when(is_before, order)).alias(before_alias),
        F.min_by("__av", F.when(~is_before, order)).alias(after_alias),
        F.max(F.when(is_before, F.lit(True))).alias("has_before"),
        F.max(F.when(~is_before, F.lit(True))).alias("has_after"),
    )


def time_splits(log: DataFrame, ts: str, n: int) -> list[int]:
    """Up to ``n`` - 1 instants (microseconds) that cut the rows of ``log`` into equally large
    stretches of time: the cells for a log that lies in few months. One aggregation, at most ``n`` values."""
    at = F.percentile_approx(F.unix_micros(F.col(ts).cast("timestamp_ltz")), [k / n for k in range(1, n)], 100 * n)
    return sorted(set(log.agg(at.alias("at")).first()["at"] or []))


def _cell(ts: Column, splits: Sequence[int] | None) -> Column:
    if splits is None:
        return F.date_diff(F.trunc(ts, "month"), F.lit("1970-01-01").cast("date"))
    if not splits:
        return F.lit(0)
    micros = F.unix_micros(ts.cast("timestamp_ltz"))
    return F.size(F.filter(F.array(*[F.lit(s).cast("bigint") for s in splits]), lambda s: s <= micros))


def asof_scan(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
              right_order_tiebreak: str, before_value: str, after_value: str,
              before_alias: str = "before_value", after_alias: str = "after_value",
              strict_before: bool = True, splits: Sequence[int] | None = None) -> DataFrame:
    """Return every ``left`` row, all its columns, with before_alias, after_alias,
    has_before, has_after.

    before: ``before_value`` of the latest right row with ts < left ts (``<=`` when
    ``strict_before`` is False); after: ``after_value`` of the earliest right row
    that is not before. Ties on ts resolve by ``right_order_tiebreak``: the largest
    before, the smallest after. A key may have many left rows, at equal instants too.
    Left rows without a key or an instant have neither; right rows without either are
    no one's. ``splits``: instants (microseconds) between the cells, as by
    ``time_splits``; months by default."""
    def state(column: str) -> Column:
        return F.struct(F.col(column).alias("v"))

    log = right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull()) \
        .select(F.col(key).alias("__k"), F.col(right_ts).alias("__ts"), F.col(right_order_tiebreak).alias("__id"),
                F.col(before_value).alias("__b"), F.col(after_value).alias("__a")) \
        .groupBy("__k", "__ts").agg(F.max_by(state("__b"), "__id").alias("__b"), F.min_by(state("__a"), "__id").alias("__a")) \
        .select("__k", _cell(F.col("__ts"), splits).alias("__cell"), F.lit(0).alias("__pos"), "__ts",
                F.lit(1 if strict_before else 0).alias("__side"), "__b", "__a")
    whole = F.struct(*[F.col(c) for c in left.columns])
    dated = F.col(key).isNotNull() & F.col(left_ts).isNotNull()
    asked = left.where(dated).select(
        F.col(key).alias("__k"), _cell(F.col(left_ts), splits).alias("__cell"), F.lit(0).alias("__pos"), F.col(left_ts).alias("__ts"),
        F.lit(0 if strict_before else 1).alias("__side"), whole.alias("__row"))

    # One row per key and cell: the states it begins and ends with; carried to the cells that are asked.
    ends = log.groupBy("__k", "__cell").agg(F.max_by("__b", "__ts").alias("__b"), F.min_by("__a", "__ts").alias("__a")) \
        .unionByName(asked.select("__k", "__cell").distinct().withColumn("__asked", F.lit(True)), allowMissingColumns=True) \
        .groupBy("__k", "__cell").agg(F.first("__b", True).alias("__b"), F.first("__a", True).alias("__a"), F.max("__asked").alias("__asked"))
    cells = Window.partitionBy("__k").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("__before", F.last("__b", True).over(cells.orderBy("__cell"))) \
        .withColumn("__after", F.last("__a", True).over(cells.orderBy(F.desc("__cell")))).where("__asked")
    carry = carried.where("__before IS NOT NULL").select("__k", "__cell", F.lit(-1).alias("__pos"), F.col("__before").alias("__b")) \
        .unionByName(carried.where("__after IS NOT NULL").select("__k", "__cell", F.lit(1).alias("__pos"), F.col("__after").alias("__a")),
                     allowMissingColumns=True)

    rows = asked.unionByName(log, allowMissingColumns=True).unionByName(carry, allowMissingColumns=True)
    cell = Window.partitionBy("__k", "__cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    order = ["__pos", "__ts", "__side"]
    passed = rows.withColumn("__before", F.last("__b", True).over(cell.orderBy(*order))) \
        .withColumn("__after", F.last("__a", True).over(cell.orderBy(*[F.desc(c) for c in order]))).where("__row IS NOT NULL")
    out = passed.select("__row.*", F.col("__before.v").alias(before_alias), F.col("__after.v").alias(after_alias),
                        F.col("__before").isNotNull().alias("has_before"), F.col("__after").isNotNull().alias("has_after"))
    never = left.where(~dated).select("*", F.lit(False).alias("has_before"), F.lit(False).alias("has_after"))
    return out.unionByName(never, allowMissingColumns=True)
