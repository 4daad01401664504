"""Top-1-per-key operators (WIN-01, WIN-03, AGG-10) as partial aggregates.

``max_by``/``min_by`` combine map-side, so a key holding a third of all rows is
reduced inside each map task before the shuffle; a ``row_number`` window would
sort that whole key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(order_by: Sequence[str | Column]) -> Column:
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by])


def latest_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
              values: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` tuple (put a
    unique id last so ties resolve the same way every run). NULL values of
    that row are kept (unlike ``array_agg``, which drops them)."""
    values = [c for c in (values or df.columns) if c not in keys]
    picked = F.max_by(F.struct(*values), _order(order_by)).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, "__row.*")


def earliest_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
                values: Sequence[str] | None = None) -> DataFrame:
    values = [c for c in (values or df.columns) if c not in keys]
    picked = F.min_by(F.struct(*values), _order(order_by)).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, "__row.*")


def first_in_group_rows(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column],
                        carry: Sequence[str]) -> DataFrame:
    """For each group, the ``carry`` columns of its first row by ``order_by``
    (one output row per group). Used to turn "row_number() = 1 as a 0/1 flag"
    into an additive row set without a window over hot groups."""
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    picked = F.min_by(F.struct(*[F.col(c) for c in carry]), _order(order_by)).alias("__row")
    return df.groupBy(*key_cols).agg(picked).select("__row.*")
