"""Join helpers (JN-01..JN-08) that keep joins skew-safe at cluster scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def left_join_spread_nulls(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                           spread_by: Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` for a left key that is
    often NULL (half the pings have no business).

    A NULL key never matches, but a plain shuffle join still sends every
    NULL-key row to the same partition. Joining on (key, salt) with
    salt = hash(spread_by) for NULL keys and 0 otherwise spreads those rows over
    all partitions while matching exactly the same pairs; no row is dropped. The
    right side's salt is always 0 too, but written as a remainder of its key's
    hash, which the optimizer does not fold into a constant (a literal would
    leave the join, and the shuffle, on the key alone)."""
    salt = F.when(left[left_key].isNull(), F.xxhash64(*[left[c] for c in spread_by])).otherwise(F.lit(0).cast("bigint"))
    l2 = left.withColumn("__salt_l", salt)
    r2 = right.withColumn("__salt_r", F.pmod(F.xxhash64(right[right_key]), F.lit(1).cast("bigint")))
    out = l2.join(r2, (l2[left_key] == r2[right_key]) & (l2["__salt_l"] == r2["__salt_r"]), "left")
    return out.drop("__salt_l", "__salt_r")


def full_outer_merge(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Chained FULL OUTER JOINs of per-key aggregates that are unique on ``keys``
    (JN-04/JN-05), each on the keys coalesced so far. Real full outer joins
    (not union + group) so NULL keys stay apart exactly as SQL keeps them."""
    out = frames[0]
    for i, nxt in enumerate(frames[1:]):
        ren = {k: f"__k{i}_{k}" for k in keys}
        right = nxt.select(*[F.col(k).alias(ren[k]) for k in keys], *[c for c in nxt.columns if c not in keys])
        cond = None
        for k in keys:
            term = F.col(k) == F.col(ren[k])
            cond = term if cond is None else cond & term
        joined = out.join(right, cond, "full_outer")
        merged = [F.coalesce(F.col(k), F.col(ren[k])).alias(k) for k in keys]
        rest = [c for c in joined.columns if c not in keys and c not in ren.values()]
        out = joined.select(*merged, *rest)
    return out
