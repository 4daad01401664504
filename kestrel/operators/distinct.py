"""Exact distinct counts that merge (AGG-03): bitmaps per fine group, united for coarser ones.

``count(DISTINCT ...)`` cannot be merged: a month's count is not the sum of its days',
and two distinct counts in one aggregation make Spark send every row once for each
(Expand). A bitmap can: it holds the ids of a group, 32,768 numbers to a piece, and a coarser
group's bitmap is the union of its parts'. So daily bitmaps are built once and any roll-up or
filter over the fine keys counts from them.

Ids must be whole numbers. A piece with few ids in it holds them as a list of places and only a
full one as 4 KB of bits, so bitmaps are never more than a few bytes for each id of a group, however
far apart its ids lie. Rows that repeat are dropped in the map tasks, what is sorted are places, and the
bits are built one piece at a time. ``dense_ids`` numbers any column from 1, without a global sort
in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

PIECE, PLACE, BITMAP = "__piece", "__place", "__ids"
FEW = 1024  # as many places take the 4 KB of a piece's bits


def dense_ids(values: DataFrame, column: str, alias: str = "id") -> DataFrame:
    """(column, alias): the distinct non-null values numbered 1, 2, ... in their order.
    Values are ordered by ranges; each range's first number comes from the sizes of
    those before it (one row per partition)."""
    spread = values.select(column).where(F.col(column).isNotNull()).distinct().repartitionByRange(F.col(column)) \
        .sortWithinPartitions(column)
    ensure_checkpoint_dir(values.sparkSession)
    # Written once: the numbers must come from the partitions whose sizes were counted.
    at = spread.select(column, F.spark_partition_id().alias("__part"),
                       F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__place")).checkpoint()
    sizes = {r["__part"]: r["n"] for r in at.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a partition
    first, starts = 1, {}
    for part in sorted(sizes):
        starts[part] = first
        first += sizes[part]
    if not starts:
        return at.select(column, F.lit(None).cast("bigint").alias(alias))
    start = F.element_at(F.create_map(*[F.lit(x).cast(t) for p, s in starts.items() for x, t in ((p, "int"), (s, "bigint"))]), F.col("__part"))
    return at.select(column, (start + F.col("__place")).alias(alias))


def distinct_bitmaps(df: DataFrame, keys: Sequence[str | Column], id_col: str) -> DataFrame:
    """keys, piece, bitmap: the non-null ids of each group. A bitmap is (ids, bits): the
    places of a piece with under ``FEW`` ids, else its 4 KB of bits.

    The groups meet by key and piece before bits are built, as places without repeats:
    32,768 at most, whatever rows a hot group has."""
    names = [F.col(k) if isinstance(k, str) else k for k in keys]
    places = df.where(F.col(id_col).isNotNull()).select(
        *names, F.bitmap_bucket_number(F.col(id_col)).alias(PIECE), F.bitmap_bit_position(F.col(id_col)).cast("int").alias(PLACE)).distinct()
    group = [f"`{n}`" for n in places.columns[:-1]]
    held = places.repartition(*group).groupBy(*group).agg(
        F.collect_list(PLACE).alias("ids"), F.bitmap_construct_agg(F.col(PLACE).cast("bigint")).alias("bits"))
    few = F.size("ids") < FEW
    return held.select(*group, F.struct(F.when(few, F.col("ids")).alias("ids"), F.when(~few, F.col("bits")).alias("bits")).alias(BITMAP))


def _words(bitmap: Column) -> Column:
    """The parts of a bitmap, 32 places each: (word, the bits set in it)."""
    def of_place(p):
        at = F.pmod(p, F.lit(32))  # the bits of a byte are counted from the least, bytes from the left
        return F.struct((p / F.lit(32)).cast("int").alias("word"), F.call_function(
            "shiftleft", F.lit(1).cast("bigint"), (F.lit(24) - (at - F.pmod(at, F.lit(8))) + F.pmod(at, F.lit(8))).cast("int")).alias("bits"))

    def of_word(w):
        return F.struct(w.alias("word"), F.conv(F.hex(F.substring(bitmap["bits"], w * 4 + 1, F.lit(4))), 16, 10).cast("bigint").alias("bits"))

    return F.when(bitmap["ids"].isNotNull(), F.transform(bitmap["ids"], of_place)) \
        .otherwise(F.transform(F.sequence(F.lit(0), F.lit(1023)), of_word))


def merged_counts(bitmaps: DataFrame, keys: Sequence[str | Column], counts: dict[str, Column | None]) -> DataFrame:
    """keys and one exact distinct count for each entry of ``counts``: over all finer groups
    (None) or those where a condition on their keys holds; 0 where none does. All counts come
    from one union of bitmaps, word by word and at first in the map tasks, without a row being sent twice."""
    names = [F.col(k) if isinstance(k, str) else k for k in keys]
    own = [f"__k{i}" for i in range(len(names))]
    chosen = [f"__c{i}" for i in range(len(counts))]
    conds = [(F.lit(True) if cond is None else cond).alias(h) for h, cond in zip(chosen, counts.values(), strict=True)]
    words = bitmaps.select(*[n.alias(o) for n, o in zip(names, own, strict=True)], *conds, PIECE, F.explode(_words(F.col(BITMAP))).alias("__w"))
    united = words.groupBy(*own, PIECE, "__w.word").agg(
        *[F.bit_or(F.when(F.col(h), F.col("__w.bits")).otherwise(F.lit(0).cast("bigint"))).alias(a) for a, h in zip(counts, chosen, strict=True)])
    out = bitmaps.select(*names).schema.names
    return united.groupBy(*own).agg(*[F.sum(F.bit_count(F.col(f"`{a}`")).cast("bigint")).alias(a) for a in counts]).toDF(*out, *counts)
