"""Helpers shared by the corpus operators: input, lineage cuts, Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; only Spark's own reader opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared checkpoint folder: lineage
    is cut and a lost executor costs no recomputation of what lies before."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffled(df: DataFrame) -> DataFrame:
    """As a join's right side: merged by shuffle, never broadcast. For the many small
    joins of iterative steps, which would otherwise all pass through the driver."""
    return df.hint("merge")


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and text columns alone, under names no other column can clash with."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


#: Spark bounds a batch by 10,000 rows, whatever their size.
BATCH_BYTES = 8 << 20


def give_back() -> None:
    """Return freed memory to the system: Spark uses a worker again for later stages, and
    all that stages have ever freed would add up there."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema) -> DataFrame:
    """``df.mapInArrow`` by batches of bounded bytes, whose workers keep no free memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, budget: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Row slices of ``batch`` that hold about ``budget`` bytes of ``column``
    (a row larger than that is a slice of its own), so that working memory does
    not follow the batch size."""
    import numpy as np

    col = batch.column(column)
    if len(col) == 0:
        return
    ends = np.cumsum(text_lengths(col))
    start = 0
    while start < len(col):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + budget, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_lengths(col: pa.Array):
    """UTF-8 bytes of each text, 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype("int64")


def text_bytes(col: pa.Array):
    """All texts' UTF-8 bytes one after the other as a uint8 array, and each
    text's end in it (null: no bytes)."""
    import numpy as np

    n = text_lengths(col)
    ends = np.cumsum(n)
    if not len(n) or not ends[-1]:
        return np.empty(0, np.uint8), ends
    kind = pa.large_binary() if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else pa.binary()
    flat = col.fill_null("" if not pa.types.is_binary(col.type) else b"").cast(kind)
    width = np.int64 if kind == pa.large_binary() else np.int32
    offs = np.frombuffer(flat.buffers()[1], dtype=width)[flat.offset:flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2], dtype=np.uint8)
    return data[offs[0]:offs[-1]], ends
