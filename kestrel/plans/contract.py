"""Canonical output types, so a result can be compared across engines.

Every published column is cast to one of: BIGINT, DOUBLE, VARCHAR, BOOLEAN,
DATE, TIMESTAMP (wall clock, no zone) or DECIMAL(38, s) with s <= 8.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPARK_NAME = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
               "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


def canonical_type(dt: T.DataType) -> str:
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL(38,{min(dt.scale, 8)})"
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "BIGINT"
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return "DOUBLE"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dt, T.StringType):
        return "VARCHAR"
    raise TypeError(f"no canonical type for {dt}")


def spark_type(canon: str) -> str:
    return canon.lower() if canon.startswith("DECIMAL") else _SPARK_NAME[canon]


def schema_of(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, canonical_type(f.dataType)) for f in df.schema.fields]


def conform(df: DataFrame, contract: list[tuple[str, str]] | None = None) -> DataFrame:
    """Cast every column to its canonical type (decimals round HALF_UP)."""
    contract = contract or schema_of(df)
    return df.select(*[F.col(n).cast(spark_type(t)).alias(n) for n, t in contract])
