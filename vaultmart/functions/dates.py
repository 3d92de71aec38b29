"""Type-aware casts used by staging.

Source files carry dates as ``yyyyMMdd``, ``yyyy-MM-dd`` or ``MM/dd/yyyy``
text; a plain cast raises on the first form in Spark 4 (ANSI mode), so
text is parsed with ``try_to_date`` over the accepted formats.  A column
that already has the target type passes through untouched, so a typed
source (Parquet) pays nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted text date formats, in the order tried.
DATE_FORMATS = ("yyyy-MM-dd", "yyyyMMdd", "MM/dd/yyyy")
TIMESTAMP_FORMATS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def as_date(df: DataFrame, name: str) -> Column:
    dt = dtype_of(df, name)
    c = F.col(name)
    if isinstance(dt, T.DateType):
        return c
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    text = F.nullif(F.trim(c.cast("string")), F.lit(""))
    return F.coalesce(*[F.try_to_date(text, fmt) for fmt in DATE_FORMATS])


def as_timestamp(df: DataFrame, name: str) -> Column:
    dt = dtype_of(df, name)
    c = F.col(name)
    if isinstance(dt, T.TimestampType):
        return c
    if isinstance(dt, (T.DateType, T.TimestampNTZType)):
        return c.cast("timestamp")
    text = F.nullif(F.trim(c.cast("string")), F.lit(""))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in TIMESTAMP_FORMATS])


def as_decimal(df: DataFrame, name: str, precision: int = 12, scale: int = 2) -> Column:
    dt = dtype_of(df, name)
    c = F.col(name)
    target = T.DecimalType(precision, scale)
    if dt == target:
        return c
    if isinstance(dt, T.StringType):
        return F.nullif(F.trim(c), F.lit("")).try_cast(target)
    return c.try_cast(target)


def as_int(df: DataFrame, name: str) -> Column:
    dt = dtype_of(df, name)
    c = F.col(name)
    if isinstance(dt, T.IntegerType):
        return c
    if isinstance(dt, T.StringType):
        return F.nullif(F.trim(c), F.lit("")).try_cast("int")
    return c.try_cast("int")
