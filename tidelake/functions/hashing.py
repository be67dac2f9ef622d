"""Short content hashes used in manifests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hash12(text: Column) -> Column:
    """First 12 hex digits of SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 12)


def columns_hash(columns: Column) -> Column:
    return hash12(F.array_join(columns, "|"))


def canonical_json(payload: Column) -> Column:
    """Compact JSON that keeps nulls; the caller lists struct fields in alphabetical order."""
    return F.to_json(payload, {"ignoreNullFields": "false"})


def json_hash(payload: Column) -> Column:
    return hash12(canonical_json(payload))


def exact_text(value: Column, kind: T.DataType) -> Column:
    """A value as text that any engine writes alike; values that differ give different texts.

    A double is taken apart by powers of two, which is exact: units of 2**50, the whole rest, and the fraction in units of
    2**-60. Texts carry their length, times are microseconds, null is ``n``.
    """
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        x = value.cast("double")
        high = F.floor(x / F.lit(2.0**50))
        rest = x - high.cast("double") * F.lit(2.0**50)
        parts = F.concat_ws(",", high, F.floor(rest), F.floor((rest - F.floor(rest).cast("double")) * F.lit(2.0**60)))
        text = F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == -float("inf"), "-inf").otherwise(parts)
    elif isinstance(kind, T.TimestampType):
        text = F.unix_micros(value).cast("string")
    elif isinstance(kind, T.StringType):
        text = F.concat_ws(":", F.char_length(value), value)
    else:
        text = value.cast("string")
    return F.when(value.isNull(), "n").otherwise(text)


def value_checksum(fields: list[T.StructField]) -> Column:
    """Order-free checksum of the rows' values (an aggregate): the sum of 60 bits of each row's SHA-256."""
    row = F.concat_ws("|", *[exact_text(F.col(f.name), f.dataType) for f in fields])
    return F.sum(F.conv(F.substring(F.sha2(row, 256), 1, 15), 16, 10).cast("decimal(20,0)"))
