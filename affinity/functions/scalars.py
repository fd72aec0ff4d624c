"""Scalar column expressions. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Word size and multiplier of the 32-bit string hash.
_HASH_WORD = 4294967296
_HASH_HALF = 2147483648
_HASH_FACTOR = 31
# Epoch values above this are milliseconds.
_MILLIS_ABOVE = 100_000_000_000


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since 1970 of a timestamp column.

    Zone-less timestamps are read as UTC, whatever the session zone is.
    """
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        day = F.unix_date(F.to_date(c)).cast("long") * 86400
        return day + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    return F.unix_seconds(c)


def to_seconds(ts: Column) -> Column:
    """Epoch seconds from a value that may be in milliseconds."""
    return F.when(ts > _MILLIS_ABOVE, F.floor(ts / 1000)).otherwise(ts).cast("long")


def year_month(ts: Column) -> Column:
    """Epoch seconds to the integer yyyyMM of the UTC month."""
    day = F.date_from_unix_date(F.floor(ts / 86400).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


def score_normalize(score: Column) -> Column:
    """Ten-star score to five stars, two decimals."""
    return F.round(score / 2, 2)


def tags_to_text(tags: Column) -> Column:
    return F.translate(tags, "|", " ")


def java_string_hash(s: Column) -> Column:
    """Signed 32-bit polynomial hash over the UTF-16 units of a string."""
    units = F.regexp_extract_all(F.hex(F.encode(s, "UTF-16BE")), F.lit("(.{4})"), F.lit(1))
    h = F.aggregate(
        units,
        F.lit(0).cast("long"),
        lambda acc, u: F.pmod(acc * _HASH_FACTOR + F.conv(u, 16, 10).cast("long"),
                              F.lit(_HASH_WORD).cast("long")),
    )
    return F.when(h >= _HASH_HALF, h - _HASH_WORD).otherwise(h)


def recode_latin1_utf8(s: Column) -> Column:
    """Repair text whose UTF-8 bytes were read as ISO-8859-1."""
    return F.decode(F.encode(s, "ISO-8859-1"), "UTF-8")


def cooccurrence_sim(co: Column, n1: Column, n2: Column) -> Column:
    return co / F.sqrt(n1.cast("double") * n2)


def cosine_sim(a: Column, b: Column) -> Column:
    """Cosine of two numeric arrays; NULL when either has no length."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(
            F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")),
            F.lit(0.0), lambda acc, v: acc + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
