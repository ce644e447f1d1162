"""Collapsing a slowly changing (Type 2) history to one row per key.

Every operator here is an aggregate that combines before it shuffles: a key
that holds a third of all rows sends one small row per task, not its rows.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_NAMES = ("distinct_values", "first_value", "last_value", "last_non_null_value")


#: A time and its tie share one decimal: the time counts steps of ``_TIE_RANGE``, the tie lies within a step. Both are
#: moved to start from zero. Every long is a tie; times may be 2.7e18 from 1970 (in micro-seconds 85,000 years).
_TIE_SHIFT, _TIE_RANGE = 2**63 + 1, 2**64 + 1
_TIME_SHIFT, _NO_TIME = 27 * 10**17, 54 * 10**17

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _whole_number(df: DataFrame, column: str) -> Column | None:
    """The values of ``column`` as decimals without a fraction in the same
    order, whatever the session's time zone; null for types that do not fit."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.DateType):
        value = F.unix_date(value)
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, T.TimestampNTZType):
        # Put together from parts that no time zone changes; functions on time stamps would look at the session's.
        parts = F.unix_date(value.cast("date")).cast("long") * 24 + F.hour(value)
        seconds = F.expr(f"cast(extract(SECOND FROM `{column}`) * 1000000 AS long)")
        value = (parts * 60 + F.minute(value)) * 60_000_000 + seconds
    elif isinstance(kind, T.DecimalType) and kind.precision <= 18:
        value = value * F.lit(Decimal(10**kind.scale))
    elif isinstance(kind, T.BooleanType):
        value = value.cast("int")
    elif not isinstance(kind, _WHOLE):
        return None
    return value.cast("decimal(20,0)")


def _place(df: DataFrame, order: str, tie: str | None, no_time: int) -> Column | None:
    """Time and tie as one number in their order, null ties first and rows
    without a time at ``no_time``; without a tie the time itself. Numbers can be
    aggregated in a hash table, where a struct would have all rows sorted first.
    Null for types that do not fit: text, and with a tie also whole numbers with
    more digits than an int, and floats.

    Times beyond the range above do not keep their order.
    """
    kind = df.schema[order].dataType
    if not tie:
        return None if isinstance(kind, T.StringType | T.BinaryType) else F.col(order)
    times, ties = _whole_number(df, order), _whole_number(df, tie)
    if times is None or ties is None or isinstance(kind, T.LongType):
        return None
    at = F.coalesce(times + F.lit(Decimal(_TIME_SHIFT)), F.lit(Decimal(no_time))).cast("decimal(19,0)")
    place = F.coalesce(ties + F.lit(Decimal(_TIE_SHIFT)), F.lit(Decimal(0))).cast("decimal(20,0)")
    return (at * F.lit(Decimal(_TIE_RANGE)) + place).cast("decimal(38,0)")


def _oldest(df: DataFrame, order: str, tie: str | None) -> Column:
    """Ordering key of the first version: smallest, unknown times last; ties
    are decided by ``tie``."""
    parts = [F.col(order).isNull().alias("unknown"), F.col(order).alias("at")]
    number = _place(df, order, tie, _NO_TIME)
    return F.struct(*parts, *[F.col(c).alias("tie") for c in (tie,) if c]) if number is None else number


def _newest(df: DataFrame, order: str, tie: str | None) -> Column:
    """Ordering key of the last version: largest, unknown times last; ties as above."""
    parts = [F.col(order).isNotNull().alias("known"), F.col(order).alias("at")]
    number = _place(df, order, tie, 0)
    return F.struct(*parts, *[F.col(c).alias("tie") for c in (tie,) if c]) if number is None else number


def _before() -> Column:
    """Order of the spans of a key by their oldest place, equal ones by value."""
    return F.struct(F.col("oldest").isNull().alias("unknown"), "oldest", "value")


def value_spans(df: DataFrame, key: str, value: str, order: str, tie: str | None = None) -> DataFrame:
    """One row per key and distinct value, with its oldest and newest place in
    the history. All results below are read off this much smaller table."""
    return df.groupBy(F.col(key).alias("key"), F.col(value).alias("value")).agg(
        F.min(_oldest(df, order, tie)).alias("oldest"), F.max(_newest(df, order, tie)).alias("newest")
    )


def consolidate(
    df: DataFrame,
    key: str,
    value: str,
    order: str,
    tie: str | None = None,
    names: tuple[str, str, str, str] = RESULT_NAMES,
    sort: bool = False,
) -> DataFrame:
    """One row per key: number of distinct non-null values, first value, last
    value (null allowed) and last non-null value in the order of ``order``.

    Rows with equal ``order`` are decided by ``tie``, then by the value itself.
    A null key forms one group whose last values are unknown.
    """
    v, oldest, newest = F.col("value"), _before(), F.struct("newest", "value")
    per_key = value_spans(df, key, value, order, tie).groupBy("key").agg(
        F.count(v).alias("n"),
        F.min_by(v, oldest).alias("first"),
        F.max_by(v, newest).alias("last"),
        F.max_by(v, F.when(v.isNotNull(), newest)).alias("last_known"),
    )
    keyed = F.col("key").isNotNull()
    result = per_key.select(
        F.col("key").alias(key),
        F.col("n").alias(names[0]),
        F.col("first").alias(names[1]),
        F.when(keyed, F.col("last")).alias(names[2]),
        F.when(keyed, F.col("last_known")).alias(names[3]),
    )
    return result.orderBy(F.asc_nulls_last(key)) if sort else result


def first_version(df: DataFrame, key: str, value: str, order: str, tie: str, name: str) -> DataFrame:
    """The value of the oldest version of each key, null allowed."""
    spans = value_spans(df, key, value, order, tie).groupBy(F.col("key").alias(key))
    return spans.agg(F.min_by("value", _before()).alias(name))


def latest_version(df: DataFrame, key: str, value: str, order: str, tie: str, name: str) -> DataFrame:
    """The value of the newest version of each key, null allowed."""
    spans = value_spans(df, key, value, order, tie).groupBy(F.col("key").alias(key))
    return spans.agg(F.max_by("value", F.struct("newest", "value")).alias(name))


def latest_non_null(df: DataFrame, key: str, value: str, order: str, tie: str, name: str) -> DataFrame:
    """The newest non-null value of each key; keys without one are absent."""
    return latest_version(df.where(F.col(value).isNotNull()), key, value, order, tie, name)


def distinct_values(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Number of distinct non-null values per key."""
    return df.groupBy(key).agg(F.count_distinct(F.col(value)).alias(name))


#: A sketch has 2 to this power registers, one byte each; its relative standard error is about 1.04 / sqrt(registers).
SKETCH_BITS = 12


def value_sketches(df: DataFrame, key: str, value: str, bits: int = SKETCH_BITS) -> DataFrame:
    """``key`` and a HyperLogLog ``sketch`` of its non-null values.

    For keys with too many distinct values to send them all: whatever a key
    holds, each task sends at most one sketch of it (4 KB). Sketches of parts of
    a history can be stored and merged later.
    """
    kind = df.schema[value].dataType
    fits = isinstance(kind, T.IntegerType | T.LongType | T.StringType | T.BinaryType)
    values = F.col(value) if fits else F.col(value).cast("string")
    return df.groupBy(key).agg(F.hll_sketch_agg(values, F.lit(bits)).alias("sketch"))


def merged_sketches(sketches: DataFrame, key: str) -> DataFrame:
    """One sketch per key from the sketches of several parts."""
    return sketches.groupBy(key).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketched_values(sketches: DataFrame, key: str, name: str) -> DataFrame:
    """Estimated number of distinct values per key; exact or nearly so for a few hundred values."""
    return sketches.select(key, F.hll_sketch_estimate("sketch").alias(name))


def consolidate_joined(
    df: DataFrame,
    key: str,
    value: str,
    order: str,
    tie: str,
    names: tuple[str, str, str, str] = RESULT_NAMES,
) -> DataFrame:
    """The result of :func:`consolidate` put together by left joins of one-row-
    per-key tables. It reads the history four times; use it as a cross-check."""
    summary = distinct_values(df, key, value, names[0]).join(
        first_version(df, key, value, order, tie, names[1]).withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key"))
    )
    last = latest_version(df, key, value, order, tie, names[2])
    last_known = latest_non_null(df, key, value, order, tie, names[3])
    return summary.join(last, key, "left").join(last_known, key, "left").select(key, *names)
