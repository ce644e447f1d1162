"""Shaping records: defaults, the history form, object keys and payloads."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronicle.functions.dates import cast_date, parse_date, stamp_date
from chronicle.functions.text import (
    json_document,
    json_document_size,
    or_default,
    prefix,
    safe_name,
)
from chronicle.schemas import RECORD_FIELDS


def with_defaults(df: DataFrame, run_ts: str) -> DataFrame:
    """The six record fields in fixed order; missing columns count as null,
    name and URL default to ``''`` and the time stamp to ``run_ts``."""
    defaults = {"full_name": "", "source_url": "", "scraped_at": run_ts}
    fields = []
    for f in RECORD_FIELDS:
        value = F.col(f) if f in df.columns else F.lit(None).cast("string")
        fields.append((F.coalesce(value, F.lit(defaults[f])) if f in defaults else value).alias(f))
    return df.select(*fields)


def typed_records(df: DataFrame) -> DataFrame:
    """Add typed columns beside the text ones, null where the text cannot be
    read: ``birth_date``, ``death_date`` and ``collected_at``."""
    return df.withColumns(
        {
            "birth_date": parse_date(F.col("date_of_birth")),
            "death_date": parse_date(F.col("date_of_death")),
            "collected_at": F.try_to_timestamp(F.col("scraped_at")),
        }
    )


def history_date(raw: Column, strict: bool) -> Column:
    """A history date from text. ``strict`` stops the job on text that is not a
    date, ``''`` included; otherwise such text gives null."""
    day = cast_date(raw)
    if not strict:
        return day
    bad = raw.isNotNull() & day.isNull()
    message = F.concat(F.lit("not a date: '"), raw, F.lit("'"))
    return F.when(bad, F.raise_error(message).cast("date")).otherwise(day)


def typed_history(df: DataFrame, strict: bool = True) -> DataFrame:
    """History rows with text dates as typed rows of the history schema."""
    return df.select(
        F.col("person_id").cast("long").alias("person_id"),
        *[F.col(c).cast("string").alias(c) for c in ("name", "state", "city")],
        history_date(F.col("valid_from").cast("string"), strict).alias("valid_from"),
        history_date(F.col("valid_to").cast("string"), strict).alias("valid_to"),
    )


def history_rejects(df: DataFrame) -> DataFrame:
    """The rows whose dates the lenient form of ``typed_history`` blanks out."""
    def bad(c):
        text = F.col(c).cast("string")
        return text.isNotNull() & cast_date(text).isNull()

    return df.where(bad("valid_from") | bad("valid_to"))


def record_to_history(df: DataFrame, key: Column, name: Column | None = None) -> DataFrame:
    """Each record as one open version that starts at the date of death, or on
    the day it was collected. Dates stay text; see ``typed_history``."""
    collected_on = prefix(F.coalesce(F.col("scraped_at"), F.lit("")), 10)
    nothing = F.lit(None).cast("string")
    shown = F.coalesce(F.col("full_name"), F.lit("Unknown")) if name is None else name
    return df.select(
        key.alias("person_id"),
        shown.alias("name"),
        nothing.alias("state"),
        nothing.alias("city"),
        or_default(F.col("date_of_death"), collected_on).alias("valid_from"),
        nothing.alias("valid_to"),
    )


def record_key(url: Column) -> Column:
    """A stable key of a record, the same on every run."""
    return F.xxhash64(url)


def collected_day(stamp: Column, run_ts: str) -> Column:
    """The date a record is filed under: the one written in its time stamp, or
    the day of the run where the stamp cannot be read."""
    return F.coalesce(stamp_date(stamp), F.to_date(F.lit(run_ts[:10])))


def object_suffix(*parts: Column) -> Column:
    """Sixteen hex digits that tell apart objects of the same name. Derived
    from the record, so that a rerun or a retried task gives the same key."""
    return F.lpad(F.hex(F.xxhash64(*parts)), 16, "0")


def object_key(source: str, day: Column, name: Column, suffix: Column) -> Column:
    """``raw/<source>/YYYY/MM/DD/<name>_<suffix>.json``."""
    return F.concat(
        F.lit(f"raw/{source}/"),
        F.date_format(day, "yyyy/MM/dd"),
        F.lit("/"),
        safe_name(name),
        F.lit("_"),
        suffix,
        F.lit(".json"),
    )


def payload(fields=RECORD_FIELDS) -> Column:
    """A record as the JSON text of its stored object."""
    return json_document({f: F.col(f) for f in fields})


def as_objects(df: DataFrame, source: str, run_ts: str, suffix: Column | None = None) -> DataFrame:
    """``df`` with ``object_key`` and ``size_bytes`` of the object that each record is stored as."""
    own = object_suffix(F.col("source_url"), F.col("scraped_at")) if suffix is None else suffix
    day = collected_day(F.col("scraped_at"), run_ts)
    return df.withColumns(
        {
            "object_key": object_key(source, day, F.col("full_name"), own),
            "size_bytes": json_document_size({f: F.col(f) for f in RECORD_FIELDS}).cast("long"),
        }
    )


def s3_manifest(objects: DataFrame, bucket: str) -> DataFrame:
    """One row per stored object: ``bucket, key, size_bytes``."""
    return objects.select(F.lit(bucket).alias("bucket"), F.col("object_key").alias("key"), "size_bytes")


def gcs_manifest(objects: DataFrame, bucket: str) -> DataFrame:
    """One row per stored object: ``bucket, blob, size_bytes, content_type``."""
    return objects.select(
        F.lit(bucket).alias("bucket"),
        F.col("object_key").alias("blob"),
        "size_bytes",
        F.lit("application/json").alias("content_type"),
    )


def uploaded_count(manifest: DataFrame) -> DataFrame:
    """Number of objects in a manifest, as one row."""
    return manifest.agg(F.count(F.lit(1)).alias("uploaded"))
