"""Explicit schemas of the data the jobs exchange. Nothing is ever inferred."""

from pyspark.sql import types as T

RECORD_FIELDS = (
    "full_name",
    "date_of_birth",
    "date_of_death",
    "obituary_text",
    "source_url",
    "scraped_at",
)

OPTIONAL_FIELDS = ("date_of_birth", "date_of_death", "obituary_text")

# Keys that every exported line must carry; a null value counts as carried.
REQUIRED_FIELDS = ("full_name", "date_of_birth", "date_of_death", "obituary_text")

RECORD = T.StructType([T.StructField(f, T.StringType()) for f in RECORD_FIELDS])

HISTORY = T.StructType(
    [
        T.StructField("person_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("valid_from", T.DateType()),
        T.StructField("valid_to", T.DateType()),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

FETCH_LOG = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("started", T.DoubleType()),
        T.StructField("ended", T.DoubleType()),
        T.StructField("body", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)
