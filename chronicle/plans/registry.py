"""The registered queries: every operator over the given tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicle.functions.dates import normalize_date, parse_date, stamp_date
from chronicle.functions.jsonl import is_object, object_keys
from chronicle.functions.text import join_texts, last_segment, safe_name, shorten, strip
from chronicle.functions.urls import host_allowed
from chronicle.operators import extraction, history, links, profile, quality, records, validation
from chronicle.operators.cap import capped
from chronicle.operators.versions import number_versions
from chronicle.plans import adapters
from chronicle.plans.adapters import RUN_TS, SITE, table
from chronicle.plans.daily import consolidate_cities, run_daily, standard_sinks, store_pages
from chronicle.schemas import RECORD, RECORD_FIELDS
from chronicle.shared import fresh_folder, staged, stored
from chronicle.sinks.objects import listing, manifest, store_objects
from chronicle.sinks.storage import fan_out, folder_sink, jsonl_sink, object_sink, write_folders, write_jsonl
from chronicle.sources.jsonl import (
    line_rejects,
    load_history,
    load_records,
    numbered_lines,
    read_lines,
)
from chronicle.sources.tables import read_history
from chronicle.streaming.records import record_stream, store_stream

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


EVENTS = ("user_id", "event_type", "ts", "event_id")
ORDERS = ("o_custkey", "priority", "o_orderdate", "o_orderkey")


# --- histories ---------------------------------------------------------------


@query
def scd_consolidate_events(spark, sf_dir):
    return history.consolidate(adapters.event_history(spark, sf_dir), *EVENTS)


@query
def scd_consolidate_orders(spark, sf_dir):
    return history.consolidate(adapters.order_history(spark, sf_dir), *ORDERS)


@query
def scd_consolidate_joined(spark, sf_dir):
    return history.consolidate_joined(adapters.order_history(spark, sf_dir), *ORDERS)


@query
def scd_consolidate_hot_key(spark, sf_dir):
    return history.consolidate(adapters.hot_event_history(spark, sf_dir), *EVENTS)


@query
def scd_consolidate_unknowns(spark, sf_dir):
    return history.consolidate(adapters.patchy_history(spark, sf_dir), *ORDERS)


@query
def scd_consolidate_sorted(spark, sf_dir):
    return history.consolidate(adapters.event_history(spark, sf_dir), *EVENTS, sort=True)


@query
def scd_consolidate_dates(spark, sf_dir):
    """Dates without a time: many versions of a day, decided by the order's key."""
    orders = adapters.order_history(spark, sf_dir)
    coarse = orders.withColumns({"o_orderdate": F.trunc("o_orderdate", "month"), "o_custkey": F.col("o_custkey") % 40})
    return history.consolidate(coarse, *ORDERS)


@query
def scd_consolidate_zoned(spark, sf_dir):
    """Points in time, cut to the day so that they are often equal."""
    events = adapters.hot_event_history(spark, sf_dir)
    return history.consolidate(events.withColumn("ts", F.date_trunc("day", F.col("ts").cast("timestamp"))), *EVENTS)


@query
def scd_consolidate_decimals(spark, sf_dir):
    """A decimal as the place in the history, and no tie column."""
    prices = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 40).alias("o_custkey"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"),
        F.when(F.col("o_orderkey") % 5 > 0, F.round(F.col("o_totalprice") / 50000).cast("decimal(10,2)")).alias("place"),
    )
    return history.consolidate(prices, "o_custkey", "priority", "place")


@query
def scd_approximate_values(spark, sf_dir):
    """Distinct values by sketches, those of two halves merged; exact for so few values."""
    events = adapters.event_history(spark, sf_dir)
    halves = [history.value_sketches(events.where(F.col("event_id") % 2 == i), "user_id", "event_type") for i in (0, 1)]
    merged = history.merged_sketches(halves[0].unionByName(halves[1]), "user_id")
    return history.sketched_values(merged, "user_id", "distinct_values")


@query
def scd_row_numbers(spark, sf_dir):
    numbered = number_versions(adapters.order_history(spark, sf_dir), "o_custkey", "o_orderdate", "o_orderkey")
    return numbered.select("o_orderkey", "o_custkey", "rn_asc", "rn_desc")


@query
def scd_row_numbers_hot_key(spark, sf_dir):
    numbered = number_versions(
        adapters.hot_event_history(spark, sf_dir), "user_id", "ts", "event_id", split_above=500
    )
    return numbered.select("event_id", "user_id", "rn_asc", "rn_desc")


def _null_ties(spark, sf_dir):
    """Orders with coarse times, unknown keys, times and ties, and many equal places."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey") % 50).alias("k"),
        F.col("o_orderpriority").alias("v"),
        F.when(F.col("o_orderkey") % 7 > 0, F.trunc("o_orderdate", "year")).alias("at"),
        F.when(F.col("o_orderkey") % 4 > 0, F.col("o_custkey") % 5).alias("i"),
    )


@query
def scd_row_numbers_null_ties(spark, sf_dir):
    """Rows of one place hold a run of numbers; which of them has which is open."""
    numbered = number_versions(_null_ties(spark, sf_dir), "k", "at", "i", split_above=400)
    return numbered.groupBy("k", "at", "i").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("rn_asc").alias("first_asc"),
        F.max("rn_asc").alias("last_asc"),
        F.min("rn_desc").alias("first_desc"),
        F.max("rn_desc").alias("last_desc"),
    )


@query
def scd_equal_ties(spark, sf_dir):
    """Equal places are decided by the value, in the consolidation and in its parts."""
    rows = _null_ties(spark, sf_dir).withColumn("i", F.lit(None).cast("long"))
    alone = history.first_version(rows, "k", "v", "at", "i", "first_alone").withColumnRenamed("k", "_k")
    whole = history.consolidate(rows, "k", "v", "at", "i")
    return whole.join(alone, F.col("k").eqNullSafe(F.col("_k"))).drop("_k")


@query
def scd_row_numbers_unknowns(spark, sf_dir):
    numbered = number_versions(
        adapters.patchy_history(spark, sf_dir),
        "o_custkey",
        "o_orderdate",
        "o_orderkey",
        split_above=500,
    )
    return numbered.select("o_orderkey", "o_custkey", "rn_asc", "rn_desc")


@query
def scd_first(spark, sf_dir):
    return history.first_version(adapters.order_history(spark, sf_dir), *ORDERS, name="first_value")


@query
def scd_latest(spark, sf_dir):
    return history.latest_version(adapters.order_history(spark, sf_dir), *ORDERS, name="last_value")


@query
def scd_latest_non_null(spark, sf_dir):
    return history.latest_non_null(adapters.order_history(spark, sf_dir), *ORDERS, name="last_non_null_value")


@query
def scd_distinct_values(spark, sf_dir):
    return history.distinct_values(adapters.event_history(spark, sf_dir), "user_id", "event_type", "distinct_values")


def _persons(spark, sf_dir):
    """The event history consolidated under the names of a person history."""
    person = adapters.event_history(spark, sf_dir).select(
        F.col("user_id").alias("person_id"), F.col("event_type").alias("city"), F.col("ts").alias("valid_from")
    )
    return consolidate_cities(person)


@query
def scd_summary(spark, sf_dir):
    return profile.consolidation_summary(_persons(spark, sf_dir))


@query
def consolidated_count(spark, sf_dir):
    return quality.consolidated_count(_persons(spark, sf_dir))


@query
def person_lines(spark, sf_dir):
    return profile.person_lines(_persons(spark, sf_dir))


@query
def display_columns(spark, sf_dir):
    return profile.display_names(_persons(spark, sf_dir))


def _text_history(spark, sf_dir):
    """Orders as history rows with text dates, a few of which are no dates."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("person_id"),
        F.col("o_orderpriority").alias("name"),
        F.lit(None).cast("string").alias("state"),
        F.col("o_orderstatus").alias("city"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("Spring 1940"))
        .when(F.col("o_orderkey") % 10 == 1, F.lit(""))
        .when(F.col("o_orderkey") % 10 == 2, F.date_format("o_orderdate", "yyyy/M/d"))
        .otherwise(day)
        .alias("valid_from"),
        F.when(F.col("o_orderstatus") == "F", F.concat(day, F.lit(" 10:00:00"))).alias("valid_to"),
    )


@query
def typed_history(spark, sf_dir):
    return records.typed_history(_text_history(spark, sf_dir), strict=False)


@query
def stored_history(spark, sf_dir):
    """A history written as a table, read back by its source and consolidated."""
    path = fresh_folder(spark, "history")
    stored(records.typed_history(_text_history(spark, sf_dir), strict=False), path)
    return consolidate_cities(read_history(spark, path).withColumn("person_id", F.col("person_id") % 100))


@query
def history_rejects(spark, sf_dir):
    return records.history_rejects(_text_history(spark, sf_dir)).select("person_id", "valid_from")


# --- scalar functions --------------------------------------------------------


@query
def normalize_dates(spark, sf_dir):
    """Five layouts, text that is no date, blanks that do not break, digits of other scripts, and year 0."""
    day, layouts = F.col("o_orderdate"), ["MMMM d, yyyy", "MMM dd, yyyy", "MM/dd/yyyy", "yyyy-MM-dd", "dd MMMM yyyy", "'Spring 'yyyy"]
    foreign = F.concat(F.date_format(day, "MMMM d, "), F.translate(F.date_format(day, "yyyy"), "0123456789", "٠١٢٣٤٥٦٧٨٩"))
    texts = [
        *[F.date_format(day, layout) for layout in layouts],
        F.translate(F.date_format(day, "MMMM d, yyyy"), " ", "\xa0"),
        foreign,
        F.date_format(day, "MMMM d, '0000'"),
    ]
    text = texts[-1]
    for i, way in enumerate(texts[:-1]):
        text = F.when(F.col("o_orderkey") % len(texts) == i, way).otherwise(text)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", normalize_date(text).alias("iso"), parse_date(text).isNotNull().alias("understood")
    )


@query
def stamp_days(spark, sf_dir):
    stamp = F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(F.col("event_id") % 3 == 0, "Z").when(F.col("event_id") % 3 == 1, "-05:00").otherwise(" noon"),
    )
    day = F.coalesce(stamp_date(stamp), F.lit(RUN_TS[:10]).cast("date"))
    return table(spark, sf_dir, "events").select("event_id", F.date_format(day, "yyyy/MM/dd").alias("day_path"))


@query
def joined_lines(spark, sf_dir):
    joined = join_texts(F.split("text", "\n"))
    return table(spark, sf_dir, "documents").select("doc_id", strip(F.col("text")).alias("stripped"), joined.alias("joined"))


@query
def text_preview(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", shorten(F.col("text"), 300).alias("preview"))


@query
def url_segments(spark, sf_dir):
    url = F.col("url")
    return adapters.pages(spark, sf_dir).select(
        "page_id", last_segment(url).alias("last_segment"), safe_name(url).alias("safe_name")
    )


@query
def allowed_hosts(spark, sf_dir):
    return (
        adapters.pages(spark, sf_dir)
        .where(host_allowed(F.col("url"), ["example.org", "example.net"]))
        .select("page_id", "url")
    )


@query
def strict_json_lines(spark, sf_dir):
    props, way = F.col("props"), F.col("event_id") % 8
    line = (
        F.when(way == 1, F.concat(props, F.lit(" x")))
        .when(way == 2, F.concat(F.lit("["), props, F.lit("]")))
        .when(way == 3, F.substring(props, 1, 5))
        .when(way == 4, F.concat(props, props))
        .when(way == 5, F.translate(props, '"', "'"))
        .when(way == 6, F.lit("5"))
        .when(way == 7, F.concat(F.lit('{"a":null,'), F.substr(props, F.lit(2))))
        .otherwise(props)
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        is_object(line).alias("is_object"),
        F.array_join(F.array_sort(object_keys(line)), ",").alias("keys"),
    )


# --- records -----------------------------------------------------------------


@query
def record_defaults(spark, sf_dir):
    orders = adapters.order_records(spark, sf_dir)
    shaped = records.with_defaults(orders.drop("obituary_text"), RUN_TS)
    return shaped.groupBy("full_name", "date_of_birth", "date_of_death", "obituary_text", "source_url", "scraped_at").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def typed_records(spark, sf_dir):
    typed = records.typed_records(adapters.order_records(spark, sf_dir))
    collected = F.date_format("collected_at", "yyyy-MM-dd HH:mm:ss")
    return typed.select("o_orderkey", "birth_date", "death_date", collected.alias("collected_at"))


@query
def record_to_scd(spark, sf_dir):
    orders = adapters.order_records(spark, sf_dir)
    versions = records.record_to_history(orders, F.col("o_orderkey"))
    return records.typed_history(versions, strict=False)


def _checked(spark, sf_dir):
    return validation.validated(adapters.order_records(spark, sf_dir), RUN_TS)


@query
def validated_records(spark, sf_dir):
    return validation.accepted(_checked(spark, sf_dir))


@query
def rejected_records(spark, sf_dir):
    return validation.rejected(_checked(spark, sf_dir)).select("o_orderkey", "reject_reason", "reject_message")


def _titled_pages(spark, sf_dir):
    """Pages under their titles, some without one, some with no digit in the URL."""
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    plain = F.regexp_replace("url", r"[0-9]", "")
    return adapters.pages(spark, sf_dir).select(
        "page_id",
        F.when(F.col("page_id") % 5 > 0, title).otherwise(" ").alias("full_name"),
        F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(plain).alias("source_url"),
        F.lit(None).cast("string").alias("scraped_at"),
    )


@query
def validate_pages(spark, sf_dir):
    return validation.accepted(validation.validated(_titled_pages(spark, sf_dir), RUN_TS, suffix="."))


@query
def reject_reasons(spark, sf_dir):
    checked = validation.validated(_titled_pages(spark, sf_dir), RUN_TS, suffix="e")
    return validation.rejected(checked).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query
def storage_keys(spark, sf_dir):
    day = records.collected_day(F.col("scraped_at"), RUN_TS)
    suffix = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    return adapters.order_records(spark, sf_dir).select(
        "o_orderkey", records.object_key("site", day, F.col("full_name"), suffix).alias("key")
    )


@query
def storage_key_uniqueness(spark, sf_dir):
    """Records of the same name, day, URL and time stamp share a key."""
    manifest = records.s3_manifest(records.as_objects(adapters.order_records(spark, sf_dir), "site", RUN_TS), "bucket")
    per_key = manifest.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count(F.lit(1)).alias("keys"), F.max("n").alias("most_per_key"))


def _object_store(spark, sf_dir):
    """A store with an object for each order, and what its manifest says of it."""
    root, suffix = fresh_folder(spark, "objects"), F.col("o_orderkey").cast("string")
    store_objects(adapters.order_records(spark, sf_dir), root, "run", RUN_TS, "site", suffix)
    return root, manifest(spark, root, "run")


@query
def upload_manifest(spark, sf_dir):
    """What the writing tasks of one store have committed."""
    return records.s3_manifest(_object_store(spark, sf_dir)[1], "bucket")


@query
def stored_listing(spark, sf_dir):
    """What lies in the store beside what the manifest says."""
    root, logged = _object_store(spark, sf_dir)
    found = listing(spark, root).withColumnRenamed("size_bytes", "found_bytes")
    return logged.drop("run").join(found, "object_key", "full")


@query
def blob_manifest(spark, sf_dir):
    """The manifest of the other store, written by its sink."""
    root, suffix = fresh_folder(spark, "gcs"), F.col("o_orderkey").cast("string")
    object_sink(root, RUN_TS, "site", suffix)(adapters.order_records(spark, sf_dir), "run")
    return records.gcs_manifest(manifest(spark, root, "run"), "bucket")


@query
def uploaded_count(spark, sf_dir):
    return records.uploaded_count(records.s3_manifest(_object_store(spark, sf_dir)[1], "b"))


@query
def payloads(spark, sf_dir):
    return adapters.order_records(spark, sf_dir).select("o_orderkey", records.payload().alias("payload"))


# --- profile -----------------------------------------------------------------


@query
def name_search(spark, sf_dir):
    return profile.name_search(table(spark, sf_dir, "part"), "GEAR|^red", name="p_name").select("p_partkey", "p_name")


@query
def complete_records(spark, sf_dir):
    labelled = adapters.labelled_documents(spark, sf_dir)
    return profile.complete_records(labelled, ["lang", "quality", "toxic"]).select("doc_id", "quality", "toxic")


@query
def browse_counts(spark, sf_dir):
    kept = validation.accepted(_checked(spark, sf_dir))
    return profile.browse_counts(kept, "customer#0+1", only_complete=True)


@query
def record_cards(spark, sf_dir):
    return profile.browse(validation.accepted(_checked(spark, sf_dir)), "customer#0+[0-4]")


@query
def field_coverage(spark, sf_dir):
    return profile.field_coverage(adapters.labelled_documents(spark, sf_dir), ["text", "lang", "quality", "absent"])


@query
def overview_metrics(spark, sf_dir):
    return profile.overview(adapters.labelled_documents(spark, sf_dir), _persons(spark, sf_dir), "quality", "text")


@query
def last_collected(spark, sf_dir):
    return profile.last_collected(adapters.order_records(spark, sf_dir))


@query
def component_health(spark, sf_dir):
    """A run with a failing sink."""
    status, export = _one_broken_sink(spark, sf_dir)
    exported = quality.export_not_empty(read_lines(spark, export))
    return profile.component_health(status, exported, quality.consolidated_count(_persons(spark, sf_dir)))


# --- gates -------------------------------------------------------------------


def _gate_row(gate):
    return gate.withColumn("missing_fields", F.array_join("missing_fields", ","))


@query
def jsonl_gate(spark, sf_dir):
    return _gate_row(quality.schema_gate(adapters.order_lines(spark, sf_dir)))


@query
def missing_fields(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    checks = quality.line_checks(events, "props", ["k", "z"])
    return checks.select("event_id", F.array_join("missing", ",").alias("missing"), "valid")


@query
def export_not_empty(spark, sf_dir):
    return quality.export_not_empty(adapters.order_lines(spark, sf_dir))


@query
def response_metrics(spark, sf_dir):
    return quality.fetch_metrics(adapters.fetch_log(spark, sf_dir))


@query
def fetch_failures(spark, sf_dir):
    return quality.fetch_failures(adapters.fetch_log(spark, sf_dir))


# --- pages -------------------------------------------------------------------


@query
def page_headings(spark, sf_dir):
    pages = extraction.with_nodes(adapters.pages(spark, sf_dir))
    return pages.select("page_id", extraction.extract_name().alias("full_name"))


@query
def page_ad_text(spark, sf_dir):
    pages = extraction.with_nodes(adapters.pages(spark, sf_dir))
    text = extraction.container_text(extraction.Element("div", classes=("ad",)))
    return pages.select("page_id", text.alias("ad_text"))


@query
def longest_paragraph(spark, sf_dir):
    pages = extraction.with_nodes(adapters.pages(spark, sf_dir))
    return pages.select("page_id", extraction.longest_paragraph().alias("longest"))


@query
def page_records(spark, sf_dir):
    return extraction.extract_records(adapters.pages(spark, sf_dir), RUN_TS)


@query
def customer_page_records(spark, sf_dir):
    return extraction.extract_records(adapters.customer_pages(spark, sf_dir), RUN_TS, keep=["page_id"])


@query
def page_node_counts(spark, sf_dir):
    nodes = extraction.page_nodes(adapters.pages(spark, sf_dir))
    return nodes.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


# --- links -------------------------------------------------------------------


def _nav_links(spark, sf_dir):
    return links.page_links(adapters.pages(spark, sf_dir), href_part="/")


@query
def page_links(spark, sf_dir):
    return links.edges(_nav_links(spark, sf_dir))


@query
def links_per_page(spark, sf_dir):
    return links.links_per_page(_nav_links(spark, sf_dir)).select("page_id", "n_links")


@query
def distinct_targets(spark, sf_dir):
    found = links.allowed_targets(links.edges(_nav_links(spark, sf_dir)), ["example.org"])
    return links.distinct_targets(found).select("page_key")


@query
def listing_links(spark, sf_dir):
    return links.edges(links.page_links(adapters.listing_pages(spark, sf_dir)))


def _starts(listings):
    return listings.where(F.col("page_id") % 5 == 0).select("url")


@query
def reached_listings(spark, sf_dir):
    listings = staged(links.page_links(adapters.listing_pages(spark, sf_dir)), "links")
    return links.reached_listings(listings, _starts(listings)).select("start_url", "url", "hop")


@query
def selected_record_pages(spark, sf_dir):
    listings = staged(links.page_links(adapters.listing_pages(spark, sf_dir)), "links")
    starts = listings.where(F.col("page_id") % 8 == 0).select("url")
    pages = adapters.customer_pages(spark, sf_dir)
    return links.pages_to_extract(pages, listings, starts, ["example.org"], 5).select("page_id", "url")


@query
def unfetched_pages(spark, sf_dir):
    found = links.edges(links.page_links(adapters.listing_pages(spark, sf_dir))).where("kind = 'detail'")
    fetched = adapters.customer_pages(spark, sf_dir).where(F.col("page_id") % 3 == 0).select("url")
    return links.unfetched(links.distinct_targets(found), fetched).select(F.col("dst_url").alias("url"))


# --- sources, sinks and whole jobs -------------------------------------------


@query
def jsonl_round_trip(spark, sf_dir):
    path = fresh_folder(spark, "export")
    write_jsonl(adapters.order_records(spark, sf_dir).select(*RECORD_FIELDS), path)
    return load_records(spark, path)


@query
def jsonl_rows_written(spark, sf_dir):
    """The number counted while writing beside the number of lines found."""
    path = fresh_folder(spark, "export")
    written = write_jsonl(adapters.order_records(spark, sf_dir).select(*RECORD_FIELDS), path)
    return read_lines(spark, path).agg(
        F.lit(written).cast("long").alias("written"), F.count(F.lit(1)).alias("found")
    )


def _export(spark, sf_dir):
    """The order lines as text files, in the order of their keys."""
    path = fresh_folder(spark, "lines")
    adapters.order_lines(spark, sf_dir).orderBy("o_orderkey").select("value").write.text(path)
    return path


@query
def numbered_export_lines(spark, sf_dir):
    return numbered_lines(spark, _export(spark, sf_dir))


@query
def export_history(spark, sf_dir):
    return load_history(spark, _export(spark, sf_dir))


@query
def export_rejects(spark, sf_dir):
    return line_rejects(numbered_lines(spark, _export(spark, sf_dir)))


@query
def stored_days(spark, sf_dir):
    """Two runs into date folders, the first one repeated; rows per folder."""
    root = fresh_folder(spark, "objects")
    rows = staged(adapters.order_records(spark, sf_dir), "records")
    for run in ("a", "b", "a"):
        write_folders(rows, root, run, RUN_TS)
    parts = "year string, month string, day string, run string"
    stored = spark.read.schema(f"full_name string, {parts}").json(root)
    return stored.groupBy("year", "month", "day", "run").agg(F.count(F.lit(1)).alias("n"))


def _one_broken_sink(spark, sf_dir):
    """The status of a sink that fails between two that work, and the export's path."""

    def broken(df, run):
        raise OSError("bucket is gone")

    export = fresh_folder(spark, "export")
    sinks = {"s3": object_sink(fresh_folder(spark, "s3"), RUN_TS), "gcs": broken, "jsonl": jsonl_sink(export)}
    kept = validation.accepted(_checked(spark, sf_dir))
    return fan_out(kept.select(*RECORD_FIELDS), sinks, "run"), export


@query
def sink_status(spark, sf_dir):
    status, export = _one_broken_sink(spark, sf_dir)
    found = read_lines(spark, export).agg(F.count(F.lit(1)).alias("exported"))
    return status.join(found.withColumn("sink", F.lit("jsonl")), "sink", "left")


@query
def streamed_records(spark, sf_dir):
    """Records arriving as files, validated and stored by micro-batch."""
    incoming, root = fresh_folder(spark, "incoming"), fresh_folder(spark, "streamed")
    adapters.order_records(spark, sf_dir).select(*RECORD_FIELDS).repartition(4).write.option(
        "ignoreNullFields", "false"
    ).json(incoming)
    stream = store_stream(
        record_stream(spark, incoming, max_files=2),
        {"folders": folder_sink(root, RUN_TS)},
        RUN_TS,
        fresh_folder(spark, "stream-state"),
    )
    stream.awaitTermination()
    if stream.exception():
        raise stream.exception()
    return spark.read.schema(RECORD).json(root).select(*RECORD_FIELDS)


@query
def streamed_rejects(spark, sf_dir):
    """The lines of a stream that hold no record, as its reject sink stores them."""
    root = fresh_folder(spark, "stream-rejects")
    stream = store_stream(
        record_stream(spark, _export(spark, sf_dir)),
        {},
        RUN_TS,
        fresh_folder(spark, "stream-state"),
        rejects=lambda df, run: df.select("reject_reason", "line").write.mode("overwrite").json(f"{root}/{run}"),
    )
    stream.awaitTermination()
    if stream.exception():
        raise stream.exception()
    found = spark.read.schema("reject_reason string, line string").option("recursiveFileLookup", "true").json(root)
    return found.where("line IS NOT NULL")


@query
def capped_records(spark, sf_dir):
    """A trial run's records: the first 500 accepted ones by URL."""
    kept = staged(validation.accepted(_checked(spark, sf_dir)).select(*RECORD_FIELDS), "accepted")
    return capped(kept, 500, ["source_url"])


@query
def stored_page_rejects(spark, sf_dir):
    """Extract, validate and store; the rejected pages with their reasons."""
    sinks = standard_sinks(*[fresh_folder(spark, n) for n in ("s3", "gcs", "jsonl")], RUN_TS)
    _, rejects = store_pages(adapters.customer_pages(spark, sf_dir), sinks, "run", RUN_TS)
    return rejects.select("source_url", "reject_reason")


@query
def daily_job(spark, sf_dir):
    """All steps; what the gates and the consolidation report."""
    export = fresh_folder(spark, "export")
    sinks = standard_sinks(fresh_folder(spark, "s3"), fresh_folder(spark, "gcs"), export, RUN_TS)
    person = adapters.event_history(spark, sf_dir).select(
        F.col("user_id").alias("person_id"), F.col("event_type").alias("city"), F.col("ts").alias("valid_from")
    )
    pages = adapters.customer_pages(spark, sf_dir)
    result = run_daily(spark, pages, person, sinks, export, "run", RUN_TS)

    def step(name, df, column):
        return df.select(F.lit(name).alias("step"), F.col(column).cast("long").alias("n"))

    sinks_ok = result.sinks.agg(F.count_if("ok").alias("n"))
    return (
        step("sinks", sinks_ok, "n")
        .unionByName(step("export", result.export, "s3_objects_count"))
        .unionByName(step("valid", result.schema, "valid_records"))
        .unionByName(step("persons", result.persons, "persons_consolidated"))
        .unionByName(step("rejects", result.rejects.agg(F.count(F.lit(1)).alias("n")), "n"))
    )
