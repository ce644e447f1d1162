"""The given tables, seen as the inputs of the jobs. Every adapter covers its
whole table, so the work grows with the data."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicle.sources.tables import read_pages

RUN_TS = "2026-03-12T08:00:00+00:00"
SITE = "https://www.example.org"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, f"{sf_dir}/pages.parquet")


def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as the values of a user history; errors read as unknown."""
    return table(spark, sf_dir, "events").select(
        "user_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "ts", "event_id"
    )


def hot_event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a third of all rows under a single key."""
    hot = F.when(F.col("user_id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("user_id"))
    return event_history(spark, sf_dir).withColumn("user_id", hot)


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order priorities as the values of a customer history."""
    return table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"),
        "o_orderdate",
        "o_orderkey",
    )


def patchy_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with unknown keys, unknown times and empty values."""
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority"))
        .alias("priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("o_orderdate"),
        "o_orderkey",
    )


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order, with null and empty optional fields."""
    orders, customers = (table(spark, sf_dir, t) for t in ("orders", "customer"))
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return joined.select(
        "o_orderkey",
        F.when(priority == "1-URGENT", F.concat("c_mktsegment", F.lit(" Obituaries")))
        .when(priority == "2-HIGH", F.lit(" "))
        .otherwise(F.col("c_name"))
        .alias("full_name"),
        F.when(status != "P", F.date_format("o_orderdate", "MMMM d, yyyy")).alias("date_of_birth"),
        F.when(status == "F", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(status == "O", F.lit(""))
        .alias("date_of_death"),
        F.when(priority == "5-LOW", F.lit(""))
        .otherwise(F.concat("c_mktsegment", F.lit(' "'), priority, F.lit('"\n'), "c_name"))
        .alias("obituary_text"),
        F.concat(
            F.lit(f"{SITE}/us/"),
            F.lower("c_mktsegment"),
            F.when(status == "P", F.concat(F.lit("/"), F.col("o_orderkey").cast("string"))).otherwise(""),
        ).alias("source_url"),
        F.when(status != "O", F.date_format("o_orderdate", "yyyy-MM-01'T'HH:mm:ss'Z'")).alias("scraped_at"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export line per order: most hold a record, some are broken or blank,
    some lack keys."""
    kind = F.col("o_orderkey") % 13
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    # The name holds no character that JSON would escape.
    name = F.concat(F.lit('"full_name":"Order '), F.col("o_orderkey").cast("string"), F.lit('"'))
    death = F.when(kind == 5, F.lit("null")).otherwise(F.concat(F.lit('"'), day, F.lit('"')))
    stamp = F.concat(F.lit('"scraped_at":"'), day, F.lit('T08:00:00Z"}'))
    rest = F.concat(
        F.lit('"date_of_birth":null,"date_of_death":'), death, F.lit(',"obituary_text":"it\'s",'), stamp
    )
    full = F.concat(F.lit("{"), name, F.lit(","), rest)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(kind == 0, F.lit("not json"))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.concat(full, F.lit(" x")))
        .when(kind == 3, F.concat(F.lit("["), full, F.lit("]")))
        .when(kind == 4, F.concat(F.lit("{"), rest))
        .when(kind == 6, F.concat(F.lit("{"), name, F.lit(","), stamp))
        .otherwise(full)
        .alias("value"),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, null where a document has none."""
    documents, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return documents.join(labels, "doc_id", "left")


def _spread(rows: DataFrame) -> DataFrame:
    """The same rows over all cores. A table of small rows is few splits to
    Spark, however many pages are made of them."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record page per customer in one of four layouts."""
    kind = F.col("c_custkey") % 4
    day = F.date_add(F.lit("1940-01-15").cast("date"), F.col("c_nationkey") * 31)
    long_text = F.repeat(F.concat("c_name", F.lit(" &amp; family. ")), 6)

    def html(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    block = html(
        '<p class="mt-2 mb-1 text-white fs-18"><i class="fal mr-2"></i>\n ',
        F.date_format(day, "MMMM d, yyyy"),
        "<span> - </span> ",
        F.date_format(F.date_add(day, 20000), "MMM d, yyyy"),
        "<span> (54 years old)</span></p>",
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return _spread(customers).select(
        F.col("c_custkey").alias("page_id"),
        html(f"{SITE}/us/obituaries/c-", F.col("c_custkey").cast("string")).alias("url"),
        html(
            "<html><head><title>a <h1>no</h1></title><style>p{}</style/><script>1</script x>",
            "<script><!-- <script>'</script><h1>no</h1>' --></script></head><body><!-- <h1>no</h1> -->",
            F.when(
                kind == 0,
                html(
                    '<h1>Wrong Obituary</h1><p class="my-auto h1 text-white font-weight-bolder"> ',
                    F.col("c_name"),
                    "\n</p>",
                    block,
                    '<div class="x obit-text"><b>',
                    F.col("c_mktsegment"),
                    "</b><div> <i>of</i> </div>",
                    F.col("c_name"),
                    "</div>",
                ),
            )
            .when(kind == 1, html("<h1>", F.col("c_name"), " Obituary</h1><p>short</p><p>", long_text, "</p>"))
            .when(
                kind == 2,
                html(
                    '<div class="obit-main-info"><span><p class="font-weight-bolder">',
                    F.col("c_name"),
                    '</p></span></div><div itemprop="description">',
                    F.col("c_mktsegment"),
                    "<script>f(1<2)</script></div>",
                    '<p class="mt-2 mb-1 text-white">Spring 1940</p>',
                ),
            )
            .otherwise(html("<h2>", F.col("c_name"), "</h2><p>nothing here</p>")),
            "</body></html>",
        ).alias("html"),
    )


LISTING_SIZE = 10


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of ten customers each; every page links to the next, in one
    of four ways, except that every seventh chain ends."""
    number = F.floor(F.col("c_custkey") / LISTING_SIZE)
    listings = (
        table(spark, sf_dir, "customer")
        .groupBy(number.alias("page_id"))
        .agg(F.array_sort(F.collect_list("c_custkey")).alias("ids"))  # ten ids at most
    )
    page = F.col("page_id").cast("string")
    following = F.concat(F.lit("?page="), (F.col("page_id") + 1).cast("string"))
    links = F.array_join(
        F.transform(
            "ids",
            lambda i: F.concat(
                F.lit('<a class="big obituary-item__name" href="obituaries/c-'), i.cast("string"), F.lit('">x</a>')
            ),
        ),
        "\n",
    )
    way = F.col("page_id") % 4
    onward = (
        F.when(F.col("page_id") % 7 == 6, F.lit('<a rel="next" href="">end</a>'))
        .when(way == 0, F.concat(F.lit('<a rel="next" href="'), following, F.lit('">n</a>')))
        .when(way == 1, F.concat(F.lit('<a class="pagination__next" href="'), following, F.lit('">n</a>')))
        .when(way == 2, F.concat(F.lit('<li class="next"><a href="'), following, F.lit('">n</a></li>')))
        .otherwise(F.concat(F.lit('<a class="go-next-page" href="'), following, F.lit('">n</a>')))
    )
    return listings.select(
        "page_id",
        F.concat(F.lit(f"{SITE}/us/obituaries?page="), page).alias("url"),
        F.concat(
            F.lit('<nav><a href="/us/obituaries/ct">ct</a></nav>'), links, onward
        ).alias("html"),
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as fetches: sign-ups never got a response, errors are failures."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit(f"{SITE}/a/very/long/path/to/make/the/cut/of/the/text/visible/in/the/log/"), kind, F.lit("/"), F.col("event_id").cast("string")).alias("url"),
        F.when(kind == "error", 500).when(kind == "view", 404).otherwise(200).alias("status"),
        F.lit(0.0).alias("started"),
        F.col("value").alias("ended"),
        F.col("props").alias("body"),
        F.when(kind == "signup", F.concat(F.lit("Timeout: "), F.col("event_id").cast("string"))).alias("error"),
    )
