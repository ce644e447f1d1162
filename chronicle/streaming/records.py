"""Records that arrive as files: validated and stored as they come.

The same functions as in the batch job, applied per micro-batch. There is no
state, so a restart continues from the stream's own checkpoint.
"""

from collections.abc import Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronicle.operators.validation import LISTING_SUFFIX, accepted, rejected, validated
from chronicle.functions.jsonl import parsed_object
from chronicle.schemas import RECORD, RECORD_FIELDS
from chronicle.shared import has_mark, put_mark, remove_folder, staged, staging
from chronicle.sinks.storage import Sink, fan_out
from chronicle.sources.jsonl import is_blank


def record_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Records from JSON Lines files that appear in ``folder``, parsed as strictly
    as in the batch job. ``line`` holds the text of a line that is no record."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(folder).where(~is_blank(F.col("value")))
    # Binding the record in a lambda parses each line once.
    return lines.select(
        F.inline(
            F.transform(
                F.array(parsed_object(F.col("value"), RECORD)),
                lambda r: F.struct(
                    *[r[f].alias(f) for f in RECORD_FIELDS], F.when(r.isNull(), F.col("value")).alias("line")
                ),
            )
        )
    )


def store_stream(
    records: DataFrame,
    sinks: Mapping[str, Sink],
    run_ts: str,
    checkpoint: str,
    rejects: Sink | None = None,
    suffix: str = LISTING_SUFFIX,
) -> StreamingQuery:
    """Validate every micro-batch and hand it to the sinks, until the input
    present at the start is used up.

    A batch is named by its number, so a batch that is tried again replaces its
    own earlier output. A failing sink fails the batch, which is then retried
    with the sinks that have not stored it yet: a batch that fails leaves marks
    of the others beside the stream's checkpoint.
    Lines that are no record go to ``rejects`` as they are, with the reason
    ``malformed_line``, beside the records that validation rejects.
    """

    def store(batch: DataFrame, number: int) -> None:
        run, spark = f"batch-{number:09d}", batch.sparkSession
        marks = f"{checkpoint}/stored/{run}"
        open_sinks = {name: sink for name, sink in sinks.items() if not has_mark(spark, f"{marks}/{quote(name, safe='')}")}
        with staging(spark):
            arrived = staged(batch, "micro-batch")
            checked = validated(arrived.where("line IS NULL"), run_ts, suffix)
            good = accepted(checked).drop("line")
            status = fan_out(good, open_sinks, run).collect()  # a row per sink
            failed = [r for r in status if not r.ok]
            for r in status if failed else ():
                if r.ok:
                    put_mark(spark, f"{marks}/{quote(r.sink, safe='')}")
            if rejects is not None:
                broken = arrived.where("line IS NOT NULL").withColumns(
                    {"reject_reason": F.lit("malformed_line"), "reject_message": F.lit("not one JSON object")}
                )
                rejects(rejected(checked).unionByName(broken), run)
        if failed:
            raise RuntimeError("; ".join(f"{r.sink}: {r.error}" for r in failed))
        remove_folder(spark, marks)

    return (
        records.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
