"""File streams: cleaning ingest and windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from civicloom.functions.text import clean_text, parse_timestamp
from civicloom.sources.manifests import read_manifest
from civicloom.sources.snapshots import append_batch, compact


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    max_files_per_trigger: int = 1000,
    **options: str,
) -> DataFrame:
    """A folder that grows, a bounded number of files per micro-batch."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    return reader.option("maxFilesPerTrigger", max_files_per_trigger).load(path)


def _cleaned(stream: DataFrame, text_col: str, ts_col: str) -> DataFrame:
    typed = F.col(ts_col)
    if isinstance(stream.schema[ts_col].dataType, T.StringType):
        typed = parse_timestamp(typed)
    return stream.withColumns({text_col: clean_text(F.col(text_col)), ts_col: typed})


def stream_clean_ingest(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    text_col: str = "comment",
    ts_col: str = "timestamp",
) -> StreamingQuery:
    """Clean the text, type the time, and append to Parquet; each input file counts once, also
    after a restart, by the checkpoint and the sink's own log. Stops when the input is read."""
    return (
        _cleaned(stream, text_col, ts_col).writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_into_table(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    name: str,
    text_col: str = "comment",
    ts_col: str = "timestamp",
    day_col: str | None = None,
    compact_after: int = 32,
) -> StreamingQuery:
    """Clean the text, type the time, and append to the table that ``load_complaints`` and
    ``label_range`` use. Stops when the input is read.

    Each micro-batch is one change of the table's manifest, under the stream's ``name`` and the
    batch's number: a batch that runs again after a failure counts once. A checkpoint that starts
    anew needs a new name. Once more than ``compact_after`` batches stand beside the snapshot, one
    rewrite brings them together; labels and readers go on meanwhile.
    """
    days = (day_col,) if day_col else ()

    def save(rows: DataFrame, batch: int) -> None:
        if day_col:
            rows = rows.withColumn(day_col, F.col(ts_col).cast("date"))
        spark = rows.sparkSession
        append_batch(rows, root, name, batch, days)
        if len(read_manifest(spark, root).parts) > compact_after:
            compact(spark, root, days)

    return (
        _cleaned(stream, text_col, ts_col).writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def windowed_counts(
    stream: DataFrame, ts_col: str, key: str, width: str = "1 hour", lateness: str = "1 hour"
) -> DataFrame:
    """Rows per tumbling window and key; rows later than the watermark are dropped."""
    counted = (
        stream.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
        .withWatermark(ts_col, lateness)
        .groupBy(F.window(ts_col, width), key)
        .agg(F.count("*").alias("n"))
    )
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        key,
        "n",
    )


def stream_counts(
    stream: DataFrame, out: str, checkpoint: str, ts_col: str, key: str, **window: str
) -> StreamingQuery:
    """Write every window a micro-batch changes, open ones too, with its count so far.

    Each batch has a folder of its own, which a batch that runs again after a failure replaces;
    ``newest_counts`` reads the result. Stops when the input is read.
    """

    def save(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return (
        windowed_counts(stream, ts_col, key, **window)
        .writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def newest_counts(spark: SparkSession, out: str, key: str) -> DataFrame:
    """What ``stream_counts`` has counted: for each window and key the count of its last batch."""
    written = spark.read.parquet(out)
    return written.groupBy("window_start", "window_end", key).agg(F.max_by("n", "batch").alias("n"))
