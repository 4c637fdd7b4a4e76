"""Incremental ingest. What a resumable scraper keeps by hand (ids seen, a cursor, files appended to) is here a
stream's checkpoint: each run takes the files that are new and stops."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def read_new_jsonl(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the JSON lines below path, good rows only, in batches of so many files."""
    from ..sources.files import _BAD, T

    full = T._parse_datatype_string(schema).add(_BAD, "string")
    rows = spark.readStream.schema(full).option("columnNameOfCorruptRecord", _BAD).option("maxFilesPerTrigger", files_per_batch).json(path)
    return rows.where(F.col(_BAD).isNull()).drop(_BAD)


def ingest(
    spark: SparkSession, path: str, schema: str, key: str, out: str, checkpoint: str, clean: Callable[[DataFrame], DataFrame] = lambda df: df, files_per_batch: int = 100
) -> StreamingQuery:
    """Append what is new below path to Parquet at out: cleaned, and each key once over all runs. Started, and
    ends by itself; rows are written exactly once even if a run breaks off."""
    rows = clean(read_new_jsonl(spark, path, schema, files_per_batch)).dropDuplicates([key])
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_within(rows: DataFrame, key: str, time_col: str, horizon: str, out: str, checkpoint: str) -> StreamingQuery:
    """As ingest() for rows with a time: keys are forgotten after the horizon, which bounds the state."""
    stream = rows.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, horizon).dropDuplicatesWithinWatermark([key])
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling(rows: DataFrame, time_col: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts per window and key; windows close once they are late."""
    t = rows.withColumn("t", F.col(time_col).cast("timestamp")).withWatermark("t", late)
    return t.groupBy(F.window("t", width).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


class Progress(StreamingQueryListener):
    """What a watcher prints: batches, rows and rows a second of each query, newest last."""

    def __init__(self):
        self.rows: list[dict] = []

    def onQueryStarted(self, event):
        self.rows.append({"query": str(event.id), "state": "started"})

    def onQueryProgress(self, event):
        p = event.progress
        self.rows.append({"query": str(p.id), "state": "running", "batch": p.batchId, "rows": p.numInputRows, "rows_per_s": p.processedRowsPerSecond})

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.rows.append({"query": str(event.id), "state": "failed" if event.exception else "ended"})
