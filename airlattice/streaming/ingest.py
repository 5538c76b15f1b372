"""Payload files as a stream: late data, duplicates, hourly means and idempotent writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from airlattice.plans.load_run import refresh_quality
from airlattice.session import stored
from airlattice.sources import payloads, sinks
from airlattice.tables import table_path

LATENESS = "24 hours"
OBSERVED = "observation_records"
LOSSES = "stream_losses"
REASONS = [p.replace(" ", "_") for p in payloads.PROBLEMS]
COUNTS = ["records", *REASONS, "late", "repeats"]
LAYOUT = "query_id STRING, batch_id BIGINT, " + ", ".join(f"{c} BIGINT" for c in COUNTS)
DUPLICATE_KEY = ["location_id", "parameter", "timestamp"]


def without_repeats(obs: DataFrame, lateness: str = LATENESS, keys=None) -> DataFrame:
    """Drop repeats that arrive within the allowed lateness; state is bounded by it."""
    return obs.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(keys or DUPLICATE_KEY)


def ingest_stream(spark: SparkSession, path: str, cities: DataFrame | None = None,
                  envelope: bool = False, lateness: str = LATENESS, max_files: int | None = None,
                  max_bytes: str | None = None) -> DataFrame:
    """New payload files as the de-duplicated long frame.

    ``max_files`` or ``max_bytes`` limit one micro-batch, so that a backlog is taken in steps. Records are counted by
    problem under the name ``OBSERVED``; a ``LossCounter`` stores the counts.
    """
    limits = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    lines = payloads.read_lines(spark, path, stream=True, **{k: v for k, v in limits.items() if v is not None})
    records = payloads.unwrap(lines) if envelope else payloads.as_records(lines)
    return without_repeats(payloads.parse_observations(records, cities, observed=OBSERVED), lateness)


class LossCounter(StreamingQueryListener):
    """Stores what each micro-batch read and did not keep: one row a batch in a table below ``root``.

    Problems of records come from the observed metrics, late and repeated rows from the state operators, which see a
    row at most once. Register it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__()
        self.session, self.path = spark, table_path(root, LOSSES)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if OBSERVED not in progress.observedMetrics:
            return
        seen, states = progress.observedMetrics[OBSERVED], progress.stateOperators
        counts = [int(seen[c] or 0) for c in ("records", *REASONS)]
        counts += [sum(s.numRowsDroppedByWatermark for s in states), sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in states)]
        if any(counts):
            row = (str(progress.id), progress.batchId, *counts)
            self.session.createDataFrame([row], LAYOUT).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def finish(self, seconds: int = 60) -> None:
        """Wait for the counts of batches that have ended, and stop listening."""
        self.session.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(seconds * 1000)
        self.session.streams.removeListener(self)


def losses(spark: SparkSession, root: str) -> DataFrame:
    """(problem, records) over all batches of all streams that were counted; a batch that ran again counts once."""
    batches = spark.read.schema(LAYOUT).parquet(table_path(root, LOSSES)).groupBy("query_id", "batch_id").agg(*[F.max(c).alias(c) for c in COUNTS])
    total = batches.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])
    return total.select(F.inline(F.array(*[
        F.struct(F.lit(c.replace("_", " ")).alias("problem"), F.col(c).alias("records")) for c in COUNTS])))


def hourly_stream(obs: DataFrame, city: str = "city", value: str = "value_ug_m3") -> DataFrame:
    """City-hour means; an hour is emitted once the watermark has passed it."""
    return (obs.groupBy(F.window("timestamp", "1 hour"), city, "parameter")
            .agg(F.sum(value).alias("v_sum"), F.count(value).cast("int").alias("station_count"))
            .select(F.col("window.start").alias("timestamp"), city, "parameter",
                    (F.col("v_sum").cast("double") / F.col("station_count")).alias("value_ug_m3"),
                    "station_count"))


def load_batch(spark: SparkSession, root: str, batch: DataFrame) -> None:
    """Append one micro-batch and the quality rows of its days; safe to repeat."""
    batch = stored(batch)
    sinks.append_observations(spark, root, batch)
    refresh_quality(spark, root, batch)


def stream_to_warehouse(hourly: DataFrame, root: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write finished hours into the star schema, all available files and then stop, or hourly."""
    writer = (hourly.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, _: load_batch(batch.sparkSession, root, batch)))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 hour")
    return writer.start()


def stream_to_files(hourly: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write finished hours as Parquet with exactly-once file commits."""
    return (hourly.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .option("path", path).trigger(availableNow=True).start())
