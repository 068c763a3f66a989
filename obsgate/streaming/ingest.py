"""Incremental loads of observation files as they arrive.

A Structured Streaming file source picks up only files it has not seen
(tracked in the checkpoint), and each micro-batch runs the same load plan
as the batch job. Whole files arrive in one micro-batch, so the per-file
coverage gate still sees complete files.

Exactly-once output: every micro-batch writes its tables into its own
``batch_id=<n>`` partition with overwrite, so a batch replayed after a
failure replaces exactly what its first attempt wrote and nothing else.
Readers of the output see ``batch_id`` as an extra partition column. The
checkpoint is the caller's to name: a fresh one would start at batch 0 again.

Rows that an earlier batch stored are not stored again, and the day gate sees
the stored rows of the years a batch brings: files give the same table in
however many batches they arrive. A batch whose rows a gate refuses stops the
stream before its checkpoint, so its files are not lost; mend or remove them and
start again. Files rejected one by one are told in the status and don't stop it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from obsgate.plans.pressure import PARTITION_COLS as PRESSURE_PARTITIONS, load_pressure
from obsgate.plans.temperature import PARTITION_COLS as TEMPERATURE_PARTITIONS, load_temperature
from obsgate.sinks.parquet import table_schema
from obsgate.sources.text import file_name_column

LOADS = {
    "temperature": (load_temperature, TEMPERATURE_PARTITIONS),
    "pressure": (load_pressure, PRESSURE_PARTITIONS),
}


def line_stream(spark: SparkSession, source: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(value, file_name, file_path)`` of every line of every new file under ``source``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:  # paces the batches; the table doesn't depend on it
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(source).select(
        "value", file_name_column().alias("file_name"), F.col("_metadata.file_path").alias("file_path"))


def _batch_writer(kind: str, output: str, quarantine: str | None, status: str | None, options: dict):
    load, partitions = LOADS[kind]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = None
        if table_schema(spark, output) is not None:
            stored = spark.read.parquet(output).filter(F.col("batch_id") != batch_id)
        res = load(spark, batch, load_id=str(batch_id), existing=stored, **options)
        try:
            target = f"{output.rstrip('/')}/batch_id={batch_id}"
            if quarantine is not None and res.counts["rows_quarantined"]:
                (res.quarantine.hint("rebalance", "file_name").write.mode("overwrite").partitionBy("file_name")
                 .parquet(f"{quarantine.rstrip('/')}/batch_id={batch_id}"))
            if status is not None:
                done = res.status.withColumn("loaded", F.col("gates_passed") & (F.col("rows_staged") > 0))
                (done.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
                 .parquet(f"{status.rstrip('/')}/batch_id={batch_id}"))
            if res.counts["rows_staged"] and not res.gates["gates_passed"]:
                raise ValueError(f"batch {batch_id} is refused: {res.gates}")
            if res.counts["rows_staged"]:
                (res.loaded.hint("rebalance", *partitions).write.mode("overwrite")
                 .partitionBy(*partitions).parquet(target))
        finally:
            res.release()

    return write_batch


def start_ingest(
    spark: SparkSession,
    kind: str,
    source: str,
    output: str,
    *,
    checkpoint: str,
    quarantine: str | None = None,
    status: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    **options,
) -> StreamingQuery:
    """Start an incremental ``temperature`` or ``pressure`` load of ``source``.

    ``available_now`` processes everything present and stops (scheduled
    incremental runs); otherwise ``processing_time`` (e.g. ``"1 minute"``)
    keeps the stream running. ``legacy_mandatory_null`` is refused: its rule
    looks at a whole batch, which here is whatever a trigger picks up.
    """
    if kind not in LOADS:
        raise ValueError(f"kind must be one of {sorted(LOADS)}")
    if options.get("legacy_mandatory_null"):
        raise ValueError("legacy_mandatory_null depends on the batch; use the batch load")
    lines = line_stream(spark, source, max_files_per_trigger=max_files_per_trigger)
    writer = (
        lines.writeStream.foreachBatch(_batch_writer(kind, output, quarantine, status, options))
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
