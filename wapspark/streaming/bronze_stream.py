"""Incremental bronze → quarantine with Structured Streaming.

The batch loader reads only the newest landed file, so files landing between
runs are skipped. The stream instead picks up every new file exactly once
(file source + checkpoint) and applies the quarantine load rules to each
micro-batch; accepted and rejected rows together are the input, whenever the
job runs.

A repeated id is a reject, in the batch or accepted before. What was accepted
before is known from a state store and not by reading the accepted table: the
ids of rows that nothing else refuses pass ``dropDuplicatesWithinWatermark``
over their arrival time (the file's modification time), narrow rows, hash
partitioned by id. An id lives in the state for ``window`` after its arrival
and is evicted by the watermark, so the state is bounded by the ids of two
windows, whatever was ingested in all. The batch function gets all rows of the
micro-batch and, beside them, the ids that the state met for the first time;
an id of the batch that is not among these has been accepted within the
window. Rows older than the window (a file put back with its old time) can't
be told from copies any more: unless their id is new to the batch's state they
are rejected as ``late_record``, and none is lost.

Only rows that would be accepted enter the state, so a record that was refused
for its values may come again, corrected, under its id. Records without an id
get a fresh UUID and need no state.

Each micro-batch writes under its own ``batch_id=`` folder with overwrite: a
batch replayed after a failure meets the same state and replaces its own
output. ``availableNow`` drains what has landed and stops, so the job can be
scheduled like a batch job. The number of state partitions is that of
``spark.sql.shuffle.partitions`` at the first start.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wapspark.operators.joins import discard, materialize
from wapspark.operators.quality import row_reasons
from wapspark.session import ensure_checkpoint_dir, releasing
from wapspark.sources.bronze import BRONZE_SCHEMA, load_to_quarantine, to_quarantine_rows
from wapspark.sources.sinks import read_if_present

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_COMPRESSION = "spark.sql.streaming.stateStore.rocksdb.compression"


def _sound_ids(raw: DataFrame) -> DataFrame:
    """Ids (with arrival) of the records that have one and that no rule refuses
    for its own values."""
    rows = to_quarantine_rows(raw.filter("_keyed"), carry=("_arrival",))
    return rows.filter((F.size("_parse_errors") == 0) & (F.size(row_reasons()) == 0)).select(
        "transaction_id", "_arrival")


def _late_before(spark: SparkSession, path: str, batch_id: int, window: str) -> DataFrame | None:
    """One row: the newest arrival of earlier batches less the window. Two
    slots hold the running maximum, a replayed batch rewrites its own."""
    seen = read_if_present(spark, path)
    if seen is None:
        return None
    return (seen.filter(F.col("batch_id") < batch_id)
            .agg((F.max("newest") - F.expr(f"INTERVAL {window}")).alias("_late_before")))


def _note_arrivals(batch: DataFrame, path: str, batch_id: int) -> None:
    spark = batch.sparkSession
    newest = batch.agg(F.max("_arrival").alias("newest"))
    before = read_if_present(spark, path)
    if before is not None:
        newest = newest.unionByName(before.filter(F.col("batch_id") < batch_id).select("newest"))
    newest = newest.agg(F.lit(batch_id).cast("long").alias("batch_id"),
                        F.max("newest").alias("newest")).checkpoint()
    newest.coalesce(1).write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")


def ingest_bronze_stream(spark: SparkSession, source_path: str, accepted_path: str,
                         rejected_path: str, checkpoint_path: str,
                         as_of: dt.datetime | None = None, available_now: bool = True,
                         window: str = "30 days", max_files_per_trigger: int | None = None,
                         oldest_file: str = "3650d") -> StreamingQuery:
    """Start the ingest. ``window`` is how long after its arrival an accepted
    id is known; give it the longest time after which a source repeats one.
    ``oldest_file``: files that are older than the newest by more are not read
    (the source's own default, a week, would pass over late files in silence);
    it bounds the paths that the source remembers."""
    ensure_checkpoint_dir(spark)
    if spark.conf.get(STATE_PROVIDER, None) is None or "HDFSBacked" in spark.conf.get(STATE_PROVIDER):
        spark.conf.set(STATE_PROVIDER, ROCKSDB)  # state on executors' disks, not in their heap
    if spark.conf.get(STATE_COMPRESSION, "lz4") == "lz4":  # the default; ids of hex digits take half of it
        spark.conf.set(STATE_COMPRESSION, "zstd")
    reader = (spark.readStream.schema(BRONZE_SCHEMA)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record")
              .option("recursiveFileLookup", "true")
              .option("maxFileAge", oldest_file))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    ident = F.coalesce(F.col("id"), F.lit(""))
    raw = (reader.json(source_path)
           .select("*", F.col("_metadata.file_path").alias("source_file"),
                   F.col("_metadata.file_modification_time").alias("_arrival"))
           .withColumn("_keyed", ~ident.isin("", "0")))
    first = (_sound_ids(raw).withWatermark("_arrival", window)
             .dropDuplicatesWithinWatermark(["transaction_id"])
             .select(F.col("transaction_id").alias("_first")))
    both = raw.withColumn("_first", F.lit(None).cast("string")).unionByName(
        first, allowMissingColumns=True)
    arrivals = f"{checkpoint_path.rstrip('/')}-arrivals"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stored = materialize(batch, "batch")  # the state is read and written once
        records = stored.filter("_first is null").drop("_first")
        fresh = stored.filter("_first is not null").select(F.col("_first").alias("transaction_id"))
        known = _sound_ids(records).select("transaction_id").distinct().join(
            fresh, "transaction_id", "left_anti")
        rows = to_quarantine_rows(records, as_of=as_of, carry=("_arrival",))
        accepted, rejected = load_to_quarantine(rows, known)
        late = _late_before(session, arrivals, batch_id, window)
        reasons = F.col("reject_reasons")
        kept = rejected
        if late is not None:  # a row
            kept = kept.crossJoin(F.broadcast(late))
            reasons = F.when(F.col("_arrival") < F.col("_late_before"), F.transform(
                "reject_reasons", lambda r: F.when(r == "duplicate_key", F.lit("late_record"))
                .otherwise(r))).otherwise(reasons)
        kept = kept.withColumn("reject_reasons", F.array_join(reasons, ",")).drop(
            "_arrival", "_late_before")
        for rows, path in ((accepted.drop("_arrival"), accepted_path), (kept, rejected_path)):
            with releasing(session):
                rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch_id={batch_id}")
        _note_arrivals(records, arrivals, batch_id)
        discard(accepted)
        discard(stored)

    writer = (both.writeStream.foreachBatch(write_batch).outputMode("append")
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def state_rows(query: StreamingQuery) -> int:
    """Ids that the state held after the query's last batch."""
    last = query.lastProgress
    return sum(s["numRowsTotal"] for s in last["stateOperators"]) if last else 0
