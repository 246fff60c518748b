"""Structured Streaming: resumable scans, duplicates across runs, counters, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(kind).load(path)


def run_available(stream: DataFrame, out: str, checkpoint: str, kind: str = "parquet", timeout: int | None = None) -> None:
    """Process what is there and stop; a later call goes on from the checkpoint."""
    q = stream.writeStream.format(kind).option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if timeout is not None and not q.awaitTermination(timeout):
        q.stop()
    elif timeout is None:
        q.awaitTermination()


def dedup_stream(stream: DataFrame, text: str = "text") -> DataFrame:
    """First arrival of each text, across batches and restarts."""
    return stream.withColumn("sha", F.sha2(text, 256)).dropDuplicates(["sha"])


def _earlier(spark: SparkSession, path: str, batch_id: int, schema: str) -> DataFrame:
    """What batches before this one wrote; none yet is an empty table."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/batch=-1")
    return spark.read.schema(f"{schema}, batch long").parquet(path).where(F.col("batch") < batch_id).drop("batch")


def seen_table_batch(seen_path: str, key: str):
    """foreachBatch function: keeps rows whose key no earlier batch had, in a folder of the batch. A batch that is run again replaces its own folder only."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema)
        known = _earlier(batch.sparkSession, seen_path, batch_id, schema)
        fresh = batch.dropDuplicates([key]).join(known.select(key), key, "left_anti")
        fresh.select(*batch.columns).write.mode("overwrite").parquet(f"{seen_path}/batch={batch_id}")

    return handle


def near_seen_batch(seen_path: str, key: str = "node"):
    """foreachBatch function over (node, bucket): keeps nodes that share no bucket with a node kept in an earlier batch or with a smaller one of this batch.

    The table of kept nodes and their buckets outlives restarts, so near duplicates are met across runs.
    """
    from textkiln.operators.graph import first_in_buckets

    def handle(batch: DataFrame, batch_id: int) -> None:
        members = batch.select(key, "bucket").distinct()
        known = _earlier(batch.sparkSession, seen_path, batch_id, f"`{key}` {batch.schema[key].dataType.simpleString()}, bucket string")
        met = members.join(known.select("bucket").distinct(), "bucket", "left_semi").select(key).distinct()
        open_ = members.join(met, key, "left_anti").withColumnRenamed(key, "node")
        kept = first_in_buckets(open_.select("node").distinct(), open_)
        open_.join(kept, "node").withColumnRenamed("node", key).select(key, "bucket").write.mode("overwrite").parquet(f"{seen_path}/batch={batch_id}")

    return handle


def kept_in(spark: SparkSession, seen_path: str, schema: str) -> DataFrame:
    """The table that seen_table_batch or near_seen_batch keeps."""
    return spark.read.schema(f"{schema}, batch long").parquet(seen_path).drop("batch")


def run_complete(aggregated: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Run a streaming aggregate over what is there: after each batch its whole state is the table ``out``, so totals are seen while it runs."""
    q = aggregated.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start()
    q.awaitTermination()
    return aggregated.sparkSession.read.parquet(out)


def counters(stream: DataFrame, *by: str, size: str = "text") -> DataFrame:
    """Rows and characters per group of a stream."""
    return stream.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.length(size)).alias("chars"))


def rotating_batch(folder: str, order: str, rows: int, target: str | None = None):
    """foreachBatch function over (source, track, ...): named shards whose indexes go on from batch to batch; with ``target`` they are shipped there."""

    def handle(batch: DataFrame, _: int) -> None:
        from textkiln.sources import sinks

        made = sinks.write_named_shards(batch, folder, order, rows)
        if target is not None:
            sinks.ship(made.select(F.concat(F.lit(f"{folder}/"), "name").alias("path")), target, delete=False)

    return handle


def tumbling(events: DataFrame, width: str, *by: str, late: str | None = None) -> DataFrame:
    df = events.withWatermark("ts", late) if late else events
    return df.groupBy(F.window("ts", width).alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *by, "n", "total")


def sliding(events: DataFrame, width: str, step: str, *by: str) -> DataFrame:
    return events.groupBy(F.window("ts", width, step).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def sessions(events: DataFrame, gap: str, user: str = "user_id") -> DataFrame:
    return events.groupBy(user, F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select(user, F.col("w.start").alias("start"), "n")
