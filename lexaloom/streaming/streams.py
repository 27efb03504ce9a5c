"""The batch windows and writes as Structured Streaming."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_table(spark: SparkSession, path: str, like: DataFrame, files: int = 1) -> DataFrame:
    """A folder or a pattern of Parquet files as a stream."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).parquet(path)


def window_counts(events: DataFrame, time: str = "ts", key: str = "event_type", width: str = "300 seconds", late: str = "10 minutes") -> DataFrame:
    """(start, key, n, total) by tumbling windows; events later than ``late`` are dropped."""
    e = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    g = e.groupBy(F.window("_t", width).alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("start"), key, "n", "total")


def sessions(events: DataFrame, time: str = "ts", key: str = "user_id", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(key, start, end, n) by sessions that end after a gap."""
    e = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    g = e.groupBy(F.session_window("_t", gap).alias("w"), key).agg(F.count("*").alias("n"))
    return g.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_deliveries(rows: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """Each key once, within the watermark."""
    return rows.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late).dropDuplicatesWithinWatermark([key]).drop("_t")


def _part(target: str, checkpoint: str, number: int) -> str:
    """Folder of one batch of one stream, the same whenever the batch runs."""
    return f"{target}/part={hashlib.md5(checkpoint.encode()).hexdigest()[:12]}-{number}"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def upsert_batches(rows: DataFrame, keys: list[str], target: str, checkpoint: str) -> StreamingQuery:
    """Adds to the table at ``target`` the rows of each batch whose keys it lacks.

    A batch has a folder of its own, which is written whole: one that dies half-way
    or comes again leaves nothing twice. Of the table only keys are read.
    """

    def write(batch: DataFrame, number: int) -> None:
        own, spark = _part(target, checkpoint, number), batch.sparkSession
        new = batch.dropDuplicates(keys)
        if _exists(spark, target):
            old = spark.read.parquet(target).where(F.col("part").cast("string") != own.rsplit("=", 1)[1]).select(*keys)
            new = new.join(old, keys, "left_anti")
        new.write.mode("overwrite").parquet(own)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_batches(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Writes what each batch changes of an aggregation, with the batch's number; ``settled`` reads the last of each key. Nothing passes through the driver."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(_part(target, checkpoint, number))

    return rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def settled(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """The last state of each key of a table written by ``latest_batches``."""
    x = spark.read.parquet(target).drop("part")
    rest = [c for c in x.columns if c not in (*keys, "batch")]
    return x.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in rest])
