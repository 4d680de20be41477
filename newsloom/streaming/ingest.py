"""Incremental collection: landed rows to stored mentions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.dedupe import hard_dedupe, new_only, with_dedupe_hash
from newsloom.operators.stories import assign_online


def landed(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def exact_dedupe(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Every key once for ever: state grows with the keys, as the stored table would."""
    return stream.dropDuplicates(keys)


def bounded_dedupe(stream: DataFrame, keys: list[str], at: str, delay: str = "72 hours") -> DataFrame:
    """A key once within the watermark; a later repetition may come through again."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def daily_counts(stream: DataFrame, at: str, delay: str = "1 day") -> DataFrame:
    return stream.withWatermark(at, delay).groupBy(F.window(at, "1 day").alias("w")).agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("day"), "n")


def sliding_counts(stream: DataFrame, at: str, length: str = "7 days", step: str = "1 day", delay: str = "1 day") -> DataFrame:
    return stream.withWatermark(at, delay).groupBy(F.window(at, length, step).alias("w")).agg(F.count("*").alias("n")).select("w.start", "w.end", "n")


def store_batches(stream: DataFrame, table: str, checkpoint: str, at: str = "published"):
    """Start the collection query: each micro-batch is deduplicated against the table and given stories.

    A batch is written to a folder named by its id and overwrites it, so a
    batch that runs again after a failure leaves the same rows once. Late and
    undated rows are taken like any other.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = hard_dedupe(with_dedupe_hash(batch), ["channel", "dedupe_hash"], ["id"])
        try:
            stored = spark.read.parquet(table).where(F.col("batch") < batch_id)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            stored = spark.createDataFrame([], rows.withColumn("story_id", F.col("id")).schema)
        fresh = new_only(rows, stored, ["channel", "dedupe_hash"])
        placed = fresh.join(assign_online(fresh, stored), "id")
        placed.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
