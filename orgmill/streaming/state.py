"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmill.operators.evidence import first_by


def read_events(spark: SparkSession, path: str, schema) -> DataFrame:
    """New Parquet files of a folder, with ts as a time zone aware time."""
    return spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def latest_state(events: DataFrame, key: str, at: str = "ts", seq: str = "event_id", state: str = "event_type") -> DataFrame:
    """The current state of each key, in update mode: the group's state is one row."""
    return events.groupBy(key).agg(F.max_by(state, F.struct(at, seq)).alias("state"), F.count("*").alias("n"))


def new_ids(events: DataFrame, key: str, at: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """The first event of each key; state is dropped once the watermark has passed it."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def append_once(target: str, keys: list[str], order: str):
    """For foreachBatch: of rows whose keys the target folder does not hold, the first by order is appended."""

    def append(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = first_by(batch, keys, order)
        try:
            fresh = fresh.join(spark.read.parquet(target).select(*keys).distinct(), keys, "left_anti")
        except AnalysisException as e:  # nothing is written yet
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        fresh.write.mode("append").parquet(target)

    return append


def keep_updates(target: str):
    """For foreachBatch in update mode: the changed rows of each batch, with its number, in a folder. A batch that runs again
    overwrites its own rows."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return write


def latest_update(spark: SparkSession, target: str, key: str) -> DataFrame:
    """The last state of each key that keep_updates has written."""
    rows = spark.read.parquet(target)
    rest = [c for c in rows.columns if c not in (key, "batch")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("row")).select(key, "row.*")
