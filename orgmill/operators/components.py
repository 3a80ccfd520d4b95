"""Duplicates over batches that arrive one after another, without going through earlier rows again.

The state is a folder of tables that are only added to:
- nodes/batch=k: id and the root that it got when batch k came,
- keys/batch=k: each key (reason, key) that batch k has seen first, with the root of its rows then,
- moved/batch=k: roots that batch k has joined to smaller ones: old and new root, with all earlier moves brought up to date.
- done/batch=k: written last; a batch without it has not happened, and its folders are overwritten when it runs again.

A batch aggregates its rows by key, joins the stored keys, and finds components over what it touches: its own rows and the roots
that they meet. Earlier ids and keys are read to find what is met, but nothing of them is relabelled or written; the current
root of a row is its stored root, or where that has moved to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmill.operators.resolve import connected
from orgmill.shared import listed, stored


def _batches(spark: SparkSession, state: str) -> list[int]:
    """Those that have been completed."""
    return listed(spark, f"{state}/done")


def _table(spark: SparkSession, state: str, name: str, batches: list[int], schema: str) -> DataFrame:
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{state}/{name}/batch={k}" for k in batches])


def _kind(batch: DataFrame, id_col: str) -> str:
    return batch.schema[id_col].dataType.simpleString()


def _keys(batch: DataFrame, id_col: str, keys: dict[str, str]) -> DataFrame:
    pairs = [F.struct(F.lit(reason).alias("reason"), F.col(column).cast("string").alias("key")) for reason, column in keys.items()]
    return batch.select(F.col(id_col).alias("id"), F.explode(F.array(*pairs)).alias("k")).select("id", "k.*").where("key is not null and key <> ''")


def add_batch(batch: DataFrame, number: int, state: str, id_col: str, keys: dict[str, str]) -> DataFrame:
    """Adds the rows of batch to the state and returns old, new: the roots that this batch has moved. Ids must not come again
    (an id that does is left out). A number that has been completed is not added again."""
    spark, kind = batch.sparkSession, _kind(batch, id_col)
    done = _batches(spark, state)
    if number in done:
        return spark.read.schema(f"old {kind}, new {kind}").parquet(f"{state}/change/batch={number}")
    if done and number < done[-1]:
        raise ValueError(f"batch {number} is older than {done[-1]}")
    known = _table(spark, state, "nodes", done, f"id {kind}, root {kind}")
    moved = _table(spark, state, "moved", done[-1:], f"old {kind}, new {kind}")
    seen = _table(spark, state, "keys", done, f"reason string, key string, root {kind}")
    rows = stored(batch.dropDuplicates([id_col]).join(known.select(F.col("id").alias(id_col)), id_col, "left_anti"), "batch")
    each = stored(_keys(rows, id_col, keys), "keys")
    least = each.groupBy("reason", "key").agg(F.min("id").alias("own"))
    met = least.join(seen, ["reason", "key"], "left").join(moved, F.col("root") == F.col("old"), "left").select("reason", "key", "own", F.coalesce("new", "root").alias("root"))
    met = stored(met, "met")
    # a row hangs at the smallest row of its key in the batch, that one at the stored root
    links = each.join(met.select("reason", "key", "own"), ["reason", "key"]).select(F.col("id").alias("a"), F.col("own").alias("b")).union(met.where("root is not null").select(F.col("own").alias("a"), F.col("root").alias("b")))
    roots = stored(connected(links), "roots")
    nodes = rows.select(F.col(id_col).alias("id")).join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    nodes.write.mode("overwrite").parquet(f"{state}/nodes/batch={number}")
    fresh = met.where("root is null").select("reason", "key", F.col("own").alias("id")).join(roots, "id", "left")
    fresh.select("reason", "key", F.coalesce("root", "id").alias("root")).write.mode("overwrite").parquet(f"{state}/keys/batch={number}")
    # of the ids in roots, those that are no rows of this batch are earlier roots
    change = roots.join(rows.select(F.col(id_col).alias("id")), "id", "left_anti").where("id <> root").select(F.col("id").alias("old"), F.col("root").alias("new"))
    # a root that new rows with smaller ids take over moves, too; the log also tells of moves of moves
    change.write.mode("overwrite").parquet(f"{state}/change/batch={number}")
    change = spark.read.schema(f"old {kind}, new {kind}").parquet(f"{state}/change/batch={number}")
    again = change.select(F.col("old").alias("via"), F.col("new").alias("last"))
    up_to_date = moved.join(again, F.col("new") == F.col("via"), "left").select("old", F.coalesce("last", "new").alias("new"))
    up_to_date.unionByName(change).write.mode("overwrite").parquet(f"{state}/moved/batch={number}")
    change.limit(0).write.mode("overwrite").parquet(f"{state}/done/batch={number}")
    return change


def current(spark: SparkSession, state: str, kind: str) -> DataFrame:
    """id, kept_id: the smallest id of each row's component, after all completed batches. kind: the type of ids."""
    done = _batches(spark, state)
    nodes = _table(spark, state, "nodes", done, f"id {kind}, root {kind}")
    moved = _table(spark, state, "moved", done[-1:], f"old {kind}, new {kind}")
    return nodes.join(moved, F.col("root") == F.col("old"), "left").select("id", F.coalesce("new", "root").alias("kept_id"))

