"""Ordered lists of any length: a key's items in chunks of bounded size, each with its place in the whole.

A row's place within its key comes from two levels of sums. Rows are sorted in ranges of (key, order), so a key on any share of the
rows is many tasks'; a task counts places within its range, and the counts before it of the one key that may go on from earlier
ranges are added. These are one number for each range at most.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgmill.shared import stored

CHUNK = 10_000


def numbered(df: DataFrame, key: str, order: list[str | Column], into: str = "pos") -> DataFrame:
    """df with the place of each row within its key (from 0) by order, nulls first. Rows that order does not tell apart are in
    any order. A null key is a key."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    marked = df.withColumn("__key", F.struct(key))
    sorted_ = marked.repartitionByRange(F.asc_nulls_first(key), *columns).sortWithinPartitions(F.asc_nulls_first(key), *columns)

    def read(batches):
        part, before, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            keys, places = batch.column("__key").to_pylist(), []
            for k in keys:
                n = n + 1 if k == before else 0
                before = k
                places.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(places, pa.int64())], names=[*batch.schema.names, "__part", "__local"])

    schema = T.StructType([*marked.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__local", T.LongType())])
    local = stored(sorted_.mapInArrow(read, schema), "numbered")
    each = local.groupBy("__key", "__part").agg(F.count("*").alias("n"))
    spanning = each.join(each.groupBy("__key").agg(F.count("*").alias("parts")).where("parts > 1").select("__key"), "__key", "left_semi")
    before = F.sum("n").over(W.partitionBy("__key").orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    offsets = spanning.select("__key", "__part", F.coalesce(before, F.lit(0)).alias("__before")).where("__before > 0")  # one for each range at most
    out = local.join(F.broadcast(offsets), ["__key", "__part"], "left")
    return out.withColumn(into, F.col("__local") + F.coalesce("__before", F.lit(0))).select(*df.columns, into)


def chunked(df: DataFrame, key: str, order: list[str], item: str, size: int = CHUNK) -> DataFrame:
    """key, chunk, first (the place of its first item) and items: size of them at most, in order."""
    placed = numbered(df.select(*dict.fromkeys([key, *order, item])), key, order, "__pos")
    each = placed.withColumn("chunk", F.floor(F.col("__pos") / size))
    items = F.transform(F.sort_array(F.collect_list(F.struct("__pos", F.col(item).alias("item")))), lambda x: x["item"])
    return each.groupBy(key, "chunk").agg(items.alias("items")).withColumn("first", F.col("chunk") * size).select(key, "chunk", "first", "items")


def history_chunks(log: DataFrame, key: str, at: str = "at", seq: str = "seq", size: int = CHUNK) -> DataFrame:
    """state_history for entities with any number of transitions."""
    return chunked(log.select(key, at, seq, "state"), key, [at, seq], "state", size)


def group_chunks(resolved: DataFrame, size: int = CHUNK) -> DataFrame:
    """The merged ids of duplicate groups of any size. resolved: id, kept_id."""
    merged = resolved.where("id <> kept_id").select("kept_id", "id", F.col("id").alias("merged"))
    return chunked(merged, "kept_id", ["id"], "merged", size)


def merged_chunks(e: DataFrame, key: str, column: str, size: int = CHUNK) -> DataFrame:
    """merge_lists for entities with any number of items: distinct ones without regard to case, each as first spelt, by
    confidence and arrival."""
    each = e.select(key, "confidence", "seq", F.posexplode(column).alias("place", "item")).where("item is not null")
    first = each.groupBy(key, F.lower(F.trim("item")).alias("same")).agg(F.min(F.struct("confidence", "seq", "place", "item")).alias("x"))
    return chunked(first.select(key, "x.confidence", "x.seq", "x.place", "x.item"), key, ["confidence", "seq", "place"], "item", size)
