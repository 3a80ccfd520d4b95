"""A table with keys that micro-batches append to: rows whose key it has already stay out, and a batch reads only what it touches.

Layout of the folder:
- data/batch=k/bucket=b: the rows that micro-batch k has added, by a hash of their keys,
- manifest/batch=k: bucket, n, and a Bloom filter of all keys of the bucket up to then; written last. A batch without a manifest
  has not happened: its rows are not read, and are overwritten when it runs again. A batch with one is not added again.

A batch is reduced to one row for each key. The newest filters of its buckets tell which of its keys may be there; only buckets
with such keys are read, and only such rows are joined. Filters have a fixed size: a full one lets more through to the join, which
decides.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmill.operators.evidence import first_by
from orgmill.shared import listed, stored

BUCKETS, BITS = 64, 1 << 17
MANIFEST = "bucket int, n long, filter binary"


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three bits of each key by its 64-bit hash."""
    h = h.view(np.uint64)
    return tuple((h >> np.uint64(17 * k)).astype(np.int64) % BITS for k in range(3))


def _keyed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn("__hash", F.xxhash64(*keys)).withColumn("bucket", F.pmod(F.shiftright("__hash", 40), F.lit(buckets)).cast("int"))


def _filters(spark: SparkSession, target: str, done: list[int]) -> dict[int, bytes]:
    """The newest filter of each bucket: as many as there are buckets, BITS / 8 bytes each."""
    if not done:
        return {}
    rows = spark.read.schema("batch int, " + MANIFEST).parquet(f"{target}/manifest")
    newest = rows.where(F.col("batch").isin(*done)).groupBy("bucket").agg(F.max_by("filter", "batch").alias("filter"))
    return {r["bucket"]: bytes(r["filter"]) for r in newest.collect()}


def _maybe(filters: dict[int, bytes]):
    @F.pandas_udf("boolean")
    def maybe(h: pd.Series, bucket: pd.Series) -> pd.Series:
        out = np.zeros(len(h), bool)
        for b in bucket.unique():
            if b in filters:
                own, here = np.frombuffer(filters[b], np.uint8), (bucket == b).to_numpy()
                found = np.ones(int(here.sum()), bool)
                for at in _places(h.to_numpy()[here]):
                    found &= (own[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                out[here] = found
        return pd.Series(out)

    return maybe


def _partial(batches):
    """A task's rows by bucket: how many, and their filter."""
    counts: dict[int, int] = {}
    bits: dict[int, np.ndarray] = {}
    for rows in batches:
        for bucket, own in rows.groupby("bucket"):
            counts[bucket] = counts.get(bucket, 0) + len(own)
            mine = bits.setdefault(bucket, np.zeros(BITS, np.uint8))
            for at in _places(own["__hash"].to_numpy()):
                mine[at] = 1
    yield pd.DataFrame({"bucket": list(counts), "n": list(counts.values()), "filter": [np.packbits(bits[b], bitorder="little").tobytes() for b in counts]}, columns=["bucket", "n", "filter"])


def _grown(filters: dict[int, bytes]):
    """For applyInPandas by bucket: the tasks' filters and the one before, together."""

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows.bucket.iloc[0])
        bits = np.frombuffer(filters.get(bucket, bytes(BITS // 8)), np.uint8).copy()
        for own in rows["filter"]:
            bits |= np.frombuffer(own, np.uint8)
        return pd.DataFrame({"bucket": [bucket], "n": [int(rows.n.sum())], "filter": [bits.tobytes()]})

    return grow


def add_batch(batch: DataFrame, number: int, target: str, keys: list[str], order: str, buckets: int = BUCKETS) -> list[int]:
    """Adds the rows of batch whose keys the table does not have, the first of each key by order; returns the buckets that were
    read for it. Key columns must not be named bucket."""
    spark = batch.sparkSession
    done = listed(spark, f"{target}/manifest")
    if number in done:
        return []
    rows = _keyed(first_by(batch, keys, order), keys, buckets)
    filters = _filters(spark, target, done)
    rows = stored(rows.withColumn("__maybe", _maybe(filters)("__hash", "bucket")) if filters else rows.withColumn("__maybe", F.lit(False)), "batch")
    touched = sorted(r["bucket"] for r in rows.where("__maybe").select("bucket").distinct().collect())  # buckets at most
    fresh = rows.where("not __maybe")
    if touched:
        held = read(spark, target, batch.schema, touched).select(*keys).distinct()
        fresh = fresh.unionByName(rows.where("__maybe").join(held, keys, "left_anti").select(rows.columns))
    fresh = stored(fresh, "fresh")
    fresh.drop("__hash", "__maybe").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/data/batch={number}")
    parts = fresh.select("bucket", "__hash").mapInPandas(_partial, MANIFEST)  # one filter for each task and bucket
    parts.groupBy("bucket").applyInPandas(_grown(filters), MANIFEST).write.mode("overwrite").parquet(f"{target}/manifest/batch={number}")
    return touched


def read(spark: SparkSession, target: str, schema, buckets: list[int] | None = None) -> DataFrame:
    """The rows of all completed batches, or of some buckets of them: only their folders are read."""
    done = listed(spark, f"{target}/manifest")
    paths = []
    for k in done:
        own = listed(spark, f"{target}/data/batch={k}", "bucket=")
        paths += [f"{target}/data/batch={k}/bucket={b}" for b in own if buckets is None or b in buckets]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def keep(target: str, keys: list[str], order: str, buckets: int = BUCKETS):
    """For foreachBatch."""

    def add(batch: DataFrame, number: int) -> None:
        add_batch(batch, number, target, keys, order, buckets)

    return add
