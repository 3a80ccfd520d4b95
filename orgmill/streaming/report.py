"""The run report kept current while states change: what an entity's old row has added is taken back when it changes."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from orgmill.shared import listed

#: What a row adds, each a whole number, so that taking back is exact.
SHARES = ("discovered", "processed", "approved", "review", "rejected", "duplicates", "completeness_sum", "completeness_n", "confidence_sum", "confidence_n")
ROW = "version long, state string, last_error string, completeness long, source_confidence long"
DELTA = ", ".join(f"{c} long" for c in SHARES)
#: Into how many parts entities are dealt by a hash: a part's last rows are one value of the state.
BUCKETS = 1024


def shares() -> list[Column]:
    """What a row adds."""
    state, duplicate = F.col("state"), F.coalesce(F.col("last_error") == "duplicate", F.lit(False))
    one = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    measured = [x for c in ("completeness", "source_confidence") for x in (F.coalesce(c, F.lit(0)), one(F.col(c).isNotNull()))]
    counts = [F.lit(1), one(state.isin("JSON_READY", "APPROVED", "NEEDS_REVIEW")), one(state == "APPROVED"), one(state == "NEEDS_REVIEW"), one((state == "REJECTED") & ~duplicate), one(duplicate)]
    return [x.cast("long").alias(c) for c, x in zip(SHARES, counts + measured)]


def _packed(ids: np.ndarray, numbers: np.ndarray) -> bytes:
    out = io.BytesIO()
    table = pa.table({"id": pa.array(ids, pa.string()), **{c: numbers[:, k] for k, c in enumerate(("version", *SHARES))}})
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as to:
        to.write_table(table)
    return out.getvalue()


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    table = pa.ipc.open_stream(blob).read_all()
    return table["id"].to_numpy(), np.column_stack([table[c].to_numpy() for c in table.column_names[1:]])


class Changes(StatefulProcessor):
    """Value state: version and shares of the last row of each entity of a part. Newer ones give the difference between what
    the two add, summed over the part; older ones give nothing."""

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "rows binary")

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(list(rows), ignore_index=True).sort_values(["version", "tie"]).drop_duplicates("id", keep="last")
        ids, numbers = new["id"].to_numpy(object), new[["version", *SHARES]].to_numpy(np.int64)
        known, old = _unpacked(bytes(self.last.get()[0])) if self.last.exists() else (np.zeros(0, object), np.zeros((0, 1 + len(SHARES)), np.int64))
        at = pd.Index(known).get_indexer(ids)
        there = at >= 0
        newer = np.flatnonzero(there)[numbers[there, 0] > old[at[there], 0]]
        delta = numbers[~there, 1:].sum(0) + numbers[newer, 1:].sum(0) - old[at[newer], 1:].sum(0)
        old = old.copy()
        old[at[newer]] = numbers[newer]
        self.last.update((_packed(np.concatenate([known, ids[~there]]), np.concatenate([old, numbers[~there]])),))
        yield pd.DataFrame([delta], columns=list(SHARES))

    def close(self) -> None:
        pass


def changes(states: DataFrame, key: str = "id", buckets: int = BUCKETS) -> DataFrame:
    """A row of differences for each part (of buckets, the same in all runs from one checkpoint) whose entities a micro-batch of
    states (id, version, state, last_error, completeness, source_confidence) changes. Of an entity's rows of one version in a
    micro-batch the greatest counts, nulls first. Needs the RocksDB state store."""
    own = states.select(F.col(key).cast("string").alias("id"), *[F.col(c.split()[0]).cast(c.split()[1]) for c in ROW.split(", ")])
    tie = F.concat_ws("\0", *[F.coalesce(F.concat(F.lit("1"), F.col(c).cast("string")), F.lit("0")) for c in ("state", "last_error", "completeness", "source_confidence")])
    rows = own.select(F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("part"), "id", "version", tie.alias("tie"), *shares())
    return rows.groupBy("part").transformWithStateInPandas(statefulProcessor=Changes(), outputStructType=DELTA, outputMode="Update", timeMode="None")


def keep_totals(target: str):
    """For foreachBatch of changes: the totals after each micro-batch, one row in a folder of its number. A batch that runs
    again starts from the totals before it."""

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        delta = batch.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SHARES])
        before = [k for k in listed(spark, target) if k < number]
        if before:
            delta = delta.unionByName(spark.read.schema(DELTA).parquet(f"{target}/batch={max(before)}"))
        delta.agg(*[F.sum(c).alias(c) for c in SHARES]).coalesce(1).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return add


def report(spark: SparkSession, target: str, scope: str | None = None, number: int | None = None) -> DataFrame:
    """The run report after micro-batch number (the last one), as run_report gives it for all current states."""
    done = listed(spark, target)
    rows = spark.read.schema(DELTA).parquet(f"{target}/batch={max(done) if number is None else number}") if done else spark.createDataFrame([(0,) * len(SHARES)], DELTA)
    mean = lambda c: F.coalesce(F.floor(F.col(f"{c}_sum") / F.nullif(F.col(f"{c}_n"), F.lit(0)) + 0.5), F.lit(0)).cast("int").alias(f"mean_{c}")
    return rows.select("discovered", "processed", "approved", "review", "rejected", "duplicates", mean("completeness"), mean("confidence"), F.lit(scope).cast("string").alias("scope"))
