"""The log of state transitions as a stream: created on first sight, in order of event time, stages only forward, with states
that expire; and the same log from a table.

A transition counts if its stage is beyond the entity's current one (review and rejection are beyond every stage). An entity's
first row makes it, with a row DISCOVERED at that time. After `idle` without a row its state ends: a later row makes it anew.
"""

from __future__ import annotations

import datetime
import io

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from orgmill.functions import fixed
from orgmill.operators.state import stage_rank

#: n: place in the entity's history, from 0 again after its state has ended.
LOG = "key string, n int, at timestamp, state string, note string"
ROWS = "key string, n int, us long, state string, note string"
RANKS = {s: i for i, s in enumerate(fixed.STAGES)} | {"NEEDS_REVIEW": 999, "REJECTED": 999}
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Into how many parts entities are dealt by a hash: what waits of a part and its current rows are one value of the state each,
#: so calls, timers and rows of the state are bounded by parts and micro-batches, not by entities.
PARTS = 1024
WAITING = pa.schema([("key", pa.string()), ("us", pa.int64()), ("seq", pa.int64()), ("state", pa.string()), ("note", pa.string())])
NOW = pa.schema([("key", pa.string()), ("n", pa.int64()), ("rank", pa.int64()), ("last", pa.int64())])


def _ms(us: int) -> int:
    """Milliseconds of the epoch, rounded up."""
    return -(-us // 1000)


def _packed(rows: list[tuple], schema: pa.Schema) -> bytes:
    out = io.BytesIO()
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    with pa.ipc.new_stream(out, schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as to:
        to.write_table(table)
    return out.getvalue()


def _unpacked(blob: bytes) -> list[tuple]:
    return list(zip(*(c.to_pylist() for c in pa.ipc.open_stream(blob).read_all().columns)))


class StateLog(StatefulProcessor):
    """Rows of a part wait in a list, a value for each micro-batch, until the watermark has passed them, so rows that come late,
    but within its delay, are in order. A timer stands at the part's first waiting row's time, or at the first end of an idle time,
    and handles all that the watermark has passed. A part holds what waits and, until the idle time is over, one row of each
    entity."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.now = handle.getValueState("now", "rows binary, until long")

    def handleInputRows(self, key, rows, timerValues):
        new = [(r["key"], r["us"], r["seq"], r["state"], r["note"]) for r in rows]
        self.waiting.appendValue((_packed(new, WAITING),))
        self.handle.registerTimer(min(_ms(r[1]) for r in new))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        due, passed = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        blob, until = tuple(self.now.get()) if self.now.exists() else (None, None)
        if until is not None and due <= until:
            return iter([])  # another timer of this part has done it
        now = {k: tuple(x) for k, *x in _unpacked(bytes(blob))} if blob is not None else {}
        rows = [r for (b,) in self.waiting.get() for r in _unpacked(bytes(b))] if self.waiting.exists() else []
        ready = sorted((r for r in rows if _ms(r[1]) <= passed), key=lambda r: (r[1], r[2] is not None, r[2]))
        later = [r for r in rows if _ms(r[1]) > passed]
        out = []
        for own, us, _, state, note in ready:
            n, rank, last = now.get(own, (0, 0, None))
            if last is None or _ms(us) - _ms(last) > self.idle_ms:
                n, rank = 1, 0
                out.append(Row(key=own, n=0, us=us, state="DISCOVERED", note=None))
            if RANKS.get(state, 0) > rank:
                rank = RANKS[state]
                out.append(Row(key=own, n=n, us=us, state=state, note=note))
                n += 1
            now[own] = n, rank, us
        if ready:
            self.waiting.clear()
            if later:
                self.waiting.appendValue((_packed(later, WAITING),))
        now = {k: x for k, x in now.items() if passed <= _ms(x[2]) + self.idle_ms}
        if now:
            self.now.update((_packed([(k, *x) for k, x in now.items()], NOW), passed))
        else:
            self.now.clear()
        ends = [_ms(r[1]) for r in later] + [_ms(x[2]) + self.idle_ms + 1 for x in now.values()]
        if ends:
            self.handle.registerTimer(min(ends))
        return iter(out)

    def close(self) -> None:
        pass


def stream_log(events: DataFrame, key: str, delay: str, idle: datetime.timedelta, parts: int = PARTS) -> DataFrame:
    """The log of a stream of at, seq, state, note and key, whose rows are late by delay at most. Needs the state store PROVIDER.
    parts: the same in all runs from one checkpoint."""
    own = events.select(F.col(key).cast("string").alias("key"), "at", F.col("seq").cast("long").alias("seq"), "state", "note").withWatermark("at", delay)
    dealt = own.select(F.pmod(F.xxhash64("key"), F.lit(parts)).alias("part"), "*", F.unix_micros("at").alias("us"))
    processor = StateLog(int(idle / datetime.timedelta(milliseconds=1)))
    rows = dealt.groupBy("part").transformWithState(statefulProcessor=processor, outputStructType=ROWS, outputMode="Append", timeMode="EventTime")
    return rows.select("key", "n", F.timestamp_micros("us").alias("at"), "state", "note")


def batch_log(events: DataFrame, key: str, idle: datetime.timedelta) -> DataFrame:
    """The same log of a table: lives by gaps, and of each life the rows beyond all before."""
    ms = F.ceil(F.unix_micros("at") / 1000)
    own = events.select(F.col(key).cast("string").alias("key"), "at", F.col("seq").cast("long").alias("seq"), "state", "note").withColumn("ms", ms)
    order = W.partitionBy("key").orderBy("at", "seq")
    first = F.coalesce(F.col("ms") - F.lag("ms").over(order) > int(idle / datetime.timedelta(milliseconds=1)), F.lit(True))
    lives = own.withColumn("first", first).withColumn("life", (F.sum(F.col("first").cast("int")).over(order) - 1).cast("int")).withColumn("rank", stage_rank(F.col("state")))
    inside = W.partitionBy("key", "life").orderBy("at", "seq")
    before = F.coalesce(F.max("rank").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    kept = lives.withColumn("before", F.greatest(before, F.lit(0))).where("rank > before").withColumn("n", F.row_number().over(inside))
    start = lives.where("first").select("key", F.lit(0).alias("n"), "at", F.lit("DISCOVERED").alias("state"), F.lit(None).cast("string").alias("note"))
    return start.unionByName(kept.select("key", "n", "at", "state", "note"))
