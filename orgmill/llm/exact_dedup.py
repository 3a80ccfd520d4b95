"""Exact duplicates by an extendible-hash index on shared files.

Texts are equal when they are after lower-casing A-Z only; of equal texts the row with the largest doc_id stays.

1. One pass gives each row its key (a 64-bit hash of the text in lower case, so texts that differ in the case of other
   letters share a key, and chains are used) and the SHA-256 of its normalised text. Texts stay where they are.
2. The index holds the keys that several rows have. Its directory starts with one bucket; a bucket beyond CAPACITY bytes
   splits by the next bit of the key, and the directory doubles when it has no such bit yet. What Spark counts for it are
   sums by prefix, finer only below prefixes that are overfull. At MAX_DEPTH bits, or with one key alone, a bucket gets
   overflow pages of its own instead.
3. Each task of a second pass joins equal rows of its slice, then sends one row for each text to the bucket's owner (a range of
   keys). Owners sort by key and put texts into the key's chain after comparing bytes; their chains are the index's files
   in the shared folder. Pages of a bucket are chained each for itself, then together, so a key on any share of the rows is
   no task's alone.
4. Rows find their chain's entry by key and SHA-256. An owner that finds different bytes under one SHA-256 raises, and so
   does an index that has not seen every row of its keys (a source that changes between two reads).

Up to BROADCAST_KEYS repeated keys are broadcast, so only their texts move; with more of them the index holds every key.

A null text is empty, and equal to empty ones. A null doc_id is below all others; a group of null ids only has a null
keep_id. Of rows equal in text and doc_id one stays. Further columns of any name are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmill.llm.common import BROADCAST_KEYS, distinct_rows, lean, mix, slices, stored, text_key, texts, without_rows

CAPACITY, OWNER, MAX_DEPTH, STEP = 32 << 20, 64 << 20, 20, 4
CHUNK_BYTES = 16 << 20
#: Groups of more than one row in HEAVY are broadcast when rows look up their group: HEAVY of them at most.
HEAVY = 1000


def key_of(text: Column) -> Column:
    return F.xxhash64(F.lower(text))


def digested(docs: DataFrame) -> DataFrame:
    """doc_id, place, h, key, size and sha of each row of docs (doc_id, place, h, key, text)."""

    def read(batches):
        for batch in batches:
            for part in slices(batch):
                own = [x.lower() for x in part.column("text").cast(pa.binary()).to_pylist()]  # of bytes: A-Z only
                sha = pa.array([hashlib.sha256(x).digest() for x in own], pa.binary())
                size = pa.array([len(x) for x in own], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "place", "h", "key")), size, sha], names=["doc_id", "place", "h", "key", "size", "sha"])

    return docs.select("doc_id", "place", "h", "key", "text").mapInArrow(lean(read), "doc_id long, place long, h long, key long, size long, sha binary")


class Directory:
    """Slots for each prefix of `depth` bits; several slots may name one bucket. A bucket has pages, and its first owner."""

    def __init__(self) -> None:
        self.depth, self.slots, self.local, self.load = 0, np.zeros(1, np.int64), [0], [0]

    def doubled(self) -> None:
        self.depth, self.slots = self.depth + 1, np.repeat(self.slots, 2)

    def split(self, bucket: int, left: int, right: int) -> int:
        """The bucket keeps the lower half of its keys; the upper half goes to a new one, whose number is returned."""
        if self.local[bucket] == self.depth:
            self.doubled()
        own = np.flatnonzero(self.slots == bucket)
        self.local[bucket] += 1
        self.local.append(self.local[bucket])
        self.slots[own[len(own) // 2 :]] = len(self.load)
        self.load[bucket] = left
        self.load.append(right)
        return len(self.load) - 1

    def assign(self, capacity: int, owner_bytes: int) -> None:
        """Pages for each bucket, and owners for ranges of buckets in the order of keys."""
        load = np.array(self.load, np.int64)
        self.pages = np.maximum(1, -(-load // capacity))
        self.owner, now, filled = np.zeros(len(load), np.int64), 0, 0
        for b in dict.fromkeys(self.slots.tolist()):
            if filled and (self.pages[b] > 1 or filled + load[b] > owner_bytes):
                now, filled = now + 1, 0
            self.owner[b] = now
            if self.pages[b] > 1:
                now, filled = now + int(self.pages[b]), 0
            else:
                filled += int(load[b])
        self.owners = now + 1

    def find(self, h: np.ndarray) -> np.ndarray:
        return self.slots[(h.view(np.uint64) >> np.uint64(64 - self.depth)).astype(np.int64)] if self.depth else np.full(len(h), self.slots[0])


def grown(keys: DataFrame, capacity: int, owner_bytes: int, max_depth: int) -> Directory:
    """The directory for keys (h, size: bytes of all its rows): each round counts STEP bits below the prefixes that are overfull,
    so the driver sees sums for 2 ** STEP prefixes below each of them."""
    out, prefix = Directory(), lambda bits: F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")
    total = keys.agg(F.sum("size").alias("size")).first()["size"] or 0
    out.load[0], open_, depth = int(total), {0: 0} if total > capacity else {}, 0  # prefix of depth bits -> its bucket
    while open_ and depth < max_depth:
        bits = min(STEP, max_depth - depth)
        at = keys.sparkSession.createDataFrame([(p,) for p in open_], "p long")
        below = keys.withColumn("p", prefix(depth)).join(F.broadcast(at), "p").groupBy(prefix(depth + bits).alias("q")).agg(F.sum("size").alias("size"), F.min("h").alias("a"), F.max("h").alias("b"))
        found = {r["q"]: (int(r["size"]), r["a"] == r["b"]) for r in below.collect()}
        for k in range(bits):
            following = {}
            for p, bucket in open_.items():
                sums = [[(s, one) for q in range((2 * p + side) << (bits - k - 1), (2 * p + side + 1) << (bits - k - 1)) if (s_one := found.get(q)) for s, one in [s_one]] for side in (0, 1)]
                if sum(map(len, sums)) == 1 and (sums[0] or sums[1])[0][1]:
                    continue  # one key alone: it gets pages
                left, right = (sum(s for s, _ in x) for x in sums)
                new = out.split(bucket, left, right)
                following |= {2 * p + side: b for side, b, s in ((0, bucket, left), (1, new, right)) if s > capacity}
            open_ = following
        depth += bits
    out.assign(capacity, owner_bytes)
    return out


def rows_for_owners(docs: DataFrame, directory: Directory, chunk: int) -> DataFrame:
    """One row for each text of a slice: its owner, its bucket, its key, how many rows have it, and their largest doc_id."""

    def read(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in slices(batch, size=chunk):
                found: dict[tuple[int, bytes], list] = {}
                for h, i, text in zip(some.column("h").to_pylist(), some.column("doc_id").to_pylist(), some.column("text").cast(pa.binary()).to_pylist()):
                    own = found.setdefault((h, text.lower()), [0, None])
                    own[0] += 1
                    own[1] = i if own[1] is None or i is not None and i > own[1] else own[1]
                number += 1
                h = np.array([k for k, _ in found], np.int64)
                bucket = directory.find(h)
                with np.errstate(over="ignore"):
                    page = mix(np.full(len(h), (part << 24) + number, np.uint64)) % directory.pages[bucket].astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(directory.owner[bucket] + page.astype(np.int64)), pa.array(bucket), pa.array(h), pa.array([n for n, _ in found.values()], pa.int64()), pa.array([i for _, i in found.values()], pa.int64()), pa.array([x for _, x in found], pa.binary())], names=["owner", "bucket", "h", "n", "last", "text"])

    return docs.select("h", "doc_id", "text").mapInArrow(lean(read), "owner long, bucket long, h long, n long, last long, text binary")


def chained(rows: Iterator[tuple[int, int, int, int | None, bytes]]) -> Iterator[tuple[int, int, int, int, int | None, bytes, bytes]]:
    """bucket, key, place in the chain, rows, last, SHA-256 and text. rows: sorted by key; only one key's chain is held."""
    key, chain = None, []

    def entries():
        shas = set()
        for v, (bucket, n, last, text) in enumerate(chain):
            sha = hashlib.sha256(text).digest()
            if sha in shas:
                raise RuntimeError("two texts have one SHA-256")
            shas.add(sha)
            yield bucket, key, v, n, last, sha, text

    for bucket, h, n, last, text in rows:
        if h != key:
            yield from entries()
            key, chain = h, []
        for entry in chain:
            if entry[3] == text:
                entry[1] += n
                entry[2] = last if entry[2] is None or last is not None and last > entry[2] else entry[2]
                break
        else:
            chain.append([bucket, n, last, text])
    yield from entries()


INDEX = "bucket long, h long, v int, n long, last long, sha binary, text binary"


def owned(sent: DataFrame, owners: int) -> DataFrame:
    """The chains of each owner's keys."""

    def read(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("bucket", "h", "n", "last", "text")))

        names, kinds = [c.split()[0] for c in INDEX.split(", ")], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        held, size = [], 0
        for entry in chained(rows()):
            held.append(entry)
            size += len(entry[-1])
            if size > CHUNK_BYTES or len(held) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names=names)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*held), kinds)], names=names)

    dealt = sent.repartition(owners, "owner").sortWithinPartitions("owner", "h")
    return dealt.select("bucket", "h", "n", "last", "text").mapInArrow(lean(read), INDEX)


def built(docs: DataFrame, keys: DataFrame, capacity: int, owner_bytes: int, max_depth: int, chunk: int) -> DataFrame:
    """The index over the rows of docs (h, doc_id, text) with these keys, as a table in the shared folder."""
    directory = grown(keys, capacity, owner_bytes, max_depth)
    index = stored(owned(rows_for_owners(docs, directory, chunk), directory.owners), "index")
    paged = [int(b) for b in np.flatnonzero(directory.pages > 1)]
    if not paged:
        return index
    spark, done, before = index.sparkSession, None, None
    while True:  # the chains of a bucket's pages become one: fewer pages each time, or the last one
        apart = index.join(F.broadcast(spark.createDataFrame([(b,) for b in paged], "bucket long")), "bucket", "left_semi")
        rest = index.join(F.broadcast(spark.createDataFrame([(b,) for b in paged], "bucket long")), "bucket", "left_anti")
        done = rest if done is None else done.unionByName(rest)
        size = {r["bucket"]: r["size"] for r in apart.groupBy("bucket").agg(F.sum(F.length("text") + 64).alias("size")).collect()}
        pages = {b: -(-s // capacity) if before is None or s < before.get(b, s + 1) else 1 for b, s in size.items()}
        plan = spark.createDataFrame([(b, int(k)) for b, k in pages.items()], "bucket long, k long")
        sent = apart.join(F.broadcast(plan), "bucket").withColumn("owner", F.xxhash64("bucket", F.expr("xxhash64(h, n, last, v) % k")))
        index, before = stored(owned(sent.select("owner", "bucket", "h", "n", "last", "text"), sum(pages.values())), "index"), size
        paged = [b for b, k in pages.items() if k > 1]
        if not paged:
            return done.unionByName(index)


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Callable[[Column], Column] = key_of, capacity: int = CAPACITY, owner_bytes: int = OWNER, max_depth: int = MAX_DEPTH, chunk: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and key (a hash of the text as it is) for each row of df."""
    docs = texts(df, id_col, text_col).withColumns({"h": key(F.col("text")), "key": text_key("text")})
    rows = stored(digested(docs.withColumn("place", F.monotonically_increasing_id())), "entries")
    keys = stored(rows.groupBy("h").agg(F.count("*").alias("n"), F.sum(F.col("size") + 64).alias("size")), "keys")
    sums = keys.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("repeated"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("own")).first()
    total, expected = sums["n"] or 0, sums["own"] or 0
    if sums["repeated"] <= BROADCAST_KEYS:
        keys = keys.where("n > 1")
        docs = docs.join(F.broadcast(keys.select("h")), "h", "left_semi")
    else:
        expected = total
    index = built(docs, keys, capacity, owner_bytes, max_depth, chunk)
    if (index.agg(F.sum("n")).first()[0] or 0) != expected:
        raise RuntimeError("the table has changed between two reads")
    classes = index.select("h", "sha", F.col("n").alias("group_size"), "last").where("group_size > 1")
    heavy = F.broadcast(classes.where(F.col("group_size") * HEAVY > total))
    light = classes.where(F.col("group_size") * HEAVY <= total)
    # the key says nothing that the SHA-256 does not, but the index is read by it
    found = rows.join(heavy, ["h", "sha"]).unionByName(rows.join(heavy.select("h", "sha"), ["h", "sha"], "left_anti").join(light, ["h", "sha"], "left"), allowMissingColumns=True)
    out = found.select("doc_id", "place", "h", "sha", "key", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("last")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"))
    out = stored(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))), "found")
    ties = out.where("kept and group_size > 1").groupBy("h", "sha").agg(F.max("place").alias("stays"), F.count("*").alias("n")).where("n > 1").select("h", "sha", "stays")
    ties = stored(ties, "ties")
    if n := ties.count():
        out = out.join(F.broadcast(ties) if n <= BROADCAST_KEYS else ties, ["h", "sha"], "left").withColumn("kept", F.col("kept") & (F.col("place") == F.coalesce("stays", "place")))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"), "key")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one row for each text. Texts stay where they are while the rows to drop are few."""
    df = distinct_rows(df, id_col, text_col)
    gone = groups(df, id_col, text_col).where("not kept").select(F.col("doc_id").alias("id"), "key")
    return without_rows(df, gone, id_col, text_col)


ORACLE = """WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS own FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(own) AS text_sha256 FROM d WINDOW w AS (PARTITION BY own)"""
