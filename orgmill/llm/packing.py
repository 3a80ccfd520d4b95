"""Best-fit packing of token sequences by exact complements.

Only the histogram of piece lengths is planned, so the plan's size depends on the capacity and not on the number
of documents. For the largest length left, its gap is looked up among single lengths, sums of pairs and sums of
triples that are still available; the combination that fills the gap exactly is consumed as often as all its counts
allow. Where nothing fills it exactly, the sequence is completed by best fit. Each step uses up at least one length.

Null texts are empty documents (their end id alone); an empty table gives no rows; repeated rows are packed one by
one; a null doc_id stays null.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgmill.llm.common import lean, slices, stored, texts
from orgmill.llm.word_encoder import WORDS, word_encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Rows of one length that are numbered by one task, about.
ROWS_A_BUCKET = 50_000


def pieces(df: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most capacity ids of each document with its end id."""

    def cut(batches):
        encoder = word_encoder(path)
        for batch in batches:
            for part in slices(batch, size=1 << 20):  # an encoder's arrays take some 15 times its texts
                ids, offsets = encoder.ids(part.column("text"))
                rows = []
                for doc, a, b in zip(part.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                    for k, start in enumerate(range(0, len(own), capacity)):
                        piece = own[start : start + capacity]
                        rows.append((doc, k, start, len(piece), zlib.crc32(piece.tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        encoder.keep()

    return texts(df, id_col, text_col).mapInArrow(lean(cut, WORDS), PIECES)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns [(length, copies in a sequence), ...] and the number of sequences of each."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns = []

    def take(items: list[int]) -> None:
        lengths, copies = np.unique(items, return_counts=True)
        times = int((left[lengths] // copies).min())
        left[lengths] -= times * copies
        patterns.append(([(int(n), int(k)) for n, k in zip(lengths[::-1], copies[::-1])], times))

    def enough(items: tuple[int, ...]) -> bool:
        return all(left[x] >= items.count(x) for x in items)

    def pair(gap: int, own: tuple[int, ...]) -> tuple[int, int] | None:
        """The pair with this sum whose larger part is largest, counting what own already uses."""
        if gap < 2:
            return None
        high = np.arange(gap - 1, (gap - 1) // 2, -1)
        for a in high[(left[high] > 0) & (left[gap - high] > 0)].tolist():
            if enough((*own, a, gap - a)):
                return a, gap - a
        return None

    def exact(length: int) -> list[int] | None:
        gap = capacity - length
        if gap == 0:
            return [length]
        if left[gap] and enough((length, gap)):
            return [length, gap]
        if two := pair(gap, (length,)):
            return [length, *two]
        for a in present[(present < gap)].tolist():
            if sums[gap - a] and enough((length, a)) and (two := pair(gap - a, (length, a))):
                return [length, a, *two]
        return None

    while left.any():
        present = np.flatnonzero(left)[::-1]
        sums = np.zeros(capacity + 1, bool)  # sums of two lengths that are present
        for a in present.tolist():
            sums[a + present[present <= capacity - a]] = True
        spent = 0
        while left.any() and spent < 64:  # then the index of sums is built anew
            length = int(np.flatnonzero(left)[-1])
            if not (items := exact(length)):
                items, gap = [length], capacity - length
                while gap:
                    fits = [n for n in np.flatnonzero(left[: gap + 1])[::-1].tolist() if enough((*items, n))][:1]
                    if not fits:
                        break
                    items.append(fits[0])
                    gap -= fits[0]
                    if gap and left[gap] and enough((*items, gap)):
                        items.append(gap)
                        gap = 0
            take(items)
            spent += 1
    return patterns


def slots(patterns: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, copies, offset): which ranks of a length go where."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for items, times in patterns:
        offset = 0
        for length, copies in items:
            first = used.get(length, 0)
            rows.append((length, first, first + times * copies, sequence, copies, offset))
            used[length] = first + times * copies
            offset += length * copies
        sequence += times
    return rows


def pack(df: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces with sequence_id and offset. Texts are encoded once; the rest moves a few numbers for each piece."""
    cut = stored(pieces(df, path, capacity, end_id, id_col, text_col), "pieces")
    spark = df.sparkSession
    counts = {int(r["length"]): r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    buckets = max(1, sum(counts.values()) // ROWS_A_BUCKET)
    placed = spark.createDataFrame(slots(plan(counts, capacity)), "length long, low long, high long, first_sequence long, copies long, at long")
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    before = cut.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = before.select("length", "bucket", (F.sum("n").over(W.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    within = F.row_number().over(W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = cut.withColumn("within", within).join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("within") - 1)
    p = placed.select(F.col("length").alias("slot_length"), "low", "high", "first_sequence", "copies", "at")
    joined = ranked.join(F.broadcast(p), (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    nth = F.col("rank") - F.col("low")
    return joined.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.floor(nth / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("copies")) * F.col("length")).cast("long").alias("offset"),
    )
