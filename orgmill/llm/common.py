"""Helpers that several operators of this folder share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmill.shared import settled, shared_path, stored  # noqa: F401  for the operators of this folder

#: ASCII white space: what separates words everywhere in this folder.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes of text that vectorised code handles at once; a longer document is handled alone.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, under fixed names, so no further column of df can clash; a null text is empty."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def held_out(id_col: str, modulus: int, remainder: int):
    """crc32(id as text) mod modulus = remainder; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % modulus == remainder, F.lit(False))


#: Keys that may be broadcast (about 80 bytes each).
BROADCAST_KEYS = 500_000


def free_names(df: DataFrame, *names: str) -> list[str]:
    """names, each with as many _ behind it as it takes for df to have no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_key(text_col: str):
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))


def without_rows(df: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without the rows of gone: id and key, the text_key of the row; a null key stands for all texts of the id.

    Up to BROADCAST_KEYS rows of gone are broadcast, so texts stay where they are; more are joined by a shuffle.
    """
    gone = stored(gone.distinct(), "gone")
    some = gone.agg(F.count("*").alias("n"), F.count_if(F.isnull("key")).alias("whole")).first()
    own, key, id_, key_ = free_names(df, "own_id", "own_key", "gone_id", "gone_key")
    out = df.withColumns({own: F.col(f"`{id_col}`").cast("long"), key: text_key(text_col)})
    for part, n, on in (
        (gone.where("key is null"), some["whole"], F.col(own) == F.col(id_)),
        (gone.where("key is not null"), some["n"] - some["whole"], F.col(own).eqNullSafe(F.col(id_)) & (F.col(key) == F.col(key_))),
    ):
        part = part.select(F.col("id").alias(id_), F.col("key").alias(key_))
        if n:
            out = out.join(F.broadcast(part) if n <= BROADCAST_KEYS else part, on, "left_anti")
    return out.drop(own, key)


def distinct_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one row for each id and text; rows without an id stay all. Only repeated rows are shuffled."""
    own, key, id_, key_ = free_names(df, "own_id", "own_key", "again_id", "again_key")
    out = df.withColumns({own: F.col(f"`{id_col}`").cast("long"), key: text_key(text_col)})
    again = out.where(F.col(own).isNotNull()).groupBy(own, key).agg(F.count("*").alias("n")).where("n > 1").select(F.col(own).alias(id_), F.col(key).alias(key_))
    again = stored(again, "again")
    n = again.count()
    if not n:
        return df
    if n > BROADCAST_KEYS:
        once = out.where(F.col(own).isNotNull()).dropDuplicates([own, key])
        return once.unionByName(out.where(F.col(own).isNull())).drop(own, key)
    on = (F.col(own) == F.col(id_)) & (F.col(key) == F.col(key_))
    once = out.join(F.broadcast(again), on, "left_semi").dropDuplicates([own, key])
    return out.join(F.broadcast(again), on, "left_anti").unionByName(once).drop(own, key)


#: What this worker keeps between tasks: its name, and what forgets it.
_kept: dict[str, Callable[[], None]] = {}


def keep_until_others(name: str, forget: Callable[[], None]) -> None:
    """Has forget called when a task comes that does not use what is kept under this name."""
    _kept[name] = forget


def forget_others(name: str | None) -> None:
    for other in [x for x in _kept if x != name]:
        _kept.pop(other)()


def lean(read, keeps: str | None = None):
    """read, for mapInArrow or applyInArrow, giving freed memory back to the system when it ends: Spark keeps Python
    workers for later tasks, and what one operator needed at its peak should not count against the next. What is kept
    between tasks is forgotten, but for keeps."""

    def run(data):
        forget_others(keeps)
        try:
            out = read(data)
            if not isinstance(out, pa.Table):
                out = _drained(out)
            return out
        finally:
            release()

    return run


def lean_pair(read):
    """lean for cogrouped applyInArrow."""

    def run(left, right):
        forget_others(None)
        try:
            return read(left, right)
        finally:
            release()

    return run


def _drained(batches):
    try:
        yield from batches
    finally:
        release()


def release() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than GNU's
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the len + 1 offsets of its values; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, name: str = "text", size: int = SLICE_BYTES):
    """Runs of rows with about size bytes of text together."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False), np.int64)
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if total and total + n > size:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
LOWER_CODE = BYTE_CODE.copy()
LOWER_CODE[65:91] = BYTE_CODE[97:123]
BASE = 0xD6E8FEB86659FD93
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """BASE to the powers from 0 to n - 1, modulo 2 to the 64th."""
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n, 4096), BASE, np.uint64))])
    return _powers[:n]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word of all the texts, and each text's first word (len + 1 numbers)."""
    n, keep = len(data), ~SPACE[data]
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = ~keep[:-1], ~keep[1:]
    first = offsets[:-1]
    before[first[first < n]] = True
    last = offsets[1:] - 1
    after[last[last >= 0]] = True
    starts, ends = np.flatnonzero(keep & before), np.flatnonzero(keep & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray = LOWER_CODE) -> np.ndarray:
    """A 64-bit hash of each word; by default A-Z count as a-z."""
    lengths = ends - starts
    if not len(starts) or not lengths.all():  # an empty word has the hash of 0
        out, some = np.full(len(starts), mix(np.zeros(1, np.uint64))[0]), lengths > 0
        if some.any():
            out[some] = word_hashes(data, starts[some], ends[some], code)
        return out
    at = np.cumsum(lengths) - lengths
    within = np.arange(lengths.sum()) - np.repeat(at, lengths)
    values = code[data[np.repeat(starts, lengths) + within]] * powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(values, at) + lengths.astype(np.uint64))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] numbers, then the same for the others."""
    at = np.cumsum(lengths) - lengths
    return np.repeat(starts - at, lengths) + np.arange(int(lengths.sum()))


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays byte plane by byte plane, compressed."""
    raw = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b"" for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def released(blob: bytes, *kinds: tuple[int, str]) -> list[np.ndarray]:
    raw, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8), 0, []
    for n, kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).ravel() if n else np.zeros(0, kind))
        at += n * size
    return out
