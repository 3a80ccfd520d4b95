"""Token-id files with one zstandard dictionary.

A file is a folder of two Parquet tables, so it can be in any store that Spark reads:

- dictionary: sha256, dictionary (bytes; empty where training had too little to learn from)
- shards: part, shard (order), first_doc_id, last_doc_id, n_docs, n_ids, start_in_part, width (bytes of an id),
  dictionary_sha256, doc_ids, starts, counts, frame_offsets (little-endian 64-bit arrays), frames

Each document is one zstandard frame of its ids as little-endian unsigned integers, compressed alone with the shared
dictionary. frame_offsets is the index: one document is read by decompressing its frame only. Documents are in
ascending doc_id order (null first; equal ids by a hash of the text), so part, shard and place give each start.

Null texts are empty documents (their end id alone); an empty table gives a file without shards; repeated rows are
written one by one.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgmill.llm.common import lean, slices, texts
from orgmill.llm.word_encoder import WORDS, word_encoder

#: The dictionary is trained on pieces of this many documents, those with the smallest hashes of their ids.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 1000, 16_384, 65_536
#: Bytes of a shard's frames, and of text in one task's range of ids, about.
SHARD_BYTES, RANGE_BYTES = 2 << 20, 64 << 20
SHARDS = "part int, shard int, first_doc_id long, last_doc_id long, n_docs long, n_ids long, start_in_part long, width int, dictionary_sha256 string, doc_ids binary, starts binary, counts binary, frame_offsets binary, frames binary"
NO_ID = -(1 << 63)


def train_dictionary(df: DataFrame, path: str, end_id: int, width: int) -> bytes:
    """Trained on SAMPLE_DOCS pieces of at most SAMPLE_BYTES: what reaches the driver is bounded by their product."""
    docs = texts(df).withColumn("h", F.xxhash64("doc_id"))
    top = docs.select("h").orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h").alias("h")).first()["h"]
    if top is None:
        return b""

    def encode(batches):
        encoder = word_encoder(path)
        for batch in batches:
            for part in slices(batch):
                ids, offsets = encoder.ids(part.column("text"))
                raw = [np.append(ids[a:b], np.uint32(end_id)).astype(f"<u{width}").tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([x[i : i + SAMPLE_BYTES] for x in raw for i in range(0, len(x), SAMPLE_BYTES)], pa.binary())], names=["raw"])
        encoder.keep()

    sample = docs.where(F.col("h") <= top).select("doc_id", "text").mapInArrow(lean(encode, WORDS), "raw binary")
    found = [bytes(r["raw"]) for r in sample.orderBy(F.xxhash64("raw"), "raw").limit(SAMPLE_DOCS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, found).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few or too short samples
        return b""


def write_ids(df: DataFrame, to: str, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", level: int = 3) -> None:
    """Write every document of df. One range shuffle of the texts; each is encoded once, after it."""
    from tokenizers import Tokenizer

    spark = df.sparkSession
    width = 2 if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    docs = texts(df, id_col, text_col)
    dictionary = train_dictionary(docs, path, end_id, width)
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, bytearray(dictionary))], "sha256 string, dictionary binary").coalesce(1).write.parquet(f"{to}/dictionary")

    def shards(batches):
        encoder, part, state = word_encoder(path), TaskContext.get().partitionId(), {"shard": 0, "start": 0}
        packer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        docs_, counts, frames, size = [], [], [], 0

        def row():
            n = np.array(counts, "<i8")
            starts = state["start"] + np.cumsum(n) - n
            at = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<i8")
            names = [None if d == NO_ID else d for d in docs_]
            out = [part, state["shard"], names[0], names[-1], len(docs_), int(n.sum()), state["start"], width, sha, np.array(docs_, "<i8").tobytes(), starts.astype("<i8").tobytes(), n.tobytes(), at.tobytes(), b"".join(frames)]
            state["shard"], state["start"] = state["shard"] + 1, state["start"] + int(n.sum())
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.int32(), pa.string(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(out, kinds)], names=[c.split()[0] for c in SHARDS.split(", ")])

        for batch in batches:
            for some in slices(batch):
                ids, offsets = encoder.ids(some.column("text"))
                for doc, a, b in zip(some.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    own = np.append(ids[a:b], np.uint32(end_id))
                    docs_.append(NO_ID if doc is None else doc)
                    counts.append(len(own))
                    frames.append(packer.compress(own.astype(f"<u{width}").tobytes()))
                    size += len(frames[-1])
                    if size >= SHARD_BYTES:
                        yield row()
                        docs_, counts, frames, size = [], [], [], 0
        if docs_:
            yield row()
        encoder.keep()

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // RANGE_BYTES + 1
    ordered = docs.withColumn("tie", F.xxhash64("text")).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "text").mapInArrow(lean(shards, WORDS), SHARDS).write.parquet(f"{to}/shards")


def read_dictionary(spark: SparkSession, at: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{at}/dictionary").first()
    dictionary = bytes(row["dictionary"])
    if hashlib.sha256(dictionary).hexdigest() != row["sha256"]:
        raise ValueError(f"{at}: the dictionary is not the one that was written")
    return row["sha256"], dictionary


def read_ids(spark: SparkSession, at: str, doc_ids: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if wanted, ids. doc_ids: only these frames are decompressed."""
    sha, dictionary = read_dictionary(spark, at)
    shards = spark.read.parquet(f"{at}/shards")
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row for each task that wrote
    base = totals.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))  # broadcast, so frames stay where they are
    if doc_ids is not None:
        within = F.lit(False)
        for d in doc_ids:
            within = within | F.lit(d).between(F.col("first_doc_id"), F.col("last_doc_id"))
        shards = shards.where(within)
    wanted = None if doc_ids is None else np.array(sorted(doc_ids), np.int64)
    joined = shards.join(F.broadcast(base), "part").select("base", "width", "dictionary_sha256", "doc_ids", "starts", "counts", "frame_offsets", "frames")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def unpack(batches):
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):  # one shard's bytes at a time
                if row["dictionary_sha256"] != sha:
                    raise ValueError("a shard was written with another dictionary")
                docs, starts, counts, at_ = (np.frombuffer(row[k], "<i8") for k in ("doc_ids", "starts", "counts", "frame_offsets"))
                which = np.arange(len(docs)) if wanted is None else np.flatnonzero(np.isin(docs, wanted))
                out = []
                for i in which.tolist():
                    ids = np.frombuffer(reader.decompress(row["frames"][at_[i] : at_[i + 1]]), f"<u{row['width']}").astype("<u4")
                    if len(ids) != counts[i]:
                        raise ValueError("a frame has another length than its index says")
                    out.append((None if docs[i] == NO_ID else int(docs[i]), int(row["base"] + starts[i]), len(ids), zlib.crc32(ids.tobytes()), ids.astype(np.int32) if with_ids else None))
                columns = list(zip(*out)) if out else [[]] * 5
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(kinds)])

    return joined.mapInArrow(lean(unpack), schema)
