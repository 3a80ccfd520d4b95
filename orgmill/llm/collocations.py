"""Phrases of 2 to LONGEST words that occur together more often than their parts would, by dynamic itemset counting.

Texts (A-Z as a-z) are cut into pieces at .,;:!? and line ends, pieces into words at spaces and tabs. Everything is counted for
each language by itself. A phrase with LEAST occurrences or more is a candidate; its worst cut into two phrases gives its score,
floor(1000 a n / (l r)); candidates that a longer candidate with as many occurrences holds are dropped; the first TOP of each
language stay.

1. Documents are stored once in SHARDS shards by a hash of their id, which are scanned in a cycle. A phrase is counted from
   the step after both its longest parts (all but the last word, all but the first) have reached LEAST, for one full cycle, so
   lengths interleave: no length waits for the one below it. Single words count from the first step.
2. A step's tasks count the active phrases of their slices by 64-bit hashes of the words and the language, and Spark adds them
   to the table of counts so far, which is written anew. A phrase whose cycle is over leaves that table: to the frequent ones
   or for good. As every part of a frequent phrase is frequent, each frequent phrase has counted in every shard. After the
   first cycle, when all words are counted, the shards are written once more, as runs of numbers of frequent words.
3. The tasks know the phrases that have reached LEAST, and when, by a sorted array of their hashes, at most KNOWN of them. With more,
   counting starts anew, a length for each scan, and the tasks know the phrases one word shorter by a Bloom filter of fixed size:
   what it lets through wrongly is counted too, and has fewer than LEAST occurrences.
4. A last scan gives the frequent phrases' words, and the hashes of all their parts. With each count goes a group of documents
   (of GROUPS) that have the phrase, so few tasks send a phrase. Parts, scores, longer candidates and ranks are joins, sums and a
   window with exact decimals.

A null text is empty, a null language is und. Repeated rows count each. Further columns are ignored. An empty table gives no
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgmill.llm.common import BASE, LOWER_CODE, buffers, lean, mix, powers, ragged, released, slices, squeezed, stored
from orgmill.shared import deleted, shared_path

LONGEST, LEAST, TOP, SHARDS, GROUPS = 5, 100, 2000, 3, 64
KNOWN, FILTER_BITS = 4_000_000, 27
CHUNK_BYTES, BLOCK_BYTES, PENDING = 8 << 20, 2 << 20, 3_000_000
#: 0: part of a word, 1: between words, 2: between pieces.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
NEXT = np.uint64(0x9E3779B97F4A7C15)


INVERSE = pow(BASE, -1, 1 << 64)
_inverses = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    global _inverses
    if len(_inverses) < n:
        with np.errstate(over="ignore"):
            _inverses = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, INVERSE, np.uint64))])
    return _inverses[:n]


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word by its letters (A-Z as a-z) and its length: differences of running sums, block by block."""
    out = np.zeros(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        begin = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, begin + BLOCK_BYTES, side="right")))
        end = int(ends[last - 1])
        size = end - begin
        with np.errstate(over="ignore"):
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(LOWER_CODE[data[begin:end]] * powers(max(size, BLOCK_BYTES))[:size], out=sums[1:])
            a, b = starts[first:last] - begin, ends[first:last] - begin
            out[first:last] = mix((sums[b] - sums[a]) * inverse_powers(max(size, BLOCK_BYTES))[a] + (b - a).astype(np.uint64))
        first = last
    return out


class Windows:
    """The words of a slice, and the hashes of its phrases by length and first word."""

    def __init__(self, part: pa.RecordBatch):
        self.data, offsets = buffers(part.column("text"))
        kind = KIND[self.data]
        keep, n = kind == 0, len(self.data)
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = ~keep[:-1], ~keep[1:]
        first, last = offsets[:-1], offsets[1:] - 1
        before[first[first < n]] = True
        after[last[last >= 0]] = True
        self.starts, self.ends = np.flatnonzero(keep & before), np.flatnonzero(keep & after) + 1
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(self.starts, offsets)))
        breaks = np.searchsorted(np.flatnonzero(kind == 2), self.starts).astype(np.int32)  # those before each word
        del kind, keep, before, after
        self.joined = np.zeros(len(self.starts), bool)  # the next word is in the same piece
        if len(self.starts) > 1:
            self.joined[:-1] = (breaks[:-1] == breaks[1:]) & (doc[:-1] == doc[1:])
        self.doc, self.langs, self.groups = doc.astype(np.int32), part.column("lang_h").to_numpy().view(np.uint64), part.column("g").to_numpy().astype(np.uint8)
        self.group = self.groups[self.doc]
        with np.errstate(over="ignore"):
            self.words = hashed(self.data, self.starts, self.ends)
            self.words += mix(self.langs)[self.doc]
            self.words = mix(self.words)

    def hash_at(self, at: np.ndarray, length: int, shorter: np.ndarray) -> np.ndarray:
        """Of the phrases at some places, by the hashes of those without their last word."""
        with np.errstate(over="ignore"):
            return mix(shorter[at] * NEXT + self.words[at + length - 1] + np.uint64(length))

    def find_words(self, known) -> tuple[np.ndarray, np.ndarray]:
        return known.find(self.words)

    def phrase(self, i: int, length: int) -> str:
        return b" ".join(self.data[self.starts[k] : self.ends[k]].tobytes().lower() for k in range(i, i + length)).decode()


class Runs(Windows):
    """The same of a slice that has been written as runs of two frequent words or more."""

    def __init__(self, blob: bytes, n: int, m: int, singles: np.ndarray):
        self.ids, lengths, groups = released(blob, (n, "<u4"), (m, "<u4"), (m, "u1"))
        self.singles, self.words = singles, singles[self.ids]
        self.group = np.repeat(groups, lengths)
        self.joined = np.ones(n, bool)
        self.joined[np.cumsum(lengths, dtype=np.int64) - 1] = False

    def find_words(self, known) -> tuple[np.ndarray, np.ndarray]:
        there, new = known.find(self.singles)
        return there[self.ids], new[self.ids]


class Exact:
    """The phrases that have reached LEAST before this step: sorted hashes, and which of them in the last cycle. As hashes are
    spread evenly, a table of places by first bits finds them."""

    def __init__(self, hashes: np.ndarray, recent: np.ndarray):
        self.hashes, self.recent = hashes, recent
        self.bits = max(8, int(len(hashes) * 4).bit_length())
        counts = np.bincount((hashes >> np.uint64(64 - self.bits)).astype(np.int64), minlength=1 << self.bits)
        self.most = int(counts.max(initial=0))
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)

    def __reduce__(self):  # tasks make the table of places themselves
        return Exact, (self.hashes, self.recent)

    def place(self, h: np.ndarray) -> np.ndarray:
        """Where each of h is among the known ones, -1 where it isn't."""
        out = np.full(len(h), -1, np.int32)
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int32)
        low, high = self.first[slot], self.first[slot + 1]
        left = np.flatnonzero(low < high)
        low, high, own = low[left], high[left], h[left]
        for _ in range(self.most):
            hit = self.hashes[low] == own
            out[left[hit]] = low[hit]
            low = low + 1
            more = ~hit & (low < high)
            left, low, high, own = left[more], low[more], high[more], own[more]
            if not len(left):
                break
        return out

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of h have reached it, and which in the last cycle."""
        at = self.place(h)
        there = at >= 0
        new = there.copy()
        new[there] = self.recent[at[there]]
        return there, new


class Bloom:
    """A superset of a set of hashes, in 2 ** bits bits whatever its size."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @staticmethod
    def places(h: np.ndarray, bits: int) -> list[np.ndarray]:
        with np.errstate(over="ignore"):
            return [mix(h + np.uint64(k)) >> np.uint64(64 - bits) for k in (1, 2)]

    @staticmethod
    def of(keys: DataFrame, bits: int = FILTER_BITS) -> Bloom:
        """Blocks of bits are made by Spark, so the driver sees 2 ** bits bits and no key."""
        block = 15

        def places(batches):
            for batch in batches:
                at = np.unique(np.concatenate(Bloom.places(batch.column("h").to_numpy().view(np.uint64), bits))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at >> block), pa.array(at & ((1 << block) - 1))], names=["block", "at"])

        def packed(table: pa.Table) -> pa.Table:
            own = np.zeros(1 << block, bool)
            own[table["at"].to_numpy()] = True
            return pa.table({"block": table["block"][:1], "own": pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())})

        out = np.zeros(max(1 << bits, 1 << block) // 8, np.uint8)
        set_ = keys.select("h").mapInArrow(lean(places), "block long, at long").distinct()
        for r in set_.groupBy("block").applyInArrow(lean(packed), "block long, own binary").collect():
            out[r["block"] << (block - 3) : (r["block"] + 1) << (block - 3)] = np.frombuffer(r["own"], np.uint8)
        return Bloom(out)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits = (len(self.table) * 8 - 1).bit_length()
        there = np.ones(len(h), bool)
        for at in Bloom.places(h, bits):
            there &= (self.table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return there, there


def active(win: Windows, known: Exact | Bloom | None, singles: bool, longest: int, only: int | None = None):
    """(length, places, hashes) of the phrases to count: both longest parts have reached LEAST, one of them in the last cycle. only:
    the length to count, all shorter ones being complete."""
    if singles:
        yield 1, np.arange(len(win.words)), win.words
    if known is None or not len(win.words):
        return
    at, n = np.arange(len(win.words)), len(win.words)
    there, new = win.find_words(known)
    h = win.words
    for length in range(2, longest + 1):
        ok, recent, shorter = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, np.uint64)
        ok[at[there]], recent[at[new]], shorter[at] = True, True, h
        # both parts are inside one piece, so the phrase is, too
        at = np.flatnonzero(ok[:-1] & ok[1:] & win.joined[: n - 1])
        at = at[at <= n - length]
        if not len(at):
            return
        h = win.hash_at(at, length, shorter)
        if only is None or only == length:
            some = recent[at] | recent[at + 1]
            yield length, at[some], h[some]
        if only == length:
            return
        if only is None and not recent.any() and not isinstance(known, Bloom) and not known.recent.any():
            return
        there, new = known.find(h)


COUNTS = "h long, c long, p long"


def counted(win: Windows, step: int, known: Exact | Bloom | None, singles: bool, longest: int, only: int | None = None):
    """Hashes, counts and p of a slice: of its phrases, and of its languages."""
    found = [(h, ((step * GROUPS + win.group[at].astype(np.int32)) * 8 + length).astype(np.int32)) for length, at, h in active(win, known, singles, longest, only)]
    found = [(h, np.ones(len(h), np.int32), p) for h, p in found if len(h)]
    if found:
        yield summed(found)
    if singles and len(win.words):
        langs, index = np.unique(win.langs, return_inverse=True)
        yield langs, np.bincount(index[win.doc], minlength=len(langs)), np.full(len(langs), step * GROUPS * 8, np.int32)


def summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, c, p = (np.concatenate(x) for x in zip(*parts))
    parts.clear()
    order = np.argsort(h)
    h, c, p = h[order], c[order], p[order]
    edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[edge], np.add.reduceat(c, edge, dtype=np.int64), np.minimum.reduceat(p, edge)


def sent(parts):
    """Slices' counts of a task, added up until they are many."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size > PENDING:
            h, c, p = summed(held)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c), pa.array(p.astype(np.int64))], names=["h", "c", "p"])
            size = 0
    if held:
        h, c, p = summed(held)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c), pa.array(p.astype(np.int64))], names=["h", "c", "p"])


def scan(docs: DataFrame, step: int, known: Exact | Bloom | None, singles: bool, longest: int, only: int | None = None) -> DataFrame:
    """h, c and p = ((step * GROUPS + group) * 8 + length) of the active phrases, added up in each task; c of a language's own hash
    is its words."""

    def read(batches):
        parts = (part for batch in batches for part in slices(batch, size=CHUNK_BYTES))
        return sent(x for part in parts for x in counted(Windows(part), step, known, singles, longest, only))

    return docs.select("text", "lang_h", "g").mapInArrow(lean(read), COUNTS)


def scan_runs(shard: DataFrame, singles: np.ndarray, step: int, known: Exact, longest: int) -> DataFrame:
    """The same of a shard that is written as runs."""

    def read(batches):
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "blob"))))
        return sent(x for n, m, blob in rows for x in counted(Runs(blob, n, m, singles), step, known, False, longest))

    return shard.select("n", "m", "blob").mapInArrow(lean(read), COUNTS)


def written_runs(docs: DataFrame, singles: np.ndarray, path: str) -> None:
    """Each slice as runs of two frequent words or more, which are numbers: places in singles (sorted hashes)."""
    known = Exact(singles, np.ones(len(singles), bool))

    def read(batches):
        for batch in batches:
            for shard in np.unique(batch.column("shard").to_numpy()).tolist():
                own = batch.filter(pa.array(batch.column("shard").to_numpy() == shard))
                for part in slices(own, size=CHUNK_BYTES):
                    win = Windows(part)
                    at = known.place(win.words)
                    inside = (at >= 0) & np.append(win.joined[:-1] & (at[1:] >= 0), False)[: len(at)]  # goes on to the next word
                    begins = np.flatnonzero(inside & ~np.append(False, inside[:-1])[: len(at)])
                    stops = np.flatnonzero(inside & ~np.append(inside[1:], False)[: len(at)]) + 2
                    lengths = stops - begins
                    ids = at[ragged(begins, lengths)].astype(np.uint32)
                    row = shard, len(ids), len(begins), squeezed(ids, lengths.astype(np.uint32), win.group[begins])
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=["shard", "n", "m", "blob"])

    docs.select("text", "lang_h", "g", "shard").mapInArrow(lean(read), "shard int, n long, m long, blob binary").write.partitionBy("shard").parquet(path)


def added(*counts: DataFrame) -> DataFrame:
    both = counts[0]
    for x in counts[1:]:
        both = both.unionByName(x)
    return both.groupBy("h").agg(F.sum("c").alias("c"), F.min("p").alias("p"))


def step_of(p) -> object:
    return F.floor(p / (8 * GROUPS)).cast("long")


def cyclic(docs: DataFrame, least: int, longest: int, shards: int, known_most: int) -> DataFrame | None:
    """h, c, p of the frequent phrases; None if more than known_most are known. docs: with the number of their shard."""
    spark, runs, singles = docs.sparkSession, None, None
    hashes, steps = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    state, frequent, step, last = None, [], 0, -1
    while step < shards or step <= last + shards:
        known, at = Exact(hashes, steps >= step - shards), F.col("shard") == step % shards
        found = scan(docs.where(at), step, known, True, longest) if step < shards else scan_runs(runs.where(at), singles, step, known, longest)
        path, before = shared_path(spark, "counts"), state
        (added(found) if state is None else added(state[0], found)).write.parquet(path)
        now = spark.read.schema(COUNTS).parquet(path)
        reached = now.where(F.col("c") >= least)
        if len(hashes) + reached.count() > known_most:
            return None
        rows = reached.select("h", (F.col("p") % 8).alias("length")).toPandas()
        h, length = rows.h.to_numpy(np.int64).view(np.uint64), rows.length.to_numpy(np.int64)
        new = (known.place(h) < 0) & (length > 0)
        if (new & (length < longest)).any():
            last = step
        hashes, steps = np.concatenate([hashes, h[new]]), np.concatenate([steps, np.full(int(new.sum()), step)])
        order = np.argsort(hashes)
        hashes, steps = hashes[order], steps[order]
        over = step_of(F.col("p")) <= step - shards + 1  # its cycle ends with this step at the latest
        frequent.append(stored(reached.where(over), "frequent"))
        state = (now.where(~over), path)
        if before:
            deleted(spark, before[1])
        step += 1
        if step == shards and step <= last + shards:  # every word has been counted
            words = now.where((F.col("c") >= least) & (F.col("p") % 8 == 1)).select("h")
            for x in frequent:
                words = words.unionByName(x.where("p % 8 = 1").select("h"))
            singles = np.unique(words.toPandas().h.to_numpy(np.int64).view(np.uint64))
            path = shared_path(spark, "runs")
            written_runs(docs, singles, path)
            runs = spark.read.schema("n long, m long, blob binary, shard int").parquet(path)
    # rare in the first shards of their cycle, and therefore seen late: complete by now, too
    out = state[0].where(F.col("c") >= least)
    for x in frequent:
        out = out.unionByName(x)
    return out


def by_length(docs: DataFrame, least: int, longest: int, bits: int) -> DataFrame:
    """The same by one scan for each length, with what is known in a filter of fixed size."""
    out = stored(added(scan(docs, 0, None, True, 1)).where(F.col("c") >= least), "frequent")
    level, every = out, out
    for length in range(2, longest + 1):
        level = stored(added(scan(docs, 0, Bloom.of(every, bits), False, longest, length)).where(F.col("c") >= least), "frequent")
        every = every.unionByName(level)
    return every


PHRASES = "h long, lang_h long, phrase string, prefixes array<long>, suffixes array<long>, inside array<long>"


def phrases(docs: DataFrame, frequent: DataFrame, known: Exact | Bloom, groups: np.ndarray | None, longest: int) -> DataFrame:
    """Of each frequent phrase of 2 words or more its words, and the hashes of its parts: the first k words, the others, and all
    shorter phrases of 2 words or more inside. known: all frequent ones; groups: which group of documents has each."""

    def read(batches):
        for batch in batches:
            for part in slices(batch, size=CHUNK_BYTES):
                win, rows = Windows(part), []
                n = len(win.words)
                at, h, there = np.arange(n), win.words, win.find_words(known)[0] if n else np.zeros(0, bool)
                for length in range(2, min(longest, n) + 1):
                    ok, shorter = np.zeros(n, bool), np.zeros(n, np.uint64)
                    ok[at[there]], shorter[at] = True, h
                    at = np.flatnonzero(ok[:-1] & ok[1:] & win.joined[: n - 1])
                    at = at[at <= n - length]
                    if not len(at):
                        break
                    h = win.hash_at(at, length, shorter)
                    if isinstance(known, Bloom):
                        there = known.find(h)[0]
                        own = np.flatnonzero(there)
                    else:
                        i = known.place(h)
                        there = i >= 0
                        own = np.flatnonzero(there)
                        own = own[groups[i[own]] == win.group[at[own]]]
                    own = own[np.unique(h[own], return_index=True)[1]]
                    rows += [(length, i) for i in at[own].tolist()]
                for length in {x for x, _ in rows}:
                    at = np.array([i for x, i in rows if x == length])
                    part_of = {}  # first word and length -> hashes
                    for o in range(length):
                        h = win.words[at + o]
                        part_of[o, 1] = h
                        for m in range(2, length - o + 1):
                            with np.errstate(over="ignore"):
                                h = mix(h * NEXT + win.words[at + o + m - 1] + np.uint64(m))
                            part_of[o, m] = h
                    columns = lambda keys: pa.array(np.stack([part_of[k] for k in keys], axis=1).view(np.int64).tolist() if keys else [[]] * len(at), pa.list_(pa.int64()))  # noqa: E731, B023
                    yield pa.RecordBatch.from_arrays([
                        pa.array(part_of[0, length].view(np.int64)), pa.array(win.langs[win.doc[at]].view(np.int64)), pa.array([win.phrase(i, length) for i in at.tolist()]),
                        columns([(0, k) for k in range(1, length)]), columns([(k, length - k) for k in range(1, length)]), columns([(o, m) for m in range(2, length) for o in range(length - m + 1)]),
                    ], names=[c.split()[0] for c in PHRASES.split(", ")])

    found = docs.select("text", "lang_h", "g").mapInArrow(lean(read), PHRASES).dropDuplicates(["h"])
    return found.join(frequent.select("h", F.col("c").alias("a")), "h")


def mine(df: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, shards: int = SHARDS, known: int = KNOWN, bits: int = FILTER_BITS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score."""
    spark = df.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    place = F.xxhash64(F.col(id_col).cast("string"), F.length(text_col))
    own = df.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), lang.alias("lang"), F.xxhash64(lang).alias("lang_h"), F.pmod(place, F.lit(shards)).cast("int").alias("shard"), F.pmod(F.shiftright(place, 20), F.lit(GROUPS)).cast("long").alias("g"))
    path = shared_path(spark, "shards")
    own.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    schema = own.drop("shard").schema.add("shard", "integer")
    docs = spark.read.schema(schema).parquet(path)
    langs = docs.select("lang", "lang_h").distinct()
    frequent = cyclic(docs, least, longest, shards, known)
    if frequent is None:
        frequent = by_length(docs, least, longest, bits)
        kept, groups = Bloom.of(frequent, bits), None
    else:
        rows = frequent.select("h", "p").toPandas()
        h = rows.h.to_numpy(np.int64).view(np.uint64)
        order = np.argsort(h)
        kept, groups = Exact(h[order], np.ones(len(h), bool)), (rows.p.to_numpy(np.int64)[order] // 8 % GROUPS).astype(np.uint8)
    frequent = stored(frequent, "frequent")
    found = stored(phrases(docs, frequent, kept, groups, longest), "phrases")
    if found.count() != frequent.where("p % 8 > 1").count():
        raise RuntimeError("the table has changed between two reads")
    of = lambda name, key: frequent.select(F.col("h").alias(key), F.col("c").alias(name))
    cuts = found.select("h", "lang_h", "phrase", "a", F.posexplode(F.arrays_zip("prefixes", "suffixes")).alias("k", "part")).select("h", "lang_h", "phrase", "a", "k", F.col("part.prefixes").alias("hl"), F.col("part.suffixes").alias("hr"))
    cuts = cuts.join(of("l", "hl"), "hl").join(of("r", "hr"), "hr").join(F.broadcast(of("n", "lang_h").join(langs, "lang_h")), "lang_h")
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    worst = cuts.withColumn("score", score).groupBy("h").agg(F.min(F.struct("score", "k", "l", "r", "lang", "phrase", "a", "n")).alias("x")).select("h", "x.*")
    longer = found.select(F.explode("inside").alias("h"), "a").groupBy("h").agg(F.max("a").alias("longer"))
    kept_ = worst.join(longer, "h", "left").where("longer is null or 100 * longer < 100 * a")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return kept_.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = f"""WITH piece AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM documents),
word AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece), n AS (SELECT lang, count(*) AS n FROM word GROUP BY lang),
f AS (SELECT lang, p, count(*) AS f FROM (SELECT lang, w[i:i + k - 1] AS p FROM word, range(1, {LONGEST + 1}) x(k) WHERE i + k - 1 <= len(w)) GROUP BY lang, p HAVING count(*) >= {LEAST}),
c AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1),
cut AS (SELECT c.lang, c.p, a, k, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score FROM (SELECT *, unnest(range(1, len(p))) AS k FROM c) c JOIN f l ON l.lang = c.lang AND l.p = c.p[1:k] JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1:] JOIN n ON n.lang = c.lang),
worst AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (SELECT DISTINCT lang, p[o:o + m - 1] AS p, a FROM (SELECT lang, p, a, unnest(range(2, len(p))) AS m FROM c), range(1, {LONGEST}) x(o) WHERE o + m - 1 <= len(p)),
kept AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM worst WHERE NOT EXISTS (FROM inside WHERE inside.lang = worst.lang AND inside.p = worst.p AND 100 * inside.a >= 100 * worst.a))
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= {TOP}"""
