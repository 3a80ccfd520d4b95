"""Removal of byte strings that an earlier document also has, by a distributed merge of sorted suffix runs.

A byte goes if a string of LENGTH bytes over it also starts in a document with a smaller id. The result is exact (anchors
are told apart by hashes of 64 bits; what is removed is compared byte by byte).

1. Slices. Documents are cut into slices of about SLICE bytes; a slice is one compressed cell. This exchange of slices by
   their names is the only one that moves texts: all later steps read it again or join small rows to it.
2. Anchors. In each string of LENGTH bytes the GRAM-byte string with the least hash is its anchor, so equal strings
   have equal anchors in equal places. Anchors are a few per cent of all positions; those inside a stretch of one period
   are one anchor with the stretch's length. Each slice sends its distinct anchor hashes with their counts once (packed in
   blobs); an anchor that only one document has is dropped.
3. Suffixes. At each anchor left, the suffix of up to LENGTH bytes, followed by up to LENGTH - GRAM bytes before it,
   backwards, holds every string whose anchor it is. A slice's suffixes are sorted into a run. Where a run has a suffix of
   two documents, the later one is settled at once and not sent.
4. Exchange. Runs are cut at splitters (from a bounded sample; a range is divided further by a hash of the anchor) and
   front-coded: each suffix is the length of the prefix shared with the one before, and the rest. One task for each range
   merges its runs with a loser tree that keeps, for each loser, the prefix length it shares with the winner that beat
   it, so known prefixes are never compared again.
5. Equal neighbours settle whole suffixes. Suffixes that share only the anchor are settled string by string within
   the anchor's group. An anchor with more than HOT places in all documents has no group: its strings themselves, each
   once for a slice, make runs that are merged in ranges of their own.

Texts are UTF-8 bytes of any length. A null or short text loses nothing; null ids count as larger than all others and,
being equal, do not remove from each other; rows with one id do not remove from each other; repeated rows get equal
results; an empty table gives no rows; extra columns, whatever their names, stay as they are.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgmill.llm.common import BASE, BYTE_CODE, buffers, lean, lean_pair, mix, powers, release, released, slices, squeezed

LENGTH, GRAM = 50, 26
#: Bytes and rows of a slice; bytes of text for each range of suffixes; anchors that one task compares, about.
SLICE, SLICE_ROWS, RANGE_BYTES, BUCKET = 8 << 20, 50_000, 16 << 20, 2_000_000
#: Places of an anchor beyond which Spark settles its strings.
HOT = 20_000
#: Anchors of a bucket that are compared at once, about.
COMPARED = 250_000
#: Bytes that are hashed at once (with some 100 bytes of arrays for each), and suffixes that are cut at once.
BLOCK, ROWS = 1 << 16, 1 << 14
#: Splitters at most, the documents and the anchors of each that they are sampled from, and the parts of a range.
SPLITTERS, SAMPLE_DOCS, SAMPLE_ANCHORS, PARTS = 1024, 1000, 64, 4
NO_ID = (1 << 63) - 1
INVERSE = pow(BASE, -1, 1 << 64)
NEAR = np.uint64((1 << 40) - 1)
_inverse = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        _inverse = np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n, 4096), INVERSE, np.uint64))])
    return _inverse[:n]


def sliding(op, values: np.ndarray, width: int) -> np.ndarray:
    """op over each run of width values."""
    have = 1
    out = values
    while 2 * have <= width:
        out, have = op(out[:-have], out[have:]), 2 * have
    return op(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all texts. Blocks overlap by what an anchor depends on."""
    n, out = len(data), [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for low in range(0, n, block):
        a, b = max(0, low - length), min(n, low + block + length)
        first, last = np.searchsorted(offsets, a, side="right") - 1, np.searchsorted(offsets, b - 1, side="right")
        starts, ends = np.maximum(offsets[first:last], a), np.minimum(offsets[first + 1 : last + 1], b)
        rest = np.repeat(ends, ends - starts) - np.arange(a, b)  # bytes from here to the text's end
        at, h = anchors_in_block(data[a:b], rest, length, gram)
        at = at + a
        own = (at >= low) & (at < low + block)
        out.append((at[own], h[own]))
    at, h = (np.concatenate(x) for x in zip(*out))
    return at, h


def anchors_in_block(data: np.ndarray, rest: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    n, width = len(data), length - gram + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_CODE[data] * powers(n))])
    h = mix((sums[gram:] - sums[:-gram]) * inverse_powers(n)[: n - gram + 1])
    h = np.maximum(h, np.uint64(1))
    h[rest[: len(h)] < gram] = np.iinfo(np.uint64).max
    least = sliding(np.minimum, h, width)
    least[rest[: len(least)] < length] = 0
    pad = np.zeros(width - 1, np.uint64)
    most = sliding(np.maximum, np.concatenate([pad, least, pad]), width)
    at = np.flatnonzero((most == h) & (rest[: len(h)] >= gram))
    return at, mix(h[at])


def without_periods(doc: np.ndarray, at: np.ndarray, h: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Which anchors stay, and how many bytes before it each stands for.

    Anchors of one hash that follow each other at one distance of gram bytes at most lie in a stretch of that period.
    Those with all their bytes inside it have equal suffixes; the last of them stands for all: what goes at its place
    goes at theirs too, and these strings overlap.
    """
    back, keep = np.zeros(len(at), np.int64), np.ones(len(at), bool)
    if len(at) < 3:
        return keep, back
    step = np.diff(at)
    equal = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1]) & (step <= gram)
    goes_on = equal[1:] & equal[:-1] & (step[1:] == step[:-1])  # anchors i, i + 1 and i + 2 are in one stretch
    edges = np.flatnonzero(np.diff(np.concatenate([[False], goes_on, [False]]).astype(np.int8)))
    for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
        j += 1  # the stretch is anchors i to j
        inside = i + np.flatnonzero((at[i : j + 1] >= at[i] + length - gram) & (at[i : j + 1] <= at[j] + gram - length))
        if len(inside) > 1:
            keep[inside[:-1]] = False
            back[inside[-1]] = at[inside[-1]] - at[inside[0]]
    return keep, back


def whole(batch: pa.RecordBatch) -> bytes:
    """All columns of a batch, compressed."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def opened(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_next_batch()


def table_of(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns)})


def cut_slices(size: int):
    """Runs of rows as one cell each, under a name of their own."""

    def read(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in slices(batch, size=size):
                for piece in (some.slice(i, SLICE_ROWS) for i in range(0, some.num_rows, SLICE_ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array([(part << 24) | number], pa.int64()), pa.array([whole(piece)], pa.binary())], names=["slice", "rows"])
                    number += 1

    return read


def sign(batch: pa.RecordBatch) -> int:
    """The checksum of a slice's rows, which goes with every message about it."""
    data, offsets = buffers(batch.column("text"))
    return zlib.crc32(np.ascontiguousarray(batch.column("oid").to_numpy(zero_copy_only=False)), zlib.crc32(np.ascontiguousarray(offsets), zlib.crc32(np.ascontiguousarray(data))))


CHANGED = "the table has changed between two reads: a slice has other rows than before"
LISTS = "bucket long, slice long, sign long, n long, blob binary"


def anchor_lists(buckets: int, length: int, gram: int):
    """For each slice and bucket the distinct hashes of its anchors with their counts."""

    def read(batches):
        for batch in batches:
            for name, blob in zip(batch.column("slice").to_pylist(), batch.column("rows")):
                batch_ = opened(blob.as_py())
                own = sign(batch_)
                with np.errstate(over="ignore"):
                    h = anchors(*buffers(batch_.column("text")), length, gram)[1]
                del batch_
                h, counts = np.unique(h, return_counts=True)
                counts = np.minimum(counts, 65535).astype("<u2")
                near, bucket = h & NEAR, (h >> np.uint64(40)) % np.uint64(buckets)
                order = np.lexsort((near, bucket))
                near, bucket, counts = near[order], bucket[order], counts[order]
                del order
                edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(h) else np.zeros(1, int)
                rows = [(int(bucket[a]), name, own, int(b - a), squeezed(np.diff(near[a:b], prepend=np.uint64(0)), counts[a:b])) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                del h, near, bucket, counts
                release()
                yield from table_of(rows, LISTS).to_batches()

    return read


ANSWERS = "slice long, sign long, bucket long, n long, blob binary"


def shared_in_bucket(hot: int):
    """Hashes of a bucket that several slices have, for each of them, marked where they have more than hot places in all.
    A hash of one slice is told only if it is hot."""

    def compare(table: pa.Table) -> pa.Table:
        names, signs, sizes = table["slice"].to_numpy(), table["sign"].to_numpy(), table["n"].to_pylist()
        parts = []
        for n, blob in zip(sizes, table["blob"]):
            steps, counts = released(blob.as_py(), (n, "<u8"), (n, "<u2"))
            parts.append((np.cumsum(steps), counts))
        ranges = sum(sizes) // COMPARED + 1  # of hashes, which are even
        cuts = np.array([(int(NEAR) + 1) * i // ranges for i in range(ranges + 1)], np.uint64)
        places = [np.searchsorted(x, cuts).tolist() for x, _ in parts]
        found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in parts]
        for i in range(ranges):
            h = np.concatenate([x[at[i] : at[i + 1]] for (x, _), at in zip(parts, places)])
            if not len(h):
                continue
            counts = np.concatenate([x[at[i] : at[i + 1]] for (_, x), at in zip(parts, places)]).astype(np.int64)
            who = np.repeat(np.arange(len(parts)), [at[i + 1] - at[i] for at in places])
            order = np.argsort(h, kind="stable")
            h, counts, who = h[order], counts[order], who[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            held = np.diff(np.append(first, len(h)))
            many = np.add.reduceat(counts, first) > hot
            told, many = np.repeat((held > 1) | many, held), np.repeat(many, held)
            h, who, many = h[told], who[told], many[told]
            order = np.argsort(who, kind="stable")  # h stays ascending within each
            h, who, many = h[order], who[order], many[order]
            edges = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1], [True]])) if len(h) else np.zeros(1, int)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                found[who[a]].append((h[a:b], many[a:b]))
        del parts
        bucket, rows = table["bucket"][0].as_py(), []
        for name, sign_, own in zip(names.tolist(), signs.tolist(), found):
            if own:
                h, many = (np.concatenate(x) for x in zip(*own))
                rows.append((name, sign_, bucket, len(h), squeezed(np.diff(h, prepend=np.uint64(0)), many.astype("u1"))))
        return table_of(rows, ANSWERS)

    return compare


def suffixes(data: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, length: int, gram: int) -> np.ndarray:
    """A row of bytes for each anchor: its suffix, what is before it backwards, and the two lengths."""
    back = length - gram
    out = np.zeros((len(at), length + back + 2), np.uint8)
    for i in range(0, len(at), ROWS):
        own, a, x, y = out[i : i + ROWS], at[i : i + ROWS, None], left[i : i + ROWS, None], right[i : i + ROWS, None]
        step = np.arange(length)
        own[:, :length] = np.where(step < y, data[np.minimum(a + step, len(data) - 1)], 0)
        step = np.arange(back)
        own[:, length:-2] = np.where(step < x, data[np.maximum(a - 1 - step, 0)], 0)
    out[:, -2], out[:, -1] = right, left + 1
    return out


def as_strings(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel()


def merged_spans(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Overlapping spans of a text joined, by text and start."""
    if not len(key):
        return [key, start, end]
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], end[order]
    text = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
    shift = text * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    first = np.flatnonzero(np.concatenate([[True], (start + shift)[1:] > reach[:-1]]))
    last = np.append(first[1:], len(key)) - 1
    return [key[first], start[first], reach[last] - shift[last]]


SPANS = "slice long, sign long, n long, blob binary"


def span_rows(key: np.ndarray, start: np.ndarray, end: np.ndarray, signs: dict[int, int]) -> list[tuple[int, int, int, bytes]]:
    """(slice, sign, n, blob) of spans, those of one text joined where they overlap."""
    key, start, end = merged_spans(key, start, end)
    name = key >> 16
    edges = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1], [True]])) if len(key) else np.zeros(1, int)
    return [(int(name[a]), signs[int(name[a])], int(b - a), squeezed((key[a:b] & 0xFFFF).astype("<u2"), start[a:b].astype("<u4"), (end - start)[a:b].astype("<u4"))) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


#: range: below 0 for spans that are settled; else n rows of m documents as a part of a run. After the ranges of suffixes
#: there are as many for the strings of hot anchors.
RUNS = "range long, slice long, sign long, n long, m long, blob binary"


def coded(name: int, which: np.ndarray, rows: np.ndarray, oid, key, place, back) -> list[tuple]:
    """Parts of a sorted run, one for each range, front-coded."""
    out = []
    order = np.argsort(which, kind="stable")
    rows, oid, key, place, back, which = (x[order] for x in (rows, oid, key, place, back, which))
    edges = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1], [True]])) if len(which) else np.zeros(1, int)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        own = rows[a:b]
        differs = own[1:] != own[:-1]
        common = np.concatenate([[0], np.where(differs.any(axis=1), differs.argmax(axis=1), own.shape[1])])
        tails = own[np.arange(own.shape[1]) >= common[:, None]]
        docs, first = np.unique(key[a:b], return_index=True)
        out.append((int(which[a]), name, b - a, len(docs), squeezed((docs & 0xFFFF).astype("<u2"), oid[a:b][first].astype("<i8"), (key[a:b] & 0xFFFF).astype("<u2"), place[a:b].astype("<u4"), back[a:b].astype("<u4"), common.astype("u1"), tails)))
    return out


def settled_at_once(name: int, key, start, end) -> list[tuple]:
    return [(-1 - name, s, n, None, blob) for s, _, n, blob in span_rows(key, start, end, {name: 0})]


def row_hashes(rows: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((BYTE_CODE[rows] * powers(rows.shape[1])).sum(axis=1, dtype=np.uint64))


def hot_strings(data, first, size, key, oid, place, back, name: int, ranges: int, length: int, gram: int) -> list[tuple]:
    """Runs of the strings whose anchor is hot. first and size: of each place's text. Of one string of the slice only the
    places in the document with the least id are sent; the others are settled."""
    out, step = [], np.arange(length)
    for i in range(0, len(place), ROWS):
        some = slice(i, min(i + ROWS, len(place)))
        start = place[some, None] - np.arange(length - gram + 1)
        ok = (start >= 0) & (start + length <= size[some, None])
        which, start = some.start + np.nonzero(ok)[0], start[ok]
        o, k, b, at = oid[which], key[which], back[which], first[which] + start
        rows = np.empty((len(at), length), np.uint8)
        for x in range(0, len(at), ROWS):
            rows[x : x + ROWS] = data[at[x : x + ROWS, None] + step]
        # UTF-8 has no byte 255, so inverted rows have no zero byte that numpy could take for an end
        by = np.argsort(o, kind="stable")
        by = by[np.argsort(as_strings(~rows[by]), kind="stable")[::-1]]  # the order of the rows themselves; ids descend
        rows, o, k, b, start = (x[by] for x in (rows, o, k, b, start))
        edges = np.flatnonzero(np.concatenate([np.ones(min(len(rows), 1), bool), (rows[1:] != rows[:-1]).any(axis=1), np.ones(1, bool)]))
        later = o > np.repeat(o[edges[1:] - 1], np.diff(edges)) if len(rows) else np.zeros(0, bool)
        out += settled_at_once(name, k[later], (start - b)[later], start[later] + length)
        rows, o, k, b, start = (x[~later] for x in (rows, o, k, b, start))
        out += coded(name, ranges + (row_hashes(rows) % np.uint64(ranges)).astype(np.int64), rows, o, k, start, b)
    return out


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in known, which ascends."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def runs_of(splitters: list[bytes], parts: int, buckets: int, length: int, gram: int):
    """The sorted, front-coded run of a slice's suffixes at shared anchors, cut by ranges."""
    cuts = np.array(splitters, f"S{gram}")

    def sort(slice_: pa.Table, answers: pa.Table) -> pa.Table:
        if not slice_.num_rows:
            raise RuntimeError(CHANGED)
        name, batch = slice_["slice"][0].as_py(), opened(slice_["rows"][0].as_py())
        own_sign = sign(batch)
        if any(x != own_sign for x in answers["sign"].to_pylist()):
            raise RuntimeError(CHANGED)
        near, hot = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for bucket, n, blob in zip(answers["bucket"].to_pylist(), answers["n"].to_pylist(), answers["blob"]):
            h, many = released(blob.as_py(), (n, "<u8"), (n, "u1"))
            near.append(np.cumsum(h) | np.uint64(bucket << 40))
            hot.append(near[-1][many > 0])
        data, offsets = buffers(batch.column("text"))
        with np.errstate(over="ignore"):
            at, h = anchors(data, offsets, length, gram)
        doc = np.searchsorted(offsets, at, side="right") - 1
        code = (h & NEAR) | ((h >> np.uint64(40)) % np.uint64(buckets)) << np.uint64(40)  # as the buckets know it
        shared = among(code, np.sort(np.concatenate(near)))
        order = np.argsort(h, kind="stable")  # doc ascends already
        if len(order):  # anchors that several texts of this slice have
            ordered = h[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            sizes = np.diff(np.append(first, len(h)))
            several = doc[order[first]] != doc[order[first + sizes - 1]]
            shared[order[np.repeat(several, sizes)]] = True
            del ordered, first, sizes, several
        del order
        doc, at, h, code = doc[shared], at[shared], h[shared], code[shared]
        del shared, near
        release()
        keep, back = without_periods(doc, at, h, length, gram)
        doc, at, back = doc[keep], at[keep], back[keep]
        place, many = at - offsets[doc], among(code[keep], np.sort(np.concatenate(hot)))
        key, oid = (name << 16) | doc, batch.column("oid").to_numpy(zero_copy_only=False)[doc]
        size, ranges = np.diff(offsets)[doc], (len(cuts) + 1) * parts
        order = np.flatnonzero(many)
        order = order[np.argsort(code[keep][order], kind="stable")]
        out = hot_strings(data, *(x[order] for x in (offsets[doc], size, key, oid, place, back)), name, ranges, length, gram)
        doc, at, key, oid, place, size, back = (x[~many] for x in (doc, at, key, oid, place, size, back))
        left, right = np.minimum(place, length - gram), np.minimum(size - place, length)
        rows = suffixes(data, at, left, right, length, gram)
        by = np.argsort(oid, kind="stable")
        by = by[np.argsort(as_strings(rows[by]), kind="stable")]
        rows, oid, key, place, left, right, back = (x[by] for x in (rows, oid, key, place, left, right, back))
        new = np.concatenate([np.ones(min(len(rows), 1), bool), (rows[1:] != rows[:-1]).any(axis=1)])
        later = oid > oid[np.flatnonzero(new)][np.cumsum(new) - 1]
        out += settled_at_once(name, key[later], (place - left - back)[later], (place + right)[later])
        rows, oid, key, place, back = (x[~later] for x in (rows, oid, key, place, back))
        part = (row_hashes(rows[:, :gram]) % np.uint64(parts)).astype(np.int64)
        which = np.searchsorted(cuts, as_strings(rows[:, :gram]), side="right") * parts + part
        return table_of([(*r[:2], own_sign, *r[2:]) for r in out + coded(name, which, rows, oid, key, place, back)], RUNS)

    return sort


#: Rows of a run that are Python's numbers at once, and spans that are held as such.
DECODED, HELD = 1024, 20_000


def decoded(name: int, n: int, m: int, blob: bytes, width: int):
    """(suffix, prefix length shared with the one before, id, row key, place, back) of a front-coded run, in order."""
    docs, oids, *columns = (x.copy() for x in released(blob, (m, "<u2"), (m, "<i8"), (n, "<u2"), (n, "<u4"), (n, "<u4"), (n, "u1")))
    raw = zstandard.ZstdDecompressor().decompress(blob)[m * 10 + n * 11 :]
    suffix, at, id_of = b"", 0, dict(zip(docs.tolist(), oids.tolist()))
    name <<= 16
    for i in range(0, n, DECODED):  # Python's numbers take several times the arrays
        for k, p, b, s in zip(*(x[i : i + DECODED].tolist() for x in columns)):
            end = at + width - s
            suffix = suffix[:s] + raw[at:end]
            at = end
            yield suffix, s, id_of[k], name | k, p, b


def merge(runs: list, width: int):
    """The runs' rows in order, each with the prefix length it shares with the row given before it.

    A loser tree. Each node keeps the run that lost there and the prefix length that it shares with the winner. A new
    row of a run shares a known length with the last winner, and so does every loser on its path: the longer shared
    prefix is the smaller row; only where both are equal are bytes compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list = [next(r, None) for r in runs] + [None] * (size - len(runs))
    lost, known = [0] * size, [0] * size  # a run that has ended is known by -1, so it loses without a comparison

    def differ(p: bytes, q: bytes, at: int) -> int:
        """Where p and q part, if they are equal up to at."""
        if at == width or p[at] != q[at]:
            return at
        x = int.from_bytes(p) ^ int.from_bytes(q)
        return width - (x.bit_length() + 7) // 8

    def build(node: int) -> tuple[int, int]:
        if node >= size:
            return node - size, 0 if heads[node - size] else -1
        (a, ka), (b, kb) = build(2 * node), build(2 * node + 1)
        if ka == kb == 0:
            p, q = heads[a][0], heads[b][0]
            kb = differ(p, q, 0)
            if kb < width and p[kb] > q[kb]:
                a, b = b, a
        elif ka < kb:
            a, ka, b, kb = b, kb, a, ka
        lost[node], known[node] = b, kb
        return a, ka

    w, k = build(1)
    while (head := heads[w]) is not None:
        yield head, k
        row = heads[w] = next(runs[w], None)
        k = row[1] if row else -1
        node = (w + size) >> 1
        while node:
            kx = known[node]
            if k < kx:
                w, k, lost[node], known[node] = lost[node], kx, w, k
            elif k == kx and k >= 0:
                x = lost[node]
                p, q = heads[w][0], heads[x][0]
                at = differ(p, q, k)
                known[node] = at
                if at < width and p[at] > q[at]:
                    w, lost[node] = x, w
            node >>= 1


#: Groups of one anchor that are settled pair by pair.
PAIRS = 8


def settle_range(ranges: int, length: int, gram: int):
    """Spans of all suffixes, or all strings of hot anchors, of a range; what is settled already goes on as it is."""
    back, width = length - gram, 2 * length - gram + 2

    def strings(suffix: bytes):
        """(bytes before the anchor, string) of each whole string whose anchor this is; the string starts with that number."""
        right, left = suffix[-2], suffix[-1] - 1
        for j in range(length - right, left + 1):
            yield j, bytes([j]) + suffix[: length - j] + suffix[length : length + j]

    def settle(table: pa.Table) -> pa.Table:
        number = table["range"][0].as_py()
        if number < 0:
            return table.select(["slice", "sign", "n", "blob"])
        whole_strings = number >= ranges
        wide = length if whole_strings else width
        found: list[tuple[int, int, int]] = []  # key, start, end
        packed = [np.zeros((0, 3), np.int64)]  # those found before

        def by_pairs(group):
            """What a suffix shares with an earlier one around the anchor is one span."""
            group.sort(key=lambda g: g[1])
            parts = [(int.from_bytes(x[:length]), int.from_bytes(x[length:-2]), x[-2], x[-1] - 1) for x, _, _ in group]
            for i in range(1, len(group)):
                r, left_of, right, left = parts[i]
                for j in range(i):
                    if group[j][1] == group[i][1]:
                        break
                    r2, l2, right2, left2 = parts[j]
                    n = min(length - ((r ^ r2).bit_length() + 7) // 8, right, right2)
                    m = min(back - ((left_of ^ l2).bit_length() + 7) // 8, left, left2)
                    if n + m >= length:
                        found.extend([(k, p - m - b, p + n) for k, p, b in group[i][2]])

        def finish(group):
            """group: [suffix, its least id, (row name, place, back) of that id]: distinct suffixes of one anchor."""
            if len(group) <= PAIRS:
                by_pairs(group)
                return
            least: dict[bytes, int] = {}
            for suffix, o, _ in group:
                for _, x in strings(suffix):
                    if o < least.get(x, NO_ID + 1):
                        least[x] = o
            for suffix, o, places in group:
                for j, x in strings(suffix):
                    if least[x] < o:
                        found.extend([(k, p - j - b, p - j + length) for k, p, b in places])

        group: list = []
        members: list = []  # rows of one suffix

        def close():
            suffix = members[0][0]
            if whole_strings:
                least = min([m[2] for m in members])
                found.extend([(k, p - b, p + length) for _, _, o, k, p, b in members if o > least])
            elif len(members) == 1:
                _, _, o, k, p, b = members[0]
                group.append((suffix, o, [(k, p, b)]))
            else:
                least = min([m[2] for m in members])
                right, left = suffix[-2], suffix[-1] - 1
                found.extend([(k, p - left - b, p + right) for _, _, o, k, p, b in members if o > least])
                group.append((suffix, least, [(k, p, b) for _, _, o, k, p, b in members if o == least]))

        runs = [decoded(*x, wide) for x in zip(*(table[c].to_pylist() for c in ("slice", "n", "m", "blob")))]
        for row, shared in merge(runs, wide):
            if shared < wide and members:
                close()
                members = []
                if len(found) > HELD:
                    packed.append(np.array(found, np.int64))
                    found.clear()
                if shared < gram:
                    if len(group) > 1:
                        finish(group)
                    group = []
            members.append(row)
        close()
        if len(group) > 1:
            finish(group)
        signs = dict(zip(table["slice"].to_pylist(), table["sign"].to_pylist()))
        packed.append(np.array(found, np.int64).reshape(-1, 3))
        return table_of(span_rows(*np.concatenate(packed).T, signs), SPANS)

    return settle


def sampled_splitters(docs: DataFrame, n: int, length: int, gram: int) -> list[bytes]:
    """n - 1 anchors at equal distances in the anchors of a bounded sample of documents."""
    if n < 2:
        return []

    def sample(batches):
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                raw = text.encode()[: 1 << 16]  # a sample only: it balances ranges and decides nothing
                with np.errstate(over="ignore"):
                    at = anchors(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), length, gram)[0]
                found += [raw[i : i + gram] for i in at[:: max(1, len(at) // SAMPLE_ANCHORS)].tolist()[:SAMPLE_ANCHORS]]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["x"])

    hashed = F.xxhash64("oid")
    top = docs.select(hashed.alias("h")).orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    some = docs.where(hashed <= top).select("text").limit(2 * SAMPLE_DOCS).mapInArrow(sample, "x binary") if top is not None else None
    found = sorted(bytes(r["x"]) for r in some.collect()) if some else []  # 2 * SAMPLE_DOCS * SAMPLE_ANCHORS short strings at most
    return sorted({found[len(found) * i // n] for i in range(1, n)}) if found else []


def find_repeats(df: DataFrame, id_col: str, text_col: str, length: int, gram: int, hot: int, slice_bytes: int, range_bytes: int) -> tuple[DataFrame, DataFrame]:
    """slices (slice, rows: an Arrow stream with doc_id, oid, text and rest, the other columns) and spans (slice, n, blob:
    place of the row in the slice, start and length of what is to go). One plan: slices are exchanged once."""
    others = [c for c in df.columns if c not in (id_col, text_col)]
    docs = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("oid"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(0).alias("none")]).alias("rest"),
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, ranges = int(size * 2 / (length - gram + 2)) // BUCKET + 1, size // range_bytes + 1
    splitters = sampled_splitters(docs, min(SPLITTERS, ranges // PARTS + 1), length, gram)
    parts = ranges // (len(splitters) + 1) + 1
    cut = docs.mapInArrow(lean(cut_slices(slice_bytes)), "slice long, rows binary").repartition("slice")
    lists = cut.mapInArrow(lean(anchor_lists(buckets, length, gram)), LISTS)
    answers = lists.groupBy("bucket").applyInArrow(lean(shared_in_bucket(hot)), ANSWERS)
    runs = cut.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(lean_pair(runs_of(splitters, parts, buckets, length, gram)), RUNS)
    return cut, runs.groupBy("range").applyInArrow(lean(settle_range((len(splitters) + 1) * parts, length, gram)), SPANS)


def rows_with_spans(slice_: pa.Table, spans: pa.Table):
    """The rows of a slice with the disjoint spans to remove from each."""
    if not slice_.num_rows:
        raise RuntimeError(CHANGED)
    batch, parts = opened(slice_["rows"][0].as_py()), [(np.zeros(0, np.int64),) * 3]
    if spans.num_rows and set(spans["sign"].to_pylist()) != {sign(batch)}:
        raise RuntimeError(CHANGED)
    for n, blob in zip(spans["n"].to_pylist(), spans["blob"]):
        doc, start, size = (x.astype(np.int64) for x in released(blob.as_py(), (n, "<u2"), (n, "<u4"), (n, "<u4")))
        parts.append((doc, start, start + size))
    out: list[list[tuple[int, int]]] = [[] for _ in range(batch.num_rows)]
    for doc, a, b in zip(*(x.tolist() for x in merged_spans(*(np.concatenate(x) for x in zip(*parts))))):
        out[doc].append((a, b))
    return batch, out


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in spans:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def digests(df: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, slice_bytes: int = SLICE, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of df."""

    def digest(slice_: pa.Table, found: pa.Table) -> pa.Table:
        rows, spans = rows_with_spans(slice_, found)
        raw = [text.as_py().encode() for text in rows.column("text")]
        sha = [hashlib.sha256(without(x, s)).hexdigest() for x, s in zip(raw, spans)]
        numbers = [pa.array(c, pa.int64()) for c in ([len(x) for x in raw], [sum(b - a for a, b in s) for s in spans], [len(s) for s in spans])]
        return pa.table([rows.column("doc_id"), *numbers, pa.array(sha, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    cut, spans = find_repeats(df.select("doc_id", "text"), "doc_id", "text", length, gram, hot, slice_bytes, range_bytes)
    return cut.groupBy("slice").cogroup(spans.groupBy("slice")).applyInArrow(lean_pair(digest), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans without the bytes of characters that they hold in part."""
    out = []
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        out.append((a, b))
    return out


def remove_repeats(df: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with the repeated strings cut out of its texts (whole characters only); all other columns as they are."""
    others = [f for f in df.schema.fields if f.name not in (id_col, text_col)]

    def kept(slice_: pa.Table, found: pa.Table) -> pa.Table:
        rows, spans = rows_with_spans(slice_, found)
        texts = []
        for text, s in zip(rows.column("text").to_pylist(), spans):
            if s:
                raw = text.encode()
                text = without(raw, whole_characters(raw, s)).decode()
            texts.append(text)
        return pa.table([rows.column("doc_id"), pa.array(texts, pa.string()), rows.column("rest")], names=["doc_id", "text", "rest"])

    rest = T.StructType(others) if others else T.StructType([T.StructField("none", T.IntegerType())])
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("rest", rest)])
    cut, spans = find_repeats(df, id_col, text_col, length, gram, HOT, SLICE, RANGE_BYTES)
    found = cut.groupBy("slice").cogroup(spans.groupBy("slice")).applyInArrow(lean_pair(kept), schema)
    column = {id_col: F.col("doc_id").cast(df.schema[id_col].dataType), text_col: F.col("text")}
    return found.select(*[column.get(c, F.col(f"rest.`{c}`")).alias(c) for c in df.columns])
