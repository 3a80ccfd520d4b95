import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from orgmill.llm import suffix_dedup


def brute(values, length=50):
    raws = [(t or "").encode() for t in values]
    seen, out = set(), []
    for i, raw in enumerate(raws):
        gone = np.zeros(len(raw), bool)
        own = [raw[k : k + length] for k in range(len(raw) - length + 1)]
        for k, x in enumerate(own):
            if x in seen:
                gone[k : k + length] = True
        seen.update(own)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        n_spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((i, len(raw), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(n)) for n in (12, 20, 60)]
    out = [None, "", "short", "x" * 49, "y" * 50, "y" * 200, "\x00" * 120, "ab" * 90]
    for _ in range(150):
        parts = [" ".join(word() for _ in range(rng.choice([2, 9, 40]))) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.choice(passages)
            cut = rng.choice([0, 0, rng.randrange(len(p) // 2)])
            parts.insert(rng.randrange(len(parts) + 1), p[cut:])
        out.append(" ".join(parts))
        if rng.random() < 0.3:
            out.append(out[-1])
        if rng.random() < 0.3:
            k = rng.randrange(len(out[-1]))
            out.append(out[-1][:k] + "#" + out[-1][k + 1 :])
    return out


@pytest.mark.parametrize("hot, slice_bytes, range_bytes", [(20_000, 8 << 20, 16 << 20), (20, 2000, 1000), (0, 500, 8000)])
def test_digests_equal_brute_force(spark, hot, slice_bytes, range_bytes):
    """hot = 0: every shared anchor is settled by runs of its strings."""
    values = corpus(hot)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(values)], "doc_id long, text string, n_bytes int").repartition(3)
    found = sorted(tuple(r) for r in suffix_dedup.digests(df, hot=hot, slice_bytes=slice_bytes, range_bytes=range_bytes).collect())
    assert found == brute(values)


def test_anchors_in_blocks_equal_those_of_the_whole():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 0, 30, 79, 1500, 1500, 4990, 5000])
    with np.errstate(over="ignore"):
        at, h = suffix_dedup.anchors(data, offsets)
        for block in (64, 333, 1024):
            a, g = suffix_dedup.anchors(data, offsets, block=block)
            assert (a == at).all() and (g == h).all()


def test_periods_give_one_anchor_for_a_stretch():
    for period in ("y", "ab", "abcdefghijklmnopqrstuvwx"):
        data = np.frombuffer((period * 20_000)[:400_000].encode(), np.uint8)
        with np.errstate(over="ignore"):
            at, h = suffix_dedup.anchors(data, np.array([0, len(data)]))
        keep, back = suffix_dedup.without_periods(np.zeros(len(at), int), at, h, 50, 26)
        assert keep.sum() < 60 and back.max() > len(data) - 200


def test_long_periodic_texts(spark):
    """Two texts of 5 MB of spaces and two of "ab", with an own beginning and end each, and one of 1 MB without a period."""
    rng = random.Random(5)
    own = lambda: "".join(rng.choice("0123456789") for _ in range(60))
    noise = "".join(rng.choice("abcdefghij") for _ in range(1_000_000))
    values = [own() + " " * 5_000_000 + own(), own() + " " * 5_000_000 + own(), "ab" * 2_500_000, own() + "ab" * 2_500_000, noise, noise[500_000:] + own()]
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(2)
    found = sorted(tuple(r)[:4] for r in suffix_dedup.digests(df).collect())
    assert found == [(0, 5_000_120, 0, 0), (1, 5_000_120, 5_000_000, 1), (2, 5_000_000, 0, 0), (3, 5_000_060, 5_000_000, 1), (4, 1_000_000, 0, 0), (5, 500_060, 500_000, 1)]


def test_texts_are_exchanged_once(spark):
    plan = suffix_dedup.digests(spark.createDataFrame([(i, f"text {i} " * 30) for i in range(20)], "doc_id long, text string"))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.split("== Initial Plan ==")[0].count("ReusedExchange") >= 2


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (None, text), (5, text), (5, text), (3, "z" + text)], "doc_id long, text string")
    found = sorted((r["doc_id"] or 99, r["n_removed"]) for r in suffix_dedup.digests(df).collect())
    n = len(text)
    assert found == [(3, 0), (5, n), (5, n), (99, n), (99, n)]
    assert suffix_dedup.digests(df.limit(0)).count() == 0


def test_merge_keeps_order_and_prefix_lengths():
    rng = random.Random(2)
    runs, every = [], []
    for k in range(7):
        rows = sorted(bytes(rng.choice(b"ab") for _ in range(6)) for _ in range(rng.randrange(40)))
        every += rows
        shared = lambda a, b: next((i for i in range(6) if a[i] != b[i]), 6)
        runs.append(iter([(x, shared(x, rows[i - 1]) if i else 0, k, 0, 0, 0) for i, x in enumerate(rows)]))
    merged = list(suffix_dedup.merge(runs, 6))
    assert [r[0] for r, _ in merged] == sorted(every)
    for (a, _), (b, s) in zip(merged, merged[1:]):
        assert s == shared(a[0], b[0])


def test_a_slice_with_other_rows_than_before_raises():
    """A message about a slice carries its checksum: the rows that it meets must be the ones that it is about."""
    batch = lambda *texts: pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "oid", "text"])
    first, other = batch("some text", "more of it"), batch("some text", "more of It")
    cell = lambda b: pa.table({"slice": [7], "rows": pa.array([suffix_dedup.whole(b)], pa.binary())})
    spans = suffix_dedup.table_of(suffix_dedup.span_rows(np.array([7 << 16]), np.array([0]), np.array([4]), {7: suffix_dedup.sign(first)}), suffix_dedup.SPANS)
    assert suffix_dedup.rows_with_spans(cell(first), spans)[1] == [[(0, 4)], []]
    with pytest.raises(RuntimeError, match="changed"):
        suffix_dedup.rows_with_spans(cell(other), spans)
    answers = suffix_dedup.table_of([(7, suffix_dedup.sign(first), 0, 0, suffix_dedup.squeezed(np.zeros(0, "<u8"), np.zeros(0, "u1")))], suffix_dedup.ANSWERS)
    runs = suffix_dedup.runs_of([], 1, 1, 50, 26)
    assert runs(cell(first), answers).num_rows == 0
    with pytest.raises(RuntimeError, match="changed"):
        runs(cell(other), answers)
