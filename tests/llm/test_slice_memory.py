"""What a worker of the substring removal holds beside a slice is a few times the slice, not the arrays of all its bytes."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from orgmill.llm import suffix_dedup as S
from orgmill.llm import word_encoder
from orgmill.llm.common import lean

TEXT = 4 << 20


def slice_of_words(seed: int, rows: int = 1000) -> bytes:
    raw = np.random.default_rng(seed).integers(97, 123, TEXT).astype(np.uint8)
    raw[::6] = 32
    texts = [x.tobytes().decode() for x in np.split(raw, np.linspace(0, TEXT, rows + 1).astype(int)[1:-1])]
    ids = pa.array(range(rows), pa.int64())
    return S.whole(pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], names=["doc_id", "oid", "text"]))


def most(run) -> int:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_anchors_are_told_in_bounded_memory():
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([slice_of_words(1)], pa.binary())], names=["slice", "rows"])
    assert most(lambda: list(S.anchor_lists(3, 50, 26)(iter([batch])))) < 8 * TEXT


def test_runs_are_made_in_bounded_memory():
    own = pa.table({"slice": pa.array([1], pa.int64()), "rows": pa.array([slice_of_words(2)], pa.binary())})
    answers = S.table_of([], S.ANSWERS)
    assert most(lambda: S.runs_of([], 4, 3, 50, 26)(own, answers)) < 10 * TEXT


def test_blocks_of_any_size_give_the_same_anchors():
    data = np.random.default_rng(3).integers(97, 100, 300_000).astype(np.uint8)
    data[100_000:140_000] = 97  # one period over block edges
    offsets = np.array([0, 10, 70_000, 70_000, 65_536 * 3, 300_000])
    with np.errstate(over="ignore"):
        expected = S.anchors(data, offsets, block=1 << 20)
        for block in (1 << 12, S.BLOCK):
            assert all(np.array_equal(x, y) for x, y in zip(expected, S.anchors(data, offsets, block=block)))


def bucket(slices: int, each: int) -> pa.Table:
    rng, rows = np.random.default_rng(4), []
    common = rng.integers(0, 1 << 40, each).astype(np.uint64)
    for k in range(slices):
        h = np.unique(np.concatenate([common[k % 2 :: 2], rng.integers(0, 1 << 40, each // 2).astype(np.uint64), np.array([0, (1 << 40) - 1], np.uint64)]))
        rows.append((3, k, 7, len(h), S.squeezed(np.diff(h, prepend=np.uint64(0)), rng.integers(1, 9, len(h)).astype("<u2"))))
    return S.table_of(rows, S.LISTS)


def test_buckets_are_compared_in_bounded_memory():
    table = bucket(10, 100_000)
    assert most(lambda: S.shared_in_bucket(20)(table)) < 50_000_000


def test_ranges_of_a_bucket_give_what_the_whole_gives(monkeypatch):
    table = bucket(5, 1000)
    whole = S.shared_in_bucket(20)(table)
    monkeypatch.setattr(S, "COMPARED", 100)
    assert whole.num_rows == 5 and S.shared_in_bucket(20)(table).equals(whole)


def test_words_are_forgotten_with_another_operators_task():
    word_encoder.word_encoder(public_tokenizers.path("word_bpe_49k.json"))
    list(lean(iter, word_encoder.WORDS)([]))
    assert word_encoder._encoders
    list(lean(iter)([]))
    assert not word_encoder._encoders
