import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orgmill.llm import exact_dedup


def normal(text):
    return (text or "").encode().lower()


def plain(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[normal(text)].append(i)
    out = []
    for own, ids in groups.items():
        last = max((i for i in ids if i is not None), default=None)
        kept = 0
        for i in ids:
            out.append((i, last, len(ids), i == last and not kept, hashlib.sha256(own).hexdigest()))
            kept += i == last
    return sorted(out, key=str)


def found(df, **parameters):
    return sorted((tuple(r) for r in exact_dedup.groups(df, **parameters).drop("key").collect()), key=str)


def corpus(n=400):
    rng = random.Random(5)
    some = ["", "Same text", "same TEXT", "École", "école", "ÉCOLE", "x" * 50_000, " ", "a\x00b", "A\x00B", None]
    return [(i, rng.choice(some) if rng.random() < 0.6 else f"Text {rng.randint(0, 300)} {'y' * rng.randint(0, 400)}") for i in range(n)]


def test_groups_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, h int, n string").repartition(5)
    assert found(df) == plain(rows)


@pytest.mark.parametrize("modulus", [1, 3, 1 << 40])
def test_split_buckets_pages_and_chains_equal_brute_force(spark, modulus):
    """Small buckets: the directory doubles, keys get pages, and keys of a poor hash have long chains."""
    rows = corpus(150)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    poor = lambda text: F.xxhash64(F.xxhash64(F.lower(text)) % modulus)
    assert found(df, key=poor, capacity=20_000, owner_bytes=60_000, max_depth=6, chunk=20_000) == plain(rows)


def test_directory_doubles_and_covers_every_key(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("h"), F.lit(100).cast("long").alias("size"))
    own = exact_dedup.grown(keys, 2000, 10_000, 20)
    assert own.depth >= 8 and len(own.slots) == 1 << own.depth and max(own.load) <= 2000 and sum(own.load) == 300_000
    assert all(2 ** (own.depth - d) == (own.slots == b).sum() for b, d in enumerate(own.local)) and (own.pages == 1).all()
    import numpy as np

    h = np.array([r["h"] for r in keys.collect()], np.int64)
    assert (np.bincount(own.find(h), minlength=len(own.load)) * 100 == own.load).all()
    hot = spark.range(300).select(F.lit(5).cast("long").alias("h"), F.lit(100).cast("long").alias("size"))
    one = exact_dedup.grown(hot, 2000, 10_000, 20)
    assert one.depth <= exact_dedup.STEP and one.pages.max() == 15


def test_index_of_every_key_when_repeated_keys_are_many(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_KEYS", 2)
    rows = corpus(200)
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == plain(rows)


def test_odd_rows_and_ties(spark):
    rows = [(None, "a"), (None, "A"), (3, None), (2, ""), (7, "b"), (7, "b"), (7, "B"), (-5, "c"), (None, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == plain(rows)
    kept = exact_dedup.deduplicate(df)
    assert sorted((normal(r["text"]) for r in kept.collect())) == sorted({normal(t) for _, t in rows})
    assert exact_dedup.groups(df.limit(0)).count() == 0 and exact_dedup.deduplicate(df.limit(0)).columns == df.columns


def test_long_texts(spark):
    rows = [(i, "word " * 300_000 + ("." if i % 2 else "")) for i in range(6)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)
