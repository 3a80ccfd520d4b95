import random
import re

import numpy as np
import pyarrow as pa
import pytest

from orgmill.llm import ngram_join
from orgmill.llm.components import components


def shingles(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute(values):
    sets = [shingles(t) for t in values]
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= 85 * (len(sets[i]) + len(sets[j]) - o):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [(i, len(s), root(i)) for i, s in enumerate(sets)]


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(30)]
    out = [None, "", " \n", "one", "One", "one two three", "one two", "É é x y", "é é x y"]
    while len(out) < n:
        base = [word() for _ in range(rng.choice([3, 12, 40, 90]))] + (passage if rng.random() < 0.3 else [])
        for _ in range(rng.choice([1, 1, 2, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = word()
            out.append(rng.choice([" ", "\n", "  \t"]).join(copy))
    return out[:n]


@pytest.mark.parametrize("elements", [2_000_000, 300])
def test_classes_equal_brute_force(spark, monkeypatch, elements):
    monkeypatch.setattr(ngram_join, "STORED", elements // 10)
    monkeypatch.setattr(ngram_join, "WALKING", elements)
    values = corpus(elements, 260)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(values)], "doc_id long, text string, n_shingles int").repartition(5)
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.classes(df).collect())
    assert found == brute(values)


def test_links_come_from_walks(spark, monkeypatch):
    """Without the trees there is no link; with them every link reaches the threshold."""
    values = corpus(11, 120)
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    named, found = ngram_join.links(df)
    text = {r["node"]: shingles(values[r["first"]]) for r in named.where("node is not null").collect()}
    pairs = [tuple(r) for r in found.collect()]
    assert pairs and all(100 * len(text[a] & text[b]) >= 85 * len(text[a] | text[b]) for a, b in pairs)
    monkeypatch.setattr(ngram_join, "walk", lambda percent: lambda table: pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())}))
    assert ngram_join.links(df)[1].count() == 0


def test_many_classes_with_one_passage(spark):
    """Short documents of a common passage and own words: one n-gram is in the prefixes of unlike documents."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(12)]
    values = []
    for k in range(40):
        own = [f"w{k}x{i}" for i in range(rng.choice([3, 8]))]
        values += [" ".join(own + passage), " ".join(passage + own), " ".join(passage[: rng.choice([11, 12])]), " ".join([*passage, own[0]])]
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(4)
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.classes(df).collect())
    assert found == brute(values)


def test_null_ids_several_texts_repeated_rows_and_empty_table(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(None, text), (4, text), (4, text), (2, text), (5, text), (5, "another text of five words"), (None, None), (6, "")], "doc_id long, text string")
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.classes(df).collect()]
    assert sorted(found, key=str) == sorted([(None, 5, None), (4, 5, 2), (4, 5, 2), (2, 5, 2), (5, 5, 2), (5, 2, 5), (None, 0, None), (6, 0, 6)], key=str)
    assert ngram_join.classes(df.limit(0)).count() == 0
    kept = ngram_join.keep_one(df.selectExpr("doc_id", "text", "1 as own_key", "2 as gone_id"))
    assert kept.columns == ["doc_id", "text", "own_key", "gone_id"]
    assert sorted([(r[0], r[1]) for r in kept.collect()], key=str) == sorted([(None, text), (None, None), (2, text), (6, "")], key=str)


def test_very_long_texts(spark):
    rng = random.Random(4)
    long = [f"w{rng.randrange(10**6)}" for _ in range(200_000)]
    values = [" ".join(long), " ".join(long[:-5000]), " ".join(long[:100_000]), "same " * 300_000]
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(2)
    found = sorted((r["doc_id"], r["component_id"]) for r in ngram_join.classes(df).collect())
    assert found == [(0, 0), (1, 0), (2, 2), (3, 3)]


def test_prefix_tree_finds_every_near_set():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(200)]
    sets += [np.unique(np.append(s, rng.integers(0, 60))) for s in sets[:80]] + sets[:3]
    sizes = [len(s) + int(rng.integers(0, 2)) for s in sets]
    tree = ngram_join.PrefixTree(sets, sizes, 85)
    for own, size in list(zip(sets, sizes))[::7]:
        member = np.zeros(60, np.int8)
        member[own] = 1
        near = {i for i, o in tree.near(own, size, member, 85) if 100 * o >= 85 * (sizes[i] + size - o)}
        assert near == {i for i, s in enumerate(sets) if 100 * (o := len(np.intersect1d(s, own))) >= 85 * (sizes[i] + size - o)}


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(7, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found == label
