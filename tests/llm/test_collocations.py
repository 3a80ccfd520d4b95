import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from orgmill.llm import collocations


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", low)]


def plain(rows, least, top, longest=5):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        for words in pieces(text):
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang or "und"][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        known = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in known.items():
            for m in range(2, len(p)):
                for o in range(len(p) - m + 1):
                    inside[p[o : o + m]] = max(inside[p[o : o + m]], a)
        found = []
        for p, a in known.items():
            if 100 * inside[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def corpus(n=300, seed=6):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["The", "the", "É", "é", "a", "a", "b\x0b", "x#y"]
    phrases = ["new York city hall", "a a a a a a", "à la carte", "one two three four five six seven"]
    rows = []
    for i in range(n):
        parts = [rng.choice(phrases) if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randint(0, 60))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "!", "; "]) for p in parts)
        rows.append((i, text, rng.choice(["en", "de", None, "und"])))
    return rows + [(None, None, "en"), (5, "", None), (6, " .,; ", "fr"), (7, "Alone", "it")]


def found(df, **parameters):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in collocations.mine(df, **parameters).collect())


@pytest.mark.parametrize("least, top, shards, known", [(10, 2000, 4, 10**6), (4, 25, 3, 10**6), (10, 2000, 1, 10**6), (7, 50, 4, 20)])
def test_phrases_equal_brute_force(spark, least, top, shards, known):
    """Several shards, one shard (a length for each scan), and more phrases than tasks may know."""
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, h int, shard int").repartition(5)
    want = plain(rows, least, top)
    assert len(want) > 20 and found(df, least=least, top=top, shards=shards, known=known, bits=16) == want


def test_production_threshold_on_copies_and_ties(spark):
    rows = [(i, "same old story again and again", "en") for i in range(120)] + [(i, "rare words here", "en") for i in range(99)] + [(i, "yes no, yes no", "en") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert found(df) == plain(rows, 100, 2000) and found(df)[0][3] >= 100


def test_long_texts_and_empty_tables(spark):
    rows = [(1, "left right " * 100_000, "en"), (2, "x" * 2_000_000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert found(df) == plain(rows, 100, 2000)
    assert found(df.limit(0)) == []


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, n, x, y = 9_000_000_000, 8_000_000_000_000, 9_000_000_001, 9_500_000_123
    row = spark.createDataFrame([(a, n, x, y)], "a long, n long, l long, r long")
    score = row.select(F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")).first()[0]
    assert score == 1000 * a * n // (x * y)


def test_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS h")
    own = collocations.Bloom.of(keys, 18)
    h = np.array([r["h"] for r in keys.collect()], np.int64).view(np.uint64)
    assert own.find(h)[0].all() and own.find(h + np.uint64(1))[0].mean() < 0.05
