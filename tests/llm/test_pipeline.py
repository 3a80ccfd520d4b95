import corpus_pipeline
from orgmill.llm.common import shared_path


def text(seed, n=80):
    import random

    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_each_stage_on_planted_cases(spark):
    at = shared_path(spark, "tables")
    clean = [(i, text(i)) for i in range(40)]
    leak = text(999, 30)
    passage = text(777, 60)
    near = text(3)[:-4] + "zz"
    planted = [(50, text(3)), (51, near), (52, text(60) + " " + passage), (53, passage + " " + text(61)), (54, text(62) + " " + leak + " " + text(63)), (55, "you idiot worthless scum pathetic loser " * 3), (56, None), (57, ""), (None, text(64))]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in clean + planted], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{at}/documents.parquet")
    labels = [(i, 1, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["toxicity_stage", "near_duplicates", "repeated_passages", "benchmark_leaks", "packed_sequences"]
    kept = corpus_pipeline.toxicity_stage(spark, docs, at)
    assert kept.columns == docs.columns
    everyone = {*range(40), 50, 51, 52, 53, 54, 55, 56, 57, None}
    ids = lambda df: {r["doc_id"] for r in df.collect()}
    assert everyone - {55} <= ids(kept)
    kept = corpus_pipeline.near_duplicates(spark, docs, at)
    assert kept.columns == docs.columns and ids(kept) == everyone - {50, 51}
    cut = corpus_pipeline.repeated_passages(spark, kept, at)
    rows = {r["doc_id"]: r for r in cut.collect()}
    assert cut.columns == docs.columns and set(rows) == everyone - {50, 51}
    assert rows[52]["text"].endswith(passage) and passage not in rows[53]["text"] and rows[53]["n_chars"] == len(rows[53]["text"]) < 70 * 8
    assert rows[7]["text"] == text(7)
    clear = corpus_pipeline.benchmark_leaks(spark, cut, at)
    assert clear.columns == docs.columns and ids(clear) == everyone - {50, 51, 54}
    packed = corpus_pipeline.run(spark, at).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 4096 and set(range(40)) - set(packed.doc_id) == set()


def test_near_copies_between_080_and_085_go(spark):
    def grams(t, n):
        w = t.split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    def alike(a, b, n):
        return len(grams(a, n) & grams(b, n)) / len(grams(a, n) | grams(b, n))

    def edited(t, places):
        w = t.split()
        return " ".join(f"edit{k}" if k in places else x for k, x in enumerate(w))

    def block(t, start, size):
        return edited(t, range(start, start + size))

    rows = [(i, text(1000 + i, 200)) for i in range(6)]
    pairs = [(20, edited(rows[0][1], (30, 60, 90, 120))), (21, block(rows[1][1], 80, 14)), (22, block(rows[2][1], 50, 16)), (23, edited(rows[3][1], (20, 50, 80, 110, 140)))]
    similar = [alike(rows[i][1], t, 5) for i, (_, t) in enumerate(pairs)]
    assert all(0.8 <= x < 0.85 for x in similar[:3]) and similar[3] < 0.8, similar
    assert any(alike(rows[i][1], t, 4) < 0.85 for i, (_, t) in enumerate(pairs[:3]))
    docs = rows + pairs
    gone = {max(a, b) for a, s in docs for b, t in docs if a < b and alike(s, t, 5) >= 0.8}
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert gone == {20, 21, 22} and {r["doc_id"] for r in kept.collect()} == {a for a, _ in docs} - gone


def test_stages_on_odd_tables(spark):
    """Nulls in every column, repeated rows, ties, empty texts, clashing column names, and no labels or items."""
    at = shared_path(spark, "odd")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, own_key long, gone_id long, again_id long, slice long, node long, toxic int, rest string"
    odd = (None,) * 8
    one, other = text(70), text(71)
    rows = [(1, one, "en", "s", 5, *odd)] * 3 + [(None, None, None, None, None, *odd)] * 2 + [(None, other, "en", None, 1, *odd), (2, "", None, "s", 0, *odd), (2, None, "x", "s", None, *odd), (3, "   ", "x", "s", 3, *odd), (4, other, "en", "s", 9, "k", 1, 2, 3, 4, 5, 1, "r")]
    docs = spark.createDataFrame(rows, schema)
    expected = {"toxicity": 10, "ngram_jaccard_join": 7, "suffix_array_dedup": 10, "benchmark_decontamination": 10}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, at)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        found = out.collect()
        assert len(found) == expected[name], name
        assert ("k", 1, 2, 3, 4, 5, 1, "r") in [tuple(r)[5:] for r in found]
        if name != "suffix_array_dedup":  # there a null text becomes an empty one, and a null id counts as the largest
            assert {(r["doc_id"], r["text"]) for r in found} <= {r[:2] for r in rows}
        assert stage(spark, docs.limit(0), at).count() == 0
    packed = corpus_pipeline.packed_sequences(spark, docs, at)
    assert packed.select("doc_id", "piece").count() == 10 and packed.agg({"sequence_id": "max"}).first()[0] == 0
    assert corpus_pipeline.packed_sequences(spark, docs.limit(0), at).count() == 0
