import random
import zlib

import numpy as np

from orgmill.llm import toxicity


def rows(n=900):
    rng = random.Random(8)
    clean, bad = [f"word{i}" for i in range(300)], [f"gnarl{x}" for x in ("a", "um", "ix", "oo", "est", "ing", "ed")]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(clean, k=rng.randint(5, 60))
        toxic = rng.random() < 0.2
        if toxic:
            words += rng.choices(bad if rng.random() < 0.6 else ["idiot", "worthless"], k=3)
        rng.shuffle(words)
        docs.append((i, " ".join(words), 1.0))
        if rng.random() < 0.5:
            labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels = rows()
    docs += [(None, "idiot worthless gnarlum", 1.0), (5000, None, 1.0), (5001, "", 1.0), (5002, "x" * 100_000, 1.0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score double")
    known = spark.createDataFrame([(*x, 1) for x in labels] + [(1, None, 0), (None, 1, 0)], "doc_id long, toxic int, quality int")
    found = toxicity.score(df, known).toPandas()
    assert len(found) == len(docs) and found.score.between(0, 1).all()
    truth = {i: any(w.startswith(("gnarl", "idiot", "worthless")) for w in (t or "").split()) for i, t, _ in docs}
    for r in found.itertuples():
        if r.doc_id == r.doc_id:
            assert r.held_out == (zlib.crc32(str(int(r.doc_id)).encode()) % 3 == 1)
        assert r.predicted == int(r.score >= 0.7)
    held = found[found.held_out]
    assert (held.predicted == held.doc_id.map(truth)).mean() > 0.97
    assert found[found.doc_id.isna()].predicted.tolist() == [1] and not found[found.doc_id.isin([5000, 5001, 5002])].predicted.any()
    kept = toxicity.remove_toxic(df, known)
    assert kept.columns == df.columns and kept.count() == (found.predicted == 0).sum()


def test_held_out_labels_are_never_read(spark):
    docs, labels = rows(300)
    df = spark.createDataFrame(docs, "doc_id long, text string, score double")
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    scores = [{r["doc_id"]: r["score"] for r in toxicity.score(df, spark.createDataFrame(x, "doc_id long, toxic int")).collect()} for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_without_labels_and_without_documents(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a fine day"] * 40 + ["you idiot, worthless scum!!!", "pathetic loser, you moron"] * 6)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = toxicity.score(df, none).toPandas().sort_values("doc_id").score.tolist()
    assert min(found[40:]) > max(found[:40])
    assert toxicity.score(df.limit(0), none).count() == 0


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(3)
    n, v = 40_000, len(toxicity.VOTERS)
    y = rng.random(n) < 0.2
    hit, false = np.full(v, 0.6), np.full(v, 0.05)
    votes = rng.random((n, v)) < np.where(y[:, None], hit, false)
    votes[:, 3] = np.where(rng.random(n) < 0.95, votes[:, 2], votes[:, 3])  # two voters that copy each other
    votes[:, toxicity.VOTERS.index("none")] = ~votes[:, : len(toxicity.LEXICONS)].any(axis=1)
    packed = (votes << np.arange(v)).sum(axis=1)
    patterns, counts = np.unique(packed, return_counts=True)
    x = toxicity.bits(patterns)
    full = np.stack([counts, 0 * counts, 0 * counts], axis=1).astype(float)
    model = toxicity.LabelModel(x, full)
    accuracy = model.accuracies(x, full)
    assert np.abs(accuracy[1][8:10] - 0.6).max() < 0.05 and np.abs(accuracy[0][8:10] - 0.05).max() < 0.02
    assert model.parents[3] == 2 or model.parents[2] == 3
    q = dict(zip(patterns.tolist(), model.posteriors(x)[:, 0]))
    assert np.mean([(q[p] > 0.5) == t for p, t in zip(packed.tolist(), y.tolist())]) > 0.97


def test_an_annotator_that_errs_is_found_out():
    """A third of the labels is wrong: the voters agree, so the model gives them the say."""
    rng = np.random.default_rng(5)
    n, v = 30_000, len(toxicity.VOTERS)
    y = rng.random(n) < 0.3
    votes = rng.random((n, v)) < np.where(y[:, None], 0.7, 0.05)
    label = np.where(rng.random(n) < 1 / 3, ~y, y)
    packed = (votes << np.arange(v)).sum(axis=1)
    patterns, index = np.unique(packed, return_inverse=True)
    state = np.where(rng.random(n) < 0.5, 0, 1 + label)
    counts = np.stack([np.bincount(index[state == k], minlength=len(patterns)) for k in range(3)], axis=1).astype(float)
    model = toxicity.LabelModel(toxicity.bits(patterns), counts)
    assert np.abs(model.errors - 1 / 3).max() < 0.04
    q = model.posteriors(toxicity.bits(patterns))[index, state]
    assert ((q > 0.5) == y).mean() > 0.97


def test_scores_equal_a_plain_version(spark):
    """The classifier's optimum, by plain gradient steps on the same posteriors; and a flipped label acts through them only."""
    docs, labels = rows(400)
    df = spark.createDataFrame(docs, "doc_id long, text string, score double")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    own = toxicity.training_labels(known)
    text = toxicity.texts(df).withColumn("held_out", toxicity.held_out("doc_id", 3, 1)).withColumn("key", toxicity.F.lit(0).cast("long"))
    mined = toxicity.mine(text, own)
    voted = toxicity.vote(text, mined).join(own, "doc_id", "left").toPandas()
    x = np.zeros((len(voted), toxicity.VOCABULARY + len(toxicity.VOTERS)))
    for i, (f, v) in enumerate(zip(voted.features, voted.votes)):
        x[i, list(f)] = 1
        x[i, toxicity.VOCABULARY :] = toxicity.bits(np.array([v]))[0]
    train = (~voted.held_out).to_numpy()
    state = np.where(voted.toxic.isna(), 0, voted.toxic.fillna(0) + 1).astype(int)
    patterns, index = np.unique(voted.votes, return_inverse=True)
    counts = np.stack([np.bincount(index[train & (state == k)], minlength=len(patterns)) for k in range(3)], axis=1).astype(float)
    seen = counts.sum(axis=1) > 0
    model = toxicity.LabelModel(toxicity.bits(patterns[seen]), counts[seen])
    q = np.zeros((len(patterns), 3))
    q[seen] = model.posteriors(toxicity.bits(patterns[seen]))
    q = q[index, state]
    z, w = np.hstack([x, np.ones((len(x), 1))]), np.zeros(x.shape[1] + 1)
    l2 = np.append(np.full(x.shape[1], 1e-4), 0)
    for _ in range(40):  # Newton steps, halved at first
        p = 1 / (1 + np.exp(-(z[train] @ w)))
        gradient = z[train].T @ (p - q[train]) / train.sum() + l2 * w
        hessian = (z[train].T * (p * (1 - p))) @ z[train] / train.sum() + np.diag(l2 + 1e-12)
        w = w - 0.7 * np.linalg.solve(hessian, gradient)
    plain = dict(zip(voted.doc_id, 1 / (1 + np.exp(-(z @ w)))))
    found = {r["doc_id"]: r["score"] for r in toxicity.score(df, known).collect()}
    assert max(abs(found[k] - plain[k]) for k in plain) < 0.05
    assert {k for k in plain if plain[k] > 0.7} ^ {k for k in found if found[k] > 0.7} <= {k for k in plain if abs(plain[k] - 0.7) < 0.05}
