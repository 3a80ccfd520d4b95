"""Toxicity by weak supervision.

1. Words and beginnings of words that set toxic from other labelled training documents apart are counted on a bounded
   sample (SAMPLE_ROWS labelled rows, those with the smallest hashes of their ids); of those in SUPPORT rows or more the
   VOCABULARY strongest become features.
2. Every document gets the votes of all VOTERS: fixed lexicons in four languages, patterns, and lexicons of mined words
   whose precision is high. Votes are bits, so all documents together have at most 2 to the number of voters vote
   patterns; Spark counts them.
3. A generative label model is fitted to the counts of all training documents by expectation maximisation: a hidden label,
   each voter's accuracy for either label, and the strongest correlations between voters (a tree by conditional mutual
   information). The labels of training rows are one more voter, the annotator, that may err: its error rates are
   estimated with the others'. No label is taken as the truth.
4. A linear classifier (logistic regression on words and votes) is trained on the posterior labels of all
   training documents, and scores every document.

Rows whose crc32(id) mod 3 is 1 are never learnt from. Labels, lang, source and ids are no features. Texts are read
whole. A null or empty text is scored from its votes (none). A null id is not held out and has no label. Several
labels of one id: the highest counts. No labels at all: only the fixed voters speak. Repeated rows are scored alike, and
each counts in training. An empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgmill.llm.common import held_out, lean, settled, slices, stored, texts, without_rows

SAMPLE_ROWS, SUPPORT, VOCABULARY, MINED = 20_000, 5, 1000, 5
#: Pseudo-counts of the annotator's errors and right labels.
ERRORS, RIGHT = 1, 49
#: Words that insult, despise or threaten.
LEXICONS = {
    "insult": "idiot idiots moron morons loser losers fool clown clowns stupid dumb imbecile jerk dumbass",
    "contempt": "pathetic worthless disgusting scum trash garbage vermin filth filthy vile repulsive",
    "threat": "kill die hurt destroy burn beat strangle",
    "profanity": "damn crap bastard bullshit ass shit fuck fucking bitch",
    "german": "idiot dumm dummkopf trottel versager abschaum widerlich erbärmlich wertlos müll blöd arsch scheiße",
    "french": "idiot idiote imbécile crétin minable ordure dégoûtant pathétique stupide connard merde racaille",
    "spanish": "idiota imbécil estúpido estúpida basura escoria patético inútil asqueroso payaso mierda tonto",
}
PATTERNS = {
    "second_person": re.compile(r"\b(?:you|du|tu|tú|vous)\b(?:\W+\w+){0,3}\W+(?:idiot|moron|loser|clown|scum|trash|stupid|worthless|pathetic|imbécile|trottel|idiota)", re.I),
    "exclaiming": re.compile(r"![!1]{2,}"),
    "masked": re.compile(r"\b[A-Za-z]+[*@$][*@$A-Za-z]*[A-Za-z]\b"),
}
VOTERS = [*LEXICONS, *PATTERNS, "none", *[f"mined_{i}" for i in range(MINED)]]
WORD = re.compile(r"[^\W_]+")
_LEXICONS = [frozenset(words.split()) for words in LEXICONS.values()]


#: Beginnings of words are features too (written with a mark), so that inflected forms not seen in training count.
STEMS = (4, 5, 6)


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features_of(words: set[str]) -> set[str]:
    """Words and the beginnings of longer ones."""
    found = set(words)
    for n in STEMS:
        found.update([w[:n] + "~" for w in words if len(w) > n])
    return found


def training_labels(labels: DataFrame) -> DataFrame:
    """doc_id and toxic (0 or 1) of rows that may be learnt from."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    return own.where(~held_out("doc_id", 3, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def mine(docs: DataFrame, sample: DataFrame) -> list[tuple[str, int, int]]:
    """(word, toxic documents, others) of the VOCABULARY words that separate the sample best by log likelihood ratio."""
    some = docs.join(F.broadcast(sample), "doc_id").select("text", "toxic")

    def distinct(batches):
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array([list(features_of(words_of(x))) for x in part.column("text").to_pylist()], pa.list_(pa.string()))], names=["toxic", "words"])

    counts = some.mapInArrow(lean(distinct), "toxic int, words array<string>").select("toxic", F.explode("words").alias("word"))
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).where(f"a + b >= {SUPPORT}")
    rows = sample.groupBy("toxic").count().collect()
    totals = {r["toxic"]: r["count"] for r in rows}
    n1, n0 = float(totals.get(1, 0)), float(totals.get(0, 0))
    share = (F.col("a") + F.col("b")) / max(n1 + n0, 1.0)
    part = lambda seen, expected: seen * F.log(F.greatest(seen, F.lit(1e-9)) / F.greatest(expected, F.lit(1e-9)))
    gain = part(F.col("a"), share * n1) + part(F.col("b"), share * n0) + part(n1 - F.col("a"), (1 - share) * n1) + part(n0 - F.col("b"), (1 - share) * n0)
    return [(r["word"], r["a"], r["b"]) for r in counts.orderBy(F.round(gain, 6).desc(), "word").limit(VOCABULARY).collect()]


def vote(docs: DataFrame, mined: list[tuple[str, int, int]]) -> DataFrame:
    """votes (bits, in the order of VOTERS) and features (places in the vocabulary) of each document. One pass."""
    place = {w: i for i, (w, _, _) in enumerate(mined)}
    sure = [w for w, a, b in mined if a >= SUPPORT and a >= 9 * b]
    groups = {w: i % MINED for i, w in enumerate(sure)}
    first_pattern, nothing, first_mined = len(LEXICONS), len(LEXICONS) + len(PATTERNS), len(LEXICONS) + len(PATTERNS) + 1

    def read(batches):
        for batch in batches:
            for part in slices(batch):
                votes, features = [], []
                for text in part.column("text").to_pylist():
                    own, bits = words_of(text), 0
                    for i, lexicon in enumerate(_LEXICONS):
                        bits |= (not own.isdisjoint(lexicon)) << i
                    if not bits:
                        bits |= 1 << nothing
                    for i, pattern in enumerate(PATTERNS.values()):
                        bits |= bool(pattern.search(text)) << (first_pattern + i)
                    known = features_of(own) & place.keys()
                    for w in known & groups.keys():
                        bits |= 1 << (first_mined + groups[w])
                    votes.append(bits)
                    features.append(sorted(place[w] for w in known))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), part.column("held_out"), pa.array(votes, pa.int32()), pa.array(features, pa.list_(pa.int32()))], names=["doc_id", "key", "held_out", "votes", "features"])

    return docs.select("doc_id", "key", "held_out", "text").mapInArrow(lean(read), "doc_id long, key long, held_out boolean, votes int, features array<int>")


class LabelModel:
    """A hidden binary label with voters that depend on it and, along a tree, on each other, and an annotator."""

    def __init__(self, votes: np.ndarray, counts: np.ndarray, rounds: int = 40):
        """votes: a row of bits for each pattern; counts: its documents that the annotator left, called clean, called toxic."""
        self.parents = np.full(votes.shape[1], -1)
        toxic = votes[:, [i for i, v in enumerate(VOTERS) if v != "none"]].sum(axis=1)
        labelled = counts[:, 1:].sum()
        start = np.where(toxic > 0, 0.8, 0.02)
        if labelled:  # patterns start from what the annotator calls them
            start = (counts[:, 2] + counts[:, 2].sum() / labelled) / (counts[:, 1:].sum(axis=1) + 1)
        self.errors = np.array([ERRORS, ERRORS]) / (ERRORS + RIGHT)  # of a clean and of a toxic document
        odds = lambda p: np.log(p) - np.log1p(-p)
        q = self._with_annotator(odds(np.clip(start, 1e-6, 1 - 1e-6)))
        for k in range(rounds):
            weights = np.stack([(counts * (1 - q)).sum(axis=1), (counts * q).sum(axis=1)])
            self.prior = (weights.sum(axis=1) + 1) / (weights.sum() + 2)
            if k and k % 10 == 0:
                self.parents, self.information = self._tree(votes, weights)
            self._fit(votes, weights)
            wrong = np.array([(counts[:, 2] * (1 - q[:, 2])).sum(), (counts[:, 1] * q[:, 1]).sum()])
            right = np.array([(counts[:, 1] * (1 - q[:, 1])).sum(), (counts[:, 2] * q[:, 2]).sum()])
            self.errors = (wrong + ERRORS) / (wrong + right + ERRORS + RIGHT)
            q = self.posteriors(votes)

    def _with_annotator(self, odds: np.ndarray) -> np.ndarray:
        """The posterior of each pattern without the annotator, with its label 0 and with its label 1."""
        e0, e1 = self.errors
        shift = np.array([0.0, np.log(e1) - np.log(1 - e0), np.log(1 - e1) - np.log(e0)])
        return 1 / (1 + np.exp(-np.clip(odds[:, None] + shift, -500, 500)))

    def _tree(self, x: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each voter's parent in the maximum spanning tree of conditional mutual information."""
        v = x.shape[1]
        information = np.zeros((v, v))
        for w in weights:
            total = w.sum() + 4
            ones = (w @ x + 2) / total
            both = (x.T @ (x * w[:, None]) + 1) / total
            cells = {(1, 1): both, (1, 0): ones[:, None] - both, (0, 1): ones[None, :] - both, (0, 0): 1 - ones[:, None] - ones[None, :] + both}
            for (a, b), p in cells.items():
                side = lambda k: ones if k else 1 - ones
                p = np.maximum(p, 1e-12)
                information += w.sum() / max(weights.sum(), 1) * p * np.log(p / np.maximum(side(a)[:, None] * side(b)[None, :], 1e-12))
        np.fill_diagonal(information, 0)
        parents, inside = np.full(v, -1), [0]
        while len(inside) < v:
            outside = [i for i in range(v) if i not in inside]
            i, j = max(((i, j) for i in inside for j in outside), key=lambda e: information[e])
            parents[j] = i
            inside.append(j)
        return parents, information

    def _fit(self, x: np.ndarray, weights: np.ndarray) -> None:
        """p[label, parent's vote, voter]: a vote's probability, with one pseudo-count on either side."""
        self.p = np.zeros((2, 2, x.shape[1]))
        for y, w in enumerate(weights):
            for i, parent in enumerate(self.parents):
                for a in (0, 1):
                    own = w if parent < 0 else w * (x[:, parent] == a)
                    self.p[y, a, i] = (own @ x[:, i] + 1) / (own.sum() + 2)

    def _odds(self, x: np.ndarray) -> np.ndarray:
        above = np.where(self.parents >= 0, x[:, self.parents], 0).astype(int)
        columns = np.arange(x.shape[1])
        scores = [np.log(self.prior[y]) + np.log(np.where(x > 0, self.p[y][above, columns], 1 - self.p[y][above, columns])).sum(axis=1) for y in (0, 1)]
        return scores[1] - scores[0]

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        """P(toxic | votes) where the annotator left the document, called it clean, called it toxic."""
        return self._with_annotator(self._odds(x))

    def accuracies(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """P(vote | not toxic) and P(vote | toxic) of each voter."""
        q = self.posteriors(x)
        weights = np.stack([(counts * (1 - q)).sum(axis=1), (counts * q).sum(axis=1)])
        return (weights @ x + 1) / (weights.sum(axis=1, keepdims=True) + 2)


def bits(votes: np.ndarray) -> np.ndarray:
    return (votes[:, None] >> np.arange(len(VOTERS)) & 1).astype(np.float64)


def label_model(train: DataFrame) -> tuple[LabelModel, np.ndarray, np.ndarray]:
    """The model, and the vote patterns with their counts. train: votes and annotator (0 left, 1 clean, 2 toxic)."""
    rows = train.groupBy("votes").agg(*[F.count_if(F.col("annotator") == k).alias(f"n{k}") for k in range(3)]).orderBy("votes").collect()  # 2 ** len(VOTERS) rows at most
    patterns = np.array([r["votes"] for r in rows], np.int64)
    counts = np.array([(r["n0"], r["n1"], r["n2"]) for r in rows], np.float64).reshape(-1, 3)
    return LabelModel(bits(patterns), counts), patterns, counts


class Unsettled(RuntimeError):
    """A fit that has not come to its optimum."""


def minimise(value, w: np.ndarray, rounds: int, memory: int = 10, tolerance: float = 2e-6, noise: float = 1e-9) -> np.ndarray:
    """Limited-memory BFGS with halved steps, until no part of the gradient is beyond tolerance; raises if that does not come.
    value(w): the loss, right to noise, and its gradient."""
    f, g = value(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        if np.abs(g).max() <= tolerance:
            return w
        d, kept = -g, []
        for s, y in reversed(steps):
            kept.append((s @ d) / (s @ y))
            d = d - kept[-1] * y
        if steps:
            s, y = steps[-1]
            d = d * (s @ y) / (y @ y)
        for (s, y), a in zip(steps, reversed(kept)):
            d = d + (a - (y @ d) / (s @ y)) * s
        length = 1.0 if steps else min(1.0, 1 / max(np.abs(g).sum(), 1e-12))
        while True:
            near, slope = value(w + length * d)
            if near <= f + 1e-4 * length * (g @ d) + noise:
                break
            length /= 2
            if length < 1e-9:
                raise Unsettled(f"no step makes the loss less, with a gradient of {np.abs(g).max()}")
        if (length * d) @ (slope - g) > 1e-14:
            steps = [*steps, (length * d, slope - g)][-memory:]
        w, f, g = w + length * d, near, slope
    raise Unsettled(f"a gradient of {np.abs(g).max()} is left after {rounds} rounds")


#: Sums over rows are of whole numbers of these units, so they are the same in any order and for any partitions.
UNIT, LOSS_UNIT, ROWS = 2.0**-36, 2.0**-28, 4096


def linear(lists: pa.Array, voted: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The weighted sum of each row, the same whatever rows are with it; and the rows and places of all features."""
    row = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths(), np.int64))
    places = lists.flatten().to_numpy(zero_copy_only=False)
    return np.bincount(row, weights[places], len(lists)) + (voted * weights[VOCABULARY:-1]).sum(axis=1) + weights[-1], row, places


def fit(train: DataFrame, model: LabelModel, patterns: np.ndarray, l2: float = 1e-4, rounds: int = 300) -> np.ndarray:
    """Weights of words, of voters and the bias: logistic regression on the posterior labels of all rows of train, up to its
    optimum. Each step is one pass, whose tasks add up the loss and its gradient; the driver sees one number for each weight.
    Weights are scaled by how often their features occur, which makes the steps few."""
    size = VOCABULARY + len(VOTERS) + 1
    if not len(patterns):
        return np.append(np.zeros(size - 1), -3.0)
    q = np.clip(model.posteriors(bits(patterns)), 1e-9, 1 - 1e-9)

    def passed(w: np.ndarray, times: bool = False) -> tuple[np.ndarray, float, int]:
        """Sums of the gradient, of the loss, and rows. times: instead of the gradient, how often each feature occurs."""

        def add_up(batches):
            total = np.zeros(size + 2, np.int64)  # gradient, loss, rows
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS):
                    batch = whole.slice(at, ROWS)
                    votes = batch.column("votes").to_numpy()
                    target = q[np.searchsorted(patterns, votes), batch.column("annotator").to_numpy()]
                    voted = bits(votes.astype(np.int64))
                    z, row, places = linear(batch.column("features"), voted, w)
                    off = np.ones(len(z)) if times else np.rint((1 / (1 + np.exp(-np.clip(z, -500, 500))) - target) / UNIT)
                    total[:size] += np.bincount(places, off[row], size).astype(np.int64)
                    total[VOCABULARY : size - 1] += (off[:, None] * voted).sum(axis=0).astype(np.int64)
                    total[size - 1 :] += np.array([off.sum(), np.rint((np.logaddexp(0, z) - target * z) / LOSS_UNIT).sum(), batch.num_rows]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 2)), pa.array(total)], names=["place", "x"])

        found = [0] * (size + 2)
        for r in train.mapInArrow(add_up, "place long, x long").groupBy("place").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
            found[r["place"]] = int(r["x"])
        return np.array([float(x) for x in found[:size]]), float(found[size]) * LOSS_UNIT, found[-1]

    start = np.append(np.zeros(size - 1), np.log(model.prior[1] / model.prior[0]))
    often, _, n = passed(start, times=True)
    scale = 1 / np.sqrt(often / n / 4 * model.prior.min() + l2)

    def value(v: np.ndarray) -> tuple[float, np.ndarray]:
        w = v * scale
        gradient, loss, _ = passed(w)
        own = np.append(w[:-1], 0.0)
        return loss / n + l2 / 2 * float((own * own).sum()), (gradient * UNIT / n + l2 * own) * scale

    return minimise(value, start / scale, rounds) * scale


def score(df: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted and key (a hash of the text) for each row of df."""
    docs = texts(df, id_col, text_col).withColumn("held_out", held_out("doc_id", 3, 1)).withColumn("key", F.xxhash64("text"))
    own = training_labels(labels)
    mined = mine(docs, own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS))
    voted = stored(vote(docs, mined), "votes")
    annotator = F.coalesce(F.col("toxic") + 1, F.lit(0)).alias("annotator")
    train = stored(voted.where("not held_out").join(own, "doc_id", "left").select("votes", "features", annotator), "train")
    model, patterns, _ = label_model(train)
    weights = fit(train, model, patterns)

    def apply(batches):
        for batch in batches:
            total, _, _ = linear(batch.column("features"), bits(batch.column("votes").to_numpy(zero_copy_only=False).astype(np.int64)), weights)
            p = 1 / (1 + np.exp(-np.clip(total, -60, 60)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32)), batch.column("key")], names=["doc_id", "held_out", "score", "predicted", "key"])

    return voted.mapInArrow(apply, "doc_id long, held_out boolean, score double, predicted int, key long")


def remove_toxic(df: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without the documents that score threshold or more."""
    bad = settled(df.sparkSession, "toxic", lambda: score(df, labels, threshold, id_col, text_col).where("predicted = 1").select(F.col("doc_id").alias("id"), "key"))
    return without_rows(df, bad, id_col, text_col)
