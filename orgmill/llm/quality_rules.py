r"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

Words are runs of characters other than ASCII white space. All counts are exact (windows of eight words are compared
by a 64-bit hash of the eight words). The plan is a scan and one projection: no shuffle, no Python.

A null text has no words and fails; so does an empty one; an empty table gives no rows; repeated rows are judged one
by one; a null doc_id stays null; extra columns of the input are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmill.llm.common import texts

WINDOW = 8
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is it that on for with as this are be by from at an a or was "
    "der die das und ist nicht mit den ein eine auf sich dem im für zu von "
    "la le les de des du et un une que qui pour dans est en sur par avec au "
    "el los las del y una por con para no se es"
).split()
SPACES, NOT_SPACE = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """low <= numerator / denominator <= high, by multiplication, so that no division by zero can arise."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        a, b = F.col(self.numerator), F.col(self.denominator)
        checks = ([a >= b * F.lit(self.low)] if self.low is not None else []) + ([a <= b * F.lit(self.high)] if self.high is not None else [])
        return checks[0] if len(checks) == 1 else checks[0] & checks[1]


#: Numbers that a rule may name: n_words, word_chars, n_symbols, n_marks, n_stop_words, n_lines, n_dup_lines,
#: n_closed_lines, n_upper, n_repeat_words.
THRESHOLDS = (
    Rule("mean_word_length", "word_chars", "n_words", 2.5, 12.0),
    Rule("symbol_ratio", "n_symbols", "n_words", high=0.1),
    Rule("mark_ratio", "n_marks", "n_words", high=0.5),
    Rule("stop_word_ratio", "n_stop_words", "n_words", low=0.04),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", high=0.4),
)


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words in windows of eight that occur twice or more."""

    def covered(hashes: Column) -> Column:
        def of(s: Column) -> Column:
            near = lambda k: F.coalesce(F.try_element_at(s, k)["h"], F.lit(None))
            twice = F.filter(s, lambda x, k: ((k > 0) & (near(F.when(k > 0, k).otherwise(1)) == x["h"])) | (near(k + 2) == x["h"]).eqNullSafe(True))
            places = F.array_sort(F.transform(twice, lambda x: x["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
            step = lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last"))
            return F.aggregate(places, start, step, lambda a: a["n"])

        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), let(ordered, of)).otherwise(0)

    def windows(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        return let(hashes, covered)

    return F.when(F.size(words) > WINDOW, let(words, windows)).otherwise(0).cast("long")


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and every number that a rule may name."""
    text = F.col("text")
    without = lambda marks: F.length(text) - F.length(F.translate(text, marks, ""))
    base = texts(df, id_col, text_col).select(
        "doc_id",
        F.filter(F.split(text, SPACES), lambda w: w != "").alias("w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE)).alias("x"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        without(SYMBOLS + "!?=+~^_@").cast("long").alias("n_marks"),
    )
    return base.select(
        "doc_id", "word_chars", "n_symbols", "n_marks",
        F.size("w").cast("long").alias("n_words"),
        F.size("x").cast("long").alias("n_lines"),
        (F.size("x") - F.size(F.array_distinct("x"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
    )


def judge(df: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The numbers, base_failed, kept, and failed: the names of the rules that a document breaks."""
    failed = F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules]))
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    numbers = measure(df, id_col, text_col)
    return numbers.withColumns({"base_failed": base, "failed": failed}).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


ORACLE = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS x FROM t),
g AS (SELECT doc_id, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') AS v FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, v) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM d, range(8) r(k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda s: length(s))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, length(regexp_replace(text, '[^#*$%&|<>!?=+~^_@]', '', 'g'))::BIGINT AS n_marks,
    len(x)::BIGINT AS n_lines, (len(x) - len(list_distinct(x)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda s: s IN ({", ".join(f"'{s}'" for s in dict.fromkeys(STOP_WORDS))})))::BIGINT AS n_stop_words
  FROM w LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND word_chars BETWEEN n_words * 2.5 AND n_words * 12 AND n_symbols <= n_words * 0.1
    AND n_marks <= n_words * 0.5 AND n_stop_words >= n_words * 0.04 AND n_dup_lines <= n_lines * 0.4 AS kept
FROM m
"""
COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
