import re
from collections import Counter

from orgmill.llm import quality_rules

GOOD = "the cat sat on the mat and it was a good day for all of the people in town so they went to see it"
TEXTS = [None, "", "  \n\t", "one two", GOOD, GOOD + "\n" + GOOD, "a b c d e f g h a b c d e f g h i a b c d e f g h", "x " * 400, "THE!! CAT!! " * 20, "der ### die $$$ das &&& " * 9,
         "\n".join(["same line of the text"] * 30), "é" * 50 + " " + GOOD, GOOD + "\x0b" + GOOD[::-1] + "\x1c\x85"]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if n[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w)


def test_counts_and_verdicts(spark):
    df = spark.createDataFrame([(i, t, 5, True) for i, t in enumerate(TEXTS)] + [(None, GOOD, 5, True)], "doc_id long, text string, n_words int, kept boolean")
    found = {r["doc_id"]: r for r in quality_rules.judge(df).collect()}
    assert len(found) == len(TEXTS) + 1
    for i, text in enumerate(TEXTS):
        r = found[i]
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == brute(text), text
        assert not (r["kept"] and r["base_failed"])
    assert found[4]["kept"] and found[None]["kept"] and not found[9]["kept"] and "symbol_ratio" in found[9]["failed"]
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_no_python_and_no_shuffle_in_the_plan(spark):
    df = spark.createDataFrame([(1, GOOD)], "doc_id long, text string")
    plan = quality_rules.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_repeated_rows_and_very_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(150_000)) + "\n" + "same words all over again and again so it goes on\n" * 3000
    df = spark.createDataFrame([(1, GOOD), (1, GOOD), (2, long)], "doc_id long, text string")
    found = quality_rules.judge(df).collect()
    assert len(found) == 3 and len({tuple(r)[:8] for r in found if r["doc_id"] == 1}) == 1
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert tuple(next(r for r in found if r["doc_id"] == 2)[c] for c in names) == brute(long)
