"""URL filter: rules, host word segmentation and multinomial naive Bayes.

1. A url is cut into host and path; the longest rule that fits decides.
2. Names (runs of letters in host labels and path) are split into words by unigram Viterbi: every substring of every
   distinct name, of any length, is joined with the word counts of the whole page table (without scripts and styles), and
   the best chain of known words (unknown ones pay for their length) is kept. No vocabulary is broadcast.
3. Multinomial naive Bayes on these words learns from all urls by expectation maximisation: urls that a rule decides have
   their class, the others the posterior of the last round; ROUNDS rounds. Seed words count once each, so that they only
   break the tie before the first round. Each distinct name has the sum of its words' log odds; a url's names are added
   up. Above 0 it is blocked.

Names are joined by a salted key, so a name that most urls have is spread. A null url, or one without ://, has an empty
host and path, no rule and no names, and is allowed; null urls take no part in any join. A null page_id stays null;
repeated urls count once in training and are judged alike; an empty table gives no rows. With no words in the pages,
names stay whole.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmill.llm.common import stored

#: (verdict, host/path): a rule fits its host and all subdomains, where the path starts with the rule's.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Words that speak for one verdict.
SEEDS = {"block": "casino poker bet betting pills pill viagra cialis pharmacy porn xxx sex adult escort loan loans payday cheap replica warez crack torrent spam free win prize".split(), "allow": "wiki docs news edu library museum university school research journal science gov help manual blog".split()}
ROUNDS, SALTS = 2, 16
#: Urls on more than one row in HEAVY are broadcast with their scores.
HEAVY = 1000
#: Letters up to which a name's substrings are words to look up; longer words are looked up by so many first letters. A
#: longer name is known by its digest, so that its text does not travel with each substring.
HEAD, KEY = 24, 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"^(?s)(.*?)://", "")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(verdict, rule) of the longest rule that fits, else null."""
    chain = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        chain = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(chain)
    return chain


def word_counts(pages: DataFrame) -> DataFrame:
    """word, n over the readable text of all pages."""
    bare = F.regexp_replace(F.coalesce(F.col("html").cast("string"), F.lit("")), r"(?is)<(script|style)\b[^>]*>.*?</\1>", " ")
    text = F.lower(F.regexp_replace(bare, r"<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, r"[^\p{L}]+")).alias("word")).where(F.length("word") > 1)
    return words.groupBy("word").agg(F.count("*").alias("n"))


def best_split(name: str, known: dict[str, int], total: int) -> list[str]:
    """Viterbi over a name: log probabilities of words, and for an unknown stretch a price that grows with its length."""
    longest, unknown = max(map(len, known), default=0), 1 - math.log10(total)
    best, since = [(0.0, 0)], 0  # since: where an unknown stretch best starts
    for end in range(1, len(name) + 1):
        cost, at = best[since][0] + (unknown - (end - since)), since
        for start in range(max(0, end - longest), end):
            n = known.get(name[start:end], 0)
            if n and ((new := best[start][0] + math.log10(n / total)) > cost or (new == cost and start < at)):
                cost, at = new, start
        best.append((cost, at))
        if cost + end > best[since][0] + since:
            since = end
    out, end = [], len(name)
    while end:
        start = best[end][1]
        out.append(name[start:end])
        end = start
    return out[::-1]


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """name, words for distinct names of letters."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    keyed = names.select("name", F.when(F.length("name") <= KEY, F.col("name")).otherwise(F.sha2("name", 256)).alias("key"))

    def substrings(batches):
        for batch in batches:
            keys, words = [], []
            for name, key in zip(batch.column("name").to_pylist(), batch.column("key").to_pylist()):
                own = {name[i : i + k] for i in range(len(name)) for k in range(2, min(HEAD, len(name) - i) + 1)}
                keys += [key] * len(own)
                words += own
                if len(words) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(words, pa.string())], names=["key", "word"])
                    keys, words = [], []
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(words, pa.string())], names=["key", "word"])

    parts = keyed.mapInArrow(substrings, "key string, word string")
    found = parts.join(counts.where(F.length("word") <= HEAD), "word").select("key", "word", "n")
    heads = counts.where(F.length("word") > HEAD).select(F.substring("word", 1, HEAD).alias("head"), "word", "n")
    long_names = keyed.where(F.length("name") > HEAD)
    begun = long_names.mapInArrow(substrings, "key string, word string").where(F.length("word") == HEAD).withColumnRenamed("word", "head")
    found = found.union(begun.join(heads, "head").join(long_names, "key").where(F.contains("name", "word")).select("key", "word", "n"))
    known = found.groupBy("key").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    joined = keyed.join(known, "key", "left").select("name", "known")

    def split(batches):
        for batch in batches:
            rows = batch.to_pylist()
            words = [best_split(r["name"], {k["word"]: k["n"] for k in r["known"]}, total) if r["known"] else [r["name"]] for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(words, pa.list_(pa.string()))], names=["name", "words"])

    return joined.mapInArrow(split, "name string, words array<string>")


def log_odds(words: DataFrame, names: DataFrame) -> DataFrame:
    """name, odds: the sum of its words' log odds of blocking. names: name, block and allow (urls, or parts of urls, of
    either class that hold it)."""
    seeds = words.sparkSession.createDataFrame([(w, float(k == "block"), float(k == "allow")) for k, ws in SEEDS.items() for w in ws], "word string, block double, allow double")
    held = words.join(names, "name").select(F.explode("words").alias("word"), "block", "allow")
    counts = stored(held.union(seeds).groupBy("word").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")), "words")
    t = counts.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count("*").alias("v")).first()
    odds = F.log((F.col("block") + 1) / F.lit(float(t["block"] + t["v"]))) - F.log((F.col("allow") + 1) / F.lit(float(t["allow"] + t["v"])))
    return words.select("name", F.explode("words").alias("word")).join(counts.select("word", odds.alias("odds")), "word").groupBy("name").agg(F.sum("odds").alias("odds"))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", rounds: int = ROUNDS) -> DataFrame:
    """page_id, host, path, rule, verdict, score (log odds of blocking) for each row of pages."""
    host, path = host_and_path(F.col(url_col).cast("string"))
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), host.alias("host"), path.alias("path")).withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    letters = F.filter(F.split(F.lower(F.concat_ws("/", "host", "path")), r"[^\p{L}]+"), lambda x: x != "")
    urls = base.where("url is not null").select("url", F.col("own.verdict").alias("known"), letters.alias("names")).dropDuplicates(["url"])
    each = stored(urls.select("url", "known", F.explode("names").alias("name")), "urls")
    words = stored(segmented(each.select("name").distinct(), stored(word_counts(pages), "counts")), "names")

    def scores(odds: DataFrame) -> DataFrame:
        salted = odds.select("name", "odds", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        found = each.withColumn("salt", F.pmod(F.xxhash64("url"), F.lit(SALTS)).cast("int")).join(salted, ["name", "salt"])
        return found.groupBy("url").agg(F.round(F.sum("odds"), 6).alias("score"))

    sure = F.when(F.col("known") == "block", 1.0).when(F.col("known") == "allow", 0.0)
    part = each.select("name", sure.alias("p"))
    for k in range(rounds + 1):
        total = part.where("p is not null").groupBy("name").agg(F.sum("p").alias("block"), F.sum(1 - F.col("p")).alias("allow"))
        odds = log_odds(words, total if k else total.union(words.select("name", F.lit(0.0), F.lit(0.0))).groupBy("name").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")))
        found = stored(scores(odds), "scores")
        part = each.join(found, "url").select("name", F.coalesce(sure, 1 / (1 + F.exp(-F.col("score")))).alias("p"))
    score = F.coalesce("score", F.lit(0.0))
    verdict = F.coalesce("own.verdict", F.when(score > 0, "block").otherwise("allow"))
    # urls on many rows meet their score where they are: HEAVY of them at most
    told = base.where("url is not null")
    often = told.groupBy("url").agg(F.count("*").alias("n"))
    total = often.agg(F.sum("n")).first()[0] or 0
    hot = stored(found.join(often.where(F.col("n") * HEAVY > total), "url").select("url", "score"), "hot")
    seldom = told.join(F.broadcast(hot.select("url")), "url", "left_anti").join(found, "url", "left")
    out = told.join(F.broadcast(hot), "url").unionByName(seldom).unionByName(base.where("url is null").withColumn("score", F.lit(None).cast("double")))
    return out.select("page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"), score.alias("score"))
