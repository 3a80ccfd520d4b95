import math
import random
import re
from collections import Counter

from orgmill.llm import url_filter

URLS = [None, "", "no scheme", "http://", "HTTP://Www.Example.ORG/en/2?x=1", "https://example.org/es/a#b", "https://example.org/en/19", "https://a.example.org/en/2", "https://notexample.org/es/", "http://org", "http://x.com/fr/", "http://x.com/de/1",
        "http://com/fr/q", "http://y.net/en/1", "http://cheappills.net/buy", "a://b://c/d", "http://libraryscience.net/", "http://É.net/ü"]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(r), r, v) for v, r in url_filter.RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_hosts_paths_rules_and_verdicts(spark):
    html = "<p class=xyz>the cheap pills of a library and science of pills</p>"
    pages = spark.createDataFrame([(i, u, html, "x") for i, u in enumerate(URLS)] + [(4, URLS[4], html, "x"), (None, URLS[4], None, "x")], "page_id long, url string, html string, verdict string")
    rows = url_filter.judge(pages).collect()
    assert len(rows) == len(URLS) + 2
    found = {r["page_id"]: r for r in rows}
    for i, url in enumerate(URLS):
        r = found[i]
        host, path, rule, verdict = brute(url)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert r["verdict"] == (verdict or ("block" if r["score"] > 0 else "allow"))
    assert found[14]["verdict"] == "block" and found[16]["verdict"] == "allow" and found[0]["verdict"] == "allow"
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_best_split_is_the_best_of_all():
    known, total = {"cheap": 5, "pills": 4, "pill": 9, "s": 1, "che": 2, "a": 30, "heap": 3}, 200

    def cost(words):
        return sum(math.log10(known[w] / total) if w in known else 1 - math.log10(total) - len(w) for w in words)

    for name in ("cheappills", "apills", "xyz", "heaps", "a"):
        ways = [[name[i:j] for i, j in zip((0, *cuts), (*cuts, len(name)))] for k in range(1 << (len(name) - 1)) for cuts in [tuple(b + 1 for b in range(len(name) - 1) if k >> b & 1)]]
        assert math.isclose(cost(url_filter.best_split(name, known, total)), max(map(cost, ways)))
    assert url_filter.best_split("cheappills", known, total) == ["cheap", "pills"]


def test_long_names_and_long_words_are_split(spark):
    word = "pneumonoultramicroscopicsilicovolcanoconiosis"
    html = "<p>the cheap pills of a library and science of pills</p>"
    urls = ["http://y.net/cheappills", "http://y.net/" + "cheappills" * 8, "http://y.net/" + "libraryscience" * 300]
    found = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame([(i, u, html) for i, u in enumerate(urls)], "page_id long, url string, html string")).collect()}
    assert [found[i]["verdict"] for i in range(3)] == ["block", "block", "allow"] and found[1]["score"] > 3 * found[0]["score"] > 0
    counts = spark.createDataFrame([("cheap", 5), ("pills", 4), (word, 3)], "word string, n long")
    names = spark.createDataFrame([("cheap" + word + "pills",), ("cheappills" * 10 + word,)], "name string")
    split = {r["name"]: r["words"] for r in url_filter.segmented(names, counts).collect()}
    assert split == {"cheap" + word + "pills": ["cheap", word, "pills"], "cheappills" * 10 + word: ["cheap", "pills"] * 10 + [word]}


def brute_scores(urls, htmls, rounds):
    """Splits, counts and expectation maximisation over distinct urls, in plain Python."""
    counts = Counter(w for h in htmls for w in re.split(r"[^a-zé]+", re.sub(r"<[^>]*>", " ", re.sub(r"(?is)<(script|style)\b[^>]*>.*?</\1>", " ", h or "")).lower()) if len(w) > 1)
    total, split, sure = sum(counts.values()), {}, {}
    for url in {u for u in urls if u is not None}:
        host, path, _, verdict = brute(url)
        names = [x for x in re.split(r"[^a-zéü]+", f"{host}/{path}".lower()) if x]
        split[url] = [w for x in names for w in url_filter.best_split(x, {k: n for k, n in counts.items() if k in x}, total)]
        sure[url] = {"block": 1.0, "allow": 0.0}.get(verdict)
    p, score = dict(sure), {}
    for _ in range(rounds + 1):
        block, allow = Counter({w: 1.0 for w in url_filter.SEEDS["block"]}), Counter({w: 1.0 for w in url_filter.SEEDS["allow"]})
        for url, words in split.items():
            for w in words:
                block[w] += p[url] or 0
                allow[w] += 0 if p[url] is None else 1 - p[url]
        v = len({w for ws in split.values() for w in ws} | set(block) | set(allow))
        odds = lambda w: math.log((block[w] + 1) / (sum(block.values()) + v)) - math.log((allow[w] + 1) / (sum(allow.values()) + v))  # noqa: B023, E731
        score = {u: sum(map(odds, ws)) for u, ws in split.items()}
        p = {u: score_ if (score_ := sure[u]) is not None else 1 / (1 + math.exp(-score[u])) for u in split}
    return score


def test_scores_equal_brute_force(spark):
    rng = random.Random(4)
    words = ["cheap", "pills", "library", "science", "news", "garden", "poker", "tables", "river"]
    urls = [f"http://{rng.choice(words)}{rng.choice(words)}.{rng.choice(['net', 'org', 'com'])}/{rng.choice(['fr', 'de', 'en'])}/{'-'.join(rng.choices(words, k=rng.randint(0, 3)))}" for _ in range(60)] + URLS
    htmls = [f"<style>p{{cheap}}</style><p class='river'>{' '.join(rng.choices(words, k=6))}</p><script>var pills;</script>" for _ in urls]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(zip(urls, htmls))], "page_id long, url string, html string")
    want = brute_scores(urls, htmls, url_filter.ROUNDS)
    for r in url_filter.judge(pages).collect():
        assert math.isclose(r["score"], want.get(urls[r["page_id"]], 0.0), abs_tol=1e-3), urls[r["page_id"]]


def test_a_url_on_most_rows_and_null_urls(spark):
    pages = spark.range(3000).selectExpr("id as page_id", "case when id % 3 = 0 then null when id % 3 = 1 then 'http://hot.net/cheap' else concat('http://a', id, '.net/') end as url", "'<p>cheap hot</p>' as html")
    found = url_filter.judge(pages)
    assert found.count() == 3000 and found.where("page_id % 3 = 1").select("score").distinct().count() == 1 and found.where("page_id % 3 = 0 and verdict = 'allow' and host = ''").count() == 1000


def test_a_url_on_most_rows_is_judged_like_any_other(spark):
    html = "<p>the cheap pills of a library and science of pills</p>"
    rows = [(i, "http://y.net/cheappills" if i % 3 else f"http://y.net/library{i}", html) for i in range(3000)] + [(9000, None, html)]
    found = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).toPandas()
    assert len(found) == len(rows) and found.page_id.is_unique
    hot = found[found.page_id.isin([i for i in range(3000) if i % 3])]
    assert hot.score.nunique() == 1 and set(hot.verdict) == {"block"} and found[found.page_id == 9000].score.item() == 0
    once = url_filter.judge(spark.createDataFrame(rows[:1000], "page_id long, url string, html string")).count()
    assert once == 1000
