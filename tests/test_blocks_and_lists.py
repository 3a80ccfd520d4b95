import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orgmill.operators import blocks, lists, pages, resolve, state

PAGE = """<html><body><!-- <nav>no</nav> --><header><nav class="a>b"><a href="/one">Course one</a><nav><a href='/two'>course <b>two</b></a></nav><a href="/three">course three</a></nav>
<a href="/four">course four</a></header><script>var x = "<nav><a href='/no'>course no</a></nav>";</script><article>First<article>inner</article> rest<br>line<ul><li>open<li>items</ul></article>
<table><tr><th>A</th><th>B<!-- x --></th></tr><tr><td>1<table><tr><td>deep</td></tr></table></td><td>2</td></tr></table><a href="/five">course five</a><p>never closed <b>bold</body></html>"""


def test_elements_are_nested_intervals():
    found = blocks.scanned(PAGE)
    inside = lambda x: PAGE[x["start"] : x["stop"]]
    for x in found:
        for y in found:  # one holds the other, or they are apart
            assert x is y or x["stop"] <= y["open"] or y["stop"] <= x["open"] or x["start"] <= y["open"] and y["stop"] <= x["stop"] or y["start"] <= x["open"] and x["stop"] <= y["stop"]
    by_tag = defaultdict(list)
    for x in found:
        by_tag[x["tag"]].append(inside(x))
    assert len(by_tag["nav"]) == 2 and by_tag["nav"][1] == "<a href='/two'>course <b>two</b></a>" and by_tag["nav"][0].endswith("course three</a>")
    assert by_tag["article"] == ["First<article>inner</article> rest<br>line<ul><li>open<li>items</ul>", "inner"] and by_tag["br"] == [""]
    assert by_tag["li"] == ["open<li>items", "items"] and by_tag["p"][0].startswith("never closed") and len(by_tag["script"]) == 1
    assert blocks.scanned("") == [] and blocks.scanned("</p>no < tags > <") == [] and blocks.scanned("<a")== []


def test_links_and_facts_of_nested_blocks(spark):
    df = spark.createDataFrame([(1, "http://h/x", PAGE), (2, "http://h/y", None), (3, "http://h/z", ""), (4, "http://h/w", "<a href='/only'>course</a><!-- <a href='/not'>course</a> -->")], "page_id int, url string, html string")
    found = {(r["page_id"], r["link"]) for r in pages.course_links(df, ["course"]).collect()}
    assert found == {(1, "http://h/one"), (1, "http://h/two"), (1, "http://h/three"), (1, "http://h/four"), (4, "http://h/only")}
    facts = {r["page_id"]: r for r in pages.page_facts(df).collect()}
    assert facts[1]["descriptionSourceText"] == "First inner rest\nline open items" and facts[3]["descriptionSourceText"] is None and facts[2]["name"] is None
    assert facts[1]["categoryLabels"] == ["Course one", "course three"]


def test_tables_in_tables(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<td>alone</td>")], "page_id int, html string")
    rows = {(r["table_n"], r["row_n"]): r["cells"] for r in blocks.table_rows(df).collect()}
    assert rows == {(0, 0): ["A", "B"], (0, 1): ["1 deep", "2"], (1, 0): ["deep"]}


def test_places_over_many_ranges(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None, *map(str, range(40))]), rng.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, at int, seq int").repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        found = lists.numbered(df, "k", ["at", "seq"]).collect()
        chunks = lists.chunked(df, "k", ["at", "seq"], "seq", 100).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    own = defaultdict(list)
    for k, at, seq in sorted(rows, key=lambda r: (r[1], r[2])):
        own[k].append((at, seq))
    assert {(r["k"], r["pos"]): (r["at"], r["seq"]) for r in found} == {(k, i): x for k, v in own.items() for i, x in enumerate(v)}
    for r in chunks:
        assert r["first"] == r["chunk"] * 100 and r["items"] == [s for _, s in own[r["k"]][r["first"] : r["first"] + 100]]
    assert lists.numbered(df.limit(0), "k", ["at"]).count() == 0


def test_one_entity_with_very_many_items(spark):
    """The whole list is never in one place: chunks of 10,000, each in its own group."""
    n = 400_000
    log = spark.range(n).select(F.lit("one").alias("k"), F.timestamp_micros(F.col("id") * 7919 % n).alias("at"), F.col("id").alias("seq"), F.col("id").cast("string").alias("state"))
    out = lists.history_chunks(log, "k")
    sizes = out.select("chunk", F.size("items").alias("n"), F.element_at("items", 1).cast("long").alias("x")).collect()
    assert sum(r["n"] for r in sizes) == n and max(r["n"] for r in sizes) == lists.CHUNK
    assert all(r["x"] * 7919 % n == r["chunk"] * lists.CHUNK for r in sizes)


def test_history_in_chunks_equals_the_whole(spark):
    rng = random.Random(3)
    log = spark.createDataFrame([(rng.randint(0, 3), rng.randint(0, 9), i, rng.choice("ABC")) for i in range(200)], "k int, at int, seq int, state string")
    whole = {r["k"]: r["history"] for r in state.state_history(log, "k").collect()}
    parts = defaultdict(list)
    for r in lists.history_chunks(log, "k", size=7).orderBy("k", "chunk").collect():
        parts[r["k"]] += r["items"]
    assert parts == whole


@pytest.mark.parametrize("threshold, hot", [(0.2, 5000), (0.25, 3), (0.1, 1)])
def test_ambiguous_pairs_with_hot_letters(spark, threshold, hot):
    rng = random.Random(9)
    words = ["School No. " + str(rng.randint(1, 60)) for _ in range(40)] + ["".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(60)]
    rows = [(i, w) for i, w in enumerate(words)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    first = {}
    for i, w in rows:
        first.setdefault(w, i)
    want = {(i, j) for a, i in first.items() for b, j in first.items() if i < j and distance(a, b) <= threshold * max(len(a), len(b))}
    got = [(r["a"], r["b"]) for r in resolve.ambiguous_pairs(spark.createDataFrame(rows, "id long, name string"), "id", "name", threshold, hot).collect()]
    assert len(got) == len(set(got)) and set(got) == want
