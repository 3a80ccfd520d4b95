import random

import pytest
from pyspark.sql import functions as F

from orgmill.functions import expressions as X
from orgmill.operators import classify, evidence, pages, resolve, standardize, state
from orgmill.plans import engine
from orgmill.sources import io


def values(spark, column, cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string")
    return [r["x"] for r in df.select("i", column(F.col("c")).alias("x")).orderBy("i").collect()]


def test_names_and_slugs(spark):
    assert values(spark, X.name_key, ["Cambridge Learning Center", "  Najot Ta‘lim LLC ", "Émile", "Курс", None]) == ["cambridge learning", "najot talim", "emile", "", None]
    assert values(spark, lambda c: X.slug(c, F.lit("Tashkent")), ["Cambridge Learning Center"]) == ["cambridge-learning-center-tashkent"]
    assert values(spark, lambda c: X.slug(c), ["King's Academy", "Najot Ta'lim", "", None, "!!"]) == ["kings-academy", "najot-talim", "institution", "institution", "institution"]
    ids = values(spark, lambda c: X.entity_id(c, F.lit("x")), ["Курс А", "Курс Б"])
    assert ids[0] != ids[1]


def test_phones(spark):
    found = values(spark, X.phone, ["+998 90 123 45 67", "901234567", "+99890123", "0901234567", "", None, "998901234567"])
    assert [r["normalized"] for r in found] == ["+998901234567", "+998901234567", None, None, None, None, "+998901234567"]
    assert found[3]["reason"].startswith("leading 0") and found[2]["reason"].endswith("got 5")
    assert values(spark, X.phone2, ["+998909007966,+998944130900", "901234567", "ask", None, " "]) == ["+998909007966,+998944130900", "+998901234567", "ask", None, None]


def test_urls(spark):
    assert values(spark, X.url, ["Example.COM/", "http://A.b/c?d", "https://x.uz:8080/", None, " "]) == ["https://example.com", "http://a.b/c?d", "https://x.uz:8080", None, None]
    assert values(spark, X.handle, ["https://www.instagram.com/Name/"]) == ["instagram.com/name"]
    links = spark.createDataFrame([("http://a.b/c/d?x", h) for h in ("e", "/e", "//z.y/q", "https://w.v", "mailto:x")], "base string, href string")
    assert [r[0] for r in links.select(X.resolve_link(F.col("base"), F.col("href"))).collect()] == ["http://a.b/c/e", "http://a.b/e", "http://z.y/q", "https://w.v", None]


def test_languages_and_keywords(spark):
    df = spark.createDataFrame([(["Узбекский", " English ", "o'zbek", "", "Klingon", "EN"],), (None,)], "x array<string>")
    assert [r[0] for r in df.select(X.languages(F.col("x"))).collect()] == [["uz", "en", "klingon"], []]
    briefs = spark.createDataFrame([("maktab SAT kurs in Toshkent",), ("",), ("nothing",)], "b string")
    rows = classify.resolve_scopes(briefs, "b").collect()
    assert (rows[0]["types"], rows[0]["categories"], rows[0]["regions"]) == (["SCHOOL", "COURSE_CENTER"], ["SAT"], ["Tashkent"])
    assert rows[1]["categories"][0] == "LANGUAGES" and rows[2]["categories"] is None


def test_city_order(spark):
    df = spark.createDataFrame([("Toshkent viloyati, X",), ("tashkent",), ("Qarshi sh.",), ("?",), (None,)], "p string")
    dim = resolve.city_dimension(spark)
    assert {r["p"]: r["city"] for r in resolve.resolve_city(df, "p", dim).collect()} == {"Toshkent viloyati, X": "Tashkent Region", "tashkent": "Tashkent", "Qarshi sh.": "Karshi", "?": None, None: None}
    assert {r["city"] for r in resolve.resolve_city(df.limit(1), "p", dim, first_alias=True).collect()} == {"Tashkent"}


@pytest.mark.parametrize("order", [1, -1])
def test_duplicates_are_independent_of_order(spark, order):
    rows = [(0, "a", None), (1, "b", None), (2, "a", "p"), (3, None, "p"), (4, "", ""), (5, "b", None), (6, "", None)][::order]
    df = spark.createDataFrame(rows, "id int, name string, phone string").repartition(3)
    found = resolve.resolve_duplicates(df, "id", {"name": "name", "phone": "phone"})
    assert {r["id"]: r["kept_id"] for r in found.collect()} == {0: 0, 1: 1, 2: 0, 3: 0, 4: 4, 5: 1, 6: 6}
    assert {r["kept_id"]: r["merged_ids"] for r in resolve.duplicate_groups(found).collect()} == {0: [2, 3], 1: [5]}


def test_long_chain_is_one_component(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r["root"] for r in resolve.connected(chain).collect()} == {0}


def test_evidence_scores_and_merge(spark):
    one = spark.createDataFrame([(1, 0.6)], "evidence_count int, best_confidence double")
    assert evidence.with_source_confidence(one).first()["source_confidence"] == 52
    two = spark.createDataFrame([("e", 0, "+998 90 1234567", "https://a.uz/", "X st"), ("e", 1, "901234567", "www.a.uz", "Y st"), ("f", 2, "901234567", None, None)], "entity_id string, seq int, phone string, website string, address string")
    assert {r["seq"]: r["corroborated"] for r in evidence.corroborated(two, "entity_id", "seq").collect()} == {0: 2, 1: 2, 2: 0}
    lists = spark.createDataFrame([("e", 0.9, 2, ["IELTS", "SAT"]), ("e", 0.5, 1, ["General", "ielts", "Kids"])], "entity_id string, confidence double, seq int, programs array<string>")
    assert evidence.merge_lists(lists, "entity_id", "programs").first()["programs"] == ["General", "ielts", "Kids", "SAT"]
    kinds = spark.createDataFrame([("website", 0), ("website", 2)], "source_kind string, corroborated int")
    for c in ("phone", "address", "website", "email", "telegram", "instagram"):
        kinds = kinds.withColumn(c, F.lit("x"))
    assert [r["confidence"] for r in evidence.with_item_confidence(kinds).orderBy("corroborated").collect()] == [0.9, 0.95]
    full = spark.range(1).select(*[F.lit("x").alias(c) for c in ("nameUz", "phone", "city", "address", "type", "deliveryMode")], F.array(F.lit("SAT")).alias("categories"))
    assert evidence.with_completeness(full).first()["completeness"] == 80
    twice = evidence.append_evidence(two.select("entity_id", F.col("phone").alias("source_url"), "seq"), two.select("entity_id", F.col("phone").alias("source_url"), "seq"))
    assert twice.count() == 3


def test_description_and_junk(spark):
    df = spark.createDataFrame([("The best school, best of all, with a long text of facts", "N", None)], "descriptionSourceText string, nameUz string, nameRu string").withColumn("nameLatin", F.lit("L"))
    r = standardize.render_description(df).first()
    assert r["descriptionUz"] == "N haqida: The school, best of all, with a long text of facts" and r["descriptionRu"] is None and r["needs_review"]
    items = spark.createDataFrame([(["IELTS", "Registon o‘quv markazi", "Uzbekistan courses", "registon club"], ["Registon"])], "i array<string>, n array<string>")
    assert items.select(standardize.drop_junk_items(F.col("i"), F.col("n"))).first()[0] == ["IELTS"]


def test_links_facts_and_hosts(spark):
    html = '<header><a href="/kurslar">All</a></header><a href="courses.html">c</a><h1 class="x"> A &amp; B </h1><address>Toshkent, 5</address> href="tel:+998 (90) 1"'
    p = spark.createDataFrame([(1, "http://s.uz/a/b", html), (2, "http://s.uz/a/b", '<a href="courses.html">c</a>'), (3, "u", None)], "page_id int, url string, html string")
    assert {(r["page_id"], r["link"]) for r in pages.course_links(p).collect()} == {(1, "http://s.uz/kurslar"), (2, "http://s.uz/a/courses.html")}
    f = pages.page_facts(p).where("page_id = 1").first()
    assert (f["name"], f["city"], f["phone"]) == ("A & B", "Toshkent", "+998901")
    hosts = spark.createDataFrame([(h,) for h in ("10.1.2.3", "172.32.0.1", "localhost", "100.64.0.1", "8.8.8.8", "fe80::1", "x.org", "300.1.1.1")], "h string")
    assert [r["blocked"] for r in pages.flag_private_hosts(hosts, "h").collect()] == [True, False, True, True, False, True, False, False]


def test_csv_and_payloads(spark, tmp_path):
    df = spark.createDataFrame([(['a', 'b'], 'Bank, "the best"', None)], "x array<string>, y string, z string")
    assert io.csv_lines(df, {"x": "X", "y": "Y", "z": "Z"}).first()["line"] == 'a; b,"Bank, ""the best""",'
    io.write_csv(df, {"x": "X", "y": "Y, Z"}, str(tmp_path / "c"))
    raw = next((tmp_path / "c").glob("part*")).read_bytes()
    assert raw == '﻿X,"Y, Z"\r\na; b,"Bank, ""the best"""\r\n'.encode()
    texts = ['```json\n[{"a": 1}]\n```', 'so {"items": [{"a": 1}, {"a": 2}]}', "[]", "none", '{"other": 1}', None]
    got = io.unwrap_records(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    assert [len(r["records"]) for r in got.collect()] == [1, 2, 0, 0, 0, 0]


def test_run(spark):
    rows = [(0, "Alpha School", "Tashkent", "SAT", "SCHOOL", "901234567", "alpha.uz", None, None), (1, "Alpha O'quv", "Toshkent", "SAT", "SCHOOL", "+998901234567", None, None, None), (2, "Beta", "Nukus", None, None, None, None, None, None)]
    c = spark.createDataFrame(rows, "input_pos int, rawName string, city string, category string, type string, phone string, website string, telegram string, instagram string")
    kept = {r["input_pos"]: r["entity_id"] for r in engine.dedupe(c).collect()}
    assert set(kept) == {0, 2}
    text = "A school with a long and detailed text about its courses"
    items = [(kept[0], f"https://s{i}", "website", i, "Alfa", "Альфа", "901234567", "alpha.uz", "Main st. 1", "a@b.uz", text, ["Kids"], 1999) for i in range(3)]
    e = spark.createDataFrame(items, "entity_id string, source_url string, source_kind string, seq int, nameUz string, nameRu string, phone string, website string, address string, email string, descriptionSourceText string, programs array<string>, foundedYear int")
    found = {r["entity_id"]: r for r in engine.run(c, e).collect()}
    assert found[kept[0]]["outcome"] == "APPROVED", found[kept[0]]
    assert found[kept[2]]["outcome"] == "NEEDS_REVIEW" and found[kept[2]]["record"] is None


def test_candidate_and_state_documents(spark, tmp_path):
    (tmp_path / "c.json").write_text('{\n "institutions": [\n {"fixtureId": "b", "rawName": "B"},\n {"fixtureId": "a", "rawName": "A", "city": "Tashkent"}]}')
    rows = io.read_candidates(spark, str(tmp_path / "c.json")).orderBy("input_pos").collect()
    assert [(r["input_pos"], r["fixtureId"], r["city"]) for r in rows] == [(0, "b", None), (1, "a", "Tashkent")]
    records = spark.createDataFrame([(2, "y"), (1, "x")], "id int, name string")
    io.write_envelope(records, str(tmp_path / "e"), "2024-01-01T00:00:00Z", "id")
    assert [tuple(r) for r in io.read_export(spark, str(tmp_path / "e"), "id int, name string").collect()] == [(1, "x"), (2, "y")]
    (tmp_path / "bare.json").write_text('[{"id": 3, "name": "z"}]')
    assert [tuple(r) for r in io.read_export(spark, str(tmp_path / "bare.json"), "id int, name string").collect()] == [(3, "z")]
    io.write_records(records, str(tmp_path / "r"))
    assert io.read_state(spark, str(tmp_path / "r"), "id int, name string").count() == 2


def test_hosts_written_as_ipv6(spark):
    cases = {"::ffff:10.0.0.1": True, "::FFFF:8.8.8.8": False, "[::ffff:127.0.0.1]": True, "0:0:0:0:0:ffff:192.168.1.1": True, "::ffff:a00:1": True, "::ffff:808:808": False, "[::1]": True, "0:0:0:0:0:0:0:1": True, "2001:db8::1": False, "fe80::1": True, "fc00::": True, "": False}
    df = spark.createDataFrame([(h,) for h in [*cases, None]], "h string")
    found = {r["h"]: r["blocked"] for r in pages.flag_private_hosts(df, "h").collect()}
    assert found == cases | {None: False}
    schemes = spark.createDataFrame([("x.org", "ftp"), ("x.org", "HTTPS")], "h string, s string")
    assert [r["blocked"] for r in pages.flag_private_hosts(schemes, "h", "s").collect()] == [True, False]


def test_crawl_without_and_with_a_budget(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(80)], "a long, b long")
    start = spark.createDataFrame([(0,)], "id long")
    assert {r["id"]: r["depth"] for r in pages.crawl_reach(start, chain).collect()} == {i: i for i in range(81)}
    with pytest.raises(RuntimeError):
        pages.crawl_reach(start, chain, max_depth=50)
    edges = [("a", "c", 0), ("a", "b", 1), ("b", "d", 0), ("c", "e", 0), ("c", "b", 1), ("d", "a", 0), ("e", "f", 0)]
    e = spark.createDataFrame(edges, "a string, b string, place int")
    seeds = spark.createDataFrame([("a", 0)], "id string, pos int")
    order = lambda **k: [r["id"] for r in pages.crawl_reach(seeds, e, **k).orderBy("pos").collect()]
    assert order(most=300) == ["a", "c", "b", "e", "d", "f"]
    assert order(most=4) == ["a", "c", "b", "e"]
    named = spark.createDataFrame([("b",), ("d",)], "id string")
    assert order(most=300, named=named, target=1) == ["a", "c", "b"]
    assert order(most=300, named=named, target=2) == ["a", "c", "b", "e", "d"]
    assert order(most=300, named=named, target=9) == ["a", "c", "b", "e", "d", "f"]


def test_ambiguous_pairs_are_all_found(spark):
    rng = random.Random(6)
    names = ["shared word center"] * 3 + [f"shared word center {i}" for i in range(60)] + ["ab", "ac", "a", "", None, "abcde", "abcdf", "xbcde"]
    names += ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 14))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    first = {}
    for i, n in enumerate(names):
        first.setdefault(n, i)

    def distance(p, q):
        row = list(range(len(q) + 1))
        for i, x in enumerate(p, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(q, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    own = sorted((i, n) for n, i in first.items() if n)
    for t in (0.1, 0.2, 0.25):
        want = {(a, b) for k, (a, p) in enumerate(own) for b, q in own[k + 1 :] if distance(p, q) <= t * max(len(p), len(q))}
        assert {(r["a"], r["b"]) for r in resolve.ambiguous_pairs(df, "id", "name", t).collect()} == want
    assert resolve.ambiguous_pairs(df.limit(0), "id", "name").count() == 0


def test_transitions_and_stages(spark):
    log = spark.createDataFrame([("a", 1, "DISCOVERED", None, 0), ("a", 2, "RESEARCHING", None, 1)], "id string, at int, state string, note string, seq long")
    new = spark.createDataFrame([("a", 3, "VERIFIED", "x"), ("b", 3, "REJECTED", None), ("b", 3, "RESEARCHING", None)], "id string, at int, state string, note string")
    out = state.append_transitions(log, new, "id").orderBy("id", "at", "seq").collect()
    assert [(r["id"], r["state"], r["seq"]) for r in out] == [("a", "DISCOVERED", 0), ("a", "RESEARCHING", 1), ("a", "VERIFIED", 2), ("b", "DISCOVERED", -1), ("b", "RESEARCHING", 0), ("b", "REJECTED", 1)]
    assert {r["id"]: r["state"] for r in state.state_latest(state.append_transitions(log, new, "id"), "id").collect()} == {"a": "VERIFIED", "b": "REJECTED"}
    assert [r["state"] for r in state.past_stage(new, "VERIFIED").orderBy("state").collect()] == ["REJECTED", "VERIFIED"]


def test_one_file_sinks_have_a_bound(spark, tmp_path):
    df = spark.range(20).selectExpr("id", "'x' as name")
    with pytest.raises(ValueError):
        io.write_csv(df, {"id": "Id"}, str(tmp_path / "a"), most=10)
    with pytest.raises(ValueError):
        io.write_envelope(df, str(tmp_path / "b"), "2024-01-01T00:00:00Z", "id", most=10)
    io.write_csv_parts(df.repartition(3), {"id": "Id"}, str(tmp_path / "c"))
    assert spark.read.text(str(tmp_path / "c")).count() == 20
    objects = spark.createDataFrame([('```json\n{"a": 1}\n```',), ('[{"a": 2}, {"a": 3}]',), ("[]",), ("[1]",), ("none",), (None,)], "t string")
    assert [r["object"] for r in io.unwrap_object(objects, "t").collect()] == ['{"a":1}', '{"a":2}', None, None, None, None]


def test_superlative_with_a_number_sign(spark):
    df = spark.createDataFrame([("Markaz№1 and the best place with a long text of facts", "N", None)], "descriptionSourceText string, nameUz string, nameRu string").withColumn("nameLatin", F.lit("L"))
    assert standardize.render_description(df).first()["descriptionUz"] == "N haqida: Markaz and the best place with a long text of facts"
    rows = spark.createDataFrame([("x", None, None), (" ", [], None), (None, ["a"], None), (None, None, 3)], "a string, b array<string>, c int")
    assert classify.with_some_field(rows, ["a", "b", "c"]).count() == 3
