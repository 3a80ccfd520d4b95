import duckdb

from orgmill.llm import decontaminate

ITEM = "If Anna buys 12 apples for 30 dollars and later Anna sells 12 pears, how much does Anna earn in total this week?"
OTHER = "the quick brown fox jumps over the lazy dog while seven cats watch from behind a tall green fence nearby"
DOCS = [
    (0, f"Some words first. {ITEM} And some after it."),
    (1, f"Intro here, {ITEM.replace('Anna', 'Boris').replace('12', '47').replace('30', '9')} End."),  # consistent
    (2, ITEM.replace("Anna buys 12", "Carl buys 5").replace("later Anna sells 12", "later Dora sells 99")),  # inconsistent
    (3, OTHER.upper()), (4, OTHER), (5, " ".join(OTHER.split()[:9]) + " and then something else altogether happened there"),
    (6, "A clean text about nothing in particular, with 12 apples."), (7, None), (8, ""), (9, "... 5 !"), (4, OTHER), (None, OTHER),
]
ITEMS = [(100, ITEM), (101, OTHER), (102, "too short"), (103, None), (None, OTHER), (104, "1 2 3 4 5 6 7")]


def test_leaks_and_slots(spark):
    docs = spark.createDataFrame([(*r, "x") for r in DOCS], "doc_id long, text string, item_id string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in decontaminate.find_leaks(docs, items).collect()}
    assert found == {(0, 100): False, (1, 100): True, (3, 101): False, (4, 101): False, (None, 101): False}
    kept = decontaminate.remove_leaks(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 5, 6, 7, 8, 9]
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0 and decontaminate.find_leaks(docs.limit(0), items).count() == 0


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    before = sorted(map(str, decontaminate.find_leaks(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert sorted(map(str, decontaminate.find_leaks(docs, items).collect())) == before


def test_oracle_agrees(spark):
    docs = [r for i, r in enumerate(DOCS) if r[0] is not None and i < 10]
    items = [r for r in ITEMS if r[0] is not None and r[1]]
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    want = sorted(con.sql(decontaminate.ORACLE).fetchall())
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(tuple(r) for r in found.drop("key").collect()) == want and len(want) == 4


def test_each_occurrence_is_judged_alone(spark):
    twice = "Later that day Tom had 3 red apples in his bag while Jim had 5 red apples in his old box near home"
    sheet = "She paid 14 dollars for two tickets and then walked over to buy bread"
    rows = [
        (0, f"Before it. {twice} and after."),  # (a) one template window twice, with other values
        (1, f"{sheet.replace('14', '21')} again. Next one: {sheet.replace('14', '35')} again."),  # (b) twice with other numbers
        (2, f"{sheet}. " + "filler words go on " * 30 + "he said she paid 99 dollars for two coats"),  # (c) one chance match elsewhere
        (3, twice.replace("Tom had 3", "Bob had 8").replace("5 red", "8 red").replace("near home", "near Bob")),
        (4, f"{sheet.replace('14', '21')} again. {sheet.replace('two', 'three')}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, twice), (2, sheet)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["n_windows"] == r["n_item_windows"], r["reparameterised"]) for r in decontaminate.find_leaks(docs, items).collect()}
    assert found[0, 1] == (True, False) and found[1, 2] == (True, True) and found[2, 2] == (True, False) and found[4, 2] == (True, True)
    odd = "Mia has 2 cats and Mia has 2 dogs and Mia has 2 fish and Mia has 2 birds"  # one value against several within an occurrence
    broken = odd.replace("2 dogs", "3 dogs").replace("2 fish", "4 fish").replace("2 birds", "5 birds")
    one = spark.createDataFrame([(9, broken)], "doc_id long, text string")
    assert decontaminate.find_leaks(one, spark.createDataFrame([(3, odd)], "item_id long, text string")).count() == 0


def test_short_and_slot_heavy_items_are_found_as_written(spark):
    items = [(1, "What is 48 * 12 + 7 - 3?"), (2, "Define osmosis."), (3, "7 14 21 28 35 42 49")]
    rows = [(0, "Quiz time! What is 48 * 12 + 7 - 3? Think."), (1, "What is 51 * 12 + 9 - 4?"), (2, "First, define osmosis. Then rest."), (3, "define it, then osmosis"), (4, "it counts 7, 14, 21, 28, 35, 42, 49 aloud"), (5, "it counts 8 16 24 32 40 48 56 aloud"), (None, "what is 48 12 7 3")]
    found = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(0, 1), (2, 2), (4, 3), (None, 1)}


def test_very_long_texts_and_repeated_items(spark):
    filler = " ".join(f"filler{i}" for i in range(100_000))
    docs = spark.createDataFrame([(1, f"{filler} {ITEM} {filler}"), (2, filler), (3, "1 2 3 " * 50_000)], "doc_id long, text string")
    items = spark.createDataFrame([(100, ITEM), (100, ITEM), (101, OTHER)], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()} == {(1, 100)}


STORIES = [
    "{0} has 5 apples and a basket. {0} sells 3 of them on the market. {0} then buys 1 melon for {1} and goes home.",
    "{0} walks 12 km every morning before work. {1} runs 7 km with {0} twice a week. {0} rests when {1} swims.",
    "{0} and {1} share 40 sweets between them. {1} gives 6 of hers to {0} after lunch. How many sweets does {1} have left now?",
    "There are 30 books on the shelf of {0}. {1} takes 4 of them and brings 2 others back. {0} counts them again in the evening.",
]


def test_names_that_begin_sentences_and_names_of_any_script(spark):
    """Questions with other names and numbers, names at the beginning of sentences only, and names in other alphabets."""
    names = [("Anna", "Bob"), ("Мария", "Иван"), ("Élodie", "Åke"), ("Zoë", "Łukasz"), ("Ольга", "Tim")]
    items = [(i, story.format("Clara", "Dan")) for i, story in enumerate(STORIES)]
    docs = []
    for k, (a, b) in enumerate(names):
        for i, story in enumerate(STORIES):
            text = story.format(a, b)
            for old, new in (("5 ", "8 "), ("12 ", "31 "), ("40 ", "90 "), ("30 ", "77 ")):
                text = text.replace(old, new)
            docs.append((10 * k + i, f"Homework for today follows here. {text} That is all for today, good luck with it."))
            mixed = text.split(f"{a} ")
            docs.append((1000 + 10 * k + i, f"{mixed[0]}{a} " + " Eve ".join(mixed[1:])))  # one name against two
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(10 * k + i, i) for k in range(len(names)) for i in range(len(STORIES))}
    assert len(found & want) >= 0.9 * len(want) and all(i == d % 10 for d, i in found)


def test_one_word_items_need_a_line_of_their_own(spark):
    items = spark.createDataFrame([(1, "Why?"), (2, "42"), (3, "Tell me")], "item_id long, text string")
    rows = [(0, "why did the dog run home today"), (1, "Why?"), (2, "First line.\n why? \nthird line"), (3, "the answer is 42"), (4, "42."), (5, "please tell me now"), (6, "")]
    found = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(1, 1), (2, 1), (4, 2), (5, 3)}


def test_one_window_of_many_is_no_leak(spark):
    """An item most of whose windows are too full of placeholders to be searched is not found by the one that is."""
    item = "Ann 3 Bob 4 Cid 5 walks over the old bridge 6 Dan 7 Eve 8 Fay 9 Gus 10 Hal 11"
    rows = [(0, "He walks over the old bridge at noon and thinks of nothing."), (1, f"So: {item}."), (2, f"So: {item.replace('Ann', 'Zed').replace('3', '33')}.")]
    found = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {(r["doc_id"], r["reparameterised"]) for r in found.collect()} == {(1, False), (2, True)}


def test_oracle_agrees_on_what_the_others_plant(spark):
    rows = [(i, text) for i, (_, text) in enumerate(r for r in DOCS if r[1])]
    twice = "Later that day Tom had 3 red apples in his bag while Jim had 5 red apples in his old box near home"
    rows += [(50, f"Before it. {twice} and after."), (51, twice.replace("Tom had 3", "Bob had 8").replace("5 red", "8 red")), (52, "First, define osmosis. Then rest."), (53, "it counts 7, 14, 21, 28, 35, 42, 49 aloud"), (54, "Why?\nno"), (55, STORIES[0].format("Мария", "Bob").replace("5", "6")), (56, STORIES[1].format("Ann", "Ann"))]
    items = [(100, ITEM), (101, OTHER), (1, twice), (2, "Define osmosis."), (3, "7 14 21 28 35 42 49"), (4, "Why?"), (5, STORIES[0].format("Clara", "Dan")), (6, STORIES[1].format("Clara", "Dan"))]
    con = duckdb.connect()
    for name, key, own in (("documents", "doc_id", rows), ("benchmark", "item_id", items)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", own)
    found = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(tuple(r) for r in found.drop("key").collect())
    assert got == sorted(con.sql(decontaminate.ORACLE).fetchall()) and len({i for _, i, *_ in got}) >= 7
