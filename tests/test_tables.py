"""Operators over keyword, alias and range tables of any size, and over batches that arrive one after another."""

import ipaddress
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from orgmill.operators import classify, components, matching, pages, ranges, resolve


@pytest.mark.parametrize("automaton", [1000, 0])
def test_keyword_table_equals_contains(spark, automaton):
    rng = random.Random(2)
    alphabet = "abcß é"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(200)] + [None, "", " ABC ", "aaaa"]
    table = [(p, f"L{p}", k, "".join(rng.choices("abcß é", k=rng.randint(1, 7)))) for p in range(6) for k in range(15)] + [(9, "never", 0, "zzzzzz"), (9, "never", 1, ""), (9, "never", 2, None)]
    df = spark.createDataFrame([(i, x, 1) for i, x in enumerate(texts)], "i int, text string, labels_ int").repartition(3)
    found = matching.classify_by_table(df, "text", spark.createDataFrame(table, "label_pos int, label string, keyword_pos int, keyword string"), automaton)
    for r in found.collect():
        want = defaultdict(list)
        for p, label, k, word in table:
            if r["text"] is not None and word and word in r["text"].strip(" ").lower():
                want[p, label].append((k, word))
        assert r["labels"] == [label for _, label in sorted(want)] and r["hits"] == [min(want[k])[1] for k in sorted(want)]
    assert found.count() == len(texts)


def test_keyword_table_equals_the_literal_form(spark):
    words = {"A": ["school", "lyceum"], "B": ["course", "it"], "C": []}
    table = [(p, label, k, w) for p, (label, own) in enumerate(words.items()) for k, w in enumerate(own)]
    df = spark.createDataFrame([("A School of IT",), ("nothing",), (None,), ("lyceum and school course",)], "t string")
    literal = classify.classify(df, "t", words).collect()
    by_table = matching.classify_by_table(df, "t", spark.createDataFrame(table, "label_pos int, label string, keyword_pos int, keyword string"))
    assert {(r["t"], tuple(r["labels"] or ()), tuple(r["hits"] or ())) for r in literal} == {(r["t"], tuple(r["labels"]), tuple(r["hits"])) for r in by_table.collect()}


@pytest.mark.parametrize("automaton", [1000, 0])
def test_aliases_of_a_table(spark, automaton):
    dim = spark.createDataFrame([(0, "New", "a"), (1, "new york", "b"), (2, "York", "c"), (3, "york", "d"), (4, "x", "e")], "alias_pos int, alias string, name string")
    df = spark.createDataFrame([("in NEW   YORK city",), ("york",), ("Newark",), ("none",), (None,), ("",), ("x",)], "place string")
    found = {r["place"]: r["name"] for r in matching.resolve_by_table(df, "place", dim, ["name"], automaton=automaton).collect()}
    assert found == {"in NEW   YORK city": "b", "york": "c", "Newark": "a", "none": None, None: None, "": None, "x": "e"}
    first = {r["place"]: r["name"] for r in matching.resolve_by_table(df, "place", dim, ["name"], True, automaton).collect()}
    assert first["in NEW   YORK city"] == "a" and first["york"] == "c"
    told = {r["place"]: (r["mentioned"], r["aliases"]) for r in matching.mentions_by_table(df, "place", dim, "name", automaton=automaton).collect()}
    assert told["york"] == (["c", "d"], ["York", "york"]) and told["x"] == ([], []) and told[None] == ([], [])


@pytest.mark.parametrize("automaton", [1000, 0])
def test_no_nested_loop_in_the_plans(spark, automaton):
    dim = resolve.city_dimension(spark)
    df = spark.createDataFrame([("Toshkent",)], "place string")
    for found in (matching.resolve_by_table(df, "place", dim, ["city"], automaton=automaton), matching.mentions_by_table(df, "place", dim, "city", automaton=automaton), resolve.resolve_city(df, "place", dim)):
        plan = found._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


HOSTS = ["10.1.2.3", "8.8.8.8", "::ffff:10.1.2.3", "[::1]", "::", "2001:db8::5", "2001:DB8:0:0:1::", "fe80::1%eth0", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1::2::3", "300.1.1.1", "example.org", "", None, "::ffff:a01:203", "64:ff9b::8.8.8.8", "12345::", "1:2:3:4:5:6:7::"]


def address(host):
    try:
        found = ipaddress.ip_address((host or "").strip().lower().strip("[]").split("%")[0])
    except ValueError:
        return None
    return getattr(found, "ipv4_mapped", None) or found


def test_addresses(spark):
    df = spark.createDataFrame([(h,) for h in HOSTS], "host string")
    for r in df.select("host", ranges.address(F.col("host")).alias("digits")).collect():
        own = address(r["host"])
        assert r["digits"] == (None if own is None else own.packed.hex()), r["host"]


def test_blocks_equal_brute_force(spark):
    rng = random.Random(3)
    blocks = [f"{rng.choice([10, 8, 192])}.{rng.randint(0, 3)}.{rng.randint(0, 3)}.{rng.randint(0, 255)}/{rng.randint(0, 32)}" for _ in range(60)]
    blocks += [f"2001:db8:{rng.randint(0, 15):x}::/{rng.randint(30, 64)}" for _ in range(30)] + ["::ffff:10.0.0.0/104", "::/0", "10.1.2.3", "bad", "10.0.0.0/33", None, "1.2.3.4/x"]
    hosts = [f"{rng.choice([10, 8, 192])}.{rng.randint(0, 3)}.{rng.randint(0, 3)}.{rng.randint(0, 255)}" for _ in range(80)] + [f"2001:db8:{rng.randint(0, 15):x}::{rng.randint(0, 99):x}" for _ in range(40)] + HOSTS
    known = {}
    for b in blocks:
        try:
            net = ipaddress.ip_network(b or "", strict=False)
        except ValueError:
            continue
        if net.version == 6 and net.prefixlen >= 96 and net.network_address.ipv4_mapped:
            net = ipaddress.ip_network(f"{net.network_address.ipv4_mapped}/{net.prefixlen - 96}", strict=False)
        known[b] = net
    df, table = spark.createDataFrame([(h,) for h in hosts], "host string"), spark.createDataFrame([(b,) for b in blocks], "cidr string")
    want = {(h, b) for h in hosts if (own := address(h)) for b, net in known.items() if own.version == net.version and own in net}
    assert {(r["host"], r["block"]) for r in ranges.blocks_of(df, "host", table, "cidr").collect()} == want
    best = {r["host"]: r["block"] for r in ranges.with_block(df, "host", table, "cidr").collect()}
    for h in hosts:
        own = [(-known[b].prefixlen, b) for x, b in want if x == h]
        assert best[h] == (min(own)[1] if own else None)


def test_ten_thousand_ranges_make_no_nested_loop(spark):
    table = spark.range(10_000).select(F.concat(F.col("id").cast("string"), F.lit(".0.0.0/8")).alias("x"), F.format_string("10.%d.%d.0/24", (F.col("id") / 256).cast("int"), F.col("id") % 256).alias("cidr"))
    df = spark.range(2000).select(F.format_string("10.%d.%d.9", F.col("id") % 256, F.col("id") % 200).alias("host"))
    found = ranges.with_block(df, "host", table, "cidr")
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and len(plan) < 50_000
    assert found.where("block is not null").count() == spark.range(2000).where("(id % 256) * 256 + id % 200 < 10000").count()


def test_blocked_ranges_as_a_table_equal_the_fixed_ones(spark):
    df = spark.createDataFrame([(h, s) for h in HOSTS + ["localhost", "169.254.1.1", "224.0.0.1", "fc00::1"] for s in ("http", "ftp")], "host string, scheme string")
    fixed = {(r["host"], r["scheme"]): r["blocked"] for r in pages.flag_private_hosts(df, "host", "scheme").collect()}
    table = {(r["host"], r["scheme"]): r["blocked"] for r in ranges.flag_blocked(df, "host", ranges.blocked_ranges(spark), scheme="scheme").collect()}
    assert {k: v for k, v in fixed.items() if k[0] != "fe80::1%eth0"} == {k: v for k, v in table.items() if k[0] != "fe80::1%eth0"}


def components_of(rows):
    root = {i: i for i, *_ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    first = {}
    for i, *keys in rows:
        for k, key in enumerate(keys):
            if key:
                other = first.setdefault((k, key), i)
                a, b = sorted((find(i), find(other)))
                root[b] = a
    return {i: find(i) for i, *_ in rows}


def test_batches_give_what_one_run_gives(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, rng.choice([None, "", *[f"n{k}" for k in range(120)]]), rng.choice([None, *[f"p{k}" for k in range(150)]])) for i in range(150)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, name string, phone string")
    parts = [rows[:60], rows[60:100], rows[100:] + rows[:5]]  # the last one repeats ids
    state, changes, written = str(tmp_path / "state"), [], []
    for k, part in enumerate(parts):
        before = {r["id"]: r["kept_id"] for r in components.current(spark, state, "bigint").collect()}
        change = components.add_batch(spark.createDataFrame(part, df.schema), k, state, "id", {"name": "name", "phone": "phone"})
        moved = {r["old"]: r["new"] for r in change.collect()}
        now = {r["id"]: r["kept_id"] for r in components.current(spark, state, "bigint").collect()}
        assert all(now[i] == moved.get(root, root) for i, root in before.items())  # the log tells every change, and nothing else changes
        assert now == components_of([r for r in rows if r[0] in now])
        changes.append(moved)
        files = {f: f.stat().st_mtime_ns for f in (tmp_path / "state").rglob("*.parquet")}
        assert all(files[f] == at for earlier in written for f, at in earlier.items())  # nothing earlier is written again
        written.append(files)
    assert any(changes[1:])
    again = components.add_batch(spark.createDataFrame(parts[2], df.schema), 2, state, "id", {"name": "name", "phone": "phone"})
    assert {r["old"]: r["new"] for r in again.collect()} == changes[2]
    one = {r["id"]: r["kept_id"] for r in resolve.resolve_duplicates(df, "id", {"name": "name", "phone": "phone"}).collect()}
    assert one == {r["id"]: r["kept_id"] for r in components.current(spark, state, "bigint").collect()}
    with pytest.raises(ValueError):
        components.add_batch(df.limit(1), 1, str(tmp_path / "other"), "id", {"name": "name"}) and components.add_batch(df.limit(1), 0, str(tmp_path / "other"), "id", {"name": "name"})


def test_a_batch_that_broke_off_is_done_again(spark, tmp_path):
    df = spark.createDataFrame([(5, "a"), (6, "b")], "id long, name string")
    state = str(tmp_path / "state")
    components.add_batch(df, 0, state, "id", {"name": "name"})
    later = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id long, name string")
    later.select("id", F.col("id").alias("root")).write.parquet(f"{state}/nodes/batch=1")  # what a broken run has left
    change = components.add_batch(later, 1, state, "id", {"name": "name"})
    assert {(r["old"], r["new"]) for r in change.collect()} == {(5, 1), (6, 2)}
    assert {r["id"]: r["kept_id"] for r in components.current(spark, state, "bigint").collect()} == {5: 1, 1: 1, 6: 2, 2: 2, 3: 2}
