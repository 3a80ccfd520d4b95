import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from orgmill.llm import conversation_repair as cr


def faults(rows):
    """b, d, t or nothing for each row of a conversation (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
        out.append("b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Cost, edits and repaired rows by trying everything: breadth first over (row, state), ties by the string of edits."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {(0, ""): (0, "", ())}
    for k in range(len(rows) + 1):
        for _ in range(3):  # insertions
            for state in ("", "s", "u", "a"):
                if (k, state) in best:
                    cost, edits, lines = best[k, state]
                    to = follow[state]
                    role = {"u": "user", "a": "assistant"}[to]
                    step = (cost + 3, edits + "I", lines + ((role, ""),))
                    best[k, to] = min(best.get((k, to), step), step)
        if k == len(rows):
            break
        for state in ("", "s", "u", "a"):
            if (k, state) not in best:
                continue
            cost, edits, lines = best[k, state]
            options = [(state, (cost + 4, edits + "D", lines))]
            if found[k] not in ("b", "d"):
                _, role, text = rows[k]
                more = 3 * (found[k] == "t")
                to = follow[state]
                if role[:1] == to or role[:1] == "s" and state == "":
                    options.append((role[:1], (cost + more, edits + "K", lines + ((role, text),))))
                options.append((to, (cost + 3 + more, edits + "R", lines + (({"u": "user", "a": "assistant"}[to], text),))))
            for to, step in options:
                best[k + 1, to] = min(best.get((k + 1, to), step), step)
    return min(best[len(rows), s] for s in ("", "a") if (len(rows), s) in best)


def plain(rows):
    """conv_id -> the report of its rows (turn, role, text), as they are."""
    own = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    if not own:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    found = faults(own)
    turns = [t for t, _, _ in own if t is not None]
    cost, edits, lines = cheapest(own, found)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, found.count("b"), found.count("d"), found.count("t"), illegal, cost, edits, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest()


def hurt(rows):
    out = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if k == 0:
            continue
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        out += [(c, t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    return out


def wild(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 5, 9, 30])):
            text = rng.choice(["Fine.", "Fine. ", "No", "Why?", "", " \t", f"Text {t}.", f"cut {t}", "é!", None])
            rows.append((c if c else None, rng.choice([t, t, t, None, t + 1]), rng.choice(["user", "assistant", "system", "tool", "", "User", None, "user", "assistant"]), text))
    return rows


def by_conversation(rows):
    out = defaultdict(list)
    for c, t, r, x in rows:
        out[c].append((t, r, x))
    return out


SCHEMA = "conv_id long, turn long, role string, text string, d int, nth int"


def reports(df):
    return {r["conv_id"]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in cr.report(df).collect()}


def test_reports_equal_brute_force(spark):
    rows = wild()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(5)
    own = by_conversation(hurt(rows))
    assert reports(df) == {c: plain(own.get(c, [])) for c in by_conversation(rows)}


def test_short_segments_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(cr, "SEGMENT", 3)
    monkeypatch.setattr(cr, "MAX_RULE", 4)
    rows = wild(60, 4) + [(777, t, "user" if t % 2 else "assistant", f"x{t % 40}.") for t in range(200)]
    own = by_conversation(hurt(rows))
    assert reports(spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)) == {c: plain(own.get(c, [])) for c in by_conversation(rows)}


def test_every_short_sequence():
    """All sequences of up to 4 symbols: the grammar's product equals the programme row by row, whatever the rules."""
    names = ["system", "user", "assistant", "tool"]
    for rules in ([], [(4, 8), (12, 12), (3, 12), (5, 5)]):
        grammar = cr.Grammar(rules)
        for n in (1, 2, 3):
            for symbols in itertools.product(range(cr.TERMINALS), repeat=n):
                whole = cr.product(grammar.of(bytes(symbols)), cr.inserts())[0]
                cost, rope = cr.better(whole[0], whole[3])
                rows = [(k, names[s // 3], f"{k}") for k, s in enumerate(symbols)]
                want = cheapest(rows, ["" if s % 3 == cr.STAYS else "t" if s % 3 == cr.CUT else "d" for s in symbols])
                assert (cost, cr.flat(rope)) == want[:2]


def test_rules_are_learnt_and_shorten_sequences(spark):
    rows = [(bytes([3, 6] * 50), 100), (bytes([0] + [3, 6] * 20), 30), (bytes([3] * 7), 2), (bytes([11]), 1)]
    grammar = cr.learn(spark.createDataFrame(rows, "symbols binary, n long"))
    assert (3, 6) in grammar.rules and len(grammar.compress(np.array([3, 6] * 50))) < 10
    x = np.array([3, 3, 3, -1, 3, 3, 6])
    assert cr.replaced(x, 3, 3, 12).tolist() == [12, 3, -1, 12, 6]

    def expand(s):
        return [s] if s < cr.TERMINALS else expand(grammar.rules[s - cr.TERMINALS][0]) + expand(grammar.rules[s - cr.TERMINALS][1])

    for symbols, _ in rows:
        assert sum((expand(s) for s in grammar.compress(np.frombuffer(symbols, np.uint8).astype(int)).tolist()), []) == list(symbols)


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi again."), (2, None, "user", "A question?"), (3, 5, "tool", "x")]
    repaired, plans = cr.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = defaultdict(list)
    for r in sorted(repaired.collect(), key=lambda r: (r["conv_id"], r["pos"])):
        out[r["conv_id"]].append((r["role"], r["text"], r["edit"]))
    assert out[1] == [("system", "S.", "K"), ("user", "Hi.", "K"), ("assistant", "Hi again.", "R")] and out[2] == [("user", "A question?", "K"), ("assistant", "", "I")] and 3 not in out
    assert {r["conv_id"]: (r["cost"], r["audit"]) for r in plans.collect()} == {1: (3, "KKR"), 2: (3, "KI"), 3: (4, "D")}


def test_empty_table_and_long_texts(spark):
    df = spark.createDataFrame([(1, 1, "user", "x" * 3_000_000 + "."), (1, 2, "assistant", "y " * 1_000_000)], "conv_id long, turn long, role string, text string")
    assert reports(df) == {1: plain([r[1:] for r in hurt([tuple(r) for r in df.collect()])])}
    assert reports(df.where(F.lit(False))) == {}
