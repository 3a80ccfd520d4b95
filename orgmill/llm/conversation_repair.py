"""The cheapest repair of conversations whose turns are damaged, by a dynamic programme over grammar-compressed sequences.

Rows of a conversation are taken by turn (nulls first; rows of one turn by role and text). A row's first fault counts: blank,
duplicate (its role and text have occurred before), truncated (its last character that is no space is none of .!?). Edits:
Keep 0, Rerole to user or assistant 3, Delete 4 (blank and duplicate rows must go), Insert an empty user or assistant row
3; a truncated row that stays adds 3. The repaired roles' initials are (s?(ua)+)?. Of the cheapest repairs, the one whose
edits' initials come first in ASCII order counts.

1. Each row is one of 12 symbols: its role's initial (s, u, a, other) and what its fault means (stays, truncated, must go). Rows
   without texts are sorted in ranges of (conversation, turn), so a conversation on any share of the rows is many
   tasks'; each gives its part of a conversation as segments of SEGMENT symbols at most.
2. Re-Pair: pairs of neighbouring symbols are counted over all distinct segments, weighted by their number; the most
   frequent pairs that share no symbol become rules, and the next round counts in the rewritten segments.
3. Four states (nothing yet, after s, after u, after a): a symbol is a matrix of the least cost from state to state and the
   edits that reach it. A rule's matrix is the min-plus product of its two symbols', its edits a rope of theirs. The rules
   are evaluated once, bottom-up, and serve all conversations; equal segments are evaluated once in a task.
   Costs and edits go together: two edit sequences of the same rows and cost never are each other's prefix, so
   taking the least of them early is right.
4. A conversation's segments are multiplied in order. Then one shuffle brings its rows to its edits (a stream: no conversation
   is held in memory), which gives the repaired rows.

A null role or text is one space; a null conv_id is a conversation of its own. Repeated rows are duplicates. Further columns are
ignored. An empty table gives no rows. A conversation's edits are one string, a letter for each of its rows.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgmill.llm.common import BROADCAST_KEYS, lean, stored

SEGMENT, ROUNDS, MAX_RULE, LEAST_GAIN = 1 << 15, 16, 1024, 0.002
INITIALS, STAYS, CUT, GOES = "sua", 0, 1, 2
TERMINALS = 12
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACES = r"[\x20\x09-\x0D]"


# Transfer matrices: 4 x 4 of None or (cost, rope); a rope is a string or a pair of ropes.
def flat(rope) -> str:
    out, todo = [], [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += [x[1], x[0]]
    return "".join(out)


def better(x, y):
    """The cheaper one, of equal ones the one that comes first."""
    if x is None or y is None:
        return x or y
    if x[0] != y[0]:
        return x if x[0] < y[0] else y
    return x if flat(x[1]) <= flat(y[1]) else y


def product(a: list, b: list) -> list:
    out = []
    for row in a:
        new = [None] * 4
        for j in range(4):
            for k in range(4):
                if row[k] and b[k][j]:
                    cost = row[k][0] + b[k][j][0]
                    if new[j] is None or cost <= new[j][0]:
                        new[j] = better(new[j], (cost, (row[k][1], b[k][j][1])))
        out.append(new)
    return out


def inserts() -> list:
    """Any insertions, none included: after nothing, s and a comes u, after u comes a."""
    out = [[(0, "") if i == j else None for j in range(4)] for i in range(4)]
    for i in (0, 1, 3):
        out[i][2] = (INSERT, "I")
    for i in (0, 1):
        out[i][3] = (2 * INSERT, "II")
    out[2][3] = (INSERT, "I")
    return out


def terminal(symbol: int) -> list:
    """Insertions before a row, then the row's edit."""
    initial, fault = divmod(symbol, 3)
    own = [[(DELETE, "D") if i == j else None for j in range(4)] for i in range(4)]
    if fault != GOES:
        more = TRUNCATED if fault == CUT else 0
        for i, j in ((0, 2), (1, 2), (3, 2), (2, 3)):
            own[i][j] = (REROLE + more, "R")
        for i, j in (((0, 1),), ((0, 2), (1, 2), (3, 2)), ((2, 3),), ())[initial]:
            own[i][j] = (more, "K")
    return product(inserts(), own)


class Grammar:
    """Rules: symbol TERMINALS + i stands for rules[i], two earlier symbols."""

    def __init__(self, rules: list[tuple[int, int]]):
        self.rules = rules

    def __reduce__(self):  # tasks get the rules and evaluate them once
        return grammar_of, (tuple(self.rules),)

    @functools.cached_property
    def matrices(self) -> list:
        """Bottom-up: each rule from two that are known."""
        out = [terminal(s) for s in range(TERMINALS)]
        for a, b in self.rules:
            out.append(product(out[a], out[b]))
        return out

    @functools.cached_property
    def lengths(self) -> list[int]:
        out = [1] * TERMINALS
        for a, b in self.rules:
            out.append(out[a] + out[b])
        return out

    def compress(self, x: np.ndarray) -> np.ndarray:
        """Symbols by rules; -1 separates sequences."""
        for new, (a, b) in enumerate(self.rules, TERMINALS):
            x = replaced(x, a, b, new)
        return x

    def of(self, symbols: bytes) -> list:
        """The matrix of a segment: a balanced product of its compressed symbols."""
        if symbols not in self.seen:
            if len(self.seen) > 20_000:
                self.seen.clear()
            found = Balanced()
            for s in self.compress(np.frombuffer(symbols, np.uint8).astype(np.int64)).tolist():
                found.push(self.matrices[s])
            self.seen[symbols] = found.result()
        return self.seen[symbols]

    @functools.cached_property
    def seen(self) -> dict:
        return {}


@functools.lru_cache(maxsize=2)
def grammar_of(rules: tuple[tuple[int, int], ...]) -> Grammar:
    return Grammar(list(rules))


class Balanced:
    """A product of many matrices in order, as a tree: equal ranks join."""

    def __init__(self) -> None:
        self.parts: list[tuple[int, list]] = []

    def push(self, matrix: list) -> None:
        rank = 0
        while self.parts and self.parts[-1][0] == rank:
            matrix, rank = product(self.parts.pop()[1], matrix), rank + 1
        self.parts.append((rank, matrix))

    def result(self) -> list:
        return functools.reduce(lambda right, left: product(left, right), [m for _, m in reversed(self.parts)])


def pairs_at(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """Where the pair stands; of overlapping ones (a = b) each second one of a run."""
    at = np.flatnonzero((x[:-1] == a) & (x[1:] == b))
    if a == b and len(at):
        begins = np.concatenate([[True], np.diff(at) > 1])
        first = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - first) % 2 == 0]
    return at


def replaced(x: np.ndarray, a: int, b: int, new: int) -> np.ndarray:
    at = pairs_at(x, a, b)
    if not len(at):
        return x
    x = x.copy()
    x[at] = new
    return np.delete(x, at + 1)


def learn(segments: DataFrame, rounds: int = ROUNDS) -> Grammar:
    """Rules for the segments (symbols, n: how often). Each round is one pass that counts pairs; the driver sees the counts of
    pairs of symbols, not sequences. The rules change no result, only how much work is shared."""
    grammar = Grammar([])
    for _ in range(rounds):
        size = TERMINALS + len(grammar.rules)

        def count(batches, grammar=grammar, size=size):
            total = np.zeros(size * size, np.int64)
            length = 0
            for batch in batches:
                for symbols, n in zip(batch.column("symbols").to_pylist(), batch.column("n").to_pylist()):
                    x = grammar.compress(np.frombuffer(symbols, np.uint8).astype(np.int64))
                    length += n * len(x)
                    found, times = np.unique(x[:-1] * size + x[1:], return_counts=True)
                    for p, k in zip(found.tolist(), times.tolist()):
                        a, b = divmod(p, size)
                        total[p] += n * (k if a != b else len(pairs_at(x, a, b)))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], length))], names=["pair", "n"])

        found = {r["pair"]: r["n"] for r in segments.mapInArrow(lean(count), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()}
        length, used, rules = found.pop(-1, 0), set(), list(grammar.rules)
        for p, n in sorted(found.items(), key=lambda x: (-x[1], x[0])):
            a, b = divmod(p, size)
            if n < max(2, LEAST_GAIN * length):
                break
            if not {a, b} & used and grammar.lengths[a] + grammar.lengths[b] <= MAX_RULE:
                used |= {a, b}
                rules.append((a, b))
        if len(rules) == len(grammar.rules):
            break
        grammar = Grammar(rules)
    return grammar


def rows_of(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, d (a digest of role and text), blank and cut."""
    own = df.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    d = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return own.withColumns({"d": d, "blank": ~F.col("text").rlike(rf"[^\x20\x09-\x0D]"), "cut": ~F.col("text").rlike(rf"[.!?]{SPACES}*+\z")})


def on(a: str, b: str, *names: str):
    out = F.lit(True)
    for c in names:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def with_some(df: DataFrame, some: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """df with columns of some, null where it has no such keys. Broadcast up to BROADCAST_KEYS rows."""
    n = some.count()
    if not n:
        return df.withColumns({c: F.lit(None).cast(some.schema[c].dataType) for c in columns})
    return df.alias("x").join((F.broadcast(some) if n <= BROADCAST_KEYS else some).alias("y"), on("x", "y", *keys), "left").select("x.*", *[f"y.{c}" for c in columns])


class Ordered:
    """What both passes need: rows, and the order of different rows of one turn."""

    def __init__(self, df: DataFrame):
        self.rows = rows_of(df)
        self.facts = stored(self.rows.drop("text"), "facts")
        ties = stored(self.facts.groupBy("conv_id", "turn").agg(F.min("d").alias("a"), F.max("d").alias("b")).where("a <> b").select("conv_id", "turn"), "ties")
        self.ties = None
        if n := ties.count():
            some = self.rows.alias("x").join((F.broadcast(ties) if n <= BROADCAST_KEYS else ties).alias("y"), on("x", "y", "conv_id", "turn"), "left_semi")
            nth = F.dense_rank().over(W.partitionBy("conv_id", "turn").orderBy("role", "text")).alias("nth")
            self.ties = stored(some.select("conv_id", "turn", "d", nth).distinct(), "ties")

    def __call__(self, rows: DataFrame) -> DataFrame:
        if self.ties is None:
            return rows.withColumn("nth", F.lit(0))
        return with_some(rows, self.ties, ["conv_id", "turn", "d"], "nth")


SEGMENTS = "seg long, symbols binary, first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long"


def segments_of(order: Ordered) -> DataFrame:
    facts, kind = order.facts, order.facts.schema["conv_id"].dataType.simpleString()
    again = facts.where("not blank").groupBy("conv_id", "d").agg(F.min(F.struct("turn")).alias("t"), F.count("*").alias("n")).where("n > 1")
    again = stored(again.select("conv_id", "d", F.col("t.turn").alias("first"), F.lit(True).alias("again")), "again")
    rows = order(with_some(facts, again, ["conv_id", "d"], "first", "again"))
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    initial = F.when((F.length("role") > 0) & (initial > 0), initial - 1).otherwise(3)
    rows = rows.select("conv_id", "turn", "nth", "d", initial.cast("int").alias("initial"), "blank", "cut", F.coalesce("again", F.lit(False)).alias("again"), "first")
    names = ["conv_id", *[c.split()[0] for c in SEGMENTS.split(", ")]]

    def read(batches):
        number, place, conv, sums, symbols, before = TaskContext.get().partitionId(), 0, None, None, bytearray(), None

        def row():
            return conv, (number << 32) + place, bytes(symbols), *sums

        out, schema = [], None
        for batch in batches:
            schema = batch.schema.field("conv_id").type
            for c, turn, d, initial, blank, cut, again, first in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "turn", "d", "initial", "blank", "cut", "again", "first"))):
                if sums is None or c != conv or len(symbols) == SEGMENT:
                    if sums is not None:
                        out.append(row())
                        place += 1
                    before = None if sums is None or c != conv else before
                    conv, symbols, sums = c, bytearray(), [None, None, 0, 0, 0, 0]
                if turn is not None:
                    sums[0] = turn if sums[0] is None else sums[0]
                    sums[1] = turn
                    sums[2] += before is None or before[0] != turn
                duplicate = not blank and again and (turn != first or before == (turn, d))
                cut = cut and not blank and not duplicate
                sums[3] += blank
                sums[4] += duplicate
                sums[5] += cut
                symbols.append(3 * initial + (GOES if blank or duplicate else CUT if cut else STAYS))
                before = (turn, d)
            if len(out) > 5000:
                yield table_of(out, names, schema)
                out = []
        if sums is not None:
            out.append(row())
        if out:
            yield table_of(out, names, schema)

    def table_of(rows, names, kind):
        kinds = [kind, pa.int64(), pa.binary(), *[pa.int64()] * 6]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

    dealt = rows.repartitionByRange(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn")).sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "nth", "d")
    return dealt.mapInArrow(lean(read), f"conv_id {kind}, {SEGMENTS}")


def plans_of(segments: DataFrame, grammar: Grammar) -> DataFrame:
    """A row for each conversation: its cheapest edits and what was wrong."""
    kind = segments.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def read(batches):
        out, kinds, conv, now = [], None, None, None

        def row():
            product_, first, last, turns, *faults, illegal, _ = now
            whole = product(product_.result(), inserts())[0]
            cost, rope = better(whole[0], whole[3])
            return conv, last - first + 1 - turns if first is not None else 0, *faults, illegal, cost, flat(rope)

        for batch in batches:
            kinds = [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string()]
            for c, symbols, first, last, turns, *faults in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "symbols", "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated"))):
                if now is None or c != conv:
                    if now is not None:
                        out.append(row())
                    conv, now = c, [Balanced(), None, None, 0, 0, 0, 0, 0, None]
                now[0].push(grammar.of(symbols))
                if first is not None:
                    now[1], now[2] = first if now[1] is None else now[1], last
                now[3] += turns
                now[4:7] = [x + y for x, y in zip(now[4:7], faults)]
                own = np.frombuffer(symbols, np.uint8) // 3
                both = own if now[8] is None else np.concatenate([[now[8]], own])
                step = both[:-1] * 4 + both[1:]
                now[7] += len(step) - int(np.isin(step, [1, 6, 9]).sum())  # su, ua, au
                now[8] = own[-1]
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)
                out = []
        if now is not None:
            out.append(row())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)

    dealt = segments.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    return dealt.mapInArrow(lean(read), f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def applied(order: Ordered, plans: DataFrame) -> DataFrame:
    """The repaired rows in the order of their conversations: conv_id, pos, turn, role, text, edit."""
    kind = plans.schema["conv_id"].dataType.simpleString()
    rows = order(order.rows).select("conv_id", F.lit(1).alias("tag"), "turn", "nth", "d", "role", "text")
    first = plans.select("conv_id", F.lit(0).alias("tag"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("int").alias("nth"), F.lit(None).cast("binary").alias("d"), F.lit("").alias("role"), F.col("audit").alias("text"))
    names = ["conv_id", "pos", "turn", "role", "text", "edit"]

    def read(batches):
        conv, audit, at, pos, after = None, "", 0, 0, ""

        def inserted():
            nonlocal at, pos, after
            while at < len(audit) and audit[at] == "I":
                after = "assistant" if after == "user" else "user"
                yield conv, pos, None, after, "", "I"
                at, pos = at + 1, pos + 1

        def edited(c, tag, turn, role, text):
            nonlocal conv, audit, at, pos, after
            if not tag:
                yield from finished()
                conv, audit, at, pos, after = c, text, 0, 0, ""
                return
            yield from inserted()
            edit = audit[at] if at < len(audit) else ""
            at += 1
            if edit not in ("K", "R", "D"):
                raise RuntimeError("the table has changed between two reads")
            if edit == "D":
                return
            role = role if edit == "K" else "assistant" if after == "user" else "user"
            after = "user" if role[:1] == "u" else role
            yield c, pos, turn, role, text, edit
            pos += 1

        def finished():
            yield from inserted()
            if at != len(audit):
                raise RuntimeError("the table has changed between two reads")

        def table_of(rows, kind):
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), [kind, pa.int64(), pa.int64(), *[pa.string()] * 3])], names=names)

        kind = None
        for batch in batches:
            kind, out, size = batch.schema.field("conv_id").type, [], 0
            for row in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "tag", "turn", "role", "text"))):
                for made in edited(*row):
                    out.append(made)
                    size += len(made[4])
                if size > 4 << 20:
                    yield table_of(out, kind)
                    out, size = [], 0
            if out:
                yield table_of(out, kind)
        if out := list(finished()):
            yield table_of(out, kind)

    dealt = rows.unionByName(first).repartition("conv_id").sortWithinPartitions("conv_id", "tag", F.asc_nulls_first("turn"), "nth", "d")
    return dealt.select("conv_id", "tag", "turn", "role", "text").mapInArrow(lean(read), f"conv_id {kind}, pos long, turn long, role string, text string, edit string")


def repair(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired rows (conv_id, pos, turn, role, text, edit), and a row for each conversation (conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit). df: conv_id, turn, role, text."""
    order = Ordered(df)
    segments = stored(segments_of(order), "segments")
    grammar = learn(stored(segments.groupBy("symbols").agg(F.count("*").alias("n")), "sequences"))
    plans = stored(plans_of(segments, grammar), "plans")
    return applied(order, plans), plans


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of role:text, joined by newlines. The rows come in order, a conversation's in one task."""
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def read(batches):
        conv, own = None, None
        for batch in batches:
            out = []
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text"))):
                if own is None or c != conv:
                    if own is not None:
                        out.append((conv, own.hexdigest()))
                    conv, own = c, hashlib.sha256()
                else:
                    own.update(b"\n")
                own.update(f"{role}:{text}".encode())
            of = batch.schema.field("conv_id").type
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), [of, pa.string()])], names=["conv_id", "repaired_sha256"])
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], of), pa.array([own.hexdigest()])], names=["conv_id", "repaired_sha256"])

    return repaired.mapInArrow(lean(read), f"conv_id {kind}, repaired_sha256 string")


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults by crc32(conv_id:turn) % 20: row dropped, emptied, without .!?, repeated, role user."""
    own = df.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    own = own.withColumn("k", F.crc32(key) % 20).where("k <> 0")
    own = own.withColumns({"text": F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")), "role": F.when(F.col("k") == 4, "user").otherwise(F.col("role"))})
    return own.withColumn("copy", F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).select("conv_id", "turn", "role", "text")


def report(conversations: DataFrame) -> DataFrame:
    """What the repair of the damaged conversations finds, for each conv_id of the undamaged ones."""
    repaired, plans = repair(damaged(conversations))
    ids = conversations.select("conv_id")
    every = plans.unionByName(digests(repaired), allowMissingColumns=True).unionByName(ids, allowMissingColumns=True)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = every.groupBy("conv_id").agg(*[F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in numbers], F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.max("repaired_sha256").alias("sha"))
    return out.select("conv_id", *numbers, "audit", F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


_FAR = "{'c': 1000000000000, 'a': ''}"
_ADD = "{{'c': {0}.c + {1}, 'a': {0}.a || '{2}'}}"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


_E2 = _least("s2", *[_ADD.format(s, INSERT, "I") for s in ("s0", "s1", "s3")])
_E3 = _least("s3", _ADD.format("s2", INSERT, "I"), *[_ADD.format(s, 2 * INSERT, "II") for s in ("s0", "s1")])
ORACLE = f"""WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce([4294967295] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: unicode(c)::BIGINT), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS k FROM conversations, crc),
hurt AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text FROM (SELECT *, unnest(range(CASE k WHEN 3 THEN 2 ELSE 1 END)) FROM keyed WHERE k <> 0)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM hurt),
fault AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd' WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 't' ELSE '' END AS f,
 CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS i, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM placed),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated, count(*) FILTER (pos > 1 AND before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM fault GROUP BY conv_id),
dp AS (SELECT conv_id, 0::BIGINT AS pos, n, {{'c': 0::BIGINT, 'a': ''}} AS s0, {_FAR} AS s1, {_FAR} AS s2, {_FAR} AS s3 FROM sums
 UNION ALL SELECT conv_id, pos, n, {_ADD.format("s0", DELETE, "D")}, {_least(_ADD.format("s1", DELETE, "D"), f"CASE WHEN i = 's' AND f NOT IN ('b', 'd') THEN {_ADD.format('s0', 'm', 'K')} ELSE {_FAR} END")},
 {_least(_ADD.format("s2", DELETE, "D"), f"CASE WHEN f IN ('b', 'd') THEN {_FAR} WHEN i = 'u' THEN {_ADD.format('u', 'm', 'K')} ELSE {_ADD.format('u', f'm + {REROLE}', 'R')} END")},
 {_least(_ADD.format("s3", DELETE, "D"), f"CASE WHEN f IN ('b', 'd') THEN {_FAR} WHEN i = 'a' THEN {_ADD.format('s2', 'm', 'K')} ELSE {_ADD.format('s2', f'm + {REROLE}', 'R')} END")}
 FROM (SELECT e.*, {_least("s0", "s1", "s3")} AS u, CASE f WHEN 't' THEN {TRUNCATED} ELSE 0 END AS m, f, i FROM (SELECT conv_id, pos + 1 AS pos, n, s0, s1, {_E2} AS s2, {_E3} AS s3 FROM dp WHERE pos < n) e JOIN fault ON e.conv_id IS NOT DISTINCT FROM fault.conv_id AND e.pos = fault.pos)),
plan AS (SELECT conv_id, {_least("s0", _E3)} AS best FROM dp WHERE pos = n),
letter AS (SELECT conv_id, place, e, count(*) FILTER (e <> 'I') OVER w AS pos, count(*) FILTER (e <> 'D') OVER w AS o FROM (SELECT conv_id, unnest(string_split(best.a, '')) AS e, generate_subscripts(string_split(best.a, ''), 1) AS place FROM plan WHERE best.a <> '') WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)),
made AS (SELECT l.conv_id, place, e, o, CASE e WHEN 'K' THEN role END AS kept, CASE WHEN e = 'I' THEN '' ELSE text END AS text, max(CASE WHEN e = 'K' AND i = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS s FROM letter l JOIN fault f ON l.conv_id IS NOT DISTINCT FROM f.conv_id AND f.pos = greatest(l.pos, 1) WHERE e <> 'D'),
lines AS (SELECT conv_id, sha256(string_agg(coalesce(kept, CASE WHEN (o - s) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY place)) AS sha FROM made GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums ON c.conv_id IS NOT DISTINCT FROM sums.conv_id LEFT JOIN plan ON c.conv_id IS NOT DISTINCT FROM plan.conv_id LEFT JOIN lines ON c.conv_id IS NOT DISTINCT FROM lines.conv_id"""
