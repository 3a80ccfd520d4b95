r"""Benchmark decontamination by template windows.

Texts become templates: punctuation goes, letters are lower-cased, and numbers, units after numbers and capitalised words (of
any script, also where a sentence begins) become the typed placeholders #, $unit and @. Windows of WINDOW template words of all
items are joined by hash with those of all documents, so a question with other numbers or names still matches. Windows with
LITERALS other words or more are searched everywhere; where SHARE of those of an item are found, all its windows are looked
for. Where a pair's windows have placeholders, its slots must be consistent: one value of the item always stands against one
value of the document. They are judged twice: over all matches of the windows that are searched (if they are not consistent,
only windows without placeholders count), and for each occurrence alone, with all windows: the matches in line with one place
of the document, exactly or within SHIFT words (the nearest one of each item window). The larger number counts.

A document holds an item if at least SHARE of all its windows are found. Everything is DataFrame operations; only the item
windows are broadcast, behind a check of their number; beyond it the windows are joined by a shuffle.

An item without a window to search (numbers and names mostly, or fewer than WINDOW words) is searched as written: by windows of
WINDOW words, or the whole item if it has fewer, whose slots must be equal; an item of one word only as a whole line. A
null text has no windows; a null item is no item; documents with a null id are told apart by their texts; repeated rows give one
result; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmill.llm.common import BROADCAST_KEYS, settled, stored, without_rows

WINDOW, LITERALS, SHARE = 5, 3, 0.5
#: Words by which windows of one occurrence may be out of line.
SHIFT = 3
#: Item windows that may be broadcast (about 100 bytes each).
BROADCAST_ROWS = 1_000_000
NUMBER, UNIT, NAME = "#", "$unit", "@"
#: Units of measure, money and time.
UNITS = "km m cm mm mi mile miles ft feet inch inches kg g mg lb lbs pounds l ml liters litres s sec seconds min minutes h hours days weeks months years percent dollars usd euros eur cents mph kmh".split()
ENDS = ".!?%"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(text, r"[^\p{L}\p{N}.!?%]+", " "), " "), lambda x: F.trim(x, F.lit(ENDS)) != "")


def digit(x: Column) -> Column:
    return (x >= "0") & (x < ":")


def canonical(x: Column, before: Column) -> Column:
    core = F.trim(x, F.lit(ENDS))
    first = F.left(core, F.lit(1))
    return (
        F.when(digit(core), NUMBER)
        .when((F.lower(first) != first) & (core != F.upper(core)), NAME)
        .when(digit(before) & F.lower(core).isin(UNITS), UNIT)
        .otherwise(F.lower(core))
    )


def with_templates(df: DataFrame) -> DataFrame:
    """w (words as written) and c (their template) for a column text."""
    before = F.concat(F.array(F.lit(".")), F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))))
    return df.withColumn("w", words_of(F.col("text"))).withColumn("c", F.when(F.size("w") > 0, F.zip_with("w", before, canonical)).otherwise(F.array().cast("array<string>")))


def windows(c: Column) -> Column:
    """The hash of each window of template words, in order."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(c) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(c, i, WINDOW)))
    return F.when(F.size(c) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, h, at, slots (whether it has placeholders), searched, c, values, n (windows of the item), n_searched."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null").dropDuplicates()
    all_windows = with_templates(items).select("item_id", "w", "c", F.posexplode(windows(F.col("c"))).alias("at", "h"))
    own = all_windows.select("item_id", "h", "at", F.slice("c", F.col("at") + 1, WINDOW).alias("c"), F.transform(F.slice("w", F.col("at") + 1, WINDOW), lambda x: F.lower(F.trim(x, F.lit(ENDS)))).alias("values"))
    placed = F.size(F.filter("c", lambda x: x.isin(NUMBER, UNIT, NAME)))
    own = own.withColumns({"slots": placed > 0, "searched": WINDOW - placed >= LITERALS})
    counts = own.groupBy("item_id").agg(F.count_distinct("at").alias("n"), F.count_distinct(F.when(F.col("searched"), F.col("at"))).alias("n_searched")).where("n_searched > 0")
    return own.join(counts, "item_id")


def literal_windows(benchmark: DataFrame, searched: DataFrame) -> DataFrame:
    """item_id, k (words in a window), h, at, n for items without a window searched by template."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null").dropDuplicates()
    rest = items.join(searched.select("item_id").distinct(), "item_id", "left_anti").select("item_id", as_written(words_of(F.col("text"))).alias("v")).where("size(v) > 0")
    rest = rest.withColumn("k", F.least(F.lit(WINDOW), F.size("v")))
    own = rest.select("item_id", "k", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("v") - F.col("k") + 1), lambda i: F.xxhash64(F.slice("v", i, F.col("k"))))).alias("at", "h"))
    return own.join(own.groupBy("item_id").agg(F.count_distinct("at").alias("n")), "item_id")


def as_written(w: Column) -> Column:
    return F.transform(w, lambda x: F.lower(F.trim(x, F.lit(ENDS))))


def literal_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The result of find_leaks for the items of literal_windows."""
    sizes = items.groupBy("k").agg(F.count("*").alias("n")).collect()
    own = docs.select("doc_id", "key", "text", as_written(words_of(F.col("text"))).alias("v"))
    alone = F.filter(F.transform(F.split("text", "\n"), lambda line: as_written(words_of(line))), lambda v: F.size(v) == 1)
    out = None
    for k, n in sorted(map(tuple, sizes)):
        each = own.select("doc_id", "key", F.explode(F.array_distinct(F.transform(alone, lambda v: F.xxhash64(v)))).alias("h")) if k == 1 else own.where(F.size("v") >= k).select("doc_id", "key", F.explode(F.transform(F.sequence(F.lit(1), F.size("v") - (k - 1)), lambda i: F.xxhash64(F.slice("v", i, k)))).alias("h"))  # noqa: B023
        small = items.where(F.col("k") == k).drop("k")
        matches = each.join(F.broadcast(small) if n <= BROADCAST_ROWS else small, "h")
        found = matches.groupBy("doc_id", "key", "item_id", "n").agg(F.count_distinct("at").alias("found")).where(F.col("found") >= SHARE * F.col("n"))
        found = found.select("doc_id", "key", "item_id", F.col("found").alias("n_windows"), F.col("n").alias("n_item_windows"), F.lit(False).alias("reparameterised"))
        out = found if out is None else out.union(found)
    return out


def find_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (a hash of the text), item_id, n_windows (of the item found), n_item_windows, reparameterised."""
    items = stored(item_windows(benchmark), "items")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    found = template_leaks(docs, items)
    literal = stored(literal_windows(benchmark, items), "literal")
    return found.union(literal_leaks(docs, literal)) if literal.limit(1).count() else found


def template_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The result of find_leaks for the items of item_windows."""
    small = items.count() <= BROADCAST_ROWS
    held = lambda x: F.broadcast(x) if small else x
    searched = with_templates(docs).select("doc_id", "key", F.posexplode(windows(F.col("c"))).alias("place", "h"))
    matches = searched.join(held(items.where("searched").select("h", "item_id", "at", "slots", "n", "n_searched")), "h")
    pairs = matches.groupBy("doc_id", "key", "item_id", "n", "n_searched").agg(F.count_distinct("at").alias("found"), F.count_distinct(F.when(~F.col("slots"), F.col("at"))).alias("literal"))
    pairs = stored(pairs.where(F.col("found") >= SHARE * F.col("n_searched")).drop("n_searched").distinct(), "pairs")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["key"] == b["key"])
    wanted = pairs.select("doc_id", "key").distinct()
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted  # then texts stay where they are
    again = with_templates(docs.join(wanted, same(docs, wanted), "left_semi").distinct()).select("doc_id", "key", "w", "c")
    found = again.select("doc_id", "key", F.explode(F.arrays_zip(F.sequence(F.lit(0), F.size("c") - WINDOW).alias("place"), windows(F.col("c")).alias("h"), F.transform(F.sequence(F.lit(1), F.size("c") - (WINDOW - 1)), lambda i: F.slice("c", i, WINDOW)).alias("c"), F.transform(F.sequence(F.lit(1), F.size("c") - (WINDOW - 1)), lambda i: F.slice("w", i, WINDOW)).alias("w"))).alias("x")).select("doc_id", "key", "x.*")
    met = found.join(held(items.drop("c")), "h").alias("m").join(pairs.select("doc_id", "key", "item_id").alias("p"), paired("m", "p"), "left_semi")
    met = stored(met, "met")
    slot = met.where("slots and searched").select("doc_id", "key", "item_id", F.explode(F.arrays_zip("c", "w", "values")).alias("s")).where(F.col("s.c").isin(NUMBER, UNIT, NAME))
    slot = slot.select("doc_id", "key", "item_id", F.col("s.c").alias("kind"), F.col("s.values").alias("mine"), F.lower(F.trim("s.w", F.lit(ENDS))).alias("theirs")).distinct()
    p, q, r = pairs.alias("p"), consistency(slot, "doc_id", "key", "item_id").alias("q"), best_occurrences(met).alias("r")
    joined = p.join(q, paired("p", "q"), "left").join(r, paired("p", "r"), "left")
    consistent = F.coalesce(F.col("q.consistent"), F.lit(True))
    n = F.when(consistent, F.col("p.found")).otherwise(F.col("p.literal"))
    better = F.coalesce(F.col("r.best.found") >= n, F.lit(False))
    other = F.when(better, ~F.col("r.best.same")).otherwise(consistent & F.coalesce(F.col("q.other"), F.lit(False)))
    out = joined.select("p.doc_id", "p.key", "p.item_id", F.when(better, F.col("r.best.found")).otherwise(n).alias("n_windows"), F.col("p.n").alias("n_item_windows"), other.alias("reparameterised"))
    return out.where(F.col("n_windows") >= SHARE * F.col("n_item_windows"))


def paired(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.key") == F.col(f"{b}.key")) & (F.col(f"{a}.item_id") == F.col(f"{b}.item_id"))


def consistency(slot: DataFrame, *keys: str) -> DataFrame:
    """keys, consistent, other (some value differs) of distinct slots (kind, mine, theirs)."""
    per_value = slot.groupBy(*keys, "kind", "mine").agg(F.count("*").alias("values"), F.max(F.col("mine") != F.col("theirs")).alias("other"))
    return per_value.groupBy(*keys).agg((F.max("values") == 1).alias("consistent"), F.max("other").alias("other"))


def best_occurrences(here: DataFrame) -> DataFrame:
    """doc_id, key, item_id, best (found, same) over the consistent occurrences of each pair's matches."""
    keys = ["doc_id", "key", "item_id", "start", "within"]
    lines = F.array(F.struct(F.lit(0).alias("by"), F.lit(0).alias("within")), *[F.struct(F.lit(x).alias("by"), F.lit(SHIFT).alias("within")) for x in range(-SHIFT, SHIFT + 1)])
    each = here.withColumn("line", F.explode(lines)).withColumns({"start": F.col("place") - F.col("at") + F.col("line.by"), "within": F.col("line.within")})
    one = each.groupBy(*keys, "at").agg(F.min_by(F.struct("slots", "c", "w", "values", "n"), F.struct(F.abs("line.by"), "place")).alias("m"))
    enough = one.groupBy(*keys).agg(F.count("*").alias("found"), F.max("m.n").alias("n")).where(F.col("found") >= SHARE * F.col("n")).drop("n")
    slot = one.where("m.slots").select(*keys, F.explode(F.arrays_zip("m.c", "m.w", "m.values")).alias("s")).where(F.col("s.c").isin(NUMBER, UNIT, NAME))
    slot = slot.select(*keys, F.col("s.c").alias("kind"), F.col("s.values").alias("mine"), F.lower(F.trim("s.w", F.lit(ENDS))).alias("theirs")).distinct()
    x, y = enough.alias("x"), consistency(slot, *keys).alias("y")
    on = F.col("x.doc_id").eqNullSafe(F.col("y.doc_id"))
    for k in keys[1:]:
        on = on & (F.col(f"x.{k}") == F.col(f"y.{k}"))
    good = x.join(y, on, "left").where(F.coalesce(F.col("y.consistent"), F.lit(True)))
    return good.groupBy("x.doc_id", "x.key", "x.item_id").agg(F.max(F.struct(F.col("x.found").alias("found"), (~F.coalesce(F.col("y.other"), F.lit(False))).alias("same"))).alias("best"))


def remove_leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without the documents that hold a benchmark item."""
    leaks = settled(df.sparkSession, "leaks", lambda: find_leaks(df, benchmark, id_col, text_col).select(F.col("doc_id").alias("id"), "key"))
    return without_rows(df, leaks, id_col, text_col)


_UNITS = ", ".join(f"'{u}'" for u in UNITS)
_PLACED = f"('{NUMBER}', '{UNIT}', '{NAME}')"
ORACLE = rf"""
WITH t AS (SELECT DISTINCT * FROM (SELECT 'd' AS kind, doc_id AS id, coalesce(text, '') AS text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL)),
w AS (SELECT kind, id, text, list_filter(string_split(regexp_replace(text, '[^\p{{L}}\p{{N}}.!?%]+', ' ', 'g'), ' '), lambda x: trim(x, '{ENDS}') <> '') AS w FROM t),
u AS (SELECT kind, id, unnest(w) AS x, unnest(range(len(w))) AS i FROM w),
b AS (SELECT kind, id, i, x, trim(x, '{ENDS}') AS core, coalesce(lag(x) OVER (PARTITION BY kind, id ORDER BY i), '.') AS before FROM u),
c AS (SELECT kind, id, i, lower(core) AS v, CASE WHEN core >= '0' AND core < ':' THEN '{NUMBER}' WHEN lower(core[1]) <> core[1] AND core <> upper(core) THEN '{NAME}'
    WHEN before >= '0' AND before < ':' AND lower(core) IN ({_UNITS}) THEN '{UNIT}' ELSE lower(core) END AS c FROM b),
g AS (SELECT kind, id, i, list(c) OVER z AS c, list(v) OVER z AS v, count(*) OVER z AS k FROM c WINDOW z AS (PARTITION BY kind, id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
s AS (SELECT kind, id, i, c, v, len(list_filter(c, lambda x: x IN {_PLACED})) AS slots FROM g WHERE k = {WINDOW}),
items AS (SELECT *, count(*) OVER (PARTITION BY id) AS n, count(*) FILTER ({WINDOW} - slots >= {LITERALS}) OVER (PARTITION BY id) AS ns FROM s WHERE kind = 'i' QUALIFY ns > 0),
m AS (SELECT d.id AS doc_id, d.i AS place, items.id AS item_id, items.i AS pos, n, ns, items.slots AS slots, d.c AS c, d.v AS dv, items.v AS iv FROM s d JOIN items ON d.kind = 'd' AND d.c = items.c),
p AS (SELECT doc_id, item_id, n, count(DISTINCT pos) AS found, count(DISTINCT CASE WHEN slots = 0 THEN pos END) AS literal FROM m WHERE {WINDOW} - slots >= {LITERALS} GROUP BY doc_id, item_id, n, ns HAVING count(DISTINCT pos) >= {SHARE} * ns),
e AS (SELECT DISTINCT doc_id, item_id, kind, mine, theirs FROM (SELECT doc_id, item_id, unnest(c) AS kind, unnest(iv) AS mine, unnest(dv) AS theirs FROM m WHERE slots > 0 AND {WINDOW} - slots >= {LITERALS}) WHERE kind IN {_PLACED}),
f AS (SELECT doc_id, item_id, max(k) = 1 AS consistent, bool_or(other) AS other FROM (SELECT doc_id, item_id, kind, mine, count(*) AS k, bool_or(mine <> theirs) AS other FROM e GROUP BY ALL) GROUP BY ALL),
o AS (SELECT m.*, place - pos + shift AS start, wide FROM m SEMI JOIN p USING (doc_id, item_id), (SELECT 0 AS shift, 0 AS wide UNION ALL SELECT unnest(range(-{SHIFT}, {SHIFT} + 1)), {SHIFT}) QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, place - pos + shift, wide, pos ORDER BY abs(shift), place) = 1),
q AS (SELECT doc_id, item_id, start, wide, count(*) AS found FROM o GROUP BY ALL HAVING count(*) >= {SHARE} * any_value(n)),
h AS (SELECT doc_id, item_id, start, wide, max(k) = 1 AS consistent, bool_or(other) AS other FROM (SELECT doc_id, item_id, start, wide, kind, mine, count(DISTINCT theirs) AS k, bool_or(mine <> theirs) AS other FROM (SELECT doc_id, item_id, start, wide, unnest(c) AS kind, unnest(iv) AS mine, unnest(dv) AS theirs FROM o WHERE slots > 0) WHERE kind IN {_PLACED} GROUP BY ALL) GROUP BY ALL),
best AS (SELECT doc_id, item_id, max((found, NOT coalesce(other, false))) AS x FROM q LEFT JOIN h USING (doc_id, item_id, start, wide) WHERE coalesce(consistent, true) GROUP BY ALL),
r AS (SELECT doc_id, item_id, n, CASE WHEN coalesce(consistent, true) THEN found ELSE literal END AS nw, coalesce(consistent, true) AND coalesce(other, false) AS other, x FROM p LEFT JOIN f USING (doc_id, item_id) LEFT JOIN best USING (doc_id, item_id)),
lw AS (SELECT kind, id, text, list_transform(w, lambda x: lower(trim(x, '{ENDS}'))) AS v FROM w), li AS (SELECT id, v, least({WINDOW}, len(v)) AS k FROM lw WHERE kind = 'i' AND len(v) > 0 AND id NOT IN (SELECT id FROM items)),
ln AS (SELECT id, list_transform(list_filter(string_split(regexp_replace(unnest(string_split(text, chr(10))), '[^\p{{L}}\p{{N}}.!?%]+', ' ', 'g'), ' '), lambda x: trim(x, '{ENDS}') <> ''), lambda x: lower(trim(x, '{ENDS}'))) AS v FROM w WHERE kind = 'd'),
lx AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM (SELECT id, k, unnest(range(1, len(v) - k + 2)) AS i, v FROM li)), lk AS (SELECT id AS item_id, k, n, i, v[i:i + k - 1] AS x FROM lx),
ld AS (SELECT DISTINCT id AS doc_id, k, v[i:i + k - 1] AS x FROM (SELECT id, k, v, unnest(range(1, len(v) - k + 2)) AS i FROM lw, (SELECT DISTINCT k FROM li WHERE k > 1) WHERE kind = 'd' AND len(v) >= k) UNION SELECT id, 1, v FROM ln WHERE len(v) = 1)
SELECT doc_id, item_id, CASE WHEN coalesce(x[1] >= nw, false) THEN x[1] ELSE nw END AS n_windows, n AS n_item_windows, CASE WHEN coalesce(x[1] >= nw, false) THEN NOT x[2] ELSE other END AS reparameterised FROM r WHERE CASE WHEN coalesce(x[1] >= nw, false) THEN x[1] ELSE nw END >= {SHARE} * n
UNION ALL SELECT doc_id, item_id, count(DISTINCT i), n, false FROM ld JOIN lk USING (k, x) GROUP BY doc_id, item_id, n HAVING count(DISTINCT i) >= {SHARE} * n
"""
