"""Duplicate resolution by shared keys, city resolution, and anti joins against what is known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgmill.functions import expressions as X
from orgmill.functions import fixed
from orgmill.operators.matching import resolve_by_table
from orgmill.shared import stored


def connected(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """id, root (the smallest id reachable) for every id of links (a, b).

    Each round takes the smallest root among neighbours and then that root's own root, so paths halve. Minima are
    aggregated before the shuffle; no neighbourhood is gathered in one place.
    """
    edges = links.where("a <> b").select("a", "b")
    edges = stored(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    roots = stored(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("root")), "roots")
    for _ in range(max_rounds):
        near = edges.join(roots.select(F.col("id").alias("b"), "root"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        new = roots.join(near, "id").select("id", F.least("root", "near").alias("mid"), F.col("root").alias("old"))
        jump = roots.select(F.col("id").alias("mid"), F.col("root").alias("far"))
        new = stored(new.join(jump, "mid", "left").select("id", "old", F.least("mid", F.coalesce("far", "mid")).alias("root")), "roots")
        if not new.where("old <> root").limit(1).count():
            return new.select("id", "root")
        roots = new.select("id", "root")
    raise RuntimeError("components did not settle")


def duplicate_links(df: DataFrame, id_col: str, keys: dict[str, str]) -> DataFrame:
    """(a, b): each row and the smallest row with which it shares a key; keys: reason -> column. Nulls and blanks never match."""
    pairs = [F.struct(F.lit(reason).alias("reason"), F.col(column).cast("string").alias("key")) for reason, column in keys.items()]
    each = df.select(F.col(id_col).alias("a"), F.explode(F.array(*pairs)).alias("k")).select("a", "k.*").where("key is not null and key <> ''")
    least = each.groupBy("reason", "key").agg(F.min("a").alias("b"))
    return each.join(least, ["reason", "key"]).select("a", "b", "reason").distinct()


def resolve_duplicates(df: DataFrame, id_col: str, keys: dict[str, str]) -> DataFrame:
    """id, kept_id, reason: the row with the smallest id of each group that shared keys connect, and which keys tie the row
    to others (null for a row alone)."""
    links = stored(duplicate_links(df, id_col, keys).where("a <> b"), "links")
    ties = links.select(F.col("a").alias("id"), "reason").union(links.select("b", "reason")).groupBy("id").agg(F.array_join(F.sort_array(F.collect_set("reason")), ", ").alias("reason"))
    known = connected(links).join(ties, "id")
    return df.select(F.col(id_col).alias("id")).join(known, "id", "left").select("id", F.coalesce("root", "id").alias("kept_id"), "reason")


def duplicate_groups(resolved: DataFrame) -> DataFrame:
    """kept_id, merged_ids, reason (the keys that join the group) of groups with more than one row."""
    merged = F.sort_array(F.collect_list(F.when(F.col("id") != F.col("kept_id"), F.col("id"))))
    why = F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.split("reason", ", "))))), ", ")
    return resolved.groupBy("kept_id").agg(merged.alias("merged_ids"), why.alias("reason")).where(F.size("merged_ids") > 0)


#: Keys that may be split, and known everywhere (about 40 bytes each): as many as rows divided by the size of a part.
BROADCAST_PARTS = 100_000


def ambiguous_pairs(df: DataFrame, id_col: str, name: str, threshold: float = 0.2, hot: int = 5000) -> DataFrame:
    """a, b, distance: every two different names whose edit distance is at most threshold times the longer one's length, each
    name by its smallest id; for review.

    Exact. One edit changes two pairs of neighbouring letters at most, so two such names share a pair among the rarest
    2 k + 1 of either (k: the edits that the longest possible partner allows). Names join by those and by each length that
    a partner may have; a pair of letters that more than hot names of one length have is split, so no task meets all of it.
    """
    if not 0 < threshold <= 0.25:
        raise ValueError("beyond 0.25 names need not share a pair of letters")
    names = df.where(F.length(name) > 0).groupBy(F.col(name).alias("name")).agg(F.min(id_col).alias("id")).withColumn("size", F.length("name"))
    places = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda i: F.struct(F.substr("name", i, F.lit(2)).alias("gram"), i.alias("at")))
    each = names.where("size > 1").select("id", "name", "size", F.inline(places))
    nth = F.row_number().over(W.partitionBy("id", "gram").orderBy("at"))  # a pair of letters counts as often as it occurs
    each = stored(each.select("id", "name", "size", "gram", nth.alias("nth")), "grams")
    counts = each.groupBy("gram", "nth").agg(F.count("*").alias("n"))
    ranked = each.join(counts, ["gram", "nth"]).withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy("n", "gram", "nth")))
    edits = F.floor(threshold * F.floor(F.col("size") / (1 - threshold) + 1e-9) + 1e-9)
    rare = stored(ranked.where(F.col("rank") <= 2 * edits + 1).select("id", "name", "size", "gram", "nth"), "rare")
    # lengths are part of the key, and a frequent key's rows are dealt to parts on one side, which the other side meets all of
    parts = rare.groupBy("gram", "nth", "size").agg(F.ceil(F.count("*") / hot).cast("int").alias("parts"))
    parts = F.broadcast(parts.where("parts > 1")) if rare.count() <= hot * BROADCAST_PARTS else parts.where("parts > 1")
    parts = parts.withColumnsRenamed({"size": "near"})
    y = rare.select("id", "name", F.col("size").alias("near"), "gram", "nth").join(parts, ["gram", "nth", "near"], "left").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))))
    least, most_ = F.ceil(F.col("size") * (1 - threshold) - 1e-9).cast("int"), F.floor(F.col("size") / (1 - threshold) + 1e-9).cast("int")
    x = rare.withColumn("near", F.explode(F.sequence(least, most_))).join(parts, ["gram", "nth", "near"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    keys = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("gram", "nth", "near", "part")]
    near = keys[0] & keys[1] & keys[2] & keys[3] & (F.col("x.id") < F.col("y.id"))
    pairs = x.alias("x").join(y.alias("y"), near).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.name").alias("p"), F.col("y.name").alias("q")).distinct()
    distance = F.levenshtein("p", "q") / F.greatest(F.length("p"), F.length("q"))
    return pairs.select("a", "b", F.round(distance, 6).alias("distance")).where(F.col("distance") <= threshold)


def city_dimension(spark) -> DataFrame:
    """alias_pos, alias, cityId, regionId, city: a few dozen rows."""
    rows, pos = [], 0
    for city_id, region_id, name, aliases in fixed.CITIES:
        for alias in dict.fromkeys([*aliases, name.lower()]):
            rows.append((pos, alias, city_id, region_id, name))
            pos += 1
    return spark.createDataFrame(rows, "alias_pos int, alias string, cityId string, regionId string, city string")


def resolve_city(df: DataFrame, col: str, dim: DataFrame, first_alias: bool = False) -> DataFrame:
    """city, cityId and regionId of each row: an alias equal to the text, else the longest (or first) alias that it contains."""
    return resolve_by_table(df, col, dim, ["city", "cityId", "regionId"], first_alias)


def in_city_scope(df: DataFrame, col: str, dim: DataFrame, cities: list[str] | None) -> DataFrame:
    """Rows whose city is one of cities; a place that no city is known for stays only where all are wanted (None)."""
    return df if cities is None else resolve_city(df, col, dim).where(F.col("city").isin(*cities))


def attach_evidence(candidates: DataFrame, evidence: DataFrame, key: str) -> DataFrame:
    """Candidates with each of their evidence rows; one without evidence stays, with nulls."""
    return candidates.join(evidence, key, "left")


def approved_records(states: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """The records of entities that are approved."""
    return records.join(states.where("state = 'APPROVED'").select(key).distinct(), key, "left_semi")


def unknown_ids(df: DataFrame, col: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose id is set and not in the dimension."""
    return df.where(F.col(col).isNotNull()).join(dim.select(F.col(key).alias(col)).distinct(), col, "left_anti")


def new_only(df: DataFrame, known: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys known does not hold: seen candidates, finished entities, fetched addresses."""
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")


def fill_from_candidate(df: DataFrame, candidates: DataFrame, key: str, columns: list[str], defaults: dict[str, str] | None = None) -> DataFrame:
    """Missing or blank values from the candidate row, then from the defaults."""
    given = candidates.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = df.join(given, key, "left")
    own = lambda c: F.nullif(F.trim(c), F.lit("")) if dict(df.dtypes)[c] == "string" else F.col(c)
    filled = {c: F.coalesce(own(c), F.col(f"__{c}"), *([F.lit(defaults[c])] if defaults and c in defaults else [])) for c in columns}
    return joined.withColumns(filled).drop(*[f"__{c}" for c in columns])


def search_plan(scopes: DataFrame, cities: list[str] | None = None) -> DataFrame:
    """The rows of scopes (types, categories, regions; null: all) with a category, type and city for each search.

    Both lists named: each category with each type; one: its entries; none: every category. Then each city of the regions,
    or all cities if none of them is one. The lists are small dimensions, so a row expands by itself: no join.
    """
    known = X.texts(cities or [c[2] for c in fixed.CITIES])
    kind = "array<struct<category:string,type:string>>"
    null = F.lit(None).cast("string")
    pair = lambda c, t: F.struct(c.alias("category"), t.alias("type"))
    every = F.transform(X.texts(fixed.CATEGORIES), lambda c: pair(c, null))
    both = F.flatten(F.transform("categories", lambda c: F.transform("types", lambda t: pair(c, t))))
    facets = (
        F.when(F.col("categories").isNotNull() & F.col("types").isNotNull(), both.cast(kind))
        .when(F.col("categories").isNotNull(), F.transform("categories", lambda c: pair(c, null)).cast(kind))
        .when(F.col("types").isNotNull(), F.transform("types", lambda t: pair(null, t)).cast(kind))
        .otherwise(every.cast(kind))
    )
    wanted = F.filter(known, lambda c: F.array_contains(F.coalesce("regions", known), c))
    each = scopes.withColumn("__facet", F.explode(facets)).withColumn("city", F.explode(F.when(F.size(wanted) > 0, wanted).otherwise(known)))
    return each.select(*scopes.columns, "__facet.category", "__facet.type", "city")


def load_dims(spark) -> dict[str, DataFrame]:
    """Thresholds, weights, the default order of categories, cities with their aliases, and the enums, as small tables."""
    enums = {"type": fixed.TYPES, "status": fixed.STATUSES, "deliveryMode": fixed.DELIVERY_MODES, "category": fixed.CATEGORIES, "language": fixed.KNOWN_LANGUAGES, "state": fixed.STATES}
    return {
        "thresholds": spark.createDataFrame([*fixed.BANDS.items(), ("REJECTED", 0)], "band string, least int"),
        "weights": spark.createDataFrame(list(fixed.WEIGHTS.items()), "score string, weight double"),
        "priorities": spark.createDataFrame(list(enumerate(fixed.DEFAULT_CATEGORIES)), "pos int, category string"),
        "cities": city_dimension(spark),
        "enums": spark.createDataFrame([(k, i, v) for k, vs in enums.items() for i, v in enumerate(vs)], "kind string, pos int, value string"),
    }


def bucket_lookup(queries: DataFrame, rows: DataFrame, key: str, default: str, count: str) -> DataFrame:
    """The first rows of the query's bucket, or of the default bucket where it has none."""
    buckets = rows.select(key).distinct().withColumn("__bucket", F.col(key))
    named = queries.join(buckets, key, "left").withColumn("__bucket", F.coalesce("__bucket", F.lit(default)))
    held = rows.withColumnRenamed(key, "__bucket")
    return named.join(held, "__bucket").where(F.col("pos") <= F.col(count)).withColumnRenamed("__bucket", "bucket")
