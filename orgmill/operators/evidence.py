"""Evidence: append-only inserts, corroboration, merging and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgmill.functions import expressions as X
from orgmill.functions import fixed


def append_evidence(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = ("entity_id", "source_url"), order: str = "seq") -> DataFrame:
    """old and the first new row of each key that old does not have; nothing is overwritten."""
    first = first_by(new, list(keys), order)
    return old.unionByName(first.join(old.select(*keys).distinct(), list(keys), "left_anti"))


def first_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key in the given order."""
    rest = [c for c in df.columns if c not in keys]
    least = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order and not dict(df.dtypes)[c].startswith("map")])).alias("__row"))
    return least.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def comparable(field: str, c: Column) -> Column:
    s = F.lower(F.trim(c))
    if field == "phone":
        s = F.right(F.regexp_replace(s, "[^0-9]", ""), F.lit(9))
    elif field == "website":
        s = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "^https?://", ""), r"^www\.", ""), "/+$", "")
    else:
        s = F.regexp_replace(s, r"\s+", " ")
    return F.nullif(s, F.lit(""))


def corroborated(df: DataFrame, entity: str, item: str, fields: tuple[str, ...] = ("phone", "website", "address")) -> DataFrame:
    """entity, item, corroborated: of how many fields another item of the entity states the same value.

    Values are counted by entity, field and value, so no entity's items are paired.
    """
    stack = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), comparable(f, F.col(f)).alias("value")) for f in fields]))
    each = df.select(entity, item, stack.alias("x")).select(entity, item, "x.*").where("value is not null").distinct()
    counts = each.groupBy(entity, "field", "value").agg((F.count("*") > 1).alias("again"))
    found = each.join(counts, [entity, "field", "value"]).groupBy(entity, item).agg(F.count_if("again").alias("corroborated"))
    return df.select(entity, item).join(found, [entity, item], "left").withColumn("corroborated", F.coalesce("corroborated", F.lit(0)))


def merge_scalars(df: DataFrame, entity: str, fields: list[str], confidence: str = "confidence", seq: str = "seq") -> DataFrame:
    """Per entity, each field's value of the most confident (then latest) item that has one; item count and best confidence."""
    rank = lambda f: F.when(F.col(f).isNotNull(), F.struct(confidence, seq))
    return df.groupBy(entity).agg(*[F.max_by(f, rank(f)).alias(f) for f in fields], F.count("*").alias("evidence_count"), F.max(confidence).alias("best_confidence"))


def merge_lists(df: DataFrame, entity: str, field: str, confidence: str = "confidence", seq: str = "seq") -> DataFrame:
    """Per entity, the items of its lists in ascending confidence; spellings that differ in case only count once, the first stays."""
    each = df.select(entity, confidence, seq, F.posexplode(field).alias("place", "item")).where(F.trim("item") != "")
    first = each.groupBy(entity, F.lower(F.trim("item")).alias("key")).agg(F.min(F.struct(confidence, seq, "place", "item")).alias("x"))
    return first.groupBy(entity).agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["item"]).alias(field))


def with_item_confidence(df: DataFrame, kind: str = "source_kind", corroborated: str = "corroborated") -> DataFrame:
    kinds = dict(df.dtypes)
    rich = sum((X.has_value(F.col(c), kinds[c]).cast("int") for c in fixed.SUBSTANTIVE_FIELDS if c in kinds), F.lit(0))
    base = F.lit(fixed.SOURCE_BASE["other"])
    for k, v in fixed.SOURCE_BASE.items():
        base = F.when(F.col(kind) == k, v).otherwise(base)
    raw = base + F.least(rich, F.lit(6)) / 6 * 0.18 + F.least(F.col(corroborated) * 0.05, F.lit(0.10))
    return df.withColumn("confidence", F.least(F.lit(0.95), F.greatest(F.lit(0.30), F.round(raw, 4))))


def with_completeness(df: DataFrame) -> DataFrame:
    kinds = dict(df.dtypes)
    share = lambda names: sum((X.has_value(F.col(c), kinds[c]).cast("int") for c in names if c in kinds), F.lit(0)) / len(names)
    return df.withColumn("completeness", F.round(share(fixed.REQUIRED_FIELDS) * 80 + share(fixed.BONUS_FIELDS) * 20).cast("int"))


def with_source_confidence(df: DataFrame) -> DataFrame:
    return df.withColumn("source_confidence", F.round(F.round((F.col("best_confidence") * 0.7 + F.least(F.col("evidence_count"), F.lit(3)) / 3 * 0.3) * 100, 6)).cast("int"))


def with_quality(df: DataFrame) -> DataFrame:
    quality = F.round(0.5 * F.col("source_confidence") + 0.5 * F.col("completeness")).cast("int")
    band = F.lit("REJECTED")
    for name, least in reversed(fixed.BANDS.items()):
        band = F.when(F.col("quality") >= least, name).otherwise(band)
    return df.withColumn("quality", quality).withColumn("band", band)


def top_by(df: DataFrame, score: str, tie: str, n: int) -> DataFrame:
    return df.orderBy(F.coalesce(score, F.lit(0)).desc(), tie).limit(n)


def n_per_group(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("rank") <= n)
