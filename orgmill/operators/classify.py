"""Keyword classification, scopes, relevance and the content gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmill.functions import expressions as X
from orgmill.functions import fixed


def classify(df: DataFrame, text: str, table: dict[str, list[str]]) -> DataFrame:
    labels, hits = X.keyword_labels(F.col(text), table)
    return df.withColumns({"labels": labels, "hits": hits})


def infer_labels(df: DataFrame, parts: list[str]) -> DataFrame:
    """type and categories from the evidence text; what is there already stays."""
    text = F.concat_ws(" ", *parts)
    types, _ = X.keyword_labels(text, fixed.TYPE_KEYWORDS)
    categories, _ = X.keyword_labels(text, fixed.CATEGORY_KEYWORDS)
    return df.withColumns({"type": F.coalesce("type", F.try_element_at(types, F.lit(1))), "categories": F.when(F.size(F.coalesce("categories", F.array().cast("array<string>"))) > 0, F.col("categories")).otherwise(categories)})


def resolve_scopes(df: DataFrame, brief: str) -> DataFrame:
    """types, categories, regions (null: all) and keywords of each brief; a blank one has the default categories."""
    types, type_hits = X.keyword_labels(F.col(brief), fixed.TYPE_KEYWORDS)
    categories, category_hits = X.keyword_labels(F.col(brief), fixed.CATEGORY_KEYWORDS)
    regions = X.city_mentions(F.col(brief))
    blank = F.coalesce(F.trim(brief) == "", F.lit(True))
    some = lambda c: F.when(F.size(c) > 0, c)
    return df.withColumns({
        "types": F.when(~blank, some(types)),
        "categories": F.when(blank, X.texts(fixed.DEFAULT_CATEGORIES)).otherwise(some(categories)),
        "regions": F.when(~blank, some(regions)),
        "keywords": F.when(blank, F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(type_hits, category_hits))),
    })


def in_scope(df: DataFrame, types=None, categories=None, regions=None, limit: int | None = None) -> DataFrame:
    """Rows of the named types, categories and regions (None: all), the first limit in input order."""
    for column, wanted in (("type", types), ("category", categories), ("region", regions)):
        if wanted is not None:
            df = df.where(F.col(column).isin(*wanted))
    return df.orderBy("pos").limit(limit) if limit else df


def relevance_reason(texts: Column) -> Column:
    """Why a row is no learning centre: the first text with a medical or else a landmark word."""

    def reason(t: Column) -> Column:
        lower = F.lower(t)
        shown = F.concat(F.left(t, F.lit(80)), F.when(F.length(t) > 80, "...").otherwise(""))
        told = lambda what, hit: F.concat(F.lit(f'{what} (matched "'), hit, F.lit('" in "'), shown, F.lit('")'))
        medical, landmark = X.first_keyword(lower, fixed.MEDICAL_KEYWORDS), X.first_keyword(lower, fixed.LANDMARK_KEYWORDS)
        return F.when(medical.isNotNull(), told(fixed.MEDICAL_REASON, medical)).when(landmark.isNotNull(), told(fixed.LANDMARK_REASON, landmark))

    return F.try_element_at(F.array_compact(F.transform(F.array_compact(texts), reason)), F.lit(1))


def flag_irrelevant(df: DataFrame, scalars: list[str], arrays: list[str] = ()) -> DataFrame:
    texts = F.array(*[F.col(c) for c in scalars])
    for c in arrays:
        texts = F.concat(texts, F.coalesce(c, F.array().cast("array<string>")))
    return df.withColumn("flag_reason", relevance_reason(texts))


def split_flagged(df: DataFrame, scalars: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that go on, rows for review) before the costly stages."""
    flagged = flag_irrelevant(df, scalars)
    return flagged.where("flag_reason is null").drop("flag_reason"), flagged.where("flag_reason is not null")


def assess_material(df: DataFrame) -> DataFrame:
    """sufficient, facts and material_reason: is there enough to write a description from?"""
    kinds = dict(df.dtypes)
    has = lambda c: X.has_value(F.col(c), kinds[c]) if c in kinds else F.lit(False)
    any_of = lambda *cs: F.greatest(*[has(c) for c in cs])
    source = F.coalesce(F.length(F.trim("descriptionSourceText")) >= 40, F.lit(False)) if "descriptionSourceText" in kinds else F.lit(False)
    facts = F.array_compact(F.array(F.when(source, "descriptionSourceText"), *[F.when(has(c), c) for c in fixed.MATERIAL_FACTS]))
    weight = F.size(facts) + source.cast("int")
    missing = F.array_compact(F.array(
        F.when(~any_of("nameUz", "nameRu", "nameLatin"), fixed.MISSING["name"]),
        F.when(~any_of("city", "address"), fixed.MISSING["place"]),
        F.when(~any_of("type", "categories"), fixed.MISSING["kind"]),
        F.when(weight < 2, fixed.MISSING["facts"]),
    ))
    return df.withColumns({"facts": facts, "sufficient": F.size(missing) == 0, "material_reason": F.when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, "; ")))})


def guess_kind(df: DataFrame, query: str) -> DataFrame:
    padded = F.concat(F.lit(" "), F.lower(F.col(query)), F.lit(" "))
    kinds = [F.when(X.first_keyword(padded, words).isNotNull(), F.lit(kind)) for kind, words in fixed.ITEM_KINDS.items()]
    return df.withColumn("kind", F.coalesce(*kinds))


def usable_pages(df: DataFrame, text: str, least: int = 200) -> DataFrame:
    return df.where(F.length(text) >= least)


def with_some_field(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows in which at least one cleaned field has a value."""
    kinds = dict(df.dtypes)
    some = F.lit(False)
    for c in fields:
        some = some | X.has_value(F.col(c), kinds[c])
    return df.where(some)
