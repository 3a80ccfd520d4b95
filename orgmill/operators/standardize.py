"""Jobs that append standardised columns to a table of candidates, evidence, offers or listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgmill.functions import expressions as X
from orgmill.functions import fixed

EVIDENCE_STRINGS = ("nameUz", "nameRu", "nameLatin", "phone", "phone2", "email", "website", "telegram", "instagram", "city", "address", "achievements", "pricingNote", "descriptionSourceText")
EVIDENCE_ARRAYS = ("languages", "programs", "shifts", "specializations")
EVIDENCE_NUMBERS = ("foundedYear", "studentCount", "teacherCount")


def blank_to_null(c):
    return F.nullif(F.trim(c), F.lit(""))


def with_name_key(df: DataFrame, col: str, to: str = "name_key") -> DataFrame:
    return df.withColumn(to, X.name_key(F.col(col)))


def with_slug(df: DataFrame, *cols: str, to: str = "slug") -> DataFrame:
    return df.withColumn(to, X.slug(*[F.col(c) for c in cols]))


def with_entity_id(df: DataFrame, name: str, city: str) -> DataFrame:
    """entity_id, and duplicate_id and hash of the same name."""
    digest = F.sha2(F.coalesce(F.col(name), F.lit("")), 256)
    return df.withColumns({"entity_id": X.entity_id(F.col(name), F.col(city)), "duplicate_id": F.concat(F.lit("dup-"), F.left(digest, F.lit(24))), "hash": digest})


def with_phone(df: DataFrame, col: str) -> DataFrame:
    p = X.phone(F.col(col))
    return df.withColumns({"normalized": p["normalized"], "valid": p["valid"], "reason": p["reason"]})


def with_source_kind(df: DataFrame, col: str) -> DataFrame:
    u = F.lower(F.col(col))
    kind = F.when(u.rlike(fixed.SOCIAL_HOSTS), "social").when(u.rlike(fixed.DIRECTORY_HOSTS), "directory").when(u.rlike("^https?://"), "website").otherwise("other")
    return df.withColumn("source_kind", kind)


def drop_junk_items(items, names):
    """Items that hold one of the names, or a headline, go."""
    return F.filter(items, lambda x: ~F.exists(names, lambda n: (F.trim(n) != "") & F.contains(F.lower(x), F.lower(F.trim(n)))) & ~F.lower(x).rlike(fixed.JUNK_ITEM))


def clean_evidence(df: DataFrame) -> DataFrame:
    """Known fields only: trimmed, blanks null, lists without blanks and headlines, numbers above 0 rounded."""
    kinds, out = dict(df.dtypes), {}
    for c in EVIDENCE_STRINGS:
        if c in kinds:
            out[c] = blank_to_null(F.col(c))
    names = F.array_compact(F.array(*[out.get(c, F.lit(None).cast("string")) for c in ("nameUz", "nameRu", "nameLatin")]))
    for c in EVIDENCE_ARRAYS:
        if c in kinds:
            items = F.transform(F.filter(c, lambda x: F.trim(x) != ""), lambda x: F.trim(x))
            items = drop_junk_items(items, names) if c in ("programs", "specializations") else items
            out[c] = F.when(F.size(items) > 0, items)
    for c in EVIDENCE_NUMBERS:
        if c in kinds:
            n = F.col(c).try_cast("double")
            out[c] = F.when((n > 0) & (n < float("inf")), F.round(n).cast("int"))
    if "deliveryMode" in kinds:
        mode = F.upper(F.trim("deliveryMode"))
        out["deliveryMode"] = F.when(mode.isin(*fixed.DELIVERY_MODES), mode)
    return df.select(*[out.get(c, F.col(c)).alias(c) for c in df.columns])


def clean_offers(df: DataFrame, strings: list[str]) -> DataFrame:
    """Confirmed offers only: blanks null, name and website from the candidate, http(s) citations."""
    out = {c: blank_to_null(F.col(c)) for c in strings}
    out["providerName"] = F.coalesce(out["providerName"], F.col("candidateName"))
    out["website"] = F.coalesce(out["website"], F.col("candidateWebsite"))
    out["sourceUrls"] = F.filter("sourceUrls", lambda u: u.rlike("(?i)^https?://"))
    kept = confirmed(df, "confirmed")
    return kept.select(*[out.get(c, F.col(c)).alias(c) for c in kept.columns])


def confirmed(df: DataFrame, flag: str) -> DataFrame:
    """Rows whose tri-state flag is exactly true."""
    return df.where(F.col(flag).eqNullSafe(F.lit(True)))


def clean_listings(df: DataFrame) -> DataFrame:
    """Rows with an http(s) address and a title; the site defaults to the host; blank attributes go."""
    kept = df.where(F.col("sourceUrl").rlike("(?i)^https?://") & (F.trim("title") != ""))
    pairs = F.map_filter("attributes", lambda k, v: (F.trim(k) != "") & (F.trim(v) != ""))
    pairs = F.transform_values(F.transform_keys(pairs, lambda k, v: F.trim(k)), lambda k, v: F.trim(v))
    site = F.coalesce(blank_to_null(F.col("sourceSite")), F.try_parse_url("sourceUrl", F.lit("HOST")))
    return kept.withColumns({"title": F.trim("title"), "sourceSite": site, "attributes": pairs})


def search_to_candidates(df: DataFrame, per_search: int = 10) -> DataFrame:
    """id, name, city of search rows; the first per_search rows of each search."""
    rank = F.row_number().over(W.partitionBy("search").orderBy("pos"))
    city = F.coalesce(blank_to_null(F.col("statedCity")), F.col("searchedCity"))
    return df.withColumn("rank", rank).where(F.col("rank") <= per_search).select(F.col("url").alias("id"), F.coalesce(blank_to_null(F.col("name")), blank_to_null(F.col("title"))).alias("name"), city.alias("city"), "search", "rank")


def with_provenance(df: DataFrame, citations: str, key: str) -> DataFrame:
    """The first http(s) citation is the source, the rest are kept; without one a synthetic source stands."""
    real = F.filter(citations, lambda u: u.rlike("(?i)^https?://"))
    synthetic = F.concat(F.lit("research://web-search/"), F.replace(F.url_encode(key), F.lit("+"), F.lit("%20")))
    return df.withColumns({"source_url": F.coalesce(F.try_element_at(real, F.lit(1)), synthetic), "additional_urls": F.when(F.size(real) > 1, F.slice(real, 2, F.size(real) - 1)).otherwise(F.array().cast("array<string>"))})


def with_export_identity(df: DataFrame, raw: str) -> DataFrame:
    best = F.coalesce("nameUz", "nameLatin", "nameRu", raw)
    return df.withColumns({"best_name": best, "name_key": X.name_key(best), "slug": X.slug(best, F.col("city"))})


def render_description(df: DataFrame) -> DataFrame:
    """descriptionUz and descriptionRu from the source text, and why a review is needed."""
    source = F.trim("descriptionSourceText")
    enough = F.coalesce(F.length(source) >= 40, F.lit(False))
    cleaned = F.trim(F.regexp_replace(F.regexp_replace(source, rf"(?is)^(.*?){fixed.SUPERLATIVE}", "$1"), r"\s{2,}", " "))
    name = F.coalesce("nameUz", "nameLatin", F.lit(fixed.NAMELESS))
    russian = F.coalesce(F.col("nameRu"), F.lit("")) != ""
    reason = F.when(~enough, fixed.TOO_SHORT).when(~russian, fixed.NO_RUSSIAN)
    return df.withColumns({
        "descriptionUz": F.when(enough, F.concat(name, F.lit(fixed.ABOUT), cleaned)),
        "descriptionRu": F.when(enough & russian, F.concat("nameRu", F.lit(": "), cleaned)),
        "needs_review": ~enough | ~russian,
        "content_reason": reason,
    })


def fetch_targets(df: DataFrame, limit: int = 4) -> DataFrame:
    """Website, source, citations, telegram, instagram: distinct http(s) addresses, the first few."""
    ordered = F.concat(F.array("website", "source_url"), F.coalesce("citations", F.array().cast("array<string>")), F.array("telegram", "instagram"))
    kept = F.filter(F.transform(F.array_compact(ordered), lambda u: F.trim(u)), lambda u: u.rlike("(?i)^https?://"))
    return df.withColumn("targets", F.slice(F.array_distinct(kept), 1, limit))
