"""The whole chain over tables of candidates and evidence: resolve, merge, score, build, validate, route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgmill.functions import expressions as X
from orgmill.operators import classify, evidence, records, resolve, standardize

SCALARS = ["nameUz", "nameRu", "nameLatin", "phone", "phone2", "email", "website", "telegram", "instagram", "city", "address", "achievements", "descriptionSourceText", "deliveryMode", "foundedYear", "studentCount", "teacherCount"]
LISTS = ["languages", "programs", "specializations"]


def dedupe(candidates: DataFrame) -> DataFrame:
    """The candidate with the smallest input_pos of each group that name and city, phone, site or handles connect."""
    keyed = candidates.withColumns({
        "__name": F.when(X.name_key(F.col("rawName")) != "", F.concat_ws("|", X.name_key(F.col("rawName")), F.lower(F.trim("city")))),
        "__phone": X.phone(F.col("phone"))["normalized"],
        "__site": X.domain(F.col("website")),
        "__telegram": X.handle(F.col("telegram")),
        "__instagram": X.handle(F.col("instagram")),
    })
    resolved = resolve.resolve_duplicates(keyed, "input_pos", {k: f"__{k}" for k in ("name", "phone", "site", "telegram", "instagram")})
    kept = resolved.where("id = kept_id").select(F.col("id").alias("input_pos"))
    return standardize.with_entity_id(candidates.join(kept, "input_pos", "left_semi"), "rawName", "city").drop("duplicate_id", "hash")


def run(candidates: DataFrame, items: DataFrame) -> DataFrame:
    """candidates: input_pos, rawName, city, category, type, phone, website, telegram, instagram. items: entity_id,
    source_url, source_kind, seq and evidence fields. One row for each entity: outcome, reasons, record and scores."""
    entities = dedupe(candidates)
    cleaned = standardize.clean_evidence(items)
    agreed = evidence.corroborated(cleaned, "entity_id", "seq")
    weighed = evidence.with_item_confidence(cleaned.join(agreed, ["entity_id", "seq"]))
    merged = evidence.merge_scalars(weighed, "entity_id", [c for c in SCALARS if c in weighed.columns])
    for c in LISTS:
        if c in weighed.columns:
            merged = merged.join(evidence.merge_lists(weighed, "entity_id", c), "entity_id", "left")
    base = entities.select("entity_id", F.col("rawName").alias("nameLatin"), "city", "phone", "website", "telegram", "instagram")
    full = entities.select("entity_id", "input_pos", "type", "category").join(merged, "entity_id", "left")
    for c in SCALARS + LISTS:
        if c not in full.columns:
            full = full.withColumn(c, F.lit(None).cast("array<string>" if c in LISTS else "int" if c.endswith(("Year", "Count")) else "string"))
    full = resolve.fill_from_candidate(full, base, "entity_id", ["nameLatin", "city", "phone", "website", "telegram", "instagram"])
    full = full.withColumns({"deliveryMode": F.coalesce("deliveryMode", F.lit("OFFLINE")), "categories": F.when(F.col("category").isNotNull(), F.array("category")), "evidence_count": F.coalesce("evidence_count", F.lit(0)), "best_confidence": F.coalesce("best_confidence", F.lit(0.0))})
    full = classify.infer_labels(full, ["nameUz", "nameRu", "nameLatin", "achievements", "descriptionSourceText"])
    located = resolve.resolve_city(full.withColumnRenamed("city", "place"), "place", resolve.city_dimension(full.sparkSession)).withColumn("city_known", F.col("city").isNotNull()).withColumn("city", F.coalesce("city", "place"))
    scored = evidence.with_quality(evidence.with_source_confidence(evidence.with_completeness(standardize.render_description(located))))
    built = records.build_records(scored)
    checked = records.validate_batch(records.flat(built, "entity_id")).select("entity_id", "reasons")
    out = built.join(checked, "entity_id", "left").withColumn("reasons", F.coalesce("reasons", F.array().cast("array<string>")))
    return records.route(out).select("entity_id", "outcome", "build_errors", "reasons", "record", "completeness", "source_confidence", "quality", "band")
