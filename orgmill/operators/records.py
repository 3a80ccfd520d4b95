"""Export records, validation, routing and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgmill.functions import expressions as X
from orgmill.functions import fixed
from orgmill.operators.classify import relevance_reason


#: What a record takes from its row, and may be missing there.
GIVEN = "nameUz string, nameRu string, nameLatin string, type string, additionalTypes array<string>, phone string, phone2 string, email string, website string, telegram string, instagram string, city string, cityId string, regionId string, address string, lat double, lng double, deliveryMode string, descriptionUz string, descriptionRu string, foundedYear int, studentCount int, teacherCount int, languages array<string>, programs array<string>, shifts array<string>, specializations array<string>, achievements string, categories array<string>"
#: What the rules name.
CHECKED = "id string, slug string, nameKey string, status string, " + GIVEN


def with_missing(df: DataFrame, schema: str) -> DataFrame:
    """df with a null column for each of schema that it lacks."""
    return df.withColumns({n: F.lit(None).cast(k) for n, k in (c.split() for c in schema.split(", ")) if n not in df.columns})


def build_records(df: DataFrame) -> DataFrame:
    """build_errors, and record (null where there is an error). df has city_known, and cityId and regionId if they are."""
    given = [c for c in df.columns]
    df = with_missing(df, GIVEN)
    p = X.phone(F.col("phone"))
    told = F.coalesce(F.trim("phone") != "", F.lit(False))
    texts = F.concat(F.array("nameUz", "nameRu", "nameLatin", "descriptionUz", "descriptionRu"), *[F.coalesce(c, F.array().cast("array<string>")) for c in ("programs", "specializations")])
    errors = F.array_compact(F.array(
        F.when(~F.coalesce("city_known", F.lit(False)), F.concat(F.lit(fixed.NO_CITY), F.coalesce("city", F.lit("(missing)")), F.lit('"'))),
        F.when(told & ~p["valid"], F.concat(F.lit(fixed.BAD_PHONE), F.col("phone"), F.lit('": '), p["reason"])),
        F.when(F.coalesce("nameUz", "nameLatin").isNull(), fixed.NO_NAME),
        relevance_reason(texts),
    ))
    name, none = F.coalesce("nameUz", "nameLatin"), F.array().cast("array<string>")
    listed = lambda c: F.coalesce(c, none).alias(c)
    details = F.struct(
        "descriptionUz", "descriptionRu", "foundedYear", "studentCount", "teacherCount", X.languages(F.col("languages")).alias("languages"), listed("programs"), listed("shifts"), listed("specializations"), "achievements", listed("categories"),
    )
    record = F.struct(
        X.record_id(F.col("entity_id")).alias("id"), name.alias("nameUz"), F.coalesce("nameRu", name).alias("nameRu"), X.name_key(name).alias("nameKey"), X.slug(name, F.col("city")).alias("slug"),
        F.coalesce("type", F.lit("COURSE_CENTER")).alias("type"), listed("additionalTypes"), F.lit("PENDING").alias("status"), p["normalized"].alias("phone"), X.phone2(F.col("phone2")).alias("phone2"), "email", X.url(F.col("website")).alias("website"),
        "telegram", "instagram", "cityId", "regionId", "address", "lat", "lng", F.lit(False).alias("isVerified"), F.lit(False).alias("trialLessonEnabled"), F.coalesce("deliveryMode", F.lit("OFFLINE")).alias("deliveryMode"), details.alias("details"),
        F.lit(None).cast("struct<monthlyMin:double,monthlyMax:double,paymentMethods:array<string>>").alias("pricing"), none.alias("media"), none.alias("branches"),
    )
    return df.withColumn("build_errors", errors).withColumn("record", F.when(F.size("build_errors") == 0, record)).select(*given, "build_errors", "record")


def flat(df: DataFrame, *keys: str) -> DataFrame:
    """keys and the fields of each record and of its details, as validate_records reads them."""
    return df.where("record is not null").select(*keys, "record.*").select("*", "details.*").drop("details")


def _too_short(c: str):
    return lambda: F.coalesce(F.length(c) < 1, F.lit(True))


def _not_in(c: str, values):
    return lambda: ~F.coalesce(F.col(c).isin(*values), F.lit(False))


def _bad_items(c: str, wrong) -> Column:
    """The items of a list that are wrong; null if none is."""
    return F.nullif(F.array_join(F.filter(c, wrong), ", ", "null"), F.lit(""))


def _any_not_in(c: str, values):
    return lambda: F.exists(c, lambda x: ~F.coalesce(x.isin(*values), F.lit(False)))


def _unknown(c: str, known):
    return lambda: F.coalesce(~F.col(c).isin(*known), F.lit(False))


def _fraction(c: str):
    return lambda: F.coalesce(F.col(c) != F.floor(c), F.lit(False))


def _value(c: str):
    return lambda: F.col(c).cast("string")


def _items(c: str, values):
    return lambda: _bad_items(c, lambda x: ~F.coalesce(x.isin(*values), F.lit(False)))


#: Rule -> when it is broken, and which value breaks it (where there is one to name).
RULES = {
    **{f"{c}: too short": (_too_short(c), None) for c in ("id", "nameUz", "nameRu", "nameKey")},
    "slug: slug must be url-safe kebab-case": (lambda: ~F.coalesce(F.col("slug").rlike("^[a-z0-9]+(-[a-z0-9]+)*$"), F.lit(False)), _value("slug")),
    "type: not in enum": (_not_in("type", fixed.TYPES), _value("type")),
    "additionalTypes: not in enum": (_any_not_in("additionalTypes", fixed.TYPES), _items("additionalTypes", fixed.TYPES)),
    "status: not in enum": (_not_in("status", fixed.STATUSES), _value("status")),
    "email: not an address": (lambda: F.col("email").isNotNull() & ~F.col("email").rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), _value("email")),
    "website: not a url": (lambda: F.col("website").isNotNull() & ~F.col("website").rlike("(?i)^https?://.+"), _value("website")),
    "deliveryMode: not in enum": (_not_in("deliveryMode", fixed.DELIVERY_MODES), _value("deliveryMode")),
    **{f"{c}: not an integer": (_fraction(c), _value(c)) for c in ("foundedYear", "studentCount", "teacherCount")},
    "languages: not a lower-case code": (lambda: F.exists("languages", lambda x: ~x.rlike("^[a-z]{2,3}$")), lambda: _bad_items("languages", lambda x: ~x.rlike("^[a-z]{2,3}$"))),
    "categories: not in enum": (_any_not_in("categories", fixed.CATEGORIES), _items("categories", fixed.CATEGORIES)),
    "cityId: not a known city": (_unknown("cityId", sorted({c[0] for c in fixed.CITIES if c[0]})), _value("cityId")),
    "regionId: not a known region": (_unknown("regionId", sorted({c[1] for c in fixed.CITIES})), _value("regionId")),
    "phone is not normalized": (lambda: F.coalesce((F.col("phone") != "") & ~X.phone(F.col("phone"))["valid"], F.lit(False)), _value("phone")),
    "deliveryMode ONLINE is flagged for review": (lambda: F.coalesce(F.col("deliveryMode") == "ONLINE", F.lit(False)), None),
    "languages contain codes not yet observed": (lambda: F.exists("languages", lambda x: ~x.isin(*fixed.KNOWN_LANGUAGES)), lambda: _bad_items("languages", lambda x: ~x.isin(*fixed.KNOWN_LANGUAGES))),
    "categories must be non-empty": (lambda: F.size(F.coalesce("categories", F.array().cast("array<string>"))) == 0, None),
    "both descriptions are null": (lambda: (F.coalesce("descriptionUz", F.lit("")) == "") & (F.coalesce("descriptionRu", F.lit("")) == ""), None),
}


def _told(name: str, value) -> Column:
    """The rule, and in quotes the value that breaks it."""
    return F.lit(name) if value is None else F.concat(F.lit(name), F.coalesce(F.concat(F.lit(' ("'), value(), F.lit('")')), F.lit(" (missing)")))


def validate_records(df: DataFrame) -> DataFrame:
    """reasons and valid of each record by itself; df is as flat gives it, and what it lacks counts as null."""
    reasons = F.array_compact(F.array(*[F.when(rule(), _told(name, value)) for name, (rule, value) in RULES.items()]))
    return with_missing(df, CHECKED).withColumn("reasons", reasons).select(*df.columns, "reasons").withColumn("valid", F.size("reasons") == 0)


def validate_batch(df: DataFrame) -> DataFrame:
    """Adds reasons for slugs and for name and city that other records of the batch have too."""
    checked = with_missing(validate_records(df), "cityId string").withColumn("__key", X.name_key(F.col("nameUz")))
    slugs = df.groupBy("slug").agg(F.count("*").alias("__slugs"))
    names = checked.groupBy("__key", "cityId").agg(F.count("*").alias("__names")).select(F.col("__key").alias("__k"), F.col("cityId").alias("__c"), "__names")
    both = checked.join(slugs, "slug", "left").join(names, checked["__key"].eqNullSafe(names["__k"]) & checked["cityId"].eqNullSafe(names["__c"]), "left")
    more = F.array_compact(F.array(F.when(F.col("__slugs") > 1, F.concat(F.lit('slug "'), F.col("slug"), F.lit('" is not unique across the batch'))), F.when(F.col("__names") > 1, "duplicate name and city in the batch")))
    out = both.withColumn("reasons", F.concat("reasons", more)).withColumn("valid", F.size("reasons") == 0)
    return out.select(*df.columns, "reasons", "valid")


def route(df: DataFrame) -> DataFrame:
    """outcome: build errors and reasons go to review, a rejected score is rejected, the rest is approved."""
    outcome = (
        F.when(F.size("build_errors") > 0, "NEEDS_REVIEW").when(F.col("band") == "REJECTED", "REJECTED").when((F.col("band") == "NEEDS_REVIEW") | (F.size("reasons") > 0), "NEEDS_REVIEW").otherwise("APPROVED")
    )
    return df.withColumn("outcome", outcome)


def finalize(df: DataFrame, key: str, at: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records to export, records demoted to review (key, reasons), and the rows that the demotion adds to the state log
    (key, at, state, note), of an approved set that is validated once more."""
    checked = validate_batch(df)
    demoted = checked.where("not valid").select(key, "reasons", F.lit("NEEDS_REVIEW").alias("state"), F.array_join("reasons", "; ").alias("last_error"))
    note = F.concat(F.lit("failed final pre-export batch validation: "), F.col("last_error"))
    return checked.where("valid").drop("reasons", "valid"), demoted, demoted.select(key, F.lit(at).cast("timestamp").alias("at"), "state", note.alias("note"))


def run_report(states: DataFrame, scope: str | None = None, generated_at: str | None = None) -> DataFrame:
    """Counts by state and rounded mean scores over rows that have both; duplicates count apart from other rejected rows.
    scope (a JSON text) and generated_at are kept as they are."""
    is_state = lambda s: F.count_if(F.col("state") == s)
    duplicate = F.coalesce(F.col("last_error") == "duplicate", F.lit(False))
    mean = lambda c: F.coalesce(F.floor(F.avg(c) + 0.5), F.lit(0)).cast("int")
    return states.agg(
        F.count("*").alias("discovered"), F.count_if(F.col("state").isin("JSON_READY", "APPROVED", "NEEDS_REVIEW")).alias("processed"), is_state("APPROVED").alias("approved"), is_state("NEEDS_REVIEW").alias("review"),
        F.count_if((F.col("state") == "REJECTED") & ~duplicate).alias("rejected"), F.count_if(duplicate).alias("duplicates"), mean("completeness").alias("mean_completeness"), mean("source_confidence").alias("mean_confidence"),
    ).withColumns({"scope": F.lit(scope).cast("string"), "generated_at": F.lit(generated_at).cast("timestamp")})


def run_summary(states: DataFrame, target: int) -> DataFrame:
    report = run_report(states).select("approved", "review", "rejected", "duplicates")
    return report.withColumn("shortfall", F.greatest(F.lit(0), target - F.col("approved"))).withColumn("exhausted", F.col("approved") < target)


def by_source(results: DataFrame, source: str = "source") -> DataFrame:
    """Rows for each source; 'unknown' for none."""
    return results.groupBy(F.coalesce(source, F.lit("unknown")).alias("source")).agg(F.count("*").alias("n"))


def validation_summary(checked: DataFrame) -> DataFrame:
    """Records for each reason, without the values that it names; valid ones under 'valid'."""
    each = F.explode(F.when(F.size("reasons") == 0, F.array(F.lit("valid"))).otherwise(F.col("reasons"))).alias("reason")
    return checked.select(each).groupBy(F.regexp_replace("reason", r' \((?:".*"|missing)\)$|(?<=^slug) ".*"', "").alias("reason")).agg(F.count("*").alias("n"))


def result_rows(states: DataFrame, records: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """The record's values, else the candidate's, with one of four display states."""
    shown = F.when(F.col("state") == "APPROVED", "approved").when(F.col("state") == "NEEDS_REVIEW", "review").when(F.col("state") == "REJECTED", "rejected").otherwise("in progress")
    joined = states.alias("s").join(records.alias("r"), key, "left").join(candidates.alias("c"), key, "left")
    return joined.select(key, F.coalesce("r.name", "c.name").alias("name"), shown.alias("status"), F.col("s.quality").alias("quality"), F.coalesce("c.source", F.lit("unknown")).alias("source"))
