"""Readers and writers: candidate documents, envelopes, payloads, side outputs and CSV lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmill.functions import fixed

BOM = "﻿"
CANDIDATE = "institutions array<struct<fixtureId:string,rawName:string,city:string,category:string,type:string,phone:string,website:string,telegram:string,instagram:string,sourceUrl:string>>"


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """One multi-line JSON document: its institutions as rows, with their place as input_pos."""
    doc = spark.read.schema(CANDIDATE).option("multiLine", True).json(path)
    return doc.select(F.posexplode("institutions").alias("input_pos", "x")).select("input_pos", "x.*")


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def envelope(records: DataFrame, exported_at: str, order: str) -> DataFrame:
    """One row with the JSON document {version, exportedAt, institutions}. For bulk use write_records."""
    rows = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("__order"), F.struct("*").alias("r")))), lambda x: x["r"])
    return records.agg(F.to_json(F.struct(F.lit(1).alias("version"), F.lit(exported_at).alias("exportedAt"), rows.alias("institutions"))).alias("value"))


def write_envelope(records: DataFrame, path: str, exported_at: str, order: str, most: int = 100_000) -> None:
    """One document, which one task writes: more than most records raise. write_records has no such bound."""
    if records.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} records for one document: use write_records")
    envelope(records, exported_at, order).write.text(path)


def write_records(records: DataFrame, path: str) -> None:
    """JSON lines, in as many parts as there are partitions."""
    records.write.json(path)


def write_outcomes(df: DataFrame, path: str, by: str = "outcome") -> None:
    df.write.partitionBy(by).json(path)


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of an envelope or of a bare array."""
    lines = spark.read.text(path, wholetext=True)
    v = F.try_parse_json("value")
    both = F.coalesce(F.try_variant_get(v, "$.institutions", "array<variant>"), F.try_variant_get(v, "$", "array<variant>"))
    return lines.select(F.explode(both).alias("x")).select(F.from_json(F.to_json("x"), schema).alias("r")).select("r.*")


def payload_records(c: Column) -> Column:
    """The JSON objects in a text: a code fence goes, an array or an object that wraps one is opened; else none."""
    body = F.regexp_replace(F.trim(c), r"(?s)^```[a-z]*\s*(.*?)\s*```$", "$1")
    body = F.when(F.trim(body).startswith("["), body).otherwise(F.regexp_extract(body, r"(?s)(\{.*\})", 1))
    v = F.try_parse_json(body)
    tries = [F.try_variant_get(v, p, "array<variant>") for p in ("$", "$.results", "$.items", "$.institutions", "$.data")]
    return F.coalesce(*tries, F.array().cast("array<variant>"))


def unwrap_records(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn("records", F.transform(payload_records(F.col(col)), lambda x: F.to_json(x)))


def unwrap_object(df: DataFrame, col: str) -> DataFrame:
    """object: the JSON object in a text, or the first element of an array of objects there; else null."""
    body = F.regexp_replace(F.trim(col), r"(?s)^```[a-z]*\s*(.*?)\s*```$", "$1")
    body = F.when(F.trim(body).startswith("["), body).otherwise(F.regexp_extract(body, r"(?s)(\{.*\})", 1))
    v = F.try_parse_json(body)
    first = F.try_element_at(F.try_variant_get(v, "$", "array<variant>"), F.lit(1))
    text = F.to_json(F.coalesce(first, v))
    return df.withColumn("object", F.when(text.startswith("{"), text))


def csv_cell(c: Column, kind: str = "string") -> Column:
    s = F.array_join(c, "; ") if kind.startswith("array") else c.cast("string")
    quoted = F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(s.isNull(), "").when(s.rlike('[",\n\r]'), quoted).otherwise(s)


def csv_lines(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A line (without its end) for each row; columns: name -> header. Lists are joined by '; '."""
    kinds = dict(df.dtypes)
    return df.withColumn("line", F.array_join(F.array(*[csv_cell(F.col(c), kinds[c]) for c in columns]), ","))


def write_csv(df: DataFrame, columns: dict[str, str], path: str, most: int = 100_000) -> None:
    """UTF-8 with a mark, CRLF ends and a header, in one file, as it is made to be opened in a spreadsheet: one task writes
    it, and more than most rows raise. write_csv_parts has no such bound."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows for one file: use write_csv_parts")
    head = ",".join(f'"{h}"' if "," in h else h for h in columns.values())
    lines = csv_lines(df, columns).select("line")
    out = df.sparkSession.createDataFrame([(BOM + head,)], "line string").union(lines)
    out.coalesce(1).write.option("lineSep", "\r\n").text(path)


def write_csv_parts(df: DataFrame, columns: dict[str, str], path: str) -> None:
    """The same lines, without mark and header, in as many files as there are partitions."""
    csv_lines(df, columns).select("line").write.option("lineSep", "\r\n").text(path)


def with_columns_of(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast("string") for c in columns if c not in df.columns})


def offers_to_csv(df: DataFrame) -> DataFrame:
    """line: the ten columns of an offer; what is missing is blank. For write_csv: fixed.OFFER_COLUMNS."""
    return csv_lines(with_columns_of(df, fixed.OFFER_COLUMNS), fixed.OFFER_COLUMNS)


def listings_to_csv(df: DataFrame, attributes: str = "attributes") -> DataFrame:
    """line: the seven columns of a listing, and its attributes (a map) in one more cell. For write_csv: fixed.LISTING_COLUMNS."""
    return csv_lines(with_columns_of(df.withColumn("attributesText", F.coalesce(flatten_map(F.col(attributes)), F.lit(""))), fixed.LISTING_COLUMNS), fixed.LISTING_COLUMNS)


def flatten_map(c: Column) -> Column:
    """'k: v; k: v' in key order."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "; ")
