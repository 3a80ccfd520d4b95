"""The operators over the driver's tables, each with the SQL that must give the same rows (where SQL can)."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgmill.functions import expressions as X
from orgmill.functions import fixed
from orgmill.operators import blocks, classify, components, evidence, lists, matching, pages, ranges, records, resolve, standardize, state
from orgmill.shared import shared_path
from orgmill.sources import io
from orgmill.streaming import state as streams
from orgmill.streaming import report, store, transitions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# SQL of the scalar expressions, for the oracles
def q_key(c: str) -> str:
    s = f"strip_accents(translate(lower(trim({c})), 'ʻʼ’‘ōūāʺʹ', '''''''''oua'))"
    s = f"regexp_replace({s}, '\\b(llc|mchj|ltd|inc|centre|center|lc)\\b', '', 'g')"
    return f"trim(regexp_replace(regexp_replace({s}, '[''\".,()]', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"


def q_slug(c: str) -> str:
    s = f"regexp_replace(regexp_replace(regexp_replace(lower(strip_accents({c})), '[''\".,()]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
    return f"CASE WHEN {s} = '' THEN 'institution' ELSE {s} END"


def q_url(c: str) -> str:
    full = f"(CASE WHEN regexp_matches(trim({c}), '(?i)^https?://') THEN trim({c}) ELSE 'https://' || trim({c}) END)"
    return f"lower(regexp_extract({full}, '(?i)^https?://[^/?#]*')) || CASE WHEN regexp_replace({full}, '(?i)^https?://[^/?#]*', '') = '/' THEN '' ELSE regexp_replace({full}, '(?i)^https?://[^/?#]*', '') END"


def q_host(c: str) -> str:
    return f"regexp_replace(lower(regexp_extract({c}, '(?i)^https?://([^/?#:]*)', 1)), '^www\\.', '')"


def q_labels(text: str, table: dict[str, list[str]]) -> str:
    parts = [f"CASE WHEN {' OR '.join(f'contains(lower(trim({text})), {sql_list([k])})' for k in words)} THEN '{label}' END" for label, words in table.items()]
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
#: For synthetic corpora: keywords that their texts hold.
WORDS = {"A": ["the", "nicht"], "B": ["tion", "aux"], "C": ["worthless", "idiot", "license"], "D": ["zzzz"]}
PHONE_SQL = "CASE c_custkey % 5 WHEN 0 THEN '+998 90 ' || lpad((c_custkey % 10000000)::VARCHAR, 7, '0') WHEN 1 THEN '90' || lpad((c_custkey % 10000000)::VARCHAR, 7, '0') WHEN 2 THEN '0' || c_custkey::VARCHAR WHEN 3 THEN '+998' || c_custkey::VARCHAR ELSE '' END"


def phones(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    seven = F.lpad((k % 10_000_000).cast("string"), 7, "0")
    raw = F.when(k % 5 == 0, F.concat(F.lit("+998 90 "), seven)).when(k % 5 == 1, F.concat(F.lit("90"), seven)).when(k % 5 == 2, F.concat(F.lit("0"), k.cast("string"))).when(k % 5 == 3, F.concat(F.lit("+998"), k.cast("string"))).otherwise("")
    return t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", raw.alias("phone"))


@query(f"SELECT doc_id, {q_key('text')} AS name_key FROM documents")
def name_key(spark, d):
    return standardize.with_name_key(t(spark, d, "documents"), "text").select("doc_id", "name_key")


@query(f"SELECT doc_id, {q_slug('''text || ' ' || source''')} AS slug FROM documents")
def slug(spark, d):
    return standardize.with_slug(t(spark, d, "documents"), "text", "source").select("doc_id", "slug")


@query(f"SELECT s_suppkey, 'pipeline-' || {q_slug(q_key('s_name') + " || ' ' || n_name")} AS entity_id, 'dup-' || sha256(s_name)[:24] AS duplicate_id, sha256(s_name) AS hash FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def entity_id(spark, d):
    s = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return standardize.with_entity_id(s, "s_name", "n_name").select("s_suppkey", "entity_id", "duplicate_id", "hash")


def q_record_id(c: str) -> str:
    return f"'c' || list_aggregate(list_transform(range(24), lambda i: substr('0123456789abcdefghijklmnopqrstuvwxyz', ('0x' || substr(sha256({c}), 2 * i + 1, 2))::INTEGER % 36 + 1, 1)), 'string_agg', '')"


@query(f"SELECT s_suppkey, {q_record_id('s_name')} AS id FROM supplier")
def record_id(spark, d):
    return t(spark, d, "supplier").select("s_suppkey", X.record_id(F.col("s_name")).alias("id"))


@query(
    f"""WITH p AS (SELECT c_custkey, {PHONE_SQL} AS raw FROM customer), k AS (SELECT *, regexp_replace(trim(raw), '[^0-9+]', '', 'g') AS k FROM p),
n AS (SELECT *, CASE WHEN starts_with(k, '+998') THEN k[5:] WHEN starts_with(k, '998') THEN k[4:] WHEN regexp_matches(k, '^[0-9]{{9}}$') THEN k END AS n FROM k)
SELECT c_custkey, CASE WHEN regexp_matches(n, '^[0-9]{{9}}$') AND raw <> '' THEN '+998' || n END AS normalized, coalesce(regexp_matches(n, '^[0-9]{{9}}$'), false) AND raw <> '' AS valid,
CASE WHEN raw = '' THEN 'empty phone' WHEN n IS NULL AND starts_with(k, '0') THEN 'leading 0 without country code is not accepted' WHEN n IS NULL THEN 'unrecognized phone format' WHEN NOT regexp_matches(n, '^[0-9]{{9}}$') THEN 'expected 9 digits after country code, got ' || length(n) END AS reason FROM n"""
)
def phone_std(spark, d):
    return standardize.with_phone(phones(spark, d), "phone").select("c_custkey", "normalized", "valid", "reason")


@query(f"WITH p AS (SELECT c_custkey, {PHONE_SQL} AS raw FROM customer), q AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN raw || ',' || raw ELSE raw END AS raw FROM p) SELECT c_custkey, CASE WHEN contains(raw, ',') THEN raw WHEN regexp_matches(regexp_replace(raw, ' ', '', 'g'), '^(\\+998)?[0-9]{{9}}$') AND NOT starts_with(raw, '0') THEN '+998' || right(regexp_replace(raw, ' ', '', 'g'), 9) WHEN raw = '' THEN NULL ELSE raw END AS phone2 FROM q")
def phone2(spark, d):
    p = phones(spark, d).withColumn("phone", F.when(F.col("c_custkey") % 3 == 0, F.concat("phone", F.lit(","), "phone")).otherwise(F.col("phone")))
    return p.select("c_custkey", X.phone2(F.col("phone")).alias("phone2"))


@query(f"SELECT page_id, {q_url('url')} AS url FROM pages")
def url_std(spark, d):
    return t(spark, d, "pages").select("page_id", X.url(F.col("url")).alias("url"))


@query(f"SELECT page_id, {q_host('url')} AS domain, {q_host('url')} || regexp_replace(lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)), '/$', '') AS handle, CASE WHEN regexp_matches(url, 'maps\\.') THEN 'directory' ELSE 'website' END AS source_kind FROM pages")
def domain_key(spark, d):
    return standardize.with_source_kind(t(spark, d, "pages"), "url").select("page_id", X.domain(F.col("url")).alias("domain"), X.handle(F.col("url")).alias("handle"), "source_kind")


@query("SELECT source, list_sort(list_distinct(list(CASE lang WHEN 'en' THEN 'en' WHEN 'de' THEN 'de' WHEN 'fr' THEN 'fr' ELSE 'klingon' END))) AS languages FROM documents GROUP BY source")
def languages_std(spark, d):
    spelled = F.when(F.col("lang") == "en", " English ").when(F.col("lang") == "de", "немецкий  язык").when(F.col("lang") == "fr", "FRANSUZ tili").otherwise("Klingon")
    return t(spark, d, "documents").groupBy("source").agg(F.collect_list(spelled).alias("x")).select("source", F.sort_array(X.languages(F.col("x"))).alias("languages"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS \"nameUz\", CASE WHEN value > 10 THEN round(value)::INTEGER END AS \"foundedYear\", CASE WHEN event_id % 4 < 3 THEN ['OFFLINE', 'HYBRID', 'ONLINE'][(event_id % 4 + 1)::INTEGER] END AS \"deliveryMode\" FROM events")
def clean_evidence(spark, d):
    k = F.col("event_id")
    mode = F.when(k % 4 == 0, "offline ").when(k % 4 == 1, "Hybrid").when(k % 4 == 2, "ONLINE").otherwise("by post")
    e = t(spark, d, "events").select("event_id", F.when(k % 3 == 0, "   ").otherwise(F.concat(F.lit(" "), "event_type", F.lit(" "))).alias("nameUz"), F.when(F.col("value") > 10, F.col("value")).otherwise(-F.col("value")).alias("foundedYear"), mode.alias("deliveryMode"))
    return standardize.clean_evidence(e)


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE p_name END AS \"providerName\", 'http://x/' || p_partkey AS website, 1 AS n_urls FROM part WHERE p_partkey % 3 = 0")
def clean_offers(spark, d):
    k = F.col("p_partkey")
    offers = t(spark, d, "part").select("p_partkey", F.when(k % 2 == 0, "p_brand").alias("x"), F.when(k % 2 == 0, F.concat(F.lit(" "), "p_brand")).otherwise("  ").alias("providerName"), F.lit("").alias("website"), F.col("p_name").alias("candidateName"), F.concat(F.lit("http://x/"), k.cast("string")).alias("candidateWebsite"), F.array(F.lit("ftp://a"), F.lit("HTTPS://b")).alias("sourceUrls"), F.when(k % 3 == 0, True).when(k % 3 == 1, False).alias("confirmed"))
    return standardize.clean_offers(offers, ["providerName", "website"]).select("p_partkey", "providerName", "website", F.size("sourceUrls").alias("n_urls"))


@query("SELECT page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS \"sourceSite\", 'color: ' || page_id AS attributes FROM pages WHERE page_id % 2 = 0")
def clean_listings(spark, d):
    k = F.col("page_id")
    rows = t(spark, d, "pages").select("page_id", F.when(k % 2 == 0, "url").otherwise("").alias("title"), F.col("url").alias("sourceUrl"), F.lit(" ").alias("sourceSite"), F.create_map(F.lit(" color "), F.concat(F.lit(" "), k.cast("string")), F.lit("size"), F.lit(" ")).alias("attributes"))
    return standardize.clean_listings(rows).select("page_id", "sourceSite", io.flatten_map(F.col("attributes")).alias("attributes"))


@query(f"SELECT url AS id, trim({TITLE}) AS name, CASE WHEN page_id % 2 = 0 THEN 'Bukhara' ELSE 'Tashkent' END AS city, search, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY search ORDER BY page_id) AS rank FROM (SELECT *, page_id % 7 AS search FROM pages)) WHERE rank <= 10 AND {TITLE} <> ''")
def search_candidates(spark, d):
    k = F.col("page_id")
    rows = t(spark, d, "pages").select("url", k.alias("pos"), (k % 7).alias("search"), F.lit("  ").alias("name"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.when(k % 2 == 0, " Bukhara").otherwise(" ").alias("statedCity"), F.lit("Tashkent").alias("searchedCity"))
    return standardize.search_to_candidates(rows).where("name is not null")


@query("SELECT doc_id, list_filter(string_split(text, ' '), lambda w: NOT contains(lower(w), lower(string_split(text, ' ')[1])) AND NOT regexp_matches(lower(w), '(filial|tarmog|shahrida|shahridagi|viloyatidagi|uzbekistan)')) AS items FROM documents WHERE string_split(text, ' ')[1] <> '' UNION ALL SELECT doc_id, list_filter(string_split(text, ' '), lambda w: NOT regexp_matches(lower(w), '(filial|tarmog|shahrida|shahridagi|viloyatidagi|uzbekistan)')) FROM documents WHERE string_split(text, ' ')[1] = ''")
def junk_items(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.split("text", " ").alias("items"))
    return docs.select("doc_id", standardize.drop_junk_items(F.col("items"), F.slice("items", 1, 1)).alias("items"))


@query(f"SELECT host, coalesce(real[1], 'research://web-search/' || host) AS source_url, coalesce(real[2:], []) AS additional_urls FROM (SELECT host, list_sort(list_filter(list(url), lambda u: starts_with(u, 'https'))) AS real FROM (SELECT {q_host('url')} AS host, url FROM pages) GROUP BY host)")
def provenance(spark, d):
    p = t(spark, d, "pages").groupBy(X.domain(F.col("url")).alias("host")).agg(F.sort_array(F.collect_list(F.when(F.col("url").startswith("https"), F.col("url")).otherwise(F.concat(F.lit("x"), "url")))).alias("citations"))
    return standardize.with_provenance(p, "citations", "host").select("host", "source_url", "additional_urls")


@query(f"SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'É ' || s_name END AS best_name, {q_key("CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'É ' || s_name END")} AS name_key FROM supplier")
def export_identity(spark, d):
    s = t(spark, d, "supplier").select("s_suppkey", "s_name", F.lit(None).cast("string").alias("nameUz"), F.when(F.col("s_suppkey") % 2 == 1, F.concat(F.lit("É "), "s_name")).alias("nameLatin"), F.lit(None).cast("string").alias("nameRu"), F.lit("x").alias("city"))
    return standardize.with_export_identity(s, "s_name").select("s_suppkey", "best_name", "name_key")


CLEANED = r"trim(regexp_replace(regexp_replace(trim(text), '(?i)\b(best|number\s*1|№\s*1|no\.?\s*1|leading|top-rated|top\s+choice)\b', ''), '\s{2,}', ' ', 'g'))"


@query(f"""SELECT doc_id, CASE WHEN enough THEN source || ' haqida: ' || {CLEANED} END AS "descriptionUz", CASE WHEN enough AND lang = 'fr' THEN source || ': ' || {CLEANED} END AS "descriptionRu", NOT enough OR lang <> 'fr' AS needs_review,
CASE WHEN NOT enough THEN '{fixed.TOO_SHORT}' WHEN lang <> 'fr' THEN '{fixed.NO_RUSSIAN}' END AS content_reason FROM (SELECT *, length(trim(text)) >= 40 AS enough FROM documents)""")
def description(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.col("text").alias("descriptionSourceText"), F.col("source").alias("nameUz"), F.lit(None).cast("string").alias("nameLatin"), F.when(F.col("lang") == "fr", F.col("source")).alias("nameRu"))
    return standardize.render_description(docs).select("doc_id", "descriptionUz", "descriptionRu", "needs_review", "content_reason")


@query("SELECT host, list_sort(list_distinct(list(url)))[1:4] AS targets FROM (SELECT regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, url FROM pages) GROUP BY host")
def fetch_targets(spark, d):
    p = t(spark, d, "pages").groupBy(F.try_parse_url("url", F.lit("HOST")).alias("host")).agg(F.sort_array(F.collect_list("url")).alias("citations"))
    p = p.select("host", F.lit("@handle").alias("website"), F.col("citations")[0].alias("source_url"), "citations", F.lit(None).cast("string").alias("telegram"), F.lit("x.com").alias("instagram"))
    return standardize.fetch_targets(p).select("host", "targets")


@query(f"SELECT doc_id, {q_labels('text', WORDS)} AS labels FROM documents")
def classify_labels(spark, d):
    return classify.classify(t(spark, d, "documents"), "text", WORDS).select("doc_id", "labels")


CITY_TEXT = ["Toshkent shahri", "in SAMARQAND today", "nowhere", "Toshkent viloyati, Chirchiq", "Бухара", ""]


def city_texts(c):
    chain = F.lit(CITY_TEXT[-1])
    for i, text in enumerate(CITY_TEXT[:-1]):
        chain = F.when(c % len(CITY_TEXT) == i, text).otherwise(chain)
    return chain




def city_answers(values: list[str | None]) -> str:
    return "CASE s_suppkey % 6 " + " ".join(f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values)) + " END"


@query(f"SELECT s_suppkey, {city_answers(['Tashkent', 'Samarkand', None, 'Tashkent Region', 'Bukhara', None])} AS city FROM supplier")
def resolve_city(spark, d):
    s = t(spark, d, "supplier").select("s_suppkey", city_texts(F.col("s_suppkey")).alias("place"))
    return resolve.resolve_city(s, "place", resolve.city_dimension(spark)).select("s_suppkey", "city")


@query(f"SELECT s_suppkey FROM (SELECT s_suppkey, {city_answers(['Tashkent', 'Samarkand', None, 'Tashkent Region', 'Bukhara', None])} AS city FROM supplier) WHERE city IN ('Tashkent', 'Bukhara')")
def city_scope(spark, d):
    s = t(spark, d, "supplier").select("s_suppkey", city_texts(F.col("s_suppkey")).alias("place"))
    return resolve.in_city_scope(s, "place", resolve.city_dimension(spark), ["Tashkent", "Bukhara"]).select("s_suppkey")


@query("SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN ['Tashkent'] WHEN 1 THEN ['Samarkand'] WHEN 3 THEN ['Tashkent', 'Tashkent Region'] WHEN 4 THEN ['Bukhara'] ELSE []::VARCHAR[] END AS cities FROM supplier")
def city_mentions(spark, d):
    text = F.when(F.col("s_suppkey") % 6 == 3, "Toshkent viloyati, Chirchiq").otherwise(city_texts(F.col("s_suppkey")))
    return t(spark, d, "supplier").select("s_suppkey", X.city_mentions(text).alias("cities"))


@query("SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN ['LANGUAGES', 'SCHOOL_SUBJECTS', 'UNIVERSITY_PREP', 'KIDS_EDUCATION'] WHEN 1 THEN ['IELTS', 'KIDS_EDUCATION'] WHEN 2 THEN NULL ELSE NULL END AS categories, CASE s_suppkey % 4 WHEN 2 THEN ['SCHOOL', 'COURSE_CENTER'] END AS types, CASE s_suppkey % 4 WHEN 1 THEN ['Bukhara'] END AS regions FROM supplier")
def resolve_scope(spark, d):
    k = F.col("s_suppkey")
    brief = F.when(k % 4 == 0, "  ").when(k % 4 == 1, "IELTS for KIDS in Buxoro").when(k % 4 == 2, "maktab va kurs").otherwise("something else")
    return classify.resolve_scopes(t(spark, d, "supplier").select("s_suppkey", brief.alias("brief")), "brief").select("s_suppkey", "categories", "types", "regions")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'looks like a medical organization (matched \"clinic\" in \"' || source || ' Clinic\")' WHEN doc_id % 3 = 1 THEN 'looks like a landmark (matched \"unesco\" in \"UNESCO site\")' END AS flag_reason FROM documents")
def relevance_flag(spark, d):
    k = F.col("doc_id")
    docs = t(spark, d, "documents").select("doc_id", F.when(k % 3 == 0, F.concat("source", F.lit(" Clinic"))).otherwise(F.col("source")).alias("name"), F.when(k % 3 != 2, F.array(F.lit("English"), F.lit("UNESCO site"))).alias("programs"))
    return classify.flag_irrelevant(docs, ["name"], ["programs"]).select("doc_id", "flag_reason")


@query("SELECT doc_id, doc_id % 3 <> 0 AS goes_on, CASE WHEN doc_id % 3 = 0 THEN 'looks like a medical organization (matched \"hospital\" in \"a hospital\")' END AS flag_reason FROM documents".replace('\\"', '"'))
def early_exit(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, "a hospital").alias("name"))
    on, review = classify.split_flagged(docs, ["name"])
    return on.select("doc_id", F.lit(True).alias("goes_on"), F.lit(None).cast("string").alias("flag_reason")).union(review.select("doc_id", F.lit(False), "flag_reason"))


MATERIAL = "list_filter([CASE WHEN length(trim(text)) >= 40 THEN 'descriptionSourceText' END, CASE WHEN quality IS NOT NULL THEN 'foundedYear' END, CASE WHEN trim(source) <> '' THEN 'address' END], lambda x: x IS NOT NULL)"


@query(f"""SELECT doc_id, facts, len(missing) = 0 AS sufficient, CASE WHEN len(missing) > 0 THEN 'missing ' || array_to_string(missing, '; ') END AS material_reason FROM (SELECT *, list_filter([CASE WHEN lang = 'es' THEN 'a name' END, CASE WHEN len(facts) + CASE WHEN length(trim(text)) >= 40 THEN 1 ELSE 0 END < 2 THEN 'at least 2 substantive facts' END], lambda x: x IS NOT NULL) AS missing
FROM (SELECT *, {MATERIAL} AS facts FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id)))""")
def material_gate(spark, d):
    labels = t(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("foundedYear"))
    docs = t(spark, d, "documents").join(labels, "doc_id", "left").select("doc_id", F.col("text").alias("descriptionSourceText"), "foundedYear", F.col("source").alias("address"), F.when(F.col("lang") != "es", F.col("lang")).alias("nameUz"), F.lit("SCHOOL").alias("type"))
    return classify.assess_material(docs).select("doc_id", "facts", "sufficient", "material_reason")


@query("SELECT conv_id, turn, CASE WHEN contains(lower(text), 'sedan') OR contains(' ' || lower(text) || ' ', ' at ') OR contains(' ' || lower(text) || ' ', ' mt ') OR contains(lower(text), 'mashina') OR contains(lower(text), 'avtomobil') OR contains(' ' || lower(text) || ' ', 'avto ') OR contains(lower(text), 'krossover') THEN 'avtomobil' END AS kind FROM conversations")
def kind_guess(spark, d):
    return classify.guess_kind(t(spark, d, "conversations"), "text").select("conv_id", "turn", "kind")


@query("SELECT doc_id FROM documents WHERE length(text) >= 200")
def usable_pages(spark, d):
    return classify.usable_pages(t(spark, d, "documents"), "text").select("doc_id")


@query("SELECT p_partkey FROM part WHERE p_type IN ('ECONOMY', 'SMALL') AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') ORDER BY p_partkey LIMIT 50")
def scope_filter(spark, d):
    part = t(spark, d, "part").select(F.col("p_partkey").alias("pos"), F.col("p_type").alias("type"), F.col("p_brand").alias("category"))
    return classify.in_scope(part, ["ECONOMY", "SMALL"], ["Brand#1", "Brand#2", "Brand#3"], limit=50).select(F.col("pos").alias("p_partkey"))


@query(f"""WITH s AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 4 IN (1, 3) THEN ['SAT', 'IELTS'] END AS categories, CASE WHEN n_nationkey % 4 IN (2, 3) THEN ['SCHOOL', 'LYCEUM', 'TUTORING'] END AS types, CASE n_nationkey % 3 WHEN 1 THEN ['Bukhara', 'Karshi', n_name] WHEN 2 THEN [n_name] END AS regions FROM nation),
f AS (SELECT k, regions, unnest(CASE WHEN categories IS NOT NULL THEN categories WHEN types IS NOT NULL THEN [NULL] ELSE [{sql_list(fixed.CATEGORIES)}] END) AS category, types FROM s),
g AS (SELECT k, regions, category, unnest(CASE WHEN types IS NULL THEN [NULL] ELSE types END) AS type FROM f), c AS (SELECT unnest([{sql_list([c[2] for c in fixed.CITIES])}]) AS city)
SELECT k, category, type, city FROM g, c WHERE k % 3 <> 1 OR city IN ('Bukhara', 'Karshi')""")
def search_plan(spark, d):
    k = F.col("n_nationkey")
    scopes = t(spark, d, "nation").select(k.alias("k"), F.when(k % 4 % 2 == 1, X.texts(["SAT", "IELTS"])).alias("categories"), F.when(k % 4 >= 2, X.texts(["SCHOOL", "LYCEUM", "TUTORING"])).alias("types"), F.when(k % 3 == 1, F.array(F.lit("Bukhara"), F.lit("Karshi"), F.col("n_name"))).when(k % 3 == 2, F.array("n_name")).alias("regions"))
    return resolve.search_plan(scopes).select("k", "category", "type", "city")


@query(f"SELECT 'threshold' AS kind, unnest(['APPROVED', 'APPROVED_WITH_WARNINGS', 'NEEDS_REVIEW', 'REJECTED']) AS name, unnest([85, 70, 50, 0])::VARCHAR AS value UNION ALL SELECT 'weight', unnest(['sourceConfidence', 'dataCompleteness']), '0.5' UNION ALL SELECT 'priority', unnest([{sql_list(fixed.DEFAULT_CATEGORIES)}]), unnest([0, 1, 2, 3])::VARCHAR UNION ALL SELECT 'city', unnest([{sql_list([c[2] for c in fixed.CITIES])}]), '1' UNION ALL SELECT 'enum type', unnest([{sql_list(fixed.TYPES)}]), unnest([0, 1, 2, 3, 4])::VARCHAR")
def dims(spark, d):
    tables = resolve.load_dims(spark)
    rows = lambda name, kind, a, b: tables[name].select(F.lit(kind).alias("kind"), F.col(a).alias("name"), F.col(b).cast("string").alias("value"))
    cities = tables["cities"].select(F.lit("city").alias("kind"), F.col("city").alias("name"), F.lit("1").alias("value")).distinct()
    enum = tables["enums"].where("kind = 'type'").select(F.lit("enum type").alias("kind"), F.col("value").alias("name"), F.col("pos").cast("string").alias("value"))
    return rows("thresholds", "threshold", "band", "least").union(rows("weights", "weight", "score", "weight")).union(rows("priorities", "priority", "category", "pos")).union(cities).union(enum)


@query(f"SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'LYCEUM' ELSE {q_labels('x', fixed.TYPE_KEYWORDS)}[1] END AS type, CASE WHEN doc_id % 5 = 0 THEN ['CEFR'] ELSE {q_labels('x', fixed.CATEGORY_KEYWORDS)} END AS categories FROM (SELECT *, CASE doc_id % 3 WHEN 0 THEN 'Repetitor ' WHEN 1 THEN 'IELTS kurslar ' ELSE '' END || text AS x FROM documents)")
def infer_labels(spark, d):
    k = F.col("doc_id")
    docs = t(spark, d, "documents").select("doc_id", F.when(k % 3 == 0, "Repetitor").when(k % 3 == 1, "IELTS kurslar").alias("a"), F.col("text").alias("b"), F.when(k % 4 == 0, "LYCEUM").alias("type"), F.when(k % 5 == 0, F.array(F.lit("CEFR"))).alias("categories"))
    return classify.infer_labels(docs, ["a", "b"]).select("doc_id", "type", "categories")


PAGE_KEYS = f"SELECT page_id, {q_host('url')} AS host, {q_key(TITLE)} AS title FROM pages"
DUPLICATES = f"""WITH RECURSIVE p AS ({PAGE_KEYS}), k AS (SELECT page_id, 'h' || host AS k FROM p WHERE host <> '' UNION ALL SELECT page_id, 't' || title FROM p WHERE title <> ''),
w AS (SELECT DISTINCT a.page_id AS a, b.page_id AS b, CASE a.k[1] WHEN 'h' THEN 'domain' ELSE 'name' END AS reason FROM k a JOIN (SELECT k, min(page_id) AS page_id FROM k GROUP BY k) b USING (k)), e AS (SELECT DISTINCT a, b FROM w), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT page_id AS id, page_id AS root FROM p UNION SELECT u.b, r.root FROM r JOIN u ON r.id = u.a), m AS (SELECT id, list_sort(list_distinct(list(reason))) AS reasons FROM (SELECT a AS id, reason FROM w WHERE a <> b UNION ALL SELECT b, reason FROM w WHERE a <> b) GROUP BY id),
f AS (SELECT id, min(root) AS kept_id, any_value(reasons) AS reasons FROM r LEFT JOIN m USING (id) GROUP BY id)"""


def resolved_pages(spark, d) -> DataFrame:
    p = t(spark, d, "pages").select("page_id", X.domain(F.col("url")).alias("host"), X.name_key(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))
    return resolve.resolve_duplicates(p, "page_id", {"domain": "host", "name": "title"})


@query(f"{DUPLICATES} SELECT id, kept_id, array_to_string(reasons, ', ') AS reason FROM f")
def resolve_duplicates(spark, d):
    return resolved_pages(spark, d)


@query(f"{DUPLICATES} SELECT kept_id, list_sort(list(id) FILTER (id <> kept_id)) AS merged_ids, array_to_string(list_sort(list_distinct(flatten(list(reasons)))), ', ') AS reason FROM f GROUP BY kept_id HAVING count(*) > 1")
def duplicate_groups(spark, d):
    return resolve.duplicate_groups(resolved_pages(spark, d))


@query("SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source")
def keep_first(spark, d):
    return evidence.first_by(t(spark, d, "documents").select("source", "doc_id", "lang"), ["source"], "doc_id").select("source", "doc_id")


@query("WITH n AS (SELECT p_name || ' ' || p_brand || ' ' || p_type AS name, min(p_partkey) AS id FROM part GROUP BY name) SELECT a.id AS a, b.id AS b, round(levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name)), 6) AS distance FROM n a JOIN n b ON a.id < b.id WHERE levenshtein(a.name, b.name) <= 0.1 * greatest(length(a.name), length(b.name))")
def ambiguous_pairs(spark, d):
    return resolve.ambiguous_pairs(t(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("name")), "p_partkey", "name", 0.1)


@query("WITH x AS (SELECT max(event_id) / 2 AS m FROM events), old AS (SELECT user_id AS entity_id, event_type AS source_url, min(event_id) AS seq FROM events, x WHERE event_id < m GROUP BY ALL), new AS (SELECT user_id AS entity_id, event_type AS source_url, min(event_id) AS seq FROM events, x WHERE event_id >= m GROUP BY ALL) SELECT * FROM old UNION ALL SELECT * FROM new ANTI JOIN old USING (entity_id, source_url)")
def evidence_append(spark, d):
    e = t(spark, d, "events").select(F.col("user_id").alias("entity_id"), F.col("event_type").alias("source_url"), F.col("event_id").alias("seq"))
    middle = e.agg((F.max("seq") / 2).alias("m"))
    both = e.crossJoin(F.broadcast(middle))
    old = evidence.first_by(both.where("seq < m").drop("m"), ["entity_id", "source_url"], "seq")
    return evidence.append_evidence(old, both.where("seq >= m").drop("m"))


@query("WITH e AS (SELECT user_id, event_id, (event_id % 1000)::VARCHAR AS address, 'x' || (floor(value)::INTEGER % 50) AS website FROM events), a AS (SELECT user_id, address, count(*) AS n FROM e GROUP BY ALL), w AS (SELECT user_id, website, count(*) AS n FROM e GROUP BY ALL) SELECT e.user_id, event_id, (CASE WHEN a.n > 1 THEN 1 ELSE 0 END + CASE WHEN w.n > 1 THEN 1 ELSE 0 END)::BIGINT AS corroborated FROM e JOIN a USING (user_id, address) JOIN w ON w.user_id = e.user_id AND w.website = e.website")
def corroboration(spark, d):
    e = t(spark, d, "events").select("user_id", "event_id", F.lit(None).cast("string").alias("phone"), F.concat(F.lit("https://www.X"), (F.floor("value").cast("int") % 50).cast("string"), F.lit("/")).alias("website"), (F.col("event_id") % 1000).cast("string").alias("address"))
    return evidence.corroborated(e, "user_id", "event_id")


ITEMS = "SELECT user_id, event_id AS seq, CASE WHEN event_type <> 'error' THEN event_type END AS kind, CASE WHEN event_id % 3 > 0 THEN props END AS props, value AS confidence FROM events"


@query(f"SELECT user_id, arg_max(kind, (confidence, seq)) FILTER (kind IS NOT NULL) AS kind, arg_max(props, (confidence, seq)) FILTER (props IS NOT NULL) AS props, count(*) AS evidence_count, max(confidence) AS best_confidence FROM ({ITEMS}) GROUP BY user_id")
def evidence_merge_scalar(spark, d):
    e = t(spark, d, "events").select("user_id", F.col("event_id").alias("seq"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"), F.when(F.col("event_id") % 3 > 0, F.col("props")).alias("props"), F.col("value").alias("confidence"))
    return evidence.merge_scalars(e, "user_id", ["kind", "props"])


@query("WITH e AS (SELECT user_id, value AS confidence, event_id AS seq, unnest([event_type, CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE 'x' END]) AS item, unnest([0, 1]) AS place FROM events), f AS (SELECT user_id, lower(item) AS k, min((confidence, seq, place, item)) AS x FROM e GROUP BY ALL) SELECT user_id, list_transform(list_sort(list(x)), lambda s: s[4]) AS items FROM f GROUP BY user_id")
def evidence_merge_list(spark, d):
    items = F.array("event_type", F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise("x"))
    e = t(spark, d, "events").select("user_id", F.col("value").alias("confidence"), F.col("event_id").alias("seq"), items.alias("items"))
    return evidence.merge_lists(e, "user_id", "items")


@query("SELECT event_id, least(0.95, greatest(0.30, round(CASE event_type WHEN 'view' THEN 0.72 WHEN 'click' THEN 0.62 WHEN 'purchase' THEN 0.58 WHEN 'signup' THEN 0.55 ELSE 0.5 END + (CASE WHEN value > 5 THEN 1 ELSE 0 END + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END) / 6.0 * 0.18 + least(event_id % 4 * 0.05, 0.10), 4)))::DOUBLE AS confidence FROM events")
def item_confidence(spark, d):
    kind = F.when(F.col("event_type") == "view", "website").when(F.col("event_type") == "click", "directory").when(F.col("event_type") == "purchase", "search").when(F.col("event_type") == "signup", "social").otherwise("other")
    e = t(spark, d, "events").select("event_id", kind.alias("source_kind"), (F.col("event_id") % 4).alias("corroborated"), F.when(F.col("value") > 5, "x").otherwise(" ").alias("phone"), F.when(F.col("event_id") % 2 == 0, F.array(F.lit("x"))).alias("programs"))
    return evidence.with_item_confidence(e).select("event_id", "confidence")


COMPLETE = "SELECT c_custkey, round((1 + CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END + CASE WHEN n > 0 THEN 1 ELSE 0 END) / 7 * 80 + CASE WHEN n > 10 THEN 1 ELSE 0 END / 9 * 20)::INTEGER AS completeness, coalesce(n, 0) AS n, c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey"


def enriched(spark, d) -> DataFrame:
    orders = t(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    c = t(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return c.select("c_custkey", F.col("c_name").alias("nameUz"), F.when(F.col("c_acctbal") > 0, "1").alias("phone"), F.when(F.col("n") > 0, F.array(F.lit("SAT"))).alias("categories"), F.when(F.col("n") > 10, F.col("n").cast("int")).alias("studentCount"), F.col("n").alias("evidence_count"), F.round(F.abs("c_acctbal") / 10000, 2).alias("best_confidence"))


@query(f"SELECT c_custkey, completeness FROM ({COMPLETE})")
def completeness(spark, d):
    return evidence.with_completeness(enriched(spark, d)).select("c_custkey", "completeness")


#: Halves go up in the decimal number: cents of the balance are whole numbers, as doubles such as 2850 / 10000 are below their half.
CENTS = "round(abs(c_acctbal) * 100)::BIGINT"
CONFIDENCE = f"SELECT *, ((({CENTS} + 5000) // 10000 * 7 + least(n, 3) * 100 + 5) // 10)::INTEGER AS source_confidence FROM ({COMPLETE})"


@query(f"SELECT c_custkey, source_confidence FROM ({CONFIDENCE})")
def source_confidence(spark, d):
    return evidence.with_source_confidence(enriched(spark, d)).select("c_custkey", "source_confidence")


BAND = f"SELECT *, CASE WHEN q >= 85 THEN 'APPROVED' WHEN q >= 70 THEN 'APPROVED_WITH_WARNINGS' WHEN q >= 50 THEN 'NEEDS_REVIEW' ELSE 'REJECTED' END AS band FROM (SELECT *, round(0.5 * source_confidence + 0.5 * completeness)::INTEGER AS q FROM ({CONFIDENCE}))"


def scored(spark, d) -> DataFrame:
    return evidence.with_quality(evidence.with_source_confidence(evidence.with_completeness(enriched(spark, d))))


@query(f"SELECT c_custkey, q AS quality, band FROM ({BAND})")
def quality_band(spark, d):
    return scored(spark, d).select("c_custkey", "quality", "band")


@query(f"SELECT c_custkey, q AS quality FROM ({BAND}) ORDER BY q DESC, c_custkey LIMIT 25")
def top_quality(spark, d):
    return evidence.top_by(scored(spark, d), "quality", "c_custkey", 25).select("c_custkey", "quality")


@query("SELECT o_custkey, o_orderkey, rank::INTEGER AS rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 4")
def n_per_group(spark, d):
    return evidence.n_per_group(t(spark, d, "orders"), "o_custkey", [F.col("o_totalprice").desc(), "o_orderkey"], 4).select("o_custkey", "o_orderkey", "rank")


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 20")
def first_n(spark, d):
    return t(spark, d, "documents").orderBy("doc_id").limit(20).select("doc_id", "lang")


@query("SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
def attach_evidence(spark, d):
    return resolve.attach_evidence(t(spark, d, "customer"), t(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey").select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN c_name ELSE o_orderpriority END AS name, coalesce(CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END, c_mktsegment, 'OFFLINE') AS mode FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def fill_from_candidate(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("id"), F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise(F.col("o_orderpriority")).alias("name"), F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderstatus")).alias("mode"))
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("mode"))
    return resolve.fill_from_candidate(o, c, "id", ["name", "mode"], {"mode": "OFFLINE"}).select("o_orderkey", "name", "mode")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def pending_only(spark, d):
    states = t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "APPROVED").otherwise("VERIFIED").alias("state"))
    return state.pending(t(spark, d, "customer").select("c_custkey"), states, "c_custkey")


@query("SELECT DISTINCT user_id, props FROM events WHERE event_type = 'view' AND (user_id, props) NOT IN (SELECT (user_id, props) FROM events WHERE event_type = 'error')")
def new_only(spark, d):
    e = t(spark, d, "events").select("user_id", "props", "event_type")
    return resolve.new_only(e.where("event_type = 'view'").select("user_id", "props"), e.where("event_type = 'error'"), "user_id", "props").distinct()


@query("SELECT page_id FROM pages WHERE sha256(url) NOT IN (SELECT sha256(url) FROM pages WHERE starts_with(url, 'http:'))")
def to_fetch(spark, d):
    p = t(spark, d, "pages").select("page_id", "url", F.sha2("url", 256).alias("key"))
    return resolve.new_only(p, p.where(F.col("url").startswith("http:")), "key").select("page_id")


@query("SELECT s_suppkey FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)")
def unknown_ids(spark, d):
    return resolve.unknown_ids(t(spark, d, "supplier"), "s_nationkey", t(spark, d, "nation").where("n_regionkey < 3"), "n_nationkey").select("s_suppkey")


@query("SELECT page_id, p_brand AS bucket_name FROM (SELECT page_id, CASE WHEN 'Brand#' || (page_id % 40) IN (SELECT p_brand FROM part) THEN 'Brand#' || (page_id % 40) ELSE 'Brand#1' END AS b FROM pages) JOIN (SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS pos FROM part) ON b = p_brand WHERE pos <= 2")
def bucket_lookup(spark, d):
    queries = t(spark, d, "pages").select("page_id", F.concat(F.lit("Brand#"), (F.col("page_id") % 40).cast("string")).alias("p_brand"), F.lit(2).alias("count"))
    rows = evidence.n_per_group(t(spark, d, "part").select("p_brand", "p_partkey"), "p_brand", ["p_partkey"], 2).withColumnRenamed("rank", "pos")
    return resolve.bucket_lookup(queries, rows, "p_brand", "Brand#1", "count").select("page_id", F.col("bucket").alias("bucket_name"))


CITY, REGION = fixed.CITIES[0][:2]


@query(f"""SELECT s_suppkey, list_filter([CASE WHEN k % 5 = 0 THEN 'could not resolve city "' || n_name || '"' END, CASE WHEN k % 3 = 0 THEN 'invalid phone "123": unrecognized phone format' END, CASE WHEN k % 7 = 0 AND k % 14 > 0 THEN 'no nameUz/nameLatin available' END, CASE WHEN k % 14 = 0 THEN 'looks like a medical organization (matched "clinic" in "Neo Clinic")' END], lambda x: x IS NOT NULL) AS build_errors,
CASE WHEN ok THEN {q_record_id("'e' || k")} END AS id, CASE WHEN ok THEN s_name END AS "nameUz", CASE WHEN ok THEN CASE WHEN k % 2 = 0 THEN 'Имя' ELSE s_name END END AS "nameRu", CASE WHEN ok THEN {q_key('s_name')} END AS "nameKey", CASE WHEN ok THEN {q_slug("s_name || ' ' || n_name")} END AS slug, CASE WHEN ok THEN 'COURSE_CENTER' END AS type, CASE WHEN ok THEN 'PENDING' END AS status,
CASE WHEN ok AND k % 3 = 1 THEN '+99890' || lpad(k::VARCHAR, 7, '0') END AS phone, CASE WHEN ok THEN 'https://site' || k || '.uz' END AS website, CASE WHEN ok AND k % 2 = 0 THEN 'a@b.uz' END AS email, CASE WHEN ok AND k % 2 = 0 THEN '{CITY}' END AS "cityId", CASE WHEN ok THEN '{REGION}' END AS "regionId", CASE WHEN ok THEN 'Main st. ' || k END AS address, CASE WHEN ok THEN k / 10 END AS lat, CASE WHEN ok THEN k / 5 END AS lng, CASE WHEN ok THEN '90 1,91 2' END AS phone2, CASE WHEN ok THEN '@t' || k END AS telegram, CASE WHEN ok AND k % 2 = 1 THEN '@i' END AS instagram, CASE WHEN ok THEN ['SCHOOL'] END AS "additionalTypes", CASE WHEN ok THEN false END AS "trialLessonEnabled",
CASE WHEN ok THEN k END::INTEGER AS "studentCount", CASE WHEN ok AND k % 2 = 0 THEN 7 END::INTEGER AS "teacherCount", CASE WHEN ok THEN []::VARCHAR[] END AS shifts, CASE WHEN ok THEN ['Physics'] END AS specializations, CASE WHEN ok THEN 'won' END AS achievements, CASE WHEN ok AND k % 4 = 0 THEN 'y' END AS "descriptionRu", CASE WHEN ok THEN 0 END::INTEGER AS n_media, CASE WHEN ok THEN true END AS no_pricing,
CASE WHEN ok THEN 'HYBRID' END AS "deliveryMode", CASE WHEN ok THEN ['en'] END AS languages, CASE WHEN ok THEN CASE WHEN k % 4 > 0 THEN ['SAT'] ELSE []::VARCHAR[] END END AS categories, CASE WHEN ok THEN ['Kids'] END AS programs, CASE WHEN ok THEN 1990 + k % 30 END::INTEGER AS "foundedYear", CASE WHEN ok THEN 'x' END AS "descriptionUz", CASE WHEN ok THEN false END AS "isVerified", CASE WHEN ok THEN 0 END::INTEGER AS n_branches
FROM (SELECT *, s_suppkey AS k, s_suppkey % 5 > 0 AND s_suppkey % 3 > 0 AND s_suppkey % 7 > 0 AS ok FROM supplier JOIN nation ON s_nationkey = n_nationkey)""")
def build_records(spark, d):
    k = F.col("s_suppkey")
    s = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    built = records.build_records(s.select(
        "s_suppkey", F.concat(F.lit("e"), k.cast("string")).alias("entity_id"), F.when(k % 7 > 0, F.col("s_name")).alias("nameUz"), F.when(k % 2 == 0, "Имя").alias("nameRu"), F.when(k % 14 == 0, "Neo Clinic").alias("nameLatin"), F.col("n_name").alias("city"), (k % 5 > 0).alias("city_known"),
        F.when(k % 3 == 0, "123").when(k % 3 == 1, F.concat(F.lit("90"), F.lpad(k.cast("string"), 7, "0"))).alias("phone"), F.concat(F.lit("Site"), k.cast("string"), F.lit(".UZ/")).alias("website"), F.when(k % 2 == 0, "a@b.uz").alias("email"), F.when(k % 2 == 0, CITY).alias("cityId"), F.lit(REGION).alias("regionId"),
        F.concat(F.lit("Main st. "), k.cast("string")).alias("address"), (k / 10).alias("lat"), (k / 5).alias("lng"), F.lit(" 90 1,91 2 ").alias("phone2"), F.concat(F.lit("@t"), k.cast("string")).alias("telegram"), F.when(k % 2 == 1, "@i").alias("instagram"), F.array(F.lit("SCHOOL")).alias("additionalTypes"),
        k.cast("int").alias("studentCount"), F.when(k % 2 == 0, 7).alias("teacherCount"), F.array(F.lit("Physics")).alias("specializations"), F.lit("won").alias("achievements"), F.when(k % 4 == 0, "y").alias("descriptionRu"), F.lit("HYBRID").alias("deliveryMode"), F.array(F.lit("English")).alias("languages"), F.when(k % 4 > 0, F.array(F.lit("SAT"))).alias("categories"), F.array(F.lit("Kids")).alias("programs"), (1990 + k % 30).cast("int").alias("foundedYear"), F.lit("x").alias("descriptionUz"),
    ))
    own = "id nameUz nameRu nameKey slug type additionalTypes status phone phone2 website email telegram instagram cityId regionId address lat lng deliveryMode isVerified trialLessonEnabled".split()
    details = "languages categories programs shifts specializations achievements foundedYear studentCount teacherCount descriptionUz descriptionRu".split()
    empty = [F.when(F.col("record").isNotNull(), F.size(f"record.{c}")).alias(f"n_{c}") for c in ("branches", "media")]
    return built.select("s_suppkey", "build_errors", *[f"record.{c}" for c in own], *[f"record.details.{c}" for c in details], *empty, F.when(F.col("record").isNotNull(), F.col("record.pricing").isNull()).alias("no_pricing"))


def batch(spark, d) -> DataFrame:
    """Records of which each breaks some of the rules, by its key."""
    k = F.col("s_suppkey")
    when = lambda m, r, bad, good: F.when(k % m == r, bad).otherwise(good)
    one = lambda *x: F.array(*[F.lit(v) for v in x])
    return t(spark, d, "supplier").select(
        "s_suppkey", when(43, 12, F.lit(""), F.lit("c1")).alias("id"), when(13, 2, F.lit("Same"), F.col("s_name")).alias("nameUz"), when(41, 11, F.lit(""), F.lit("Имя")).alias("nameRu"), when(47, 13, F.lit(""), F.lit("key")).alias("nameKey"),
        F.when(k % 11 == 1, "same").when(k % 17 == 3, "Bad Slug").otherwise(F.concat(F.lit("s-"), k.cast("string"))).alias("slug"), when(13, 4, F.lit("SHOP"), F.lit("SCHOOL")).alias("type"), when(19, 5, one("SCHOOL", "SHOP"), one("SCHOOL")).alias("additionalTypes"), when(23, 6, F.lit("GONE"), F.lit("ACTIVE")).alias("status"),
        when(5, 1, F.lit("nobody"), F.lit("a@b.uz")).alias("email"), when(29, 7, F.lit("ftp://x"), F.lit("https://x")).alias("website"), F.when(k % 31 == 8, "POST").when(k % 31 == 9, "ONLINE").otherwise("OFFLINE").alias("deliveryMode"), when(37, 10, F.lit(1990.5), F.lit(1990.0)).alias("foundedYear"),
        F.when(k % 6 == 1, one("en", "xx1")).when(k % 6 == 2, one("fr")).otherwise(one("en")).alias("languages"), F.when(k % 4 == 0, one().cast("array<string>")).when(k % 8 == 3, one("XYZ")).otherwise(one("SAT")).alias("categories"), F.when(k % 3 == 1, "nowhere").when(k % 3 == 2, CITY).alias("cityId"),
        when(9, 2, F.lit("nowhere"), F.lit(REGION)).alias("regionId"), when(7, 2, F.lit("90 12"), F.lit("+998901234567")).alias("phone"), F.lit("").alias("descriptionUz"), F.when(k % 2 == 0, "x").alias("descriptionRu"),
    )


def _told(*rules: tuple[str, str]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {when} THEN '{name}' END" for when, name in rules) + "], lambda x: x IS NOT NULL)"


REASONS = _told(
    ("k % 43 = 12", "id: too short"), ("k % 41 = 11", "nameRu: too short"), ("k % 47 = 13", "nameKey: too short"), ("k % 17 = 3 AND k % 11 <> 1", 'slug: slug must be url-safe kebab-case ("Bad Slug")'), ("k % 13 = 4", 'type: not in enum ("SHOP")'), ("k % 19 = 5", 'additionalTypes: not in enum ("SHOP")'), ("k % 23 = 6", 'status: not in enum ("GONE")'),
    ("k % 5 = 1", 'email: not an address ("nobody")'), ("k % 29 = 7", 'website: not a url ("ftp://x")'), ("k % 31 = 8", 'deliveryMode: not in enum ("POST")'), ("k % 37 = 10", 'foundedYear: not an integer ("1990.5")'), ("k % 6 = 1", 'languages: not a lower-case code ("xx1")'), ("k % 8 = 3", 'categories: not in enum ("XYZ")'), ("k % 3 = 1", 'cityId: not a known city ("nowhere")'),
    ("k % 9 = 2", 'regionId: not a known region ("nowhere")'), ("k % 7 = 2", 'phone is not normalized ("90 12")'), ("k % 31 = 9", "deliveryMode ONLINE is flagged for review"), ("k % 6 = 1", 'languages contain codes not yet observed ("xx1")'), ("k % 6 = 2", 'languages contain codes not yet observed ("fr")'), ("k % 4 = 0", "categories must be non-empty"), ("k % 2 = 1", "both descriptions are null"),
)
OWN = f"SELECT *, s_suppkey AS k, {REASONS.replace('k %', 's_suppkey %')} AS own FROM supplier"
BATCH = f"""SELECT s_suppkey, own || list_filter([CASE WHEN count(*) OVER (PARTITION BY slug) > 1 THEN 'slug "' || slug || '" is not unique across the batch' END, CASE WHEN count(*) OVER (PARTITION BY name, k % 3) > 1 THEN 'duplicate name and city in the batch' END], lambda x: x IS NOT NULL) AS reasons
FROM (SELECT *, CASE WHEN k % 11 = 1 THEN 'same' WHEN k % 17 = 3 THEN 'Bad Slug' ELSE 's-' || k END AS slug, CASE WHEN k % 13 = 2 THEN 'Same' ELSE s_name END AS name FROM ({OWN}))"""


@query(f"SELECT s_suppkey, own AS reasons, len(own) = 0 AS valid FROM ({OWN})")
def validate_records(spark, d):
    return records.validate_records(batch(spark, d)).select("s_suppkey", "reasons", "valid")


@query(f"SELECT s_suppkey, reasons, len(reasons) = 0 AS valid FROM ({BATCH})")
def validate_batch(spark, d):
    return records.validate_batch(batch(spark, d)).select("s_suppkey", "reasons", "valid")


@query(f"SELECT s_suppkey, CASE WHEN len(reasons) = 0 THEN 'export' ELSE 'NEEDS_REVIEW' END AS state, CASE WHEN len(reasons) > 0 THEN array_to_string(reasons, '; ') END AS last_error, CASE WHEN len(reasons) > 0 THEN 'failed final pre-export batch validation: ' || array_to_string(reasons, '; ') END AS note FROM ({BATCH})")
def finalize(spark, d):
    kept, demoted, log = records.finalize(batch(spark, d), "s_suppkey", "2024-01-01 00:00:00")
    null = F.lit(None).cast("string")
    return kept.select("s_suppkey", F.lit("export").alias("state"), null.alias("last_error"), null.alias("note")).union(demoted.join(log.select("s_suppkey", "note"), "s_suppkey").select("s_suppkey", "state", "last_error", "note"))


@query(f"SELECT regexp_replace(reason, ' \\(\".*\"\\)$', '') AS reason, count(*) AS n FROM (SELECT unnest(CASE WHEN len(own) = 0 THEN ['valid'] ELSE own END) AS reason FROM ({OWN})) GROUP BY ALL")
def validation_summary(spark, d):
    return records.validation_summary(records.validate_records(batch(spark, d)))


@query(f"SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'NEEDS_REVIEW' WHEN band = 'REJECTED' THEN 'REJECTED' WHEN band = 'NEEDS_REVIEW' OR c_custkey % 5 = 0 THEN 'NEEDS_REVIEW' ELSE 'APPROVED' END AS outcome FROM ({BAND})")
def route(spark, d):
    k, none = F.col("c_custkey"), F.array().cast("array<string>")
    s = scored(spark, d).withColumns({"build_errors": F.when(k % 9 == 0, F.array(F.lit("x"))).otherwise(none), "reasons": F.when(k % 5 == 0, F.array(F.lit("y"))).otherwise(none)})
    return records.route(s).select("c_custkey", "outcome")


STATE_SQL = "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'JSON_READY' WHEN o_orderstatus = 'F' THEN 'APPROVED' WHEN o_orderstatus = 'O' THEN 'REJECTED' ELSE 'NEEDS_REVIEW' END AS state, CASE WHEN o_orderkey % 4 = 0 THEN 'duplicate' END AS last_error, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 100 END AS completeness, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 51 END AS source_confidence FROM orders"


def order_states(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    s = F.when(k % 7 == 0, "JSON_READY").when(F.col("o_orderstatus") == "F", "APPROVED").when(F.col("o_orderstatus") == "O", "REJECTED").otherwise("NEEDS_REVIEW")
    return t(spark, d, "orders").select(k.alias("id"), s.alias("state"), F.when(k % 4 == 0, "duplicate").alias("last_error"), F.when(k % 3 > 0, k % 100).alias("completeness"), F.when(k % 3 > 0, k % 51).alias("source_confidence"))


COUNTS = "count(CASE WHEN state = 'APPROVED' THEN 1 END) AS approved, count(CASE WHEN state = 'NEEDS_REVIEW' THEN 1 END) AS review, count(CASE WHEN state = 'REJECTED' AND last_error IS NULL THEN 1 END) AS rejected, count(CASE WHEN last_error = 'duplicate' THEN 1 END) AS duplicates"


@query(f"SELECT count(*) AS discovered, count(CASE WHEN state IN ('JSON_READY', 'APPROVED', 'NEEDS_REVIEW') THEN 1 END) AS processed, {COUNTS}, floor(avg(completeness) + 0.5)::INTEGER AS mean_completeness, floor(avg(source_confidence) + 0.5)::INTEGER AS mean_confidence, '{{\"types\":null}}' AS scope FROM ({STATE_SQL})".replace('\\"', '"'))
def run_report(spark, d):
    return records.run_report(order_states(spark, d), '{"types":null}', "2024-01-01 00:00:00").drop("generated_at")


@query(f"SELECT *, greatest(0, 10000 - approved) AS shortfall, approved < 10000 AS exhausted FROM (SELECT {COUNTS} FROM ({STATE_SQL}))")
def run_summary(spark, d):
    return records.run_summary(order_states(spark, d), 10_000)


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def by_source(spark, d):
    return records.by_source(t(spark, d, "documents"))


@query(f"SELECT s.id, coalesce(CASE WHEN s.id % 2 = 0 THEN 'r' || s.id END, 'c' || s.id) AS name, CASE state WHEN 'APPROVED' THEN 'approved' WHEN 'REJECTED' THEN 'rejected' WHEN 'NEEDS_REVIEW' THEN 'review' ELSE 'in progress' END AS status, completeness AS quality, 'src' AS source FROM ({STATE_SQL}) s")
def result_rows(spark, d):
    s = order_states(spark, d).withColumnRenamed("completeness", "quality")
    r = s.where("id % 2 = 0").select("id", F.concat(F.lit("r"), F.col("id").cast("string")).alias("name"))
    c = s.select("id", F.concat(F.lit("c"), F.col("id").cast("string")).alias("name"), F.lit("src").alias("source"))
    return records.result_rows(s, r, c, "id")


@query(f"SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN ({STATE_SQL}) s ON o_orderkey = s.id WHERE s.state = 'APPROVED'")
def approved_records(spark, d):
    rows = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("id"), "c_name")
    return resolve.approved_records(order_states(spark, d), rows, "id").select(F.col("id").alias("o_orderkey"), "c_name")


HTML = r"trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g'))"


@query(f"SELECT page_id, {HTML}[:20000] AS text FROM pages")
def html_to_text(spark, d):
    return pages.pages_to_text(t(spark, d, "pages")).select("page_id", "text")


@query(r"""WITH n AS (SELECT page_id, regexp_extract(url, '^https?://[^/?#]*') AS origin, unnest(regexp_extract_all(array_to_string(regexp_extract_all(html, '(?is)<nav\b[^>]*>(.*?)</nav>', 1), ' '), '(?is)<a\b[^>]*href\s*=\s*["'']([^"'']+)["''][^>]*>.*?</a>', 1)) AS href FROM pages)
SELECT DISTINCT page_id, origin || href AS link FROM n WHERE contains(lower(href), 'th') OR contains(lower(href), 'de')""")
def link_extract(spark, d):
    return pages.course_links(t(spark, d, "pages"), ["th", "de"])


def q_decode(c: str) -> str:
    for a, b in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#039;", "''")):
        c = f"replace({c}, '{a}', '{b}')"
    return c


def q_clean(c: str) -> str:
    s = q_decode(f"regexp_replace(regexp_replace({c}, '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]+>', ' ', 'g')")
    return f"nullif(array_to_string(list_filter(list_transform(string_split(regexp_replace({s}, '[ \\t]+', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10)), '')"


#: Pages with what only directories have, by page_id.
DIRECTORY = """SELECT page_id, url, CASE WHEN page_id % 3 = 0 THEN replace(html, '<nav>', '<nav><a href="/x">IELTS &amp; kurs</a>') ELSE html END || CASE WHEN page_id % 2 = 0 THEN '<address>City ' || page_id % 9 || ', <b>Main</b> st.</address><a href="tel:+998 (90) ' || page_id || '7">call</a>' ELSE '' END
|| CASE WHEN page_id % 5 = 0 THEN replace('#LAT#:#41.5# #LON#:#69.25#', '#', chr(39)) ELSE '' END || CASE WHEN page_id % 4 = 0 THEN '<a class="x" href="https://t.me/a">Other</a><a href="https://t.me/b' || page_id || '"> Telegram </a><a href="http://w">WEBSITE</a><a href="http://f/' || page_id || '">Facebook</a><a href="http://i">instagram</a>' ELSE '' END AS html FROM pages"""


def directory(spark, d) -> DataFrame:
    k, html = F.col("page_id"), F.col("html")
    some = lambda m, *parts: F.when(k % m == 0, F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])).otherwise("")
    html = F.concat(
        F.when(k % 3 == 0, F.replace(html, F.lit("<nav>"), F.lit('<nav><a href="/x">IELTS &amp; kurs</a>'))).otherwise(html),
        some(2, "<address>City ", (k % 9).cast("string"), ', <b>Main</b> st.</address><a href="tel:+998 (90) ', k.cast("string"), '7">call</a>'),
        some(5, "'LAT':'41.5' 'LON':'69.25'"),
        some(4, '<a class="x" href="https://t.me/a">Other</a><a href="https://t.me/b', k.cast("string"), '"> Telegram </a><a href="http://w">WEBSITE</a><a href="http://f/', k.cast("string"), '">Facebook</a><a href="http://i">instagram</a>'),
    )
    return t(spark, d, "pages").select("page_id", "url", html.alias("html"))


NAV = "regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1)"
LABELS = f"""list_filter(list_transform(regexp_extract_all({NAV}, '<a href="[^"]*">([^<]+)</a>', 1), lambda x: trim({q_decode("x")})), lambda x: x <> '')"""
FACTS = f"""SELECT page_id, url, {q_clean("regexp_extract(html, '(?s)<h1[^>]*>\\s*([^<]+?)\\s*</h1>', 1)")} AS name, CASE WHEN page_id % 2 = 0 THEN 'City ' || page_id % 9 || ', Main st.' END AS address, CASE WHEN page_id % 2 = 0 THEN 'City ' || page_id % 9 END AS city, CASE WHEN page_id % 2 = 0 THEN '+99890' || page_id || '7' END AS phone, CASE WHEN page_id % 5 = 0 THEN 41.5::DOUBLE END AS lat, CASE WHEN page_id % 5 = 0 THEN 69.25::DOUBLE END AS lng,
{q_clean("regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1)")} AS "descriptionSourceText", CASE WHEN page_id % 4 = 0 THEN 'https://t.me/b' || page_id END AS telegram, CASE WHEN page_id % 4 = 0 THEN 'http://w' END AS website, CASE WHEN page_id % 4 = 0 THEN 'http://f/' || page_id END AS facebook, CASE WHEN page_id % 4 = 0 THEN 'http://i' END AS instagram, {LABELS} AS "categoryLabels",
list_transform(regexp_extract_all({NAV}, '<a\\s+href="([^"]+)"', 1), lambda x: regexp_extract(url, '^https?://[^/?#]*') || {q_decode("x")}) AS "nearbyUrls" FROM ({DIRECTORY})"""
NAV_LISTS = {"categoryLabels": pages.LISTS["categoryLabels"], "nearbyUrls": ("nav", pages.LISTS["nearbyUrls"][1])}


@query(FACTS)
def page_facts(spark, d):
    return pages.page_facts(directory(spark, d), lists=NAV_LISTS)


@query(f"""SELECT url AS id, name, city, {q_labels('labels', fixed.TYPE_KEYWORDS)}[1] AS type, {q_labels('labels', fixed.CATEGORY_KEYWORDS)}[1] AS category, array_to_string("categoryLabels", ', ') AS notes FROM (SELECT *, array_to_string("categoryLabels", ' ') AS labels FROM ({FACTS})) WHERE name IS NOT NULL""")
def page_candidates(spark, d):
    return pages.facts_to_candidates(pages.page_facts(directory(spark, d), lists=NAV_LISTS))


@query(f"""WITH RECURSIVE p AS ({PAGE_KEYS}), e AS (SELECT page_id AS a, lead(page_id) OVER (PARTITION BY host ORDER BY page_id) AS b FROM p UNION SELECT page_id, lead(page_id) OVER (PARTITION BY title ORDER BY page_id) FROM p),
r AS (SELECT min(page_id) AS id, 0 AS depth FROM p GROUP BY host UNION SELECT e.b, r.depth + 1 FROM r JOIN e ON r.id = e.a WHERE e.b IS NOT NULL) SELECT id, min(depth) AS depth FROM r GROUP BY id""")
def crawl_reach(spark, d):
    from pyspark.sql import Window as W

    p = t(spark, d, "pages").select("page_id", X.domain(F.col("url")).alias("host"), X.name_key(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))
    after = lambda key: p.select(F.col("page_id").alias("a"), F.lead("page_id").over(W.partitionBy(key).orderBy("page_id")).alias("b"))
    return pages.crawl_reach(p.groupBy("host").agg(F.min("page_id").alias("id")), after("host").union(after("title")).where("b is not null").distinct())


#: Hosts of all kinds by event_id; ip is a dotted address.
HOST_CASES = ["ip", "'::ffff:' || ip", "'[::FFFF:' || ip || ']'", "'::ffff:' || hex", "'localhost'", "'fe80::' || event_id", "'fd00::1'", "'::1'", "'host' || event_id || '.org'", "'2001:db8::' || event_id % 9", "'300.1.1.1'"]


@query(f"""SELECT event_id, host, scheme <> 'https' OR event_id % {len(HOST_CASES)} IN (4, 5, 6, 7) OR (event_id % {len(HOST_CASES)} < 4 AND (a IN (0, 10, 127) OR (a = 169 AND b = 254) OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168) OR (a = 100 AND b BETWEEN 64 AND 127) OR a >= 224)) AS blocked
FROM (SELECT *, CASE event_id % {len(HOST_CASES)} {' '.join(f'WHEN {i} THEN {c}' for i, c in enumerate(HOST_CASES))} END AS host FROM (SELECT *, a || '.' || b || '.' || c || '.7' AS ip, format('{{:x}}:{{:x}}', a * 256 + b, c * 256 + 7) AS hex FROM (SELECT event_id, event_id * 37 % 256 AS a, event_id * 11 % 256 AS b, event_id % 256 AS c, CASE WHEN event_id % 50 = 0 THEN 'ftp' ELSE 'https' END AS scheme FROM events)))""")
def private_hosts(spark, d):
    k = F.col("event_id")
    a, b, c = k * 37 % 256, k * 11 % 256, k % 256
    s = lambda x: x.cast("string")
    ip = F.concat_ws(".", s(a), s(b), s(c), F.lit("7"))
    pair = F.concat_ws(":", F.lower(F.hex(a * 256 + b)), F.lower(F.hex(c * 256 + 7)))
    cases = [ip, F.concat(F.lit("::ffff:"), ip), F.concat(F.lit("[::FFFF:"), ip, F.lit("]")), F.concat(F.lit("::ffff:"), pair), F.lit("localhost"), F.concat(F.lit("fe80::"), s(k)), F.lit("fd00::1"), F.lit("::1"), F.concat(F.lit("host"), s(k), F.lit(".org")), F.concat(F.lit("2001:db8::"), s(k % 9)), F.lit("300.1.1.1")]
    host = F.element_at(F.array(*cases), (k % len(cases) + 1).cast("int"))
    e = t(spark, d, "events").select("event_id", host.alias("host"), F.when(k % 50 == 0, "ftp").otherwise("https").alias("scheme"))
    return pages.flag_private_hosts(e, "host", "scheme").select("event_id", "host", "blocked")


LOG = "SELECT user_id, event_id AS seq, ts, event_type AS state FROM events"


def log(spark, d) -> DataFrame:
    return t(spark, d, "events").select("user_id", F.col("event_id").alias("seq"), F.col("ts").alias("at"), F.col("event_type").alias("state"))


@query(f"SELECT user_id, arg_max(state, (ts, seq)) AS state FROM ({LOG}) GROUP BY user_id")
def state_latest(spark, d):
    return state.state_latest(log(spark, d), "user_id").select("user_id", "state")


@query(f"SELECT user_id, list(state ORDER BY ts, seq) AS history FROM ({LOG}) GROUP BY user_id")
def state_history(spark, d):
    return state.state_history(log(spark, d), "user_id")


@query("SELECT user_id, count(*) AS failures, CASE WHEN count(*) >= 15 THEN 'REJECTED' ELSE 'RETRY' END AS state FROM events WHERE event_type = 'error' GROUP BY user_id")
def retry_ceiling(spark, d):
    return state.retry_ceiling(t(spark, d, "events").where("event_type = 'error'"), "user_id", 15)


@query("SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 60)")
def resume(spark, d):
    e = t(spark, d, "events")
    states = e.select("user_id", F.when((F.col("event_type") == "purchase") & (F.col("value") > 60), "REJECTED").otherwise("VERIFIED").alias("state"))
    return state.pending(e.select("user_id").distinct(), states, "user_id")


@query("SELECT event_id, 'k: ' || regexp_extract(props, '[0-9]+') AS flat FROM events")
def map_flatten(spark, d):
    return t(spark, d, "events").select("event_id", io.flatten_map(F.from_json("props", "map<string,string>")).alias("flat"))


@query("SELECT conv_id, turn, conv_id || ',' || CASE WHEN regexp_matches(text, '[\",\\n\\r]') THEN '\"' || replace(text, '\"', '\"\"') || '\"' ELSE text END || ',' || role || '; ' || turn AS line FROM conversations".replace("\\n", "\n").replace("\\r", "\r"))
def csv_lines(spark, d):
    c = t(spark, d, "conversations").withColumn("both", F.array("role", F.col("turn").cast("string")))
    return io.csv_lines(c, {"conv_id": "Id", "text": "Text", "both": "Who"}).select("conv_id", "turn", "line")


@query("SELECT p_partkey, p_brand || ',' || p_name || ',' || p_type || ',,,' || p_size || '%,' || p_retailprice::DECIMAL(18,1)::VARCHAR || ',,a; b,\"said \"\"' || p_type || '\"\"\"' AS line FROM part".replace('\\"', '"'))
def offers_csv(spark, d):
    p = t(spark, d, "part").select("p_partkey", F.col("p_brand").alias("providerName"), F.col("p_name").alias("productName"), F.col("p_type").alias("category"), F.concat(F.col("p_size").cast("string"), F.lit("%")).alias("interestRate"), F.col("p_retailprice").cast("decimal(18,1)").alias("loanAmountRange"), F.array(F.lit("a"), F.lit("b")).alias("requirements"), F.concat(F.lit('said "'), "p_type", F.lit('"')).alias("description"))
    return io.offers_to_csv(p).select("p_partkey", "line")


@query("SELECT page_id, 'No. ' || page_id || ',,,' || regexp_extract(url, '^https?://([^/?#]*)', 1) || ',' || CASE WHEN regexp_matches(url, '[\",]') THEN '\"' || url || '\"' ELSE url END || ',,,a: ' || page_id || '; b: x' AS line FROM pages".replace('\\"', '"'))
def listings_csv(spark, d):
    k = F.col("page_id").cast("string")
    p = t(spark, d, "pages").select("page_id", F.concat(F.lit("No. "), k).alias("title"), F.regexp_extract("url", "^https?://([^/?#]*)", 1).alias("sourceSite"), F.col("url").alias("sourceUrl"), F.create_map(F.lit("b"), F.lit("x"), F.lit("a"), k).alias("attributes"))
    return io.listings_to_csv(p).select("page_id", "line")


K = "regexp_extract(props, '[0-9]+')"


@query(f"SELECT event_id, CASE event_id % 4 WHEN 3 THEN []::VARCHAR[] WHEN 1 THEN [{K}, {K}] ELSE [{K}] END AS values, CASE WHEN event_id % 4 IN (0, 2) AND event_id % 8 <> 2 OR event_id % 4 = 1 THEN CASE event_id % 4 WHEN 0 THEN {K} END END AS first FROM events")
def unwrap_json(spark, d):
    k = F.col("event_id")
    wrapped = F.when(k % 4 == 0, F.concat(F.lit("```json\n["), "props", F.lit("]\n```"))).when(k % 4 == 1, F.concat(F.lit('so: {"items": ['), "props", F.lit(","), "props", F.lit("]} done"))).when(k % 4 == 2, F.concat(F.lit('{"results": ['), "props", F.lit("]}"))).otherwise("none at all")
    both = io.unwrap_object(io.unwrap_records(t(spark, d, "events").select("event_id", wrapped.alias("x")), "x"), "x")
    return both.select("event_id", F.transform("records", lambda x: F.get_json_object(x, "$.k")).alias("values"), F.get_json_object("object", "$.k").alias("first"))


@query("SELECT s_suppkey - 1 AS input_pos, s_name AS \"rawName\", CASE WHEN s_suppkey % 2 = 0 THEN 'Tashkent' END AS city FROM (SELECT row_number() OVER (ORDER BY s_suppkey) AS s_suppkey, s_name FROM supplier)".replace('\\"', '"'))
def candidates(spark, d):
    placed = lists.numbered(t(spark, d, "supplier").select(F.lit(0).alias("all"), "s_suppkey", "s_name"), "all", ["s_suppkey"])
    s = placed.select((F.col("pos") + 1).alias("k"), "s_name")
    path = shared_path(spark, "candidates")
    io.write_envelope(s.select("k", F.col("s_name").alias("rawName"), F.when(F.col("k") % 2 == 0, "Tashkent").alias("city")), path, "2024-01-01T00:00:00Z", "k")
    return io.read_candidates(spark, path).select(F.col("input_pos").cast("long").alias("input_pos"), "rawName", "city")


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def json_roundtrip(spark, d):
    path = shared_path(spark, "envelope")
    s = t(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    io.write_envelope(s, path, "2024-01-01T00:00:00Z", "s_suppkey")
    return io.read_export(spark, path, "s_suppkey bigint, s_name string, s_nationkey int")


@query("SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN 'review' ELSE 'rejected' END AS outcome FROM supplier")
def outcome_store(spark, d):
    path = shared_path(spark, "outcomes")
    io.write_outcomes(t(spark, d, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 2 == 0, "review").otherwise("rejected").alias("outcome")), path)
    return io.read_state(spark, path, "s_suppkey bigint, s_name string, outcome string")


def drained(df: DataFrame, name: str) -> DataFrame:
    """An append-only stream over what is there now, as a table in the shared folder."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", shared_path(spark, f"{name}-marks")).trigger(availableNow=True).start(path).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def event_stream(spark, d) -> DataFrame:
    batch_ = t(spark, d, "events")
    # a folder is what a file stream reads: the one file, or the parts, under a name of their own
    path = shared_path(spark, "events")
    batch_.write.parquet(path)
    return streams.read_events(spark, path, batch_.schema)


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS state, count(*) AS n FROM events GROUP BY user_id")
def stream_latest_state(spark, d):
    path = shared_path(spark, "latest")
    states = streams.latest_state(event_stream(spark, d), "user_id")
    states.writeStream.outputMode("update").foreachBatch(streams.keep_updates(path)).option("checkpointLocation", shared_path(spark, "marks")).trigger(availableNow=True).start().awaitTermination()
    return streams.latest_update(spark, path, "user_id")


@query("SELECT DISTINCT user_id FROM events")
def stream_new_ids(spark, d):
    return drained(streams.new_ids(event_stream(spark, d).select("user_id", "ts"), "user_id", delay="3650 days").select("user_id"), "ids")


@query("SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY user_id, event_type")
def stream_append_once(spark, d):
    target, marks = shared_path(spark, "evidence"), shared_path(spark, "marks")
    events = event_stream(spark, d).select("user_id", "event_type", "event_id", "value")
    for _ in range(2):  # the second pass finds everything there
        events.writeStream.foreachBatch(streams.append_once(target, ["user_id", "event_type"], "event_id")).option("checkpointLocation", f"{marks}-{uuid.uuid4().hex}").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(target).select("user_id", "event_type", "event_id", "value")


TRANSITIONS = """WITH x AS (SELECT max(event_id) / 2 AS m FROM events), o AS (SELECT user_id, ts AS moment, CASE event_type WHEN 'view' THEN 'RESEARCHING' WHEN 'error' THEN 'NEEDS_REVIEW' ELSE 'VERIFIED' END AS state, event_id FROM events), old AS (SELECT o.* FROM o, x WHERE event_id < m AND user_id % 2 = 0), new AS (SELECT o.* FROM o, x WHERE event_id >= m)
SELECT user_id, moment, state, 'old' AS note FROM old UNION ALL SELECT user_id, moment, state, 'new' FROM new UNION ALL SELECT user_id, min(moment), 'DISCOVERED', NULL FROM new WHERE user_id NOT IN (SELECT user_id FROM old) GROUP BY user_id"""


@query(f"SELECT user_id, epoch_us(moment)::BIGINT AS moment, state, note, state IN ('NEEDS_REVIEW', 'VERIFIED') AS verified FROM ({TRANSITIONS})")
def state_transitions(spark, d):
    e = t(spark, d, "events")
    stage = F.when(F.col("event_type") == "view", "RESEARCHING").when(F.col("event_type") == "error", "NEEDS_REVIEW").otherwise("VERIFIED")
    middle = e.agg((F.max("event_id") / 2).alias("m"))
    rows = e.crossJoin(F.broadcast(middle)).select("user_id", F.col("ts").cast("timestamp").alias("at"), stage.alias("state"), "event_id", "m")
    old = rows.where("event_id < m and user_id % 2 = 0").select("user_id", "at", "state", F.lit("old").alias("note"), F.col("event_id").alias("seq"))
    new = rows.where("event_id >= m").select("user_id", "at", "state", F.lit("new").alias("note"))
    log = state.append_transitions(old, new, "user_id")
    return log.select("user_id", F.unix_micros("at").alias("moment"), "state", "note", (state.stage_rank(F.col("state")) >= fixed.STAGES.index("VERIFIED")).alias("verified"))


#: Words of documents as a keyword table: a label for each length, words in the order of the first document that has them.
KEYWORDS = "SELECT 'length ' || length(w) AS label, length(w) AS label_pos, min(doc_id) AS keyword_pos, w AS keyword FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS w FROM documents) WHERE length(w) >= 4 GROUP BY w"
LABELLED = f"""WITH k AS ({KEYWORDS}), hit AS (SELECT conv_id, turn, label, label_pos, arg_min(keyword, (keyword_pos, keyword)) AS hit FROM conversations JOIN k ON contains(lower(trim(text)), keyword) GROUP BY ALL)
SELECT c.conv_id, c.turn, coalesce(list(label ORDER BY label_pos) FILTER (label IS NOT NULL), []) AS labels, coalesce(list(hit ORDER BY label_pos) FILTER (label IS NOT NULL), []) AS hits FROM conversations c LEFT JOIN hit USING (conv_id, turn) GROUP BY ALL"""


def keyword_rows(spark, d) -> DataFrame:
    words = t(spark, d, "documents").select("doc_id", F.explode(F.split(F.lower("text"), " ")).alias("keyword")).where(F.length("keyword") >= 4)
    return words.groupBy("keyword").agg(F.min("doc_id").alias("keyword_pos")).withColumns({"label_pos": F.length("keyword"), "label": F.concat(F.lit("length "), F.length("keyword").cast("string"))})


@query(LABELLED)
def keyword_table(spark, d):
    return matching.classify_by_table(t(spark, d, "conversations"), "text", keyword_rows(spark, d)).select("conv_id", "turn", "labels", "hits")


@query(LABELLED)
def keyword_table_join(spark, d):
    """As with a table that is too large for an automaton."""
    return matching.classify_by_table(t(spark, d, "conversations"), "text", keyword_rows(spark, d), automaton=0).select("conv_id", "turn", "labels", "hits")


def part_names(spark, d) -> tuple[DataFrame, DataFrame]:
    parts = t(spark, d, "part")
    dim = parts.select(F.col("p_partkey").alias("alias_pos"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("No."), F.col("p_partkey").cast("string"))).otherwise(F.upper("p_name")).alias("alias"), F.col("p_brand").alias("brand"))
    return parts.select("p_partkey", F.concat(F.lit(" Buy  "), "p_name", F.lit(" or No."), (F.col("p_partkey") * 7 % 1000).cast("string"), F.lit(" now ")).alias("wish")), dim


@query("""WITH a AS (SELECT p_partkey AS pos, CASE WHEN p_partkey % 3 = 0 THEN 'no.' || p_partkey ELSE lower(p_name) END AS alias, p_brand AS brand FROM part), x AS (SELECT p_partkey, 'buy ' || lower(p_name) || ' or no.' || p_partkey * 7 % 1000 || ' now' AS wish FROM part)
SELECT p_partkey, arg_min(brand, (-length(alias), pos)) AS brand FROM x LEFT JOIN a ON contains(wish, alias) GROUP BY p_partkey""")
def alias_table(spark, d):
    wishes, dim = part_names(spark, d)
    return matching.resolve_by_table(wishes, "wish", dim, ["brand"]).select("p_partkey", "brand")


@query("SELECT p_partkey, list_sort(list(DISTINCT brand)) AS mentioned FROM (SELECT p_partkey, 'buy ' || lower(p_name) || ' or no.' || p_partkey * 7 % 1000 || ' now' AS wish FROM part) JOIN (SELECT p_brand AS brand, CASE WHEN p_partkey % 3 = 0 THEN 'no.' || p_partkey ELSE lower(p_name) END AS alias FROM part) ON contains(wish, alias) GROUP BY p_partkey")
def mention_table(spark, d):
    wishes, dim = part_names(spark, d)
    own = wishes.withColumn("wish", F.regexp_replace("wish", " +", " "))
    return matching.mentions_by_table(own, "wish", dim, "brand", automaton=0).where(F.size("mentioned") > 0).select("p_partkey", F.sort_array("mentioned").alias("mentioned"))


#: A block for each event: IPv4 of 12 to 28 bits, IPv6 of 40 to 48.
RANGES = "SELECT event_id, event_id % 4 < 3 AS four, event_id * 131 % 256 * 16777216 + event_id * 17 % 256 * 65536 + event_id % 256 * 256 AS low, 12 + event_id % 17 AS bits, event_id * 7 % 65536 AS third, 40 + event_id % 9 AS bits6, CASE WHEN event_id % 4 < 3 THEN event_id * 131 % 256 || '.' || event_id * 17 % 256 || '.' || event_id % 256 || '.0/' || 12 + event_id % 17 ELSE format('2001:db8:{:x}::/{}', event_id * 7 % 65536, 40 + event_id % 9) END AS cidr FROM events"


@query(f"""WITH r AS ({RANGES}), h AS (SELECT event_id, event_id % 5 < 4 AS four, event_id * 37 % 256 * 16777216 + event_id * 11 % 256 * 65536 + event_id % 256 * 256 + 7 AS ip, event_id * 5 % 65536 AS third,
 CASE event_id % 5 WHEN 0 THEN '::ffff:' || dotted WHEN 1 THEN format('[::FFFF:{{:x}}:{{:x}}]', a * 256 + b, event_id % 256 * 256 + 7) WHEN 4 THEN format('2001:0DB8:{{:x}}::{{:x}}', event_id * 5 % 65536, event_id % 9) ELSE dotted END AS host FROM (SELECT *, a || '.' || b || '.' || event_id % 256 || '.7' AS dotted FROM (SELECT event_id, event_id * 37 % 256 AS a, event_id * 11 % 256 AS b FROM events))),
f AS (SELECT h.event_id, cidr, bits AS n FROM h, (SELECT DISTINCT bits AS b FROM r) JOIN r ON r.bits = b AND r.four AND r.low >> (32 - b) = h.ip >> (32 - b) WHERE h.four UNION ALL SELECT h.event_id, cidr, bits6 FROM h, (SELECT DISTINCT bits6 AS b FROM r) JOIN r ON r.bits6 = b AND NOT r.four AND r.third >> (48 - b) = h.third >> (48 - b) WHERE NOT h.four)
SELECT h.event_id, any_value(host) AS host, arg_min(cidr, (-n, cidr)) AS block FROM h LEFT JOIN f USING (event_id) GROUP BY h.event_id""")
def range_join(spark, d):
    k = F.col("event_id")
    s = lambda x: x.cast("string")
    h = lambda x: F.lower(F.hex(x))
    a, b, c = k * 37 % 256, k * 11 % 256, k % 256
    dotted = F.concat_ws(".", s(a), s(b), s(c), F.lit("7"))
    host = F.when(k % 5 == 0, F.concat(F.lit("::ffff:"), dotted)).when(k % 5 == 1, F.concat(F.lit("[::FFFF:"), h(a * 256 + b), F.lit(":"), h(c * 256 + 7), F.lit("]"))).when(k % 5 == 4, F.concat(F.lit("2001:0DB8:"), h(k * 5 % 65536), F.lit("::"), h(k % 9))).otherwise(dotted)
    e = t(spark, d, "events")
    four = F.concat(F.concat_ws(".", s(k * 131 % 256), s(k * 17 % 256), s(c), F.lit("0")), F.lit("/"), s(12 + k % 17))
    six = F.concat(F.lit("2001:db8:"), h(k * 7 % 65536), F.lit("::/"), s(40 + k % 9))
    table = e.select(F.when(k % 4 < 3, four).otherwise(six).alias("cidr"))
    return ranges.with_block(e.select("event_id", host.alias("host")), "host", table, "cidr")


@query(f"{DUPLICATES} SELECT id, kept_id FROM f")
def incremental_duplicates(spark, d):
    """Three batches, of which later ones have smaller ids, too."""
    p = t(spark, d, "pages").select("page_id", X.domain(F.col("url")).alias("host"), X.name_key(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))
    at = shared_path(spark, "components")
    for k in range(3):
        components.add_batch(p.where(F.col("page_id") % 3 == 2 - k), k, at, "page_id", {"domain": "host", "name": "title"})
    return components.current(spark, at, "bigint")


STAGE_OF = {"view": "RESEARCHING", "click": "VERIFIED", "signup": "CONTENT_READY", "purchase": "APPROVED", "error": "NEEDS_REVIEW"}
IDLE, LATE = datetime.timedelta(hours=30), "6 hours"


def transitions_of(events: DataFrame) -> DataFrame:
    stage = F.create_map(*[F.lit(x) for pair in STAGE_OF.items() for x in pair])[F.col("event_type")]
    return events.select("user_id", F.col("ts").alias("at"), F.col("event_id").alias("seq"), stage.alias("state"), F.col("props").alias("note"))


@query(f"""WITH e AS (SELECT user_id::VARCHAR AS key, ts, event_id, props, CASE event_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STAGE_OF.items())} END AS state, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 5 ELSE 999 END AS rank, ceil(epoch_us(ts) / 1000)::BIGINT AS ms FROM events),
g AS (SELECT *, coalesce(ms - lag(ms) OVER (PARTITION BY key ORDER BY ts, event_id) > {int(IDLE.total_seconds() * 1000)}, true) AS first FROM e WHERE ms <= (SELECT max(epoch_ms(ts)) - {6 * 3_600_000} FROM events)),
l AS (SELECT *, sum(first::INTEGER) OVER (PARTITION BY key ORDER BY ts, event_id) AS life FROM g), b AS (SELECT *, coalesce(max(rank) OVER (PARTITION BY key, life ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM l)
SELECT key, 0 AS n, epoch_us(ts) AS moment, 'DISCOVERED' AS state, NULL AS note FROM l WHERE first UNION ALL SELECT key, row_number() OVER (PARTITION BY key, life ORDER BY ts, event_id)::INTEGER, epoch_us(ts), state, props FROM b WHERE rank > before""")
def stream_state_log(spark, d):
    """Four parts whose rows are late by up to six hours, each in a run of its own that goes on from the last one's checkpoint."""
    events = t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    shifted = F.unix_micros("ts") + F.col("event_id") * 7919 % 21_600 * 1_000_000
    part = F.least(F.floor((shifted - (first or 0)) * 4 / ((last or 0) - (first or 0) + 1)), F.lit(3))
    source, target, marks = (shared_path(spark, x) for x in ("transitions", "log", "marks"))
    own, provider = transitions_of(events.withColumn("part", part)).schema, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, transitions.PROVIDER)
    try:
        for k in range(4):
            transitions_of(events.where(part == k)).write.mode("append").parquet(source)
            log_ = transitions.stream_log(spark.readStream.schema(own).parquet(source), "user_id", LATE, IDLE)
            log_.writeStream.format("parquet").outputMode("append").option("checkpointLocation", marks).trigger(availableNow=True).start(target).awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return spark.read.schema(transitions.LOG).parquet(target).select("key", "n", F.unix_micros("at").alias("moment"), "state", "note")


@query("SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY user_id, event_type")
def stream_store(spark, d):
    """Three micro-batches, the second one tried twice."""
    target = shared_path(spark, "store")
    events = t(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    most = events.agg(F.max("event_id")).first()[0] or 0
    part = F.floor(F.col("event_id") * 3 / (most + 1))
    for k in (0, 1, 1, 2):
        store.add_batch(events.where(part == k), k, target, ["user_id", "event_type"], "event_id")
    return store.read(spark, target, events.schema)


@query(f"SELECT count(*) AS discovered, count(CASE WHEN state IN ('JSON_READY', 'APPROVED', 'NEEDS_REVIEW') THEN 1 END) AS processed, {COUNTS}, floor(avg(completeness) + 0.5)::INTEGER AS mean_completeness, floor(avg(source_confidence) + 0.5)::INTEGER AS mean_confidence, '{{\"types\":null}}' AS scope FROM ({STATE_SQL})".replace('\\"', '"'))
def stream_report(spark, d):
    """States that change over three runs of a stream: every order first is something else, and some change twice."""
    states = order_states(spark, d)
    other = F.when(F.col("state") == "APPROVED", "NEEDS_REVIEW").otherwise("APPROVED")
    early = states.select("id", F.lit(1).alias("version"), other.alias("state"), F.lit("duplicate").alias("last_error"), F.lit(7).alias("completeness"), F.lit(None).cast("long").alias("source_confidence"))
    final = states.select("id", F.lit(3).alias("version"), "state", "last_error", "completeness", "source_confidence")
    parts = [early, final.where("id % 2 = 0").unionByName(early.where("id % 3 = 0").withColumn("version", F.lit(2))), final.where("id % 2 = 1").unionByName(early.where("id % 2 = 0"))]
    source, target, marks = (shared_path(spark, x) for x in ("states", "totals", "marks"))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, transitions.PROVIDER)
    try:
        for part in parts:
            part.write.mode("append").parquet(source)
            changed = report.changes(spark.readStream.schema(part.schema).parquet(source))
            changed.writeStream.outputMode("update").foreachBatch(report.keep_totals(target)).option("checkpointLocation", marks).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(provider, before)
    return report.report(spark, target, '{"types":null}')


@query(f"SELECT user_id, i // 20 AS chunk, i // 20 * 20 AS first, list(state ORDER BY i) AS items FROM (SELECT user_id, state, row_number() OVER (PARTITION BY user_id ORDER BY ts, seq) - 1 AS i FROM ({LOG})) GROUP BY user_id, i // 20")
def history_chunks(spark, d):
    return lists.history_chunks(log(spark, d), "user_id", size=20)


@query(f"{DUPLICATES} SELECT kept_id, i // 5 AS chunk, i // 5 * 5 AS first, list(id ORDER BY i) AS items FROM (SELECT kept_id, id, row_number() OVER (PARTITION BY kept_id ORDER BY id) - 1 AS i FROM f WHERE id <> kept_id) GROUP BY kept_id, i // 5")
def group_chunks(spark, d):
    return lists.group_chunks(resolved_pages(spark, d), 5)


@query("WITH e AS (SELECT event_type, value AS confidence, event_id AS seq, unnest([props, CASE WHEN event_id % 2 = 0 THEN upper(props) ELSE 'x' END]) AS item, unnest([0, 1]) AS place FROM events), f AS (SELECT event_type, lower(item) AS k, min((confidence, seq, place, item)) AS x FROM e GROUP BY ALL), g AS (SELECT event_type, x[4] AS item, row_number() OVER (PARTITION BY event_type ORDER BY x) - 1 AS i FROM f) SELECT event_type, i // 50 AS chunk, i // 50 * 50 AS first, list(item ORDER BY i) AS items FROM g GROUP BY event_type, i // 50")
def merged_chunks(spark, d):
    items = F.array("props", F.when(F.col("event_id") % 2 == 0, F.upper("props")).otherwise("x"))
    e = t(spark, d, "events").select("event_type", F.col("value").alias("confidence"), F.col("event_id").alias("seq"), items.alias("items"))
    return lists.merged_chunks(e, "event_type", "items", 50)


@query("SELECT page_id, 0 AS n, 'article' AS tag, 'A' || page_id || '<article>B<!-- </article> --></article><p>C' AS markup FROM pages UNION ALL SELECT page_id, 1, 'article', 'B<!-- </article> -->' FROM pages UNION ALL SELECT page_id, 2, 'article', 'end' FROM pages WHERE page_id % 2 = 0")
def nested_blocks(spark, d):
    """Articles in articles, a comment with an end tag, and a paragraph that is never closed, around no page's own articles."""
    page = F.regexp_replace("html", "(?i)</?article[^>]*>", "")
    html = F.concat(F.lit("<article class='x>y'>A"), F.col("page_id").cast("string"), F.lit("<article>B<!-- </article> --></article><p>C</article>"), F.when(F.col("page_id") % 2 == 0, "<ARTICLE>end</ARTICLE>").otherwise(""), page)
    return blocks.page_blocks(t(spark, d, "pages").select("page_id", html.alias("html")), ["article"]).select("page_id", "n", "tag", "markup")


@query("WITH x AS (SELECT min(ts) AS m FROM events) SELECT DISTINCT user_id FROM events, x WHERE ts < m + INTERVAL 10 DAY UNION ALL SELECT -1 UNION ALL SELECT DISTINCT user_id FROM events, x WHERE ts >= m + INTERVAL 20 DAY")
def stream_ids_again(spark, d):
    """The watermark at work: an id that comes again after its state has gone counts as new. A row between the two parts moves
    the watermark past all of the first."""
    e = t(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    m = F.lit(e.agg(F.min("ts")).first()[0]).cast("timestamp")
    days = lambda n: m + F.expr(f"INTERVAL {n} DAYS")
    parts = [e.where(F.col("ts") < days(10)), e.agg(F.lit(-1).cast("long").alias("user_id"), days(15).alias("ts")), e.where(F.col("ts") >= days(20))]
    source, target, marks = (shared_path(spark, x) for x in ("ids", "new", "marks"))
    for part in parts:
        part.write.mode("append").parquet(source)
        fresh = streams.new_ids(spark.readStream.schema(e.schema).parquet(source), "user_id", delay="1 day").select("user_id")
        fresh.writeStream.format("parquet").outputMode("append").option("checkpointLocation", marks).trigger(availableNow=True).start(target).awaitTermination()
    return spark.read.schema("user_id long").parquet(target)
