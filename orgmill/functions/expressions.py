"""Column expressions: names, phones, urls, languages and keyword tables. Built-in functions only."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from orgmill.functions import fixed

SPACE = r"[\s   -     　﻿]"


def _folds() -> tuple[str, str]:
    letters = [chr(c) for r in (range(0xC0, 0x250), range(0x1E00, 0x1F00)) for c in r] + list("ЙйЁё")
    pairs = [(x, d[0]) for x in letters if len(d := unicodedata.normalize("NFD", x)) > 1]
    return "".join(x for x, _ in pairs), "".join(y for _, y in pairs)


FOLD_FROM, FOLD_TO = _folds()


def fold_accents(c: Column) -> Column:
    """Letters without their accents."""
    return F.regexp_replace(F.translate(c, FOLD_FROM, FOLD_TO), "[̀-ͯ]", "")


def name_key(c: Column) -> Column:
    """What two spellings of a name have in common; empty for a name without Latin letters or digits."""
    s = F.translate(F.lower(F.trim(c)), "ʻʼ’‘ōūāʺʹ", "''''oua")
    s = F.regexp_replace(fold_accents(s), r"(?<![A-Za-z0-9_])(llc|mchj|ltd|inc|centre|center|lc)(?![A-Za-z0-9_])", "")
    s = F.regexp_replace(F.translate(s, "'\".,()", ""), rf"[^a-z0-9]+", " ")
    return F.trim(s)


def slug(*parts: Column) -> Column:
    joined = F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != "")), " ")
    s = F.translate(F.lower(fold_accents(joined)), "'\".,()", "")
    s = F.regexp_replace(F.regexp_replace(s, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", "institution").otherwise(s)


def entity_id(name: Column, city: Column) -> Column:
    key = name_key(name)
    return F.concat(F.lit("pipeline-"), F.when(key == "", F.left(F.sha2(F.coalesce(name, F.lit("")), 256), F.lit(24))).otherwise(slug(key, city)))


def record_id(c: Column) -> Column:
    """'c' and 24 characters of base 36 from a hash: the same in every run."""
    digits = F.transform(F.sequence(F.lit(1), F.lit(24)), lambda i: F.pmod(F.conv(F.substr(F.sha2(c, 256), i * 2 - 1, F.lit(2)), 16, 10).cast("int"), F.lit(36)))
    return F.concat(F.lit("c"), F.array_join(F.transform(digits, lambda d: F.substr(F.lit("0123456789abcdefghijklmnopqrstuvwxyz"), d + 1, F.lit(1))), ""))


def phone(c: Column) -> Column:
    """struct(normalized, valid, reason)."""
    kept = F.regexp_replace(F.regexp_replace(F.trim(c), r"[^\d+]", ""), r"(?!^)\+", "")
    national = F.when(kept.startswith("+998"), F.substring(kept, 5, 99)).when(kept.startswith("998"), F.substring(kept, 4, 99)).when(kept.rlike(r"^\d{9}$"), kept)
    reason = (
        F.when(c.isNull() | (F.trim(c) == ""), "empty phone")
        .when(national.isNull() & kept.startswith("0"), "leading 0 without country code is not accepted")
        .when(national.isNull(), "unrecognized phone format")
        .when(~national.rlike(r"^\d{9}$"), F.concat(F.lit("expected 9 digits after country code, got "), F.length(national).cast("string")))
    )
    return F.struct(F.when(reason.isNull(), F.concat(F.lit("+998"), national)).alias("normalized"), reason.isNull().alias("valid"), reason.alias("reason"))


def phone2(c: Column) -> Column:
    raw = F.nullif(F.trim(c), F.lit(""))
    return F.when(F.instr(raw, ",") > 0, raw).otherwise(F.coalesce(phone(raw)["normalized"], raw))


def url(c: Column) -> Column:
    """With a scheme, a lower-case host and no slash after a bare host; null where it cannot be parsed."""
    raw = F.nullif(F.trim(c), F.lit(""))
    full = F.when(raw.rlike("(?i)^https?://"), raw).otherwise(F.concat(F.lit("https://"), raw))
    host = F.try_parse_url(full, F.lit("HOST"))
    rest = F.regexp_replace(full, "^(?i)https?://[^/?#]*", "")
    port = F.regexp_extract(full, r"^(?i)https?://[^/?#]*?(:\d+)?(?:[/?#]|$)", 1)
    scheme = F.lower(F.regexp_extract(full, "^(?i)(https?)://", 1))
    return F.when(host.isNotNull() & (host != ""), F.concat(scheme, F.lit("://"), F.lower(host), port, F.when(rest == "/", "").otherwise(rest)))


def domain(c: Column) -> Column:
    return F.regexp_replace(F.try_parse_url(url(c), F.lit("HOST")), r"^www\.", "")


def handle(c: Column) -> Column:
    return F.concat(domain(c), F.regexp_replace(F.lower(F.coalesce(F.try_parse_url(url(c), F.lit("PATH")), F.lit(""))), "/$", ""))


def language_code(c: Column) -> Column:
    pairs = [F.lit(x) for code, names in fixed.LANGUAGE_NAMES.items() for n in names for x in (n, code)]
    key = F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), key)


def languages(c: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(x) != ""), language_code))


def texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def once(c: Column, f) -> Column:
    """f(c), with c evaluated once, however often f names it: bodies of lambdas are evaluated anew for each element."""
    return F.element_at(F.transform(F.array(c), f), 1)


def _first(text: Column, keywords) -> Column:
    """The first keyword that the text contains: the search ends with it."""
    found = [F.when(F.contains(text, F.lit(k)), F.lit(k)) for k in keywords]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def first_keyword(text: Column, keywords) -> Column:
    """The first keyword, in the table's order, that the text contains."""
    return once(text, lambda t: _first(t, keywords))


def keyword_labels(text: Column, table: dict[str, list[str]]) -> tuple[Column, Column]:
    """Labels of which the lower-cased text contains a keyword, and those keywords, in the table's order."""
    lower = F.lower(F.trim(text))
    labels = lambda t: F.array_compact(F.array(*[F.when(_first(t, words).isNotNull(), F.lit(k)) for k, words in table.items()]))
    return once(lower, labels), once(lower, lambda t: F.array_compact(F.array(*[_first(t, words) for words in table.values()])))


def city_mentions(text: Column) -> Column:
    found = lambda t: F.array_compact(F.array(*[F.when(_first(t, [x.lower() for x in (name, *aliases) if len(x) >= 3]).isNotNull(), F.lit(name)) for _, _, name, aliases in fixed.CITIES]))
    return once(F.lower(F.trim(text)), found)


def has_value(c: Column, kind: str) -> Column:
    if kind.startswith("array"):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if kind == "string":
        return F.coalesce(F.trim(c) != "", F.lit(False))
    return c.isNotNull()


def html_text(c: Column, limit: int = 20_000) -> Column:
    s = F.regexp_replace(c, r"(?is)<(script|style)\b[^>]*>.*?</\1>", " ")
    s = F.regexp_replace(s, r"(?s)<[^>]*>", " ")
    s = F.replace(F.replace(s, F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&"))
    return F.left(F.trim(F.regexp_replace(s, r"\s+", " ")), F.lit(limit))


def decode_entities(c: Column) -> Column:
    for a, b in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#039;", "'")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def resolve_link(base: Column, href: Column) -> Column:
    """An absolute http(s) address for a link on a page; null for other schemes."""
    origin = F.regexp_extract(base, "^(?i)(https?://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, "[?#].*$", ""), "^((?i)https?://[^/]*)(/(?:.*/)?)?[^/]*$", "$1$2")
    folder = F.when(folder.rlike("^(?i)https?://[^/]*$"), F.concat(folder, F.lit("/"))).otherwise(folder)
    return (
        F.when(href.rlike("^(?i)https?://"), href)
        .when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^(?i)(https?:)", 1), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .otherwise(F.concat(folder, href))
    )


def ipv4(c: Column) -> Column:
    """A dotted address as a number; null where it isn't one."""
    parts = F.split(c, r"\.")
    number = sum((F.try_element_at(parts, F.lit(i + 1)).try_cast("long") * 256 ** (3 - i) for i in range(1, 4)), F.try_element_at(parts, F.lit(1)).try_cast("long") * 256**3)
    return F.when(c.rlike(r"^(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?!$)|$)){4}$"), number)
