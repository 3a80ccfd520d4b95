"""Elements of pages as nested intervals, and blocks of a page by which interval holds which.

A scan gives each element the interval of its content in the page's text. Comments, scripts and styles are skipped whole, elements
without content (br, img, ...) have none, and what is never closed ends with the element around it. An interval lies inside another
one or beside it, so everything about nesting is a comparison of numbers.
"""

from __future__ import annotations

import re
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: tag, depth (0: not inside another element), open (where its tag begins), start and stop (of its content).
ELEMENTS = T.ArrayType(T.StructType([T.StructField("tag", T.StringType()), *[T.StructField(c, T.IntegerType()) for c in ("depth", "open", "start", "stop")]]))
#: Elements that have no content, and those whose content is no markup.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)


def _scan(html: str, tags: list[str], numbers: tuple[array, array, array, array]) -> None:
    """Adds the elements of a page to tags and to numbers (depth, open, start and stop)."""
    depth, opened, start, stop = numbers
    path, at = [], 0
    while token := TOKEN.search(html, at):
        at = token.end()
        closing, tag, rest = token.group(1), token.group(2), token.group(3)
        if tag is None:
            continue
        tag = sys.intern(tag.lower())
        if closing:
            if any(tags[k] == tag for k in path):  # whatever is still open inside ends here, too
                while True:
                    k = path.pop()
                    stop[k] = token.start()
                    if tags[k] == tag:
                        break
            continue
        tags.append(tag)
        depth.append(len(path))
        opened.append(token.start())
        start.append(at)
        stop.append(at)
        if tag in VOID or rest.endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            stop[-1] = end.start() if end else len(html)
            at = end.end() if end else len(html)
            continue
        path.append(len(tags) - 1)
    for k in path:
        stop[k] = len(html)


def scanned(html: str) -> list[dict]:
    """The elements of a page, outer ones before those inside, in page order."""
    tags, numbers = [], tuple(array("i") for _ in range(4))
    _scan(html, tags, numbers)
    return [dict(zip(("tag", "depth", "open", "start", "stop"), row)) for row in zip(tags, *numbers)]


@F.arrow_udf(ELEMENTS)
def elements(html: pa.Array) -> pa.Array:
    """Pages one at a time, their elements as columns of whole numbers: an object for each would take some twenty times that."""
    tags, numbers, ends, codes = array("i"), tuple(array("i") for _ in range(4)), array("i", [0]), {}
    for page in html:
        text = page.as_py()
        if text is not None:
            names, own = [], tuple(array("i") for _ in range(4))
            _scan(text, names, own)
            tags.extend(codes.setdefault(x, len(codes)) for x in names)
            for all_, one in zip(numbers, own):
                all_.extend(one)
        ends.append(len(tags))
    ints = lambda x: pa.array(np.frombuffer(x, np.int32) if len(x) else np.zeros(0, np.int32))
    names = pa.DictionaryArray.from_arrays(ints(tags), pa.array(list(codes), pa.string())).cast(pa.string())
    rows = pa.StructArray.from_arrays([names, *map(ints, numbers)], names=["tag", "depth", "open", "start", "stop"])
    return pa.ListArray.from_arrays(ints(ends), rows)


def with_elements(pages: DataFrame, html: str = "html", into: str = "elements") -> DataFrame:
    return pages.withColumn(into, elements(F.col(html)))


def outermost(found: Column, tags: list[str]) -> Column:
    """Those of some tags that no other one of them holds, in page order."""
    own = F.filter(found, lambda x: x["tag"].isin(*tags))
    return F.filter(own, lambda x: ~F.exists(own, lambda y: (y["start"] <= x["open"]) & (x["open"] < y["stop"])))


def contents(html: Column, blocks: Column) -> Column:
    """The markup inside each of the blocks."""
    return F.transform(blocks, lambda x: F.substr(html, x["start"] + 1, x["stop"] - x["start"]))


def without_comments(html: Column) -> Column:
    return F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", " ")


def page_blocks(pages: DataFrame, tags: list[str], html: str = "html") -> DataFrame:
    """page_id, n (from 0), tag, depth, markup: every element of some tags, nested ones too, with all that it holds."""
    found = F.filter("elements", lambda x: x["tag"].isin(*tags))
    each = with_elements(pages.select("page_id", F.col(html).alias("html"))).select("page_id", "html", F.posexplode(found).alias("n", "x"))
    return each.select("page_id", "n", F.col("x.tag").alias("tag"), F.col("x.depth").alias("depth"), F.substr("html", F.col("x.start") + 1, F.col("x.stop") - F.col("x.start")).alias("markup"))


def table_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, table_n, row_n and cells (texts) of the rows of every table: a row belongs to the innermost table that holds it,
    and a cell to the innermost row."""
    own = with_elements(pages.select("page_id", F.col(html).alias("html")))
    of = lambda tags: F.filter("elements", lambda x: x["tag"].isin(*tags))
    inner = lambda outer, x: F.array_max(F.transform(F.filter(outer, lambda y: (y["start"] <= x["open"]) & (x["open"] < y["stop"])), lambda y: y["open"]))
    each = own.withColumns({"tables": of(["table"]), "rows": of(["tr"]), "cells": of(["td", "th"])})
    text = lambda x: F.trim(F.regexp_replace(F.regexp_replace(without_comments(F.substr("html", x["start"] + 1, x["stop"] - x["start"])), r"(?s)<[^>]*>", " "), r"\s+", " "))
    placed = each.withColumn("cells", F.transform("cells", lambda x: F.struct(inner(F.col("rows"), x).alias("row"), text(x).alias("text")))).withColumn("rows", F.transform("rows", lambda x: F.struct(x["open"].alias("open"), inner(F.col("tables"), x).alias("table"))))
    row = placed.select("page_id", "tables", "cells", "rows", F.posexplode("rows").alias("k", "r")).where("r.table is not null")
    first = F.array_position(F.transform(F.filter("rows", lambda y: y["table"] == F.col("r.table")), lambda y: y["open"]), F.col("r.open"))
    return row.select(
        "page_id",
        (F.array_position(F.transform("tables", lambda x: x["open"]), F.col("r.table")) - 1).alias("table_n"),
        (first - 1).alias("row_n"),
        F.transform(F.filter("cells", lambda x: x["row"] == F.col("r.open")), lambda x: x["text"]).alias("cells"),
    )
