"""Pages: readable text, links, facts, crawls over link tables, and addresses that are never fetched."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orgmill.functions import expressions as X
from orgmill.functions import fixed
from orgmill.operators import blocks
from orgmill.shared import stored

ANCHOR = r"""(?is)<a\b[^>]*href\s*=\s*["']([^"']+)["'][^>]*>(.*?)</a>"""
#: What each fact of a directory page stands in; one group each.
MARKERS = {
    "phone": r'href="tel:(\+?\d[\d\s()-]*\d)"', "lat": r"'LAT':'([\d.]+)'", "lng": r"'LON':'([\d.]+)'",
}
#: Facts that are the content of the first element of a tag.
BLOCKS = {"name": "h1", "address": "address", "descriptionSourceText": "article"}
#: Lists of a page: the first element of a tag, and one item within it.
LISTS = {"categoryLabels": ("nav", r'<a href="[^"]*">([^<]+)</a>'), "nearbyUrls": ("aside", r'<a\s+href="([^"]+)"')}
LABELLED_LINKS = ("website", "instagram", "facebook", "telegram")


def pages_to_text(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.withColumn("text", X.html_text(F.col(html)))


def all_links(pages: DataFrame, region: list[str] | None = None) -> DataFrame:
    """url, href, label of each anchor outside comments; region: only within elements of these tags, however they are nested."""
    html = F.col("html")
    if region is not None:
        pages = blocks.with_elements(pages, into="__elements")
        html = F.array_join(blocks.contents(html, blocks.outermost(F.col("__elements"), region)), " ")
    html = blocks.without_comments(html)
    hrefs, labels = (F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(i)) for i in (1, 2))
    each = pages.select("page_id", "url", F.explode(F.arrays_zip(hrefs.alias("href"), labels.alias("label"))).alias("x"))
    label = F.lower(F.trim(F.regexp_replace(F.regexp_replace("x.label", "<[^>]+>", " "), r"\s+", " ")))
    return each.select("page_id", "url", F.col("x.href").alias("href"), label.alias("label"))


def course_links(pages: DataFrame, keywords: list[str] | None = None) -> DataFrame:
    """page_id, link: distinct absolute links whose text or address holds a keyword; header and nav win over the page."""
    words = X.texts(keywords or fixed.COURSE_LINK_KEYWORDS)

    def chosen(links: DataFrame) -> DataFrame:
        match = F.exists(words, lambda k: F.contains("label", k) | F.contains(F.lower("href"), k))
        kept = links.where(match & ~F.trim("href").rlike("(?i)^(#|javascript:|mailto:|tel:)"))
        return kept.select("page_id", X.resolve_link(F.col("url"), F.col("href")).alias("link")).where("link is not null").distinct()

    top, whole = chosen(all_links(pages, ["header", "nav"])), chosen(all_links(pages))
    return top.union(whole.join(top.select("page_id").distinct(), "page_id", "left_anti"))


def clean_text(html) -> Column:
    """Lines without tags and entities; blank lines go."""
    s = X.decode_entities(F.regexp_replace(F.regexp_replace(html, r"(?i)<br\s*/?>", "\n"), "<[^>]+>", " "))
    lines = F.filter(F.transform(F.split(F.regexp_replace(s, r"[ \t]+", " "), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.nullif(F.array_join(lines, "\n"), F.lit(""))


def page_facts(pages: DataFrame, markers: dict[str, str] | None = None, lists: dict[str, tuple[str, str]] | None = None, content: dict[str, str] | None = None) -> DataFrame:
    """page_id, url, a nullable column for each marker and each of content, city (the first part of the address), the labelled
    links, and a list for each of lists (items in page order, addresses absolute). What a page lacks is null or empty by
    itself; elements end where their own end tag is, whatever they hold."""
    pages = blocks.with_elements(pages, into="__elements")
    html = F.col("html")
    first = lambda tag: F.coalesce(F.try_element_at(blocks.contents(html, blocks.outermost(F.col("__elements"), [tag])), F.lit(1)), F.lit(""))
    found = {k: F.regexp_extract(html, m, 1) for k, m in (markers or MARKERS).items()} | {k: blocks.without_comments(first(tag)) for k, tag in (content or BLOCKS).items()}
    out = {k: clean_text(c) for k, c in found.items()}
    if "phone" in found:
        out["phone"] = F.nullif(F.regexp_replace(found["phone"], r"[\s()-]", ""), F.lit(""))
    for k in ("lat", "lng"):
        if k in found:
            out[k] = found[k].try_cast("double")
    if "address" in found:
        out["city"] = F.nullif(F.trim(F.try_element_at(F.split(out["address"], ","), F.lit(1))), F.lit(""))
    hrefs, labels = (F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(i)) for i in (1, 2))
    label = lambda x: F.lower(F.trim(X.decode_entities(x)))
    links = F.map_from_entries(F.transform(F.array_distinct(F.filter(F.transform(labels, label), lambda x: x.isin(*LABELLED_LINKS))), lambda k: F.struct(k, F.element_at(F.filter(F.arrays_zip(hrefs.alias("href"), F.transform(labels, label).alias("label")), lambda z: z["label"] == k), -1)["href"])))
    out |= {k: F.trim(F.try_element_at(links, F.lit(k))) for k in LABELLED_LINKS}
    for k, (block, item) in (lists or LISTS).items():
        items = F.transform(F.regexp_extract_all(blocks.without_comments(first(block)), F.lit(item), F.lit(1)), lambda x: F.trim(X.decode_entities(x)))
        items = F.filter(items, lambda x: x != "")
        out[k] = F.coalesce(F.transform(items, lambda x: X.resolve_link(F.col("url"), x)) if k.endswith("Urls") else items, F.array().cast("array<string>"))
    return pages.select("page_id", "url", *[c.alias(k) for k, c in out.items()])


def facts_to_candidates(facts: DataFrame, labels: str = "categoryLabels") -> DataFrame:
    """Candidates of pages with a name: type and category inferred from the labels, which are kept as notes."""
    text = F.array_join(F.coalesce(labels, F.array().cast("array<string>")), " ")
    categories, _ = X.keyword_labels(text, fixed.CATEGORY_KEYWORDS)
    types, _ = X.keyword_labels(text, fixed.TYPE_KEYWORDS)
    kept = facts.where("name is not null")
    return kept.select(F.col("url").alias("id"), "name", "city", F.try_element_at(types, F.lit(1)).alias("type"), F.try_element_at(categories, F.lit(1)).alias("category"), F.array_join(labels, ", ").alias("notes"))


def reach(seeds: DataFrame, edges: DataFrame, rounds: list | None = None) -> DataFrame:
    """id, depth: the least number of edges (a, b) from a seed (id) to each node that one leads to.

    Stretches of nodes with one way in and one way out are shortened first, by pointers that double their length each round; what
    is left are weighted edges between the other nodes, whose depths are relaxed until none gets less. So the number of
    rounds grows with the logarithm of the stretches and the number of forks and joins on a way, not with the depth. rounds
    gets a name for each.
    """
    told = (lambda _: None) if rounds is None else rounds.append
    edges = stored(edges.where("a is not null and b is not null and a <> b").select("a", "b").distinct(), "edges")
    start = seeds.select("id").where("id is not null").distinct()
    one_in = edges.groupBy(F.col("b").alias("id")).agg(F.count("*").alias("n"), F.min("a").alias("head")).where("n = 1").select("id", "head")
    one_out = edges.groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n")).where("n = 1").select("id")
    inner = stored(one_in.join(one_out, "id").join(start, "id", "left_anti").withColumn("far", F.lit(1).cast("long")), "stretch")
    # head: a node before id, far edges away. Each round doubles far where the head is an inner node itself
    stretch, most = inner, inner.count()
    for _ in range(most.bit_length()):
        told("double")
        via = stretch.select(F.col("id").alias("head"), F.col("head").alias("next"), F.col("far").alias("more"))
        step = stored(stretch.join(via, "head", "left").select("id", F.coalesce("next", "head").alias("head"), (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"), "next"), "stretch")
        stretch = step.select("id", "head", "far")
        if not step.where("next is not null").limit(1).count():
            break
    # after as many rounds, heads that are inner nodes are on circles that nothing leads into: no seed reaches them
    stretch = stretch.join(inner.select(F.col("id").alias("head")), "head", "left_anti").select("id", "head", "far")
    named = stretch.select("id", F.col("head").alias("from"), "far")
    outer = edges.join(inner.select(F.col("id").alias("b")), "b", "left_anti").join(named.withColumnRenamed("id", "a"), "a", "left")
    outer = stored(outer.join(inner.select(F.col("id").alias("a"), F.lit(True).alias("is_inner")), "a", "left").where("from is not null or is_inner is null").groupBy(F.coalesce("from", "a").alias("a"), "b").agg(F.min(F.coalesce(F.col("far"), F.lit(0)) + 1).alias("weight")), "edges")
    depths = frontier = stored(start.withColumn("depth", F.lit(0).cast("long")), "depths")
    while frontier.limit(1).count():
        told("relax")
        near = frontier.withColumnRenamed("id", "a").join(outer, "a").groupBy(F.col("b").alias("id")).agg(F.min(F.col("depth") + F.col("weight")).alias("depth"))
        known = depths.select("id", F.col("depth").alias("old"))
        frontier = stored(near.join(known, "id", "left").where("old is null or depth < old").select("id", "depth"), "frontier")
        depths = stored(depths.join(frontier.select("id"), "id", "left_anti").unionByName(frontier), "depths")
    inside = stretch.join(depths.select(F.col("id").alias("head"), "depth"), "head").select("id", (F.col("depth") + F.col("far")).alias("depth"))
    return depths.unionByName(inside).select("id", F.col("depth").cast("int").alias("depth"))


def crawl_reach(seeds: DataFrame, edges: DataFrame, most: int | None = None, named: DataFrame | None = None, target: int | None = None, max_depth: int | None = None) -> DataFrame:
    """What a crawl from seeds over edges (a, b) visits, each node once.

    Without most: id, depth, as reach. With most (a budget of visits), breadth first: id, depth, pos, the visits in queue order
    - seeds by seeds.pos, then by the visit of the page that links and the link's place (edges.place) - and no visit after the
    target-th one that is in named (id). max_depth is a guard: beyond it this raises.
    """
    if most is None:
        found = reach(seeds, edges)
        if max_depth is not None and found.where(F.col("depth") > max_depth).limit(1).count():
            raise RuntimeError(f"the crawl is deeper than {max_depth}")
        return found
    frontier = stored(queued(seeds.select("id", F.struct(F.lit(0).alias("by"), F.col("pos").alias("place")).alias("key")), 0, 0, most, named), "frontier")
    parts, depth = [frontier], 0
    while True:
        if len(parts) > 16:
            parts = [stored(functools.reduce(DataFrame.union, parts), "visited")]
        visited = functools.reduce(DataFrame.union, parts)
        so_far = visited.count()
        if so_far >= most or (target is not None and visited.where("named").count() >= target):
            break
        step = frontier.withColumnRenamed("id", "a").join(edges, "a")
        keyed = step.select(F.col("b").alias("id"), F.struct(F.col("pos").alias("by"), "place").alias("key"))
        frontier = stored(queued(keyed.join(visited.select("id"), "id", "left_anti"), depth + 1, so_far, most - so_far, named), "frontier")
        if not frontier.limit(1).count():
            break
        depth += 1
        if max_depth is not None and depth > max_depth:
            raise RuntimeError(f"the crawl is deeper than {max_depth}")
        parts.append(frontier)
    if target is not None:
        seen = F.sum(F.col("named").cast("int")).over(W.orderBy("pos"))  # at most `most` rows
        visited = visited.withColumn("seen", seen - F.col("named").cast("int")).where(F.col("seen") < target)
    return visited.select("id", "depth", "pos")


def queued(keyed: DataFrame, depth: int, before: int, most: int, named: DataFrame | None) -> DataFrame:
    """The first most ids by key, numbered on from before."""
    first = keyed.groupBy("id").agg(F.min("key").alias("key")).orderBy("key", "id").limit(most)
    rows = first.withColumn("pos", F.row_number().over(W.orderBy("key", "id")) - 1 + before).select("id", F.lit(depth).alias("depth"), "pos")
    if named is None:
        return rows.withColumn("named", F.lit(True))
    return rows.join(named.select("id").distinct().withColumn("named", F.lit(True)), "id", "left").fillna(False, ["named"])


def blocked_address(ip: Column) -> Column:
    """Is this number of an IPv4 address in a blocked range?"""
    inside = F.lit(False)
    for cidr in fixed.BLOCKED_RANGES:
        address, bits = cidr.split("/")
        low = sum(int(x) << 8 * (3 - i) for i, x in enumerate(address.split(".")))
        inside = inside | ip.between(low, low + (1 << 32 - int(bits)) - 1)
    return F.coalesce(inside, F.lit(False))


def flag_private_hosts(df: DataFrame, host: str, scheme: str | None = None) -> DataFrame:
    """blocked: another scheme than http(s), localhost, or an address in a blocked range, also an IPv4 one that is written
    as IPv6 (dotted or in hexadecimal, with or without brackets)."""
    lower = F.regexp_replace(F.lower(F.trim(host)), r"^\[(.*)\]$", "$1")
    dotted = X.ipv4(F.regexp_extract(lower, r"^(?:0*:)+ffff:(\d+\.\d+\.\d+\.\d+)$", 1))
    pair = [F.conv(F.nullif(F.regexp_extract(lower, r"^(?:0*:)+ffff:([0-9a-f]{1,4}):([0-9a-f]{1,4})$", i), F.lit("")), 16, 10).cast("long") for i in (1, 2)]
    six = lower.rlike(r"^[0:]*:0*1?$") | lower.rlike("^f[cd][0-9a-f]{0,2}:") | lower.rlike("^fe[89ab][0-9a-f]?:")
    other = ~F.lower(F.col(scheme)).isin("http", "https") if scheme else F.lit(False)
    address = F.coalesce(X.ipv4(lower), dotted, pair[0] * 65536 + pair[1])
    return df.withColumn("blocked", F.coalesce(other | (lower == "localhost") | six | blocked_address(address), F.lit(False)))
