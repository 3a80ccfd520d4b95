"""Exact Jaccard join of documents on word n-grams, by prefix trees.

1. Each text becomes a set of 64-bit n-gram hashes; equal sets become one node, named by a hash of the set.
2. A node can only have a partner if enough of its smallest hashes occur in another node (a prefix of each set is
   exchanged, in hash order). Nodes without are done; this is the only step that moves a share of all n-grams.
3. Over the rest, n-grams are ordered globally from rare to frequent. Two nodes that link share an n-gram in their
   prefixes of this order.
4. Every link is found by a walk of a prefix tree: a task stores some sets in a tree, in that order, and walks it with
   each of its other sets. Overlaps are shared by all sets below a branch, and a branch is left when what remains of both
   sets cannot reach the threshold. Nodes that prefix n-grams join are a cluster; one of at most STORED elements is one
   task, whose sets all walk the tree of all. In a larger one each n-gram's pivot (one of its holders) is stored and its
   other holders of a fitting size walk: linear in the rows, and near copies become one component.
5. Then only n-grams of large clusters whose holders are in several components are left. Components that such n-grams join
   are one task; more than WALKING elements are cut into ranges of their n-grams and classes of set sizes (a set walks its
   own and the two next classes only). A set is sent to each task once. The holders of an n-gram's largest component
   walk but are not stored: what they could find among each other is one component already.
6. A task with more than STORED or WALKING elements is cut into parts; each part of the stored sets meets each part of the
   walking ones. Links give connected components. A task returns the links that join components, not all pairs.

Everything is exact (up to equal 64-bit hashes): no cap on holders, partners or candidates.

A null or empty text has an empty set and links with nothing (its component is its own id). A null doc_id links
with nothing and has a null component. Repeated rows are one node; an id with several texts has a row for each, with the
component of that text. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgmill.llm.common import BROADCAST_KEYS, buffers, distinct_rows, lean, mix, settled, slices, stored, texts, without_rows, word_hashes, word_spans
from orgmill.llm.components import components

#: Elements of the sets that one task stores in its tree, and of those that walk it, about.
STORED, WALKING = 200_000, 2_000_000
SETS = "doc_id long, n_shingles long, k1 long, k2 long, grams array<long>"


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int):
    """The sorted distinct n-gram hashes of each text; a text with fewer words has its whole sequence as one."""
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    step = np.uint64(0x9E3779B97F4A7C15)
    grams = np.zeros(len(h), np.uint64)
    for k in range(n):
        grams[: len(h) - k] = mix(grams[: len(h) - k] * step + h[k:])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            whole = np.uint64(b - a)
            for x in h[a:b]:
                whole = mix(np.array([whole * step + x], np.uint64))[0]
            yield np.array([whole], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def least_overlap(n: int, percent: int) -> int:
    """Of a set of n elements with any partner."""
    return -(-percent * n // 100)


def sets_of(df: DataFrame, n: int, percent: int, whole: bool) -> DataFrame:
    """whole: all hashes; else the prefix in hash order of which some must occur elsewhere."""

    def read(batches):
        for batch in batches:
            for part in slices(batch, size=2 << 20):
                counts, k1, k2, grams = [], [], [], []
                with np.errstate(over="ignore"):
                    for s in gram_sets(*buffers(part.column("text")), n):
                        m = len(s)
                        counts.append(m)
                        k1.append(int(mix(s).sum(dtype=np.uint64).astype(np.int64)) if m else 0)
                        k2.append(int(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)) if m else 0)
                        grams.append(s if whole else s[: m - least_overlap(m, percent) + m // 10 + 1])
                flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
                at = np.concatenate([[0], np.cumsum([len(g) for g in grams])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), lists], names=["doc_id", "n_shingles", "k1", "k2", "grams"])

    return df.mapInArrow(lean(read), SETS)


class PrefixTree:
    """Ascending integer sequences with shared beginnings stored once; a chain without a branch is one segment, cut
    where a set must have met its partner at the latest. sizes: of the sets, with elements that no other set has."""

    def __init__(self, sets: list[np.ndarray], sizes: list[int], percent: int):
        order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        shared = np.zeros(len(order) + 1, np.int64)  # elements that a sequence has in common with the one before
        for k in range(1, len(order)):
            x, y = sets[order[k - 1]], sets[order[k]]
            m = min(len(x), len(y))
            differ = np.flatnonzero(x[:m] != y[:m])
            shared[k] = differ[0] if len(differ) else m
        segments, parents, starts = [], [], []
        self.ends: list[list[int]] = []

        def add(own: np.ndarray, depth: int, parent: int, ends: list[int]) -> int:
            segments.append(own)
            parents.append(parent)
            starts.append(depth)
            self.ends.append(ends)
            return len(segments) - 1

        todo = [(0, len(order), 0, -1)] if order else []
        while todo:
            low, high, depth, parent = todo.pop()
            own = sets[order[low]]
            if high - low == 1:
                cut = len(own) - least_overlap(sizes[order[low]], percent) + 1
                if depth < cut < len(own):
                    parent, depth = add(own[depth:cut], depth, parent, []), cut
                add(own[depth:], depth, parent, [order[low]])
                continue
            end = int(shared[low + 1 : high].min())
            node = add(own[depth:end], depth, parent, [])
            cuts = [low, *(low + 1 + np.flatnonzero(shared[low + 1 : high] == end)).tolist(), high]
            todo += [(x, y, end, node) for x, y in zip(cuts, cuts[1:])]
        n = len(segments)
        self.lengths = np.array([len(s) for s in segments], np.int64)
        self.flat = np.concatenate(segments) if segments else np.zeros(0, np.int64)
        self.at, starts_ = np.cumsum(self.lengths) - self.lengths, np.array(starts, np.int64)
        self.last = np.array([s[-1] if len(s) else -1 for s in segments], np.int64)
        self.low, self.high = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)  # sizes of the sets below
        longest = np.zeros(n, np.int64)
        kids: list[list[int]] = [[] for _ in range(n + 1)]  # the root is in kids[-1]
        for x in range(n - 1, -1, -1):
            kids[parents[x]].append(x)
            for i in self.ends[x]:
                self.low[x], self.high[x], longest[x] = min(self.low[x], sizes[i]), max(self.high[x], sizes[i]), max(longest[x], len(sets[i]))
            for y in kids[x]:
                self.low[x], self.high[x], longest[x] = min(self.low[x], self.low[y]), max(self.high[x], self.high[y]), max(longest[x], longest[y])
        self.rest = longest - starts_ - self.lengths  # elements of the longest set below that are still to come
        self.kids = [np.array(k, np.int64) for k in kids]

    def near(self, own: np.ndarray, size: int, member: np.ndarray, percent: int):
        """(i, overlap) of stored sets that reach the threshold with own; member: own as marks over all elements."""
        nodes, overlaps = self.kids[-1], np.zeros(len(self.kids[-1]), np.int64)
        while len(nodes):
            fits = (self.high[nodes] * 100 >= percent * size) & (self.low[nodes] * percent <= 100 * size)
            nodes, overlaps = nodes[fits], overlaps[fits]
            lengths = self.lengths[nodes]
            shift = np.cumsum(lengths) - lengths
            where = np.repeat(self.at[nodes] - shift, lengths) + np.arange(int(lengths.sum()))
            marks = np.concatenate([[0], np.cumsum(member[self.flat[where]], dtype=np.int64)])
            overlaps = overlaps + marks[shift + lengths] - marks[shift]
            rest = np.minimum(len(own) - np.searchsorted(own, self.last[nodes], side="right"), self.rest[nodes])
            alive = overlaps + rest >= -(-percent * (size + self.low[nodes]) // (100 + percent))
            nodes, overlaps = nodes[alive], overlaps[alive]
            for x, o in zip(nodes.tolist(), overlaps.tolist()):
                for i in self.ends[x]:
                    yield i, o
            counts = np.array([len(self.kids[x]) for x in nodes.tolist()], np.int64)
            overlaps = np.repeat(overlaps, counts)
            nodes = np.concatenate([self.kids[x] for x in nodes.tolist()]) if len(nodes) else nodes


def tree_links(ids: list[int], known: list[int], in_tree: list[bool], walks: list[bool], ranked: list[np.ndarray], sizes: list[int], percent: int) -> list[tuple[int, int]]:
    """Links between walking and stored sets of different components, one for each two components that meet."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    size = max((int(s[-1]) for s in ranked if len(s)), default=-1) + 1
    member, found = np.zeros(size, np.int8), []
    kept = [i for i in range(len(ids)) if in_tree[i]]
    tree = PrefixTree([ranked[i] for i in kept], [sizes[i] for i in kept], percent)
    for j in range(len(ids)):
        if not walks[j]:
            continue
        member[ranked[j]] = 1
        for place, overlap in tree.near(ranked[j], sizes[j], member, percent):
            i = kept[place]
            if ids[i] != ids[j] and 100 * overlap >= percent * (sizes[i] + sizes[j] - overlap) and (a := root(known[i])) != (b := root(known[j])):
                parent[a] = b
                found.append((ids[i], ids[j]))
        member[ranked[j]] = 0
    return found


def walk(percent: int):
    """The links of one task: rows of node, n, component, in_tree, walks and g (n-grams that other sets have)."""

    def run(table: pa.Table) -> pa.Table:
        lists = pa.concat_arrays(table["g"].chunks)
        at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        grams, index, counts = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        order = np.lexsort((grams, counts))  # rare ones of this task first
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        rank = rank[index]
        ranked = [np.sort(rank[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        found = tree_links(*(table[k].to_pylist() for k in ("node", "component", "in_tree", "walks")), ranked, table["n"].to_pylist(), percent)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return run


def walked(tasks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links a, b. tasks: task, node, component, in_tree, walks (distinct task and node); sets: node, n, size, g.

    Up to BROADCAST_KEYS rows of tasks are broadcast, so that sets go to their tasks in one exchange."""
    sized = tasks.join(sets.select("node", "size"), "node")
    parts = sized.groupBy("task").agg(*[F.ceil(F.sum(F.when(F.col(k), F.col("size")).otherwise(0)) / most).cast("int").alias(k + "_parts") for k, most in (("in_tree", STORED), ("walks", WALKING))])
    cut = tasks.join(parts.where("in_tree_parts > 0 and walks_parts > 0"), "task")
    own = lambda k: F.pmod(F.xxhash64("node", F.lit(k)), F.col(k + "_parts")).cast("int")
    every = lambda k: F.sequence(F.lit(0), F.col(k + "_parts") - 1)
    stored_at = cut.where("in_tree").select("task", "node", "component", F.lit(True).alias("in_tree"), F.lit(False).alias("walks"), own("in_tree").alias("p"), F.explode(every("walks")).alias("q"))
    walks_at = cut.where("walks").select("task", "node", "component", F.lit(False).alias("in_tree"), F.lit(True).alias("walks"), F.explode(every("in_tree")).alias("p"), own("walks").alias("q"))
    placed = stored_at.union(walks_at).groupBy("task", "p", "q", "node").agg(F.first("component").alias("component"), F.max("in_tree").alias("in_tree"), F.max("walks").alias("walks"))
    placed = stored(placed, "placed")
    placed = F.broadcast(placed) if placed.count() <= BROADCAST_KEYS else placed
    return sets.select("node", "n", "g").join(placed, "node").groupBy("task", "p", "q").applyInArrow(lean(walk(percent)), "a long, b long")


def with_cluster(df: DataFrame, clusters: DataFrame) -> DataFrame:
    """Rows of these clusters with the clusters' columns. Large clusters are few (each has more than STORED elements); they
    are broadcast after a check of their number, so that the rows of a cluster need not meet in one task."""
    return df.join(F.broadcast(clusters) if clusters.count() <= BROADCAST_KEYS else clusters, "cluster")


def without_clusters(df: DataFrame, clusters: DataFrame) -> DataFrame:
    few = clusters.select("cluster")
    return df.join(F.broadcast(few) if few.count() <= BROADCAST_KEYS else few, "cluster", "left_anti")


def links(df: DataFrame, n: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(rows, links): rows has doc_id, n_shingles, node and first (the node's smallest id; both null for an empty set or a
    null id) for each row of df; links has a, b (nodes)."""
    docs = texts(df)
    name = F.xxhash64("n_shingles", "k1", "k2")
    rows = stored(sets_of(docs, n, percent, False).withColumn("node", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), name)), "sets")
    usable = rows.where("node is not null")
    firsts = usable.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("n_shingles").alias("n"))
    named = rows.drop("grams", "k1", "k2").join(firsts.select("node", "first"), "node", "left")
    # 2. only nodes of whose prefix enough is shared; equal sets have equal prefixes, so any of them stands for the node
    grams = usable.groupBy("node").agg(F.first("grams").alias("grams")).select("node", F.explode("grams").alias("g"))
    shared = grams.groupBy("g").agg(F.count("*").alias("c")).where("c > 1").select("g")
    enough = f"c >= floor(ceil({percent} * n / 100) / 10) + 1"
    alive = stored(grams.join(shared, "g").groupBy("node").agg(F.count("*").alias("c")).join(firsts, "node").where(enough).select("node", "first"), "alive")
    ids = alive.select(F.col("first").alias("doc_id")).distinct()
    whole = docs.join(F.broadcast(ids) if alive.count() <= BROADCAST_KEYS else ids, "doc_id", "left_semi")  # so that texts stay where they are
    sets = sets_of(whole, n, percent, True).select(name.alias("node"), F.col("n_shingles").alias("n"), "grams")
    sets = stored(sets.join(alive.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")
    # 3. the prefix from rare to frequent; what occurs once cannot be shared but takes the first places
    single = sets.select("node", F.explode("grams").alias("g"))
    often = single.groupBy("g").agg(F.count("*").alias("c")).where("c > 1")
    ranked = single.join(often, "g").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("c", "g"))).alias("grams"))
    ranked = ranked.select("node", F.size("grams").alias("size"), F.col("grams.g").alias("g")).join(sets.select("node", "n"), "node")
    need = F.expr(f"cast(ceil({percent} * n / 100) as int)")
    ranked = stored(ranked.where(F.col("size") >= need), "ranked")
    prefix = ranked.select("node", "n", "size", F.explode(F.slice("g", 1, F.greatest(F.lit(0), F.col("size") - need + 1))).alias("g"))
    prefix = stored(prefix.join(prefix.groupBy("g").agg(F.count("*").alias("c")).where("c > 1").select("g"), "g"), "prefix")
    # 4. clusters of nodes that prefix n-grams join; small ones are one task, in large ones holders walk the trees of pivots
    pivots = prefix.groupBy("g").agg(F.min_by(F.struct("node", "n", "size"), F.struct(F.xxhash64("node"), "node")).alias("pivot"))
    met = stored(prefix.join(pivots, "g").where("node <> pivot.node").select("node", "n", "pivot").distinct(), "met")
    cluster = components(met.select(F.col("node").alias("a"), F.col("pivot.node").alias("b"))).withColumnRenamed("component", "cluster")
    nodes = stored(cluster.join(ranked.select("node", "size"), "node"), "clusters")
    large = stored(nodes.groupBy("cluster").agg(F.sum("size").alias("elements")).where(f"elements > {STORED}"), "large")
    small = without_clusters(nodes, large).select(F.xxhash64("cluster").alias("task"), "node", F.lit(True).alias("in_tree"), F.lit(True).alias("walks"))
    inside = with_cluster(nodes, large)
    fits = met.where(f"100 * pivot.n >= {percent} * n and 100 * n >= {percent} * pivot.n").join(inside.select("node", "cluster"), "node")
    trees = fits.select("cluster", "pivot.node", "pivot.size").distinct().groupBy("cluster").agg(F.ceil(F.sum("size") / STORED).alias("parts"))
    fits = stored(with_cluster(fits, stored(trees, "trees")).withColumn("task", F.xxhash64("cluster", F.pmod(F.xxhash64("pivot.node", F.lit("tree")), "parts"))), "fits")
    roles = [fits.select("task", F.col(k).alias("node"), F.lit(k == "pivot.node").alias("in_tree"), F.lit(k == "node").alias("walks")) for k in ("pivot.node", "node")]
    tasks = small.union(roles[0].union(roles[1]).groupBy("task", "node").agg(F.max("in_tree").alias("in_tree"), F.max("walks").alias("walks")))
    first_links = stored(walked(tasks.withColumn("component", F.col("node")), ranked, percent), "links")
    # 5. n-grams of large clusters whose holders are in several components
    known = components(first_links)
    held = prefix.join(inside.select("node"), "node", "left_semi").join(known, "node", "left").select("g", "node", "n", "size", F.coalesce("component", "node").alias("component"))
    mixed = held.groupBy("g", "component").agg(F.count("*").alias("c")).groupBy("g").agg(F.count("*").alias("components"), F.max_by("component", F.struct("c", "component")).alias("largest")).where("components > 1")
    held = stored(held.join(mixed, "g").withColumn("minor", F.col("component") != F.col("largest")), "held")
    cluster = components(held.where("minor").select(F.col("component").alias("a"), F.col("largest").alias("b")).distinct()).select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    held = stored(held.join(cluster, "component"), "held")
    crowded = stored(held.select("cluster", "node", "size").distinct().groupBy("cluster").agg(F.sum("size").alias("elements")).where(f"elements > {WALKING}"), "crowded")
    small = without_clusters(held, crowded).select(F.xxhash64("cluster").alias("task"), "node", "component", F.col("minor").alias("in_tree"), F.lit(True).alias("walks"))
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(1.001 * math.log(100 / percent) if percent < 100 else 1.0))  # a linked set is in the same class or in the next one
    large = with_cluster(held, crowded).withColumn("range", F.pmod(F.xxhash64("g"), F.ceil(F.col("elements") / WALKING))).withColumn("class", size_class)
    columns = [F.xxhash64("cluster", "range", "class").alias("task"), "node", "component"]
    in_tree = large.where("minor").select(*columns, F.lit(True).alias("in_tree"), F.lit(False).alias("walks"))
    walking = large.withColumn("class", F.explode(F.array(*[F.col("class") + k for k in (-1, 0, 1)]))).select(*columns, F.lit(False).alias("in_tree"), F.lit(True).alias("walks"))
    tasks = small.union(in_tree).union(walking).groupBy("task", "node", "component").agg(F.max("in_tree").alias("in_tree"), F.max("walks").alias("walks"))
    return named, first_links.union(stored(walked(tasks, ranked, percent), "links"))


def classes(df: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of df."""
    named, found = links(df, n, percent)
    known = components(found)
    least = known.join(named.where("node is not null").select("node", "first").distinct(), "node").groupBy("component").agg(F.min("first").alias("least"))
    known = known.join(least, "component").select("node", "least")
    return named.join(known, "node", "left").select("doc_id", "n_shingles", F.coalesce("least", "first", "doc_id").alias("component_id"))


def keep_one(df: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one document of each class: that with the smallest id. Rows with one id and one text count once; rows
    without an id stay all, as nothing says that they are one document."""
    own = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    gone = settled(df.sparkSession, "copies", lambda: classes(own, n, percent).where("doc_id <> component_id").select(F.col("doc_id").alias("id"), F.lit(None).cast("long").alias("key")))
    return distinct_rows(without_rows(df, gone, id_col, text_col), id_col, text_col)
