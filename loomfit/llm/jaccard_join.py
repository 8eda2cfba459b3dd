"""Near duplicates by a grouped prefix join on word n-grams.

Two texts are linked if the Jaccard similarity of their sets of distinct n-grams reaches a threshold. All
steps are exact:

* Texts with equal sets are one node. Nodes whose prefix and size are equal form a group, and only
  groups are joined.
* In any order of all n-grams, linked texts share one among the first few (the prefix). The order puts
  frequent n-grams last. Frequencies are counted over the lowest hashes of each node, where prefixes
  come from; a node with too few rare n-grams there is *deep*. Deep nodes are joined with each other in an
  order of their own, by exact counts over all their n-grams, and with the others in the common one.
* Group pairs pass filters on size and position, members are expanded, and sets are compared. First
  each group meets one pivot per n-gram, which settles most of a large family of copies; then only
  pairs that are still in different components are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FOLDED, Cells, Spans, forget, keep, query, read, small_batches, text_bytes

WORDS = 5
PERCENT = 80
HOT = 64  # nodes that share an n-gram from which on it is frequent
FILTER_BITS = 24  # cells of the filters of nodes and of frequent n-grams: 2 MB each at any size
TOKEN_BITS = 26  # cells of the filter of shared n-grams, 8 MB
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The distinct n-grams of each text as sorted 64-bit hashes; of a shorter text, one of all its words."""
    spans = Spans(texts)
    hashes = spans.hashes(FOLDED)

    def gram(begin: int, end: int, width: int) -> np.ndarray:
        out = np.full(max(end - begin - width + 1, 0), width, np.uint64)
        for k in range(width):
            out = (out ^ hashes[begin + k : begin + k + len(out)]) * _MULTIPLIER
            out ^= out >> np.uint64(29)
        return out

    every = gram(0, len(spans), words)
    out = []
    for begin, end in zip(spans.offsets[:-1].tolist(), spans.offsets[1:].tolist()):
        found = every[begin : end - words + 1] if end - begin >= words else gram(begin, end, end - begin)[: end > begin]
        found = np.sort(found)
        out.append(found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found)
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    """Sets as lists of signed numbers in the same order."""
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array((flat ^ np.uint64(1 << 63)).view(np.int64)))


def _node(found: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def _prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _low_size(n: int, percent: int) -> int:
    """How many of a node's lowest hashes are kept: half as many again as its prefix needs, and some."""
    return min(n, 3 * _prefix_size(n, percent) // 2 + 8)


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_bytes(F.col("text"))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("key"))


def _sketches(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, key, n, node and the lowest hashes of each document; the node of an empty text is null.

    ``key`` is a hash of the text, by which a node's text is found again without hashing the words of all others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            sets = shingles(batch.column("text"), words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) if len(s) else None for s in sets], pa.int64()),
                    _lists([s[: _low_size(len(s), percent)] for s in sets]),
                ],
                ["doc_id", "key", "n", "node", "low"],
            )

    rows = _keyed(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, key long, n long, node long, low array<long>")


def _sets(docs: DataFrame, words: int, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and tokens, the whole set, of the nodes in ``wanted``, from the text that stands for each in ``nodes``."""
    keys = nodes.select("node", "key").join(wanted.select("node"), "node", "left_semi")
    shared = docs.sparkSession.sparkContext.broadcast(Cells(keys.select("key"), FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = shared.value.holds(batch.column("key").to_numpy())
            for part in small_batches([batch.filter(pa.array(some))], "text"):
                named = [(_node(s), s) for s in shingles(part.column("text"), words) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node for node, _ in named], pa.int64()), _lists([s for _, s in named])], ["node", "tokens"]
                )

    found = _keyed(docs).select("text", "key").mapInArrow(run, "node long, tokens array<long>")
    return found.join(wanted.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])


def _frequent_of(nodes: DataFrame, frequent: DataFrame) -> DataFrame:
    """node, n, low and hot: the frequent n-grams among a node's lowest; only nodes that may have some."""
    shared = nodes.sparkSession.sparkContext.broadcast(Cells(frequent.select("token"), FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = batch.column("low")
            hit = np.concatenate([[0], np.cumsum(shared.value.holds(low.flatten().to_numpy()))])
            ends = low.offsets.to_numpy() - low.offsets[0].as_py()
            some = hit[ends[1:]] > hit[ends[:-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(some)], ["node", "n", "low", "some"])

    marked = nodes.select("node", "n", "low").mapInArrow(run, "node long, n long, low array<long>, some boolean")
    touched = keep(marked.filter("some").drop("some"))
    hot = (
        touched.select("node", F.explode("low").alias("token"))
        .join(frequent, "token", "left_semi")
        .groupBy("node")
        .agg(F.collect_list("token").alias("hot"))
    )
    out = keep(touched.join(hot, "node", "left"))
    forget(touched)
    return out


def _prefix_rows(nodes: DataFrame, shared_tokens: Cells) -> DataFrame:
    """The n-grams of prefixes that other nodes may have too: grp, node, n, deep, at, token.

    ``grp`` stands for the nodes with this prefix and size. A node without such n-grams has one row with none.
    """
    known = nodes.sparkSession.sparkContext.broadcast(shared_tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            tokens = prefix.flatten().to_numpy()
            ends = prefix.offsets.to_numpy().astype(np.int64) - prefix.offsets[0].as_py()
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            at = np.arange(len(tokens)) - ends[owner] + 1
            hit = np.flatnonzero(known.value.holds(tokens))
            rows = [batch.column(c).take(pa.array(owner[hit])) for c in ("grp", "node", "n", "deep")]
            yield pa.RecordBatch.from_arrays(
                [*rows, pa.array(at[hit]), pa.array(tokens[hit])], ["grp", "node", "n", "deep", "at", "token"]
            )

    named = nodes.select(F.xxhash64("n", "deep", "prefix").alias("grp"), "node", "n", "deep", "prefix")
    return named.mapInArrow(run, "grp long, node long, n long, deep boolean, at long, token long")


def _may_link(n1: Column, at1: Column, n2: Column, at2: Column, percent: int) -> Column:
    """Whether sets of these sizes that first meet at these places of their orders can be similar enough."""
    overlap = F.least(n1 - at1, n2 - at2) + 1
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (
        (100 + percent) * overlap >= percent * (n1 + n2)
    )


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough."""
    both = F.size(F.array_intersect("s", "t"))
    union = F.size("s") + F.size("t") - both
    return (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("s")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("t")), "b")
        .filter(100 * both >= percent * union)
        .select("a", "b")
    )


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that links (a, b) reach, for each node of a link.

    Large-star and small-star steps in turn, each written to the shared folder, until nothing changes.
    A node's neighbours are never gathered: steps are minima and joins.
    """

    def lowest(edges: DataFrame) -> DataFrame:
        return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = keep(large.filter("u <> v").distinct())
        small = large.join(lowest(large), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        before, edges = edges, keep(small.filter("u <> v").distinct())
        forget(before, large)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _groups(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The n-grams of each group that other groups have too, with their pivots, and the members (grp, node, first).

    The pivot of an n-gram is the group that has it earliest in its order.
    """
    rows = keep(rows)
    tokens = rows.drop("node").distinct()
    pivot = F.min(F.struct("at", "n", "grp")).alias("p")
    often = tokens.groupBy("token").agg(F.count("*").alias("c"), pivot).filter("c > 1").drop("c")
    members = rows.select("grp", "node").distinct()
    first = members.groupBy("grp").agg(F.min("node").alias("first"))
    out = keep(tokens.join(often, "token")), keep(members.join(first, "grp"))
    forget(rows)
    return out


def _pivot_pairs(shared: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes: the first of each group and of its n-grams' pivots, and of its other members."""
    pairs = (
        shared.filter(F.col("grp") != F.col("p.grp"))
        .filter(_may_link(F.col("n"), F.col("at"), F.col("p.n"), F.col("p.at"), percent))
        .select("grp", F.col("p.grp").alias("other"))
        .distinct()
    )
    first = members.filter("node = first").select("grp", "first")
    named = pairs.join(first, "grp").join(first.select(F.col("grp").alias("other"), F.col("first").alias("pivot")), "other")
    own = members.filter("node <> first").select("first", F.col("node").alias("pivot"))
    return named.select("first", "pivot").union(own).select(F.least("first", "pivot").alias("a"), F.greatest("first", "pivot").alias("b"))


def _group_pairs(shared: DataFrame, state: DataFrame, percent: int, not_both_deep: bool) -> DataFrame:
    """Pairs of groups that may link and are not yet wholly in one component.

    ``state`` has for each group the smallest and largest component of its members.
    """
    rows = shared.drop("p").join(state, "grp")
    left = rows.select("token", *[F.col(c).alias(f"{c}1") for c in rows.columns if c != "token"])
    right = rows.select("token", *[F.col(c).alias(f"{c}2") for c in rows.columns if c != "token"])
    apart = (F.col("low1") != F.col("high2")) | (F.col("high1") != F.col("low2"))
    can = (F.col("grp1") < F.col("grp2")) & apart & _may_link(F.col("n1"), F.col("at1"), F.col("n2"), F.col("at2"), percent)
    if not_both_deep:
        can &= ~(F.col("deep1") & F.col("deep2"))
    same = left["token"] == right["token"]
    return left.join(right, same & can).select(F.col("grp1").alias("a"), F.col("grp2").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Texts are compared by their distinct n-grams of ``words`` lower-cased (A-Z) words, a shorter text by all
    its words at once; they link if 100 * intersection >= ``percent`` * union. ``component_id`` is the
    smallest doc_id that links reach. Null and empty texts have no n-grams and are components of their own.
    Repeated rows and equal texts are one node, ids that occur with several texts join them, and a null id
    has a component only through other rows. An empty table gives no rows; other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    whole = keep(_sketches(docs, words, percent))
    nodes = keep(whole.filter("node is not null").select("node", "key", "n", "low").dropDuplicates(["node"]))
    sketches = keep(whole.select("doc_id", "n", "node"))
    forget(whole)  # the lists of lowest hashes stay once, by node

    counted = keep(
        nodes.select(F.explode("low").alias("token")).groupBy("token").agg(F.count("*").alias("c")).filter("c > 1")
    )
    frequent = counted.filter(F.col("c") > HOT)
    p = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    touched = _frequent_of(nodes, frequent).withColumn("p", p)
    cold = F.when(F.col("hot").isNull(), F.col("low")).otherwise(F.array_except("low", "hot"))
    touched = touched.withColumn("cold", cold).withColumn("deep", F.size("cold") < F.col("p"))
    untouched = nodes.join(touched.select("node"), "node", "left_anti") if touched.take(1) else nodes
    common = untouched.select("node", "n", F.lit(False).alias("deep"), F.slice("low", 1, p).alias("prefix")).union(
        touched.filter("not deep").select("node", "n", "deep", F.slice("cold", 1, F.col("p")))
    )
    shared_tokens = counted.select("token")
    deep = keep(touched.filter("deep").select("node", "n", "p"))
    some_deep = bool(deep.take(1))
    joins: list[tuple[DataFrame, DataFrame, bool]] = []
    if some_deep:
        tokens = keep(_sets(docs, words, nodes, deep).join(deep, "node").select("node", "n", "p", F.explode("tokens").alias("token")))
        counts = keep(tokens.groupBy("token").agg(F.count("*").alias("c")))
        placed = (
            tokens.join(counts, "token")
            .join(frequent.select("token", F.col("c").alias("f")), "token", "left")
            .groupBy("node", "n", "p")
            .agg(
                F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "token"))).alias("common"),
                F.sort_array(F.collect_list(F.struct("c", "token"))).alias("own"),
            )
        )
        placed = keep(
            placed.select("node", "n", F.lit(True).alias("deep"), *[F.slice(f"{c}.token", 1, F.col("p")).alias(c) for c in ("common", "own")])
        )
        common = common.union(placed.select("node", "n", "deep", "common"))
        shared_tokens = shared_tokens.union(placed.select(F.explode("common")))
        own = placed.select("node", "n", "deep", F.col("own").alias("prefix"))
        forget(tokens)
        joins.append((*_groups(_prefix_rows(own, Cells(counts.filter("c > 1").select("token"), TOKEN_BITS))), False))
    joins.append((*_groups(_prefix_rows(common, Cells(shared_tokens, TOKEN_BITS))), some_deep))

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for part in parts[1:]:
            out = out.union(part)
        return out.distinct()

    first = keep(union([_pivot_pairs(shared, members, percent) for shared, members, _ in joins]))
    links = _check(docs, nodes, words, first, percent)
    roots = keep(components(links))

    wide = []
    for shared, members, flag in joins:
        at = keep(members.join(roots, "node", "left").select("grp", "node", F.coalesce("root", "node").alias("root")))
        state = keep(at.groupBy("grp").agg(F.min("root").alias("low"), F.max("root").alias("high")))
        found = _group_pairs(shared, state, percent, flag).union(state.filter("low <> high").select(F.col("grp").alias("a"), F.col("grp").alias("b")))
        expanded = found.join(at.select(F.col("grp").alias("a"), F.col("node").alias("x"), F.col("root").alias("rx")), "a").join(
            at.select(F.col("grp").alias("b"), F.col("node").alias("y"), F.col("root").alias("ry")), "b"
        )
        wide.append(
            expanded.filter("rx <> ry").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
    second = keep(union(wide).join(first, ["a", "b"], "left_anti"))
    if second.take(1):
        links = links.union(_check(docs, nodes, words, second, percent))
    return _labelled(sketches, components(keep(_with_repeated_ids(sketches, links))))


def _may_agree(x: Column, nx: Column, y: Column, ny: Column, percent: int) -> Column:
    """Whether the lowest hashes x and y of two nodes leave room for enough n-grams in common.

    Up to the smaller of their last hashes both lists are complete, so there a node has at most as many
    n-grams of its own as it may have in all.
    """
    reach = F.least(F.element_at(x, -1), F.element_at(y, -1))
    both = F.size(F.array_intersect(x, y))
    least = F.ceil(percent * (nx + ny) / (100 + percent))
    within = lambda low: F.size(F.filter(low, lambda v: v <= reach))
    return (within(x) - both <= nx - least) & (within(y) - both <= ny - least)


def _check(docs: DataFrame, nodes: DataFrame, words: int, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs that link: first their lowest hashes are compared, then the whole sets of those that may.

    A pair's lists are compared row by row in the JVM, so no batch of many pairs of long texts is ever held.
    """
    lists = pairs.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("nx"), F.col("low").alias("x")), "a").join(
        nodes.select(F.col("node").alias("b"), F.col("n").alias("ny"), F.col("low").alias("y")), "b"
    )
    good = _may_agree(F.col("x"), F.col("nx"), F.col("y"), F.col("ny"), percent)
    pairs = keep(lists.filter(good).select("a", "b"))
    needed = keep(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    sets = keep(_sets(docs, words, nodes, needed))
    links = keep(_linked(pairs, sets, percent))
    forget(sets, needed, pairs)
    return links


def _with_repeated_ids(sketches: DataFrame, links: DataFrame) -> DataFrame:
    """The links, and links between the nodes of one doc_id."""
    ids = sketches.filter("node is not null and doc_id is not null")
    spread = ids.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z").drop("z")
    return links.union(ids.join(spread, "doc_id").select("a", F.col("node").alias("b")).filter("a <> b"))


def _labelled(sketches: DataFrame, roots: DataFrame) -> DataFrame:
    rows = sketches.select("doc_id", "n", "node").join(roots, "node", "left")
    rows = rows.withColumn("root", F.coalesce("root", "node"))
    lowest = rows.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("lowest"))
    return rows.join(lowest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("lowest", "doc_id").alias("component_id")
    )


@query("op9_jaccard_join")
def op9_jaccard_join(spark, sf):
    return near_duplicates(read(spark, sf, "documents"), words=4, percent=85)
