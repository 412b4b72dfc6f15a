"""Near-duplicates by MinHash with a signature-coordinate inverted join.

A document's set holds its distinct five-word shingles (A-Z lower-cased; a text
of fewer words is one shingle).  Documents are linked when the Jaccard
similarity of their sets is at least ``SIMILARITY``; groups are the connected
components of the links.

1. Sets are signed with ``COORDINATES`` minima.  Documents of equal sets form a
   class; one of them stands for it, so copies never meet each other.
2. Each class is posted under each (coordinate, value) pair.  Lists of one class
   are skipped: they cannot collide.  A class with fewer than ``MATCHES`` other
   lists has no partner.
3. Two classes that agree in ``MATCHES`` coordinates share one of the first
   (m - MATCHES + 1) of the m lists of each, lists taken in one order, shortest
   first.  So only these short lists are merged, and the long ones skipped; the
   signatures of a pair that met there decide how many coordinates agree.
4. Pairs of at least ``MATCHES`` agreements are confirmed on the full sets.

A list is not expanded into all its pairs.  First its members are paired with
one hub per list and size band; confirmed links make components; a second time
with other hubs.  Members of a list that are then still in different components,
and share enough of their sets with others there, are compared on the full sets
with the most central of them, and those not linked through it are paired where
they differ from it in the same shingles (``offset_pairs``).  A link inside a
component changes nothing, so the components are those of all links.

With similarity s the number of agreements is binomial (COORDINATES, s): at the
least similarity, 0.75, fewer than 33 of 64 agree with probability 1e-5.

Cases: null texts and texts without a word have an empty set and are linked
with nothing; the id of a component is its smallest id, null ids counting as
largest; rows that repeat an id are documents of their own; an empty table gives
an empty one; texts of any length are read whole; extra columns stay with
``deduplicate`` and are not read by ``components_of``.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postwright.llm.common import (
    WordIds, map_rows, mixed, small_side, stage, unstage, windows, with_fields, words_of,
)

SHINGLE = 5
#: Least similarity, in per cent.
SIMILARITY = 75
COORDINATES = 64
#: Coordinates in which a pair must agree.
MATCHES = 33
SEED = 7

_FACTORS = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) + np.uint64(SEED << 32)) | np.uint64(1)


def shingles(text: str | None, ids: WordIds) -> np.ndarray:
    """The set of a text, as sorted distinct 64-bit hashes."""
    words = words_of(text, lower=True) if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = ids(words)
    if len(words) < SHINGLE:
        return mixed(windows(hashes, len(words)) + np.uint64(len(words)))
    return np.unique(windows(hashes, SHINGLE))


def signature(found: np.ndarray) -> np.ndarray:
    """The minima of a set under COORDINATES orders, 32 bits each."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(found), 2048):
        part = np.multiply.outer(found[k : k + 2048], _FACTORS)
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets are similar enough, without rounding."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= SIMILARITY * (len(a) + len(b) - both)


def signed(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_shingles, set_hash, signature, _row) of each document, staged."""
    source = documents.select(key, F.col(text).alias("_text"))
    schema = with_fields(source, [key], "n_shingles bigint, set_hash binary, signature array<int>")

    def make():
        ids = WordIds()

        def work(batch: pa.RecordBatch) -> dict:
            counts, hashes, signatures = [], [], []
            for value in batch.column(1).to_pylist():
                found = shingles(value, ids)
                counts.append(len(found))
                some = len(found) > 0
                hashes.append(xxhash.xxh3_128_digest(found.tobytes()) if some else None)
                signatures.append(signature(found) if some else None)
            return {
                key: batch.column(0), "n_shingles": counts, "set_hash": hashes,
                "signature": signatures,
            }

        return work

    found = map_rows(source, schema, make)
    return stage(found.withColumn("_row", F.monotonically_increasing_id()), "signed")


def classes_of(found: DataFrame, key: str) -> DataFrame:
    """One row per different set: node, set_hash, size, signature and its smallest id; staged."""
    grouped = found.filter(F.col("set_hash").isNotNull()).groupBy("set_hash").agg(
        F.min(key).alias("first_id"), F.first("n_shingles").alias("size"),
        F.first("signature").alias("signature"),
    )
    return stage(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")


def _tokens(classes: DataFrame) -> DataFrame:
    return classes.select("node", F.posexplode("signature").alias("at", "value")).select(
        "node", F.xxhash64("at", "value").alias("token")
    )


def postings(classes: DataFrame) -> DataFrame:
    """(node, size, tokens, prefix) of the classes that can have a partner; staged.

    ``tokens`` are the lists shared with others, ``prefix`` those to be merged.
    """
    tokens = _tokens(classes)
    shared = stage(
        tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared"
    )
    lists = (
        tokens.join(shared, "token")
        .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("lists"))
        .filter(F.size("lists") >= MATCHES)
    )
    ordered = F.transform("lists", lambda x: x["token"])
    return stage(
        lists.join(classes.select("node", "size"), "node").select(
            "node", "size", ordered.alias("tokens"),
            F.slice(ordered, 1, F.size("lists") - (MATCHES - 1)).alias("prefix"),
        ),
        "postings",
    )


def _fits(a: str, b: str) -> F.Column:
    """Sizes that leave the least similarity possible."""
    return 100 * F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def hub_pairs(members: DataFrame, order: F.Column, apart: bool) -> DataFrame:
    """(a, b): the members of each list and size band with the band's hub, the least by ``order``.

    With ``apart``, only members of another component than the hub's.
    """
    band = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / SIMILARITY)))
    banded = members.withColumn("band", band)
    hubs = stage(
        banded.groupBy("token", "band")
        .agg(F.min(F.struct(order.alias("o"), "node", "component")).alias("hub"),
             F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("token", "band", F.col("hub.node").alias("hub"),
                F.col("hub.component").alias("hub_component")),
        "hubs",
    )
    paired = banded.join(hubs, ["token", "band"]).filter(F.col("node") != F.col("hub"))
    if apart:
        paired = paired.filter(F.col("component") != F.col("hub_component"))
    return paired.select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")
    ).distinct()


def still_open(members: DataFrame) -> DataFrame:
    """The members of lists that hold more than one component; staged."""
    mixed_lists = (
        members.groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high").select("token")
    )
    return stage(members.join(mixed_lists, "token"), "open")


def unique_shingles(texts: DataFrame) -> DataFrame:
    """(node, alone): how many shingles of a class no other of these classes has."""
    schema = T.StructType.fromDDL("node bigint, shingle bigint")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        ids, target = WordIds(), to_arrow_schema(schema)
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  strict=True):
                found = shingles(text, ids).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), node)), pa.array(found)], schema=target
                )

    return (
        texts.select("node", "text").mapInArrow(run, schema)
        .groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"))
        .filter("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    )


def open_members(members: DataFrame, texts_of) -> DataFrame:
    """The members of lists in different components that can still be linked, and ``shared``; staged.

    Such a pair is among the members of lists of several components.  What two of
    them share, neither has alone among all of them, so with s for the number of
    its other shingles, s of both must reach SIMILARITY / (100 + SIMILARITY) of
    their sizes together.  This leaves out most members of a group of looser
    copies, which are alike without being linked.
    """
    opened = still_open(members)
    nodes = opened.select("node", "size").distinct()
    texts = texts_of(nodes)
    sized = nodes.join(unique_shingles(texts), "node", "left").select(
        "node", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("shared")
    ).filter(100 * F.col("shared") >= SIMILARITY * F.col("size"))
    rest = stage(sized, "shared")
    unstage(texts)
    return still_open(opened.join(small_side(rest, 16), "node"))


def central_pairs(members: DataFrame) -> DataFrame:
    """(hub, node): the members of each list with the one that has the least share alone; staged.

    Lists of one group of copies mostly have the same hub, so a member meets few.
    """
    alone = 1 - F.col("shared") / F.col("size")
    hubs = members.groupBy("token").agg(
        F.min(F.struct(alone.alias("o"), "node")).alias("h")
    ).select("token", F.col("h.node").alias("hub"))
    return stage(
        members.join(hubs, "token").filter("node <> hub").select("hub", "node").distinct(),
        "central",
    )


def offsets(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(hub, node, size, near, apart, tokens) of pairs (hub, node); staged.

    ``tokens`` are the shingles that one of both sets has and the other lacks,
    ``near`` says whether the two are linked, and ``apart`` is the node's part of
    the bound that ``offset_pairs`` describes.
    """
    rows = (
        pairs.join(texts.select(F.col("node").alias("hub"), F.col("text").alias("h_text")), "hub")
        .join(texts, "node").select("hub", "node", "h_text", "text")
    )
    schema = T.StructType.fromDDL(
        "hub bigint, node bigint, size bigint, near boolean, apart bigint, tokens array<bigint>"
    )

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        ids, target = WordIds(), to_arrow_schema(schema)
        held: OrderedDict[int, np.ndarray] = OrderedDict()

        def set_of(node: int, value: str) -> np.ndarray:
            if node not in held:
                held[node] = shingles(value, ids)
                if len(held) > 32:
                    held.popitem(last=False)
            held.move_to_end(node)
            return held[node]

        for batch in batches:
            sizes, near, apart, tokens = [], [], [], []
            hubs, nodes, h_texts, texts = (batch.column(k).to_pylist() for k in range(4))
            for hub, node, s, t in zip(hubs, nodes, h_texts, texts, strict=True):
                base, found = set_of(hub, s), set_of(node, t)
                differ = np.setxor1d(base, found, assume_unique=True)
                both = (len(base) + len(found) - len(differ)) // 2
                sizes.append(len(found))
                near.append(linked(base, found))
                apart.append(
                    2 * SIMILARITY * len(found) + (100 + SIMILARITY) * (len(base) - 2 * both)
                )
                tokens.append(differ.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), *(
                        pa.array(x, type=target.field(k).type)
                        for k, x in enumerate((sizes, near, apart, tokens), 2)
                    ),
                ],
                schema=target,
            )

    return stage(rows.mapInArrow(run, schema), "offsets")


def offset_pairs(found: DataFrame, components: DataFrame) -> DataFrame:
    """(a, b): nodes of one hub in different components that can be linked, from their offsets.

    Let H be the set of the hub and DX, DY what the sets X and Y differ from it in.
    Then |X and Y| = |DX and DY| - |H| + |X and H| + |Y and H|, so the two are linked
    exactly where

        2 (100 + SIMILARITY) |DX and DY| >= apart(X) + apart(Y),
        apart(X) = 2 SIMILARITY |X| + (100 + SIMILARITY) (|H| - 2 |X and H|).

    The right side is positive unless both are linked with the hub, and then they
    are in one component.  So they share a token of their offsets.  These are
    few, and rarely the same: of a group of copies of one text, they are what
    each has changed.  Tokens of one component only are left out; the others are
    put in order, rare ones first, and the first one shared must leave enough
    behind it on both sides.  Of nodes with the same tokens in a component the one
    that needs least stands for all.
    """
    unit = 2 * (100 + SIMILARITY)
    of = lambda name, out: components.select(
        F.col("node").alias(name), F.col("component").alias(out)
    )
    rows = found.join(of("node", "c"), "node", "left").join(of("hub", "h"), "hub", "left").select(
        "hub", "node", "size", "apart", "tokens", F.coalesce("c", "node").alias("component"),
        F.coalesce("h", "hub").alias("own"),
    )
    inside = F.col("component") == F.col("own")
    needs = rows.groupBy("hub").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.min("apart").alias("least"), F.min(F.when(~inside, F.col("apart"))).alias("least_out"),
    ).filter("low < high").drop("low", "high")
    keys = ["hub", "node", "size", "apart", "component"]
    bound = F.when(inside, F.col("least_out")).otherwise(F.col("least"))
    tokens = rows.join(needs, "hub").select(
        *keys, bound.alias("bound"), F.explode("tokens").alias("token")
    )
    shared = stage(
        tokens.groupBy("hub", "token").agg(
            F.count(F.lit(1)).alias("n"), F.min("component").alias("low"),
            F.max("component").alias("high"),
        ).filter("low < high").select("hub", "token", "n"),
        "offset-tokens",
    )
    lists = tokens.join(small_side(shared, 32), ["hub", "token"]).groupBy(*keys, "bound").agg(
        F.sort_array(F.collect_list(F.struct("n", "token"))).alias("list")
    )
    some = lists.groupBy("hub", "component", "list", "bound", "size").agg(
        F.min(F.struct("apart", "node")).alias("m")
    ).select("hub", "component", "list", "bound", "size", "m.apart", "m.node")
    room = unit * (F.size("list") - F.col("at")) - F.col("apart")
    first = stage(
        some.select(*keys, "bound", "list", F.posexplode("list").alias("at", "e"))
        .select(*keys, "bound", F.col("e.token").alias("token"), room.alias("room"))
        .filter("room >= bound").drop("bound"),
        "offset-lists",
    )
    several = first.groupBy("hub", "token").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).filter("low < high").select("hub", "token")
    left = stage(first.join(several, ["hub", "token"]), "offset-open")
    right = left.select("hub", "token", *(
        F.col(c).alias(f"r_{c}") for c in ("node", "size", "apart", "component", "room")
    ))
    return (
        left.join(right, ["hub", "token"])
        .filter((F.col("node") < F.col("r_node")) & (F.col("component") != F.col("r_component"))
                & _fits("size", "r_size")
                & (F.col("room") >= F.col("r_apart")) & (F.col("r_room") >= F.col("apart")))
        .select(F.col("node").alias("a"), F.col("r_node").alias("b")).distinct()
    )


def agreeing(pairs: DataFrame, posted: DataFrame) -> DataFrame:
    """The pairs whose signatures agree in MATCHES coordinates, whose sizes fit; staged."""
    own = lambda s: posted.select(
        F.col("node").alias(s), F.col("size").alias(f"{s}_size"), F.col("tokens").alias(f"{s}_t")
    )
    return stage(
        pairs.join(own("a"), "a").join(own("b"), "b")
        .filter(_fits("a_size", "b_size"))
        .filter(F.size(F.array_intersect("a_t", "b_t")) >= MATCHES)
        .select("a", "b"),
        "agreeing",
    )


def node_texts(documents: DataFrame, key: str, text: str, classes: DataFrame,
               nodes: DataFrame) -> DataFrame:
    """(node, text): a text for each of the classes, found by id and checked by its set; staged."""
    wanted = stage(
        classes.select("node", "first_id", "set_hash").join(nodes.select("node"), "node"), "wanted"
    ).withColumnRenamed("set_hash", "w_hash")
    found = documents.select(key, F.col(text).alias("_text")).join(
        small_side(wanted, 64), F.col(key).eqNullSafe(F.col("first_id"))
    ).select("node", "w_hash", "_text")
    schema = T.StructType.fromDDL("node bigint, text string")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        ids, target = WordIds(), to_arrow_schema(schema)
        for batch in batches:
            same = [
                xxhash.xxh3_128_digest(shingles(t, ids).tobytes()) == h
                for h, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                                strict=True)
            ]
            kept = batch.filter(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(2)], schema=target)

    # rows that repeat an id and a text give the same class twice
    return stage(found.mapInArrow(run, schema).dropDuplicates(["node"]), "texts")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough; staged."""
    rows = (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
        .select("a", "b", "a_text", "b_text")
    )
    schema = T.StructType.fromDDL("a bigint, b bigint")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        ids, target = WordIds(), to_arrow_schema(schema)
        held: OrderedDict[int, np.ndarray] = OrderedDict()

        def set_of(node: int, value: str) -> np.ndarray:
            if node not in held:
                held[node] = shingles(value, ids)
                if len(held) > 32:
                    held.popitem(last=False)
            held.move_to_end(node)
            return held[node]

        for batch in batches:
            a, b, a_text, b_text = (batch.column(k).to_pylist() for k in range(4))
            good = [
                linked(set_of(x, s), set_of(y, t))
                for x, y, s, t in zip(a, b, a_text, b_text, strict=True)
            ]
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], schema=target)

    return stage(rows.mapInArrow(run, schema), "links")


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of some edges (a, b); staged.

    Each round hooks every node to its smallest neighbour, follows that once
    more, and goes on with the edges between what is left.  Minima are summed up
    before the exchange, so a node of very many edges is no hot spot.
    """
    steps: list[DataFrame] = []
    rest = edges
    while rest.limit(1).count():
        both = rest.select("a", "b").union(rest.select("b", "a")).toDF("node", "other")
        least = stage(
            both.groupBy("node").agg(F.min("other").alias("o"))
            .select("node", F.least("node", "o").alias("to")),
            "least",
        )
        onward = least.select(F.col("node").alias("to"), F.col("to").alias("next"))
        step = stage(
            least.join(onward, "to").select("node", F.least("to", "next").alias("to")), "step"
        )
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        rest = stage(
            rest.join(left, "a").join(right, "b").filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "rest",
        )
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = steps[0].withColumnRenamed("to", "component")
    for step in steps[1:]:
        hop = step.select(F.col("node").alias("component"), "to")
        found = found.join(hop, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
    return stage(found, "components")


def _with_components(posted: DataFrame, components: DataFrame) -> DataFrame:
    """(token, node, size, component) of the lists to be merged; staged."""
    return stage(
        posted.select("node", "size", "prefix").join(components, "node", "left").select(
            F.explode("prefix").alias("token"), "node", "size",
            F.coalesce("component", "node").alias("component"),
        ),
        "members",
    )


def links(documents: DataFrame, key: str, text: str, classes: DataFrame) -> DataFrame:
    """(node, component) of the classes that are linked with another.

    The texts that a round reads are removed after it, so that only one round's lie on disk.
    """
    posted = postings(classes)
    spark = documents.sparkSession
    edges = spark.createDataFrame([], "a bigint, b bigint")
    components = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    members = _with_components(posted, components)

    def texts_of(nodes: DataFrame) -> DataFrame:
        return node_texts(documents, key, text, classes, nodes)

    def joined(fresh: DataFrame) -> None:
        nonlocal edges, components, members
        edges = fresh if not edges.limit(1).count() else stage(edges.union(fresh), "edges")
        components = connected(edges)
        members = _with_components(posted, components)

    def settle(pairs: DataFrame) -> None:
        pairs = agreeing(pairs, posted)
        if pairs.limit(1).count():
            met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            texts = texts_of(met)
            fresh = confirmed(pairs, texts)
            unstage(texts)
            joined(fresh)

    settle(hub_pairs(members, F.col("node"), False))
    settle(hub_pairs(members, F.xxhash64("token", "node"), True))
    central = central_pairs(open_members(members, texts_of))
    if not central.limit(1).count():
        return components
    met = central.select(F.explode(F.array("hub", "node")).alias("node")).distinct()
    texts = texts_of(met)
    found = offsets(central, texts)
    unstage(texts)
    near = found.filter("near").select(
        F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")
    ).distinct()
    if near.limit(1).count():
        joined(near)
    settle(offset_pairs(found, components))
    return components


def components_of(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept, _row) of each document."""
    found = signed(documents, key, text)
    classes = classes_of(found, key)
    components = links(documents, key, text, classes)
    named = classes.join(components, "node", "left").select(
        "set_hash", "first_id", F.coalesce("component", "node").alias("component")
    )
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_set = stage(
        named.join(least, "component").select("set_hash", "component", "component_id"), "named"
    )
    joined = found.select(key, "n_shingles", "set_hash", "_row").join(by_set, "set_hash", "left")
    own = F.when(F.col("set_hash").isNull(), F.col(key)).otherwise(F.col("component_id"))
    return joined.select(
        key, "n_shingles", own.alias("component_id"),
        F.col(key).eqNullSafe(own).alias("kept"), "component", "_row",
    )


def deduplicate(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, the one of smallest id; columns as they came.

    The documents are staged with a row number first, so that exactly one row of
    those that repeat the smallest id stays.
    """
    names = documents.columns
    whole = stage(
        documents.select(
            F.struct(*names).alias("_doc"), F.monotonically_increasing_id().alias("_number"),
            F.col(key).alias("_id"), F.col(text).alias("_text"),
        ),
        "documents",
    )
    found = stage(
        components_of(whole, "_number", "_text").join(
            whole.select("_number", "_id"), "_number"
        ),
        "groups",
    )
    first = found.filter("component is not null").groupBy("component").agg(
        F.min(F.struct(F.col("_id").isNull(), "_id", "_number")).alias("f")
    )
    stay = first.select(F.col("f._number").alias("_number")).union(
        found.filter("component is null").select("_number")
    )
    return whole.join(
        small_side(stage(stay, "stay"), 16), "_number", "left_semi"
    ).select("_doc.*")
