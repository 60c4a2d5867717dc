"""Prefix trie of conversations, its subtree sums by centroid decomposition of the parent-edge forest.

A node is a distinct sequence of first turns.  It is named by its smallest
member and its depth: the smallest member of a prefix stays the smallest of
every longer prefix it has, so (conv_id, depth) names one node.  Prefixes are
compared by two 64-bit running XORs over hashes of (place, role, text); texts
travel no further than their digest.

Subtree sums: a component of the forest is split at its centroid, the deepest
node that still has over half of the component's nodes below it.  The
component's nodes with over half of it below them are exactly the path from
the centroid to the top.  The centroid gets the total of its side; that total
is added to every other node of the path; the centroid's child subtrees and
the rest above it become components of at most half the size.  Which child
subtree a node belongs to is read off its own conversation's turn at that
depth, an equi-join.  Components over ``task_nodes`` nodes are split by Spark,
all of them in one round; the smaller ones are finished inside tasks by the
same recursion.  Sizes that name the centroids are counted along the
conversations beforehand.

Defined results: rows without conv_id take no part; null turns come first, and
turns of equal number are ordered by a digest of role and text; null roles and
texts count as empty; texts are read whole; repeated rows are turns of their
own; an empty table gives an empty result (no member, so no root); other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import stored
from vaultline.llm.sequence import batch_of, in_order, part, piece, rows_of

TASK_NODES = 256  # components up to this size are finished inside a task


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest, n_chars of every turn, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = (conversations.where("conv_id is not null")
             .select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                     F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
                     F.length(text).cast("long").alias("n_chars")))
    ordered = in_order(turns, F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")).drop("turn")
    runs = ordered.groupBy("conv_id", part(F.col("pos")).alias("run")).agg(F.min("pos").alias("first"), F.count("*").alias("n"))
    so_far = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "run", (F.coalesce(F.sum("n").over(so_far), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return (ordered.withColumn("run", part(F.col("pos"))).join(runs, ["conv_id", "run"])
            .select("conv_id", (F.col("pos") + F.col("shift")).alias("place"), "digest", "n_chars"))


def rebuilt(turns: DataFrame, family: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n_turns; conv_id, depth, digest, n_chars): op13's conversations from ``numbered`` turns.

    The first h turns of conversation c - c % ``family`` stand before the own ones after the h-th;
    h is the crc32 of c's digits modulo ``heads``.
    """
    lengths = turns.groupBy("conv_id").agg(F.max("place").alias("own"))
    head = F.crc32(F.col("conv_id").cast("string")) % heads
    first = lengths.select(F.col("conv_id").alias("first"), F.col("own").alias("first_own"))
    convs = stored(
        lengths.withColumn("h", head).withColumn("first", F.col("conv_id") - F.col("conv_id") % family)
        .join(first, "first", "left")
        .withColumn("taken", F.least("h", F.coalesce("first_own", F.lit(0))))
        .select("conv_id", "first", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns")))
    own = (turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("place > h")
           .select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "digest", "n_chars"))
    fronts = turns.where(F.col("place") < heads).withColumnRenamed("conv_id", "first")
    lent = (convs.select("conv_id", "first", "taken").join(fronts, "first").where("place <= taken")
            .select("conv_id", F.col("place").alias("depth"), "digest", "n_chars"))
    return convs.select("conv_id", "n_turns"), own.unionByName(lent)


def _prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, depth, a, b (the prefix), n_chars (of its last turn): every prefix of every conversation."""
    hashed = turns.select("conv_id", "depth", "n_chars", piece(F.col("depth")).alias("cut"),
                          F.xxhash64("depth", "digest").alias("x"), F.xxhash64("digest", F.lit("b"), "depth").alias("y"))
    within = Window.partitionBy("conv_id", "cut").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("conv_id").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    # longer conversations: what the pieces before a piece add up to
    offsets = (hashed.groupBy("conv_id", "cut").agg(F.bit_xor("x").alias("ox"), F.bit_xor("y").alias("oy"))
               .select("conv_id", "cut", F.bit_xor("ox").over(ahead).alias("ox"), F.bit_xor("oy").over(ahead).alias("oy"))
               .where("cut > 0"))
    running = hashed.select("conv_id", "cut", "depth", "n_chars", F.bit_xor("x").over(within).alias("x"),
                            F.bit_xor("y").over(within).alias("y"))
    whole = lambda own, offset: F.col(own).bitwiseXOR(F.coalesce(offset, F.lit(0)))
    return (running.join(offsets, ["conv_id", "cut"], "left")
            .select("conv_id", "depth", whole("x", "ox").alias("a"), whole("y", "oy").alias("b"), "n_chars"))


def _ends(convs: DataFrame, names: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of the nodes where conversations end.

    Ids are put in order and packed before they meet, so a node where a third
    of all conversations end sends its task one string for thousands of them.
    """
    at = (convs.join(names.withColumnRenamed("depth", "n_turns"), ["conv_id", "n_turns"], "left")
          .select("label", F.col("n_turns").alias("depth"), "conv_id"))
    ordered = in_order(at, F.col("label"), F.col("depth"), F.col("conv_id"))
    packs = (ordered.groupBy("label", "depth", piece(F.col("pos")).alias("cut"))
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
        node, state = None, None
        for batch in batches:
            out = []
            for label, depth, ids in rows_of(batch, "label", "depth", "ids"):
                if node == (label, depth):
                    state.update(b",")
                else:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (label, depth), hashlib.sha256()
                state.update(ids.encode())
            yield batch_of(out, schema)
        if node is not None:
            yield batch_of([(*node, state.hexdigest())], schema)

    return (packs.repartition("label", "depth").sortWithinPartitions("label", "depth", "cut")
            .mapInArrow(digests, "conv_id long, depth long, ends_sha256 string"))


def rollup_in_memory(parent: list[int], values: list[list[int]]) -> list[list[int]]:
    """Subtree sums of a tree whose parents (-1: none) stand before their children, by centroid decomposition."""
    sums = [[0] * len(parent) for _ in values]
    open_ = [list(range(len(parent)))]
    size = [0] * len(parent)
    while open_:
        nodes = open_.pop()
        inside = set(nodes)
        for v in nodes:
            size[v] = 0
        for v in reversed(nodes):
            size[v] += 1
            if parent[v] in inside:
                size[parent[v]] += size[v]
        heavy = [v for v in nodes if 2 * size[v] > len(nodes)]  # the path from the top to the centroid
        centroid = heavy[-1]
        below, pieces, above = {centroid}, {}, []
        side: dict[int, int] = {}
        for v in nodes:
            if v == centroid:
                continue
            if parent[v] in below:
                below.add(v)
                side[v] = v if parent[v] == centroid else side[parent[v]]
                pieces.setdefault(side[v], []).append(v)
            else:
                above.append(v)
        for total, own in zip(sums, values):
            gathered = sum(own[v] for v in below)
            for v in heavy:
                total[v] += gathered
        open_.extend(pieces.values())
        if above:
            open_.append(above)
    return sums


_NODE = "conv_id long, depth long, parent long, top long, top_depth long, size long"


def rollup(forest: DataFrame, paths: DataFrame, values: list[str], task_nodes: int = TASK_NODES) -> DataFrame:
    """conv_id, depth and the subtree sums of ``values`` (longs) of a forest of prefix nodes.

    ``forest``: conv_id, depth, parent (conv_id of the parent, null: none), size (nodes of the subtree) and ``values``.
    ``paths``: conv_id, depth, label: the node of each member of ``forest`` at each depth.
    """
    sums = [f"{v}_sum" for v in values]
    columns = ["conv_id", "depth", "parent", "top", "top_depth", "size", *values, *sums]
    tops = forest.where("parent is null").select(F.col("conv_id").alias("top"), F.col("depth").alias("top_depth"))
    if stored_tops := tops.limit(2).collect():
        if len(stored_tops) > 1:
            raise ValueError("more than one tree: name the top of each")
    else:
        return forest.select("conv_id", "depth", *(F.col(v).alias(s) for v, s in zip(values, sums)))
    top, top_depth = stored_tops[0]
    current = forest.select("conv_id", "depth", "parent", F.lit(top).cast("long").alias("top"),
                            F.lit(top_depth).cast("long").alias("top_depth"), "size", *values,
                            *(F.lit(0).cast("long").alias(s) for s in sums))
    current = stored(current)  # the name of the component is a key to join on, not a constant
    is_top = (F.col("conv_id") == F.col("top")) & (F.col("depth") == F.col("top_depth"))
    closed, small = [], []
    component = ["top", "top_depth"]
    while True:
        large = stored(current.where(is_top & (F.col("size") > task_nodes)).select(*component, F.col("size").alias("total")))
        if large.isEmpty():
            small.append(current.select(*columns))
            break
        small.append(stored(current.join(large, component, "left_anti").select(*columns)))
        inside = current.join(large, component)
        centroids = stored(inside.where(2 * F.col("size") > F.col("total")).groupBy(*component)
                           .agg(F.max(F.struct("depth", "conv_id", "size")).alias("z"))
                           .select(*component, F.col("z.depth").alias("z_depth"), F.col("z.conv_id").alias("z"),
                                   F.col("z.size").alias("z_size")))
        seen = inside.join(centroids, component).withColumn("ask", F.when(F.col("depth") > F.col("z_depth"), F.col("z_depth") + 1))
        child = paths.select(F.col("conv_id").alias("of"), F.col("depth").alias("ask_depth"), "label", "parent_label")
        at_z = (F.col("conv_id") == F.col("z")) & (F.col("depth") == F.col("z_depth"))
        split = stored(
            seen.join(child, (F.col("conv_id") == F.col("of")) & (F.col("ask") == F.col("ask_depth")), "left")
            .select(*columns, "total", "z", "z_depth", "z_size", at_z.alias("at_z"), "label",
                    F.coalesce(F.col("parent_label") == F.col("z"), F.lit(False)).alias("under")))
        gathered = (split.where("at_z or under").groupBy(*component)
                    .agg(*(F.sum(v).alias(f"{v}_below") for v in values)))
        moved = split.join(gathered, component)
        on_path = (2 * F.col("size") > F.col("total")) & ~F.col("under")
        added = [(F.col(s) + F.when(on_path, F.col(f"{v}_below")).otherwise(0)).alias(s) for v, s in zip(values, sums)]
        after = stored(moved.select(
            "conv_id", "depth", "parent", F.when(F.col("under"), F.col("label")).otherwise(F.col("top")).alias("top"),
            F.when(F.col("under"), F.col("z_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            (F.col("size") - F.when(on_path & ~F.col("at_z"), F.col("z_size")).otherwise(0)).alias("size"),
            *values, *added, "at_z"))
        closed.append(after.where("at_z").select("conv_id", "depth", *sums))
        current = after.where("not at_z").select(*columns)
    rest = small[0]
    for more in small[1:]:
        rest = rest.unionByName(more)

    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), *((s, pa.int64()) for s in sums)])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done() -> list[tuple]:
            at = {row[:2]: n for n, row in enumerate(held)}
            parent = [at.get((row[2], row[1] - 1), -1) for row in held]
            own = [[row[5 + k] for row in held] for k in range(len(values))]
            added = rollup_in_memory(parent, own)
            return [(*row[:2], *(added[k][n] + row[5 + len(values) + k] for k in range(len(values))))
                    for n, row in enumerate(held)]

        for batch in batches:
            out: list[tuple] = []
            for row in rows_of(batch, "conv_id", "depth", "parent", *component, *values, *sums):
                if held and held[-1][3:5] != row[3:5]:
                    out += done()
                    held.clear()
                held.append(row)
            yield batch_of(out, schema)
        if held:
            yield batch_of(done(), schema)

    out = (rest.repartition(*component).sortWithinPartitions(*component, "depth")
           .mapInArrow(finish, ", ".join(["conv_id long, depth long", *(f"{s} long" for s in sums)])))
    for one in closed:
        out = out.unionByName(one)
    return out


def trie(convs: DataFrame, turns: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """The trie's nodes from (conv_id, n_turns) and (conv_id, depth, digest, n_chars); depths count from 1."""
    prefixes = stored(_prefixes(convs, turns))
    key = ["depth", "a", "b"]
    nodes = stored(prefixes.groupBy(*key).agg(F.min("conv_id").alias("label"), F.count("*").alias("n_convs"),
                                              F.min("n_chars").alias("n_chars")))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id")).first()[0]  # one number: the root's name
    top = (convs.agg(F.min("conv_id").alias("label"), zero.alias("depth"), F.count("*").alias("n_convs"),
                     zero.alias("n_chars")).where("n_convs > 0"))
    all_nodes = top.unionByName(nodes.select("label", "depth", "n_convs", "n_chars"))
    names = stored(
        prefixes.select("conv_id", *key).join(nodes.select(*key, "label"), key).select("conv_id", "depth", "label")
        .unionByName(convs.select("conv_id", zero.alias("depth"), F.lit(root).cast("long").alias("label"))))
    above = names.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("label").alias("parent_label"))
    paths = stored(names.join(above, ["conv_id", "depth"], "left"))
    # nodes named by a conversation: its own turns from the first that it alone or first has
    lowest = all_nodes.groupBy(F.col("label").alias("conv_id")).agg(F.min("depth").alias("own_from"))
    reach = convs.join(lowest, "conv_id")
    sizes = (paths.select("conv_id", "depth", "label").join(reach, "conv_id")
             .groupBy(F.col("label").alias("conv_id"), "depth")
             .agg(F.sum(F.greatest(F.col("n_turns") - F.greatest("depth", "own_from") + 1, F.lit(0))).alias("size")))
    named = all_nodes.withColumnRenamed("label", "conv_id").join(paths.select("conv_id", "depth", F.col("parent_label").alias("parent")),
                                                                ["conv_id", "depth"])
    children = (named.where("parent is not null").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
                .agg(F.count("*").alias("n_children")))
    forest = stored(
        named.join(children, ["conv_id", "depth"], "left").join(sizes, ["conv_id", "depth"])
        .select("conv_id", "depth", "parent", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "size",
                F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved")))
    sums = rollup(forest.select("conv_id", "depth", "parent", "size", "leaf", "saved"), paths, ["leaf", "saved"], task_nodes)
    none = hashlib.sha256(b"").hexdigest()
    return (forest.join(sums, ["conv_id", "depth"]).join(_ends(convs, names), ["conv_id", "depth"], "left")
            .select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                    F.col("leaf_sum").alias("n_leaves"), F.col("saved_sum").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame, task_nodes: int = TASK_NODES) -> DataFrame:
    """The trie of the rebuilt conversations (op13)."""
    return trie(*rebuilt(stored(numbered(conversations))), task_nodes)
