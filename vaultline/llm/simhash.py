"""SimHash near-duplicates linked through a Gray-order hierarchical index.

Fingerprints of distinct value are linked when they differ in at most
``max_bits`` bits.  The 64 bits are cut into ``max_bits + 2`` fields; two
linked fingerprints agree in at least two fields, so each is sent to one
bucket per pair of fields and every link lies within some bucket.  A bucket
with more than ``hot_rows`` fingerprints is cut again, exactly: the bits its
key leaves free are cut into ``max_bits + 1`` parts, of which a link keeps one.

Inside a bucket an index is built over the fingerprints sorted by Gray rank:
runs of neighbours form nodes that hold the bits all their members share, the
nodes above hold what their children share.  A search adds up, from the root
down, the differences in bits not yet counted, and drops a whole node once
they exceed ``max_bits``.  A bucket returns only links that span its groups,
never all pairs.  Groups over all buckets come from alternating large-star and
small-star rounds, each stored in the shared folder.

Defined results: a null or word-less text has fingerprint zero, linked like
any other; repeated rows and exact copies share a fingerprint and so a group;
a null doc_id takes part but never names a group (component_id is null where a
group has no other id); an empty table gives an empty result; columns other
than those named are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import WORD, fresh, settled, stored

BITS = 64
SEED = 42
HOT_ROWS = 4096
_FANOUT = 16
_QUERIES = 256  # fingerprints searched together
_SHINGLES = 65536  # hashes counted together
_WORD = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- fingerprints ---------------------------------------------------------------------------

def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    words = _WORD.findall(text.translate(_LOWER)) if text else []
    if not words:
        return 0
    n = max(1, len(words) - words_per_shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, n, _SHINGLES):
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(" ".join(words[i:i + words_per_shingle]), SEED)
             for i in range(lo, min(n, lo + _SHINGLES))), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``keep`` and ``fp`` (the fingerprint's bits as a signed long) of every row."""
    kept = ["doc_id", *keep]
    schema = docs.select(*kept).schema.add("fp", "long")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[kept].copy()
            values = [fingerprint(t, words_per_shingle) for t in batch["text"]]
            out["fp"] = np.array(values, dtype=np.uint64).view(np.int64)
            yield out

    return docs.select(*dict.fromkeys([*kept, "text"])).mapInPandas(run, schema)


# -- index of one bucket --------------------------------------------------------------------

def gray_rank(values: np.ndarray) -> np.ndarray:
    """Position of each value in the sequence of Gray codes."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Levels of (shared bits, their pattern) over fingerprints in Gray order; the last is the root's."""

    def __init__(self, values: np.ndarray):
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        full = np.full(len(values), np.iinfo(np.uint64).max, dtype=np.uint64)
        self.levels = [(full, self.values)]
        while len(self.levels[-1][0]) > 1:
            mask, pattern = self.levels[-1]
            starts = np.arange(0, len(mask), _FANOUT)
            ones = np.bitwise_and.reduceat(mask & pattern, starts)
            zeros = np.bitwise_and.reduceat(mask & ~pattern, starts)
            self.levels.append((ones | zeros, ones))

    def search(self, queries: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(query position, value position) of all values within ``max_bits`` of a query."""
        query = np.arange(len(queries))
        node = np.zeros(len(queries), dtype=np.int64)
        counted = np.zeros(len(queries), dtype=np.int64)
        above = np.zeros(len(queries), dtype=np.uint64)
        for level in range(len(self.levels) - 1, -1, -1):
            mask, pattern = self.levels[level]
            if level < len(self.levels) - 1:
                parent = node
                node = (parent[:, None] * _FANOUT + np.arange(_FANOUT)).ravel()
                inside = node < len(mask)
                node = node[inside]
                query = np.repeat(query, _FANOUT)[inside]
                counted = np.repeat(counted, _FANOUT)[inside]
                above = np.repeat(self.levels[level + 1][0][parent], _FANOUT)[inside]
            fresh = (queries[query] ^ pattern[node]) & mask[node] & ~above
            counted = counted + np.bitwise_count(fresh)
            near = counted <= max_bits
            query, node, counted = query[near], node[near], counted[near]
        return query, node


def spanning_links(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """(value, smallest value of its group) for the groups of one bucket."""
    index = GrayIndex(np.unique(values))
    root = np.arange(len(index.values))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for lo in range(0, len(root), _QUERIES):
        query, hit = index.search(index.values[lo:lo + _QUERIES], max_bits)
        for i, j in zip((query + lo).tolist(), hit.tolist()):
            if i < j:
                a, b = find(i), find(j)
                if a != b:
                    root[max(a, b)] = min(a, b)
    signed = index.values.view(np.int64)
    groups: dict[int, list[int]] = {}
    for i in range(len(root)):
        groups.setdefault(find(i), []).append(int(signed[i]))
    return [(v, min(g)) for g in groups.values() if len(g) > 1 for v in g if v != min(g)]


def _bucket_links(max_bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None

        def links(rows: pd.DataFrame) -> pd.DataFrame:
            found = []
            keys = rows[["part", "key", "sub", "subkey"]].to_numpy()
            new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]) if len(rows) else []
            values = rows["fp"].to_numpy().view(np.uint64)
            ends = np.r_[new[1:], len(rows)] if len(rows) else []
            for a, b in zip(new, ends):
                if b - a > 1:
                    found.extend(spanning_links(values[a:b], max_bits))
            return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

        for batch in batches:
            if not len(batch):
                continue
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = rows[["part", "key", "sub", "subkey"]].to_numpy()
            open_from = int(np.argmax((last == last[-1]).all(axis=1)))
            rest = rows.iloc[open_from:].reset_index(drop=True)
            yield links(rows.iloc[:open_from].reset_index(drop=True))
        if rest is not None:
            yield links(rest)

    return run


# -- buckets --------------------------------------------------------------------------------

def _ranges(positions: list[int], parts: int) -> list[list[int]]:
    cut = [len(positions) * i // parts for i in range(parts + 1)]
    return [positions[cut[i]:cut[i + 1]] for i in range(parts)]


def _mask(positions: list[int]) -> int:
    value = sum(1 << p for p in positions)
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def links(distinct: DataFrame, max_bits: int = 3, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Links (a, b) that span all groups of the distinct fingerprints ``fp``."""
    if not 0 <= max_bits < BITS - 2:
        raise ValueError("max_bits out of range")
    fields = _ranges(list(range(BITS)), max_bits + 2)
    pairs = [x + y for x, y in combinations(fields, 2)]
    buckets = stored(distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask(p))).alias("key"))
        for i, p in enumerate(pairs)])).alias("s")).select("fp", "s.part", "s.key"))
    hot = stored(buckets.groupBy("part", "key").agg(F.count("*").alias("n"))
                 .where(F.col("n") > hot_rows).select("part", "key", F.lit(True).alias("hot")))
    subs = []
    for p in pairs:
        free = [b for b in range(BITS) if b not in set(p)]
        subs.append(F.array(*[
            F.struct(F.lit(i).alias("sub"), F.col("fp").bitwiseAND(F.lit(_mask(q))).alias("subkey"))
            for i, q in enumerate(_ranges(free, max_bits + 1))]))
    whole = F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("subkey")))
    keyed = (buckets.join(hot, ["part", "key"], "left")
             .withColumn("s", F.explode(F.when(
                 F.col("hot"), F.element_at(F.array(*subs), F.col("part") + 1)).otherwise(whole)))
             .select("part", "key", "s.sub", "s.subkey", "fp"))
    key = ["part", "key", "sub", "subkey"]
    return (keyed.repartition(*key).sortWithinPartitions(*key)
            .mapInPandas(_bucket_links(max_bits), "a long, b long"))


def _stars(edges: DataFrame) -> DataFrame:
    """The edges after one large and one small star."""
    both = edges.union(edges.select("b", "a"))
    low = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("u"), F.least("a", "b").alias("m")))
    # large star: every larger neighbour points at the smallest one
    large = stored(both.join(low, both["a"] == low["u"]).where(F.col("b") > F.col("a"))
                   .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
    # small star: smaller neighbours, and the value itself, point at the smallest
    low = stored(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u"))
    return (large.join(low, large["a"] == low["u"])
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``fp`` and ``root`` (smallest value reachable) of every value that has a link."""
    spark = edges.sparkSession
    edges = stored(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        small = settled(spark, partial(_stars, edges))
        changed = small.exceptAll(edges).limit(1).count() + edges.exceptAll(small).limit(1).count()
        edges = small
        if not changed:
            return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))
    raise RuntimeError("components did not settle")


def _named(fps: DataFrame, max_bits: int) -> DataFrame:
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(classes.select("fp"), max_bits))
    named = classes.join(roots, "fp", "left").withColumn("group", F.coalesce("root", "fp"))
    least = stored(named.groupBy("group").agg(F.min("least").alias("component_id")))
    return named.join(least, "group").select("fp", "group", "component_id")


def _labels(fps: DataFrame, max_bits: int) -> DataFrame:
    """fp, group, component_id of every distinct fingerprint of ``fps``."""
    return settled(fps.sparkSession, partial(_named, fps, max_bits))


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fingerprint, component_id and group (the group's own number) of every row."""
    fps = stored(fingerprints(docs, words_per_shingle))
    return (fps.join(_labels(fps, max_bits), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id", "group"))


def keep_one(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each group: that of smallest id (a null one only where all are null).

    Rows that share this id are told apart by the SHA-256 of their text (none for a null one); the
    least stays, and one of rows that are alike in both.  Who stays is decided on ids and digests;
    whole documents are shuffled once.
    """
    digest = F.sha2("text", 256)
    slim = docs.select("doc_id", "text", digest.alias("digest"))
    fps = stored(fingerprints(slim, words_per_shingle, keep=("digest",)))
    id_, text_, n_ = (fresh(name, docs.columns) for name in ("_id", "_digest", "_rows"))
    stay = stored(
        fps.join(_labels(fps, max_bits), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("group", "doc_id", "digest").agg(F.count("*").alias("n"))
        .groupBy("group").agg(F.min(F.struct("digest", "doc_id", "n")).alias("least"))
        .select(F.col("least.doc_id").alias(id_), F.col("least.digest").alias(text_), F.col("least.n").alias(n_)))

    def rows_of(chosen: DataFrame) -> DataFrame:
        return docs.join(chosen, docs["doc_id"].eqNullSafe(chosen[id_]) & digest.eqNullSafe(chosen[text_]), "left_semi")

    kept = rows_of(stay.where(F.col(n_) == 1))
    repeated = stay.where(F.col(n_) > 1)
    if repeated.isEmpty():
        return kept
    once = rows_of(repeated).withColumn(text_, digest).dropDuplicates(["doc_id", text_]).drop(text_)
    return kept.unionByName(once)
