"""Exact top-k by inner product through a pivot-distance index.

Largest inner product becomes smallest distance: with M the largest norm, a
row x gets one more component sqrt(M^2 - |x|^2) and a query a zero, so that
the squared distance is |q|^2 + M^2 - 2 q.x.  Pivots are means of a bounded
sample.  A row's key is its nearest pivot and its distance from it; rows of a
pivot fall in rings of that distance, and rings with more than ``block_rows``
rows are split by hash of the id.

A query first scores the sample, whose k-th best score is a lower bound of its
own.  A block whose ring lies farther from the query's pivot distance than that
bound allows, by the triangle inequality, is not visited.  In a visited block,
rows sorted by pivot distance are expanded annulus by annulus, nearest first,
until the inequality excludes the rest.  Bounds are loosened by ``_SLACK`` for
rounding, so no result is lost; scores are integers, taken from products in
double precision where those are exact and in 64-bit integers beyond.

Defined results: vectors that are null, empty or hold null or non-finite
components, and those of another length than the commonest (of equally common
ones the smallest), neither ask nor are found; components whose scores could
pass 2^63, which no long holds, raise an error; equal scores go to the smaller id; a
repeated id is one candidate per distinct vector; with fewer candidates than k
all are returned; an empty table gives an empty result; null ids take no part;
columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.vectors import (all_finite, answer, best_rows, classes_of, of_common_length, sample_vectors,
                                   search_blocks, stack)

_SLACK = 1e-6
_ANNULUS = 1024
_EXACT = float(1 << 53)
_LARGEST = float(1 << 62)


def integer_components(vector) -> F.Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256.0).cast("long"))


def _lift(vectors: np.ndarray, norm2: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0.0, norm2 - np.einsum("ij,ij->i", vectors, vectors)))
    return np.hstack([vectors, rest[:, None]])


def _pivots(lifted: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(3)
    centres = lifted[rng.choice(len(lifted), min(count, len(lifted)), replace=False)]
    for _ in range(rounds):
        near = _distances(lifted, centres).argmin(axis=1)
        centres = np.array([lifted[near == c].mean(axis=0) if (near == c).any() else centres[c]
                            for c in range(len(centres))])
    return centres


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((rows - c) ** 2).sum(axis=1)) for c in centres], axis=1)


def top_k(rows: DataFrame, k: int = 5, modulus: int = 50, pivots: int = 16, rings: int = 8,
          sample_rows: int = 4096, block_rows: int = 16_384) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest integer scores of each id divisible by ``modulus``."""
    rows = (rows.where("vec_id is not null").where(all_finite(F.col("embedding")))
            .select("vec_id", integer_components(F.col("embedding")).alias("v")))
    rows = of_common_length(rows)
    spark = rows.sparkSession
    classes = classes_of(rows, k, modulus)
    sample_ids, sample, _ = sample_vectors(classes, sample_rows)
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    norm2 = classes.select(F.max(square)).first()[0]
    if norm2 >= _LARGEST:
        raise ValueError("components too large: scores could pass 2^63")
    exact = np.float64 if norm2 < _EXACT else np.int64
    lifted = _lift(sample, norm2)
    centres = _pivots(lifted, pivots)
    keyed = _distances(lifted, centres)
    cell = keyed.argmin(axis=1)
    edges = [np.quantile(keyed[cell == c, c], np.linspace(0, 1, rings + 1)[1:-1]) if (cell == c).any()
             else np.zeros(rings - 1) for c in range(len(centres))]

    def key(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        dist = _distances(_lift(vectors, norm2), centres)
        own = dist.argmin(axis=1)
        dist = dist[np.arange(len(own)), own]
        ring = np.array([np.searchsorted(edges[c], d, side="right") for c, d in zip(own, dist)])
        return own, ring, dist

    def ringed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                own, ring, dist = key(stack(batch["v"]))
                yield pd.DataFrame({"cell": own, "ring": ring, "dist": dist})

    # one row per ring, at most pivots x rings
    shape = (classes.select("v").mapInPandas(ringed, "cell int, ring int, dist double").groupBy("cell", "ring")
             .agg(F.min("dist").alias("low"), F.max("dist").alias("high"), F.count("*").alias("n")).collect())
    blocks = {(r["cell"], r["ring"]): -(-r["n"] // block_rows) for r in shape}

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                own, ring, dist = key(stack(batch["v"]))
                parts = np.array([blocks[(c, r)] for c, r in zip(own.tolist(), ring.tolist())])
                yield pd.DataFrame({"cell": own, "ring": ring, "block": batch["h"].to_numpy() % parts,
                                    "class_id": batch["class_id"].to_numpy(), "v": batch["v"].to_numpy(),
                                    "dist": dist, "reach": 0.0, "least": 0.0})

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            ids, vectors = batch["class_id"].to_numpy(), stack(batch["v"])
            scores = vectors @ sample.T
            scores[ids[:, None] == sample_ids[None, :]] = -np.inf
            # the k-th best of the sample bounds the k-th best of all rows from below
            least = (np.partition(scores, len(sample) - k, axis=1)[:, len(sample) - k]
                     if len(sample) > k else np.full(len(ids), -np.inf))
            own2 = np.einsum("ij,ij->i", vectors, vectors)
            reach = np.sqrt(np.maximum(0.0, own2 + norm2 - 2 * least)) * (1 + _SLACK) + _SLACK
            dist = _distances(np.hstack([vectors, np.zeros((len(ids), 1))]), centres)
            out = []
            for r in shape:
                d = dist[:, r["cell"]]
                bound = np.maximum(0.0, np.maximum(r["low"] - d, d - r["high"]))
                near = np.flatnonzero(bound <= reach)
                for b in range(blocks[(r["cell"], r["ring"])]):
                    out.append(pd.DataFrame({
                        "cell": r["cell"], "ring": r["ring"], "block": b, "class_id": ids[near],
                        "v": batch["v"].to_numpy()[near], "dist": d[near], "reach": reach[near],
                        "least": least[near]}))
            yield pd.concat(out)

    schema = "cell int, ring int, block int, class_id long, v array<long>, dist double, reach double, least double"
    index = (classes.select("class_id", "v", F.pmod(F.xxhash64("class_id"), F.lit(1 << 30)).alias("h"))
             .mapInPandas(entries, schema))
    asking = classes.where("asked").select("class_id", "v").mapInPandas(probes, schema)

    def whole(vectors: pd.Series) -> np.ndarray:
        return np.array(vectors.tolist(), dtype=exact)

    def expand(block: pd.DataFrame, asked: pd.DataFrame) -> Iterator[pd.DataFrame]:
        block = block.sort_values("dist", kind="stable")
        ids, vectors, dist = block["class_id"].to_numpy(), whole(block["v"]), block["dist"].to_numpy()
        queries, at = whole(asked["v"]), asked["dist"].to_numpy()
        reach, least = asked["reach"].to_numpy().copy(), asked["least"].to_numpy().copy()
        own2 = np.einsum("ij,ij->i", queries, queries).astype(np.float64)
        best = np.full((len(asked), k + 1), -np.inf)
        hits: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(len(asked))]
        starts = np.arange(0, len(ids), _ANNULUS)
        ends = np.minimum(starts + _ANNULUS, len(ids))
        bound = np.maximum(0.0, np.maximum(dist[starts][None, :] - at[:, None], at[:, None] - dist[ends - 1][None, :]))
        for s in np.argsort(bound.min(axis=0), kind="stable"):
            live = np.flatnonzero(bound[:, s] <= reach)
            if not len(live):
                continue
            here = slice(starts[s], ends[s])
            scores = queries[live] @ vectors[here].T
            for i, near in best_rows(scores, ids[here], k + 1):
                near = near[scores[i, near] >= least[live[i]] - _SLACK * abs(least[live[i]])]
                if len(near):
                    hits[live[i]].append((ids[here][near], scores[i, near]))
            merged = np.sort(np.hstack([best[live], scores]), axis=1)[:, -(k + 1):]
            best[live] = merged
            # k + 1 rows of the block (the asker's own class may be one) bound the k-th best
            least[live] = np.maximum(least[live], merged[:, 0])
            reach[live] = np.minimum(reach[live], np.sqrt(np.maximum(
                0.0, own2[live] + norm2 - 2 * np.where(np.isfinite(least[live]), least[live], -norm2))) * (1 + _SLACK)
                + _SLACK)
        askers = asked["class_id"].to_numpy()
        out = [pd.DataFrame({"asker": askers[i], "class_id": c, "score": s.astype(np.int64)})
               for i, found in enumerate(hits) for c, s in found]
        if out:
            yield pd.concat(out)

    found = search_blocks(index, asking, expand, "asker long, class_id long, score long", ["cell", "ring", "block"])
    return answer(rows, classes, found, k, modulus, "long")
