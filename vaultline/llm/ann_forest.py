"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree halves a bounded sample at the median of its projection on a random
direction, down to leaves of about ``leaf_rows`` of all rows.  Every row is
then put in its leaf of every tree.  A query walks all trees through one
priority queue ordered by the smallest margin on the way, until the leaves reached hold
enough rows; all rows of those leaves are scored exactly and the best kept.
How many are enough is measured: brute force over the sample gives the share
that finds ``recall`` of the true neighbours (``search_rows`` at least).  Data
with structure need a small share, random directions most of the rows.

Nearness is the inner product; trees are grown on unit vectors, which for
vectors of one length gives the same order.  Rows are dealt by hash of the id
into ``groups`` groups, queries into chunks of about ``chunk_queries``, and each
pair of a group and a chunk is a cell.  A cell holds its queries, each with the
leaves it reached and its best rows so far, while the group's rows stream past
leaf by leaf; it returns ``k + 1`` rows per query at its end.  So a task's
memory is that of one chunk whatever the data, no leaf lands in one task, and
what is returned grows with the queries alone.  The forest and the leaf counts
are bounded by ``sample_rows`` and are the only things sent to all executors.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and those of another length than the commonest (of equally common
ones the smallest), neither ask nor are found; equal scores go to the smaller
id; a repeated id is one candidate per distinct vector; a query with fewer
candidates gets all that are found; an empty table gives an empty result; null
ids take no part; columns other than those named are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import stored
from vaultline.llm.vectors import all_finite, answer, classes_of, of_common_length, sample_vectors, stack

_ROUNDING = 1e-9  # by how much a product of matrices may differ from the plain sum, relative to the norms


class Tree:
    """One tree as arrays: inner node i has a direction and an offset; children < 0 are leaves ~child."""

    def __init__(self, sample: np.ndarray, depth: int, rng: np.random.Generator):
        self.normals: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.root = self._grow(sample, np.arange(len(sample)), depth, rng)
        self.matrix = np.array(self.normals).reshape(len(self.normals), sample.shape[1])

    def _grow(self, sample, rows, depth, rng) -> int:
        if depth == 0 or len(rows) < 4:
            self.leaves += 1
            return ~(self.leaves - 1)
        a, b = sample[rng.choice(rows, 2, replace=False)]
        normal = a - b if np.any(a != b) else rng.standard_normal(sample.shape[1])
        normal = normal / np.linalg.norm(normal)
        side = sample[rows] @ normal
        offset = float(np.median(side))
        left, right = rows[side < offset], rows[side >= offset]
        node = len(self.normals)
        self.normals.append(normal)
        self.offsets.append(offset)
        self.children.append([0, 0])
        self.children[node] = [self._grow(sample, left, depth - 1, rng), self._grow(sample, right, depth - 1, rng)]
        return node

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.matrix.T - np.array(self.offsets)

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        node = np.full(len(vectors), self.root)
        children = np.array(self.children).reshape(-1, 2)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            margin = np.einsum("ij,ij->i", vectors[inner], self.matrix[at]) - np.array(self.offsets)[at]
            node[inner] = children[at, (margin >= 0).astype(int)]
        return ~node


def probe(trees: list[Tree], counts: dict[tuple[int, int], int], vectors: np.ndarray,
          wanted: int) -> Iterator[list[tuple[int, int]]]:
    """Per vector the leaves reached by one queue over all trees until they hold ``wanted`` rows."""
    margins = [t.margins(vectors) for t in trees]
    for i in range(len(vectors)):
        queue = [(-np.inf, n, t.root) for n, t in enumerate(trees)]
        reached, held = [], 0
        while queue and held < wanted:
            nearness, n, node = heapq.heappop(queue)
            if node < 0:
                if counts.get((n, ~node)):
                    reached.append((n, ~node))
                    held += counts[(n, ~node)]
                continue
            margin = margins[n][i, node]
            left, right = trees[n].children[node]
            heapq.heappush(queue, (max(nearness, margin), n, left))
            heapq.heappush(queue, (max(nearness, -margin), n, right))
        yield reached


def share_needed(forest: list[Tree], vectors: np.ndarray, k: int, recall: float, asked: int, seed: int) -> float:
    """Share of all rows (over all trees) a query must reach to find ``recall`` of its ``k`` nearest.

    Measured by brute force over the sample: for each true neighbour, how many
    rows the queue hands out before the first leaf that holds it.
    """
    unit = _unit(vectors)
    leaves = [t.leaf_of(unit) for t in forest]
    counts: dict[tuple[int, int], int] = {}
    for n, found in enumerate(leaves):
        for leaf, c in zip(*np.unique(found, return_counts=True)):
            counts[(n, int(leaf))] = int(c)
    chosen = np.random.default_rng(seed).choice(len(vectors), min(asked, len(vectors)), replace=False)
    scores = vectors[chosen] @ vectors.T
    scores[np.arange(len(chosen)), chosen] = -np.inf
    nearest_rows = np.argsort(-scores, axis=1)[:, :min(k, len(vectors) - 1)]
    before = []
    for reached, near in zip(probe(forest, counts, unit[chosen], len(forest) * len(vectors)), nearest_rows):
        held, at = 0, {}
        for leaf in reached:
            at[leaf] = held
            held += counts[leaf]
        before.extend(min(at[(n, int(found[j]))] for n, found in enumerate(leaves)) for j in near)
    return (float(np.quantile(before, recall, method="higher")) + 1) / len(vectors) if before else 1.0


def _unit(vectors: np.ndarray) -> np.ndarray:
    top = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / top
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class Cell:
    """The queries of a chunk with the leaves they reached and their best rows so far."""

    def __init__(self, asked: pd.DataFrame, keep: int):
        self.askers = asked["class_id"].to_numpy()
        self.queries = stack(asked["v"])
        self.norms = np.linalg.norm(self.queries, axis=1)
        reached = asked["reached"].to_numpy()
        leaves = np.concatenate([np.asarray(r, dtype=np.int64) for r in reached])
        owner = np.repeat(np.arange(len(reached)), [len(r) for r in reached])
        order = np.argsort(leaves, kind="stable")
        names, starts = np.unique(leaves[order], return_index=True)
        self.by_leaf = dict(zip(names.tolist(), np.split(owner[order], starts[1:])))
        self.scores = np.full((len(asked), keep), -np.inf)
        self.ids = np.full((len(asked), keep), np.iinfo(np.int64).max)

    def meet(self, leaf: int, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Rows of one leaf against the queries that reached it."""
        active = self.by_leaf.get(leaf)
        if active is None:
            return
        about = self.queries[active] @ vectors.T
        slack = _ROUNDING * self.norms[active] * np.linalg.norm(vectors, axis=1).max()
        least = self.scores[active, -1] - slack
        hit = np.flatnonzero(about.max(axis=1) >= least)
        if not len(hit):
            return
        row, col = np.nonzero(about[hit] >= least[hit, None])
        exact = np.full((len(hit), len(ids)), -np.inf)
        # the plain sum, so that a pair has one score wherever it is met
        exact[row, col] = (self.queries[active[hit[row]]] * vectors[col]).sum(axis=1)
        at = active[hit]
        scores = np.hstack([self.scores[at], exact])
        names = np.hstack([self.ids[at], np.broadcast_to(ids, exact.shape)])
        best = np.lexsort((names, -scores))[:, :self.scores.shape[1]]
        self.scores[at] = np.take_along_axis(scores, best, axis=1)
        self.ids[at] = np.take_along_axis(names, best, axis=1)

    def found(self, k: int) -> pd.DataFrame:
        """asker, class_id, score of the ``k`` best of each query; a row met in several trees counts once."""
        again = np.zeros(self.ids.shape, dtype=bool)
        again[:, 1:] = self.ids[:, 1:] == self.ids[:, :-1]  # equal scores stand in order of ids
        real = ~again & np.isfinite(self.scores)
        real &= np.cumsum(real, axis=1) <= k
        row, _ = np.nonzero(real)
        return pd.DataFrame({"asker": self.askers[row], "class_id": self.ids[real], "score": self.scores[real]})


def nearest(rows: DataFrame, k: int = 20, modulus: int = 20, trees: int = 2, leaf_rows: int = 1024,
            search_rows: int = 2000, recall: float = 0.95, sample_rows: int = 20_000,
            test_queries: int = 200, groups: int = 16, chunk_queries: int = 4096, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each id divisible by ``modulus``."""
    rows = (rows.where("vec_id is not null").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
            .where(all_finite(F.col("v")) & F.exists("v", lambda x: x != 0)))
    rows = of_common_length(rows)
    spark = rows.sparkSession
    classes = classes_of(rows, k, modulus)
    _, sample, total = sample_vectors(classes, sample_rows)
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    depth = max(0, int(np.ceil(np.log2(max(1.0, total / leaf_rows)))))
    rng = np.random.default_rng(seed)
    forest = [Tree(_unit(sample), depth, rng) for _ in range(trees)]

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row per tree, with the number of its leaf among those of all trees."""
        for batch in batches:
            if len(batch):
                unit, first = _unit(stack(batch["v"])), 0
                for t in forest:
                    yield pd.DataFrame({"leaf": first + t.leaf_of(unit), "class_id": batch["class_id"].to_numpy(),
                                        "v": batch["v"].to_numpy()})
                    first += t.leaves

    placed = stored(classes.select("class_id", "v").mapInPandas(entries, "leaf int, class_id long, v array<double>"))
    first = np.cumsum([0] + [t.leaves for t in forest])
    counts = {(n, r["leaf"] - int(first[n])): r["count"] for r in placed.groupBy("leaf").count().collect()
              for n in [int(np.searchsorted(first, r["leaf"], side="right")) - 1]}
    share = share_needed(forest, sample, k, recall, test_queries, seed)
    wanted = max(search_rows, int(np.ceil(share * total)))

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                reached = [[int(first[n]) + leaf for n, leaf in found]
                           for found in probe(forest, counts, _unit(stack(batch["v"])), wanted)]
                yield batch[["class_id", "v"]].assign(reached=reached)

    # the rows go once past every chunk: a stated query set against all rows, in blocks
    asking = classes.where("asked").select("class_id", "v")
    chunks = -(-asking.count() // chunk_queries)

    def dealt(into: int, name: str) -> F.Column:
        return F.pmod(F.xxhash64("class_id"), F.lit(into)).cast("int").alias(name)

    def each(into: int, name: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(max(0, into - 1)))).alias(name)

    queries = (asking.mapInPandas(probes, "class_id long, v array<double>, reached array<int>")
               .select(dealt(max(1, chunks), "chunk"), each(groups, "grp"), F.lit(-1).alias("leaf"), "class_id", "v", "reached"))
    index = placed.select(each(chunks, "chunk"), dealt(groups, "grp"), "leaf", "class_id", "v",
                          F.lit(None).cast("array<int>").alias("reached"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, waiting, cell = None, [], None
        for batch in batches:
            if not len(batch):
                continue
            keys = batch[["chunk", "grp", "leaf"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                where, leaf = tuple(keys[a, :2]), int(keys[a, 2])
                if where != at:
                    if cell is not None:
                        yield cell.found(k + 1)
                    at, waiting, cell = where, [], None
                rows_here = batch.iloc[a:b]
                if leaf < 0:
                    waiting.append(rows_here)
                    continue
                if cell is None and waiting:
                    cell = Cell(pd.concat(waiting, ignore_index=True), trees * (k + 1))
                    waiting = []
                if cell is not None:
                    cell.meet(leaf, rows_here["class_id"].to_numpy(), stack(rows_here["v"]))
        if cell is not None:
            yield cell.found(k + 1)

    cells = ["chunk", "grp"]
    found = (queries.unionByName(index).repartition(*cells).sortWithinPartitions(*cells, "leaf")
             .mapInPandas(search, "asker long, class_id long, score double"))
    return answer(rows, classes, found, k, modulus, "double")
