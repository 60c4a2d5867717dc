"""Shared by the vector searches: valid vectors, classes of equal vectors, search inside blocks of rows.

Equal vectors are searched once, as a class named by its smallest id, which
carries its ``k + 1`` smallest ids: enough for any query's ``k`` results,
the query itself left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import stored


def all_finite(vector: Column) -> Column:
    """False for a null or empty vector and one holding a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def of_common_length(rows: DataFrame) -> DataFrame:
    """The rows whose ``v`` has the commonest length; of equally common lengths the smallest."""
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == lengths["n"]) if lengths else rows


def classes_of(rows: DataFrame, k: int, modulus: int) -> DataFrame:
    """From vec_id, v: one row per distinct v with class_id, ids (k + 1 smallest) and asked.

    ``asked`` tells whether a query (an id divisible by ``modulus``) has this vector.
    """
    first = Window.partitionBy("v").orderBy("vec_id")
    few = rows.select("vec_id", "v").withColumn("n", F.dense_rank().over(first)).where(F.col("n") <= k + 1)
    ids = few.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    asked = rows.groupBy("v").agg(F.max(F.col("vec_id") % modulus == 0).alias("asked"))
    return stored(ids.join(asked, "v").select(F.col("ids")[0].alias("class_id"), "v", "ids", "asked"))


def sample_vectors(classes: DataFrame, bound: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(class ids, vectors, number of classes): a sample of at most ``bound`` classes by hash of the id."""
    total = classes.count()
    step = max(1, -(-total // bound))
    rows = (classes.where(F.pmod(F.xxhash64("class_id"), F.lit(step)) == 0)
            .orderBy(F.xxhash64("class_id"), "class_id").select("class_id", "v").limit(bound).collect())
    rows.sort(key=lambda r: r["class_id"])
    return (np.array([r["class_id"] for r in rows], dtype=np.int64),
            np.array([r["v"] for r in rows], dtype=np.float64), total)


def stack(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


Search = Callable[[pd.DataFrame, pd.DataFrame], Iterator[pd.DataFrame]]


def search_blocks(index: DataFrame, probes: DataFrame, search: Search, schema: str, key: list[str],
                  batch_rows: int = 512) -> DataFrame:
    """Runs ``search(block rows, probe rows)`` for every block of ``index``.

    Rows of one block come together, index rows first; probes are then streamed
    past the block in batches, so a task holds one block and one batch.
    """
    both = (index.withColumn("asking", F.lit(False))
            .unionByName(probes.withColumn("asking", F.lit(True)), allowMissingColumns=True))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held, block, waiting = None, [], None, []

        def asked() -> Iterator[pd.DataFrame]:
            nonlocal block
            if block is None and held:
                block = pd.concat(held, ignore_index=True)
                held.clear()
            if waiting and block is not None:
                rows = pd.concat(waiting, ignore_index=True)
                for lo in range(0, len(rows), batch_rows):
                    yield from search(block, rows.iloc[lo:lo + batch_rows])
            waiting.clear()

        for batch in batches:
            if not len(batch):
                continue
            keys = batch[key].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                if current is None or (keys[a] != current).any():
                    yield from asked()
                    current, block = keys[a], None
                    held.clear()
                part = batch.iloc[a:b]
                asking = part["asking"].to_numpy(dtype=bool)
                if (~asking).any():
                    held.append(part[~asking])
                if asking.any():
                    waiting.append(part[asking])
                    if sum(map(len, waiting)) >= batch_rows:
                        yield from asked()
        yield from asked()

    return both.repartition(*key).sortWithinPartitions(*key, "asking").mapInPandas(run, schema)


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per row of ``scores`` the positions of its ``k`` best, ties to smaller ids."""
    for i, row in enumerate(scores):
        if len(row) > k:
            least = np.partition(row, len(row) - k)[len(row) - k]
            near = np.flatnonzero(row >= least)
        else:
            near = np.arange(len(row))
        yield i, near[np.lexsort((ids[near], -row[near]))][:k]


def answer(rows: DataFrame, classes: DataFrame, found: DataFrame, k: int, modulus: int,
           score_type: str) -> DataFrame:
    """query_id, rank, vec_id, score from found (asker, class_id, score; askers are class ids).

    ``found`` may name a pair more than once.
    """
    best = Window.partitionBy("asker").orderBy(F.desc("score"), "class_id")
    top = stored(found.repartition("asker").dropDuplicates(["asker", "class_id"])
                 .withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1))
    lists = stored(top.join(classes.select("class_id", "ids"), "class_id")
                   .groupBy("asker").agg(F.collect_list(F.struct("score", "ids")).alias("near")))
    queries = (rows.where(F.col("vec_id") % modulus == 0).select(F.col("vec_id").alias("query_id"), "v")
               .join(classes.select(F.col("class_id").alias("asker"), "v"), "v").select("query_id", "asker").distinct())
    pairs = F.flatten(F.transform("near", lambda c: F.transform(
        F.filter(c["ids"], lambda i: i != F.col("query_id")),
        lambda i: F.struct((-c["score"]).alias("s"), i.alias("vec_id")))))
    return (queries.join(lists, "asker")
            .select("query_id", F.posexplode(F.slice(F.sort_array(pairs), 1, k)).alias("rank", "c"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), "c.vec_id",
                    (-F.col("c.s")).cast(score_type).alias("score")))
