"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions alone.

Each source has a target in words.  With r = target / words of the source,
every document is taken floor(r) whole times, and the rest of r is the
inclusion probability p of one further copy.  Documents are ranked by
(u / (1 - u)) / (p / (1 - p)) with u a random number made from the id, and the
lowest are taken until the source's remaining words are reached.

No source is sorted as a whole: ranks are counted in ``_BINS`` bins per source,
sums over the bins show in which bin the cut falls, and only that bin's
documents are ranked one by one.  The plan is one row per source.

Targets: the wanted words are shared by weight; a source stops at
``max_repeat`` times its words and the excess is shared again by weight among
the others, found in one pass over the sources in order of limit / weight.

Defined results: a null text has size 0 and takes part with 0 words; null
sources are one source, last in order; equal ranks go to the smaller doc_id,
nulls first; rows that agree in source and id are taken or left together;
an empty table gives an empty result; reruns agree, as u depends on the id and
``seed`` alone; columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import WORD, quoted, stored

_BINS = 4096
_SCALE = float(1 << 52)


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_odds(doc_id: Column, seed: str) -> Column:
    """u / (1 - u), u from the first 52 bits of a hash of the id, never 0 or 1."""
    text = F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
    u = (bits.cast("double") + 0.5) / (_SCALE + 1.0)
    return u / (1.0 - u)


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0),
                   share: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """source, source_size, target: one row per source.

    The windows here run over the table of sources, not of documents.
    """
    totals = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    everything = Window.partitionBy(F.lit(0))
    by_limit = everything.orderBy(F.col("_limit") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rows = (totals.withColumn("_w", weight)
            .withColumn("_limit", F.col("source_size") * F.lit(float(max_repeat)))
            .withColumn("_all", F.sum("source_size").over(everything) * F.lit(float(share)))
            .withColumn("_wall", F.sum("_w").over(everything))
            .withColumn("_used", F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
            .withColumn("_wused", F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
            # words per weight if this source and all after it stay below their limits
            .withColumn("_rate", (F.col("_all") - F.col("_used")) / (F.col("_wall") - F.col("_wused")))
            .withColumn("_full", F.col("_limit") <= F.col("_rate") * F.col("_w")))
    rate = F.min(F.when(~F.col("_full"), F.struct(F.col("_limit") / F.col("_w"), F.col("_rate")))).over(everything)
    return (rows.withColumn("_share", rate["_rate"])
            .select("source", "source_size",
                    F.when(F.col("_full"), F.col("_limit")).otherwise(F.col("_share") * F.col("_w")).alias("target")))


def mix(docs: DataFrame, weights: Sequence[float] = (5.0, 2.0, 1.0), share: float = 1.5,
        max_repeat: float = 2.0, seed: str = "mix:") -> DataFrame:
    """All columns of ``docs`` (named ``doc_id``, ``source``, ``text`` among them) as ``doc``,
    with size, source_size, target and copies (how many times the mix takes the row)."""
    def measured(columns: list) -> DataFrame:
        return docs.select(*columns, F.col("source").alias("_source"), F.col("doc_id").alias("_id"),
                           size_in_words(F.col("text")).alias("_size"),
                           random_odds(F.col("doc_id"), seed).alias("_odds"))

    sizes = stored(measured([]).select(F.col("_source").alias("source"), F.col("_id").alias("doc_id"),
                                       F.col("_size").alias("size"), F.col("_odds").alias("odds")))
    ratio = F.coalesce(F.col("target") / F.nullif("source_size", F.lit(0)), F.lit(0.0))
    targets = stored(source_targets(sizes, weights, share, max_repeat)
                     .withColumn("whole", F.floor(ratio).cast("long"))
                     .withColumn("p", ratio - F.floor(ratio))
                     .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")))

    def ranked(rows: DataFrame) -> DataFrame:
        rank = F.when(F.col("p") > 0, F.col("odds") / (F.col("p") / (1.0 - F.col("p"))))
        return rows.withColumn("rank", rank).withColumn(
            "bin", F.floor(F.col("rank") / (1.0 + F.col("rank")) * _BINS).cast("int"))

    plan = targets.withColumnRenamed("source", "_s")
    known = ranked(sizes.join(plan, F.col("source").eqNullSafe(F.col("_s")))).where("p > 0")
    bins = known.groupBy("_s", "bin").agg(F.sum("size").alias("n"), F.first("need").alias("need"))
    upto = Window.partitionBy("_s").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = stored(bins.withColumn("sum", F.sum("n").over(upto)).where(F.col("sum") > F.col("need"))
                 .groupBy("_s").agg(F.min(F.struct("bin", (F.col("sum") - F.col("n")).alias("before"))).alias("c"))
                 .select(F.col("_s").alias("_c"), F.col("c.bin").alias("cut_bin"), "c.before"))
    edge = known.join(cut, F.col("_s").eqNullSafe(F.col("_c")) & (F.col("bin") == F.col("cut_bin")))
    # rows that agree in source and id share a rank, so they are ranked as one
    edge = edge.groupBy("_s", "rank", "doc_id").agg(
        F.sum("size").alias("n"), F.first("need").alias("need"), F.first("before").alias("before"))
    inside = Window.partitionBy("_s").orderBy("rank", F.col("doc_id").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    taken = (edge.withColumn("mid", F.col("before") + F.sum("n").over(inside) - F.col("n") / 2.0)
             .where(F.col("mid") <= F.col("need"))
             .groupBy("_s").agg(F.max(F.struct("rank", "doc_id")).alias("last"))
             .select(F.col("_s").alias("_l"), "last"))
    plan = stored(plan.join(cut, F.col("_s").eqNullSafe(F.col("_c")), "left")
                  .join(taken, F.col("_s").eqNullSafe(F.col("_l")), "left").drop("_c", "_l", "before"))

    rows = ranked(measured([F.struct(*quoted(docs.columns)).alias("doc")])
                  .withColumnRenamed("_odds", "odds")
                  .join(plan, F.col("_source").eqNullSafe(F.col("_s"))))
    at_cut = F.coalesce(F.struct("rank", F.col("_id").alias("doc_id")) <= F.col("last"), F.lit(False))
    extra = F.when(F.col("p") <= 0, False).when(F.col("cut_bin").isNull(), True).otherwise(
        (F.col("bin") < F.col("cut_bin")) | ((F.col("bin") == F.col("cut_bin")) & at_cut))
    return rows.select("doc", F.col("_size").alias("size"), "source_size", "target",
                       (F.col("whole") + extra.cast("long")).alias("copies"))


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    return mix(docs.select("doc_id", "source", "text"), **options).select(
        "doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    rows = mix(docs, **options).where("copies > 0")
    return (rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc.*"))
