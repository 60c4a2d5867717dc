"""Keep only rows whose key is not in the vault yet (the loaders' ``NOT IN``).

``NOT IN (subquery)`` plans in Spark as a null-aware anti-join that can only run
as a broadcast of the *existing* table, which grows without bound.  Keys here
are never NULL (NULL business keys are quarantined before hashing), so a plain
``left_anti`` join is the same set.  It carries no hint: adaptive execution
chooses the join from the bytes it measures, the same way for every batch size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.operators.segments import CHECK_KEYS, History

_KNOWN = "__known"


def keep_new(candidates: DataFrame, existing: DataFrame | History, keys: list[str], *,
             null_safe: bool = False, asked: DataFrame | None = None) -> DataFrame:
    """Rows of ``candidates`` whose ``keys`` do not occur in ``existing``.

    ``null_safe`` compares with ``<=>`` (NULL equals NULL), for satellites that
    are insert-once on the whole row rather than on the key.

    A segmented history is read without the parts that hold no candidate, and
    joined on its segmentation: the history is not shuffled.  ``asked`` has the
    keys of the candidates, and maybe more: which parts to read is then told
    from it, so that the candidates are made only once.
    """
    if isinstance(existing, History):
        return _keep_new_segmented(candidates, existing, keys, null_safe, candidates if asked is None else asked)
    known = existing.select(*keys)
    if not null_safe:
        known = known.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    pairs = [candidates[k].eqNullSafe(known[k]) if null_safe else candidates[k] == known[k] for k in keys]
    return candidates.join(known, reduce(lambda a, b: a & b, pairs), "left_anti")


def distinct_new(candidates: DataFrame, existing: DataFrame | History, keys: list[str], *,
                 null_safe: bool = False, asked: DataFrame | None = None) -> DataFrame:
    """Distinct rows of ``candidates`` whose ``keys`` do not occur in ``existing``; the candidates are shuffled once.

    Known keys go first: the rows then lie by key, and equal rows together.
    ``null_safe`` (``keys`` are all columns): both sides go through one
    aggregate, for which NULL equals NULL.  A segmented history takes the
    candidates dealt by its segments, and they are made distinct there.
    """
    if isinstance(existing, History):
        return _keep_new_segmented(candidates, existing, keys, null_safe, candidates if asked is None else asked, True)
    if not null_safe:
        return keep_new(candidates, existing, keys).distinct()
    if set(candidates.columns) != set(keys):
        raise ValueError("null_safe compares whole rows")
    both = candidates.select(*keys, F.lit(False).alias(_KNOWN)).union(existing.select(*keys, F.lit(True)))
    return both.groupBy(*keys).agg(F.bool_or(_KNOWN).alias(_KNOWN)).where(~F.col(_KNOWN)).select(*candidates.columns)


def _keep_new_segmented(candidates: DataFrame, history: History, keys: list[str], null_safe: bool,
                        asked: DataFrame, distinct: bool = False) -> DataFrame:
    check = CHECK_KEYS[history.name]
    candidates = history.dealt(candidates)
    if distinct:
        candidates = candidates.distinct()
    known = history.matching(asked, keys).select(*(F.col(k).alias(f"__{k}") for k in keys))

    def same(key: str) -> Column:
        own, other = candidates[key], known[f"__{key}"]
        if key in check or not null_safe:
            return own == other
        # said so that the planner keeps it as a condition: as a join key it would need an exchange
        return F.coalesce(own == other, own.isNull() & other.isNull())

    # check columns are never NULL, and first: their order is that of the segmentation
    order = [*(k for k in check if k in keys), *(k for k in keys if k not in check)]
    return candidates.join(known, reduce(lambda a, b: a & b, map(same, order)), "left_anti")
