"""Generic incremental loaders for hubs, links and satellites.

Each loader turns staged rows into the rows one batch appends: rows are
deduplicated over every output column (``select distinct``), business keys are
hashed into surrogate keys, hub members are looked up, and rows whose key is
already in the vault are dropped.  Rows that cannot be placed (a NULL business
key, a reference to a hub member that does not exist) do not fail the load and
do not vanish: they go to a quarantine frame with a reason.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vaultline.functions.keys import NARROW, KeyKind
from vaultline.operators.anti_join import distinct_new, keep_new
from vaultline.operators.store import Batch

@dataclass(frozen=True)
class HubSpec:
    table: str
    source: str  # staging table
    key: str  # hash key column
    business_key: str  # column in the staging table
    key_name: str  # business key column in the hub
    attributes: tuple[str, ...] = ()


@dataclass(frozen=True)
class Lookup:
    """Resolve a staging column to the key of a hub member.

    ``derived``: the hub is loaded from this very staging table earlier in the
    same batch, so every non-NULL value is a member and its key is the hash of
    the value; no join is needed.  ``optional``: a NULL value means "no
    relationship" (a private message has no group) and is skipped, not
    quarantined.
    """

    hub: str
    column: str
    derived: bool = False
    optional: bool = False


@dataclass(frozen=True)
class LinkSpec:
    table: str
    source: str
    key: str
    lookups: tuple[Lookup, ...]
    hash_order: tuple[str, ...]  # hub key columns, in hash argument order


@dataclass
class LoadResult:
    """New rows of one table; ``quarantine`` rows it could not place.

    ``quarantined`` is filled in while ``rows`` is written (an observation on
    the same pass), so a writer can skip a second pass when it is zero.
    """

    rows: DataFrame
    quarantine: DataFrame | None = None
    quarantined: Observation | None = None


def quarantine_rows(df: DataFrame, table: str, reason: Column, columns: list[str]) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"),
        reason.alias("reason"),
        F.to_json(F.struct(*columns)).alias("record"),
    )


def _observed(df: DataFrame, bad: Column, track: bool) -> tuple[DataFrame, Observation | None]:
    if not track:
        return df, None
    obs = Observation()
    return df.observe(obs, F.count_if(bad).alias("n")), obs


def load_hub(spec: HubSpec, source: DataFrame, existing: DataFrame, batch: Batch,
             track: bool = False, keys: KeyKind = NARROW) -> LoadResult:
    bk = F.col(spec.business_key)
    counted, obs = _observed(source, bk.isNull(), track)
    # dedupe first, hash after: fewer rows to hash, and the hashing runs after
    # the shuffle (the key is a function of the business key, so it is equal)
    staged = counted.where(bk.isNotNull()).select(bk.alias(spec.key_name), *[F.col(a) for a in spec.attributes])
    # "Already loaded" is decided on the business key: the surrogate key is a
    # function of it, so this is the same set as comparing keys, it cannot take
    # a new member whose hash collides for an old one, and no hash is computed
    # on either side of the check (the history is only scanned for its ids).
    asked = source.where(bk.isNotNull()).select(bk.alias(spec.key_name))
    kept = distinct_new(staged, existing, [spec.key_name], asked=asked)
    new = kept.select(
        keys.member(spec.key_name).alias(spec.key),
        spec.key_name,
        *spec.attributes,
        *batch.load_columns(),
    )
    bad = quarantine_rows(
        source.where(bk.isNull()), spec.table, F.lit(f"NULL {spec.business_key}"), source.columns
    )
    return LoadResult(new, bad, obs)


def resolve(df: DataFrame, lookups: tuple[Lookup, ...], hubs: dict[str, HubSpec],
            hub_tables, keys: KeyKind = NARROW) -> tuple[DataFrame, Column, Column]:
    """Add the hub key of every lookup; return (frame, all-resolved flag, reason).

    A derived lookup hashes the value; any other lookup is a left join with the
    hub on the business key (NULL key when the member is missing).  A member
    listed twice in its hub is made one before the join, so the rows of ``df``
    come back as many as they were.  Its aggregate is by member and key, which
    is not how the join deals the rows: adaptive execution can still split the
    partition of a hot member.
    """
    ok = F.lit(True)
    reasons: list[Column] = []
    for lk in lookups:
        spec = hubs[lk.hub]
        value = F.col(lk.column)
        if lk.derived:
            df = df.withColumn(spec.key, keys.member(value))
            reasons.append(F.when(value.isNull(), F.lit(f"NULL {lk.column}")))
            ok = ok & F.col(spec.key).isNotNull()
            continue
        bk = f"__bk_{spec.key}"
        members = hub_tables(lk.hub).select(F.col(spec.key_name).alias(bk), F.col(spec.key)).distinct()
        df = df.join(members, value == members[bk], "left").drop(bk)
        resolved = F.col(spec.key).isNotNull()
        ok = ok & resolved
        reasons.append(
            F.when(value.isNull(), F.lit(f"NULL {lk.column}")).when(
                ~resolved, F.lit(f"{lk.column} not in {lk.hub}")
            )
        )
    return df, ok, F.concat_ws("; ", *reasons)


def load_link(spec: LinkSpec, source: DataFrame, existing: DataFrame, batch: Batch,
              hubs: dict[str, HubSpec], hub_tables, track: bool = False, keys: KeyKind = NARROW) -> LoadResult:
    cols = [lk.column for lk in spec.lookups]
    staged = source.select(*cols)
    for lk in spec.lookups:
        if lk.optional:
            staged = staged.where(F.col(lk.column).isNotNull())
    # One row per combination of referenced members, before the lookups: the
    # business keys move, and no hash key (random, so it does not compress) does.
    # The lookups keep the rows apart, so nothing is to be made distinct again.
    staged = staged.distinct()
    resolved, ok, reason = resolve(staged, spec.lookups, hubs, hub_tables, keys)
    key_cols = [hubs[lk.hub].key for lk in spec.lookups]
    counted, obs = _observed(resolved, ~ok, track)
    # "Already loaded" is decided on the member keys (the link key is their
    # hash), which keeps hashing out of the check.
    members = counted.where(ok).select(*key_cols)
    # A member's key is the hash of its value: what may be looked for is told
    # from the staged rows, unknown members included.
    asked = source.select(*(keys.member(lk.column).alias(hubs[lk.hub].key) for lk in spec.lookups))
    kept = keep_new(members, existing, key_cols, asked=asked.dropna())
    new = kept.select(
        keys.pair(*spec.hash_order).alias(spec.key), *key_cols, *batch.load_columns()
    )
    bad = quarantine_rows(resolved.where(~ok), spec.table, reason, cols)
    return LoadResult(new, bad, obs)


def load_satellite(rows: DataFrame, existing: DataFrame, keys: list[str] | None,
                   null_safe: bool = False, asked: DataFrame | None = None) -> DataFrame:
    """Distinct satellite rows not yet recorded under ``keys`` (None: no check); ``asked``: see ``keep_new``."""
    if keys is None:
        return rows.distinct()
    return distinct_new(rows, existing, keys, null_safe=null_safe, asked=asked)
