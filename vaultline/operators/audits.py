"""Integrity audits: the warehouse's declared constraints, checked as Spark jobs.

Primary and foreign keys are informational in the source warehouse, so
duplicates and orphans can land; these jobs find them.  Every audit returns
one row per checked constraint:
``(table_name, constraint_name, column_name, n_checked, n_violations)``.

Checks are batched: all primary keys go through one tagged aggregation, all
references to one parent table through one join, and all NOT NULL columns of
a table through one scan, instead of one job per constraint.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.plans.model import HUBS
from vaultline.schemas import STAGING_KEYS, VAULT_NOT_NULL

# Declared primary keys of the vault hubs and links.
VAULT_KEYS = {
    "h_users": "hk_user_id",
    "h_groups": "hk_group_id",
    "h_dialogs": "hk_message_id",
    "l_admins": "hk_l_admin_id",
    "l_user_message": "hk_l_user_message",
    "l_groups_dialogs": "hk_l_groups_dialogs",
    "l_user_group_activity": "hk_l_user_group_activity",
}

# Declared foreign keys (child table, column, parent table, column).
STAGING_FOREIGN_KEYS = (
    ("groups", "admin_id", "users", "id"),
    ("group_log", "group_id", "groups", "id"),
    ("group_log", "user_id", "users", "id"),
    ("group_log", "user_id_from", "users", "id"),
)
VAULT_FOREIGN_KEYS = (
    ("l_admins", "hk_user_id", "h_users", "hk_user_id"),
    ("l_admins", "hk_group_id", "h_groups", "hk_group_id"),
    ("l_user_message", "hk_user_id", "h_users", "hk_user_id"),
    ("l_user_message", "hk_message_id", "h_dialogs", "hk_message_id"),
    ("l_groups_dialogs", "hk_group_id", "h_groups", "hk_group_id"),
    ("l_groups_dialogs", "hk_message_id", "h_dialogs", "hk_message_id"),
    ("l_user_group_activity", "hk_group_id", "h_groups", "hk_group_id"),
    ("l_user_group_activity", "hk_user_id", "h_users", "hk_user_id"),
    ("s_user_socdem", "hk_user_id", "h_users", "hk_user_id"),
    ("s_user_chat_info", "hk_user_id", "h_users", "hk_user_id"),
    ("s_group_name", "hk_group_id", "h_groups", "hk_group_id"),
    ("s_group_private_status", "hk_group_id", "h_groups", "hk_group_id"),
    ("s_admins", "hk_l_admin_id", "l_admins", "hk_l_admin_id"),
    ("s_dialog_info", "hk_message_id", "h_dialogs", "hk_message_id"),
    ("s_auth_history", "hk_l_user_group_activity", "l_user_group_activity",
     "hk_l_user_group_activity"),
)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _tagged(df: DataFrame, tag: str, *cols: str) -> DataFrame:
    return df.select(F.lit(tag).alias("tag"), *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])


def _report(counts: DataFrame, checks: list[tuple[str, str, str]], spark) -> DataFrame:
    """One row per (table, constraint, column) check; checks with no rows report zeros."""
    wanted = spark.createDataFrame(
        [(f"{t}|{c}|{col}", t, c, col) for t, c, col in checks],
        "tag string, table_name string, constraint_name string, column_name string",
    )
    return wanted.join(counts, "tag", "left").select(
        "table_name", "constraint_name", "column_name",
        F.coalesce("n_checked", F.lit(0)).cast("long").alias("n_checked"),
        F.coalesce("n_violations", F.lit(0)).cast("long").alias("n_violations"),
    )


def _frame(staging: dict[str, DataFrame], tables, name: str) -> DataFrame:
    return staging[name[4:]] if name.startswith("stg_") else tables(name)


def duplicate_keys(staging: dict[str, DataFrame], tables) -> DataFrame:
    """Primary keys appearing more than once, and hash keys shared by two business keys."""
    pk_checks = [(f"stg_{n}", "primary_key", k) for n, k in STAGING_KEYS.items() if k]
    pk_checks += [(n, "primary_key", k) for n, k in VAULT_KEYS.items()]
    keys = _union([
        _tagged(_frame(staging, tables, t), f"{t}|{c}|{k}", k) for t, c, k in pk_checks
    ]).where(F.col("v0").isNotNull())
    per_key = keys.groupBy("tag", "v0").agg(F.count(F.lit(1)).alias("n"))
    pk = per_key.groupBy("tag").agg(
        F.sum("n").alias("n_checked"), F.count_if(F.col("n") > 1).alias("n_violations")
    )
    hk_checks = [(n, "hash_collision", s.key) for n, s in HUBS.items()]
    members = _union([
        _tagged(tables(n), f"{n}|{c}|{k}", k, HUBS[n].key_name) for n, c, k in hk_checks
    ])
    per_hk = members.groupBy("tag", "v0").agg(F.countDistinct("v1").alias("n"))
    collisions = per_hk.groupBy("tag").agg(
        F.count(F.lit(1)).alias("n_checked"), F.count_if(F.col("n") > 1).alias("n_violations")
    )
    spark = keys.sparkSession
    return _report(pk.unionByName(collisions), pk_checks + hk_checks, spark)


def orphans(staging: dict[str, DataFrame], tables) -> DataFrame:
    """References (non-NULL) to a parent row that does not exist.

    References to the same parent are tagged and checked together: one join
    (one shuffle of the parent's keys) per parent table, not per reference.
    """
    fks = [(f"stg_{c}", fk, f"stg_{p}", pk) for c, fk, p, pk in STAGING_FOREIGN_KEYS]
    fks += list(VAULT_FOREIGN_KEYS)
    counts = []
    for parent in dict.fromkeys(p for _, _, p, _ in fks):
        group = [(c, fk, pk) for c, fk, p, pk in fks if p == parent]
        pk = group[0][2]
        # count each referenced key once per reference before the join: a
        # member referenced by a third of all rows becomes one row per task
        refs = _union([
            _tagged(_frame(staging, tables, c), f"{c}|foreign_key:{parent}|{fk}", fk)
            for c, fk, _ in group
        ]).where(F.col("v0").isNotNull()).groupBy("tag", "v0").agg(F.count(F.lit(1)).alias("n"))
        keys = (_frame(staging, tables, parent).select(F.col(pk).alias("k"))
                .where(F.col("k").isNotNull()).distinct().withColumn("found", F.lit(True)))
        counts.append(
            refs.join(keys, refs.v0 == keys.k, "left").groupBy("tag").agg(
                F.sum("n").alias("n_checked"),
                F.sum(F.when(F.col("found").isNull(), F.col("n")).otherwise(0)).alias("n_violations"),
            )
        )
    checks = [(c, f"foreign_key:{p}", fk) for c, fk, p, _ in fks]
    return _report(_union(counts), checks, counts[0].sparkSession)


def check_age(staging: dict[str, DataFrame], tables) -> DataFrame:
    """``age >= 0`` (a NULL age passes, as a SQL CHECK does)."""
    def audit(df: DataFrame, table: str) -> DataFrame:
        return df.agg(
            F.count("age").alias("n_checked"), F.count_if(F.col("age") < 0).alias("n_violations")
        ).select(F.lit(f"{table}|check:age>=0|age").alias("tag"), "n_checked", "n_violations")

    counts = audit(staging["users"], "stg_users").unionByName(
        audit(tables("s_user_socdem"), "s_user_socdem"))
    checks = [("stg_users", "check:age>=0", "age"), ("s_user_socdem", "check:age>=0", "age")]
    return _report(counts, checks, counts.sparkSession)


def not_null(staging: dict[str, DataFrame], tables) -> DataFrame:
    """NULLs in NOT NULL columns; one scan per table for all of its columns."""
    out = []
    for name, cols in VAULT_NOT_NULL.items():
        counts = tables(name).agg(
            F.count(F.lit(1)).alias("n_checked"),
            *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols],
        )
        per_col = F.explode(
            F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.col(f"nulls_{c}").alias("n_violations"))
                for c in cols
            ])
        )
        out.append(counts.select("n_checked", per_col.alias("v")).select(
            F.lit(name).alias("table_name"),
            F.lit("not_null").alias("constraint_name"),
            F.col("v.column_name").alias("column_name"),
            F.col("n_checked").cast("long").alias("n_checked"),
            F.col("v.n_violations").cast("long").alias("n_violations"),
        ))
    return _union(out)


def all_audits(staging: dict[str, DataFrame], tables) -> DataFrame:
    """Every audit in one result (one query: independent scans run side by side)."""
    return _union([fn(staging, tables) for fn in (duplicate_keys, orphans, check_age, not_null)])
