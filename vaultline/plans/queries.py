"""Named queries over the driver tables (each ``(spark, sf_dir) -> DataFrame``).

A query runs the pipeline exactly as production does: the adapter derives
the four staging inputs from the given tables, ``run_batch`` refreshes
staging and appends every vault table as parquet, and the query reads the
stored tables.  The stored scenario lives under the session's checkpoint
folder (``spark.checkpoint.dir``; a local fallback only where it is unset)
and is built once per session and data folder, then shared by the queries.

Scenarios: ``first`` loads the whole source as batch 1 into an empty vault;
``csv`` does the same after writing the source out as landed CSV files, so
the CSV scan and reject split are on the path;
``rejects`` lands it with some lines spoiled by rule;
``second`` loads the source as it stood before ``SECOND_LOAD_CUTOFF`` (every
staged row dated earlier, less every ``LATE_GROUPS``-th group and its rows) as
batch 1 and then the whole source as batch 2, and ``*_second_load`` queries
return what batch 2 appends (``reference`` repeats this with the reference
rerun behaviour); ``segmented`` does it in a segmented vault, folds the day and
loads batch 2 once more over the folded history; ``wide`` is ``first`` with
128-bit keys.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.functions.calendar import calendar_bucket
from vaultline.functions.keys import WIDE
from vaultline.functions.text import truncate_utf8_bytes
from vaultline.operators import audits
from vaultline.operators.audit_log import AuditLog
from vaultline.operators.segments import SegmentedVault
from vaultline.operators.store import Batch, MemoryVault, ParquetVault
from vaultline.plans import marts, model
from vaultline.plans.batch import load_vault
from vaultline.plans.pipeline import read_reports, run_batch
from vaultline.schemas import STAGING, STAGING_DATE_COLUMN
from vaultline.session import checkpoint_dir
from vaultline.sources.adapter import staging_from_driver_tables
from vaultline.sources.staging import read_rejects, read_staging

# Fixed values of the query suite (the oracle SQL uses the same literals).
BATCH_1 = Batch(1, "2024-06-07 12:00:00")
BATCH_2 = Batch(2, "2024-06-07 13:00:00")
SECOND_LOAD_CUTOFF = "1998-01-01 00:00:00"
LATE_GROUPS = 10  # groups of these ids, and what refers to them, come with the second load
SEGMENTS = 8
TRUNCATE_BYTES = 1000  # declared length of a message

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Loaded:
    """A stored scenario: its staging (of the last batch) and its vault."""

    spark: SparkSession
    staging_root: str
    vault_root: str

    @property
    def vault(self) -> ParquetVault:
        return ParquetVault(self.spark, self.vault_root, cache_reads=True)

    def staging(self) -> dict[str, DataFrame]:
        return {name: read_staging(self.spark, self.staging_root, name) for name in STAGING}


_LOADED: dict[tuple[str, str, str], Loaded] = {}
_LOCK = threading.Lock()


def _app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        return spark.conf.get("spark.app.id", "session")


_WORK_ROOTS: dict[str, str] = {}


def _work_root(spark: SparkSession) -> str:
    """``<checkpoint folder>/vaultline``, fixed for the life of the application."""
    app = _app_id(spark)
    if app not in _WORK_ROOTS:
        _WORK_ROOTS[app] = _find_work_root(spark)
    return _WORK_ROOTS[app]


def _find_work_root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - sessions without a local SparkContext
            base = None
    if not base:  # only where the session names no shared folder (local runs)
        base = checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="vaultline-checkpoint-"))
    return f"{base.rstrip('/')}/vaultline"


def staging_before(staging: dict[str, DataFrame], cutoff: str) -> dict[str, DataFrame]:
    """The source as it stood at ``cutoff``: rows dated before it (undated rows not yet), without the late groups."""
    group = {"groups": "id", "dialogs": "message_group", "group_log": "group_id"}
    out = {}
    for name, df in staging.items():
        date_col = STAGING_DATE_COLUMN[name] or "registration_dt"
        df = df.where(F.col(date_col) < F.lit(cutoff).cast("timestamp_ntz"))
        if name in group:
            df = df.where(F.coalesce(F.col(group[name]) % LATE_GROUPS, F.lit(1)) != 0)
        out[name] = df
    return out


def loaded(spark: SparkSession, sf_dir: str, scenario: str = "first") -> Loaded:
    """The stored scenario for ``sf_dir``; built once per session, one builder at a time.

    Every build writes a folder of its own: one that died half way is never read.
    """
    sf_dir = sf_dir.rstrip("/")
    key = (_app_id(spark), sf_dir, scenario)
    with _LOCK:
        if key not in _LOADED:
            root = f"{_work_root(spark)}/{scenario}-{uuid.uuid4().hex}"
            out = Loaded(spark, f"{root}/staging", f"{root}/vault")
            _build(spark, sf_dir, scenario, out)
            _LOADED[key] = out
        return _LOADED[key]


def land_csv(source: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write staging inputs as landed CSV files (gzip, header line, positional columns)."""
    paths = {}
    for name, df in source.items():
        paths[name] = f"{folder}/{name}"
        (df.write.mode("overwrite").option("header", True).option("compression", "gzip")
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(paths[name]))
    return paths


def _spoiled(name: str, df: DataFrame) -> DataFrame:
    """Landed lines of a staging input as ``value``, some of them spoiled (fixed rules of the query suite)."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]

    def line(*values) -> Column:
        return F.concat_ws(",", *values)

    spoiled = {
        "users": F.when(F.col("id") % 50 == 1, line(*texts[:4], F.lit("old"))),  # text in a number
        "groups": F.when(F.col("id") % 7 == 3, line(*texts[:4], F.lit("maybe"))),  # no boolean
        "dialogs": F.when(F.col("message_id") % 200 == 8, line(*texts[:3]))  # too few fields, too many
        .when(F.col("message_id") % 200 == 9, line(*texts, F.lit("surplus"))),
        "group_log": F.when((F.col("group_id") + F.col("user_id")) % 97 == 5,
                            line(*texts[:4], F.lit("1996-13-45 00:00:00"))),  # no such day
    }[name]
    return df.select(F.coalesce(spoiled, line(*texts)).alias("value"))


def land_lines(source: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write staging inputs as landed CSV files, each file with a header line, with spoiled lines."""
    paths = {}
    for name, df in source.items():
        paths[name] = f"{folder}/{name}"
        header = ",".join(df.columns)

        def headed(batches, header=header):
            yield pa.RecordBatch.from_pydict({"value": [header]})
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"value": batch.column(0)})

        _spoiled(name, df).mapInArrow(headed, "value string").write.text(paths[name])
    return paths


def _build(spark: SparkSession, sf_dir: str, scenario: str, out: Loaded) -> None:
    source = staging_from_driver_tables(spark, sf_dir)
    mode = "reference" if scenario == "second_reference" else "idempotent"
    if scenario == "csv":
        # the source goes through files: CSV scan, reject split, typed refresh
        landing = out.staging_root.rsplit("/", 1)[0] + "/landing"
        run_batch(spark, BATCH_1, staging_root=out.staging_root, vault_root=out.vault_root,
                  csv_paths=land_csv(source, landing), mode=mode)
    elif scenario == "rejects":
        landing = out.staging_root.rsplit("/", 1)[0] + "/landing"
        run_batch(spark, BATCH_1, staging_root=out.staging_root, vault_root=out.vault_root,
                  csv_paths=land_lines(source, landing), tables=("h_users",))
    elif scenario == "segmented":
        for batch, frames in ((BATCH_1, staging_before(source, SECOND_LOAD_CUTOFF)), (BATCH_2, source)):
            run_batch(spark, batch, staging_root=out.staging_root, vault_root=out.vault_root, frames=frames,
                      segments=SEGMENTS, joined_frames=True)
        vault = SegmentedVault(spark, out.vault_root, SEGMENTS)
        vault.fold("2024-06-08")
        load_vault(out.staging(), vault, BATCH_2)
    elif scenario == "wide":
        run_batch(spark, BATCH_1, staging_root=out.staging_root, vault_root=out.vault_root, frames=source, keys=WIDE,
                  joined_frames=True)
    elif scenario == "first":
        run_batch(spark, BATCH_1, staging_root=out.staging_root, vault_root=out.vault_root,
                  frames=source, mode=mode, joined_frames=True)
    elif scenario in ("second", "second_reference"):
        run_batch(spark, BATCH_1, staging_root=out.staging_root, vault_root=out.vault_root,
                  frames=staging_before(source, SECOND_LOAD_CUTOFF), mode=mode, joined_frames=True)
        run_batch(spark, BATCH_2, staging_root=out.staging_root, vault_root=out.vault_root,
                  frames=source, mode=mode, joined_frames=True)
    else:
        raise ValueError(scenario)


def _vault_query(table: str) -> Query:
    return lambda spark, sf_dir: loaded(spark, sf_dir).vault.table(table)


def _second_load_query(table: str, scenario: str = "second") -> Query:
    return lambda spark, sf_dir: loaded(spark, sf_dir, scenario).vault.batch_rows(table, BATCH_2)


def _csv_staging_query(name: str) -> Query:
    return lambda spark, sf_dir: loaded(spark, sf_dir, "csv").staging()[name]


def _staging_query(name: str) -> Query:
    return lambda spark, sf_dir: loaded(spark, sf_dir).staging()[name]


def varchar_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts cut to a message's declared byte length (multi-byte text)."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    cut = truncate_utf8_bytes("text", TRUNCATE_BYTES)
    return docs.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("bytes_in"),
        cut.alias("message"),
        F.octet_length(cut).cast("long").alias("bytes_out"),
    )


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows each staging table and each vault table received in a first load, as observed while they were written."""
    reports = read_reports(spark, loaded(spark, sf_dir).vault_root)
    return (reports.where((F.col("batch_id") == BATCH_1.batch_id) & F.col("metric").isin("loaded", "appended"))
            .select("table_name", "n_rows"))


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line set aside while the spoiled source was staged: table, reason, the line itself."""
    run = loaded(spark, sf_dir, "rejects")
    frames = [read_rejects(spark, run.staging_root, name)
              .select(F.lit(name).alias("table_name"), "reject_reason", "raw_line") for name in STAGING]
    return reduce(lambda a, b: a.unionByName(b), frames)


def calendar_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition buckets of the messages, seen from the newest message's day."""
    dialogs = loaded(spark, sf_dir).staging()["dialogs"]
    as_of = dialogs.select(F.max("message_dt")).scalar()  # scalar subquery
    return (
        dialogs.select(calendar_bucket("message_dt", as_of).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n_messages"))
    )


# Tables the conversion report reads.
CONVERSION_TABLES = ("h_groups", "l_user_group_activity", "s_auth_history",
                     "l_groups_dialogs", "l_user_message")


def group_conversion_single_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversion report as one lazy plan straight from the driver tables.

    Nothing is stored: the adapter, the loads of only the tables the report
    reads (and what they depend on) and the report compose into one plan.
    """
    store = MemoryVault(spark)
    load_vault(staging_from_driver_tables(spark, sf_dir), store, BATCH_1,
               tables=model.load_closure(CONVERSION_TABLES))
    return marts.group_conversion(store.table)


def _mart(fn) -> Query:
    return lambda spark, sf_dir: fn(loaded(spark, sf_dir).vault.table)


def _audit(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        run_ = loaded(spark, sf_dir)
        return fn(run_.staging(), run_.vault.table)

    return run


def with_faults(staging: dict[str, DataFrame], tables) -> tuple[dict[str, DataFrame], Callable[[str], DataFrame]]:
    """Staging and vault tables with faults planted by rule, for the audits to find."""
    far = 1_000_000  # no such member
    users, groups, log = staging["users"], staging["groups"], staging["group_log"]
    faulty = dict(
        staging,
        users=users.withColumn("age", F.when(F.col("id") % 40 == 0, -F.col("age")).otherwise(F.col("age")))
        .unionByName(users.where("id % 50 = 0")),
        groups=groups.withColumn("admin_id", F.col("admin_id") + F.when(F.col("id") % 7 == 0, far).otherwise(0)),
        group_log=log.withColumn("user_id_from",
                                 F.col("user_id_from") + F.when(F.col("group_id") % 9 == 0, far).otherwise(0)))

    def table(name: str) -> DataFrame:
        df = tables(name)
        if name == "h_users":  # one key for two business keys
            return df.unionByName(df.where("user_id % 60 = 0").withColumn("user_id", F.col("user_id") + far))
        if name == "l_user_message":
            key = F.col("hk_l_user_message")
            return df.withColumn("hk_user_id", F.col("hk_user_id") + F.when(key % 11 == 0, 1).otherwise(0)).withColumn(
                "hk_message_id", F.when(key % 13 != 0, F.col("hk_message_id")))
        if name == "s_user_socdem":
            key = F.col("hk_user_id")
            return df.withColumn("age", F.when(key % 17 == 0, -1).otherwise(F.col("age"))).withColumn(
                "load_dt", F.when(key % 19 != 0, F.col("load_dt")))
        return df

    return faulty, table


def _planted_audit(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        run_ = loaded(spark, sf_dir)
        return fn(*with_faults(run_.staging(), run_.vault.table))

    return run


_AUDITED: dict[tuple[str, str], AuditLog] = {}
_AUDIT_LOCK = threading.Lock()


def audited(spark: SparkSession, sf_dir: str) -> AuditLog:
    """Both batches of the second load, with planted faults, each audited alone; done once per session."""
    run, key = loaded(spark, sf_dir, "second"), (_app_id(spark), sf_dir.rstrip("/"))
    with _AUDIT_LOCK:
        if key not in _AUDITED:
            log = AuditLog(spark, f"{run.vault_root}/_audit-{uuid.uuid4().hex}", segments=SEGMENTS)
            for batch in (BATCH_1, BATCH_2):
                _, rows = with_faults(run.staging(), lambda name, b=batch: run.vault.batch_rows(name, b))
                log.audit(batch, rows)
            _AUDITED[key] = log
        return _AUDITED[key]


# Tables whose second load is also registered over the segmented vault.
SEGMENTED = ("h_users", "h_groups", "h_dialogs", "l_user_group_activity", "s_dialog_info", "s_auth_history")


def _segmented_query(table: str) -> Query:
    return lambda spark, sf_dir: SegmentedVault(
        spark, loaded(spark, sf_dir, "segmented").vault_root, SEGMENTS).batch_rows(table, BATCH_2)


def _hex_keys(df: DataFrame) -> DataFrame:
    """Wide keys as hex digits."""
    return df.withColumns({c: F.lower(F.hex(c)) for c in df.columns if c.startswith("hk_")})


# Tables also registered with wide keys.
WIDE_TABLES = ("h_dialogs", "l_user_group_activity", "s_dialog_info", "s_auth_history")


def _wide(spark: SparkSession, sf_dir: str) -> ParquetVault:
    return ParquetVault(spark, loaded(spark, sf_dir, "wide").vault_root, cache_reads=True, keys=WIDE)


def _wide_query(table: str) -> Query:
    return lambda spark, sf_dir: _hex_keys(_wide(spark, sf_dir).table(table))


QUERY_NAMES = {
    "h_users": "hub_users",
    "h_groups": "hub_groups",
    "h_dialogs": "hub_dialogs",
    "l_admins": "link_admins",
    "l_user_message": "link_user_message",
    "l_groups_dialogs": "link_groups_dialogs",
    "l_user_group_activity": "link_user_group_activity",
    "s_user_socdem": "sat_user_socdem",
    "s_user_chat_info": "sat_user_chat_info",
    "s_group_name": "sat_group_name",
    "s_group_private_status": "sat_group_private_status",
    "s_admins": "sat_admins",
    "s_dialog_info": "sat_dialog_info",
    "s_auth_history": "sat_auth_history",
}


def all_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for name in ("users", "groups", "dialogs", "group_log"):
        q[f"stg_{name}"] = _staging_query(name)
    q["stg_varchar_truncate"] = varchar_truncate
    q["load_counts"] = load_counts
    q["calendar_bucket"] = calendar_buckets
    for table, qname in QUERY_NAMES.items():
        q[qname] = _vault_query(table)
    for table, qname in QUERY_NAMES.items():
        q[f"{qname}_second_load"] = _second_load_query(table)
    q["sat_dialog_info_second_load_reference"] = _second_load_query(
        "s_dialog_info", "second_reference")
    q["sat_auth_history_second_load_reference"] = _second_load_query(
        "s_auth_history", "second_reference")
    q["first_groups_by_registration"] = _mart(
        lambda t: marts.first_groups_by_registration(t("h_groups"))
    )
    q["senders_per_group"] = _mart(
        lambda t: marts.senders_per_group(t("l_groups_dialogs"), t("l_user_message"))
    )
    q["users_added_per_group"] = _mart(
        lambda t: marts.users_added_per_group(
            t("l_user_group_activity"), t("s_auth_history"),
            F.broadcast(marts.first_groups_by_registration(t("h_groups"))),  # top-10 bound
        )
    )
    q["group_conversion"] = _mart(lambda t: marts.group_conversion(t, broadcast_rows=marts.BROADCAST_ROWS))
    q["group_conversion_single_plan"] = group_conversion_single_plan
    for name in ("users", "groups", "dialogs", "group_log"):
        q[f"stg_{name}_from_csv"] = _csv_staging_query(name)
    q["group_conversion_from_csv"] = lambda spark, sf_dir: marts.group_conversion(
        loaded(spark, sf_dir, "csv").vault.table)
    for name, fn in (("duplicate_keys", audits.duplicate_keys), ("orphans", audits.orphans),
                     ("check_age", audits.check_age), ("not_null", audits.not_null)):
        q[f"audit_{name}"] = _audit(fn)
        q[f"audit_{name}_planted"] = _planted_audit(fn)
    q["audit_batches_planted"] = lambda spark, sf_dir: audited(spark, sf_dir).totals()
    q["audit_batch_findings_planted"] = lambda spark, sf_dir: audited(spark, sf_dir).violations()
    q["stg_rejects"] = rejects
    for table in SEGMENTED:
        q[f"{QUERY_NAMES[table]}_segmented_second_load"] = _segmented_query(table)
    for table in WIDE_TABLES:
        q[f"{QUERY_NAMES[table]}_wide"] = _wide_query(table)
    q["group_conversion_wide"] = lambda spark, sf_dir: _hex_keys(marts.group_conversion(_wide(spark, sf_dir).table))
    q["group_conversion_segmented"] = lambda spark, sf_dir: marts.group_conversion(
        SegmentedVault(spark, loaded(spark, sf_dir, "segmented").vault_root, SEGMENTS).table)
    return q
