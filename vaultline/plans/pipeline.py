"""The hourly batch: refresh staging, then load the vault, then report.

``run_batch`` is what a scheduler calls once per run.  Staging is fully
refreshed (the previous run's staging is replaced), every vault table
appends into its own batch directory, and the returned report carries the
loaded, rejected and quarantined row counts.  Each step reads what the
previous one wrote, so a lost executor only retries tasks of the current
step, and a failed run is repaired by running the same batch again.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.functions.keys import NARROW, KeyKind
from vaultline.operators.audit_log import AuditLog
from vaultline.operators.segments import SegmentedVault
from vaultline.operators.store import Batch, ParquetVault
from vaultline.plans import model
from vaultline.plans.batch import VaultLoadReport, load_vault
from vaultline.schemas import STAGING
from vaultline.sources.staging import (
    REJECT_REASON,
    StagingReport,
    conformed_columns,
    read_csv,
    read_staging,
    refresh_staging,
)


@dataclass
class RunReport:
    batch: Batch
    staging: dict[str, StagingReport] = field(default_factory=dict)
    vault: VaultLoadReport | None = None

    def as_rows(self) -> list[tuple[str, str, int | None]]:
        rows = []
        for name, r in self.staging.items():
            rows.append((f"stg_{name}", "loaded", r.rows_loaded))
            rows.append((f"stg_{name}", "rejected", r.rows_rejected))
        if self.vault:
            rows += [(t, "appended", n) for t, n in self.vault.rows.items()]
            rows += [(t, "quarantined", n) for t, n in self.vault.quarantined.items()]
        return rows


def as_parsed(df: DataFrame, table: str) -> DataFrame:
    """A frame that is already typed (no raw lines) in the shape the refresh expects."""
    return df.select(
        *conformed_columns(table),
        F.lit(None).cast("string").alias(REJECT_REASON),
        F.lit(None).cast("string").alias("raw_line"),
        F.lit(None).cast("string").alias("source_file"),
    )


def run_batch(
    spark: SparkSession,
    batch: Batch,
    *,
    staging_root: str,
    vault_root: str,
    csv_paths: dict[str, str | list[str]] | None = None,
    frames: dict[str, DataFrame] | None = None,
    as_of: str | None = None,
    mode: str = "idempotent",
    strict: bool = False,
    dialect: str = "default",
    tables: tuple[str, ...] = model.LOAD_ORDER,
    segments: int | None = None,
    keys: KeyKind = NARROW,
    audit: bool = False,
    joined_frames: bool = False,
) -> RunReport:
    """Stage the four inputs (landed CSV files, or typed frames) and load the vault.

    ``segments``: the vault is a ``SegmentedVault`` with so many hash segments.
    ``keys``: the vault's surrogate keys, ``NARROW`` (60 bits) or ``WIDE`` (128 bits).
    ``joined_frames``: the ``frames`` come out of joins and are staged without another shuffle.
    ``audit``: check the batch's rows after the load and keep what is found in ``audit_log``.
    """
    if (csv_paths is None) == (frames is None):
        raise ValueError("give exactly one of csv_paths or frames")
    as_of = as_of or batch.load_dt[:10]
    report = RunReport(batch)

    def stage(name: str) -> None:
        parsed = (read_csv(spark, csv_paths[name], name, dialect) if csv_paths is not None
                  else as_parsed(frames[name], name))
        report.staging[name] = refresh_staging(parsed, name, staging_root, as_of, joined=joined_frames)

    # the four refreshes are independent jobs: submit them together
    with ThreadPoolExecutor(max_workers=len(STAGING)) as pool:
        for future in [pool.submit(stage, name) for name in STAGING]:
            future.result()
    staging = {name: read_staging(spark, staging_root, name) for name in STAGING}
    store = (SegmentedVault(spark, vault_root, segments, keys=keys) if segments
             else ParquetVault(spark, vault_root, cache_reads=True, keys=keys))
    report.vault = load_vault(staging, store, batch, mode=mode, strict=strict, tables=tables)
    write_report(spark, report, vault_root)
    if audit:
        audit_log(spark, vault_root, keys).audit(batch, lambda name: store.batch_rows(name, batch))
    return report


def audit_log(spark: SparkSession, vault_root: str, keys: KeyKind = NARROW) -> AuditLog:
    """What the audits of a vault's batches found."""
    return AuditLog(spark, f"{vault_root.rstrip('/')}/_audit", keys=keys)


REPORT_SCHEMA = "table_name STRING, metric STRING, n_rows BIGINT, load_dt STRING"


def write_report(spark: SparkSession, report: RunReport, vault_root: str) -> None:
    """Keep the run's counts next to the vault (one small directory per batch)."""
    rows = [(t, m, n, report.batch.load_dt) for t, m, n in report.as_rows()]
    (spark.createDataFrame(rows, REPORT_SCHEMA).coalesce(1).write.mode("overwrite")
     .parquet(f"{vault_root.rstrip('/')}/load_report/batch_id={report.batch.batch_id}"))


def read_reports(spark: SparkSession, vault_root: str) -> DataFrame:
    """Every stored run report (``batch_id`` from the directory)."""
    return spark.read.parquet(f"{vault_root.rstrip('/')}/load_report")
