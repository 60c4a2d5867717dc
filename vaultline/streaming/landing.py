"""Pick up landed file sets and load each one as a vault batch.

The warehouse job runs hourly and loads whatever the four files hold.  Here
every landing is a folder ``<landing_root>/<batch_id>/`` holding
``users.csv groups.csv dialogs.csv group_log.csv`` and, written last, a
``READY`` marker (any non-empty text, e.g. the batch id: the file source
skips empty files).  A file-source stream over the markers remembers in
its checkpoint which landings were loaded; ``foreachBatch`` runs
``run_batch`` for each new folder, in batch-id order.

A micro-batch that fails is replayed from the checkpoint; ``run_batch``
rewrites only that batch's directories, so the replay yields the same vault
(exactly-once in effect).  Only the marker paths pass through the driver,
never rows.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vaultline.operators.store import Batch
from vaultline.plans.pipeline import RunReport, run_batch
from vaultline.schemas import STAGING

MARKER = "READY"  # names starting with "_" or "." are hidden from file listings


def _folder(marker_path: str) -> str:
    return marker_path.rstrip("/").rsplit("/", 1)[0]


def load_landed(
    spark: SparkSession,
    landing_root: str,
    checkpoint: str,
    staging_root: str,
    vault_root: str,
    *,
    mode: str = "idempotent",
    strict: bool = False,
    dialect: str = "default",
    available_now: bool = True,
    reports: list[RunReport] | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it loads what has landed and stops.

    Folder names must be integers (the batch id, e.g. ``2024060712``); the load
    timestamp is the processing time, as the warehouse's ``now()``.
    """
    markers = (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("pathGlobFilter", MARKER)
        .load(f"{landing_root.rstrip('/')}/*/")
        .select("path")
    )

    def load(batch_df: DataFrame, epoch_id: int) -> None:
        folders = sorted({_folder(r.path) for r in batch_df.collect()},
                         key=lambda f: int(f.rsplit("/", 1)[1]))
        for folder in folders:
            batch = Batch(int(folder.rsplit("/", 1)[1]),
                          datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))
            paths = {name: f"{folder}/{name}.csv" for name in STAGING}
            report = run_batch(spark, batch, staging_root=staging_root, vault_root=vault_root,
                               csv_paths=paths, mode=mode, strict=strict, dialect=dialect)
            if reports is not None:
                reports.append(report)

    writer = markers.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
