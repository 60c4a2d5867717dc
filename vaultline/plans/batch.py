"""One incremental vault load: hubs, links, satellites, in that order.

``load_vault`` works against any store.  With ``MemoryVault`` it only builds
plans (queries and tests read the rows of any table lazily); with
``ParquetVault`` every step is written before the next one reads it, so each
step is its own job over stored tables and a failed run is repaired by
rerunning the same batch (every table rewrites only its batch directory).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions.keys import NARROW
from vaultline.operators.loaders import load_hub, load_link, load_satellite, quarantine_rows
from vaultline.operators.segments import SegmentedVault
from vaultline.operators.store import Batch, observed
from vaultline.plans import model
from vaultline.schemas import STAGING


class QuarantineError(RuntimeError):
    """Raised in strict mode when a load could not place some rows."""


@dataclass
class VaultLoadReport:
    batch: Batch
    rows: dict[str, int | None] = field(default_factory=dict)
    quarantined: dict[str, int | None] = field(default_factory=dict)


def _unresolved_pairs(store, batch: Batch) -> DataFrame:
    q = store.batch_rows("q_l_user_group_activity", batch)
    parsed = F.from_json("record", "user_id BIGINT, group_id BIGINT")
    return q.select(parsed.alias("r")).select("r.user_id", "r.group_id")


def load_vault(
    staging: dict[str, DataFrame],
    store,
    batch: Batch,
    *,
    mode: str = "idempotent",
    strict: bool = False,
    tables: tuple[str, ...] = model.LOAD_ORDER,
    parallel: bool = True,
) -> VaultLoadReport:
    """Load one batch of the four staging frames into ``store``.

    ``tables`` must hold what its members read (``model.load_closure``).
    ``strict`` raises when a table has rows to quarantine, before the table is
    appended; the quarantine is kept for inspection.
    """
    if mode not in model.RERUN_MODES:
        raise ValueError(f"mode must be one of {model.RERUN_MODES}")
    missing = set(STAGING) - set(staging)
    if missing:
        raise ValueError(f"missing staging frames: {sorted(missing)}")
    unread = set(model.load_closure(tables)) - set(tables)
    if unread:
        raise ValueError(f"tables must include what they read: {sorted(unread)}")
    load_cols = batch.load_columns()
    report = VaultLoadReport(batch)

    track = getattr(store, "materialized", False)
    keys = getattr(store, "keys", NARROW)

    def save(name: str, rows: DataFrame, quarantine: DataFrame | None = None,
             quarantined=None) -> None:
        if strict and quarantine is not None:
            n = quarantine.count()
            if n:
                report.quarantined[name] = store.append(f"q_{name}", quarantine, batch)
                raise QuarantineError(f"{n} rows of {name} could not be placed")
        report.rows[name] = store.append(name, rows, batch)
        if quarantine is None:
            return
        if track and observed(quarantined, "n") == 0:
            # counted while the rows were written: clear the batch's quarantine
            # without a second pass over the source
            report.quarantined[name] = store.clear(f"q_{name}", batch)
        else:
            report.quarantined[name] = store.append(f"q_{name}", quarantine, batch)

    def step(name: str) -> None:
        if name in model.HUBS:
            spec = model.HUBS[name]
            res = load_hub(spec, staging[spec.source], store.existing(name, batch), batch,
                           track=track, keys=keys)
            save(name, res.rows, res.quarantine, res.quarantined)
        elif name in model.LINKS:
            spec = model.LINKS[name]
            res = load_link(spec, staging[spec.source], store.existing(name, batch), batch,
                            model.HUBS, store.table, track=track, keys=keys)
            save(name, res.rows, res.quarantine, res.quarantined)
        elif name in model.HUB_SATELLITES:
            spec = model.HUB_SATELLITES[name]
            hub = model.HUBS[spec.hub]
            rows = model.hub_satellite_rows(spec, staging[hub.source], load_cols, keys)
            asked = staging[hub.source].select(keys.member(hub.business_key).alias(hub.key)).dropna()
            save(name, load_satellite(rows, store.existing(name, batch), [hub.key], asked=asked))
        elif name == "s_admins":
            # links without a row come first: only theirs are joined with the hub
            links = store.table("l_admins").select("hk_l_admin_id", "hk_group_id")
            links = load_satellite(links, store.existing(name, batch), ["hk_l_admin_id"], asked=links)
            save(name, model.admin_rows(links, store.table("h_groups"), load_cols).distinct())
        elif name == "s_dialog_info":
            if mode == "reference":
                rows = model.dialog_rows_from_hub(store.table("h_dialogs"), staging["dialogs"], load_cols)
                save(name, load_satellite(rows, store.existing(name, batch), None))
            else:
                rows = model.dialog_rows_from_staging(staging["dialogs"], load_cols, keys)
                asked = staging["dialogs"].select(keys.member("message_id").alias("hk_message_id")).dropna()
                save(name, load_satellite(rows, store.existing(name, batch), ["hk_message_id"], asked=asked))
        elif name == "s_auth_history":
            if track and report.quarantined.get("l_user_group_activity") == 0:
                # the link load of this run placed every pair: nothing to set apart
                unresolved = store.empty("q_l_user_group_activity")
                unresolved = unresolved.select(
                    F.lit(None).cast("bigint").alias("user_id"), F.lit(None).cast("bigint").alias("group_id")
                )
            else:
                unresolved = _unresolved_pairs(store, batch)
            rows, orphans = model.auth_rows(staging["group_log"], unresolved, load_cols, keys)
            existing = store.existing(name, batch)
            key = "hk_l_user_group_activity"
            if mode == "reference":
                adds = load_satellite(rows.where(F.col("event") == "add"), existing, [key])
                new = adds.unionByName(rows.where(F.col("event") == "leave").distinct())
            else:
                asked = staging["group_log"].where(F.col("event").isin(*model.AUTH_EVENTS)).select(
                    keys.pair(keys.member("user_id"), keys.member("group_id")).alias(key)).dropna()
                event = [key, "user_id_from", "event", "event_dt"]
                new = load_satellite(rows.select(*event), existing, event, null_safe=True,
                                     asked=asked).select(*event, *load_cols)
            bad = quarantine_rows(orphans, name, F.lit("user_id/group_id not in hubs"),
                                  orphans.columns)
            save(name, new, bad)
        else:
            raise KeyError(name)

    # Tables of one level read nothing the others write, so a writing store
    # submits their jobs together (small jobs then share the cores); a lazy
    # store just records the plans in order.
    for level in model.load_levels(tables):
        if track and parallel and len(level) > 1:
            with ThreadPoolExecutor(max_workers=len(level)) as pool:
                for future in [pool.submit(step, name) for name in level]:
                    future.result()
        else:
            for name in level:
                step(name)
    if isinstance(store, SegmentedVault):
        store.commit(batch)  # the whole batch appears at once
    return report
