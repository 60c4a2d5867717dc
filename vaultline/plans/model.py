"""The community vault: 3 hubs, 4 links and 7 satellites as declarative specs.

Load order matters and is fixed: hubs, then links (they look hub members
up), then satellites (some hang off links).  Every satellite is insert-once
per parent key (a changed attribute of a known user is not recorded), except
the two whose behaviour depends on the rerun mode:

* ``s_dialog_info``: ``"reference"`` re-appends every message of the hub on
  every run (a message no longer staged gets a row of NULLs);
  ``"idempotent"`` records each message once.
* ``s_auth_history``: ``"reference"`` skips an ``add`` whose link already has
  history but re-appends every ``leave`` on every run; ``"idempotent"``
  records each distinct event row once.

For a first load into an empty vault both modes give the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions.keys import NARROW, KeyKind
from vaultline.operators.loaders import HubSpec, LinkSpec, Lookup

HUBS: dict[str, HubSpec] = {
    "h_users": HubSpec("h_users", "users", "hk_user_id", "id", "user_id", ("registration_dt",)),
    "h_groups": HubSpec("h_groups", "groups", "hk_group_id", "id", "group_id", ("registration_dt",)),
    "h_dialogs": HubSpec(
        "h_dialogs", "dialogs", "hk_message_id", "message_id", "message_id", ("message_dt",)
    ),
}

LINKS: dict[str, LinkSpec] = {
    "l_admins": LinkSpec(
        "l_admins", "groups", "hk_l_admin_id",
        (Lookup("h_users", "admin_id"), Lookup("h_groups", "id", derived=True)),
        ("hk_group_id", "hk_user_id"),
    ),
    "l_user_message": LinkSpec(
        "l_user_message", "dialogs", "hk_l_user_message",
        (Lookup("h_users", "message_from"), Lookup("h_dialogs", "message_id", derived=True)),
        ("hk_message_id", "hk_user_id"),
    ),
    "l_groups_dialogs": LinkSpec(
        "l_groups_dialogs", "dialogs", "hk_l_groups_dialogs",
        (Lookup("h_groups", "message_group", optional=True),
         Lookup("h_dialogs", "message_id", derived=True)),
        ("hk_group_id", "hk_message_id"),
    ),
    "l_user_group_activity": LinkSpec(
        "l_user_group_activity", "group_log", "hk_l_user_group_activity",
        (Lookup("h_users", "user_id"), Lookup("h_groups", "group_id")),
        ("hk_user_id", "hk_group_id"),
    ),
}


@dataclass(frozen=True)
class HubSatelliteSpec:
    """Descriptive attributes of a hub member, taken from the hub's own staging table."""

    table: str
    hub: str
    attributes: tuple[str, ...]


HUB_SATELLITES: dict[str, HubSatelliteSpec] = {
    "s_user_socdem": HubSatelliteSpec("s_user_socdem", "h_users", ("country", "age")),
    "s_user_chat_info": HubSatelliteSpec("s_user_chat_info", "h_users", ("chat_name",)),
    "s_group_name": HubSatelliteSpec("s_group_name", "h_groups", ("group_name",)),
    "s_group_private_status": HubSatelliteSpec("s_group_private_status", "h_groups", ("is_private",)),
}

SATELLITES = (*HUB_SATELLITES, "s_admins", "s_dialog_info", "s_auth_history")

LOAD_ORDER: tuple[str, ...] = (*HUBS, *LINKS, *SATELLITES)

# The group-log events the authorisation history records.
AUTH_EVENTS = ("add", "leave")

RERUN_MODES = ("idempotent", "reference")

# Tables each load reads besides staging (hubs it looks up, links it hangs off).
DEPENDS: dict[str, tuple[str, ...]] = {
    "l_admins": ("h_users",),
    "l_user_message": ("h_users",),
    "l_groups_dialogs": ("h_groups",),
    "l_user_group_activity": ("h_users", "h_groups"),
    "s_admins": ("l_admins", "h_groups"),
    "s_dialog_info": ("h_dialogs",),
    "s_auth_history": ("l_user_group_activity",),
}


def load_closure(targets) -> tuple[str, ...]:
    """``targets`` and everything they read, in load order."""
    needed: set[str] = set()
    stack = list(targets)
    while stack:
        name = stack.pop()
        if name not in needed:
            needed.add(name)
            stack.extend(DEPENDS.get(name, ()))
    return tuple(t for t in LOAD_ORDER if t in needed)


def hub_satellite_rows(spec: HubSatelliteSpec, staging: DataFrame, load_columns,
                       keys: KeyKind = NARROW) -> DataFrame:
    """Hub key (the hash of the staged business key: the hub was just loaded
    from this table) with the attributes."""
    hub = HUBS[spec.hub]
    bk = F.col(hub.business_key)
    return (
        staging.where(bk.isNotNull())
        .select(bk.alias("__bk"), *spec.attributes)
        .select(keys.member("__bk").alias(hub.key), *spec.attributes, *load_columns)
    )


def admin_rows(l_admins: DataFrame, h_groups: DataFrame, load_columns) -> DataFrame:
    """Every admin link with the group's registration time as the start of the role.

    A group registered twice in one batch yields two rows (both times kept).
    """
    groups = h_groups.select("hk_group_id", F.col("registration_dt").alias("admin_from"))
    return l_admins.join(groups, "hk_group_id", "left").select(
        "hk_l_admin_id", F.lit(True).alias("is_admin"), "admin_from", *load_columns
    )


def dialog_rows_from_staging(dialogs: DataFrame, load_columns, keys: KeyKind = NARROW) -> DataFrame:
    return (
        dialogs.where(F.col("message_id").isNotNull())
        .select(keys.member("message_id").alias("hk_message_id"),
                "message_from", "message_to", "message", *load_columns)
    )


def dialog_rows_from_hub(h_dialogs: DataFrame, dialogs: DataFrame, load_columns) -> DataFrame:
    """Every message of the hub, described by the staged copy if there is one."""
    staged = dialogs.select(
        F.col("message_id").alias("__mid"), "message_from", "message_to", "message"
    )
    return h_dialogs.join(staged, h_dialogs.message_id == staged.__mid, "left").select(
        "hk_message_id", "message_from", "message_to", "message", *load_columns
    )


def auth_rows(group_log: DataFrame, unresolved: DataFrame, load_columns,
              keys: KeyKind = NARROW) -> tuple[DataFrame, DataFrame]:
    """Add/leave events keyed by their activity link; events of unresolved pairs apart.

    The link key is computed from the member keys (a link exists for every
    resolved pair: the link table was loaded from this staging table first);
    only the pairs the link load could not resolve, normally none, are
    matched, so the event table is never joined against the hubs again.
    """
    events = group_log.where(F.col("event").isin(*AUTH_EVENTS))
    bad = unresolved
    on = events.user_id.eqNullSafe(bad.user_id) & events.group_id.eqNullSafe(bad.group_id)
    placed = events.join(bad, on, "left_anti")
    orphans = events.join(bad, on, "left_semi")
    rows = placed.select(
        keys.pair(keys.member("user_id"), keys.member("group_id")).alias("hk_l_user_group_activity"),
        "user_id_from", "event", F.col("event_datetime").alias("event_dt"), *load_columns,
    )
    return rows, orphans


def load_levels(tables) -> list[list[str]]:
    """``tables`` grouped so that every table comes after everything it reads."""
    level: dict[str, int] = {}
    for name in LOAD_ORDER:
        if name in tables:
            level[name] = 1 + max((level[d] for d in DEPENDS.get(name, ()) if d in level), default=-1)
    return [[t for t in level if level[t] == n] for n in range(max(level.values(), default=-1) + 1)]
