"""Declared schemas of the staging and vault tables.

Identifiers are 64-bit everywhere (ids and hash keys alike), timestamps carry
no time zone, and text columns keep their declared byte limits so that loads
truncate exactly like the warehouse the model comes from.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


ID = LongType()
TS = TimestampNTZType()
TEXT = StringType()
BOOL = BooleanType()

# Staging tables: column order is the positional order of the landed CSV files.
STAGING: dict[str, StructType] = {
    "users": _schema(
        ("id", ID), ("chat_name", TEXT), ("registration_dt", TS), ("country", TEXT), ("age", ID)
    ),
    "groups": _schema(
        ("id", ID), ("admin_id", ID), ("group_name", TEXT), ("registration_dt", TS),
        ("is_private", BOOL),
    ),
    "dialogs": _schema(
        ("message_id", ID), ("message_dt", TS), ("message_from", ID), ("message_to", ID),
        ("message", TEXT), ("message_group", ID),
    ),
    "group_log": _schema(
        ("group_id", ID), ("user_id", ID), ("user_id_from", ID), ("event", TEXT),
        ("event_datetime", TS),
    ),
}

# Declared varchar lengths (in bytes) of the staging text columns.
BYTE_LIMITS: dict[str, dict[str, int]] = {
    "users": {"chat_name": 200, "country": 200},
    "groups": {"group_name": 100},
    "dialogs": {"message": 1000},
    "group_log": {"event": 10},
}

# Column the staging table is date-partitioned on (users has none).
STAGING_DATE_COLUMN: dict[str, str | None] = {
    "users": None,
    "groups": "registration_dt",
    "dialogs": "message_dt",
    "group_log": "event_datetime",
}

# Column each staging table is sorted on in its files.
STAGING_SORT: dict[str, str] = {
    "users": "id",
    "groups": "id",
    "dialogs": "message_id",
    "group_log": "event_datetime",
}

# Primary keys of the staging tables (group_log has none).
STAGING_KEYS: dict[str, str | None] = {
    "users": "id",
    "groups": "id",
    "dialogs": "message_id",
    "group_log": None,
}

_LOAD = (("load_dt", TS), ("load_src", TEXT))

VAULT: dict[str, StructType] = {
    # hubs
    "h_users": _schema(("hk_user_id", ID), ("user_id", ID), ("registration_dt", TS), *_LOAD),
    "h_groups": _schema(("hk_group_id", ID), ("group_id", ID), ("registration_dt", TS), *_LOAD),
    "h_dialogs": _schema(("hk_message_id", ID), ("message_id", ID), ("message_dt", TS), *_LOAD),
    # links
    "l_admins": _schema(("hk_l_admin_id", ID), ("hk_user_id", ID), ("hk_group_id", ID), *_LOAD),
    "l_user_message": _schema(
        ("hk_l_user_message", ID), ("hk_user_id", ID), ("hk_message_id", ID), *_LOAD
    ),
    "l_groups_dialogs": _schema(
        ("hk_l_groups_dialogs", ID), ("hk_group_id", ID), ("hk_message_id", ID), *_LOAD
    ),
    "l_user_group_activity": _schema(
        ("hk_l_user_group_activity", ID), ("hk_user_id", ID), ("hk_group_id", ID), *_LOAD
    ),
    # satellites
    "s_user_socdem": _schema(("hk_user_id", ID), ("country", TEXT), ("age", ID), *_LOAD),
    "s_user_chat_info": _schema(("hk_user_id", ID), ("chat_name", TEXT), *_LOAD),
    "s_group_name": _schema(("hk_group_id", ID), ("group_name", TEXT), *_LOAD),
    "s_group_private_status": _schema(("hk_group_id", ID), ("is_private", BOOL), *_LOAD),
    "s_admins": _schema(("hk_l_admin_id", ID), ("is_admin", BOOL), ("admin_from", TS), *_LOAD),
    "s_dialog_info": _schema(
        ("hk_message_id", ID), ("message_from", ID), ("message_to", ID), ("message", TEXT), *_LOAD
    ),
    "s_auth_history": _schema(
        ("hk_l_user_group_activity", ID), ("user_id_from", ID), ("event", TEXT), ("event_dt", TS),
        *_LOAD,
    ),
}

# Columns declared NOT NULL in the vault (primary keys are implicitly NOT NULL).
VAULT_NOT_NULL: dict[str, tuple[str, ...]] = {
    "h_users": ("hk_user_id",),
    "h_groups": ("hk_group_id",),
    "h_dialogs": ("hk_message_id",),
    "l_admins": ("hk_l_admin_id", "hk_user_id", "hk_group_id", "load_dt"),
    "l_user_message": ("hk_l_user_message", "hk_user_id", "hk_message_id", "load_dt"),
    "l_groups_dialogs": ("hk_l_groups_dialogs", "hk_group_id", "hk_message_id", "load_dt"),
    "l_user_group_activity": ("hk_l_user_group_activity", "hk_user_id", "hk_group_id", "load_dt"),
    "s_user_socdem": ("hk_user_id", "load_dt"),
    "s_user_chat_info": ("hk_user_id", "load_dt"),
    "s_group_name": ("hk_group_id", "load_dt"),
    "s_group_private_status": ("hk_group_id", "load_dt"),
    "s_admins": ("hk_l_admin_id", "load_dt"),
    "s_dialog_info": ("hk_message_id", "load_dt"),
    "s_auth_history": ("hk_l_user_group_activity", "load_dt"),
}

# Column each vault table is hash-segmented on (the write layout spreads rows by it).
VAULT_SEGMENT: dict[str, str] = {
    "h_users": "hk_user_id",
    "h_groups": "hk_group_id",
    "h_dialogs": "hk_message_id",
    "l_admins": "hk_l_admin_id",
    "l_user_message": "hk_l_user_message",
    "l_groups_dialogs": "hk_l_groups_dialogs",
    "l_user_group_activity": "hk_user_id",
    "s_user_socdem": "hk_user_id",
    "s_user_chat_info": "hk_user_id",
    "s_group_name": "hk_group_id",
    "s_group_private_status": "hk_group_id",
    "s_admins": "hk_l_admin_id",
    "s_dialog_info": "hk_message_id",
    "s_auth_history": "hk_l_user_group_activity",
}
