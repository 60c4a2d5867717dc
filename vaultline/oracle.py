"""Independent SQL statements of every registered query, for DuckDB.

Everything is stated over the four staging inputs, as sets: a batch appends
what its staging gives less what the earlier staging gave.  Keys are computed
from business keys where they are needed; no vault table is built and read
back.  Shared with the Spark side are the literals of the query suite alone
(batch timestamps, the second-load rule, the truncation length).
"""

from __future__ import annotations

import re

from vaultline.plans.queries import (
    BATCH_1,
    BATCH_2,
    LATE_GROUPS,
    QUERY_NAMES,
    SECOND_LOAD_CUTOFF,
    SEGMENTED,
    TRUNCATE_BYTES,
    WIDE_TABLES,
)

STAGING_SQL = """
stg_users AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS id, c.c_name AS chat_name, fo.first_dt AS registration_dt,
         n.n_name AS country, CAST(c.c_custkey % 80 + 10 AS BIGINT) AS age
  FROM customer c
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_dt FROM orders GROUP BY o_custkey) fo
         ON fo.o_custkey = c.c_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey),
stg_groups AS (
  SELECT CAST(s.s_suppkey AS BIGINT) AS id, CAST(s.s_suppkey AS BIGINT) AS admin_id,
         s.s_name AS group_name, fs.first_dt AS registration_dt, s.s_acctbal < 0 AS is_private
  FROM supplier s
  LEFT JOIN (SELECT l_suppkey, min(l_shipdate) AS first_dt FROM lineitem GROUP BY l_suppkey) fs
         ON fs.l_suppkey = s.s_suppkey),
stg_dialogs AS (
  SELECT CAST(o.o_orderkey AS BIGINT) AS message_id, o.o_orderdate AS message_dt,
         CAST(o.o_custkey AS BIGINT) AS message_from, CAST(o.o_custkey + 1 AS BIGINT) AS message_to,
         o.o_orderpriority AS message, og.g AS message_group
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, CAST(min(l_suppkey) AS BIGINT) AS g FROM lineitem GROUP BY l_orderkey) og
         ON og.l_orderkey = o.o_orderkey),
stg_group_log AS (
  SELECT CAST(l.l_suppkey AS BIGINT) AS group_id, CAST(o.o_custkey AS BIGINT) AS user_id,
         CASE WHEN l.l_linenumber = 1 THEN NULL ELSE CAST(l.l_suppkey AS BIGINT) END AS user_id_from,
         CASE l.l_returnflag WHEN 'A' THEN 'add' WHEN 'R' THEN 'leave' ELSE 'other' END AS event,
         l.l_shipdate AS event_datetime
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

CUT = f"TIMESTAMP '{SECOND_LOAD_CUTOFF}'"

EARLY_STAGING_SQL = f"""
early_users AS (SELECT * FROM stg_users WHERE registration_dt < {CUT}),
early_groups AS (SELECT * FROM stg_groups WHERE registration_dt < {CUT} AND id % {LATE_GROUPS} <> 0),
early_dialogs AS (SELECT * FROM stg_dialogs
  WHERE message_dt < {CUT} AND coalesce(message_group % {LATE_GROUPS}, 1) <> 0),
early_group_log AS (SELECT * FROM stg_group_log
  WHERE event_datetime < {CUT} AND group_id % {LATE_GROUPS} <> 0)"""


def hk(*values: str) -> str:
    """The vault's key of SQL values: 60 bits of the MD5 of their texts joined by a bar."""
    text = " || '|' || ".join(f"CAST({v} AS VARCHAR)" for v in values)
    return f"CAST('0x' || left(md5({text}), 15) AS BIGINT)"


def _pairs(link: str, s: str) -> str:
    """The member pairs a link takes from staging ``s``: a foreign member must be staged as well."""
    user, group = f"(SELECT id FROM {s}_users)", f"(SELECT id FROM {s}_groups)"
    return {
        "l_admins": f"SELECT admin_id AS u, id AS g FROM {s}_groups WHERE admin_id IN {user}",
        "l_user_message": f"SELECT message_from AS u, message_id AS m FROM {s}_dialogs WHERE message_from IN {user}",
        "l_groups_dialogs": f"SELECT message_group AS g, message_id AS m FROM {s}_dialogs WHERE message_group IN {group}",
        "l_user_group_activity":
            f"SELECT user_id AS u, group_id AS g FROM {s}_group_log WHERE user_id IN {user} AND group_id IN {group}",
    }[link]


def _events(s: str, kinds: str) -> str:
    return (f"SELECT user_id AS u, group_id AS g, user_id_from, event, event_datetime FROM {s}_group_log "
            f"WHERE event IN ({kinds}) AND user_id IN (SELECT id FROM {s}_users) "
            f"AND group_id IN (SELECT id FROM {s}_groups)")


# Output columns of each link, from member pairs.
LINK_COLUMNS = {
    "l_admins": f"{hk(hk('g'), hk('u'))} AS hk_l_admin_id, {hk('u')} AS hk_user_id, {hk('g')} AS hk_group_id",
    "l_user_message":
        f"{hk(hk('m'), hk('u'))} AS hk_l_user_message, {hk('u')} AS hk_user_id, {hk('m')} AS hk_message_id",
    "l_groups_dialogs":
        f"{hk(hk('g'), hk('m'))} AS hk_l_groups_dialogs, {hk('g')} AS hk_group_id, {hk('m')} AS hk_message_id",
    "l_user_group_activity":
        f"{hk(hk('u'), hk('g'))} AS hk_l_user_group_activity, {hk('u')} AS hk_user_id, {hk('g')} AS hk_group_id",
}

# Table, staging table, its id, and output columns of what hangs off one id.
PER_ID = (
    ("h_users", "users", "id", f"{hk('id')} AS hk_user_id, id AS user_id, registration_dt"),
    ("h_groups", "groups", "id", f"{hk('id')} AS hk_group_id, id AS group_id, registration_dt"),
    ("h_dialogs", "dialogs", "message_id", f"{hk('message_id')} AS hk_message_id, message_id, message_dt"),
    ("s_user_socdem", "users", "id", f"{hk('id')} AS hk_user_id, country, age"),
    ("s_user_chat_info", "users", "id", f"{hk('id')} AS hk_user_id, chat_name"),
    ("s_group_name", "groups", "id", f"{hk('id')} AS hk_group_id, group_name"),
    ("s_group_private_status", "groups", "id", f"{hk('id')} AS hk_group_id, is_private"),
    ("s_dialog_info", "dialogs", "message_id",
     f"{hk('message_id')} AS hk_message_id, message_from, message_to, message"),
)
AUTH_COLUMNS = f"{hk(hk('u'), hk('g'))} AS hk_l_user_group_activity, user_id_from, event, event_datetime AS event_dt"


def vault_sql(p: str, s: str, load_dt: str, before: str | None, reference: bool = False) -> str:
    """CTEs ``{p}_<table>``: the rows a batch appends from staging ``s``, over a vault loaded from staging ``before``.

    Nothing is read back from vault tables: what a batch adds is what its staging gives less what
    the earlier staging (a part of it) gave.
    """
    load = f"TIMESTAMP '{load_dt}' AS load_dt, 's3' AS load_src"
    out = {}
    for table, source, key, columns in PER_ID:
        known = f"WHERE NOT EXISTS (SELECT 1 FROM {before}_{source} o WHERE o.{key} = n.{key})" if before else ""
        out[table] = f"SELECT DISTINCT {columns}, {load} FROM {s}_{source} n {known}"
    for link, columns in LINK_COLUMNS.items():
        less = f"EXCEPT {_pairs(link, before)}" if before else ""
        out[link] = f"SELECT DISTINCT {columns}, {load} FROM ({_pairs(link, s)} {less})"
    less = f"EXCEPT {_pairs('l_admins', before)}" if before else ""
    out["s_admins"] = (
        f"SELECT DISTINCT {hk(hk('g'), hk('u'))} AS hk_l_admin_id, TRUE AS is_admin, r.registration_dt AS admin_from, "
        f"{load} FROM ({_pairs('l_admins', s)} {less}) JOIN {s}_groups r ON r.id = g")
    kinds = "'add', 'leave'"
    if reference and before:
        out["s_dialog_info"] = f"SELECT DISTINCT {PER_ID[-1][3]}, {load} FROM {s}_dialogs"
        out["s_auth_history"] = f"""SELECT DISTINCT {AUTH_COLUMNS}, {load} FROM (
            {_events(s, "'leave'")} UNION ALL
            SELECT * FROM ({_events(s, "'add'")}) n WHERE NOT EXISTS (
              SELECT 1 FROM ({_events(before, kinds)}) o WHERE o.u = n.u AND o.g = n.g))"""
    else:
        less = f"EXCEPT {_events(before, kinds)}" if before else ""
        out["s_auth_history"] = f"SELECT DISTINCT {AUTH_COLUMNS}, {load} FROM ({_events(s, kinds)} {less})"
    return ",\n".join(f"{p}_{table} AS ({body})" for table, body in out.items())


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


FIRST = vault_sql("b1", "stg", BATCH_1.load_dt, None)
SECOND = vault_sql("e2", "stg", BATCH_2.load_dt, "early")
# both batches together, under the names the audits read
BOTH = ",\n".join([vault_sql("e1", "early", BATCH_1.load_dt, None), SECOND, *(
    f"b1_{t} AS (SELECT * FROM e1_{t} UNION ALL SELECT * FROM e2_{t})"
    for t in (*(t for t, *_ in PER_ID), *LINK_COLUMNS, "s_admins", "s_auth_history"))])
SECOND_REFERENCE = vault_sql("r2", "stg", BATCH_2.load_dt, "early", reference=True)

OLDEST_SQL = f"""oldest AS (
  SELECT id, {hk('id')} AS hk_group_id, registration_dt FROM (
    SELECT id, registration_dt, row_number() OVER (ORDER BY registration_dt NULLS LAST, id) AS place FROM stg_groups)
  WHERE place <= 10)"""

# one row per group a message or an added user belongs to, counted over the staged rows
SENDERS_SQL = f"""SELECT {hk('message_group')} AS hk_group_id,
    count(DISTINCT message_from) FILTER (message_from IN (SELECT id FROM stg_users)) AS cnt_users_in_group_with_messages
  FROM stg_dialogs WHERE message_group IN (SELECT id FROM stg_groups) GROUP BY message_group"""

ADDED_SQL = f"""SELECT {hk('group_id')} AS hk_group_id, count(DISTINCT user_id) AS cnt_added_users
  FROM stg_group_log
  WHERE event = 'add' AND group_id IN (SELECT id FROM oldest) AND user_id IN (SELECT id FROM stg_users)
  GROUP BY group_id"""

CONVERSION_SQL = f"""SELECT hk_group_id, any_value(a) AS cnt_added_users, any_value(w) AS cnt_users_in_group_with_messages,
    round(100 * (any_value(w) / any_value(a)), 2) AS group_conversion
  FROM (SELECT hk_group_id, cnt_added_users AS a, NULL AS w FROM ({ADDED_SQL})
        UNION ALL SELECT hk_group_id, NULL, cnt_users_in_group_with_messages FROM ({SENDERS_SQL}))
  GROUP BY hk_group_id HAVING count(a) > 0"""

# The faults planted for the audits (the same rules as in plans/queries.py).
FAULTS_SQL = """
f_users AS (
  SELECT id, CASE WHEN id % 40 = 0 THEN -age ELSE age END AS age FROM stg_users
  UNION ALL SELECT id, age FROM stg_users WHERE id % 50 = 0),
f_groups AS (SELECT id, CASE WHEN id % 7 = 0 THEN admin_id + 1000000 ELSE admin_id END AS admin_id FROM stg_groups),
f_group_log AS (
  SELECT group_id, user_id, CASE WHEN group_id % 9 = 0 THEN user_id_from + 1000000 ELSE user_id_from END AS user_id_from
  FROM stg_group_log),
f_h_users AS (
  SELECT hk_user_id, user_id FROM b1_h_users
  UNION ALL SELECT hk_user_id, user_id + 1000000 FROM b1_h_users WHERE user_id % 60 = 0),
f_l_user_message AS (
  SELECT hk_l_user_message, CASE WHEN hk_l_user_message % 11 = 0 THEN hk_user_id + 1 ELSE hk_user_id END AS hk_user_id,
         CASE WHEN hk_l_user_message % 13 = 0 THEN NULL ELSE hk_message_id END AS hk_message_id, load_dt
  FROM b1_l_user_message),
f_s_user_socdem AS (
  SELECT hk_user_id, CASE WHEN hk_user_id % 17 = 0 THEN -1 ELSE age END AS age,
         CASE WHEN hk_user_id % 19 = 0 THEN NULL ELSE load_dt END AS load_dt
  FROM b1_s_user_socdem)"""
FAULTY = ("stg_users", "stg_groups", "stg_group_log", "b1_h_users", "b1_l_user_message", "b1_s_user_socdem")

# Declared keys and references, child before parent.
HUB_KEYS = (("h_users", "hk_user_id", "user_id"), ("h_groups", "hk_group_id", "group_id"),
            ("h_dialogs", "hk_message_id", "message_id"))
LINK_KEYS = (("l_admins", "hk_l_admin_id", "h_users", "h_groups"),
             ("l_user_message", "hk_l_user_message", "h_users", "h_dialogs"),
             ("l_groups_dialogs", "hk_l_groups_dialogs", "h_groups", "h_dialogs"),
             ("l_user_group_activity", "hk_l_user_group_activity", "h_users", "h_groups"))
SATELLITE_PARENTS = (("s_user_socdem", "h_users"), ("s_user_chat_info", "h_users"), ("s_group_name", "h_groups"),
                     ("s_group_private_status", "h_groups"), ("s_admins", "l_admins"), ("s_dialog_info", "h_dialogs"),
                     ("s_auth_history", "l_user_group_activity"))
KEY_OF = {t: k for t, k, *_ in (*HUB_KEYS, *LINK_KEYS)}

# Lines spoiled on landing (the same rules as in plans/queries.py), with the reason they are set aside for.
REJECTS_SQL = """SELECT 'users' AS table_name, 'malformed row' AS reject_reason,
    concat_ws(',', id, chat_name, coalesce(CAST(registration_dt AS VARCHAR), ''), coalesce(country, ''), 'old') AS raw_line
  FROM stg_users WHERE id % 50 = 1
UNION ALL SELECT 'groups', 'is_private: not a boolean',
    concat_ws(',', id, admin_id, group_name, coalesce(CAST(registration_dt AS VARCHAR), ''), 'maybe')
  FROM stg_groups WHERE id % 7 = 3
UNION ALL SELECT 'dialogs', 'malformed row',
    concat_ws(',', message_id, coalesce(CAST(message_dt AS VARCHAR), ''), message_from)
  FROM stg_dialogs WHERE message_id % 200 = 8
UNION ALL SELECT 'dialogs', 'malformed row',
    concat_ws(',', message_id, coalesce(CAST(message_dt AS VARCHAR), ''), message_from, message_to, message,
              coalesce(CAST(message_group AS VARCHAR), ''), 'surplus')
  FROM stg_dialogs WHERE message_id % 200 = 9
UNION ALL SELECT 'group_log', 'malformed row',
    concat_ws(',', group_id, user_id, coalesce(CAST(user_id_from AS VARCHAR), ''), event, '1996-13-45 00:00:00')
  FROM stg_group_log WHERE (group_id + user_id) % 97 = 5"""

TRUNCATE_SQL = f"""WITH long_docs AS (
  SELECT doc_id, string_split(left(text, {TRUNCATE_BYTES}), '') AS chars
  FROM documents WHERE strlen(text) > {TRUNCATE_BYTES}),
chars AS (SELECT doc_id, chars, unnest(range(1, len(chars) + 1)) AS i FROM long_docs),
sized AS (
  SELECT doc_id, i, chars[i] AS c,
         sum(strlen(chars[i])) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS upto
  FROM chars),
cut AS (SELECT doc_id, string_agg(c, '' ORDER BY i) AS message FROM sized
        WHERE upto <= {TRUNCATE_BYTES} GROUP BY doc_id),
out AS (
  SELECT d.doc_id, strlen(d.text) AS bytes_in,
         CASE WHEN strlen(d.text) <= {TRUNCATE_BYTES} THEN d.text ELSE coalesce(cut.message, '') END
           AS message
  FROM documents d LEFT JOIN cut ON cut.doc_id = d.doc_id)
SELECT doc_id, bytes_in, message, strlen(message) AS bytes_out FROM out"""


def _audit_row(table: str, constraint: str, column: str, body: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{constraint}' AS constraint_name, "
            f"'{column}' AS column_name, CAST(n_checked AS BIGINT) AS n_checked, "
            f"CAST(n_violations AS BIGINT) AS n_violations FROM ({body})")


def _duplicates() -> str:
    rows = []
    for table, key in (("stg_users", "id"), ("stg_groups", "id"), ("stg_dialogs", "message_id"),
                       *((t, k) for t, k in KEY_OF.items())):
        source = table if table.startswith("stg_") else f"b1_{table}"
        rows.append(_audit_row(table, "primary_key", key,
            f"SELECT count({key}) AS n_checked, (SELECT count(*) FROM (SELECT {key} FROM {source} WHERE {key} IS NOT NULL "
            f"GROUP BY 1 HAVING count(*) > 1)) AS n_violations FROM {source}"))
    for table, key, name in HUB_KEYS:
        rows.append(_audit_row(table, "hash_collision", key,
            f"SELECT count(DISTINCT {key}) AS n_checked, count(DISTINCT {key}) FILTER (low <> high) AS n_violations FROM "
            f"(SELECT {key}, min({name}) OVER (PARTITION BY {key}) AS low, max({name}) OVER (PARTITION BY {key}) AS high "
            f"FROM b1_{table})"))
    return "\nUNION ALL\n".join(rows)


def _orphans() -> str:
    references = [("stg_groups", "admin_id", "stg_users", "id"), ("stg_group_log", "group_id", "stg_groups", "id"),
                  ("stg_group_log", "user_id", "stg_users", "id"), ("stg_group_log", "user_id_from", "stg_users", "id")]
    references += [(t, KEY_OF[parent], parent, KEY_OF[parent]) for t, _, *parents in LINK_KEYS for parent in parents]
    references += [(t, KEY_OF[parent], parent, KEY_OF[parent]) for t, parent in SATELLITE_PARENTS]
    rows = []
    for child, column, parent, key in references:
        c, p = (x if x.startswith("stg_") else f"b1_{x}" for x in (child, parent))
        rows.append(_audit_row(child, f"foreign_key:{parent}", column,
            f"SELECT count({column}) AS n_checked, count({column}) FILTER (NOT EXISTS (SELECT 1 FROM {p} p "
            f"WHERE p.{key} = c.{column})) AS n_violations FROM {c} c"))
    return "\nUNION ALL\n".join(rows)


def _ages() -> str:
    return "\nUNION ALL\n".join(
        _audit_row(name, "check:age>=0", "age",
                   f"SELECT count(age) AS n_checked, coalesce(sum(CAST(age < 0 AS INT)), 0) AS n_violations FROM {source}")
        for name, source in (("stg_users", "stg_users"), ("s_user_socdem", "b1_s_user_socdem")))


def _nulls() -> str:
    columns = [(t, [k]) for t, k, _ in HUB_KEYS]
    columns += [(t, [k, *(KEY_OF[p] for p in parents), "load_dt"]) for t, k, *parents in LINK_KEYS]
    columns += [(t, [KEY_OF[p], "load_dt"]) for t, p in SATELLITE_PARENTS]
    return "\nUNION ALL\n".join(
        _audit_row(t, "not_null", c, f"SELECT count(*) AS n_checked, count(*) - count({c}) AS n_violations FROM b1_{t}")
        for t, cs in columns for c in cs)


def _findings() -> str:
    """Every vault key that breaks a key or a reference, from the tables the audits read."""
    rows = [f"SELECT '{t}' AS table_name, 'primary_key' AS constraint_name, '{k}' AS column_name, {k} AS key_value, "
            f"1 AS n_violations FROM b1_{t} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1" for t, k in KEY_OF.items()]
    rows += [f"SELECT '{t}', 'hash_collision', '{k}', {k}, 1 FROM b1_{t} GROUP BY {k} HAVING count(DISTINCT {name}) > 1"
             for t, k, name in HUB_KEYS]
    references = [(t, parent) for t, _, *parents in LINK_KEYS for parent in parents] + list(SATELLITE_PARENTS)
    rows += [f"SELECT '{t}', 'foreign_key:{p}', '{KEY_OF[p]}', c.{KEY_OF[p]}, count(*) FROM b1_{t} c "
             f"ANTI JOIN b1_{p} p ON p.{KEY_OF[p]} = c.{KEY_OF[p]} WHERE c.{KEY_OF[p]} IS NOT NULL GROUP BY c.{KEY_OF[p]}"
             for t, p in references]
    return "\nUNION ALL\n".join(rows)


def _planted(statement: str) -> str:
    """An audit over the tables with planted faults."""
    for name in FAULTY:
        statement = re.sub(rf"FROM {name}\b", f"FROM f_{name.removeprefix('stg_').removeprefix('b1_')}", statement)
    return statement


def _load_counts() -> str:
    rows = [f"SELECT 'stg_{t}' AS table_name, count(*) AS n_rows FROM stg_{t}"
            for t in ("users", "groups", "dialogs", "group_log")]
    rows += [f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM b1_{t}" for t in QUERY_NAMES]
    return "\nUNION ALL\n".join(rows)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    base = _with(STAGING_SQL)
    for t in ("users", "groups", "dialogs", "group_log"):
        q[f"stg_{t}"] = base + f"SELECT * FROM stg_{t}"
    q["stg_varchar_truncate"] = TRUNCATE_SQL
    first = _with(STAGING_SQL, FIRST)
    q["load_counts"] = first + _load_counts()
    as_of = "(SELECT max(message_dt) FROM stg_dialogs)"
    q["calendar_bucket"] = base + (
        "SELECT CAST(CASE WHEN date_diff('year', d, seen) >= 2 THEN date_trunc('year', d) "
        "WHEN date_diff('month', d, seen) >= 3 THEN date_trunc('month', d) ELSE d END AS DATE) AS bucket, "
        f"count(*) AS n_messages FROM (SELECT CAST(message_dt AS DATE) AS d, CAST({as_of} AS DATE) AS seen "
        "FROM stg_dialogs) GROUP BY 1")
    for table, name in QUERY_NAMES.items():
        q[name] = first + f"SELECT * FROM b1_{table}"
    second = _with(STAGING_SQL, EARLY_STAGING_SQL, SECOND)
    for table, name in QUERY_NAMES.items():
        q[f"{name}_second_load"] = second + f"SELECT * FROM e2_{table}"
    second_ref = _with(STAGING_SQL, EARLY_STAGING_SQL, SECOND, SECOND_REFERENCE)
    q["sat_dialog_info_second_load_reference"] = second_ref + "SELECT * FROM r2_s_dialog_info"
    q["sat_auth_history_second_load_reference"] = second_ref + "SELECT * FROM r2_s_auth_history"
    oldest = _with(STAGING_SQL, OLDEST_SQL)
    q["first_groups_by_registration"] = oldest + "SELECT hk_group_id, id AS group_id, registration_dt FROM oldest"
    q["senders_per_group"] = base + SENDERS_SQL
    q["users_added_per_group"] = oldest + ADDED_SQL
    q["group_conversion"] = oldest + CONVERSION_SQL
    for name in ("single_plan", "from_csv", "segmented"):
        q[f"group_conversion_{name}"] = q["group_conversion"]
    q["stg_rejects"] = base + REJECTS_SQL
    wide = lambda statement: re.sub(  # noqa: E731  the whole digest in place of its first 60 bits
        r"CAST\('0x' \|\| left\(md5\((.*?)\), 15\) AS BIGINT\)", r"md5(\1)", statement)
    for table in WIDE_TABLES:
        statement = first + f"SELECT * FROM b1_{table}"
        while wide(statement) != statement:
            statement = wide(statement)
        q[f"{QUERY_NAMES[table]}_wide"] = statement
    q["group_conversion_wide"] = wide(q["group_conversion"])
    for table in SEGMENTED:
        q[f"{QUERY_NAMES[table]}_segmented_second_load"] = second + f"SELECT * FROM e2_{table}"
    for t in ("users", "groups", "dialogs", "group_log"):
        q[f"stg_{t}_from_csv"] = q[f"stg_{t}"]
    faulty = _with(STAGING_SQL, FIRST, FAULTS_SQL)
    for name, body in (("duplicate_keys", _duplicates()), ("orphans", _orphans()), ("check_age", _ages()),
                       ("not_null", _nulls())):
        q[f"audit_{name}"] = first + body
        q[f"audit_{name}_planted"] = faulty + _planted(body)
    both = _with(STAGING_SQL, EARLY_STAGING_SQL, BOTH, FAULTS_SQL)
    bodies = "\nUNION ALL\n".join((_duplicates(), _orphans(), _ages(), _nulls()))
    q["audit_batches_planted"] = (
        f"{both}SELECT * FROM ({_planted(bodies)}) WHERE table_name NOT LIKE 'stg%'")
    q["audit_batch_findings_planted"] = both + _planted(_findings())
    return q
