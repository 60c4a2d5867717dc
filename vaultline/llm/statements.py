"""DuckDB statements of the operators that SQL can express: exact top-k, conversation repair, the prefix trie."""

from __future__ import annotations

OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256.0::DOUBLE * CAST(x AS DOUBLE))) AS c FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.c, r.c) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.c, r.c) DESC, r.vec_id) AS place
  FROM v q JOIN v r ON r.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
WHERE place <= 5
"""


def crc32_sql(source: str, text: str) -> str:
    """CTEs ``crc(name, crc)`` of every distinct ``text`` of ``source``, one byte after the other."""
    return f"""
crc_step AS (
  SELECT i, 0 AS k, CAST(i AS BIGINT) AS x FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END FROM crc_step WHERE k < 8),
crc_table AS (SELECT i, x FROM crc_step WHERE k = 8),
crc_run AS (
  SELECT DISTINCT {text} AS name, 0 AS pos, CAST(4294967295 AS BIGINT) AS c FROM {source}
  UNION ALL
  SELECT name, pos + 1, xor(c >> 8, t.x) FROM crc_run
  JOIN crc_table t ON t.i = xor(c, ascii(substr(name, pos + 1, 1))) & 255 WHERE pos < length(name)),
crc AS (SELECT name, xor(c, 4294967295) AS crc FROM crc_run WHERE pos = length(name))"""


OP13_SQL = f"""
WITH RECURSIVE turns AS (
  SELECT conv_id, coalesce(text, '') AS txt, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS sig,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
{crc32_sql("turns", "CAST(conv_id AS VARCHAR)").lstrip()},
own AS (SELECT conv_id, max(place) AS n FROM turns GROUP BY conv_id),
convs AS (
  SELECT o.conv_id, o.conv_id - o.conv_id % 100 AS head, crc % 6 AS h, least(crc % 6, coalesce(b.n, 0)) AS taken,
         least(crc % 6, coalesce(b.n, 0)) + greatest(o.n - crc % 6, 0) AS n_turns
  FROM own o JOIN crc ON name = CAST(o.conv_id AS VARCHAR) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
built AS (
  SELECT c.conv_id, place - h + taken AS depth, sig, txt FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND place > h
  UNION ALL SELECT c.conv_id, place, sig, txt FROM convs c JOIN turns t ON t.conv_id = c.head AND place <= taken),
paths AS (
  SELECT conv_id, depth, length(txt) AS chars, string_agg(sig, '') OVER (PARTITION BY conv_id ORDER BY depth) AS node FROM built
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars
          FROM paths GROUP BY node),
kids AS (SELECT left(node, length(node) - 32) AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
leafy AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (node)),
below AS (SELECT a.node, sum(CAST(d.n_children = 0 AS INT)) AS n_leaves, sum((d.n_convs - 1) * d.chars) AS saved
          FROM leafy a JOIN leafy d ON starts_with(d.node, a.node) GROUP BY a.node),
ends AS (SELECT p.node, string_agg(CAST(c.conv_id AS VARCHAR), ',' ORDER BY c.conv_id) AS ids
         FROM convs c JOIN paths p ON p.conv_id = c.conv_id AND p.depth = c.n_turns GROUP BY p.node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(n.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM leafy n JOIN below USING (node) LEFT JOIN ends USING (node)
LEFT JOIN nodes up ON n.depth > 0 AND up.node = left(n.node, length(n.node) - 32)
"""


def _then(state: str, cost: int, letter: str, turn: str = "''", when: str = "TRUE") -> str:
    """A state's best edits with one more edit; none where it cannot be reached."""
    return (f"CASE WHEN {when} AND {state} IS NOT NULL THEN {{'c': {state}.c + {cost} + more, 'a': {state}.a || '{letter}', "
            f"'r': {state}.r || {turn}}} END")


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _with_inserts(source: str) -> str:
    """``source`` with the states that inserted turns lead to."""
    insert = lambda state, role: _then(state, 3, "I", f"chr(10) || '{role}:'")
    u = _least("u", insert("z", "user"), insert("s", "user"), insert("a", "user"))
    return (f"SELECT conv_id, pos, z, s, u, {_least('a', insert('u', 'assistant'))} AS a FROM "
            f"(SELECT conv_id, pos, more, z, s, {u} AS u, a FROM (SELECT *, 0 AS more FROM ({source})))")


_STATE = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR)"
_TURN = "chr(10) || role || ':' || txt"
_DELETE = {x: _then(x, "4 - more", "D") for x in "zsua"}  # what a turn costs more while it stays
_STAYS = "fault NOT IN ('blank', 'duplicate')"


def _keep(state: str, initial: str) -> str:
    return _then(state, 0, "K", _TURN, f"{_STAYS} AND initial = '{initial}'")


def _rerole(state: str, role: str) -> str:
    return _then(state, 3, "R", f"chr(10) || '{role}:' || txt", _STAYS)


_STEP = f"""SELECT p.conv_id, p.pos + 1 AS pos, {_DELETE['z']} AS z, {_least(_DELETE['s'], _keep('z', 's'))} AS s,
    {_least(_DELETE['u'], *(_rerole(x, 'user') for x in 'zsa'), *(_keep(x, 'u') for x in 'zsa'))} AS u,
    {_least(_DELETE['a'], _rerole('u', 'assistant'), _keep('u', 'a'))} AS a
  FROM best p JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.pos = p.pos + 1"""

OP11_SQL = f"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS txt,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
{crc32_sql("named", "name").lstrip()},
hit AS (
  SELECT conv_id, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role,
         CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN translate(txt, '.!?', '') ELSE txt END AS txt, crc % 20 AS kind
  FROM named JOIN crc USING (name) WHERE crc % 20 <> 0),
damaged AS (SELECT * FROM hit UNION ALL SELECT * FROM hit WHERE kind = 3),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || txt)) AS pos,
         rtrim(txt, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM damaged),
judged AS (
  SELECT *, left(role, 1) AS initial, CASE
      WHEN shown = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY pos) > 1 THEN 'duplicate'
      WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1), 'ua') AS pair
  FROM placed),
judged2 AS (SELECT *, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more FROM judged),
first_states AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, CAST({{'c': 0, 'a': '', 'r': ''}} AS {_STATE}) AS z,
         CAST(NULL AS {_STATE}) AS s, CAST(NULL AS {_STATE}) AS u, CAST(NULL AS {_STATE}) AS a FROM placed),
best AS (
  {_with_inserts("SELECT * FROM first_states")}
  UNION ALL
  {_with_inserts(_STEP.replace("JOIN judged j", "JOIN judged2 j"))}),
repaired AS (
  SELECT conv_id, list_min([z, a]) AS r FROM best
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(r.c, 0) AS BIGINT) AS cost,
       coalesce(r.a, '') AS audit, sha256(coalesce(substr(r.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM i.conv_id
"""
