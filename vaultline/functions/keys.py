"""Surrogate hash keys (hubs hash one business key, links hash two hub keys).

The key is the first 60 bits of the MD5 of the ``|``-joined text of the inputs,
read as a non-negative ``bigint``.  It is reproducible in any SQL engine that
has ``md5`` (DuckDB: ``cast('0x' || substr(md5(...), 1, 15) as bigint)``), and
argument order matters: ``hash_key(a, b) != hash_key(b, a)``.

A NULL input gives a NULL key instead of silently hashing the remaining
arguments, so a failed lookup can never masquerade as a valid key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, LongType

# Separator between hashed parts and number of hex digits kept.
KEY_SEPARATOR = "|"
KEY_HEX_DIGITS = 15


def hash_key_expr(*exprs: str) -> str:
    """Spark SQL text of the key of SQL expressions ``exprs`` (column names or nested keys)."""
    if not exprs:
        raise ValueError("hash_key needs at least one column")
    parts = f", '{KEY_SEPARATOR}', ".join(f"CAST({e} AS STRING)" for e in exprs)
    return f"CAST(conv(substring(md5(concat({parts})), 1, {KEY_HEX_DIGITS}), 16, 10) AS BIGINT)"


def hash_key(*cols: str | Column) -> Column:
    """Deterministic 60-bit ``bigint`` key of one or more columns.

    ``concat`` (unlike ``concat_ws``) is NULL as soon as one part is NULL, and
    md5/conv/cast pass the NULL through: no conditional is needed, so nested
    keys evaluate each inner key once.  Column names build one SQL expression.
    """
    if not cols:
        raise ValueError("hash_key needs at least one column")
    if all(isinstance(c, str) for c in cols):
        return F.expr(hash_key_expr(*[f"`{c}`" for c in cols]))
    parts: list[Column] = []
    for c in cols:
        if parts:
            parts.append(F.lit(KEY_SEPARATOR))
        parts.append((F.col(c) if isinstance(c, str) else c).cast("string"))
    digest = F.md5(F.concat(*parts))
    return F.conv(F.substring(digest, 1, KEY_HEX_DIGITS), 16, 10).cast("long")


def hash_key_sql(*exprs: str) -> str:
    """The same key as DuckDB SQL text (used by the oracle queries)."""
    parts = ", ".join(f"CAST({e} AS VARCHAR)" for e in exprs)
    return (
        f"CAST('0x' || substr(md5(concat_ws('{KEY_SEPARATOR}', {parts})), 1, {KEY_HEX_DIGITS}) "
        "AS BIGINT)"
    )


def wide_key(*cols: str | Column, of_keys: bool = False) -> Column:
    """The whole MD5 as 16 bytes: 128 bits, enough for any number of members.

    The text hashed is that of ``hash_key``; ``of_keys`` hashes wide keys, as their hex digits.
    """
    if not cols:
        raise ValueError("wide_key needs at least one column")
    parts: list[Column] = []
    for c in cols:
        if parts:
            parts.append(F.lit(KEY_SEPARATOR))
        value = F.col(c) if isinstance(c, str) else c
        parts.append(F.lower(F.hex(value)) if of_keys else value.cast("string"))
    return F.unhex(F.md5(F.concat(*parts)))


@dataclass(frozen=True)
class KeyKind:
    """How a vault makes its surrogate keys: 60 bits in a ``bigint``, or 128 bits in 16 bytes."""

    wide: bool = False

    @property
    def type(self) -> DataType:
        return BinaryType() if self.wide else LongType()

    def member(self, *cols: str | Column) -> Column:
        """Key of a hub member from its business key."""
        return wide_key(*cols) if self.wide else hash_key(*cols)

    def pair(self, *cols: str | Column) -> Column:
        """Key of a link from its members' keys."""
        return wide_key(*cols, of_keys=True) if self.wide else hash_key(*cols)


NARROW, WIDE = KeyKind(False), KeyKind(True)
