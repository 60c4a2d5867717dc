"""Declared-length text: cut UTF-8 text to a byte budget on a character boundary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _byte_is_continuation_sql(raw: str, pos: int) -> str:
    """SQL: the byte at 1-based ``pos`` of binary ``raw`` is a continuation byte (10xxxxxx)."""
    return f"substring(hex(substring({raw}, {pos}, 1)), 1, 1) IN ('8', '9', 'A', 'B')"


def truncate_utf8_bytes_sql(text: str, max_bytes: int) -> str:
    """Spark SQL for the longest prefix of ``text`` within ``max_bytes`` UTF-8 bytes."""
    if max_bytes < 1:
        raise ValueError("max_bytes must be positive")
    raw = f"encode({text}, 'UTF-8')"
    # 1-based position of the first byte that is dropped: the byte after the
    # budget, or the lead byte of the character that straddles the budget
    first_dropped = str(max(max_bytes - 2, 1))
    for pos in reversed([p for p in (max_bytes + 1, max_bytes, max_bytes - 1) if p >= 1]):
        first_dropped = (f"CASE WHEN NOT {_byte_is_continuation_sql(raw, pos)} THEN {pos} "
                         f"ELSE {first_dropped} END")
    kept = f"decode(substring({raw}, 1, ({first_dropped}) - 1), 'UTF-8')"
    return f"CASE WHEN octet_length({text}) <= {max_bytes} THEN {text} ELSE {kept} END"


def truncate_utf8_bytes(c: str, max_bytes: int) -> Column:
    """Longest prefix of column ``c`` whose UTF-8 encoding fits in ``max_bytes`` bytes.

    Text within the budget is returned untouched.  Otherwise the encoded text
    is cut after ``max_bytes`` bytes; if the first dropped byte continues a
    multi-byte character, the cut backs off to that character's lead byte (a
    UTF-8 character is at most four bytes, so at most three steps back), and
    no character is ever split.  One built-in SQL expression, no UDF.
    """
    return F.expr(truncate_utf8_bytes_sql(f"`{c}`", max_bytes))
