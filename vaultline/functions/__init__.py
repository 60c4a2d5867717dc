"""Scalar column functions: hash keys, byte-limited text, calendar buckets."""

from vaultline.functions.calendar import calendar_bucket
from vaultline.functions.keys import hash_key
from vaultline.functions.text import truncate_utf8_bytes

__all__ = ["calendar_bucket", "hash_key", "truncate_utf8_bytes"]
