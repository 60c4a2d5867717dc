"""Rows in a global order: the ground on which long sequences are cut into pieces.

Rows are dealt out by ranges of their keys and numbered in order, so a sequence
that holds a third of all rows spans many tasks, and its pieces are told apart
by ``pos`` alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import stored

PIECE_BITS = 14  # a piece has at most 2 ** PIECE_BITS rows
_PART_BITS = 33  # Fixed value: row numbers within a task, of monotonically_increasing_id


def in_order(rows: DataFrame, *keys: Column) -> DataFrame:
    """``rows`` stored with ``pos``, a number that ascends with ``keys``; within a task it has no gaps.

    Rows equal in all keys come in any order, one after the other.
    """
    return stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                  .withColumn("pos", F.monotonically_increasing_id()))


def piece(pos: Column) -> Column:
    """Number of the piece that a row belongs to, ascending with ``pos``."""
    return F.shiftright(pos, PIECE_BITS)


def part(pos: Column) -> Column:
    """Number of the task that wrote a row: the rows of one sequence there have successive ``pos``."""
    return F.shiftright(pos, _PART_BITS)


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names))


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
