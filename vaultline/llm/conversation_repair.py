"""Repair of conversation structure: the cheapest edits that make the turns alternate.

A conversation is right if the initials of its roles read ``(s?(ua)+)?``.  Each
turn is kept (free), given the role user or assistant (3) or deleted (4); an
empty turn of user or assistant may be inserted anywhere (3).  Blank turns and
repeats must be deleted; a truncated turn that stays costs 3 more.

The edits come from a Viterbi recursion over four states (nothing yet, after
the system turn, after user, after assistant), run from the end so that the
least audit string among the cheapest can be traced from the front.  It is
parallel within a conversation:

* turns are put in one global order and cut into pieces of at most 2 ** 14
  rows; a piece is held as one letter per turn;
* every piece starts from a speculative cost vector at its end.  Fix-up passes
  then hand each piece the vector found at the start of the next one.  It
  reruns both vectors side by side until they differ by a constant only: from
  there on nothing changes.  Passes go on until no piece gets another vector,
  so most conversations need none and a pass that changes a piece's start
  reaches one piece further;
* with the backward costs stitched, a piece is traced from every state it may
  be entered in, and the entered one is chosen along the pieces.

Defined results: null roles and texts count as one space; null turns come
first; turns of equal number are ordered by a digest of role and text; a null
``conv_id`` is one conversation; a role that does not start with s, u or a, the
empty one too, fits nowhere and is never kept; texts of any length are read
whole; an empty table gives empty results; other columns are not read.  The
text of one conversation passes through one task as a stream, since a digest
over it can't be split; that task holds one batch at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import stored
from vaultline.llm.sequence import batch_of, in_order, piece, rows_of

# Costs of the edits, and the white space of the contract.
KEEP, REROLE, INSERT, DELETE, TRUNCATED = 0, 3, 3, 4, 3
BLANKS = " \t\n\x0b\x0c\r"
# States: nothing yet, after s, after u, after a.  The empty sequence and one that ends on a are whole.
_NEXT = (2, 2, 3, 2)
_KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
_END = (0, 2 * INSERT, INSERT, 0)
_FINE, _CUT, _BLANK, _REPEAT = range(4)
_CLASSES = "suao"
_LEGAL = ("su", "ua", "au")


def letter_of(initial: str, fault: int) -> str:
    return chr(65 + 4 * _CLASSES.index(initial) + fault)


def _read(letter: str) -> tuple[str, int]:
    kind, fault = divmod(ord(letter) - 65, 4)
    return _CLASSES[kind], fault


def _normal(costs: list[int]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(c - least for c in costs), least


@cache  # vectors of small differences over 16 letters: a few hundred entries
def before(vector: tuple[int, ...], letter: str) -> tuple[tuple[int, ...], int]:
    """Costs ahead of a turn from those behind it, as differences and the constant taken off."""
    initial, fault = _read(letter)
    if fault >= _BLANK:
        return vector, DELETE
    more = TRUNCATED if fault == _CUT else 0
    costs = []
    for state, behind in enumerate(vector):
        least = min(DELETE + behind, REROLE + more + vector[_NEXT[state]])
        if (kept := _KEPT[initial].get(state)) is not None:
            least = min(least, KEEP + more + vector[kept])
        costs.append(least)
    user, assistant = costs[2], costs[3]
    costs[2], costs[3] = min(user, INSERT + assistant), min(assistant, INSERT + user)
    costs[0], costs[1] = (min(c, INSERT + costs[2]) for c in costs[:2])
    return _normal(costs)


@cache
def edits(vector: tuple[int, ...], letter: str, state: int) -> tuple[str, int, int]:
    """(least of the cheapest edits up to and with this turn, state behind it, cost)."""
    initial, fault = _read(letter)
    ahead, least = before(vector, letter)
    done, spent = "", 0
    more = TRUNCATED if fault == _CUT else 0
    while True:
        left = ahead[state] + least
        if DELETE + vector[state] == left:
            return done + "D", state, spent + DELETE
        if INSERT + ahead[_NEXT[state]] + least == left:
            done, state, spent = done + "I", _NEXT[state], spent + INSERT
            continue
        kept = _KEPT[initial].get(state)
        if kept is not None and KEEP + more + vector[kept] == left:
            return done + "K", kept, spent + KEEP + more
        return done + "R", _NEXT[state], spent + REROLE + more


def backward(letters: str, end: tuple[int, ...]) -> tuple[int, ...]:
    for letter in reversed(letters):
        end, _ = before(end, letter)
    return end


def rerun(letters: str, old_end: tuple[int, ...], new_end: tuple[int, ...], old_start: tuple[int, ...]) -> tuple[int, ...]:
    """The start vector for another end vector; ends where the two differ by a constant."""
    old, new = old_end, new_end
    for letter in reversed(letters):
        if old == new:
            return old_start
        old, _ = before(old, letter)
        new, _ = before(new, letter)
    return new


def trace(letters: str, end: tuple[int, ...], state: int, last: bool) -> tuple[str, int, int]:
    """(audit, state behind the piece, cost) of a piece entered in ``state``."""
    behind = [end]
    for letter in reversed(letters):
        behind.append(before(behind[-1], letter)[0])
    out, cost = [], 0
    for n, letter in enumerate(letters):
        done, state, spent = edits(behind[len(letters) - 1 - n], letter, state)
        out.append(done)
        cost += spent
    while last and state in (1, 2):
        out.append("I")
        state = _NEXT[state]
        cost += INSERT
    return "".join(out), state, cost


class Repair(NamedTuple):
    summary: DataFrame  # conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit
    turns: DataFrame  # conv_id, place, role, text: the repaired turns, each conversation whole and in order


def _fault_letter(first: Column) -> Column:
    ends = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (F.when(ends == "", _BLANK).when(~first, _REPEAT)
             .when(~F.substring(ends, -1, 1).isin(".", "!", "?"), _CUT).otherwise(_FINE))
    start = F.substring("role", 1, 1)
    kind = F.when(start == "s", 0).when(start == "u", 1).when(start == "a", 2).otherwise(3)
    return F.char(F.lit(65) + 4 * kind + fault)


def _pieces(ordered: DataFrame) -> DataFrame:
    """conv_id, cut, letters, and the cuts before and after it in the conversation."""
    firsts = ordered.groupBy("conv_id", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    marked = (ordered.select("conv_id", "pos", "bare").join(firsts, "pos", "left")
              .select("conv_id", "pos", F.when(F.col("first"), F.col("bare.first"))
                      .otherwise(F.col("bare.repeat")).alias("letter")))
    letters = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "letter"))), lambda x: x["letter"]), "")
    along = Window.partitionBy("conv_id").orderBy("cut")
    return (marked.groupBy("conv_id", piece(F.col("pos")).alias("cut")).agg(letters.alias("letters"))
            .withColumns({"ahead": F.lag("cut").over(along), "next": F.lead("cut").over(along)}))


_STATE = "conv_id long, cut long, ahead long, next long, letters string, end array<int>, start array<int>"
_STATE_ARROW = pa.schema([("conv_id", pa.int64()), ("cut", pa.int64()), ("ahead", pa.int64()), ("next", pa.int64()),
                          ("letters", pa.string()), ("end", pa.list_(pa.int32())), ("start", pa.list_(pa.int32()))])


def _speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch_of([(c, cut, ahead, after, letters, _END, backward(letters, _END))
                        for c, cut, ahead, after, letters in rows_of(batch, "conv_id", "cut", "ahead", "next", "letters")],
                       _STATE_ARROW)


def _fix_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for c, cut, ahead, after, letters, end, start, found in rows_of(batch, *_STATE_ARROW.names, "found"):
            end, start = tuple(end), tuple(start)
            if found is not None and tuple(found) != end:
                start, end = rerun(letters, end, tuple(found), start), tuple(found)
            rows.append((c, cut, ahead, after, letters, end, start))
        yield batch_of(rows, _STATE_ARROW)


def _handed(pieces: DataFrame) -> DataFrame:
    """Each piece with the vector at the start of the next one, as ``found``."""
    starts = pieces.select(F.col("conv_id").alias("of"), F.col("cut").alias("at"), F.col("start").alias("found"))
    return (pieces.join(starts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("next") == F.col("at")), "left")
            .select("conv_id", "cut", "ahead", "next", "letters", "end", "start", "found"))


def _settle(pieces: DataFrame) -> DataFrame:
    """Pieces with the true vectors at their ends; ``pieces`` are those of conversations with several."""
    while True:
        handed = stored(_handed(pieces))
        if handed.where(F.col("found") != F.col("end")).isEmpty():
            return pieces
        pieces = stored(handed.mapInArrow(_fix_up, _STATE))


_TRACE = ("conv_id long, cut long, ahead long, next long, audits array<string>, exits array<int>, costs array<long>, "
          "blank long, duplicate long, truncated long, illegal long, head string, tail string")
_TRACE_ARROW = pa.schema([("conv_id", pa.int64()), ("cut", pa.int64()), ("ahead", pa.int64()), ("next", pa.int64()),
                          ("audits", pa.list_(pa.string())), ("exits", pa.list_(pa.int32())),
                          ("costs", pa.list_(pa.int64())), ("blank", pa.int64()), ("duplicate", pa.int64()),
                          ("truncated", pa.int64()), ("illegal", pa.int64()), ("head", pa.string()), ("tail", pa.string())])


def _traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for c, cut, ahead, after, letters, end in rows_of(batch, "conv_id", "cut", "ahead", "next", "letters", "end"):
            entered = range(1 if ahead is None else 4)
            audits, exits, costs = zip(*(trace(letters, tuple(end), s, after is None) for s in entered))
            kinds, faults = zip(*map(_read, letters))
            illegal = sum(a + b not in _LEGAL for a, b in zip(kinds, kinds[1:]))
            rows.append((c, cut, ahead, after, audits, exits, costs, faults.count(_BLANK), faults.count(_REPEAT),
                         faults.count(_CUT), illegal, kinds[0], kinds[-1]))
        yield batch_of(rows, _TRACE_ARROW)


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of (conv_id, cut): the state each is entered in, and whether its border is illegal."""
    schema = pa.schema([("conv_id", pa.int64()), ("cut", pa.int64()), ("entry", pa.int32()), ("border", pa.int64())])
    state, tail = 0, ""
    for batch in batches:
        rows = []
        for c, cut, ahead, exits, head, last in rows_of(batch, "conv_id", "cut", "ahead", "exits", "head", "tail"):
            if ahead is None:
                state = 0
            rows.append((c, cut, state, 0 if ahead is None else int(tail + head not in _LEGAL)))
            state, tail = exits[state], last
        yield batch_of(rows, schema)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns from (audit of a piece, then its turns) in order."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    names = {2: "user", 3: "assistant"}
    conv, state, place, ops, at = None, 0, 0, "", 0

    def inserted(out: list[tuple]) -> None:
        nonlocal state, place, at
        while at < len(ops) and ops[at] == "I":
            state = _NEXT[state]
            out.append((conv, place, names[state], ""))
            place += 1
            at += 1

    out: list[tuple] = []
    for batch in batches:
        for c, audit, first, role, text in rows_of(batch, "conv_id", "audit", "opens", "role", "text"):
            if audit is not None:
                inserted(out)  # those behind the last turn of the piece before
                if first:
                    conv, state, place = c, 0, 0
                ops, at = audit, 0
                continue
            inserted(out)
            op = ops[at]
            at += 1
            if op == "D":
                continue
            if op == "K":
                state = _KEPT[role[0]][state]
            else:
                state = _NEXT[state]
                role = names[state]
            out.append((conv, place, role, text))
            place += 1
        yield batch_of(out, schema)
        out = []
    inserted(out)
    if out:
        yield batch_of(out, schema)


def repair(turns: DataFrame) -> Repair:
    """The repair of every conversation of conv_id, turn, role, text."""
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumns({
        "digest": F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)),
        "bare": F.struct(_fault_letter(F.lit(True)).alias("first"), _fault_letter(F.lit(False)).alias("repeat"))})
    ordered = in_order(rows, F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"))
    pieces = stored(_pieces(ordered).mapInArrow(_speculate, _STATE))
    several = F.col("ahead").isNotNull() | F.col("next").isNotNull()
    settled = pieces.where(~several).unionByName(_settle(pieces.where(several)))
    traced = stored(settled.mapInArrow(_traces, _TRACE))
    slim = traced.where(several).select("conv_id", "cut", "ahead", "exits", "head", "tail")
    entries = (slim.repartition("conv_id").sortWithinPartitions("conv_id", "cut")
               .mapInArrow(_entered, "conv_id long, cut long, entry int, border long")
               .select(F.col("conv_id").alias("of"), F.col("cut").alias("at"), "entry", "border"))
    entry = F.coalesce("entry", F.lit(0))
    chosen = stored(
        traced.join(entries, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("cut") == F.col("at")), "left")
        .select("conv_id", "cut", F.col("ahead").isNull().alias("opens"), F.get("audits", entry).alias("audit"),
                F.get("costs", entry).alias("cost"), "blank", "duplicate", "truncated",
                (F.col("illegal") + F.coalesce("border", F.lit(0))).alias("illegal")))
    numbers = (ordered.where("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1))
               .groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("cut", "audit"))), lambda x: x["audit"]), "")
    totals = chosen.groupBy("conv_id").agg(*(F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal", "cost")),
                                           whole.alias("audit"))
    summary = (totals.join(numbers.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left")
               .select("conv_id", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated",
                       "illegal", "cost", "audit"))
    both = (ordered.select("conv_id", piece(F.col("pos")).alias("cut"), "pos", F.lit(None).cast("string").alias("audit"),
                           F.lit(False).alias("opens"), "role", "text")
            .unionByName(chosen.select("conv_id", "cut", F.lit(-1).cast("long").alias("pos"), "audit", "opens",
                                       F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))))
    repaired = (both.repartition("conv_id").sortWithinPartitions("conv_id", "cut", "pos")
                .mapInArrow(_applied, "conv_id long, place long, role string, text string"))
    return Repair(summary, repaired)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    conv, state = None, None
    for batch in batches:
        out = []
        for c, place, role, text in rows_of(batch, "conv_id", "place", "role", "text"):
            if place == 0:
                if state is not None:
                    out.append((conv, state.hexdigest()))
                conv, state = c, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        yield batch_of(out, schema)
    if state is not None:
        yield batch_of([(conv, state.hexdigest())], schema)


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of ``Repair.turns`` as they come: no further shuffle."""
    return turns.mapInArrow(_digests, "conv_id long, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """The turns of op11: by crc32 of conv_id:turn some are dropped, emptied, cut, repeated or given to the user."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text = F.coalesce("text", F.lit(" "))
    kind = F.col("kind")
    return (rows.select("conv_id", "turn", "role", "text", (F.crc32(name) % 20).alias("kind")).where(kind != 0)
            .select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                    F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """Per original conv_id what op11 asks of the damaged turns."""
    found = repair(damaged(conversations))
    whole = found.summary.join(digests(found.turns).withColumnRenamed("conv_id", "of"),
                               F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    ids = conversations.select(F.col("conv_id").cast("long")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (ids.join(whole.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left")
            .select("conv_id", *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in counts),
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))
