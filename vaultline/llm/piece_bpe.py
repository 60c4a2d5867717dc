"""SentencePiece encoding and decoding for vocabularies of the merge type (BPE with byte fallback).

A text's symbols are its characters, blanks written as U+2581 after one added
in front.  An agenda holds every adjacent pair whose joined text is a piece,
ordered by the piece's score (highest first) and then by place (leftmost
first).  The best pair is merged, the pairs it formed with its neighbours
enter the agenda, and entries whose symbols have meanwhile changed are passed
over.  Characters that are no piece become the ids of their UTF-8 bytes.

No piece of such a vocabulary runs from a letter into a following blank (this
is checked on loading), so no merge crosses that border: the agenda works word
by word, and a worker keeps the ids of a bounded number of recent words.

Work runs over Arrow batches.  Each batch is compared with the sentencepiece
library: the ids of every word the worker has not met, and the decoding of
every text; a difference stops the job.

Models that need more than this raise ``ValueError``: other model types,
normalisation rules other than identity, no blank in front, removal of extra
blanks, blanks as suffixes, user-defined or unused pieces, no byte fallback.

Defined results: a null text is encoded as the empty one, which has no ids;
texts of any length are encoded whole; ties go to the leftmost pair; repeated
rows give repeated results; an empty table gives an empty result; columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

BLANK = "▁"
_CACHED_WORDS = 200_000  # words whose ids a worker keeps, in each of two generations
_CACHED_CHARS = 48
_SHORT = 64  # symbols up to which a list is a quicker agenda than a heap
_NO_PIECE = 1 << 30  # rank of a pair that is no piece
# Fixed values of the model file: field numbers and piece kinds.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
_MERGE_TYPE = 2
_UNKNOWN_SURFACE = " ⁇ "


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one serialized message; fixed-width values stay bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        field, wire = divmod(number(), 8)
        if wire == 0:
            yield field, number()
            continue
        size = {1: 8, 5: 4}.get(wire)
        if size is None:
            size = number()
        yield field, data[at:at + size]
        at += size


def _settings(data: bytes, defaults: dict[int, int | bytes]) -> dict[int, int | bytes]:
    return defaults | dict(message_fields(data))


class PieceBpe:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as fh:
            model = list(message_fields(fh.read()))
        trainer = _settings(next((v for f, v in model if f == TRAINER), b""), {3: 1, 24: 0, 35: 0})
        rules = _settings(next((v for f, v in model if f == NORMALIZER), b""), {2: b"", 3: 1, 4: 1, 5: 1})
        if trainer[3] != _MERGE_TYPE or trainer[24] or not trainer[35]:
            raise ValueError("only merge-type models with byte fallback and blanks as prefixes are read")
        if rules[2] or rules[4] or not (rules[5] and rules[3]):
            raise ValueError("only identity normalisation that keeps blanks and puts one in front is read")
        self.prefix = BLANK
        pieces = []
        for field, value in model:
            if field == PIECES:
                spec = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(message_fields(value))
                pieces.append((spec[1].decode(), struct.unpack("<f", spec[2])[0], spec[3]))
        if odd := {kind for _, _, kind in pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError(f"pieces of kinds {sorted(odd)} are not read")
        if any(BLANK in piece.lstrip(BLANK) for piece, _, kind in pieces if kind == NORMAL):
            raise ValueError("a piece holds a blank after a letter")
        order = {s: n for n, s in enumerate(sorted({s for _, s, k in pieces if k == NORMAL}, reverse=True))}
        self.ids = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.rank = {piece: order[score] for piece, score, kind in pieces if kind == NORMAL}
        self.byte_ids = [0] * 256
        # what each id stands for: text, or one byte
        self.surface: list[str | int] = []
        for i, (piece, _, kind) in enumerate(pieces):
            if kind == BYTE:
                byte = int(piece[3:5], 16)
                self.byte_ids[byte] = i
                self.surface.append(byte)
            else:
                self.surface.append({CONTROL: "", UNKNOWN: _UNKNOWN_SURFACE}.get(kind, piece.replace(BLANK, " ")))
        self.names = [str(i) for i in range(len(pieces))]
        self.controls = {i for i, (_, _, kind) in enumerate(pieces) if kind == CONTROL}
        self.words = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        self._cache: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self.merged: list[tuple[str, tuple[int, ...]]] = []  # words merged since ``differing`` last looked

    def differing(self, library) -> str | None:
        """A word that the library encodes otherwise, among those merged since the last call."""
        merged, self.merged = self.merged, []
        cut = len(self.prefix)  # every word starts with the blank that the library puts in front
        theirs = library.encode([word[cut:] for word, _ in merged], num_threads=1) if merged else []
        alone = [library.piece_to_id(BLANK)]  # of one blank nothing is left to encode
        return next((word for (word, ids), found in zip(merged, theirs)
                     if list(ids) != (found if len(word) > cut else alone)), None)

    def _merge(self, word: str) -> tuple[int, ...]:
        """Ids of ``word`` by the agenda."""
        return self._ids_of(self._merged_short(word) if len(word) <= _SHORT else self._merged_long(word))

    def _merged_short(self, word: str) -> list[str]:
        """Symbols after all merges; the agenda is a list of the pairs' ranks in order of place."""
        symbols, rank = list(word), self.rank.get
        agenda = [rank(a + b, _NO_PIECE) for a, b in zip(symbols, word[1:])]
        while agenda and (best := min(agenda)) < _NO_PIECE:
            at = agenda.index(best)  # the leftmost
            joined = symbols[at] = symbols[at] + symbols.pop(at + 1)
            del agenda[at]
            if at:
                agenda[at - 1] = rank(symbols[at - 1] + joined, _NO_PIECE)
            if at < len(agenda):
                agenda[at] = rank(joined + symbols[at + 1], _NO_PIECE)
        return symbols

    def _merged_long(self, word: str) -> list[str]:
        """The same with the agenda as a heap."""
        rank, size = self.rank, len(word)
        symbols: list[str] = list(word)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        agenda = []
        for left in range(size - 1):
            score = rank.get(symbols[left] + symbols[left + 1])
            if score is not None:
                agenda.append((score, left, left + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, length = heapq.heappop(agenda)
            one, two = symbols[left], symbols[right]
            if not one or not two or len(one) + len(two) != length:
                continue  # a symbol was merged away or has grown since
            joined = symbols[left] = one + two
            symbols[right] = ""
            follower = after[left] = after[right]
            if follower < size:
                before[follower] = left
                score = rank.get(joined + symbols[follower])
                if score is not None:
                    heapq.heappush(agenda, (score, left, follower, length + len(symbols[follower])))
            leader = before[left]
            if leader >= 0:
                score = rank.get(symbols[leader] + joined)
                if score is not None:
                    heapq.heappush(agenda, (score, leader, left, len(symbols[leader]) + length))
        return [symbol for symbol in symbols if symbol]

    def _ids_of(self, symbols: list[str]) -> tuple[int, ...]:
        found = tuple(map(self.ids.get, symbols))
        if None not in found:
            return found
        return tuple(i for symbol, known in zip(symbols, found)
                     for i in ([known] if known is not None else [self.byte_ids[b] for b in symbol.encode()]))

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        cache = self._cache
        for word in self.words.findall(self.prefix + text.replace(" ", BLANK)):
            ids = cache.get(word)
            if ids is None:
                ids = self._older.get(word)
                if ids is None:
                    ids = self._merge(word)
                    self.merged.append((word, ids))
                if len(word) <= _CACHED_CHARS:
                    if len(cache) >= _CACHED_WORDS:  # words not met since the last change go
                        self._older, self._cache = cache, {}
                        cache = self._cache
                    cache[word] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The library's text of ``ids``: one blank in front goes, bytes that are no UTF-8 become U+FFFD each."""
        parts: list[str] = []
        waiting = bytearray()
        front = bool(self.prefix)
        for i in ids:
            piece = self.surface[i]
            if isinstance(piece, int):
                waiting.append(piece)
                continue
            if waiting:
                parts.append(_text_of(waiting))
                waiting.clear()
                front = False
            if front and i not in self.controls:
                piece = piece.removeprefix(" ") if piece != _UNKNOWN_SURFACE else piece
                front = False
            parts.append(piece)
        parts.append(_text_of(waiting))
        return "".join(parts)


def _text_of(data: bytearray) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for size in (1, 2, 3, 4):
                try:
                    out.append(data[at:at + size].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                size = 1
                out.append("�")
            at += size
        return "".join(out)


@lru_cache(maxsize=1)
def loaded(path: str) -> PieceBpe:
    """The model of ``path``: one per worker, so that tasks share the words it has met."""
    return PieceBpe(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, path: str | None = None, keep_ids: bool = False,
                     check: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row; also ``ids`` with ``keep_ids``.

    ``check`` compares every Arrow batch with the sentencepiece library.
    """
    path = path or default_model()
    schema = docs.select("doc_id").schema
    for name, kind in (("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")):
        schema = schema.add(name, kind)
    if keep_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        ours = loaded(path)
        theirs = sentencepiece.SentencePieceProcessor(model_file=path) if check else None

        def row(text: str, doc_id) -> tuple:
            ids = ours.encode(text)
            decoded = ours.decode(ids)
            if theirs is not None and theirs.decode(ids) != decoded:
                raise ValueError(f"document {doc_id} is decoded otherwise than by the library")
            found = (len(ids), hashlib.sha256(",".join([names[i] for i in ids]).encode()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest())
            return found + (ids,) if keep_ids else found

        names = ours.names
        kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
        for batch in batches:
            rows = [row(t.as_py() or "", i) for t, i in zip(batch.column("text"), batch.column("doc_id"))]
            if theirs is not None and (word := ours.differing(theirs)) is not None:
                raise ValueError(f"{word!r} is encoded otherwise than by the library")
            ours.merged.clear()
            columns = [pa.array([r[n] for r in rows], kinds[n]) for n in range(len(schema.fields) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], [f.name for f in schema.fields])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
