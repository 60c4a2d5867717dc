"""Byte-level BPE encoding by backtracking over the longest matches of a trie, and decoding by a table of bytes.

The vocabulary file's merges give each token a rank and the two tokens it is
merged from.  Two adjacent tokens are compatible when merging their joined
bytes by rank would leave the border between them alone; a sequence whose
neighbours are all compatible is exactly what the merges produce.  The encoder
walks each pre-token once, takes the longest match, shortens it or steps back
where a pair is incompatible, and never tries a position again once it has
failed there, so work is linear in the text.

Pre-tokens repeat, so a task keeps the ids of recent ones.  Texts of ASCII alone
are cut by the same pattern in its ASCII form, which is faster.  Decoding joins
the bytes of each token.

Defined results: a null text is encoded as the empty one; ties do not arise
(the encoding is unique); repeated rows give repeated results; an empty table
gives an empty result; columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

# Fixed value: the pre-token pattern of byte-level BPE vocabularies (white space by Unicode property).
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
            r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
ASCII_PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\x09-\x0D A-Za-z0-9]+"
                  r"|[\x09-\x0D ]+(?![^\x09-\x0D ])|[\x09-\x0D ]+")  # the same for texts of ASCII alone
_CACHE = 150_000  # pre-tokens whose ids a task keeps, in each of two generations
_FITS_SLOTS = 1 << 17  # answers about pairs that a task keeps
_CACHED_CHARS = 64


def byte_alphabet() -> dict[str, int]:
    """The vocabulary file's printable stand-in of each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    out.update({chr(256 + i): b for i, b in enumerate(rest)})
    return out


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        alphabet = byte_alphabet()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]

        def raw(token: str) -> bytes:
            return bytes(alphabet[c] for c in token)

        # tokens are numbered by rank: single bytes first, then one per merge; arrays keep a worker small
        self.left, self.right = array("i"), array("i")
        self.ids: list[int] = []  # one object an id: what a task keeps refers to them
        number: dict[str, int] = {}
        for char in alphabet:
            if char in vocab:
                number[char] = len(self.ids)
                self.left.append(number[char])
                self.right.append(number[char])
                self.ids.append(vocab[char])
        pairs: list[tuple[int, int, int]] = []
        for merge in merges:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            joined = left + right
            if joined in number:
                raise ValueError(f"token merged twice: {joined!r}")
            number[joined] = len(self.ids)
            pairs.append((number[left], number[right], number[joined]))
            self.left.append(number[left])
            self.right.append(number[right])
            self.ids.append(vocab[joined])
        self.size = len(self.ids)
        self.pair = {a * self.size + b: joined for a, b, joined in pairs}
        self.length = array("i")
        self.trie = ahocorasick.Automaton()
        for token, n in number.items():
            data = raw(token)
            self.length.append(len(data))
            self.trie.add_word(data.decode("latin-1"), n)
        self.longest = max(self.length, default=0)
        # the longest token that a token starts with, itself apart; -1: none
        self.shorter = array("i", (max((number[t[:k]] for k in range(1, len(t)) if t[:k] in number),
                                       key=self.length.__getitem__, default=-1) for t in number))

        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.added = added
        longest_first = sorted(added, key=len, reverse=True)
        self.added_pattern = regex.compile("|".join(map(regex.escape, longest_first))) if added else None
        self.pattern = regex.compile(PRETOKEN)
        self.ascii_pattern = re.compile(ASCII_PRETOKEN)

        by_id = {i: raw(t) for t, i in vocab.items() if t not in added}
        by_id.update({i: t.encode() for t, i in added.items()})
        # by id: its bytes, its digits
        self.bytes = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.names = [str(i) for i in range(max(by_id) + 1)]
        # one answer per slot, the latest: key of the pair, and whether it is compatible
        self._asked = array("q", [-1]) * _FITS_SLOTS
        self._fits = bytearray(_FITS_SLOTS)
        self._cache: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}

    def forget(self) -> None:
        """Drop the pre-tokens met so far; the tables stay."""
        self._cache, self._older = {}, {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of ``left`` and ``right`` before both are whole."""
        size, pair, lefts, rights = self.size, self.pair, self.left, self.right
        key = left * size + right
        slot = (left * 31 + right) % _FITS_SLOTS
        if self._asked[slot] == key:
            return bool(self._fits[slot])
        limit, answer = size, True
        while True:
            merged = pair.get(left * size + right)
            if merged is not None and merged < limit:
                answer = False
                break
            # undo the later of the two tokens: only merges ranked before it were done by then
            undo_left = left > right
            for _ in range(2):
                if undo_left and rights[left] != left:
                    limit, left = left, rights[left]
                    break
                if not undo_left and lefts[right] != right:
                    limit, right = right + 1, lefts[right]
                    break
                undo_left = not undo_left
            else:
                break
        self._asked[slot] = key
        self._fits[slot] = answer
        return answer

    def _encode_bytes(self, data: str) -> tuple[int, ...]:
        """Ids of ``data``, a string with one character per byte."""
        length, shorter, compatible = self.length, self.shorter, self.compatible
        asked, fits, vocabulary = self._asked, self._fits, self.size
        prefix, token, longest = self.trie.longest_prefix, self.trie.get, self.longest
        size = len(data)
        dead = bytearray(size + 1)
        tokens: list[int] = []
        pos, last = 0, -1
        fresh = True  # no token was tried at this position since it was reached
        while pos < size:
            if fresh:
                rest = data[pos:pos + longest]
                end = prefix(rest)  # no token reaches further
                n = token(rest[:end], -1)
                while n < 0 and end > 1:
                    end -= 1
                    n = token(rest[:end], -1)
            while n >= 0:
                if not dead[pos + length[n]]:
                    if last < 0:
                        break
                    slot = (last * 31 + n) % _FITS_SLOTS
                    if fits[slot] if asked[slot] == last * vocabulary + n else compatible(last, n):
                        break
                n = shorter[n]
            fresh = n >= 0
            if fresh:
                tokens.append(n)
                pos += length[n]
                last = n
            else:
                if not tokens:
                    raise ValueError("bytes outside the vocabulary")
                dead[pos] = 1
                n = tokens.pop()
                pos -= length[n]
                last = tokens[-1] if tokens else -1
                n = shorter[n]
        ids = self.ids
        return tuple([ids[n] for n in tokens])

    def _ordinary(self, text: str, out: list[int]) -> None:
        cache = self._cache
        for word in (self.ascii_pattern if text.isascii() else self.pattern).findall(text):
            ids = cache.get(word)
            if ids is None:
                ids = self._older.get(word)
                if ids is None:
                    ids = self._encode_bytes(word if word.isascii() else word.encode().decode("latin-1"))
                if len(word) <= _CACHED_CHARS:
                    if len(cache) >= _CACHE:  # what was not used since the last time goes
                        self._older, self._cache = cache, {}
                        cache = self._cache
                    cache[word] = ids
            out += ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        start = 0
        if self.added_pattern is not None:
            for m in self.added_pattern.finditer(text):
                self._ordinary(text[start:m.start()], out)
                out.append(self.added[m.group()])
                start = m.end()
        self._ordinary(text[start:] if start else text, out)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def loaded(path: str) -> Bpe:
    """The vocabulary of ``path``, read once per worker."""
    return Bpe(path)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_documents(docs: DataFrame, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row; also ``ids`` with ``keep_ids``."""
    path = path or default_vocabulary()
    schema = docs.select("doc_id").schema
    for name, kind in (("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")):
        schema = schema.add(name, kind)
    if keep_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(path)
        name = bpe.names.__getitem__
        for batch in batches:
            rows = []
            for text in batch["text"]:
                ids = bpe.encode(text or "")
                row = (len(ids), hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest(),
                       hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                rows.append(row + (ids,) if keep_ids else row)
            out = pd.DataFrame(rows, columns=[f.name for f in schema.fields[1:]])
            out.insert(0, "doc_id", batch["doc_id"].values)
            yield out
        bpe.forget()  # workers live on into later stages

    return docs.select("doc_id", "text").mapInPandas(run, schema)
