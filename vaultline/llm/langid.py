"""Language identification by rank-order n-gram profiles.

A language's profile is its ``profile_size`` most frequent character n-grams
(1 to ``max_n`` characters, taken inside words padded by ``_``), in order of
frequency.  A document is given the language whose profile is nearest by
out-of-place distance: the sum, over the document's own most frequent n-grams,
of the difference of ranks, ``profile_size`` where the profile lacks the n-gram.

Counting runs over all training rows: each task counts n-grams, packed into
longs, a batch at a time and emits partial counts, which Spark adds up.  Only the
profiles (languages x ``profile_size`` rows) reach the driver; more than
``max_languages`` distinct labels is an error, so their size is bounded.

Defined results: a null text, or one without letters, is ``und`` with score 0;
so is every text when there is nothing to learn from.  Equal distances go to
the smaller language code.  Repeated rows are judged alike; an empty table
gives an empty result; columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
_LETTERS = regex.compile(r"\p{L}+")  # by category: number forms such as \u00bd are no letters
_BITS = 21  # a code point's share of an n-gram's code
_MAX_N = 3  # characters whose code points fit a long
_CHARS = 1_000_000  # characters of training text counted together

Profiles = dict[str, dict[str, int]]
Counts = tuple[np.ndarray, np.ndarray]  # codes in ascending order, how often each occurs


def word_ngrams(word: str, max_n: int) -> list[str]:
    """The n-grams of one word: what ``packed_counts`` counts, written out."""
    padded = f"_{word}_"
    return [*word, *(padded[i:i + n] for n in range(2, max_n + 1) for i in range(len(padded) - n + 1))]


def code_of(gram: str) -> int:
    """The n-gram's code points side by side, the first on top: codes sort as the n-grams do."""
    code = 0
    for char in gram.ljust(_MAX_N, "\0"):
        code = code << _BITS | ord(char)
    return code


def gram_of(code: int) -> str:
    mask = (1 << _BITS) - 1
    return "".join(chr(code >> _BITS * i & mask) for i in reversed(range(_MAX_N))).rstrip("\0")


def packed_counts(words: list[str], max_n: int) -> Counts:
    """Codes of the n-grams of 1 to ``max_n`` characters inside ``words`` padded by ``_``, counted."""
    if not 1 <= max_n <= _MAX_N:
        raise ValueError(f"max_n must be from 1 to {_MAX_N}")
    # neighbours share a "_"; a gram with an inner "_" lies across two words
    points = np.frombuffer(f"_{'_'.join(words)}_".encode("utf-32-le"), dtype="<u4").astype(np.int64)
    letter = points != ord("_")
    first = points << 2 * _BITS
    grams = [first[letter]]
    if max_n > 1:
        second = first[:-1] | points[1:] << _BITS
        grams.append(second)
    if max_n > 2:
        grams.append((second[:-1] | points[2:])[letter[1:-1]])
    return np.unique(np.concatenate(grams), return_counts=True)


def ngram_counts(words: list[str], max_n: int) -> dict[str, int]:
    """``packed_counts`` by n-gram."""
    codes, counts = packed_counts(words, max_n)
    return dict(zip(map(gram_of, codes.tolist()), counts.tolist()))


def _merged(parts: list[Counts]) -> Counts:
    codes, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    total = np.zeros(len(codes), dtype=np.int64)
    np.add.at(total, where, np.concatenate([n for _, n in parts]))
    return codes, total


def _counter(max_n: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang", sort=False)["text"]:
                parts: list[Counts] = []
                words: list[str] = []
                held = 0
                for text in texts:
                    words += _LETTERS.findall(text.lower())
                    held += len(text)
                    if held > _CHARS:
                        parts.append(packed_counts(words, max_n))
                        words, held = [], 0
                parts.append(packed_counts(words, max_n))
                codes, n = _merged(parts)
                yield pd.DataFrame({"lang": lang, "code": codes, "n": n})

    return count


def learn_profiles(train: DataFrame, max_n: int = 3, profile_size: int = 300,
                   max_languages: int = 1000) -> Profiles:
    """Profiles of every non-null ``lang`` of ``train`` (columns ``lang``, ``text``)."""
    rows = train.where("lang is not null and text is not null").select("lang", "text")
    counts = (rows.mapInPandas(_counter(max_n), "lang string, code long, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = (counts.withColumn("rank", F.row_number().over(best))
           .where(F.col("rank") <= profile_size)
           .limit(max_languages * profile_size + 1))
    out: Profiles = {}
    for r in top.collect():
        out.setdefault(r["lang"], {})[gram_of(r["code"])] = r["rank"] - 1
    if len(out) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    return dict(sorted(out.items()))


class Judge:
    """Profiles as one matrix of ranks, n-gram by language."""

    def __init__(self, profiles: Profiles, max_n: int, profile_size: int):
        self.max_n, self.size, self.langs = max_n, profile_size, list(profiles)
        row = {g: i for i, g in enumerate(sorted({g for p in profiles.values() for g in p}))}
        self.codes = np.array([code_of(g) for g in row], dtype=np.int64)
        self.ranks = np.full((len(row) + 1, len(self.langs)), -1, dtype=np.int64)  # the last: in no profile
        for j, lang in enumerate(self.langs):
            for g, rank in profiles[lang].items():
                self.ranks[row[g], j] = rank

    def classify(self, text: str | None) -> tuple[str, float]:
        """Nearest language of one text and 1 - distance / largest possible distance."""
        found = _LETTERS.findall(text.lower()) if text else []
        if not found or not len(self.codes):
            return UNKNOWN, 0.0
        codes, counts = packed_counts(found, self.max_n)
        own = codes[np.argsort(-counts, kind="stable")[:self.size]]  # ties in order of the n-grams
        at = np.searchsorted(self.codes, own)
        at[self.codes[np.minimum(at, len(self.codes) - 1)] != own] = len(self.codes)
        ranks = self.ranks[at]
        apart = np.abs(ranks - np.arange(len(own))[:, None])
        distance = np.where(ranks < 0, self.size, apart).sum(axis=0)
        best = int(distance.argmin())
        return self.langs[best], max(0.0, 1.0 - int(distance[best]) / (self.size * len(own)))


def identify(docs: DataFrame, profiles: Profiles, columns: list[str], max_n: int = 3,
             profile_size: int = 300) -> DataFrame:
    """``columns`` of ``docs`` with ``lang_pred`` and ``score``; only ``text`` is judged."""
    schema = docs.select(*columns).schema.add("lang_pred", "string").add("score", "double")
    extra = [] if "text" in columns else [F.col("text")]

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = Judge(profiles, max_n, profile_size)
        for batch in batches:
            judged = [judge.classify(t) for t in batch["text"]]
            out = batch[columns].copy()
            out["lang_pred"] = [j[0] for j in judged]
            out["score"] = [j[1] for j in judged]
            yield out

    return docs.select(*columns, *extra).mapInPandas(predict, schema)


def judged(text: F.Column, profiles: Profiles, max_n: int = 3, profile_size: int = 300) -> F.Column:
    """``lang_pred`` and ``score`` of ``text`` as a struct; the other columns of its frame stay where they are."""

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        judge = Judge(profiles, max_n, profile_size)
        for texts in batches:
            yield pd.DataFrame([judge.classify(t) for t in texts], columns=["lang_pred", "score"])

    return F.pandas_udf(predict, "lang_pred string, score double")(text)


def held_out(doc_id) -> F.Column:
    """The contract's fold: crc32 of the id as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learnt from the rows that are not held out."""
    fold = held_out(F.col("doc_id"))
    profiles = learn_profiles(docs.where(~fold))
    rows = docs.select("doc_id", fold.alias("held_out"), "text")
    return identify(rows, profiles, ["doc_id", "held_out"])
