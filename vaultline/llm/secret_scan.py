"""Secret scan: patterns propose candidates, a random forest removes false positives.

Candidates are known key formats, values assigned to a name, and long mixed
runs.  Features: length, character classes and transitions between them,
repetition and entropy, likelihood of letter pairs, dictionary coverage, path
and URL marks, and the words next to the candidate.

Words and letter pairs are counted over the whole texts of all rows; a word is
a run of 2 to 40 letters.  The ``dictionary_words`` most frequent words of four
letters or more are the dictionary, the ``letter_pairs`` most frequent pairs
give the likelihood; these two bounded tables alone reach the driver.

The forest is fitted on a bounded, balanced set of labelled findings
(``labelled_findings``): secrets and look-alikes made by rule from a seed and
set in sentences of the dictionary's words.  Judging covers every whole text.

Candidates have no upper length.  A value assigned inside another value is
proposed as well, up to the next such assignment and up to the next ``&``.

Defined results: a null or empty text has no finding; every candidate is
judged; overlapping secrets are joined to one span that covers them all, with
the kind of the earliest, then longest; repeated rows are judged alike; an empty table gives an empty result; columns other than those named
are not read.  Redaction replaces a secret by ``[SECRET]`` and keeps the row.
"""

from __future__ import annotations

import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import fresh, quoted, stored
from vaultline.llm.trees import RandomForest

MARK = "[SECRET]"
# Published formats of keys, and names whose assigned value is looked at.
FORMATS = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|AIza[0-9A-Za-z_-]{35}|sk_(?:live|test)_[0-9A-Za-z]{16,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})(?![A-Za-z0-9])")
PRIVATE_KEY = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----")
PRIVATE_KEY_END = re.compile(r"-----END [A-Z ]{0,30}PRIVATE KEY-----")
ASSIGNMENT = re.compile(r"(?i)(?<![a-z0-9_.-])([a-z0-9_.-]++)[\"']?[ \t]*+(?:=>|:=|=|:)[ \t]*+[\"']?")
ASSIGNED_NAMES = re.compile(r"(?i)passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credentials?")
VALUE = re.compile(r"[^\s\"'<>,;]*+")
_LEAST_VALUE = 6
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])")
NAMES = re.compile(r"(?i)passw|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private")
DENIALS = re.compile(r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|todo|fake|redacted|test[_-]?only")
_CONTEXT = 40
_SYMBOLS = 64  # of base64: a longer value cannot have more entropy a character
_LETTERS = re.compile(r"[^\W\d_]+")
_LEAST_WORD, _MOST_WORD = 4, 20  # letters of a dictionary word


@dataclass(frozen=True)
class Speech:
    """What the corpus's words look like: its dictionary, and the log-likelihood of letter pairs."""

    words: frozenset[str] = frozenset()
    pairs: dict[str, float] = field(default_factory=dict)
    unseen: float = -12.0

    def covered(self, value: str) -> int:
        """Characters of ``value`` inside dictionary words, the longest first."""
        total = 0
        for m in _LETTERS.finditer(value.lower()):
            run, at = m.group(), 0
            while at + _LEAST_WORD <= len(run):
                size = next((n for n in range(min(_MOST_WORD, len(run) - at), _LEAST_WORD - 1, -1)
                             if run[at:at + n] in self.words), 0)
                total += size
                at += size or 1
        return total

    def likelihood(self, value: str) -> float:
        """Mean log-likelihood of the letter pairs of ``value``; that of an unseen pair where it has none."""
        found = [self.pairs.get(run[i:i + 2], self.unseen) for run in _LETTERS.findall(value.lower())
                 for i in range(len(run) - 1)]
        return sum(found) / len(found) if found else self.unseen


@dataclass(frozen=True)
class Model:
    forest: RandomForest
    speech: Speech

    def probability(self, found: list[tuple[str, int, int]]) -> list[float]:
        x = [features(t, a, b, self.speech) for t, a, b in found]
        return self.forest.probability(np.array(x)).tolist() if x else []


def _private_keys(text: str) -> list[tuple[int, int]]:
    out, at = [], 0
    while m := PRIVATE_KEY.search(text, at):
        end = PRIVATE_KEY_END.search(text, m.end())
        if not end:
            return out + [b.span() for b in PRIVATE_KEY.finditer(text, m.start())]
        at = end.end()
        out.append((m.start(), at))
    return out


def _assigned(text: str) -> list[tuple[int, int]]:
    """Whole values, and their parts from each name in them to the next one; all lengths add up to a few times the text's."""
    named = [m.span() for m in ASSIGNMENT.finditer(text) if ASSIGNED_NAMES.search(m.group(1).rpartition(".")[2])]
    out, whole = [], 0
    for i, (_, start) in enumerate(named):
        if start >= whole:
            whole = VALUE.match(text, start).end()
            out.append((start, whole))
        stop = min(whole, named[i + 1][0]) if i + 1 < len(named) else whole
        out.append((start, stop))
        part = text.find("&", start, stop)
        if part >= 0:
            out.append((start, part))
    return [s for s in out if s[1] - s[0] >= _LEAST_VALUE]


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of proposed spans, in order, the longer first; they may overlap."""
    found: dict[tuple[int, int], str] = {}
    for kind, spans in (("private_key", _private_keys(text)), ("format", (m.span() for m in FORMATS.finditer(text))),
                        ("assigned", _assigned(text)), ("run", (m.span() for m in RUN.finditer(text)))):
        for span in spans:
            found.setdefault(span, kind)
    return [(a, b, found[a, b]) for a, b in sorted(found, key=lambda s: (s[0], -s[1]))]


def features(text: str, start: int, end: int, speech: Speech = Speech()) -> list[float]:
    value = text[start:end]
    before, after = text[max(0, start - _CONTEXT):start], text[end:end + _CONTEXT]
    n = len(value)
    classes = ["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "s" for c in value]
    moves = sum(a != b for a, b in zip(classes, classes[1:]))
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    letters = sum(c in "lu" for c in classes)
    vowels = sum(c in "aeiouAEIOU" for c in value)
    hexadecimal = sum(c in string.hexdigits for c in value)
    return [
        n, moves / max(1, n - 1), entropy, entropy / max(1.0, math.log2(min(n, _SYMBOLS))),
        classes.count("d") / n, classes.count("u") / n, classes.count("s") / n, letters / n,
        vowels / max(1, letters), hexadecimal / n, speech.covered(value) / n,
        speech.likelihood(value),
        max(counts.values()) / n, sum(a == b for a, b in zip(value, value[1:])) / max(1, n - 1),
        value.count("/") + value.count("\\"), value.count("."), value.count("-") + value.count("_"),
        float("://" in before[-12:] + value), float("@" in value),
        float(bool(NAMES.search(before[-24:]))), float(bool(re.search(r"[=:][ \t]*[\"']?$", before))),
        float(bool(DENIALS.search(before[-24:] + value))), float(bool(FORMATS.fullmatch(value))),
        float(bool(PRIVATE_KEY.match(value))), float(after[:1] in "\"'"),
    ]


def labelled_findings(words: list[str], rows: int = 3000, seed: int = 5) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label): secrets (1) and look-alikes (0) by rule, inside sentences of ``words``."""
    rng = random.Random(seed)
    words = words or ["word"]
    upper, mixed = string.ascii_uppercase + string.digits, string.ascii_letters + string.digits

    def of(alphabet: str, n: int) -> str:
        return "".join(rng.choices(alphabet, k=n))

    def word() -> str:
        return rng.choice(words)

    names = ["password", "passwd", "token", "secret", "api_key", "access_key", "auth_token", "client_secret"]

    def secret() -> tuple[str, str]:
        assign = rng.choice(names) + rng.choice(["=", " = ", ": ", ' = "', "='"])
        return rng.choice([
            lambda: ("", rng.choice(["AKIA", "ASIA"]) + of(upper, 16)),
            lambda: ("", "ghp_" + of(mixed, 36)),
            lambda: ("", "sk_live_" + of(mixed, 24)),
            lambda: ("", "xoxb-" + of(string.digits, 12) + "-" + of(mixed, 24)),
            lambda: ("", "eyJ" + of(mixed, 20) + "." + of(mixed, 40) + "." + of(mixed, 30)),
            lambda: (assign, of("0123456789abcdef", rng.choice([12, 16, 18, 20, 24, 32, 40, 64]))),
            lambda: (assign, of(mixed, rng.randint(10, 48))),
            lambda: (assign, of(mixed + "!#$%&*+/=?@^_~-", rng.randint(10, 32))),
            lambda: ("", of(mixed + "+/", 40)),
            lambda: (assign, of(mixed, rng.randint(49, 3000))),
            lambda: ("", of(mixed + "+/", rng.randint(41, 3000))),
            lambda: ("", "-----BEGIN RSA PRIVATE KEY-----"),
            lambda: ("", "-----BEGIN RSA PRIVATE KEY-----\n" + of(mixed + "+/", rng.randint(60, 3000))
                     + "\n-----END RSA PRIVATE KEY-----"),
        ])()

    def lookalike() -> tuple[str, str]:
        assign = rng.choice(names) + rng.choice(["=", " = ", ": "])
        return rng.choice([
            lambda: (assign, word() + rng.choice(["", ".", word()])),
            lambda: (assign, rng.choice(["changeme", "your_password_here", "xxxxxxxxxxxx", "example-token", "<redacted>",
                                         "placeholder", "os.environ", "None", "required", "test_only_value"])),
            lambda: ("", "/".join(word() for _ in range(rng.randint(4, 8))) + "/" + of(string.digits, 3) + ".html"),
            lambda: ("https://", word() + ".example.com/" + word() + "/" + of(string.digits, 4) + "/" + word()),
            lambda: ("", "-".join(word() for _ in range(5)) + "-" + of(string.digits, 2)),
            lambda: ("", "_".join(word() for _ in range(5)) + of(string.digits, 1)),
            lambda: ("", of(string.digits, rng.randint(20, 40))),
            lambda: ("", of("-=_", 1) * 24 + "1" + "-" * 5),
            lambda: ("", (word() + word() + word() + word() + word())[:60] + of(string.digits, 1)),
            lambda: ("", "-".join(of("0123456789abcdef", n) for n in (8, 4, 4, 4, 12))),
            lambda: ("", rng.choice("/-_+").join(word() for _ in range(rng.randint(9, 400))) + of(string.digits, 1)),
            lambda: ("", of(string.digits, rng.randint(41, 3000))),
        ])()

    out = []
    for i in range(rows):
        label = i % 2
        lead, value = secret() if label else lookalike()
        start = " ".join(word() for _ in range(rng.randint(0, 8)))
        text = (start + " " if start else "") + lead
        after = ('"' if lead.endswith('"') else "") + " " + " ".join(word() for _ in range(rng.randint(0, 6)))
        out.append((text + value + after, len(text), len(text) + len(value), label))
    return out


def learn_speech(docs: DataFrame, dictionary_words: int = 5000, letter_pairs: int = 4000) -> Speech:
    """Dictionary and letter pairs, counted over the whole texts of all rows."""
    words = F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")
    counts = stored(docs.where("text is not null").select(words).where(F.length("word").between(2, 40))
                    .groupBy("word").agg(F.count("*").alias("n")))
    common = (counts.where(F.length("word").between(_LEAST_WORD, _MOST_WORD)).orderBy(F.desc("n"), "word")
              .limit(dictionary_words).collect())
    places = F.sequence(F.lit(1), F.length("word") - 1)
    pair = F.explode(F.transform(places, lambda i: F.substr("word", i, F.lit(2)))).alias("pair")
    pairs = (counts.select("n", pair).groupBy("pair").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "pair").limit(letter_pairs).collect())
    total = sum(r["n"] for r in pairs) + len(pairs) + 1
    return Speech(frozenset(r["word"] for r in common),
                  {r["pair"]: math.log((r["n"] + 1) / total) for r in pairs}, math.log(1 / total))


def fit(docs: DataFrame, rows: int = 3000, dictionary_words: int = 5000, letter_pairs: int = 4000) -> Model:
    """The forest, fitted on ``rows`` labelled findings set in words of the dictionary, with the corpus's speech."""
    speech = learn_speech(docs, dictionary_words, letter_pairs)
    findings = labelled_findings(sorted(speech.words), rows)
    x = np.array([features(t, a, b, speech) for t, a, b, _ in findings])
    return Model(RandomForest(x, np.array([f[3] for f in findings])), speech)


def judge(texts: list[str | None], model: Model, threshold: float = 0.5) -> list[list[tuple]]:
    """Per text its candidates as (start, end, kind, score, is secret); overlapping secrets are one."""
    spans = [candidates(t) if t else [] for t in texts]
    scores = iter(model.probability([(t, a, b) for t, s in zip(texts, spans) for a, b, _ in s]))
    out = []
    for s in spans:
        judged, last = [], -1
        for a, b, kind in s:
            score = next(scores)
            if score < threshold:
                judged.append((a, b, kind, score, False))
            elif last >= 0 and a < judged[last][1]:
                first = judged[last]
                judged[last] = (first[0], max(first[1], b), first[2], max(first[3], score), True)
            else:
                last = len(judged)
                judged.append((a, b, kind, score, True))
        out.append(judged)
    return out


def scan(docs: DataFrame, model: Model | None = None, threshold: float = 0.5) -> DataFrame:
    """doc_id, n_candidates, n_secrets, spans (``kind:start:end`` of secrets, comma-joined), max_score."""
    model = model or fit(docs)
    schema = docs.select("doc_id").schema
    for name, kind in (("n_candidates", "long"), ("n_secrets", "long"), ("spans", "string"), ("max_score", "double")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            judged = judge(list(batch["text"]), model, threshold)
            out = batch[["doc_id"]].copy()
            out["n_candidates"] = [len(j) for j in judged]
            out["n_secrets"] = [sum(c[4] for c in j) for j in judged]
            out["spans"] = [",".join(f"{c[2]}:{c[0]}:{c[1]}" for c in j if c[4]) for j in judged]
            out["max_score"] = [round(max((c[3] for c in j), default=0.0), 6) for j in judged]
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, schema)


def redact(docs: DataFrame, model: Model | None = None, threshold: float = 0.5) -> DataFrame:
    """``docs`` with every secret of ``text`` replaced by ``[SECRET]`` and ``n_chars`` made to fit."""
    model = model or fit(docs)

    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = []
            for text, found in zip(batch, judge(list(batch), model, threshold)):
                for start, end, _, _, secret in reversed(found):
                    if secret:
                        text = text[:start] + MARK + text[end:]
                texts.append(text)
            yield pd.Series(texts, dtype=object)

    # only the text goes to Python; the other columns, whatever their names, stay where they are
    text = fresh("_redacted", docs.columns)
    out = docs.withColumn(text, F.pandas_udf(clean, "string")(F.col("text")))
    fitting = F.when(~F.col(text).eqNullSafe(F.col("text")), F.length(text).cast("long")).otherwise(F.col("n_chars")) \
        if "n_chars" in docs.columns else None
    swapped = {"text": F.col(text).alias("text"), "n_chars": fitting if fitting is None else fitting.alias("n_chars")}
    return out.select(*(swapped[c] if swapped.get(c) is not None else F.col(q)
                        for c, q in zip(docs.columns, quoted(docs.columns))))
