"""Personal data by patterns, checksums and context words, in DataFrame functions alone.

A pattern proposes spans.  Positions need no UDF: splitting a text by the
pattern gives the pieces between the matches, and the lengths of pieces and
matches add up to the start of each match.  Running sums are taken over blocks
of ``_BLOCK`` lengths, so a text with many matches is not summed anew for each.
Possessive quantifiers keep the patterns linear and free of recursion; they
match what the plain forms match, as no later part could use what they give up.

Validators confirm: Luhn for cards, parts of at most 255 for addresses, digit
counts for phones, mod-97 for bank account numbers (kind ``iban``, which the
method adds).  An account number ends where its country's published length
ends, else, for codes not in the list, at the last blank or end at which mod-97
holds; its match takes in the first four characters only, so that a wrong start
hides no number after it.  Words near a span raise its score; base spans are kept at any
score, an account number without a valid checksum is dropped.

Defined results: a null text is the empty one; spans of one kind never overlap
(except valid account numbers inside one another, all of which are kept), so
ties do not arise; repeated rows give repeated results; an empty table gives
an empty result; columns other than those named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCK = 512
_CONTEXT = 48  # code points looked at on either side of a span
_LOCAL = "A-Za-z0-9._%+-"


@dataclass(frozen=True)
class Kind:
    """A kind of span: pattern, a text that must occur for it, validator, words that speak for it."""

    name: str
    pattern: str
    needs: str | None
    base_score: float
    words: str


# The kinds in the order of the digest (the first four are the base kinds).
KINDS = (
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
         "mail|contact|write|address"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, r"\bip\b|host|server|address|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", None, 0.8, "card|visa|credit|payment|karte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, "phone|tel|call|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){11,31}+))[A-Z]{2}[0-9]{2}", None, 0.8,
         "iban|account|bank|konto|compte|cuenta"),
)
BASE = ("email", "ip", "card", "phone")
_ACCOUNT_START = 4  # characters of an account number that its match takes in; group 1 is what may belong to it
# Published lengths of account numbers by country code.
ACCOUNT_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Digits from the right; every second one doubled, its digits added."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    weighed = F.transform(values, lambda v, i: F.when(i % 2 == 0, v).otherwise(v * 2 - F.when(v > 4, 9).otherwise(0)))
    return F.aggregate(weighed, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def _mod97(account: Column) -> Column:
    """Country and check digits moved to the end, letters as 10 to 35, remainder 1."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))
    values = F.transform(F.filter(F.split(turned, ""), lambda c: c != ""), lambda c: F.when(
        c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = r"0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5]|(?<=0))"
        return F.regexp_like(match, F.lit(rf"^{part}(?:\.{part}){{3}}$"))
    if kind == "card":
        return F.when(F.length(_digits(match)).between(16, 19), _luhn(_digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    if kind == "iban":
        return match.isNotNull()
    return F.lit(True)


def _account(candidate: Column) -> Column:
    """The account number at the candidate's start, or null."""
    parts = F.split(candidate, " ")
    starts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), " "))

    def fits(start: Column) -> Column:
        account = F.replace(start, F.lit(" "), F.lit(""))
        code, length = F.left(account, F.lit(2)), F.length(account)
        published = F.lit(None).cast("int")
        for n, codes in ACCOUNT_LENGTHS.items():
            published = F.when(code.isin(*codes.split()), n).otherwise(published)
        return (F.coalesce(length == published, length.between(15, 34))
                & F.regexp_like(account, F.lit("^[A-Z0-9]+$")) & _mod97(account))

    return F.get(F.reverse(F.filter(starts, fits)), F.lit(0))


def _sum(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, n: a + n)


def _lengths(kind: str) -> Column:
    """Length of each match and the piece before it."""
    pieces = F.col(f"_p_{kind}")
    return F.transform(f"_m_{kind}", lambda m, i: (
        (F.lit(_ACCOUNT_START) if kind == "iban" else F.length(m)) + F.length(F.get(pieces, i))).cast("long"))


def _block_sums(kind: str) -> Column:
    lengths = F.col(f"_l_{kind}")
    blocks = F.sequence(F.lit(0), F.floor(F.size(lengths) / _BLOCK).cast("int"))
    return F.transform(blocks, lambda b: _sum(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))


def _spans(kind: Kind) -> Column:
    """array<struct<kind,start,end,score>> from the columns ``_m``, ``_p``, ``_l`` and ``_b`` of the kind."""
    m, pieces, lengths, blocks = (F.col(f"{c}_{kind.name}") for c in ("_m", "_p", "_l", "_b"))

    def span(match: Column, i: Column) -> Column:
        block = F.floor(i / _BLOCK).cast("int")
        start = (_sum(F.slice(blocks, F.lit(1), block))
                 + _sum(F.slice(lengths, block * _BLOCK + 1, i % _BLOCK))
                 + F.length(F.get(pieces, i)))
        after = F.get(pieces, i + 1)
        if kind.name == "iban":
            after = F.substr(after, F.length(match) - _ACCOUNT_START + 1)
        near = F.concat(F.right(F.get(pieces, i), F.lit(_CONTEXT)), F.lit(" "), F.left(after, F.lit(_CONTEXT)))
        score = F.lit(kind.base_score) + F.when(
            F.regexp_like(F.lower(near), F.lit(kind.words)), 0.1).otherwise(0.0)
        return F.when(_valid(kind.name, match), F.struct(
            F.lit(kind.name).alias("kind"), start.alias("start"),
            (start + F.length(match)).alias("end"), F.round(score, 2).alias("score")))

    return F.filter(F.transform(m, span), lambda s: s.isNotNull())


def find(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` with ``findings``: array<struct<kind,start,end,score>> over the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<string>")
    rows = docs.select(*columns, text.alias("_t"))

    def if_needed(kind: Kind, value: Column) -> Column:
        return value if kind.needs is None else F.when(
            F.contains(F.col("_t"), F.lit(kind.needs)), value).otherwise(none)

    rows = rows.select("*", *[if_needed(k, F.regexp_extract_all("_t", F.lit(k.pattern), F.lit(int(k.name == "iban")))
                                          ).alias(f"_m_{k.name}") for k in KINDS])
    rows = rows.select("*", *[F.when(F.size(f"_m_{k.name}") > 0, F.split("_t", k.pattern, -1)).otherwise(none)
                              .alias(f"_p_{k.name}") for k in KINDS])
    rows = rows.withColumn("_m_iban", F.transform("_m_iban", _account))
    rows = rows.select("*", *[_lengths(k.name).alias(f"_l_{k.name}") for k in KINDS])
    rows = rows.select("*", *[_block_sums(k.name).alias(f"_b_{k.name}") for k in KINDS])
    return rows.select(*columns, F.concat(*[_spans(k) for k in KINDS]).alias("findings"))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, a count per base kind, base_sha256, spans, scores (one per span, as context adjusted it) and findings."""
    found = find(docs, ["doc_id"])

    def digest(keep) -> Column:
        kept = F.filter("findings", keep)
        return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select("doc_id", *counts,
                        F.sha2(digest(lambda s: s["kind"].isin(*BASE)), 256).alias("base_sha256"),
                        digest(lambda s: F.lit(True)).alias("spans"),
                        F.array_join(F.transform("findings", lambda s: s["score"].cast("string")), ",").alias("scores"),
                        "findings")
