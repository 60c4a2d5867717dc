"""URL filter: exact host and path rules first, then gradient-boosted trees on lexical features.

Features: lengths, path depth, label counts, ratios of digits and hyphens,
entropy, parameter counts, and three shares of known blocked: whether most URLs
under the host's suffix are, and in tenths that of the hosts with its last label
and of the hosts that share one of its words (the largest).  No feature looks at the words that label.

Statistics count every URL of the table: URLs and known blocked ones are added
up per host, then URLs and hosts per suffix, last label and word (whole words
of the host but its last label), and joined back by host.  A host is left out
of its own shares, in fitting and in judging, so that its label tells nothing.

Labels: blocked where a word of the host names an unwanted kind and no rule
allows the URL; clean where a rule allows it and there is no such word; all
others are of unknown kind, have none and fit no tree (a rule that blocks tells
of the URLs it covers, which the trees do not judge).  As a table may hold few
of them, or none, ``labelled_urls`` adds ``made_rows`` by rule from a seed: half
of their hosts go into the shares, the trees see the other half.  The trees
alone are fitted on a sample, at most ``label_rows`` labelled rows of the table
by hash of the id.

Defined results: a null url, or one without ``://``, has empty host and path
and no rule; the method judges it as it does any other.  Rules of one length
cannot both fit, so ties do not arise; repeated rows are judged alike; an empty
table gives an empty result; columns other than those named are not read.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import stored
from vaultline.llm.trees import BoostedTrees

# Fixed values: (verdict, host, path) of the rules, and words of unwanted hosts.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
# Kinds of unwanted hosts, as whole words of a host but its last label, and last labels of unwanted hosts.
UNWANTED_KINDS = {
    "adult": "adult adults porn porno xxx sex sexy sexcam sexcams webcam camgirls nude nudes naked erotic erotica hentai "
             "escort escorts milf fetish hardcore",
    "ads and tracking": "ad ads adserver adserv adservice adclick adnet adnetwork adsystem advert adverts advertising "
                        "banners doubleclick popunder popunders popups tracker trackers tracking clicktrack telemetry",
    "gambling": "casino casinos bet bets betting bookmaker bookmakers poker slots slot jackpot roulette blackjack lottery "
                "lotto gamble gambling wager bingo",
    "spam": "spam spammer clickbait linkfarm contentfarm pills viagra cialis pharma payday loan loans replica replicas "
            "getrich giveaway freebies",
    "malware and fraud": "malware phish phishing virus trojan ransomware spyware botnet exploit exploits scam scams fraud "
                         "keygen keygens crack cracks warez",
}
UNWANTED = r"(?<![a-z])(?:" + "|".join(w for words in UNWANTED_KINDS.values() for w in words.split()) + r")(?![a-z])"
UNWANTED_LABELS = "adult bet bingo casino loan poker porn sex sexy xxx webcam".split()
UNWANTED_END = r"\.(?:" + "|".join(UNWANTED_LABELS) + r")(?::[0-9]*)?$"
# Words and last labels of hosts of either kind, of which the made labelled URLs are composed.
PLAIN_WORDS = ("best win free cheap farm track top my the online shop club city news page site bank login home life world "
               "web net info live video videos photo blog m www en mail store house group team tech data cloud art x king "
               "go example pro direct express center daily").split()
LAST_LABELS = "com net org info de fr es eu io co".split()
_SYLLABLES = [c + v for c in "bcdfghklmnprstvw" for v in "aeiou"]
Rules = tuple[tuple[str, str, str], ...]


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Rules = RULES) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def unwanted(host: Column) -> Column:
    """Whether a whole word of the host, but its last label, or the last label names an unwanted kind."""
    named = F.when(F.contains(host, F.lit(".")), F.regexp_replace(host, r"\.[^.]*$", "")).otherwise(host)
    return F.regexp_like(named, F.lit(UNWANTED)) | F.regexp_like(host, F.lit(UNWANTED_END))


def label_of(host: Column, path: Column, rules: Rules = RULES) -> Column:
    """1 for a URL known as blocked, 0 for one known as clean, null where the host's kind is unknown."""
    _, verdict = rule_for(host, path, rules)
    allowed = F.coalesce(verdict == "allow", F.lit(False))
    return F.when(unwanted(host) & ~allowed, 1).when(allowed & ~unwanted(host), 0)


def _labelled(pages: DataFrame, rules: Rules) -> DataFrame:
    """``pages`` with host, path and label."""
    rows = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    return rows.withColumn("label", F.when(F.col("url").isNotNull(), label_of(F.col("host"), F.col("path"), rules)))


def labelled_urls(rows: int = 4000, seed: int = 17) -> list[tuple[str, str, int]]:
    """(url, host, label): blocked (1) and clean (0) URLs by rule, in overlapping shapes.

    Blocked hosts hold a word of an unwanted kind, or end in such a label, or (a tenth) disguise the word and
    have only their shape to tell them; clean ones hold invented words.  Both have plain words among them.
    """
    rng = random.Random(seed)
    kinds = [w for words in UNWANTED_KINDS.values() for w in words.split()]

    def invented() -> str:
        return "".join(rng.choices(_SYLLABLES, k=rng.randint(2, 4))) + rng.choice(["", "n", "s", "r"])

    def digits(most: int) -> str:
        return "".join(rng.choices("0123456789", k=rng.randint(1, most)))

    out = []
    for i in range(rows):
        label, disguised = i % 2, i % 20 == 1
        words = rng.sample(PLAIN_WORDS, rng.randint(0, 2))
        last = rng.choice(LAST_LABELS)
        if disguised:
            words.append(rng.choice(kinds) + digits(3) + invented() + digits(2))
            words[-1] = words[-1].translate(str.maketrans("aeio", "4310"))
        elif label and rng.random() < 0.15:
            words, last = [*words, invented()], rng.choice(UNWANTED_LABELS)
        else:
            words.append(rng.choice(kinds) if label else invented())
            if rng.random() < (0.3 if label else 0.15):
                words.append(invented())
        rng.shuffle(words)
        if rng.random() < (0.3 if label else 0.1):
            words[-1] += digits(3)
        name = "".join(w + rng.choices("-.", (3, 2) if label else (1, 1))[0] for w in words)[:-1]
        host = rng.choice(["", "", "www.", "m.", "blog."]) + name + rng.choice(["", ".example"]) + "." + last
        path = "".join("/" + rng.choice([invented(), rng.choice(LAST_LABELS[4:]), digits(4)])
                       for _ in range(rng.randint(0, 5))) + rng.choice(["", "/", ".html", "#top"])
        parameters = rng.randint(3, 6) if disguised else rng.randint(0, 4) if label else max(0, rng.randint(-2, 3))
        query = "&".join(f"{invented()}={digits(5)}" for _ in range(parameters))
        scheme = "https" if rng.random() < (0.4 if label else 0.6) else "http"
        out.append((f"{scheme}://{host}{path.partition('#')[0]}" + (f"?{query}" if query else ""), host, label))
    return out


def _folds(made: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Made URLs whose hosts are counted, and those the trees see; blocked and clean ones alternate in both."""
    return [r for i, r in enumerate(made) if i // 2 % 2 == 0], [r for i, r in enumerate(made) if i // 2 % 2]


def statistics(pages: DataFrame, rules: Rules = RULES, made: list[tuple] = ()) -> DataFrame:
    """Per host: URLs, known blocked ones and whether the host counts; the same of its suffix, its last label and its words.

    ``n`` and ``blocked`` count URLs of ``pages``; ``hosts`` and ``bad`` count hosts, those of half of ``made`` included.
    """
    blocked = F.coalesce(F.col("label"), F.lit(0)).cast("long")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    rows = _labelled(pages.select("url"), rules).select("host", one.alias("n"), blocked.alias("blocked"),
                                                        one.alias("hosts"), blocked.alias("bad"))
    if made:
        counted, seen = _folds(made)
        more = [(h, y, 1) for _, h, y in counted] + [(h, 0, 0) for _, h, _ in seen]
        rows = rows.unionAll(pages.sparkSession.createDataFrame(more, "host string, label long, hosts long").select(
            "host", none.alias("n"), none.alias("blocked"), "hosts", F.col("label").alias("bad")))
    hosts = stored(rows.groupBy("host").agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"),
                                            F.max("hosts").alias("hosts"), F.max("bad").alias("bad")))
    sums = [F.sum(c).alias(c) for c in _SUMS]
    suffix = F.substring_index("host", ".", -2).alias("suffix")
    last = F.substring_index("host", ".", -1).alias("last")
    named = F.when(F.contains("host", F.lit(".")), F.regexp_replace("host", r"\.[^.]*$", "")).otherwise(F.col("host"))
    words = hosts.select("host", *_SUMS, F.explode(F.array_distinct(
        F.regexp_extract_all(named, F.lit("[a-z]+"), F.lit(0)))).alias("word"))

    def of(name: str, column) -> DataFrame:
        return hosts.select(*_SUMS, column).groupBy(name).agg(*sums).withColumnsRenamed({c: f"{name}_{c}" for c in _SUMS})

    of_words = words.select("host", "word").join(words.groupBy("word").agg(*sums), "word").groupBy("host").agg(
        F.collect_list(F.struct(*_SUMS)).alias("words"))
    return stored(hosts.select("host", *_SUMS, suffix, last).join(of("suffix", suffix), "suffix")
                  .join(of("last", last), "last").join(of_words, "host", "left")
                  .select("host", *_SUMS, "suffix_n", "suffix_blocked", "last_hosts", "last_bad",
                          *[F.col(f"words.{c}").alias(f"words_{c}") for c in _SUMS]))


_SUMS = ["n", "blocked", "hosts", "bad"]
_NUMBERS = [*_SUMS, "suffix_n", "suffix_blocked", "last_hosts", "last_bad"]
_COUNTS = [*_NUMBERS, "words_hosts", "words_bad"]
FEATURES = ["suffix_mostly_blocked", "last_label_share", "word_share", "url_length", "host_length", "path_length", "depth", "labels",
            "longest_label", "digit_ratio", "host_digit_ratio", "host_hyphens", "host_entropy", "path_entropy", "parameters",
            "https", "escapes"]


class UrlModel:
    """Trees and the overall share of known blocked URLs.  Rows: url, host, path and the counts; labels beside them."""

    def __init__(self, rows: list[tuple], labels: list[int], prior: float, seed: int = 11):
        self.prior = prior
        x = np.array([self.features(*r) for r in rows])
        self.trees = BoostedTrees(x, np.array(labels, dtype=float), seed=seed)

    def _share(self, n: int, blocked: int, own: int, own_n: int = 1) -> float:
        """Share of the others, drawn towards the overall one."""
        return (blocked - own + 2 * self.prior) / (max(0, n - own_n) + 2)

    def features(self, url: str, host: str, path: str, own_n, own_blocked, own_hosts, own_bad, suffix_n, suffix_blocked,
                 last_hosts, last_bad, words_hosts, words_bad) -> list[float]:
        """In the order of ``FEATURES``."""
        query = url.partition("#")[0].partition("?")[2]
        n = max(1, len(url))
        labels = host.split(".")
        words = max((self._share(a, b, own_bad, own_hosts) for a, b in zip(words_hosts, words_bad)), default=self.prior)
        # Coarse: an exact share would tell the few labelled hosts of the table, by their suffix or their own absence.
        return [
            float(self._share(suffix_n, suffix_blocked, own_blocked, own_n) > 0.5),
            round(self._share(last_hosts, last_bad, own_bad, own_hosts), 1), round(words, 1),
            len(url), len(host), len(path), path.count("/"), len(labels), max(map(len, labels)),
            sum(c.isdigit() for c in url) / n, sum(c.isdigit() for c in host) / max(1, len(host)),
            host.count("-"), _entropy(host), _entropy(path), query.count("=") + query.count("&"),
            float(url.startswith("https")), float("@" in url or "%" in url),
        ]

    def probability(self, rows: list[tuple]) -> np.ndarray:
        return self.trees.probability(np.array([self.features(*r) for r in rows])) if rows else np.zeros(0)

    def splits(self) -> dict[str, int]:
        """How often the trees split by each feature."""
        used = Counter(f for tree in self.trees.trees for f in tree.feature if f >= 0)
        return {name: used[i] for i, name in enumerate(FEATURES)}


def _with_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    none = F.array().cast("array<long>")
    return rows.join(counts.select("host", *_COUNTS), "host", "left").withColumns(
        {c: F.coalesce(c, F.lit(0).cast("long") if c in _NUMBERS else none) for c in _COUNTS})


def fit(pages: DataFrame, rules: Rules = RULES, label_rows: int = 20_000, counts: DataFrame | None = None,
        made: list[tuple] | None = None) -> UrlModel:
    """A model whose trees see half of ``made`` and at most ``label_rows`` labelled URLs, chosen by hash of the id."""
    made = labelled_urls() if made is None else made
    counts = counts if counts is not None else statistics(pages, rules, made)
    total = counts.agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked")).first()
    rows = _labelled(pages.select("page_id", "url"), rules).where("label is not null")
    step = max(1, -(-rows.count() // label_rows))
    digest = F.xxhash64("page_id", "url")
    known = _with_counts(rows.where(F.pmod(digest, F.lit(step)) == 0).withColumn("digest", digest), counts).select(
        "digest", "label", "url", "host", "path", *_COUNTS).collect()
    seen = pages.sparkSession.createDataFrame(_folds(made)[1], "url string, host string, label int").withColumn(
        "path", path_of(F.col("url")))
    more = _with_counts(seen, counts).select(F.lit(0), "label", "url", "host", "path", *_COUNTS).collect()
    known = sorted(map(tuple, known))[:label_rows] + sorted(map(tuple, more))
    return UrlModel([r[2:] for r in known], [r[1] for r in known],
                    ((total["blocked"] or 0) + 1) / ((total["n"] or 0) + 2))


def judge(pages: DataFrame, model: UrlModel | None = None, rules: Rules = RULES,
          threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's score of every row."""
    made = labelled_urls()
    counts = statistics(pages, rules, made)
    model = model or fit(pages, rules, counts=counts, made=made)
    rows = _labelled(pages.select("page_id", F.col("url")), rules).withColumn("url", F.coalesce("url", F.lit("")))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    schema = rows.drop("url").schema.add("score", "double")
    names = schema.fieldNames()[:-1]
    rows = _with_counts(rows, counts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = model.probability(list(zip(*(batch[c] for c in ("url", "host", "path", *_COUNTS)))))
            method = pd.Series(np.where(score >= threshold, "block", "allow"), index=batch.index)
            yield batch[names].assign(verdict=batch["verdict"].where(batch["verdict"].notna(), method),
                                                    score=np.round(score, 6))

    return rows.mapInPandas(run, schema)
