"""URL filter: host and path rules first, then a weighted URL vocabulary.

The vocabulary is one Aho-Corasick automaton over strict and soft terms. A hit
counts only between boundaries (no letter or digit on either side). One strict
hit or ``soft_limit`` distinct soft terms block a URL that no rule decides.

Defined results: a null URL, an empty one and one without ``://`` have an empty
host and path, no rule fits them; their whole text is still scanned for terms
(null: none, so allowed). Repeated rows are judged one by one. Columns of the
input named like an output column are replaced; all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Terms of the vocabulary.
STRICT = (
    "casino", "escorts", "hentai", "malware", "phishing", "porn", "pornhub", "sportsbook", "viagra", "warez",
    "xxx",
)
SOFT = (
    "ads", "adult", "bets", "betting", "bonus", "cheap", "cialis", "clickbait", "coupons", "crack", "farm", "free",
    "jackpot", "keygen", "lottery", "pharmacy", "pills", "poker", "popup", "slots", "spam", "torrent", "track",
    "win", "winner",
)
# Fixed values: (verdict, rule); the part from the first slash on is the path.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@lru_cache(maxsize=8)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):  # a term in both lists is strict
        for term in terms:
            machine.add_word(term, (kind, term))
    machine.make_automaton()
    return machine


def count_terms(text: str | None, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[int, int]:
    """Strict hits and distinct soft terms of one lower-case text."""
    if not text:
        return 0, 0
    n_strict, found = 0, set()
    for last, (kind, term) in _automaton(strict, soft).iter(text):
        first = last - len(term) + 1
        if first > 0 and text[first - 1].isalnum() or last + 1 < len(text) and text[last + 1].isalnum():
            continue
        if kind == "strict":
            n_strict += 1
        else:
            found.add(term)
    return n_strict, len(found)


def _hits(strict: tuple[str, ...], soft: tuple[str, ...]):
    @F.pandas_udf("struct<n_strict int, n_soft int>")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([count_terms(t, strict, soft) for t in texts], columns=["n_strict", "n_soft"])

    return hits


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, tail = rule.partition("/")
        inside = (host == name) | host.endswith("." + name)
        fits.append(F.when(inside & path.startswith("/" + tail),
                           F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits)


def filter_urls(
    pages: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_limit: int = 2,
) -> DataFrame:
    """Add host, path, rule, n_strict, n_soft and verdict (allow or block) to every row."""
    added = ["host", "path", "rule", "n_strict", "n_soft", "verdict"]
    # the row travels as one struct, so that no input column can clash with a working one
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.col(url).alias("u"))
    host, path = host_and_path(F.col("u"))
    split = rows.select("row", host.alias("host"), path.alias("path"),
                        _hits(tuple(strict), tuple(soft))(F.translate("u", UPPER, LOWER)).alias("hits"))
    ruled = split.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    refused = (F.col("hits.n_strict") > 0) | (F.col("hits.n_soft") >= soft_limit)
    return ruled.select(
        *[F.col(f"row.`{c}`") for c in pages.columns if c not in added], "host", "path", F.col("fit.rule").alias("rule"),
        F.col("hits.n_strict").alias("n_strict"), F.col("hits.n_soft").alias("n_soft"),
        F.coalesce(F.col("fit.verdict"), F.when(refused, "block").otherwise("allow")).alias("verdict"),
    )
