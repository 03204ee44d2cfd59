"""Quality rules: repetition and length rules, then distribution divergence.

Every document gets two histograms: characters by class, and words by a list of
common words plus "any other". The references are the pooled histograms of each
language over all documents that pass the base rules. A document is compared to
every reference by the Jensen-Shannon distance (square root of the divergence in
bits, 0 to 1) and its closest reference counts. A histogram is judged only when
the text is long enough for it: short texts diverge by chance. A language is the two- or
three-letter code that a label begins with, so there are 18,252 references at most, each as large as the two
histograms; other labels count as none. Every language that occurs is a reference, however rare, so a
document fares alike whatever else the table holds; the only document of a language is its own reference.

Built-in functions only. Words are ``[^\\x20\\x09-\\x0D]+``. Defined results:
a null text counts as empty: no words, so it fails the base rules; with no
reference at all (empty table, no labelled document that passes) divergence is
not judged and ``char_distance`` and ``word_distance`` are null; they are also
null under the guards. A null language is compared to all references like any other. Repeated rows are judged one by one. Input columns named
like an output column are replaced by ``judge`` and kept apart by ``judged``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.store import saved

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
# Common words of four languages.
COMMON_WORDS = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im"),
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "una"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans"),
}
# Character classes, taken off in this order; what is left is "other".
CLASSES = (
    ("lower", r"[a-z]+"),
    ("space", SPACE),
    ("upper", r"[A-Z]+"),
    ("letter", r"\p{L}+"),
    ("digit", r"\p{N}+"),
    ("symbol", r"[#*$%&|<>]+"),
    ("punctuation", r"\p{P}+"),
)
CHAR_BINS = len(CLASSES) + 1


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    max_repeat_percent: int = 20
    # divergence is judged from these lengths on
    char_guard: int = 400
    word_guard: int = 200
    max_char_distance: float = 0.30
    max_word_distance: float = 0.30
    smoothing: float = 0.5


def vocabulary() -> list[str]:
    return sorted({w for words in COMMON_WORDS.values() for w in words})


def features(docs: DataFrame, text: str) -> DataFrame:
    """The input columns (none named ``_q_...``) with base counts, ``_q_chars`` and ``_q_words`` (the two histograms)."""
    d = docs.withColumn("_q_0", F.coalesce(F.col(text), F.lit("")))
    for i, (_, pattern) in enumerate(CLASSES):
        d = d.withColumn(f"_q_{i + 1}", F.regexp_replace(f"_q_{i}", pattern, ""))
    lengths = [F.length(f"_q_{i}") for i in range(CHAR_BINS)]
    bins = [a - b for a, b in zip(lengths, lengths[1:])] + [lengths[-1]]
    d = d.withColumns({
        "_q_chars": F.array(*bins),
        "_q_w": F.array_remove(F.split("_q_0", SPACE), ""),
        "_q_lines": F.filter(F.split("_q_0", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    })
    d = d.withColumns({
        "n_words": F.size("_q_w").cast("long"),
        "word_chars": (F.length("_q_0") - F.col("_q_chars")[1]).cast("long"),
        "n_symbols": F.col("_q_chars")[5].cast("long"),
        "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
        "_q_h": F.transform("_q_w", lambda w: F.xxhash64(w)),
        "_q_hits": F.filter(F.transform("_q_w", F.lower), lambda w: w.isin(*vocabulary())),
    })
    return _common_words(_repeats(d)).drop(*[f"_q_{i}" for i in range(CHAR_BINS)], "_q_w", "_q_lines", "_q_h", "_q_hits")


def _repeats(d: DataFrame) -> DataFrame:
    """``n_repeat_words``: words in windows whose hash stands in the text twice or more."""
    at = lambda i: F.get("_q_h", i)
    d = d.withColumn("_q_windows", F.transform(
        F.slice("_q_h", F.lit(1), F.greatest(F.size("_q_h") - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[at(i + k) for k in range(1, WINDOW)])))
    repeats = F.size(F.array_distinct("_q_windows")) < F.size("_q_windows")
    d = d.withColumn("_q_sorted", F.when(repeats, F.sort_array(
        F.transform("_q_windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    same = lambda s, k: F.coalesce(F.get("_q_sorted", k).getField("h") == s.getField("h"), F.lit(False))
    d = d.withColumn("_q_starts", F.sort_array(F.transform(
        F.filter("_q_sorted", lambda s, k: same(s, k - 1) | same(s, k + 1)), lambda s: s.getField("i"))))
    fresh = F.transform("_q_starts", lambda p, k: F.coalesce(
        F.least(F.lit(WINDOW), p - F.get("_q_starts", k - 1)), F.lit(WINDOW)))
    covered = F.aggregate(fresh, F.lit(0), lambda total, n: total + n)
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "_q_windows", "_q_sorted", "_q_starts")


def _common_words(d: DataFrame) -> DataFrame:
    """Histogram of the common words; each count is what taking the word out of the joined hits removes."""
    d = d.withColumn("_q_joined", F.concat(F.lit(" "), F.array_join("_q_hits", "  "), F.lit(" ")))
    whole = F.octet_length("_q_joined")
    counts = [
        ((whole - F.octet_length(F.replace("_q_joined", F.lit(f" {w} "), F.lit("")))) / F.lit(len(f" {w} ".encode()))).cast("int")
        for w in vocabulary()
    ]
    other = F.size("_q_w") - F.size("_q_hits")
    return d.withColumn("_q_words", F.array(*counts, other)).drop("_q_joined")


def language(label: Column) -> Column:
    """The code that a label begins with, in lower case; null if it begins with none."""
    return F.nullif(F.regexp_extract(F.lower(label), r"^([a-z]{2,3})(?![a-z0-9])", 1), F.lit(""))


def references(measured: DataFrame, rules: Rules, lang: str = "lang") -> DataFrame:
    """(language, chars, words): smoothed shares of both histograms."""
    names = {"chars": ("_q_chars", CHAR_BINS), "words": ("_q_words", len(vocabulary()) + 1)}
    code = language(F.col(lang)).alias("language")
    sums = [F.sum(F.col(c)[i]).alias(f"{out}{i}") for out, (c, n) in names.items() for i in range(n)]
    pooled = measured.where(~F.col("base_failed")).groupBy(code).agg(*sums).where("language IS NOT NULL")
    smooth = {out: F.array(*[F.col(f"{out}{i}") + rules.smoothing for i in range(n)]) for out, (_, n) in names.items()}
    return pooled.select("language", *[shares(c, 0.0).alias(out) for out, c in smooth.items()])


def shares(counts: Column, zero: float = 0) -> Column:
    """Shares of a histogram; an empty one stays empty of any."""
    total = F.aggregate(counts, F.lit(zero), lambda a, x: a + x)
    return F.zip_with(counts, F.array_repeat(total, F.size(counts)), lambda x, n: x / F.nullif(n, F.lit(0)))


def distance(own: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares, to 6 places."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(own, reference, lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    divergence = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2
    return F.round(F.sqrt(F.when(divergence < 0, F.lit(0.0)).otherwise(divergence)), 6)


def closest(own: Column, kind: str) -> Column:
    """Distance to the closest of the references in ``_q_refs``; null where ``own`` is."""
    return F.when(own.isNotNull(), F.array_min(F.transform("_q_refs", lambda r: distance(own, r[kind]))))


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "char_distance",
         "word_distance", "kept")


def judged(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang",
           carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the input columns, or of those in ``carry``) and the added columns."""
    columns = docs.columns if carry is None else carry
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    measured = saved(features(rows, "text").drop("text").withColumn("base_failed", failed), "quality")
    # one row of bounded size, known to every task
    refs = references(measured, rules).agg(F.collect_list(F.struct("chars", "words")).alias("all")).scalar()
    n_chars = reduce(lambda a, b: a + b, [F.col("_q_chars")[i] for i in range(CHAR_BINS)])
    odd = (F.coalesce(F.col("char_distance") > rules.max_char_distance, F.lit(False))
           | F.coalesce(F.col("word_distance") > rules.max_word_distance, F.lit(False)))
    # shares stand in a projection of their own: each distance reads them for every bin
    shared = measured.withColumns({
        "_q_refs": refs,
        "_q_char_shares": F.when(n_chars >= rules.char_guard, shares(F.col("_q_chars"))),
        "_q_word_shares": F.when(F.col("n_words") >= rules.word_guard, shares(F.col("_q_words"))),
    })
    return shared.withColumns({
        "char_distance": closest(F.col("_q_char_shares"), "chars"), "word_distance": closest(F.col("_q_word_shares"), "words"),
    }).withColumn("kept", ~F.col("base_failed") & ~odd).select("row", *ADDED)


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text", lang: str = "lang",
          carry: list[str] | None = None) -> DataFrame:
    """Input columns (or those in ``carry``) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, char_distance, word_distance and kept."""
    columns = [c for c in (docs.columns if carry is None else carry) if c not in ADDED]
    return judged(docs, rules, text, lang, carry).select(*[F.col(f"row.`{c}`") for c in columns], *ADDED)
