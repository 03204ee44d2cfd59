"""License scan by diagonal voting.

Every pair of neighbouring words of every text is hashed and joined to the same
pairs of the license templates (a fixed table, broadcast). A hit votes for the
diagonal "text position minus template position". Votes are summed by diagonal,
neighbouring diagonals of one template (words inserted or left out) are merged,
and a span counts when enough of its template's pairs, compared word by word, were
found within a span not much longer than the template. Phrases count only whole,
on one diagonal.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case.

Defined results: a null or empty text has no words, no labels and score 0; rows
alike in key and text get equal results, once per row; a null key is a key like
any other. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Fixed values: (label, phrase) that count only whole.
PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
# Fixed values: (label, opening words of a license or notice).
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation "
            "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in "
               "compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc", "this work is licensed under a creative commons attribution 4 0 international license"),
)
MARK = -1


@dataclass(frozen=True)
class Votes:
    least_votes: int = 2
    widest_step: int = 4
    least_share: float = 0.7
    longest_span: float = 1.5


def template_pairs() -> list[tuple[int, int, str]]:
    """(template, position, pair of words); phrases come first."""
    out = []
    for i, (_, text) in enumerate(PHRASES + TEMPLATES):
        words = text.split()
        out += [(i, k, f"{a} {b}") for k, (a, b) in enumerate(zip(words, words[1:]))]
    return out


def words_of(text: Column) -> Column:
    # lower() maps one sign outside ASCII to an ASCII letter, the Kelvin sign; it is taken out of the way
    return F.array_remove(F.split(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\ue000"))), NO_WORD), "")


def hits(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text_hash, template, tpos, pos, copies); one row with template MARK and pos = number of words per document."""
    spark: SparkSession = docs.sparkSession
    pairs = spark.createDataFrame(template_pairs() + [(MARK, 0, "")], "template int, tpos int, pair string")
    pairs = F.broadcast(pairs.withColumn("h", F.xxhash64("pair")))
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"), words_of(F.col(text)).alias("w"))
    inner = F.transform(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))),
                        lambda x, i: F.concat_ws(" ", x, F.get("w", i + 1)))
    rows = rows.select("id", "text_hash", F.size("w").alias("n_words"), inner.alias("g"))
    # one more entry, the empty pair behind all others, carries the number of words
    spread = rows.select("id", "text_hash", "n_words", F.posexplode(F.array_append("g", F.lit(""))).alias("at", "gram"))
    found = spread.withColumn("h", F.xxhash64("gram")).join(pairs, "h").where(F.col("gram") == F.col("pair"))
    at = F.when(F.col("template") == MARK, F.col("n_words")).otherwise(F.col("at"))
    return found.select("id", "text_hash", "template", "tpos", at.alias("pos")).groupBy(
        "id", "text_hash", "template", "tpos", "pos").agg(F.count("*").alias("copies"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", votes: Votes = Votes()) -> DataFrame:
    """One row per document: the key, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    phrases = len(PHRASES)
    sizes = [len(t.split()) - 1 for _, t in PHRASES + TEMPLATES]
    n_pairs = F.get(F.array(*map(F.lit, sizes)), F.col("template"))
    label = F.get(F.array(*[F.lit(name) for name, _ in PHRASES + TEMPLATES]), F.col("template"))
    doc = ["id", "text_hash"]
    diagonals = hits(docs, key, text).groupBy(
        *doc, "template", F.when(F.col("template") == MARK, 0).otherwise(F.col("pos") - F.col("tpos")).alias("diagonal")
    ).agg(F.collect_set("tpos").alias("found"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.max("copies").alias("copies"))
    whole = (F.col("template") >= phrases) & (F.size("found") >= votes.least_votes)
    kept = diagonals.where((F.col("template") == MARK) | whole | (
        F.col("template").between(0, phrases - 1) & (F.size("found") == n_pairs)))
    order = Window.partitionBy(*doc, "template").orderBy("diagonal")
    opens = (F.col("template") < phrases) | F.coalesce(
        F.col("diagonal") - F.lag("diagonal").over(order) > votes.widest_step, F.lit(True))
    grouped = kept.withColumn("_opens", opens.cast("int")).withColumn("span", F.sum("_opens").over(order))
    spans = grouped.groupBy(*doc, "template", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("n"), F.min("first").alias("first"),
        F.max("last").alias("last"), F.max("copies").alias("copies"))
    share = F.col("n") / n_pairs
    good = (F.col("template") >= 0) & (share >= votes.least_share) & (
        F.col("last") - F.col("first") + 2 <= votes.longest_span * (n_pairs + 1))
    base = F.col("template").between(0, phrases - 1)
    names = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, label))), ",")
    per_doc = spans.groupBy(*doc).agg(
        F.max(F.when(F.col("template") == MARK, F.col("last"))).cast("long").alias("n_words"),
        F.max(F.when(F.col("template") == MARK, F.col("copies"))).alias("_copies"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        names(base).alias("base_labels"), names(good).alias("labels"),
        F.round(F.coalesce(F.max(F.when(good, share)), F.lit(0.0)), 6).alias("score"))
    return per_doc.select(F.col("id").alias(key), *[c for c in per_doc.columns if c not in (*doc, "_copies")],
                          F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).drop("_copy")
