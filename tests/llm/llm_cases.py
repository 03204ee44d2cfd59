"""Small tables with the awkward cases: nulls, empty and long texts, repeated rows, clashing names."""

from pyspark.sql import types as T

LONG = "word and more words of the text " * 3000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs into the forest of the night.", "en"),
    (2, "The quick brown fox jumps over the lazy dog and runs into the forest of the night.", "en"),
    (3, None, "en"), (4, "", "de"), (5, " \n\t ", None), (6, "123 456 --- !!!", "fr"),
    (7, "Der schnelle braune Fuchs springt über den faulen Hund und läuft in den Wald der Nacht.", "de"),
    (7, "Der schnelle braune Fuchs springt über den faulen Hund und läuft in den Wald der Nacht.", "de"),
    (None, "Released under the MIT License. No other general public license applies.", "en"),
    (8, LONG, "en"), (9, "é" * 3000, "fr"), (10, "a\x0bb\x0cc\r\nd e f g\nd e f g\nd e f g", "en"),
]
# names that operators add or work with
CLASHES = ("text_hash", "shard", "host", "n_words", "kept", "score", "_text", "fp", "id", "ids", "size", "row", "u", "_q_0")


def documents(spark, rows=TEXTS, clashes=False):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
              T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    data = [(i, t, lang, "src", None if t is None else len(t)) for i, t, lang in rows]
    if clashes:
        fields += [T.StructField(c, T.StringType()) for c in CLASHES]
        data = [(*r, *("x" for _ in CLASHES)) for r in data]
    return spark.createDataFrame(data, T.StructType(fields))
