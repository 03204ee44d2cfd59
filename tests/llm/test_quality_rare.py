"""References of rare and of many languages."""

from llm_cases import documents
from pyspark.sql import functions as F

from cartwright.llm import quality_rules

ENGLISH = "the cat sat on the mat and was with it for a day in that house by the sea as is ".split()
RUSSIAN = "и в не на что он как это по но из у за от так же для вы до бы мы ты она они дом река лес утро вода окно".split()
JUNK = " ".join(f"w{k}$$$###%%%" for k in range(300))


def varied(words, k):
    return " ".join(f"{w}{i + k}" if i % 3 == 2 else w for i, w in enumerate(words * 15))


def test_rare_language_is_kept(spark):
    """One document of a language is judged against itself; what fares how does not depend on the other rows."""
    rows = [(i, varied(ENGLISH, i), "en") for i in range(300)]
    rows += [(1000, varied(RUSSIAN, 0), "ru"), (1001, JUNK, "en"), (1002, JUNK, None), (1003, JUNK, "unknown")]
    got = {r.doc_id: r for r in quality_rules.judge(documents(spark, rows)).collect()}
    assert got[1000].kept and got[1000].char_distance < 0.05 and got[1000].word_distance < 0.2
    assert got[0].kept and got[0].char_distance is not None
    assert not any(got[i].kept for i in (1001, 1002, 1003)) and got[1001].char_distance > 0.3
    few = {r.doc_id: r.kept for r in quality_rules.judge(documents(spark, rows[200:])).collect()}
    assert few == {i: got[i].kept for i in few}


def test_three_hundred_languages(spark):
    """All judged alike, with labels in several spellings; none is too rare."""
    codes = [a + b + c for a in "abcdefg" for b in "abcdefg" for c in "abcdefg"][:300]
    rows = [(i, varied(ENGLISH, i), c.upper() if i % 2 else f"{c}-XX") for i, c in enumerate(codes)]
    rows.append((999, JUNK, codes[0]))
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert all(got[i].kept and got[i].char_distance is not None and got[i].word_distance is not None for i in range(300))
    assert not got[999].kept
    plan = quality_rules.judge(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "abc" not in plan  # references are data, not literals


def test_codes(spark):
    labels = ["en", "EN", "en-US", "deu_DE", "e", "engl", "en1", "", None, " en", "zh.x"]
    codes = spark.createDataFrame([(x,) for x in labels], "lang string").select(quality_rules.language(F.col("lang")).alias("code"))
    assert [r.code for r in codes.collect()] == ["en", "en", "en", "deu", None, None, None, None, None, None, "zh"]
