"""Transcripts whose turns run on inside one text."""

from collections import Counter

from cartwright.llm import chat_format


def learned(spark, table):
    pieces = chat_format.raw_transcripts(table)
    return pieces, chat_format.learn(chat_format.lines(pieces, "conv_id", "turn", "text", carry="role"))


def recovered(parsed):
    return Counter((r.conv_id, r.turn, r.role, r.text) for r in parsed.collect())


def test_turns_inside_one_text(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    pieces, model = learned(spark, table)
    want = Counter((r.conv_id, r.turn, r.role, r.text.strip("\n")) for r in table.collect())
    joined = chat_format.run_on(pieces.drop("role"))
    assert joined.count() < table.count() / 2
    got = recovered(chat_format.parse(joined, model))
    print("turns", sum(want.values()), "found", sum((want & got).values()),
          "conversations", len({k[0] for k in want}), "inexact", len({k[0] for k in (want - got) | (got - want)}))
    assert sum((want & got).values()) >= 0.99 * sum(want.values())
    assert got == recovered(chat_format.parse(pieces.drop("role"), model))


def test_blocks_hold_a_fixed_number_of_lines(spark, monkeypatch):
    """Null ids and one shared turn number: many blocks of few lines, and the result of one block."""
    rows = [(None if k % 2 else 7, None if k % 3 else 1, f"Q: number {k}\n\nstill {k}\nmore\n\n\nA: answer {k}\n") for k in range(60)]
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    _, model = learned(spark, table)
    odd = spark.createDataFrame(rows + rows[:9] * 3, "conv_id long, turn long, text string")

    def joined(parsed):
        turns = {}
        for r in sorted(parsed.collect(), key=lambda r: (str(r.conv_id), r.turn, r.part)):
            turns.setdefault((r.conv_id, r.turn, r.role), []).append(r.text)
        return {k: "\n".join(v).strip("\n") for k, v in turns.items()}, max(len(v) for v in turns.values())

    whole, _ = joined(chat_format.parse(odd, model))
    monkeypatch.setattr(chat_format, "BLOCK", 5)
    sizes = chat_format.lines(odd, "conv_id", "turn", "text").groupBy("conv", "block").count().collect()
    assert max(r["count"] for r in sizes) <= 5 and len(sizes) > 80
    parts, most = joined(chat_format.parse(odd, model))
    assert parts == whole and most > 1


def test_marker_words_inside_turns_stay(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    _, model = learned(spark, table)
    said = "Here it comes.\nAnswer: 42\nContext: none\nmodel\na\nand so on."
    text = f"Q: what is it\n\nA: {said}\n\nQ: Why?\nQ: again?\n"
    odd = spark.createDataFrame([(1, 0, text)], "conv_id long, turn long, text string")
    got = [(r.role, r.text) for r in sorted(chat_format.parse(odd, model).collect(), key=lambda r: r.turn)]
    assert got == [("user", "what is it"), ("assistant", said), ("user", "Why?\nQ: again?")]
