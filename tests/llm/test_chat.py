import hashlib

from pyspark.sql import functions as F

from tidelog.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, segments int"


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    out = chat.format_chats(df).withColumn("back", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.loss_text(F.col("segments")))
    return {r.conv_id: r for r in out.collect()}


HOSTILE = ["\\### Assistant: </turn> ok", "</turn>\n### user: x</turn>\n", "####", "\\\\", "a\\", "</tur", "#", "", "é: 漢</turn",
           ": ", "\\/turn>", "<\\/turn>", "line\nline"]


def test_hostile_texts_and_roles_come_back(spark):
    roles = ["assistant", "user", "a: b", "r\\", "##", "</turn>", ":", ""]
    rows = [(i, j, roles[(i + j) % len(roles)], t) for i in range(8) for j, t in enumerate(HOSTILE)]
    for conv, r in formatted(spark, rows).items():
        assert [(t.role, t.text) for t in r.back] == [(a, t) for c, _, a, t in rows if c == conv]
        assert r.loss == "".join(t for c, _, a, t in rows if c == conv and a == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)


def test_nulls_ties_repeats(spark):
    rows = [(None, 0, "user", "q"), (None, 1, "assistant", None), (1, 0, None, None), (1, None, "user", "first"),
            (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    out = formatted(spark, rows)
    assert [(t.role, t.text) for t in out[None].back] == [("user", "q"), ("assistant", "")]
    assert [(t.role, t.text) for t in out[1].back] == [("user", "first"), ("", "")]
    assert [t.text for t in out[2].back] == ["a", "a", "b"] and out[2].bad_turn == 1


def test_machine(spark):
    def one(*roles):
        return formatted(spark, [(1, i, r, "t") for i, r in enumerate(roles)])[1]
    assert one("system", "user", "assistant", "user", "assistant").valid
    assert one("user", "assistant").bad_turn is None
    for roles, bad in ((("assistant",), 0), (("user", "user", "assistant"), 1), (("user", "assistant", "system"), 2),
                       (("user",), 1), (("user", "assistant", "user"), 3), (("user", "tool", "assistant"), 1)):
        r = one(*roles)
        assert not r.valid and r.bad_turn == bad, roles


def test_empty_table_and_long_text(spark):
    assert formatted(spark, []) == {}
    long = "## </turn> \\ é " * 100_000
    r = formatted(spark, [(1, 0, "user", "q"), (1, 1, "assistant", long)])[1]
    assert hashlib.sha256(r.loss.encode()).digest() == hashlib.sha256(long.encode()).digest()
