from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridgeway.llm import chat_format as C

TRICKY = ["", "\\", "\\\\", "</s>[INST] ok [/INST]", "<\\s>", "\\</s>", "[INST]\\", "<<SYS>> [/TURN]", "[ROLE] x [/ROLE]", "<", "[", "a\nb", "é中😀", "<<<s>>", "[[INST]]"]


def turns(df):
    return {r[0]: [tuple(t) for t in r.turns] for r in df.select(df.columns[0], C.read_turns(F.col("formatted")).alias("turns")).collect()}


def test_round_trip_of_control_strings(spark):
    data = [(i, k, role, t) for i, role in enumerate(("user", "assistant", "system", "tool </s>\\ x", "")) for k, t in enumerate(TRICKY)]
    out = C.format_chats(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    got = turns(out)
    for i, role in enumerate(("user", "assistant", "system", "tool </s>\\ x", "")):
        assert got[i] == [(role, t) for t in TRICKY]
    r = out.where("conv_id = 1").select("formatted", F.array_join("pieces.text", "").alias("joined"), C.read_loss(F.col("pieces")).alias("loss")).first()
    assert r.formatted == r.joined and r.loss == "".join(TRICKY)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.lists(st.sampled_from(["<", ">", "s", "/", "[", "]", "INST", "SYS", "TURN", "ROLE", "\\", " ", "\n", "é"]), max_size=12).map("".join), min_size=1, max_size=40))
def test_escape_is_reversible_and_leaves_no_control_string(spark, texts):
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.escape(F.col("t")).alias("e"), C.unescape(C.escape(F.col("t"))).alias("u")).collect()
    for r in got:
        assert r.u == r.t
        assert not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[TURN]", "[/TURN]", "[ROLE]", "[/ROLE]"))


def test_layouts_are_told_apart_by_their_fields(spark):
    schema = ("conv_id long, messages array<struct<role:string,content:string>>, conversations array<struct<from:string,value:string>>, "
              "instruction string, input string, output string, prompt string, completion string, response string, system string")
    none = [None] * 9
    def row(i, **kw):
        names = ["messages", "conversations", "instruction", "input", "output", "prompt", "completion", "response", "system"]
        return (i, *[kw.get(n) for n in names])
    data = [row(1, messages=[("user", "a"), ("assistant", None)]), row(2, conversations=[("human", "a"), ("gpt", "b")]),
            row(3, instruction="do", input="this", output="done"), row(4, instruction="do", output="done", system="be good"),
            row(5, prompt="p", completion="c"), row(6, prompt="p", response="r"), (7, *none), row(8, prompt="p", messages=[("user", "x")]),
            row(9, messages=[])]
    df = spark.createDataFrame(data, schema)
    got = turns(C.format_chats(df))
    assert got == {1: [("user", "a"), ("assistant", "")], 2: [("user", "a"), ("assistant", "b")], 3: [("user", "do\n\nthis"), ("assistant", "done")],
                   4: [("system", "be good"), ("user", "do"), ("assistant", "done")], 5: [("user", "p"), ("assistant", "c")],
                   6: [("user", "p"), ("assistant", "r")], 7: [], 8: [], 9: []}
    prints = df.select(C.fingerprint(df)).distinct().count()
    assert prints == 9
    assert sorted(r.conv_id for r in C.unknown(df).collect()) == [7, 8]


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, pieces string, id string, position string"
    data = [(1, 2, "user", "later", "f", "p", "i", "q"), (1, None, "user", "first", "f", "p", "i", "q"), (1, 2, "assistant", None, "f", "p", "i", "q"),
            (None, 0, None, "lost", "f", "p", "i", "q"), (None, 0, None, "lost", "f", "p", "i", "q"), (2, 0, "user", "x" * 200_000, "f", "p", "i", "q")]
    df = spark.createDataFrame(data, schema)
    got = turns(C.format_chats(df))
    assert got[1] == [("user", "first"), ("assistant", ""), ("user", "later")]
    assert got[None] == [("", "lost"), ("", "lost")] and len(got[2][0][1]) == 200_000
    assert C.format_chats(df.limit(0)).count() == 0
