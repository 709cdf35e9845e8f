from __future__ import annotations

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
TRICKY = ["\\### Assistant: </turn> ok", "#####", "<next></turn>\n", "\\", "\\\\<\\next>", "", "a\nb", "<\\/turn>", "### user\n"]


def read(df):
    chats = chat.format_chats(df)
    out = chats.select("conv_id", "formatted", "loss_mask", chat.read_turns(F.col("formatted")).alias("turns"),
                       chat.read_learned(F.col("formatted"), F.col("loss_mask")).alias("learned"))
    return {r.conv_id: r for r in out.collect()}


def test_control_strings_survive(rows):
    data = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(TRICKY)]
    row = read(rows(SCHEMA, *data))[1]
    assert [(t.role, t.text) for t in row.turns] == [(r, t) for _, _, r, t in data]
    assert list(row.learned) == [t for _, _, r, t in data if r == "assistant"]
    assert row.formatted.count("</turn>") == len(data)


def test_adjacent_turns_of_one_role_share_a_block(rows):
    chats = chat.format_chats(rows(SCHEMA, (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")))
    row = chats.first()
    assert row.formatted == "### user\na<next>b</turn>\n### assistant\nc</turn>\n" and row.n_blocks == 2
    span = row.loss_mask[0]
    assert row.formatted[span.start : span.start + span.length] == "c"


def test_nulls_ties_repeats_and_clashing_columns(spark):
    data = [(1, None, "user", None), (1, 0, None, "x"), (1, 0, "a", "y"), (1, 0, "a", "y"), (None, 0, "user", "z")]
    df = spark.createDataFrame(data, SCHEMA).withColumns({"formatted": F.lit("old"), "n_blocks": F.lit(9)})
    got = read(df)
    assert [(t.role, t.text) for t in got[1].turns] == [("user", ""), ("", "x"), ("a", "y"), ("a", "y")]
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "z")]
    assert read(df.orderBy("text")) == got


def test_empty_table_and_long_text(rows, spark):
    assert chat.digests(chat.format_chats(spark.createDataFrame([], SCHEMA))).count() == 0
    text = "<next>é#### " * 40_000
    row = chat.digests(chat.format_chats(rows(SCHEMA, (1, 0, "assistant", text)))).first()
    assert row.loss_chars == len(text) and row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a b/\n"]), st.text("\\#</>turnex \né😀", max_size=30)), min_size=1, max_size=12))
def test_round_trip(spark, turns):
    data = [(5, i, r, t) for i, (r, t) in enumerate(turns)]
    row = chat.digests(chat.format_chats(spark.createDataFrame(data, SCHEMA))).first()
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    learned = "".join(t for r, t in turns if r == "assistant")
    assert row.n_turns == len(turns) and row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest() and row.loss_chars == len(learned)
