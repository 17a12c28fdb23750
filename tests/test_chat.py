"""Rendered conversations keep every message."""

from quarry.operators.chat import render_chat, render_messages


def test_messages_without_content_are_kept(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, None, "x"), (1, None, "system", "s"), (2, 0, "user", None)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = {r.conv_id: (r.turns, r.rendered) for r in render_chat(df, add_generation=False, chunk_turns=2).collect()}
    assert got[1] == (4, "<|system|>\ns\n<|user|>\nhi\n<|assistant|>\n\n<||>\nx\n") and got[2] == (1, "<|user|>\n\n")
    m = spark.sql("SELECT array(struct('user' AS role, string(null) AS content)) AS m")
    assert m.select(render_messages("m").alias("x")).first().x == "<|user|>\n\n<|assistant|>\n"
