"""Answer extraction and scoring (B14-B16), tags and keys (B1, B3-B5, B19), lengths."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T

# (answer, truth, expected score) - the 19 published cases; case 4 has no marker.
SCORE_CASES = [
    ("e2e4", "e2e4", 1.0), ("d7d5", "d7d5", 1.0), ("g1f3", "e2e4", 0.0), (None, "e2e4", 0.0),
    ("h1h8", "h1h3", 0.0), ("e2e3", "e2e4", 0.0), ("f2e4", "e2e4", 0.0), ("a1h8", "e2e4", 0.0),
    ("e1g1", "e1c1", 0.0), ("e1c1", "e1g1", 0.0), ("e8g8", "e8c8", 0.0), ("e1f1", "e1g1", 0.0),
    ("e7e8q", "e7e8r", 0.0), ("e7e8r", "e7e8q", 0.0), ("e7f8q", "e7e8q", 0.0), ("d7e8q", "e7e8q", 0.0),
    ("d7f8q", "e7e8q", 0.0), ("e5d6", "e5d6", 1.0), ("e5d6", "e5f6", 0.0),
]


def test_published_score_cases(spark):
    rows = [
        ("FINAL_ANSWER: " + a if a else "The best move is e2e4 to control the center.", t, e)
        for a, t, e in SCORE_CASES
    ]
    df = spark.createDataFrame(rows, "resp string, truth string, expected double")
    s = T.answer_score("resp", "truth")
    out = df.select("expected", s["score"].alias("score"), s["binary_score"].alias("b"),
                    T.is_correct("resp", "truth").alias("ok")).collect()
    assert len(out) == 19
    for r in out:
        assert r.score == r.expected and r.b == r.expected and r.ok == (r.expected == 1.0)


M = "FINAL_ANSWER:"
EXTRACT_CASES = [
    ("final_answer:E7E8Q", "e7e8q"),
    (M + "\n\ne2e4xyz and then " + M + " a1a2", "e2e4"),
    (M + "\u00a0e2e4", "e2e4"),
    (M + "\u2003e2e4", "e2e4"),
    (M + "\u0085e2e4", "e2e4"),
    (M + "\u001ce2e4", "e2e4"),
    ("FINAL_AN\u017fWER: e2e4", "e2e4"),
    ("F\u0131NAL_ANSWER: e2e4", "e2e4"),
    ("F\u0130NAL_ANSWER: e2e4", "e2e4"),
    (M + "\u180ee2e4", None),
    (M + "\u200be2e4", None),
    (M + " **e2e4**", None),
    ("FINAL_ANSWER e2e4", None),
    (M + " e7e8k", "e7e8"),
    (M + " i2e4", None),
    ("", None),
    (None, None),
]


def test_extraction_edges(spark):
    df = spark.createDataFrame(EXTRACT_CASES, "resp string, expected string")
    for r in df.select("resp", "expected", T.extract_answer("resp").alias("got")).collect():
        assert r.got == r.expected, (r.resp, r.got, r.expected)


def test_null_inputs_score_zero(spark):
    df = spark.createDataFrame([(None, "e2e4"), ("FINAL_ANSWER: e2e4", None), ("", "e2e4")], "r string, t string")
    assert [x.s for x in df.select(T.answer_score("r", "t")["score"].alias("s")).collect()] == [0.0, 0.0, 0.0]


def test_tags_and_keys(spark):
    df = spark.createDataFrame(
        [(" mate  fork\tpin ", "4k3/8/8/8/8/8/8/4K3 w - - 9 30", "mate_in_2", "['a', 'b']"),
         (None, None, "x", '["c"]')],
        "t string, fen string, name string, lst string",
    )
    out = df.select(T.tags("t").alias("tags"), T.prefix_key("fen").alias("key"),
                    T.last_segment("name").alias("seg"), T.parse_list("lst").alias("l")).collect()
    assert out[0].tags == ["mate", "fork", "pin"] and out[1].tags == []
    assert out[0].key == "4k3/8/8/8/8/8/8/4K3 w - -" and out[1].key is None
    assert out[0].seg == "2" and out[1].seg == "x"
    assert out[0].l == ["a", "b"] and out[1].l == ["c"]


def test_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("  \n",), (" x ",)], "t string")
    assert [r.b for r in df.select(T.is_blank("t").alias("b")).collect()] == [True, True, True, False]


def test_merge_metadata_later_wins(spark):
    df = spark.createDataFrame([('{"type": "mate", "k": 1}', "fen1")], "j string, fen string")
    base = F.create_map(F.lit("fen"), F.col("fen"), F.lit("type"), F.lit("short"))
    m = df.select(T.merge_metadata(base, "j").alias("m")).first().m
    assert m == {"fen": "fen1", "type": "mate", "k": "1"}


def test_lengths(spark):
    df = spark.createDataFrame([("a b  c d e",), ("x",)], "t string")
    out = df.select(T.length_flags("t", 5).alias("f"), T.truncate_tokens("t", 3).alias("tr")).collect()
    assert out[0].f.num_tokens == 5 and out[0].f.clipped and out[0].tr == "a b c"
    assert out[1].f.num_tokens == 1 and not out[1].f.clipped
    with pytest.raises(Exception):
        df.select(T.assert_length("t", 2)).collect()
    assert df.select(T.assert_length("t", 5).alias("x")).count() == 2


def test_arrow_token_counter(spark):
    counter = T.arrow_tokens(lambda t: [len(w) for w in t.split()])
    df = spark.createDataFrame([("a bb ccc",), (None,)], "t string")
    out = df.select(T.length_flags("t", 3, counter=counter).alias("f")).collect()
    assert out[0].f.num_tokens == 3 and out[0].f.clipped and out[1].f.num_tokens is None
