"""Sources and sinks (A1-A10)."""

import os

import pytest
from pyspark.sql import functions as F

from quarry.sources import io


def test_csv_roundtrip_multiline_and_arrays(spark, tmp_dir):
    df = spark.createDataFrame(
        [("p1", "fen a", "e2e4 e7e5", 1500, "fork pin", ["fork", "pin"], "line one\nline \"two\"")],
        "PuzzleId string, FEN string, Moves string, Rating int, Themes string, themes_list array<string>, cot string",
    )
    path = os.path.join(tmp_dir, "csv")
    io.write_records(df, path, "csv")
    schema = "PuzzleId string, FEN string, Moves string, Rating int, Themes string, themes_list string, cot string"
    back = io.read_records(spark, path, schema, "csv", multi_line=True)
    r = back.first()
    assert back.count() == 1 and r.cot == "line one\nline \"two\"" and r.Rating == 1500
    assert back.select(F.from_json("themes_list", "array<string>").alias("l")).first().l == ["fork", "pin"]


def test_append_and_json_nulls(spark, tmp_dir):
    df = spark.createDataFrame([("a", None)], "k string, v string")
    p = os.path.join(tmp_dir, "pq")
    io.write_records(df, p, "parquet")
    io.write_records(df, p, "parquet", mode="append")
    assert io.read_records(spark, p, fmt="parquet").count() == 2
    j = os.path.join(tmp_dir, "js")
    io.write_records(spark.createDataFrame([("é", None)], "k string, v string"), j, "json")
    text = "".join(open(os.path.join(j, f), encoding="utf-8").read() for f in os.listdir(j) if f.endswith(".json"))
    assert '"v":null' in text and "é" in text


def test_materialize_reuses_complete_output(spark, tmp_dir):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    p = io.cache_path(tmp_dir, "half", seed=42)
    assert p.endswith("half-seed42")
    assert io.materialize(spark, build, p).count() == 5
    assert io.materialize(spark, build, p).count() == 5
    assert len(calls) == 1
    both = io.materialize_all(spark, lambda: {"a": spark.range(2), "b": spark.range(3)},
                              {"a": os.path.join(tmp_dir, "a"), "b": os.path.join(tmp_dir, "b")})
    assert both["a"].count() == 2 and both["b"].count() == 3


def test_benchmark_positional_binding_and_convert(spark, tmp_dir):
    cols = [f"c{i}" for i in range(9)]
    row = tuple(["x", "mate_in_2", "y", "fenZ", "z", "w", "e2e4", "v", '{"a": 1}'])
    src = os.path.join(tmp_dir, "bench")
    spark.createDataFrame([row], ", ".join(f"{c} string" for c in cols)).write.parquet(src)
    b = io.load_benchmark(spark, src).first()
    assert (b.task, b.fen, b.answer, b.metadata) == ("mate_in_2", "fenZ", "e2e4", '{"a": 1}')
    out = io.convert(spark, src, os.path.join(tmp_dir, "bench_json"), "parquet", "json")
    assert out.count() == 1


def test_csv_is_bound_by_header_names(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('GameUrl,Themes,Rating,PuzzleId,Moves,FEN,Extra Tags\nhttp://x,"fork, pin",1500,p1,e2e4 e7e5,fen a,"a ""q"" b"\n')
    r = io.read_records(spark, path, io.PUZZLE_SCHEMA)
    assert r.columns == ["PuzzleId", "FEN", "Moves", "Rating", "Themes", "GameUrl", "Extra Tags"]
    assert tuple(r.first()) == ("p1", "fen a", "e2e4 e7e5", 1500, "fork, pin", "http://x", 'a "q" b')
    with pytest.raises(ValueError, match="Absent"):
        io.read_records(spark, path, "PuzzleId string, Absent int")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        io.read_records(spark, path, "Themes int").collect()


def test_csv_without_quoted_newlines_is_split(spark, tmp_dir):
    path = os.path.join(tmp_dir, "big.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("a,b\n" + "".join(f"{i},x{i}\n" for i in range(50_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        df = io.read_records(spark, path, "a int, b string")
        assert df.rdd.getNumPartitions() > 3 and df.count() == 50_000 and df.agg(F.sum("a")).first()[0] == sum(range(50_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_parts_of_one_output(spark, tmp_dir):
    calls = []

    def build():
        calls.append(1)
        return spark.range(10).select("id", F.when(F.col("id") < 4, "A").otherwise("B").alias("half"))

    for _ in range(2):
        got = io.materialize_split(spark, build, os.path.join(tmp_dir, "halves"), "half", ["A", "B"])
        assert got["A"].count() == 4 and got["B"].columns == ["id"]
    assert len(calls) == 1
    io.remove(spark, os.path.join(tmp_dir, "halves"))
    assert not os.path.exists(os.path.join(tmp_dir, "halves"))


def test_benchmark_csv_keeps_json(spark, tmp_dir):
    from quarry.functions.text import merge_metadata

    path = os.path.join(tmp_dir, "bench_csv")
    row = tuple(["x", "mate_in_2", "y", "fen\nZ", "z", "w", "e2e4", "v", '{"a": "1, 2", "b": "\\"q\\""}'])
    io.write_records(spark.createDataFrame([row], ", ".join(f"c{i} string" for i in range(9))), path, "csv")
    b = io.load_benchmark(spark, path, "csv", multi_line=True)
    m = b.select(merge_metadata(F.create_map(F.lit("a"), F.lit("base")), "metadata").alias("m"), "fen").first()
    assert (m.m, m.fen) == ({"a": "1, 2", "b": '"q"'}, "fen\nZ")


def test_materialize_by_content_rebuilds_what_changed(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    spark.range(5).write.parquet(src)
    build = lambda k=1: lambda: spark.read.parquet(src).select((F.col("id") * k).alias("v"))
    get = lambda b, **p: sorted(r.v for r in io.materialize(spark, b, out, inputs=[src], **p).collect())
    assert get(build()) == [0, 1, 2, 3, 4] and len(os.listdir(out)) == 1
    assert get(build()) == [0, 1, 2, 3, 4] and len(os.listdir(out)) == 1  # reused
    assert get(build(2)) == [0, 2, 4, 6, 8] and len(os.listdir(out)) == 2  # another plan
    assert get(build(), model="b") == [0, 1, 2, 3, 4] and len(os.listdir(out)) == 3  # another parameter
    spark.range(5, 7).write.mode("append").parquet(src)
    assert get(build()) == [0, 1, 2, 3, 4, 5, 6] and len(os.listdir(out)) == 4  # a changed input is never served stale
    other = spark.newSession()
    df = other.read.parquet(src).select((F.col("id") * 1).alias("v"))
    assert io.content_key(df, [src]) == io.content_key(build()(), [src])
