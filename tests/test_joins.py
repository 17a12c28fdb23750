"""Resume and exclusion (J1-J4, G1-G3) and row status."""

from quarry.operators import joins
from quarry.operators.scoring import status_counts
from quarry.plans.flows import classify


def test_pending_plus_done_is_input(spark):
    df = spark.createDataFrame([(i, f"p{i}") for i in range(50)], "pos int, PuzzleId string")
    done = spark.createDataFrame([(f"p{i}",) for i in range(0, 50, 3)] + [("p3",), ("zz",)], "PuzzleId string")
    pend = {r.PuzzleId for r in joins.pending(df, done).collect()}
    done_ids = {r.PuzzleId for r in done.collect()} & {f"p{i}" for i in range(50)}
    assert pend | done_ids == {f"p{i}" for i in range(50)} and not (pend & done_ids)
    target = joins.pending(df, done, order_cols=["pos"], max_rows=10).collect()
    assert sorted(r.pos for r in target) == [1, 2, 4, 5, 7, 8]


def test_exclude_overlap_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    test = spark.createDataFrame([("a",), ("a",)], "k string")
    assert sorted(r.v for r in joins.exclude_overlap(df, test, "k").collect()) == [2, 3]
    flags = {r.v: r.overlaps for r in joins.flag_overlap(df, test, "k").collect()}
    assert flags == {1: True, 2: False, 3: False}


def test_line_rule_has_no_cut(spark):
    docs = spark.createDataFrame([(1, "short\nx\nend"), (2, "nothing shared\n\n"), (3, None), (4, "")], "id int, text string")
    test = spark.createDataFrame([("intro\nx\n",), (None,), ("",)], "text string")
    kept = joins.exclude_passages(docs, "id", "text", test, "text", rule="line")
    assert sorted(r.id for r in kept.collect()) == [2, 3, 4]
    flags = {r.id: r.overlaps for r in joins.flag_passages(docs, "id", "text", test, "text").collect()}
    assert flags == {1: True, 2: False, 3: False, 4: False}
    # no leak: a semi join of what is kept with the test lines is empty
    assert joins.lines(kept, "text").join(joins.lines(test, "text").select("_seg"), "_seg", "left_semi").count() == 0


def test_passage_rule_equals_substring_search(spark):
    import random

    rng = random.Random(4)
    vocabulary = ["a", "bb", "ccc", "d e", "f\ng", "h\u00a0i", "\u00e9"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(80)]
    passages = []
    for _ in range(25):
        t = rng.choice(texts)
        i = rng.randint(0, max(0, len(t) - 10))
        passages.append(t[i : i + rng.randint(6, 60)])
    passages += [None, "", "   "]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(1000, None)], "id int, text string")
    test = spark.createDataFrame([(p,) for p in passages], "text string")
    long = [p for p in passages if p and len(p.split()) > 2]
    short = [p.split() for p in passages if p and 0 < len(p.split()) <= 2]

    def hit(t):
        w = t.split()
        return any(p in t for p in long) or any(s == w[k : k + len(s)] for s in short for k in range(len(w)))

    got = {r.id for r in joins.passage_ids(docs, "id", "text", test, "text").collect()}
    assert got == {i for i, t in enumerate(texts) if hit(t)} and got


def test_set_ops(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2,)], "k int")
    assert joins.distinct_keys(a, "k").count() == 2
    assert joins.difference_by_key(a, b, "k").count() == 2  # row-preserving
    assert joins.append(a, b).count() == 4


def test_status_order_invalid_before_excluded(spark):
    # FIXTURES section 5, re-aimed: text blank or unlabelled -> invalid, checked before overlap
    line = "this line is long enough to matter"
    docs = spark.createDataFrame(
        [(1, line), (2, "other text that is not in the test"), (3, line), (4, " "), (5, line)],
        "id int, text string",
    )
    done = spark.createDataFrame([(1,), (2,), (4,), (5,)], "id int")
    test = spark.createDataFrame([(line,)], "text string")
    st = {r.id: r.status for r in classify(docs, "id", "text", done, test).collect()}
    assert st == {1: "excluded", 2: "kept", 3: "invalid", 4: "invalid", 5: "excluded"}
    counts = {r.status: r.rows for r in status_counts(classify(docs, "id", "text", done, test)).collect()}
    assert counts == {"excluded": 2, "kept": 1, "invalid": 2}


def test_dense_prefix_is_a_filter_equal_to_top_n(spark):
    from pyspark.sql import functions as F

    from quarry.operators import order

    df = spark.range(1, 201).select(F.col("id").alias("rank"), (F.col("id") * 7 % 13).alias("v")).repartition(5)
    dense = order.first_n(df, ["rank"], 37, dense=True)
    assert "TakeOrdered" not in dense._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.rank for r in dense.collect()) == list(range(1, 38))
    assert sorted(r.rank for r in order.first_n(df, ["rank"], 37).collect()) == list(range(1, 38))
    done = spark.createDataFrame([(3,), (5,)], "rank long")
    assert len(joins.pending(df, done, "rank", ["rank"], 10, dense=True).collect()) == 8


def test_pending_against_a_landed_done_table(spark, tmp_dir):
    from quarry.operators import done

    df = spark.createDataFrame([(i % 400, f"r{i}") for i in range(500)] + [(None, "null")], "id long, v string").repartition(5)
    first = spark.createDataFrame([(i,) for i in range(0, 400, 3)] + [(3,), (None,)], "id long")
    done.open_done(spark, "done_test", tmp_dir + "/done", "id", "bigint", 8)
    assert done.pending_landed(df, "done_test", "id").count() == 501  # nothing is done yet
    done.land_done(first, "done_test", "id", 8)
    done.land_done(first, "done_test", "id", 8)  # repeated: adds nothing
    assert spark.table("done_test").count() == 134
    done.land_done(spark.createDataFrame([(1,), (3,)], "id long"), "done_test", "id", 8)
    got = done.pending_landed(df, "done_test", "id")
    ids = {*range(0, 400, 3), 1}
    assert sorted(r.v for r in got.collect()) == sorted([f"r{i}" for i in range(500) if i % 400 not in ids] + ["null"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.rpartition("Initial Plan")[2].count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount: 8 out of 8" in plan  # the done side is not exchanged
    # another session, or a restart, finds the same table at its path
    before = sorted(r.v for r in got.collect())
    spark.sql("DROP TABLE done_test")
    done.open_done(spark, "done_again", tmp_dir + "/done", "id", "bigint", 8)
    assert sorted(r.v for r in done.pending_landed(df, "done_again", "id").collect()) == before
    spark.sql("DROP TABLE done_again")
