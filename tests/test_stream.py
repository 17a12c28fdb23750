"""Resumable scored append (H1): restarts, later duplicates, empty reruns."""

import os

from quarry.streaming.scored_append import run_available

SCHEMA = "id string, attempt int, text string, truth string"


def _land(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(os.path.join(folder, name))


def test_restarts_append_each_id_once(spark, tmp_dir):
    land, sink, ckpt = (os.path.join(tmp_dir, x) for x in ("land", "sink", "ckpt"))
    os.makedirs(land)
    _land(spark, land, [("a", 1, "FINAL_ANSWER: e2e4", "e2e4"), ("b", 1, "no", "e2e4"),
                        ("b", 2, "FINAL_ANSWER: d2d4", "d2d4"), ("a", 2, "FINAL_ANSWER: e2e4", "e2e4")], "f1")
    out = run_available(spark, land + "/*", SCHEMA, sink, ckpt, "id")
    assert sorted((r.id, r.attempt) for r in out.collect()) == [("a", 1), ("b", 2)]

    # second arrival: a later correct attempt of "a" is a duplicate; "c" is new
    _land(spark, land, [("a", 3, "FINAL_ANSWER: e2e4", "e2e4"), ("c", 1, "FINAL_ANSWER: h7h8q", "h7h8q")], "f2")
    out = run_available(spark, land + "/*", SCHEMA, sink, ckpt, "id")
    assert sorted((r.id, r.attempt) for r in out.collect()) == [("a", 1), ("b", 2), ("c", 1)]

    # a rerun with nothing new changes nothing
    out = run_available(spark, land + "/*", SCHEMA, sink, ckpt, "id")
    assert out.count() == 3


def test_replayed_batch_is_idempotent(spark, tmp_dir):
    from pyspark.sql import functions as F

    from quarry.streaming.scored_append import _accept_batch

    sink = os.path.join(tmp_dir, "sink")
    batch0 = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 0.0), ("b", 2, 1.0)], "id string, attempt int, score double")
    batch1 = spark.createDataFrame([("a", 5, 1.0), ("c", 1, 1.0)], "id string, attempt int, score double")
    run = _accept_batch(spark, sink, "id", "attempt", 11)
    run(batch0, 0)
    run(batch1, 1)
    run(batch1, 1)  # replay of a committed batch: rewrites its own folder only
    run(batch0, 0)  # replay of the first batch after later ones
    got = sorted((r.id, r.attempt, r.batch_id) for r in spark.read.parquet(sink).collect())
    assert got == [("a", 1, 0), ("b", 2, 0), ("c", 1, 1)]
    assert spark.read.parquet(sink).groupBy("id").count().filter(F.col("count") > 1).count() == 0


def test_sink_folders_and_files_stay_bounded(spark, tmp_dir):
    from pyspark.sql import functions as F

    from quarry.streaming import scored_append as S

    sink = os.path.join(tmp_dir, "sink")
    run = S._accept_batch(spark, sink, "id", "attempt", 11)
    batches = 22
    for n in range(batches):  # batch n repeats half of the batch before
        ids = range(5 * n, 5 * n + 10)
        run(spark.createDataFrame([(f"k{i}", n % 9, 1.0) for i in ids if n != 7], "id string, attempt int, score double"), n)  # 7 is empty
        runs = S.live(S.committed(spark, sink))
        assert sorted(b for r in runs for b in range(r.lo, r.hi + 1)) == list(range(n + 1))  # each batch in one folder
        levels = [r.level for r in runs]
        assert all(levels.count(x) <= S.FAN for x in set(levels))
    assert max(levels) == 2
    rows = S.accepted_rows(spark, sink).collect()
    first = {i: n % 9 for n in reversed(range(batches)) if n != 7 for i in range(5 * n, 5 * n + 10)}
    assert sorted((int(r.id[1:]), r.attempt) for r in rows) == sorted(first.items())
    files = [f for r in runs for _, _, names in os.walk(r.path.removeprefix("file:")) for f in names if f.endswith(".parquet")]
    assert len(files) <= 2 * len(runs)
    # a replay of a merged batch, and of the last one, changes nothing
    run(spark.createDataFrame([("k0", 0, 1.0), ("new", 0, 1.0)], "id string, attempt int, score double"), 2)
    run(spark.createDataFrame([(f"k{i}", 1, 1.0) for i in range(5 * batches - 5, 5 * batches + 5)], "id string, attempt int, score double"), batches - 1)
    again = S.accepted_rows(spark, sink)
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in rows)
    assert again.groupBy("id").count().filter(F.col("count") > 1).count() == 0


def test_a_broken_off_merge_is_done_again(spark, tmp_dir):
    from quarry.streaming import scored_append as S

    sink = os.path.join(tmp_dir, "sink")
    run = S._accept_batch(spark, sink, "id", "attempt", 11)
    make = lambda n: spark.createDataFrame([(f"k{n}", 1, 1.0)], "id string, attempt int, score double")
    for n in range(4):
        run(make(n), n)
    os.makedirs(os.path.join(sink, "batch_id=0-3", "bucket=1"))  # no _SUCCESS
    assert len(S.live(S.committed(spark, sink))) == 4
    run(make(4), 4)
    assert [(r.lo, r.hi) for r in S.live(S.committed(spark, sink))] == [(0, 3), (4, 4)]
    assert os.path.exists(os.path.join(sink, "batch_id=0"))  # superseded; the next batch removes it
    run(make(5), 5)
    assert not os.path.exists(os.path.join(sink, "batch_id=0"))
    assert sorted(r.id for r in S.accepted_rows(spark, sink).collect()) == [f"k{n}" for n in range(6)]
