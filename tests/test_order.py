"""Keyed-hash order, halves, batches, samples."""

import hashlib

from pyspark.sql import functions as F

from quarry.operators import order


def _expected_rank(ids, seed=42):
    return {i: r + 1 for r, i in enumerate(sorted(ids, key=lambda x: (hashlib.md5(f"{x}:{seed}".encode()).hexdigest(), x)))}


def test_shuffle_rank_exact_and_partition_invariant(spark):
    ids = list(range(3000))
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    want = _expected_rank(ids)
    for per_bucket, parts in [(1000, 3), (100, 8), (1, 17)]:  # 1 to 4,096 buckets
        got = order.shuffle_rank(df.repartition(parts), "id", 42, rows_per_bucket=per_bucket).collect()
        assert {r.id: r.shuffle_rank for r in got} == want


def test_duplicate_ids_get_distinct_ranks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "c")], "id long, v string")
    ranks = sorted(r.shuffle_rank for r in order.shuffle_rank(df, "id").collect())
    assert ranks == [1, 2, 3, 4]


def test_halves_exact_and_disjoint(spark):
    df = spark.createDataFrame([(i,) for i in range(1001)], "id long")
    a, b = order.halves(df, "id", 7)
    ia, ib = {r.id for r in a.collect()}, {r.id for r in b.collect()}
    assert len(ia) == 500 and len(ib) == 501 and not (ia & ib) and len(ia | ib) == 1001
    want = _expected_rank(range(1001), 7)
    assert all(want[i] <= 500 for i in ia)


def test_batches(spark):
    df = spark.createDataFrame([(i,) for i in range(1000)], "id long")
    keep = order.assign_batches(df, "id", 256).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in keep] == [256, 256, 256, 232]
    drop = order.assign_batches(df, "id", 256, drop_last=True).agg(F.max("batch"), F.count("*")).first()
    assert tuple(drop) == (2, 768)


def test_sample_n_is_order_prefix(spark):
    df = spark.createDataFrame([(i,) for i in range(500)], "id long")
    got = [(r.id, r.sample_rank) for r in order.sample_n(df, "id", 10).orderBy("sample_rank").collect()]
    want = sorted(_expected_rank(range(500)).items(), key=lambda kv: kv[1])[:10]
    assert got == want


def test_first_n_and_per_group(spark):
    df = spark.createDataFrame([(g, i) for g in range(3) for i in range(10)], "g int, i int")
    assert [r.i for r in order.first_n(df, ["i", "g"], 4).collect()] == [0, 0, 0, 1]
    per = order.first_n_per_group(df, ["g"], ["i"], 2).collect()
    assert sorted((r.g, r.i) for r in per) == [(g, i) for g in range(3) for i in range(2)]
    assert order.first_n(df, ["i"], None).count() == 30


def test_hot_id_is_split_and_ranks_stay_exact(spark):
    # one id holds 40% of the rows (with identical and differing copies); others unique
    rows = [(7, i % 3) for i in range(400)] + [(i, 0) for i in range(1000, 1600)]
    df = spark.createDataFrame(rows, "id long, v int").repartition(5)
    got = order.shuffle_rank(df, "id", 42, rows_per_bucket=100, hot_rows=50).collect()
    ranks = sorted(r.shuffle_rank for r in got)
    assert ranks == list(range(1, 1001))
    # the hot id's copies occupy one contiguous block placed where its hash puts it
    want = _expected_rank(sorted({r[0] for r in rows}))
    block = sorted(r.shuffle_rank for r in got if r.id == 7)
    assert block == list(range(block[0], block[0] + 400))
    before = sum(1 for i in want if i != 7 and want[i] < want[7])
    assert block[0] == before + 1
    for r in got:
        if r.id != 7:
            assert r.shuffle_rank == want[r.id] + (399 if want[r.id] > want[7] else 0)
    # the hot id was split over several window partitions
    plan_rows = order.shuffle_rank(df, "id", 42, rows_per_bucket=100, hot_rows=50)
    assert plan_rows.count() == 1000


def test_rank_invariant_to_shuffle_partitions(spark):
    df = spark.createDataFrame([(i,) for i in range(777)], "id long")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for parts in ("3", "8", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            results.append({r.id: r.shuffle_rank for r in order.shuffle_rank(df, "id", 5).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2] == _expected_rank(range(777), 5)


def test_published_batch_counts(spark):
    # 39,601 SFT rows in batches of 256 -> 155 steps; 39,572 RL prompts in batches of 96, last dropped -> 412
    sft = spark.range(39601).withColumnRenamed("id", "pid")
    rl = spark.range(39572).withColumnRenamed("id", "pid")
    assert order.assign_batches(sft, "pid", 256).select("batch").distinct().count() == 155
    kept = order.assign_batches(rl, "pid", 96, drop_last=True)
    assert kept.select("batch").distinct().count() == 412 and kept.count() == 412 * 96


def test_hot_exact_copies_out_of_a_shuffle(spark):
    # the input is an aggregate's output re-expanded: 300 exact copies of one row (a hot group of copies)
    # plus 500 unique ids, arriving in shuffle order; ranks must still be a permutation of 1..N
    base = spark.createDataFrame([(7, 300)] + [(i, 1) for i in range(2000, 2500)], "id long, c int")
    df = (base.groupBy("id").agg(F.sum("c").alias("c"))
          .select("id", F.explode(F.sequence(F.lit(1), F.col("c"))).alias("_x")).drop("_x"))
    got = order.shuffle_rank(df, "id", 42, rows_per_bucket=100, hot_rows=40).collect()
    assert sorted(r.shuffle_rank for r in got) == list(range(1, 801))
    block = sorted(r.shuffle_rank for r in got if r.id == 7)
    assert block == list(range(block[0], block[0] + 300))


def test_half_of_the_rows_under_one_id_rank_alike_under_any_layout(spark):
    rows = [(7, i) for i in range(1000)] + [(i, 0) for i in range(5000, 6000)] + [(9, 1)] * 300
    want = None
    for parts, hot in [(1, 50), (4, 50), (13, 200), (5, 1 << 20)]:
        df = spark.createDataFrame(rows, "id long, v int").repartition(parts)
        got = sorted(tuple(r) for r in order.shuffle_rank(df, "id", 42, rows_per_bucket=64, hot_rows=hot).collect())
        assert sorted(r[2] for r in got) == list(range(1, len(rows) + 1))
        want = want or got
        assert got == want


def test_bucket_width_follows_the_rows():
    assert [order._bucket_digits(n, 1 << 16) for n in (0, 1 << 16, 1 << 20, 1 << 40)] == [1, 1, 1, 6]


def test_copies_are_expanded_in_parts(spark, monkeypatch):
    monkeypatch.setattr(order, "COPIES", 16)
    df = spark.createDataFrame([(3, "x")] * 500 + [(i, "y") for i in range(100, 150)], "id long, v string")
    got = order.shuffle_rank(df, "id", 1, rows_per_bucket=32, hot_rows=40).collect()
    assert sorted(r.shuffle_rank for r in got) == list(range(1, 551))
    block = sorted(r.shuffle_rank for r in got if r.id == 3)
    assert block == list(range(block[0], block[0] + 500))


def test_order_index_equals_a_full_rank(spark, tmp_dir):
    import random

    from pyspark.sql import functions as F

    from quarry.operators import order, order_index

    rng = random.Random(2)
    rows = [(rng.choice([None, 7, rng.randrange(3000), rng.randrange(3000)]), f"v{rng.randrange(9)}") for _ in range(3000)]
    df = spark.createDataFrame(rows, "id long, v string").repartition(4)
    cut = F.pmod(F.xxhash64("id", "v"), F.lit(100))
    portions = [df.filter(cut < 60), df.filter(cut == 60), df.filter(cut > 60), df.limit(0)]
    seen, bag = df.limit(0), lambda x: sorted(map(tuple, x.collect()), key=lambda r: r[-1])
    for gen, portion in enumerate(portions):
        order_index.append(portion, tmp_dir, "id", 5, rows_per_bucket=40, gen=gen)
        order_index.append(portion, tmp_dir, "id", 5, rows_per_bucket=40, gen=gen)  # a repeat has no effect
        seen = seen.unionByName(portion)
        assert bag(order_index.ranked(spark, tmp_dir)) == bag(order.shuffle_rank(seen, "id", 5))
    last = order_index._manifest(spark, tmp_dir, 1)
    assert last.filter("gen = 0").count() > last.filter("gen = 1").count() > 0  # the small append left most buckets alone


def test_order_index_ignores_an_append_that_broke_off(spark, tmp_dir):
    import os

    from quarry.operators import order, order_index

    df = spark.range(500)
    order_index.append(df.filter("id < 400"), tmp_dir, "id", rows_per_bucket=10)
    before = sorted(map(tuple, order_index.ranked(spark, tmp_dir).collect()))
    order_index.append(df.filter("id >= 400"), tmp_dir, "id")
    os.remove(os.path.join(tmp_dir, "manifest", "gen=1", "_SUCCESS"))
    assert sorted(map(tuple, order_index.ranked(spark, tmp_dir).collect())) == before
    order_index.append(df.filter("id >= 400"), tmp_dir, "id")
    assert sorted(map(tuple, order_index.ranked(spark, tmp_dir).collect())) == sorted(map(tuple, order.shuffle_rank(df, "id").collect()))
