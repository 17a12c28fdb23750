"""Quota selection (E3) and shortfall (D6) against a sequential model written here."""

import random
from collections import Counter

from pyspark.sql import functions as F

from quarry.operators.quota import quota_assignments, quota_select, quota_shortfall
from quarry.operators.tags import rarest_tags, tag_frequency

FIXTURE = [(0, "p1", "a b c"), (1, "p2", "a c"), (2, "p3", "b"), (3, "p4", "b c"), (4, "p5", "c")]


def sequential(rows, n, k):
    """The definition: rarest tags first, rows in source order, an id taken once, n per tag."""
    freq = Counter(t for _, _, tags in rows for t in tags.split())
    themes = sorted(freq, key=lambda t: (freq[t], t))[:k]
    seen, taken = set(), []
    found = {t: 0 for t in themes}
    for t in themes:
        for pos, pid, tags in sorted(rows):
            if found[t] >= n:
                break
            if t in tags.split() and pid not in seen:
                seen.add(pid)
                taken.append((pos, pid, t))
                found[t] += 1
    return sorted(taken), found


def _df(spark, rows):
    return spark.createDataFrame(rows, "src_pos int, id string, tags string")


def test_fixture_cases(spark):
    df = _df(spark, FIXTURE)
    sel = quota_select(df, "id", "tags", "src_pos", 1, 3).orderBy("src_pos").collect()
    assert [(r.src_pos, r.id, r.theme) for r in sel] == [(0, "p1", "a"), (1, "p2", "c"), (2, "p3", "b")]
    short = quota_shortfall(df, "id", "tags", "src_pos", 2, 3).collect()
    assert [(r.theme, r.found, r.shortfall) for r in short] == [("c", 1, 1)]
    sel2 = quota_select(df, "id", "tags", "src_pos", 1, 2).collect()
    assert sorted(r.id for r in sel2) == ["p1", "p3"]


def test_frequency_counts_repeats(spark):
    df = spark.createDataFrame([("a a b",), ("b",)], "t string")
    assert [(r.tag, r.freq) for r in tag_frequency(df, "t").collect()] == [("a", 2), ("b", 2)]
    assert [r.tag_rank for r in rarest_tags(df, "t", 5).collect()] == [0, 1]


def test_random_tables_match_sequential(spark):
    rng = random.Random(7)
    for case in range(6):
        vocab = [f"t{i}" for i in range(rng.randint(3, 8))]
        rows = []
        for pos in range(rng.randint(20, 120)):
            pid = f"id{rng.randint(0, 60)}"  # repeated ids
            tags = " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 4)))  # repeated tags
            rows.append((pos, pid, tags))
        n, k = rng.randint(1, 6), rng.randint(1, len(vocab))
        want, found = sequential(rows, n, k)
        got = quota_assignments(_df(spark, rows), "id", "tags", "src_pos", n, k)
        got = sorted((r.src_pos, r.id, r.tag) for r in got.collect())
        assert got == want, (case, n, k)
        rep = {r.theme: r.found for r in quota_shortfall(_df(spark, rows), "id", "tags", "src_pos", n, k,
                                                         only_short=False).collect()}
        assert rep == found


def test_selected_rows_carry_columns(spark):
    df = _df(spark, FIXTURE).withColumn("rating", F.col("src_pos") * 100)
    sel = quota_select(df, "id", "tags", "src_pos", 1, 3)
    assert set(sel.columns) >= {"src_pos", "id", "tags", "rating", "theme", "theme_rank"}


def test_pruning_tree_levels_match_sequential(spark):
    from quarry.operators import quota as Q

    assert Q._levels(100, 10) == 0 and Q._levels(160 * 16, 10) == 1 and Q._levels(160 * 16 * 16 + 1, 10) >= 2
    rng = random.Random(3)
    rows = [(pos, f"id{rng.randint(0, 300)}", " ".join(rng.choice("abcde") for _ in range(2))) for pos in range(600)]
    cand_df = _df(spark, rows)
    themes = rarest_tags(cand_df, "tags", 3)
    cand = Q._candidates(cand_df, "id", "tags", "src_pos", themes, True)
    deep = sorted(tuple(r) for r in Q._prune(cand, 4, 3).collect())
    flat = sorted(tuple(r) for r in Q._prune(cand, 4, 0).collect())
    assert deep == flat
    want, _ = sequential(rows, 4, 3)
    got = sorted((r.src_pos, r.id, r.tag) for r in quota_assignments(cand_df, "id", "tags", "src_pos", 4, 3).collect())
    assert got == want


def test_array_tags_give_same_selection(spark):
    from quarry.functions.text import tags as tag_array

    df = _df(spark, FIXTURE)
    arr = df.withColumn("tag_list", tag_array("tags")).drop("tags")
    a = sorted(tuple(r) for r in quota_assignments(df, "id", "tags", "src_pos", 1, 3).collect())
    b = sorted(tuple(r) for r in quota_assignments(arr, "id", "tag_list", "src_pos", 1, 3, split=False).collect())
    assert a == b


def test_rows_that_repeat_id_and_position_are_one_candidate(spark):
    df = spark.createDataFrame([(1, "a", 5, "x"), (1, "a", 5, "y"), (1, "b", 5, "z"), (2, "a", 6, "w"), (2, "a", 6, "w")],
                               "id int, tags string, pos int, v string")
    one = quota_select(df, "id", "tags", "pos", 1, 1).collect()
    assert [(r.id, r.theme) for r in one] == [(1, "b")]
    two = quota_select(df, "id", "tags", "pos", 2, 2).collect()
    assert sorted((r.id, r.theme) for r in two) == [(1, "b"), (2, "a")]
