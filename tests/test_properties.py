"""Property tests (hypothesis): exact ranks and halves for arbitrary sizes and duplicate ids."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators import order


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=120), st.integers(0, 1000))
def test_ranks_are_a_permutation_and_halves_exact(spark, ids, seed):
    df = spark.createDataFrame([(i, j) for j, i in enumerate(ids)], "id long, pos long")
    ranked = order.shuffle_rank(df, "id", seed, rows_per_bucket=8).collect()
    assert sorted(r.shuffle_rank for r in ranked) == list(range(1, len(ids) + 1))
    # copies of one id are contiguous, and ids are ordered by their hash
    by_id = {}
    for r in ranked:
        by_id.setdefault(r.id, []).append(r.shuffle_rank)
    spans = sorted((min(v), max(v), len(v)) for v in by_id.values())
    assert all(hi - lo + 1 == n for lo, hi, n in spans)
    a, b = order.halves(df, "id", seed)
    pa, pb = {r.pos for r in a.collect()}, {r.pos for r in b.collect()}
    assert len(pa) == len(ids) // 2 and not (pa & pb) and len(pa | pb) == len(ids)


tag_lists = st.lists(st.sampled_from("abcdef"), min_size=0, max_size=4).map(" ".join)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 25), tag_lists), min_size=1, max_size=60),
       st.integers(1, 5), st.integers(1, 6))
def test_quota_selection_matches_sequential_model(spark, rows, n, k):
    from tests.test_quota import sequential

    from quarry.operators.quota import quota_assignments

    data = [(pos, f"id{i}", tags) for pos, (i, tags) in enumerate(rows)]
    want, _ = sequential(data, n, k)
    df = spark.createDataFrame(data, "src_pos int, id string, tags string")
    got = sorted((r.src_pos, r.id, r.tag) for r in quota_assignments(df, "id", "tags", "src_pos", n, k).collect())
    assert got == want
