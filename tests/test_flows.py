"""End-to-end flows over fixture puzzles (select -> distil/accept -> format -> evaluate)."""

from pyspark.sql import functions as F

from quarry.plans import flows
from tests.positions import POSITIONS

PUZZLES = [
    (f"p{i}", fen, mv, 1000 + 10 * i, tags)
    for i, (fen, mv, tags) in enumerate(
        [
            (POSITIONS[0][0], "e2e4 e7e5 g1f3", "opening short"),
            (POSITIONS[1][0], "e1g1 h3g2 g1g2", "castle middlegame"),
            (POSITIONS[4][0], "d7c8q d8c8 e1g1", "promotion advantage"),
            (POSITIONS[6][0], "e5d6 e8d7", "enPassant short"),
            (POSITIONS[5][0], "c4f7 f8f7", "sacrifice mateIn1"),
            (POSITIONS[2][0], "e2e4 f4e3", "enPassant endgame"),
        ]
    )
]


def test_flows(spark):
    pz = spark.createDataFrame(PUZZLES, "PuzzleId string, FEN string, Moves string, Rating int, Themes string")
    sel = flows.select_flow(pz, n_sft=2, k_sft=3, n_rl=2, k_rl=3, seed=1)
    total = sel["sft"].count() + sel["rl"].count()
    assert 0 < total <= 6
    rows = flows.teacher_rows(pz)
    # the distillation target is the first rows of the selection in its final shuffle order
    shuffled = sel["sft"].unionByName(sel["rl"].drop("shuffle_rank")
                                      .withColumn("shuffle_rank", F.col("src_pos") * 0 + 100 + F.col("src_pos")))
    first2 = {x.PuzzleId for x in sel["sft"].filter("shuffle_rank <= 2").collect()}
    assert {x.PuzzleId for x in flows.teacher_rows(shuffled, max_rows=2).collect()} == first2
    none_done = spark.createDataFrame([("zz",)], "PuzzleId string")
    assert {x.PuzzleId for x in flows.teacher_rows(shuffled, none_done, max_rows=2).collect()} == first2
    r = {x.PuzzleId: x for x in rows.collect()}
    assert r["p0"].fen_after == "rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq - 0 1"
    assert r["p0"].best_move == "e7e5" and "e7e5" in r["p0"].legal_moves and len(r["p0"].legal_moves) == 20
    assert "\nPV: e7e5 g1f3\n" in r["p0"].teacher_prompt and "PV:" not in r["p4"].teacher_prompt

    att = spark.createDataFrame(
        [("p0", 1, "FINAL_ANSWER: e7e6", 1.0), ("p0", 2, "ok\nFINAL_ANSWER: e7e5", 2.0), ("p1", 1, "no", 1.0)],
        "PuzzleId string, attempt int, content string, cost double",
    )
    distilled, ledger = flows.accept_flow(rows, att)
    d = distilled.collect()
    assert [(x.PuzzleId, x.attempt) for x in d] == [("p0", 2)]
    lg = ledger.first()
    assert (lg.ids, lg.accepted, lg.total_cost, lg.accepted_cost) == (2, 1, 4.0, 2.0)

    test = flows.build_test_set(
        spark.createDataFrame([("x_mate", d[0].fen_after.rsplit(" ", 2)[0] + " 9 30", "g1f3", '{"k": "v"}')],
                              "task string, fen string, answer string, metadata string")
    )
    t = test.first()
    assert t.extra_info["type"] == "mate" and t.extra_info["k"] == "v"
    sft, rl, counts = flows.format_flow(distilled, flows.test_keys_of(test))
    assert sft.count() == 0 and {(x.dataset, x.status, x.rows) for x in counts.collect()} == {
        ("sft", "excluded", 1), ("rl", "excluded", 1)}
    broken = distilled.withColumn("cot", F.lit("  "))
    got = {(x.dataset, x.status) for x in flows.format_flow(broken, flows.test_keys_of(test))[2].collect()}
    assert got == {("sft", "invalid"), ("rl", "excluded")}
    sft2, rl2, counts2 = flows.format_flow(distilled, flows.test_keys_of(test).filter("false"))
    s = sft2.first()
    assert s.instruction.startswith("You are given a chess position in FEN: ") and s.input == "" and "e7e5" in s.output
    assert rl2.first().extra_info.themes == ["opening", "short"]
    # RL records come from the RL selection: position after the opponent's move, answer = second move;
    # a one-move row has no answer and is invalid
    rl_sel = pz.filter("PuzzleId IN ('p1', 'p3')").withColumn("Moves", F.expr("IF(PuzzleId = 'p3', 'e5d6', Moves)"))
    _, rl3, counts3 = flows.format_flow(distilled, flows.test_keys_of(test).filter("false"), rl_rows=rl_sel)
    r3 = rl3.collect()
    assert [(x.extra_info.puzzle_id, x.reward_model.ground_truth) for x in r3] == [("p1", "h3g2")]
    assert r3[0].extra_info.fen == "r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R4RK1 b kq - 1 1"
    assert {(x.dataset, x.status, x.rows) for x in counts3.collect()} == {
        ("sft", "kept", 1), ("rl", "kept", 1), ("rl", "invalid", 1)}

    resp = spark.createDataFrame(
        [("t0", 0, "FINAL_ANSWER: g1f3 " + "w " * 10), ("t0", 1, "nothing")], "prompt_id string, sample int, text string"
    )
    rows_e, summary = flows.evaluate_flow(resp, test.withColumn("prompt_id", F.lit("t0")), max_tokens=8)
    e = rows_e.first()
    assert e.score == 0.5 and e.num_tokens == 12 and e.clipped
    sm = summary.first()
    assert (sm.prompts, sm.accuracy, sm.clipped) == (1, 0.5, 1)


def test_checkpoint_report(spark):
    test = spark.createDataFrame(
        [("t0", "e2e4"), ("t1", "d2d4")], "prompt_id string, gt string"
    ).select("prompt_id", F.struct(F.col("gt").alias("ground_truth"), F.lit("rule").alias("style")).alias("reward_model"),
             F.array(F.struct(F.lit("user").alias("role"), F.lit("q").alias("content"))).alias("prompt"),
             F.create_map(F.lit("fen"), F.lit("x")).alias("extra_info"))
    resp = spark.createDataFrame(
        [("rl", 10, "t0", 0, "FINAL_ANSWER: e2e4"), ("rl", 10, "t1", 0, "no"),
         ("rl", 20, "t0", 0, "FINAL_ANSWER: e2e4"), ("rl", 20, "t1", 0, "FINAL_ANSWER: d2d4"),
         ("rl", 30, "t0", 0, "FINAL_ANSWER: e2e4"), ("rl", 30, "t1", 0, "FINAL_ANSWER: d2d4")],
        "stage string, step int, prompt_id string, sample int, text string",
    )
    summary, curve, best = flows.checkpoint_report(resp, test, max_tokens=64)
    assert {(r.step, r.accuracy) for r in summary.collect()} == {(10, 0.5), (20, 1.0), (30, 1.0)}
    assert [r.running_best for r in curve.orderBy("step").collect()] == [0.5, 1.0, 1.0]
    assert [(r.stage, r.best_step) for r in best.collect()] == [("rl", 20)]


def _test_records(spark, rows):
    return spark.createDataFrame(rows, "prompt_id string, gt string, kind string").select(
        "prompt_id", F.struct(F.col("gt").alias("ground_truth"), F.lit("rule").alias("style")).alias("reward_model"),
        F.array(F.struct(F.lit("user").alias("role"), F.lit("q").alias("content"))).alias("prompt"),
        F.create_map(F.lit("type"), F.col("kind")).alias("extra_info"))


def test_unanswered_prompts_count_as_wrong(spark):
    test = _test_records(spark, [("t0", "e2e4", "mate"), ("t1", "d2d4", "fork")])
    resp = spark.createDataFrame([("t0", 0, "FINAL_ANSWER: e2e4")], "prompt_id string, sample int, text string")
    rows, summary = flows.evaluate_flow(resp, test, max_tokens=8)
    assert {(r.prompt_id, r.score, r.num_tokens, r.clipped) for r in rows.collect()} == {("t0", 1.0, 2, False), ("t1", 0.0, 0, False)}
    s = summary.first()
    assert (s.prompts, s.accuracy) == (2, 0.5)
    # info keys become columns, and the summary can be grouped by them
    rows, summary = flows.evaluate_flow(resp, test, max_tokens=8, by=["type"], info_keys=["type"])
    assert {(r.type, r.accuracy) for r in summary.collect()} == {("mate", 1.0), ("fork", 0.0)} and "extra_info" not in rows.columns
    # every checkpoint is an evaluation of the whole test set
    steps = resp.withColumn("step", F.lit(1)).unionByName(resp.withColumn("prompt_id", F.lit("t1")).withColumn("step", F.lit(2)))
    _, summary = flows.evaluate_flow(steps, test, by=["step"])
    assert {(r.step, r.prompts, r.accuracy) for r in summary.collect()} == {(1, 2, 0.5), (2, 2, 0.0)}


def test_building_flows_runs_nothing(spark):
    sc = spark.sparkContext
    sc.setJobGroup("building", "flows are lazy")
    try:
        pz = spark.range(4).select(F.col("id").cast("string").alias("PuzzleId"), F.lit(POSITIONS[0][0]).alias("FEN"),
                                   F.lit("e2e4 e7e5").alias("Moves"), F.lit(1500).alias("Rating"), F.lit("fork").alias("Themes"))
        pz = pz.groupBy(*pz.columns).agg(F.count("*").alias("n"))  # a frame behind a shuffle
        rows = flows.teacher_rows(pz, done=pz.filter("PuzzleId = '1'"))
        att = pz.select("PuzzleId", F.lit(1).alias("attempt"), F.lit("FINAL_ANSWER: e7e5").alias("content"), F.lit(1.0).alias("cost"))
        distilled, _ = flows.accept_flow(rows, att)
        bench = pz.select(F.lit("x_mate").alias("task"), F.col("FEN").alias("fen"), F.lit("e2e4").alias("answer"), F.lit("{}").alias("metadata"))
        test = flows.build_test_set(bench)
        flows.format_flow(distilled, flows.test_keys_of(test), rl_rows=pz)
        resp = pz.select(F.col("PuzzleId").alias("prompt_id"), F.lit("rl").alias("stage"), F.lit(1).alias("step"), F.lit(0).alias("sample"), F.lit("x").alias("text"))
        flows.checkpoint_report(resp, test.withColumn("prompt_id", F.lit("0")))
        flows.classify(pz, "PuzzleId", "Moves", pz, bench.withColumnRenamed("fen", "text"))
        assert len(sc.statusTracker().getJobIdsForGroup("building")) == 0
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_supplied_legal_moves_are_used(spark):
    bench = spark.createDataFrame([("x_mate", POSITIONS[0][0], "e2e4", "{}", ["a1a1"])],
                                  "task string, fen string, answer string, metadata string, legal_moves array<string>")
    assert "Legal moves: a1a1" in flows.build_test_set(bench).first().prompt[0].content


def test_landed_positions_are_joined_instead_of_computed(spark):
    rows = [("p0", "A w", "m1 n1", 1500, "fork"), ("p1", "A w", "m2 n2", 1500, "fork"), ("p2", "B w", "m1 n3", 1400, "pin"), ("bad", None, "m1 n1", 1, "x")]
    pz = spark.createDataFrame(rows, "PuzzleId string, FEN string, Moves string, Rating int, Themes string")
    after = spark.createDataFrame([("A w", "m1", "C b"), ("A w", "m1", "C b"), ("A w", "m2", "D b"), ("Z w", "m1", "E b")], "fen string, move string, fen_after string")
    legal = spark.createDataFrame([("C b", ["n1"]), ("C b", ["n1"]), ("D b", ["n2", "n4"]), ("A w", ["m1", "m2"])], "fen string, legal_moves array<string>")
    landed = flows.Positions(legal, after)
    got = {r.PuzzleId: r for r in flows.teacher_rows(pz, landed=landed).collect()}
    assert len(got) == 4  # repeated keys do not multiply rows
    assert [got[k].fen_after for k in ("p0", "p1", "p2", "bad")] == ["C b", "D b", None, None]
    assert [got[k].legal_moves for k in ("p0", "p1", "p2", "bad")] == [["n1"], ["n2", "n4"], None, None]
    bench = pz.select(F.lit("x_mate").alias("task"), F.col("FEN").alias("fen"), F.lit("e2e4").alias("answer"), F.lit("{}").alias("metadata"))
    test = flows.build_test_set(bench, landed)
    assert sum("Legal moves: m1, m2" in (r.prompt[0].content or "") or "m1 m2" in (r.prompt[0].content or "") for r in test.collect()) == 2
    assert "Join" in test._jdf.queryExecution().executedPlan().toString()
