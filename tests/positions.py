"""Board queries over literal positions, kept out of the catalog: no driver table holds positions. Each event picks one of
the positions below, and the DuckDB SQL beside a query gives its expected rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans.catalog import table

QUERIES, ORACLES = {}, {}


def register(name, sql):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


# ---- B6 - B12: positions assigned to events ----------------------------------------------------------------------------
# Published depth-1 move counts of eight positions (six standard perft positions, an en-passant case and a mate).
POSITIONS = [
    ("rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", 20),
    ("r3k2r/p1ppqpb1/bn2pnp1/3PN3/1p2P3/2N2Q1p/PPPBBPPP/R3K2R w KQkq - 0 1", 48),
    ("8/2p5/3p4/KP5r/1R3p1k/8/4P1P1/8 w - - 0 1", 14),
    ("r3k2r/Pppp1ppp/1b3nbN/nP6/BBP1P3/q4N2/Pp1P2PP/R2Q1RK1 w kq - 0 1", 6),
    ("rnbq1k1r/pp1Pbppp/2p5/8/2B5/8/PPP1NnPP/RNBQK2R w KQ - 1 8", 44),
    ("r4rk1/1pp1qppp/p1np1n2/2b1p1B1/2B1P1b1/P1NP1N2/1PP1QPPP/R4RK1 w - - 0 10", 46),
    ("4k3/8/8/3pP3/8/8/8/4K3 w - d6 0 2", 7),
    ("7k/6Q1/6K1/8/8/8/8/8 b - - 0 1", 0),
]
# One move applied to a position, with the hand-derived result.
MOVE_CASES = [
    ("rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1", "e2e4 e7e5 g1f3",
     "rnbqkbnr/pppppppp/8/8/4P3/8/PPPP1PPP/RNBQKBNR b KQkq - 0 1"),
    ("r3k2r/8/8/8/8/8/8/R3K2R w KQkq - 0 1", "e1g1 e8c8", "r3k2r/8/8/8/8/8/8/R4RK1 b kq - 1 1"),
    ("r3k2r/8/8/8/8/8/8/R3K2R w KQkq - 0 1", "a1a8 e8d7 a8h8 d7e6", "R3k2r/8/8/8/8/8/8/4K2R b Kk - 0 1"),
    ("4k3/3p4/8/4P3/8/8/8/4K3 b - - 0 1", "d7d5 e5d6", "4k3/8/8/3pP3/8/8/8/4K3 w - d6 0 2"),
    ("4k3/8/8/3pP3/8/8/8/4K3 w - d6 0 2", "e5d6", "4k3/8/3P4/8/8/8/8/4K3 b - - 0 2"),
    ("4k3/P7/8/8/8/8/8/4K3 w - - 0 1", "a7a8q e8d7", "Q3k3/8/8/8/8/8/8/4K3 b - - 0 1"),
]


def _sql_values(rows, cols) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in (i, *r)) + ")" for i, r in enumerate(rows))
    return f"(VALUES {body}) AS v(pos_idx, {', '.join(cols)})"


def positions(spark: SparkSession, sf: str) -> DataFrame:
    """events -> (event_id, fen, expected_moves): position ``event_id % 8`` of the list above."""
    fens = F.array(*[F.lit(f) for f, _ in POSITIONS])
    counts = F.array(*[F.lit(n) for _, n in POSITIONS])
    i = F.pmod(F.col("event_id"), F.lit(len(POSITIONS))).cast("int")
    ev = table(spark, sf, "events").select("event_id")
    return ev.select("event_id", F.get(fens, i).alias("fen"), F.get(counts, i).alias("expected"))


def move_cases(spark: SparkSession, sf: str) -> DataFrame:
    """events -> (event_id, fen, moves): case ``event_id % 6`` of the list above."""
    i = F.pmod(F.col("event_id"), F.lit(len(MOVE_CASES))).cast("int")
    fens = F.array(*[F.lit(c[0]) for c in MOVE_CASES])
    moves = F.array(*[F.lit(c[1]) for c in MOVE_CASES])
    ev = table(spark, sf, "events").select("event_id")
    return ev.select("event_id", F.get(fens, i).alias("fen"), F.get(moves, i).alias("moves"))


SQL_POS = f"""pos AS (SELECT e.event_id, v.fen, v.expected FROM events e
                  JOIN {_sql_values(POSITIONS, ['fen', 'expected'])} ON e.event_id % {len(POSITIONS)} = v.pos_idx)"""
SQL_MOVES = f"""mv AS (SELECT e.event_id, v.fen, v.moves, v.after FROM events e
                  JOIN {_sql_values(MOVE_CASES, ['fen', 'moves', 'after'])} ON e.event_id % {len(MOVE_CASES)} = v.pos_idx)"""


def _sql_expand(fen: str) -> str:
    s = f"split_part({fen}, ' ', 1)"
    for d in range(8, 0, -1):
        s = f"replace({s}, '{d}', '{'.' * d}')"
    return s


SQL_CELLS = f"""cells AS (
  SELECT event_id, i, substr(b, i + 1, 1) AS piece, chr(CAST(97 + i % 8 AS INTEGER)) || CAST(8 - i // 8 AS VARCHAR) AS square
  FROM (SELECT event_id, replace({_sql_expand('fen')}, '/', '') AS b, unnest(range(0, 64)) AS i FROM pos)
  WHERE substr(b, i + 1, 1) <> '.')"""


@register("board_rows", f"WITH {SQL_POS}, {SQL_CELLS} SELECT event_id, square, piece FROM cells")
def q_board_rows(spark, sf):
    from quarry.operators.board import board_rows

    return board_rows(positions(spark, sf), "event_id", "fen").select("event_id", "square", "piece")


_KIND_ORDER = "CASE upper(piece) WHEN 'K' THEN 0 WHEN 'Q' THEN 1 WHEN 'R' THEN 2 WHEN 'B' THEN 3 WHEN 'N' THEN 4 ELSE 5 END"
_KIND_NAME = ("CASE upper(piece) WHEN 'K' THEN 'King' WHEN 'Q' THEN 'Queen' WHEN 'R' THEN 'Rook' WHEN 'B' THEN 'Bishop' "
              "WHEN 'N' THEN 'Knight' ELSE 'Pawn' END")


@register(
    "piece_inventory",
    f"""WITH {SQL_POS}, {SQL_CELLS},
        groups AS (
          SELECT event_id, piece = upper(piece) AS white, {_KIND_ORDER} AS ko,
                 (CASE WHEN piece = upper(piece) THEN 'White ' ELSE 'Black ' END) || {_KIND_NAME} || ': [' ||
                 array_to_string(list_transform(list_sort(list(square)), lambda x: '''' || x || ''''), ', ') || ']' AS part
          FROM cells GROUP BY event_id, piece)
        SELECT event_id, string_agg(part, ', ' ORDER BY white DESC, ko) AS inventory FROM groups GROUP BY event_id""",
)
def q_piece_inventory(spark, sf):
    from quarry.operators.board import piece_inventory

    return piece_inventory(positions(spark, sf), "event_id", "fen")


@register(
    "board_text",
    f"""WITH {SQL_POS}
        SELECT event_id, array_to_string(list_transform(string_split({_sql_expand('fen')}, '/'),
                                                        lambda x: array_to_string(string_split(x, ''), ' ')), chr(10)) AS board,
               CASE WHEN split_part(fen, ' ', 2) = 'w' THEN 'White' ELSE 'Black' END AS side
        FROM pos""",
)
def q_board_text(spark, sf):
    from quarry.functions import chess as C

    p = positions(spark, sf)
    return p.select("event_id", C.board_text("fen").alias("board"), C.side_to_move("fen").alias("side"))


@register(
    "parse_moves",
    f"""WITH {SQL_MOVES}
        SELECT event_id, string_split(moves, ' ')[1] AS opponent, string_split(moves, ' ')[2] AS answer,
               array_to_string(list_slice(string_split(moves, ' '), 2, len(string_split(moves, ' '))), ' ') AS continuation
        FROM mv""",
)
def q_parse_moves(spark, sf):
    from quarry.functions import chess as C

    p = move_cases(spark, sf).select("event_id", C.parse_moves("moves").alias("m"))
    return p.select("event_id", "m.opponent", "m.answer", F.array_join("m.continuation", " ").alias("continuation"))


@register("apply_move", f"WITH {SQL_MOVES} SELECT event_id, after AS fen_after FROM mv")
def q_apply_move(spark, sf):
    from quarry.functions import chess as C

    from quarry.operators.board import apply_moves

    m = move_cases(spark, sf)
    return apply_moves(m, "fen", C.parse_moves("moves")["opponent"]).select("event_id", "fen_after")


@register("legal_moves", f"WITH {SQL_POS} SELECT event_id, CAST(expected AS INTEGER) AS n_moves FROM pos")
def q_legal_moves(spark, sf):
    from quarry.operators.board import legal_moves

    return legal_moves(positions(spark, sf), "fen").select("event_id", F.size("moves").cast("int").alias("n_moves"))


def walked_positions(spark: SparkSession, sf: str) -> DataFrame:
    """events -> (event_id, fen): from position ``event_id % 8``, the legal move at index
    ``(3 * event_id + 1) mod (number of legal moves)`` is played, so positions vary with the events
    (castles, promotions and en-passant captures included). A position without a move stays as it is."""
    from quarry.operators.board import apply_moves, legal_moves

    p = legal_moves(positions(spark, sf).select("event_id", "fen"), "fen", out="_lm")
    idx = F.pmod(F.col("event_id") * F.lit(3) + F.lit(1), F.greatest(F.size("_lm"), F.lit(1))).cast("int")
    p = apply_moves(p.withColumn("_pick", F.get(F.col("_lm"), idx)), "fen", "_pick", out="_next")
    return p.select("event_id", F.coalesce(F.col("_next"), F.col("fen")).alias("fen"))


@register("legal_moves_walk", None)
def q_legal_moves_walk(spark, sf):
    """B11 then B12 on positions derived from the events: no SQL oracle (legal moves are not expressible
    in the oracle's SQL); ``tests/test_prompts_bruteforce.py`` checks it against a brute-force generator."""
    from quarry.operators.board import legal_moves

    m = legal_moves(walked_positions(spark, sf), "fen")
    return m.select("event_id", "fen", F.size("moves").cast("int").alias("n_moves"),
                    F.array_join("moves", " ").alias("moves"))


@register(
    "side_to_move",
    f"WITH {SQL_POS} SELECT event_id, CASE WHEN split_part(fen, ' ', 2) = 'w' THEN 'White' ELSE 'Black' END AS side FROM pos",
)
def q_side_to_move(spark, sf):
    from quarry.functions import chess as C

    return positions(spark, sf).select("event_id", C.side_to_move("fen").alias("side"))


# ---- B13a / B13b: prompts over the positions (no oracle: they embed the legal-move lists) ----------------------------
@register("student_prompts", None)
def q_student_prompts(spark, sf):
    from quarry.functions import chess as C
    from quarry.functions.records import student_prompt
    from quarry.operators.board import legal_moves

    p = legal_moves(positions(spark, sf), "fen", out="legal")
    return p.select("event_id", student_prompt("fen", C.piece_inventory("fen"), "legal").alias("prompt"))


@register("teacher_prompts", None)
def q_teacher_prompts(spark, sf):
    from quarry.functions import chess as C
    from quarry.functions.records import teacher_prompt
    from quarry.operators.board import legal_moves

    m = move_cases(spark, sf).join(table(spark, sf, "events").select("event_id", "value", "event_type"), "event_id")
    mv = C.parse_moves("moves")
    from quarry.operators.board import apply_moves

    m = apply_moves(m, "fen", mv["opponent"]).withColumn("best", mv["answer"])
    m = legal_moves(m.filter(F.col("best").isNotNull()), "fen_after", out="legal")
    themes = F.concat_ws(" ", "event_type", F.when(F.col("event_id") % 2 == 0, F.lit("mateIn1")).otherwise(F.lit("fork")))
    prompt = teacher_prompt("fen_after", C.board_text("fen_after"), C.piece_inventory("fen_after"),
                            C.side_to_move("fen_after"), mv["opponent"], "best", F.col("value").cast("int"), themes,
                            "legal", "moves")
    return m.select("event_id", prompt.alias("prompt"))
