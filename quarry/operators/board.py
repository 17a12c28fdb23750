"""Board tables and legal moves.

``board_rows`` expands positions to one row per occupied square (a generator, no shuffle).
``legal_moves`` is a single row-local Spark SQL expression built from higher-order functions over the
64-character board: pseudo-legal targets per piece (steppers, sliders up to the first blocker, pawns with
pushes / captures / en passant / promotion, castling through unattacked squares), then a king-safety
test on the board after each move. Every position is independent, so the work spreads over tasks with
the data and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import chess as C

# ---- fixed values: piece geometry ------------------------------------------------------------------------------
KNIGHT_STEPS = [(1, 2), (2, 1), (2, -1), (1, -2), (-1, -2), (-2, -1), (-2, 1), (-1, 2)]
KING_STEPS = [(1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1)]
ORTHOGONAL = [(1, 0), (-1, 0), (0, 1), (0, -1)]
DIAGONAL = [(1, 1), (1, -1), (-1, 1), (-1, -1)]
PROMOTIONS = ["q", "r", "b", "n"]


def board_rows(df: DataFrame, id_col: str, fen: str) -> DataFrame:
    """``(id, square, rank, file, piece, color, kind)`` for every occupied square."""
    cells = df.select(F.col(id_col), F.posexplode(F.split(C.board64(fen), "")).alias("_i", "piece"))
    cells = cells.filter((F.col("piece") != ".") & (F.col("piece") != "") & (F.col("_i") < 64))
    return cells.select(
        id_col,
        C.square_name(F.col("_i")).alias("square"),
        (8 - F.floor(F.col("_i") / 8)).cast("int").alias("rank"),
        F.substring(F.lit(C.FILES), (F.col("_i") % 8 + 1).cast("int"), 1).alias("file"),
        "piece",
        F.when(F.col("piece") == F.upper("piece"), F.lit("White")).otherwise(F.lit("Black")).alias("color"),
        F.upper("piece").alias("kind"),
    )


def piece_inventory(df: DataFrame, id_col: str, fen: str, out: str = "inventory") -> DataFrame:
    """``(id, inventory)``. Row-local: the board and its occupied cells are materialised by one
    projection each, then the twelve piece lists are cut from the short cell list."""
    cells = df.select(id_col, C.occupied(C.board64(fen)).alias("_cells"))
    return cells.select(id_col, C.inventory_from_cells(F.col("_cells")).alias(out))


# ---- per-square geometry, generated from the step rules above (index 0 = a8 ... 63 = h1) -----------------------
def _index(f: int, r: int) -> int:
    return (7 - r) * 8 + f


def _on(f: int, r: int) -> bool:
    return 0 <= f < 8 and 0 <= r < 8


def _targets(steps) -> list[list[int]]:
    out = []
    for sq in range(64):
        f, r = sq % 8, 7 - sq // 8
        out.append([_index(f + x, r + y) for x, y in steps if _on(f + x, r + y)])
    return out


def _rays() -> list[list[list[int]]]:
    """Per square the eight rays (straight lines first, then diagonals), nearest square first."""
    out = []
    for sq in range(64):
        f, r = sq % 8, 7 - sq // 8
        rays = []
        for x, y in ORTHOGONAL + DIAGONAL:
            rays.append([_index(f + k * x, r + k * y) for k in range(1, 8) if _on(f + k * x, r + k * y)])
        out.append(rays)
    return out


def _lit(v) -> str:
    if isinstance(v, list):
        return "CAST(array() AS array<int>)" if not v else "array(" + ", ".join(_lit(x) for x in v) + ")"
    return str(v)


def _lit_nested(v) -> str:
    """array<array<int>> / array<array<array<int>>> literal; empty leaves typed as array<int>."""
    return _lit(v)


# The tables are bound once per expression as lambda variables (see ``_legal_sql``); the builders below
# refer to them by these names, which keeps the expression small to parse and analyse.
_TABLES = {
    "kn_t": _lit_nested(_targets(KNIGHT_STEPS)),
    "kg_t": _lit_nested(_targets(KING_STEPS)),
    "up_t": _lit_nested(_targets([(-1, 1), (1, 1)])),      # squares diagonally toward rank 8
    "dn_t": _lit_nested(_targets([(-1, -1), (1, -1)])),    # squares diagonally toward rank 1
    "ray_t": _lit_nested(_rays()),
}
_KN_AT, _KG_AT, _UP_AT, _DOWN_AT, _RAYS_AT = "kn_t", "kg_t", "up_t", "dn_t", "ray_t"
_EMPTY_MOVES = "CAST(array() AS array<struct<fr:int,to:int,pr:string>>)"
_EMPTY_INTS = "CAST(array() AS array<int>)"


# ---- SQL text builders ------------------------------------------------------------------------------------------
def _ch(b: str, i: str) -> str:
    return f"substring({b}, ({i}) + 1, 1)"


def _own(c: str) -> str:
    return f"({c} <> '.' AND ({c} = upper({c})) = _w)"


def _enemy(c: str) -> str:
    return f"({c} <> '.' AND ({c} = upper({c})) <> _w)"


def _enemy_piece(letter: str) -> str:
    return f"(CASE WHEN _w THEN '{letter.lower()}' ELSE '{letter}' END)"


def _let(value: str, var: str, body: str) -> str:
    """Bind ``value`` to a lambda variable once and evaluate ``body`` with it."""
    return f"get(transform(array({value}), {var} -> {body}), 0)"


def _move(fr: str, to: str, pr: str = "''") -> str:
    return f"named_struct('fr', CAST({fr} AS INT), 'to', CAST({to} AS INT), 'pr', {pr})"


def _first_piece(b: str, ray: str) -> str:
    """First non-empty square's character along a ray (array of squares); null if none. The ray's squares
    are filtered as integers and only the blocker's character is fetched."""
    return _ch(b, f"get(filter({ray}, q -> {_ch(b, 'q')} <> '.'), 0)")


def _attacked(b: str, t: str) -> str:
    """Whether square ``t`` is attacked on board ``b`` by the side not to move."""
    # enemy pawns attack t from the squares diagonally ahead of it (seen from the side to move)
    pawn_from = f"(CASE WHEN _w THEN get({_UP_AT}, tt) ELSE get({_DOWN_AT}, tt) END)"
    knight = f"exists(get({_KN_AT}, tt), q -> {_ch(b, 'q')} = {_enemy_piece('N')})"
    king = f"exists(get({_KG_AT}, tt), q -> {_ch(b, 'q')} = {_enemy_piece('K')})"
    pawn = f"exists({pawn_from}, q -> {_ch(b, 'q')} = {_enemy_piece('P')})"
    # a ray with no piece on it yields NULL; coalesce keeps the test two-valued
    rays = f"get({_RAYS_AT}, tt)"
    rook = (f"exists(slice({rays}, 1, 4), ry -> coalesce({_first_piece(b, 'ry')} "
            f"IN ({_enemy_piece('R')}, {_enemy_piece('Q')}), false))")
    bishop = (f"exists(slice({rays}, 5, 4), ry -> coalesce({_first_piece(b, 'ry')} "
              f"IN ({_enemy_piece('B')}, {_enemy_piece('Q')}), false))")
    return _let(t, "tt", f"({pawn} OR {knight} OR {rook} OR {bishop} OR {king})")


def _steps(table: str, s: str) -> str:
    return f"filter(get({table}, {s}), t -> NOT {_own(_ch('_b', 't'))})"


def _slides(s: str) -> str:
    kind = f"upper({_ch('_b', s)})"
    lo = f"(CASE {kind} WHEN 'B' THEN 5 ELSE 1 END)"
    n = f"(CASE {kind} WHEN 'Q' THEN 8 ELSE 4 END)"
    block = f"array_position(transform(ry, j -> {_ch('_b', 'j')} <> '.'), true)"
    body = f"filter(ry, (i, n) -> bk = 0 OR n < bk - 1 OR (n = bk - 1 AND {_enemy(_ch('_b', 'i'))}))"
    return f"flatten(transform(slice(get({_RAYS_AT}, {s}), {lo}, {n}), ry -> {_let(block, 'bk', body)}))"


def _pawn(s: str) -> str:
    step = "(CASE WHEN _w THEN -8 ELSE 8 END)"
    rank = f"(7 - floor({s} / 8))"
    start = "(CASE WHEN _w THEN 1 ELSE 6 END)"
    last = "(CASE WHEN _w THEN 6 ELSE 1 END)"
    one, two = f"({s} + {step})", f"({s} + 2 * {step})"
    caps = f"(CASE WHEN _w THEN get({_UP_AT}, {s}) ELSE get({_DOWN_AT}, {s}) END)"
    targets = (
        f"concat("
        f"CASE WHEN {one} BETWEEN 0 AND 63 AND {_ch('_b', one)} = '.' THEN array({one}) ELSE {_EMPTY_INTS} END, "
        f"CASE WHEN {rank} = {start} AND {_ch('_b', one)} = '.' AND {_ch('_b', two)} = '.' THEN array({two}) "
        f"ELSE {_EMPTY_INTS} END, "
        f"filter({caps}, q -> {_enemy(_ch('_b', 'q'))} OR q = _ep))"
    )
    promo = "array(" + ", ".join(f"'{p}'" for p in PROMOTIONS) + ")"
    return (
        f"CASE WHEN {rank} = {last} "
        f"THEN flatten(transform({targets}, t -> transform({promo}, pp -> {_move(s, 't', 'pp')}))) "
        f"ELSE transform({targets}, t -> {_move(s, 't')}) END"
    )


def _generate(s: str) -> str:
    kind = f"upper({_ch('_b', s)})"
    return (
        f"CASE {kind} WHEN 'P' THEN {_pawn(s)} "
        f"WHEN 'N' THEN transform({_steps(_KN_AT, s)}, t -> {_move(s, 't')}) "
        f"WHEN 'K' THEN transform({_steps(_KG_AT, s)}, t -> {_move(s, 't')}) "
        f"ELSE transform({_slides(s)}, t -> {_move(s, 't')}) END"
    )


# fixed values: castling rules as (white?, right letter, king from, king to, rook square, squares that must
# be empty, squares the king passes that must not be attacked)
CASTLING = [
    (True, "K", 60, 62, 63, [61, 62], [60, 61]),
    (True, "Q", 60, 58, 56, [57, 58, 59], [60, 59]),
    (False, "k", 4, 6, 7, [5, 6], [4, 5]),
    (False, "q", 4, 2, 0, [1, 2, 3], [4, 3]),
]


def _castles() -> str:
    specs = "array(" + ", ".join(
        f"named_struct('w', {str(w).lower()}, 'r', '{r}', 'kf', {kf}, 'kt', {kt}, 'rk', {rk}, "
        f"'e', {_lit(e)}, 's', {_lit(sf)})"
        for w, r, kf, kt, rk, e, sf in CASTLING
    ) + ")"
    king = "(CASE WHEN _w THEN 'K' ELSE 'k' END)"
    rook = "(CASE WHEN _w THEN 'R' ELSE 'r' END)"
    ok = (
        f"cs.w = _w AND instr(_cr, cs.r) > 0 AND {_ch('_b', 'cs.kf')} = {king} AND {_ch('_b', 'cs.rk')} = {rook} "
        f"AND forall(cs.e, q -> {_ch('_b', 'q')} = '.') AND NOT exists(cs.s, sq -> {_attacked('_b', 'sq')})"
    )
    return (f"(CASE WHEN _cr = '-' THEN {_EMPTY_MOVES} "
            f"ELSE transform(filter({specs}, cs -> {ok}), cs -> {_move('cs.kf', 'cs.kt')}) END)")


def _after(m: str) -> str:
    """Board after candidate ``m`` (piece moved, promotion, en-passant victim, castling rook)."""
    p = _ch("_b", f"{m}.fr")
    placed = f"(CASE WHEN {m}.pr <> '' THEN (CASE WHEN _w THEN upper({m}.pr) ELSE {m}.pr END) ELSE {p} END)"
    nb = f"overlay(overlay(_b PLACING '.' FROM {m}.fr + 1 FOR 1) PLACING {placed} FROM {m}.to + 1 FOR 1)"
    victim = f"CAST(floor({m}.fr / 8) * 8 + {m}.to % 8 AS INT)"
    nb = (
        f"(CASE WHEN upper({p}) = 'P' AND {m}.to = _ep AND {m}.fr % 8 <> {m}.to % 8 "
        f"THEN overlay({nb} PLACING '.' FROM {victim} + 1 FOR 1) ELSE {nb} END)"
    )
    rf = f"(CASE WHEN {m}.to % 8 = 6 THEN {m}.to + 1 ELSE {m}.to - 2 END)"
    rt = f"(CASE WHEN {m}.to % 8 = 6 THEN {m}.to - 1 ELSE {m}.to + 1 END)"
    rook = _ch("_b", rf)
    return (
        f"(CASE WHEN upper({p}) = 'K' AND abs({m}.to - {m}.fr) = 2 "
        f"THEN overlay(overlay({nb} PLACING '.' FROM {rf} + 1 FOR 1) PLACING {rook} FROM {rt} + 1 FOR 1) "
        f"ELSE {nb} END)"
    )


def _pinned() -> str:
    """Squares of own pieces pinned to the own king: on each of the eight king rays, the first piece is
    own and the second is an enemy slider moving along that ray (rook/queen straight, bishop/queen
    diagonal). Computed once per position."""
    occ = "filter(ry, j -> " + _ch("_b", "j") + " <> '.')"
    straight = f"array({_enemy_piece('R')}, {_enemy_piece('Q')})"
    diagonal = f"array({_enemy_piece('B')}, {_enemy_piece('Q')})"
    sliders = f"(CASE WHEN n < 4 THEN {straight} ELSE {diagonal} END)"
    pin = (f"CASE WHEN size(occ) >= 2 AND {_own(_ch('_b', 'occ[0]'))} "
           f"AND array_contains({sliders}, {_ch('_b', 'occ[1]')}) THEN occ[0] ELSE -1 END")
    per_line = f"transform(get({_RAYS_AT}, _k), (ry, n) -> {_let(occ, 'occ', pin)})"
    return f"filter({per_line}, q -> q >= 0)"


def _legal_sql() -> str:
    own_squares = f"filter(sequence(0, 63), s -> {_own(_ch('_b', 's'))})"
    cands = f"concat(flatten(transform({own_squares}, s -> {_generate('s')})), {_castles()})"
    ksq = f"(CASE WHEN upper({_ch('_b', 'm.fr')}) = 'K' THEN m.to ELSE _k END)"
    safe = f"NOT {_let(_after('m'), 'bb', _attacked('bb', ksq))}"
    # Only a king move, a move out of check, a move onto the en-passant square (the capture can uncover a
    # rank) or a move of a pinned piece can expose the king; every other pseudo-legal move is legal
    # without the attack test.
    risky = f"(upper({_ch('_b', 'm.fr')}) = 'K' OR chk OR m.to = _ep OR array_contains(pins, m.fr))"
    legal = f"filter({cands}, m -> NOT {risky} OR {safe})"
    name = "concat(substring('abcdefgh', {i} % 8 + 1, 1), CAST(8 - floor({i} / 8) AS STRING))"
    uci = f"concat({name.format(i='u.fr')}, {name.format(i='u.to')}, u.pr)"
    # ``chk`` (side to move in check) and ``pins`` are bound once per position by a let, not as columns:
    # a column used once inside a lambda would be inlined by the optimizer and re-evaluated per candidate.
    body = f"array_sort(transform({legal}, u -> {uci}))"
    expr = _let(_attacked("_b", "_k"), "chk", _let(_pinned(), "pins", body))
    for name, table in _TABLES.items():
        expr = _let(table, name, expr)
    return expr


LEGAL_MOVES_SQL = _legal_sql()


def legal_moves(df: DataFrame, fen: str, out: str = "moves") -> DataFrame:
    """Adds ``out`` = sorted UCI strings of every legal move of the position in column ``fen``."""
    w = C.fen_field(fen, 1) == F.lit("w")
    ep = C.fen_field(fen, 3)
    bound = df.select(
        "*",
        C.board64(fen).alias("_b"),
        w.alias("_w"),
        F.when(ep == F.lit("-"), F.lit(-1)).otherwise(C.square_index(ep)).cast("int").alias("_ep"),
        F.coalesce(C.fen_field(fen, 2), F.lit("-")).alias("_cr"),
    )
    king = F.when(F.col("_w"), F.lit("K")).otherwise(F.lit("k"))
    bound = bound.withColumn("_k", (F.instr(F.col("_b"), king) - 1).cast("int"))
    return bound.withColumn(out, F.expr(LEGAL_MOVES_SQL)).drop("_b", "_w", "_ep", "_cr", "_k")



def _ep_legal_sql() -> str:
    """Whether the side to move has a legal en-passant capture onto ``_ep`` (the pawn that just advanced
    two squares stands beside the capturer); each of the at most two captures is tested for king safety
    on the board after it."""
    pushed = "(_ep + CASE WHEN _w THEN 8 ELSE -8 END)"
    own_pawn = "(CASE WHEN _w THEN 'P' ELSE 'p' END)"
    capturers = (f"filter(array({pushed} - 1, {pushed} + 1), q -> q BETWEEN 0 AND 63 "
                 f"AND floor(q / 8) = floor({pushed} / 8) AND {_ch('_b', 'q')} = {own_pawn})")
    cand = "named_struct('fr', CAST(q AS INT), 'to', CAST(_ep AS INT), 'pr', '')"
    safe = _let(cand, "m", f"NOT {_let(_after('m'), 'bb', _attacked('bb', '_k'))}")
    expr = f"exists({capturers}, q -> {safe})"
    for name, table in _TABLES.items():
        expr = _let(table, name, expr)
    return expr


EP_LEGAL_SQL = _ep_legal_sql()


def apply_moves(df: DataFrame, fen: str, move, out: str = "fen_after") -> DataFrame:
    """B11 as a table operator. The move and the expanded board are materialised by a projection first
    (the move is read at a dozen places of the position arithmetic). The en-passant field of the result
    is kept only when the side to move has a *legal* en-passant capture (a capture that would expose its
    own king, e.g. along the rank, does not count), so position keys compare like the rules library's."""
    mv = F.col(move) if isinstance(move, str) else move
    staged = df.select("*", mv.alias("_mv"), C.board64(fen).alias("_b64"))
    moved = staged.withColumn("_nf", C.apply_move(fen, "_mv", board=F.col("_b64"))).drop("_mv", "_b64")
    ep = C.fen_field("_nf", 3)
    check = moved.select(
        "*",
        C.board64("_nf").alias("_b"),
        (C.fen_field("_nf", 1) == F.lit("w")).alias("_w"),
        F.when(ep.isNull() | (ep == F.lit("-")), F.lit(-1)).otherwise(C.square_index(ep)).cast("int").alias("_ep"),
    )
    king = F.when(F.col("_w"), F.lit("K")).otherwise(F.lit("k"))
    check = check.withColumn("_k", (F.instr(F.col("_b"), king) - 1).cast("int"))
    keep = (F.col("_ep") < 0) | F.expr(EP_LEGAL_SQL)
    fields = [C.fen_field("_nf", i) for i in range(6)]
    cleared = F.concat_ws(" ", fields[0], fields[1], fields[2], F.lit("-"), fields[4], fields[5])
    result = F.when(F.col("_nf").isNull() | keep, F.col("_nf")).otherwise(cleared)
    return check.withColumn(out, result).drop("_nf", "_b", "_w", "_ep", "_k")
