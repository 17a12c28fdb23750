"""Position strings as columns: expansion to a 64-character board, board text, side to move, move lists,
piece inventory and applying one move (B7, B8, B9, B10, B11).

A position's piece placement is expanded once into a 64-character string, index 0 = a8 ... 63 = h1,
'.' for an empty square. Everything else is row-local string arithmetic on that string: no shuffle, no
Python, and Catalyst eliminates the repeated expansion within one projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ---------------------------------------------------------------------------------------
FILES = "abcdefgh"
# Inventory order: colours, then piece kinds, with their letters (upper case = White).
COLORS = ["White", "Black"]
PIECE_NAMES = ["King", "Queen", "Rook", "Bishop", "Knight", "Pawn"]
PIECE_LETTERS = ["K", "Q", "R", "B", "N", "P"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fen_field(fen, i: int) -> Column:
    """0-based whitespace field of a position string (null when absent)."""
    return F.get(F.split(_col(fen), " "), i)


def expand_ranks(fen) -> Column:
    """Placement field with digits written out as dots, ranks still separated by '/'."""
    s = fen_field(fen, 0)
    for d in range(8, 0, -1):
        s = F.regexp_replace(s, str(d), "." * d)
    return s


def board64(fen) -> Column:
    """64-character board, a8 first, h1 last."""
    return F.regexp_replace(expand_ranks(fen), "/", "")


def compress_board(b64: Column) -> Column:
    """Inverse of ``board64``: back to the placement field."""
    ranks = F.concat_ws("/", *[F.substring(b64, 8 * r + 1, 8) for r in range(8)])
    for d in range(8, 0, -1):
        ranks = F.regexp_replace(ranks, r"\." * d, str(d))
    return ranks


def square_index(sq) -> Column:
    """0-based board index of a square name (``a8`` -> 0, ``h1`` -> 63)."""
    s = _col(sq)
    f = F.instr(F.lit(FILES), F.substring(s, 1, 1)) - 1
    r = F.substring(s, 2, 1).cast("int")
    return (8 - r) * 8 + f


def square_name(idx: Column) -> Column:
    return F.concat(F.substring(F.lit(FILES), (idx % 8 + 1).cast("int"), 1), (8 - F.floor(idx / 8)).cast("string"))


# ---- B7 / B9 / B10 --------------------------------------------------------------------------------------------
def board_text(fen) -> Column:
    """Eight text lines, rank 8 first, squares separated by a space, '.' for empty."""
    spaced = F.regexp_replace(expand_ranks(fen), r"([^/])(?=[^/])", "$1 ")
    return F.regexp_replace(spaced, "/", "\n")


def side_to_move(fen) -> Column:
    return F.when(fen_field(fen, 1) == F.lit("w"), F.lit("White")).otherwise(F.lit("Black"))


def parse_moves(moves) -> Column:
    """``struct<opponent, answer, continuation array<string>>`` from a space-separated move list."""
    arr = F.split(_col(moves), " ")
    return F.struct(
        F.get(arr, 0).alias("opponent"),
        F.get(arr, 1).alias("answer"),
        F.slice(arr, 2, F.greatest(F.size(arr) - 1, F.lit(0))).alias("continuation"),
    )


# ---- B8 ---------------------------------------------------------------------------------------------------------
def occupied(b64: Column) -> Column:
    """``array<struct<p, sq>>`` of the occupied squares of a 64-character board, in board order.

    The board is the array argument of the higher-order function (evaluated once per row); only the
    lambda variables are used inside the lambda, so nothing is recomputed per square.
    """
    cells = F.transform(F.split(b64, ""), lambda ch, i: F.struct(ch.alias("p"), square_name(i).alias("sq")))
    return F.filter(cells, lambda c: (c["p"] != F.lit(".")) & (c["p"] != F.lit("")))


def inventory_from_cells(cells: Column) -> Column:
    """Piece inventory text from ``occupied(...)``: colours, then kinds in fixed order, squares sorted."""
    parts = []
    for color in COLORS:
        for name, letter in zip(PIECE_NAMES, PIECE_LETTERS):
            ch = letter if color == "White" else letter.lower()
            sq = F.array_sort(F.transform(F.filter(cells, lambda c: c["p"] == F.lit(ch)), lambda c: c["sq"]))
            listed = F.array_join(F.transform(sq, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ")
            parts.append(F.when(F.size(sq) > 0, F.concat(F.lit(f"{color} {name}: ["), listed, F.lit("]"))))
    return F.concat_ws(", ", *parts)


def piece_inventory(fen) -> Column:
    """``White King: ['e1'], White Rook: ['a1', 'h1'], ... Black King: ['e8']``; absent kinds omitted.

    Convenience form for small inputs; tables should use ``quarry.operators.board.piece_inventory``, which
    materialises the board and the occupied-cell list once per row.
    """
    return inventory_from_cells(occupied(board64(fen)))


# ---- B11 ----------------------------------------------------------------------------------------------------------
def _char(b: Column, i: Column) -> Column:
    return F.substring(b, (i + 1).cast("int"), 1)


def _put(b: Column, i: Column, ch: Column) -> Column:
    return F.overlay(b, ch, (i + 1).cast("int"), F.lit(1))


def apply_move(fen, move, board: Column | None = None) -> Column:
    """Position string after one UCI move (castling rook, en passant, promotion, rights, clocks).

    The en-passant field is printed only when a pawn of the side to move next stands beside the pushed
    pawn (a capture is possible). The capture is not checked against pins.
    """
    fen, move = _col(fen), _col(move)
    b = board64(fen) if board is None else board
    side = fen_field(fen, 1)
    rights = fen_field(fen, 2)
    ep = fen_field(fen, 3)
    half = fen_field(fen, 4).cast("int")
    full = fen_field(fen, 5).cast("int")
    src = square_index(F.substring(move, 1, 2))
    dst = square_index(F.substring(move, 3, 2))
    promo = F.substring(move, 5, 1)
    piece = _char(b, src)
    kind = F.upper(piece)
    target = _char(b, dst)
    white = side == F.lit("w")
    capture = target != F.lit(".")
    is_pawn = kind == F.lit("P")
    ep_capture = is_pawn & (ep != F.lit("-")) & (dst == square_index(ep)) & ((src % 8) != (dst % 8))
    moved = F.when(promo != F.lit(""), F.when(white, F.upper(promo)).otherwise(F.lower(promo))).otherwise(piece)

    nb = _put(_put(b, src, F.lit(".")), dst, moved)
    # en passant victim: same file as the target, rank of the source
    victim = F.floor(src / 8) * 8 + dst % 8
    nb = F.when(ep_capture, _put(nb, victim, F.lit("."))).otherwise(nb)
    # castling: king moves two files; the rook jumps over it
    castle = (kind == F.lit("K")) & (F.abs(dst % 8 - src % 8) == 2)
    short = dst % 8 == 6
    rook_from = F.when(short, dst + 1).otherwise(dst - 2)
    rook_to = F.when(short, dst - 1).otherwise(dst + 1)
    nb = F.when(castle, _put(_put(nb, rook_from, F.lit(".")), rook_to, _char(b, rook_from))).otherwise(nb)

    # rights lost by king moves, rook moves and captures on the rook corners (a8=0, h8=7, a1=56, h1=63)
    def drop(r: Column, letter: str, cond: Column) -> Column:
        return F.when(cond, F.regexp_replace(r, letter, "")).otherwise(r)

    touched = lambda sq: (src == F.lit(sq)) | (dst == F.lit(sq))
    r = F.when(rights == F.lit("-"), F.lit("")).otherwise(rights)
    r = drop(r, "K", (piece == F.lit("K")) | touched(63))
    r = drop(r, "Q", (piece == F.lit("K")) | touched(56))
    r = drop(r, "k", (piece == F.lit("k")) | touched(7))
    r = drop(r, "q", (piece == F.lit("k")) | touched(0))
    r = F.when(r == F.lit(""), F.lit("-")).otherwise(r)

    # en-passant square after a double push, printed only if an enemy pawn can take
    double = is_pawn & (F.abs(dst - src) == 16)
    enemy_pawn = F.when(white, F.lit("p")).otherwise(F.lit("P"))
    left = F.when(dst % 8 > 0, _char(nb, dst - 1)).otherwise(F.lit(""))
    right = F.when(dst % 8 < 7, _char(nb, dst + 1)).otherwise(F.lit(""))
    ep_sq = square_name(((src + dst) / 2).cast("int"))
    new_ep = F.when(double & ((left == enemy_pawn) | (right == enemy_pawn)), ep_sq).otherwise(F.lit("-"))

    new_half = F.when(is_pawn | capture | ep_capture, F.lit(0)).otherwise(half + 1)
    new_full = F.when(white, full).otherwise(full + 1)
    new_side = F.when(white, F.lit("b")).otherwise(F.lit("w"))
    fields = F.concat_ws(" ", compress_board(nb), new_side, r, new_ep, new_half.cast("string"), new_full.cast("string"))
    # no position or no move: no result (concat_ws alone would skip the null fields and emit a fragment)
    return F.when(fen.isNotNull() & move.isNotNull(), fields)
