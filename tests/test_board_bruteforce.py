"""B11 / B12 against a brute-force move generator on positions reached by seeded random play.

The generator below is a plain, square-by-square implementation of the rules, used only here: it makes
each pseudo-legal move on a copy of the board and keeps it when the mover's king is not attacked. The
positions are walks of random legal moves from the published test positions, so they reach castling,
en passant, promotions, pins and checks. Spark's ``legal_moves`` must return the same sorted UCI list,
and ``apply_moves`` the same next position string, for every position and move.
"""

import random

from quarry.operators import board
from tests.positions import POSITIONS

FILES = "abcdefgh"
KNIGHT = [(1, 2), (2, 1), (2, -1), (1, -2), (-1, -2), (-2, -1), (-2, 1), (-1, 2)]
KING = [(1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1)]
ROOK = [(1, 0), (-1, 0), (0, 1), (0, -1)]
BISHOP = [(1, 1), (1, -1), (-1, 1), (-1, -1)]


def name(f, r):
    return FILES[f] + str(r + 1)


def parse(fen):
    place, side, rights, ep, half, full = fen.split()
    sq = {}
    for i, row in enumerate(place.split("/")):
        f = 0
        for ch in row:
            if ch.isdigit():
                f += int(ch)
            else:
                sq[(f, 7 - i)] = ch
                f += 1
    return {"sq": sq, "white": side == "w", "rights": "" if rights == "-" else rights,
            "ep": None if ep == "-" else (FILES.index(ep[0]), int(ep[1]) - 1), "half": int(half), "full": int(full)}


def is_white(p):
    return p.isupper()


def attacked(sq, f, r, by_white):
    def has(x, y, kinds):
        p = sq.get((x, y))
        return p is not None and is_white(p) == by_white and p.upper() in kinds

    d = -1 if by_white else 1  # an attacking pawn stands one rank behind, from its own point of view
    if any(has(f + df, r + d, "P") for df in (-1, 1)):
        return True
    if any(has(f + a, r + b, "N") for a, b in KNIGHT) or any(has(f + a, r + b, "K") for a, b in KING):
        return True
    for dirs, kinds in ((ROOK, "RQ"), (BISHOP, "BQ")):
        for a, b in dirs:
            x, y = f + a, r + b
            while 0 <= x < 8 and 0 <= y < 8:
                if (x, y) in sq:
                    if has(x, y, kinds):
                        return True
                    break
                x, y = x + a, y + b
    return False


def pseudo(pos):
    sq, white = pos["sq"], pos["white"]
    out = []
    for (f, r), p in list(sq.items()):
        if is_white(p) != white:
            continue
        k = p.upper()

        def add(x, y, promo=""):
            out.append(((f, r), (x, y), promo))

        def free_or_enemy(x, y):
            t = sq.get((x, y))
            return 0 <= x < 8 and 0 <= y < 8 and (t is None or is_white(t) != white)

        if k == "P":
            d, start, last = (1, 1, 7) if white else (-1, 6, 0)
            targets = []
            if (f, r + d) not in sq:
                targets.append((f, r + d))
                if r == start and (f, r + 2 * d) not in sq:
                    targets.append((f, r + 2 * d))
            for df in (-1, 1):
                x, y = f + df, r + d
                t = sq.get((x, y))
                if 0 <= x < 8 and ((t is not None and is_white(t) != white) or pos["ep"] == (x, y)):
                    targets.append((x, y))
            for x, y in targets:
                for promo in ("q", "r", "b", "n") if y == last else ("",):
                    add(x, y, promo)
        elif k in "NK":
            for a, b in KNIGHT if k == "N" else KING:
                if free_or_enemy(f + a, r + b):
                    add(f + a, r + b)
        else:
            dirs = {"R": ROOK, "B": BISHOP, "Q": ROOK + BISHOP}[k]
            for a, b in dirs:
                x, y = f + a, r + b
                while 0 <= x < 8 and 0 <= y < 8:
                    t = sq.get((x, y))
                    if t is None or is_white(t) != white:
                        add(x, y)
                    if t is not None:
                        break
                    x, y = x + a, y + b
    # castling: right present, king and rook home, squares between empty, king path not attacked
    home = 0 if white else 7
    king, rook = ("K", "R") if white else ("k", "r")
    for right, rook_f, between, path in (("K", 7, (5, 6), (4, 5, 6)), ("Q", 0, (1, 2, 3), (4, 3, 2))):
        r_char = right if white else right.lower()
        if (r_char in pos["rights"] and sq.get((4, home)) == king and sq.get((rook_f, home)) == rook
                and all((x, home) not in sq for x in between)
                and not any(attacked(sq, x, home, not white) for x in path)):
            out.append(((4, home), (path[-1], home), ""))
    return out


def make(pos, move):
    (f, r), (x, y), promo = move
    sq = dict(pos["sq"])
    white = pos["white"]
    p = sq.pop((f, r))
    captured = (x, y) in sq
    ep_take = p.upper() == "P" and pos["ep"] == (x, y) and f != x
    if ep_take:
        sq.pop((x, r))
    sq[(x, y)] = (promo.upper() if white else promo) if promo else p
    if p.upper() == "K" and abs(x - f) == 2:
        rf, rt = (7, 5) if x == 6 else (0, 3)
        sq[(rt, y)] = sq.pop((rf, y))
    rights = pos["rights"]
    lost = set()
    if p == "K":
        lost |= {"K", "Q"}
    if p == "k":
        lost |= {"k", "q"}
    for corner, right in (((7, 0), "K"), ((0, 0), "Q"), ((7, 7), "k"), ((0, 7), "q")):
        if corner in ((f, r), (x, y)):
            lost.add(right)
    rights = "".join(c for c in rights if c not in lost)
    ep = ((f, (r + y) // 2) if p.upper() == "P" and abs(y - r) == 2 else None)
    nxt = {"sq": sq, "white": not white, "rights": rights, "ep": ep,
           "half": 0 if p.upper() == "P" or captured or ep_take else pos["half"] + 1,
           "full": pos["full"] + (0 if white else 1)}
    if ep is not None and not any(m[1] == ep and nxt["sq"][m[0]].upper() == "P" for m in legal(nxt)):
        nxt["ep"] = None  # printed only when a legal en-passant capture exists
    return nxt


def own_king_safe(pos):
    white = not pos["white"]  # the side that just moved
    king = "K" if white else "k"
    (kf, kr), = [s for s, p in pos["sq"].items() if p == king]
    return not attacked(pos["sq"], kf, kr, not white)


def legal(pos):
    return [m for m in pseudo(pos) if own_king_safe(make_board_only(pos, m))]


def make_board_only(pos, move):
    # the board after a move, for the safety test (no recursion into the en-passant rule)
    (f, r), (x, y), promo = move
    sq = dict(pos["sq"])
    p = sq.pop((f, r))
    if p.upper() == "P" and pos["ep"] == (x, y) and f != x:
        sq.pop((x, r))
    sq[(x, y)] = (promo.upper() if pos["white"] else promo) if promo else p
    if p.upper() == "K" and abs(x - f) == 2:
        rf, rt = (7, 5) if x == 6 else (0, 3)
        sq[(rt, y)] = sq.pop((rf, y))
    return {"sq": sq, "white": not pos["white"]}


def fen(pos):
    rows = []
    for r in range(7, -1, -1):
        row, gap = "", 0
        for f in range(8):
            p = pos["sq"].get((f, r))
            if p is None:
                gap += 1
            else:
                row += (str(gap) if gap else "") + p
                gap = 0
        rows.append(row + (str(gap) if gap else ""))
    ep = "-" if pos["ep"] is None else name(*pos["ep"])
    return " ".join(["/".join(rows), "w" if pos["white"] else "b", pos["rights"] or "-", ep,
                     str(pos["half"]), str(pos["full"])])


def uci(m):
    return name(*m[0]) + name(*m[1]) + m[2]


def walks(seed=7, per_start=6, plies=24):
    rng = random.Random(seed)
    seen, cases = set(), []
    for start, _ in POSITIONS:
        for _ in range(per_start):
            pos = parse(start)
            for _ in range(plies):
                moves = legal(pos)
                if not moves:
                    break
                # favour the special moves so they are reached often
                special = [m for m in moves if m[2] or (pos["sq"][m[0]].upper() == "K" and abs(m[1][0] - m[0][0]) == 2)
                           or (pos["sq"][m[0]].upper() == "P" and (m[1] == pos["ep"] or abs(m[1][1] - m[0][1]) == 2))]
                m = rng.choice(special) if special and rng.random() < 0.5 else rng.choice(moves)
                key = fen(pos)
                if key not in seen:
                    seen.add(key)
                    cases.append((key, sorted(uci(x) for x in moves), uci(m), fen(make(pos, m))))
                pos = make(pos, m)
    return cases


def test_brute_force_model_matches_published_counts():
    for start, count in POSITIONS:
        assert len(legal(parse(start))) == count


def test_legal_moves_and_apply_move_match_brute_force(spark):
    cases = walks()
    assert len(cases) > 300
    df = spark.createDataFrame(cases, "fen string, want array<string>, mv string, after string")
    got = board.apply_moves(board.legal_moves(df, "fen"), "fen", "mv").collect()
    bad_moves = [(r.fen, sorted(set(r.want) ^ set(r.moves))) for r in got if r.moves != r.want]
    bad_after = [(r.fen, r.mv, r.fen_after, r.after) for r in got if r.fen_after != r.after]
    assert not bad_moves, bad_moves[:5]
    assert not bad_after, bad_after[:5]
    # the walks reach the special moves
    assert any(r.mv in ("e1g1", "e1c1", "e8g8", "e8c8") for r in got)
    assert any(len(r.mv) == 5 for r in got)
    assert any(r.fen.split()[3] != "-" for r in got)
