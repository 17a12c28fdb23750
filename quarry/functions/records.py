"""Prompt text and training/evaluation record shapes.

Records are built as nested columns (``struct`` / ``array<struct>``) in one projection; nothing is
assembled on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import merge_metadata

# ---- fixed values: prompt templates ---------------------------------------------------------------------
# Student prompt, one line each; "{fen}", "{pieces}" and "{moves}" are filled per row.
STUDENT_LINES = [
    "You are given a chess position in FEN: {fen}.",
    "Piece positions: {pieces}",
    "Legal moves: {moves}",
    "Find the best move for the side to play.",
    "Analyze step by step and explain your reasoning.",
    "Finish with a single line formatted EXACTLY as:",
    "FINAL_ANSWER: <answer>",
    "Use UCI notation (e.g., e2e4, c2b1q) for the final answer.",
]

# Teacher prompt: head, context block, optional continuation line, task block.
TEACHER_HEAD = (
    "You are a chess grandmaster generating training data for teaching small LLMs to solve chess puzzles.\n\n"
    "CRITICAL: The small model only sees the FEN string. Your analysis must show how to go from FEN → piece "
    "positions → tactical relationships → solution. Ground everything in explicit square names.\n\n"
    "CONTEXT (use this to ground your analysis; present everything as your own reasoning, never as something you "
    "were told):\n"
)
TEACHER_CONTEXT = (
    "FEN: {fen}\nBoard:\n{board}\nPieces: {pieces}\nSide to Move: {side}\nOpponent's Last Move: {opp}\n"
    "Solution: {move}\nRating: {rating}\nThemes: {themes}\nLegal Moves: {legal}"
)
TEACHER_TASK = (
    "\n\nTASK: Write natural chain-of-thought analysis arriving at {move}.\n\n"
    "Your analysis should cover (in natural prose, vary the structure):\n"
    "- Where key pieces are (use square names: \"the queen on h5\", \"king on g1\")\n"
    "- What tactical relationship exists (attacks, pins, weak squares, defender counts)\n"
    "- Why the move works (what it threatens, why opponent can't respond adequately)\n\n"
    "Style:\n"
    "- Objective voice, no \"I see/notice\"\n"
    "- Standard notation with brief clarification when helpful: \"Qxh7+ (queen takes h7 with check)\"\n"
    "- Justify the move through the key tactical idea and main threat; keep any deeper continuation brief and "
    "mention only follow-up moves you are certain are legal. Present everything as your own reasoning - never "
    "reference the provided fields (rating, themes, solution, PV, legal moves) as sources, and never imply you "
    "were given the answer\n"
    "- 4-10 sentences, scaled to complexity\n\n"
    "End with exactly: FINAL_ANSWER: {move}"
)
SKIP_CONTINUATION_TAG = "mateIn1"
RECORD_DATA_SOURCE = "chess_puzzles"
RECORD_ABILITY = "chess"
RECORD_STYLE = "rule"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fill(template: str, values: dict[str, Column]) -> Column:
    """Template with ``{name}`` holes -> ``concat`` of literals and columns."""
    parts: list[Column] = []
    rest = template
    while rest:
        i = rest.find("{")
        if i < 0:
            parts.append(F.lit(rest))
            break
        j = rest.index("}", i)
        if i:
            parts.append(F.lit(rest[:i]))
        parts.append(values[rest[i + 1 : j]])
        rest = rest[j + 1 :]
    return F.concat(*parts)


# ---- B2 ---------------------------------------------------------------------------------------------------------
def as_messages(content, role: str = "user") -> Column:
    """``array<struct<role, content>>`` with one message."""
    return F.array(F.struct(F.lit(role).alias("role"), _col(content).alias("content")))


# ---- B13a / B13b / B25 ------------------------------------------------------------------------------------------
def student_prompt(fen, pieces, moves) -> Column:
    """Student prompt from a position, its piece inventory and its legal moves (array of UCI strings)."""
    joined = F.array_join(_col(moves), ", ")
    return _fill("\n".join(STUDENT_LINES), {"fen": _col(fen), "pieces": _col(pieces), "moves": joined})


def teacher_prompt(fen, board, pieces, side, opponent_move, move, rating, themes, legal_moves, moves) -> Column:
    """Teacher prompt. ``themes`` is the raw tag string; ``moves`` the full move list (opponent first).

    The continuation line is added unless the raw tag string *contains* ``mateIn1`` (a substring test, as
    in the reference). Legal moves are listed in UCI (algebraic notation is not built).
    """
    all_moves = F.split(_col(moves), " ")
    cont_moves = F.array_join(F.slice(all_moves, 2, F.greatest(F.size(all_moves) - 1, F.lit(0))), " ")
    values = {
        "fen": _col(fen),
        "board": _col(board),
        "pieces": _col(pieces),
        "side": _col(side),
        "opp": _col(opponent_move),
        "move": _col(move),
        "rating": _col(rating).cast("string"),
        "themes": F.replace(_col(themes), F.lit(" "), F.lit(", ")),
        "legal": F.array_join(_col(legal_moves), ", "),
    }
    pv = F.when(~_col(themes).contains(SKIP_CONTINUATION_TAG), F.concat(F.lit("\nPV: "), cont_moves)).otherwise(
        F.lit("")
    )
    return F.concat(F.lit(TEACHER_HEAD), _fill(TEACHER_CONTEXT, values), pv, _fill(TEACHER_TASK, {"move": _col(move)}))


# ---- B17 / B18 ----------------------------------------------------------------------------------------------------
def to_sft(df: DataFrame, instruction, output, extra: list[str] | None = None) -> DataFrame:
    """SFT record ``instruction, input (''), output``."""
    return df.select(
        *(extra or []),
        _col(instruction).alias("instruction"),
        F.lit("").alias("input"),
        _col(output).alias("output"),
    )


def to_rl(
    df: DataFrame,
    prompt,
    ground_truth,
    info: dict[str, Column | str],
    data_source: str = RECORD_DATA_SOURCE,
    ability: str = RECORD_ABILITY,
    style: str = RECORD_STYLE,
) -> DataFrame:
    """RL / test record: ``data_source, prompt, ability, reward_model, extra_info`` (typed struct info)."""
    return df.select(
        F.lit(data_source).alias("data_source"),
        as_messages(prompt).alias("prompt"),
        F.lit(ability).alias("ability"),
        F.struct(_col(ground_truth).alias("ground_truth"), F.lit(style).alias("style")).alias("reward_model"),
        F.struct(*[_col(v).alias(k) for k, v in info.items()]).alias("extra_info"),
    )


def to_test_record(df: DataFrame, prompt, ground_truth, fen, kind, metadata_json) -> DataFrame:
    """Test record: ``extra_info`` is ``map<string,string>``: fen and type, then every key of the JSON
    metadata object, which wins on a clash."""
    base = F.create_map(F.lit("fen"), _col(fen), F.lit("type"), _col(kind))
    return df.select(
        F.lit(RECORD_DATA_SOURCE).alias("data_source"),
        as_messages(prompt).alias("prompt"),
        F.lit(RECORD_ABILITY).alias("ability"),
        F.struct(_col(ground_truth).alias("ground_truth"), F.lit(RECORD_STYLE).alias("style")).alias("reward_model"),
        merge_metadata(base, metadata_json).alias("extra_info"),
    )


# ---- B23 ----------------------------------------------------------------------------------------------------------
def flatten_info(df: DataFrame, col: str = "extra_info", keys: list[str] | None = None) -> DataFrame:
    """Spread an info column over the row; an info key wins over a same-named column.

    A struct spreads all its fields (or ``keys``). The keys of a map are data, so the ones to spread are named in
    ``keys`` (``info_keys`` finds them; absent ones are null); without them a map column stays as it is."""
    kind = df.schema[col].dataType
    fields = keys if keys is not None else kind.fieldNames() if isinstance(kind, T.StructType) else None
    if fields is None:
        return df
    keep = [c for c in df.columns if c != col and c not in fields]
    return df.select(*keep, *[F.col(col)[f].alias(f) for f in fields])


MAX_INFO_KEYS = 4096  # columns that the keys of an info column may become


def _bounded_keys(keys: DataFrame, what: str) -> list:
    found = keys.limit(MAX_INFO_KEYS + 1).collect()
    if len(found) > MAX_INFO_KEYS:
        raise ValueError(f"{what} has more than {MAX_INFO_KEYS} keys")
    return sorted(found, key=lambda r: r[0])


def info_keys(df: DataFrame, col: str = "extra_info") -> list[str]:
    """The keys that occur in a map column (one job), for ``flatten_info``."""
    return [r[0] for r in _bounded_keys(df.select(F.explode(F.map_keys(col)).alias("key")).distinct(), col)]


def info_schema(df: DataFrame, col: str) -> dict[str, str]:
    """The keys of a column of JSON objects and the type that holds all values of each, found from the data (one job).

    Values are parsed as VARIANT; their types are merged by key, as partial aggregates. A key whose values have no type
    in common, are objects, or are all null is a string (objects and mixed values as JSON text). Text that is no JSON
    object has no keys."""
    info = df.select(F.try_parse_json(col).alias("_info")).filter("schema_of_variant(_info) like 'OBJECT<%'")
    cells = info.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_info").outer()))
    found = cells.groupBy("key").agg(F.schema_of_variant_agg("value").alias("kind"))
    loose = lambda kind: any(x in kind for x in ("OBJECT", "VARIANT", "VOID"))
    return {r.key: "STRING" if loose(r.kind) else r.kind for r in _bounded_keys(found, col)}


def spread_info(df: DataFrame, col: str, schema: dict[str, str] | None = None) -> DataFrame:
    """B23 for a column of JSON objects: its keys, found and typed from the data unless a ``schema`` is given, as
    columns; a key wins over a same-named column. Absent keys, and rows without a JSON object, are null."""
    schema = info_schema(df, col) if schema is None else schema
    if len({k.lower() for k in schema}) < len(schema):
        raise ValueError(f"keys of {col} differ in case only: {sorted(schema)}")
    taken = {k.lower() for k in schema}
    keep = [F.col(f"`{c}`") for c in df.columns if c != col and c.lower() not in taken]
    if not schema:
        return df.select(*keep)
    quoted = {k: "`" + k.replace("`", "``") + "`" for k in schema}
    ddl = "struct<" + ", ".join(f"{quoted[k]}: {kind}" for k, kind in schema.items()) + ">"
    rows = df.select(*keep, F.try_variant_get(F.try_parse_json(f"`{col}`"), "$", ddl).alias("_info"))
    return rows.select(*(F.col(f"`{c}`") for c in rows.columns[:-1]), *(F.col(f"_info.{quoted[k]}").alias(k) for k in schema))


# ---- B26 ----------------------------------------------------------------------------------------------------------
def drop_overlong(df: DataFrame, col: str, max_tokens: int, counter=None, out: str | None = None) -> DataFrame:
    """Drop rows whose text has more than ``max_tokens`` tokens (default counter: whitespace tokens). ``out`` names a
    column for the count, which is then taken once."""
    from quarry.functions.text import token_count

    n = token_count(col) if counter is None else token_count(col, counter)
    if out is None:
        return df.filter(n <= F.lit(max_tokens))
    return df.withColumn(out, n).filter(F.col(out) <= F.lit(max_tokens))
