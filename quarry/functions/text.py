"""Column expressions for tags, keys, answer extraction and scoring, and length policies.

Every function here returns a ``Column`` built from Spark built-ins and can be used in ``select``, ``filter`` or
``groupBy`` alike. Tokens are split and cleaned without lambdas, so these stay inside whole-stage codegen; the
metadata merge uses a lambda, which Spark interprets.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's behaviour) -------------------------------------------
# The answer marker, the UCI move shape that follows it, and the promotion letters.
ANSWER_MARKER = "FINAL_ANSWER:"
UCI_MOVE = "[a-h][1-8][a-h][1-8][qrbn]?"
# Whitespace as Python's Unicode-aware ``\s`` / ``str.strip`` sees it: ASCII \s, the information
# separators U+001C..U+001F, NEL U+0085, and every Unicode space/line/paragraph separator.
PY_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
# Case-insensitive with Unicode case folding, so long s / dotless i / dotted I in the marker match.
ANSWER_PATTERN = r"(?iu)" + ANSWER_MARKER + PY_SPACE + r"*(" + UCI_MOVE + r")"
# Separator of ``str.split()``-style tokenisation: runs of the whitespace above.
TOKEN_SPLIT = PY_SPACE + "+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- B1 / B19: tags --------------------------------------------------------------------------------
def tags(c) -> Column:
    """Whitespace-delimited tags as an array; null text gives an empty array."""
    return F.coalesce(ws_tokens(c), F.array().cast("array<string>"))


def parse_list(c) -> Column:
    """A list literal held in text (``['a', 'b']`` or JSON) as ``array<string>``."""
    return F.from_json(_col(c), "array<string>")


# ---- B3 / B5: keys ---------------------------------------------------------------------------------
def last_segment(c, sep: str = "_") -> Column:
    """Last part of a delimited name (``mate_in_2`` -> ``2``)."""
    return F.split_part(_col(c), F.lit(sep), F.lit(-1))


def prefix_key(c, k: int = 4) -> Column:
    """First ``k`` whitespace-separated fields joined by one space (position key without clocks)."""
    return F.when(_col(c).isNotNull(), F.array_join(first_tokens(c, k), " "))


# ---- B4: metadata merge ----------------------------------------------------------------------------
def merge_metadata(base: Column, json_col) -> Column:
    """Merge a JSON object over a base ``map<string,string>``; keys of the JSON object win.

    Implemented without relying on the session's map-key dedup policy: base keys that the JSON object
    also defines are removed before concatenation.
    """
    extra = F.coalesce(F.from_json(_col(json_col), "map<string,string>"), F.create_map().cast("map<string,string>"))
    kept = F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(extra), k))
    return F.map_concat(kept, extra)


# ---- B14 - B16: answer extraction and scoring ------------------------------------------------------
def extract_answer(c) -> Column:
    """First marked UCI move, lower-cased; null when there is none (or the text is null)."""
    return F.nullif(F.lower(F.regexp_extract(_col(c), ANSWER_PATTERN, 1)), F.lit(""))


def answer_score(resp, truth) -> Column:
    """``struct<score double, binary_score double>``; exact case-insensitive match, never null."""
    hit = F.coalesce((extract_answer(resp) == F.lower(_col(truth))).cast("double"), F.lit(0.0))
    return F.struct(hit.alias("score"), hit.alias("binary_score"))


def is_correct(resp, truth) -> Column:
    return answer_score(resp, truth)["score"] == F.lit(1.0)


# ---- B20: JSON-safe rendering ----------------------------------------------------------------------
def to_plain_json(c) -> Column:
    return F.to_json(_col(c))


# ---- B22 / B26 / B27: lengths ----------------------------------------------------------------------
def ws_tokens(c) -> Column:
    """Whitespace tokens of a text (the default, pluggable token counter)."""
    return F.array_remove(F.split(_col(c), TOKEN_SPLIT), "")


def first_tokens(c, n: int) -> Column:
    """The first ``n`` whitespace tokens. The split stops after them: a leading separator yields one empty part, and
    the last part is the unsplit rest of the text."""
    return F.slice(F.array_remove(F.slice(F.split(_col(c), TOKEN_SPLIT, n + 2), 1, n + 1), ""), 1, n)


def arrow_tokens(encode):
    """A token counter backed by any Python tokenizer ``encode(text) -> list[int]``.

    Runs as an Arrow-batched pandas UDF (a batch of texts per call, never row at a time) and returns the
    token ids as ``array<int>``, so it plugs into ``token_count`` / ``length_flags`` like ``ws_tokens``.
    """
    @F.pandas_udf("array<int>")
    def _encode(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else [int(x) for x in encode(t)])

    return lambda c: _encode(_col(c))


def token_count(c, counter=ws_tokens) -> Column:
    return F.size(counter(c))


def length_flags(c, max_tokens: int, counter=ws_tokens) -> Column:
    """``struct<num_tokens int, clipped boolean>``: clipped means length reached ``max_tokens``."""
    n = token_count(c, counter)
    return F.struct(n.alias("num_tokens"), (n >= F.lit(max_tokens)).alias("clipped"))


def truncate_tokens(c, n: int) -> Column:
    """Keep the first ``n`` whitespace tokens, re-joined by single spaces."""
    return F.array_join(first_tokens(c, n), " ")


def assert_length(c, n: int) -> Column:
    """Fail the job when a text has more than ``n`` tokens; otherwise pass the text through."""
    return F.when(token_count(c) > F.lit(n), F.raise_error(F.lit(f"text longer than {n} tokens"))).otherwise(_col(c))


# ---- B24: validity ---------------------------------------------------------------------------------
def is_blank(c) -> Column:
    """Null, empty, or only (Unicode) whitespace."""
    return _col(c).isNull() | ~_col(c).rlike("[^" + PY_SPACE[1:])
