"""Pluggable scoring functions chosen by name and dispatch by data source.

A scorer is a *Column builder* ``(response, truth) -> struct<score double, binary_score double>`` made of
Spark built-ins, so scoring stays in the JVM. For SQL users the same builders are registered as Spark SQL
functions (``CREATE TEMPORARY FUNCTION ... RETURN <expression>``); nothing runs in Python per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import ANSWER_PATTERN

Scorer = Callable[[Column, Column], Column]

_SCORERS: dict[str, Scorer] = {}
_SQL_BODIES: dict[str, str] = {}


def register_scorer(name: str, builder: Scorer, sql_body: str | None = None) -> None:
    """Add a scorer. ``sql_body`` is the same logic as a SQL expression over ``resp`` and ``truth``."""
    _SCORERS[name] = builder
    if sql_body is not None:
        _SQL_BODIES[name] = sql_body


def scorer(name: str) -> Scorer:
    return _SCORERS[name]


def scorers() -> list[str]:
    return sorted(_SCORERS)


def _zero() -> Column:
    return F.struct(F.lit(0.0).alias("score"), F.lit(0.0).alias("binary_score"))


def dispatch(data_source, resp, truth, default: str | None = None) -> Column:
    """Score each row with the scorer named by its ``data_source``; unknown sources score 0.0
    (or use ``default``)."""
    ds = F.col(data_source) if isinstance(data_source, str) else data_source
    r = F.col(resp) if isinstance(resp, str) else resp
    t = F.col(truth) if isinstance(truth, str) else truth
    out = None
    for name, build in _SCORERS.items():
        out = (F.when(ds == F.lit(name), build(r, t)) if out is None else out.when(ds == F.lit(name), build(r, t)))
    fallback = _SCORERS[default](r, t) if default else _zero()
    return fallback if out is None else out.otherwise(fallback)


def register_sql_functions(spark: SparkSession, prefix: str = "score_") -> list[str]:
    """I1 for SQL: one temporary SQL function per scorer with a SQL body, e.g.
    ``SELECT score_chess_puzzles(text, truth).score FROM ...``."""
    names = []
    for name, body in _SQL_BODIES.items():
        fn = prefix + name
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {fn}(resp STRING, truth STRING) "
            f"RETURNS STRUCT<score: DOUBLE, binary_score: DOUBLE> RETURN {body}"
        )
        names.append(fn)
    return names


# ---- built-in scorers ------------------------------------------------------------------------------------------
def _answer(resp: Column, truth: Column) -> Column:
    from quarry.functions.text import answer_score

    return answer_score(resp, truth)


def _exact(resp: Column, truth: Column) -> Column:
    hit = F.coalesce((F.trim(resp) == F.trim(truth)).cast("double"), F.lit(0.0))
    return F.struct(hit.alias("score"), hit.alias("binary_score"))


_PAT = ANSWER_PATTERN.replace("\\", "\\\\").replace("'", "\\'")
register_scorer(
    "chess_puzzles",
    _answer,
    "named_struct('score', coalesce(CAST(nullif(lower(regexp_extract(resp, '" + _PAT + "', 1)), '') = lower(truth) "
    "AS DOUBLE), 0D), 'binary_score', coalesce(CAST(nullif(lower(regexp_extract(resp, '" + _PAT + "', 1)), '') = "
    "lower(truth) AS DOUBLE), 0D))",
)
register_scorer(
    "exact_text",
    _exact,
    "named_struct('score', coalesce(CAST(trim(resp) = trim(truth) AS DOUBLE), 0D), "
    "'binary_score', coalesce(CAST(trim(resp) = trim(truth) AS DOUBLE), 0D))",
)
