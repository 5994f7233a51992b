"""The list of registered queries: a Spark query each, with SQL where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Means of cents often lie exactly halfway between two roundings, and then the
# last bit of a sum decides. Both sides add this before they round.
OFF_HALFWAY = 3.17e-8


def _off_halfway(sql: str) -> str:
    """Every `round(x, n)` of the text as `round(x + OFF_HALFWAY, n)`."""
    out, at = [], 0
    for call in re.finditer(r"\bround\(", sql):
        depth, i = 1, call.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            i += 1
        comma = sql.rindex(",", call.end(), i)
        out += [sql[at:comma], f" + {OFF_HALFWAY!r}"]
        at = comma
    return "".join(out) + sql[at:]


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            SQL[name] = _off_halfway(sql)
        return fn

    return register


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Round fractions, so that two engines' last bits do not matter."""
    return df.withColumns({c: F.round(F.col(c) + OFF_HALFWAY, digits) for c in columns})


def rounds(columns: Sequence[str], digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)
