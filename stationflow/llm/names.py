"""Column names for helpers that a table of the user does not have."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Each name, with as many underscores before it as it takes to differ from all columns of `df`."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        out.append(name)
    return out
