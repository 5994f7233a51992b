"""Expressions on station names: line letters, name forms, borough flags.

A name may hold several groups of line letters, `Cross Av (N)/62 St (D)`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from stationflow.schema import BOROUGH_FLAGS, BOROUGHS, STATION_ALIASES, TERMINAL_STATIONS

# --- Fixed values: patterns for the bracketed line letters ----------------------
LINE_GROUP = r"\(([^)]+)\)"
NAME_PIECE = r"(\([^)]+\)|[^(]+|\()"


def line_entries(name: Column) -> Column:
    """Every line letter in the name, in order, repeats kept."""
    groups = F.regexp_extract_all(name, F.lit(LINE_GROUP), F.lit(1))
    return F.flatten(F.transform(groups, lambda g: F.transform(F.split(g, ","), lambda letter: F.trim(letter))))


def num_lines(name: Column) -> Column:
    """How many line letters a name lists; 1 where it lists none."""
    n = F.size(line_entries(name))
    return F.when(n > 0, n).otherwise(F.lit(1)).cast("int")


def lines(name: Column) -> Column:
    """The distinct line letters of a name, sorted."""
    return F.array_sort(F.array_distinct(line_entries(name)))


def is_terminal(name: Column, terminals: list[str] | None = None) -> Column:
    """1 where the name contains a known terminal's name, letter case aside."""
    lowered = F.lower(name)
    hits = [F.contains(lowered, F.lit(t.lower())) for t in (terminals or TERMINAL_STATIONS)]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False)).cast("int")


def sort_line_letters(name: Column) -> Column:
    """The name with the letters inside each bracket sorted and trimmed."""
    pieces = F.regexp_extract_all(name, F.lit(NAME_PIECE), F.lit(1))

    def tidy(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(2), F.length(piece) - 2)
        letters = F.array_sort(F.transform(F.split(inner, ","), lambda letter: F.trim(letter)))
        bracket = F.concat(F.lit("("), F.array_join(letters, ","), F.lit(")"))
        return F.when(F.startswith(piece, F.lit("(")) & (F.length(piece) > 1), bracket).otherwise(piece)

    return F.array_join(F.transform(pieces, tidy), "")


def canonical_name(name: Column, aliases: dict[str, str] | None = None) -> Column:
    """The kept name of a renamed station; other names pass through."""
    pairs = [F.lit(x) for pair in (aliases or STATION_ALIASES).items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name)


def borough_flags(borough: Column) -> list[Column]:
    return [
        F.coalesce(borough == name, F.lit(False)).cast("int").alias(flag)
        for flag, name in zip(BOROUGH_FLAGS, BOROUGHS)
    ]


def borough_from_flags(default: str = "Unknown") -> Column:
    """Borough name from the one-hot columns."""
    picks = [F.when(F.col(flag) == 1, F.lit(name)) for flag, name in zip(BOROUGH_FLAGS, BOROUGHS)]
    return F.coalesce(*picks, F.lit(default))
