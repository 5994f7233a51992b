"""Bands, positions and texts shown for scores and rates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _round_half_up(x: Column) -> Column:
    return F.floor(x + 0.5).cast("int")


# --- Fixed values: band limits and their texts ----------------------------------
def busyness_level(p: Column) -> Column:
    return F.when(p.isNull(), "na").when(p >= 0.6, "high").when(p >= 0.3, "moderate").otherwise("low")


def busyness_label(p: Column) -> Column:
    return (
        F.when(p.isNull(), "No data")
        .when(p >= 0.6, "Busier than usual")
        .when(p >= 0.3, "Moderately busy")
        .otherwise("Quieter than usual")
    )


def congestion_band(n: Column) -> Column:
    """Four bands of the normalised ridership, 0 = lightest."""
    return F.when(n > 0.7, 3).when(n > 0.4, 2).when(n > 0.2, 1).otherwise(0)


def auc_band(auc: Column) -> Column:
    return F.when(auc >= 0.97, "high").when(auc >= 0.95, "medium").otherwise("low")


def clamp01(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def rate_position(rate: Column) -> Column:
    """Place of a busy rate on the map's colour scale."""
    return clamp01((rate - 0.10) / 0.32)


def drift_position(drift: Column) -> Column:
    return clamp01((drift + 0.10) / 0.22)


def auc_position(auc: Column) -> Column:
    return clamp01(1 - (auc - 0.92) / 0.07)


# --- texts ------------------------------------------------------------------------
def percent_text(p: Column) -> Column:
    """Whole percent, empty where there is no value."""
    return F.when(p.isNull(), "").otherwise(F.concat(_round_half_up(p * 100).cast("string"), F.lit("%")))


def rate_text(rate: Column) -> Column:
    return F.format_string("%.1f%%", rate * 100)


def drift_text(drift: Column) -> Column:
    return F.concat(F.when(drift >= 0, "+").otherwise(""), F.format_string("%.1f%%", drift * 100))


def auc_text(auc: Column) -> Column:
    return F.when(F.coalesce(auc, F.lit(0.0)) == 0, "N/A").otherwise(F.format_string("%.4f", auc))


def safe_ratio(value: Column, ceiling: Column) -> Column:
    """value / ceiling, or 0 where the ceiling is not positive."""
    return F.when(ceiling > 0, value / ceiling).otherwise(F.lit(0.0))
