"""Numeric expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.params import RISK_EDGES, RISK_LABELS

# Decimal places at which amounts are summed: sums are exact, and equal under any partitioning or retry.
MONEY_PLACES = 12
# Bands and cells per doubling of the value; see order_cell. A band has 16,384 cells.
BAND_DENSITY = 1 << 7
CELL_DENSITY = 1 << 21


def money_units(amount: Column, places: int = MONEY_PLACES) -> Column:
    """An amount as a decimal that sums exactly, up to 10^26 at twelve places."""
    return amount.cast("double").cast(f"decimal({min(38, places + 16)}, {places})")


def money(units: Column) -> Column:
    return units.cast("double")


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, 0 where ``den`` is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def finite(x: Column) -> Column:
    """NULL for NULL, NaN and the infinities."""
    d = x.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))), d)


def order_cell(x: Column, density: int) -> Column:
    """A whole number that never decreases as ``x`` grows: the bucket of distributed ordering.

    It depends on the value alone (no sampled ranges). Cells are equally wide on the log scale down to
    the smallest double, which suits probabilities of any size as well as heavy-tailed amounts; zero has a
    cell of its own. A doubling of the value has ``density`` cells.
    """
    d = x.cast("double")
    size = F.when(d != 0, F.floor((F.log2(F.abs(d)) + 1075) * density)).otherwise(0)
    return (F.signum(d) * size).cast("bigint")


def risk_tier(p: Column) -> Column:
    """Right-closed bands; the lowest edge belongs to the first band; NULL outside the edges."""
    out = F.when(p.isNull() | F.isnan(p) | (p < RISK_EDGES[0]) | (p > RISK_EDGES[-1]), F.lit(None))
    for edge, name in zip(RISK_EDGES[1:-1], RISK_LABELS):
        out = out.when(p <= edge, F.lit(name))
    return out.otherwise(F.lit(RISK_LABELS[-1]))
