"""Exact sums and benchmark means."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exact(value: Column, scale: int = 2) -> Column:
    """A double holding a decimal amount, as DECIMAL, so sums do not depend on row order."""
    return value.cast(f"decimal(18,{scale})")


def money(total: Column, scale: int = 2) -> Column:
    """A decimal total rounded half up and given back as double."""
    return F.round(total, scale).cast("double")


def geo_mean(value: Column) -> Column:
    return F.exp(F.avg(F.ln(value)))


def hot_run(runs: Column) -> Column:
    """The better of the second and third run."""
    return F.least(F.get(runs, F.lit(1)), F.get(runs, F.lit(2)))


def cold_run(runs: Column) -> Column:
    return F.get(runs, F.lit(0))


def hex_number(text: Column) -> Column:
    """The value of a hexadecimal text as BIGINT."""
    return F.conv(text, 16, 10).cast("bigint")
