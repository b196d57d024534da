"""Rounding with decimal semantics, and sizes as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, places: int = 2) -> Column:
    """Round half away from zero; returned as double. Twelve places are kept first, as summation order moves later ones."""
    return F.round(value.cast("decimal(38,12)"), places).cast("double")


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, counts both, to two places, halves up and without a rounding in between; NULL when ``whole`` is zero."""
    doubled = F.nullif(whole, F.lit(0)).cast("decimal(18,0)") * 2
    return F.floor((part.cast("decimal(18,0)") * 20_000 + whole) / doubled).cast("double") / 100


def exact_sum(value: Column) -> Column:
    """The sum of bigints as text, beyond the range of one; three sums of some of the bits each, as decimals made per row take far longer."""
    bits, low = 22, F.lit((1 << 22) - 1)
    parts = [F.shiftright(value, 2 * bits), F.shiftright(value, bits).bitwiseAND(low), value.bitwiseAND(low)]
    high, middle, least = [F.sum(part).cast("decimal(20,0)") for part in parts]
    return (high * F.lit(1 << 2 * bits) + middle * F.lit(1 << bits) + least).cast("string")


def six_places(value: Column) -> Column:
    """Averages and deviations to six places, since summation order follows partitioning."""
    return F.round(value.cast("double"), 6)


def format_bytes(size: Column) -> Column:
    """Size text in the first unit whose rounded value stays below 10240 (the last unit takes the rest)."""
    units = ["kB", "MB", "GB", "TB"]
    text = F.when(size < 10240, F.concat(size.cast("string"), F.lit(" bytes")))
    for power, unit in enumerate(units, start=1):
        rounded = F.round(size.cast("decimal(38,6)") / F.lit(1024 ** power).cast("decimal(20,0)")).cast("bigint")
        shown = F.concat(rounded.cast("string"), F.lit(f" {unit}"))
        text = text.otherwise(shown) if unit == units[-1] else text.when(rounded < 10240, shown)
    return text
