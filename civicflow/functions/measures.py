"""Grid cells and exact, order-independent means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import GRID_DECIMALS
from .timefns import MICROS_PER_HOUR

GRID_TYPE = "decimal(9,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grid(c) -> Column:
    """Coordinate rounded half away from zero to the grid, from its double's 15 significant digits.

    Below 1000 those digits move a coordinate by less than 1e-12, so only one
    near the middle of two cells needs them; any other is rounded as a double.
    """
    d = _col(c).cast("double")
    scaled = F.abs(d) * F.lit(10.0 ** GRID_DECIMALS)
    cells = F.floor(scaled + F.lit(0.5))
    clear = (F.abs(d) < 1000) & (F.abs(scaled - F.floor(scaled) - F.lit(0.5)) > F.lit(1e-6))
    near = (F.when(d < 0, -cells).otherwise(cells).cast("double") / F.lit(10.0 ** GRID_DECIMALS)).cast(GRID_TYPE)
    return F.when(clear, near).otherwise(_grid_of_digits(d))


def _grid_of_digits(d: Column) -> Column:
    exact, size = d.cast("decimal(38,18)"), F.abs(d)
    digits = F.when(size >= 100, F.round(exact, 12).cast("decimal(38,18)")).when(
        size >= 10, F.round(exact, 13).cast("decimal(38,18)")).when(
        size >= 1, F.round(exact, 14).cast("decimal(38,18)")).otherwise(
        F.round(exact, 15).cast("decimal(38,18)"))
    return F.round(digits, GRID_DECIMALS).cast(GRID_TYPE)


def cell_label(lat, lon) -> Column:
    """``Lat 40.71, Lon -74.01`` (grid values have two decimals, so the double prints exactly)."""
    return F.format_string("Lat %.2f, Lon %.2f", _col(lat).cast("double"), _col(lon).cast("double"))


def mean_hours(us_sum, n) -> Column:
    """Mean in hours from a bigint microsecond sum and a count; NULL when n = 0.

    Integer sums are exact, so the mean does not depend on the order in which
    partial aggregates were combined.
    """
    return _col(us_sum).cast("double") / (F.lit(MICROS_PER_HOUR) * F.nullif(_col(n), F.lit(0)).cast("double"))


US_SUM_TYPE = "decimal(38,0)"


def us_sum(us) -> Column:
    """Exact sum of microsecond durations (decimal: a hot group cannot overflow it)."""
    return F.sum(_col(us).cast(US_SUM_TYPE))


def mean_us(us_total, n) -> Column:
    """A group's mean duration in whole microseconds (bigint); NULL when n = 0.

    Rolling means up as integers keeps means of means independent of the
    order in which rows were combined.
    """
    return F.round(_col(us_total).cast("double") / F.nullif(_col(n), F.lit(0)).cast("double")).cast("long")
