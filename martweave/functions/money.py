"""Sums, averages and rates of money held as double.

Adding doubles depends on the order rows arrive in, so two runs, or two grains of
one metric, may differ in the last digits. Here amounts are counted in whole
ten-thousandths instead, as integers, whose sum is the same in any order. Decimals
would be exact too, but they leave primitive arithmetic and take several times as
long. One integer could overflow in a group of very many rows, so the upper and
lower bits are summed apart: the lower sum holds for 2**43 rows.

Amounts are rounded to one part in ``units``, four places unless told otherwise;
``units=None`` adds the doubles as they are. NaN, infinity and amounts too large to
count in units are added as doubles beside the integers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 10_000.0
_LOW_BITS = 20


def _column(amount: Column | str) -> Column:
    return F.col(amount) if isinstance(amount, str) else amount


def exact_parts(amount: Column | str, units: float | None = UNITS) -> tuple[Column, Column, Column]:
    """Two integer columns and one of doubles; their sums make up the sum of the amount."""
    amount = _column(amount)
    if units is None:
        none = F.lit(None).cast("bigint")
        return none, none, amount.cast("double")
    fits = F.abs(amount) < 2.0**62 / units  # NaN counts as larger than any number
    counted = F.when(fits, F.rint(amount * units).cast("bigint"))
    low = counted.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("bigint"))
    return F.shiftright(counted, _LOW_BITS), low, F.when(~fits, amount)


def from_parts(high: Column, low: Column, odd: Column, units: float | None = UNITS) -> Column:
    """The amount as double from the three summed parts; NULL if there was none."""
    whole = (high.cast("double") * float(1 << _LOW_BITS) + low.cast("double")) / (units or 1.0)
    return F.coalesce(whole + odd, whole, odd)


def exact_sum(amount: Column | str, units: float | None = UNITS) -> Column:
    """Sum of the non-null amounts; NULL when there is none."""
    return from_parts(*map(F.sum, exact_parts(amount, units)), units)


def exact_avg(amount: Column | str, units: float | None = UNITS) -> Column:
    """Average over the non-null amounts; NULL when there is none."""
    return rate(exact_sum(amount, units), F.count(_column(amount)))


def summed_parts(name: str, amount: str) -> dict[str, Callable[..., Column]]:
    """Aggregates ``<name>_high``, ``_low`` and ``_odd``, which may be summed again."""

    def part(k: int) -> Callable[..., Column]:
        return lambda units=UNITS: F.sum(exact_parts(amount, units)[k])

    return {f"{name}_{end}": part(k) for k, end in enumerate(("high", "low", "odd"))}


def rate(part: Column, whole: Column) -> Column:
    """``part / whole``; NULL, not an error, where the whole is zero."""
    return part / F.nullif(whole, F.lit(0))
