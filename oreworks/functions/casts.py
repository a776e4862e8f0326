"""Typing of raw columns. ANSI mode stays on; only raw text is parsed leniently."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreworks.functions.text import _col

#: Amounts below 1e21 add up exactly, to a millionth.
EXACT = "decimal(28,6)"


def as_date(c: Column | str) -> Column:
    """Raw text as a date, NULL where it is none."""
    return F.try_to_date(_col(c))


def as_double(c: Column | str) -> Column:
    """Raw text as a double, NULL where it is none."""
    return _col(c).try_cast("double")


def as_key(c: Column | str) -> Column:
    """A key as text, so that keys of different systems compare and join."""
    return _col(c).cast("string")


def money_sum(c: Column | str) -> Column:
    """Sum of amounts (double), as an aggregate.

    Amounts below 1e21 are added as decimals, so sums come out the same in whatever order
    they run. NaN, infinities and larger amounts are added as doubles, as ``sum`` does:
    nothing is left out, and one NaN makes the sum NaN. NULL if there is no amount.
    """
    amount = _col(c).cast("double")
    finite = ~F.isnan(amount) & (F.abs(amount) < F.lit(1e21))
    exact = F.when(finite, amount).cast(EXACT)
    rest = F.when(~finite, amount)
    total = F.coalesce(F.sum(exact).cast("double"), F.lit(0.0)) + F.coalesce(
        F.sum(rest), F.lit(0.0)
    )
    return F.when(F.count(amount) > 0, total)


def range_bucket(c: Column | str, width: int) -> Column:
    """Number of the fixed-width key range, truncated toward zero.

    Integer division: a double would lose digits of keys above 2**53.
    """
    return F.call_function("div", _col(c), F.lit(width)).cast("int")


def rejected(raw: Column | str, typed: Column) -> Column:
    """True where a raw value is there but its typed form is not."""
    return _col(raw).isNotNull() & typed.isNull()
