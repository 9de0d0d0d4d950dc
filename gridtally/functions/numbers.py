"""Exact arithmetic on numbers that arrive as text or doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridtally.schemas import AMOUNT, REGISTER

#: What becomes of the places that are cut off.
ROUNDING = ("up", "down", "ceiling", "floor", "half_up", "half_down", "half_even", "unnecessary")


def parse_register(text: Column) -> Column:
    """Decimal register, null for anything that is not a plain number (NaN, 48,892.60, empty)."""
    return text.try_cast(REGISTER)


def is_valid_number(text: Column) -> Column:
    return parse_register(text).isNotNull()


def exact(x: Column) -> Column:
    """The decimal a double or text prints as, so that sums carry no binary error."""
    return x.cast(AMOUNT)


def exact_sum(a: Column, b: Column) -> Column:
    return exact(a) + exact(b)


def exact_difference(smaller: Column, bigger: Column) -> Column:
    return exact(bigger) - exact(smaller)


def exact_product(a: Column, b: Column) -> Column:
    """The product of two numbers with at most six decimals; an error for any other number."""
    return (_register(a) * _register(b)).cast(AMOUNT)


def _register(x: Column) -> Column:
    """``x`` as a register, never a rounded one."""
    register = x.cast(REGISTER)
    finer = F.raise_error(F.concat(F.lit("more than six decimals: "), x.cast("string")))
    return F.when(register != x.cast("decimal(38,18)"), finer.cast(REGISTER)).otherwise(register)


def round_half_up(x: Column, places: int) -> Column:
    return F.round(x, places)


def rounded(x: Column, places: int, mode: str = "half_up") -> Column:
    """``x`` as an exact amount rounded to some places, 10 at most.

    Up and down mean away from zero and towards it, ceiling and floor towards more and less. The half
    modes go to the nearer neighbour and differ where both are as near. ``unnecessary`` is an error
    unless ``x`` has no more places. A number that no amount can hold is null.
    """
    if mode not in ROUNDING:
        raise ValueError(f"not a rounding mode: {mode}")
    if not 0 <= places <= 10:
        raise ValueError(f"not a number of places: {places}")
    d = x.try_cast(AMOUNT)
    ceiling, floor = (f(d, F.lit(places)).cast(AMOUNT) for f in (F.ceil, F.floor))
    up = F.when(d >= 0, ceiling).otherwise(floor)
    down = F.when(d >= 0, floor).otherwise(ceiling)
    tie = d - down == up - d
    return {
        "up": up, "down": down, "ceiling": ceiling, "floor": floor,
        "half_up": F.round(d, places).cast(AMOUNT),
        "half_down": F.when(tie, down).otherwise(F.round(d, places).cast(AMOUNT)),
        "half_even": F.bround(d, places).cast(AMOUNT),
        "unnecessary": F.when(d == down, d).otherwise(
            F.raise_error(F.concat(F.lit("needs rounding: "), d.cast("string"))).cast(AMOUNT)),
    }[mode]
