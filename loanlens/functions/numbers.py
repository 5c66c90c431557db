"""Rounding and sums that do not depend on order.

Double sums depend on the order in which tasks finish, and a mean that sits on
a rounding tie then flips between runs. The aggregates below therefore add
decimals of eight places, which is exact for them, and only the result is
rounded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column, digits: int) -> Column:
    """Scale, round to a whole number (ties away from zero), scale back.

    This is how SQL engines that work in binary round a double. Spark's own
    two-argument ``round`` goes through the printed decimal instead, so that
    1.005 becomes 1.01 rather than 1.0.
    """
    scale = float(10**digits)
    return F.round(x * scale, 0) / scale


def round_half_even_exact(x: str, digits: int) -> Column:
    """The column ``x`` correctly rounded to ``digits``, looking at its exact binary value.

    ``x * 10**digits`` is itself rounded. What was lost is recovered by
    splitting ``x`` into two halves whose products are exact (2**27 + 1 does
    the splitting), so that only a true tie goes to the even neighbour.
    """
    scale = f"1e{digits}D"
    product = f"({x} * {scale})"
    spread = f"({x} * 134217729D)"
    high = f"({spread} - ({spread} - {x}))"
    lost = f"(({high} * {scale} - {product}) + ({x} - {high}) * {scale})"
    whole = f"FLOOR({product})"
    beyond_half = f"((({product} - {whole}) - 0.5D) + {lost})"
    return F.expr(
        f"CASE WHEN {beyond_half} > 0 OR ({beyond_half} = 0 AND {whole} % 2 <> 0) "
        f"THEN {whole} + 1 ELSE {whole} END / {scale}"
    )


#: Twenty digits before the point and eight after it.
WIDE = "decimal(28,8)"


def sum_money(x: Column) -> Column:
    """Sum of amounts, in any order of rows; each counts with eight decimals."""
    return F.sum(x.cast(WIDE)).cast("double")


def avg_score(x: Column) -> Column:
    """Mean of values with eight decimals; NULLs are left out."""
    return sum_money(x) / F.nullif(F.count(x), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / whole


def float_text(x: Column, digits: int) -> Column:
    """A double that was rounded to ``digits``, in its shortest plain form: 12.5, 3.0."""
    plain = x.cast(f"decimal(30,{digits})").cast("string")
    return F.regexp_replace(plain, f"0{{1,{digits - 1}}}$", "")


def fixed_text(x: str, digits: int) -> Column:
    """The column ``x`` with exactly ``digits`` decimals, as a report prints it."""
    return round_half_even_exact(x, digits).cast(f"decimal(30,{digits})").cast("string")
