"""Exact amounts: whole units inside, the caller's type outside.

Sums of doubles depend on the order of the rows, and a threshold test on them is not
stable. Mining therefore runs on units of 10^-scale: BIGINT for lines and single receipts,
DECIMAL(38,0) for sums over receipts. Results do not depend on ANSI mode.
"""

from __future__ import annotations

from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_SCALE = 4
TOTAL = "decimal(38,0)"
_LARGEST = float(1 << 63)
_PART_BITS = 21


def scale_of(dtype: T.DataType) -> int:
    """Decimal places kept for amounts of this type."""
    if isinstance(dtype, T.IntegralType):
        return 0
    return dtype.scale if isinstance(dtype, T.DecimalType) else DEFAULT_SCALE


def to_units(amount: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.IntegralType):
        return amount.cast("bigint")
    scaled = amount * (10 ** scale_of(dtype))
    return (scaled if isinstance(dtype, T.DecimalType) else F.round(scaled)).cast("bigint")


def threshold_units(min_util, dtype: T.DataType) -> int:
    """Smallest whole number of units that reaches ``min_util``, which must be positive."""
    limit = Decimal(str(min_util))
    if not limit.is_finite() or limit <= 0:
        raise ValueError(f"min_util must be positive, got {min_util}")
    return int(limit.scaleb(scale_of(dtype)).to_integral_value(ROUND_CEILING))


def threshold(min_util) -> Column:
    """``min_util`` as a literal that is compared exactly with integers and decimals."""
    return F.lit(Decimal(str(min_util)))


def total(units: Column | str) -> Column:
    """Sum of BIGINT units as DECIMAL(38,0), over up to 2^42 rows a group.

    The units are added up in three parts of few bits each, which is some five times faster than adding up
    decimals, and put together at the end.
    """
    units = F.col(units) if isinstance(units, str) else units
    mask = (1 << _PART_BITS) - 1
    parts = [
        F.sum(F.shiftright(units, 2 * _PART_BITS)),
        F.sum(F.shiftright(units, _PART_BITS).bitwiseAND(mask)),
        F.sum(units.bitwiseAND(mask)),
    ]
    high, middle, low = (p.cast("decimal(19,0)") for p in parts)
    step = 1 << _PART_BITS
    return (high * F.lit(Decimal(step * step)) + middle * F.lit(Decimal(step)) + low).cast(TOTAL)


def receipt_sum(units: Column) -> Column:
    """Sum of BIGINT units within a receipt, which must fit BIGINT; raises in any mode if it does not."""
    exceeded = F.sum(F.abs(units.cast("double"))) >= _LARGEST
    error = F.raise_error(F.lit("a receipt's amounts exceed BIGINT units")).cast("bigint")
    # The sum itself must not raise first, nor wrap.
    return F.when(exceeded, error).otherwise(F.try_sum(units))


def from_units(units: Column, dtype: T.DataType) -> Column:
    """Amounts of ``dtype``'s scale, as decimals that hold sums of any size."""
    scale = scale_of(dtype)
    if not scale:
        return units.cast(TOTAL)
    step = F.lit(Decimal(1).scaleb(-scale))
    return (units.cast(f"decimal({36 - scale},0)") * step).cast(f"decimal(38,{scale})")
