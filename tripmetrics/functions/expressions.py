"""Column expressions for trips."""

from __future__ import annotations

from decimal import Decimal
from math import inf, nextafter

from pyspark.sql import Column
from pyspark.sql import functions as f
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    FractionalType,
    IntegerType,
    IntegralType,
    LongType,
    ShortType,
)

from tripmetrics.schemas import KM_PER_MILE, UNKNOWN


def duration_minutes(start: str, end: str) -> Column:
    """Minutes from start to end, two decimals.

    Each side is cut to whole seconds first. On timestamps without zone this is wall-clock
    time, so the session zone and its clock changes do not matter.

    The result equals ``round(seconds / 60, 2)``. Whole seconds are never halfway between two
    hundredths of a minute, so ``floor`` finds the nearest hundredth exactly; ``round`` would
    build a big decimal each time a filter or a projection looks at the column.
    """
    seconds = f.unix_timestamp(end) - f.unix_timestamp(start)
    hundredths = f.floor(seconds * (100 / 60) + 0.5)
    return hundredths / 100


def kilometres(miles: str) -> Column:
    return f.round(f.col(miles) * KM_PER_MILE, 2)


def month_label(ts: str) -> Column:
    """Jan ... Dec.

    Formatting goes through the session zone; the detour over the date keeps a timestamp
    without zone in its own month whatever that zone is.
    """
    return f.date_format(f.to_date(ts), "MMM")


def code_label(code: str, labels: dict[int, str]) -> Column:
    """Text for a code; codes not listed and null give ``Unknown``.

    The labels are one constant map, which generates much less code than a chain of cases.
    """
    entries = [f.lit(part) for entry in labels.items() for part in entry]
    known = f.create_map(*entries).cast("map<bigint,string>")
    text = f.try_element_at(known, f.col(code).cast("bigint"))
    return f.coalesce(text, f.lit(UNKNOWN))


_BITS = {ByteType(): 8, ShortType(): 16, IntegerType(): 32, LongType(): 64}


def fitting_cast(value: Column, source: DataType, target: DataType) -> Column:
    """``value`` cast to ``target``; null where it does not fit, fractions cut off.

    Numbers are compared with the target's range first: a failing ``try_cast`` raises and
    catches an exception inside, which is many times slower when misfits are frequent.
    """
    if source == target:
        return value
    if isinstance(source, DecimalType) or isinstance(target, DecimalType):
        return _fitting_decimal(value, source, target)
    if isinstance(target, IntegralType) and isinstance(source, (IntegralType, FractionalType)):
        bits = _BITS[target]
        if isinstance(source, IntegralType) and _BITS[source] <= bits:
            return value.cast(target)
        limit = 2 ** (bits - 1)
        if isinstance(source, IntegralType):
            fits = value.between(-limit, limit - 1)
        elif bits < 64:
            fits = (value > float(-limit - 1)) & (value < float(limit))
        else:
            fits = (value >= float(-limit)) & (value < float(limit))
        return f.when(fits, value.cast(target))
    if isinstance(target, FractionalType) and isinstance(source, IntegralType):
        return value.cast(target)
    return value.try_cast(target)


def _fitting_decimal(value: Column, source: DataType, target: DataType) -> Column:
    """From or to decimals, by exact bounds: decimals for decimals, integers for integers, and for
    doubles the first one whose decimal digits no longer fit."""
    if isinstance(source, DecimalType) and isinstance(target, FractionalType):
        if not isinstance(target, DecimalType):
            return value.cast(target)
        whole, room = source.precision - source.scale, target.precision - target.scale
        rounds = source.scale > target.scale
        if whole + rounds <= room:
            return value.cast(target)
        # the first value that is rounded to too many digits
        bound = Decimal(10) ** room - (Decimal(5).scaleb(-target.scale - 1) if rounds else 0)
        return _within(value, bound, target, room + (target.scale + 1 if rounds else 0) + 1)
    if isinstance(source, DecimalType) and isinstance(target, IntegralType):
        limit = 2 ** (_BITS[target] - 1)
        if 10 ** (source.precision - source.scale) <= limit:
            return value.cast(target)
        fits = (value > _decimal(-limit - 1)) & (value < _decimal(limit))
        return f.when(fits, value.cast(target))
    if isinstance(source, IntegralType) and isinstance(target, DecimalType):
        most = 10 ** (target.precision - target.scale) - 1
        if 2 ** (_BITS[source] - 1) <= most:
            return value.cast(target)
        return f.when(value.between(-most, most), value.cast(target))
    if isinstance(source, FractionalType):
        bound = Decimal(10) ** (target.precision - target.scale)
        first = _first_double(bound - Decimal(5).scaleb(-target.scale - 1))
        double = value.cast("double")
        return f.when((double > -first) & (double < first), value.cast(target))
    return value.try_cast(target)


def _within(value: Column, bound: Decimal, target: DecimalType, digits: int) -> Column:
    if digits > 38:  # the bound itself is no decimal
        return value.try_cast(target)
    fits = (value > _decimal(-bound)) & (value < _decimal(bound))
    return f.when(fits, value.cast(target))


def _decimal(number: Decimal | int) -> Column:
    return f.lit(Decimal(number))


def _first_double(bound: Decimal) -> float:
    """The least double whose shortest decimal form is ``bound`` or more."""
    found = float(bound)
    while Decimal(repr(found)) >= bound:
        found = nextafter(found, -inf)
    while Decimal(repr(found)) < bound:
        found = nextafter(found, inf)
    return found


#: Below this, means are exact sums of whole numbers; of so many rows at most, 2 ** 39.
_EXACT_BELOW = 2.0**40
_LIMB_BITS = 24


def exact_mean(column: str) -> Column:
    """The mean of a column of doubles, without missing values and NaN: the same bits in whatever
    order the rows come.

    A value is cut into four limbs of 24 bits, from 2 ** 40 down to 2 ** -56, whose sums are whole
    numbers and so exact. What lies below is dropped; values of 2 ** 40 or more are summed as they
    are, in no fixed order.
    """
    value = without_nan(column)
    small = f.abs(value) < _EXACT_BELOW
    rest, unit = f.when(small, value), _EXACT_BELOW / 2**_LIMB_BITS
    limbs = []
    for _ in range(4):
        limb = f.floor(rest / unit)
        limbs.append((f.coalesce(f.sum(limb), f.lit(0)), unit))
        rest, unit = rest - limb * unit, unit / 2**_LIMB_BITS
    total = f.coalesce(f.sum(f.when(~small, value)), f.lit(0.0))
    carry = f.lit(0)
    parts = []
    for limb, unit in reversed(limbs):  # from the lowest; carries keep the parts apart
        limb = limb + carry
        parts.append(limb.bitwiseAND(2**_LIMB_BITS - 1) * f.lit(unit))
        carry = f.shiftright(limb, _LIMB_BITS)
    exact = carry * f.lit(_EXACT_BELOW)
    for part in reversed(parts):
        exact = exact + part
    return f.try_divide(exact + total, f.count(value))


def without_nan(number: str) -> Column:
    """The column with NaN read as null."""
    return f.nanvl(f.col(number), f.lit(None).cast("double"))
