"""Rounding a double by the value its bits stand for, not by its decimal text."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Beyond this a double's neighbours are an eighth or more apart.
_COARSE = float(2**49)


def _power_of_two(n: Column) -> Column:
    """2^n as an exact decimal, for n from 0 to 100."""
    one = F.lit(1).cast("bigint")
    half = F.least(n, F.lit(50))
    low = F.call_function("shiftleft", one, half).cast("decimal(19,0)")
    return (low * F.call_function("shiftleft", one, n - half).cast("decimal(18,0)")).cast("decimal(38,0)")


def round_binary(c: Column, places: int) -> Column:
    """Nearest multiple of 10^-places (0 to 4 places) to the double's exact value; exact ties go to the even digit.

    2.675 is 2.67499999999999982236431605997495353221893310546875 and gives 2.67; 0.125 is a tie and gives
    0.12. A positive double is m / 2^s with an integer m below 2^56; m * 10^places is divided by 2^s in whole
    numbers, so nothing is lost. Null, NaN and infinities stay as they are.
    """
    if not 0 <= places <= 4:
        raise ValueError("0 to 4 places")
    size = F.abs(c)
    fine = (size >= 10.0 ** -(places + 1)) & (size < _COARSE)
    held = F.when(fine, size)
    s = (53 - F.floor(F.log2(held))).cast("int")
    m = (held * F.pow(F.lit(2.0), s.cast("double"))).cast("bigint")
    dividend = (m.cast("decimal(19,0)") * F.lit(Decimal(10**places)).cast("decimal(5,0)")).cast("decimal(38,0)")
    divisor = _power_of_two(s)
    whole = F.call_function("div", dividend, divisor)
    twice = (dividend - whole.cast("decimal(19,0)") * divisor) * F.lit(2)
    up = (twice > divisor) | ((twice == divisor) & (whole % 2 == 1))
    units = (whole + F.when(up, 1).otherwise(0)).cast("decimal(19,0)")
    near = (units * F.lit(Decimal(1).scaleb(-places)).cast(f"decimal({places + 1},{places})")).cast("double")
    special = c.isNull() | F.isnan(c) | (size == float("inf"))
    return F.when(special, c).when(fine, F.when(c < 0, -near).otherwise(near)).when(size < 1, F.lit(0.0)).otherwise(F.bround(c, places))
