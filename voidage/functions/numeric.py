"""Column expressions: lines through two points, rounding rules, safe ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PLACES = 5


def extrapolate(x1: Column, x2: Column, y1: Column, y2: Column, x: Column) -> Column:
    """The line through (x1, y1) and (x2, y2), at x; flat when x1 = x2."""
    return F.when(x1 == x2, y1).otherwise(y1 + (x - x1) * (y2 - y1) / (x2 - x1))


def interpolate(
    x1: Column, x2: Column, y1: Column, y2: Column, x: Column, guarded: bool = False
) -> Column:
    """The same line; ``guarded`` gives NULL for x outside [x1, x2]."""
    line = extrapolate(x1, x2, y1, y2, x)
    if not guarded:
        return line
    # least/greatest skip NULLs, so missing inputs are ruled out first.
    present = x1.isNotNull() & x2.isNotNull() & y1.isNotNull() & y2.isNotNull()
    inside = (x >= F.least(x1, x2)) & (x <= F.greatest(x1, x2))
    return F.when(x1 == x2, y1).when(present & inside, line)


def round_half_up(c: Column, places: int = PLACES) -> Column:
    """Halves towards plus infinity."""
    scale = 10.0**places
    return F.floor(c * scale + 0.5) / scale


#: Scaled values from here on are doubles farther apart than the decimals, so each is its own rounded value.
_WHOLE = 2.0**53
#: Cuts a double in two halves of 26 bits, whose products with a power of ten up to 10^5 are exact.
_SPLIT = 2.0**27 + 1


def round_binary(c: Column, places: int = PLACES) -> Column:
    """The decimal of ``places`` (at most 5) nearest to the exact binary value, halves to even.

    ``bround`` goes by the shortest decimal that a double stands for: it takes 0.000015
    for a half, while the double is a little above it.  Here the scaled value is kept
    as a double and what that lacks of the exact product, so that a half is one only
    where the binary value is.
    """
    if not 0 <= places <= 5:
        raise ValueError("places must be 0 to 5")
    x, scale = F.abs(c), F.lit(10.0**places)
    scaled = x * scale
    upper = x * _SPLIT - (x * _SPLIT - x)
    lacking = (upper * scale - scaled) + (x - upper) * scale
    down = F.floor(scaled).cast("double")
    # Both sides are exact: what is above a half without the rest, against the rest.
    above, rest = scaled - down - 0.5, -lacking
    odd = F.pmod(down, F.lit(2.0)) == 1
    up = (above > rest) | ((above == rest) & odd)
    # A large product may have been rounded up by a half, which then was one below.
    back = (lacking == -0.5) & odd
    rounded = (down + F.when(back, -1.0).when(up, 1.0).otherwise(0.0)) / scale
    far = F.isnan(c) | (scaled >= _WHOLE)
    return F.when(c.isNull() | far, c).when(c < 0, -rounded).otherwise(rounded)


#: Rounding rules of a lookup result: SQL (halves away from zero),
#: halves up, halves of the binary value to even.
ROUNDING = {
    "sql": lambda c: F.round(c, PLACES),
    "half_up": round_half_up,
    "half_even": round_binary,
}


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, or 0 where that is undefined."""
    return F.coalesce(numerator / F.nullif(denominator, F.lit(0.0)), F.lit(0.0))


def settle(c: Column, places: int) -> Column:
    """Report rounding for sums of doubles.

    Halves go up, and so does anything within 1e-4 of a step below a half: a
    sum that lands on a half then rounds the same whatever order it was added in.
    """
    scale = 10.0**places
    return F.floor(c * scale + 0.5001) / scale
