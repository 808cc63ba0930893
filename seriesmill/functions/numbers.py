"""Number parsing, ratios, growth, rounding and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seriesmill.functions.text import strip

# A plain decimal number with optional exponent, or an infinity. Java literals
# such as `12d` are refused.
_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"


def parse_value(text: Column) -> Column:
    """Text to double; anything that is not a number becomes NULL, never NaN."""
    bare = strip(text)
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def parse_magnitude(text: Column) -> Column:
    """Text to int, fraction cut off, anything unreadable becomes 0."""
    return F.coalesce(parse_value(text).try_cast("int"), F.lit(0))


def scale_by_magnitude(value: Column, magnitude: Column) -> Column:
    """C4: a magnitude above 1 multiplies the value."""
    return F.when(magnitude > 1, value * magnitude).otherwise(value)


def safe_divide(numerator: Column, denominator: Column, default: float = 0) -> Column:
    """`default` for a zero or missing denominator; a NULL numerator stays NULL."""
    unusable = denominator.isNull() | (denominator == 0)
    return F.when(unusable, F.lit(float(default))).otherwise(numerator / denominator)


def growth_pct(current: Column, earlier: Column, digits: int = 2) -> Column:
    """percent change against a positive base, else NULL."""
    change = (current - earlier) / earlier * F.lit(100)
    return F.when(earlier > 0, F.round(change, digits))


def point_gap(left: Column, right: Column, digits: int = 1) -> Column:
    """difference of two unrounded figures, rounded once."""
    return F.round(left - right, digits)


def round_to(value: Column, step: int) -> Column:
    """round to a multiple of `step`."""
    return F.round(value / F.lit(float(step)), 0) * F.lit(step)


def in_billions(value: Column, digits: int = 2) -> Column:
    """F18."""
    return F.round(value / F.lit(1e9), digits)


def annualise(hourly: Column) -> Column:
    """forty hours a week, fifty-two weeks, whole currency units."""
    return F.round(hourly * F.lit(40) * F.lit(52), 0)


# Exact sums. Each value belongs to one slice of the number line by its size, and each slice is
# added as decimals whose scale holds all digits of its values, with room for 10^12 rows.
# Behind 17 digits a small value leaves a rest, which is added on its own, to 37 digits.
_TO_MAIN, _TO_WIDE, _TO_LARGE, _TO_HUGE = 1e9, 1e18, 1e26, 1e35
_HUGE_UNIT = 2.0**64


def parts(value: Column) -> Column:
    """Sum of a double column in parts that can be added up further, in whatever order (`add_parts`)."""
    size = F.abs(value)
    main = value.try_cast("decimal(38,17)")
    rest = value.try_cast("decimal(38,38)") - main.cast("decimal(38,38)")
    return F.struct(
        F.try_sum(F.when((size < 0.1) & (rest != 0), rest)).alias("rest"),
        F.try_sum(F.when(size < _TO_MAIN, main)).alias("main"),
        F.try_sum(F.when((size >= _TO_MAIN) & (size < _TO_WIDE), value.try_cast("decimal(38,7)"))).alias("wide"),
        F.try_sum(F.when((size >= _TO_WIDE) & (size < _TO_LARGE), value.try_cast("decimal(38,0)"))).alias("large"),
        F.try_sum(
            F.when((size >= _TO_LARGE) & (size < _TO_HUGE), (value / _HUGE_UNIT).try_cast("decimal(38,10)"))
        ).alias("huge"),
        F.sum(F.when(size >= _TO_HUGE, value)).alias("beyond"),
    )


def add_parts(column: Column) -> Column:
    """Add up stored `parts`."""
    names = ["rest", "main", "wide", "large", "huge"]
    sums = [F.try_sum(column.getField(name)).alias(name) for name in names]
    return F.struct(*sums, F.sum(column.getField("beyond")).alias("beyond"))


def _plus(left: Column, right: Column, scale: int) -> Column:
    """Exact sum of two decimals, one of them if the other is NULL; NULL if it has too many digits."""
    a, b = (side.try_cast(f"decimal(37,{scale})") for side in (left, right))
    return F.when(left.isNull(), b).when(right.isNull(), a).otherwise(a + b)


def from_parts(summed: Column) -> Column:
    """The double next to a sum in parts; NULL for no values.

    Parts that may cancel each other are added as decimals as long as these have the digits.
    """
    names = ("rest", "main", "wide", "large", "huge", "beyond")
    some = F.coalesce(*[summed.getField(name).cast("double") for name in names])
    rest, main, wide, large, huge, beyond = (F.nullif(summed.getField(name), F.lit(0)) for name in names)
    doubles = {name: F.coalesce(part.cast("double"), F.lit(0.0)) for name, part in zip(names, (rest, main, wide, large))}
    high = _plus(wide, large, 7)
    mid = _plus(main, high, 17)
    fits = mid.isNotNull() & (large.isNull() | high.isNotNull())
    low = F.when(fits, F.coalesce(_plus(mid, rest, 30).cast("double"), mid.cast("double") + doubles["rest"]))
    rough = (doubles["rest"] + doubles["main"]) + (doubles["wide"] + doubles["large"])
    outer = F.coalesce(huge.cast("double") * _HUGE_UNIT, F.lit(0.0)) + F.coalesce(beyond, F.lit(0.0))
    return F.when(some.isNotNull(), F.coalesce(low, rough) + outer)


def total(value: Column) -> Column:
    """Sum of a double column, the same in whatever order its rows arrive.

    Values are added as the decimals that they print as, without a limit of digits for
    values of ordinary size: from 1e-21 to 1e35 every digit counts, below that those up to
    the 37th behind the point. So partitions, retried tasks and the ANSI setting make no
    difference. Values beyond 1e35, infinite ones and NaN are added as doubles.
    """
    return from_parts(parts(value))


def mean(value: Column) -> Column:
    """Mean of a double column, NULL for no values; the sum is that of `total`."""
    n = F.count(value)
    return F.when(n > 0, total(value) / n)


def signed_text(value: Column, digits: int = 1) -> Column:
    """`+0.4`, `-1.2`."""
    return F.format_string(f"%+.{digits}f", value)
