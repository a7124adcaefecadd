"""Numbers: coercion, rounding, guarded ratios and order-independent money sums."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that counts as a number: decimal or exponent notation, or an infinity.
NUMBER_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*$"

# Decimals kept when money is summed; a DECIMAL sum does not depend on how rows were partitioned.
MONEY_SCALE = 10
# DECIMAL(28, MONEY_SCALE) holds amounts below this; totals may be ten billion times larger.
_MONEY_LIMIT = 1e17


def to_number(c: Column, as_int: bool = False) -> Column:
    """Text as a double, or NULL where it is no number.

    With `as_int` the result is a bigint, and a value with a fraction fails the query instead of being truncated.
    """
    text = c.cast("string")
    value = F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
    if not as_int:
        return value
    message = F.concat(F.lit("not a whole number: "), text)
    checked = F.when(value == F.floor(value), value.cast("bigint")).when(value.isNotNull(), F.raise_error(message))
    # the direct cast keeps ids above 2^53 exact
    return F.coalesce(text.try_cast("bigint"), checked)


def round_half_away(c: Column, digits: int) -> Column:
    """Scale, round halves away from zero, scale back (1.005 -> 1.0 at two digits, because 1.005 * 100 < 100.5)."""
    scale = F.lit(float(10**digits))
    return F.round(c * scale) / scale


def guarded_ratio(num: Column, den: Column) -> Column:
    """num / den as a double; NULL when the denominator is zero or NULL."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def money_sum(c: Column, scale: int = MONEY_SCALE) -> Column:
    """Order-independent sum of an amount, as a double; NULL when every value is NULL.

    Each amount counts with `scale` (at most 10) decimals. Infinite and NaN amounts, and those of 1e17 and more, are added
    as doubles: one infinity makes the total infinite, NaN or both infinities make it NaN.
    """
    amount = c.cast("double")
    regular = F.abs(amount) < _MONEY_LIMIT  # false for infinities and, since NaN is the largest double, for NaN
    exact = F.sum(F.when(regular, amount).cast(f"decimal({18 + scale},{scale})")).cast("double")
    rest = F.sum(F.when(~regular, amount))
    return F.when(rest.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + rest)
