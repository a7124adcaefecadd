"""Text: trimming, dish and category names, report formats."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from checkmart.vocabulary import DELIVERY_PREFIX, NO_VALUE

# Unicode whitespace, including the ASCII separators U+001C to U+001F.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def clean_text(c: Column) -> Column:
    """Strip Unicode whitespace at both ends; empty becomes NULL."""
    return F.nullif(F.btrim(c.cast("string"), F.lit(WHITESPACE)), F.lit(""))


def strip_prefix(c: Column, prefix: str) -> Column:
    """Remove one leading `prefix`."""
    return F.when(c.startswith(prefix), c.substr(F.lit(len(prefix) + 1), F.length(c))).otherwise(c)


def category_clean(c: Column, prefix: str = DELIVERY_PREFIX) -> Column:
    """Category without the delivery-menu prefix, so that one dish has one category in every channel.

    Follows the documented intent. A pattern that escapes the dot twice would match nothing and leave the
    prefix in place.
    """
    return strip_prefix(c, prefix)


def is_delivery_category(c: Column, prefix: str = DELIVERY_PREFIX) -> Column:
    """Whether the category belongs to the delivery menu; NULL counts as no."""
    return F.coalesce(c.startswith(prefix), F.lit(False))


def dish_name_normalized(c: Column, prefix: str = DELIVERY_PREFIX) -> Column:
    """Dish name without the delivery prefix and without one trailing plus sign."""
    return F.regexp_replace(strip_prefix(c, prefix), r"\s*\+\s*\z", "")


def normalize_channel(c: Column, patterns: Sequence[tuple[str, str]], other: str) -> Column:
    """Label of the first case-insensitive LIKE pattern that matches, else `other`."""
    label = None
    for pattern, name in patterns:
        label = F.when(c.ilike(pattern), name) if label is None else label.when(c.ilike(pattern), name)
    return label.otherwise(other)


def fmt_number(c: Column) -> Column:
    """Whole number with blanks between thousands; a dash for NULL."""
    return F.coalesce(F.translate(F.format_number(c, 0), ",", " "), F.lit(NO_VALUE))


def fmt_money(c: Column) -> Column:
    """Whole roubles with blanks between thousands; a dash for NULL."""
    return F.coalesce(F.concat(F.translate(F.format_number(c, 0), ",", " "), F.lit(" ₽")), F.lit(NO_VALUE))


def fmt_percent(c: Column) -> Column:
    """Percentage with one decimal; a dash for NULL."""
    return F.coalesce(F.concat(F.translate(F.format_number(c, 1), ",", ""), F.lit("%")), F.lit(NO_VALUE))
