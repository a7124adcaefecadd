"""Business flags and groups. Flags are two-valued: NULL input gives FALSE unless said otherwise."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from checkmart.vocabulary import (
    MODIFIER_CATEGORY,
    ORDER_TYPE_CHANNELS,
    OTHER_CHANNEL,
    ROUNDING_DISH,
    SERVICE_CATEGORIES,
    SERVICE_DISHES,
)


def channel_group(
    c: Column, channels: Mapping[str, Sequence[str]] = ORDER_TYPE_CHANNELS, other: str = OTHER_CHANNEL
) -> Column:
    """First channel whose list holds the order type exactly; everything else, NULL included, is `other`."""
    channel = F.lit(other)
    for name, order_types in reversed(channels.items()):
        channel = F.when(c.isin(*order_types), name).otherwise(channel)
    return channel


def is_service_item(dish: Column, names: Sequence[str] = SERVICE_DISHES) -> Column:
    return F.coalesce(dish.isin(*names), F.lit(False))


def is_zero_amount_modifier(category: Column, amount: Column, modifier: str = MODIFIER_CATEGORY) -> Column:
    """A free modifier line; tests the category as received, and a NULL amount counts as zero."""
    return F.coalesce((category == modifier) & (F.coalesce(amount, F.lit(0)) == 0), F.lit(False))


def is_zero_qty(qty: Column) -> Column:
    return F.coalesce(qty, F.lit(0)) == 0


def is_turnover_item(zero_modifier: Column) -> Column:
    """Lines that count in turnover; service lines do."""
    return ~zero_modifier


def is_dish_sales_item(service: Column, zero_modifier: Column) -> Column:
    """Lines that count as dish sales; service lines do not."""
    return ~(service | zero_modifier)


def is_service_category(category: Column, categories: Sequence[str] = SERVICE_CATEGORIES) -> Column:
    """Documented variant of the service flag, by category; NULL stays NULL."""
    return category.isin(*categories)


def is_modifier(category: Column, modifier: str = MODIFIER_CATEGORY) -> Column:
    """Documented modifier flag; NULL stays NULL."""
    return category == modifier


def is_rounding_adjustment(dish: Column, name: str = ROUNDING_DISH) -> Column:
    """Documented flag of the rounding line; NULL stays NULL."""
    return dish == name
