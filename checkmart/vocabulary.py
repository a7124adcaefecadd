"""Fixed values of the restaurant POS feed.

Every operator takes these as default arguments, so the same operators run on other feeds with other words.
"""

from collections.abc import Mapping, Sequence
from typing import NamedTuple

# Extract headers and their canonical column names.
FACT_HEADERS = {
    "Учетный день": "accounting_date",
    "Номер чека": "check_id",
    "Время открытия": "open_ts",
    "Час открытия": "open_hour",
    "Время закрытия": "close_ts",
    "Час закрытия": "close_hour",
    "Блюдо": "dish_name",
    "Категория блюда": "dish_category",
    "Тип заказа": "order_type",
    "Количество блюд": "qty",
    "Количество гостей": "guest_count",
    "Сумма со скидкой, р.": "amount_discount_rub",
}

# Plan headers as (header, occurrence counted from 0) and their canonical column names.
PLAN_HEADERS = {
    ("Учетный день", 0): "plan_date",
    ("План на день", 0): "plan_total_amount",
    ("Ресторан", 0): "plan_restaurant_amount",
    ("БАНКЕТ НАШ", 0): "plan_banquet_own_amount",
    ("Банкет C&B", 0): "plan_banquet_cb_amount",
    ("Агрегатор", 0): "plan_aggregator_amount",
    ("Самовывоз", 0): "plan_pickup_amount",
    ("Доставка", 0): "plan_delivery_amount",
    ("Ресторан", 1): "plan_avg_check_restaurant",
    ("Доставка", 1): "plan_avg_check_delivery",
    ("Ресторан", 2): "plan_avg_guest_restaurant",
    ("Доставка", 2): "plan_avg_guest_delivery",
    ("Банкет", 0): "plan_avg_guest_banquet",
}

# Order types of every sales channel; anything else belongs to OTHER_CHANNEL.
ORDER_TYPE_CHANNELS = {
    "delivery": [
        "Приложение (доставка курьером)",
        "Сайт (доставка курьером)",
        "Доставка курьером",
        "Агрегатор (Курьером)",
        "Яндекс.ультима",
    ],
    "pickup": [
        "Приложение (самовывоз гостем)",
        "Сайт (самовывоз гостем)",
        "Самовывоз гостем",
        "Агрегатор (Самовывоз)",
    ],
    "restaurant": ["Заказ в ресторане", "Заказ с собой", "Веранда"],
    "banquet": ["Банкет", "Банкет C&B"],
}
OTHER_CHANNEL = "other"
CHANNELS = ["delivery", "pickup", "restaurant", "banquet", "other"]

# Dishes that are service lines rather than menu items.
SERVICE_DISHES = [
    "Округление в пользу гостя",
    "Сервисный сбор",
    "Доставка 199",
    "Доставка 299",
    "CHEESE/ S Маргарита",
    "PET/вкусняшка + ваучер на груминг",
]
ROUNDING_DISH = "Округление в пользу гостя"

# Category words.
MODIFIER_CATEGORY = "МОДИФИКАТОРЫ"
DELIVERY_PREFIX = "Д."
SERVICE_CATEGORIES = ["МОДИФИКАТОРЫ", "УСЛУГИ", "ПРОМО", "ДОПЫ", "АКЦИИ/ПОДАРКИ", "МАРКИРОВКА"]

# Case-insensitive order-type patterns and their labels; the first match wins.
CHANNEL_PATTERNS = [
    ("%курьер%", "delivery_courier"),
    ("%агрегатор%курьер%", "delivery_courier"),
    ("%агрегатор%самовывоз%", "pickup_aggregator"),
    ("%самовывоз%", "pickup_direct"),
    ("%приложение%самовывоз%", "pickup_app"),
    ("%яндекс%", "delivery_yandex"),
    ("%сайт%", "delivery_site"),
    ("%ресторан%", "dine_in"),
    ("%заказ в ресторан%", "dine_in"),
    ("%банкет%", "banquet"),
]

# Thresholds of the check flags.
LONG_CHECK_HOURS = 12
SUSPICIOUS_OPEN_DAYS = 3

# Report wording and sizes.
TOP_DISHES = 15
DETAIL_PAGE_ROWS = 12
SAMPLE_ROWS = 10
NO_VALUE = "—"
NO_CATEGORY = "без категории"
DETAIL_HEADERS = ["Дата", "Факт", "План", "Выполнение", "YoY", "Чеки", "Средний чек"]

# The incremental source and its lineage mark.
CHECK_SOURCE_NAME = "pos.check_items"
CHECK_SOURCE_SYSTEM = "pos_excel_simulated_db"


class CheckRules(NamedTuple):
    """The words of a feed that staging needs to derive channels, categories and flags."""

    channels: Mapping[str, Sequence[str]] = ORDER_TYPE_CHANNELS
    service_dishes: Sequence[str] = SERVICE_DISHES
    modifier_category: str = MODIFIER_CATEGORY
    delivery_prefix: str = DELIVERY_PREFIX


RESTAURANT = CheckRules()
