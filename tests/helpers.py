"""Hand-built frames."""

import datetime as dt

from checkmart.schemas import RAW_CHECKS, RAW_PLAN


def ts(text):
    return dt.datetime.fromisoformat(text) if text else None


def day(text):
    return dt.date.fromisoformat(text) if text else None


def raw_checks(spark, rows):
    """Raw check lines from dicts; missing columns are NULL, row ids run from 1."""
    names = RAW_CHECKS.names
    filled = []
    for number, row in enumerate(rows, start=1):
        row = {"source_row_id": number, **row}
        for key in ("open_ts", "close_ts", "source_loaded_at"):
            row[key] = ts(row.get(key))
        row["accounting_date"] = day(row.get("accounting_date"))
        filled.append(tuple(row.get(name) for name in names))
    return spark.createDataFrame(filled, RAW_CHECKS)


def raw_plan(spark, rows):
    filled = [tuple({**row, "plan_date": day(row["plan_date"])}.get(n) for n in RAW_PLAN.names) for row in rows]
    return spark.createDataFrame(filled, RAW_PLAN)


def line(check, close, qty, amount=0.0, **more):
    """A check line of 1 February 2026."""
    return {
        "check_id": check,
        "accounting_date": "2026-02-01",
        "open_ts": "2026-02-01 10:00:00",
        "close_ts": close and f"2026-02-01 {close}:00",
        "dish_name": "Карбонара",
        "dish_category": "ПАСТА",
        "order_type": "Заказ в ресторане",
        "qty": qty,
        "guest_count": 2,
        "amount_discount_rub": amount,
        **more,
    }
