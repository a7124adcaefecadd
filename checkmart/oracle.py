"""The same results as plain DuckDB SQL over the given tables, written independently of the DataFrame code.

Final versions use a window here (the operators an aggregate and a join), date differences use DATE_DIFF, and
money is summed as DECIMAL.
"""

# --- inputs ----------------------------------------------------------------------------------------------------------

ORDER_LINES = r"""
ol_raw AS (
  SELECT CAST(NULL AS BIGINT) AS source_row_id,
    CAST(o_orderdate AS DATE) AS accounting_date,
    l_orderkey AS check_id,
    CAST(o_orderdate - to_days(CAST(o_orderkey % 5 AS INTEGER)) AS TIMESTAMP) AS open_ts,
    l_shipdate AS close_ts,
    p_name AS dish_name,
    CASE p_type WHEN 'PROMO' THEN 'Д.' || p_brand WHEN 'SMALL' THEN 'МОДИФИКАТОРЫ' ELSE p_brand END AS dish_category,
    o_orderpriority AS order_type,
    CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS qty,
    CAST(1 + o_custkey % 4 AS INTEGER) AS guest_count,
    CAST(CASE WHEN p_type = 'SMALL' AND l_quantity <= 25 THEN 0
      ELSE CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) END AS DECIMAL(18,4)) AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
ol AS (
  SELECT *,
    CASE WHEN dish_category[1:2] = 'Д.' THEN dish_category[3:] ELSE dish_category END AS category_clean,
    COALESCE(dish_category[1:2] = 'Д.', FALSE) AS is_delivery_category,
    CASE order_type WHEN '1-URGENT' THEN 'delivery' WHEN '2-HIGH' THEN 'pickup' WHEN '3-MEDIUM' THEN 'restaurant'
      WHEN '4-NOT SPECIFIED' THEN 'banquet' ELSE 'other' END AS channel_group,
    dish_name IN ('red plate', 'hot ring') AS is_service_item,
    (dish_category = 'МОДИФИКАТОРЫ' AND COALESCE(amount, 0) = 0) AS is_zero_amount_modifier,
    DATE_DIFF('minute', open_ts, close_ts) AS check_duration_minutes,
    COALESCE(DATE_DIFF('hour', open_ts, close_ts) > 12, FALSE) AS is_long_duration_check,
    COALESCE(open_ts < CAST(accounting_date AS TIMESTAMP) - INTERVAL 3 DAY, FALSE) AS is_suspicious_open_date
  FROM ol_raw
)"""

EVENT_LINES = r"""
ev_k AS (
  SELECT *, CAST(regexp_extract(props, '"k": *(\d+)', 1) AS INTEGER) AS k, date_trunc('day', ts) AS day_start FROM events
),
ev_raw AS (
  SELECT event_id + 1 AS source_row_id,
    CAST(ts AS DATE) AS accounting_date,
    user_id * 100 + EXTRACT(day FROM ts) AS check_id,
    ts AS open_ts,
    CAST(EXTRACT(hour FROM ts) AS INTEGER) AS open_hour,
    CAST(day_start + to_hours(CAST(6 * (EXTRACT(hour FROM ts) // 6 + 1) AS INTEGER)) AS TIMESTAMP) AS close_ts,
    CAST((6 * (EXTRACT(hour FROM ts) // 6 + 1)) % 24 AS INTEGER) AS close_hour,
    CASE WHEN event_id % 89 <> 5 THEN 'dish-' || CAST(k % 20 AS VARCHAR) END AS dish_name,
    CASE k % 3 WHEN 0 THEN 'Д.ПИЦЦА' WHEN 1 THEN 'ПИЦЦА' ELSE 'МОДИФИКАТОРЫ' END AS dish_category,
    CASE WHEN event_id % 97 <> 3 THEN event_type END AS order_type,
    CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 + event_id % 3 END AS DOUBLE) AS qty,
    CAST(1 + user_id % 4 AS INTEGER) AS guest_count,
    CAST(CASE WHEN k % 3 = 2 AND k % 2 = 0 THEN 0 ELSE CAST(value AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS amount,
    'events' AS source_system,
    '2024-01 ' || CASE WHEN EXTRACT(day FROM ts) <= 15 THEN 'first' ELSE 'second' END || ' half' AS source_period,
    event_id + 2 AS source_row_number
  FROM ev_k
),
ev AS (
  SELECT *, source_period AS source_sheet,
    CASE WHEN dish_category = 'Д.ПИЦЦА' THEN 'ПИЦЦА' ELSE dish_category END AS category_clean,
    dish_category = 'Д.ПИЦЦА' AS is_delivery_category,
    CASE order_type WHEN 'click' THEN 'delivery' WHEN 'purchase' THEN 'pickup' WHEN 'signup' THEN 'restaurant'
      WHEN 'view' THEN 'banquet' ELSE 'other' END AS channel_group,
    COALESCE(dish_name IN ('dish-3', 'dish-11'), FALSE) AS is_service_item,
    (dish_category = 'МОДИФИКАТОРЫ' AND amount = 0) AS is_zero_amount_modifier,
    DATE_DIFF('minute', open_ts, close_ts) AS check_duration_minutes,
    DATE_DIFF('hour', open_ts, close_ts) > 12 AS is_long_duration_check,
    open_ts < CAST(accounting_date AS TIMESTAMP) - INTERVAL 3 DAY AS is_suspicious_open_date
  FROM ev_raw
)"""


def final_of(lines: str) -> str:
    return f"""
{lines}_fact AS (
  SELECT s.*, s.accounting_date AS revenue_date, NOT s.is_zero_amount_modifier AS is_turnover_item,
    NOT s.is_service_item AND NOT s.is_zero_amount_modifier AS is_dish_sales_item
  FROM {lines} s
  WHERE COALESCE(s.qty, 0) > 0 AND s.check_id IS NOT NULL AND s.close_ts IS NOT NULL
  QUALIFY s.close_ts = MAX(s.close_ts) OVER (PARTITION BY s.check_id)
)"""


PLAN = r"""
pl_sum AS (
  SELECT CAST(o_orderdate AS DATE) + 45 AS plan_date, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS ordered
  FROM orders GROUP BY 1
),
pl_total AS (
  SELECT plan_date, CASE WHEN EXTRACT(day FROM plan_date) = 13 THEN CAST(0 AS DOUBLE) ELSE ordered END AS total FROM pl_sum
),
pl AS (
  SELECT plan_date, total AS plan_total_amount,
    total * CAST(0.4 AS DOUBLE) AS plan_restaurant_amount,
    total * CAST(0.05 AS DOUBLE) AS plan_banquet_own_amount,
    CASE WHEN EXTRACT(day FROM plan_date) <> 1 THEN total * CAST(0.05 AS DOUBLE) END AS plan_banquet_cb_amount,
    total * CAST(0.2 AS DOUBLE) AS plan_aggregator_amount,
    total * CAST(0.1 AS DOUBLE) AS plan_pickup_amount,
    total * CAST(0.2 AS DOUBLE) AS plan_delivery_amount,
    CAST(2500 AS DOUBLE) AS plan_avg_check_restaurant,
    CAST(1800 AS DOUBLE) AS plan_avg_check_delivery,
    CAST(1250 AS DOUBLE) AS plan_avg_guest_restaurant,
    CAST(900 AS DOUBLE) AS plan_avg_guest_delivery,
    CAST(3000 AS DOUBLE) AS plan_avg_guest_banquet
  FROM pl_total
)"""

CELLS = r"""
cells AS (
  SELECT
    CASE WHEN source_row_id % 37 = 5 THEN 'no date'
      WHEN source_row_id % 3 = 1 THEN strftime(accounting_date, '%d.%m.%Y')
      ELSE CAST(accounting_date AS VARCHAR) END AS accounting_date,
    CASE WHEN source_row_id % 41 = 3 THEN NULL WHEN source_row_id % 43 = 7 THEN 'n/a'
      ELSE CAST(check_id AS VARCHAR) END AS check_id,
    CAST(open_ts AS VARCHAR) AS open_ts,
    CAST(open_hour AS VARCHAR) || CASE WHEN source_row_id % 11 = 0 THEN '.0' ELSE '' END AS open_hour,
    CASE WHEN source_row_id % 31 = 2 THEN '2024' ELSE CAST(close_ts AS VARCHAR) END AS close_ts,
    CAST(close_hour AS VARCHAR) AS close_hour,
    CASE WHEN source_row_id % 7 = 2 THEN ' ' || chr(9) || dish_name || chr(160) ELSE dish_name END AS dish_name,
    CASE WHEN source_row_id % 13 = 4 THEN ' ' || chr(160) || ' ' ELSE dish_category END AS dish_category,
    CASE WHEN source_row_id % 17 = 8 THEN NULL ELSE order_type || chr(8195) END AS order_type,
    CASE WHEN source_row_id % 23 = 1 THEN 'x' ELSE CAST(qty AS VARCHAR) END AS qty,
    CASE WHEN source_row_id % 29 = 4 THEN ' ' ELSE CAST(guest_count AS VARCHAR) END AS guest_count,
    CASE WHEN source_row_id % 19 = 6 THEN '12,5' ELSE CAST(CAST(amount AS DOUBLE) AS VARCHAR) END AS amount_discount_rub,
    CAST(source_row_number AS VARCHAR) AS source_row_number
  FROM ev
)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


ORDERS = with_(ORDER_LINES)
ORDERS_FACT = with_(ORDER_LINES, final_of("ol"))
EVENTS = with_(EVENT_LINES)
EVENTS_FACT = with_(EVENT_LINES, final_of("ev"))
EVENT_CELLS = with_(EVENT_LINES, CELLS)

# --- marts -----------------------------------------------------------------------------------------------------------

_CHANNELS = ["restaurant", "delivery", "pickup", "banquet", "other"]


def _channel_sums(suffix: str) -> str:
    return ",\n".join(
        f"SUM(CASE WHEN channel_group = '{c}' AND is_turnover_item THEN amount ELSE 0 END) AS {c}{suffix}"
        for c in _CHANNELS
    )


def checks_of(fact: str) -> str:
    return f"""
checks AS (
  SELECT revenue_date, check_id, MAX(guest_count) AS guest_count,
    SUM(CASE WHEN is_turnover_item THEN amount ELSE 0 END) AS check_revenue, {_channel_sums("_revenue")}
  FROM {fact} GROUP BY revenue_date, check_id
)"""


ACTUAL = f"""
actual AS (
  SELECT revenue_date, COUNT(*) AS checks_count, CAST(SUM(guest_count) AS BIGINT) AS guests_count,
    CAST(SUM(check_revenue) AS DOUBLE) AS fact_total_amount,
    {", ".join(f"CAST(SUM({c}_revenue) AS DOUBLE) AS fact_{c}_amount" for c in _CHANNELS)},
    CAST(SUM(check_revenue) AS DOUBLE) / COUNT(*) AS avg_check_per_order,
    CAST(SUM(check_revenue) AS DOUBLE) / NULLIF(SUM(guest_count), 0) AS avg_check_per_guest
  FROM checks GROUP BY revenue_date
)"""

PLAN_FACT = """
plan_fact AS (
  SELECT COALESCE(a.revenue_date, p.plan_date) AS revenue_date, checks_count, guests_count,
    ROUND(fact_total_amount, 2) AS fact_total_amount,
    ROUND(plan_total_amount, 2) AS plan_total_amount,
    ROUND(fact_total_amount - plan_total_amount, 2) AS plan_fact_delta_amount,
    ROUND(fact_total_amount / NULLIF(plan_total_amount, 0), 4) AS plan_completion_rate,
    ROUND(fact_restaurant_amount, 2) AS fact_restaurant_amount,
    ROUND(plan_restaurant_amount, 2) AS plan_restaurant_amount,
    ROUND(fact_delivery_amount, 2) AS fact_delivery_amount,
    ROUND(plan_delivery_amount + plan_aggregator_amount, 2) AS plan_delivery_and_aggregator_amount,
    ROUND(fact_pickup_amount, 2) AS fact_pickup_amount,
    ROUND(plan_pickup_amount, 2) AS plan_pickup_amount,
    ROUND(fact_banquet_amount, 2) AS fact_banquet_amount,
    ROUND(plan_banquet_own_amount + plan_banquet_cb_amount, 2) AS plan_banquet_amount,
    ROUND(fact_other_amount, 2) AS fact_other_amount,
    ROUND(avg_check_per_order, 2) AS avg_check_per_order,
    ROUND(avg_check_per_guest, 2) AS avg_check_per_guest,
    plan_avg_check_restaurant, plan_avg_check_delivery, plan_avg_guest_restaurant, plan_avg_guest_delivery,
    plan_avg_guest_banquet
  FROM actual a FULL OUTER JOIN pl p ON a.revenue_date = p.plan_date
)"""

DASHBOARD = """
prev_days AS (
  SELECT CAST(revenue_date + INTERVAL 1 YEAR AS DATE) AS revenue_date, COUNT(*) AS days,
    CAST(SUM(CAST(fact_total_amount AS DECIMAL(18,2))) AS DOUBLE) AS fact_total_amount,
    CAST(SUM(checks_count) AS BIGINT) AS checks_count, CAST(SUM(guests_count) AS BIGINT) AS guests_count,
    MAX(avg_check_per_order) AS per_order, MAX(avg_check_per_guest) AS per_guest
  FROM plan_fact GROUP BY 1
),
prev AS (
  SELECT revenue_date, fact_total_amount, checks_count, guests_count,
    CASE days WHEN 1 THEN per_order ELSE ROUND(fact_total_amount / NULLIF(checks_count, 0), 2) END AS avg_check_per_order,
    CASE days WHEN 1 THEN per_guest ELSE ROUND(fact_total_amount / NULLIF(guests_count, 0), 2) END AS avg_check_per_guest
  FROM prev_days
),
dash AS (
  SELECT c.* EXCLUDE (plan_avg_check_restaurant, plan_avg_check_delivery, plan_avg_guest_restaurant,
      plan_avg_guest_delivery, plan_avg_guest_banquet),
    y.fact_total_amount AS prev_year_fact_total_amount, y.checks_count AS prev_year_checks_count,
    y.guests_count AS prev_year_guests_count, y.avg_check_per_order AS prev_year_avg_check_per_order,
    y.avg_check_per_guest AS prev_year_avg_check_per_guest,
    ROUND((c.fact_total_amount - y.fact_total_amount) / NULLIF(y.fact_total_amount, 0), 4) AS yoy_growth_rate,
    c.checks_count - y.checks_count AS yoy_checks_delta,
    ROUND(c.avg_check_per_order - y.avg_check_per_order, 2) AS yoy_avg_check_delta
  FROM plan_fact c LEFT JOIN prev y ON c.revenue_date = y.revenue_date
)"""


def sales_by(name: str, fact: str, by: str) -> str:
    return f"""
{name} AS (
  SELECT {by}, COUNT(*) AS checks_count, CAST(SUM(guest_count) AS BIGINT) AS guests_count,
    ROUND(CAST(SUM(check_revenue) AS DOUBLE), 2) AS revenue_amount,
    ROUND(CAST(SUM(check_revenue) AS DOUBLE) / COUNT(*), 2) AS avg_check_per_order,
    ROUND(CAST(SUM(check_revenue) AS DOUBLE) / NULLIF(SUM(guest_count), 0), 2) AS avg_revenue_per_guest
  FROM (
    SELECT {by}, check_id, MAX(guest_count) AS guest_count,
      SUM(CASE WHEN is_turnover_item THEN amount ELSE 0 END) AS check_revenue
    FROM {fact} GROUP BY {by}, check_id) c
  GROUP BY {by}
)"""


CHANNEL_DAILY = sales_by("channel_daily", "ev_fact", "revenue_date, channel_group")
ORDER_TYPE_DAILY = sales_by("order_type_daily", "ev_fact", "revenue_date, order_type, channel_group")

DISH_DAILY = """
dish_daily AS (
  SELECT revenue_date, category_clean, dish_name, SUM(qty) AS qty_sold,
    ROUND(CAST(SUM(amount) AS DOUBLE), 2) AS dish_revenue_amount, COUNT(DISTINCT check_id) AS checks_count
  FROM ol_fact WHERE is_dish_sales_item GROUP BY ALL
)"""

ORDERS_CHECKS = [ORDER_LINES, final_of("ol"), checks_of("ol_fact")]
ORDERS_ACTUAL = [*ORDERS_CHECKS, ACTUAL]
ORDERS_PLAN_FACT = [*ORDERS_ACTUAL, PLAN, PLAN_FACT]
ORDERS_DASHBOARD = [*ORDERS_PLAN_FACT, DASHBOARD]

_KEY = "check_id, dish_name, close_ts"
_LINE = (
    "accounting_date, check_id, open_ts, open_hour, close_ts, close_hour, dish_name, dish_category, order_type, qty,"
    " guest_count, CAST(amount AS DOUBLE) AS amount_discount_rub"
)
_LINEAGE = "source_system, source_sheet, source_period, source_row_number"


def _key(*columns: str) -> str:
    """A surrogate key; NULL parts count as empty text."""
    return "MD5(" + " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in columns) + ")"


def _fact_select(lines: str, hours: str, sheet: str, period: str) -> str:
    item = _key("source_row_id", "check_id", "close_ts", "dish_name", "dish_category", "order_type")
    return f"""
SELECT {item} AS check_item_key,
  source_row_id, revenue_date, check_id, open_ts, close_ts, {hours},
  {_key("dish_name", "category_clean")} AS dish_key, {_key("order_type", "channel_group")} AS order_type_key,
  dish_name, dish_category, category_clean, is_delivery_category, order_type, channel_group, qty, guest_count,
  CAST(amount AS DOUBLE) AS amount_discount_rub, is_service_item, is_zero_amount_modifier, is_turnover_item,
  is_dish_sales_item, check_duration_minutes, is_long_duration_check, is_suspicious_open_date,
  {period} AS source_period, {sheet} AS source_sheet, CAST(NULL AS TIMESTAMP) AS extracted_at
FROM {lines}_fact"""


_EVENTS_FACT_SELECT = EVENTS_FACT + _fact_select("ev", "open_hour, close_hour", "source_sheet", "source_period")

_MIDNIGHT = "CAST(0 AS INTEGER) AS open_hour, CAST(0 AS INTEGER) AS close_hour"

_TYPED_CELLS = """
  CASE WHEN accounting_date = 'no date' THEN NULL WHEN contains(accounting_date, '.')
    THEN CAST(strptime(accounting_date, '%d.%m.%Y') AS DATE) ELSE CAST(accounting_date AS DATE) END AS accounting_date,
  TRY_CAST(check_id AS BIGINT) AS check_id"""

_BROKEN = """
broken AS (
  SELECT * REPLACE (
    CASE WHEN source_row_id % 50 = 7 THEN 'kiosk' WHEN source_row_id % 50 = 8 THEN NULL ELSE channel_group END
      AS channel_group,
    CASE WHEN source_row_id % 40 = 3 THEN NULL ELSE dish_name END AS dish_name,
    CASE WHEN source_row_id % 30 = 1 THEN source_row_id - 1 WHEN source_row_id % 90 = 5 THEN NULL
      ELSE source_row_id END AS source_row_id)
  FROM ev
)"""

_DISH_DIM = "SELECT DISTINCT MD5(dish_name || '|' || category_clean) AS dish_key FROM {}"


def _nulls(table: str, column: str, source: str) -> str:
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, 'not_null' AS test, COUNT(*) - COUNT({column}) AS failures FROM {source}"


def _dups(table: str, column: str, source: str) -> str:
    return (
        f"SELECT '{table}', '{column}', 'unique', COUNT(*) FROM (SELECT {column} FROM {source}"
        f" WHERE {column} IS NOT NULL GROUP BY {column} HAVING COUNT(*) > 1)"
    )


def _strange(table: str, column: str, source: str) -> str:
    return (
        f"SELECT '{table}', '{column}', 'accepted_values', COUNT(DISTINCT {column}) FROM {source}"
        f" WHERE {column} NOT IN ('delivery', 'pickup', 'restaurant', 'banquet', 'other')"
    )


_DQ_TABLES = f"""
keyed AS ({_fact_select("ol", _MIDNIGHT, "NULL", "NULL")}),
dishes AS (
  SELECT MD5(dish_name || '|' || category_clean) AS dish_key, ANY_VALUE(dish_name) AS dish_name
  FROM ol WHERE dish_name IS NOT NULL GROUP BY dish_name, category_clean),
order_types AS (
  SELECT DISTINCT MD5(order_type || '|' || channel_group) AS order_type_key, order_type, channel_group FROM ol),
cancelled AS (SELECT check_id FROM ol GROUP BY check_id HAVING COALESCE(MAX(qty), 0) <= 0),
ol_channel AS (SELECT revenue_date, channel_group FROM ol_fact GROUP BY ALL),
ol_types AS (SELECT revenue_date, order_type, channel_group FROM ol_fact GROUP BY ALL),
days AS (
  SELECT UNNEST(generate_series(
    (SELECT MIN(d) FROM (SELECT accounting_date AS d FROM ol UNION ALL SELECT plan_date FROM pl)),
    (SELECT MAX(d) FROM (SELECT accounting_date AS d FROM ol UNION ALL SELECT plan_date FROM pl)),
    INTERVAL 1 DAY)) AS date_key)"""

_DQ_CHECKS = [
    *[
        _nulls("stg_checks", c, "broken")
        for c in ("source_row_id", "accounting_date", "check_id", "dish_name")
    ],
    _dups("stg_checks", "source_row_id", "broken"),
    _strange("stg_checks", "channel_group", "broken"),
    _nulls("stg_plan_daily", "plan_date", "pl"),
    _dups("stg_plan_daily", "plan_date", "pl"),
    _nulls("stg_plan_daily", "plan_total_amount", "pl"),
    _nulls("dim_date", "date_key", "days"),
    _dups("dim_date", "date_key", "days"),
    _nulls("dim_dish", "dish_key", "dishes"),
    _dups("dim_dish", "dish_key", "dishes"),
    _nulls("dim_dish", "dish_name", "dishes"),
    _nulls("dim_order_type", "order_type_key", "order_types"),
    _dups("dim_order_type", "order_type_key", "order_types"),
    _nulls("dim_order_type", "order_type", "order_types"),
    _strange("dim_order_type", "channel_group", "order_types"),
    *[
        _nulls("fact_check_items", c, "keyed")
        for c in ("check_item_key", "revenue_date", "check_id", "dish_key", "order_type_key")
    ],
    _dups("fact_check_items", "check_item_key", "keyed"),
    "SELECT 'fact_check_items', 'dish_key', 'relationship', COUNT(DISTINCT dish_key) FROM keyed"
    " WHERE dish_key NOT IN (SELECT dish_key FROM dishes)",
    "SELECT 'fact_check_items', 'order_type_key', 'relationship', COUNT(DISTINCT order_type_key) FROM keyed"
    " WHERE order_type_key NOT IN (SELECT order_type_key FROM order_types)",
    _nulls("cancelled_checks", "check_id", "cancelled"),
    _dups("cancelled_checks", "check_id", "cancelled"),
    _nulls("mart_plan_fact_daily", "revenue_date", "plan_fact"),
    _dups("mart_plan_fact_daily", "revenue_date", "plan_fact"),
    _nulls("mart_channel_daily", "revenue_date", "ol_channel"),
    _strange("mart_channel_daily", "channel_group", "ol_channel"),
    _nulls("mart_avg_check_by_order_type", "revenue_date", "ol_types"),
    _nulls("mart_avg_check_by_order_type", "order_type", "ol_types"),
    _nulls("mart_dish_sales_daily", "revenue_date", "dish_daily"),
    _nulls("mart_dish_sales_daily", "dish_name", "dish_daily"),
    _nulls("mart_dashboard_daily", "revenue_date", "dash"),
    _dups("mart_dashboard_daily", "revenue_date", "dash"),
]


def _kpis(label: str, where: str) -> str:
    def total(column: str) -> str:
        return f"CAST(COALESCE(SUM(CAST({column} AS DECIMAL(18,2))), 0) AS DOUBLE)"

    return f"""
SELECT '{label}' AS label, fact_amount, plan_amount, prev_year_amount, checks_count, guests_count,
  fact_amount / NULLIF(plan_amount, 0) * 100 AS plan_completion_pct,
  (fact_amount / NULLIF(prev_year_amount, 0) - 1) * 100 AS yoy_growth_pct,
  fact_amount / NULLIF(checks_count, 0) AS avg_check, fact_amount / NULLIF(guests_count, 0) AS avg_guest,
  CASE WHEN plan_amount <> 0 THEN fact_amount - plan_amount END AS plan_delta_amount
FROM (
  SELECT {total("fact_total_amount")} AS fact_amount, {total("plan_total_amount")} AS plan_amount,
    {total("prev_year_fact_total_amount")} AS prev_year_amount,
    CAST(COALESCE(SUM(checks_count), 0) AS BIGINT) AS checks_count,
    CAST(COALESCE(SUM(guests_count), 0) AS BIGINT) AS guests_count
  FROM dash WHERE {where})"""


def _thousands(c: str) -> str:
    return f"replace(format('{{:,.0f}}', CAST({c} AS DOUBLE)), ',', ' ')"


def _text_trim(c: str) -> str:
    space = r"[\s\v\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    return f"NULLIF(regexp_replace({c}, '^{space}+|{space}+$', '', 'g'), '')"


def _cell_lines(extra: str = "") -> str:
    return f"""
SELECT {_TYPED_CELLS},
  CAST(open_ts AS TIMESTAMP) AS open_ts, CAST(CAST(open_hour AS DOUBLE) AS INTEGER) AS open_hour,
  CASE WHEN close_ts <> '2024' THEN CAST(close_ts AS TIMESTAMP) END AS close_ts,
  CAST(close_hour AS INTEGER) AS close_hour,
  {_text_trim("dish_name")} AS dish_name, {_text_trim("dish_category")} AS dish_category,
  {_text_trim("order_type")} AS order_type, TRY_CAST(qty AS DOUBLE) AS qty,
  TRY_CAST(guest_count AS INTEGER) AS guest_count, TRY_CAST(amount_discount_rub AS DOUBLE) AS amount_discount_rub,
  'pos_excel_simulated_db' AS source_system, '2024-01' AS source_sheet, '2024-01' AS source_period,
  CAST(source_row_number AS BIGINT) AS source_row_number
FROM cells WHERE accounting_date <> 'no date' AND TRY_CAST(check_id AS BIGINT) IS NOT NULL"""


_RANGE = "SELECT '{}' AS label, revenue_date, checks_count, fact_total_amount FROM plan_fact WHERE {}"

ORACLE: dict[str, str] = {
    # columns
    "category_clean": f"{ORDERS} SELECT {_KEY}, dish_category, category_clean FROM ol",
    "is_delivery_category": f"{ORDERS} SELECT {_KEY}, dish_category, is_delivery_category FROM ol",
    "channel_group": f"{ORDERS} SELECT check_id, order_type, channel_group FROM ol",
    "is_service_item": f"{ORDERS} SELECT {_KEY}, is_service_item FROM ol",
    "is_zero_amount_modifier": f"""{ORDERS} SELECT {_KEY}, CAST(amount AS DOUBLE) AS amount_discount_rub,
      is_zero_amount_modifier AS is_zero_modifier FROM ol""",
    "is_long_duration_check": f"{ORDERS} SELECT {_KEY}, open_ts, is_long_duration_check AS is_long FROM ol",
    "is_suspicious_open_date": f"""{ORDERS}
      SELECT check_id, open_ts, accounting_date, is_suspicious_open_date AS is_suspicious FROM ol""",
    "is_zero_qty_row": f"{ORDERS} SELECT {_KEY}, qty, COALESCE(qty, 0) = 0 AS is_zero_qty FROM ol",
    "service_category_flags": f"""{ORDERS} SELECT {_KEY}, dish_category,
      dish_category IN ('Brand#1', 'Brand#2', 'Д.Brand#3') AS is_service_category,
      dish_category = 'МОДИФИКАТОРЫ' AS is_modifier FROM ol""",
    "is_multiday_check": f"""{ORDERS} SELECT check_id, open_ts, accounting_date,
      CAST(open_ts AS DATE) < accounting_date AS is_multiday FROM ol""",
    "is_rounding_adjustment": f"{ORDERS} SELECT {_KEY}, dish_name = 'red plate' AS is_rounding FROM ol",
    "normalize_channel_patterns": f"""{ORDERS}, named AS (SELECT *, ['Приложение (доставка курьером)',
        'Сайт (доставка курьером)', 'Доставка курьером', 'Агрегатор (Курьером)', 'Яндекс.ультима',
        'Приложение (самовывоз гостем)', 'Сайт (самовывоз гостем)', 'Самовывоз гостем', 'Агрегатор (Самовывоз)',
        'Заказ в ресторане', 'Заказ с собой', 'Веранда', 'Банкет', 'Банкет C&B'][check_id % 15 + 1] AS named_order_type
      FROM ol)
      SELECT check_id, order_type, named_order_type,
      CASE order_type WHEN '1-URGENT' THEN 'fast' WHEN '2-HIGH' THEN 'fast' WHEN '3-MEDIUM' THEN 'normal'
        WHEN '4-NOT SPECIFIED' THEN 'open' ELSE 'other' END AS channel,
      ['delivery_courier', 'delivery_courier', 'delivery_courier', 'delivery_courier', 'delivery_yandex',
        'pickup_direct', 'pickup_direct', 'pickup_direct', 'pickup_aggregator', 'dine_in', 'other', 'other',
        'banquet', 'banquet', 'other'][check_id % 15 + 1] AS named_channel FROM named""",
    "dish_name_normalized": f"""{ORDERS} SELECT check_id,
      'Д.' || dish_name || CASE WHEN is_long_duration_check THEN ' + ' ELSE '' END AS decorated,
      dish_name AS dish FROM ol""",
    "check_duration_minutes": f"""{with_(ORDER_LINES)},
      gaps AS (SELECT event_id, ts, CASE WHEN event_id % 50 <> 0
        THEN CAST(DATE '2024-01-01' + CAST(event_id % 40 AS INTEGER) AS TIMESTAMP) END AS before FROM events)
      SELECT 'event gap' AS label, event_id AS row_id, DATE_DIFF('minute', before, ts) AS minutes,
        COALESCE(DATE_DIFF('hour', before, ts) > 1, FALSE) AS is_long FROM gaps
      UNION ALL SELECT 'order line', check_id, check_duration_minutes, is_long_duration_check FROM ol""",
    "open_date_hour": f"""{EVENTS} SELECT source_row_id, CAST(date_trunc('day', open_ts) AS TIMESTAMP) AS open_date,
      open_hour FROM ev""",
    "excel_serial_to_ts": """WITH s AS (SELECT event_id, 46054 + event_id / CAST(977 AS DOUBLE) AS serial FROM events)
      SELECT event_id, serial, TIMESTAMP '1970-01-01 00:00:00'
        + to_microseconds(CAST(ROUND((serial - 25569) * CAST(86400000000 AS DOUBLE)) AS BIGINT)) AS serial_ts FROM s""",
    "coerce_numeric": f"""{EVENT_CELLS} SELECT source_row_number, TRY_CAST(qty AS DOUBLE) AS qty,
      TRY_CAST(amount_discount_rub AS DOUBLE) AS amount, TRY_CAST(check_id AS BIGINT) AS check_id,
      CAST(CAST(open_hour AS DOUBLE) AS BIGINT) AS open_hour, TRY_CAST(guest_count AS BIGINT) AS guest_count
      FROM cells""",
    "coerce_datetime": f"""{EVENT_CELLS} SELECT source_row_number,
      CAST(COALESCE(TRY_STRPTIME(accounting_date, '%d.%m.%Y'), TRY_STRPTIME(accounting_date, '%Y-%m-%d')) AS DATE)
        AS accounting_date, CAST(open_ts AS TIMESTAMP) AS open_ts,
      CAST(CAST(open_ts AS TIMESTAMP) AS DATE) AS open_day, TRY_CAST(close_ts AS TIMESTAMP) AS close_ts FROM cells""",
    "clean_text": f"""{EVENT_CELLS}
      SELECT 'line' AS label, CAST(source_row_number AS BIGINT) AS row_id, {_text_trim("dish_name")} AS first,
        {_text_trim("dish_category")} AS second, {_text_trim("order_type")} AS third FROM cells
      UNION ALL SELECT 'document', CAST(doc_id AS BIGINT), MD5({_text_trim("text")}), {_text_trim("lang")},
        {_text_trim("source")} FROM documents""",
    "fact_flags": f"""{ORDERS} SELECT {_KEY}, CAST(amount AS DOUBLE) AS amount_discount_rub,
      NOT is_zero_amount_modifier AS is_turnover_item,
      NOT (is_service_item OR is_zero_amount_modifier) AS is_dish_sales_item FROM ol""",
    "surrogate_keys": f"""SELECT source_row_id, check_item_key, dish_key, order_type_key
      FROM ({_EVENTS_FACT_SELECT})""",
    "guarded_ratio": f"""{with_(*ORDERS_PLAN_FACT)} SELECT revenue_date,
      fact_total_amount / NULLIF(plan_total_amount, 0) AS fact_to_plan,
      fact_total_amount / NULLIF(guests_count, 0) AS per_guest,
      plan_pickup_amount / NULLIF(fact_pickup_amount, 0) AS pickup_plan_to_fact FROM plan_fact""",
    # staging
    "stg_checks": f"""{ORDERS} SELECT source_row_id, accounting_date, check_id, open_ts, {_MIDNIGHT}, close_ts,
      dish_name, dish_category, order_type, qty, guest_count, CAST(amount AS DOUBLE) AS amount_discount_rub,
      CAST(NULL AS VARCHAR) AS source_system, CAST(NULL AS VARCHAR) AS source_file,
      CAST(NULL AS VARCHAR) AS source_sheet, CAST(NULL AS VARCHAR) AS source_period,
      CAST(NULL AS BIGINT) AS source_row_number, CAST(NULL AS TIMESTAMP) AS source_loaded_at,
      CAST(NULL AS TIMESTAMP) AS extracted_at, category_clean, is_delivery_category, channel_group, is_service_item,
      is_zero_amount_modifier, check_duration_minutes, is_long_duration_check, is_suspicious_open_date,
      COALESCE(qty, 0) = 0 AS is_zero_qty_row FROM ol""",
    "stg_plan_daily": f"""{with_(PLAN)} SELECT *, 'orders.parquet' AS source_file, 'plan' AS source_sheet,
      CAST(NULL AS TIMESTAMP) AS loaded_at FROM pl""",
    # versions and fact
    "positive_qty": f"""{ORDERS} SELECT {_KEY}, qty, CAST(amount AS DOUBLE) AS amount_discount_rub FROM ol
      WHERE COALESCE(qty, 0) > 0""",
    "check_final_close": f"""{EVENTS} SELECT check_id, MAX(close_ts) AS final_close_ts FROM ev
      WHERE COALESCE(qty, 0) > 0 GROUP BY check_id""",
    "final_versions": f"{EVENTS_FACT} SELECT source_row_id, {_LINE}, channel_group FROM ev_fact",
    "check_versions": f"""{EVENTS} SELECT check_id, COUNT(*) AS raw_rows_count,
      COUNT(*) FILTER (WHERE qty > 0) AS positive_qty_rows_count, MAX(close_ts) AS last_close_ts,
      MIN(accounting_date) AS first_accounting_date, MAX(accounting_date) AS last_accounting_date
      FROM ev GROUP BY check_id""",
    "cancelled_checks": f"""{EVENTS} SELECT check_id, COUNT(*) AS raw_rows_count, MAX(close_ts) AS last_close_ts,
      MIN(accounting_date) AS first_accounting_date, MAX(accounting_date) AS last_accounting_date,
      TRUE AS is_cancelled FROM ev GROUP BY check_id HAVING COUNT(*) FILTER (WHERE qty > 0) = 0""",
    "latest_line_per_check_day": f"""{EVENTS} SELECT source_row_id, {_LINE} FROM ev
      WHERE qty > 0 AND dish_category <> 'МОДИФИКАТОРЫ'
      QUALIFY ROW_NUMBER() OVER (PARTITION BY check_id, accounting_date ORDER BY close_ts DESC, source_row_id) = 1""",
    "superseded_versions": f"""{EVENTS} SELECT DISTINCT check_id, accounting_date, open_ts FROM ev
      WHERE close_ts < (SELECT MAX(close_ts) FROM ev o
        WHERE o.check_id = ev.check_id AND o.accounting_date = ev.accounting_date)""",
    "fact_check_items": _EVENTS_FACT_SELECT,
    "fact_check_items_orders": ORDERS_FACT
    + _fact_select("ol", _MIDNIGHT, "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"),
    # dimensions
    "dim_dish": f"""{EVENTS} SELECT MD5(dish_name || '|' || category_clean) AS dish_key, dish_name, category_clean,
      BOOL_OR(is_delivery_category) AS has_delivery_category, BOOL_OR(is_service_item) AS is_service_item
      FROM ev WHERE dish_name IS NOT NULL GROUP BY dish_name, category_clean""",
    "dim_order_type": f"""{EVENTS} SELECT DISTINCT MD5(order_type || '|' || channel_group) AS order_type_key,
      order_type, channel_group FROM ev WHERE order_type IS NOT NULL""",
    "date_bounds": f"""{with_(ORDER_LINES, PLAN)} SELECT MIN(d) AS min_date, MAX(d) AS max_date
      FROM (SELECT accounting_date AS d FROM ol UNION ALL SELECT plan_date FROM pl)""",
    "date_spine": f"""{with_(ORDER_LINES, PLAN)} SELECT CAST(UNNEST(generate_series(MIN(d), MAX(d), INTERVAL 1 DAY))
      AS DATE) AS date_key FROM (SELECT accounting_date AS d FROM ol UNION ALL SELECT plan_date FROM pl)""",
    "dim_date": f"""{with_(ORDER_LINES, PLAN)}, days AS (
        SELECT CAST(UNNEST(generate_series(MIN(d), MAX(d), INTERVAL 1 DAY)) AS DATE) AS date_key
        FROM (SELECT accounting_date AS d FROM ol UNION ALL SELECT plan_date FROM pl))
      SELECT date_key, EXTRACT(year FROM date_key) AS year, EXTRACT(month FROM date_key) AS month,
        EXTRACT(day FROM date_key) AS day, STRFTIME(date_key, '%Y-%m') AS year_month,
        STRFTIME(date_key, '%A') AS weekday_name, EXTRACT(isodow FROM date_key) AS iso_weekday,
        EXTRACT(isodow FROM date_key) IN (6, 7) AS is_weekend FROM days""",
    # daily aggregates and marts
    "check_level_daily": f"""{with_(EVENT_LINES, final_of("ev"), checks_of("ev_fact"))}
      SELECT revenue_date, check_id, guest_count, CAST(check_revenue AS DOUBLE) AS check_revenue,
        {", ".join(f"CAST({c}_revenue AS DOUBLE) AS {c}_revenue" for c in _CHANNELS)} FROM checks""",
    "channel_pivot_daily": f"""{EVENTS_FACT}, p AS (SELECT revenue_date, {_channel_sums("_revenue")}
        FROM ev_fact GROUP BY revenue_date)
      SELECT revenue_date, {", ".join(f"CAST({c}_revenue AS DOUBLE) AS {c}_revenue" for c in _CHANNELS)} FROM p""",
    "actual_daily": f"{with_(*ORDERS_ACTUAL)} SELECT * FROM actual",
    "mart_plan_fact_daily": f"{with_(*ORDERS_PLAN_FACT)} SELECT * FROM plan_fact",
    "mart_channel_daily": f"{with_(EVENT_LINES, final_of('ev'), CHANNEL_DAILY)} SELECT * FROM channel_daily",
    "mart_avg_check_by_order_type": f"""{with_(EVENT_LINES, final_of("ev"), ORDER_TYPE_DAILY)}
      SELECT * FROM order_type_daily""",
    "mart_dish_sales_daily": f"{with_(ORDER_LINES, final_of('ol'), DISH_DAILY)} SELECT * FROM dish_daily",
    "mart_dashboard_daily": f"{with_(*ORDERS_DASHBOARD)} SELECT * FROM dash",
    "yoy_shift_join": f"""{with_(*ORDERS_ACTUAL)}
      SELECT c.revenue_date, c.checks_count, c.fact_total_amount, y.checks_count AS prev_year_checks_count,
        y.fact_total_amount AS prev_year_fact_total_amount
      FROM actual c LEFT JOIN actual y ON c.revenue_date = CAST(y.revenue_date + INTERVAL 1 YEAR AS DATE)""",
    "avg_check_distinct": f"""{EVENTS_FACT} SELECT revenue_date, order_type, channel_group,
      COUNT(DISTINCT check_id) AS checks_count,
      ROUND(CAST(SUM(CASE WHEN is_turnover_item THEN amount ELSE 0 END) AS DOUBLE) / COUNT(DISTINCT check_id), 2)
        AS avg_check FROM ev_fact GROUP BY ALL""",
    # reports
    "default_period": f"""{with_(*ORDERS_PLAN_FACT)} SELECT MIN(revenue_date) AS min_date,
      MAX(revenue_date) AS max_date, CAST(date_trunc('month', MAX(revenue_date)) AS DATE) AS start_date,
      MAX(revenue_date) AS end_date FROM plan_fact""",
    "filter_by_date": with_(*ORDERS_PLAN_FACT)
    + " UNION ALL ".join(
        [
            _RANGE.format("all", "TRUE"),
            _RANGE.format("from", "revenue_date >= DATE '1996-02-10'"),
            _RANGE.format("up to", "revenue_date <= DATE '1998-03-05'"),
            _RANGE.format("between", "revenue_date BETWEEN DATE '1996-02-10' AND DATE '1998-03-05'"),
        ]
    ),
    "period_kpis": with_(*ORDERS_DASHBOARD)
    + " UNION ALL ".join(
        [_kpis("all", "TRUE"), _kpis("1997", "EXTRACT(year FROM revenue_date) = 1997"), _kpis("none", "FALSE")]
    ),
    "channel_totals": f"""{with_(EVENT_LINES, final_of("ev"), CHANNEL_DAILY)} SELECT channel_group,
      CAST(SUM(CAST(revenue_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue_amount,
      CAST(SUM(checks_count) AS BIGINT) AS checks_count FROM channel_daily GROUP BY channel_group""",
    "dish_totals": f"""{with_(ORDER_LINES, final_of("ol"), DISH_DAILY)} SELECT category_clean, dish_name,
      CAST(SUM(CAST(dish_revenue_amount AS DECIMAL(18,2))) AS DOUBLE) AS dish_revenue_amount, SUM(qty_sold) AS qty_sold
      FROM dish_daily WHERE category_clean IS NOT NULL AND dish_name IS NOT NULL GROUP BY ALL""",
    "top_dishes": f"""{with_(ORDER_LINES, final_of("ol"), DISH_DAILY)} SELECT category_clean, dish_name,
      CAST(SUM(CAST(dish_revenue_amount AS DECIMAL(18,2))) AS DOUBLE) AS dish_revenue_amount, SUM(qty_sold) AS qty_sold,
      dish_name || ' / ' || category_clean AS label
      FROM dish_daily WHERE category_clean IS NOT NULL AND dish_name IS NOT NULL GROUP BY ALL
      ORDER BY dish_revenue_amount DESC, dish_name, category_clean LIMIT 15""",
    "daily_detail_report": f"""{with_(*ORDERS_DASHBOARD)} SELECT CAST(revenue_date AS VARCHAR) AS "Дата",
      COALESCE({_thousands("fact_total_amount")} || ' ₽', '—') AS "Факт",
      COALESCE({_thousands("plan_total_amount")} || ' ₽', '—') AS "План",
      COALESCE(printf('%.1f', plan_completion_rate * 100) || '%', '—') AS "Выполнение",
      COALESCE(printf('%.1f', yoy_growth_rate * 100) || '%', '—') AS "YoY",
      COALESCE({_thousands("checks_count")}, '—') AS "Чеки",
      COALESCE({_thousands("avg_check_per_order")} || ' ₽', '—') AS "Средний чек" FROM dash""",
    "daily_detail_page": f"""{with_(*ORDERS_PLAN_FACT)}
      (SELECT 'first' AS label, revenue_date, checks_count, fact_total_amount FROM plan_fact
        ORDER BY revenue_date LIMIT 12)
      UNION ALL (SELECT 'next', revenue_date, checks_count, fact_total_amount FROM plan_fact
        WHERE revenue_date > DATE '1997-02-20' ORDER BY revenue_date LIMIT 12)""",
    "sample_marts": f"""{with_(*ORDERS_PLAN_FACT, EVENT_LINES, final_of("ev"), CHANNEL_DAILY, ORDER_TYPE_DAILY)}
      (SELECT 'plan_fact' AS label, revenue_date, CAST(NULL AS VARCHAR) AS group_name, checks_count,
        fact_total_amount AS revenue FROM plan_fact ORDER BY revenue_date LIMIT 10)
      UNION ALL (SELECT 'channel', revenue_date, channel_group, checks_count, revenue_amount FROM channel_daily
        ORDER BY revenue_date, channel_group LIMIT 10)
      UNION ALL (SELECT 'order_type', revenue_date, order_type, checks_count, revenue_amount FROM order_type_daily
        ORDER BY revenue_date, order_type LIMIT 10)""",
    "read_mart": f"""{with_(ORDER_LINES, final_of("ol"), DISH_DAILY)}
      SELECT revenue_date, category_clean, dish_name, dish_revenue_amount FROM dish_daily""",
    # extracts and incremental loading
    "scan_checks": EVENT_CELLS + _cell_lines(),
    "scan_plan": f"{with_(PLAN)} SELECT *, 'plan' AS source_sheet FROM pl",
    "rename_columns": f"{EVENT_CELLS} SELECT * EXCLUDE (source_row_number) FROM cells",
    "drop_unkeyed": f"""{EVENT_CELLS} SELECT source_row_number, {_TYPED_CELLS} FROM cells
      WHERE accounting_date <> 'no date' AND TRY_CAST(check_id AS BIGINT) IS NOT NULL""",
    "with_lineage": f"""{EVENTS} SELECT source_row_number, check_id, CAST(amount AS DOUBLE) AS amount_discount_rub,
      'events' AS source_system, 'events.parquet' AS source_file, 'january' AS source_sheet,
      '2024-01' AS source_period FROM ev""",
    "union_periods": f"{EVENTS} SELECT {_LINE}, {_LINEAGE} FROM ev",
    "assign_row_ids": f"""{EVENTS} SELECT
      ROW_NUMBER() OVER (ORDER BY source_period DESC, source_row_number) AS source_row_id,
      source_period, source_row_number, check_id FROM ev""",
    "period_stats": f"""{EVENTS} SELECT source_period, COUNT(*) AS rows_count,
      COUNT(DISTINCT check_id) AS checks_count FROM ev GROUP BY source_period""",
    "incremental_extract": f"""{EVENTS} SELECT
      CASE WHEN source_row_id <= (SELECT MAX(source_row_id) FROM ev WHERE source_period = '2024-01 first half')
        THEN 'first run' ELSE 'second run' END AS label, source_row_id, {_LINE}, {_LINEAGE} FROM ev""",
    "source_watermark": "SELECT COALESCE(MAX(event_id) + 1, 0) AS watermark FROM events",
    "read_watermark": f"""{EVENTS} SELECT 'click' AS label, MAX(source_row_id) AS watermark FROM ev
        WHERE order_type = 'click'
      UNION ALL SELECT 'unknown', 0""",
    "upsert_checkpoint": f"""{EVENTS}, marks AS (
        SELECT order_type, source_period = '2024-01 first half' AS is_first, MAX(source_row_id) AS watermark,
          MAX(open_ts) AS updated_at FROM ev WHERE order_type IS NOT NULL GROUP BY ALL),
      changes AS (
        SELECT CASE order_type WHEN 'error' THEN 'fault' ELSE order_type END AS source_name,
          CASE order_type WHEN 'view' THEN 1 ELSE watermark END AS watermark, updated_at FROM marks WHERE NOT is_first)
      SELECT source_name, MAX(watermark) AS watermark, MAX(updated_at) AS updated_at
      FROM (SELECT order_type AS source_name, watermark, updated_at FROM marks WHERE is_first
        UNION ALL SELECT * FROM changes) GROUP BY source_name""",
    "stream_incremental_load": f"{EVENTS} SELECT source_row_id, {_LINE}, {_LINEAGE} FROM ev",
    "incremental_fact_refresh": _EVENTS_FACT_SELECT,
    "refresh_job_fact": _EVENTS_FACT_SELECT,
    # quality
    "dq_not_null": with_(EVENT_LINES, _BROKEN)
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS failures FROM broken"
        for c in ("source_row_id", "accounting_date", "check_id", "dish_name", "channel_group")
    ),
    "dq_unique": f"""{with_(EVENT_LINES, _BROKEN)} SELECT source_row_id, COUNT(*) AS rows_count FROM broken
      WHERE source_row_id IS NOT NULL GROUP BY source_row_id HAVING COUNT(*) > 1""",
    "dq_accepted_values": f"""{with_(EVENT_LINES, _BROKEN)} SELECT channel_group, COUNT(*) AS rows_count FROM broken
      WHERE channel_group NOT IN ('delivery', 'pickup', 'restaurant', 'banquet', 'other') GROUP BY channel_group""",
    "dq_relationship": f"""{ORDERS_FACT} {_DISH_DIM.format("ol")} EXCEPT {_DISH_DIM.format("ol_fact")}""",
    "dq_report": with_(*ORDERS_DASHBOARD, DISH_DAILY, EVENT_LINES, _BROKEN, _DQ_TABLES)
    + " UNION ALL ".join(_DQ_CHECKS),
}
