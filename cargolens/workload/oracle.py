"""The same queries in ANSI SQL over the benchmark tables, written independently.

Each statement starts from common table expressions that restate the mapping of
``proxy``; outputs carry the query's column names and its rounding.
"""

from __future__ import annotations

WIDE = """
w0 AS (
  SELECT l_orderkey AS order_id, l_suppkey * 10 + l_linenumber AS order_item_id,
    l_linenumber AS line_no, o_custkey AS customer_id, l_partkey AS product_card_id,
    o_orderdate AS order_date_dateorders, l_shipdate AS shipping_date_dateorders,
    l_extendedprice AS sales, l_discount AS order_item_discount_rate,
    l_extendedprice * l_discount AS order_item_discount,
    CAST(l_quantity AS INTEGER) AS order_item_quantity,
    floor(l_extendedprice / l_quantity) AS order_item_product_price,
    (floor(l_tax * CAST(100 AS DOUBLE) + CAST(0.5 AS DOUBLE)) - 3) / CAST(10 AS DOUBLE)
      AS order_item_profit_ratio,
    CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER)
      AS days_for_shipping_real,
    CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 4
      ELSE 7 END AS days_for_shipment_scheduled,
    o_orderpriority AS shipping_mode, o_orderstatus AS type,
    CASE WHEN o_orderstatus = 'F' THEN 'COMPLETE' WHEN o_orderstatus = 'O' THEN 'SUSPECTED_FRAUD'
      WHEN o_orderpriority = '5-LOW' THEN 'CANCELED'
      WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'PROCESSING'
      ELSE 'PENDING_PAYMENT' END AS order_status,
    c_mktsegment AS customer_segment, c_name AS customer_city, n_name AS customer_country,
    r_name AS customer_state, r_name AS market, r_name AS order_region, n_name AS order_country,
    c_name AS order_city, r_name AS order_state, o_custkey AS order_customer_id,
    p_name AS product_name, p_type AS category_name, p_brand AS department_name,
    p_size % 2 AS product_status, p_size * CAST(12.5 AS DOUBLE) AS product_price,
    CAST(length(p_type) AS BIGINT) AS category_id,
    CAST(length(p_type) AS BIGINT) AS product_category_id,
    CAST(substr(p_brand, 7) AS BIGINT) AS department_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey),
w AS (
  SELECT *, sales - order_item_discount AS net_revenue,
    sales * order_item_profit_ratio AS order_profit_per_order,
    days_for_shipping_real - days_for_shipment_scheduled AS shipping_delay_days,
    CASE WHEN days_for_shipping_real > days_for_shipment_scheduled THEN 1 ELSE 0 END
      AS late_delivery_risk,
    CASE WHEN order_status = 'SUSPECTED_FRAUD' THEN 'Fraud' ELSE 'Legitimate' END AS is_fraud,
    CASE WHEN days_for_shipping_real > 60 THEN 'Late delivery'
      WHEN days_for_shipping_real < 0 THEN 'Advance shipping' ELSE 'Shipping on time' END
      AS delivery_status,
    CAST(order_date_dateorders AS DATE) AS day,
    strftime(order_date_dateorders, '%Y-%m') AS year_month
  FROM w0)"""

WEB = """
h AS (
  SELECT event_id, p_name AS product, p_type AS category, p_brand AS department, ts,
    CAST(hour(ts) AS INTEGER) AS hour, CAST(user_id AS VARCHAR) AS ip,
    CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_add_to_cart,
    CASE WHEN event_type = 'purchase' THEN 'Add to Cart' ELSE 'Product View' END AS action_type,
    '/department/' || p_type || '/product/' || p_name ||
      CASE WHEN event_type = 'purchase' THEN '/add_to_cart' ELSE '' END AS url
  FROM events JOIN part ON p_partkey = user_id)"""

# Lifts a quotient that ends exactly in a half, so that both engines round it up.
NUDGE = "CAST(1e-9 AS DOUBLE)"

# Derived text of an order line.
PERFORMANCE = """CASE WHEN shipping_delay_days < 0 THEN 'Early' WHEN shipping_delay_days = 0
  THEN 'On Time' ELSE 'Late' END"""
CATEGORY = """CASE WHEN order_item_profit_ratio > CAST(0.2 AS DOUBLE) THEN 'High Profit'
  WHEN order_item_profit_ratio > 0 THEN 'Low Profit' ELSE 'Loss' END"""
TIER = """CASE WHEN order_item_profit_ratio > CAST(0.3 AS DOUBLE) THEN 'High'
  WHEN order_item_profit_ratio > CAST(0.1 AS DOUBLE) THEN 'Medium'
  WHEN order_item_profit_ratio > 0 THEN 'Low' ELSE 'Loss' END"""


def _between(c: str, edges: list[float], labels: list[str]) -> str:
    cases = " ".join(
        f"WHEN {c} > CAST({lo} AS DOUBLE) AND {c} <= CAST({hi} AS DOUBLE) THEN '{label}'"
        for lo, hi, label in zip(edges, edges[1:], labels))
    return f"CASE {cases} END"


DISCOUNT = _between("order_item_discount_rate", [-0.01, 0, 0.1, 0.2, 1],
                    ["No Discount", "Low (1-10%)", "Medium (11-20%)", "High (>20%)"])
BANDS = ["0-5%", "5-10%", "10-15%", "15-20%", "20-25%", "25%+"]
BAND = _between("order_item_discount_rate", [0, 0.05, 0.10, 0.15, 0.20, 0.25, 1], BANDS)
HOUR_GROUP = """CASE WHEN hour < 6 THEN 'Night (0-5)' WHEN hour < 12 THEN 'Morning (6-11)'
  WHEN hour < 18 THEN 'Afternoon (12-17)' ELSE 'Evening (18-23)' END"""
STATUS_GROUP = """CASE WHEN order_status LIKE '%COMPLETE%' THEN 'Completed'
  WHEN order_status LIKE '%CANCEL%' THEN 'Cancelled' WHEN order_status LIKE '%FRAUD%' THEN 'Fraud'
  WHEN order_status LIKE '%PENDING%' THEN 'Pending' ELSE 'Other' END"""
PRICE_RANGE = """CASE WHEN product_price < 50 THEN 'Budget (<$50)'
  WHEN product_price < 200 THEN 'Mid ($50-$200)'
  WHEN product_price < 500 THEN 'Premium ($200-$500)' ELSE 'Luxury (>$500)' END"""


def parts(d: str) -> str:
    return f"""CAST(year({d}) AS INTEGER) AS order_year, CAST(month({d}) AS INTEGER) AS order_month,
  monthname({d}) AS order_month_name, 'Q' || quarter({d}) AS order_quarter,
  dayname({d}) AS order_day_of_week, CAST(week({d}) AS INTEGER) AS order_week_number"""


FACT = f"""order_id, order_item_id, customer_id, product_card_id, order_date_dateorders,
  shipping_date_dateorders, round(sales, 2) AS sales, round(net_revenue, 6) AS net_revenue,
  round(order_profit_per_order, 6) AS order_profit_per_order, order_item_quantity,
  round(order_item_discount, 6) AS order_item_discount, order_item_discount_rate,
  order_item_product_price AS order_item_product_price, order_item_profit_ratio,
  round(net_revenue, 6) AS order_item_total,
  round(order_profit_per_order, 6) AS benefit_per_order,
  round(net_revenue, 6) AS sales_per_customer,
  days_for_shipping_real, days_for_shipment_scheduled, shipping_delay_days,
  {PERFORMANCE} AS shipping_performance, late_delivery_risk, is_fraud,
  {CATEGORY} AS profit_category, {TIER} AS profit_tier, {DISCOUNT} AS discount_tier,
  {parts('order_date_dateorders')}"""
LINE = "order_id, order_item_id, product_card_id"
FIRST = """order_date_dateorders, order_id, order_item_id, product_card_id,
  shipping_date_dateorders, sales"""


def wide(sql: str, *more: str) -> str:
    return "WITH " + ", ".join([WIDE.strip(), *more]) + " " + sql


def web(sql: str) -> str:
    return "WITH " + WEB.strip() + " " + sql


def first_row(key: str, columns: str) -> str:
    return f"""f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}
  ORDER BY {FIRST}) AS rn FROM w) WHERE rn = 1) SELECT {columns} FROM f"""


DIM_CUSTOMER = """customer_id, customer_city, customer_country, customer_segment, customer_state,
  market, customer_city || ', ' || customer_country AS customer_full_location"""
DIM_PRODUCT = f"""product_card_id, product_name, product_price, product_status, category_id,
  category_name, department_id, department_name,
  CASE WHEN product_status = 0 THEN 'In Stock' ELSE 'Out of Stock' END AS stock_status,
  {PRICE_RANGE} AS price_range"""
DIM_ORDER = f"""order_id, order_status, order_region, order_country, order_city, order_state,
  shipping_mode, delivery_status, type, order_customer_id, {STATUS_GROUP} AS status_group,
  CASE WHEN delivery_status LIKE '%Late%' THEN 'At Risk' ELSE 'Normal' END
  AS delivery_risk_flag"""
CALENDAR = """c AS (SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(
  (SELECT date_trunc('year', min(o_orderdate)) FROM orders),
  (SELECT date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM orders),
  INTERVAL 1 DAY)) AS d))"""

# --- dirty extract ------------------------------------------------------------------
# Text values as the extract has them; a line with number 7 appears twice.
RAW = """
r0 AS (SELECT *, CASE WHEN order_item_profit_ratio = CAST(0.5 AS DOUBLE) THEN NULL
    WHEN order_item_profit_ratio = CAST(0.4 AS DOUBLE) THEN '1d'
    ELSE CAST(sales AS VARCHAR) END AS sales_raw,
  CASE WHEN customer_segment <> 'BUILDING' THEN customer_segment END AS segment_raw,
  CASE WHEN shipping_mode = '3-MEDIUM' THEN NULL WHEN shipping_mode = '2-HIGH' THEN 'not a date'
    ELSE strftime(order_date_dateorders, '%-m/%-d/%Y %-H:%M') END AS date_raw FROM w),
r AS (SELECT * FROM r0 UNION ALL SELECT * FROM r0 WHERE line_no = 7)"""
# One date per order: the last readable one up to it in order of the id.
DIRTY_CLEAN = """
d AS (SELECT DISTINCT * EXCLUDE (sales), CASE WHEN sales_raw IS NULL OR sales_raw = '1d' THEN
    CAST(0 AS DOUBLE) ELSE sales END AS sales FROM r),
od AS (SELECT order_id, min(CASE WHEN date_raw <> 'not a date' THEN order_date_dateorders END)
  AS dt FROM d GROUP BY order_id),
of AS (SELECT order_id, last_value(dt IGNORE NULLS) OVER (ORDER BY order_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM od),
cl AS (SELECT d.* REPLACE (filled AS order_date_dateorders,
  sales - order_item_discount AS net_revenue), d.net_revenue AS raw_net
  FROM d JOIN of USING (order_id))"""
CLEAN_FACT = (FACT.replace("round(net_revenue, 6) AS order_item_total",
                           "round(raw_net, 6) AS order_item_total")
              .replace("round(net_revenue, 6) AS sales_per_customer",
                       "round(raw_net, 6) AS sales_per_customer"))

# --- grouped reports ------------------------------------------------------------------
SALES = "round(sum(sales), 2) AS sales"
PROFIT = "round(sum(order_profit_per_order), 3) AS profit"
MARGIN = ("round(sum(order_profit_per_order) / nullif(sum(sales), 0) * 100, 6) AS margin_pct")
MARGIN_RAW = "sum(order_profit_per_order) / nullif(sum(sales), 0) * 100"
ORDERS = "count(DISTINCT order_id) AS orders"
LATE = "avg(CAST(late_delivery_risk AS DOUBLE)) * 100"
DELAY = "round(avg(CAST(shipping_delay_days AS DOUBLE)), 6) AS avg_delay"
FIRST_STATUS = """fo AS (SELECT order_id, delivery_status FROM (SELECT *, row_number() OVER (
  PARTITION BY order_id ORDER BY """ + FIRST + """) AS rn FROM w) WHERE rn = 1)"""


def risk(rate: str, high: int, medium: int) -> str:
    return (f"CASE WHEN {rate} > {high} THEN 'high' WHEN {rate} > {medium} THEN 'medium' "
            "ELSE 'low' END AS status")


def above(value: str, threshold: str) -> str:
    return f"CASE WHEN {value} > {threshold} THEN 'above' ELSE 'below' END AS status"


RFM = """
b AS (SELECT customer_id, max(order_date_dateorders) AS last_order,
  count(DISTINCT order_id) AS frequency, sum(sales) AS monetary FROM w GROUP BY customer_id),
rb AS (SELECT customer_id, CAST(floor((epoch((SELECT max(last_order) FROM b))
  - epoch(last_order)) / 86400) AS BIGINT) AS recency, frequency, monetary FROM b),
e AS (SELECT list_distinct(quantile_cont(CAST(recency AS DOUBLE), [0, 0.25, 0.5, 0.75, 1])) AS er,
  list_distinct(quantile_cont(CAST(frequency AS DOUBLE), [0, 0.25, 0.5, 0.75, 1])) AS ef,
  list_distinct(quantile_cont(monetary, [0, 0.25, 0.5, 0.75, 1])) AS em FROM rb),
s0 AS (SELECT rb.*,
  greatest(len(er) - 1, 1) - len(list_filter(er, lambda x: x < recency AND x > list_min(er)
    AND x < list_max(er))) AS r,
  1 + len(list_filter(ef, lambda x: x < frequency AND x > list_min(ef) AND x < list_max(ef))) AS f,
  1 + len(list_filter(em, lambda x: x < monetary AND x > list_min(em) AND x < list_max(em))) AS m
  FROM rb, e),
s AS (SELECT *, r + f + m AS rfm_score, CASE WHEN r + f + m >= 10 THEN 'Champions'
  WHEN r + f + m >= 8 THEN 'Loyal' WHEN r + f + m >= 6 THEN 'Potential'
  WHEN r + f + m >= 4 THEN 'At Risk' ELSE 'Lost' END AS segment FROM s0)"""


def histogram(column: str, bins: int) -> str:
    n = f"CAST({bins} AS DOUBLE)"

    def edge(i: str) -> str:
        return f"(CASE WHEN {i} = {bins} THEN hi ELSE lo + {i} * ((hi - lo) / {n}) END)"

    return wide(f"""SELECT CAST(g.i + 1 AS INTEGER) AS bin, round({edge('g.i')}, 6) AS bin_lo,
  round({edge('(g.i + 1)')}, 6) AS bin_hi, coalesce(n, 0) AS n
FROM (SELECT unnest(range({bins})) AS i) g CROSS JOIN b LEFT JOIN (
  SELECT CASE WHEN v < {edge('i')} THEN i - 1
    WHEN v >= {edge('(i + 1)')} AND i < {bins - 1} THEN i + 1 ELSE i END AS i, count(*) AS n
  FROM (SELECT v, lo, hi, least(CAST(floor((v - lo) / (hi - lo) * {n}) AS BIGINT), {bins - 1}) AS i
    FROM v0, b) GROUP BY 1) k ON k.i = g.i""",
                f"v0 AS (SELECT CAST({column} AS DOUBLE) AS v FROM w)",
                "b AS (SELECT min(v) AS lo, max(v) AS hi FROM v0)")


CORRELATED = ["sales", "order_profit_per_order", "order_item_quantity",
              "order_item_discount_rate", "late_delivery_risk", "shipping_delay_days"]


def correlations() -> str:
    pairs = [(a, b) for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1:]]
    return wide(" UNION ALL ".join(
        f"SELECT '{b}' AS col_a, '{a}' AS col_b, round(corr({a}, {b}), 3) AS r FROM w"
        for a, b in pairs))


def profile() -> str:
    text = ["shipping_performance", "is_fraud", "profit_category", "profit_tier", "discount_tier",
            "order_month_name", "order_quarter", "order_day_of_week"]
    times = ["order_date_dateorders", "shipping_date_dateorders"]
    numbers = ["order_id", "order_item_id", "customer_id", "product_card_id", "sales",
               "net_revenue", "order_profit_per_order", "order_item_quantity",
               "order_item_discount", "order_item_discount_rate", "order_item_product_price",
               "order_item_profit_ratio", "days_for_shipping_real", "days_for_shipment_scheduled",
               "shipping_delay_days", "late_delivery_risk", "order_year", "order_month",
               "order_week_number", "order_item_total", "benefit_per_order", "sales_per_customer"]
    rows = []
    for c in text:
        rows.append(f"""SELECT '{c}' AS column_name, count({c}) AS count,
  count(DISTINCT {c}) AS unique, (SELECT {c} FROM f GROUP BY {c} ORDER BY count(*) DESC, {c}
  LIMIT 1) AS top, (SELECT max(n) FROM (SELECT count(*) AS n FROM f GROUP BY {c})) AS freq,
  NULL AS mean, NULL AS std, NULL AS min, NULL AS p25, NULL AS p50, NULL AS p75, NULL AS max
  FROM f""")
    for c in times + numbers:
        v = f"epoch({c})" if c in times else f"CAST({c} AS DOUBLE)"
        std = "NULL" if c in times else f"round(stddev_samp({v}), 6)"
        rows.append(f"""SELECT '{c}', count({c}), NULL, NULL, NULL, round(avg({v}) + {NUDGE}, 6), {std},
  round(min({v}), 6), round(quantile_cont({v}, 0.25), 6), round(quantile_cont({v}, 0.5), 6),
  round(quantile_cont({v}, 0.75), 6), round(max({v}), 6) FROM f""")
    base = f"""f AS (SELECT *, net_revenue AS order_item_total, net_revenue AS sales_per_customer,
  order_profit_per_order AS benefit_per_order, {PERFORMANCE} AS shipping_performance, {CATEGORY} AS profit_category,
  {TIER} AS profit_tier, {DISCOUNT} AS discount_tier, {parts('order_date_dateorders')} FROM w)"""
    return wide(" UNION ALL ".join(rows), base)


def finding(no: int, label: str, key: str, score: str, order: str) -> str:
    return (f"SELECT * FROM (SELECT {no} AS finding_no, '{label}' AS finding, {key} AS value "
            f"FROM w GROUP BY {key} ORDER BY {score} {order}, {key} LIMIT 1)")


FINDINGS = " UNION ALL ".join([
    finding(1, "Top Market by Sales", "market", "sum(sales)", "DESC"),
    finding(2, "Top Department by Profit", "department_name", "sum(order_profit_per_order)",
            "DESC"),
    finding(3, "Top Product by Sales", "product_name", "sum(sales)", "DESC"),
    finding(4, "Highest Order Segment", "customer_segment", "count(DISTINCT order_id)", "DESC"),
    finding(5, "Highest Late Delivery Region", "order_region", LATE, "DESC"),
    finding(6, "Best Shipping Mode (On-time)", "shipping_mode", LATE, "ASC"),
    finding(7, "Worst Shipping Mode (Late)", "shipping_mode", LATE, "DESC"),
    f"SELECT 8, 'Overall Profit Margin', CAST(round({MARGIN_RAW}, 1) AS VARCHAR) || '%' FROM w",
    f"SELECT 9, 'Overall Late Delivery Rate', CAST(round({LATE}, 1) AS VARCHAR) || '%' FROM w",
    "SELECT 10, 'Total Records Analyzed', format('{:,}', count(*)) FROM w"])

_FRAUD = "count(*) FILTER (is_fraud = 'Fraud')"
_LATE_LINES = "count(*) FILTER (late_delivery_risk = 1)"
_N_ORDERS = "count(DISTINCT order_id)"


def measures(by: str | None) -> str:
    group = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return wide(f"""SELECT {group}round(sum(sales), 2) AS total_sales,
  round(sum(net_revenue), 4) AS total_revenue,
  round(sum(order_profit_per_order), 3) AS total_profit, {_N_ORDERS} AS total_orders,
  CAST(sum(order_item_quantity) AS BIGINT) AS total_quantity,
  round(sum(sales) / {_N_ORDERS} + {NUDGE}, 6) AS avg_order_value,
  round(sum(order_profit_per_order) / nullif(sum(sales), 0), 6) AS profit_margin,
  round(sum(order_profit_per_order) / count(DISTINCT customer_id) + {NUDGE}, 6) AS profit_per_customer,
  round(CAST({_LATE_LINES} AS DOUBLE) / {_N_ORDERS}, 6) AS late_lines_per_order,
  round({LATE} / 100, 6) AS late_line_rate,
  round(avg(CAST(shipping_delay_days AS DOUBLE)), 6) AS avg_shipping_delay,
  {_FRAUD} AS fraud_orders, round(CAST({_FRAUD} AS DOUBLE) / {_N_ORDERS}, 6)
  AS fraud_lines_per_order, round(CAST({_FRAUD} AS DOUBLE) / count(*), 6) AS fraud_line_rate
FROM w{tail}""")


def calendar_days(by: str = "") -> str:
    """Daily totals on every day between the first and last order day, per group."""
    keys = f"{by}, " if by else ""
    groups = f"(SELECT DISTINCT {by} FROM w) g, " if by else ""
    on = f"d.{by} = g.{by} AND " if by else ""
    out = f"g.{by}, " if by else ""
    return f"""d AS (SELECT {keys}day, sum(sales) AS sales, sum(order_profit_per_order) AS profit
  FROM w GROUP BY {keys}day),
cal AS (SELECT CAST(x AS DATE) AS day FROM (SELECT unnest(generate_series(
  (SELECT CAST(min(day) AS TIMESTAMP) FROM d), (SELECT CAST(max(day) AS TIMESTAMP) FROM d),
  INTERVAL 1 DAY)) AS x)),
sp AS (SELECT {out}cal.day, d.sales FROM {groups}cal LEFT JOIN d ON {on}d.day = cal.day)"""


def to_date(period: str, by: str = "") -> str:
    name = {"month": "mtd_sales", "quarter": "qtd_sales", "year": "ytd_sales"}[period]
    keys = f"{by}, " if by else ""
    return wide(f"""SELECT {keys}day, round(sales, 2) AS sales, round(sum(sales) OVER (
  PARTITION BY {keys}date_trunc('{period}', day) ORDER BY day
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS {name} FROM sp""", calendar_days(by))


MONTHLY = """mo AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month, sum(sales) AS sales,
  sum(order_profit_per_order) AS profit FROM w GROUP BY 1)"""


def counts(*names: tuple[str, str]) -> str:
    return wide(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count({what}) AS row_count FROM {source}"
        for name, what, source in names), WEB.strip(), CALENDAR)


STAR_COUNTS = [
    ("fact_orders", "*", "w"), ("dim_customer", "DISTINCT customer_id", "w"),
    ("dim_product", "DISTINCT product_card_id", "w"), ("dim_order", "DISTINCT order_id", "w"),
    ("dim_date", "*", "c"), ("fact_weblogs", "*", "h")]
WAREHOUSE_NAMES = {"fact_orders": "Fact_Orders", "dim_customer": "Dim_Customer",
                   "dim_product": "Dim_Product", "dim_order": "Dim_Order",
                   "dim_date": "Dim_Date", "fact_weblogs": "Fact_WebLogs"}
GAP_COLUMNS = "CAST(order_id AS VARCHAR) AS order_id, CAST(order_item_id AS VARCHAR) AS order_item_id"


def dictionary() -> str:
    from cargolens.schemas import DERIVED_FIELDS, FIELD_TABLES
    names = ", ".join(f"('{name}', '{table}', {i})"
                      for i, (name, table) in enumerate(FIELD_TABLES, 1))
    derived = ", ".join(f"('{f}', '{f}', '{d}', 'Derived', '{t}')" for f, d, t in DERIVED_FIELDS)
    return f"""WITH k(field, tbl, i) AS (VALUES {names})
SELECT coalesce(field, p_name) AS "Field",
  lower(regexp_replace(regexp_replace(coalesce(field, p_name), '\\s+', '_', 'g'),
    '[^\\w]', '', 'g')) AS "Standardized_Column_Name",
  p_type || ' of ' || p_brand AS "Description", 'Original' AS "Source",
  coalesce(tbl, 'Unknown') AS "Table"
FROM part LEFT JOIN k ON k.i = length(p_name) + p_size
UNION ALL SELECT * FROM (VALUES {derived})"""


MISSING = """CAST(sum(CASE WHEN sales_raw IS NULL THEN 1 ELSE 0 END
  + CASE WHEN segment_raw IS NULL THEN 1 ELSE 0 END
  + CASE WHEN date_raw IS NULL OR date_raw = 'not a date' THEN 1 ELSE 0 END + 3) AS BIGINT)"""

SQL: dict[str, str] = {
    "scan_orders": wide("""SELECT CAST(order_id AS VARCHAR) AS "Order Id",
  CAST(order_item_id AS VARCHAR) AS "Order Item Id", segment_raw AS "Customer Segment",
  product_name AS "Product Name", sales_raw AS "Sales", date_raw AS "order date (DateOrders)"
  FROM r""", RAW.strip()),
    "scan_weblogs": web("""SELECT CAST(event_id AS VARCHAR) AS event_id, product AS "Product",
  category AS "Category", strftime(ts, '%Y-%m-%d %H:%M:%S') AS "Date",
  CAST(hour AS VARCHAR) AS "Hour", url FROM h"""),
    "publish_star": counts(*STAR_COUNTS),
    "publish_warehouse": wide(f"""SELECT CAST(year(day) AS INTEGER) AS order_year, category_name,
  {SALES}, CAST(sum(order_item_quantity) AS BIGINT) AS units FROM w GROUP BY 1, 2"""),
    "verify_counts": counts(*[(WAREHOUSE_NAMES[n], w, s) for n, w, s in STAR_COUNTS]),
    "weblog_head": web("""SELECT event_id, ts AS date, product, is_add_to_cart FROM h
  ORDER BY ts, event_id LIMIT 700"""),
    "nan_to_null": """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value
  FROM events""",
    "drop_columns": wide(f"SELECT {GAP_COLUMNS}, order_region FROM r", RAW.strip()),
    "parse_ts": """SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('minute', ts)
  END AS parsed FROM events""",
    "dedupe_rows": wide(f"""SELECT DISTINCT {GAP_COLUMNS},
  CAST(product_card_id AS VARCHAR) AS product_card_id, segment_raw AS segment FROM r""",
                        RAW.strip()),
    "fill_numeric": wide(f"""SELECT {GAP_COLUMNS}, CASE WHEN sales_raw IS NULL THEN '0'
  WHEN sales_raw = '1d' THEN '1d' ELSE 'number' END AS sales_text FROM r""", RAW.strip()),
    "fill_text": wide(f"""SELECT {GAP_COLUMNS}, coalesce(segment_raw, 'Unknown') AS segment
  FROM r""", RAW.strip()),
    "ffill_dates": """SELECT o_orderkey, last_value(CASE WHEN o_orderpriority NOT IN
  ('2-HIGH', '3-MEDIUM') THEN o_orderdate END IGNORE NULLS) OVER (ORDER BY o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS order_ts FROM orders""",
    "std_names": wide(f"""SELECT {GAP_COLUMNS}, CAST(days_for_shipping_real AS VARCHAR)
  AS days_for_shipping_real, CAST(late_delivery_risk AS VARCHAR) AS late_delivery_risk
  FROM r""", RAW.strip()),
    "coerce_int": wide(f"""SELECT {GAP_COLUMNS}, CAST(order_item_quantity AS BIGINT) AS quantity,
  CASE WHEN sales_raw IS NULL OR sales_raw = '1d' THEN 0 ELSE CAST(trunc(sales) AS BIGINT) END
  AS whole_sales FROM r""", RAW.strip()),
    "coerce_float": wide(f"""SELECT {GAP_COLUMNS}, CASE WHEN sales_raw IS NULL
  OR sales_raw = '1d' THEN 0 ELSE sales END AS sales, order_item_discount_rate AS rate FROM r""",
                         RAW.strip()),
    "drop_required_nulls": web("""SELECT event_id, category AS "Category" FROM h
  WHERE category <> 'PROMO'"""),
    "dq_report": wide(f"""SELECT 'rows_before' AS metric, (SELECT count(*) FROM r) AS value
  UNION ALL SELECT 'rows_after', (SELECT count(*) FROM q)
  UNION ALL SELECT 'duplicate_rows', (SELECT count(*) FROM r) - (SELECT count(*) FROM q)
  UNION ALL SELECT 'missing_before', (SELECT {MISSING} FROM q)
  UNION ALL SELECT 'missing_after', (SELECT count(*) FROM cl WHERE order_date_dateorders IS NULL)
  UNION ALL SELECT 'columns_before', 52 UNION ALL SELECT 'columns_dropped', 7
  UNION ALL SELECT 'columns_after', 45""", RAW.strip(), "q AS (SELECT DISTINCT * FROM r)",
                      DIRTY_CLEAN.strip()),
    "clean_orders": wide(f"SELECT {CLEAN_FACT} FROM cl", RAW.strip(), DIRTY_CLEAN.strip()),
    "clean_star": wide("""SELECT DISTINCT customer_id, coalesce(segment_raw, 'Unknown')
  AS customer_segment, market, customer_city || ', ' || customer_country AS customer_full_location
  FROM r""", RAW.strip()),
    "order_date_parts": wide(f"SELECT {LINE}, {parts('order_date_dateorders')} FROM w"),
    "shipping_performance": wide(f"""SELECT {LINE}, shipping_delay_days, {PERFORMANCE}
  AS shipping_performance FROM w"""),
    "fraud_flag": wide(f"SELECT {LINE}, is_fraud FROM w"),
    "profit_tiers": wide(f"SELECT {LINE}, {CATEGORY} AS profit_category, {TIER} AS profit_tier FROM w"),
    "discount_tier": wide(f"SELECT {LINE}, {DISCOUNT} AS discount_tier FROM w"),
    "discount_band": wide(f"SELECT {LINE}, {BAND} AS discount_band FROM w"),
    "net_revenue": wide(f"SELECT {LINE}, round(net_revenue, 6) AS net_revenue FROM w"),
    "weblog_enrich": web(f"""SELECT event_id, CAST(year(ts) AS INTEGER) AS year,
  CAST(month(ts) AS INTEGER) AS month_num, CAST(day(ts) AS INTEGER) AS day, hour,
  is_add_to_cart, action_type, {HOUR_GROUP} AS hour_group FROM h"""),
    "fact_orders": wide(f"SELECT {FACT} FROM w"),
    "dim_customer": wide("", first_row("customer_id", DIM_CUSTOMER)),
    "dim_product": wide("", first_row("product_card_id", DIM_PRODUCT + ", product_category_id")),
    "dim_order": wide("", first_row("order_id", DIM_ORDER)),
    "dim_date": "WITH " + CALENDAR + """ SELECT date, CAST(year(date) AS INTEGER) AS year,
  CAST(month(date) AS INTEGER) AS month_num, monthname(date) AS month_name,
  'Q' || quarter(date) AS quarter, dayname(date) AS day_of_week,
  CAST(week(date) AS INTEGER) AS week_number, isodow(date) > 5 AS is_weekend,
  strftime(date, '%Y-%m') AS year_month, 'FY' || year(date) || '-Q' || quarter(date)
  AS fiscal_quarter FROM c""",
    "conform_fact": wide(f"""SELECT {LINE}, day AS "Order_DateKey",
  CAST(shipping_date_dateorders AS DATE) AS "Shipping_DateKey",
  round(order_profit_per_order, 6) AS "Order_Profit", order_item_quantity AS "Item_Quantity",
  days_for_shipping_real AS "Shipping_Days_Actual",
  days_for_shipment_scheduled AS "Shipping_Days_Scheduled" FROM w"""),
    "conform_weblogs": web("""SELECT event_id, product AS "Product_Name",
  category AS "Category_Name", ip AS "IP_Address", ts AS "Log_Date",
  CAST(year(ts) AS INTEGER) AS "Log_Year", CAST(month(ts) AS INTEGER) AS "Log_Month_Num",
  CAST(day(ts) AS INTEGER) AS "Log_Day", hour AS "Log_Hour", action_type FROM h"""),
    "conform_order": wide("", first_row("order_id", f"""order_id, type AS "Transaction_Type",
  order_status, {STATUS_GROUP} AS status_group, shipping_mode""")),
    "conform_product": wide("", first_row("product_card_id", DIM_PRODUCT)),
    "conform_date": "WITH " + CALENDAR + """ SELECT date AS "DateKey",
  strftime(date, '%Y-%m') AS year_month FROM c""",
    "data_dictionary": dictionary(),
    "star_join": wide("""SELECT order_id, order_item_id, product_card_id, customer_id, sales,
  shipping_mode, order_country, customer_segment, market, product_name, year_month FROM w"""),
    "row_counts": counts(*STAR_COUNTS),
    "kpi_headline": wide(f"""SELECT round(sum(sales), 2) AS total_sales,
  round(sum(order_profit_per_order), 3) AS total_profit, {_N_ORDERS} AS total_orders,
  round(sum(sales) / {_N_ORDERS} + {NUDGE}, 6) AS avg_order_value, {MARGIN},
  round(sum(sales) / 1e6, 2) AS sales_m, round(sum(order_profit_per_order) / 1e6, 2) AS profit_m,
  round({_N_ORDERS} / 1e3, 1) AS orders_k,
  round(sum(sales) / {_N_ORDERS}, 2) AS avg_order_value_rounded,
  round({MARGIN_RAW}, 2) AS margin_pct_rounded FROM w"""),
    "monthly_trend": wide(f"SELECT year_month, {SALES}, {PROFIT} FROM w GROUP BY year_month"),
    "yearly_performance": wide(f"""SELECT CAST(year(day) AS INTEGER) AS year, {SALES}, {PROFIT},
  {MARGIN} FROM w GROUP BY 1"""),
    "market_performance": wide(f"""SELECT market, {SALES}, {PROFIT}, {ORDERS}, {MARGIN},
  {above(MARGIN_RAW, '10')} FROM w GROUP BY market"""),
    "segment_analysis": wide(f"""SELECT customer_segment, {SALES}, {ORDERS},
  count(DISTINCT customer_id) AS customers,
  round(sum(sales) / count(DISTINCT customer_id) + {NUDGE}, 6) AS sales_per_customer,
  round(sum(sales) / (SELECT sum(sales) FROM w) * 100, 6) AS share_pct
  FROM w GROUP BY customer_segment"""),
    "rfm_base": wide("""SELECT customer_id, recency, frequency, round(monetary, 2) AS monetary
  FROM rb""", RFM.strip()),
    "rfm_scores": wide("""SELECT customer_id, recency, frequency, round(monetary, 2) AS monetary,
  r, f, m, rfm_score, segment FROM s""", RFM.strip()),
    "rfm_segments": wide("""SELECT segment, count(*) AS customers,
  round(sum(monetary), 2) AS revenue FROM s GROUP BY segment""", RFM.strip()),
    "product_performance": wide(f"""SELECT product_name, {SALES}, {PROFIT},
  CAST(sum(order_item_quantity) AS BIGINT) AS units, {MARGIN} FROM w GROUP BY product_name"""),
    **{f"top_products_{what}": wide(f"""SELECT product_name, {SALES}, {PROFIT},
  CAST(sum(order_item_quantity) AS BIGINT) AS units, {MARGIN}, substr(product_name, 1, 35) AS label
  FROM w GROUP BY product_name ORDER BY sum({column}) DESC, product_name LIMIT 10""")
       for what, column in [("sales", "sales"), ("profit", "order_profit_per_order")]},
    "department_performance": wide(f"""SELECT department_name, {SALES}, {PROFIT},
  CAST(sum(order_item_quantity) AS BIGINT) AS units, {MARGIN}, {above(MARGIN_RAW, '0')}
  FROM w GROUP BY department_name"""),
    "discount_band_profit": wide(f"""SELECT band_no, bands.discount_band,
  coalesce(orders, 0) AS orders, avg_profit, {above('coalesce(avg_profit, 0)', '0')}
  FROM (VALUES {', '.join(f"({i}, '{b}')" for i, b in enumerate(BANDS, 1))})
    bands(band_no, discount_band)
  LEFT JOIN (SELECT {BAND} AS discount_band, {ORDERS},
    round(avg(order_profit_per_order) + {NUDGE}, 6) AS avg_profit FROM w GROUP BY 1) x
  ON x.discount_band = bands.discount_band"""),
    "late_overall": wide(f"SELECT round({LATE}, 6) AS late_rate_pct, {DELAY} FROM w"),
    "shipping_mode_performance": wide(f"""SELECT shipping_mode, {ORDERS},
  round({LATE}, 6) AS late_rate_pct, {DELAY}, {risk(LATE, 50, 30)} FROM w GROUP BY shipping_mode"""),
    "delivery_status_mix": wide("""SELECT fo.delivery_status, count(*) AS lines,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM w) * 100, 6) AS share_pct
  FROM w JOIN fo USING (order_id) GROUP BY fo.delivery_status""", FIRST_STATUS),
    "region_late_rate": wide(f"""SELECT order_region, round({LATE}, 6) AS late_rate_pct,
  {risk(LATE, 55, 45)} FROM w GROUP BY order_region"""),
    "fraud_summary": wide("""SELECT is_fraud, count(*) AS lines,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM w) * 100, 6) AS share_pct,
  round(sum(sales), 2) AS revenue, CASE WHEN is_fraud = 'Fraud' THEN 1 ELSE 0 END AS is_fraud_row
  FROM w GROUP BY is_fraud"""),
    "fraud_by_market": wide(f"""SELECT market,
  round(CAST({_FRAUD} AS DOUBLE) / count(*) * 100, 6) AS fraud_rate_pct,
  {above(f'CAST({_FRAUD} AS DOUBLE) / count(*) * 100', '10')} FROM w GROUP BY market"""),
    "fraud_by_mode": wide(f"""SELECT shipping_mode,
  round(CAST({_FRAUD} AS DOUBLE) / count(*) * 100, 6) AS fraud_rate_pct
  FROM w GROUP BY shipping_mode"""),
    "country_performance": wide(f"""SELECT market, order_country, {SALES}, {PROFIT}, {ORDERS},
  {MARGIN} FROM w GROUP BY market, order_country"""),
    "top_countries": wide(f"""SELECT market, order_country, round(s, 2) AS sales,
  round(p, 3) AS profit, orders, round(m, 6) AS margin_pct, round(mm, 6) AS mean_margin_pct,
  {above('m', 'mm')} FROM (SELECT *, avg(m) OVER () AS mm FROM (SELECT market, order_country,
    sum(sales) AS s, sum(order_profit_per_order) AS p, {ORDERS}, {MARGIN_RAW} AS m
    FROM w GROUP BY market, order_country)) ORDER BY s DESC, market, order_country LIMIT 15"""),
    "web_totals": web("SELECT count(*) AS hits, count(DISTINCT product) AS products FROM h"),
    "top_viewed_products": web("""SELECT product, count(*) AS views FROM h GROUP BY product
  ORDER BY views DESC, product LIMIT 10"""),
    "top_viewed_categories": web("""SELECT category, count(*) AS views FROM h GROUP BY category
  ORDER BY views DESC, category LIMIT 10"""),
    "web_hourly": web("SELECT hour, count(*) AS hits FROM h GROUP BY hour"),
    "cart_conversion": web("""SELECT is_add_to_cart, action_type, count(*) AS hits,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM h) * 100, 6) AS share_pct
  FROM h GROUP BY is_add_to_cart, action_type"""),
    "views_vs_sales": wide("""SELECT product AS product_name, views, round(sales, 2) AS sales FROM vs
  ORDER BY views DESC, product LIMIT 50""", WEB.strip(), """vs AS (SELECT product, views, sales
  FROM (SELECT product, count(*) AS views FROM h GROUP BY product) v JOIN (SELECT product_name,
  sum(sales) AS sales FROM w GROUP BY product_name) s ON v.product = s.product_name)"""),
    "views_sales_corr": wide("""SELECT count(*) AS products, round(corr(views, sales), 6)
  AS correlation FROM (SELECT * FROM vs ORDER BY views DESC, product LIMIT 50)""", WEB.strip(),
                             """vs AS (SELECT product, views, sales
  FROM (SELECT product, count(*) AS views FROM h GROUP BY product) v JOIN (SELECT product_name,
  sum(sales) AS sales FROM w GROUP BY product_name) s ON v.product = s.product_name)"""),
    "correlation_matrix": correlations(),
    "hist_sales": histogram("sales", 50),
    "hist_profit": histogram("order_profit_per_order", 50),
    "hist_delay": histogram("shipping_delay_days", 30),
    "describe_fact": profile(),
    "key_findings": wide(FINDINGS),
    "measures_total": measures(None),
    "measures_by_market": measures("market"),
    "measures_by_month": measures("year_month"),
    "ly_sales": wide("""SELECT n.day, round(n.sales, 2) AS sales, round(p.sales, 2) AS ly_sales
  FROM sp n LEFT JOIN sp p ON p.day = CAST(n.day - INTERVAL 12 MONTH AS DATE)""",
                     calendar_days()),
    "yoy_growth": wide("""SELECT n.month, round(n.sales, 2) AS sales,
  round(n.profit, 3) AS profit, round(p.sales, 2) AS ly_sales, round(p.profit, 3) AS ly_profit,
  round((n.sales - p.sales) / nullif(p.sales, 0), 6) AS yoy_sales_growth,
  round((n.profit - p.profit) / nullif(p.profit, 0), 6) AS yoy_profit_growth
  FROM mo n LEFT JOIN mo p ON p.month = CAST(n.month - INTERVAL 12 MONTH AS DATE)""", MONTHLY),
    "yoy_growth_by_year": wide("""SELECT n.year, round(n.sales, 2) AS sales,
  round(n.profit, 3) AS profit, round(p.sales, 2) AS ly_sales, round(p.profit, 3) AS ly_profit,
  round((n.sales - p.sales) / nullif(p.sales, 0), 6) AS yoy_sales_growth,
  round((n.profit - p.profit) / nullif(p.profit, 0), 6) AS yoy_profit_growth
  FROM ye n LEFT JOIN ye p ON p.year = CAST(n.year - INTERVAL 12 MONTH AS DATE)""", """ye AS (
  SELECT CAST(date_trunc('year', day) AS DATE) AS year, sum(sales) AS sales,
  sum(order_profit_per_order) AS profit FROM w GROUP BY 1)"""),
    "ytd_profit": wide("""SELECT day, round(profit, 3) AS profit, round(sum(profit) OVER (
  PARTITION BY date_trunc('year', day) ORDER BY day
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 3) AS ytd_profit
  FROM (SELECT cal.day, d.profit FROM cal LEFT JOIN d ON d.day = cal.day)""", calendar_days()),
    "mtd_sales": to_date("month"),
    "qtd_sales": to_date("quarter"),
    "ytd_sales": to_date("year"),
    "ytd_sales_by_market": to_date("year", "market"),
    "rolling_3m_sales": wide("""SELECT c.day, round(sum(d.sales), 2) AS rolling_sales
  FROM cal c JOIN d ON d.day > CAST(c.day - INTERVAL 3 MONTH AS DATE) AND d.day <= c.day
  GROUP BY c.day""", calendar_days()),
    "rolling_3m_by_month": wide("""SELECT c.month, round(c.sales, 2) AS sales,
  round(sum(p.sales), 2) AS rolling_sales FROM mo c JOIN mo p ON p.month <= c.month
  AND p.month > CAST(c.month - INTERVAL 3 MONTH AS DATE) GROUP BY c.month, c.sales""", MONTHLY),
}
