"""SQL of the queries in ``stored``, over the same restatement of the tables as ``oracle``."""

from __future__ import annotations

from cargolens.workload.oracle import (CALENDAR, DELAY, DISCOUNT, LATE, NUDGE, ORDERS, RAW, STATUS_GROUP, TIER,
                                       WAREHOUSE_NAMES, dictionary, first_row, risk, web, wide)


def span(by: str = "", where: str = "TRUE", period: str = "") -> str:
    keys = ", ".join(x for x in (by, period) if x)
    return wide(f"""SELECT {keys + ', ' if keys else ''}round(sum(sales), 2) AS total_sales,
  round(sum(order_profit_per_order), 3) AS total_profit, count(DISTINCT order_id) AS orders,
  count(DISTINCT customer_id) AS customers,
  round(sum(sales) / count(DISTINCT order_id) + {NUDGE}, 6) AS avg_order_value,
  round(sum(order_profit_per_order) / count(DISTINCT customer_id) + {NUDGE}, 6) AS profit_per_customer
FROM w WHERE {where}{' GROUP BY ALL' if keys else ''}""")


TABLES = [("fact_orders", "SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey"),
          ("dim_customer", "SELECT count(*) FROM customer"), ("dim_product", "SELECT count(*) FROM part"),
          ("dim_order", "SELECT count(*) FROM orders"), ("dim_date", "SELECT count(*) FROM c")]

SQL: dict[str, str] = {
    "first_customer": wide("", first_row("customer_id", """customer_id,
  market || '/' || (order_item_id % 10) AS market,
  customer_city || '/' || order_item_quantity AS customer_city, customer_segment""")),
    "first_product": wide("", first_row("product_card_id", """product_card_id,
  product_price + order_item_quantity AS product_price, product_name""")),
    "first_order": wide("", first_row("order_id", """order_id,
  order_region || '/' || (order_item_id % 10) AS order_region,
  shipping_mode || '/' || order_item_quantity AS shipping_mode, delivery_status""")),
    "dedupe_by_value": wide("""SELECT CAST(order_id AS VARCHAR) AS order_id,
  CAST(order_item_id AS VARCHAR) AS order_item_id, CAST(product_card_id AS VARCHAR) AS product_card_id,
  CAST(order_item_quantity AS VARCHAR) AS order_item_quantity, count(*) AS copies
  FROM r GROUP BY ALL""", RAW.strip()),
    "dictionary_from_csv": dictionary(),
    "odd_headers": wide(f"""SELECT order_id, order_item_id, product_card_id,
  'he said: "' || customer_city || '",' || chr(10) || 'then' || chr(10) || order_id AS order_note,
  coalesce(segment_raw, 'Unknown') AS customer_segment, {TIER} AS profit_tier, {DISCOUNT} AS discount_tier,
  is_fraud FROM r""", RAW.strip()),
    "bucketed_order_join": wide(f"""SELECT order_id, order_item_id, product_card_id, sales, shipping_mode,
  order_country, {STATUS_GROUP} AS status_group FROM w"""),
    "bucketed_shipping_mode": wide(f"""SELECT shipping_mode, {ORDERS},
  round({LATE}, 6) AS late_rate_pct, {DELAY}, {risk(LATE, 50, 30)} FROM w GROUP BY shipping_mode"""),
    "quarter_of_partitions": wide("""SELECT CAST(year(day) AS INTEGER) AS order_year,
  CAST(month(day) AS INTEGER) AS order_month, count(*) AS lines, round(sum(sales), 2) AS sales
  FROM w WHERE year(day) = 1997 AND quarter(day) = 2 GROUP BY 1, 2"""),
    "span_total": span(),
    "span_by_market": span("market", "day BETWEEN DATE '1996-03-15' AND DATE '1998-10-02'"),
    "span_by_market_year": span("market", period="CAST(date_trunc('year', day) AS DATE) AS period"),
    "span_by_market_of_segments": span("market"),
    "web_reach": web("""SELECT hour, count(*) AS hits, count(DISTINCT product) AS products,
  TRUE AS within_error, TRUE AS merges FROM h GROUP BY hour"""),
    "refresh_warehouse": f"WITH {CALENDAR}, t AS (" + " UNION ALL ".join(
        f"SELECT '{WAREHOUSE_NAMES[name]}' AS table_name, ({sql}) AS n" for name, sql in TABLES) + """)
  SELECT table_name, n AS row_count, n AS manifest_rows, CAST(2 AS BIGINT) AS version FROM t""",
}
