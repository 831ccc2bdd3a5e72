"""Column lists of the raw extracts, the star schema and the warehouse."""

from __future__ import annotations

from cargolens.functions.text import standard_name

# ---------------------------------------------------------------------------
# Raw field names and the table each one belongs to.
FIELD_TABLES = [
    ("Type", "Dim_Order"),
    ("Days for shipping (real)", "Fact_Orders"),
    ("Days for shipment (scheduled)", "Fact_Orders"),
    ("Benefit per order", "Fact_Orders"),
    ("Sales per customer", "Fact_Orders"),
    ("Delivery Status", "Dim_Order"),
    ("Late_delivery_risk", "Fact_Orders"),
    ("Category Id", "Dim_Product"),
    ("Category Name", "Dim_Product"),
    ("Customer City", "Dim_Customer"),
    ("Customer Country", "Dim_Customer"),
    ("Customer Email", "Dropped"),
    ("Customer Fname", "Dim_Customer"),
    ("Customer Id", "Dim_Customer"),
    ("Customer Lname", "Dim_Customer"),
    ("Customer Password", "Dropped"),
    ("Customer Segment", "Dim_Customer"),
    ("Customer State", "Dim_Customer"),
    ("Customer Street", "Dropped"),
    ("Customer Zipcode", "Dropped"),
    ("Department Id", "Dim_Product"),
    ("Department Name", "Dim_Product"),
    ("Latitude", "Dim_Customer"),
    ("Longitude", "Dim_Customer"),
    ("Market", "Dim_Customer"),
    ("Order City", "Dim_Order"),
    ("Order Country", "Dim_Order"),
    ("Order Customer Id", "Dim_Order"),
    ("order date (DateOrders)", "Fact_Orders"),
    ("Order Id", "Fact_Orders"),
    ("Order Item Cardprod Id", "Dropped"),
    ("Order Item Discount", "Fact_Orders"),
    ("Order Item Discount Rate", "Fact_Orders"),
    ("Order Item Id", "Fact_Orders"),
    ("Order Item Product Price", "Fact_Orders"),
    ("Order Item Profit Ratio", "Fact_Orders"),
    ("Order Item Quantity", "Fact_Orders"),
    ("Sales", "Fact_Orders"),
    ("Order Item Total", "Fact_Orders"),
    ("Order Profit Per Order", "Fact_Orders"),
    ("Order Region", "Dim_Order"),
    ("Order State", "Dim_Order"),
    ("Order Status", "Dim_Order"),
    ("Product Card Id", "Dim_Product"),
    ("Product Category Id", "Dim_Product"),
    ("Product Description", "Dropped"),
    ("Product Image", "Dropped"),
    ("Product Name", "Dim_Product"),
    ("Product Price", "Dim_Product"),
    ("Product Status", "Dim_Product"),
    ("Shipping date (DateOrders)", "Fact_Orders"),
    ("Shipping Mode", "Dim_Order"),
]

# Derived fields as (field, description, table).
DERIVED_FIELDS = [
    ("order_year", "Year extracted from order date", "Fact_Orders"),
    ("order_month", "Month number extracted from order date", "Fact_Orders"),
    ("order_month_name", "Month name extracted from order date", "Fact_Orders"),
    ("order_quarter", "Quarter (Q1–Q4) from order date", "Fact_Orders"),
    ("order_day_of_week", "Day of week from order date", "Fact_Orders"),
    ("order_week_number", "ISO week number from order date", "Fact_Orders"),
    ("shipping_delay_days", "Actual shipping days minus scheduled days", "Fact_Orders"),
    ("shipping_performance", "Early / On Time / Late based on delay days", "Fact_Orders"),
    ("is_fraud", "Fraud / Legitimate based on order status", "Fact_Orders"),
    ("profit_category", "High Profit / Low Profit / Loss based on profit ratio", "Fact_Orders"),
    ("profit_tier", "High / Medium / Low / Loss (finer profit buckets)", "Fact_Orders"),
    ("discount_tier", "No Discount / Low / Medium / High discount bands", "Fact_Orders"),
    ("net_revenue", "Sales minus Order Item Discount", "Fact_Orders"),
    ("stock_status", "In Stock / Out of Stock from product_status flag", "Dim_Product"),
    ("price_range", "Budget / Mid / Premium / Luxury price bucket", "Dim_Product"),
    ("status_group", "Completed / Cancelled / Fraud / Pending / Other", "Dim_Order"),
    ("delivery_risk_flag", "At Risk / Normal based on delivery status", "Dim_Order"),
    ("customer_full_location", "Concatenation of customer city and country", "Dim_Customer"),
    ("is_add_to_cart", "1 if URL contains add_to_cart, 0 otherwise", "Web_Access_Logs"),
    ("action_type", "Add to Cart / Product View", "Web_Access_Logs"),
    ("hour_group", "Night / Morning / Afternoon / Evening time band", "Web_Access_Logs"),
]

# Column lists and rename maps of the cleaning and load steps.
DROPPED_COLUMNS = [
    "Customer Email", "Customer Password", "Product Description", "Product Image",
    "Customer Street", "Customer Zipcode", "Order Item Cardprod Id",
]
RAW_DATE_COLUMNS = ["order date (DateOrders)", "shipping date (DateOrders)"]
INT_COLUMNS = [
    "category_id", "customer_id", "department_id", "order_id", "order_item_id",
    "product_card_id", "order_item_quantity", "late_delivery_risk", "product_status",
]
FLOAT_COLUMNS = [
    "benefit_per_order", "sales_per_customer", "order_item_discount", "order_item_discount_rate",
    "order_item_product_price", "order_item_profit_ratio", "sales", "order_item_total",
    "order_profit_per_order", "product_price", "latitude", "longitude",
]
# Whole numbers that a type-inferring reader would recognise without being told.
INFERRED_INT_COLUMNS = [
    "days_for_shipping_real", "days_for_shipment_scheduled",
    "order_customer_id", "product_category_id",
]
FACT_COLUMNS = [
    "order_id", "order_item_id", "customer_id", "product_card_id",
    "order_date_dateorders", "shipping_date_dateorders",
    "sales", "net_revenue", "order_profit_per_order", "order_item_quantity",
    "order_item_discount", "order_item_discount_rate", "order_item_product_price",
    "order_item_profit_ratio", "order_item_total", "benefit_per_order", "sales_per_customer",
    "days_for_shipping_real", "days_for_shipment_scheduled",
    "shipping_delay_days", "shipping_performance", "late_delivery_risk", "is_fraud",
    "profit_category", "profit_tier", "discount_tier", "order_year", "order_month",
    "order_month_name", "order_quarter", "order_day_of_week", "order_week_number",
]
CUSTOMER_COLUMNS = [
    "customer_id", "customer_city", "customer_country",
    "customer_segment", "customer_state", "market",
]
PRODUCT_COLUMNS = [
    "product_card_id", "product_name", "product_price", "product_status", "category_id",
    "category_name", "department_id", "department_name", "product_category_id",
]
ORDER_COLUMNS = [
    "order_id", "order_status", "order_region", "order_country", "order_city",
    "order_state", "shipping_mode", "delivery_status", "type", "order_customer_id",
]
DATE_COLUMNS = [
    "date", "year", "month_num", "month_name", "quarter", "day_of_week",
    "week_number", "is_weekend", "year_month", "fiscal_quarter",
]
WEBLOG_REQUIRED = ["Product", "Category", "Date"]
WAREHOUSE_FACT_NAMES = {
    "order_date_dateorders": "Order_DateKey",
    "shipping_date_dateorders": "Shipping_DateKey",
    "order_profit_per_order": "Order_Profit",
    "order_item_quantity": "Item_Quantity",
    "order_item_discount": "Item_Discount",
    "order_item_discount_rate": "Item_Discount_Rate",
    "order_item_product_price": "Item_Product_Price",
    "order_item_profit_ratio": "Item_Profit_Ratio",
    "order_item_total": "Item_Total",
    "days_for_shipping_real": "Shipping_Days_Actual",
    "days_for_shipment_scheduled": "Shipping_Days_Scheduled",
}
WAREHOUSE_WEBLOG_NAMES = {
    "product": "Product_Name",
    "category": "Category_Name",
    "ip": "IP_Address",
    "month_num": "Log_Month_Num",
    "date": "Log_Date",
    "year": "Log_Year",
    "day": "Log_Day",
    "hour": "Log_Hour",
}
# Text a type-inferring CSV reader takes as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# ---------------------------------------------------------------------------

# The extract spells this one header in lower case, the dictionary does not.
RAW_ORDER_FIELDS = [
    name.replace("Shipping date", "shipping date") for name, _ in FIELD_TABLES
]
RAW_WEBLOG_FIELDS = ["Product", "Category", "Date", "Month", "Hour", "Department", "ip", "url"]

NUMERIC_COLUMNS = INT_COLUMNS + FLOAT_COLUMNS + INFERRED_INT_COLUMNS
RAW_NUMERIC_FIELDS = [f for f in RAW_ORDER_FIELDS if standard_name(f) in NUMERIC_COLUMNS]

DIMENSION_ATTRIBUTES = {
    "order": ORDER_COLUMNS[1:] + ["status_group", "delivery_risk_flag"],
    "customer": CUSTOMER_COLUMNS[1:] + ["customer_full_location"],
    "product": PRODUCT_COLUMNS[1:] + ["stock_status", "price_range"],
    "date": DATE_COLUMNS[1:],
}
DIMENSION_KEYS = {
    "order": "order_id",
    "customer": "customer_id",
    "product": "product_card_id",
    "date": "order_date",
}


def dimension_of(column: str) -> str | None:
    """Dimension that owns ``column``; None for a fact column."""
    for name, attributes in DIMENSION_ATTRIBUTES.items():
        if column in attributes:
            return name
    return None
