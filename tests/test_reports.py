import datetime as dt

import pytest
from pyspark.sql import functions as F

from cargolens.operators import star as model
from cargolens.operators.star import Star
from cargolens.plans import findings, measures, operations, periods, pipeline, sales, web


@pytest.fixture(scope="module")
def star(spark):
    """Eight lines with ties, a zero-sales market, rates outside the first bands."""
    lines = [
        # order, customer, product, day, sales, profit, qty, rate, late, delay, fraud, net
        (1, 1, 1, dt.datetime(2016, 2, 29, 8), 100.0, 10.0, 1, 0.0, 1, 2, "Fraud", 100.0),
        (1, 1, 2, dt.datetime(2016, 2, 29, 8), 50.0, -5.0, 2, 0.05, 1, 2, "Fraud", 47.5),
        (2, 2, 1, dt.datetime(2016, 3, 31), 150.0, 30.0, 3, 0.06, 0, -1, "Legitimate", 141.0),
        (3, 3, 3, dt.datetime(2017, 2, 28), 0.0, 1.0, 1, 0.30, 0, 0, "Legitimate", 0.0),
        (4, 1, 4, dt.datetime(2017, 5, 31), 80.0, 8.0, 4, 0.25, 1, 1, "Legitimate", 60.0),
        (5, 2, 4, dt.datetime(2017, 6, 15), 20.0, 2.0, 1, 1.00, 0, 0, "fraud", 0.0),
    ]
    fact = spark.createDataFrame(
        lines, "order_id BIGINT, customer_id BIGINT, product_card_id BIGINT, "
               "order_date_dateorders TIMESTAMP_NTZ, sales DOUBLE, order_profit_per_order DOUBLE, "
               "order_item_quantity INT, order_item_discount_rate DOUBLE, late_delivery_risk INT, "
               "shipping_delay_days INT, is_fraud STRING, net_revenue DOUBLE")
    return Star.of_tables(fact, {
        "customer": spark.createDataFrame(
            [(1, "EU", "Consumer"), (2, "USCA", "Corporate"), (3, "Africa", "Consumer")],
            "customer_id BIGINT, market STRING, customer_segment STRING"),
        "order": spark.createDataFrame(
            [(i, "First" if i < 3 else "Second", f"R{i % 2}", "C", "Late delivery")
             for i in range(1, 6)],
            "order_id BIGINT, shipping_mode STRING, order_region STRING, order_country STRING, "
            "delivery_status STRING"),
        "product": spark.createDataFrame(
            [(1, "zeta", "D1"), (2, "alpha", "D1"), (3, "beta", "D2"), (4, "gamma" * 15, "D3")],
            "product_card_id BIGINT, product_name STRING, department_name STRING"),
        "date": model.calendar_between(spark, "2016-01-01", "2017-12-31"),
    })


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_kpi(star):
    row = sales.kpi_headline(star).first()
    assert (row["total_sales"], row["total_profit"], row["total_orders"]) == (400.0, 46.0, 5)
    assert row["avg_order_value"] == 80.0 and row["margin_pct_rounded"] == 11.5


def test_kpi_of_no_rows(spark, star):
    empty = Star.of_tables(star.fact(["order_id", "sales", "order_profit_per_order"])
                           .where("false"), {})
    row = sales.kpi_headline(empty).first()
    assert (row["total_sales"], row["total_orders"], row["margin_pct"]) == (0.0, 0, None)


def test_market_order_ties_and_zero_denominator(star):
    rows = sales.market_performance(star).collect()
    assert [r["market"] for r in rows] == ["Africa", "USCA", "EU"]
    assert rows[0]["margin_pct"] is None and rows[0]["status"] == "below"


def test_segments_share(star):
    rows = by_key(sales.segment_analysis(star), "customer_segment")
    assert rows["Consumer"]["customers"] == 2 and rows["Consumer"]["orders"] == 3
    assert sum(r["share_pct"] for r in rows.values()) == pytest.approx(100)


def test_all_bands_appear_and_rate_zero_has_none(star):
    rows = sales.discount_band_profit(star).collect()
    assert [(r["discount_band"], r["orders"], r["avg_profit"]) for r in rows] == [
        ("0-5%", 1, -5.0), ("5-10%", 1, 30.0), ("10-15%", 0, None), ("15-20%", 0, None),
        ("20-25%", 1, 8.0), ("25%+", 2, 1.5)]


def test_top_products_break_ties_by_name_and_cut_labels(star):
    rows = sales.top_products(star, n=2).collect()
    assert [r["product_name"][:5] for r in rows] == ["zeta", "gamma"]
    assert len(rows[1]["label"]) == 35


def test_fraud_label_case_does_not_matter(star):
    rows = by_key(operations.fraud_by_market(star), "market")
    assert rows["EU"]["fraud_rate_pct"] == pytest.approx(200 / 3)
    assert rows["USCA"]["fraud_rate_pct"] == 50 and rows["Africa"]["status"] == "below"


def test_findings(star):
    values = [r["value"] for r in findings.key_findings(star).collect()]
    # Segments tie 3:2; regions R0 and R1 differ; product name is cut to 50 characters.
    assert values[:4] == ["EU", "D1", "zeta", "Consumer"]
    assert values[5:7] == ["Second", "First"]
    assert values[7:] == ["11.5%", "50.0%", "6"]


def test_findings_tie_goes_to_the_first_key(spark, star):
    lines = star.fact(["order_id", "customer_id", "product_card_id", "sales",
                       "order_profit_per_order", "late_delivery_risk"]).where("order_id = 1")
    even = lines.withColumns({"sales": F.lit(1.0), "order_profit_per_order": F.lit(1.0)})
    tied = Star.of_tables(even, star._dimensions | {})
    tied._dimensions = star._dimensions
    values = [r["value"] for r in findings.key_findings(tied).collect()]
    assert values[2] == "alpha"


def test_measures_and_their_ratios(star):
    row = by_key(measures.measures(star, ["market"]), "market")["EU"]
    assert row["total_orders"] == 2 and row["total_revenue"] == 207.5
    assert row["late_lines_per_order"] == 1.5 and row["late_line_rate"] == 1.0
    assert row["fraud_orders"] == 2 and row["fraud_lines_per_order"] == 1.0
    assert row["profit_per_customer"] == 13.0
    africa = by_key(measures.measures(star, ["market"], ["profit_margin"]), "market")["Africa"]
    assert africa["profit_margin"] is None


def test_measure_may_not_filter_a_grouping_column(star):
    with pytest.raises(ValueError):
        measures.measures(star, ["is_fraud"], ["fraud_orders"])
    with pytest.raises(ValueError):
        measures.measures(star, [], ["nope"])
    assert measures.measures(star, ["is_fraud"], ["total_sales"]).count() == 3


def test_to_date_resets_and_covers_every_day(star):
    rows = by_key(periods.to_date(star, "month"), "day")
    assert len(rows) == (dt.date(2017, 6, 15) - dt.date(2016, 2, 29)).days + 1
    assert rows[dt.date(2016, 2, 29)]["mtd_sales"] == 150.0
    assert rows[dt.date(2016, 3, 1)]["mtd_sales"] is None
    assert rows[dt.date(2016, 3, 31)]["mtd_sales"] == 150.0
    year = by_key(periods.to_date(star, "year"), "day")
    assert year[dt.date(2016, 12, 31)]["ytd_sales"] == 300.0
    quarter = by_key(periods.to_date(star, "quarter"), "day")
    assert quarter[dt.date(2016, 3, 31)]["qtd_sales"] == 300.0
    assert quarter[dt.date(2017, 6, 15)]["qtd_sales"] == 100.0


def test_last_year_on_leap_days(star):
    rows = by_key(periods.last_year(star), "day")
    assert rows[dt.date(2017, 2, 28)]["ly_sales"] is None      # reads 2016-02-28
    assert rows[dt.date(2017, 3, 31)]["ly_sales"] == 150.0
    months = by_key(periods.growth(star), "month")
    february = months[dt.date(2017, 2, 1)]
    assert (february["ly_sales"], february["yoy_sales_growth"]) == (150.0, -1.0)
    assert months[dt.date(2016, 2, 1)]["ly_sales"] is None


def test_rolling_window_is_open_at_its_start(star):
    rows = by_key(periods.rolling_days(star), "day")
    # 2016-05-31 - 3 months is 2016-02-29, which is outside the window.
    assert rows[dt.date(2016, 5, 30)]["rolling_sales"] == 150.0 + 0
    assert rows[dt.date(2016, 5, 28)]["rolling_sales"] == 300.0
    assert rows[dt.date(2016, 5, 31)]["rolling_sales"] == 150.0
    months = by_key(periods.rolling_months(star), "month")
    assert months[dt.date(2016, 3, 1)]["rolling_sales"] == 300.0
    assert months[dt.date(2017, 6, 1)]["rolling_sales"] == 100.0


def test_gap_periods_are_kept_at_every_grain(spark):
    rows = [(i, i, dt.datetime(*day), sales, 1.0) for i, (day, sales) in enumerate([
        ((2017, 1, 5), 10.0), ((2017, 2, 5), 20.0), ((2018, 1, 5), 30.0), ((2018, 3, 5), 40.0)])]
    gaps = Star.of_tables(spark.createDataFrame(
        rows, "order_id BIGINT, customer_id BIGINT, order_date_dateorders TIMESTAMP_NTZ, sales DOUBLE, "
              "order_profit_per_order DOUBLE"), {})
    months = by_key(periods.growth(gaps), "month")
    assert len(months) == 15
    february = months[dt.date(2018, 2, 1)]
    assert (february["sales"], february["ly_sales"], february["yoy_sales_growth"]) == (None, 20.0, -1.0)
    rolling = by_key(periods.rolling_months(gaps), "month")
    assert rolling[dt.date(2017, 4, 1)]["rolling_sales"] == 20.0
    assert rolling[dt.date(2017, 6, 1)]["rolling_sales"] is None
    days = by_key(periods.rolling_days(gaps), "day")
    assert len(days) == 425 and days[dt.date(2017, 9, 1)]["rolling_sales"] is None
    years = by_key(periods.growth(gaps, grain="year"), "year")
    assert years[dt.date(2018, 1, 1)]["yoy_sales_growth"] == (70 - 30) / 30
    quarters = by_key(periods.last_year(gaps, grain="quarter", measure="profit"), "quarter")
    assert quarters[dt.date(2018, 1, 1)]["ly_profit"] == 2.0


def test_periods_by_group(star):
    rows = periods.to_date(star, "year", ["market"]).where("day = '2017-06-15'").collect()
    assert {r["market"]: r["ytd_sales"] for r in rows} == {
        "EU": 80.0, "USCA": 20.0, "Africa": 0.0}


def test_web_reports(spark, star):
    hits = spark.createDataFrame(
        [("zeta", "c1", 1, 1), ("zeta", "c1", 1, 0), ("alpha", "c2", 2, 0), ("ghost", "c2", 2, 0)],
        "product STRING, category STRING, hour INT, is_add_to_cart INT")
    assert web.web_totals(hits).first()["products"] == 3
    assert [r["product"] for r in web.top_viewed(hits, n=2).collect()] == ["zeta", "alpha"]
    cart = by_key(web.cart_conversion(hits), "action_type")
    assert cart["Add to Cart"]["share_pct"] == 25.0
    rows = web.views_vs_sales(hits, star).collect()
    assert [(r["product_name"], r["views"], r["sales"]) for r in rows] == [
        ("zeta", 2, 250.0), ("alpha", 1, 50.0)]
    renamed = hits.withColumnRenamed("product", "product_name")
    assert web.web_totals(renamed).first()["hits"] == 4


def test_empty_weblog_gives_empty_reports(spark):
    from cargolens.schemas import RAW_WEBLOG_FIELDS
    from cargolens.sources.readers import text_schema
    hits = pipeline.clean_weblogs(spark.createDataFrame([], text_schema(RAW_WEBLOG_FIELDS)))
    assert web.web_totals(hits).first()["hits"] == 0 and web.web_hourly(hits).count() == 0
