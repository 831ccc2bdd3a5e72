import datetime as dt

from pyspark.sql import functions as F

from cargolens.functions import derive, numbers, text


def test_discount_tiers_are_right_closed(evaluate):
    rates = [-0.02, -0.01, -0.005, 0.0, 0.05, 0.1, 0.15, 0.2, 0.25, 1.0, 1.5, None]
    assert evaluate(derive.discount_tier, rates, "DOUBLE") == [
        None, None, "No Discount", "No Discount", "Low (1-10%)", "Low (1-10%)",
        "Medium (11-20%)", "Medium (11-20%)", "High (>20%)", "High (>20%)", None, None]
    assert evaluate(derive.discount_band, rates, "DOUBLE") == [
        None, None, None, None, "0-5%", "5-10%", "10-15%", "15-20%", "20-25%", "25%+", None, None]


def test_profit_tiers(evaluate):
    ratios = [-0.1, 0.0, 0.01, 0.1, 0.11, 0.2, 0.21, 0.3, 0.31, None]
    assert evaluate(derive.profit_tier, ratios, "DOUBLE") == [
        "Loss", "Loss", "Low", "Low", "Medium", "Medium", "Medium", "Medium", "High", "Loss"]
    assert evaluate(derive.profit_category, ratios, "DOUBLE") == [
        "Loss", "Loss", "Low Profit", "Low Profit", "Low Profit", "Low Profit", "High Profit",
        "High Profit", "High Profit", "Loss"]


def test_price_and_hour_groups(evaluate):
    assert evaluate(derive.price_range, [49.99, 50.0, 199.99, 200.0, 499.99, 500.0], "DOUBLE") == [
        "Budget (<$50)", "Mid ($50-$200)", "Mid ($50-$200)", "Premium ($200-$500)",
        "Premium ($200-$500)", "Luxury (>$500)"]
    groups = evaluate(derive.hour_group, [0, 5, 6, 11, 12, 17, 18, 23], "INT")
    assert [g.split()[0] for g in groups] == [
        "Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening"]


def test_status_labels(evaluate):
    status = ["COMPLETE", "CLOSED", "CANCELED", "SUSPECTED_FRAUD", "PENDING", "PENDING_PAYMENT",
              "complete", None]
    assert evaluate(derive.status_group, status, "STRING") == [
        "Completed", "Other", "Cancelled", "Fraud", "Pending", "Pending", "Completed", "Other"]
    assert evaluate(derive.fraud_label, ["suspected_fraud", "COMPLETE", None], "STRING") == [
        "Fraud", "Legitimate", "Legitimate"]
    assert evaluate(derive.fraud_flag, ["FRAUD", "fraud", "Legitimate", None], "STRING") == [
        1, 1, 0, 0]
    assert evaluate(derive.delivery_risk_flag, ["Late delivery", "late", None], "STRING") == [
        "At Risk", "Normal", "Normal"]
    assert evaluate(derive.stock_status, [0, 1, None], "INT") == [
        "In Stock", "Out of Stock", "Out of Stock"]
    assert evaluate(derive.shipping_performance, [-1, 0, 1], "INT") == [
        "Early", "On Time", "Late"]


def test_cart_flag(evaluate):
    assert evaluate(derive.add_to_cart_flag, ["/a/add_to_cart", "/a/ADD_TO_CART", None],
                    "STRING") == [1, 0, 0]


def test_location_is_null_if_either_part_is(spark):
    rows = spark.createDataFrame([("A", "B"), (None, "B"), ("A", None)], "c STRING, d STRING")
    out = rows.select(derive.full_location(F.col("c"), F.col("d")).alias("x")).collect()
    assert [r["x"] for r in out] == ["A, B", None, None]


def test_calendar_parts(evaluate):
    days = [dt.date(2016, 1, 1), dt.date(2016, 2, 29), dt.date(2017, 12, 31)]
    week = evaluate(lambda d: derive.order_date_parts(d)["order_week_number"], days, "DATE")
    assert week == [53, 9, 52]
    assert evaluate(derive.day_name, days, "DATE") == ["Friday", "Monday", "Sunday"]
    assert evaluate(derive.is_weekend, days, "DATE") == [False, False, True]
    assert evaluate(derive.fiscal_quarter, days, "DATE") == ["FY2016-Q1", "FY2016-Q1", "FY2017-Q4"]


def test_numbers_from_text(evaluate):
    values = ["3", "3.0", "3.9", "-2.5", "1d", "inf", "nan", "1,000", " 7 ", "1e3", "", None,
              "9007199254740993"]
    assert evaluate(text.to_int, values, "STRING") == [
        3, 3, 3, -2, 0, 0, 0, 0, 7, 1000, 0, 0, 9007199254740993]
    assert evaluate(text.to_float, values, "STRING") == [
        3.0, 3.0, 3.9, -2.5, 0.0, 0.0, 0.0, 0.0, 7.0, 1000.0, 0.0, 0.0, 9007199254740992.0]


def test_timestamps_from_text(evaluate):
    values = ["1/31/2018 22:56", "2018-01-31 22:56:00", "2018-01-31", "31/31/2018 1:00", "x", None]
    read = evaluate(lambda c: text.to_timestamp(
        c, ["M/d/yyyy H:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]), values, "STRING")
    assert read == [dt.datetime(2018, 1, 31, 22, 56), dt.datetime(2018, 1, 31, 22, 56),
                    dt.datetime(2018, 1, 31), None, None, None]


def test_a_format_is_tried_only_on_texts_with_its_separators(spark, evaluate):
    assert text.separators("M/d/yyyy H:mm") == [" ", "/", ":"] and text.separators("yyyyMMdd") == []
    assert text.separators("yyyy[-MM]") == text.separators("yyyy'-'MM") == []
    rows = spark.createDataFrame([("x",)], "x STRING").select(text.to_timestamp(F.col("x"), ["yyyy-MM-dd"]))
    assert "CASE WHEN Contains(x" in rows._jdf.queryExecution().optimizedPlan().toString()
    values = ["2018", "2018-01", "2018/01", "20180131"]
    read = evaluate(lambda c: text.to_timestamp(c, ["yyyy[-MM]", "yyyyMMdd"]), values, "STRING")
    assert read == [dt.datetime(2018, 1, 1), dt.datetime(2018, 1, 1), None, dt.datetime(2018, 1, 31)]


def test_long_and_padded_numbers_keep_one_spelling(evaluate):
    values = ["0.30000000000000004", "0.300000000000000040", "1.00000000000000000001", "1", "12345678.50", "12345678.5",
              "-0.00", "0\n", "5\n", "1.0\n", "1234567.000", "99999999999999999999.5", "0.00010"]
    got = evaluate(text.canonical_number, values, "STRING")
    assert got == ["0.30000000000000004", "0.30000000000000004", "1", "1", "1.23456785E7", "1.23456785E7", "0", "0\n",
                   "5\n", "1\n", "1234567", "1.0E20", "1.0E-4"]


def test_names(evaluate):
    names = [" Order  Id ", "order date (DateOrders)", "Días de envío"]
    want = ["order_id", "order_date_dateorders", "días_de_envío"]
    assert [text.standard_name(n) for n in names] == want
    assert evaluate(text.standardized, names, "STRING") == want
    assert evaluate(text.clean_description, ["  :: a: b ", None], "STRING") == ["a: b", None]


def test_zero_safe_ratio_and_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0),
                                (9.0, None, 5.0)], "a DOUBLE, b DOUBLE, c DOUBLE")
    row = df.agg(numbers.zero_safe_corr("a", "b").alias("ab"),
                 numbers.zero_safe_corr("a", "c").alias("ac")).first()
    import numpy as np
    assert abs(row["ab"] - np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1]) < 1e-12
    assert row["ac"] is None
    one = df.limit(1).agg(numbers.zero_safe_corr("a", "b").alias("r")).first()
    assert one["r"] is None
    zero = spark.range(1).select(numbers.ratio(F.lit(1), F.lit(0)).alias("r"),
                                 numbers.ratio(F.lit(1), F.lit(None)).alias("n")).first()
    assert zero["r"] is None and zero["n"] is None
