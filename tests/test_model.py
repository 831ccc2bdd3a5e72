import datetime as dt
import random

from pyspark.sql import functions as F

from cargolens.operators import star as model
from cargolens.operators.first_row import first_row_per_key
from cargolens.operators.star import Star


def test_first_row_wins_whatever_the_partitioning(spark):
    """A third of the rows share one key."""
    random.seed(3)
    rows = [(0 if i % 3 == 0 else i % 50, i, f"v{i}", None if i % 2 else i) for i in range(900)]
    df = spark.createDataFrame(random.sample(rows, len(rows)),
                               "k INT, seq BIGINT, v STRING, w INT").repartition(11)
    got = {r["k"]: (r["v"], r["w"]) for r in first_row_per_key(
        df, "k", ["k", "v", "w"], ["seq"]).collect()}
    want = {}
    for k, _, v, w in sorted(rows, key=lambda r: r[1]):
        want.setdefault(k, (v, w))
    assert got == want


def test_calendar(spark):
    days = model.calendar_between(spark, "2015-01-01", "2018-12-31")
    assert days.count() == 1461
    leap = days.where("date = '2016-02-29'").first()
    assert (leap["year"], leap["month_name"], leap["quarter"], leap["day_of_week"]) == (
        2016, "February", "Q1", "Monday")
    assert days.where("date = '2016-01-01'").first()["week_number"] == 53


def small_star(spark):
    random.seed(5)
    # Order 0 holds a third of all lines; some keys have no dimension row or a null attribute.
    lines = [(0 if i % 3 == 0 else i % 40, i % 11, i % 7, float(i), i % 5,
              dt.datetime(2016, 1, 1) + dt.timedelta(days=i % 90), "Fraud" if i % 4 else "ok")
             for i in range(600)]
    fact = spark.createDataFrame(
        lines, "order_id BIGINT, customer_id BIGINT, product_card_id BIGINT, sales DOUBLE, "
               "late_delivery_risk INT, order_date_dateorders TIMESTAMP_NTZ, is_fraud STRING")
    dims = {
        "customer": spark.createDataFrame(
            [(i, None if i == 3 else f"m{i % 3}", f"s{i % 2}") for i in range(10)],
            "customer_id BIGINT, market STRING, customer_segment STRING"),
        "order": spark.createDataFrame([(i, f"mode{i % 4}") for i in range(40)],
                                       "order_id BIGINT, shipping_mode STRING"),
        "product": spark.createDataFrame([(i, f"p{i % 4}") for i in range(7)],
                                         "product_card_id BIGINT, product_name STRING"),
        "date": model.calendar_between(spark, "2016-01-01", "2016-12-31"),
    }
    return Star.of_tables(fact, dims)


def naive(star, by, column="sales"):
    columns = list(dict.fromkeys([*by, column, "order_id", "customer_id"]))
    rows = star.lines(columns)
    for c in by:
        rows = rows.where(F.col(c).isNotNull())
    return rows.groupBy(*by).agg(F.count("*").alias("lines"), F.sum(column).alias("total"),
                                 F.avg(column).alias("mean"),
                                 F.countDistinct("order_id").alias("orders"),
                                 F.countDistinct("customer_id").alias("customers"))


def test_aggregate_before_join_equals_join_before_aggregate(spark):
    star = small_star(spark)
    for by in (["market"], ["shipping_mode"], ["product_name"], ["market", "shipping_mode"],
               ["year_month"], ["order_date"], ["market", "is_fraud"], []):
        got = star.aggregate(by, {"total": "sales"}, {"mean": "sales"},
                             {"orders": "order_id", "customers": "customer_id"})
        want = naive(star, by)
        key = [*by, "lines", "total", "mean", "orders", "customers"]
        rows = lambda df: sorted(map(tuple, df.select(*key).collect()), key=repr)
        assert rows(got) == rows(want), by


def test_single_counted_key_needs_no_distinct(spark):
    star = small_star(spark)
    got = star.aggregate(["shipping_mode"], distinct={"orders": "order_id"})
    want = {r["shipping_mode"]: r["orders"] for r in naive(star, ["shipping_mode"]).collect()}
    assert {r["shipping_mode"]: r["orders"] for r in got.collect()} == want


def test_join_keeps_the_fact_rows(spark):
    star = small_star(spark)
    lines = star.lines(["order_id", "sales", "market", "product_name", "shipping_mode",
                        "year_month"])
    assert lines.count() == 600
    assert lines.where("market is null").count() > 0


def test_only_wanted_dimensions_are_planned(spark):
    plan = small_star(spark).lines(["sales", "product_name"])
    assert plan._jdf.queryExecution().analyzed().toString().count("Join") == 1
    fact_only = small_star(spark).aggregate(sums={"sales": "sales"})
    assert "Join" not in fact_only._jdf.queryExecution().analyzed().toString()


def test_hot_key_join_is_split(spark):
    """With a third of the rows on one key the join partition of that key is split."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        fact = spark.range(200_000).repartition(8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000).cast("bigint")
            .alias("product_card_id"), F.col("id").cast("double").alias("sales"))
        dim = spark.range(1000).select(F.col("id").alias("product_card_id"),
                                       F.concat(F.lit("p"), "id").alias("product_name"))
        star = Star.of_tables(fact, {"product": dim})
        lines = star.lines(["product_card_id", "sales", "product_name"]).groupBy(
            "product_card_id").agg(F.sum("sales"))
        assert len(lines.collect()) == 1000
        assert "skew=true" in lines._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
