import csv
import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cargolens.operators import conform
from cargolens.plans import pipeline
from cargolens.schemas import FACT_COLUMNS, RAW_ORDER_FIELDS, RAW_WEBLOG_FIELDS
from cargolens.session import shared_dir
from cargolens.sources import readers, writers

LINE = {f: "x" for f in RAW_ORDER_FIELDS} | {
    "Days for shipping (real)": "3", "Days for shipment (scheduled)": "4", "Sales": "100.5",
    "Order Item Discount": "10", "Order Item Discount Rate": "0.1",
    "Order Item Profit Ratio": "0.31", "Order Status": "SUSPECTED_FRAUD", "Late_delivery_risk": "0",
    "Order Id": "1", "Order Item Id": "1", "Customer Id": "7", "Product Card Id": "5",
    "Product Status": "0", "Product Price": "50", "order date (DateOrders)": "1/31/2018 22:56",
    "shipping date (DateOrders)": "2/3/2018 22:56", "Delivery Status": "Late delivery",
    "Market": "LATAM", "Order Item Quantity": "2.0"}


def write_csv(path, fields, rows, encoding):
    with open(path, "w", newline="", encoding=encoding) as out:
        writer = csv.DictWriter(out, fields)
        writer.writeheader()
        writer.writerows(rows)


@pytest.fixture
def extracts(tmp_path):
    lines = [
        LINE | {"Order City": "São Paulo, \"SP\""},
        LINE | {"Order City": "São Paulo, \"SP\"", "Customer Email": "differs but is dropped"},
        LINE | {"Order Item Id": "2", "Market": "Europe", "order date (DateOrders)": "bad",
                "Sales": "NA", "Customer Segment": ""},
        LINE | {"Order Id": "2", "Customer Id": "8", "Order Status": "CLOSED", "Product Price": "",
                "order date (DateOrders)": "2/1/2018 0:00", "Days for shipping (real)": "6"},
    ]
    write_csv(tmp_path / "orders.csv", RAW_ORDER_FIELDS, lines, "latin-1")
    hits = [{"Product": "p", "Category": "c", "Date": "9/1/2017 6:00", "Month": "Sep",
             "Hour": h, "Department": "d", "ip": "i", "url": "/add_to_cart"} for h in "566"]
    write_csv(tmp_path / "web.csv", RAW_WEBLOG_FIELDS, hits, "utf-8")
    write_csv(tmp_path / "dictionary.csv", ["A", "B"],
              [{"A": " Sales ", "B": " : Value in sales"}, {"A": "Mystery Field", "B": "?"}], "utf-8")
    return tmp_path


def test_pipeline_end_to_end(spark, extracts):
    paths = pipeline.run(spark, str(extracts / "orders.csv"), str(extracts / "web.csv"),
                         str(extracts / "dictionary.csv"), str(extracts / "out"))
    tables = readers.read_star(spark, str(extracts / "out"), list(paths))
    counts = {r["table_name"]: r["row_count"] for r in writers.table_counts(tables).collect()}
    assert counts == {"fact_orders": 3, "dim_customer": 2, "dim_product": 1, "dim_order": 2,
                      "dim_date": 1461, "fact_weblogs": 2, "data_dictionary": 23}
    fact = tables["fact_orders"].orderBy("order_id", "order_item_id").collect()
    assert set(tables["fact_orders"].columns) == set(FACT_COLUMNS)
    assert fact[0]["sales"] == 100.5 and fact[0]["net_revenue"] == 90.5
    assert fact[0]["order_item_quantity"] == 2 and fact[0]["shipping_performance"] == "Early"
    assert fact[0]["profit_tier"] == "High" and fact[0]["is_fraud"] == "Fraud"
    # The unreadable date takes the date of the row before it.
    assert fact[1]["order_date_dateorders"] == dt.datetime(2018, 1, 31, 22, 56)
    assert fact[1]["sales"] == 0.0 and fact[1]["discount_tier"] == "Low (1-10%)"
    assert fact[2]["shipping_performance"] == "Late" and fact[2]["order_month_name"] == "February"
    # The first row of the file decides the market of a customer.
    customer = {r["customer_id"]: r for r in tables["dim_customer"].collect()}
    assert customer[7]["market"] == "LATAM"
    order = {r["order_id"]: r for r in tables["dim_order"].collect()}
    assert order[1]["order_city"] == "São Paulo, \"SP\"" and order[1]["status_group"] == "Fraud"
    assert order[2]["status_group"] == "Other" and order[2]["delivery_risk_flag"] == "At Risk"
    product = tables["dim_product"].first()
    assert (product["stock_status"], product["price_range"]) == ("In Stock", "Mid ($50-$200)")
    words = {r["Field"]: r for r in tables["data_dictionary"].collect()}
    assert words["Sales"]["Description"] == "Value in sales"
    assert words["Sales"]["Table"] == "Fact_Orders"
    assert words["Mystery Field"]["Table"] == "Unknown"
    assert words["Mystery Field"]["Standardized_Column_Name"] == "mystery_field"


def test_decimal_money_and_web_limit(spark, extracts):
    paths = pipeline.run(spark, str(extracts / "orders.csv"), str(extracts / "web.csv"),
                         str(extracts / "dictionary.csv"), str(extracts / "dec"),
                         money_type="decimal(18,4)", web_limit=1)
    tables = readers.read_star(spark, str(extracts / "dec"), list(paths))
    assert dict(tables["fact_orders"].dtypes)["sales"] == "decimal(18,4)"
    assert tables["fact_weblogs"].count() == 1


def test_fact_is_partitioned_and_pruned(spark, extracts):
    paths = pipeline.run(spark, str(extracts / "orders.csv"), str(extracts / "web.csv"),
                         str(extracts / "dictionary.csv"), str(extracts / "out"))
    january = spark.read.parquet(paths["fact_orders"]).where("order_year = 2018 and order_month = 1")
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan and january.count() == 2


def test_quality_report(spark, extracts):
    raw = readers.with_row_seq(readers.read_orders(spark, str(extracts / "orders.csv")))
    report = {r["metric"]: r["value"] for r in pipeline.quality_report(raw).collect()}
    assert report["rows_before"] == 4 and report["duplicate_rows"] == 1
    # Segment, sales and date of one row, product price of another.
    assert report["missing_before"] == 4 and report["missing_after"] == 0
    assert (report["columns_before"], report["columns_after"]) == (52, 45)


def test_missing_orders_fail_and_missing_weblog_is_empty(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_orders(spark, str(tmp_path / "none.csv")).count()
    assert readers.read_weblogs(spark, str(tmp_path / "none.csv")).count() == 0


def test_warehouse_names(spark, extracts):
    raw = readers.with_row_seq(readers.read_orders(spark, str(extracts / "orders.csv")))
    star = pipeline.build_star(pipeline.clean_orders(raw))
    tables = conform.conform(star)
    fact = dict(tables["Fact_Orders"].dtypes)
    assert fact["Order_DateKey"] == "date" and "Item_Discount_Rate" in fact
    assert "order_date_dateorders" not in fact
    assert "product_category_id" not in tables["Dim_Product"].columns
    assert "Transaction_Type" in tables["Dim_Order"].columns
    assert "order_customer_id" not in tables["Dim_Order"].columns
    assert tables["Dim_Date"].columns[0] == "DateKey"
    writers.publish_warehouse(tables, str(extracts / "wh"))
    writers.publish_warehouse(tables, str(extracts / "wh"))      # a refresh replaces, not appends
    assert spark.read.parquet(str(extracts / "wh" / "Fact_Orders")).count() == 3


def test_nan_is_stored_as_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None)], "x DOUBLE, y STRING")
    assert [tuple(r) for r in writers.nulls_for_nan(df).collect()] == [(None, "a"), (1.0, None)]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("limit", [1, 37, 400, 4000])
def test_first_rows_of_a_long_table(spark, limit):
    """A third of the rows share one lead value, some have none."""
    rows = [(None if i % 50 == 0 else 5 if i % 3 == 0 else i * 7919 % 4001, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "t INT, id INT").repartition(6)
    got = [tuple(r) for r in writers.first_rows(df, ["t", "id"], limit).collect()]
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))[:limit]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    names = df.select(F.col("id").cast("string").alias("s"))
    assert writers.first_rows(names, ["s"], limit).count() == limit


def test_row_numbers_follow_the_requested_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(6)
    rows = readers.with_row_seq(df, ["k"]).collect()
    ordered = [r["k"] for r in sorted(rows, key=lambda r: r["row_seq"])]
    assert ordered == sorted(ordered) and len({r["row_seq"] for r in rows}) == 5000


def test_csv_is_read_by_its_header(spark, tmp_path):
    (tmp_path / "web.csv").write_text(
        'Product,Category,Date,Hour,url,ip,More\n"two\nlines",c,9/1/2017 6:00,6,/x,1,z\n')
    hits = readers.read_weblogs(spark, str(tmp_path / "web.csv"), multi_line=True)
    assert hits.columns[-1] == "More" and hits.first()["Product"] == "two\nlines"
    row = pipeline.clean_weblogs(hits).first()                 # neither Month nor Department is there
    assert row["product"] == "two\nlines" and row["hour"] == 6
    (tmp_path / "orders.csv").write_text("Order Id,Sales\n1,2.5\n2\n3,4,5\n")
    rows = readers.read_orders(spark, str(tmp_path / "orders.csv"), corrupt="broken").collect()
    assert [(r["Order Id"], r["broken"] is not None) for r in rows] == [("1", False), ("2", True), ("3", True)]


def test_dictionary_is_optional(spark, extracts):
    assert readers.read_dictionary(spark, str(extracts / "none.csv")) is None
    paths = pipeline.run(spark, str(extracts / "orders.csv"), str(extracts / "web.csv"),
                         str(extracts / "none.csv"), str(extracts / "plain"))
    assert "data_dictionary" not in paths and "fact_orders" in paths


def test_calls_have_folders_of_their_own(spark):
    from cargolens.workload import registry
    frames = [registry.scan_weblogs(spark, f"/root/testdata/{sf}") for sf in ("sf0.01", "sf0.001")]
    assert [f.count() for f in frames] == [10_000, 1_000]


def test_stages_can_be_cleared(spark, monkeypatch):
    from cargolens import session
    kept = session.stage(spark.range(3), "kept")
    base = session.shared_dir(spark)
    monkeypatch.setattr(session, "shared_dir", lambda spark: base + "-other")
    session.stage(spark.range(3), "gone")
    session.clear_stages(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(base + "-other")
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) and kept.count() == 3


def test_a_run_reports_what_it_has_done(spark, extracts):
    paths, metrics = pipeline.run_with_metrics(
        spark, str(extracts / "orders.csv"), str(extracts / "web.csv"), str(extracts / "dictionary.csv"),
        str(extracts / "measured"))
    raw = readers.with_row_seq(readers.read_orders(spark, str(extracts / "orders.csv")))
    assert metrics == {r["metric"]: r["value"] for r in pipeline.quality_report(raw).collect()}
    assert metrics["rows_after"] == spark.read.parquet(paths["fact_orders"]).count() == 3


def test_no_wide_row_moves_for_its_equals(spark, extracts, monkeypatch):
    """Equal rows are found by digests: no grouping carries the text of the extract."""
    raw = readers.with_row_seq(readers.read_orders(spark, str(extracts / "orders.csv")))
    plans, kept = [], pipeline.stage
    monkeypatch.setattr(pipeline, "stage", lambda df, *rest, **more: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), kept(df, *rest, **more))[1])
    assert pipeline.clean_orders(raw).select("order_id", "order_date_dateorders").count() == 3
    grouped = [line for plan in plans for line in plan.splitlines() if "Aggregate [" in line]
    assert grouped and not [line for line in grouped if "Customer City" in line]


def stored(monkeypatch):
    """Names and optimized plans of what the cleaning stores from now on."""
    plans, kept = {}, pipeline.stage
    monkeypatch.setattr(pipeline, "stage", lambda df, name, *rest, **more: (
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString()), kept(df, name, *rest, **more))[1])
    return plans


def test_text_of_the_extract_is_read_in_one_pass(spark, extracts, monkeypatch):
    """Rows are stored as numbers with their digests; equal ones are found without their columns."""
    raw = readers.with_row_seq(readers.read_orders(spark, str(extracts / "orders.csv")))
    plans = stored(monkeypatch)
    clean = pipeline.clean_orders(raw)
    assert clean.select("order_id", "sales").count() == 3 and dict(clean.dtypes)["order_item_quantity"] == "bigint"
    assert list(plans) == ["orders_typed", "orders_unique"]
    assert "_first" in plans["orders_unique"] and "xxhash64" not in plans["orders_unique"]
    assert not [line for line in plans["orders_unique"].splitlines() if "Aggregate [" in line and "city" in line]


def test_a_quality_report_stores_no_row(spark, extracts, monkeypatch):
    raw = readers.with_row_seq(readers.read_orders(spark, str(extracts / "orders.csv")))
    plans = stored(monkeypatch)
    report = {r["metric"]: r["value"] for r in pipeline.quality_report(raw).collect()}
    assert list(plans) == ["orders_unique"] and report["rows_before"] == 4 and report["rows_after"] == 3


def test_digest_tells_rows_apart_by_where_nulls_stand(spark):
    from cargolens.operators import cleaning
    df = spark.createDataFrame([(1, "a", None), (2, None, "a"), (3, "a", None), (4, "", "a"), (5, None, None)],
                               "row_seq BIGINT, x STRING, y STRING")
    first, second = cleaning.digest(df, ["row_seq"])
    by = {r["row_seq"]: (r["f"], r["s"]) for r in df.select("row_seq", first.alias("f"), second.alias("s")).collect()}
    assert by[1] == by[3] and len(set(by.values())) == 4 and len({f for f, _ in by.values()}) == 4


def test_numbers_follow_order_and_item(spark, tmp_path):
    from cargolens.workload import proxy
    spark.createDataFrame([(k,) for k in (9, -3, 5, 5)], "o_orderkey BIGINT").write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.createDataFrame([(5, 2, 1), (9, 1, 1), (5, 1, 7), (-3, 4, 1), (5, 1, 2), (5, 1, 2)],
                                  "order_id BIGINT, order_item_id BIGINT, product_card_id BIGINT")
    rows = proxy.numbered(spark, str(tmp_path), lines).orderBy("row_seq").collect()
    assert len({r["row_seq"] for r in rows}) == 6
    assert [(r[0], r[1], r[2]) for r in rows] == sorted((r[0], r[1], r[2]) for r in rows)
