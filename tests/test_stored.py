"""Stored layouts: what they hold, what their plans avoid, and the queries over them."""

import datetime as dt
import importlib.util
import os
import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from cargolens import session
from cargolens.operators import bitmaps, star as model
from cargolens.operators.first_row import first_row_per_key
from cargolens.operators.pruning import on_days
from cargolens.operators.star import Star
from cargolens.plans import reach, spans
from cargolens.session import own_dir
from cargolens.sources import bucketed, readers, refresh, writers
from cargolens.workload import proxy, registry, stored, stored_oracle

ROOT = Path(__file__).resolve().parents[1]
DATA = Path("/root/testdata/sf0.001")
spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- the queries ------------------------------------------------------------------

@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(stored.QUERIES) == set(stored_oracle.SQL)
    assert not set(stored.QUERIES) & set(registry.QUERIES)
    assert set(stored.QUERIES) <= set(entry.queries())


@pytest.mark.skipif(not DATA.exists(), reason="benchmark tables not present")
@pytest.mark.parametrize("name", sorted(stored.QUERIES))
def test_query_matches_sql(spark, database, name):
    got = entry.queries()[name](spark, str(DATA))
    cursor = database.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    order = sorted(columns)
    assert order == sorted(got.columns)
    want = [dict(zip(columns, row)) for row in cursor.fetchall()]
    assert sorted((tuple(r[c] for c in order) for r in got.collect()), key=repr) == \
        sorted((tuple(r[c] for c in order) for r in want), key=repr)


# --- first rows -------------------------------------------------------------------

def test_first_row_by_number_has_no_sort_and_no_ties(spark):
    rng = random.Random(8)
    rows = [(None if i % 10 == 9 else 0 if i % 3 == 0 else i % 40, i, f"v{i}", None if i % 2 else i)
            for i in range(1200)]
    path = own_dir(spark, "numbered")
    spark.createDataFrame(rng.sample(rows, len(rows)), "k INT, seq BIGINT, v STRING, w INT").repartition(
        7).write.parquet(path)
    found = first_row_per_key(spark.read.parquet(path), "k", ["k", "v", "w"], "seq")
    assert found.columns == ["k", "v", "w"]
    want = {}
    for k, _, v, w in rows:
        want.setdefault(k, (v, w))
    got = found.collect()
    assert len(got) == len(want) and {r["k"]: (r["v"], r["w"]) for r in got} == want
    assert "SortAggregate" not in plan_of(found) and "HashAggregate" in plan_of(found)


@pytest.mark.skipif(not DATA.exists(), reason="benchmark tables not present")
@pytest.mark.parametrize("name", ["first_customer", "first_product", "first_order", "clean_star"])
def test_dimension_plans_have_no_sort_aggregate(spark, name):
    assert "SortAggregate" not in plan_of(entry.queries()[name](spark, str(DATA)))


# --- buckets ----------------------------------------------------------------------

def facts(spark, n=4000):
    rng = random.Random(2)
    rows = [(None if i % 97 == 0 else 1 if i % 3 == 0 else rng.randrange(500), i, float(i % 13)) for i in range(n)]
    orders = [(i, f"mode {i % 5}", "it's `odd`") for i in range(600)]
    return (spark.createDataFrame(rows, "order_id BIGINT, `item no` BIGINT, sales DOUBLE"),
            spark.createDataFrame(orders, "order_id BIGINT, shipping_mode STRING, order_city STRING"))


def test_join_and_grouping_by_the_bucket_key_move_nothing(spark):
    fact, orders = facts(spark)
    base = own_dir(spark, "buckets it's")
    layout = bucketed.Layout("order_id", 5)
    for name, df in (("fact", fact), ("order", orders)):
        bucketed.write_bucketed(df, f"{base}/{name}", layout)
    left, right = (bucketed.read_bucketed(spark, f"{base}/{n}", layout) for n in ("fact", "order"))
    joined = bucketed.join_in_place(left, right, "order_id")
    assert bucketed.exchanged(joined) == []
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(
        map(tuple, fact.join(orders, "order_id", "left").collect()), key=repr)
    grouped = joined.groupBy("order_id", "shipping_mode").agg(F.sum("sales").alias("s"))
    assert bucketed.exchanged(grouped) == []
    assert grouped.count() == fact.select("order_id").distinct().count()
    assert len(list(Path(f"{base}/fact").glob("*.parquet"))) == 5


@pytest.mark.skipif(not DATA.exists(), reason="benchmark tables not present")
def test_registered_bucket_queries_shuffle_no_lines(spark):
    assert bucketed.exchanged(stored.bucketed_order_join(spark, str(DATA))) == []
    star = stored.order_star(spark, str(DATA))
    report = star.aggregate(["shipping_mode"], means={"late": "late_delivery_risk"},
                            distinct={"orders": "order_id"})
    # What is exchanged is a row for each mode and task, above the join.
    plan = plan_of(report)
    assert "SortMergeJoin" in plan
    below = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in below


def test_a_bucketed_table_can_be_written_again(spark):
    fact, _ = facts(spark, 50)
    path, layout = own_dir(spark, "again"), bucketed.Layout("order_id", 3)
    bucketed.write_bucketed(fact, path, layout)
    bucketed.write_bucketed(fact.where("sales > 6"), path, layout)
    assert bucketed.read_bucketed(spark, path, layout).count() == fact.where("sales > 6").count()
    bucketed.write_bucketed(fact.limit(0), path, layout)
    assert bucketed.read_bucketed(spark, path, layout, fact.schema).count() == 0


# --- pruning ----------------------------------------------------------------------

def files_read(df):
    """Numbers of files that the scans of a collected frame have opened."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().executedPlan()

    def scans(node):
        if "QueryStage" in node.getClass().getSimpleName():
            return scans(node.plan())
        children = [node.children().apply(i) for i in range(node.children().size())]
        found = [f for child in children for f in scans(child)]
        metric = node.metrics().get("numFiles")
        return found + ([metric.get().value()] if metric.isDefined() else [])
    return scans(leaves)


def test_a_calendar_filter_opens_only_its_partitions(spark):
    rows = [(i, dt.datetime(2016 + i // 12 % 3, 1 + i % 12, 1 + i % 28, 5), 2016 + i // 12 % 3, 1 + i % 12, 1.0)
            for i in range(2000)]
    rows.append((9999, None, None, None, 1.0))
    fact = spark.createDataFrame(rows, "order_id BIGINT, order_date_dateorders TIMESTAMP_NTZ, order_year INT, "
                                       "order_month INT, sales DOUBLE")
    base = own_dir(spark, "pruned")
    stored = writers.publish_star({"fact_orders": fact}, base)["fact_orders"]
    partitions = len(list(Path(stored).glob("order_year=*/order_month=*")))
    days = model.calendar_between(spark, "2016-01-01", "2018-12-31")
    for condition, months in (("fiscal_quarter = 'FY2017-Q2'", 3), ("year_month = '2018-05'", 1),
                              ("date = DATE '2016-03-03'", 1), ("fiscal_quarter = 'none'", 0)):
        chosen = days.where(condition)
        got = on_days(spark.read.schema(fact.schema).parquet(stored), chosen)
        assert "dynamicpruning" in plan_of(got)
        read = sum(files_read(got))
        wanted = {r["date"] for r in chosen.collect()}
        assert sorted(r["order_id"] for r in got.collect()) == sorted(
            r[0] for r in rows if r[1] and r[1].date() in wanted)
        opened = sum(len(list(Path(stored).glob(f"order_year={y}/order_month={m}/*.parquet")))
                     for y, m in {(d.year, d.month) for d in wanted})
        assert read <= opened and months < partitions and (months == 0) == (opened == 0)


# --- bitmaps ----------------------------------------------------------------------

def test_bitmaps_count_and_unite_exactly(spark):
    rng = random.Random(4)
    rows = [(f"g{rng.randrange(3)}", dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(20)),
             None if i % 50 == 0 else f"k{rng.randrange(700) if i % 3 else 7}") for i in range(5000)]
    df = spark.createDataFrame(rows, "g STRING, day DATE, key STRING")
    ids = bitmaps.dense_ids(df, "key", "day")
    numbers = {r["key"]: r["id"] for r in ids.collect()}
    assert sorted(numbers.values()) == list(range(len(numbers))) and None not in numbers
    first = {}
    for _, day, key in rows:
        if key:
            first[key] = min(first.get(key, day), day)
    assert [k for k, _ in sorted(numbers.items(), key=lambda x: x[1])] == sorted(first, key=lambda k: (first[k], k))
    kept = bitmaps.bitmaps(df.join(ids, "key", "left"), ["g", "day"])
    got = {r["g"]: r["n"] for r in bitmaps.counted(kept, ["g"]).collect()}
    assert got == {g: len({k for h, _, k in rows if h == g and k}) for g in got} and len(got) == 3
    part = kept.where(F.col("day") < dt.date(2020, 1, 6))
    assert bitmaps.counted(part, []).first()["n"] == len({k for _, d, k in rows if k and d < dt.date(2020, 1, 6)})


def test_bitmaps_of_many_pieces(spark):
    rows = spark.range(200_000).select((F.col("id") % 2).alias("g"), "id").union(
        spark.range(100).select(F.lit(0).alias("g"), (F.col("id") * 65_537 + 10**12).alias("id")))
    kept = bitmaps.bitmaps(rows, ["g"])
    assert kept.count() > 8
    assert {r["g"]: r["n"] for r in bitmaps.counted(kept, ["g"]).collect()} == {0: 100_100, 1: 100_000}
    assert bitmaps.counted(bitmaps.bitmaps(rows.limit(0), ["g"]), ["g"]).count() == 0
    assert bitmaps.counted(bitmaps.bitmaps(rows.limit(0), []), []).first()["n"] == 0


def small_star(spark):
    rng = random.Random(9)
    fact = [(i // 3, None if i % 40 == 0 else rng.randrange(30), i % 5,
             None if i % 33 == 0 else dt.datetime(2019 + rng.randrange(3), 1 + rng.randrange(12), 5, 10),
             float(rng.randrange(100)), 1.0) for i in range(900)]
    fact = spark.createDataFrame(fact, "order_id BIGINT, customer_id BIGINT, product_card_id BIGINT, "
                                       "order_date_dateorders TIMESTAMP_NTZ, sales DOUBLE, order_profit_per_order DOUBLE")
    customers = spark.createDataFrame([(i, None if i == 3 else f"m{i % 4}") for i in range(25)],
                                      "customer_id BIGINT, market STRING")
    products = spark.createDataFrame([(i, f"d{i % 2}") for i in range(5)], "product_card_id BIGINT, department_name STRING")
    return Star.of_tables(fact, {"customer": customers, "product": products})


CHOICES = [{}, {"first": "2019-05-01", "last": "2020-08-31"}, {"grain": "quarter"}, {"last": "2000-01-01"}]


@pytest.mark.parametrize("by", [(), ("market",), ("market", "department_name"), ("product_card_id",)])
def test_spans_equal_one_pass_over_the_lines(spark, by):
    star = small_star(spark)
    summary = spans.daily_summary(star, by)
    lines = star.lines([*by, "order_id", "customer_id", "order_date", "sales", "order_profit_per_order"])
    lines = [r.asDict() for r in lines.na.drop(subset=[*by, "order_date"]).collect()]
    for choice in CHOICES:
        got = spans.over_days(summary, **choice)
        assert "Expand" not in plan_of(got)
        groups = {} if by or "grain" in choice else {(): []}
        for r in lines:
            day = r["order_date"]
            if choice.get("first", "1900") <= str(day) <= choice.get("last", "2100"):
                period = (dt.date(day.year, (day.month - 1) // 3 * 3 + 1, 1),) if "grain" in choice else ()
                groups.setdefault((*[r[c] for c in by], *period), []).append(r)
        want = {key: (sum(r["sales"] for r in rows) if rows else None, len({r["order_id"] for r in rows}),
                      len({r["customer_id"] for r in rows} - {None})) for key, rows in groups.items()}
        found = got.collect()
        keys = [*by, *(["period"] if "grain" in choice else [])]
        assert {tuple(r[c] for c in keys): (r["total_sales"], r["orders"], r["customers"])
                for r in found} == want
        for r in found:
            assert r["avg_order_value"] == (r["total_sales"] / r["orders"] if r["orders"] else None)


def test_groups_of_a_summary_can_be_merged(spark):
    star = small_star(spark)
    summary = spans.daily_summary(star, ["market", "department_name"])
    coarse = spans.over_days(summary, by=["department_name"]).orderBy("department_name").collect()
    for r in coarse:
        kept = [x for x in star.lines(["market", "department_name", "order_id", "order_date"]).collect()
                if x["department_name"] == r["department_name"] and x["market"] and x["order_date"]]
        assert r["orders"] == len({x["order_id"] for x in kept})


# --- sketches ---------------------------------------------------------------------

def test_stored_sketches_estimate_within_their_error_and_merge(spark):
    n = 60_000
    hits = spark.range(3 * n).select(
        F.timestamp_seconds(1_600_000_000 + F.col("id") % 200_000).cast("timestamp_ntz").alias("date"),
        F.concat(F.lit("p"), F.col("id") % n).alias("product"))
    kept = reach.hourly_reach(hits.union(hits.where("product = 'p5'").select(F.lit(None), "product")), "product")
    assert kept.count() == 51
    (whole,) = reach.reach(kept).collect()
    assert whole["hits"] == 3 * n
    assert abs(whole["distinct_estimate"] / n - 1) <= 3 * reach.standard_error()
    at_once = hits.agg(F.hll_sketch_estimate(F.hll_sketch_agg("product", reach.LG_K))).first()[0]
    assert abs(whole["distinct_estimate"] - at_once) <= 1 + 0.001 * n
    days = {r["day"]: r["distinct_estimate"] for r in
            reach.reach(kept, [F.to_date("hour_start").alias("day")]).collect()}
    exact = hits.groupBy(F.to_date("date").alias("day")).agg(F.countDistinct("product").alias("n")).collect()
    assert len(days) == len(exact)
    for r in exact:
        assert abs(days[r["day"]] / r["n"] - 1) <= 3 * reach.standard_error()
    assert reach.reach(reach.hourly_reach(hits.limit(0), "product"), ["hour_start"]).count() == 0


# --- refresh ----------------------------------------------------------------------

def warehouse(spark, n):
    def rows(k):
        return spark.createDataFrame([(i, f"t{k}", None if i % 2 else float("nan")) for i in range(n)],
                                     "id BIGINT, name STRING, x DOUBLE")
    tables = {name: rows(k) for k, name in enumerate(refresh.LOAD_ORDER)}
    tables["Fact_Orders"] = tables["Fact_Orders"].withColumns({
        "order_year": F.lit(2020), "order_month": (F.col("id") % 12 + 1).cast("int")})
    return tables


def counts(spark, base):
    return {name: df.count() for name, df in refresh.read_current(spark, base).items()}


def test_a_failed_run_leaves_the_old_warehouse_whole(spark):
    base = own_dir(spark, "wh")
    assert refresh.read_current(spark, base) == {}
    refresh.refresh(warehouse(spark, 20), base)
    assert counts(spark, base) == dict.fromkeys(refresh.LOAD_ORDER, 20)
    held = refresh.read_current(spark, base)["Dim_Order"]

    broken = warehouse(spark, 30)
    fourth = refresh.LOAD_ORDER[3]
    broken[fourth] = broken[fourth].withColumn("name", F.when(
        F.col("id") == 29, F.raise_error(F.lit("broken row"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="broken row"):
        refresh.refresh(broken, base)
    assert counts(spark, base) == dict.fromkeys(refresh.LOAD_ORDER, 20)

    def refuse(name, rows):
        if name == "Fact_Orders" and rows.count() == 30:
            raise ValueError("too many")
    with pytest.raises(ValueError):
        refresh.refresh(warehouse(spark, 30), base, refuse)
    assert counts(spark, base) == dict.fromkeys(refresh.LOAD_ORDER, 20)

    refresh.refresh(warehouse(spark, 30), base, lambda name, rows: None)
    assert counts(spark, base) == dict.fromkeys(refresh.LOAD_ORDER, 30)
    assert held.count() == 20                       # a reader of the old run is not disturbed
    entry = refresh.current_run(spark, base).collect()
    assert {r["version"] for r in entry} == {2} and len(entry) == 6
    assert len(refresh.drop_old_runs(spark, base, keep=1)) == 3
    assert counts(spark, base) == dict.fromkeys(refresh.LOAD_ORDER, 30)


def test_what_is_stored_is_compared_with_what_was_sent(spark, monkeypatch):
    base = own_dir(spark, "wh")
    refresh.refresh(warehouse(spark, 5), base)
    read = refresh._read
    monkeypatch.setattr(refresh, "_read", lambda s, path, like=None: read(s, path, like).withColumn(
        "name", F.lit("other")) if like is not None and path.endswith("Dim_Product") else read(s, path, like))
    with pytest.raises(refresh.RefreshError, match="Dim_Product"):
        refresh.refresh(warehouse(spark, 6), base)
    monkeypatch.undo()
    assert counts(spark, base) == dict.fromkeys(refresh.LOAD_ORDER, 5)


def test_checksum_sees_where_a_null_stands(spark):
    a = spark.createDataFrame([("x", None)], "a STRING, b STRING").agg(*refresh._measures(
        spark.createDataFrame([], "a STRING, b STRING"))).first()
    b = spark.createDataFrame([(None, "x")], "a STRING, b STRING").agg(*refresh._measures(
        spark.createDataFrame([], "a STRING, b STRING"))).first()
    assert a["row_count"] == b["row_count"] == 1 and a["checksum"] != b["checksum"]


def test_dealt_fact_derives_after_the_exchange(spark, tmp_path):
    """The rows that are brought together by month carry no derived column but the month."""
    rows = session.stage(proxy.joined(spark, DATA), "joined")
    fact = proxy.dealt_fact(rows)
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    assert "profit_tier" not in plan.split("RebalancePartitions", 1)[1]
    stored = writers.publish_star({"fact_orders": fact}, str(tmp_path), dealt=["fact_orders"])["fact_orders"]
    found = spark.read.schema(fact.schema).parquet(stored).select(*fact.columns)
    expected = model.fact_orders(proxy.unsplit(rows)).select(*fact.columns)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_extracts_are_compressed_and_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "EXTRACT_ROWS", 10)
    writers.write_extract(spark.range(25).coalesce(1).selectExpr("cast(id as string) as `Order Id`"), f"{tmp_path}/x")
    files = [f for f in os.listdir(f"{tmp_path}/x") if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    assert readers.read_orders(spark, f"{tmp_path}/x").distinct().count() == 25


def test_shuffles_of_table_queries_are_fine_and_taken_back(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    session.tune(spark, fine=True)
    assert spark.conf.get(key) == "1000"
    session.tune(spark)
    assert spark.conf.get(key, None) is None
