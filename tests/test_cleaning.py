import math
import random
import re
from decimal import Decimal

import pandas as pd
import pytest

from cargolens.functions import text
from cargolens.operators import cleaning
from cargolens.operators.forward_fill import forward_fill
from cargolens.plans import pipeline


def test_dedupe_treats_nulls_as_equal_and_keeps_the_first_number(spark):
    df = spark.createDataFrame([(1, None, 10), (1, None, 7), (1, "a", 8), (2, "a", 9)],
                               "x INT, y STRING, row_seq BIGINT")
    kept = {(r["x"], r["y"]): r["row_seq"] for r in cleaning.dedupe_rows(df, "row_seq").collect()}
    assert kept == {(1, None): 7, (1, "a"): 8, (2, "a"): 9}
    assert cleaning.dedupe_rows(df.drop("row_seq")).count() == 3


def test_fill_missing(spark):
    df = spark.createDataFrame([(None, None, None), ("1", "b", 2.0)],
                               "Sales STRING, Market STRING, rate DOUBLE")
    rows = cleaning.fill_missing(df, ["Sales", "rate"]).collect()
    assert [tuple(r) for r in rows] == [("0", "Unknown", 0.0), ("1", "b", 2.0)]


def test_name_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], ["Order Id", "order_id"])
    with pytest.raises(ValueError, match="order_id"):
        cleaning.standardize_names(df)


def test_drop_missing_columns_is_no_error(spark):
    df = spark.createDataFrame([(1, 2)], ["Order Id", "Customer Email"])
    assert cleaning.drop_columns(df).columns == ["Order Id"]


@pytest.mark.parametrize("step", [1, 3, 10_000_019])
def test_forward_fill_matches_a_global_fill(spark, step):
    """Gaps cross partition borders, the first rows stay empty, keys may be sparse."""
    random.seed(7)
    rows = []
    for i in range(300):
        gap = i < 3 or 40 <= i < 60 or random.random() < 0.4
        rows.append((i * step, None if gap else i, None if random.random() < 0.8 else i * 10, f"r{i}"))
    want = pd.DataFrame(rows, columns=["seq", "a", "b", "c"])
    want[["a", "b"]] = want[["a", "b"]].ffill()
    shuffled = random.sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "seq BIGINT, a BIGINT, b BIGINT, c STRING").repartition(7)
    got = forward_fill(df, ["a", "b"], "seq")
    assert got.columns == ["seq", "a", "b", "c"]
    got = got.orderBy("seq").toPandas()
    for c in ("a", "b"):
        assert got[c].fillna(-1).astype(int).tolist() == want[c].fillna(-1).astype(int).tolist()
    assert got["c"].tolist() == want["c"].tolist()


def test_weblog_keeps_unreadable_dates_and_drops_missing_ones(spark):
    hits = spark.createDataFrame([
        ("p", "c", "9/1/2017 6:00", "Sep", "6", "d", "ip", "/x/add_to_cart"),
        ("p", "c", "9/1/2017 6:00", "Sep", "6", "d", "ip", "/x/add_to_cart"),
        ("p", "c", "??", "Sep", "bad", "d", "ip", None),
        ("p", "c", None, "Sep", "1", "d", "ip", "/x"),
        (None, "c", "9/1/2017 6:00", "Sep", "1", "d", "ip", "/x")],
        "Product STRING, Category STRING, Date STRING, Month STRING, Hour STRING, "
        "Department STRING, ip STRING, url STRING")
    rows = pipeline.clean_weblogs(hits).orderBy("hour").collect()
    assert [(r["hour"], r["year"], r["is_add_to_cart"], r["action_type"]) for r in rows] == [
        (0, None, 0, "Product View"), (6, 2017, 1, "Add to Cart")]
    assert rows[0]["date"] is None and rows[1]["hour_group"] == "Morning (6-11)"


def test_equal_numbers_in_other_spellings_are_equal_rows(spark):
    df = spark.createDataFrame([("a", "7", "1.50", 2), ("a", "7.0", "1.5", 1), ("a", " +07 ", "15e-1", 3),
                                ("a", "7x", "1.5", 4), ("b", "0", None, 5), ("b", "-0.0", None, 6)],
                               "`Product Name` STRING, `Order Item Quantity` STRING, Sales STRING, row_seq BIGINT")
    rows = cleaning.dedupe_rows(cleaning.canonical_numbers(df), "row_seq").orderBy("row_seq").collect()
    assert [(r["Order Item Quantity"], r["Sales"], r["row_seq"]) for r in rows] == [
        ("7", "1.5", 1), ("7x", "1.5", 4), ("0", None, 5)]


SPELLINGS = ["7", "7.0", "+7", "007", "7.", "7.00", " 7 ", "7e0", "70e-1", "-7", "-7.0", "-07", "0", "-0", "0.0", "+0.",
             ".5", "0.5", "5e-1", "0.50", "1e400", "-1e400", "1e-3", "0.001", "0.0010", "1.0E-3", "1e7", "10000000",
             "1.0E7", "12345678.25", "1.234567825E7", "123.45", "123.450", "9007199254740993", "9007199254740992",
             "9007199254740993.0", "1d", "1f", "NaN", "nan", "Infinity", "inf", "", "x", "1,5", "1.2.3", "0x10",
             "99999999999999999999", "099999999999999999999", "1_0", "e5", "4.9E-324", "1.5", "15e-1"]


def test_equal_numbers_have_one_spelling_and_others_stay(spark, evaluate):
    number = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?")
    got = dict(zip(SPELLINGS, evaluate(text.canonical_number, SPELLINGS, "STRING")))
    for a in SPELLINGS:
        if not number.fullmatch(a.strip(" ")) or "400" in a:
            assert got[a] == a
            continue
        for b in SPELLINGS:
            if number.fullmatch(b.strip(" ")) and "400" not in b:
                assert (got[a] == got[b]) == (Decimal(a.strip()) == Decimal(b.strip())), (a, b)
    assert (got["7.0"], got["0.50"], got["-0"], got["1.0E7"]) == ("7", "0.5", "0", got["10000000"])


def test_number_beyond_double_stays_what_it_was(spark, evaluate):
    assert evaluate(lambda c: text.to_float(text.canonical_number(c)), ["1e400", "-1e400", "1e5"], "STRING") == \
        evaluate(text.to_float, ["1e400", "-1e400", "1e5"], "STRING") == [math.inf, -math.inf, 1e5]


def test_copies_are_counted(spark):
    df = spark.createDataFrame([(1, None, 10), (1, None, 7), (2, "a", 9)], "x INT, y STRING, row_seq BIGINT")
    kept = {r["x"]: (r["row_seq"], r["n"]) for r in cleaning.dedupe_rows(df, "row_seq", "n").collect()}
    assert kept == {1: (7, 2), 2: (9, 1)}
    assert sorted(r["n"] for r in cleaning.dedupe_rows(df.drop("row_seq"), copies="n").collect()) == [1, 2]
