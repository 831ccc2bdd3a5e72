from pyspark.sql import functions as F

from cargolens.operators.row_numbers import number_rows


def test_numbers_are_gapless_over_all_rows_and_within_groups(spark):
    rows = spark.range(5000).select("id", (F.hash("id") % 700).alias("k"),
                                    F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("g"))
    got = number_rows(rows, ["k", "id"], "n").toPandas().sort_values(["k", "id"])
    assert got["n"].tolist() == list(range(5000))
    got = number_rows(rows, ["k", "id"], "n", by=["g"]).toPandas()
    for _, part in got.groupby("g", dropna=False):
        assert part.sort_values(["k", "id"])["n"].tolist() == list(range(len(part)))


def test_numbers_descending_with_ties_and_of_no_rows(spark):
    rows = spark.createDataFrame([(1.0,), (3.0,), (None,), (3.0,)], "x DOUBLE")
    got = number_rows(rows, ["x"], "n", descending=True).orderBy("n").collect()
    assert [r["x"] for r in got] == [3.0, 3.0, 1.0, None]
    assert number_rows(rows.limit(0), ["x"], "n").count() == 0
