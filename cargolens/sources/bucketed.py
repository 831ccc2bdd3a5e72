"""Tables dealt into buckets by a join key, so that joins and groupings on it move no rows.

A fact and a dimension written with the same key and number of buckets lie alike: bucket k of one
joins bucket k of the other, and a grouping that contains the key is complete in its bucket. Neither
is shuffled then, whatever its size. Each bucket is one file, sorted by the key.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cargolens.operators.star import Star
from cargolens.schemas import DIMENSION_KEYS


@dataclass(frozen=True)
class Layout:
    """Rows with equal ``key`` are in one of ``buckets`` files. A bucket is read by one task: take
    as many as keep the largest table's buckets within an executor's memory for sorting."""

    key: str
    buckets: int


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_bucketed(df: DataFrame, path: str, layout: Layout) -> None:
    """Write ``df`` as Parquet in the layout, replacing what is there. Rows with a null key share a
    bucket with others."""
    spark, name = df.sparkSession, f"writing_{uuid.uuid4().hex}"
    # The exchange uses the hash of the buckets, so a task writes one file.
    dealt = df.repartition(layout.buckets, layout.key).sortWithinPartitions(layout.key)
    (dealt.write.format("parquet").mode("overwrite").option("path", path)
     .bucketBy(layout.buckets, layout.key).sortBy(layout.key).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")      # an external table: its files stay


def read_bucketed(spark: SparkSession, path: str, layout: Layout,
                  schema: StructType | None = None) -> DataFrame:
    """The table as written by ``write_bucketed``; plans know how it is dealt. The catalog entry is of
    this session alone. A table without rows has no files to take the ``schema`` from."""
    schema = schema or spark.read.parquet(path).schema
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    name = f"bucketed_{uuid.uuid4().hex}"
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_quoted(layout.key)}) "
              f"SORTED BY ({_quoted(layout.key)}) INTO {layout.buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def join_in_place(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join two tables of one layout bucket by bucket. The hint keeps the planner from sending a
    small right side to every task, which would cost more than reading its buckets."""
    return left.join(right.hint("merge"), key, how)


def write_star(tables: Mapping[str, DataFrame], base: str, buckets: int,
               name: str = "order") -> dict[str, Layout]:
    """Write ``fact`` and the dimension ``name`` of ``tables`` by the key they share; returns the
    layout by table."""
    layout = Layout(DIMENSION_KEYS[name], buckets)
    for table in ("fact", name):
        write_bucketed(tables[table], f"{base.rstrip('/')}/{table}", layout)
    return {table: layout for table in ("fact", name)}


class BucketedStar(Star):
    """A star whose fact and one dimension lie in the same buckets. Reports by that dimension's
    attributes read both in place: the fact is reduced by the key and joined without a shuffle."""

    def __init__(self, fact: DataFrame, dimension: DataFrame, name: str = "order",
                 others: Mapping[str, DataFrame] | None = None) -> None:
        super().__init__(lambda columns: fact.select(*columns),
                         {d: (lambda columns, df=df: df.select(*columns)) for d, df in (others or {}).items()}
                         | {name: lambda columns: dimension.select(*columns).hint("merge")})

    @classmethod
    def read(cls, spark: SparkSession, base: str, layouts: Mapping[str, Layout],
             others: Mapping[str, DataFrame] | None = None) -> BucketedStar:
        (name,) = [t for t in layouts if t != "fact"]
        fact, dimension = (read_bucketed(spark, f"{base.rstrip('/')}/{t}", layouts[t]) for t in ("fact", name))
        return cls(fact, dimension, name, others)


def exchanged(df: DataFrame) -> Sequence[str]:
    """The exchanges in the plan of ``df``, for tests and for a look at a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" :+-") for line in plan.splitlines() if "Exchange" in line]
