"""Full refresh of the warehouse as one step: all tables or none.

Every table is written to a folder of its own run, read back, and compared with what went in by
count and checksum. Only then one small file, appended to the manifest, names the run. Readers follow
the last entry of the manifest, so they see the old warehouse whole until then and the new one
whole after. A run that fails changes nothing and can simply be started again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cargolens.sources.writers import LOAD_ORDER, PARTITIONS, nulls_for_nan

MANIFEST = "version BIGINT, run STRING, table_name STRING, path STRING, row_count BIGINT, checksum STRING"
WAREHOUSE_PARTITIONS = {"Fact_Orders": PARTITIONS["fact_orders"]}


class RefreshError(RuntimeError):
    """What was stored isn't what went in."""


def _measures(df: DataFrame) -> list[Column]:
    """Count and order-free checksum of all columns; where a null stands counts as well."""
    cells = [F.col(f"`{c}`") for c in df.columns]
    row = F.xxhash64(*cells, *[c.isNull() for c in cells])
    return [F.count("*").alias("row_count"),
            F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum")]


def _write(df: DataFrame, path: str, keys: list[str], dealt: bool = False) -> dict:
    """Write ``df`` and return its measures, taken by the tasks that write: no pass of its own. A task
    that is run again may be counted twice; the comparison then fails, never passes wrongly."""
    seen = Observation()
    rows = (df.hint("rebalance", *keys) if keys and not dealt else df).observe(seen, *_measures(df))
    writer = rows.write.mode("errorifexists")
    (writer.partitionBy(*keys) if keys else writer).parquet(path)
    return seen.get


def _read(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    reader = spark.read.schema(like.schema) if like is not None else spark.read
    rows = reader.parquet(path)
    return rows.select(*[f"`{c}`" for c in like.columns]) if like is not None else rows


def _entries(spark: SparkSession, base: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).json(f"{base.rstrip('/')}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def current_run(spark: SparkSession, base: str) -> DataFrame:
    """The manifest's last entry, a row for each table; empty before the first refresh. Of two runs
    that took the same number at the same time, one wins for every reader."""
    entries = _entries(spark, base)
    last = entries.agg(F.max(F.struct("version", "run")).alias("last")).scalar()
    return entries.where(F.struct("version", "run") == last)


def refresh(tables: Mapping[str, DataFrame], base: str,
            check: Callable[[str, DataFrame], None] | None = None,
            dealt: Sequence[str] = ()) -> DataFrame:
    """Replace the warehouse under ``base`` by ``tables``, dimensions before facts; returns the new
    entry of the manifest.

    ``check`` may refuse a stored table by raising: it is called with the name and the rows as read
    back. ``dealt`` names tables whose rows have been brought together by partition. Any error leaves the manifest, and so every reader, as it was.
    """
    spark = next(iter(tables.values())).sparkSession
    base, run = base.rstrip("/"), uuid.uuid4().hex
    entries = []
    for name in [t for t in LOAD_ORDER if t in tables] + [t for t in tables if t not in LOAD_ORDER]:
        df = nulls_for_nan(tables[name])
        path = f"{base}/runs/{run}/{name}"
        keys = [c for c in WAREHOUSE_PARTITIONS.get(name, []) if c in df.columns]
        sent = _write(df, path, keys, name in dealt)
        stored = _read(spark, path, df)
        found = stored.agg(*_measures(stored)).first().asDict()
        if found != sent:
            raise RefreshError(f"{name}: {sent} was sent, {found} is stored")
        if check:
            check(name, stored)
        entries.append((name, path, found["row_count"], found["checksum"]))
    version = (_entries(spark, base).agg(F.max("version")).first()[0] or 0) + 1
    entry = spark.createDataFrame([(version, run, *e) for e in entries], MANIFEST)
    # One file: it is there as a whole or not at all.
    entry.coalesce(1).write.mode("append").json(f"{base}/manifest")
    return entry


def read_current(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables of the last complete refresh. Frames stay on that run when a new one is published."""
    return {r["table_name"]: _read(spark, r["path"]) for r in current_run(spark, base).collect()}


def drop_old_runs(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Remove the folders of all but the last ``keep`` runs of the manifest, failed runs among them;
    returns their names. For a time when nobody loads or still reads an older run."""
    entries = _entries(spark, base)
    kept = {r["run"] for r in entries.select("version", "run").distinct()
            .orderBy(F.desc("version"), F.desc("run")).limit(keep).collect()}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/runs")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in (files.listStatus(folder) if files.exists(folder) else []):
        if status.getPath().getName() not in kept:
            files.delete(status.getPath(), True)
            gone.append(status.getPath().getName())
    return gone
