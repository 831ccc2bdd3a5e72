"""What several corpus operators share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import cargolens

# The white space of the corpus contracts, as a class for regular expressions
# and as bytes. It is also what bytes.split() splits on.
SPACE = r"\x20\x09-\x0D"
SPACE_BYTES = b" \t\n\x0b\x0c\r"

# A batch handed to a Python worker: whole texts, so few rows; the bytes bound very long ones.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def small_batches(spark: SparkSession) -> SparkSession:
    """Prepare a session for Python workers: small batches, and this package on their path."""
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if not hasattr(context, "_cargolens_shipped"):
        package = Path(cargolens.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="cargolens-"), "cargolens.zip")
        with zipfile.ZipFile(archive, "w") as file:
            for source in sorted(package.rglob("*.py")):
                file.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))   # the driver serves it; executors fetch it once
        context._cargolens_shipped = True
    return spark


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def text_bytes(column: str | Column) -> Column:
    """UTF-8 bytes of a text; null is the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def words(column: str | Column) -> Column:
    """Words of a text as an array: maximal runs of anything but white space."""
    text = F.regexp_replace(F.coalesce(column, F.lit("")), f"^[{SPACE}]+|[{SPACE}]+$", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(text, f"[{SPACE}]+"))
