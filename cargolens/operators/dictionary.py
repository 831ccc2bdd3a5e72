"""Data dictionary: cleaned field descriptions, their table, and the derived fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cargolens.functions.text import clean_description, standardized, stripped
from cargolens.schemas import DERIVED_FIELDS, FIELD_TABLES

OUTPUT = ["Field", "Standardized_Column_Name", "Description", "Source", "Table"]


def data_dictionary(raw: DataFrame) -> DataFrame:
    """``raw`` has Field and Description; fields without a known table get ``Unknown``."""
    spark = raw.sparkSession
    lookup = spark.createDataFrame(FIELD_TABLES, "Field STRING, Table STRING")
    derived = spark.createDataFrame(
        DERIVED_FIELDS, "Field STRING, Description STRING, Table STRING")
    fields = raw.select(stripped(F.col("Field")).alias("Field"),
                        clean_description(F.col("Description")).alias("Description"))
    # The lookup has one row per raw field name, fixed above: always small enough to copy.
    original = (fields.join(F.broadcast(lookup), "Field", "left")
                .withColumns({"Table": F.coalesce("Table", F.lit("Unknown")),
                              "Source": F.lit("Original"),
                              "Standardized_Column_Name": standardized(F.col("Field"))}))
    derived = derived.withColumns({"Source": F.lit("Derived"),
                                   "Standardized_Column_Name": F.col("Field")})
    return (original.select(*OUTPUT).unionByName(derived.select(*OUTPUT))
            .orderBy("Table", "Field"))
