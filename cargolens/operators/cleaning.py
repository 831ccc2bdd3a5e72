"""Cleaning steps of the raw extracts; each is usable on its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cargolens.functions.text import (canonical_number, standard_name, to_float, to_int,
                                      to_timestamp)
from cargolens.schemas import DROPPED_COLUMNS, RAW_DATE_COLUMNS, RAW_NUMERIC_FIELDS

DATE_FORMATS = ["M/d/yyyy H:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def present(df: DataFrame, names: list[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n in have]


def drop_columns(df: DataFrame, names: list[str] = DROPPED_COLUMNS) -> DataFrame:
    return df.drop(*names)


def parse_timestamps(df: DataFrame, names: list[str] = RAW_DATE_COLUMNS,
                     formats: list[str] = DATE_FORMATS) -> DataFrame:
    return df.withColumns({n: to_timestamp(quoted(n), formats) for n in present(df, names)})


def canonical_numbers(df: DataFrame, names: list[str] = RAW_NUMERIC_FIELDS) -> DataFrame:
    """Text of number fields in one spelling, so that equal numbers are equal texts."""
    return df.withColumns({n: canonical_number(quoted(n)) for n in present(df, names)})


def dedupe_rows(df: DataFrame, row_seq: str | None = None, copies: str | None = None) -> DataFrame:
    """Keep one copy of equal rows, nulls being equal. Texts are compared as they are: see
    ``canonical_numbers``.

    With ``row_seq`` the copy keeps its lowest row number, i.e. the first one stays; ``copies``
    names a column for how many rows it stands for.
    """
    if row_seq is None and copies is None:
        return df.dropDuplicates()
    keys = [quoted(c) for c in df.columns if c != row_seq]
    kept = [F.min(row_seq).alias(row_seq)] if row_seq else []
    return df.groupBy(*keys).agg(*kept, *([F.count("*").alias(copies)] if copies else []))


def digest(df: DataFrame, skip: list[str] = ()) -> list[Column]:
    """Two hashes of 64 bits that equal rows share and others don't, where a null stands included.
    They run over the columns in opposite orders, so they don't collide together."""
    kinds = {c: kind for c, kind in df.dtypes if c not in skip}
    texts = F.array(*[quoted(c) for c, kind in kinds.items() if kind == "string"])
    others = [quoted(c) for c, kind in kinds.items() if kind != "string"]
    # Arrays make short loops, where code for each of fifty columns is too long to be compiled.
    gaps = F.array(*[quoted(c).isNull() for c in kinds])
    return [F.xxhash64(texts, *others, gaps), F.xxhash64(gaps, *reversed(others), F.reverse(texts))]


def fill_missing(df: DataFrame, numeric: list[str], skip: list[str] = ()) -> DataFrame:
    """Missing numbers become 0 and missing text ``Unknown``.

    Raw numeric columns are still text here, so their fill is the text "0".
    """
    types = dict(df.dtypes)
    fills = {}
    for name in df.columns:
        if name in skip or types[name] not in ("string", "int", "bigint", "double"):
            continue
        if name in numeric:
            fills[name] = F.lit(0).cast(types[name])
        elif types[name] == "string":
            fills[name] = F.lit("Unknown")
    return df.withColumns({n: F.coalesce(quoted(n), v) for n, v in fills.items()})


def standardize_names(df: DataFrame) -> DataFrame:
    names = [standard_name(n) for n in df.columns]
    if len(set(names)) != len(names):
        clashes = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"column names collide after standardising: {clashes}")
    return df.toDF(*names)


def coerce_numbers(df: DataFrame, ints: list[str], floats: list[str],
                   money_type: str = "double") -> DataFrame:
    """Text to numbers, unreadable values to zero.

    ``money_type`` may be a DECIMAL, which makes every later sum exact and
    independent of how the rows are spread over tasks.
    """
    casts = {n: to_int(F.col(n)) for n in present(df, ints)}
    casts |= {n: to_float(F.col(n)).cast(money_type) for n in present(df, floats)}
    return df.withColumns(casts)


def drop_incomplete(df: DataFrame, required: list[str]) -> DataFrame:
    return df.na.drop(subset=required)
