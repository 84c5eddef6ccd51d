"""Column clean-up of exported tables, applied in a fixed order by ``tidy``."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from turnstile.operators.filters import filter_rows


def remove_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns; unknown names are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def keep_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Keep the known ones of the named columns; all columns if none is known."""
    known = [n for n in names if n in df.columns]
    return df.select(*known) if known else df


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns; unknown names are ignored."""
    return df.withColumnsRenamed(mapping)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold no value at all, found in one pass over the table."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(df.columns)])
    row = counts.first()
    return df.drop(*[c for i, c in enumerate(df.columns) if row[i] == 0])


def standardize_columns(df: DataFrame) -> DataFrame:
    """Lower-case trimmed names with blanks, hyphens and slashes as underscores."""
    return df.toDF(*[re.sub(r"[ \-/]", "_", c.lower().strip()) for c in df.columns])


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """Union by name; columns missing from a table are null in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Distinct rows, nulls being equal."""
    return df.dropDuplicates()


def tidy(
    df: DataFrame, drop_empty: bool = False, remove: list[str] | None = None,
    keep: list[str] | None = None, rename: dict[str, str] | None = None,
    where: str | None = None, distinct: bool = False,
) -> DataFrame:
    """Drop empty columns, remove, keep, rename, filter, then remove duplicate rows."""
    if drop_empty:
        df = drop_empty_columns(df)
    if remove:
        df = remove_columns(df, remove)
    if keep:
        df = keep_columns(df, keep)
    if rename:
        df = rename_columns(df, rename)
    if where:
        df = filter_rows(df, where)
    return drop_duplicate_rows(df) if distinct else df
