"""Flat tables: Parquet by snapshot as the table format, CSV as the exchange format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from turnstile.functions.text import fold_ascii

# Texts that count as missing when a CSV is read back.
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

BOM = "\ufeff"


def table_write(df: DataFrame, root: str, name: str, snapshot: str | None = None) -> str:
    """Write a table, replacing only the given snapshot's partition."""
    path = f"{root}/{name}"
    if snapshot is not None:
        df = df.withColumn("run_id", F.lit(snapshot))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run_id").parquet(path)
    return path


def table_read(spark: SparkSession, root: str, name: str, snapshot: str) -> DataFrame:
    """One snapshot of a table; only its partition is listed and read. Missing is an error."""
    return spark.read.option("basePath", f"{root}/{name}").parquet(
        f"{root}/{name}/run_id={snapshot}").drop("run_id")


def flat_columns(df: DataFrame) -> DataFrame:
    """Maps, lists and structs as JSON text, so the row fits a CSV line."""
    nested = (T.MapType, T.ArrayType, T.StructType)
    return df.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def csv_export(df: DataFrame, path: str, encoding: str = "utf-8-sig") -> None:
    """Write CSV parts: ``utf-8-sig`` opens cleanly in spreadsheets, ``ascii`` folds text.

    Characters without an ASCII stand-in are kept; ``special_characters`` reports them.
    """
    if encoding not in ("utf-8-sig", "utf-8", "ascii"):
        raise ValueError("encoding must be utf-8-sig, utf-8 or ascii")
    df = flat_columns(df)
    if encoding == "ascii":
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.withColumns({c: fold_ascii(F.col(f"`{c}`")) for c in texts})
    if encoding == "utf-8-sig" and df.columns:
        df = df.toDF(BOM + df.columns[0], *df.columns[1:])
    df.write.mode("errorifexists").option("header", True).option("escape", '"').option(
        "emptyValue", "").csv(path)


def csv_read(
    spark: SparkSession, path: str, schema: T.StructType | None = None, line_breaks: bool = True
) -> DataFrame:
    """Read exported CSV; untyped without a schema.

    Missing-value words become null, but in a text column of a given schema only empty text
    does: there "None" or "NA" may be a name. Without ``line_breaks`` in texts Spark can split
    a file over many tasks.
    """
    raw = spark.read.option("header", True).option("escape", '"').option(
        "multiLine", line_breaks).csv(path)
    texts = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)} if schema else ()
    clean = raw.select(*[
        F.when(~F.col(f"`{c}`").isin([""] if c.lstrip(BOM) in texts else NA_WORDS),
               F.col(f"`{c}`")).alias(c.lstrip(BOM))
        for c in raw.columns
    ])
    if schema is None:
        return clean
    return clean.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in clean.columns
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])
