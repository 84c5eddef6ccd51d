"""Summaries of table snapshots that merge without reading the tables again.

A snapshot has one row per leaf path: rows, filled rows, a sketch of its distinct values and, for
numbers, a sketch of their quantiles. Counts add up and sketches unite, so coverage, null counts,
row counts and profiles of any set of snapshots come from a few kilobytes per snapshot. The row
with the empty path counts the table's rows: a path that a snapshot lacks counts as unfilled there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from turnstile.operators.quality import leaf_paths

SUMMARY_DDL = (
    "path string, n_rows bigint, filled bigint, distinct_sketch binary, quantile_sketch binary, "
    "entity string, snapshot_id string"
)
WHOLE = ""


def _leaf_type(schema: T.StructType, path: str) -> T.DataType:
    kind: T.DataType = schema
    for name in path.split("."):
        kind = kind[name].dataType
    return kind


def _leaf_summary(path: str, kind: T.DataType) -> Column:
    value = F.col(path)
    numbers = isinstance(kind, T.NumericType)
    quantiles = F.kll_sketch_agg_double(value.cast("double")) if numbers else F.lit(None)
    return F.struct(
        F.lit(path).alias("path"), F.count("*").alias("n_rows"), F.count(value).alias("filled"),
        F.hll_sketch_agg(value.cast("string")).alias("distinct_sketch"),
        quantiles.cast("binary").alias("quantile_sketch"))


def summarise(df: DataFrame, entity: str | Column, snapshot: str | Column) -> DataFrame:
    """Summary rows of the snapshots in ``df``, in one pass.

    ``entity`` and ``snapshot`` are names, or columns if the table holds several. A named snapshot
    without rows has a summary of zeros.
    """
    keys = {"_entity": entity, "_snapshot": snapshot}
    held = {k: v for k, v in keys.items() if isinstance(v, Column)}
    keyed = df.select(*[v.alias(k) for k, v in held.items()], F.struct("*").alias("_row"))
    whole = F.struct(F.lit(WHOLE).alias("path"), F.count("*").alias("n_rows"),
                     F.count("*").alias("filled"), F.lit(None).cast("binary").alias("distinct_sketch"),
                     F.lit(None).cast("binary").alias("quantile_sketch"))
    leaves = [_leaf_summary(f"_row.{p}", _leaf_type(df.schema, p)).alias(f"l{i}")
              for i, p in enumerate(leaf_paths(df.schema))]
    wide = keyed.groupBy(*held).agg(whole.alias("l"), *leaves)
    rows = F.explode(F.array(*[F.col(c) for c in wide.columns[len(held):]])).alias("r")
    return wide.select(*held, rows).withColumns(
        {k: F.lit(v) for k, v in keys.items() if k not in held}).select(
        F.regexp_replace("r.path", r"^_row\.", "").alias("path"), "r.n_rows", "r.filled",
        "r.distinct_sketch", "r.quantile_sketch", F.col("_entity").alias("entity"),
        F.col("_snapshot").alias("snapshot_id"))


def save_summaries(summaries: DataFrame, root: str) -> None:
    """Store summaries; those of the same snapshot of an entity are replaced, others stay."""
    summaries.repartition("entity", "snapshot_id").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("entity", "snapshot_id").parquet(root)


def read_summaries(spark: SparkSession, root: str) -> DataFrame:
    """Stored summaries; filters on entity and snapshot_id select folders."""
    return spark.read.schema(SUMMARY_DDL).parquet(root)


def merge_summaries(summaries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by..., path, n_rows (of the whole tables), filled and both sketches, merged.

    One row per key and path that any of the snapshots has; keys without rows keep their paths.
    """
    keys = list(by)
    merged = summaries.groupBy(*keys, "path").agg(
        F.sum("filled").alias("filled"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))
    totals = merged.where(F.col("path") == WHOLE).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("filled").alias("n_rows"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return merged.where(F.col("path") != WHOLE).join(totals, same).select(
        *keys, "path", "n_rows", "filled", "distinct_sketch", "quantile_sketch")


def coverage_of(summaries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Filled rows and fill rate of every path over the given snapshots."""
    rate = F.col("filled") / F.when(F.col("n_rows") > 0, F.col("n_rows"))
    return merge_summaries(summaries, by).select(
        *by, "path", "filled", F.coalesce(rate, F.lit(0.0)).alias("fill_rate"))


def null_counts_of(summaries: DataFrame, critical: list[str]) -> DataFrame:
    """Nulls per critical field over the given snapshots; of an absent field all rows are null."""
    whole = summaries.where(F.col("path") == WHOLE).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
    filled = summaries.where(F.col("path").isin(critical)).groupBy("path").agg(
        F.sum("filled").alias("filled"))
    fields = whole.select(F.explode(F.array(*[F.lit(c) for c in critical])).alias("path"), "n")
    nulls = F.col("n") - F.coalesce("filled", F.lit(0))
    return fields.join(filled, "path", "left").select(
        F.col("path").alias("field"), nulls.alias("null_count"), (nulls == 0).alias("passed"))


def row_counts_of(summaries: DataFrame) -> DataFrame:
    """entity, snapshot_id, row_count of every summarised snapshot."""
    return summaries.where(F.col("path") == WHOLE).select(
        "entity", "snapshot_id", F.col("n_rows").alias("row_count"))


def profile_of(summaries: DataFrame, ranks: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0),
               by: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct values (within about 2 %) and quantiles (ranks within about 2 %) per path.

    Paths without a number have null quantiles.
    """
    counted = F.kll_sketch_get_n_double("quantile_sketch")
    quantiles = F.array(*[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(r))
                          for r in ranks])
    return merge_summaries(summaries, by).select(
        *by, "path", "n_rows", "filled",
        F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0)).alias("n_distinct"),
        F.when(counted > 0, quantiles).alias("quantiles"))
