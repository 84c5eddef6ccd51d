"""Two exports compared by bucket digests: only buckets that differ are compared row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnstile.session import stage

BUCKETS = 1 << 16


def _both_sides(left: DataFrame, right: DataFrame, key: str, status: str, buckets: int) -> DataFrame:
    """side (1 left, -1 right), key, status, bucket of all rows with a key."""
    sides = [df.where(F.length(F.col(key)) > 0).select(
        F.lit(side).alias("side"), F.col(key).alias("key"), F.col(status).alias("status"))
        for df, side in ((left, 1), (right, -1))]
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")
    return sides[0].unionByName(sides[1]).withColumn("bucket", bucket)


def compare_exports(
    left: DataFrame, right: DataFrame, key: str, status: str, buckets: int = BUCKETS
) -> tuple[DataFrame, DataFrame]:
    """Counts per status, and the (key, status) pairs that one side has more often.

    Rows are compared as multisets of (key, status); rows with a null or blank key are left out,
    a null status is a status. Both sides are summed into one digest per (bucket of keys, status),
    left minus right, which shuffles a row per bucket, status and task. Keys and statuses of a
    bucket whose digests cancel are equal; only the rows of other buckets are grouped by key. The
    set of those buckets has at most ``buckets`` numbers, so it is broadcast.

    Counts: status, rows_left, rows_right, in_both, left_only, right_only. Differences: key,
    status, n_left, n_right.
    """
    rows = _both_sides(left, right, key, status, buckets)
    side = F.col("side")
    digest = lambda salt: F.sum(
        side * F.xxhash64("key", "status", F.lit(salt)).cast("decimal(38,0)"))
    cells = stage(rows.groupBy("bucket", "status").agg(
        F.count_if(side == 1).alias("n_left"), F.count_if(side == -1).alias("n_right"),
        digest(1).alias("x"), digest(2).alias("y")), "export-digests")
    unequal = cells.where("n_left <> n_right OR x <> 0 OR y <> 0").select("bucket").distinct()
    differences = stage(rows.join(F.broadcast(unequal), "bucket", "left_semi").groupBy(
        "key", "status").agg(F.count_if(side == 1).alias("n_left"),
                             F.count_if(side == -1).alias("n_right")).where("n_left <> n_right"),
        "export-differences")
    zero = F.lit(0).cast("bigint")
    surplus = F.col("n_left") - F.col("n_right")
    parts = cells.select("status", "n_left", "n_right", zero.alias("l"), zero.alias("r")).union(
        differences.select("status", zero, zero, F.greatest(surplus, zero),
                           F.greatest(-surplus, zero)))
    counts = parts.groupBy("status").agg(
        F.sum("n_left").alias("rows_left"), F.sum("n_right").alias("rows_right"),
        F.sum("l").alias("left_only"), F.sum("r").alias("right_only"))
    return counts.select("status", "rows_left", "rows_right",
                         (F.col("rows_left") - F.col("left_only")).alias("in_both"),
                         "left_only", "right_only"), differences
