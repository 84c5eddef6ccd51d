"""New raw files -> flat rows -> latest row per key, as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from turnstile.operators.enrich import upsert_latest
from turnstile.session import stage


def existing_buckets(spark: SparkSession, target: str) -> tuple[DataFrame | None, int | None]:
    """The table and its number of buckets, or nothing if there is no table yet.

    Any other error of reading is raised: a table that cannot be read must not be replaced.
    """
    try:
        table = spark.read.parquet(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, None
    row = table.select("buckets").first()
    return (table, row["buckets"]) if row else (None, None)


def upsert_batch(
    target: str, batch: DataFrame, key: str, updated: str, buckets: int | None = None
) -> None:
    """Merge a batch into a table partitioned by key hash, rewriting only what changes.

    The number of buckets is set when the table is made (the session's shuffle partitions
    unless given, so a larger session makes a finer table) and kept with it as ``buckets``.
    A bucket is rewritten, as one file, if a row of the batch takes the place of another one
    there; a batch repeated after a failure, or one with late rows only, writes nothing.
    """
    spark = batch.sparkSession
    table, known = existing_buckets(spark, target)
    buckets = known or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    delta = batch.where(F.length(key) > 0).withColumn(
        "buckets", F.lit(buckets)).withColumn("bucket", bucket)
    # Written aside: a table cannot be read and overwritten in one job.
    changed = stage(delta if table is None else changed_rows(table, delta, key, updated), "upsert-delta")
    touched = [r["bucket"] for r in changed.select("bucket").distinct().collect()]
    if not touched:
        return
    existing = changed.limit(0) if table is None else table.where(F.col("bucket").isin(touched))
    merged = stage(upsert_latest(existing, changed, key, updated), "upsert-merged")
    merged.repartition("bucket").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("buckets", "bucket").parquet(target)


def changed_rows(table: DataFrame, delta: DataFrame, key: str, updated: str) -> DataFrame:
    """The latest row per key of ``delta`` where it replaces a different row or none.

    Rows are equal if their JSON forms are, so absent columns count as null ones.
    """
    same = [c for c in delta.columns if c not in ("buckets", "bucket")]
    form = lambda df: F.to_json(F.struct(*[c for c in same if c in df.columns]))
    latest = upsert_latest(delta.limit(0), delta, key, updated).withColumn("_form", form(delta))
    stored = table.select(
        "bucket", key, F.col(updated).alias("_stored"), form(table).alias("_stored_form"))
    late = F.col("_stored").isNotNull() & ~F.coalesce(
        F.col(updated) >= F.col("_stored"), F.lit(False))
    return latest.join(stored, ["bucket", key], "left").where(
        F.col("_stored_form").isNull() | ~(late | (F.col("_form") == F.col("_stored_form")))
    ).select(*delta.columns)


def stream_upsert(
    spark: SparkSession, source: str, schema: T.StructType,
    flatten: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, key: str,
    updated: str = "updated_datetime", buckets: int | None = None,
) -> StreamingQuery:
    """Process every raw file not seen before and stop; call again for the next files."""
    wanted = T.StructType(schema.fields + [T.StructField("_ord", T.LongType())])
    raw = spark.readStream.schema(wanted).option("recursiveFileLookup", True).json(source)
    return (
        flatten(raw).writeStream
        .foreachBatch(lambda batch, _: upsert_batch(target, batch, key, updated, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
