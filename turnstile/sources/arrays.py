"""JSON array files read by all cores.

Spark reads an array file in one task. Here the text is cut at every ``}``, which Spark can do at
any split of the file. Each piece is summarised for both ways it may start (outside or inside a
string); summaries combine by addition, first within a split, then over the splits of a file. So
every piece learns its depth and the number of the record it belongs to, and records are put
together from their own pieces only.

Records are the objects of one top-level array, or top-level objects that follow each other.
Values of other kinds between them are not read. An array cut off inside a record loses that
record. Spark never places a split boundary inside a piece, and valid JSON never has a ``}`` right
after an escaping backslash, so no escape reaches over a cut. The only tables not dealt by split or
record have one row per split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from turnstile.session import stage

SPLIT = ["file", "split"]


def _rise(parts: Column, start: int) -> Column:
    """Brackets opened minus closed in every second part between quotes."""
    outside = F.array_join(F.filter(parts, lambda _, i: i % 2 == start), "")
    count = lambda marks: F.length(outside) - F.length(F.translate(outside, marks, ""))
    return count("{[") - count("}]")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, split, at, text and, for both states at the start of the split, depths after it.

    ``quoted`` is 1 where the piece ends in the other state than its split starts; ``depth_out``
    and ``depth_in`` are the brackets opened since the start of the split if that lies outside
    or inside a string.
    """
    text = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    parts = F.split(F.regexp_replace("text", r"\\[\s\S]", ""), '"')
    read = text.withColumn("parts", parts).select(
        *SPLIT, "at", "text", ((F.size("parts") - 1) % 2).alias("odd"),
        _rise(F.col("parts"), 0).alias("rise_out"), _rise(F.col("parts"), 1).alias("rise_in"))
    so_far = Window.partitionBy(*SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    read = read.withColumn("quoted", F.sum("odd").over(so_far) % 2)
    before = (F.col("quoted") + F.col("odd")) % 2
    # The brace at the cut counts where the piece ends outside a string.
    out = F.when(before == 0, F.col("rise_out")).otherwise(F.col("rise_in")) - (1 - F.col("quoted"))
    inside = F.when(before == 0, F.col("rise_in")).otherwise(F.col("rise_out")) - F.col("quoted")
    return read.select(*SPLIT, "at", "text", "quoted", F.sum(out).over(so_far).alias("depth_out"),
                       F.sum(inside).over(so_far).alias("depth_in"))


def _starts(pieces: DataFrame) -> DataFrame:
    """State and depth at the start of every split; one row per split of a file."""
    last = pieces.groupBy(*SPLIT).agg(F.max_by(
        F.struct("quoted", "depth_out", "depth_in"), "at").alias("end")).select(*SPLIT, "end.*")
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(
        Window.unboundedPreceding, -1)
    state = last.withColumn(
        "in_string", F.coalesce(F.sum("quoted").over(earlier) % 2, F.lit(0)))
    rise = F.when(F.col("in_string") == 0, F.col("depth_out")).otherwise(F.col("depth_in"))
    return state.withColumn("rise", rise).select(
        *SPLIT, "in_string", F.coalesce(F.sum("rise").over(earlier), F.lit(0)).alias("depth"))


def record_texts(spark: SparkSession, path: str) -> DataFrame:
    """file, position (from 0 in its file) and text of every record of the files at ``path``."""
    pieces = stage(_pieces(spark, path), "array-pieces")
    place = F.struct("split", "at")
    files = pieces.groupBy("file").agg(
        F.min_by("text", place).alias("head"), F.max_by("at", place).alias("tail")).select(
        "file", "tail", F.col("head").rlike(r"^[\s\uFEFF]*\[").cast("int").alias("base"))
    placed = pieces.join(_starts(pieces).join(files, "file"), SPLIT)
    # Behind the last piece of an array there is no brace.
    outside = (F.col("quoted") == F.col("in_string")) & (
        (F.col("base") == 0) | (F.col("at") != F.col("tail")))
    depth = F.col("depth") + F.when(
        F.col("in_string") == 0, F.col("depth_out")).otherwise(F.col("depth_in"))
    earlier = Window.partitionBy(*SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.withColumn("ends", (outside & (depth == F.col("base"))).cast("int")).withColumn(
        "done", F.coalesce(F.sum("ends").over(earlier), F.lit(0)))
    ends = stage(ends.select(*SPLIT, "at", "text", "ends", "done"), "array-ends")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.groupBy(*SPLIT).agg(F.sum("ends").alias("n")).select(
        *SPLIT, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
        F.sum("n").over(Window.partitionBy("file")).alias("records"))
    # What follows the last record is left out first: in a broken file it may be long.
    whole = ends.join(offsets, SPLIT).withColumn("position", F.col("first") + F.col("done")).where(
        "position < records").groupBy("file", "position").agg(
        F.sort_array(F.collect_list(F.struct("split", "at", "text"))).alias("pieces"))
    body = F.concat(F.array_join("pieces.text", "}"), F.lit("}"))
    return whole.select(
        "file", "position", F.regexp_replace(body, r"^[\s,\[\uFEFF]+", "").alias("text"))


def read_arrays(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of array files with ``_ord``, the position in the file.

    Fields that do not fit the schema read as null.
    """
    return record_texts(spark, path).select(
        F.from_json("text", schema).alias("r"), F.col("position").alias("_ord")).select("r.*", "_ord")
