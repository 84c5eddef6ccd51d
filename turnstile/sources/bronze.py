"""Raw snapshots: ``<root>/<entity>/year=Y/month=M/day=D/snapshot_<id>.json``.

A snapshot is one JSON array file (as pulled) or a folder of JSON lines (as written here).
The id is ``YYYYMMDD_HHMMSS``; its text order is its time order.
"""

from __future__ import annotations

import re
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from turnstile.schemas import raw_schema
from turnstile.sources.arrays import read_arrays

SNAPSHOT_ID = r"(\d{8}_\d{6})"


def snapshot_path(root: str, entity: str, snapshot: str) -> str:
    """Folder or file of one snapshot."""
    if len(snapshot) < 8 or not snapshot[:8].isdigit():
        raise ValueError(f"snapshot id must start with YYYYMMDD, got {snapshot!r}")
    y, m, d = snapshot[:4], snapshot[4:6], snapshot[6:8]
    return f"{root}/{entity}/year={y}/month={m}/day={d}/snapshot_{snapshot}.json"


def bronze_write(df: DataFrame, root: str, entity: str, snapshot: str) -> str:
    """Write one immutable snapshot as JSON lines; an existing one is never replaced."""
    path = snapshot_path(root, entity, snapshot)
    df.write.mode("errorifexists").json(path)
    return path


def _renamed(kind: T.DataType, names: dict[str, str], at: str = "") -> T.DataType:
    """A type with the fields of the source; ``names`` maps dotted paths to source names."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_renamed(kind.elementType, names, at), kind.containsNull)
    if not isinstance(kind, T.StructType):
        return kind
    return T.StructType([
        T.StructField(names.get(f"{at}{f.name}", f.name),
                      _renamed(f.dataType, names, f"{at}{f.name}."), f.nullable)
        for f in kind.fields])


def _is_large(spark: SparkSession, path: str) -> bool:
    """Whether a plain file has more bytes than the session reads in one task."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found) or []
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return any(f.isFile() and f.getLen() > limit for f in files)


def bronze_read(
    spark: SparkSession, root: str, entity: str, snapshot: str,
    schema: T.StructType | None = None, array_file: bool = False,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Raw records of one snapshot with ``_ord``, ``run_id`` and ``_corrupt_record``.

    A missing snapshot reads as an empty table. Records that do not parse keep their text in
    ``_corrupt_record`` instead of vanishing. In an array file Spark cannot tell which record
    a bad field belongs to: the field reads as null and its record stays. Written snapshots
    carry ``_ord``; for an array file it is the position in the file. An array file larger than
    one split of the session is cut into records by all cores, with the same result. ``names``
    maps fields, as dotted paths of the schema, to the names they have in the source.
    """
    target = schema or raw_schema(entity)
    schema = _renamed(target, names or {})
    corrupt = T.StructField("_corrupt_record", T.StringType())
    wanted = schema if array_file else T.StructType(
        schema.fields + [corrupt, T.StructField("_ord", T.LongType())])
    path = snapshot_path(root, entity, snapshot)
    reader = spark.read.schema(wanted).option("multiLine", array_file).option(
        "columnNameOfCorruptRecord", "_corrupt_record")
    try:
        split = array_file and _is_large(spark, path)
        raw = read_arrays(spark, path, schema) if split else reader.json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], wanted)
    if names:
        raw = raw.select(
            *[F.col(f"`{have.name}`").cast(want.dataType).alias(want.name)
              for have, want in zip(schema.fields, target.fields, strict=True)],
            *[c for c in ("_corrupt_record", "_ord") if c in raw.columns])
    if array_file:
        position = F.col("_ord") if "_ord" in raw.columns else F.monotonically_increasing_id()
        raw = raw.withColumns({"_ord": position, "_corrupt_record": F.lit(None).cast("string")})
    return raw.withColumn("run_id", F.lit(snapshot))


def snapshot_list(spark: SparkSession, root: str, suffix: str = ".json") -> DataFrame:
    """Snapshots of every entity, newest first, from the names in the day folders alone.

    One row per snapshot, however many files it has; ``suffix`` applies to snapshots that are
    single files.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/year=*/month=*/day=*/snapshot*")
    rows = []
    for found in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []:
        name = found.getPath().toString()
        entity, snapshot = re.search(r"/([^/]+)/year=\d{4}/", name), re.search(SNAPSHOT_ID, name)
        if entity and snapshot and (found.isDirectory() or name.endswith(suffix)):
            rows.append((entity[1], snapshot[1], found.getModificationTime() / 1000))
    listed = spark.createDataFrame(rows, "entity string, snapshot_id string, modified double")
    return listed.groupBy("entity", "snapshot_id").agg(
        F.max(F.timestamp_seconds("modified")).alias("modified")
    ).orderBy(F.col("snapshot_id").desc(), "entity")


def resolve_snapshots(snapshots: DataFrame, which: str = "latest") -> list[str]:
    """Snapshot ids to work on: ``latest``, ``all`` (newest first) or one id."""
    if which not in ("latest", "all") and not re.fullmatch(SNAPSHOT_ID, which):
        raise ValueError("which must be latest, all or a snapshot id")
    ids = snapshots.select("snapshot_id").distinct().orderBy(F.col("snapshot_id").desc())
    if which == "latest":
        ids = ids.limit(1)
    elif which != "all":
        ids = ids.where(F.col("snapshot_id") == which)
    found = [r["snapshot_id"] for r in ids.collect()]
    if not found:
        raise ValueError(f"no snapshot found for {which!r}")
    return found


def latest_file(spark: SparkSession, root: str, prefix: str) -> str | None:
    """Newest file by modification time whose name starts with a prefix."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"{prefix}*").load(root)
        .orderBy(F.col("modificationTime").desc(), F.col("path").desc())
        .select("path").first()
    )
    return found["path"] if found else None


def expired_snapshots(snapshots: DataFrame, as_of: str, days: int = 730) -> DataFrame:
    """Snapshots older than the retention period; a report, nothing is deleted."""
    day = F.to_date(F.substring("snapshot_id", 1, 8), "yyyyMMdd")
    age = F.date_diff(F.to_date(F.lit(as_of)), day)
    return snapshots.withColumn("age_days", age).where(F.col("age_days") > days)


def union_sources(frames: list[DataFrame | None]) -> DataFrame:
    """Union by name of pulls from several namespaces; a failed pull (None) is skipped."""
    present = [f for f in frames if f is not None]
    if not present:
        raise ValueError("no namespace could be read")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def snapshot_ids(
    spark: SparkSession, root: str, entity: str, start: str, end: str
) -> list[str]:
    """Snapshots of an entity dated in [start, end), listed from their day folders only."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    if first >= last:
        raise ValueError("start date must be before end date")
    days: dict[tuple[int, int], list[str]] = {}
    for n in range((last - first).days):
        day = first + timedelta(days=n)
        days.setdefault((day.year, day.month), []).append(f"{day.day:02d}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    found: set[str] = set()
    for (year, month), numbers in days.items():
        path = hadoop(f"{root}/{entity}/year={year:04d}/month={month:02d}/"
                      f"day={{{','.join(numbers)}}}/snapshot_*")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
        names = [re.search(SNAPSHOT_ID, f.getPath().getName()) for f in files]
        found.update(m[1] for m in names if m)
    return sorted(found)


def bronze_range(
    spark: SparkSession, root: str, entity: str, start: str, end: str
) -> DataFrame:
    """Written snapshots dated in [start, end), found by day folders."""
    ids = snapshot_ids(spark, root, entity, start, end)
    schema = T.StructType(raw_schema(entity).fields + [
        T.StructField("_corrupt_record", T.StringType()), T.StructField("_ord", T.LongType())])
    if not ids:
        return spark.createDataFrame([], schema).withColumn("run_id", F.lit(""))
    raw = spark.read.schema(schema).json([snapshot_path(root, entity, i) for i in ids])
    return raw.withColumn(
        "run_id", F.regexp_extract(F.col("_metadata.file_path"), SNAPSHOT_ID, 1))


def array_to_lines(spark: SparkSession, root: str, entity: str, snapshot: str, to_root: str) -> str:
    """Write an as-pulled array snapshot once as JSON lines with ``_ord``.

    Every later read of the lines is split without a search for the records.
    """
    rows = bronze_read(spark, root, entity, snapshot, array_file=True)
    return bronze_write(rows.drop("run_id", "_corrupt_record"), to_root, entity, snapshot)
