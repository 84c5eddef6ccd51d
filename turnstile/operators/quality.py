"""Data-quality checks and coverage profiles; each check is one pass over its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from turnstile.functions.text import non_ascii_flags
from turnstile.functions.values import blank_to_null


def _long(row: DataFrame, label: str, value: str) -> DataFrame:
    """Turn a one-row table of counts into (label, value) rows."""
    pairs = [F.struct(F.lit(c).alias(label), F.col(f"`{c}`").alias(value)) for c in row.columns]
    return row.select(F.explode(F.array(*pairs)).alias("r")).select("r.*")


def null_counts(df: DataFrame, critical: list[str]) -> DataFrame:
    """Nulls per critical field and whether the field passes."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in critical])
    return _long(counts, "field", "null_count").withColumn("passed", F.col("null_count") == 0)


def row_count_changes(manifest: DataFrame, limit: float = 0.1) -> DataFrame:
    """Row count of every (entity, snapshot) against the entity's previous snapshot."""
    from pyspark.sql import Window

    window = Window.partitionBy("entity").orderBy("snapshot_id")
    previous = F.lag("row_count").over(window)
    change = F.when(
        F.col("previous") > 0, (F.col("row_count") - F.col("previous")) / F.col("previous")
    ).otherwise(0.0)
    return (
        manifest.select("entity", "snapshot_id", "row_count", previous.alias("previous"))
        .where("previous IS NOT NULL")
        .withColumn("change", change)
        .withColumn("passed", F.abs("change") < limit)
    )


def schema_differences(df: DataFrame, expected: T.StructType) -> list[tuple[str, str, str]]:
    """(column, expected type, actual type) of every column that differs; '' if absent."""
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [
        (n, want.get(n, ""), have.get(n, ""))
        for n in sorted(want.keys() | have.keys()) if want.get(n) != have.get(n)
    ]


def orphan_counts(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-blank key has no parent, per key value."""
    lost = child.where(F.length(key) > 0).join(
        parent.select(key).distinct(), key, "left_anti")
    return lost.groupBy(key).agg(F.count("*").alias("rows"))


def future_dates(df: DataFrame, column: str, as_of: str) -> DataFrame:
    """Rows with a date after ``as_of`` and the latest such date."""
    late = F.col(column) > as_of
    return df.agg(
        F.count_if(late).alias("future_rows"),
        F.max(F.when(late, F.col(column))).alias("latest"),
        (F.count_if(late) == 0).alias("passed"))


def pseudonymize(df: DataFrame, id_columns: list[str], drop: list[str], salt: str) -> DataFrame:
    """Replace ids by salted SHA-256 digests and drop personal columns."""
    hashed = {c: F.sha2(F.concat(F.lit(salt), F.col(c)), 256) for c in id_columns}
    return df.withColumns(hashed).drop(*drop)


def special_characters(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per text column with foldable and with other non-ASCII characters."""
    aggs = []
    for c in columns:
        foldable, other = non_ascii_flags(F.col(c))
        aggs.append(F.struct(F.count_if(foldable).alias("foldable_rows"),
                             F.count_if(other).alias("other_rows")).alias(c))
    return _long(df.agg(*aggs), "column", "n").select("column", "n.*")


def leaf_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted paths of all leaves of a nested schema; lists count as leaves."""
    out: list[str] = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out += leaf_paths(f.dataType, path + ".")
        else:
            out.append(path)
    return out


def field_coverage(df: DataFrame) -> DataFrame:
    """Filled rows and fill rate of every leaf path."""
    paths = leaf_paths(df.schema)
    counts = df.agg(F.count("*").alias("_rows"), *[
        F.count(F.col(p)).alias(str(i)) for i, p in enumerate(paths)])
    pairs = [F.struct(F.lit(p).alias("path"), F.col(str(i)).alias("filled"))
             for i, p in enumerate(paths)]
    return counts.select("_rows", F.explode(F.array(*pairs)).alias("r")).select(
        "r.path", "r.filled",
        F.coalesce(F.col("r.filled") / F.when(F.col("_rows") > 0, F.col("_rows")), F.lit(0.0))
        .alias("fill_rate"))


def identity_fill_rates(guests: DataFrame) -> DataFrame:
    """Share of guests with first name, last name and e-mail."""
    def rate(c: str):
        return (F.count(blank_to_null(F.col(c))) / F.count("*")).alias(c)

    return guests.agg(rate("first_name"), rate("last_name"), rate("email"))
