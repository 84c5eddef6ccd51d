"""Helpers shared by the flatteners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from turnstile.functions.dates import split_filled
from turnstile.functions.values import blank_to_null

# Columns that travel with a record without being part of its entity.
CARRIED = ("_ord", "run_id")


def shape(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Select named expressions, keeping the record's order and snapshot columns."""
    kept = [F.col(c) for c in CARRIED if c in df.columns and c not in columns]
    return df.select(*[e.alias(n) for n, e in columns.items()], *kept)


def stamps(prefix: str, c: Column, whole: bool = False) -> dict[str, Column]:
    """``<prefix>_date`` and ``<prefix>_time`` (and the raw ``_datetime``) of ISO text."""
    date, time = split_filled(c)
    out = {f"{prefix}_date": date, f"{prefix}_time": time}
    if whole:
        out[f"{prefix}_datetime"] = blank_to_null(c)
    return out


def any_set(*cols: Column) -> Column:
    """True when at least one of the fields is present."""
    test = cols[0].isNotNull()
    for c in cols[1:]:
        test = test | c.isNotNull()
    return test


def kind(v: Column) -> Column:
    """Type name of a variant: STRING, BIGINT, OBJECT<...>, ARRAY<...>, VOID, null."""
    return F.schema_of_variant(v)


def variant_at(v: Column, path: str, to: str = "string") -> Column:
    return F.try_variant_get(v, path, to)


def variant_filled(v: Column, path: str = "$") -> Column:
    """Text of a variant value unless it is null, empty, zero or false."""
    inner = F.try_variant_get(v, path, "variant")
    text = F.try_variant_get(v, path, "string")
    empty = F.when(kind(inner) == "STRING", text == "").when(
        kind(inner) == "BOOLEAN", text == "false"
    ).when(
        kind(inner).startswith("OBJECT"), kind(inner) == "OBJECT<>"
    ).when(
        kind(inner).startswith("ARRAY"), F.size(F.try_variant_get(v, path, "array<variant>")) == 0
    ).otherwise(text.try_cast("double") == 0)
    return F.when(~empty, text)


def variant_text(v: Column) -> Column:
    """Answer text: list items joined by ``; ``, objects as JSON text, scalars as text."""
    return F.when(
        kind(v).startswith("ARRAY"),
        F.array_join(F.try_variant_get(v, "$", "array<string>"), "; ", "None"),
    ).otherwise(F.try_variant_get(v, "$", "string"))


def last_entries(entries: Column) -> Column:
    """Map of an array of (key, value) structs in which the last of equal keys wins.

    Sorted by key and place, an entry stays if the next one has another key.
    """
    placed = F.transform(entries, lambda x, i: F.struct(
        x["key"].alias("key"), i.alias("place"), x["value"].alias("value")))
    ordered = F.array_sort(placed, lambda a, b: F.when(a["key"] < b["key"], -1).when(
        a["key"] > b["key"], 1).otherwise(a["place"] - b["place"]))
    kept = F.filter(F.transform(
        F.arrays_zip(ordered.alias("a"), F.slice(ordered, 2, F.size(ordered)).alias("b")),
        lambda z: F.struct(z["a"]["key"].alias("key"), z["a"]["value"].alias("value"),
                           (z["a"]["key"] == z["b"]["key"]).alias("again"))),
        lambda x: ~F.coalesce(x["again"], F.lit(False)))
    return F.map_from_entries(F.transform(kept, lambda x: F.struct(x["key"], x["value"])))


def _aligned(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        known = {f.name: f.dataType for f in have.fields}
        parts = [
            (_aligned(c[f.name], known[f.name], f.dataType) if f.name in known
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(c, lambda x: _aligned(x, have.elementType, want.elementType))
    if isinstance(want, T.VariantType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_variant_object(c)
    return c.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Align records to a schema: missing fields become null at any depth, types are cast."""
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = {
        f.name: _aligned(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have
        else F.lit(None).cast(f.dataType)
        for f in schema.fields
    }
    return shape(df, columns)
