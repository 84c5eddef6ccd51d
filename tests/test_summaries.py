"""Merged summaries against the tables they stand for."""

import json
import uuid
from pathlib import Path

from pyspark.sql import functions as F

from turnstile.operators.quality import field_coverage, null_counts, row_count_changes
from turnstile.plans.runs import backfill, build_flat_tables
from turnstile.session import scratch_root
from turnstile.sources import bronze
from turnstile.sources.summaries import (
    coverage_of,
    merge_summaries,
    null_counts_of,
    profile_of,
    read_summaries,
    row_counts_of,
    save_summaries,
    summarise,
)


def table(spark, n=4000):
    return spark.range(n).selectExpr(
        "id", "cast(id % 4 as string) as day",
        "named_struct('name', if(id % 3 = 0, null, concat('n', id % 700)), 'tags', "
        "if(id % 5 = 0, null, array(id % 2))) as info",
        "if(id % 7 = 0, null, cast(id as double) / 10) as price")


def put(raw, entity, records, snap):
    path = Path(bronze.snapshot_path(str(raw), entity, snap))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(records))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def stored(spark, *summaries):
    root = f"{scratch_root(spark)}/summaries-{uuid.uuid4().hex}"
    for s in summaries:
        save_summaries(s, root)
    return root, read_summaries(spark, root)


def test_merged_counts_equal_one_pass_over_all(spark):
    df = table(spark)
    _, kept = stored(spark, summarise(df, "guests", F.col("day")))
    assert rows(coverage_of(kept)) == rows(field_coverage(df))
    assert rows(null_counts_of(kept, ["price", "info.name"])) == [
        ("info.name", 1334, False), ("price", 572, False)]
    assert rows(null_counts_of(kept, ["id"])) == rows(null_counts(df, ["id"]))
    assert rows(null_counts_of(kept, ["absent"])) == [("absent", 4000, False)]


def test_a_range_reads_its_own_snapshots(spark):
    df = table(spark)
    _, kept = stored(spark, summarise(df, "guests", F.col("day")))
    some = kept.where("snapshot_id IN ('1', '2')")
    assert rows(coverage_of(some)) == rows(field_coverage(df.where("day IN ('1', '2')")))
    by_day = coverage_of(kept, ["snapshot_id"]).where("snapshot_id = '3'").drop("snapshot_id")
    assert rows(by_day) == rows(field_coverage(df.where("day = '3'")))


def test_sketches_merge_to_close_estimates(spark):
    df = table(spark, 40_000)
    _, kept = stored(spark, summarise(df, "guests", F.col("day")))
    found = {r["path"]: r for r in profile_of(kept).collect()}
    assert abs(found["id"]["n_distinct"] - 40_000) < 0.05 * 40_000
    assert abs(found["info.name"]["n_distinct"] - 700) < 0.05 * 700
    assert found["info.name"]["quantiles"] is None
    low, first, middle, third, high = found["price"]["quantiles"]
    assert low == 0.1 and high == 3999.9
    for value, rank in ((first, 0.25), (middle, 0.5), (third, 0.75)):
        assert abs(value / 4000 - rank) < 0.03


def test_a_repeated_snapshot_replaces_its_summary(spark):
    df = table(spark)
    one = summarise(df, "guests", "s1")
    root, kept = stored(spark, one, summarise(df.limit(10), "guests", "s2"), one)
    assert rows(row_counts_of(kept)) == [("guests", "s1", 4000), ("guests", "s2", 10)]
    save_summaries(summarise(df.limit(7), "guests", "s2"), root)
    assert rows(row_counts_of(read_summaries(spark, root))) == [
        ("guests", "s1", 4000), ("guests", "s2", 7)]
    changed = row_count_changes(row_counts_of(read_summaries(spark, root))).first()
    assert changed["previous"] == 4000 and changed["passed"] is False


def test_changed_schemas_and_empty_tables(spark):
    old, new = table(spark, 30).select("id"), table(spark, 10).select("id", "price")
    _, kept = stored(spark, summarise(old, "guests", "a"), summarise(new, "guests", "b"))
    filled = 10 - 2
    assert rows(coverage_of(kept)) == [("id", 40, 1.0), ("price", filled, filled / 40)]
    nothing = summarise(old.limit(0), "guests", "c")
    assert rows(row_counts_of(nothing)) == [("guests", "c", 0)]
    assert rows(coverage_of(nothing)) == [("id", 0, 0.0)]
    assert rows(null_counts_of(nothing, ["id"])) == [("id", 0, True)]
    # Of snapshots named by a column, none is there without rows.
    unnamed = summarise(new.limit(0), "guests", F.col("id").cast("string"))
    assert rows(merge_summaries(unnamed)) == []


def test_runs_summarise_what_they_write(spark, tmp_path):
    raw, out, root = tmp_path / "raw", str(tmp_path / "tables"), str(tmp_path / "summaries")
    for snap, members in (("20260105_000000", "ab"), ("20260106_000000", "abc")):
        put(raw, "members", [{"id": m} for m in members], snap)
        build_flat_tables(spark, str(raw), out, snap, ["members"], array_files=True,
                          summary_root=root)
    kept = read_summaries(spark, root)
    assert rows(row_counts_of(kept)) == [
        ("members", "20260105_000000", 2), ("members", "20260106_000000", 3)]
    put(raw, "members", [{"id": "z"}], "20260105_000000")
    backfill(spark, str(raw), out, "2026-01-05", "2026-01-06", ["members"], array_files=True,
             summary_root=root)
    again = read_summaries(spark, root)
    assert rows(row_counts_of(again)) == [
        ("members", "20260105_000000", 1), ("members", "20260106_000000", 3)]
    assert {r["path"]: r["filled"] for r in coverage_of(again).collect()}["member_id"] == 4


def test_all_null_numbers_have_no_quantiles(spark):
    df = spark.range(5).selectExpr("cast(null as int) as x", "id")
    found = {r["path"]: r for r in profile_of(summarise(df, "e", "s")).collect()}
    assert (found["x"]["filled"], found["x"]["n_distinct"], found["x"]["quantiles"]) == (0, 0, None)
