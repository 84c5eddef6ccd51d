"""Array files cut into records, against the json module."""

import json
import random

import pytest
from pyspark.sql import types as T

from turnstile.sources import arrays, bronze


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "256")
    yield
    for n, value in zip(names, old):
        spark.conf.set(n, value)


def value(rng, depth):
    kind = rng.randrange(6 if depth else 3)
    if kind == 0:
        return "".join(rng.choice('ab}{][",:\\\n\té–') for _ in range(rng.randrange(30)))
    if kind == 1:
        return rng.randrange(100)
    if kind == 2:
        return None
    if kind == 3:
        return [value(rng, depth - 1) for _ in range(rng.randrange(3))]
    return {rng.choice(["k}", 'q"', "z", "\\"]): value(rng, depth - 1) for _ in range(rng.randrange(3))}


def texts(spark, path):
    rows = arrays.record_texts(spark, str(path)).orderBy("file", "position").collect()
    return [r["position"] for r in rows], [json.loads(r["text"]) for r in rows]


@pytest.mark.parametrize("seed,indent", [(1, None), (2, 2)])
def test_records_equal_those_of_the_json_module(spark, tmp_path, small_splits, seed, indent):
    rng = random.Random(seed)
    records = [{"id": i, "v": value(rng, 3)} for i in range(150)] + [{}]
    (tmp_path / "a.json").write_text(
        json.dumps(records, indent=indent, ensure_ascii=False), encoding="utf-8")
    assert spark.read.text(str(tmp_path / "a.json")).rdd.getNumPartitions() > 8
    positions, found = texts(spark, tmp_path / "a.json")
    assert found == records and positions == list(range(len(records)))


def test_odd_files(spark, tmp_path):
    cases = {"a": ("[]", []), "b": ("", []), "c": ('{"x": "}"}\n', [{"x": "}"}]),
             "d": ('﻿[ {"x": 1} , {"x": {}} ]', [{"x": 1}, {"x": {}}]),
             "e": ('[{"x": 1}, {"x": 2', [{"x": 1}]), "f": ('{"x": 1}\n{"x": 2}', [{"x": 1}, {"x": 2}])}
    for name, (text, _) in cases.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    rows = arrays.record_texts(spark, str(tmp_path)).orderBy("file", "position").collect()
    for name, (_, want) in cases.items():
        mine = [r for r in rows if r["file"].endswith(f"/{name}.json")]
        assert [json.loads(r["text"]) for r in mine] == want, name
        assert [r["position"] for r in mine] == list(range(len(want)))


def test_large_array_snapshots_take_the_split_path(spark, tmp_path, small_splits):
    rng = random.Random(3)
    records = [{"id": f"m{i}", "profile": "oops" if i % 7 == 0 else {"slug": value(rng, 0) or "s"}}
               for i in range(80)]
    path = tmp_path / "members" / "year=2026" / "month=02" / "day=11"
    path.mkdir(parents=True)
    (path / "snapshot_20260211_143022.json").write_text(json.dumps(records))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField(
        "profile", T.StructType([T.StructField("slug", T.StringType())]))])

    def read():
        rows = bronze.bronze_read(spark, str(tmp_path), "members", "20260211_143022", schema,
                                  array_file=True)
        return rows.columns, sorted(map(str, rows.collect()))

    split = read()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    assert read() == split and len(split[1]) == 80
