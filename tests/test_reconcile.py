"""Exports compared as multisets."""

import random
from collections import Counter

from turnstile.operators.reconcile import compare_exports


def frames(spark, *sides):
    return [spark.createDataFrame(rows, "k string, s string") for rows in sides]


def test_differences_equal_those_of_counters(spark):
    rng = random.Random(4)

    def export():
        rows = [(f"k{rng.randrange(300)}", rng.choice(["PAID", "DUE", None])) for _ in range(900)]
        return rows + [("hot", "PAID")] * rng.randrange(400, 500) + [("", "PAID"), (None, "DUE")]

    shared = [(f"s{i}", "PAID") for i in range(2000)]
    left, right = export() + shared, shared[::-1] + export()
    counts, rows = compare_exports(*frames(spark, left, right), "k", "s", 64)
    a, b = (Counter(r for r in side if r[0]) for side in (left, right))
    want = {r: (a[r], b[r]) for r in a.keys() | b.keys() if a[r] != b[r]}
    assert {(r["key"], r["status"]): (r["n_left"], r["n_right"]) for r in rows.collect()} == want
    for r in counts.collect():
        keys = [x for x in a.keys() | b.keys() if x[1] == r["status"]]
        assert tuple(r)[1:] == (
            sum(a[x] for x in keys), sum(b[x] for x in keys), sum((a & b)[x] for x in keys),
            sum((a - b)[x] for x in keys), sum((b - a)[x] for x in keys))
    assert {r["status"] for r in counts.collect()} == {"PAID", "DUE", None}


def test_equal_and_empty_exports(spark):
    rows = [("a", "1"), ("a", "1"), ("b", None)]
    counts, differences = compare_exports(*frames(spark, rows, rows[::-1]), "k", "s")
    assert differences.count() == 0
    assert sorted((r["status"] or "", r["in_both"], r["left_only"]) for r in counts.collect()) == [
        ("", 1, 0), ("1", 2, 0)]
    counts, differences = compare_exports(*frames(spark, [], rows), "k", "s")
    assert differences.count() == 2 and sum(r["right_only"] for r in counts.collect()) == 3
    counts, differences = compare_exports(*frames(spark, [], []), "k", "s")
    assert counts.count() == 0 and differences.count() == 0
