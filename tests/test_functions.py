from pyspark.sql import Row, functions as F

from turnstile import functions as fn
from turnstile.functions.richtext import rich_text
from turnstile.functions.similarity import indel_ratio, sorted_tokens


def values(spark, rows, *exprs):
    df = spark.createDataFrame(rows)
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_split_iso_shapes(spark):
    cases = [
        ("2025-10-12T17:00:00Z", "America/New_York", ("2025-10-12", "13:00:00")),
        ("2025-03-09T06:59:59Z", "America/New_York", ("2025-03-09", "01:59:59")),
        ("2025-03-09T07:00:00Z", "America/New_York", ("2025-03-09", "03:00:00")),
        ("2025-10-12T02:00:00Z", "America/New_York", ("2025-10-11", "22:00:00")),
        ("2025-10-12T17:00:00", "America/New_York", ("2025-10-12", "17:00:00")),
        ("2025-10-12T17:00:00.123Z", None, ("2025-10-12", "17:00:00")),
        ("2025-10-12T17:00:00.123456Z", "", ("2025-10-12", "17:00:00")),
        ("2025-10-12T17:00:00.1234567Z", None, ("2025-10-12T17:00:00.1234567Z", None)),
        ("2025-10-12T17:00:00+02:00", None, ("2025-10-12T17:00:00+02:00", None)),
        ("2025-10-12T17:00:00Z", "Mars/Base", ("2025-10-12", "17:00:00")),
        ("2025-02-30T17:00:00Z", None, ("2025-02-30T17:00:00Z", None)),
        ("2025-10-12", "America/New_York", ("2025-10-12", None)),
        ("", None, ("", None)),
        (None, "America/New_York", (None, None)),
    ]
    df = spark.createDataFrame([(t, z) for t, z, _ in cases], "t string, z string")
    got = df.select(*fn.split_iso(F.col("t"), F.col("z"))).collect()
    assert [tuple(r) for r in got] == [want for _, _, want in cases]


def test_split_iso_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2025-03-09T02:30:00Z",)], "t string")
        assert tuple(df.select(*fn.split_iso(F.col("t"))).first()) == ("2025-03-09", "02:30:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_every_known_zone_converts(spark):
    from turnstile.functions.dates import known_zones

    df = spark.createDataFrame([("2025-10-12T17:00:00Z", z) for z in known_zones()], "t string, z string")
    times = df.select(fn.split_iso(F.col("t"), F.col("z"))[1].alias("x"))
    assert times.where("x IS NULL").count() == 0


def test_zones_outside_the_regions_convert(spark):
    rows = [("2025-07-12T17:00:00Z", z) for z in ("Japan", "EST5EDT", "Brazil/East", "Nowhere/X")]
    df = spark.createDataFrame(rows, "t string, z string")
    found = {r["z"]: r["x"] for r in df.select("z", fn.split_iso(F.col("t"), F.col("z"))[1].alias(
        "x")).collect()}
    assert found == {"Japan": "02:00:00", "EST5EDT": "13:00:00", "Brazil/East": "14:00:00",
                     "Nowhere/X": "17:00:00"}


def test_last_of_equal_keys_wins(spark):
    from turnstile.operators.shaping import last_entries

    entries = [("b", "1"), ("a", "2"), ("b", "3"), ("c", None), ("a", "4")]
    df = spark.createDataFrame([(entries,), ([],)], "e array<struct<key:string,value:string>>")
    found = [r[0] for r in df.select(last_entries(F.col("e"))).collect()]
    assert found == [{"a": "4", "b": "3", "c": None}, {}]


def test_wide_export_of_many_keys(spark):
    from turnstile.operators.flatten_forms import pivot_submissions

    df = spark.sql("SELECT 's' AS submission_id, map_from_arrays("
                   "transform(sequence(1, 2500), i -> concat('field_', i)), "
                   "transform(sequence(1, 2500), i -> string(i))) AS fields")
    row = pivot_submissions(df).first()
    assert len(row) == 2501 and row["field_2500"] == "2500"


def test_rich_text_of_any_depth(spark):
    import json

    from turnstile.functions.richtext import rich_text

    doc = {"type": "TEXT", "textData": {"text": "deep"}}
    for level in range(400):
        doc = {"type": "P", "nodes": [doc, {"type": "TEXT", "textData": {"text": str(level)}}]}
    too_deep = '{"nodes":[' * 200_000
    df = spark.createDataFrame([(json.dumps({"nodes": [doc]}),), (too_deep,)], "d string")
    first, second = (r[0] for r in df.select(rich_text(F.col("d"))).collect())
    assert first == " ".join(["deep", *map(str, range(400))]) and second is None


def test_orders_without_event_are_part_of_the_total(spark):
    from turnstile.plans.reports import sales_summary

    df = spark.createDataFrame([("e", 2, "5"), (None, 3, "7")],
                               "event_id string, tickets_quantity int, total string")
    found = sorted((r["overall"], r["event_id"] or "", r["total_orders"], r["total_tickets"])
                   for r in sales_summary(df).collect())
    assert found == [(False, "", 1, 3), (False, "e", 1, 2), (True, "", 2, 5)]


def test_tri_state_bool(spark):
    words = {"true": True, " YES ": True, "0": False, "No": False, "": None, "NaN": None,
             "null": None, "maybe": True}
    got = values(spark, [Row(w=w) for w in words], fn.safe_bool(F.col("w")))
    assert [g[0] for g in got] == list(words.values())


def test_numbers(spark):
    rows = [Row(w=w) for w in ("12.9", "-3.7", "nan", "", "abc", " 7 ")]
    got = values(spark, rows, fn.safe_float(F.col("w")), fn.safe_int(F.col("w")))
    assert got == [(12.9, 12), (-3.7, -3), (None, None), (None, None), (None, None), (7.0, 7)]


def test_bands(spark):
    rows = [Row(v=v, f=f) for v, f in (
        (0.0, None), (-1.0, False), (24.99, None), (25.0, None), (99.0, True), (100.0, None))]
    got = values(spark, rows, fn.bucket_price(F.col("v"), F.col("f")), fn.bucket_amount(F.col("v")))
    assert got == [("Free", "Free"), ("0-25", "0-25"), ("0-25", "0-25"), ("25-50", "25-50"),
                   ("Free", "50-100"), ("100+", "100-250")]


def test_labels(spark):
    rows = [Row(s="SOME_NEW", a=10.0, r=None), Row(s="APPROVED", a=10.0, r=4.0),
            Row(s="APPROVED", a=10.0, r=10.0), Row(s="APPROVED", a=0.0, r=4.0),
            Row(s="APPROVED", a=10.0, r=None), Row(s=None, a=1.0, r=1.0)]
    df = spark.createDataFrame(rows, "s string, a double, r double")
    got = [r[0] for r in df.select(fn.status_label(F.col("s"), F.col("a"), F.col("r"))).collect()]
    assert got == ["Some_New", "Partially refunded", "Refunded", "Partially refunded",
                   "Successful", None]


def test_fold_ascii_keeps_other_characters(spark):
    text = "“é–è” à b… ñ"
    assert values(spark, [Row(t=text)], fn.fold_ascii(F.col("t"))) == [('"e-e" a b... ñ',)]


def test_rich_text_depth_blanks_and_other_nodes(spark):
    doc = (
        '{"nodes":[{"type":"P","nodes":[{"type":"TEXT","textData":{"text":" a "}},'
        '{"type":"LIST","nodes":[{"type":"ITEM","nodes":[{"type":"TEXT","textData":{"text":"b"}},'
        '{"type":"TEXT","textData":{"text":""}}]}]}]},{"type":"IMAGE","textData":{"text":"no"}}]}')
    df = spark.createDataFrame([(doc,), ("{}",), ("not json",), (None,)], "d string")
    assert [r[0] for r in df.select(rich_text(F.col("d"))).collect()] == ["a  b", None, None, None]


def test_token_sort_ratio(spark):
    rows = [Row(a="Mary Ann Lee", b="lee mary ann"), Row(a="jon smth", b="john smith")]
    a, b = sorted_tokens(F.lower("a")), sorted_tokens(F.lower("b"))
    got = [r[0] for r in values(spark, rows, indel_ratio(a, b))]
    assert got[0] == 100.0 and abs(got[1] - 100 * 16 / 18) < 1e-9
