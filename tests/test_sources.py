"""Raw snapshots, exports, manifest and a full run over them."""

import json

import pytest
from pyspark.sql import functions as F

from turnstile.operators.flatten_people import flatten_guests
from turnstile.plans.runs import (
    backfill, build_facts, build_flat_tables, out_of_date, run_snapshots,
)
from turnstile.schemas import raw_schema
from turnstile.sources import bronze, manifest, tables
from turnstile.streaming.upsert import stream_upsert, upsert_batch

SNAP = "20260211_143022"


def put(root, entity, records, snapshot=SNAP):
    path = bronze.snapshot_path(str(root), entity, snapshot)
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(records if isinstance(records, str) else json.dumps(records))


def test_array_snapshot_keeps_order_and_bad_fields_are_null(spark, tmp_path):
    put(tmp_path, "members", [
        {"id": "b", "profile": {"slug": "s"}}, {"id": "a", "profile": "oops"}, {"id": "c"}])
    rows = bronze.bronze_read(spark, str(tmp_path), "members", SNAP, array_file=True).orderBy(
        "_ord").collect()
    assert [r["id"] for r in rows] == ["b", "a", "c"]
    assert rows[0]["profile"]["slug"] == "s" and rows[1]["profile"] is None


def test_bad_lines_keep_their_text(spark, tmp_path):
    put(tmp_path, "members", '{"id": "b", "_ord": 1}\n{"id": "a", \n{"id": "c", "_ord": 3}\n')
    rows = bronze.bronze_read(spark, str(tmp_path), "members", SNAP).collect()
    assert sorted(r["id"] for r in rows if r["_corrupt_record"] is None) == ["b", "c"]
    assert [r["_corrupt_record"] for r in rows if r["_corrupt_record"]] == ['{"id": "a", ']


def test_missing_snapshot_is_empty_and_ids_are_checked(spark, tmp_path):
    assert bronze.bronze_read(spark, str(tmp_path), "members", SNAP).count() == 0
    with pytest.raises(ValueError):
        bronze.snapshot_path(str(tmp_path), "members", "2026")


def test_snapshots_newest_first(spark, tmp_path):
    for snap in ("20260101_000000", SNAP):
        put(tmp_path, "members", [{"id": "a"}], snap)
    found = bronze.snapshot_list(spark, str(tmp_path))
    assert bronze.resolve_snapshots(found) == [SNAP]
    assert bronze.resolve_snapshots(found, "all") == [SNAP, "20260101_000000"]
    with pytest.raises(ValueError):
        bronze.resolve_snapshots(found, "20200101_000000")


def test_csv_has_bom_and_reads_back(spark, tmp_path):
    df = spark.createDataFrame([("1", 'say "hi",\nthere', None), ("2", "–x", 2.5)],
                               "id string, t string, v double")
    tables.csv_export(df, f"{tmp_path}/bom")
    part = next((tmp_path / "bom").glob("part-*.csv"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbf")
    back = tables.csv_read(spark, f"{tmp_path}/bom", df.schema).orderBy("id").collect()
    assert [tuple(r) for r in back] == [("1", 'say "hi",\nthere', None), ("2", "–x", 2.5)]
    tables.csv_export(df, f"{tmp_path}/ascii", "ascii")
    assert tables.csv_read(spark, f"{tmp_path}/ascii").where("t = '-x'").count() == 1


def test_manifest_states(spark):
    run = manifest.RunManifest(spark, SNAP)
    with run.stage("a") as s:
        s.record(row_count=3)
    with run.stage("b"):
        pass
    with pytest.raises(ZeroDivisionError):
        with run.stage("c"):
            1 / 0
    row = manifest.manifest_summary(run.table()).first()
    assert (row["successful"], row["skipped"], row["failed"], row["total_records"]) == (1, 1, 1, 3)


def test_phone_answers_and_last_match(spark, tmp_path):
    answers = [{"inputName": "Phone", "value": ""}, {"inputName": "phone company", "value": "1"},
               {"inputName": "Company phone", "value": "2"}, {"inputName": "Notes", "value": "n1"},
               {"inputName": "message", "value": "n2"}]
    put(tmp_path, "guests", [
        {"id": "g", "guestDetails": {"email": "e", "formResponse": {"inputValues": answers}}},
        {"id": "h"}])
    raw = bronze.bronze_read(spark, str(tmp_path), "guests", SNAP, array_file=True)
    g, h = flatten_guests(raw).orderBy("guest_id").collect()
    assert (g["phone"], g["company"], g["guest_notes"], g["checked_in"]) == ("1", "2", "n2", False)
    assert (h["checked_in"], h["custom_field_count"], h["is_member"]) == (None, 0, False)


def test_full_run_from_raw_files(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "tables")
    put(raw, "events", [
        {"id": "e1", "title": "Jam", "registration": {"type": "TICKETING"},
         "dateAndTimeSettings": {"startDate": "2026-03-01T00:30:00Z",
                                 "timeZoneId": "America/Toronto"}},
        {"id": "e2", "title": "Old", "registration": {"type": "RSVP"}}])
    put(raw, "contacts", [{"id": "c1", "primaryInfo": {"email": "c1@x.test"},
                           "info": {"name": {"first": "Ann"}}}, {"id": "c9"}])
    put(raw, "members", [{"id": "m1", "contactId": "c1", "createdDate": "2020-01-01T00:00:00Z"}])
    put(raw, "guests", [
        {"id": "b", "eventId": "e1", "contactId": "c1", "guestType": "BUYER", "orderNumber": "o1"},
        {"id": "h1", "eventId": "e1", "contactId": "c9", "guestType": "TICKET_HOLDER",
         "orderNumber": "o1", "ticketNumber": "t1"},
        {"id": "h2", "eventId": "e1", "guestType": "TICKET_HOLDER", "orderNumber": "o1",
         "ticketNumber": "t2"},
        {"id": "r", "eventId": "e2", "guestType": "RSVP"}])
    put(raw, "ticket_definitions", [{"id": "d1", "eventId": "e1", "name": "Jam ticket",
                                     "pricingMethod": {"fixedPrice": {"value": "25.0"}}}])
    put(raw, "tickets", [{"ticketNumber": "zz", "eventId": "e1", "orderNumber": "o9"}])
    put(raw, "order_summaries", [{"event_id": "e1", "summary": {"sales": []}}])
    put(raw, "event_orders", [{"orderNumber": "o1", "eventId": "e1", "contactId": "c1"}])
    put(raw, "payments", [{"transactionId": "p1", "status": "APPROVED",
                           "createdAt": "2026-02-01T10:00:00Z", "amount": {"amount": "25"},
                           "order": {"description": {"appOrderId": "o1", "items": [
                               {"id": "i", "name": "Jam ticket", "quantity": 1}]}}}])
    run = build_flat_tables(spark, str(raw), out, SNAP, array_files=True)
    states = {r["entity"]: r["status"] for r in run.table().collect()}
    assert states["guests"] == "success" and states["coupons"] == "skipped"
    build_facts(spark, out, SNAP, run)
    fact = {r["guest_id"]: r for r in tables.table_read(spark, out, "attendance_fact", SNAP).collect()}
    assert set(fact) == {"h1", "h2"}
    assert [fact[g]["counts_as_human"] for g in ("h1", "h2")] == [True, False]
    assert fact["h1"]["identity_source"] == "buyer_overrides_holder"
    assert fact["h2"]["identity_source"] == "buyer"
    assert fact["h1"]["start_date"] == "2026-02-28" and fact["h1"]["email"] == "c1@x.test"
    assert (fact["h1"]["price_source"], fact["h1"]["price_value"]) == ("td_match", 25.0)
    paid = tables.table_read(spark, out, "payments_fact", SNAP).first()
    assert paid["enrichment_status"] == "fully_enriched" and paid["is_member"]


def test_stream_upsert_takes_only_new_files(spark, tmp_path):
    from turnstile.operators.flatten_people import flatten_members

    def flat(rows):
        return flatten_members(rows).withColumn(
            "updated_datetime", F.concat_ws(" ", "updated_date", "updated_time"))

    source, target, state = (str(tmp_path / n) for n in ("s", "t", "c"))

    def load(records):
        spark.createDataFrame(records, "id string, status string, updatedDate string, _ord bigint") \
            .write.mode("append").json(source)
        stream_upsert(spark, source, raw_schema("members"), flat, target, state, "member_id",
                      buckets=4).awaitTermination()
        return {r["member_id"]: r["status"] for r in spark.read.parquet(target).collect()}

    assert load([("a", "old", "2024-01-01T00:00:00Z", 1), ("b", "x", "2024-01-01T00:00:00Z", 2)]) \
        == {"a": "old", "b": "x"}
    assert load([("a", "new", "2024-02-01T00:00:00Z", 3), ("b", "late", "2023-01-01T00:00:00Z", 4)]) \
        == {"a": "new", "b": "x"}


def test_upsert_writes_changed_buckets_only_and_one_file_each(spark, tmp_path):
    target = str(tmp_path / "t")

    def put_batch(records):
        upsert_batch(target, spark.createDataFrame(
            records, "id string, v string, at string").repartition(3), "id", "at", 4)

    def files():
        return {str(f): f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}

    first = [(f"k{i}", "x", "2024-01-02") for i in range(60)] + [("n", "a", None), ("n", "a", None)]
    put_batch(first)
    before = files()
    assert len(before) == 4
    put_batch(first)
    put_batch([("k1", "late", "2024-01-01"), ("k2", "late", None), ("", "no key", "2025-01-01")])
    assert files() == before
    put_batch([("k1", "new", "2024-01-03"), ("k3", "late", "2023-01-01")])
    after = files()
    assert len(after) == 4 and len(before.keys() - after.keys()) == 1
    put_batch([("n", "b", None), ("k2", "tie", "2024-01-02"), ("z", "first", None)])
    rows = {r["id"]: r["v"] for r in spark.read.parquet(target).collect()}
    assert len(rows) == 62 and spark.read.parquet(target).count() == 62
    assert (rows["k1"], rows["k2"], rows["k3"], rows["n"], rows["z"]) == ("new", "tie", "x", "b", "first")


def test_stream_started_again_from_nothing_writes_nothing(spark, tmp_path):
    source, target = str(tmp_path / "s"), tmp_path / "t"
    spark.createDataFrame([("a", "1", 1), ("b", "1", 2)], "id string, at string, _ord bigint") \
        .write.json(source)
    schema = spark.createDataFrame([], "id string, at string").schema

    def run(checkpoint):
        stream_upsert(spark, source, schema, lambda rows: rows, str(target),
                      str(tmp_path / checkpoint), "id", "at", buckets=2).awaitTermination()
        return {str(f): f.stat().st_mtime_ns for f in target.rglob("*.parquet")}

    once = run("c1")
    assert once and run("c1") == once and run("c2") == once


def minimal(raw, snapshot=SNAP):
    put(raw, "events", [
        {"id": "e1", "title": "Jam", "registration": {"type": "TICKETING"}},
        {"id": "e2", "title": "Old", "registration": {"type": "RSVP"}}], snapshot)
    put(raw, "guests", [
        {"id": "h", "eventId": "e1", "guestType": "TICKET_HOLDER", "orderNumber": "o1"},
        {"id": "r", "eventId": "e2", "guestType": "RSVP"},
        {"id": "n", "guestType": "RSVP"}], snapshot)
    put(raw, "contacts", [{"id": "c1"}], snapshot)


def test_entities_without_records_are_empty_tables(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "tables")
    minimal(raw)
    put(raw, "tickets", [])
    run, = run_snapshots(spark, str(raw), out, "latest", array_files=True)
    assert run.failed() == set()
    fact = tables.table_read(spark, out, "attendance_fact", SNAP)
    assert sorted(r["guest_id"] for r in fact.collect()) == ["h", "n"]
    assert run.table().where("entity = 'payments_fact'").first()["row_count"] == 0


def test_no_fact_from_a_failed_entity(spark, tmp_path):
    run = manifest.RunManifest(spark, SNAP)
    with pytest.raises(KeyError), run.stage("guests"):
        raise KeyError("broken")
    with pytest.raises(RuntimeError, match="guests"):
        build_facts(spark, str(tmp_path), SNAP, run)


def test_backfill_takes_the_steps_of_a_first_run(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "tables")
    for snap in ("20260101_000000", "20260105_000000", SNAP):
        minimal(raw, snap)
    entities = ["events", "guests"]
    build_flat_tables(spark, str(raw), out, "20260105_000000", entities, array_files=True)
    before = sorted(map(str, tables.table_read(spark, out, "guests", "20260105_000000").collect()))
    runs = backfill(spark, str(raw), out, "2026-01-02", "2026-02-01", entities, array_files=True)
    assert [r.snapshot for r in runs] == ["20260105_000000"]
    after = sorted(map(str, tables.table_read(spark, out, "guests", "20260105_000000").collect()))
    assert after == before and len(after) == 2
    assert tables.table_read(spark, out, "rsvp_events", "20260105_000000").count() == 1
    assert bronze.snapshot_ids(spark, str(raw), "guests", "2026-01-01", "2026-03-01") == [
        "20260101_000000", "20260105_000000", SNAP]


def test_backfill_rebuilds_what_is_out_of_date_and_nothing_else(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "tables")
    for snap, entities in (("20260105_000000", ["events", "guests", "contacts"]), (SNAP, ["guests"])):
        minimal(raw, snap)
        build_flat_tables(spark, str(raw), out, snap, entities, array_files=True)

    def files():
        return {str(f.relative_to(out)): f.stat().st_mtime_ns
                for f in (tmp_path / "tables").rglob("*.parquet")}

    before = files()
    backfill(spark, str(raw), out, "2026-01-05", "2026-01-06", ["guests"], array_files=True)
    after = files()
    touched = {name for name in before.keys() | after.keys() if before.get(name) != after.get(name)}
    assert {name.split("/")[0] for name in touched} == {"guests", "attendance_fact"}
    assert all("20260105_000000" in name for name in touched)
    assert tables.table_read(spark, out, "attendance_fact", "20260105_000000").count() == 2
    assert out_of_date(["contacts"]) == (
        ["contacts", "guests"], ["attendance_fact", "payments_fact"])
    assert out_of_date(["ticket_definitions"])[0] == ["ticket_definitions", "tickets"]
    assert out_of_date(["coupons"]) == (["coupons"], [])


def test_unreadable_lines_are_set_aside_and_counted(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "tables")
    put(raw, "members", '{"id": "b", "_ord": 1}\n{"id": "a", \n{"id": "c", "_ord": 3}\n')
    run = build_flat_tables(spark, str(raw), out, SNAP, ["members"])
    ids = [r["member_id"] for r in tables.table_read(spark, out, "members", SNAP).collect()]
    assert sorted(ids) == ["b", "c"]
    row = run.table().first()
    assert (row["row_count"], row["extra_paths"]["rejected_rows"]) == (2, "1")
    rejects = tables.table_read(spark, out, "rejects_members", SNAP).collect()
    assert [r["_corrupt_record"] for r in rejects] == ['{"id": "a", ']


def test_source_field_names_are_mapped(spark, tmp_path):
    put(tmp_path, "payments", [{"transactionId": "p1", "order": {"description": {"linkA": "o1"}}}])
    row = bronze.bronze_read(spark, str(tmp_path), "payments", SNAP, array_file=True,
                             names={"order.description.appOrderId": "linkA"}).first()
    assert row["order"]["description"]["appOrderId"] == "o1"


def test_array_snapshot_becomes_lines_in_the_same_order(spark, tmp_path):
    put(tmp_path / "raw", "members", [{"id": i} for i in "cab"])
    bronze.array_to_lines(spark, str(tmp_path / "raw"), "members", SNAP, str(tmp_path / "lines"))
    rows = bronze.bronze_read(spark, str(tmp_path / "lines"), "members", SNAP).orderBy("_ord")
    assert [r["id"] for r in rows.collect()] == list("cab")


def test_names_that_look_missing_survive_csv(spark, tmp_path):
    df = spark.createDataFrame([("None", 1.0), ("NA", None), (None, 2.0)], "name string, v double")
    tables.csv_export(df, str(tmp_path / "c"))
    for line_breaks in (True, False):
        back = tables.csv_read(spark, str(tmp_path / "c"), df.schema, line_breaks)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_unreadable_target_is_not_replaced(spark, tmp_path):
    target = tmp_path / "t" / "buckets=4" / "bucket=0"
    target.mkdir(parents=True)
    (target / "part-0.parquet").write_text("not parquet")
    batch = spark.createDataFrame([("a", "1")], "id string, at string")
    with pytest.raises(Exception):
        upsert_batch(str(tmp_path / "t"), batch, "id", "at")
    assert [p.name for p in target.iterdir()] == ["part-0.parquet"]
