"""How tables that grow with the data are joined."""

from catalog.base import Lake
from catalog.gold import attendance_fact, payments_fact
from turnstile.operators import dims, headcount, orders
from turnstile.plans import views
from turnstile.session import stage
from turnstile.sources import star


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark):
    baskets = stage(spark.createDataFrame(
        [("e1", "red rod, blue bolt"), ("e2", "red rod")], "event_id string, product_name string"),
        "baskets")
    definitions = stage(spark.createDataFrame(
        [("e1", "red rod", 1), ("e2", "old", 2)], "event_id string, name string, _ord long").selectExpr(
        "*", "1.0 AS fixed_price_value", "'x' AS pricing_type", "1L AS initial_limit",
        "1L AS actual_limit", "1L AS limit_per_checkout"), "definitions")
    return baskets, definitions


def test_definitions_are_matched_without_broadcast(spark):
    # Compressed files of a few megabytes hold millions of text pieces.
    found = dims.match_ticket_definitions(*tables(spark))
    assert "Broadcast" not in plan(found)
    assert [(r["_td_event"], r["td_name"]) for r in found.collect()] == [("e1", "red rod")]


def test_stubs_are_counted_without_broadcast(spark):
    guests = stage(spark.createDataFrame(
        [("g1", "TICKET_HOLDER", "1", 1), ("g2", "TICKET_HOLDER", "1", 2), ("b", "BUYER", "1", 0)],
        "guest_id string, guest_type string, order_number string, _ord long").selectExpr(
        "*", "'e' AS event_id", "'c' AS contact_id", "'t' || guest_id AS ticket_number",
        *[f"CAST(NULL AS STRING) AS {c}" for c in (
            "primary_ticket_number", "primary_ticket_definition_id", "primary_ticket_name",
            "attendance_status", "order_status", "first_name", "last_name", "full_name", "email",
            "phone", "created_date", "created_time", "member_id")],
        "FALSE AS checked_in", "FALSE AS is_member"), "guests")
    payments = stage(spark.createDataFrame(
        [("1", "APPROVED", 1, "p", "2024-01-01", 1)],
        "app_order_id string, status string, total_quantity long, product_name string, "
        "payment_datetime string, _ord long"), "payments")
    stubs = headcount.ticket_stubs(guests, orders.order_context(guests, payments))
    counted = headcount.count_people(stage(stubs, "kept"))
    assert "Broadcast" not in plan(stubs) and "Broadcast" not in plan(counted)
    assert sorted((r["guest_id"], r["is_paid_ticket_stub"], r["counts_as_human"])
                  for r in counted.collect()) == [("g1", True, True), ("g2", False, False)]


def hot_guests(spark, n=30_000):
    """Guests of whom most have contact ``0``."""
    return spark.range(n).selectExpr(
        "concat('g', id) AS guest_id", "IF(id % 10 < 9, '0', CAST(id AS STRING)) AS contact_id",
        "CAST(id % 50 AS STRING) AS event_id", "id AS _ord", "sha2(CAST(id AS STRING), 256) AS pad")


def test_hot_contact_is_split(spark):
    contacts = spark.range(30_000).selectExpr(
        "CAST(id AS STRING) AS contact_id", "concat('name ', id) AS full_name",
        "'x@y' AS primary_email", "TRUE AS is_member", "id AS _ord")
    events = spark.range(50).selectExpr(
        "CAST(id AS STRING) AS event_id", "concat('event ', id) AS title", "'2024' AS start_date",
        "'c' AS category_names", "id AS _ord")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        wide = views.guests_enriched(hot_guests(spark).repartition(8), contacts, events)
        rows = wide.collect()
        final = plan(wide)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in final
    assert len(rows) == 30_000
    assert all(r["contact_full_name"] == f"name {r['contact_id']}" for r in rows)


def test_guests_are_dealt_out_once(spark):
    sf = "/root/testdata/sf0.001"
    guests = star.entity(spark, sf, "t_guest").where("guest_type <> 'BUYER'").hint("merge")
    text = plan(guests)
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1
    assert "hashpartitioning(l_orderkey#" in text and "l_linenumber" not in "".join(
        line for line in text.split("\n") if "Exchange" in line)


def test_single_reads_leave_out_branches(spark):
    lake = Lake(spark, "/root/testdata/sf0.001")
    text = plan(lake.once("t_guest").where("guest_type = 'BUYER'").select("guest_id"))
    assert "lineitem" not in text


def test_payments_are_joined_by_shuffle(spark):
    lake = Lake(spark, "/root/testdata/sf0.001")
    assert "Broadcast" not in plan(payments_fact(lake))


def test_wide_stubs_are_shuffled_once(spark):
    # Dimensions are looked up by row number; the events (broadcast here) are joined last.
    fact = attendance_fact(Lake(spark, "/root/testdata/sf0.001"))
    formatted = spark._jvm.PythonSQLUtils.explainString(fact._jdf.queryExecution(), "formatted")
    exchanges = [b for b in formatted.split("\n\n") if "Exchange" in b.split("\n")[0]]
    assert len(exchanges) > 5
    assert sum("attendance_status#" in b for b in exchanges) == 1
