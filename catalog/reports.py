"""Reports, views, filters, unions and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from catalog import gold
from catalog.base import Lake, query
from catalog.gold_sql import (
    ATTENDANCE_ENTITIES,
    PAYMENTS_CTE,
    PAYMENTS_ENTITIES,
    attendance_ctes,
)
from turnstile.functions.values import midpoint_price
from turnstile.operators import enrich, filters, flatten_forms, flatten_people, tidy
from turnstile.operators.reconcile import compare_exports
from turnstile.operators.shaping import conform
from turnstile.plans import reports, views
from turnstile.schemas import raw_schema

def stored(lake: Lake, name: str):
    """A fact written once per session and data folder, as reports read it from a table."""
    return lake.stored(name, lambda: getattr(gold, name)(lake))


def on_attendance(name: str, sql: str):
    def wrap(fn):
        return query(name, attendance_ctes() + sql, ATTENDANCE_ENTITIES)(
            lambda lake: fn(stored(lake, "attendance_fact")))
    return wrap


def on_payments(name: str, sql: str):
    def wrap(fn):
        return query(name, PAYMENTS_CTE + sql, PAYMENTS_ENTITIES)(
            lambda lake: fn(stored(lake, "payments_fact")))
    return wrap


MONEY = "CAST(sum(CAST({0} AS DECIMAL(18,4))) AS DOUBLE)"
AMOUNT = MONEY.format("amount")

on_attendance("q1_popular_categories", """
    SELECT split_part(category_names, ',', 1) AS primary_cat, count(*) AS attendees
    FROM attendance_fact GROUP BY 1""")(reports.popular_categories)
on_attendance("q2_comp_usage", """
    SELECT is_member, free, count(*) AS stubs FROM attendance_fact
    WHERE order_status IS NOT NULL GROUP BY 1, 2""")(reports.comp_usage)
on_attendance("q3_repeat_guests", """
    SELECT email, count(DISTINCT event_id) AS events_attended FROM attendance_fact
    GROUP BY email HAVING count(DISTINCT event_id) >= 3""")(reports.repeat_guests)
on_attendance("q4_category_guests", """
    SELECT full_name, email, event_title, start_date, paid_bucket FROM attendance_fact
    WHERE category_names LIKE '%ASIA%' AND start_date >= '2024-02-01'""")(
    lambda fact: reports.category_guests(fact, "%ASIA%", "2024-02-01"))
on_payments("q5_top_events_by_revenue", f"""
    SELECT event_title, {AMOUNT} AS revenue, count(*) AS payment_count FROM payments_fact
    WHERE transaction_status = 'Successful' GROUP BY 1
    ORDER BY revenue DESC, event_title NULLS FIRST LIMIT 10""")(reports.top_events_by_revenue)
on_payments("q6_revenue_by_category", f"""
    SELECT category_names, count(*) AS payments, {AMOUNT} AS gross FROM payments_fact
    WHERE transaction_status = 'Successful' GROUP BY 1""")(reports.revenue_by_category)
on_payments("q7_member_spend", f"""
    SELECT is_member, count(*) AS payments, {AMOUNT} AS gross,
           {AMOUNT} / count(amount) AS avg_ticket FROM payments_fact
    WHERE transaction_status = 'Successful' GROUP BY 1""")(reports.member_spend)
on_payments("q8_repeat_buyers", f"""
    SELECT email, count(DISTINCT event_id) AS events, {AMOUNT} AS lifetime_value
    FROM payments_fact WHERE transaction_status = 'Successful' AND category_names LIKE '%A%'
    GROUP BY 1 HAVING count(DISTINCT event_id) >= 3""")(
    lambda fact: reports.repeat_buyers(fact, "%A%"))
on_payments("q9_refund_monitor", f"""
    SELECT event_title, transaction_status, count(*) AS payments,
           {MONEY.format('refund_total_amount')} AS refunded FROM payments_fact
    WHERE transaction_status IN ('Refunded', 'Partially refunded', 'Chargeback')
    GROUP BY 1, 2""")(reports.refund_monitor)
on_payments("q10_weekday_revenue", f"""
    SELECT event_day_of_week, count(*) AS payments, {AMOUNT} AS gross FROM payments_fact
    WHERE transaction_status = 'Successful' GROUP BY 1""")(reports.weekday_revenue)
on_attendance("q12_canonical_headcount", """
    SELECT event_id, count(*) AS people FROM attendance_fact WHERE counts_as_human GROUP BY 1
    """)(reports.canonical_headcount)
on_attendance("x12_x13_price_source", """
    SELECT price_source, price_currency, free, paid_bucket, count(*) AS stubs
    FROM attendance_fact GROUP BY ALL""")(
    lambda f: f.groupBy("price_source", "price_currency", "free", "paid_bucket").agg(
        F.count("*").alias("stubs")))
on_attendance("x14_x15_identity_and_members", """
    SELECT identity_source, is_member, member_id IS NULL AS no_member_id, count(*) AS stubs
    FROM attendance_fact GROUP BY ALL""")(
    lambda f: f.groupBy("identity_source", "is_member",
                        F.col("member_id").isNull().alias("no_member_id")).agg(
        F.count("*").alias("stubs")))


@query("q11_sold_by_definition", """
    SELECT p_name AS name, CAST(p_size * 3 AS BIGINT) AS sold_count FROM part""")
def _(lake):
    from turnstile.operators.flatten_sales import flatten_ticket_definitions
    from turnstile.session import scratch_root
    from turnstile.sources.bronze import bronze_range, bronze_write
    import uuid

    raw = lake.sql("""SELECT CAST(p_partkey AS STRING) AS id, p_name AS name,
        named_struct('soldCount', p_size * 3) AS salesDetails, p_partkey AS _ord FROM {part}""")
    root = f"{scratch_root(lake.spark)}/raw-{uuid.uuid4().hex}"
    bronze_write(raw, root, "ticket_definitions", "20260211_143022")
    found = bronze_range(lake.spark, root, "ticket_definitions", "2026-01-01", "2027-01-01")
    return reports.sold_by_definition(flatten_ticket_definitions(found))


@query("j9_ticket_sales_view", """
    SELECT g.order_number, g.ticket_number, guest_id, guest_type, g.created_date AS order_date,
      g.created_time AS order_time, coalesce(c.first_name, g.first_name) AS buyer_first_name,
      coalesce(c.last_name, g.last_name) AS buyer_last_name,
      coalesce(c.primary_email, g.email) AS buyer_email, e.title AS event_name, g.event_id,
      e.start_date AS event_start_date, e.start_time AS event_start_time,
      e.end_date AS event_end_date, e.end_time AS event_end_time, e.timezone AS event_timezone,
      e.location_name AS event_location, e.location_city AS event_city,
      e.status AS event_status, e.currency, e.lowest_price AS ticket_price_low,
      e.highest_price AS ticket_price_high,
      CASE WHEN e.event_id IS NOT NULL THEN round_even((coalesce(e.lowest_price, 0)
        + coalesce(e.highest_price, 0)) / 2, 2) END AS estimated_ticket_price,
      attendance_status, checked_in, g.contact_id
    FROM t_guest g LEFT JOIN t_contact c ON g.contact_id = c.contact_id
    LEFT JOIN t_event e ON g.event_id = e.event_id""", "t_guest t_contact t_event")
def _(lake):
    return views.ticket_sales_view(lake.once("t_guest"), lake.t_contact, lake.t_event)


@query("l1_first_ticket_sales", """
    SELECT guest_id, g.created_date AS order_date, e.title AS event_name
    FROM t_guest g LEFT JOIN t_event e ON g.event_id = e.event_id
    ORDER BY order_date DESC NULLS LAST, event_name NULLS LAST, guest_id LIMIT 100
    """, "t_guest t_event")
def _(lake):
    return views.ticket_sales_view(lake.once("t_guest"), lake.t_contact, lake.t_event).limit(100).select(
        "guest_id", "order_date", "event_name")


@query("x10_midpoint_price", """
    SELECT event_id, round_even((coalesce(lowest_price, 0) + coalesce(highest_price, 0)) / 2, 2)
        AS estimate FROM t_event""", "t_event")
def _(lake):
    return lake.t_event.select(
        "event_id", midpoint_price(F.col("lowest_price"), F.col("highest_price")).alias("estimate"))


ENRICHED = """
    , enriched AS (SELECT g.*, c.full_name AS contact_full_name,
        c.primary_email AS contact_primary_email, c.is_member AS contact_is_member,
        e.title AS event_title, e.start_date AS event_start_date,
        e.category_names AS event_category_names
      FROM t_guest g LEFT JOIN t_contact c ON g.contact_id = c.contact_id
      LEFT JOIN t_event e ON g.event_id = e.event_id)"""


def enriched(lake):
    return views.guests_enriched(lake.once("t_guest"), lake.t_contact, lake.t_event)


@query("a18_guests_enriched", ENRICHED + "SELECT * FROM enriched", "t_guest t_contact t_event")
def _(lake):
    return enriched(lake)


@query("p4_find_contact_events", ENRICHED + """
    SELECT DISTINCT contact_full_name, contact_primary_email, event_title, event_start_date,
      guest_type, order_number FROM enriched
    WHERE contact_primary_email ILIKE '%7@X.test%' OR contact_full_name ILIKE '%7@X.test%'
    """, "t_guest t_contact t_event")
def _(lake):
    return filters.contact_events(enriched(lake), "7@X.test")


@query("p4_find_event_attendees", ENRICHED + """
    SELECT DISTINCT event_title, event_start_date, contact_full_name, contact_primary_email,
      guest_type, attendance_status FROM enriched WHERE event_title ILIKE '%7%'
    """, "t_guest t_contact t_event")
def _(lake):
    return filters.event_attendees(enriched(lake), "R#[0-9]*7")


@query("p4_find_category_attendees", ENRICHED + """
    SELECT DISTINCT contact_full_name, contact_primary_email, contact_is_member FROM enriched
    WHERE event_category_names ILIKE '%europe%'""", "t_guest t_contact t_event")
def _(lake):
    return filters.category_attendees(enriched(lake), "europe")


HISTORY = """
    , history AS (SELECT c.contact_id, c.full_name, c.primary_email, c.is_member,
        count(DISTINCT g.event_id) AS unique_events_count, count(g.guest_id) AS total_attendances
      FROM t_contact c LEFT JOIN t_guest g ON c.contact_id = g.contact_id GROUP BY ALL)"""
SEEN = """
    , seen AS (SELECT e.event_id, e.title, e.start_date, e.status, e.category_names,
        count(g.guest_id) AS total_guests, count(DISTINCT g.contact_id) AS unique_contacts,
        count(*) FILTER (g.guest_type = 'BUYER') AS buyer_count,
        count(*) FILTER (g.guest_type = 'TICKET_HOLDER') AS ticket_holder_count
      FROM t_event e LEFT JOIN t_guest g ON e.event_id = g.event_id GROUP BY ALL)"""


def on_history(name: str, sql: str):
    def wrap(fn):
        return query(name, HISTORY + sql, "t_contact t_guest")(
            lambda lake: fn(views.contact_event_history(lake.t_contact, lake.once("t_guest"))))
    return wrap


def on_seen(name: str, sql: str):
    def wrap(fn):
        return query(name, SEEN + sql, "t_event t_guest")(
            lambda lake: fn(views.event_attendance(lake.t_event, lake.once("t_guest"))))
    return wrap


on_history("a16_contact_event_history", "SELECT * FROM history")(lambda h: h)
on_history("a19_repeat_attendees", """
    SELECT contact_id, full_name, primary_email, unique_events_count, total_attendances, is_member
    FROM history WHERE unique_events_count > 1
    ORDER BY unique_events_count DESC, contact_id LIMIT 20""")(reports.repeat_attendees)
on_history("a20_attendance_histogram", """
    SELECT unique_events_count, count(*) AS contacts FROM history GROUP BY 1""")(
    reports.attendance_histogram)
on_history("a20_attendance_buckets", """
    SELECT count(*) FILTER (unique_events_count = 0) AS none,
      count(*) FILTER (unique_events_count = 1) AS one,
      count(*) FILTER (unique_events_count >= 2) AS two_plus,
      count(*) FILTER (unique_events_count >= 5) AS five_plus,
      count(*) FILTER (unique_events_count >= 10) AS ten_plus FROM history""")(
    reports.attendance_buckets)
on_history("a22_member_stats", """
    SELECT is_member, count(*) AS contact_count,
      CAST(sum(unique_events_count) AS BIGINT) AS total_unique_events,
      round_even(sum(unique_events_count) / count(*), 2) AS avg_unique_events,
      CAST(sum(total_attendances) AS BIGINT) AS total_attendances,
      round_even(sum(total_attendances) / count(*), 2) AS avg_attendances
    FROM history GROUP BY 1""")(reports.member_stats)
on_seen("a17_event_attendance", "SELECT * FROM seen")(lambda s: s)
on_seen("l3_popular_events", """
    SELECT event_id, title, start_date, total_guests, unique_contacts, buyer_count,
      ticket_holder_count FROM seen ORDER BY total_guests DESC, event_id LIMIT 20""")(
    reports.popular_events)
@query("p5_empty_events", """
    SELECT event_id, title, start_date, status FROM t_event
    WHERE event_id NOT IN (SELECT event_id FROM t_guest
      WHERE created_date = '1996-03-02' AND event_id IS NOT NULL)""", "t_event t_guest")
def _(lake):
    # Over the whole time every event of the test data has guests, but not on each day.
    one_day = lake.once("t_guest").where("created_date = '1996-03-02'")
    return reports.empty_events(views.event_attendance(lake.t_event, one_day))


on_seen("a21_category_stats", """
    SELECT category_names, count(*) AS event_count,
      CAST(sum(total_guests) AS BIGINT) AS total_attendances,
      CAST(sum(unique_contacts) AS BIGINT) AS total_unique_contacts,
      round_even(sum(total_guests) / count(*), 1) AS avg_attendance FROM seen
    WHERE category_names IS NOT NULL GROUP BY 1""")(reports.category_stats)
on_seen("a23_monthly_attendance", """
    SELECT * FROM (SELECT substring(start_date, 1, 7) AS month, count(*) AS events_held,
      CAST(sum(total_guests) AS BIGINT) AS total_guests,
      CAST(sum(unique_contacts) AS BIGINT) AS unique_attendees
      FROM seen WHERE start_date < '2025-06-01' GROUP BY 1) ORDER BY month DESC LIMIT 12""")(
    lambda s: reports.monthly_attendance(s, "2025-06-01"))


@query("a24_event_profile", """
    SELECT 'status' AS measure, status AS value, CAST(count(*) AS VARCHAR) AS result
      FROM t_event GROUP BY 2
    UNION ALL SELECT 'registration_type', registration_type, CAST(count(*) AS VARCHAR)
      FROM t_event GROUP BY 2
    UNION ALL SELECT 'start', 'earliest', min(start_datetime) FROM t_event
    UNION ALL SELECT 'start', 'latest', max(start_datetime) FROM t_event
    UNION ALL SELECT 'start', 'past', CAST(count(*) FILTER (start_datetime < '2024-03-01')
      AS VARCHAR) FROM t_event
    UNION ALL SELECT 'start', 'future', CAST(count(*) FILTER (start_datetime >= '2024-03-01')
      AS VARCHAR) FROM t_event""", "t_event")
def _(lake):
    return reports.event_profile(lake.t_event, "2024-03-01")


@query("a24_edge_dates", """
    SELECT * FROM (SELECT start_datetime, event_id, 'first' AS edge FROM t_event
      ORDER BY start_datetime, event_id LIMIT 5)
    UNION ALL SELECT * FROM (SELECT start_datetime, event_id, 'last' FROM t_event
      ORDER BY start_datetime DESC, event_id DESC LIMIT 5)""", "t_event")
def _(lake):
    return reports.edge_dates(lake.t_event)


@query("a25_events_by_status", "SELECT status, count(*) AS events FROM t_event GROUP BY 1", "t_event")
def _(lake):
    return reports.events_by_status(lake.t_event)


@query("a26_sales_summary", f"""
    SELECT event_id, grouping(event_id) = 1 AS overall, count(*) AS total_orders,
      CAST(sum(tickets_quantity) AS BIGINT) AS total_tickets, {MONEY.format('total')} AS total_sales
    FROM t_order GROUP BY ROLLUP (event_id)""", "t_order")
def _(lake):
    return reports.sales_summary(lake.t_order)


CONTACT_RAW = """
    SELECT CAST(c_custkey AS STRING) AS id, named_struct(
        'name', named_struct('first', CASE WHEN c_acctbal > 2000 THEN 'Cy' END, 'last', c_name),
        'emails', named_struct('items', array(
          named_struct('email', lower(c_name) || '@first.test', 'primary', FALSE),
          named_struct('email', 'x@two.test', 'primary', TRUE))),
        'phones', named_struct('items', CASE WHEN c_acctbal > 4000
          THEN array(named_struct('phone', '777-' || c_nationkey)) END)) AS info,
      c_custkey AS _ord FROM {customer}"""


@query("j1_enrich_guests", """
    SELECT guest_id,
      coalesce(nullif(g.first_name, ''), CASE WHEN c.c_acctbal > 2000 THEN 'Cy' END,
        g.first_name) AS first_name,
      coalesce(nullif(g.last_name, ''), c.c_name, g.last_name) AS last_name,
      CASE WHEN c.c_custkey IS NULL THEN g.full_name ELSE coalesce(nullif(concat_ws(' ',
        coalesce(nullif(g.first_name, ''), CASE WHEN c.c_acctbal > 2000 THEN 'Cy' END),
        coalesce(nullif(g.last_name, ''), c.c_name)), ''), g.full_name) END AS full_name,
      coalesce(g.email, lower(c.c_name) || '@first.test') AS email,
      coalesce(g.phone, CASE WHEN c.c_acctbal > 4000
        THEN '777-' || CAST(c.c_nationkey AS VARCHAR) END) AS phone
    FROM t_guest g LEFT JOIN customer c ON g.contact_id = CAST(c.c_custkey AS VARCHAR)
    """, "t_guest")
def _(lake):
    raw = conform(lake.sql(CONTACT_RAW), raw_schema("contacts"))
    return flatten_people.enrich_guests(lake.t_guest, raw).select(
        "guest_id", "first_name", "last_name", "full_name", "email", "phone")


@query("p6_contacts_by_email", """
    SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer
    WHERE c_name = 'Customer#000000007'""")
def _(lake):
    raw = conform(lake.sql(CONTACT_RAW), raw_schema("contacts"))
    return filters.contacts_by_email(raw, "customer#000000007@first.test").select("id")


@query("p6_contacts_by_phone", """
    SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer
    WHERE c_acctbal > 4000 AND c_nationkey = 7""")
def _(lake):
    raw = conform(lake.sql(CONTACT_RAW), raw_schema("contacts"))
    return filters.contacts_by_phone(raw, "777-7").select("id")


@query("p6_find_orders", """
    SELECT order_number, event_id, channel FROM t_order
    WHERE event_id = '3' AND channel IN ('ONLINE', 'OFFLINE')""", "t_order")
def _(lake):
    found = filters.find(lake.t_order, {"event_id": "3", "channel": ["ONLINE", "OFFLINE"]},
                         [F.col("order_number").asc()])
    return found.select("order_number", "event_id", "channel")


for _name, _entity, _where, _sql in (
    ("p6_event_by_id", "t_event", {"event_id": "3"}, "event_id = '3'"),
    ("p6_event_by_slug", "t_event", {"slug": ["supplier-000000003", "none"]},
     "slug IN ('supplier-000000003', 'none')"),
    ("p6_events_by_category", "t_event", {"category_names": "MIDDLE EAST, NATION_9"},
     "category_names = 'MIDDLE EAST, NATION_9'"),
    ("p6_event_guests", "t_guest", {"event_id": "3", "guest_type": "TICKET_HOLDER"},
     "event_id = '3' AND guest_type = 'TICKET_HOLDER'"),
    ("p6_event_tickets", "t_ticket", {"event_id": "3"}, "event_id = '3'"),
    ("p6_order_by_number", "t_order", {"order_number": "7"}, "order_number = '7'"),
):
    _key = {"t_event": "event_id", "t_guest": "guest_id", "t_ticket": "ticket_number",
            "t_order": "order_number"}[_entity]
    query(_name, f"SELECT {_key} FROM {_entity} WHERE {_sql}", _entity)(
        lambda lake, e=_entity, w=_where, k=_key: filters.find(getattr(lake, e), w).select(k))


@query("p6_form_submissions", """
    SELECT CAST(page_id AS VARCHAR) AS submission_id FROM pages WHERE page_id % 5 = 2""")
def _(lake):
    raw = lake.sql("""SELECT CAST(page_id AS STRING) AS id,
        'form-' || (page_id % 5) AS formId, page_id AS _ord FROM {pages}""")
    schema = T.StructType([*raw_schema("form_submissions").fields,
                           T.StructField("_ord", T.LongType())])
    flat = flatten_forms.flatten_submissions_wide(conform(raw, schema))
    return filters.find(flat, {"form_id": "form-2"}).select("submission_id")


@query("a29_identity_fill_rates", """
    SELECT count(nullif(first_name, '')) / count(*) AS first_name,
      count(nullif(last_name, '')) / count(*) AS last_name, count(email) / count(*) AS email
    FROM t_guest""", "t_guest")
def _(lake):
    from turnstile.operators.quality import identity_fill_rates

    return identity_fill_rates(lake.t_guest)


@query("j2_tickets_with_definitions", """
    SELECT ticket_number, d.pricing_type AS def_pricing_type, d.fee_type AS def_fee_type,
      d.sale_status AS def_sale_status, d.sold_count AS def_sold_count, d.sold_out AS def_sold_out
    FROM t_ticket t LEFT JOIN t_def d ON t.ticket_definition_id = d.definition_id
    """, "t_ticket t_def")
def _(lake):
    joined = enrich.tickets_with_definitions(lake.t_ticket, lake.t_def)
    return joined.select("ticket_number", *[c for c in joined.columns if c.startswith("def_")])


@query("j3_exclude_rsvp_guests", """
    SELECT guest_id, event_id FROM t_guest WHERE event_id IS NULL OR event_id NOT IN (
      SELECT event_id FROM t_event WHERE registration_type = 'RSVP')""", "t_guest t_event")
def _(lake):
    return enrich.exclude_rsvp_guests(lake.t_guest, lake.t_event).select("guest_id", "event_id")


@query("j13_summaries_for_events", """
    SELECT e.event_id, e.title AS event_title, s.total_sales_currency, s.total_sales_amount,
      coalesce(s.total_orders, 0) AS total_orders, coalesce(s.total_tickets, 0) AS total_tickets,
      s.avg_ticket_price, s.event_id IS NOT NULL AS has_sales
    FROM t_event e LEFT JOIN t_summary s USING (event_id)""", "t_event t_summary")
def _(lake):
    return enrich.summaries_for_events(lake.t_event, lake.t_summary)


@query("j14_patch_records", """
    SELECT event_id, title, CASE WHEN registration_type = 'RSVP' THEN 'Full text' END
      AS description FROM t_event""", "t_event")
def _(lake):
    bulk = lake.t_event.select("event_id", "title", F.lit(None).cast("string").alias("description"))
    detail = lake.t_event.where("registration_type = 'RSVP'").select(
        "event_id", "title", F.lit("Full text").alias("description"), "_ord")
    return enrich.patch_records(bulk, detail, "event_id")


@query("j15_educator_feed", """
    SELECT title, start_date, start_time, category_names,
      coalesce(total_tickets, 0) AS tickets_sold, total_sales_amount AS total_revenue
    FROM t_event e LEFT JOIN t_summary s USING (event_id)
    WHERE e.status = 'UPCOMING' AND registration_type = 'TICKETING'""", "t_event t_summary")
def _(lake):
    return enrich.educator_feed(lake.t_event, lake.t_summary)


@query("c6_l2_socials_feed", """
    SELECT title, day_of_week, start_date, start_time, lowest_price, highest_price, location_name
    FROM t_event WHERE status = 'UPCOMING' AND registration_type = 'TICKETING'""", "t_event")
def _(lake):
    return enrich.socials_feed(lake.t_event)


@query("p1_upcoming_ticketing", """
    SELECT event_id, title FROM t_event
    WHERE status = 'UPCOMING' AND registration_type = 'TICKETING'""", "t_event")
def _(lake):
    return filters.upcoming_ticketing(lake.t_event).select("event_id", "title")


@query("j16_reconcile_export", """
    , a AS (SELECT app_order_id AS k, max(status) AS s FROM t_payment
            WHERE app_order_id IS NOT NULL GROUP BY 1)
    , b AS (SELECT order_number AS k, max(channel) AS s FROM t_order GROUP BY 1)
    SELECT count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS matched,
      count(*) FILTER (b.k IS NULL) AS left_only, count(*) FILTER (a.k IS NULL) AS right_only,
      count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL AND a.s IS DISTINCT FROM b.s)
        AS status_differs
    FROM a FULL JOIN b ON a.k = b.k""", "t_payment t_order")
def _(lake):
    left = lake.t_payment.select("app_order_id", "status")
    right = lake.t_order.select(F.col("order_number").alias("app_order_id"),
                                F.col("channel").alias("status"))
    return enrich.reconcile(left, right, "app_order_id", "status")


# Two exports of the order lines: the second lacks some, and has other or no status for others.
EXPORTS = """
    WITH u AS (SELECT CAST(l_orderkey AS VARCHAR) AS key, l_linestatus AS status, 1 AS a, 0 AS b
        FROM lineitem
      UNION ALL SELECT CAST(l_orderkey AS VARCHAR), CASE WHEN l_discount = 0 THEN NULL
          WHEN l_tax > 0.07 THEN 'REFUNDED' ELSE l_linestatus END, 0, 1
        FROM lineitem WHERE l_quantity < 50),
    d AS (SELECT key, status, CAST(sum(a) AS BIGINT) AS n_left, CAST(sum(b) AS BIGINT) AS n_right
        FROM u GROUP BY 1, 2)"""


def exports(lake: Lake):
    left = lake.sql("SELECT CAST(l_orderkey AS STRING) AS number, l_linestatus AS state FROM {lineitem}")
    right = lake.sql("""SELECT CAST(l_orderkey AS STRING) AS number, CASE WHEN l_discount = 0 THEN NULL
        WHEN l_tax > 0.07 THEN 'REFUNDED' ELSE l_linestatus END AS state
        FROM {lineitem} WHERE l_quantity < 50""")
    return compare_exports(left, right, "number", "state")


@query("j16_export_status_counts", EXPORTS + """
    SELECT status, CAST(sum(n_left) AS BIGINT) AS rows_left, CAST(sum(n_right) AS BIGINT) AS rows_right,
      CAST(sum(least(n_left, n_right)) AS BIGINT) AS in_both,
      CAST(sum(greatest(n_left - n_right, 0)) AS BIGINT) AS left_only,
      CAST(sum(greatest(n_right - n_left, 0)) AS BIGINT) AS right_only FROM d GROUP BY 1""")
def _(lake):
    return exports(lake)[0]


@query("j16_export_differences", EXPORTS + " SELECT * FROM d WHERE n_left <> n_right")
def _(lake):
    return exports(lake)[1]


@query("s10_l5_payments_filter", """
    SELECT transaction_id, payment_datetime, status FROM t_payment
    WHERE payment_datetime >= '2024-01-05' AND payment_datetime <= '2024-01-20'
      AND currency = 'CAD' AND status IN ('APPROVED', 'PENDING')""", "t_payment")
def _(lake):
    return filters.payments_filter(
        lake.t_payment, from_date="2024-01-05", to_date="2024-01-20", currency="CAD",
        status=["APPROVED", "PENDING"], order="date:asc",
    ).select("transaction_id", "payment_datetime", "status")


@query("l4_capped_payments", """
    SELECT transaction_id, payment_datetime FROM t_payment WHERE payment_method = 'CreditCard'
    ORDER BY payment_datetime DESC, transaction_id LIMIT 50""", "t_payment")
def _(lake):
    return filters.payments_filter(
        lake.t_payment, method="CreditCard", max_results=50,
    ).select("transaction_id", "payment_datetime")


@query("s11_upsert_latest", """
    SELECT order_number, status, CAST(v AS BIGINT) AS v FROM (
      SELECT CAST(o_orderkey AS VARCHAR) AS order_number, o_orderstatus AS status, 1 AS v,
        CAST(o_orderdate AS DATE) AS u, 0 AS n FROM orders
      UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'SHIPPED', 2, CAST(max(l_shipdate) AS DATE), 1
        FROM lineitem GROUP BY 1)
    QUALIFY row_number() OVER (PARTITION BY order_number ORDER BY u DESC, n DESC) = 1""")
def _(lake):
    existing = lake.sql("""SELECT CAST(o_orderkey AS STRING) AS order_number,
        o_orderstatus AS status, CAST(1 AS BIGINT) AS v,
        CAST(CAST(o_orderdate AS DATE) AS STRING) AS updated_datetime FROM {orders}""")
    delta = lake.sql("""SELECT CAST(l_orderkey AS STRING) AS order_number, 'SHIPPED' AS status,
        CAST(2 AS BIGINT) AS v, CAST(CAST(max(l_shipdate) AS DATE) AS STRING) AS updated_datetime
        FROM {lineitem} GROUP BY l_orderkey""")
    return enrich.upsert_latest(existing, delta, "order_number").select(
        "order_number", "status", "v")


@query("s9_coupons_all", """
    SELECT CAST(p_partkey AS VARCHAR) AS coupon_id, TRUE AS active FROM part WHERE p_size > 10
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), FALSE FROM part WHERE p_size <= 20""")
def _(lake):
    rows = lake.part.select(F.col("p_partkey").cast("string").alias("coupon_id"), "p_size")
    active = rows.where("p_size > 10").withColumn("active", F.lit(True)).drop("p_size")
    expired = rows.where("p_size <= 20").withColumn("active", F.lit(False)).drop("p_size")
    return enrich.coupons_all(active, expired)


@query("s8_u4_union_sources", """
    SELECT doc_id AS id, lang, CAST(NULL AS VARCHAR) AS url FROM documents
    UNION ALL SELECT page_id, NULL, url FROM pages
    UNION ALL SELECT conv_id * 100 + turn, NULL, NULL FROM conversations""")
def _(lake):
    from turnstile.sources.bronze import union_sources

    return union_sources([
        lake.documents.select(F.col("doc_id").alias("id"), "lang"), None,
        lake.pages.select(F.col("page_id").alias("id"), "url"),
        lake.conversations.select((F.col("conv_id") * 100 + F.col("turn")).alias("id")),
    ])


@query("u1_union_tables", """
    SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""")
def _(lake):
    return tidy.union_tables([
        lake.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
                             F.col("c_mktsegment").alias("segment")),
        lake.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")),
    ])


@query("c1_c4_p7_a30_tidy", """
    SELECT DISTINCT c_mktsegment AS segment, c_nationkey FROM customer WHERE c_acctbal > 0""")
def _(lake):
    # The filter runs after the renames, so it names the new column.
    table = lake.customer.withColumn("empty", F.lit(None).cast("string"))
    kept = tidy.tidy(
        table, drop_empty=True, remove=["c_name", "unknown"],
        keep=["c_mktsegment", "c_nationkey", "c_acctbal", "empty"],
        rename={"c_mktsegment": "segment", "nope": "x"}, where="c_acctbal > 0")
    return tidy.drop_duplicate_rows(tidy.remove_columns(kept, ["c_acctbal"]))


@query("c5_standardize_columns", """
    SELECT p_partkey AS part_key, p_name AS part_name, p_size AS size_cm FROM part""")
def _(lake):
    return tidy.standardize_columns(lake.part.select(
        F.col("p_partkey").alias(" Part-Key"), F.col("p_name").alias("Part Name "),
        F.col("p_size").alias("Size/cm")))
