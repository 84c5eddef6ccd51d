"""Facts and the order-level operators below them."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import Lake, query
from catalog.gold_sql import (
    ATTENDANCE_ENTITIES,
    ORDER_CTES,
    PAYMENTS_CTE,
    PAYMENTS_ENTITIES,
    attendance_ctes,
    stub_ctes,
)
from turnstile.operators import dims, headcount, orders
from turnstile.plans.attendance_fact import (
    attendance_audit,
    build_attendance_fact,
    buyer_only_orders,
    order_baskets,
)
from turnstile.plans.payments_fact import build_payments_fact, enrichment_audit

STUB_ENTITIES = "t_guest t_payment"


def payments_fact(lake: Lake):
    return build_payments_fact(
        lake.t_payment, lake.t_order, lake.t_event, lake.t_contact, lake.t_member, lake.t_summary
    )


def attendance_fact(lake: Lake, include_inactive: bool = False):
    return build_attendance_fact(
        lake.t_guest, lake.t_event, lake.t_contact, lake.t_member, lake.t_def, lake.t_ticket,
        lake.t_summary, lake.t_payment, include_inactive,
    )


query("j5_payments_fact", PAYMENTS_CTE + "SELECT * FROM payments_fact", PAYMENTS_ENTITIES)(
    payments_fact)
query("j6_attendance_fact", attendance_ctes() + "SELECT * FROM attendance_fact",
      ATTENDANCE_ENTITIES)(attendance_fact)
query("p2_attendance_with_inactive",
      attendance_ctes(True) + "SELECT * FROM attendance_fact", ATTENDANCE_ENTITIES)(
    lambda lake: attendance_fact(lake, True))


@query("a7_enrichment_audit", PAYMENTS_CTE + """
    SELECT enrichment_status, count(*) AS payments FROM payments_fact GROUP BY 1
    """, PAYMENTS_ENTITIES)
def _(lake):
    return enrichment_audit(payments_fact(lake))


@query("j0_last_wins_dim", """
    SELECT event_type, max(event_id) AS last_event, arg_max(value, event_id) AS last_value
    FROM events GROUP BY event_type""")
def _(lake):
    rows = lake.events.withColumn("_ord", F.col("event_id"))
    return dims.last_wins(rows, "event_type").select(
        "event_type", F.col("event_id").alias("last_event"), F.col("value").alias("last_value"))


@query("a1_latest_payment_per_order", ORDER_CTES + """
    SELECT order_number, status AS order_payment_status, total_quantity, product_name,
           _ord AS payment_ord FROM latest""", STUB_ENTITIES)
def _(lake):
    return orders.latest_payment_per_order(lake.t_payment).drop("payment_datetime")


@query("a1_payments_out_of_order", """
    WITH RECURSIVE p AS (
      SELECT CAST(user_id AS VARCHAR) AS k, event_id AS pos, event_type = 'purchase' AS ok,
        CASE WHEN event_id % 4 > 0 THEN
          CAST(CAST(ts - to_hours(CAST(event_id % 7 AS INTEGER) * 40) AS DATE) AS VARCHAR) END AS day,
        row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
    f AS (
      SELECT k, n, pos, ok, day FROM p WHERE n = 1
      UNION ALL
      SELECT k, n, CASE WHEN win THEN new_pos ELSE pos END, CASE WHEN win THEN new_ok ELSE ok END,
        CASE WHEN win THEN new_day ELSE day END
      FROM (SELECT f.k, p.n, f.pos, f.ok, f.day, p.pos AS new_pos, p.ok AS new_ok, p.day AS new_day,
              (p.ok AND NOT f.ok) OR coalesce(p.day > f.day, FALSE) AS win
            FROM f JOIN p ON p.k = f.k AND p.n = f.n + 1))
    SELECT k AS order_number, pos AS payment_ord FROM f
    WHERE n = (SELECT max(n) FROM p WHERE p.k = f.k)""")
def _(lake):
    # Events read as payments of their user: undated ones, and dates out of order.
    payments = lake.sql("""
        SELECT CAST(user_id AS STRING) AS app_order_id,
          CASE WHEN event_type = 'purchase' THEN 'APPROVED' ELSE 'PENDING' END AS status,
          CASE WHEN event_id % 4 > 0 THEN CAST(CAST(
            ts - make_interval(0, 0, 0, 0, CAST(event_id % 7 AS INT) * 40) AS DATE) AS STRING)
          END AS payment_datetime, CAST(1 AS BIGINT) AS total_quantity, event_type AS product_name,
          event_id AS _ord FROM {events}""")
    return orders.latest_payment_per_order(payments).select("order_number", "payment_ord")


@query("a2_event_capacity", """
    SELECT event_id, CAST(sum(initial_limit) AS BIGINT) AS event_total_capacity,
           count(*) AS event_distinct_td_count FROM t_def GROUP BY event_id""", "t_def")
def _(lake):
    return dims.event_capacity(lake.t_def)


@query("a3_order_grain", ORDER_CTES + """
    SELECT g.order_number, b.contact_id AS buyer_contact_id, g.buyers, g.holders, g.rsvps,
           nullif(g.holders, 0) AS tickets_in_order
    FROM grain g LEFT JOIN buyer b USING (order_number)""", STUB_ENTITIES)
def _(lake):
    return orders.order_grain(lake.once("t_guest")).select(
        "order_number", F.col("buyer.contact_id").alias("buyer_contact_id"), "buyers", "holders",
        "rsvps", "tickets_in_order")


@query("w4_first_buyer", ORDER_CTES + """
    SELECT order_number, guest_id, contact_id FROM buyer""", STUB_ENTITIES)
def _(lake):
    return orders.first_buyer(lake.once("t_guest"))


@query("a4_paid_tickets_per_order", ORDER_CTES + """
    SELECT order_number, paid_n AS paid_tickets_per_order, inactive FROM ctx""", STUB_ENTITIES)
def _(lake):
    return orders.order_context(lake.once("t_guest"), lake.t_payment).select(
        "order_number", "paid_tickets_per_order", "inactive")


def _stubs(lake):
    guests = lake.t_guest
    return headcount.ticket_stubs(guests, orders.order_context(guests, lake.t_payment))


@query("p3_kept_stubs", stub_ctes() + """
    SELECT guest_id, guest_type, event_id, order_number, buyer_contact_id, tickets_in_order,
           order_payment_status FROM stub""", STUB_ENTITIES)
def _(lake):
    return _stubs(lake).select(
        "guest_id", "guest_type", "event_id", "order_number", "buyer_contact_id",
        "tickets_in_order", "order_payment_status")


@query("w1_paid_stub_flag", stub_ctes() + """
    SELECT guest_id, order_number, paid_tickets_per_order, is_paid_ticket_stub FROM stub
    """, STUB_ENTITIES)
def _(lake):
    return _stubs(lake).select(
        "guest_id", "order_number", "paid_tickets_per_order", "is_paid_ticket_stub")


@query("a5_headcount_by_buyer_event", stub_ctes() + """
    SELECT DISTINCT event_id, buyer_contact_id, n_paid AS paid, n_free AS free, n_rsvp AS rsvps,
           humans FROM seated""", STUB_ENTITIES)
def _(lake):
    return headcount.headcount_by_buyer(_stubs(lake)).drop("first_seat")


@query("w2_counts_as_human", stub_ctes() + """
    SELECT guest_id, counts_as_human, is_partner_seat, humans_at_event_for_buyer FROM counted
    WHERE guest_type <> 'RSVP'""", STUB_ENTITIES)
def _(lake):
    return headcount.count_people(_stubs(lake)).where("guest_type <> 'RSVP'").select(
        "guest_id", "counts_as_human", "is_partner_seat", "humans_at_event_for_buyer")


@query("w3_rsvp_rows", stub_ctes() + """
    SELECT guest_id, counts_as_human, is_partner_seat, humans_at_event_for_buyer FROM counted
    WHERE guest_type = 'RSVP'""", STUB_ENTITIES)
def _(lake):
    return headcount.count_people(_stubs(lake)).where("guest_type = 'RSVP'").select(
        "guest_id", "counts_as_human", "is_partner_seat", "humans_at_event_for_buyer")


@query("a6_attendance_audit", ORDER_CTES + """
    SELECT 'inactive_stubs' AS measure, pay_status AS status,
           CAST(sum(holders + rsvps) AS BIGINT) AS n FROM ctx WHERE inactive GROUP BY 2
    UNION ALL SELECT 'buyer_only_orders', NULL, count(*) FROM ctx
        WHERE NOT inactive AND holders + rsvps = 0
    UNION ALL SELECT 'buyer_rows', NULL, count(*) FROM t_guest WHERE guest_type = 'BUYER'
    UNION ALL SELECT 'orphans_kept', NULL, count(*) FROM t_guest
        WHERE order_number IS NULL AND guest_type <> 'BUYER'""", STUB_ENTITIES)
def _(lake):
    return attendance_audit(lake.t_guest, orders.order_context(lake.t_guest, lake.t_payment))


@query("a6_buyer_only_orders", ORDER_CTES + """
    SELECT order_number, buyers FROM ctx WHERE NOT inactive AND holders + rsvps = 0
    """, STUB_ENTITIES)
def _(lake):
    return buyer_only_orders(orders.order_context(lake.once("t_guest"), lake.t_payment))


@query("j7_ticket_lookup", """
    , lone AS (SELECT event_id, order_number, max(_ord) AS _ord FROM t_ticket
               GROUP BY event_id, order_number HAVING count(*) = 1)
    SELECT g.guest_id, coalesce(t1.ticket_number, t2.ticket_number) AS found_ticket
    FROM t_guest g LEFT JOIN t_ticket t1 ON g.ticket_number = t1.ticket_number
    LEFT JOIN lone ON t1._ord IS NULL AND lone.event_id = g.event_id
                  AND lone.order_number = g.order_number
    LEFT JOIN t_ticket t2 ON t2._ord = lone._ord""", "t_guest t_ticket")
def _(lake):
    return dims.ticket_lookup(lake.once("t_guest"), lake.t_ticket).select(
        "guest_id", F.col("ticket.ticket_number").alias("found_ticket"))


@query("j8_match_ticket_definitions", ORDER_CTES + """
    , basket AS (SELECT DISTINCT g.event_id, l.product_name FROM t_guest g
                 JOIN latest l USING (order_number)
                 WHERE g.guest_type IN ('TICKET_HOLDER', 'RSVP') AND l.product_name <> '')
    SELECT b.event_id, b.product_name, string_agg(d.name, ', ' ORDER BY d._ord) AS td_name,
           string_agg(CAST(d.initial_limit AS VARCHAR), ', ' ORDER BY d._ord)
               AS td_initial_limit_text,
           CASE WHEN count(*) = 1 THEN 'exact' ELSE 'ambiguous' END AS td_match_confidence
    FROM basket b JOIN t_def d ON b.event_id = d.event_id AND trim(d.name) <> ''
         AND contains(lower(b.product_name), lower(trim(d.name)))
    GROUP BY b.event_id, b.product_name""", "t_guest t_payment t_def")
def _(lake):
    context = orders.order_context(lake.t_guest, lake.t_payment)
    found = dims.match_ticket_definitions(order_baskets(lake.t_guest, context), lake.t_def)
    return found.select(
        F.col("_td_event").alias("event_id"), F.col("_td_product").alias("product_name"),
        "td_name", "td_initial_limit_text", "td_match_confidence")
