"""One row per ticket stub with identity, headcount, price and all dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnstile.functions.text import join_name
from turnstile.functions.values import (
    blank_to_null,
    bucket_price,
    first_filled,
    safe_bool,
    safe_float,
)
from turnstile.operators.dims import (
    event_dim,
    join_dim,
    last_wins,
    match_ticket_definitions,
    person_dim,
    prefixed,
    ticket_lookup,
)
from turnstile.operators.headcount import count_people, ticket_stubs
from turnstile.operators.orders import order_context
from turnstile.session import by_key, stage


def _identity() -> dict[str, Column]:
    """Names and addresses of the buyer if the order has one, else of the guest."""
    buyer_id = blank_to_null(F.col("buyer_contact_id"))
    has_buyer = buyer_id.isNotNull()

    def own(field: str) -> Column:
        return F.when(has_buyer, F.col(f"buyer.{field}")).otherwise(F.col(field))

    holder = F.col("contact_id")
    first = first_filled(own("first_name"), F.col("c_first_name"))
    last = first_filled(own("last_name"), F.col("c_last_name"))
    return {
        "identity_source": F.when(~has_buyer, "orphan_no_buyer")
        .when(holder.isNull(), "buyer")
        .when(holder == buyer_id, "th_matches_buyer")
        .otherwise("buyer_overrides_holder"),
        "first_name": first,
        "last_name": last,
        "full_name": F.coalesce(
            first_filled(own("full_name"), F.col("c_full_name")), join_name(first, last)),
        "email": first_filled(own("email"), F.col("c_primary_email"), F.col("c_email")),
        "phone": blank_to_null(own("phone")),
    }


def with_price(rows: DataFrame) -> DataFrame:
    """Add price_source, price_value, price_text, price_currency and free.

    Sources in rank order: free order, ticket, definition, matched definition, event average.
    Each step is its own projection, so no expression is repeated inside the next.
    """
    status = F.upper(F.coalesce(F.col("order_status"), F.lit("")))
    rows = rows.withColumns({
        "_status": status,
        "_ticket_price": safe_float(F.col("ticket.price_value")),
        "_definition_price": safe_float(F.col("d_fixed_price_value")),
        "_average_price": safe_float(F.col("s_avg_ticket_price")),
        "_ticket_currency": blank_to_null(F.col("ticket.price_currency")),
    })
    rows = rows.withColumn(
        "price_source",
        F.when(F.col("_status") == "FREE", "order_status")
        .when(F.col("_ticket_price").isNotNull(), "ticket")
        .when(F.col("_definition_price").isNotNull(), "ticket_definition")
        .when(F.col("td_fixed_price_value_text").isNotNull(), "td_match")
        .when(F.col("_average_price").isNotNull(), "event_average")
        .otherwise("unknown"),
    )
    source, on_ticket = F.col("price_source"), F.col("_ticket_currency")
    on_definition, on_sales = F.col("d_fixed_price_currency"), F.col("s_total_sales_currency")
    rows = rows.withColumns({
        "price_value": F.when(source == "order_status", F.lit(0.0))
        .when(source == "ticket", F.col("_ticket_price"))
        .when(source == "ticket_definition", F.col("_definition_price"))
        .when(source == "td_match", F.col("td_fixed_price_value"))
        .when(source == "event_average", F.col("_average_price")),
        "price_text": F.when(source == "td_match", F.col("td_fixed_price_value_text")),
        "price_currency": F.when(
            source == "order_status",
            F.coalesce(on_ticket, first_filled(on_definition, on_sales), F.col("e_currency")))
        .when(source == "ticket_definition", F.coalesce(on_ticket, on_definition))
        .when(source == "event_average", F.coalesce(on_ticket, on_sales))
        .otherwise(F.col("ticket.price_currency")),
    })
    # Several matched prices are text, which is never zero.
    several = (source == "td_match") & F.col("td_fixed_price_value").isNull()
    by_price = F.when(several, False).otherwise(F.col("price_value") == 0)
    return rows.withColumn(
        "free",
        F.when(F.col("_status") == "FREE", True)
        .when(F.col("_status") == "PAID", False)
        .otherwise(F.coalesce(
            safe_bool(F.col("ticket.free")), safe_bool(F.col("d_free")), by_price)),
    )


def build_attendance_fact(
    guests: DataFrame,
    events: DataFrame,
    contacts: DataFrame,
    members: DataFrame,
    ticket_definitions: DataFrame,
    tickets: DataFrame,
    order_summaries: DataFrame,
    payments: DataFrame,
    include_inactive: bool = False,
) -> DataFrame:
    """Build the attendance fact.

    Dimensions are deduplicated and staged first. A stub looks each of them up with its row number
    and key only; what it finds, if anything, comes back by that number, so wide rows are shuffled
    once and not once for every dimension. The events are joined last; they are broadcast as long
    as Spark finds them small.

    Where several ticket definitions match with different numbers, the numeric ``td_*``
    and ``price_value`` are null and the joined values are in the ``*_text`` columns.
    """
    context = order_context(guests, payments)
    kept = stage(ticket_stubs(guests, context, include_inactive).withColumn(
        "_row", F.monotonically_increasing_id()), "stubs")
    person = F.coalesce(blank_to_null(F.col("buyer_contact_id")), F.col("contact_id"))
    kept = kept.withColumn("_who", person)
    counted = count_people(kept).select(
        "_row", "humans_at_event_for_buyer", "counts_as_human", "is_partner_seat")
    definition_id = F.coalesce(
        blank_to_null(F.col("ticket.ticket_definition_id")),
        F.col("primary_ticket_definition_id"),
    )
    definitions = prefixed(
        last_wins(ticket_definitions, "definition_id"), "d_", "definition_id",
        "name", "fixed_price_value", "fixed_price_currency", "free", "pricing_type",
        "fee_type", "sale_status",
    ).withColumnRenamed("definition_id", "_definition")
    ticketed = join_dim(
        ticket_lookup(kept, tickets).withColumn("ticket_definition_id", definition_id),
        by_key(stage(definitions, "definitions")), "ticket_definition_id", "_definition", "_ord",
    ).select("_row", "_wanted", "ticket", "ticket_definition_id",
             *[c for c in definitions.columns if c != "_definition"])
    signals = stage(
        match_ticket_definitions(stub_baskets(kept), ticket_definitions), "signals")
    named = kept.select("_row", "event_id", "product_name").join(
        by_key(signals),
        (F.col("event_id") == F.col("_td_event")) & (F.col("product_name") == F.col("_td_product")),
    ).drop("event_id", "product_name", "_td_event", "_td_product")
    people = stage(person_dim(contacts, members), "people")
    known = kept.select("_row", "_who").where(F.length("_who") > 0).join(
        by_key(people), F.col("_who") == F.col("_person")).drop("_who", "_person")
    rows = kept.drop("product_name").join(by_key(counted), "_row").join(by_key(ticketed), "_row")
    rows = rows.join(by_key(named), "_row", "left").join(by_key(known), "_row", "left")
    shows = stage(event_dim(events, order_summaries, ticket_definitions), "shows")
    rows = join_dim(rows, shows, "event_id", "_event", "guest_id")

    rows = with_price(rows)
    who = _identity()
    member_id = first_filled(
        F.col("m_member_id"), F.col("buyer.member_id"), F.col("c_member_id"))
    checked = F.coalesce(safe_bool(F.col("ticket.checked_in")), safe_bool(F.col("checked_in")))
    buyer_id = blank_to_null(F.col("buyer_contact_id"))
    false = F.lit(False)
    columns = {
        "guest_id": F.col("guest_id"),
        "event_id": F.col("event_id"),
        "contact_id": F.col("_who"),
        "buyer_contact_id": F.col("buyer_contact_id"),
        "th_contact_id_raw": F.col("contact_id"),
        "identity_source": who["identity_source"],
        "order_number": F.col("order_number"),
        "ticket_number": F.coalesce(
            blank_to_null(F.col("ticket.ticket_number")), F.col("_wanted")),
        "ticket_definition_id": F.col("ticket_definition_id"),
        "guest_type": F.col("guest_type"),
        "was_buyer": buyer_id.isNotNull(),
        "tickets_in_order": F.col("tickets_in_order"),
        "attendance_status": F.col("attendance_status"),
        "order_status": F.col("order_status"),
        "order_payment_status": F.col("order_payment_status"),
        "paid_tickets_per_order": F.col("paid_tickets_per_order"),
        "is_paid_ticket_stub": F.col("is_paid_ticket_stub"),
        "humans_at_event_for_buyer": F.col("humans_at_event_for_buyer"),
        "counts_as_human": F.col("counts_as_human"),
        "is_partner_seat": F.col("is_partner_seat"),
        "checked_in": checked,
        "check_in_date": F.col("ticket.check_in_date"),
        "check_in_time": F.col("ticket.check_in_time"),
        "event_title": F.col("e_title"),
        "event_slug": F.col("e_slug"),
        "event_status": F.col("e_status"),
        "registration_type": F.col("e_registration_type"),
        "category_names": F.col("e_category_names"),
        "category_count": F.col("e_category_count"),
        "start_date": F.col("e_start_date"),
        "start_time": F.col("e_start_time"),
        "start_datetime": F.col("e_start_datetime"),
        "day_of_week": F.col("e_day_of_week"),
        "is_weekend": F.col("e_is_weekend"),
        "location_name": F.col("e_location_name"),
        "location_city": F.col("e_location_city"),
        "event_lowest_price": F.col("e_lowest_price"),
        "event_highest_price": F.col("e_highest_price"),
        "event_currency": F.col("e_currency"),
        "td_name": F.col("td_name"),
        "td_pricing_type": F.col("td_pricing_type"),
        **{f"td_{f}{t}": F.col(f"td_{f}{t}")
           for f in ("fixed_price_value", "initial_limit", "actual_limit", "limit_per_checkout")
           for t in ("", "_text")},
        "td_match_confidence": F.coalesce("td_match_confidence", F.lit("none")),
        "event_total_capacity": F.col("event_total_capacity"),
        "event_distinct_td_count": F.col("event_distinct_td_count"),
        "ticket_name": F.coalesce(
            first_filled(F.col("ticket.ticket_name"), F.col("primary_ticket_name"),
                         F.col("d_name")),
            F.col("td_name")),
        **{c: F.col(c) for c in (
            "price_value", "price_text", "price_currency", "price_source")},
        "paid_bucket": bucket_price(F.col("price_value"), F.col("free")),
        "free": F.col("free"),
        "def_pricing_type": F.col("d_pricing_type"),
        "def_fee_type": F.col("d_fee_type"),
        "def_sale_status": F.col("d_sale_status"),
        **{c: who[c] for c in ("first_name", "last_name", "full_name", "email", "phone")},
        "is_member": (
            F.coalesce(safe_bool(F.col("buyer.is_member")), false)
            | F.coalesce(safe_bool(F.col("c_is_member")), false)
            | member_id.isNotNull()
        ),
        "member_id": member_id,
        "member_signup_date": F.col("m_created_date"),
        "member_last_login_date": F.col("m_last_login_date"),
        "registered_date": F.col("created_date"),
        "registered_time": F.col("created_time"),
    }
    return rows.select(*[e.alias(n) for n, e in columns.items()])


def stub_baskets(stubs: DataFrame) -> DataFrame:
    """Distinct (event, product text) of kept stubs, the input of definition matching."""
    return stubs.where(F.length("product_name") > 0).select(
        "event_id", "product_name").distinct()


def order_baskets(guests: DataFrame, context: DataFrame) -> DataFrame:
    """Distinct (event, product text) of ordered stubs, the input of definition matching."""
    placed = guests.where(
        (F.length("order_number") > 0) & F.col("guest_type").isin("TICKET_HOLDER", "RSVP")
    ).select("order_number", "event_id")
    bought = context.where(F.length("product_name") > 0).select("order_number", "product_name")
    return placed.join(by_key(bought), "order_number").select("event_id", "product_name").distinct()


def attendance_audit(guests: DataFrame, context: DataFrame) -> DataFrame:
    """What the fact leaves out and keeps: one row per (measure, status).

    Stubs dropped per inactive status, buyer-only orders, buyer rows folded into their
    order, and kept guests without an order.
    """
    inactive = F.col("inactive")
    dropped = context.where(inactive).groupBy(
        F.lit("inactive_stubs").alias("measure"),
        F.col("order_payment_status").alias("status"),
    ).agg(F.sum(F.col("holders") + F.col("rsvps")).alias("n"))
    buyer_only = buyer_only_orders(context).agg(F.count("*").alias("n")).select(
        F.lit("buyer_only_orders").alias("measure"),
        F.lit(None).cast("string").alias("status"), "n",
    )
    blank_order = blank_to_null(F.col("order_number")).isNull()
    is_buyer = F.col("guest_type").eqNullSafe(F.lit("BUYER"))
    counts = guests.agg(
        F.count_if(is_buyer).alias("buyer_rows"),
        F.count_if(blank_order & ~is_buyer).alias("orphans_kept"),
    )
    totals = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.lit(None).cast("string").alias("status"),
                 F.col(c).alias("n"))
        for c in ("buyer_rows", "orphans_kept")
    ])).alias("r")).select("r.*")
    return dropped.unionByName(buyer_only).unionByName(totals)


def buyer_only_orders(context: DataFrame) -> DataFrame:
    """Active orders that have a buyer but no holder or RSVP, for follow-up."""
    return context.where(
        ~F.col("inactive") & (F.col("holders") + F.col("rsvps") == 0)
    ).select("order_number", "buyers")
