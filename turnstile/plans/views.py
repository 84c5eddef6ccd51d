"""Flat views over guests, contacts and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnstile.functions.values import midpoint_price, safe_float
from turnstile.operators.dims import join_dim, last_wins, prefixed
from turnstile.session import by_key, stage


def ticket_sales_view(guests: DataFrame, contacts: DataFrame, events: DataFrame) -> DataFrame:
    """One row per guest in the shape of a sales export, newest orders first.

    Buyer fields come from the contact and fall back to the guest.
    """
    people = prefixed(last_wins(contacts, "contact_id"), "c_", "contact_id",
                      "first_name", "last_name", "primary_email").withColumnRenamed(
        "contact_id", "_person")
    people = by_key(stage(people, "people"))
    shows = prefixed(last_wins(events, "event_id"), "e_", "event_id",
                     "title", "start_date", "start_time", "end_date", "end_time", "timezone",
                     "location_name", "location_city", "status", "currency", "lowest_price",
                     "highest_price").withColumnRenamed("event_id", "_event")
    shows = by_key(stage(shows, "shows"))
    wide = join_dim(guests, people, "contact_id", "_person", "guest_id").select(
        "order_number", "ticket_number", "guest_id", "guest_type", "created_date", "created_time",
        F.coalesce("c_first_name", "first_name").alias("buyer_first_name"),
        F.coalesce("c_last_name", "last_name").alias("buyer_last_name"),
        F.coalesce("c_primary_email", "email").alias("buyer_email"),
        "event_id", "attendance_status", "checked_in", "contact_id")
    wide = join_dim(wide, shows, "event_id", "_event", "guest_id")
    low, high = safe_float(F.col("e_lowest_price")), safe_float(F.col("e_highest_price"))
    out = wide.select(
        "order_number", "ticket_number", "guest_id", "guest_type",
        F.col("created_date").alias("order_date"), F.col("created_time").alias("order_time"),
        "buyer_first_name", "buyer_last_name", "buyer_email",
        F.col("e_title").alias("event_name"), "event_id",
        F.col("e_start_date").alias("event_start_date"),
        F.col("e_start_time").alias("event_start_time"),
        F.col("e_end_date").alias("event_end_date"), F.col("e_end_time").alias("event_end_time"),
        F.col("e_timezone").alias("event_timezone"),
        F.col("e_location_name").alias("event_location"),
        F.col("e_location_city").alias("event_city"), F.col("e_status").alias("event_status"),
        F.col("e_currency").alias("currency"), low.alias("ticket_price_low"),
        high.alias("ticket_price_high"),
        F.when(F.col("_event").isNotNull(), midpoint_price(low, high))
        .alias("estimated_ticket_price"),
        "attendance_status", "checked_in", "contact_id",
    )
    return out.orderBy(
        F.col("order_date").desc_nulls_last(), F.col("event_name").asc_nulls_last(), "guest_id")


def guests_enriched(guests: DataFrame, contacts: DataFrame, events: DataFrame) -> DataFrame:
    """Guests with ``contact_*`` and ``event_*`` columns.

    The dimensions are staged, as Spark splits a hot key only in a join of two plain shuffles.
    """
    people = prefixed(last_wins(contacts, "contact_id"), "contact_", "contact_id",
                      "full_name", "primary_email", "is_member").withColumnRenamed(
        "contact_id", "_person")
    people = by_key(stage(people, "people"))
    shows = prefixed(last_wins(events, "event_id"), "event_", "event_id",
                     "title", "start_date", "category_names").withColumnRenamed(
        "event_id", "_event")
    shows = by_key(stage(shows, "shows"))
    wide = join_dim(guests, people, "contact_id", "_person", "guest_id").drop("_person")
    return join_dim(wide, shows, "event_id", "_event", "guest_id").drop("_event")


def contact_event_history(contacts: DataFrame, guests: DataFrame) -> DataFrame:
    """Per contact: distinct events and attendances, 0 for contacts without guests."""
    seen = guests.where(F.length("contact_id") > 0).groupBy("contact_id").agg(
        F.count_distinct("event_id").alias("unique_events_count"),
        F.count("*").alias("total_attendances"),
    )
    zero = F.lit(0).cast("bigint")
    people = last_wins(contacts, "contact_id").select(
        "contact_id", "full_name", "primary_email", "is_member")
    return people.join(seen, "contact_id", "left").withColumns({
        "unique_events_count": F.coalesce("unique_events_count", zero),
        "total_attendances": F.coalesce("total_attendances", zero),
    })


def event_attendance(events: DataFrame, guests: DataFrame) -> DataFrame:
    """Per event: guests, distinct contacts, buyers and holders, 0 for empty events."""
    seen = guests.where(F.length("event_id") > 0).groupBy("event_id").agg(
        F.count("*").alias("total_guests"),
        F.count_distinct("contact_id").alias("unique_contacts"),
        F.count_if(F.col("guest_type") == "BUYER").alias("buyer_count"),
        F.count_if(F.col("guest_type") == "TICKET_HOLDER").alias("ticket_holder_count"),
    )
    zero = F.lit(0).cast("bigint")
    counts = ("total_guests", "unique_contacts", "buyer_count", "ticket_holder_count")
    shows = last_wins(events, "event_id").select(
        "event_id", "title", "start_date", "status", "category_names")
    return shows.join(seen, "event_id", "left").withColumns(
        {c: F.coalesce(c, zero) for c in counts})
