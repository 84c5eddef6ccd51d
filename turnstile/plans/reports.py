"""Questions answered from the facts and views.

Top lists end their sort in a unique column, so ties always come out the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnstile.functions.labels import WEEKDAYS
from turnstile.functions.values import to_money


def money_sum(name: str) -> Column:
    """Exact sum as double."""
    return F.sum(to_money(F.col(name))).cast("double")


def money_avg(name: str) -> Column:
    return money_sum(name) / F.count(name)


def popular_categories(attendance: DataFrame) -> DataFrame:
    """Stubs per first-listed category."""
    first = F.split_part("category_names", F.lit(","), F.lit(1)).alias("primary_cat")
    return attendance.groupBy(first).agg(F.count("*").alias("attendees")).orderBy(
        F.col("attendees").desc(), "primary_cat")


def comp_usage(attendance: DataFrame) -> DataFrame:
    """Free and paid stubs of members and non-members with a known order status."""
    known = attendance.where("order_status IS NOT NULL")
    return known.groupBy("is_member", "free").agg(F.count("*").alias("stubs")).orderBy(
        "is_member", "free")


def repeat_guests(attendance: DataFrame, at_least: int = 3) -> DataFrame:
    """E-mails seen at several distinct events."""
    per_mail = attendance.groupBy("email").agg(
        F.count_distinct("event_id").alias("events_attended"))
    return per_mail.where(F.col("events_attended") >= at_least).orderBy(
        F.col("events_attended").desc(), "email")


def category_guests(attendance: DataFrame, like: str, since: str) -> DataFrame:
    """Stubs at events of a category since a date."""
    return attendance.where(
        F.col("category_names").like(like) & (F.col("start_date") >= since)
    ).select("full_name", "email", "event_title", "start_date", "paid_bucket")


def _successful(payments: DataFrame) -> DataFrame:
    return payments.where("transaction_status = 'Successful'")


def top_events_by_revenue(payments: DataFrame, n: int = 10) -> DataFrame:
    """Events with the highest successful revenue."""
    return _successful(payments).groupBy("event_title").agg(
        money_sum("amount").alias("revenue"), F.count("*").alias("payment_count"),
    ).orderBy(F.col("revenue").desc(), "event_title").limit(n)


def revenue_by_category(payments: DataFrame) -> DataFrame:
    return _successful(payments).groupBy("category_names").agg(
        F.count("*").alias("payments"), money_sum("amount").alias("gross"),
    ).orderBy(F.col("gross").desc(), "category_names")


def member_spend(payments: DataFrame) -> DataFrame:
    return _successful(payments).groupBy("is_member").agg(
        F.count("*").alias("payments"), money_sum("amount").alias("gross"),
        money_avg("amount").alias("avg_ticket"))


def repeat_buyers(payments: DataFrame, like: str, at_least: int = 3) -> DataFrame:
    """Buyers of several events of a series with what they spent on it."""
    chosen = _successful(payments).where(F.col("category_names").like(like))
    per_mail = chosen.groupBy("email").agg(
        F.count_distinct("event_id").alias("events"),
        money_sum("amount").alias("lifetime_value"))
    return per_mail.where(F.col("events") >= at_least).orderBy(
        F.col("lifetime_value").desc(), "email")


def refund_monitor(payments: DataFrame) -> DataFrame:
    """Refunds and chargebacks per event."""
    bad = payments.where(
        F.col("transaction_status").isin("Refunded", "Partially refunded", "Chargeback"))
    return bad.groupBy("event_title", "transaction_status").agg(
        F.count("*").alias("payments"), money_sum("refund_total_amount").alias("refunded"),
    ).orderBy(F.col("refunded").desc(), "event_title", "transaction_status")


def weekday_revenue(payments: DataFrame) -> DataFrame:
    """Revenue by weekday of the event, Monday first."""
    rank = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("event_day_of_week"))
    return _successful(payments).groupBy("event_day_of_week").agg(
        F.count("*").alias("payments"), money_sum("amount").alias("gross")).orderBy(rank)


def sold_by_definition(definitions: DataFrame) -> DataFrame:
    """Name and sold count of every ticket definition of a raw or flat table."""
    return definitions.select("name", "sold_count")


def canonical_headcount(attendance: DataFrame) -> DataFrame:
    """People per event."""
    return attendance.where("counts_as_human").groupBy("event_id").agg(
        F.count("*").alias("people"))


def repeat_attendees(history: DataFrame, n: int = 20) -> DataFrame:
    """Contacts with more than one event, most frequent first."""
    return history.where("unique_events_count > 1").orderBy(
        F.col("unique_events_count").desc(), "contact_id").limit(n).select(
        "contact_id", "full_name", "primary_email", "unique_events_count",
        "total_attendances", "is_member")


def attendance_histogram(history: DataFrame) -> DataFrame:
    """Contacts per number of events attended."""
    return history.groupBy("unique_events_count").agg(F.count("*").alias("contacts")).orderBy(
        "unique_events_count")


def attendance_buckets(history: DataFrame) -> DataFrame:
    n = F.col("unique_events_count")
    return history.agg(
        F.count_if(n == 0).alias("none"), F.count_if(n == 1).alias("one"),
        F.count_if(n >= 2).alias("two_plus"), F.count_if(n >= 5).alias("five_plus"),
        F.count_if(n >= 10).alias("ten_plus"))


def popular_events(attendance: DataFrame, n: int = 20) -> DataFrame:
    return attendance.orderBy(F.col("total_guests").desc(), "event_id").limit(n).select(
        "event_id", "title", "start_date", "total_guests", "unique_contacts", "buyer_count",
        "ticket_holder_count")


def empty_events(attendance: DataFrame) -> DataFrame:
    return attendance.where("total_guests = 0").select("event_id", "title", "start_date", "status")


def category_stats(attendance: DataFrame) -> DataFrame:
    """Events, attendances, contacts and mean attendance per category."""
    total, events = F.sum("total_guests"), F.count("*")
    return attendance.where("category_names IS NOT NULL").groupBy("category_names").agg(
        events.alias("event_count"), total.alias("total_attendances"),
        F.sum("unique_contacts").alias("total_unique_contacts"),
        F.bround(total / events, 1).alias("avg_attendance"),
    ).orderBy(F.col("total_attendances").desc(), "category_names")


def member_stats(history: DataFrame) -> DataFrame:
    """Contacts, events and attendances of members and others."""
    unique, total, people = F.sum("unique_events_count"), F.sum("total_attendances"), F.count("*")
    return history.groupBy("is_member").agg(
        people.alias("contact_count"), unique.alias("total_unique_events"),
        F.bround(unique / people, 2).alias("avg_unique_events"),
        total.alias("total_attendances"),
        F.bround(total / people, 2).alias("avg_attendances"))


def monthly_attendance(attendance: DataFrame, as_of: str, months: int = 12) -> DataFrame:
    """Past events by month, the latest months first cut and then shown in order."""
    past = attendance.where(F.col("start_date") < as_of)
    per_month = past.groupBy(F.substring("start_date", 1, 7).alias("month")).agg(
        F.count("*").alias("events_held"), F.sum("total_guests").alias("total_guests"),
        F.sum("unique_contacts").alias("unique_attendees"))
    return per_month.orderBy(F.col("month").desc()).limit(months).orderBy("month")


def event_profile(events: DataFrame, as_of: str) -> DataFrame:
    """Event counts by status and by registration type, and the date span."""
    start = F.col("start_datetime")
    by = [
        events.groupBy(F.coalesce(F.col(c), F.lit("UNKNOWN")).alias("value"))
        .agg(F.count("*").cast("string").alias("result"))
        .select(F.lit(c).alias("measure"), "value", "result")
        for c in ("status", "registration_type")
    ]
    span = events.agg(
        F.min(start).alias("earliest"), F.max(start).alias("latest"),
        F.count_if(start < as_of).cast("string").alias("past"),
        F.count_if(start >= as_of).cast("string").alias("future"),
    ).select(F.explode(F.array(*[
        F.struct(F.lit("start").alias("measure"), F.lit(c).alias("value"),
                 F.col(c).alias("result"))
        for c in ("earliest", "latest", "past", "future")
    ])).alias("r")).select("r.*")
    return by[0].unionByName(by[1]).unionByName(span)


def edge_dates(events: DataFrame, n: int = 5) -> DataFrame:
    """The first and last event dates."""
    dated = events.where(F.length("start_datetime") > 0).select("start_datetime", "event_id")
    first = dated.orderBy("start_datetime", "event_id").limit(n)
    last = dated.orderBy(F.col("start_datetime").desc(), F.col("event_id").desc()).limit(n)
    return first.withColumn("edge", F.lit("first")).unionByName(
        last.withColumn("edge", F.lit("last")))


def events_by_status(events: DataFrame) -> DataFrame:
    return events.groupBy("status").agg(F.count("*").alias("events"))


def sales_summary(event_orders: DataFrame) -> DataFrame:
    """Orders, tickets and total per event and over all; ``overall`` marks the latter.

    Orders without an event have a row of their own and are part of the total.
    """
    return event_orders.rollup("event_id").agg(
        (F.grouping_id() == 1).alias("overall"),
        F.count("*").alias("total_orders"),
        F.sum(F.col("tickets_quantity").cast("bigint")).alias("total_tickets"),
        money_sum("total").alias("total_sales"))


def rsvp_summary(rsvps: DataFrame, where: dict[str, str] | None = None) -> DataFrame:
    """RSVP counts and guests by status, after equality filters."""
    from turnstile.operators.filters import find

    return find(rsvps, where).groupBy("rsvp_status").agg(
        F.count("*").alias("rsvps"), F.sum("total_guests").alias("guests"))
