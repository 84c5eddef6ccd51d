"""Lookups and filters over entity tables."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, functions as F


def upcoming_ticketing(events: DataFrame) -> DataFrame:
    """Upcoming events that sell tickets; both tests reach the scan."""
    return events.where("status = 'UPCOMING' AND registration_type = 'TICKETING'")


def mentions(c: Column, pattern: str) -> Column:
    """Case-insensitive regular-expression search; null counts as no match."""
    return F.coalesce(c.rlike(f"(?i){pattern}"), F.lit(False))


def contact_events(guests_enriched: DataFrame, email_or_name: str) -> DataFrame:
    """Events of every contact whose e-mail or name matches, newest first."""
    hit = mentions(F.col("contact_primary_email"), email_or_name) | mentions(
        F.col("contact_full_name"), email_or_name)
    return guests_enriched.where(hit).select(
        "contact_full_name", "contact_primary_email", "event_title", "event_start_date",
        "guest_type", "order_number",
    ).distinct().orderBy(F.col("event_start_date").desc_nulls_last(), "event_title",
                         "order_number")


def event_attendees(guests_enriched: DataFrame, title: str) -> DataFrame:
    """Attendees of every event whose title matches."""
    return guests_enriched.where(mentions(F.col("event_title"), title)).select(
        "event_title", "event_start_date", "contact_full_name", "contact_primary_email",
        "guest_type", "attendance_status",
    ).distinct().orderBy("event_title", "contact_full_name")


def category_attendees(guests_enriched: DataFrame, category: str) -> DataFrame:
    """Contacts who attended an event of a matching category."""
    return guests_enriched.where(mentions(F.col("event_category_names"), category)).select(
        "contact_full_name", "contact_primary_email", "contact_is_member",
    ).distinct().orderBy("contact_full_name")


def find(
    df: DataFrame, where: dict[str, object] | None = None, sort: list[Column] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows matching every given value (a list means any of), sorted and capped on demand."""
    for name, value in (where or {}).items():
        c = F.col(name)
        df = df.where(c.isin(*value) if isinstance(value, (list, tuple, set)) else c == value)
    if sort:
        df = df.orderBy(*sort)
    return df if limit is None else df.limit(limit)


def contacts_by_email(raw_contacts: DataFrame, email: str) -> DataFrame:
    """Raw contacts that list the e-mail address."""
    return raw_contacts.where(F.exists("info.emails.items", lambda e: e["email"] == email))


def contacts_by_phone(raw_contacts: DataFrame, phone: str) -> DataFrame:
    """Raw contacts that list the phone number."""
    return raw_contacts.where(F.exists("info.phones.items", lambda p: p["phone"] == phone))


def payments_filter(
    payments: DataFrame, from_date: str | None = None, to_date: str | None = None,
    currency: str | None = None, provider: str | None = None, method: str | None = None,
    status: list[str] | None = None, app_id: str | None = None, order: str = "date:desc",
    max_results: int | None = None,
) -> DataFrame:
    """Payments by creation range and attributes, sorted by date, optionally capped."""
    if order not in ("date:asc", "date:desc"):
        raise ValueError("order must be date:asc or date:desc")
    at = F.col("payment_datetime")
    tests = [
        at >= from_date if from_date else None,
        at <= to_date if to_date else None,
        F.col("currency") == currency if currency else None,
        F.col("payment_provider_friendly") == provider if provider else None,
        F.col("payment_method") == method if method else None,
        F.col("status").isin(*status) if status else None,
        F.col("app_id") == app_id if app_id else None,
    ]
    for test in tests:
        if test is not None:
            payments = payments.where(test)
    first = at.asc() if order == "date:asc" else at.desc()
    payments = payments.orderBy(first, "transaction_id")
    return payments if max_results is None else payments.limit(max_results)


def filter_rows(df: DataFrame, expression: str) -> DataFrame:
    """Rows matching a SQL expression; an invalid one warns and leaves the table unchanged."""
    try:
        return df.where(F.expr(expression))
    except (AnalysisException, ParseException) as e:
        warnings.warn(f"not filtered, {expression!r} is invalid: {e}", stacklevel=2)
        return df
