"""One row per payment with its order, event, contact, member and event sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnstile.functions.text import join_name
from turnstile.functions.values import (
    blank_to_null,
    bucket_amount,
    first_filled,
    safe_bool,
    safe_float,
)
from turnstile.operators.dims import event_dim, join_dim, last_wins, person_dim, prefixed
from turnstile.session import by_key, stage

PAYMENT_FIELDS = (
    "transaction_id", "provider_transaction_id", "order_id", "app_order_id", "payment_date",
    "payment_time", "payment_datetime", "currency", "amount", "platform_fee", "net_amount",
    "tax", "discount", "status", "transaction_status", "transaction_type", "is_refundable",
    "failure_code", "payment_provider_friendly", "payment_method", "card_network",
    "card_last_four", "refund_count", "refund_succeeded_count", "refund_total_amount",
    "refund_status", "refund_reason", "refund_date", "product_name", "product_count",
    "total_quantity", "billing_first_name", "billing_last_name", "billing_full_name",
    "billing_email", "billing_phone", "billing_city", "billing_country",
)


def build_payments_fact(
    payments: DataFrame,
    event_orders: DataFrame,
    events: DataFrame,
    contacts: DataFrame,
    members: DataFrame,
    order_summaries: DataFrame,
) -> DataFrame:
    """Join chain payment -> order -> (event + sales, contact + member).

    Exactly one row per payment; ``enrichment_status`` tells where the chain ended. Three
    joins by shuffle, each against a dimension deduplicated on its key; missing keys are spread.
    Payments carry only the columns still needed from one join to the next.
    """
    orders = prefixed(
        last_wins(event_orders, "order_number").withColumn("found", F.lit(True)),
        "o_", "order_number",
        "found", "event_id", "contact_id", "member_id", "channel", "status",
        "tickets_quantity", "ticket_names",
    ).withColumnRenamed("order_number", "_order")
    wide = join_dim(
        payments, by_key(orders), "app_order_id", "_order", "transaction_id").drop("_order", "_ord")
    people = by_key(stage(person_dim(contacts, members), "people"))
    wide = join_dim(wide, people, "o_contact_id", "_person", "transaction_id").drop("_person")
    shows = by_key(stage(event_dim(events, order_summaries), "shows"))
    wide = join_dim(wide, shows, "o_event_id", "_event", "transaction_id")

    order_key = blank_to_null(F.col("app_order_id"))
    contact_id = blank_to_null(F.col("o_contact_id"))
    member_id = first_filled(F.col("m_member_id"), F.col("o_member_id"), F.col("c_member_id"))
    flags = safe_bool(F.col("c_is_member"))
    if "is_member" in payments.columns:
        flags = F.coalesce(safe_bool(F.col("is_member")), F.lit(False)) | flags
    first = first_filled(F.col("c_first_name"), F.col("billing_first_name"))
    last = first_filled(F.col("c_last_name"), F.col("billing_last_name"))
    amount = safe_float(F.col("amount"))
    status = (
        F.when(order_key.isNull(), "no_order_id")
        .when(F.col("o_found").isNull(), "order_not_found")
        .when(F.col("e_found").isNull(), "event_not_found")
        .when(contact_id.isNull(), "no_contact_link")
        .otherwise("fully_enriched")
    )
    columns = {
        **{c: F.col(c) for c in (
            "transaction_id", "provider_transaction_id", "order_id", "app_order_id")},
        "event_id": F.col("o_event_id"),
        "contact_id": contact_id,
        "member_id": member_id,
        "enrichment_status": status,
        **{c: F.col(c) for c in (
            "payment_date", "payment_time", "payment_datetime", "currency")},
        "amount": amount,
        **{c: F.col(c) for c in ("platform_fee", "net_amount", "tax", "discount")},
        "amount_bucket": bucket_amount(amount),
        **{c: F.col(c) for c in (
            "status", "transaction_status", "transaction_type", "is_refundable",
            "failure_code")},
        "payment_provider": F.col("payment_provider_friendly"),
        **{c: F.col(c) for c in (
            "payment_method", "card_network", "card_last_four", "refund_count",
            "refund_succeeded_count", "refund_total_amount", "refund_status",
            "refund_reason", "refund_date", "product_name", "product_count",
            "total_quantity")},
        "event_title": F.col("e_title"),
        "event_slug": F.col("e_slug"),
        "event_status": F.col("e_status"),
        "registration_type": F.col("e_registration_type"),
        "category_names": F.col("e_category_names"),
        "category_count": F.col("e_category_count"),
        "event_start_date": F.col("e_start_date"),
        "event_start_time": F.col("e_start_time"),
        "event_start_datetime": F.col("e_start_datetime"),
        "event_day_of_week": F.col("e_day_of_week"),
        "event_is_weekend": F.col("e_is_weekend"),
        "location_name": F.col("e_location_name"),
        "location_city": F.col("e_location_city"),
        "event_lowest_price": F.col("e_lowest_price"),
        "event_highest_price": F.col("e_highest_price"),
        "event_total_orders": F.col("s_total_orders"),
        "event_total_tickets": F.col("s_total_tickets"),
        "event_total_sales": F.col("s_total_sales_amount"),
        "event_avg_ticket_price": F.col("s_avg_ticket_price"),
        "order_channel": F.col("o_channel"),
        "order_status": F.col("o_status"),
        "order_tickets_quantity": F.col("o_tickets_quantity"),
        "order_ticket_names": F.col("o_ticket_names"),
        "first_name": first,
        "last_name": last,
        "full_name": F.coalesce(
            first_filled(F.col("c_full_name"), F.col("billing_full_name")),
            join_name(first, last),
        ),
        "email": first_filled(
            F.col("c_primary_email"), F.col("c_email"), F.col("billing_email")),
        "phone": blank_to_null(F.col("billing_phone")),
        "is_member": F.coalesce(flags, F.lit(False)) | member_id.isNotNull(),
        "member_signup_date": F.col("m_created_date"),
        "member_last_login_date": F.col("m_last_login_date"),
        "billing_city": F.col("billing_city"),
        "billing_country": F.col("billing_country"),
    }
    return wide.select(*[e.alias(n) for n, e in columns.items()])


def enrichment_audit(fact: DataFrame) -> DataFrame:
    """Payments per join outcome."""
    return fact.groupBy("enrichment_status").agg(F.count("*").alias("payments"))
