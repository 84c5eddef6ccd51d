"""Friendly labels for raw codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Raw payment status -> dashboard label.
STATUS_LABELS = {
    "APPROVED": "Successful",
    "AUTHORIZED": "Successful",
    "PENDING": "Pending",
    "PENDING_BUYER": "Pending",
    "PENDING_MERCHANT": "Pending",
    "IN_PROCESS": "Pending",
    "INITIALIZED": "Pending",
    "REFUND": "Refunded",
    "PARTIAL_REFUND": "Partially refunded",
    "CHARGE_BACK": "Chargeback",
    "DISPUTE": "Dispute",
    "DECLINED": "Declined",
    "FAILED": "Failed",
    "EXPIRED": "Expired",
    "TIMEOUT": "Timed out",
    "BUYER_CANCELED": "Cancelled",
    "VOID": "Voided",
    "TPA_CANCELED": "Cancelled",
    "OFFLINE": "Offline",
    "COMPLETED_FUNDS_HELD": "Funds held",
}

# Raw provider -> label. A missing provider means cash at the door.
PROVIDER_LABELS = {
    "com.stripe": "Stripe",
    "payPal": "PayPal",
    "paypal": "PayPal",
    "NA": "Pay in person",
    "": "Pay in person",
}

# Application ids -> label.
APP_LABELS = {
    "140603ad-af8d-84a5-2c80-a0f60cb47351": "Events & Tickets",
    "215238eb-22a5-4c36-9e7b-e7c08025e04e": "Stores",
    "13d21c63-b5ec-5912-8397-c3a5ddb27a97": "Bookings",
}

# An order whose latest payment has one of these does not count.
INACTIVE_STATUSES = [
    "REFUND",
    "PARTIAL_REFUND",
    "BUYER_CANCELED",
    "DECLINED",
    "FAILED",
    "CHARGE_BACK",
    "VOID",
    "EXPIRED",
]

# Fixed value: id of the synthetic fee line inside a payment's item list.
FEE_ITEM_ID = "SERVICE_FEE"

# Fixed value: name of the per-order fee line that inflates the quantity by one.
APPLICATION_FEE = "Application Fee"

# Weekday order for reports.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def lookup(c: Column, mapping: dict[str, str]) -> Column:
    """Map lookup by literal table, null when absent."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.element_at(F.create_map(*pairs), c)


def title_case(c: Column) -> Column:
    """Capitalise every run of letters, so ``SOME_NEW`` becomes ``Some_New``."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def status_label(status: Column, amount: Column, refunded: Column) -> Column:
    """Dashboard label; an approved payment with succeeded refunds reads as refunded."""
    plain = F.when(
        F.length(status) > 0, F.coalesce(lookup(status, STATUS_LABELS), title_case(status))
    )
    whole = F.coalesce((amount != 0) & (refunded >= amount), F.lit(False))
    return (
        F.when(
            (status == "APPROVED") & (F.coalesce(refunded, F.lit(0)) != 0),
            F.when(whole, "Refunded").otherwise("Partially refunded"),
        )
        .otherwise(plain)
    )


def provider_label(provider: Column, provider_name: Column) -> Column:
    raw = F.coalesce(provider, F.lit(""))
    named = F.when(F.length(provider_name) > 0, provider_name)
    return F.coalesce(lookup(raw, PROVIDER_LABELS), named, F.when(F.length(raw) > 0, raw))


def app_name(app_id: Column, labels: dict[str, str] | None = None) -> Column:
    return lookup(app_id, labels or APP_LABELS)
