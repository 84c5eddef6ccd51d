"""People behind ticket stubs: one buyer may hold paid and free stubs for the same event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnstile.functions.values import blank_to_null
from turnstile.operators.orders import (
    is_paid_stub,
    paid_cutoff,
    stub_key,
)
from turnstile.session import by_key

STUB_FIELDS = (
    "guest_id", "event_id", "contact_id", "guest_type", "order_number", "ticket_number",
    "primary_ticket_number", "primary_ticket_definition_id", "primary_ticket_name",
    "attendance_status", "order_status", "first_name", "last_name", "full_name", "email",
    "phone", "checked_in", "created_date", "created_time", "_ord",
)
CONTEXT_FIELDS = (
    "buyer", "tickets_in_order", "order_payment_status", "paid_tickets_per_order",
    "product_name", "first_seen",
)


def ticket_stubs(
    guests: DataFrame,
    context: DataFrame,
    include_inactive: bool = False,
) -> DataFrame:
    """One row per kept ticket stub with its ``order_context`` and paid flag.

    Holders and RSVPs of an order are kept unless the order's payment is inactive; orders
    with only a buyer produce nothing. Guests without an order number are kept unless they
    are buyers. No window runs over the stubs, so AQE may split a hot order in the join.
    """
    if not include_inactive:
        context = context.where(~F.col("inactive"))
    context = context.join(by_key(paid_cutoff(guests, context)), "order_number", "left")
    fields = guests.select(*STUB_FIELDS)
    key = stub_key(F.col("ticket_number"), F.col("_ord"))
    ordered = (
        fields.where(
            (F.length("order_number") > 0) & F.col("guest_type").isin("TICKET_HOLDER", "RSVP")
        )
        .join(by_key(context), "order_number")
        .select(
            *STUB_FIELDS, *CONTEXT_FIELDS,
            is_paid_stub(F.col("guest_type"), key).alias("is_paid_ticket_stub"),
        )
    )
    kinds = {f.name: f.dataType for f in ordered.schema.fields}
    orphans = fields.where(
        blank_to_null(F.col("order_number")).isNull()
        & ~F.col("guest_type").eqNullSafe(F.lit("BUYER"))
    ).select(
        *STUB_FIELDS,
        *[
            F.lit(0).cast(kinds[c]).alias(c) if c == "paid_tickets_per_order"
            else F.lit(None).cast(kinds[c]).alias(c)
            for c in CONTEXT_FIELDS
        ],
        F.lit(None).cast("boolean").alias("is_paid_ticket_stub"),
    )
    return ordered.unionByName(orphans).withColumn("buyer_contact_id", F.col("buyer.contact_id"))


def seat_rank_key() -> Column:
    """Order of stubs within (event, buyer): paid first, by number, orphans last."""
    return F.struct(
        (~F.coalesce(F.col("is_paid_ticket_stub"), F.lit(False))).alias("unpaid"),
        stub_key(F.col("ticket_number"), F.lit(0)).alias("key"),
        F.col("first_seen").isNull().alias("orphan"),
        F.col("first_seen").alias("order"),
        F.col("_ord").alias("ord"),
    )


def headcount_by_buyer(stubs: DataFrame) -> DataFrame:
    """Per (event, buyer): paid and free stubs, RSVPs, people and the first seat.

    When both paid and free stubs exist, the free ones belong to the paid people. A plain
    aggregate: hot groups, such as all orphans of an event, are combined before the shuffle.
    """
    holder = F.col("guest_type") == "TICKET_HOLDER"
    paid = holder & F.coalesce(F.col("is_paid_ticket_stub"), F.lit(False))
    counted = stubs.groupBy("event_id", "buyer_contact_id").agg(
        F.count_if(paid).alias("paid"),
        (F.count_if(holder) - F.count_if(paid)).alias("free"),
        F.count_if(F.col("guest_type") == "RSVP").alias("rsvps"),
        F.min(F.when(holder, seat_rank_key())).alias("_seat"),
    )
    mixed = (F.col("paid") > 0) & (F.col("free") > 0)
    return counted.select(
        "event_id", "buyer_contact_id", "paid", "free", "rsvps",
        F.when(mixed, F.col("paid")).otherwise(F.greatest("paid", "free")).alias("humans"),
        F.col("_seat.ord").alias("first_seat"),
    )


def count_people(stubs: DataFrame) -> DataFrame:
    """Add humans_at_event_for_buyer, counts_as_human and is_partner_seat to every stub.

    The people of a mixed group are exactly its paid stubs and of any other group all its
    stubs, so no rank is needed beyond knowing the group's first seat.
    """
    groups = by_key(headcount_by_buyer(stubs)).select(
        F.col("event_id").alias("_g_event"), F.col("buyer_contact_id").alias("_g_buyer"),
        "paid", "free", "rsvps", "humans", "first_seat",
    )
    joined = stubs.join(
        groups,
        stubs["event_id"].eqNullSafe(groups["_g_event"])
        & stubs["buyer_contact_id"].eqNullSafe(groups["_g_buyer"]),
    )
    kind = F.col("guest_type")
    mixed = (F.col("paid") > 0) & (F.col("free") > 0)
    human = F.when(
        kind == "TICKET_HOLDER",
        ~mixed | F.coalesce(F.col("is_paid_ticket_stub"), F.lit(False)),
    ).when(kind == "RSVP", True)
    return joined.withColumns({
        "counts_as_human": human,
        "humans_at_event_for_buyer": F.when(kind == "TICKET_HOLDER", F.col("humans")).when(
            kind == "RSVP", F.col("humans") + F.col("rsvps")
        ),
        "is_partner_seat": F.coalesce(
            (kind == "TICKET_HOLDER") & human & (F.col("_ord") != F.col("first_seat")),
            F.lit(False),
        ),
    }).drop("_g_event", "_g_buyer", "paid", "free", "rsvps", "humans", "first_seat")
