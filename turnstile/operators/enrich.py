"""Joins that complete entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnstile.operators.dims import join_dim, last_wins, spread_key


def tickets_with_definitions(tickets: DataFrame, definitions: DataFrame) -> DataFrame:
    """Add the five ``def_*`` columns of the ticket's definition."""
    lookup = last_wins(definitions, "definition_id").select(
        F.col("definition_id").alias("_definition"),
        F.col("pricing_type").alias("def_pricing_type"),
        F.col("fee_type").alias("def_fee_type"),
        F.col("sale_status").alias("def_sale_status"),
        F.col("sold_count").alias("def_sold_count"),
        F.col("sold_out").alias("def_sold_out"),
    )
    return join_dim(
        tickets, lookup, "ticket_definition_id", "_definition", "ticket_number"
    ).drop("_definition")


def exclude_rsvp_guests(guests: DataFrame, events: DataFrame) -> DataFrame:
    """Guests that are not at an RSVP event; guests without an event are kept."""
    rsvp = events.where("registration_type = 'RSVP'").select(
        F.col("event_id").alias("_rsvp_event")).where(F.length("_rsvp_event") > 0)
    keyed = guests.withColumn("_key", spread_key(F.col("event_id"), F.col("guest_id")))
    return keyed.join(rsvp, F.col("_key") == F.col("_rsvp_event"), "left_anti").drop("_key")


def orders_with_transactions(orders: DataFrame, summary: DataFrame) -> DataFrame:
    """Orders with their transaction roll-up; an order without any gets a count of 0."""
    joined = join_dim(orders, summary, "order_id", "orderId", "order_id").drop("orderId")
    return joined.withColumn("transaction_count", F.coalesce("transaction_count", F.lit(0)))


def summaries_for_events(events: DataFrame, summaries: DataFrame) -> DataFrame:
    """One sales summary per event; an event without one gets a no-sales row."""
    sales = last_wins(summaries, "event_id").drop("_ord", "event_title", "has_sales")
    joined = events.select("event_id", F.col("title").alias("event_title")).join(
        sales.withColumn("_found", F.lit(True)), "event_id", "left"
    )
    zero = F.lit(0).cast("bigint")
    return joined.withColumns({
        "event_title": F.coalesce("event_title", F.lit("Untitled Event")),
        "total_orders": F.coalesce("total_orders", zero),
        "total_tickets": F.coalesce("total_tickets", zero),
        "has_sales": F.col("_found").isNotNull(),
    }).drop("_found")


def patch_records(bulk: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """Replace whole records by their re-fetched version where there is one."""
    fresh = last_wins(detail, key).select(
        F.col(key).alias("_fresh_key"),
        F.struct(*[c for c in bulk.columns]).alias("_fresh"),
    )
    joined = join_dim(bulk, fresh, key, "_fresh_key", key)
    found = F.col("_fresh_key").isNotNull()
    return joined.select(*[
        F.when(found, F.col(f"_fresh.{c}")).otherwise(F.col(c)).alias(c) for c in bulk.columns
    ])


def educator_feed(events: DataFrame, summaries: DataFrame) -> DataFrame:
    """Upcoming ticketing events with tickets sold and revenue."""
    sales = last_wins(summaries, "event_id").select(
        "event_id", F.col("total_tickets").alias("tickets_sold"),
        F.col("total_sales_amount").alias("total_revenue"),
    )
    chosen = events.where("status = 'UPCOMING' AND registration_type = 'TICKETING'").select(
        "event_id", "title", "start_date", "start_time", "category_names")
    joined = chosen.join(sales, "event_id", "left")
    return joined.select(
        "title", "start_date", "start_time", "category_names",
        F.coalesce("tickets_sold", F.lit(0).cast("bigint")).alias("tickets_sold"),
        "total_revenue",
    )


# The columns of the feed.
SOCIALS = (
    "title", "day_of_week", "start_date", "start_time", "short_description", "lowest_price",
    "highest_price", "location_name", "event_page_url", "main_image_url", "sold_out",
)


def socials_feed(events: DataFrame) -> DataFrame:
    """Upcoming ticketing events for posts, by start date, undated first."""
    chosen = events.where("status = 'UPCOMING' AND registration_type = 'TICKETING'")
    return chosen.select(*[c for c in SOCIALS if c in events.columns]).orderBy(
        F.coalesce("start_date", F.lit("")), "title")


def reconcile(left: DataFrame, right: DataFrame, key: str, status: str) -> DataFrame:
    """Compare two exports by key: counts of matched, missing and differing status."""
    a = left.where(F.length(key) > 0).groupBy(key).agg(F.max(status).alias("_a"))
    b = right.where(F.length(key) > 0).groupBy(key).agg(F.max(status).alias("_b"))
    a, b = a.withColumn("_in_a", F.lit(True)), b.withColumn("_in_b", F.lit(True))
    both = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    return a.join(b, key, "full").agg(
        F.count_if(both).alias("matched"),
        F.count_if(F.col("_in_b").isNull()).alias("left_only"),
        F.count_if(F.col("_in_a").isNull()).alias("right_only"),
        F.count_if(both & ~F.col("_a").eqNullSafe(F.col("_b"))).alias("status_differs"),
    )


def upsert_latest(
    existing: DataFrame, delta: DataFrame, key: str, updated: str = "updated_datetime"
) -> DataFrame:
    """Merge changed rows into a table: per key the row updated last, the delta on ties."""
    from pyspark.sql import Window

    both = existing.withColumn("_new", F.lit(0)).unionByName(
        delta.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    ties = [F.col("_ord").desc()] if "_ord" in both.columns else []
    window = Window.partitionBy(key).orderBy(
        F.col(updated).desc_nulls_last(), F.col("_new").desc(), *ties)
    return (
        both.where(F.length(F.col(key)) > 0)
        .withColumn("_rank", F.row_number().over(window))
        .where("_rank = 1").drop("_rank", "_new")
    )


def coupons_all(
    active: DataFrame, expired: DataFrame, include_expired: bool = True, distinct: bool = False
) -> DataFrame:
    """Active and expired coupons; a coupon in both pulls appears twice unless distinct."""
    if not include_expired:
        return active
    both = active.unionByName(expired, allowMissingColumns=True)
    return both.dropDuplicates(["coupon_id"]) if distinct else both
