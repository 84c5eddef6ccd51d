"""Dimension building and dimension joins.

No join here is forced to broadcast. What grows with the data is shuffled (``by_key``), and AQE
splits skewed partitions; Spark may broadcast the events, by their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from turnstile.functions.values import blank_to_null, safe_float, safe_int
from turnstile.session import by_key, stage


def last_wins(df: DataFrame, key: str, order: str = "_ord") -> DataFrame:
    """One row per key, the last in input order; rows with a blank key are dropped.

    Spark turns the ``= 1`` filter into a group limit before the shuffle, so a hot key
    sends at most one row per map task.
    """
    window = Window.partitionBy(key).orderBy(F.col(order).desc())
    return (
        df.where(F.length(F.col(key)) > 0)
        .withColumn("_rank", F.row_number().over(window))
        .where("_rank = 1")
        .drop("_rank")
    )


def spread_key(key: Column, spread_by: Column) -> Column:
    """Join key whose null and blank values are spread over many partitions.

    They match nothing, so they only need to stay out of a single task.
    """
    filler = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(spread_by), F.lit(1 << 16)).cast("string"))
    return F.coalesce(blank_to_null(key), filler)


def join_dim(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, spread_by: str
) -> DataFrame:
    """Left join to a one-row-per-key dimension whose columns do not clash with the fact's."""
    # The key is an expression of the join, so that no copy of it is shuffled with the rows.
    return fact.join(dim, spread_key(fact[fact_key], fact[spread_by]) == dim[dim_key], "left")


def prefixed(df: DataFrame, prefix: str, key: str, *columns: str) -> DataFrame:
    """Key plus columns renamed with a prefix; absent columns come out null."""
    picked = [
        (F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(prefix + c)
        for c in columns
    ]
    return df.select(key, *picked)


def event_capacity(definitions: DataFrame) -> DataFrame:
    """Per event: sum of initial limits (null if none is given) and number of definitions."""
    return (
        definitions.where(F.length("event_id") > 0)
        .groupBy("event_id")
        .agg(
            F.sum(safe_int(F.col("initial_limit"))).alias("event_total_capacity"),
            F.count("*").alias("event_distinct_td_count"),
        )
    )


def person_dim(contacts: DataFrame, members: DataFrame) -> DataFrame:
    """Contacts and member accounts by contact id, so a fact needs one join for both."""
    people = prefixed(
        last_wins(contacts, "contact_id"), "c_", "contact_id",
        "first_name", "last_name", "full_name", "primary_email", "email", "is_member", "member_id",
    )
    accounts = prefixed(
        last_wins(members, "contact_id"), "m_", "contact_id",
        "member_id", "created_date", "last_login_date",
    )
    return people.join(accounts, "contact_id", "full").withColumnRenamed("contact_id", "_person")


def event_dim(
    events: DataFrame, summaries: DataFrame, definitions: DataFrame | None = None
) -> DataFrame:
    """Events, sales summaries and ticket capacity by event id, for one fact join."""
    shown = prefixed(
        last_wins(events, "event_id").withColumn("found", F.lit(True)), "e_", "event_id",
        "found", "title", "slug", "status", "registration_type", "category_names",
        "category_count", "start_date", "start_time", "start_datetime", "day_of_week",
        "is_weekend", "location_name", "location_city", "lowest_price", "highest_price",
        "currency",
    )
    sales = prefixed(
        last_wins(summaries, "event_id"), "s_", "event_id",
        "total_orders", "total_tickets", "total_sales_amount", "total_sales_currency",
        "avg_ticket_price",
    )
    out = shown.join(sales, "event_id", "full")
    if definitions is not None:
        out = out.join(event_capacity(definitions), "event_id", "full")
    return out.withColumnRenamed("event_id", "_event")


def lone_order_tickets(tickets: DataFrame) -> DataFrame:
    """Tickets that are the only one of their (event, order)."""
    return (
        tickets.where((F.length("event_id") > 0) & (F.length("order_number") > 0))
        .groupBy("event_id", "order_number")
        .agg(F.count("*").alias("_n"), F.max(F.struct(*_TICKET)).alias("_t"))
        .where("_n = 1")
        .select(F.col("event_id").alias("_lone_event"), F.col("order_number").alias("_lone_order"),
                F.col("_t").alias("_lone"))
    )


_TICKET = (
    "ticket_number", "ticket_definition_id", "ticket_name", "price_value", "price_currency",
    "free", "checked_in", "check_in_date", "check_in_time",
)


def ticket_lookup(guests: DataFrame, tickets: DataFrame) -> DataFrame:
    """Add struct ``ticket``: by ticket number, else the only ticket of the guest's order."""
    number = F.coalesce(
        blank_to_null(F.col("ticket_number")), F.col("primary_ticket_number")
    )
    by_number = last_wins(tickets, "ticket_number").select(
        F.col("ticket_number").alias("_number"), F.struct(*_TICKET).alias("_numbered")
    )
    out = join_dim(
        guests.withColumn("_wanted", number), by_key(by_number), "_wanted", "_number", "_ord"
    )
    lone = by_key(lone_order_tickets(tickets))
    # Only rows without a direct hit need the fallback; the others get a key that misses.
    open_order = F.when(F.col("_numbered").isNull(), F.col("order_number"))
    out = out.join(
        lone, (spread_key(open_order, F.col("_ord")) == lone["_lone_order"])
        & (out["event_id"] == lone["_lone_event"]), "left")
    return out.withColumn("ticket", F.coalesce("_numbered", "_lone")).drop(
        "_number", "_numbered", "_lone", "_lone_order", "_lone_event"
    )


ANCHOR_LETTERS = 4
# A set of keys as bits: words of 16 longs. It is broadcast, and its size does not grow with the data.
FILTER_WORDS, FILTER_LONGS = 1 << 16, 16


def _substrings(text: Column, size: Column) -> Column:
    """The distinct substrings of a length; none where the text is shorter."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.when(F.length(text) >= size, F.array_distinct(
        F.transform(starts, lambda i: text.substr(i, size))))


def may_match(rows: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """The rows whose values are among the keys, and a few others.

    A hash of each key sets one bit of a table of fixed size, which is broadcast; the more keys
    there are, the more other rows stay. An equi-join behind it then shuffles few rows.
    """
    hashed = F.xxhash64(*names)
    word = F.pmod(hashed, F.lit(FILTER_WORDS)).cast("int")
    bit = F.pmod(F.shiftright(hashed, 32), F.lit(FILTER_LONGS * 64)).cast("int")
    slot, mask = F.floor(bit / 64).cast("int"), F.expr("shiftleft(1L, _bit % 64)")
    marked = keys.select(word.alias("_word"), slot.alias("_slot"), bit.alias("_bit")).withColumn(
        "_mask", mask).groupBy("_word").agg(F.array(*[
            F.coalesce(F.bit_or(F.when(F.col("_slot") == i, F.col("_mask"))), F.lit(0).cast("long"))
            for i in range(FILTER_LONGS)]).alias("_bits"))
    found = rows.select("*", word.alias("_word"), bit.alias("_bit")).join(F.broadcast(marked), "_word")
    return found.where(
        F.get("_bits", F.floor(F.col("_bit") / 64).cast("int")).bitwiseAND(mask) != 0
    ).select(*rows.columns)


def anchor_candidates(texts: DataFrame, needles: DataFrame,
                      letters: int = ANCHOR_LETTERS) -> DataFrame:
    """(event_id, text, needle): pairs of an event that share the needle's anchor.

    The anchor of a needle is whichever of its ``letters``-letter pieces the fewest texts of the
    event hold; a needle with a piece that no text holds is in none of them. Shorter needles are
    their own anchor. Pieces and not events are the join key, so a hot event spreads over the
    cluster, and a text only meets needles whose rarest piece it has.
    """
    size = F.lit(letters)
    long = needles.where(F.length("needle") >= letters).select("event_id", "needle", F.explode(
        _substrings(F.col("needle"), size)).alias("piece"))
    # Only pieces that some needle of the event has are counted and joined.
    held = stage(may_match(texts.select("event_id", "text", F.explode(
        _substrings(F.col("text"), size)).alias("piece")), long, "event_id", "piece"), "text-pieces")
    counts = held.groupBy("event_id", "piece").agg(F.count("*").alias("n"))
    anchors = stage(long.join(by_key(counts), ["event_id", "piece"], "left").groupBy(
        "event_id", "needle").agg(
        F.count_if(F.col("n").isNull()).alias("absent"),
        F.min(F.struct("n", "piece")).alias("rarest")).where("absent = 0").select(
        "event_id", "needle", F.col("rarest.piece").alias("piece")), "anchors")
    held = stage(may_match(held, anchors, "event_id", "piece"), "anchor-pieces")
    short = needles.where(F.length("needle") < letters).select(
        "event_id", F.col("needle").alias("piece"), F.length("needle").alias("size"))
    sizes = short.select("event_id", "size").distinct()
    brief = texts.join(by_key(sizes), "event_id").select("event_id", "text", F.explode(
        _substrings(F.col("text"), F.col("size"))).alias("piece"))
    return held.join(by_key(anchors), ["event_id", "piece"]).select("event_id", "text", "needle").unionByName(
        brief.join(by_key(short), ["event_id", "piece"]).select(
            "event_id", "text", F.col("piece").alias("needle")))


def match_ticket_definitions(baskets: DataFrame, definitions: DataFrame) -> DataFrame:
    """Ticket definitions named inside a payment's product text, per (event, product text).

    ``baskets`` holds event_id and product_name. Distinct texts meet distinct names by
    ``anchor_candidates``. Numbers are typed when one definition (or one value) is found;
    several values come as joined ``*_text`` only, in input order.
    """
    products = stage(baskets.select(
        "event_id", "product_name", F.lower("product_name").alias("text")).where(
        (F.length("event_id") > 0) & (F.length("product_name") > 0)).distinct(), "products")
    name = F.lower(F.trim(F.col("name")))
    offered = definitions.where((F.length("event_id") > 0) & (F.length(name) > 0)).select(
        "event_id", name.alias("needle"), "_ord",
        blank_to_null(F.col("name")).alias("name"),
        safe_float(F.col("fixed_price_value")).alias("fixed_price_value"),
        blank_to_null(F.col("pricing_type")).alias("pricing_type"),
        safe_int(F.col("initial_limit")).alias("initial_limit"),
        safe_int(F.col("actual_limit")).alias("actual_limit"),
        safe_int(F.col("limit_per_checkout")).alias("limit_per_checkout"))
    hits = anchor_candidates(
        products.select("event_id", "text").distinct(),
        offered.select("event_id", "needle").distinct()).where(F.col("text").contains(F.col("needle")))
    named = products.join(by_key(hits), ["event_id", "text"]).join(
        by_key(offered), ["event_id", "needle"])

    def joined(field: str) -> Column:
        return F.expr(f"listagg(CAST({field} AS STRING), ', ') WITHIN GROUP (ORDER BY _ord)")

    columns = {"td_name": joined("name"), "td_pricing_type": joined("pricing_type")}
    for field in ("fixed_price_value", "initial_limit", "actual_limit", "limit_per_checkout"):
        columns[f"td_{field}"] = F.when(F.count(field) == 1, F.max(field))
        columns[f"td_{field}_text"] = joined(field)
    confidence = F.when(F.count("*") == 1, "exact").otherwise("ambiguous")
    return named.groupBy(
        F.col("event_id").alias("_td_event"), F.col("product_name").alias("_td_product")).agg(
        *[e.alias(n) for n, e in columns.items()], confidence.alias("td_match_confidence"))
