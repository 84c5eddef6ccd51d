"""Ticket, order, payment, store-order and coupon records to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnstile.functions.labels import FEE_ITEM_ID, app_name, provider_label, status_label
from turnstile.functions.text import join_filled, join_name, join_trimmed
from turnstile.functions.values import (
    blank_to_null,
    first_filled,
    nonzero,
    safe_float,
    to_money_text,
)
from turnstile.operators.shaping import (
    kind,
    last_entries,
    shape,
    stamps,
    variant_at,
    variant_filled,
    variant_text,
)


def flatten_tickets(raw: DataFrame) -> DataFrame:
    """One row per sold ticket; registration answers in the ``form_fields`` map.

    The ``def_*`` columns come from ``tickets_with_definitions``.
    """
    price, check_in = F.col("price"), F.col("checkIn")
    checked = F.coalesce(~kind(check_in).isin("OBJECT<>", "VOID"), F.lit(False))
    answers = F.coalesce(F.col("form.inputValues"), F.array())
    entries = F.transform(answers, lambda x: F.struct(
        F.concat(
            F.lit("form_"),
            F.lower(F.regexp_replace(F.coalesce(x["inputName"], F.lit("")), "[ .]", "_")),
        ).alias("key"),
        F.when(x["value"].isNotNull() & (kind(x["value"]) != "VOID"), variant_text(x["value"]))
        .otherwise(F.when(F.size(x["values"]) > 0, F.array_join(x["values"], "; ")))
        .alias("value"),
    ))
    given = F.filter(entries, lambda e: e["value"].isNotNull())
    return shape(raw, {
        "ticket_number": F.col("ticketNumber"),
        "event_id": F.col("eventId"),
        "order_number": F.col("orderNumber"),
        "ticket_definition_id": F.col("ticketDefinitionId"),
        "ticket_name": F.col("name"),
        "policy": F.col("policy"),
        "free": F.col("free"),
        "archived": F.col("archived"),
        "order_archived": F.col("orderArchived"),
        "order_status": F.col("orderStatus"),
        "order_full_name": F.col("orderFullName"),
        "guest_full_name": F.col("guestFullName"),
        "email": F.coalesce(blank_to_null(F.col("email")), F.col("guestEmail")),
        "member_id": F.col("memberId"),
        "contact_id": F.col("contactId"),
        "price_value": safe_float(F.coalesce(
            variant_filled(price["value"]), variant_at(price["amount"], "$")
        )),
        "price_currency": price["currency"],
        "checked_in": checked,
        **{f"check_in_{p}": stamps("x", variant_at(check_in, "$.created"))[f"x_{p}"]
           for p in ("date", "time")},
        "check_in_url": F.col("checkInUrl"),
        "ticket_pdf_url": F.col("ticketPdfUrl"),
        **stamps("created", first_filled(F.col("createdDate"), F.col("_createdDate"))),
        "form_fields": last_entries(given),
    })


def flatten_ticket_definitions(raw: DataFrame) -> DataFrame:
    """One row per ticket template."""
    method = F.col("pricingMethod")
    options = F.coalesce(method["pricingOptions"]["options"], F.array())
    kept = F.filter(options, lambda o: F.length(o["name"]) > 0)
    sales = F.col("salesDetails")
    return shape(raw, {
        "definition_id": F.col("id"),
        "event_id": F.col("eventId"),
        "revision": F.col("revision"),
        "name": F.col("name"),
        "description": F.col("description"),
        "hidden": F.col("hidden"),
        "pricing_type": method["pricingType"],
        "fixed_price_value": safe_float(method["fixedPrice"]["value"]),
        "fixed_price_currency": method["fixedPrice"]["currency"],
        "guest_price_value": safe_float(method["guestPrice"]["value"]),
        "guest_price_currency": method["guestPrice"]["currency"],
        "pricing_options_count": F.size(options),
        "pricing_option_names": F.when(
            F.size(options) > 0, F.array_join(F.transform(kept, lambda o: o["name"]), "; ")
        ),
        "free": F.col("free"),
        "fee_type": F.col("feeType"),
        **stamps("sale_start", F.col("salePeriod.startDate")),
        **stamps("sale_end", F.col("salePeriod.endDate")),
        "display_not_on_sale": F.col("displayNotOnSale"),
        "sale_status": F.col("saleStatus"),
        "unsold_count": sales["unsoldCount"],
        "sold_count": sales["soldCount"],
        "reserved_count": sales["reservedCount"],
        "sold_out": sales["soldOut"],
        "initial_limit": F.col("initialLimit"),
        "actual_limit": F.col("actualLimit"),
        "limit_per_checkout": F.col("limitPerCheckout"),
        **stamps("created", first_filled(F.col("createdDate"), F.col("_createdDate"))),
        **stamps("updated", first_filled(F.col("updatedDate"), F.col("_updatedDate"))),
    })


def flatten_order_summaries(raw: DataFrame) -> DataFrame:
    """One row per event with its sales totals; events without sales get zeros.

    Computed money is two-decimal text from exact decimals.
    """
    sales = F.get(F.col("summary.sales"), F.lit(0))
    has = F.coalesce(F.size("summary.sales") > 0, F.lit(False))
    total, revenue = sales["total"]["amount"], sales["revenue"]["amount"]
    total_set, revenue_set = variant_filled(total), variant_filled(revenue)
    gross = total_set.try_cast("decimal(18,4)")
    net = revenue_set.try_cast("decimal(18,4)")
    both = total_set.isNotNull() & revenue_set.isNotNull()
    fees = gross - net
    tickets = F.coalesce(sales["totalTickets"], F.lit(0))
    zero = F.lit(0).cast("bigint")
    return shape(raw, {
        "event_id": F.col("event_id"),
        "event_title": F.coalesce(F.col("event_title"), F.lit("Untitled Event")),
        "total_sales_amount": safe_float(variant_at(total, "$")),
        "total_sales_currency": sales["total"]["currency"],
        "revenue_amount": safe_float(variant_at(revenue, "$")),
        "revenue_currency": sales["revenue"]["currency"],
        "fees_amount": F.when(both, to_money_text(fees)),
        "fees_percentage": F.when(
            both, F.when(gross > 0, to_money_text(fees * 100 / nonzero(gross))).otherwise("0.00")
        ),
        "total_orders": F.when(has, F.coalesce(sales["totalOrders"], zero)).otherwise(zero),
        "total_tickets": F.when(has, tickets).otherwise(zero),
        "avg_ticket_price": F.when(
            (tickets > 0) & total_set.isNotNull(), to_money_text(gross / nonzero(tickets))
        ),
        "has_sales": has,
    })


def _amount(v: Column) -> Column:
    """Number of a price that is either a struct with ``amount`` or a plain value."""
    return safe_float(
        F.when(kind(v).startswith("OBJECT"), variant_at(v, "$.amount")).otherwise(
            variant_at(v, "$")
        )
    )


def flatten_event_orders(raw: DataFrame) -> DataFrame:
    """One row per ticket order."""
    tickets = F.coalesce(F.col("tickets"), F.array())

    def price_text(p: Column) -> Column:
        inner = F.coalesce(variant_filled(p, "$.amount"), variant_filled(p, "$.value"))
        return F.when(kind(p).startswith("OBJECT"), inner).otherwise(variant_filled(p))

    txn = F.col("paymentDetails.transaction")
    price = F.col("paymentDetails.priceSummary")
    actions = F.coalesce(F.col("availableActions"), F.array())
    false = F.lit(False)

    def filled(name: str) -> Column:
        return blank_to_null(F.col(name))

    return shape(raw, {
        "order_number": F.col("orderNumber"),
        "event_id": F.col("eventId"),
        "reservation_id": filled("reservationId"),
        "snapshot_id": filled("snapshotId"),
        "contact_id": F.col("contactId"),
        "member_id": filled("memberId"),
        "first_name": filled("firstName"),
        "last_name": filled("lastName"),
        "email": filled("email"),
        "full_name": filled("fullName"),
        "status": F.col("status"),
        "confirmed": F.coalesce(F.col("confirmed"), false),
        "archived": F.coalesce(F.col("archived"), false),
        "anonymized": F.coalesce(F.col("anonymized"), false),
        "channel": F.col("channel"),
        "method": filled("method"),
        "tickets_quantity": F.coalesce(F.col("ticketsQuantity"), F.lit(0)),
        "tickets_pdf": filled("ticketsPdf"),
        "fully_checked_in": F.coalesce(F.col("fullyCheckedIn"), false),
        "ticket_count": F.size(tickets),
        "ticket_names": join_filled(
            F.transform(tickets, lambda t: first_filled(t["ticketName"], t["name"]))),
        "ticket_numbers": join_filled(
            F.transform(tickets, lambda t: first_filled(t["ticketNumber"], t["number"]))),
        "ticket_prices": join_filled(F.transform(tickets, lambda t: price_text(t["price"]))),
        "transaction_id": filled("transactionId"),
        "payment_method": blank_to_null(txn["method"]),
        "payment_transaction_id": blank_to_null(txn["transactionId"]),
        "scheduled_action": blank_to_null(txn["scheduledAction"]),
        **{k: _amount(price[k]) for k in ("subtotal", "total", "tax", "discount", "fees")},
        "currency": price["currency"],
        "gift_card_count": F.size(F.coalesce(F.col("giftCardPaymentDetails"), F.array())),
        "available_actions": F.when(F.size(actions) > 0, F.array_join(actions, ", ")),
        **stamps("created", first_filled(F.col("created"), F.col("createdDate")), whole=True),
        **stamps("updated", first_filled(F.col("updated"), F.col("updatedDate")), whole=True),
    })


def _sum(items: Column, value) -> Column:
    """Sum of a number over an array, added in list order."""
    return F.aggregate(
        items, F.lit(0.0), lambda acc, x: acc + F.coalesce(safe_float(value(x)), F.lit(0.0))
    )


def succeeded_refunds(refunds: Column) -> Column:
    return F.filter(F.coalesce(refunds, F.array()), lambda r: F.upper(r["status"]) == "SUCCEEDED")


def refund_rollup(refunds: Column, done: Column) -> dict[str, Column]:
    """Count, succeeded count, succeeded sum (0 as null) and the latest refund of an array."""
    items = F.coalesce(refunds, F.array())
    # The latest by creation text; on a tie the earlier list position.
    ranked = F.transform(items, lambda r, i: F.struct(
        F.coalesce(r["createdAt"], F.lit("")).alias("at"), (-i).alias("back"), r.alias("r")))
    return {
        "count": F.size(items),
        "succeeded": F.size(done),
        "total": nonzero(_sum(done, lambda r: r["amount"])),
        "latest": F.array_max(ranked)["r"],
    }


def goods_and_fees(items: Column) -> tuple[Column, Column]:
    """A payment's item list without its fee lines, and the fee lines."""
    lines = F.coalesce(items, F.array())
    return (F.filter(lines, lambda i: i["id"].isNull() | (i["id"] != FEE_ITEM_ID)),
            F.filter(lines, lambda i: i["id"] == FEE_ITEM_ID))


def item_rollup(goods: Column, fees: Column) -> dict[str, Column]:
    """Names, count, quantity, fee-line sum and first product of a payment's item list."""
    quantity = F.aggregate(
        goods, F.lit(0).cast("bigint"),
        lambda acc, i: acc + F.coalesce(i["quantity"], F.lit(0).cast("bigint")),
    )
    return {
        "names": join_filled(F.transform(goods, lambda i: i["name"])),
        "count": F.size(goods),
        "quantity": F.when(F.size(goods) > 0, quantity),
        "fees": nonzero(_sum(fees, lambda i: i["price"])),
        "first": F.get(goods, F.lit(0)),
    }


def flatten_payments(raw: DataFrame) -> DataFrame:
    """One row per payment with refunds rolled up, fees split out and labels resolved."""
    desc = F.col("order.description")
    bill, ship = desc["billingAddress"], desc["shippingAddress"]
    # Lists are filtered once, in a projection of their own.
    goods, fees = goods_and_fees(desc["items"])
    split = raw.withColumns({
        "_goods": goods, "_fees": fees, "_done": succeeded_refunds(F.col("refunds"))})
    refunds = refund_rollup(F.col("refunds"), F.col("_done"))
    items = item_rollup(F.col("_goods"), F.col("_fees"))
    base = split.withColumns({
        "_refunded": refunds["total"],
        "_latest": refunds["latest"],
        "_amount": safe_float(F.col("amount.amount")),
        "_fee": safe_float(F.col("platformFee")),
    })
    zero = F.lit(0.0)
    card, extra, plan = F.col("paymentMethodData"), desc["additionalCharges"], desc["subscription"]
    latest = F.col("_latest")
    status = blank_to_null(F.col("status"))

    def filled(c: Column) -> Column:
        return blank_to_null(c)

    return shape(base, {
        "transaction_id": F.col("transactionId"),
        "provider_transaction_id": filled(F.col("providerTransactionId")),
        "order_id": F.col("order.id"),
        "app_order_id": filled(desc["appOrderId"]),
        "app_buyer_id": filled(desc["appBuyerId"]),
        "app_id": F.col("appId"),
        "app_name": app_name(F.col("appId")),
        **stamps("payment", F.col("createdAt")),
        "payment_datetime": F.col("createdAt"),
        "currency": F.col("amount.currency"),
        "amount": F.col("_amount"),
        "platform_fee": F.col("_fee"),
        "service_fee_line_amount": items["fees"],
        "net_amount": F.col("_amount") - F.coalesce("_fee", zero) - F.coalesce("_refunded", zero),
        "tax": safe_float(extra["tax"]),
        "shipping": safe_float(extra["shipping"]),
        "discount": safe_float(extra["discount"]),
        "status": status,
        "transaction_status": status_label(status, F.col("_amount"), F.col("_refunded")),
        "transaction_type": F.col("type"),
        "is_refundable": F.col("refundability.isRefundable"),
        "non_refundable_reason": F.col("refundability.reason.value"),
        "failure_code": filled(F.col("cashierError.failureCode")),
        "payment_provider": filled(F.col("provider")),
        "payment_provider_friendly": provider_label(F.col("provider"), F.col("providerName")),
        "payment_method": filled(F.col("paymentMethod")),
        "payment_method_type": filled(card["PaymentMethodDataType"]),
        "provider_dashboard_link": filled(F.col("providerDashboardLink")),
        "card_network": filled(card["network"]),
        "card_last_four": filled(card["lastFour"]),
        "card_masked": filled(card["maskedCreditCard"]),
        "card_expiry": filled(card["creditCardExpiryMonth"]),
        "card_holder_name": filled(F.trim(card["holderName"])),
        "card_bin": filled(card["bin"]),
        "installments": nonzero(card["installments"]),
        "refund_count": refunds["count"],
        "refund_succeeded_count": refunds["succeeded"],
        "refund_total_amount": F.col("_refunded"),
        "refund_status": latest["status"],
        "refund_type": latest["type"],
        "refund_reason": latest["reason"],
        "refund_provider_id": latest["providerRefundId"],
        **stamps("refund", latest["createdAt"]),
        "billing_first_name": filled(bill["firstName"]),
        "billing_last_name": filled(bill["lastName"]),
        "billing_full_name": join_trimmed(bill["firstName"], bill["lastName"]),
        "billing_email": filled(bill["email"]),
        "billing_phone": filled(bill["phone"]),
        "billing_company": filled(bill["company"]),
        "billing_address": filled(bill["address"]),
        "billing_city": filled(bill["city"]),
        "billing_state": filled(bill["state"]),
        "billing_zip": filled(bill["zipCode"]),
        "billing_country": filled(bill["countryCode"]),
        "shipping_first_name": filled(ship["firstName"]),
        "shipping_last_name": filled(ship["lastName"]),
        "shipping_email": filled(ship["email"]),
        "shipping_city": filled(ship["city"]),
        "shipping_country": filled(ship["countryCode"]),
        "product_name": items["names"],
        "product_count": items["count"],
        "total_quantity": items["quantity"],
        "primary_product_name": filled(items["first"]["name"]),
        "primary_product_unit_price": safe_float(items["first"]["price"]),
        "primary_product_quantity": nonzero(items["first"]["quantity"]),
        "subscription_status": filled(plan["status"]),
        "subscription_frequency": filled(plan["frequency"]),
        "subscription_interval": nonzero(plan["interval"]),
        "subscription_billing_cycles": nonzero(plan["billingCycles"]),
    })


def transaction_summary(transactions: DataFrame) -> DataFrame:
    """Per store order: transaction count, distinct statuses, and the first transaction.

    Only the roll-up crosses the shuffle; no list of an order's transactions is built.
    """
    first = F.struct("id", "status", "paymentMethod", F.col("amounts.total").alias("total"),
                     "currency")
    statuses = F.collect_set(blank_to_null(F.col("status")))
    return transactions.groupBy("orderId").agg(
        F.count("*").cast("int").alias("transaction_count"),
        join_filled(F.array_sort(statuses)).alias("transaction_statuses"),
        F.min_by(first, "_ord").alias("_first"),
    )


def flatten_store_orders(raw: DataFrame, transactions: DataFrame | None = None) -> DataFrame:
    """One row per store order with its transaction roll-up, if transactions are given."""
    from turnstile.operators.dims import join_dim

    buyer, bill = F.col("buyerInfo"), F.col("billingInfo.address")
    price = F.col("pricingSummary")
    lines = F.coalesce(F.col("lineItems"), F.array())
    first = F.get(lines, F.lit(0))
    offers = F.coalesce(F.col("appliedDiscounts"), F.array())
    dest = F.col("shippingInfo.logistics.shippingDestination")
    option = F.col("shippingInfo.logistics.selectedCarrierServiceOption")

    def product_name(v: Column) -> Column:
        named = F.coalesce(variant_at(v, "$.original"), variant_at(v, "$.translated"))
        return F.when(kind(v).startswith("OBJECT"), named).otherwise(variant_at(v, "$"))

    one = F.lit(1).cast("bigint")
    flat = {
        "order_id": F.col("id"),
        "order_number": F.col("number"),
        "checkout_id": F.col("checkoutId"),
        "buyer_id": buyer["id"],
        "buyer_email": buyer["email"],
        "buyer_first_name": buyer["firstName"],
        "buyer_last_name": buyer["lastName"],
        "buyer_phone": buyer["phone"],
        "buyer_full_name": join_name(buyer["firstName"], buyer["lastName"]),
        "buyer_language": F.col("buyerLanguage"),
        "billing_address": bill["formatted"],
        "billing_city": bill["city"],
        "billing_country": bill["country"],
        "billing_subdivision": bill["subdivision"],
        "billing_postal_code": bill["postalCode"],
        "payment_status": F.col("paymentStatus"),
        "fulfillment_status": F.col("fulfillmentStatus"),
        "currency": F.col("currency"),
    }
    for part in ("subtotal", "total", "tax", "shipping", "discount"):
        flat[f"{part}_amount"] = safe_float(price[part]["amount"])
        flat[f"{part}_formatted"] = price[part]["formattedAmount"]
    flat |= {
        "line_item_count": F.size(lines),
        "product_names": join_filled(F.transform(lines, lambda i: product_name(i["productName"]))),
        "product_ids": join_filled(
            F.transform(lines, lambda i: i["catalogReference"]["catalogItemId"])),
        "quantities": join_filled(F.transform(
            lines, lambda i: F.coalesce(i["quantity"], one).cast("string"))),
        "primary_product_name": product_name(first["productName"]),
        "primary_product_price": safe_float(first["price"]["amount"]),
        "primary_product_quantity": F.when(F.size(lines) > 0, F.coalesce(first["quantity"], one)),
        "discount_codes": join_filled(F.transform(offers, lambda d: d["coupon"]["code"])),
        "discount_count": F.size(offers),
        "channel_type": F.col("channelInfo.type"),
        "shipping_first_name": dest["contactDetails"]["firstName"],
        "shipping_last_name": dest["contactDetails"]["lastName"],
        "shipping_phone": dest["contactDetails"]["phone"],
        "shipping_address": dest["address"]["formatted"],
        "shipping_city": dest["address"]["city"],
        "shipping_country": dest["address"]["country"],
        "shipping_subdivision": dest["address"]["subdivision"],
        "shipping_postal_code": dest["address"]["postalCode"],
        "shipping_method": option["title"],
        "shipping_carrier": option["code"],
        **stamps("created", F.col("createdDate"), whole=True),
        **stamps("updated", F.col("updatedDate"), whole=True),
        "custom_field_count": F.size(F.coalesce(F.col("customFields"), F.array())),
        "archived": F.coalesce(F.col("archived"), F.lit(False)),
        "activity_count": F.size(F.coalesce(F.col("activities"), F.array())),
    }
    orders = shape(raw, flat)
    if transactions is None:
        return orders.withColumns({
            "transaction_count": F.lit(0),
            **{c: F.lit(None).cast("string") for c in (
                "transaction_statuses", "primary_transaction_id", "primary_transaction_status",
                "primary_payment_method")},
            "transaction_amount": F.lit(None).cast("double"),
            "transaction_currency": F.lit(None).cast("string"),
        })
    joined = join_dim(orders, transaction_summary(transactions), "order_id", "orderId",
                      spread_by="order_number")
    return joined.withColumns({
        "transaction_count": F.coalesce("transaction_count", F.lit(0)),
        "primary_transaction_id": F.col("_first.id"),
        "primary_transaction_status": F.col("_first.status"),
        "primary_payment_method": F.col("_first.paymentMethod"),
        "transaction_amount": safe_float(F.col("_first.total")),
        "transaction_currency": F.col("_first.currency"),
    }).drop("_first", "orderId")


def flatten_coupons(raw: DataFrame) -> DataFrame:
    """One row per coupon; the first non-zero discount field names its type."""
    spec = F.col("specification")
    money, percent, fixed = (nonzero(spec[f]) for f in (
        "moneyOffAmount", "percentOffRate", "fixedPriceAmount"))
    return shape(raw, {
        "coupon_id": F.col("id"),
        "name": F.col("name"),
        "code": F.col("code"),
        "active": F.col("active"),
        "expired": F.col("expired"),
        "coupon_type": spec["type"],
        "display_name": spec["name"],
        "discount_type": F.when(money.isNotNull(), "money_off")
        .when(percent.isNotNull(), "percent_off")
        .when(fixed.isNotNull(), "fixed_price")
        .when(spec["freeShipping"], "free_shipping"),
        "discount_value": F.coalesce(money, percent, fixed),
        "scope_namespace": spec["scope"]["namespace"],
        "scope_group_name": spec["scope"]["group"]["name"],
        "scope_entity_id": spec["scope"]["group"]["entityId"],
        "minimum_subtotal": spec["minimumSubtotal"],
        "limited_to_one_item": spec["limitedToOneItem"],
        "applies_to_lowest_price": spec["appliesToLowestPriceItem"],
        "limit_per_customer": F.col("limitPerCustomer"),
        "number_of_usages": F.col("numberOfUsages"),
        **stamps("created", F.col("dateCreated")),
        **stamps("start", spec["startTime"]),
        **stamps("expiration", spec["expirationTime"]),
    })
