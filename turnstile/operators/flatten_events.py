"""Event records to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnstile.functions.dates import split_iso, weekday_columns
from turnstile.functions.richtext import rich_text
from turnstile.functions.values import blank_to_null, first_filled, safe_float
from turnstile.operators.shaping import kind, shape, variant_at


def _page_url(v: Column) -> Column:
    base = blank_to_null(variant_at(v, "$.base"))
    path = F.coalesce(variant_at(v, "$.path"), F.lit(""))
    joined = F.when(base.isNotNull(), F.concat(base, path))
    return F.when(kind(v).startswith("OBJECT"), joined).otherwise(variant_at(v, "$"))


def flatten_events(raw: DataFrame) -> DataFrame:
    """One row per event; dates and times are local to the event's own time zone."""
    when, zone = F.col("dateAndTimeSettings"), F.col("dateAndTimeSettings.timeZoneId")
    start_date, start_time = split_iso(when["startDate"], zone)
    end_date, end_time = split_iso(when["endDate"], zone)
    # Later columns build on the local start date, so settle it in a first projection.
    base = raw.withColumns({
        "_start_date": start_date,
        "_rich": rich_text(F.col("description")),
        "_cats": F.coalesce(F.col("categories.categories"), F.array()),
    })
    weekday, weekday_num, weekend = weekday_columns(F.col("_start_date"))
    named = F.filter(F.col("_cats"), lambda x: F.length(x["name"]) > 0)
    place, address = F.col("location"), F.col("location.address")
    street, geo = address["streetAddress"], address["geocode"]
    signup, tickets = F.col("registration"), F.col("registration.tickets")
    image = F.col("mainImage")
    false = F.lit(False)
    detailed = F.coalesce(F.col("detailedDescription"), F.lit(""))
    return shape(base, {
        "event_id": F.col("id"),
        "title": F.col("title"),
        "slug": F.col("slug"),
        "status": F.col("status"),
        "short_description": F.col("shortDescription"),
        "category_names": F.when(
            F.size("_cats") > 0, F.array_join(F.transform(named, lambda x: x["name"]), ", ")
        ),
        "category_count": F.size("_cats"),
        "start_date": F.col("_start_date"),
        "start_time": start_time,
        "end_date": end_date,
        "end_time": end_time,
        "start_datetime": when["startDate"],
        "end_datetime": when["endDate"],
        "timezone": zone,
        "recurrence_status": when["recurrenceStatus"],
        "day_of_week": weekday,
        "day_of_week_num": weekday_num,
        "is_weekend": weekend,
        "formatted_date_time": when["formatted"]["dateAndTime"],
        "location_name": place["name"],
        "location_type": place["type"],
        "location_address": address["formattedAddress"],
        "location_city": address["city"],
        "location_country": address["country"],
        "location_subdivision": address["subdivision"],
        "location_postal_code": address["postalCode"],
        "street_number": street["number"],
        "street_name": street["name"],
        "street_apt": street["apt"],
        "location_latitude": geo["latitude"],
        "location_longitude": geo["longitude"],
        "registration_type": signup["type"],
        "registration_status": signup["status"],
        "currency": tickets["currency"],
        "lowest_price": safe_float(tickets["lowestPrice"]["value"]),
        "highest_price": safe_float(tickets["highestPrice"]["value"]),
        "sold_out": F.coalesce(tickets["soldOut"], false),
        "main_image_url": image["url"],
        "main_image_id": image["id"],
        "main_image_width": image["width"],
        "main_image_height": image["height"],
        "created_date": F.col("createdDate"),
        "updated_date": F.col("updatedDate"),
        "published_date": F.col("publishedDate"),
        "instance_id": F.col("instanceId"),
        "user_id": F.col("userId"),
        "guest_list_public": F.coalesce(F.col("guestListSettings.displayedPublicly"), false),
        "online_conference_enabled": F.coalesce(F.col("onlineConferencing.enabled"), false),
        "online_conference_type": F.col("onlineConferencing.type"),
        "google_calendar_url": F.col("calendarUrls.google"),
        "ics_calendar_url": F.col("calendarUrls.ics"),
        "event_page_url": _page_url(F.col("eventPageUrl")),
        "detailed_description": detailed,
        "description_rich_text": F.col("_rich"),
        "description_full": F.coalesce(
            first_filled(F.col("_rich"), detailed), F.col("shortDescription")
        ),
    })


def split_events_by_type(events: DataFrame) -> dict[str, DataFrame]:
    """Ticketing, RSVP and other events of a flat events table."""
    kind_ = F.col("registration_type")
    return {
        "ticketing": events.where(kind_ == "TICKETING"),
        "rsvp": events.where(kind_ == "RSVP"),
        "other": events.where(kind_.isNull() | ~kind_.isin("TICKETING", "RSVP")),
    }


def event_type_counts(events: DataFrame) -> DataFrame:
    """Number of events per branch of the split."""
    kind_ = F.col("registration_type")
    branch = F.when(kind_ == "TICKETING", "ticketing").when(kind_ == "RSVP", "rsvp")
    return events.groupBy(branch_name(branch)).agg(F.count("*").alias("events"))


def branch_name(branch: Column) -> Column:
    return F.coalesce(branch, F.lit("other")).alias("branch")


def flatten_address(df: DataFrame, column: str) -> DataFrame:
    """Append the ten parts of an address struct."""
    a = F.col(column)
    return df.withColumns({
        "formatted_address": a["formattedAddress"],
        "city": a["city"],
        "country": a["country"],
        "subdivision": a["subdivision"],
        "postal_code": a["postalCode"],
        "street_number": a["streetAddress"]["number"],
        "street_name": a["streetAddress"]["name"],
        "street_apt": a["streetAddress"]["apt"],
        "latitude": a["geocode"]["latitude"],
        "longitude": a["geocode"]["longitude"],
    })


def flatten_price(df: DataFrame, column: str) -> DataFrame:
    """Append value, currency and formatted text of a price struct."""
    p = F.col(column)
    return df.withColumns({
        "value": p["value"], "currency": p["currency"], "formatted": p["formattedValue"],
    })
