"""Contact, member, guest and RSVP records to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnstile.functions.text import join_filled, join_name
from turnstile.functions.values import blank_to_null, first_filled
from turnstile.operators.shaping import (
    any_set,
    last_entries,
    shape,
    stamps,
    variant_filled,
)


def flatten_contacts(raw: DataFrame) -> DataFrame:
    """One row per contact. The e-mail is the one flagged primary, else the first."""
    name = F.col("info.name")
    mails = F.coalesce(F.col("info.emails.items"), F.array())
    flagged = F.filter(mails, lambda m: m["primary"])
    chosen = F.coalesce(F.get(flagged, F.lit(0)), F.get(mails, F.lit(0)))
    primary = F.col("primaryInfo.email")
    has_mails = F.size(mails) > 0
    m = F.col("memberInfo")
    member = any_set(*[m[f] for f in (
        "memberId", "status", "emailVerified", "signupDate", "profileInfo", "userInfo")])
    extra = F.col("info.extendedFields.items")
    return shape(raw, {
        "contact_id": F.col("id"),
        "revision": F.col("revision"),
        **stamps("created", F.col("createdDate"), whole=True),
        **stamps("updated", F.col("updatedDate"), whole=True),
        "primary_email": primary,
        "first_name": name["first"],
        "last_name": name["last"],
        "full_name": join_name(name["first"], name["last"]),
        "email": F.when(has_mails, chosen["email"]).otherwise(primary),
        "email_tag": F.when(has_mails, chosen["tag"]),
        "email_count": F.when(has_mails, F.size(mails)).otherwise(
            F.when(F.length(primary) > 0, 1).otherwise(0)
        ),
        "picture_url": F.col("picture.url"),
        "picture_width": F.col("picture.width"),
        "picture_height": F.col("picture.height"),
        "subscription_status": F.col("primaryEmail.subscriptionStatus"),
        "deliverability_status": F.col("primaryEmail.deliverabilityStatus"),
        "is_member": member,
        "member_id": m["memberId"],
        "member_status": m["status"],
        "member_email_verified": m["emailVerified"],
        **{f"signup_{p}": stamps("x", m["signupDate"])[f"x_{p}"] for p in ("date", "time")},
        "profile_nickname": m["profileInfo"]["nickname"],
        "profile_privacy": m["profileInfo"]["privacyStatus"],
        "user_role": m["userInfo"]["role"],
        "user_id": m["userInfo"]["userId"],
        "source_type": F.col("source.sourceType"),
        "source_app_id": F.col("source.appId"),
        "display_name_first_last": F.element_at(extra, F.lit("contacts.displayByFirstName")),
        "display_name_last_first": F.element_at(extra, F.lit("contacts.displayByLastName")),
        "membership_status": F.element_at(extra, F.lit("members.membershipStatus")),
        "is_mobile_member": F.element_at(extra, F.lit("members.mobile")),
    })


def flatten_members(raw: DataFrame) -> DataFrame:
    """One row per site account."""
    p = F.col("profile")
    return shape(raw, {
        "member_id": F.col("id"),
        "login_email": F.col("loginEmail"),
        "status": F.col("status"),
        "privacy_status": F.col("privacyStatus"),
        "activity_status": F.col("activityStatus"),
        "nickname": p["nickname"],
        "slug": p["slug"],
        "profile_photo_url": p["photo"]["url"],
        "cover_photo_url": p["cover"]["url"],
        "title": p["title"],
        "first_name": p["firstName"],
        "last_name": p["lastName"],
        "contact_id": F.col("contactId"),
        **stamps("created", F.col("createdDate")),
        **stamps("updated", F.col("updatedDate")),
        **stamps("last_login", F.col("lastLoginDate")),
    })


def _mentions(name: Column, *words: str) -> Column:
    test = name.contains(words[0])
    for w in words[1:]:
        test = test | name.contains(w)
    return test


def _question(answer: Column) -> Column:
    return F.lower(F.coalesce(answer["inputName"], F.lit("")))


def flatten_guests(raw: DataFrame) -> DataFrame:
    """One row per guest record, with the common registration answers as columns.

    Answers go to a column by words in the question. A phone question fills the phone only
    while none is known; after that it is read like any other question.
    """
    details = F.col("guestDetails")
    present = any_set(*[details[f] for f in (
        "name", "email", "phone", "checkedIn", "formResponse", "member")])
    base = raw.withColumns({
        "_tickets": F.coalesce(F.col("tickets"), F.array()),
        "_answers": F.coalesce(details["formResponse"]["inputValues"], F.array()),
    })
    answers, tickets = F.col("_answers"), F.col("_tickets")
    spots = F.transform(
        answers,
        lambda x, i: F.when(_mentions(_question(x), "phone") & (F.length(x["value"]) > 0), i),
    )
    filled_at = F.array_min(spots)
    # Index of the last answer that may still set the phone; -1 when it was known before.
    phone_until = F.when(F.length(details["phone"]) > 0, F.lit(-1)).otherwise(
        F.coalesce(filled_at, F.size(answers))
    )
    base = base.withColumn("_phone_until", phone_until)
    as_phone = F.filter(
        answers, lambda x, i: _mentions(_question(x), "phone") & (i <= F.col("_phone_until"))
    )
    rest = F.filter(
        answers, lambda x, i: ~(_mentions(_question(x), "phone") & (i <= F.col("_phone_until")))
    )
    company = ("company", "organization")
    dietary = ("dietary", "allerg")
    notes = ("comment", "note", "message")

    def last_value(items: Column) -> Column:
        return F.get(F.reverse(items), F.lit(0))["value"]

    first_ticket = F.get(tickets, F.lit(0))
    return shape(base, {
        "guest_id": F.col("id"),
        "event_id": F.col("eventId"),
        "contact_id": F.col("contactId"),
        "guest_type": F.col("guestType"),
        "rsvp_id": F.col("rsvpId"),
        "order_number": F.col("orderNumber"),
        "ticket_number": F.col("ticketNumber"),
        "ticket_count": F.size(tickets),
        "ticket_definition_ids": join_filled(F.transform(tickets, lambda t: t["definitionId"])),
        "ticket_numbers": join_filled(F.transform(tickets, lambda t: t["number"])),
        "ticket_names": join_filled(F.transform(tickets, lambda t: t["name"])),
        "primary_ticket_name": first_ticket["name"],
        "primary_ticket_definition_id": first_ticket["definitionId"],
        "primary_ticket_number": first_ticket["number"],
        "attendance_status": F.col("attendanceStatus"),
        "order_status": F.col("additionalDetails.orderStatus"),
        "rsvp_status": F.col("additionalDetails.rsvpStatus"),
        "additional_details_archived": F.col("additionalDetails.archived"),
        "secondary_language_code": F.col("secondaryLanguageCode"),
        **stamps("created", F.col("createdDate"), whole=True),
        **stamps("updated", F.col("updatedDate"), whole=True),
        "first_name": details["name"]["first"],
        "last_name": details["name"]["last"],
        "full_name": join_name(details["name"]["first"], details["name"]["last"]),
        "email": details["email"],
        "phone": F.when(F.size(as_phone) > 0, last_value(as_phone)).otherwise(details["phone"]),
        "checked_in": F.when(present, F.coalesce(details["checkedIn"], F.lit(False))),
        "custom_field_count": F.size(answers),
        "company": last_value(F.filter(rest, lambda x: _mentions(_question(x), *company))),
        "dietary_notes": last_value(F.filter(
            rest,
            lambda x: _mentions(_question(x), *dietary) & ~_mentions(_question(x), *company),
        )),
        "guest_notes": last_value(F.filter(
            rest,
            lambda x: _mentions(_question(x), *notes)
            & ~_mentions(_question(x), *company, *dietary),
        )),
        "is_member": details["member"]["id"].isNotNull(),
        "member_id": details["member"]["id"],
    })


def flatten_rsvps(raw: DataFrame) -> DataFrame:
    """One row per RSVP; registration answers in the ``form_fields`` map."""
    answers = F.coalesce(F.col("formResponse.inputValues"), F.array())
    named = F.filter(answers, lambda x: F.length(x["inputName"]) > 0)
    entries = F.transform(named, lambda x: F.struct(
        F.concat(F.lit("form_"), F.lower(F.replace(x["inputName"], F.lit(" "), F.lit("_"))))
        .alias("key"),
        F.coalesce(
            variant_filled(x["value"]),
            F.when(x["values"].isNotNull(), F.to_json(x["values"])),
            F.lit(""),
        ).alias("value"),
    ))
    names = F.coalesce(F.col("guestNames"), F.array())
    return shape(raw, {
        "rsvp_id": F.col("id"),
        "event_id": F.col("eventId"),
        "contact_id": F.col("contactId"),
        "member_id": F.col("memberId"),
        "rsvp_status": F.col("rsvpStatus"),
        "check_in_status": F.col("checkInStatus"),
        "first_name": F.col("firstName"),
        "last_name": F.col("lastName"),
        "email": F.col("email"),
        "guest_names": F.when(F.size(names) > 0, F.array_join(names, "; ")),
        "additional_guests": F.coalesce(F.col("additionalGuests"), F.lit(0)),
        "total_guests": F.coalesce(F.col("totalGuests"), F.lit(1)),
        **stamps("created", first_filled(F.col("createdDate"), F.col("_createdDate"))),
        **stamps("updated", first_filled(F.col("updatedDate"), F.col("_updatedDate"))),
        "form_fields": last_entries(entries),
    })


def enrich_guests(guests: DataFrame, raw_contacts: DataFrame) -> DataFrame:
    """Fill blank guest names, e-mail and phone from the guest's contact.

    Uses the first listed e-mail and phone of the contact, not the one flagged primary.
    """
    from turnstile.operators.dims import join_dim, last_wins

    people = raw_contacts.select(
        F.col("id").alias("_contact"),
        F.col("info.name.first").alias("_first"),
        F.col("info.name.last").alias("_last"),
        F.get(F.col("info.emails.items"), F.lit(0))["email"].alias("_email"),
        F.get(F.col("info.phones.items"), F.lit(0))["phone"].alias("_phone"),
        F.lit(True).alias("_found"),
        *[c for c in ("_ord",) if c in raw_contacts.columns],
    )
    people = last_wins(people, "_contact").drop("_ord")
    joined = join_dim(guests, people, "contact_id", "_contact", spread_by="guest_id")
    found = F.col("_found").isNotNull()

    def fill(name: str, extra: str) -> Column:
        return F.when(found & blank_to_null(F.col(name)).isNull(), F.col(extra)).otherwise(
            F.col(name)
        )

    joined = joined.withColumns({
        n: fill(n, e) for n, e in (
            ("first_name", "_first"), ("last_name", "_last"),
            ("email", "_email"), ("phone", "_phone"),
        )
    })
    rebuilt = join_name(F.col("first_name"), F.col("last_name"))
    joined = joined.withColumn(
        "full_name", F.when(found, F.coalesce(rebuilt, F.col("full_name")))
        .otherwise(F.col("full_name")),
    )
    return joined.select(*guests.columns)
