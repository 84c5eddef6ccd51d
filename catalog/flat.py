"""Flatteners: nested records are built from flat tables, flattened, and compared with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog.base import Lake, query
from turnstile.operators import flatten_events as ev
from turnstile.operators import flatten_forms as fo
from turnstile.operators import flatten_people as pe
from turnstile.operators import flatten_sales as sa
from turnstile.operators.shaping import conform
from turnstile.schemas import raw_schema


def nested(lake: Lake, entity: str, sql: str) -> DataFrame:
    """Raw records of an entity from Spark SQL over base tables."""
    return conform(lake.sql(sql), raw_schema(entity))


def nulls(names: str, kind: str = "VARCHAR") -> str:
    return ", ".join(f"CAST(NULL AS {kind}) AS {n}" for n in names.split())


def map_text(column: str):
    """A map as sorted ``key=value`` text."""
    entries = F.array_sort(F.map_entries(column))
    return F.array_join(F.transform(
        entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|").alias(column)


# ISO texts used below: a UTC stamp of a date column.
def iso(col: str) -> str:
    return f"CAST(CAST({col} AS DATE) AS STRING) || 'T17:05:09.250Z'"


def day(col: str) -> str:
    return f"CAST(CAST({col} AS DATE) AS VARCHAR)"


EVENT_RAW = """
    SELECT CAST(s_suppkey AS STRING) AS id, s_name AS title,
      lower(s_name) AS slug, CASE WHEN s_acctbal < 2000 THEN 'ENDED' ELSE 'UPCOMING' END AS status,
      'At ' || n_name AS shortDescription,
      CASE WHEN s_acctbal > 4000 THEN 'Long ' || s_name END AS detailedDescription,
      CASE WHEN s_acctbal > 0 THEN named_struct('categories', array(named_struct('name', r_name),
        named_struct('name', ''), named_struct('name', n_name))) END AS categories,
      named_struct('startDate', CAST(DATE '2024-01-01' + CAST(s_suppkey % 365 AS INT) AS STRING)
          || CASE WHEN s_acctbal < 1000 THEN 'T03:30:00+02:00' ELSE 'T03:30:00Z' END,
        'endDate', CAST(DATE '2024-01-01' + CAST(s_suppkey % 365 AS INT) AS STRING),
        'timeZoneId', CASE WHEN s_nationkey % 3 = 0 THEN 'Etc/GMT+5'
          WHEN s_nationkey % 3 = 1 THEN 'No/Where' END,
        'recurrenceStatus', 'ONE_TIME') AS dateAndTimeSettings,
      named_struct('name', s_name || ' Hall', 'type', 'VENUE', 'address', named_struct(
        'city', n_name, 'country', r_name, 'streetAddress', named_struct('number', '1', 'name',
        'Main'), 'geocode', named_struct('latitude', s_acctbal / 100))) AS location,
      named_struct('type', CASE WHEN s_acctbal < 500 THEN 'RSVP' ELSE 'TICKETING' END,
        'status', 'OPEN', 'tickets', CASE WHEN s_acctbal >= 500 THEN named_struct('currency', 'CAD',
          'lowestPrice', named_struct('value', CAST(s_acctbal AS STRING)),
          'highestPrice', named_struct('value', CASE WHEN s_acctbal > 5000 THEN 'n/a'
             ELSE CAST(s_acctbal + 1 AS STRING) END),
          'soldOut', s_acctbal > 9000) END) AS registration,
      named_struct('url', 'http://i.test/' || s_suppkey, 'width', CAST(s_suppkey AS BIGINT))
        AS mainImage,
      CASE WHEN s_nationkey % 2 = 0 THEN named_struct('base', 'http://e.test', 'path',
        '/' || s_name) ELSE named_struct('base', '', 'path', '/x') END AS eventPageUrl,
      CASE WHEN s_acctbal > 8000 THEN '{{"nodes":[{{"type":"PARAGRAPH","nodes":[{{"type":"TEXT",'
        || '"textData":{{"text":" ' || s_name || ' "}}}},{{"type":"TEXT","textData":{{"text":"now"}}}}]}}]}}'
      END AS description, s_suppkey AS _ord
    FROM {supplier} LEFT JOIN {nation} ON s_nationkey = n_nationkey
         LEFT JOIN {region} ON n_regionkey = r_regionkey"""

_EVENT_DAY = (
    "DATE '2024-01-01' + CAST(s_suppkey % 365 AS INT) - CAST(s_acctbal >= 1000 "
    "AND s_nationkey % 3 = 0 AS INT)"
)


@query("t1_flatten_events", f"""
    WITH x AS (SELECT *, DATE '2024-01-01' + CAST(s_suppkey % 365 AS INT) AS d0,
        CAST({_EVENT_DAY} AS DATE) AS d FROM supplier
        LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)
    SELECT CAST(s_suppkey AS VARCHAR) AS event_id, s_name AS title, lower(s_name) AS slug,
      CASE WHEN s_acctbal < 2000 THEN 'ENDED' ELSE 'UPCOMING' END AS status,
      'At ' || n_name AS short_description,
      CASE WHEN s_acctbal > 0 THEN r_name || ', ' || n_name END AS category_names,
      CASE WHEN s_acctbal > 0 THEN 3 ELSE 0 END AS category_count,
      CASE WHEN s_acctbal < 1000 THEN CAST(CAST(d0 AS DATE) AS VARCHAR) || 'T03:30:00+02:00'
           ELSE CAST(d AS VARCHAR) END AS start_date,
      CASE WHEN s_acctbal < 1000 THEN NULL WHEN s_nationkey % 3 = 0 THEN '22:30:00'
           ELSE '03:30:00' END AS start_time,
      CAST(CAST(d0 AS DATE) AS VARCHAR) AS end_date, {nulls('end_time')},
      CAST(CAST(d0 AS DATE) AS VARCHAR) || CASE WHEN s_acctbal < 1000 THEN 'T03:30:00+02:00'
           ELSE 'T03:30:00Z' END AS start_datetime,
      CAST(CAST(d0 AS DATE) AS VARCHAR) AS end_datetime,
      CASE WHEN s_nationkey % 3 = 0 THEN 'Etc/GMT+5' WHEN s_nationkey % 3 = 1 THEN 'No/Where' END
        AS timezone, 'ONE_TIME' AS recurrence_status,
      CASE WHEN s_acctbal >= 1000 THEN dayname(d) END AS day_of_week,
      CASE WHEN s_acctbal >= 1000 THEN CAST(dayofweek(d) AS INT) END AS day_of_week_num,
      CASE WHEN s_acctbal >= 1000 THEN dayofweek(d) IN (0, 6) END AS is_weekend,
      {nulls('formatted_date_time')}, s_name || ' Hall' AS location_name, 'VENUE' AS location_type,
      {nulls('location_address')}, n_name AS location_city, r_name AS location_country,
      {nulls('location_subdivision location_postal_code')}, '1' AS street_number,
      'Main' AS street_name, {nulls('street_apt')}, s_acctbal / 100 AS location_latitude,
      {nulls('location_longitude', 'DOUBLE')},
      CASE WHEN s_acctbal < 500 THEN 'RSVP' ELSE 'TICKETING' END AS registration_type,
      'OPEN' AS registration_status, CASE WHEN s_acctbal >= 500 THEN 'CAD' END AS currency,
      CASE WHEN s_acctbal >= 500 THEN s_acctbal END AS lowest_price,
      CASE WHEN s_acctbal >= 500 AND s_acctbal <= 5000 THEN s_acctbal + 1 END AS highest_price,
      s_acctbal > 9000 AS sold_out, 'http://i.test/' || CAST(s_suppkey AS VARCHAR)
        AS main_image_url, {nulls('main_image_id')}, s_suppkey AS main_image_width,
      {nulls('main_image_height', 'BIGINT')},
      {nulls('created_date updated_date published_date instance_id user_id')},
      FALSE AS guest_list_public, FALSE AS online_conference_enabled,
      {nulls('online_conference_type google_calendar_url ics_calendar_url')},
      CASE WHEN s_nationkey % 2 = 0 THEN 'http://e.test/' || s_name END AS event_page_url,
      CASE WHEN s_acctbal > 4000 THEN 'Long ' || s_name ELSE '' END AS detailed_description,
      CASE WHEN s_acctbal > 8000 THEN s_name || '  now' END AS description_rich_text,
      CASE WHEN s_acctbal > 8000 THEN s_name || '  now' WHEN s_acctbal > 4000
           THEN 'Long ' || s_name ELSE 'At ' || n_name END AS description_full
    FROM x""")
def _(lake):
    return ev.flatten_events(nested(lake, "events", EVENT_RAW)).drop("_ord")


@query("t2_rich_text", r"""
    SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))
      AS text FROM pages""")
def _(lake):
    # Page text as a document of three levels: words in TEXT nodes of a paragraph of a section.
    from turnstile.functions.richtext import rich_text

    words = F.split(F.regexp_replace("html", "<[^>]*>", " "), r"\s+")
    nodes = F.transform(words, lambda w: F.struct(
        F.lit("TEXT").alias("type"), F.struct(w.alias("text")).alias("textData")))
    paragraph = F.struct(F.lit("PARAGRAPH").alias("type"), nodes.alias("nodes"))
    section = F.struct(F.lit("SECTION").alias("type"), F.array(paragraph).alias("nodes"))
    doc = F.to_json(F.struct(F.array(section).alias("nodes")))
    return lake.pages.select("page_id", rich_text(doc).alias("text"))


@query("t3_split_events_by_type", """
    SELECT CASE registration_type WHEN 'TICKETING' THEN 'ticketing' WHEN 'RSVP' THEN 'rsvp'
           ELSE 'other' END AS branch, count(*) AS events FROM t_event GROUP BY 1""", "t_event")
def _(lake):
    return ev.event_type_counts(lake.t_event)


@query("t4_flatten_contacts", f"""
    SELECT CAST(c_custkey AS VARCHAR) AS contact_id, c_custkey AS revision,
      '2024-02-03' AS created_date, '17:05:09' AS created_time,
      '2024-02-03T17:05:09Z' AS created_datetime,
      {nulls('updated_date updated_time updated_datetime')},
      lower(c_name) || '@x.test' AS primary_email,
      CASE WHEN c_acctbal < 0 THEN '' ELSE 'Ann' END AS first_name,
      CASE WHEN c_acctbal < 5000 THEN c_name END AS last_name,
      CASE WHEN c_acctbal < 0 THEN c_name WHEN c_acctbal < 5000 THEN 'Ann ' || c_name
           ELSE 'Ann' END AS full_name,
      CASE WHEN c_nationkey % 3 = 0 THEN lower(c_name) || '@x.test'
           WHEN c_nationkey % 3 = 1 THEN 'one@x.test' ELSE 'two@x.test' END AS email,
      CASE WHEN c_nationkey % 3 = 1 THEN 'HOME' WHEN c_nationkey % 3 = 2 THEN 'WORK' END
        AS email_tag,
      CASE WHEN c_nationkey % 3 = 0 THEN 1 ELSE 2 END AS email_count,
      {nulls('picture_url')}, {nulls('picture_width picture_height', 'BIGINT')},
      'SUBSCRIBED' AS subscription_status, {nulls('deliverability_status')},
      c_mktsegment = 'BUILDING' AS is_member,
      CASE WHEN c_mktsegment = 'BUILDING' THEN 'm' || CAST(c_custkey AS VARCHAR) END AS member_id,
      {nulls('member_status')}, {nulls('member_email_verified', 'BOOLEAN')},
      CASE WHEN c_mktsegment = 'BUILDING' THEN '2023-05-06' END AS signup_date,
      CASE WHEN c_mktsegment = 'BUILDING' THEN '01:02:03' END AS signup_time,
      CASE WHEN c_mktsegment = 'BUILDING' THEN c_name END AS profile_nickname,
      {nulls('profile_privacy user_role user_id source_type source_app_id')},
      'Ann by first' AS display_name_first_last, {nulls('display_name_last_first')},
      'ok' AS membership_status, {nulls('is_mobile_member')}
    FROM customer""")
def _(lake):
    return pe.flatten_contacts(nested(lake, "contacts", """
        SELECT CAST(c_custkey AS STRING) AS id, c_custkey AS revision,
          '2024-02-03T17:05:09Z' AS createdDate, '' AS updatedDate,
          named_struct('email', lower(c_name) || '@x.test') AS primaryInfo,
          named_struct('name', named_struct('first', CASE WHEN c_acctbal < 0 THEN '' ELSE 'Ann' END,
              'last', CASE WHEN c_acctbal < 5000 THEN c_name END),
            'emails', named_struct('items', CASE WHEN c_nationkey % 3 > 0 THEN array(
              named_struct('email', 'one@x.test', 'primary', FALSE, 'tag', 'HOME'),
              named_struct('email', 'two@x.test', 'primary', c_nationkey % 3 = 2, 'tag', 'WORK'))
              END),
            'extendedFields', named_struct('items', map('contacts.displayByFirstName',
              'Ann by first', 'members.membershipStatus', 'ok'))) AS info,
          named_struct('subscriptionStatus', 'SUBSCRIBED') AS primaryEmail,
          CASE WHEN c_mktsegment = 'BUILDING' THEN named_struct('memberId', 'm' || c_custkey,
            'signupDate', '2023-05-06T01:02:03.5Z', 'profileInfo',
            named_struct('nickname', c_name)) END AS memberInfo
        FROM {customer}"""))


@query("t5_flatten_members", f"""
    SELECT 'm' || CAST(c_custkey AS VARCHAR) AS member_id,
      lower(c_name) || '@x.test' AS login_email, 'APPROVED' AS status,
      {nulls('privacy_status activity_status')}, c_name AS nickname, {nulls('slug')},
      'http://p.test' AS profile_photo_url, {nulls('cover_photo_url title')},
      'Ann' AS first_name, {nulls('last_name')}, CAST(c_custkey AS VARCHAR) AS contact_id,
      '2020-01-02' AS created_date, '10:00:00' AS created_time,
      {nulls('updated_date updated_time')},
      CASE WHEN c_acctbal > 0 THEN '2024-01-01' END AS last_login_date,
      {nulls('last_login_time')} FROM customer""")
def _(lake):
    return pe.flatten_members(nested(lake, "members", """
        SELECT 'm' || c_custkey AS id, lower(c_name) || '@x.test' AS loginEmail,
          'APPROVED' AS status, named_struct('nickname', c_name, 'firstName', 'Ann',
            'photo', named_struct('url', 'http://p.test')) AS profile,
          CAST(c_custkey AS STRING) AS contactId, '2020-01-02T10:00:00Z' AS createdDate,
          CASE WHEN c_acctbal > 0 THEN '2024-01-01' END AS lastLoginDate FROM {customer}"""))


@query("t6_flatten_guests", f"""
    SELECT 'b' || CAST(o_orderkey AS VARCHAR) AS guest_id, 'e1' AS event_id,
      CAST(o_custkey AS VARCHAR) AS contact_id, 'BUYER' AS guest_type, {nulls('rsvp_id')},
      CAST(o_orderkey AS VARCHAR) AS order_number, {nulls('ticket_number')},
      CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END AS ticket_count,
      CASE WHEN o_orderstatus = 'O' THEN 'd1' END AS ticket_definition_ids,
      CASE WHEN o_orderstatus = 'O' THEN 'n1, n2' END AS ticket_numbers,
      CASE WHEN o_orderstatus = 'O' THEN 'First, ' || o_orderpriority END AS ticket_names,
      CASE WHEN o_orderstatus = 'O' THEN 'First' END AS primary_ticket_name,
      CASE WHEN o_orderstatus = 'O' THEN '' END AS primary_ticket_definition_id,
      CASE WHEN o_orderstatus = 'O' THEN 'n1' END AS primary_ticket_number,
      'ATTENDING' AS attendance_status,
      CASE WHEN o_orderstatus <> 'P' THEN 'PAID' END AS order_status, {nulls('rsvp_status')},
      CASE WHEN o_orderstatus <> 'P' THEN FALSE END AS additional_details_archived,
      {nulls('secondary_language_code')}, {day('o_orderdate')} AS created_date,
      '17:05:09' AS created_time, {day('o_orderdate')} || 'T17:05:09.250Z' AS created_datetime,
      {nulls('updated_date updated_time updated_datetime')},
      CASE WHEN o_orderstatus <> 'F' THEN 'Bo' END AS first_name, {nulls('last_name')},
      CASE WHEN o_orderstatus <> 'F' THEN 'Bo' END AS full_name, {nulls('email')},
      CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN '555'
           WHEN o_orderpriority = '2-HIGH' THEN '777' END AS phone,
      CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority = '5-LOW' END AS checked_in,
      CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
           THEN 4 ELSE 0 END AS custom_field_count,
      CASE WHEN o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT' THEN '888'
           WHEN o_orderstatus <> 'F' AND o_orderpriority = '2-HIGH' THEN '888' END AS company,
      CASE WHEN o_orderstatus <> 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
           THEN 'nuts' END AS dietary_notes, {nulls('guest_notes')},
      o_orderstatus <> 'F' AND o_orderpriority = '3-MEDIUM' AS is_member,
      CASE WHEN o_orderstatus <> 'F' AND o_orderpriority = '3-MEDIUM' THEN 'mm' END AS member_id
    FROM orders""")
def _(lake):
    return pe.flatten_guests(nested(lake, "guests", f"""
        SELECT 'b' || o_orderkey AS id, 'e1' AS eventId, CAST(o_custkey AS STRING) AS contactId,
          'BUYER' AS guestType, CAST(o_orderkey AS STRING) AS orderNumber,
          CASE WHEN o_orderstatus = 'O' THEN array(
            named_struct('definitionId', '', 'number', 'n1', 'name', 'First'),
            named_struct('definitionId', 'd1', 'number', 'n2', 'name', o_orderpriority)) END
            AS tickets,
          'ATTENDING' AS attendanceStatus,
          CASE WHEN o_orderstatus <> 'P' THEN named_struct('orderStatus', 'PAID', 'archived',
            FALSE) END AS additionalDetails, {iso('o_orderdate')} AS createdDate,
          CASE WHEN o_orderstatus <> 'F' THEN named_struct(
            'name', named_struct('first', 'Bo'),
            'phone', CASE WHEN o_orderpriority = '1-URGENT' THEN '555' END,
            'checkedIn', CASE WHEN o_orderpriority = '5-LOW' THEN TRUE END,
            'formResponse', CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN
              named_struct('inputValues', array(
                named_struct('inputName', 'Company', 'value', 'ACME'),
                named_struct('inputName', 'Phone of company', 'value',
                  CASE WHEN o_orderpriority = '2-HIGH' THEN '777' ELSE '888' END),
                named_struct('inputName', 'company PHONE', 'value', '888'),
                named_struct('inputName', 'Allergies or notes', 'value', 'nuts'))) END,
            'member', CASE WHEN o_orderpriority = '3-MEDIUM' THEN named_struct('id', 'mm') END)
          END AS guestDetails
        FROM {{orders}}"""))


@query("t7_flatten_tickets", f"""
    SELECT 't' || CAST(event_id AS VARCHAR) AS ticket_number, event_type AS event_id,
      CAST(user_id AS VARCHAR) AS order_number, {nulls('ticket_definition_id')},
      'GA' AS ticket_name, {nulls('policy')}, value < 5 AS free,
      {nulls('archived order_archived', 'BOOLEAN')},
      {nulls('order_status order_full_name guest_full_name')},
      CASE WHEN value > 50 THEN 'm@x.test' ELSE 'g@x.test' END AS email,
      {nulls('member_id contact_id')},
      CASE event_type WHEN 'click' THEN 9.5 WHEN 'view' THEN 0.0 ELSE value END AS price_value,
      'CAD' AS price_currency, event_type = 'purchase' AS checked_in,
      CASE WHEN event_type = 'purchase' THEN substring(CAST(ts AS VARCHAR), 1, 10) END
        AS check_in_date,
      CASE WHEN event_type = 'purchase' THEN substring(CAST(ts AS VARCHAR), 12, 8) END
        AS check_in_time,
      {nulls('check_in_url ticket_pdf_url')}, '2024-03-04' AS created_date,
      '05:06:07' AS created_time,
      CASE WHEN user_id % 2 = 0 THEN 'form_a_b_c=last|form_list=p; q'
           ELSE 'form_a_b_c=last' END AS form_fields
    FROM events""")
def _(lake):
    rows = sa.flatten_tickets(nested(lake, "tickets", """
        SELECT 't' || event_id AS ticketNumber, event_type AS eventId,
          CAST(user_id AS STRING) AS orderNumber, 'GA' AS name, value < 5 AS free,
          CASE WHEN value > 50 THEN 'm@x.test' ELSE '' END AS email, 'g@x.test' AS guestEmail,
          named_struct('value', CASE event_type WHEN 'click' THEN parse_json('0')
              WHEN 'view' THEN parse_json('"0.00"') ELSE parse_json(CAST(value AS STRING)) END,
            'amount', CAST('9.5' AS VARIANT), 'currency', 'CAD') AS price,
          CASE WHEN event_type = 'purchase' THEN to_variant_object(named_struct('created',
            replace(substring(CAST(ts AS STRING), 1, 19), ' ', 'T') || 'Z'))
            WHEN event_type = 'view' THEN parse_json('{{}}') END AS checkIn,
          named_struct('inputValues', array(
            named_struct('inputName', 'A b.c', 'value', CAST('first' AS VARIANT), 'values',
              CAST(NULL AS ARRAY<STRING>)),
            named_struct('inputName', 'a B c', 'value', CAST('last' AS VARIANT), 'values',
              CAST(NULL AS ARRAY<STRING>)),
            named_struct('inputName', 'list', 'value', CAST(NULL AS VARIANT), 'values',
              CASE WHEN user_id % 2 = 0 THEN array('p', 'q') END))) AS form,
          '' AS createdDate, '2024-03-04T05:06:07Z' AS _createdDate
        FROM {events}"""))
    return rows.withColumn("form_fields", map_text("form_fields"))


@query("t8_flatten_ticket_definitions", f"""
    SELECT CAST(p_partkey AS VARCHAR) AS definition_id, 'e' AS event_id, p_partkey AS revision,
      p_name AS name, {nulls('description')}, p_size > 40 AS hidden, p_type AS pricing_type,
      CASE WHEN p_type <> 'PROMO' THEN p_retailprice END AS fixed_price_value,
      CASE WHEN p_type <> 'PROMO' THEN 'CAD' END AS fixed_price_currency,
      {nulls('guest_price_value', 'DOUBLE')}, {nulls('guest_price_currency')},
      CASE WHEN p_size > 25 THEN 3 ELSE 0 END AS pricing_options_count,
      CASE WHEN p_size > 25 THEN 'Early; ' || p_brand END AS pricing_option_names,
      {nulls('free', 'BOOLEAN')}, 'FEE_ADDED' AS fee_type, '2024-01-01' AS sale_start_date,
      '00:00:00' AS sale_start_time, {nulls('sale_end_date sale_end_time')},
      {nulls('display_not_on_sale', 'BOOLEAN')}, {nulls('sale_status')},
      {nulls('unsold_count', 'BIGINT')}, CAST(p_size AS BIGINT) AS sold_count,
      {nulls('reserved_count', 'BIGINT')}, p_size = 50 AS sold_out,
      CAST(p_size AS BIGINT) AS initial_limit, {nulls('actual_limit', 'BIGINT')},
      CAST(4 AS BIGINT) AS limit_per_checkout, '2023-12-01' AS created_date,
      '08:00:00' AS created_time, {nulls('updated_date updated_time')}
    FROM part""")
def _(lake):
    return sa.flatten_ticket_definitions(nested(lake, "ticket_definitions", """
        SELECT CAST(p_partkey AS STRING) AS id, 'e' AS eventId, p_partkey AS revision,
          p_name AS name, p_size > 40 AS hidden, named_struct('pricingType', p_type,
            'fixedPrice', CASE WHEN p_type <> 'PROMO' THEN named_struct('value',
              CAST(p_retailprice AS STRING), 'currency', 'CAD') END,
            'pricingOptions', CASE WHEN p_size > 25 THEN named_struct('options', array(
              named_struct('name', 'Early'), named_struct('name', ''),
              named_struct('name', p_brand))) END) AS pricingMethod,
          'FEE_ADDED' AS feeType, named_struct('startDate', '2024-01-01T00:00:00Z') AS salePeriod,
          named_struct('soldCount', p_size, 'soldOut', p_size = 50) AS salesDetails,
          p_size AS initialLimit, 4 AS limitPerCheckout,
          '2023-12-01T08:00:00Z' AS _createdDate FROM {part}"""))


@query("t9_flatten_order_summaries", """
    WITH x AS (SELECT o_orderkey, o_orderstatus, o_orderpriority,
        CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders)
    SELECT CAST(o_orderkey AS VARCHAR) AS event_id,
      CASE WHEN o_orderstatus = 'P' THEN 'Untitled Event' ELSE 'T' END AS event_title,
      CASE WHEN o_orderstatus <> 'F' THEN CAST(total AS DOUBLE) END AS total_sales_amount,
      CASE WHEN o_orderstatus <> 'F' THEN 'CAD' END AS total_sales_currency,
      CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 0.0
           ELSE CAST(total - 100 AS DOUBLE) END AS revenue_amount,
      CASE WHEN o_orderstatus <> 'F' THEN 'CAD' END AS revenue_currency,
      CASE WHEN o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT' THEN '100.00' END
        AS fees_amount,
      CASE WHEN o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT'
           THEN CAST(CAST(round(CAST(10000.0 / CAST(total AS DOUBLE) AS DECIMAL(30,12)), 2)
                AS DECIMAL(18,2)) AS VARCHAR) END AS fees_percentage,
      CASE WHEN o_orderstatus <> 'F' THEN 3 ELSE 0 END::BIGINT AS total_orders,
      CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderpriority = '2-HIGH' THEN 0 ELSE 4 END::BIGINT
        AS total_tickets,
      CASE WHEN o_orderstatus <> 'F' AND o_orderpriority <> '2-HIGH'
           THEN CAST(CAST(round(CAST(total * 0.25 AS DECIMAL(24,4)), 2) AS DECIMAL(18,2))
                AS VARCHAR) END AS avg_ticket_price,
      o_orderstatus <> 'F' AS has_sales
    FROM x""")
def _(lake):
    return sa.flatten_order_summaries(nested(lake, "order_summaries", """
        SELECT CAST(o_orderkey AS STRING) AS event_id,
          CASE WHEN o_orderstatus <> 'P' THEN 'T' END AS event_title,
          named_struct('sales', CASE WHEN o_orderstatus <> 'F' THEN array(named_struct(
            'total', named_struct('amount', CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)
              AS VARIANT), 'currency', 'CAD'),
            'revenue', named_struct('amount', CASE WHEN o_orderpriority = '1-URGENT'
              THEN parse_json('0') ELSE CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 100
              AS STRING) AS VARIANT) END, 'currency', 'CAD'),
            'totalOrders', 3, 'totalTickets', CASE WHEN o_orderpriority <> '2-HIGH' THEN 4 END))
          ELSE CAST(NULL AS ARRAY<STRUCT<total: STRUCT<amount: VARIANT, currency: STRING>,
            revenue: STRUCT<amount: VARIANT, currency: STRING>, totalOrders: INT,
            totalTickets: INT>>) END) AS summary
        FROM {orders}"""))


@query("t10_flatten_event_orders", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_number, 'e' AS event_id, {nulls('reservation_id')},
      's1' AS snapshot_id, CAST(o_custkey AS VARCHAR) AS contact_id, {nulls('member_id')},
      'Bo' AS first_name, {nulls('last_name email full_name')}, 'PAID' AS status,
      o_orderstatus = 'F' AS confirmed, FALSE AS archived, FALSE AS anonymized,
      'ONLINE' AS channel, {nulls('method')},
      CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 0 END::BIGINT AS tickets_quantity,
      {nulls('tickets_pdf')}, FALSE AS fully_checked_in,
      CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 3 END AS ticket_count,
      CASE WHEN o_orderstatus <> 'P' THEN 'A, B' END AS ticket_names,
      CASE WHEN o_orderstatus <> 'P' THEN 'n1, n2' END AS ticket_numbers,
      CASE WHEN o_orderstatus <> 'P' THEN '12, 7.5' END AS ticket_prices,
      {nulls('transaction_id')}, 'card' AS payment_method,
      {nulls('payment_transaction_id scheduled_action')},
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS subtotal,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total,
      {nulls('tax discount fees', 'DOUBLE')}, 'CAD' AS currency,
      CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS gift_card_count,
      'ARCHIVE, CONFIRM' AS available_actions, {day('o_orderdate')} AS created_date,
      '17:05:09' AS created_time, {day('o_orderdate')} || 'T17:05:09.250Z' AS created_datetime,
      {nulls('updated_date updated_time updated_datetime')}
    FROM orders""")
def _(lake):
    return sa.flatten_event_orders(nested(lake, "event_orders", f"""
        SELECT CAST(o_orderkey AS STRING) AS orderNumber, 'e' AS eventId, '' AS reservationId,
          's1' AS snapshotId, CAST(o_custkey AS STRING) AS contactId, '' AS memberId,
          'Bo' AS firstName, '' AS lastName, 'PAID' AS status,
          CASE WHEN o_orderstatus = 'F' THEN TRUE END AS confirmed, 'ONLINE' AS channel,
          CASE WHEN o_orderstatus = 'P' THEN 2 END AS ticketsQuantity,
          CASE WHEN o_orderstatus <> 'P' THEN array(
            named_struct('ticketName', '', 'name', 'A', 'ticketNumber', 'n1', 'number', 'z',
              'price', to_variant_object(named_struct('amount', '', 'value', '12'))),
            named_struct('ticketName', 'B', 'name', 'x', 'ticketNumber', CAST(NULL AS STRING),
              'number', 'n2', 'price', parse_json('7.5')),
            named_struct('ticketName', '', 'name', '', 'ticketNumber', '', 'number', '',
              'price', parse_json('0'))) END AS tickets,
          named_struct('transaction', named_struct('method', 'card', 'transactionId', ''),
            'priceSummary', named_struct(
              'subtotal', to_variant_object(named_struct('amount',
                CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING))),
              'total', CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS VARIANT),
              'currency', 'CAD')) AS paymentDetails,
          CASE WHEN o_orderstatus = 'O' THEN array('g') END AS giftCardPaymentDetails,
          array('ARCHIVE', 'CONFIRM') AS availableActions, '' AS created,
          {iso('o_orderdate')} AS createdDate
        FROM {{orders}}"""))


@query("t11_flatten_payments", f"""
    WITH x AS (SELECT *, CASE event_type WHEN 'purchase' THEN 20.0 WHEN 'error' THEN value
        WHEN 'view' THEN NULL END AS refunded FROM events)
    SELECT CAST(event_id AS VARCHAR) AS transaction_id, {nulls('provider_transaction_id')},
      'o1' AS order_id, CAST(user_id AS VARCHAR) AS app_order_id, {nulls('app_buyer_id')},
      '215238eb-22a5-4c36-9e7b-e7c08025e04e' AS app_id, 'Stores' AS app_name,
      substring(CAST(ts AS VARCHAR), 1, 10) AS payment_date,
      substring(CAST(ts AS VARCHAR), 12, 8) AS payment_time,
      replace(substring(CAST(ts AS VARCHAR), 1, 19), ' ', 'T') || 'Z' AS payment_datetime,
      'CAD' AS currency, value AS amount, CASE WHEN value > 10 THEN 1.5::DOUBLE END AS platform_fee,
      2.25::DOUBLE AS service_fee_line_amount,
      value - CASE WHEN value > 10 THEN 1.5::DOUBLE ELSE 0 END - coalesce(refunded, 0)
        AS net_amount,
      0.5::DOUBLE AS tax, {nulls('shipping discount', 'DOUBLE')},
      CASE event_type WHEN 'click' THEN 'PENDING_BUYER' WHEN 'signup' THEN 'ODD_ONE'
           ELSE 'APPROVED' END AS status,
      CASE event_type WHEN 'click' THEN 'Pending' WHEN 'signup' THEN 'Odd_One'
           WHEN 'view' THEN 'Successful' WHEN 'error' THEN 'Refunded'
           ELSE CASE WHEN value <= 20 THEN 'Refunded' ELSE 'Partially refunded' END END
        AS transaction_status,
      'SALE' AS transaction_type, TRUE AS is_refundable,
      {nulls('non_refundable_reason failure_code')},
      CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN 'other'
           ELSE 'com.stripe' END AS payment_provider,
      CASE WHEN event_type = 'view' THEN 'Pay in person' WHEN event_type = 'click' THEN 'Named'
           ELSE 'Stripe' END AS payment_provider_friendly,
      'CreditCard' AS payment_method, {nulls('payment_method_type provider_dashboard_link')},
      'visa' AS card_network, {nulls('card_last_four card_masked card_expiry')},
      'A B' AS card_holder_name, {nulls('card_bin')}, {nulls('installments', 'BIGINT')},
      CASE WHEN event_type IN ('purchase', 'error') THEN 3 WHEN event_type = 'view' THEN 1
           ELSE 0 END AS refund_count,
      CASE WHEN event_type IN ('purchase', 'error') THEN 2 ELSE 0 END AS refund_succeeded_count,
      CASE WHEN event_type IN ('purchase', 'error') THEN refunded END AS refund_total_amount,
      CASE WHEN event_type IN ('purchase', 'error') THEN 'succeeded' WHEN event_type = 'view'
           THEN 'FAILED' END AS refund_status, {nulls('refund_type')},
      CASE WHEN event_type IN ('purchase', 'error') THEN 'c' WHEN event_type = 'view' THEN 'x' END
        AS refund_reason, {nulls('refund_provider_id')},
      CASE WHEN event_type IN ('purchase', 'error') THEN '2024-06-02' WHEN event_type = 'view'
           THEN '2024-06-01' END AS refund_date,
      CASE WHEN event_type IN ('purchase', 'error') THEN '01:00:00' WHEN event_type = 'view'
           THEN '02:00:00' END AS refund_time,
      'Bo' AS billing_first_name, ' ' AS billing_last_name, 'Bo' AS billing_full_name,
      {nulls('billing_email billing_phone billing_company billing_address')},
      'Oslo' AS billing_city, {nulls('billing_state billing_zip billing_country')},
      {nulls('shipping_first_name shipping_last_name shipping_email shipping_city')},
      {nulls('shipping_country')}, 'Ticket, ' || event_type AS product_name, 3 AS product_count,
      CAST(2 + user_id % 3 AS BIGINT) AS total_quantity, 'Ticket' AS primary_product_name,
      value AS primary_product_unit_price, CAST(2 AS BIGINT) AS primary_product_quantity,
      {nulls('subscription_status subscription_frequency')},
      {nulls('subscription_interval subscription_billing_cycles', 'BIGINT')}
    FROM x""")
def _(lake):
    return sa.flatten_payments(nested(lake, "payments", """
        SELECT CAST(event_id AS STRING) AS transactionId, '' AS providerTransactionId,
          '215238eb-22a5-4c36-9e7b-e7c08025e04e' AS appId,
          replace(substring(CAST(ts AS STRING), 1, 19), ' ', 'T') || 'Z' AS createdAt,
          named_struct('amount', CAST(value AS STRING), 'currency', 'CAD') AS amount,
          CASE WHEN value > 10 THEN '1.5' ELSE '' END AS platformFee,
          CASE event_type WHEN 'click' THEN 'PENDING_BUYER' WHEN 'signup' THEN 'ODD_ONE'
            ELSE 'APPROVED' END AS status, 'SALE' AS type,
          CASE WHEN event_type = 'view' THEN '' WHEN event_type = 'click' THEN 'other'
            ELSE 'com.stripe' END AS provider,
          'Named' AS providerName, 'CreditCard' AS paymentMethod,
          named_struct('network', 'visa', 'lastFour', '', 'holderName', ' A B ', 'installments', 0)
            AS paymentMethodData,
          named_struct('isRefundable', TRUE) AS refundability,
          CASE WHEN event_type IN ('purchase', 'error') THEN array(
              named_struct('status', 'SUCCEEDED', 'amount', CASE WHEN event_type = 'purchase'
                THEN '12.5' ELSE CAST(value AS STRING) END, 'createdAt', '2024-06-01T00:00:00Z',
                'reason', 'a'),
              named_struct('status', 'succeeded', 'amount', CASE WHEN event_type = 'purchase'
                THEN '7.5' ELSE 'x' END, 'createdAt', '2024-06-02T01:00:00Z', 'reason', 'c'),
              named_struct('status', 'FAILED', 'amount', '99', 'createdAt',
                '2024-06-02T00:00:00Z', 'reason', 'c'))
            WHEN event_type = 'view' THEN array(named_struct('status', 'FAILED', 'amount', '5',
              'createdAt', '2024-06-01T02:00:00Z', 'reason', 'x')) END AS refunds,
          named_struct('id', 'o1', 'description', named_struct(
            'appOrderId', CAST(user_id AS STRING), 'appBuyerId', '',
            'billingAddress', named_struct('firstName', 'Bo', 'lastName', ' ', 'city', 'Oslo'),
            'items', array(
              named_struct('id', 'p', 'name', 'Ticket', 'quantity', 2, 'price',
                CAST(value AS STRING)),
              named_struct('id', 'SERVICE_FEE', 'name', 'Fee', 'quantity', 9, 'price', '2.25'),
              named_struct('id', CAST(NULL AS STRING), 'name', event_type, 'quantity',
                CAST(user_id % 3 AS INT), 'price', ''),
              named_struct('id', 'q', 'name', '', 'quantity', CAST(NULL AS INT), 'price', '')),
            'additionalCharges', named_struct('tax', '0.5', 'discount', 'nan'))) AS order
        FROM {events}"""))


@query("t12_flatten_store_orders", f"""
    WITH txn AS (SELECT l_orderkey, count(*) AS n,
        array_to_string(list_sort(list(DISTINCT l_returnflag)), ', ') AS statuses
      FROM lineitem GROUP BY l_orderkey),
    one AS (SELECT l_orderkey, arg_min(l_returnflag, k) AS st, min(k) AS k FROM (
        SELECT l_orderkey, l_returnflag,
          l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS k FROM lineitem) GROUP BY 1)
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 'N' || CAST(o_orderkey AS VARCHAR)
        AS order_number, {nulls('checkout_id')}, CAST(o_custkey AS VARCHAR) AS buyer_id,
      {nulls('buyer_email')}, 'Bo' AS buyer_first_name, {nulls('buyer_last_name buyer_phone')},
      'Bo' AS buyer_full_name, 'en' AS buyer_language, {nulls('billing_address')},
      'Oslo' AS billing_city, {nulls('billing_country billing_subdivision billing_postal_code')},
      o_orderstatus AS payment_status, {nulls('fulfillment_status')}, 'CAD' AS currency,
      {nulls('subtotal_amount', 'DOUBLE')}, {nulls('subtotal_formatted')},
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
      {nulls('total_formatted')}, {nulls('tax_amount', 'DOUBLE')}, {nulls('tax_formatted')},
      {nulls('shipping_amount', 'DOUBLE')}, {nulls('shipping_formatted')},
      {nulls('discount_amount', 'DOUBLE')}, {nulls('discount_formatted')}, 2 AS line_item_count,
      'Orig, plain' AS product_names, 'c1' AS product_ids, '1, 3' AS quantities,
      'Orig' AS primary_product_name, 4.5::DOUBLE AS primary_product_price,
      CAST(1 AS BIGINT) AS primary_product_quantity,
      CASE WHEN o_orderstatus = 'F' THEN 'SAVE' END AS discount_codes,
      CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 0 END AS discount_count, 'WEB' AS channel_type,
      {nulls('shipping_first_name shipping_last_name shipping_phone shipping_address')},
      {nulls('shipping_city shipping_country shipping_subdivision shipping_postal_code')},
      'Post' AS shipping_method, {nulls('shipping_carrier')}, {day('o_orderdate')} AS created_date,
      '17:05:09' AS created_time, {day('o_orderdate')} || 'T17:05:09.250Z' AS created_datetime,
      {nulls('updated_date updated_time updated_datetime')}, 0 AS custom_field_count,
      FALSE AS archived, 1 AS activity_count,
      CAST(coalesce(txn.n, 0) AS INT) AS transaction_count, txn.statuses AS transaction_statuses,
      CAST(one.k AS VARCHAR) AS primary_transaction_id, one.st AS primary_transaction_status,
      CASE WHEN one.k IS NOT NULL THEN 'card' END AS primary_payment_method,
      CASE WHEN one.k IS NOT NULL THEN 1.25::DOUBLE END AS transaction_amount,
      CASE WHEN one.k IS NOT NULL THEN 'CAD' END AS transaction_currency
    FROM orders LEFT JOIN txn ON o_orderkey = txn.l_orderkey
    LEFT JOIN one ON o_orderkey = one.l_orderkey""")
def _(lake):
    orders = nested(lake, "store_orders", f"""
        SELECT CAST(o_orderkey AS STRING) AS id, 'N' || o_orderkey AS number,
          named_struct('id', CAST(o_custkey AS STRING), 'firstName', 'Bo') AS buyerInfo,
          'en' AS buyerLanguage, named_struct('address', named_struct('city', 'Oslo'))
            AS billingInfo, o_orderstatus AS paymentStatus, named_struct('total',
            named_struct('amount', CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)))
            AS pricingSummary, 'CAD' AS currency,
          array(named_struct('productName', to_variant_object(named_struct('original', 'Orig',
              'translated', 'Tr')), 'catalogReference', named_struct('catalogItemId', 'c1'),
              'quantity', CAST(NULL AS INT), 'price', named_struct('amount', '4.5')),
            named_struct('productName', CAST('plain' AS VARIANT), 'catalogReference',
              named_struct('catalogItemId', ''), 'quantity', 3, 'price',
              named_struct('amount', '1'))) AS lineItems,
          CASE WHEN o_orderstatus = 'F' THEN array(named_struct('coupon', named_struct('code',
            'SAVE')), named_struct('coupon', named_struct('code', ''))) END AS appliedDiscounts,
          named_struct('type', 'WEB') AS channelInfo, named_struct('logistics', named_struct(
            'selectedCarrierServiceOption', named_struct('title', 'Post'))) AS shippingInfo,
          {iso('o_orderdate')} AS createdDate, array('a') AS activities
        FROM {{orders}}""")
    return sa.flatten_store_orders(orders, _transactions(lake))


def _transactions(lake):
    return conform(lake.sql("""
        SELECT CAST(l_orderkey AS STRING) AS orderId,
          CAST(l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS STRING) AS id,
          l_returnflag AS status, 'card' AS paymentMethod, named_struct('total', '1.25') AS amounts,
          'CAD' AS currency, l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS _ord
        FROM {lineitem}"""), raw_schema("store_transactions"))


@query("j4_orders_with_transactions", """
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(count(l_orderkey) AS INT)
        AS transaction_count,
      CASE WHEN count(l_orderkey) > 0 THEN array_to_string(list_sort(list(DISTINCT l_returnflag)),
        ', ') END AS transaction_statuses
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def _(lake):
    from turnstile.operators.enrich import orders_with_transactions

    ids = lake.orders.select(F.col("o_orderkey").cast("string").alias("order_id"))
    return orders_with_transactions(ids, sa.transaction_summary(_transactions(lake))).select(
        "order_id", "transaction_count", "transaction_statuses")


@query("t13_flatten_rsvps", f"""
    SELECT 'r' || CAST(event_id AS VARCHAR) AS rsvp_id, event_type AS event_id,
      CAST(user_id AS VARCHAR) AS contact_id, {nulls('member_id')},
      CASE WHEN value > 20 THEN 'YES' ELSE 'NO' END AS rsvp_status, {nulls('check_in_status')},
      'Bo' AS first_name, {nulls('last_name email')},
      CASE WHEN value > 40 THEN 'Al; Cy' END AS guest_names,
      CASE WHEN value > 40 THEN 2 ELSE 0 END::BIGINT AS additional_guests,
      CASE WHEN value > 40 THEN 3 ELSE 1 END::BIGINT AS total_guests,
      '2024-02-01' AS created_date, '00:00:01' AS created_time,
      {nulls('updated_date updated_time')}, 'form_any.q=' || event_type AS form_fields
    FROM events""")
def _(lake):
    return pe.flatten_rsvps(_rsvps(lake)).withColumn("form_fields", map_text("form_fields"))


def _rsvps(lake):
    return nested(lake, "rsvps", """
        SELECT 'r' || event_id AS id, event_type AS eventId, CAST(user_id AS STRING) AS contactId,
          CASE WHEN value > 20 THEN 'YES' ELSE 'NO' END AS rsvpStatus, 'Bo' AS firstName,
          CASE WHEN value > 40 THEN array('Al', 'Cy') END AS guestNames,
          CASE WHEN value > 40 THEN 2 END AS additionalGuests,
          CASE WHEN value > 40 THEN 3 END AS totalGuests,
          named_struct('inputValues', array(named_struct('inputName', 'Any.Q', 'value',
            CAST(event_type AS VARIANT)), named_struct('inputName', '', 'value',
            CAST('x' AS VARIANT)))) AS formResponse, '2024-02-01T00:00:01' AS createdDate
        FROM {events}""")


@query("a27_rsvp_summary", """
    SELECT CASE WHEN value > 20 THEN 'YES' ELSE 'NO' END AS rsvp_status, count(*) AS rsvps,
      CAST(sum(CASE WHEN value > 40 THEN 3 ELSE 1 END) AS BIGINT) AS guests
    FROM events GROUP BY 1""")
def _(lake):
    from turnstile.plans.reports import rsvp_summary

    return rsvp_summary(pe.flatten_rsvps(_rsvps(lake)))


SUBMISSION_RAW = """
    SELECT CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS id,
      'f' || CAST(turn AS STRING) AS formId, 'forms.test' AS namespace, 'CONFIRMED' AS status,
      named_struct('contactId', CAST(conv_id AS STRING)) AS submitter,
      '2024-04-05T06:07:08.123456Z' AS _createdDate, turn > 0 AS seen,
      CASE WHEN turn < 7 THEN map('Said by.' || role, CAST(text AS VARIANT),
        'List', parse_json('["a", 1, true]'), 'Obj', parse_json('{{"k":1}}'),
        'n', parse_json(CAST(turn AS STRING))) END AS submissions,
      conv_id * 100 + turn AS _ord
    FROM {conversations}"""


@query("t14_flatten_submissions_wide", f"""
    SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS submission_id,
      'f' || CAST(turn AS VARCHAR) AS form_id, 'forms.test' AS namespace, 'CONFIRMED' AS status,
      CAST(conv_id AS VARCHAR) AS submitter_contact_id, {nulls('submitter_member_id')},
      '2024-04-05' AS created_date, '06:07:08' AS created_time,
      {nulls('updated_date updated_time')}, turn > 0 AS seen,
      CASE WHEN turn < 7 THEN 'field_list=a; 1; true|field_n=' || CAST(turn AS VARCHAR)
        || '|field_obj={{"k":1}}|field_said_by_' || role || '=' || text ELSE '' END AS fields
    FROM conversations""".replace("{{", "{").replace("}}", "}"))
def _(lake):
    wide = fo.flatten_submissions_wide(nested(lake, "form_submissions", SUBMISSION_RAW))
    return wide.withColumn("fields", map_text("fields")).drop("_ord")


@query("t15_flatten_submissions_long", """
    WITH x AS (SELECT *, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS sid
               FROM conversations),
    f AS (SELECT sid, 'Said by.' || role AS field_name, text AS field_value FROM x WHERE turn < 7
      UNION ALL SELECT sid, 'List', 'a; 1; true' FROM x WHERE turn < 7
      UNION ALL SELECT sid, 'Obj', '{"k":1}' FROM x WHERE turn < 7
      UNION ALL SELECT sid, 'n', CAST(turn AS VARCHAR) FROM x WHERE turn < 7
      UNION ALL SELECT sid, NULL, NULL FROM x WHERE turn >= 7)
    SELECT sid AS submission_id, 'f' || CAST(turn AS VARCHAR) AS form_id,
      'forms.test' AS namespace, CAST(conv_id AS VARCHAR) AS submitter_contact_id,
      CAST(NULL AS VARCHAR) AS submitter_member_id, 'CONFIRMED' AS status,
      '2024-04-05' AS created_date, field_name, field_value
    FROM x JOIN f USING (sid)""")
def _(lake):
    return fo.flatten_submissions_long(
        nested(lake, "form_submissions", SUBMISSION_RAW)).drop("_ord")


@query("f2_pivot_submissions", """
    SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS submission_id,
      CASE WHEN turn < 7 THEN 'a; 1; true' END AS field_list,
      CASE WHEN turn < 7 THEN CAST(turn AS VARCHAR) END AS field_n,
      CASE WHEN turn < 7 THEN '{"k":1}' END AS field_obj,
      CASE WHEN turn < 7 AND role = 'assistant' THEN text END AS field_said_by_assistant,
      CASE WHEN turn < 7 AND role = 'system' THEN text END AS field_said_by_system,
      CASE WHEN turn < 7 AND role = 'user' THEN text END AS field_said_by_user
    FROM conversations""")
def _(lake):
    wide = fo.flatten_submissions_wide(nested(lake, "form_submissions", SUBMISSION_RAW))
    return fo.pivot_submissions(wide.select("submission_id", "fields"))


@query("t16_flatten_coupons", f"""
    SELECT CAST(p_partkey AS VARCHAR) AS coupon_id, p_name AS name, p_brand AS code,
      p_size > 10 AS active, p_size <= 10 AS expired, {nulls('coupon_type display_name')},
      CASE WHEN p_size % 4 = 0 THEN 'money_off' WHEN p_size % 4 = 1 THEN 'percent_off'
           WHEN p_size % 4 = 2 THEN 'fixed_price' WHEN p_size > 25 THEN 'free_shipping' END
        AS discount_type,
      CASE WHEN p_size % 4 < 3 THEN CAST(p_size + 1 AS DOUBLE) END AS discount_value,
      'stores' AS scope_namespace, 'product' AS scope_group_name, {nulls('scope_entity_id')},
      p_retailprice AS minimum_subtotal, FALSE AS limited_to_one_item,
      {nulls('applies_to_lowest_price', 'BOOLEAN')}, CAST(1 AS BIGINT) AS limit_per_customer,
      CAST(p_size AS BIGINT) AS number_of_usages, '2024-01-02' AS created_date,
      '03:04:05' AS created_time, '2024-02-02' AS start_date, {nulls('start_time')},
      {nulls('expiration_date expiration_time')}
    FROM part""")
def _(lake):
    return sa.flatten_coupons(nested(lake, "coupons", """
        SELECT CAST(p_partkey AS STRING) AS id, p_name AS name, p_brand AS code,
          p_size > 10 AS active, p_size <= 10 AS expired, named_struct(
            'moneyOffAmount', CASE WHEN p_size % 4 = 0 THEN p_size + 1 ELSE 0 END,
            'percentOffRate', CASE WHEN p_size % 4 = 1 THEN p_size + 1 END,
            'fixedPriceAmount', CASE WHEN p_size % 4 = 2 THEN p_size + 1 END,
            'freeShipping', p_size > 25, 'scope', named_struct('namespace', 'stores', 'group',
              named_struct('name', 'product')), 'minimumSubtotal', p_retailprice,
            'limitedToOneItem', FALSE, 'startTime', '2024-02-02') AS specification,
          1 AS limitPerCustomer, p_size AS numberOfUsages, '2024-01-02T03:04:05Z' AS dateCreated
        FROM {part}"""))


@query("t17_flatten_automations", f"""
    SELECT CAST(s_suppkey AS VARCHAR) AS automation_id, s_name AS name, {nulls('description')},
      'ACTIVE' AS status, 'USER' AS origin, 'app' AS app_id, 'k' AS trigger_key,
      {nulls('trigger_app_id')}, CASE WHEN s_acctbal > 3000 THEN 3 ELSE 0 END AS action_count,
      CASE WHEN s_acctbal > 3000 THEN 'mail' END AS first_action_key, {nulls('first_action_app_id')},
      CASE WHEN s_acctbal > 3000 THEN 'mail; ' || s_name END AS all_action_keys,
      '2024-01-02' AS created_date, '03:04:05' AS created_time, {nulls('updated_date updated_time')}
    FROM supplier""")
def _(lake):
    return fo.flatten_automations(nested(lake, "automations", """
        SELECT CAST(s_suppkey AS STRING) AS id, s_name AS name, 'ACTIVE' AS status,
          'USER' AS origin, named_struct('appDefId', 'app') AS applicationInfo,
          named_struct('trigger', named_struct('triggerKey', 'k'), 'actions',
            CASE WHEN s_acctbal > 3000 THEN array(named_struct('actionKey', 'mail'),
              named_struct('actionKey', ''), named_struct('actionKey', s_name)) END)
            AS configuration, '2024-01-02T03:04:05Z' AS _createdDate
        FROM {supplier}"""))


@query("t18_flatten_address", f"""
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS formatted_address, n_name AS city,
      {nulls('country subdivision postal_code street_number')}, c_mktsegment AS street_name,
      {nulls('street_apt')}, c_acctbal AS latitude, {nulls('longitude', 'DOUBLE')}
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def _(lake):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField(
        "address", raw_schema("events")["location"].dataType["address"].dataType)])
    rows = conform(lake.sql("""
        SELECT CAST(c_custkey AS STRING) AS id, named_struct('formattedAddress', c_name, 'city',
          n_name, 'streetAddress', named_struct('name', c_mktsegment), 'geocode',
          named_struct('latitude', c_acctbal)) AS address
        FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey"""), schema)
    return ev.flatten_address(rows, "address").drop("address")


@query("t19_flatten_price", """
    SELECT p_partkey, CAST(p_retailprice AS VARCHAR) AS value, 'CAD' AS currency,
      '$' || CAST(p_retailprice AS VARCHAR) AS formatted FROM part""")
def _(lake):
    rows = lake.sql("""
        SELECT p_partkey, named_struct('value', CAST(p_retailprice AS STRING), 'currency', 'CAD',
          'formattedValue', '$' || CAST(p_retailprice AS STRING)) AS price FROM {part}""")
    return ev.flatten_price(rows, "price").drop("price")
