"""Ticketing entities over a retail star schema, for tests and benchmarks.

Every entity maps whole tables, so all of them grow with the data: suppliers are events,
parts are ticket definitions, customers are contacts, orders are ticket orders, line items
are ticket stubs and stream events are payments. The SQL uses only what Spark and DuckDB
share, so one text defines the entity for both sides of a comparison. ``{table}`` marks a
base table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_DAYS = (
    "CASE (s_suppkey % 365) % 7 WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' "
    "WHEN 2 THEN 'Wednesday' WHEN 3 THEN 'Thursday' WHEN 4 THEN 'Friday' "
    "WHEN 5 THEN 'Saturday' ELSE 'Sunday' END"
)
_ORDER_KEY = "(user_id * 100 + CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT))"
_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
_ADJ = "'hot,cold,red,blue,old,new,large,small'"
_NOUN = "'rod,bolt,gear,plate,ring,gizmo,widget,anvil'"
_FIRST = "'anna,bela,carl,dora,emil,fred,gina,hugo,ines,jost,kira,lars,mara,nils,olga,paul,rita,sven,tina,ugo'"
_SYL1 = "'bar,cor,dan,fel,gor,hal,jar,kel,lom,mar,nor,pel,ros,sal,tam,ven,wil,yor,zan,bri'"
_SYL2 = "'an,be,co,di,el,fa,go,hi,im,jo,ka,le,mo,ni,ol,pa,ri,so,tu,wa'"
_SYL3 = "'son,sen,man,ley,ton,ford,berg,dal,wood,field,ham,by,well,stad,holm,gaard,mere,brook,ridge,hurst'"


def _pick(words: str, n: str, size: int) -> str:
    return f"split_part({words}, ',', CAST(({n}) % {size} + 1 AS INT))"


def _div(n: str, by: int) -> str:
    return f"CAST((({n}) - ({n}) % {by}) / {by} AS BIGINT)"


_STUBS = """
    SELECT l_orderkey, l_linenumber, l_partkey, MIN(l_suppkey) AS l_suppkey,
           MAX(l_returnflag) AS l_returnflag, MAX(l_linestatus) AS l_linestatus,
           MAX(l_tax) AS l_tax, MAX(l_shipdate) AS l_shipdate,
           MAX(l_extendedprice) AS l_extendedprice
    FROM {lineitem} GROUP BY l_orderkey, l_linenumber, l_partkey"""

_TICKET_NO = (
    "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || "
    "CAST(l_partkey AS STRING)"
)

ENTITY_SQL: dict[str, str] = {
    "t_event": f"""
    SELECT CAST(s_suppkey AS STRING) AS event_id, s_name AS title,
           lower(replace(s_name, '#', '-')) AS slug,
           CASE WHEN s_acctbal < 2000 THEN 'ENDED' WHEN s_acctbal < 6000 THEN 'UPCOMING'
                ELSE 'SCHEDULED' END AS status,
           CASE WHEN s_acctbal < 500 THEN 'RSVP' ELSE 'TICKETING' END AS registration_type,
           r_name || ', ' || n_name AS category_names, 2 AS category_count,
           CAST(DATE '2024-01-01' + CAST(s_suppkey % 365 AS INT) AS STRING) AS start_date,
           '19:30:00' AS start_time,
           CAST(DATE '2024-01-01' + CAST(s_suppkey % 365 AS INT) AS STRING) || 'T19:30:00Z'
               AS start_datetime,
           CAST(DATE '2024-01-01' + CAST(s_suppkey % 365 AS INT) AS STRING) AS end_date,
           '22:00:00' AS end_time, 'UTC' AS timezone,
           {_DAYS} AS day_of_week, (s_suppkey % 365) % 7 >= 5 AS is_weekend,
           s_name || ' Hall' AS location_name, n_name AS location_city,
           abs(s_acctbal) / 100 AS lowest_price,
           CASE WHEN s_acctbal > 1000 THEN abs(s_acctbal) / 50 END AS highest_price,
           'CAD' AS currency, s_suppkey AS _ord
    FROM {{supplier}} LEFT JOIN {{nation}} ON s_nationkey = n_nationkey
         LEFT JOIN {{region}} ON n_regionkey = r_regionkey""",
    "t_contact": """
    SELECT CAST(c_custkey AS STRING) AS contact_id,
           CASE WHEN c_acctbal < 0 THEN '' ELSE lower(c_mktsegment) END AS first_name,
           c_name AS last_name,
           CASE WHEN c_acctbal >= 0 THEN lower(c_mktsegment) || ' ' || c_name END AS full_name,
           CASE WHEN c_mktsegment <> 'MACHINERY' OR c_acctbal > 1000
                THEN lower(replace(c_name, '#', '.')) || '@x.test' END AS primary_email,
           'alt.' || lower(replace(c_name, '#', '.')) || '@x.test' AS email,
           c_mktsegment = 'BUILDING' AS is_member,
           CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal >= 0
                THEN 'm' || CAST(c_custkey AS STRING) END AS member_id,
           c_custkey AS _ord
    FROM {customer}""",
    "t_member": """
    SELECT 'm' || CAST(c_custkey AS STRING) AS member_id,
           CAST(c_custkey AS STRING) AS contact_id,
           CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INT) AS STRING) AS created_date,
           CAST(DATE '2023-01-01' + CAST(c_custkey % 300 AS INT) AS STRING) AS last_login_date,
           c_custkey AS _ord
    FROM {customer} WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= 500""",
    "t_def": f"""
    SELECT CAST(p_partkey AS STRING) AS definition_id,
           CAST({_div('p_partkey', 20)} AS STRING) AS event_id,
           CASE WHEN p_size = 50 THEN ' ' WHEN p_size > 40 THEN ' ' || upper(p_name) || ' '
                ELSE p_name END AS name,
           CASE WHEN p_type <> 'PROMO' THEN p_retailprice END AS fixed_price_value,
           CASE WHEN p_type <> 'PROMO' THEN 'CAD' END AS fixed_price_currency,
           p_type AS pricing_type,
           CASE WHEN p_size > 3 THEN CAST(p_size AS BIGINT) END AS initial_limit,
           CASE WHEN p_size > 20 THEN CAST(p_size * 2 AS BIGINT) END AS actual_limit,
           CAST(p_size % 7 AS BIGINT) AS limit_per_checkout,
           CASE WHEN p_brand = 'Brand#1' THEN TRUE WHEN p_brand = 'Brand#2' THEN FALSE END AS free,
           CASE WHEN p_size < 25 THEN 'FEE_ADDED' ELSE 'FEE_INCLUDED' END AS fee_type,
           CASE WHEN p_size < 30 THEN 'SALE_STARTED' ELSE 'SALE_ENDED' END AS sale_status,
           CAST(p_size * 3 AS BIGINT) AS sold_count, p_size > 45 AS sold_out,
           p_partkey AS _ord
    FROM {{part}}""",
    "t_order": """
    SELECT CAST(o_orderkey AS STRING) AS order_number, CAST(first_supp AS STRING) AS event_id,
           CASE WHEN o_orderpriority <> '5-LOW' OR o_orderstatus <> 'P'
                THEN CAST(o_custkey AS STRING) END AS contact_id,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'om' || CAST(o_custkey AS STRING) END
               AS member_id,
           CASE WHEN o_orderstatus = 'O' THEN 'OFFLINE' ELSE 'ONLINE' END AS channel,
           'NA_ORDER_STATUS' AS status, COALESCE(n_lines, 0) AS tickets_quantity,
           CAST(NULL AS STRING) AS ticket_names, o_totalprice AS total,
           CAST(CAST(o_orderdate AS DATE) AS STRING) AS created_date, o_orderkey AS _ord
    FROM {orders} LEFT JOIN (
        SELECT l_orderkey, MIN(l_suppkey) AS first_supp, COUNT(*) AS n_lines
        FROM {lineitem} GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "t_payment": f"""
    SELECT CAST(event_id AS STRING) AS transaction_id,
           CASE WHEN event_type <> 'click' THEN 'ch_' || CAST(event_id AS STRING) END
               AS provider_transaction_id,
           'o' || CAST(event_id AS STRING) AS order_id,
           CASE WHEN event_type = 'signup' AND value < 20 THEN NULL
                WHEN event_type = 'error' AND value > 100
                    THEN 'x' || CAST({_ORDER_KEY} AS STRING)
                ELSE CAST({_ORDER_KEY} AS STRING) END AS app_order_id,
           substring(CAST(ts AS STRING), 1, 10) AS payment_date,
           substring(CAST(ts AS STRING), 12, 8) AS payment_time,
           substring(CAST(ts AS STRING), 1, 10) || 'T' || substring(CAST(ts AS STRING), 12, 8)
               || 'Z' AS payment_datetime,
           'CAD' AS currency, value AS amount,
           CASE WHEN value > 10 THEN CAST(1.5 AS DOUBLE) END AS platform_fee,
           value - CASE WHEN value > 10 THEN 1.5 ELSE 0 END AS net_amount,
           CASE WHEN user_id % 2 = 0 THEN CAST(0.5 AS DOUBLE) END AS tax, CAST(NULL AS DOUBLE) AS discount,
           CASE event_type WHEN 'purchase' THEN 'APPROVED' WHEN 'view' THEN 'APPROVED'
                WHEN 'click' THEN 'PENDING' WHEN 'signup' THEN 'DECLINED' ELSE 'REFUND' END
               AS status,
           CASE WHEN event_type = 'purchase' AND value > 150 THEN 'Partially refunded'
                WHEN event_type IN ('purchase', 'view') THEN 'Successful'
                WHEN event_type = 'click' THEN 'Pending' WHEN event_type = 'signup' THEN 'Declined'
                ELSE 'Refunded' END AS transaction_status,
           'SALE' AS transaction_type, event_type = 'purchase' AS is_refundable,
           CASE WHEN event_type = 'signup' THEN 'card_declined' END AS failure_code,
           CASE WHEN event_type = 'view' THEN 'Pay in person' ELSE 'Stripe' END
               AS payment_provider_friendly,
           CASE WHEN event_type = 'view' THEN 'Offline' ELSE 'CreditCard' END AS payment_method,
           CASE WHEN event_type <> 'view' THEN 'visa' END AS card_network,
           CASE WHEN event_type <> 'view' THEN '4242' END AS card_last_four,
           CASE WHEN event_type = 'error' OR (event_type = 'purchase' AND value > 150)
                THEN 1 ELSE 0 END AS refund_count,
           CASE WHEN event_type = 'error' OR (event_type = 'purchase' AND value > 150)
                THEN 1 ELSE 0 END AS refund_succeeded_count,
           CASE WHEN event_type = 'error' THEN value
                WHEN event_type = 'purchase' AND value > 150 THEN 20.0 END AS refund_total_amount,
           CASE WHEN event_type = 'error' THEN 'SUCCEEDED' END AS refund_status,
           CAST(NULL AS STRING) AS refund_reason,
           CASE WHEN event_type = 'error' THEN substring(CAST(ts AS STRING), 1, 10) END
               AS refund_date,
           CASE WHEN event_type = 'view' AND value < 5 THEN ''
                ELSE {_pick(_ADJ, _K, 8)} || ' ' || {_pick(_NOUN, 'user_id', 8)} || ', '
                     || {_pick(_ADJ, 'user_id', 8)} || ' ' || {_pick(_NOUN, _K, 8)}
                     || CASE WHEN value > 30 THEN ', Application Fee' ELSE '' END END
               AS product_name,
           2 AS product_count, CAST(1 + event_id % 4 AS BIGINT) AS total_quantity,
           'Bill' AS billing_first_name,
           CASE WHEN value < 50 THEN 'Payer' END AS billing_last_name,
           CASE WHEN value < 50 THEN 'Bill Payer' END AS billing_full_name,
           'pay' || CAST(user_id AS STRING) || '@bill.test' AS billing_email,
           CASE WHEN value > 40 THEN '555-' || CAST(user_id AS STRING) END AS billing_phone,
           'Toronto' AS billing_city, 'CA' AS billing_country,
           'app1' AS app_id, event_id AS _ord
    FROM {{events}}""",
    "t_guest": f"""
    SELECT 'h' || {_TICKET_NO} AS guest_id, CAST(l_suppkey AS STRING) AS event_id,
           CASE WHEN l_linenumber = 5 THEN '0' WHEN l_linenumber = 1 THEN NULL
                ELSE CAST(o_custkey AS STRING) END AS contact_id,
           CASE WHEN l_linenumber >= 6 AND l_linestatus = 'O' THEN 'RSVP'
                WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN 'WAITLIST'
                ELSE 'TICKET_HOLDER' END AS guest_type,
           CASE WHEN l_linenumber < 7 THEN CAST(l_orderkey AS STRING) END AS order_number,
           CASE WHEN l_linenumber <> 5 OR l_returnflag <> 'N' THEN {_TICKET_NO} END
               AS ticket_number,
           CAST(NULL AS STRING) AS primary_ticket_number,
           CASE WHEN l_tax < 0.07 THEN CAST(l_partkey AS STRING) END
               AS primary_ticket_definition_id,
           CAST(NULL AS STRING) AS primary_ticket_name,
           CASE WHEN l_linestatus = 'O' THEN 'ATTENDING' ELSE 'IN_WAITLIST' END
               AS attendance_status,
           CASE l_returnflag WHEN 'N' THEN 'PAID' WHEN 'A' THEN 'FREE' END AS order_status,
           CASE WHEN l_linenumber = 7 THEN 'Guest' END AS first_name,
           CASE WHEN l_linenumber = 7 AND l_tax > 0.03 THEN CAST(l_partkey AS STRING) END
               AS last_name,
           CAST(NULL AS STRING) AS full_name,
           CASE WHEN l_linenumber = 7 AND l_tax > 0.05
                THEN 'g' || CAST(l_partkey AS STRING) || '@y.test' END AS email,
           CAST(NULL AS STRING) AS phone, l_tax > 0.04 AS checked_in,
           CAST(CAST(l_shipdate AS DATE) AS STRING) AS created_date, '10:00:00' AS created_time,
           FALSE AS is_member, CAST(NULL AS STRING) AS member_id,
           (l_orderkey * 8 + l_linenumber) * 10000000 + l_partkey AS _ord
    FROM ({_STUBS}) JOIN {{orders}} ON l_orderkey = o_orderkey
    UNION ALL
    SELECT 'b' || CAST(o_orderkey AS STRING), CAST(NULL AS STRING), CAST(o_custkey AS STRING),
           'BUYER', CAST(o_orderkey AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING),
           CAST(NULL AS STRING), CAST(NULL AS STRING), 'ATTENDING', CAST(NULL AS STRING),
           CASE WHEN c_acctbal > 5000 THEN 'Buyer' END, '',
           CASE WHEN c_acctbal > 7000 THEN 'Buyer ' || c_name END,
           CASE WHEN c_acctbal > 3000 THEN 'b' || CAST(c_custkey AS STRING) || '@x.test' END,
           CASE WHEN c_acctbal > 8000 THEN '555-1000' END, FALSE,
           CAST(CAST(o_orderdate AS DATE) AS STRING), '09:00:00',
           c_mktsegment = 'HOUSEHOLD',
           CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 6000
                THEN 'bm' || CAST(c_custkey AS STRING) END,
           o_orderkey * 8 * 10000000
    FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
    WHERE o_orderstatus <> 'P' OR o_orderpriority <> '4-NOT SPECIFIED'""",
    "t_ticket": f"""
    SELECT CASE WHEN l_returnflag = 'R' THEN {_TICKET_NO} ELSE 'x' || {_TICKET_NO} END
               AS ticket_number,
           CAST(l_suppkey AS STRING) AS event_id, CAST(l_orderkey AS STRING) AS order_number,
           CAST(l_partkey AS STRING) AS ticket_definition_id,
           CASE WHEN l_tax > 0.02 THEN 'Ticket ' || CAST(l_linenumber AS STRING) END
               AS ticket_name,
           CASE WHEN l_returnflag <> 'N' THEN l_extendedprice / 1000 END AS price_value,
           CASE WHEN l_tax > 0.01 THEN 'USD' END AS price_currency,
           CASE WHEN l_tax > 0.06 THEN TRUE WHEN l_tax > 0.04 THEN FALSE END AS free,
           l_tax > 0.05 AS checked_in,
           CASE WHEN l_tax > 0.05 THEN CAST(CAST(l_shipdate AS DATE) AS STRING) END
               AS check_in_date,
           CASE WHEN l_tax > 0.05 THEN '20:00:00' END AS check_in_time,
           (l_orderkey * 8 + l_linenumber) * 10000000 + l_partkey AS _ord
    FROM ({_STUBS}) WHERE l_linestatus = 'F'""",
    "t_summary": """
    SELECT CAST(l_suppkey AS STRING) AS event_id, 'CAD' AS total_sales_currency,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_sales_amount,
           COUNT(DISTINCT l_orderkey) AS total_orders,
           CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_tickets,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE)
               / CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS avg_ticket_price,
           l_suppkey AS _ord
    FROM {lineitem} GROUP BY l_suppkey""",
    # The same people on two platforms: A sells by orders, B by stream events. On B every
    # second nation uses another address, with name parts swapped and a letter dropped.
    "t_platform_a": f"""
    SELECT CASE WHEN o_orderpriority = '5-LOW' THEN ' ' || upper(mail) || ' ' ELSE mail END
               AS buyer_email, first AS buyer_first_name, last AS buyer_last_name,
           'A ' || o_orderpriority || ' ' || o_orderstatus AS event_name,
           CAST(o_orderkey AS STRING) AS order_number,
           CAST(CAST(o_orderdate AS DATE) AS STRING) AS order_date,
           CASE WHEN o_orderstatus = 'P' THEN 'tba'
                ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS event_start_date,
           o_orderkey AS _ord
    FROM {{orders}} JOIN (
        SELECT c_custkey, CASE WHEN c_acctbal > 9900 THEN NULL
                   ELSE 'u' || CAST(c_custkey AS STRING) || '@mail.test' END AS mail,
               {_pick(_FIRST, 'c_custkey', 20)} AS first,
               {_pick(_SYL1, _div('c_custkey', 20), 20)}
               || {_pick(_SYL2, _div('c_custkey', 400), 20)}
               || {_pick(_SYL3, _div('c_custkey', 8000) + ' + c_nationkey', 20)} AS last
        FROM {{customer}}) ON o_custkey = c_custkey""",
    "t_platform_b": f"""
    SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'u' || CAST(c_custkey AS STRING) || '@mail.test'
                ELSE 'v' || CAST(c_custkey AS STRING) || '@post.test' END AS buyer_email,
           CASE WHEN c_nationkey % 4 < 2 THEN first ELSE last END AS buyer_first_name,
           CASE WHEN c_nationkey % 4 = 1 THEN replace(last, 'o', '')
                WHEN c_nationkey % 4 < 2 THEN last ELSE upper(first) END AS buyer_last_name,
           'B ' || event_type AS event_name, CAST(event_id AS STRING) AS order_id,
           substring(CAST(ts AS STRING), 1, 10) AS order_date,
           substring(CAST(ts AS STRING), 1, 10) AS event_start_date, event_id AS _ord
    FROM {{events}} JOIN (
        SELECT c_custkey, c_nationkey, {_pick(_FIRST, 'c_custkey', 20)} AS first,
               {_pick(_SYL1, _div('c_custkey', 20), 20)}
               || {_pick(_SYL2, _div('c_custkey', 400), 20)}
               || {_pick(_SYL3, _div('c_custkey', 8000) + ' + c_nationkey', 20)} AS last
        FROM {{customer}}) ON user_id = c_custkey""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One base table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Entities that group or join line items by order read them dealt out by order once; grouping by
# more columns and the join then need no further shuffle, and one sort serves both.
_DEALT = {"t_guest": {"lineitem": "l_orderkey"}, "t_ticket": {"lineitem": "l_orderkey"}}


def run_entity(spark: SparkSession, name: str, load: Callable[[str], DataFrame]) -> DataFrame:
    """One entity over base tables loaded by name."""
    dealt = _DEALT.get(name, {})
    return run_sql(spark, ENTITY_SQL[name], lambda t: (
        load(t).repartition(dealt[t]) if t in dealt else load(t)))


def run_sql(spark: SparkSession, sql: str, load: Callable[[str], DataFrame]) -> DataFrame:
    """Run a template over the base tables it names, each loaded by name."""
    names = sorted(set(re.findall(r"\{(\w+)\}", sql)))
    return spark.sql(sql, **{n: load(n) for n in names})


def entity(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One entity table."""
    return run_entity(spark, name, lambda t: table(spark, sf_dir, t))


def with_entities(*names: str) -> str:
    """``WITH`` clause that defines entities over plain table names, for other engines."""
    parts = [
        f"{n} AS ({ENTITY_SQL[n].format(**{t: t for t in TABLES})})" for n in names
    ]
    return "WITH " + ",\n".join(parts)
