"""Scalar expressions, quality checks, linkage, sources and sinks."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from catalog.base import query
from turnstile.functions import (
    app_name,
    bucket_amount,
    bucket_price,
    fold_ascii,
    join_name,
    normalize_email,
    normalize_name,
    provider_label,
    safe_bool,
    safe_float,
    safe_int,
    sanitize_key,
    split_iso,
    status_label,
    weekday_columns,
)
from turnstile.functions.similarity import indel_ratio, sorted_tokens
from turnstile.operators import linkage, quality
from turnstile.operators.shaping import conform
from turnstile.schemas import raw_schema
from turnstile.session import scratch_root, stage
from turnstile.sources import bronze, manifest, tables
from turnstile.sources.arrays import read_arrays
from turnstile.sources.summaries import (
    coverage_of,
    null_counts_of,
    read_summaries,
    row_counts_of,
    save_summaries,
    summarise,
)

# Shapes of date text by event type; zones by user.
DATE_TEXT = """
    SELECT event_id, ts, event_type, user_id,
      CASE event_type WHEN 'purchase' THEN replace(CAST(ts AS STRING), ' ', 'T') || 'Z'
        WHEN 'view' THEN substring(CAST(ts AS STRING), 1, 10)
        WHEN 'click' THEN replace(substring(CAST(ts AS STRING), 1, 19), ' ', 'T')
        WHEN 'signup' THEN replace(substring(CAST(ts AS STRING), 1, 19), ' ', 'T') || '+02:00'
        ELSE replace(substring(CAST(ts AS STRING), 1, 19), ' ', 'T') || '.1234567Z' END AS text,
      CASE user_id % 3 WHEN 0 THEN 'America/Toronto' WHEN 1 THEN 'Mars/Base' END AS zone
    FROM {events}"""


@query("x1_split_iso", """
    SELECT event_id,
      CASE event_type WHEN 'purchase' THEN substring(CAST(t AS VARCHAR), 1, 10)
        WHEN 'view' THEN substring(CAST(ts AS VARCHAR), 1, 10)
        WHEN 'click' THEN substring(CAST(ts AS VARCHAR), 1, 10)
        WHEN 'signup' THEN replace(substring(CAST(ts AS VARCHAR), 1, 19), ' ', 'T') || '+02:00'
        ELSE replace(substring(CAST(ts AS VARCHAR), 1, 19), ' ', 'T') || '.1234567Z' END AS d,
      CASE event_type WHEN 'purchase' THEN substring(CAST(t AS VARCHAR), 12, 8)
        WHEN 'click' THEN substring(CAST(ts AS VARCHAR), 12, 8) END AS t
    FROM (SELECT *, CASE WHEN user_id % 3 = 0 THEN ts - INTERVAL 5 HOUR ELSE ts END AS t
          FROM events)""")
def _(lake):
    # All stream events fall in January, when Toronto is five hours behind UTC.
    date, time = split_iso(F.col("text"), F.col("zone"))
    return lake.sql(DATE_TEXT).select("event_id", date.alias("d"), time.alias("t"))


def folded(sql: str) -> str:
    for char, to in (("–", "-"), ("—", "-"), ("‘", "''"), ("’", "''"), ("“", '"'), ("”", '"'),
                     ("…", "..."), (" ", " "), ("é", "e"), ("è", "e"), ("à", "a")):
        sql = f"replace({sql}, '{char}', '{to}')"
    return sql


@query("x2_fold_ascii", f"SELECT doc_id, {folded('text')} AS text FROM documents")
def _(lake):
    return lake.documents.select("doc_id", fold_ascii(F.col("text")).alias("text"))


CAST_TEXT = """
    SELECT event_id, CASE event_type WHEN 'purchase' THEN CAST(value AS STRING)
        WHEN 'view' THEN '' WHEN 'click' THEN 'nan' WHEN 'signup' THEN 'yes' ELSE ' 12 ' END
        AS text FROM {events}"""


@query("x3_safe_casts", """
    SELECT event_id, CASE event_type WHEN 'purchase' THEN value WHEN 'error' THEN 12.0 END AS f,
      CASE event_type WHEN 'purchase' THEN CAST(trunc(value) AS BIGINT) WHEN 'error' THEN 12 END
        AS i,
      CASE event_type WHEN 'purchase' THEN TRUE WHEN 'signup' THEN TRUE WHEN 'error' THEN TRUE END
        AS b FROM events""")
def _(lake):
    text = F.col("text")
    return lake.sql(CAST_TEXT).select(
        "event_id", safe_float(text).alias("f"), safe_int(text).alias("i"),
        safe_bool(text).alias("b"))


@query("x4_bucket_price", """
    SELECT event_id, CASE WHEN event_type = 'view' THEN 'Free'
      WHEN event_type = 'click' THEN 'Unknown' WHEN value < 25 THEN '0-25'
      WHEN value < 50 THEN '25-50' WHEN value < 100 THEN '50-100' ELSE '100+' END AS band
    FROM events""")
def _(lake):
    kind = F.col("event_type")
    value = F.when(kind != "click", F.col("value"))
    return lake.events.select(
        "event_id", bucket_price(value, kind == "view").alias("band"))


@query("x5_bucket_amount", """
    SELECT event_id, CASE WHEN value = 0 THEN 'Free' WHEN value < 25 THEN '0-25'
      WHEN value < 50 THEN '25-50' WHEN value < 100 THEN '50-100' WHEN value < 250 THEN '100-250'
      ELSE '250+' END AS band FROM events""")
def _(lake):
    return lake.events.select("event_id", bucket_amount(F.col("value")).alias("band"))


@query("x6_join_name", """
    SELECT contact_id, nullif(concat_ws(' ', nullif(first_name, ''),
      CASE WHEN is_member THEN last_name END), '') AS name FROM t_contact""", "t_contact")
def _(lake):
    last = F.when(F.col("is_member"), F.col("last_name"))
    return lake.t_contact.select("contact_id", join_name(F.col("first_name"), last).alias("name"))


@query("x7_normalize_identity", r"""
    SELECT doc_id, trim(lower(source)) AS email,
      regexp_replace(trim(lower(lang || ' ' || source)), '\s+', ' ', 'g') AS name
    FROM documents""")
def _(lake):
    return lake.documents.select(
        "doc_id", normalize_email(F.col("source")).alias("email"),
        normalize_name(F.concat("lang", F.lit("  "), "source")).alias("name"))


@query("x8_labels", """
    SELECT event_id, CASE event_type WHEN 'purchase' THEN CASE WHEN value > 100
        THEN 'Partially refunded' WHEN value > 50 THEN 'Refunded' ELSE 'Successful' END
        WHEN 'view' THEN 'Funds held' WHEN 'click' THEN 'New_State' WHEN 'signup' THEN NULL
        ELSE 'Chargeback' END AS status,
      CASE event_type WHEN 'purchase' THEN 'Stripe' WHEN 'view' THEN 'Pay in person'
        WHEN 'click' THEN 'Local Bank' WHEN 'signup' THEN 'PayPal' ELSE 'zzz' END AS provider,
      CASE WHEN user_id % 2 = 0 THEN 'Bookings' END AS app FROM events""")
def _(lake):
    kind = F.col("event_type")
    status = F.when(kind == "purchase", "APPROVED").when(
        kind == "view", "COMPLETED_FUNDS_HELD").when(kind == "click", "NEW_STATE").when(
        kind == "signup", "").otherwise("CHARGE_BACK")
    refunded = F.when(F.col("value") > 100, F.lit(10.0)).when(
        F.col("value") > 50, F.col("value"))
    provider = F.when(kind == "purchase", "com.stripe").when(kind == "click", "bank").when(
        kind == "signup", "payPal").when(kind == "error", "zzz")
    app = F.when(F.col("user_id") % 2 == 0, "13d21c63-b5ec-5912-8397-c3a5ddb27a97").otherwise("?")
    return lake.events.select(
        "event_id", status_label(status, F.col("value"), refunded).alias("status"),
        provider_label(provider, F.when(kind == "click", "Local Bank")).alias("provider"),
        app_name(app).alias("app"))


@query("x9_weekday", """
    SELECT o_orderkey, dayname(o_orderdate) AS day, CAST(dayofweek(o_orderdate) AS INT) AS num,
      dayofweek(o_orderdate) IN (0, 6) AS weekend FROM orders""")
def _(lake):
    name, number, weekend = weekday_columns(F.col("o_orderdate").cast("date").cast("string"))
    return lake.orders.select(
        "o_orderkey", name.alias("day"), number.alias("num"), weekend.alias("weekend"))


@query("x11_sanitize_key", """
    SELECT page_id, lower(regexp_replace(url, '[ .]', '_', 'g')) AS k FROM pages""")
def _(lake):
    return lake.pages.select("page_id", sanitize_key(F.col("url")).alias("k"))


# Platforms A and B with normalised identity, and attendees by e-mail.
PEOPLE = r"""
    , pa AS (SELECT *, trim(lower(buyer_email)) AS email, trim(regexp_replace(trim(lower(
        buyer_first_name)), '\s+', ' ', 'g') || ' ' || lower(buyer_last_name)) AS full_name
        FROM t_platform_a)
    , pb AS (SELECT *, trim(lower(buyer_email)) AS email, trim(lower(buyer_first_name) || ' ' ||
        lower(buyer_last_name)) AS full_name FROM t_platform_b)
    , aa AS (SELECT email, arg_min(full_name, _ord) AS full_name,
        arg_min(buyer_first_name, _ord) AS first_name, arg_min(buyer_last_name, _ord) AS last_name,
        count(DISTINCT event_name) AS events_attended, count(DISTINCT order_number) AS orders
        FROM pa WHERE email IS NOT NULL GROUP BY email)
    , ab AS (SELECT email, arg_min(full_name, _ord) AS full_name,
        arg_min(buyer_first_name, _ord) AS first_name, arg_min(buyer_last_name, _ord) AS last_name,
        count(DISTINCT event_name) AS events_attended, count(DISTINCT order_id) AS orders
        FROM pb WHERE email IS NOT NULL GROUP BY email)
    , mx AS (SELECT aa.email, aa.full_name, aa.first_name, aa.last_name,
        aa.events_attended AS events_a, aa.orders AS orders_a, ab.events_attended AS events_b,
        ab.orders AS orders_b FROM aa JOIN ab USING (email))"""
BOTH = "t_platform_a t_platform_b"


def people(lake):
    return (linkage.normalize_people(lake.t_platform_a),
            linkage.normalize_people(lake.t_platform_b))


def attendees(lake):
    a, b = people(lake)
    return (linkage.attendees_by_email(a, "order_number"),
            linkage.attendees_by_email(b, "order_id"))


def linked(name: str, sql: str | None):
    return query(name, PEOPLE + sql if sql else None, BOTH)


@linked("a10_attendees_by_email", "SELECT * FROM aa")
def _(lake):
    return attendees(lake)[0]


@linked("a31_platform_profile", """
    SELECT CAST(min(try_cast(order_date AS DATE)) AS VARCHAR) AS first_order,
      CAST(max(try_cast(order_date AS DATE)) AS VARCHAR) AS last_order,
      CAST(min(try_cast(event_start_date AS DATE)) AS VARCHAR) AS first_event,
      CAST(max(try_cast(event_start_date AS DATE)) AS VARCHAR) AS last_event,
      count(DISTINCT event_name) AS events, count(order_number) AS orders FROM pa""")
def _(lake):
    return linkage.platform_profile(people(lake)[0], "order_number")


@linked("a31_event_rows", "SELECT event_name, count(*) AS n FROM pb GROUP BY 1")
def _(lake):
    return linkage.event_rows(people(lake)[1])


@linked("j10_crossover_exact", "SELECT * FROM mx")
def _(lake):
    return linkage.crossover_exact(*attendees(lake))


@linked("j10_unmatched", "SELECT email, full_name FROM aa WHERE email NOT IN (SELECT email FROM ab)")
def _(lake):
    return linkage.unmatched(*attendees(lake)).select("email", "full_name")


SUMMARY = """
    , sm AS (SELECT (SELECT count(*) FROM aa) AS total_a, (SELECT count(*) FROM ab) AS total_b,
        (SELECT count(*) FROM mx) AS n_both)"""


@linked("a11_crossover_summary", SUMMARY + """
    SELECT total_a, total_b, n_both AS both, total_a - n_both AS only_a, total_b - n_both AS only_b,
      n_both * 100.0::DOUBLE / total_a AS pct_a_from_b,
      n_both * 100.0::DOUBLE / total_b AS pct_b_in_a FROM sm""")
def _(lake):
    return linkage.crossover_summary(*attendees(lake))


# Similarity of the texts in ``pr`` by dynamic programming, one recursion step per character; the
# Levenshtein distance never exceeds the edit count, so it only removes hopeless pairs.
DP = """dp AS (SELECT a, b, 0 AS i, [0 FOR j IN range(0, length(b) + 1)] AS r FROM pr
        UNION ALL SELECT a, b, i + 1, [list_max([CASE WHEN q = 0 THEN 0
            WHEN a[i + 1] = b[q] THEN greatest(r[q] + 1, r[q + 1]) ELSE r[q + 1] END
            FOR q IN range(0, j + 1)]) FOR j IN range(0, length(b) + 1)]
        FROM dp WHERE i < length(a))
    , sc AS (SELECT a, b, 100.0::DOUBLE * 2 * r[length(b) + 1] / (length(a) + length(b)) AS score
        FROM dp WHERE i = length(a))"""
FUZZY = """
    , ua AS (SELECT email, full_name, array_to_string(list_sort(string_split_regex(full_name,
        '[ ]+')), ' ') AS tok FROM aa WHERE email NOT IN (SELECT email FROM ab) AND full_name <> '')
    , ub AS (SELECT email, full_name, array_to_string(list_sort(string_split_regex(full_name,
        '[ ]+')), ' ') AS tok FROM ab WHERE email NOT IN (SELECT email FROM aa) AND full_name <> '')
    , pr AS (SELECT DISTINCT ua.tok AS a, ub.tok AS b FROM ua JOIN ub
        ON 2.0 * least(length(ua.tok), length(ub.tok)) >= 0.85 * (length(ua.tok) + length(ub.tok))
        AND levenshtein(ua.tok, ub.tok) <= 0.15 * (length(ua.tok) + length(ub.tok)) + 1e-9)
    , """ + DP + """
    , fz AS (SELECT ua.full_name AS source_name, ua.email AS source_email,
        ub.full_name AS target_name, ub.email AS target_email, score AS match_score,
        CASE WHEN score = 100 THEN 'exact' ELSE 'fuzzy' END AS match_type
      FROM ua JOIN sc ON ua.tok = sc.a JOIN ub ON ub.tok = sc.b WHERE score >= 85
      QUALIFY row_number() OVER (PARTITION BY ua.email ORDER BY score DESC, ub.email) = 1)"""


def fuzzy(lake):
    a, b = (stage(x, "attendees") for x in attendees(lake))
    return linkage.crossover_fuzzy(linkage.unmatched(a, b), linkage.unmatched(b, a))


@linked("j11_crossover_fuzzy", FUZZY + "SELECT * FROM fz")
def _(lake):
    return fuzzy(lake)


@linked("p5_confident_matches", FUZZY + "SELECT source_email, match_score FROM fz WHERE match_score >= 90")
def _(lake):
    return fuzzy(lake).where("match_score >= 90").select("source_email", "match_score")


@linked("a11_combined_summary", FUZZY + SUMMARY + """
    SELECT total_a, total_b, n_both AS both, total_a - n_both AS only_a, total_b - n_both AS only_b,
      n_both * 100.0::DOUBLE / total_a AS pct_a_from_b,
      n_both * 100.0::DOUBLE / total_b AS pct_b_in_a, nm AS name_matches,
      n_both + nm AS total_crossover, (n_both + nm) * 100.0::DOUBLE / total_a AS match_rate
    FROM sm, (SELECT count(*) AS nm FROM fz WHERE match_score >= 90)""")
def _(lake):
    a, b = (stage(x, "attendees") for x in attendees(lake))
    names = linkage.crossover_fuzzy(linkage.unmatched(a, b), linkage.unmatched(b, a))
    return linkage.combined_summary(linkage.crossover_summary(a, b), names)


def _tokens(text: str) -> str:
    return f"array_to_string(list_sort(string_split({text}, ' ')), ' ')"


@query("x17_token_sort_ratio", f"""
    WITH RECURSIVE pp AS (SELECT p_partkey, {_tokens('p_name')} AS a,
        {_tokens("p_type || ' ' || p_name")} AS b FROM part),
    pr AS (SELECT DISTINCT a, b FROM pp), {DP}
    SELECT p_partkey, score FROM pp JOIN sc USING (a, b)""")
def _(lake):
    pairs = lake.part.select("p_partkey", sorted_tokens(F.col("p_name")).alias("a"),
                             sorted_tokens(F.concat_ws(" ", "p_type", "p_name")).alias("b"))
    return pairs.select("p_partkey", indel_ratio(F.col("a"), F.col("b")).alias("score"))


PAIRS = """
    , ep AS (SELECT DISTINCT b.event_name AS event_b, a.event_name AS event_a, a.email
        FROM pb b JOIN pa a ON a.email = b.email)"""


@linked("j12_event_pairs", PAIRS + "SELECT * FROM ep")
def _(lake):
    return linkage.event_pairs(*people(lake))


@linked("a12_event_pair_counts", PAIRS + "SELECT event_b, event_a, count(*) AS n FROM ep GROUP BY 1, 2")
def _(lake):
    return linkage.event_pair_counts(*people(lake))


_PAIR_COLUMNS = [f"A {p} {s}" for p in (
    "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW") for s in "FOP"]


@linked("a13_event_pair_matrix", PAIRS + "SELECT event_b, " + ", ".join(
    f"count(*) FILTER (event_a = '{c}') AS \"{c}\"" for c in _PAIR_COLUMNS)
    + " FROM ep GROUP BY 1")
def _(lake):
    return linkage.event_pair_matrix(
        linkage.event_pair_counts(*people(lake)))


@linked("a14_crossover_engagement", """
    SELECT email, full_name, events_a, events_b, events_a + events_b AS total_events FROM mx
    ORDER BY total_events DESC, email LIMIT 15""")
def _(lake):
    return linkage.crossover_engagement(linkage.crossover_exact(*attendees(lake)))


@linked("a14_engagement_averages", """
    SELECT sum(events_a) / count(*) AS avg_events_a, sum(events_b) / count(*) AS avg_events_b
    FROM mx""")
def _(lake):
    return linkage.engagement_averages(linkage.crossover_exact(*attendees(lake)))


@linked("a15_event_value_counts", """
    SELECT event_name, count(*) AS n FROM pb WHERE email IN (SELECT email FROM aa) GROUP BY 1""")
def _(lake):
    a, b = attendees(lake)
    return linkage.event_value_counts(people(lake)[1], linkage.crossover_exact(a, b))


@linked("u2_common_emails", "SELECT email FROM aa INTERSECT SELECT email FROM ab")
def _(lake):
    a, b = attendees(lake)
    return linkage.common_values(a, b)


@linked("u3_emails_only_a", "SELECT email FROM aa EXCEPT SELECT email FROM ab")
def _(lake):
    a, b = attendees(lake)
    return linkage.values_only_in(a, b)


@linked("u3_emails_only_b", "SELECT email FROM ab EXCEPT SELECT email FROM aa")
def _(lake):
    a, b = attendees(lake)
    return linkage.values_only_in(b, a)


@query("dq1_null_counts", """
    SELECT field, null_count, null_count = 0 AS passed FROM (
      SELECT unnest(['contact_id', 'event_id', 'order_number']) AS field,
        unnest([count(*) FILTER (contact_id IS NULL), count(*) FILTER (event_id IS NULL),
          count(*) FILTER (order_number IS NULL)]) AS null_count FROM t_guest)""", "t_guest")
def _(lake):
    return quality.null_counts(lake.once("t_guest"), ["contact_id", "event_id", "order_number"])


@query("dq2_row_count_changes", """
    WITH m AS (SELECT event_type AS entity, substring(CAST(ts AS VARCHAR), 1, 10) AS snapshot_id,
        count(*) AS row_count FROM events GROUP BY 1, 2),
    p AS (SELECT *, lag(row_count) OVER (PARTITION BY entity ORDER BY snapshot_id) AS previous
        FROM m)
    SELECT *, (row_count - previous) / previous AS change,
      abs((row_count - previous) / previous) < 0.1 AS passed FROM p WHERE previous IS NOT NULL""")
def _(lake):
    counts = lake.events.groupBy(
        F.col("event_type").alias("entity"),
        F.substring(F.col("ts").cast("string"), 1, 10).alias("snapshot_id"),
    ).agg(F.count("*").alias("row_count"))
    return quality.row_count_changes(counts)


@query("dq3_schema_check", """
    SELECT 'c_acctbal' AS col, 'decimal(18,2)' AS expected, 'double' AS actual, count(*) AS n_rows
    FROM customer UNION ALL
    SELECT 'c_phone', 'string', '', count(*) FROM customer""")
def _(lake):
    from pyspark.sql import types as T

    expected = T.StructType([
        T.StructField("c_phone", T.StringType()) if f.name == "c_name" else
        T.StructField(f.name, T.DecimalType(18, 2)) if f.name == "c_acctbal" else f
        for f in lake.customer.schema.fields if f.name != "c_name"
    ] + [T.StructField("c_phone", T.StringType())])
    found = quality.schema_differences(lake.customer.drop("c_name"), expected)
    rows = F.array(*[
        F.struct(F.lit(a).alias("col"), F.lit(b).alias("expected"), F.lit(c).alias("actual"))
        for a, b, c in found
    ])
    return lake.customer.agg(F.count("*").alias("n_rows")).select(
        F.explode(rows).alias("d"), "n_rows").select("d.*", "n_rows")


@query("dq4_orphan_counts", """
    SELECT contact_id, count(*) AS rows FROM t_guest
    WHERE contact_id NOT IN (SELECT contact_id FROM t_member) GROUP BY 1""", "t_guest t_member")
def _(lake):
    return quality.orphan_counts(lake.once("t_guest"), lake.t_member, "contact_id")


@query("dq5_future_dates", """
    SELECT count(*) FILTER (created_date > '2001-06-01') AS future_rows,
      max(created_date) FILTER (created_date > '2001-06-01') AS latest,
      count(*) FILTER (created_date > '2001-06-01') = 0 AS passed FROM t_guest""", "t_guest")
def _(lake):
    return quality.future_dates(lake.once("t_guest"), "created_date", "2001-06-01")


@query("dq6_pseudonymize", """
    SELECT sha256('salt' || contact_id) AS contact_id, is_member, member_id, _ord
    FROM t_contact""", "t_contact")
def _(lake):
    return quality.pseudonymize(
        lake.t_contact, ["contact_id"],
        ["first_name", "last_name", "full_name", "primary_email", "email"], "salt")


@query("dq7_special_characters", """
    SELECT 'text' AS "column",
      count(*) FILTER (regexp_matches(text, '[–—‘’“”… éèà]')) AS foldable_rows,
      count(*) FILTER (regexp_matches(text, '[^\\x00-\\x7F–—‘’“”… éèà]')) AS other_rows
    FROM documents UNION ALL SELECT 'source',
      count(*) FILTER (regexp_matches(source, '[–—‘’“”… éèà]')),
      count(*) FILTER (regexp_matches(source, '[^\\x00-\\x7F]')) FROM documents""")
def _(lake):
    return quality.special_characters(lake.documents, ["text", "source"])


@query("a28_field_coverage", """
    SELECT path, filled, filled / n AS fill_rate FROM (SELECT count(*) AS n,
      unnest(['id', 'info.first', 'info.place.nation', 'info.place.score']) AS path,
      unnest([count(c_custkey), count(*) FILTER (c_acctbal > 0), count(*),
        count(*) FILTER (c_mktsegment = 'BUILDING')]) AS filled FROM customer)""")
def _(lake):
    return quality.field_coverage(lake.sql("""
        SELECT c_custkey AS id, named_struct('first', CASE WHEN c_acctbal > 0 THEN c_name END,
          'place', named_struct('nation', c_nationkey, 'score',
            CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END)) AS info FROM {customer}"""))


def fresh(lake, label: str) -> str:
    return f"{scratch_root(lake.spark)}/{label}-{uuid.uuid4().hex}"


def kept_summaries(lake, *tables) -> DataFrame:
    """Stored summaries of (table, entity, snapshot) each; the tables are not read again."""
    root = fresh(lake, "summaries")
    for df, entity, snapshot in tables:
        save_summaries(summarise(df, entity, snapshot), root)
    return read_summaries(lake.spark, root)


@query("a28_coverage_of_snapshots", """
    SELECT path, filled, filled / n AS fill_rate FROM (SELECT count(*) AS n,
      unnest(['id', 'buyer.key', 'buyer.clerk', 'total']) AS path,
      unnest([count(o_orderkey), count(*) FILTER (o_custkey % 3 > 0),
        count(*) FILTER (o_custkey % 3 > 0 AND o_orderstatus = 'F'),
        count(*) FILTER (o_totalprice > 100000)]) AS filled FROM orders)""")
def _(lake):
    # One snapshot per order month, summarised once; coverage over all months only merges.
    orders = lake.sql("""
        SELECT o_orderkey AS id, CASE WHEN o_custkey % 3 > 0 THEN named_struct('key', o_custkey,
          'clerk', CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) END AS buyer,
          CASE WHEN o_totalprice > 100000 THEN CAST(o_totalprice AS DOUBLE) END AS total,
          date_format(o_orderdate, 'yyyyMM') AS month FROM {orders}""")
    return coverage_of(kept_summaries(lake, (orders, "orders", F.col("month"))).where(
        "path <> 'month'"))


@query("dq1_null_counts_of_snapshots", """
    SELECT field, null_count, null_count = 0 AS passed FROM (
      SELECT unnest(['contact_id', 'event_id', 'order_number']) AS field,
        unnest([count(*) FILTER (contact_id IS NULL), count(*) FILTER (event_id IS NULL),
          count(*) FILTER (order_number IS NULL)]) AS null_count FROM t_guest)""", "t_guest")
def _(lake):
    guests = lake.t_guest.select("contact_id", "event_id", "order_number", "guest_type")
    kept = kept_summaries(lake, (guests, "guests", F.col("guest_type")))
    return null_counts_of(kept, ["contact_id", "event_id", "order_number"])


@query("dq2_changes_of_snapshots", """
    WITH m AS (SELECT event_type AS entity, substring(CAST(ts AS VARCHAR), 1, 10) AS snapshot_id,
        count(*) AS row_count FROM events GROUP BY 1, 2),
    p AS (SELECT *, lag(row_count) OVER (PARTITION BY entity ORDER BY snapshot_id) AS previous
        FROM m)
    SELECT *, (row_count - previous) / previous AS change,
      abs((row_count - previous) / previous) < 0.1 AS passed FROM p WHERE previous IS NOT NULL""")
def _(lake):
    day = F.substring(F.col("ts").cast("string"), 1, 10)
    kept = kept_summaries(lake, (lake.events.select("event_type", "ts"), F.col("event_type"), day))
    return quality.row_count_changes(row_counts_of(kept))


@query("s1_s2_bronze_roundtrip", """
    SELECT CAST(c_custkey AS VARCHAR) AS member_id, lower(c_name) AS login_email,
      CAST(NULL AS VARCHAR) AS corrupt, '20260211_143022' AS run_id FROM customer""")
def _(lake):
    raw = lake.sql("""SELECT CAST(c_custkey AS STRING) AS id, lower(c_name) AS loginEmail,
        c_custkey AS _ord FROM {customer}""")
    root = fresh(lake, "raw")
    bronze.bronze_write(raw, root, "members", "20260211_143022")
    back = bronze.bronze_read(lake.spark, root, "members", "20260211_143022")
    return back.select(F.col("id").alias("member_id"), F.col("loginEmail").alias("login_email"),
                       F.col("_corrupt_record").alias("corrupt"), "run_id")


@query("s1_array_files", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || ' } "{[' AS nickname,
      CAST(c_custkey // 500 AS VARCHAR) AS chunk FROM customer""")
def _(lake):
    # One array file per 500 customers, with the marks of JSON inside texts.
    root = fresh(lake, "arrays")
    record = F.to_json(F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.struct(F.concat("c_name", F.lit(' } "{[')).alias("nickname")).alias("profile"),
        F.floor(F.col("c_custkey") / 500).cast("string").alias("chunk")))
    files = lake.customer.groupBy(F.floor(F.col("c_custkey") / 500).alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(record), ", "), F.lit("]")).alias("value"))
    files.repartition("file").write.partitionBy("file").text(root)
    rows = read_arrays(lake.spark, root, T.StructType.fromDDL(
        "id string, profile struct<nickname: string>, chunk string"))
    return rows.select("id", "profile.nickname", "chunk")


@query("s3_s6_s13_snapshots", """
    SELECT DISTINCT 'orders' AS entity, strftime(o_orderdate, '%Y%m') || '01_000000' AS snapshot_id,
      date_diff('day', CAST(date_trunc('month', o_orderdate) AS DATE), DATE '1999-01-01')::INT
        AS age_days
    FROM orders WHERE date_diff('day', CAST(date_trunc('month', o_orderdate) AS DATE),
      DATE '1999-01-01') > 730""")
def _(lake):
    # One raw snapshot per order month, written in one job.
    root = fresh(lake, "raw")
    month = F.date_format("o_orderdate", "yyyyMM")
    rows = lake.orders.select(
        "o_orderkey", F.substring(month, 1, 4).alias("year"), F.substring(month, 5, 2).alias("month"),
        F.lit("01").alias("day"), F.concat(month, F.lit("01_000000")).alias("snapshot"))
    rows.repartition("snapshot").write.partitionBy("year", "month", "day", "snapshot").json(
        f"{root}/orders")
    found = bronze.snapshot_list(lake.spark, root)
    return bronze.expired_snapshots(found, "1999-01-01").select(
        "entity", "snapshot_id", "age_days")


@query("s3_resolve_snapshots", """
    SELECT max(strftime(o_orderdate, '%Y%m') || '01_000000') AS snapshot_id FROM orders""")
def _(lake):
    root = fresh(lake, "raw")
    month = F.date_format("o_orderdate", "yyyyMM")
    lake.orders.select(
        "o_orderkey", F.substring(month, 1, 4).alias("year"), F.substring(month, 5, 2).alias("month"),
        F.lit("01").alias("day"), F.concat(month, F.lit("01_000000")).alias("snapshot")
    ).repartition("snapshot").write.partitionBy("year", "month", "day", "snapshot").json(
        f"{root}/orders")
    latest = bronze.resolve_snapshots(bronze.snapshot_list(lake.spark, root), "latest")
    return lake.spark.createDataFrame([(i,) for i in latest], "snapshot_id string")


@query("s6_latest_file", "SELECT c_custkey, c_name FROM customer")
def _(lake):
    # Two exports, a folder each; the one written last is found by its newest part.
    root = fresh(lake, "exports")
    lake.supplier.select("s_suppkey", "s_name").write.parquet(f"{root}/first")
    lake.customer.select("c_custkey", "c_name").write.parquet(f"{root}/second")
    newest = bronze.latest_file(lake.spark, root, "part-")
    return lake.spark.read.parquet(newest.rpartition("/")[0])  # with its other parts


@query("s4_s5_csv_roundtrip", """
    SELECT doc_id, lang, text FROM documents""")
def _(lake):
    path = fresh(lake, "csv")
    rows = lake.documents.select("doc_id", "lang", "text")
    tables.csv_export(rows, path)
    return tables.csv_read(lake.spark, path, rows.schema)


@query("s7_run_manifest", """
    SELECT 'region' AS entity, 'success' AS status, count(*) AS row_count FROM region
    UNION ALL SELECT 'orders', 'success', count(*) FROM orders
    UNION ALL SELECT 'rsvps', 'skipped', 0""")
def _(lake):
    run = manifest.RunManifest(lake.spark, "20260211_143022")
    root = fresh(lake, "tables")
    for name in ("region", "orders"):
        with run.stage(name) as stage_:
            path = tables.table_write(stage_.counted(lake.table(name)), root, name, run.snapshot)
            stage_.record(table_path=path)
    with run.stage("rsvps"):
        pass
    run.save(f"{root}/manifest")
    return manifest.read_manifests(lake.spark, f"{root}/manifest").select(
        "entity", "status", "row_count")


EVENT_RAW = """SELECT CAST(n_nationkey AS STRING) AS id, n_name AS title,
    named_struct('type', CASE WHEN n_regionkey = 1 THEN 'RSVP' ELSE 'TICKETING' END)
      AS registration, n_nationkey AS _ord FROM {nation}"""
GUEST_RAW = """SELECT CAST(c_custkey AS STRING) AS id, CAST(c_nationkey AS STRING) AS eventId,
    'TICKET_HOLDER' AS guestType, 'o' || c_custkey AS orderNumber, c_custkey AS _ord
    FROM {customer}"""


def write_snapshots(lake, root: str, *snapshots: str) -> None:
    """Raw events and guests made of the nations and customers."""
    for entity, sql in (("events", EVENT_RAW), ("guests", GUEST_RAW)):
        schema = T.StructType([*raw_schema(entity).fields, T.StructField("_ord", T.LongType())])
        raw = conform(lake.sql(sql), schema)
        for snapshot in snapshots:
            bronze.bronze_write(raw, root, entity, snapshot)


@query("s12_backfill", """
    SELECT 'guests' AS entity, CAST(c_custkey AS VARCHAR) AS id, '20260112_000000' AS run_id
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 1
    UNION ALL SELECT CASE WHEN n_regionkey = 1 THEN 'rsvp_events' ELSE 'events' END,
      CAST(n_nationkey AS VARCHAR), '20260112_000000' FROM nation
    UNION ALL SELECT 'attendance_fact', CAST(c_custkey AS VARCHAR), '20260112_000000'
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 1""")
def _(lake):
    from turnstile.plans.runs import backfill

    root, out = fresh(lake, "raw"), fresh(lake, "tables")
    write_snapshots(lake, root, "20260105_000000", "20260112_000000")
    backfill(lake.spark, root, out, "2026-01-10", "2026-02-01", ["events", "guests"])
    tables_ = [lake.spark.read.parquet(f"{out}/{name}").select(
        F.lit(name).alias("entity"), F.col(key).alias("id"), "run_id")
        for name, key in (("guests", "guest_id"), ("events", "event_id"),
                          ("rsvp_events", "event_id"), ("attendance_fact", "guest_id"))]
    return reduce(DataFrame.unionByName, tables_)


@query("r2_full_run", """
    SELECT guest_id, event_id, title AS event_title FROM (
      SELECT CAST(c_custkey AS VARCHAR) AS guest_id, CAST(c_nationkey AS VARCHAR) AS event_id,
        n_name AS title FROM customer JOIN nation ON c_nationkey = n_nationkey
      WHERE n_regionkey <> 1)""")
def _(lake):
    # The latest of two snapshots; all entities but events and guests are empty.
    from turnstile.plans.runs import run_snapshots

    root, out = fresh(lake, "raw"), fresh(lake, "tables")
    write_snapshots(lake, root, "20260105_000000", "20260112_000000")
    run_snapshots(lake.spark, root, out, "latest")
    return tables.table_read(lake.spark, out, "attendance_fact", "20260112_000000").select(
        "guest_id", "event_id", "event_title")


@query("r1_stream_upsert", """
    SELECT CAST(user_id AS VARCHAR) AS member_id, arg_max(event_type, event_id) AS status
    FROM events GROUP BY user_id""")
def _(lake):
    from turnstile.operators.flatten_people import flatten_members
    from turnstile.schemas import raw_schema
    from turnstile.streaming.upsert import stream_upsert

    raw = lake.sql("""SELECT CAST(user_id AS STRING) AS id, event_type AS status,
        replace(substring(CAST(ts AS STRING), 1, 19), ' ', 'T') || 'Z' AS updatedDate,
        event_id AS _ord FROM {events}""")
    source, target, state = (fresh(lake, n) for n in ("raw", "target", "state"))
    raw.repartition(2).write.json(source)

    def flat(rows):
        members = flatten_members(rows)
        return members.withColumn("updated_datetime", F.concat_ws(
            " ", "updated_date", "updated_time"))

    stream_upsert(lake.spark, source, raw_schema("members"), flat, target, state, "member_id",
                  buckets=8).awaitTermination()
    return lake.spark.read.parquet(target).select("member_id", "status")
