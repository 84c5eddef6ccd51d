"""Facts restated as plain SQL with windows, independent of the operators."""

# Latest payment per order, order counts and first buyer.
ORDER_CTES = """
, latest AS (
    SELECT app_order_id AS order_number, status, total_quantity, product_name, _ord
    FROM (SELECT *, row_number() OVER (PARTITION BY app_order_id ORDER BY payment_datetime DESC,
              (status = 'APPROVED') DESC, _ord) AS rn
          FROM t_payment WHERE app_order_id IS NOT NULL)
    WHERE rn = 1)
, buyer AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_number ORDER BY _ord) AS rn
                   FROM t_guest WHERE guest_type = 'BUYER' AND order_number IS NOT NULL)
    WHERE rn = 1)
, grain AS (
    SELECT order_number, count(*) FILTER (guest_type = 'BUYER') AS buyers,
           count(*) FILTER (guest_type = 'TICKET_HOLDER') AS holders,
           count(*) FILTER (guest_type = 'RSVP') AS rsvps, min(_ord) AS first_seen
    FROM t_guest WHERE order_number IS NOT NULL GROUP BY order_number)
, ctx AS (
    SELECT g.*, l.status AS pay_status, l.product_name,
           CASE WHEN l.total_quantity IS NULL THEN 0
                WHEN l.product_name LIKE '%Application Fee%'
                    THEN greatest(l.total_quantity - 1, 0)
                ELSE l.total_quantity END AS paid_n,
           coalesce(l.status IN ('REFUND', 'PARTIAL_REFUND', 'BUYER_CANCELED', 'DECLINED',
                'FAILED', 'CHARGE_BACK', 'VOID', 'EXPIRED'), FALSE) AS inactive
    FROM grain g LEFT JOIN latest l USING (order_number))
"""


def stub_ctes(include_inactive: bool = False) -> str:
    keep = "TRUE" if include_inactive else "NOT c.inactive"
    return ORDER_CTES + f"""
, stub AS (
    SELECT g.*, b.contact_id AS buyer_contact_id, b.first_name AS b_first, b.last_name AS b_last,
           b.full_name AS b_full, b.email AS b_email, b.phone AS b_phone,
           b.is_member AS b_member, b.member_id AS b_member_id,
           nullif(c.holders, 0) AS tickets_in_order, c.pay_status AS order_payment_status,
           c.paid_n AS paid_tickets_per_order, c.product_name, c.first_seen,
           CASE WHEN g.guest_type = 'TICKET_HOLDER' THEN row_number() OVER (
               PARTITION BY g.order_number, g.guest_type
               ORDER BY g.ticket_number IS NULL, g.ticket_number, g._ord) <= c.paid_n END
               AS is_paid_ticket_stub
    FROM t_guest g JOIN ctx c ON g.order_number = c.order_number
         LEFT JOIN buyer b ON b.order_number = c.order_number
    WHERE g.guest_type IN ('TICKET_HOLDER', 'RSVP') AND {keep}
    UNION ALL
    SELECT g.*, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 0, NULL, NULL, NULL
    FROM t_guest g WHERE g.order_number IS NULL AND g.guest_type <> 'BUYER')
, grp AS (
    SELECT *,
        count(*) FILTER (guest_type = 'TICKET_HOLDER' AND is_paid_ticket_stub) OVER w AS n_paid,
        count(*) FILTER (guest_type = 'TICKET_HOLDER'
                         AND NOT coalesce(is_paid_ticket_stub, FALSE)) OVER w AS n_free,
        count(*) FILTER (guest_type = 'RSVP') OVER w AS n_rsvp,
        row_number() OVER (PARTITION BY event_id, buyer_contact_id, guest_type
            ORDER BY coalesce(is_paid_ticket_stub, FALSE) DESC, ticket_number IS NULL,
                     ticket_number, first_seen NULLS LAST, _ord) AS seat
    FROM stub WINDOW w AS (PARTITION BY event_id, buyer_contact_id))
, seated AS (
    SELECT *, CASE WHEN n_paid > 0 AND n_free > 0 THEN n_paid
                   ELSE greatest(n_paid, n_free) END AS humans
    FROM grp)
, counted AS (
    SELECT *, CASE guest_type WHEN 'TICKET_HOLDER' THEN seat <= humans WHEN 'RSVP' THEN TRUE END
               AS counts_as_human,
           CASE guest_type WHEN 'TICKET_HOLDER' THEN humans WHEN 'RSVP' THEN humans + n_rsvp END
               AS humans_at_event_for_buyer,
           guest_type = 'TICKET_HOLDER' AND seat > 1 AND seat <= humans AS is_partner_seat
    FROM seated)
"""


def attendance_ctes(include_inactive: bool = False) -> str:
    return stub_ctes(include_inactive) + """
, cap AS (SELECT event_id, CAST(sum(initial_limit) AS BIGINT) AS capacity, count(*) AS n_defs
          FROM t_def GROUP BY event_id)
, lone AS (SELECT event_id, order_number, max(_ord) AS _ord FROM t_ticket
           GROUP BY event_id, order_number HAVING count(*) = 1)
, basket AS (SELECT DISTINCT event_id, product_name FROM stub WHERE product_name <> '')
, hit AS (
    SELECT b.event_id, b.product_name, d._ord, d.name, d.fixed_price_value, d.pricing_type,
           d.initial_limit, d.actual_limit, d.limit_per_checkout
    FROM basket b JOIN t_def d ON b.event_id = d.event_id AND trim(d.name) <> ''
         AND contains(lower(b.product_name), lower(trim(d.name))))
, td AS (
    SELECT event_id, product_name, count(*) AS n,
           string_agg(name, ', ' ORDER BY _ord) AS td_name,
           string_agg(pricing_type, ', ' ORDER BY _ord) AS td_pricing_type,
           string_agg(CAST(fixed_price_value AS VARCHAR), ', ' ORDER BY _ord) AS price_t,
           string_agg(CAST(initial_limit AS VARCHAR), ', ' ORDER BY _ord) AS init_t,
           string_agg(CAST(actual_limit AS VARCHAR), ', ' ORDER BY _ord) AS actual_t,
           string_agg(CAST(limit_per_checkout AS VARCHAR), ', ' ORDER BY _ord) AS per_t,
           CASE WHEN count(fixed_price_value) = 1 THEN max(fixed_price_value) END AS price_v,
           CASE WHEN count(initial_limit) = 1 THEN max(initial_limit) END AS init_v,
           CASE WHEN count(actual_limit) = 1 THEN max(actual_limit) END AS actual_v,
           CASE WHEN count(limit_per_checkout) = 1 THEN max(limit_per_checkout) END AS per_v
    FROM hit GROUP BY event_id, product_name)
, wide AS (
    SELECT s.*, e.title, e.slug, e.status AS e_status, e.registration_type, e.category_names,
           e.category_count, e.start_date, e.start_time, e.start_datetime, e.day_of_week,
           e.is_weekend, e.location_name, e.location_city, e.lowest_price, e.highest_price,
           e.currency AS e_currency, p.first_name AS c_first, p.last_name AS c_last,
           p.full_name AS c_full, p.primary_email, p.email AS c_email, p.is_member AS c_member,
           p.member_id AS c_member_id, m.member_id AS m_member_id, m.created_date AS m_created,
           m.last_login_date, cap.capacity, cap.n_defs, su.avg_ticket_price,
           su.total_sales_currency,
           coalesce(t1.ticket_number, t2.ticket_number) AS t_number,
           CASE WHEN t1._ord IS NOT NULL THEN t1._ord ELSE t2._ord END AS t_ord,
           coalesce(t1.ticket_definition_id, t2.ticket_definition_id,
                    s.primary_ticket_definition_id) AS def_id,
           td.n AS td_n, td.td_name, td.td_pricing_type, price_t, init_t, actual_t, per_t,
           price_v, init_v, actual_v, per_v
    FROM counted s
    LEFT JOIN t_event e ON s.event_id = e.event_id
    LEFT JOIN t_contact p ON p.contact_id = coalesce(s.buyer_contact_id, s.contact_id)
    LEFT JOIN t_member m ON m.contact_id = coalesce(s.buyer_contact_id, s.contact_id)
    LEFT JOIN cap ON cap.event_id = s.event_id
    LEFT JOIN t_summary su ON su.event_id = s.event_id
    LEFT JOIN t_ticket t1 ON t1.ticket_number = coalesce(s.ticket_number, s.primary_ticket_number)
    LEFT JOIN lone ON t1._ord IS NULL AND lone.event_id = s.event_id
                   AND lone.order_number = s.order_number
    LEFT JOIN t_ticket t2 ON t2._ord = lone._ord
    LEFT JOIN td ON td.event_id = s.event_id AND td.product_name = s.product_name)
, priced AS (
    SELECT w.*, t.ticket_name AS t_name, t.price_currency AS t_currency, t.free AS t_free,
           t.checked_in AS t_checked, t.check_in_date, t.check_in_time, t.price_value AS t_price,
           d.name AS d_name, d.fixed_price_value AS d_price, d.fixed_price_currency AS d_currency,
           d.free AS d_free, d.pricing_type AS d_pricing, d.fee_type, d.sale_status,
           CASE WHEN upper(w.order_status) = 'FREE' THEN 'order_status'
                WHEN t.price_value IS NOT NULL THEN 'ticket'
                WHEN d.fixed_price_value IS NOT NULL THEN 'ticket_definition'
                WHEN price_t IS NOT NULL THEN 'td_match'
                WHEN avg_ticket_price IS NOT NULL THEN 'event_average' ELSE 'unknown' END AS src
    FROM wide w LEFT JOIN t_ticket t ON t._ord = w.t_ord
    LEFT JOIN t_def d ON d.definition_id = w.def_id)
, valued AS (
    SELECT *, CASE src WHEN 'order_status' THEN 0.0::DOUBLE WHEN 'ticket' THEN t_price
                WHEN 'ticket_definition' THEN d_price WHEN 'td_match' THEN price_v
                WHEN 'event_average' THEN avg_ticket_price END AS price_value
    FROM priced)
, freed AS (
    SELECT *, CASE upper(order_status) WHEN 'FREE' THEN TRUE WHEN 'PAID' THEN FALSE
                ELSE coalesce(t_free, d_free,
                    CASE WHEN src = 'td_match' AND price_v IS NULL THEN FALSE
                         ELSE price_value = 0 END) END AS free,
           coalesce(m_member_id, nullif(b_member_id, ''), c_member_id) AS who_member
    FROM valued)
, attendance_fact AS (
    SELECT guest_id, event_id, coalesce(buyer_contact_id, contact_id) AS contact_id,
           buyer_contact_id, contact_id AS th_contact_id_raw,
           CASE WHEN buyer_contact_id IS NULL THEN 'orphan_no_buyer'
                WHEN contact_id IS NULL THEN 'buyer'
                WHEN contact_id = buyer_contact_id THEN 'th_matches_buyer'
                ELSE 'buyer_overrides_holder' END AS identity_source,
           order_number, coalesce(t_number, ticket_number) AS ticket_number,
           def_id AS ticket_definition_id, guest_type,
           buyer_contact_id IS NOT NULL AS was_buyer, tickets_in_order, attendance_status,
           order_status, order_payment_status, paid_tickets_per_order, is_paid_ticket_stub,
           humans_at_event_for_buyer, counts_as_human, is_partner_seat,
           coalesce(t_checked, checked_in) AS checked_in, check_in_date, check_in_time,
           title AS event_title, slug AS event_slug, e_status AS event_status,
           registration_type, category_names, category_count, start_date, start_time,
           start_datetime, day_of_week, is_weekend, location_name, location_city,
           lowest_price AS event_lowest_price, highest_price AS event_highest_price,
           e_currency AS event_currency, td_name, td_pricing_type,
           price_v AS td_fixed_price_value, price_t AS td_fixed_price_value_text,
           init_v AS td_initial_limit, init_t AS td_initial_limit_text,
           actual_v AS td_actual_limit, actual_t AS td_actual_limit_text,
           per_v AS td_limit_per_checkout, per_t AS td_limit_per_checkout_text,
           CASE WHEN td_n IS NULL THEN 'none' WHEN td_n = 1 THEN 'exact' ELSE 'ambiguous' END
               AS td_match_confidence,
           capacity AS event_total_capacity, n_defs AS event_distinct_td_count,
           coalesce(t_name, primary_ticket_name, d_name, td_name) AS ticket_name,
           price_value, CASE WHEN src = 'td_match' THEN price_t END AS price_text,
           CASE src WHEN 'order_status'
                    THEN coalesce(t_currency, d_currency, total_sales_currency, e_currency)
                WHEN 'ticket_definition' THEN coalesce(t_currency, d_currency)
                WHEN 'event_average' THEN coalesce(t_currency, total_sales_currency)
                ELSE t_currency END AS price_currency,
           src AS price_source,
           CASE WHEN free THEN 'Free' WHEN price_value IS NULL THEN 'Unknown'
                WHEN price_value = 0 THEN 'Free' WHEN price_value < 25 THEN '0-25'
                WHEN price_value < 50 THEN '25-50' WHEN price_value < 100 THEN '50-100'
                ELSE '100+' END AS paid_bucket,
           free, d_pricing AS def_pricing_type, fee_type AS def_fee_type,
           sale_status AS def_sale_status,
           CASE WHEN buyer_contact_id IS NULL THEN coalesce(nullif(first_name, ''), nullif(c_first, ''))
                ELSE coalesce(nullif(b_first, ''), nullif(c_first, '')) END AS first_name,
           CASE WHEN buyer_contact_id IS NULL THEN coalesce(nullif(last_name, ''), c_last)
                ELSE coalesce(nullif(b_last, ''), c_last) END AS last_name,
           CASE WHEN buyer_contact_id IS NULL
                THEN coalesce(full_name, c_full, nullif(concat_ws(' ',
                     coalesce(nullif(first_name, ''), nullif(c_first, '')),
                     coalesce(nullif(last_name, ''), c_last)), ''))
                ELSE coalesce(b_full, c_full, nullif(concat_ws(' ',
                     coalesce(nullif(b_first, ''), nullif(c_first, '')),
                     coalesce(nullif(b_last, ''), c_last)), '')) END AS full_name,
           CASE WHEN buyer_contact_id IS NULL THEN coalesce(email, primary_email, c_email)
                ELSE coalesce(b_email, primary_email, c_email) END AS email,
           CASE WHEN buyer_contact_id IS NULL THEN phone ELSE b_phone END AS phone,
           coalesce(b_member, FALSE) OR coalesce(c_member, FALSE) OR who_member IS NOT NULL
               AS is_member,
           who_member AS member_id, m_created AS member_signup_date,
           last_login_date AS member_last_login_date, created_date AS registered_date,
           created_time AS registered_time
    FROM freed)
"""


ATTENDANCE_ENTITIES = (
    "t_guest t_event t_contact t_member t_def t_ticket t_summary t_payment"
)

PAYMENTS_ENTITIES = "t_payment t_order t_event t_contact t_member t_summary"

PAYMENTS_CTE = """
, payments_fact AS (
    SELECT p.transaction_id, p.provider_transaction_id, p.order_id, p.app_order_id,
           o.event_id, o.contact_id, coalesce(m.member_id, o.member_id, c.member_id) AS member_id,
           CASE WHEN p.app_order_id IS NULL THEN 'no_order_id'
                WHEN o.order_number IS NULL THEN 'order_not_found'
                WHEN e.event_id IS NULL THEN 'event_not_found'
                WHEN o.contact_id IS NULL THEN 'no_contact_link' ELSE 'fully_enriched' END
               AS enrichment_status,
           p.payment_date, p.payment_time, p.payment_datetime, p.currency, p.amount,
           p.platform_fee, p.net_amount, p.tax, p.discount,
           CASE WHEN p.amount IS NULL THEN 'Unknown' WHEN p.amount = 0 THEN 'Free'
                WHEN p.amount < 25 THEN '0-25' WHEN p.amount < 50 THEN '25-50'
                WHEN p.amount < 100 THEN '50-100' WHEN p.amount < 250 THEN '100-250'
                ELSE '250+' END AS amount_bucket,
           p.status, p.transaction_status, p.transaction_type, p.is_refundable, p.failure_code,
           p.payment_provider_friendly AS payment_provider, p.payment_method, p.card_network,
           p.card_last_four, p.refund_count, p.refund_succeeded_count, p.refund_total_amount,
           p.refund_status, p.refund_reason, p.refund_date, p.product_name, p.product_count,
           p.total_quantity, e.title AS event_title, e.slug AS event_slug,
           e.status AS event_status, e.registration_type, e.category_names, e.category_count,
           e.start_date AS event_start_date, e.start_time AS event_start_time,
           e.start_datetime AS event_start_datetime, e.day_of_week AS event_day_of_week,
           e.is_weekend AS event_is_weekend, e.location_name, e.location_city,
           e.lowest_price AS event_lowest_price, e.highest_price AS event_highest_price,
           s.total_orders AS event_total_orders, s.total_tickets AS event_total_tickets,
           s.total_sales_amount AS event_total_sales,
           s.avg_ticket_price AS event_avg_ticket_price, o.channel AS order_channel,
           o.status AS order_status, o.tickets_quantity AS order_tickets_quantity,
           o.ticket_names AS order_ticket_names,
           coalesce(nullif(c.first_name, ''), p.billing_first_name) AS first_name,
           coalesce(c.last_name, p.billing_last_name) AS last_name,
           coalesce(c.full_name, p.billing_full_name, nullif(concat_ws(' ',
               coalesce(nullif(c.first_name, ''), p.billing_first_name),
               coalesce(c.last_name, p.billing_last_name)), '')) AS full_name,
           coalesce(c.primary_email, c.email, p.billing_email) AS email,
           p.billing_phone AS phone,
           coalesce(c.is_member, FALSE)
               OR coalesce(m.member_id, o.member_id, c.member_id) IS NOT NULL AS is_member,
           m.created_date AS member_signup_date, m.last_login_date AS member_last_login_date,
           p.billing_city, p.billing_country
    FROM t_payment p LEFT JOIN t_order o ON p.app_order_id = o.order_number
    LEFT JOIN t_event e ON o.event_id = e.event_id
    LEFT JOIN t_summary s ON o.event_id = s.event_id
    LEFT JOIN t_contact c ON o.contact_id = c.contact_id
    LEFT JOIN t_member m ON o.contact_id = m.contact_id)
"""
