"""Order rules against plain-Python brute force."""

import random
import time

from pyspark.sql import functions as F

from turnstile.operators import dims, headcount, orders

GUEST = (
    "guest_id string, event_id string, contact_id string, guest_type string, "
    "order_number string, ticket_number string, primary_ticket_number string, "
    "primary_ticket_definition_id string, primary_ticket_name string, attendance_status string, "
    "order_status string, first_name string, last_name string, full_name string, email string, "
    "phone string, checked_in boolean, created_date string, created_time string, "
    "is_member boolean, member_id string, _ord bigint")
PAYMENT = (
    "app_order_id string, status string, payment_datetime string, total_quantity bigint, "
    "product_name string, _ord bigint")


def guest(i, event, contact, kind, order, number):
    row = [None] * 22
    row[0], row[1], row[2], row[3], row[4], row[5], row[21] = (
        f"g{i}", event, contact, kind, order, number, i)
    return tuple(row)


def fold(payments):
    best = {}
    for p in payments:
        order, status, at = p[0], p[1], p[2]
        if not order:
            continue
        e = best.get(order)
        if e is None or (status == "APPROVED" and e[1] != "APPROVED") or (
                at and e[2] and at > e[2]):
            best[order] = p
    return {k: v[5] for k, v in best.items()}


def test_latest_payment_matches_the_fold(spark):
    rng = random.Random(7)
    rows = [
        (rng.choice(["", None] + [f"o{k}" for k in range(400)]),
         rng.choice(["APPROVED", "REFUND", "PENDING", None]),
         rng.choice([None, ""] + [f"2024-01-0{d}" for d in range(1, 7)]), 1, "x", i)
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, PAYMENT).repartition(3)
    got = {r[0]: r[1] for r in orders.latest_payment_per_order(df).select(
        "order_number", "payment_ord").collect()}
    assert got == fold(rows)


def test_one_order_of_many_payments(spark):
    """Dates out of order, missing dates and changing status in an order over many tasks."""
    rng = random.Random(17)
    payments = []
    for i in range(100_000):
        year = 2200 - i // 2000 if i < 90_000 else rng.randrange(2000, 2300)
        at = rng.choice([None, "", f"{year}-{rng.randrange(10, 13)}-01"])
        status = "REFUND" if i < 60_000 else rng.choice(["APPROVED", "REFUND"])
        payments.append(("hot", status, at, 1, "Ticket", i))
    payments += [(f"o{k}", rng.choice(["APPROVED", "REFUND"]),
                  rng.choice([None, f"2024-01-{rng.randrange(10, 30)}"]), 1, "Ticket", 200_000 + k * 20 + j)
                 for k in range(200) for j in range(rng.randrange(1, 15))]
    df = spark.createDataFrame(payments, PAYMENT).repartition(6)
    got = {r["order_number"]: r["payment_ord"]
           for r in orders.latest_payment_per_order(df).collect()}
    assert got == fold(payments)


def test_alternating_payments_of_one_order(spark):
    """An order that changes its mind with every row: the rounds do not grow with it."""
    payments = [("hot", "APPROVED" if i % 2 else "PENDING", f"{9000 - i // 4}-{1 + i % 2}", 1, "x", i)
                for i in range(20_000)]
    df = spark.createDataFrame(payments, PAYMENT).repartition(8)
    start = time.perf_counter()
    got = {r[0]: r[1] for r in orders.latest_payment_per_order(df).select(
        "order_number", "payment_ord").collect()}
    assert got == fold(payments)
    assert time.perf_counter() - start < 60


def test_slices_compose_to_the_fold():
    """Any payments cut anywhere: maps of slices lead where the row-by-row rule leads."""
    rng = random.Random(23)
    for _ in range(4000):
        dates = [None, *[str(d) for d in range(rng.randint(1, 6))]]
        rows = [(rng.random() < 0.4, rng.choice(dates), i) for i in range(rng.randint(1, 14))]
        want = None
        for row in rows:
            want = orders._next(want, row)
        state, at = None, 0
        while at < len(rows):
            end = rng.randint(at + 1, len(rows))
            piece, settling = orders._Slice("k", 0), []
            for row in rows[at:end]:
                if piece.add(row):
                    settling.append((piece.highest, row))
            at = end
            if state is None:
                state = piece.start
                continue
            ok, date, _ = state
            bar = piece.highest if ok else piece.before_ok
            if date is not None and bar is not None and date < bar:
                over = [row for top, row in settling if top > date]
                assert bool(over) == (piece.settling is not None and date < piece.settling)
                state = over[0] if over else piece.from_highest
            elif not ok and piece.has_ok:
                state = piece.from_ok
        assert state == want


def test_nth_stub_of_hot_orders(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for k, size in enumerate((5, 40, 3000)):
        keys = [(n is None, n, i) for i, n in enumerate(
            rng.choice([None, f"t{rng.randrange(50):03d}"]) for _ in range(size))]
        nth = rng.randrange(1, size)
        rows += [(f"o{k}", key, nth) for key in keys]
        want[f"o{k}"] = sorted(keys, key=lambda x: (x[0], x[1] or "", x[2]))[nth - 1]
    df = spark.createDataFrame(
        rows, "order_number string, key struct<unnumbered:boolean,number:string,ord:bigint>, "
              "nth bigint")
    got = {r[0]: tuple(r[1]) for r in orders.nth_stub(df).collect()}
    assert got == want


def people(guests, payments):
    """Kept stubs with flags, by the rules read one row at a time."""
    latest = fold(payments)
    pay = {p[0]: p for p in payments if p[5] == latest.get(p[0])}
    by_order = {}
    for g in guests:
        if g[4]:
            by_order.setdefault(g[4], []).append(g)
    number = lambda g: (0, g[5]) if g[5] else (1, "")
    rows = []
    for order, members in by_order.items():
        buyers = [g for g in members if g[3] == "BUYER"]
        holders = sorted((g for g in members if g[3] == "TICKET_HOLDER"), key=number)
        p = pay.get(order)
        n = (p[3] or 0) if p else 0
        if p and "Application Fee" in (p[4] or ""):
            n = max(0, n - 1)
        if p and p[1] in ("REFUND", "DECLINED"):
            continue
        who = buyers[0][2] if buyers else None
        rows += [(g, who, i < n) for i, g in enumerate(holders)]
        rows += [(g, who, None) for g in members if g[3] == "RSVP"]
    rows += [(g, None, None) for g in guests if not g[4] and g[3] != "BUYER"]
    groups, out = {}, {}
    for r in rows:
        groups.setdefault((r[0][1], r[1]), []).append(r)
    for members in groups.values():
        th = sorted((r for r in members if r[0][3] == "TICKET_HOLDER"),
                    key=lambda r: (0 if r[2] else 1, number(r[0])))
        rsvps = [r for r in members if r[0][3] == "RSVP"]
        paid = sum(1 for r in th if r[2])
        free = len(th) - paid
        humans = paid if paid and free else max(paid, free)
        for i, r in enumerate(th):
            out[r[0][0]] = (r[2], i < humans, humans, i > 0 and i < humans)
        for r in rsvps:
            out[r[0][0]] = (None, True, humans + len(rsvps), False)
        for r in members:
            out.setdefault(r[0][0], (None, None, None, False))
    return out


def test_headcount_matches_brute_force(spark):
    rng = random.Random(11)
    kinds = ["BUYER", "TICKET_HOLDER", "TICKET_HOLDER", "TICKET_HOLDER", "RSVP", "WAITLIST"]
    guests = [
        guest(i, f"e{rng.randrange(4)}", rng.choice([None, "c0", "c1", "c2"]), rng.choice(kinds),
              rng.choice([None, ""] + [f"o{k}" for k in range(60)]),
              rng.choice([None, "", f"t{rng.randrange(30):02d}"]))
        for i in range(600)
    ]
    payments = [
        (f"o{rng.randrange(70)}", rng.choice(["APPROVED", "APPROVED", "REFUND", "DECLINED"]),
         f"2024-01-{i // 10 + 1:02d}", rng.choice([None, 0, 1, 2, 3, 9]),
         rng.choice([None, "Ticket", "Ticket, Application Fee"]), i)
        for i in range(120)
    ]
    g = spark.createDataFrame(guests, GUEST).repartition(3)
    context = orders.order_context(g, spark.createDataFrame(payments, PAYMENT))
    want = people(guests, payments)
    rows = headcount.count_people(headcount.ticket_stubs(g, context)).select(
        "guest_id", "is_paid_ticket_stub", "counts_as_human", "humans_at_event_for_buyer",
        "is_partner_seat").collect()
    assert len(rows) == len(want)
    assert {r[0]: tuple(r)[1:] for r in rows} == want


def test_last_wins_drops_blank_keys(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 3), ("a", 9, 2), ("", 5, 4), (None, 6, 5)],
                               "k string, v int, _ord bigint")
    assert [tuple(r) for r in dims.last_wins(df, "k").select("k", "v").collect()] == [("a", 2)]


def test_definition_match_numbers(spark):
    defs = spark.createDataFrame(
        [("e1", " Jam ", 25.0, "FIXED", 5, 1), ("e1", "talk", 30.0, "FIXED", None, 2),
         ("e1", " ", 1.0, "X", 1, 3), ("e2", "Solo", 7.5, "FIXED", 3, 4)],
        "event_id string, name string, fixed_price_value double, pricing_type string, "
        "initial_limit bigint, _ord bigint").withColumns(
        {"actual_limit": F.lit(None).cast("bigint"),
         "limit_per_checkout": F.lit(None).cast("bigint")})
    baskets = spark.createDataFrame(
        [("e1", "JAM, Talk"), ("e1", "nothing"), ("e2", "the solo show")],
        "event_id string, product_name string")
    rows = {r["_td_product"]: r for r in dims.match_ticket_definitions(baskets, defs).collect()}
    both = rows["JAM, Talk"]
    assert both["td_match_confidence"] == "ambiguous" and both["td_name"] == " Jam , talk"
    assert both["td_fixed_price_value"] is None
    assert both["td_fixed_price_value_text"] == "25.0, 30.0"
    assert both["td_initial_limit"] == 5
    assert rows["the solo show"]["td_fixed_price_value"] == 7.5
    assert "nothing" not in rows


def test_anchor_join_finds_what_contains_finds(spark):
    """Random names and texts of few letters, short names, a hot event, absent pieces."""
    rng = random.Random(31)
    word = lambda low, high: "".join(rng.choice("abé ") for _ in range(rng.randint(low, high)))
    event = lambda: rng.choice(["hot", "hot", "hot", "e1", "e2"])
    names = [(event(), word(1, 7), float(i), "FIXED", i, i, i, i) for i in range(120)]
    names += [("hot", None, 1.0, "FIXED", 1, 1, 1, 500), (None, "a", 1.0, "FIXED", 1, 1, 1, 501)]
    texts = [(event(), word(0, 25).upper() if i % 3 else word(0, 25)) for i in range(400)]
    texts += [("hot", None), (None, "abab"), ("", "abab")]
    defs = spark.createDataFrame(
        names, "event_id string, name string, fixed_price_value double, pricing_type string, "
               "initial_limit bigint, actual_limit bigint, limit_per_checkout bigint, _ord bigint")
    baskets = spark.createDataFrame(texts, "event_id string, product_name string")
    found = {(r["_td_event"], r["_td_product"]): (r["td_name"], r["td_match_confidence"])
             for r in dims.match_ticket_definitions(baskets, defs).collect()}
    want = {}
    for e, text in set(texts):
        hits = [n for d, n, *_ in names if e and text and d == e and (n or "").strip(" ")
                and n.strip(" ").lower() in text.lower()]
        if hits:
            want[e, text] = (", ".join(hits), "exact" if len(hits) == 1 else "ambiguous")
    assert found == want


def test_anchors_leave_few_candidates(spark):
    """An event with most of the texts: names share common words, yet meet few texts."""
    texts = spark.range(3000).selectExpr(
        "'hot' AS event_id", "concat('1 x evening ticket row ', id % 300, ' seat ', id) AS text")
    needles = spark.range(300).selectExpr(
        "'hot' AS event_id", "concat('evening ticket row ', id, ' seat') AS needle")
    candidates = dims.anchor_candidates(texts, needles).count()
    assert 3000 <= candidates <= 20 * 3000 < 3000 * 300


def test_few_text_pieces_reach_the_join(spark):
    texts = spark.range(2_000).selectExpr(
        "CAST(id % 20 AS STRING) AS event_id", "concat('some long product text ', id) AS text")
    needles = spark.range(20).selectExpr(
        "CAST(id AS STRING) AS event_id", "concat('text ', 100 + id) AS needle")
    pieces = texts.selectExpr("event_id", "text", "substr(text, -4) AS piece")
    keys = needles.selectExpr("event_id", "substr(needle, -4) AS piece")
    kept = dims.may_match(pieces, keys, "event_id", "piece")
    exact = pieces.join(keys.distinct(), ["event_id", "piece"], "left_semi").select(*pieces.columns)
    assert kept.exceptAll(exact).count() <= 20 and exact.exceptAll(kept).isEmpty()
    assert dims.may_match(pieces, keys.limit(0), "event_id", "piece").isEmpty()
    found = dims.anchor_candidates(texts, needles).where("contains(text, needle)")
    wanted = texts.join(needles, "event_id").where("contains(text, needle)")
    assert found.exceptAll(wanted.select(*found.columns)).isEmpty() and found.count() == wanted.count() > 0
    # Of 2,000 texts with more than twenty pieces each, few rows are kept for the join.
    staged = []
    stage = dims.stage
    dims.stage = lambda df, label: staged.append((label, stage(df, label))) or staged[-1][1]
    try:
        dims.anchor_candidates(texts, needles)
    finally:
        dims.stage = stage
    assert dict(staged)["anchor-pieces"].count() < 2 * dict(staged)["anchors"].join(
        texts, "event_id").where("contains(text, piece)").count() + 100
