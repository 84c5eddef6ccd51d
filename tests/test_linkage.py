"""Fuzzy matching against all pairs."""

import random

import pytest

from turnstile.operators import linkage
from turnstile.operators.linkage import crossover_fuzzy


def score(a, b):
    a, b = (" ".join(sorted(x.split())) for x in (a, b))
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return 100.0 * 2 * row[-1] / (len(a) + len(b))


def test_best_match_is_never_missed(spark):
    rng = random.Random(5)
    letters = "abcde"

    def name():
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 7)))
                        for _ in range(rng.randrange(1, 4)))

    def typo(text):
        chars = list(text)
        for _ in range(rng.randrange(0, 4)):
            i = rng.randrange(len(chars) + 1)
            chars[i:i + rng.randrange(0, 2)] = rng.choice(["", "x", rng.choice(letters)])
        return " ".join("".join(chars).split())

    target = [(f"t{i:03d}", name()) for i in range(150)]
    source = [(f"s{i:03d}", typo(rng.choice(target)[1])) for i in range(200)] + [("s999", "")]
    want = {}
    for email, full in source:
        if full.strip():
            best = max(((score(full, n), m, n) for m, n in target if n),
                       key=lambda x: (x[0], [-ord(c) for c in x[1]]))
            if best[0] >= 85:
                want[email] = (best[2], best[1], round(best[0], 6))
    schema = "email string, full_name string"
    got = crossover_fuzzy(spark.createDataFrame(source, schema),
                          spark.createDataFrame(target, schema)).collect()
    assert {r["source_email"]: (r["target_name"], r["target_email"], round(r["match_score"], 6))
            for r in got} == want


def test_names_alike_meet_in_subsequences_not_in_pairs(spark):
    """No short pair is compared one by one; pairs around the limit of 33 letters lose nothing."""
    rng = random.Random(3)
    first, last = ["anna", "hanna", "ann", "annamaria"], ["barkoson", "markosen", "jarkoland", "barkoham"]

    def name(longer):
        text = f"{rng.choice(first)} {rng.choice(last)}" + "berg" * (longer and rng.randrange(3))
        for _ in range(rng.randrange(5)):
            i = rng.randrange(len(text))
            text = text[:i] + rng.choice(["", rng.choice("aeorn")]) + text[i + rng.randrange(2):]
        return " ".join(text.split())

    for longer in (False, True):
        target = {f"t{i:03d}": name(longer) for i in range(120)}
        source = {f"s{i:03d}": name(longer) for i in range(120)}
        schema = "email string, full_name string"
        frames = [spark.createDataFrame(list(x.items()), schema) for x in (source, target)]
        got = {r["source_email"]: (r["target_email"], round(r["match_score"], 6))
               for r in crossover_fuzzy(*frames).collect()}
        best = {s: min((-score(x, y), t) for t, y in target.items()) for s, x in source.items()}
        assert got == {s: (t, round(-m, 6)) for s, (m, t) in best.items() if -m >= 85}
        short = [spark.createDataFrame([(x,) for x in set(d.values()) if len(x) <= 16], "text string")
                 for d in (source, target)]
        assert linkage.candidate_pairs(*short, 85).isEmpty()


def test_event_pairs_are_counted_from_sets(spark):
    """Repeated rows, null events and e-mails, and many people with the same events."""
    rng = random.Random(11)

    def people(events):
        rows = [(rng.choice([None] + [f"p{i}" for i in range(60)]),
                 rng.choice([None, *events])) for _ in range(300)]
        rows += [(f"fan{i}", e) for i in range(200) for e in events[:5]]
        return rows

    a, b = people([f"a{i}" for i in range(8)]), people([f"b{i}" for i in range(6)])
    want = {}
    for mail in {m for m, _ in a} & {m for m, _ in b} - {None}:
        for y in {e for m, e in b if m == mail}:
            for x in {e for m, e in a if m == mail}:
                want[y, x] = want.get((y, x), 0) + 1
    frames = [spark.createDataFrame(rows, "email string, event_name string") for rows in (a, b)]
    counts = linkage.event_pair_counts(*frames)
    assert {(r["event_b"], r["event_a"]): r["n"] for r in counts.collect()} == want
    listed = linkage.event_pairs(*frames)
    assert listed.count() == sum(want.values())


def test_matrix_refuses_too_many_columns(spark, monkeypatch):
    monkeypatch.setattr(linkage, "MOST_COLUMNS", 2)
    counts = spark.createDataFrame([("b", f"a{i}", 1) for i in range(3)],
                                   "event_b string, event_a string, n long")
    with pytest.raises(ValueError, match="event_pair_counts"):
        linkage.event_pair_matrix(counts)
    assert linkage.event_pair_matrix(counts.where("event_a <> 'a0'")).count() == 1
