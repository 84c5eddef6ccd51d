"""People on two platforms: exact e-mail overlap and fuzzy name matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from turnstile.functions.similarity import indel_ratio, sorted_tokens
from turnstile.functions.text import normalize_email, normalize_name
from turnstile.session import by_key, stage

MOST_COLUMNS = 10_000
MOST_EDITS = 4


def normalize_people(df: DataFrame) -> DataFrame:
    """Add normalised e-mail and full name of the buyer."""
    first, last = normalize_name(F.col("buyer_first_name")), normalize_name(F.col("buyer_last_name"))
    return df.withColumns({
        "email": normalize_email(F.col("buyer_email")),
        "full_name": F.trim(F.concat(first, F.lit(" "), last)),
    })


def attendees_by_email(people: DataFrame, order_column: str) -> DataFrame:
    """One row per e-mail: first non-null names, distinct events and orders.

    Rows are combined per (e-mail, event) and (e-mail, order) first, so an e-mail with many rows
    is never expanded.
    """
    named = people.where("email IS NOT NULL")
    names = {"full_name": "full_name", "buyer_first_name": "first_name",
             "buyer_last_name": "last_name"}
    per_event = named.groupBy("email", "event_name").agg(*[
        F.min(F.when(F.col(c).isNotNull(), F.struct("_ord", F.col(c).alias("v")))).alias(c)
        for c in names])
    attended = per_event.groupBy("email").agg(
        *[F.min(c)["v"].alias(alias) for c, alias in names.items()],
        F.count("event_name").alias("events_attended"))
    bought = named.select("email", order_column).distinct().groupBy("email").agg(
        F.count(order_column).alias("orders"))
    return attended.join(bought, "email")


def platform_profile(people: DataFrame, order_column: str) -> DataFrame:
    """Order and event date span (unreadable dates ignored), events and rows."""
    order_day = F.col("order_date").try_cast("date")
    event_day = F.col("event_start_date").try_cast("date")
    return people.agg(
        F.min(order_day).cast("string").alias("first_order"),
        F.max(order_day).cast("string").alias("last_order"),
        F.min(event_day).cast("string").alias("first_event"),
        F.max(event_day).cast("string").alias("last_event"),
        F.count_distinct("event_name").alias("events"),
        F.count(order_column).alias("orders"),
    )


def event_rows(people: DataFrame) -> DataFrame:
    """Rows per event name."""
    return people.groupBy("event_name").agg(F.count("*").alias("n")).orderBy("event_name")


def crossover_exact(a: DataFrame, b: DataFrame) -> DataFrame:
    """Attendees with the same e-mail on both platforms, with both counts."""
    left = a.withColumnsRenamed({"events_attended": "events_a", "orders": "orders_a"})
    right = b.select("email", F.col("events_attended").alias("events_b"),
                     F.col("orders").alias("orders_b"))
    return left.join(right, "email")


def unmatched(a: DataFrame, b: DataFrame) -> DataFrame:
    """Attendees of ``a`` whose e-mail is not in ``b``."""
    return a.join(b.select("email"), "email", "left_anti")


def crossover_summary(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sizes of both platforms, their overlap and its shares in percent."""
    left = a.select("email", F.lit(True).alias("_a"))
    right = b.select("email", F.lit(True).alias("_b"))
    has_a, has_b = F.col("_a").isNotNull(), F.col("_b").isNotNull()
    counts = left.join(right, "email", "full").agg(
        F.count_if(has_a).alias("total_a"), F.count_if(has_b).alias("total_b"),
        F.count_if(has_a & has_b).alias("both"), F.count_if(has_a & ~has_b).alias("only_a"),
        F.count_if(has_b & ~has_a).alias("only_b"))

    def share(of: str) -> Column:
        return F.coalesce(F.col("both") * 100.0 / F.when(F.col(of) > 0, F.col(of)), F.lit(0.0))

    return counts.withColumns({
        "pct_a_from_b": share("total_a").cast("double"),
        "pct_b_in_a": share("total_b").cast("double"),
    })


def combined_summary(summary: DataFrame, fuzzy: DataFrame, confident: float = 90) -> DataFrame:
    """Overlap summary plus confident name matches and the combined match rate."""
    names = fuzzy.where(F.col("match_score") >= confident).agg(F.count("*").alias("name_matches"))
    total = F.col("both") + F.col("name_matches")
    rate = F.coalesce(total * 100.0 / F.when(F.col("total_a") > 0, F.col("total_a")), F.lit(0.0))
    # Both sides are one-row aggregates.
    return summary.join(names).withColumns(
        {"total_crossover": total, "match_rate": rate.cast("double")})


def common_values(a: DataFrame, b: DataFrame, column: str = "email") -> DataFrame:
    """Distinct values of a column that both tables have."""
    return a.select(column).intersect(b.select(column))


def values_only_in(a: DataFrame, b: DataFrame, column: str = "email") -> DataFrame:
    """Distinct values of a column that the first table has and the second has not."""
    return a.select(column).subtract(b.select(column))


def _bounds(length: Column, t: float) -> tuple[Column, Column]:
    """Partner lengths that can still reach similarity t."""
    low = F.ceil(length * F.lit(t / (2 - t)) - F.lit(1e-9)).cast("int")
    high = F.floor(length * F.lit((2 - t) / t) + F.lit(1e-9)).cast("int")
    return low, high


def _edits(total: Column, t: float) -> Column:
    """Most insertions plus deletions at similarity t over a total length."""
    return F.floor(total * F.lit(1 - t) + F.lit(1e-9)).cast("int")


def _cut(text_length: Column, i: Column, pieces: Column) -> Column:
    return F.floor(i * text_length / pieces).cast("int")


def _short_pairs(t: float) -> int:
    """Largest total length at which similarity t allows ``MOST_EDITS`` edits at most."""
    if t >= 1:
        return 1 << 30
    total = int((MOST_EDITS + 1) / (1 - t)) + 1
    while int(total * (1 - t) + 1e-9) > MOST_EDITS:
        total -= 1
    return total


def _subsequences(texts: DataFrame, t: float) -> DataFrame:
    """``texts`` with every subsequence (``v``) that a short pair at similarity t may have in common.

    Each step deletes one character at or after the place of the last one, or stops for good.
    """
    length, room = F.length("text"), F.length("v") + 1
    deleted, p = length - F.length("v"), F.col("p")
    fits = lambda d: (d <= (2 * length - d) * F.lit(1 - t) + F.lit(1e-9)) & (length > d)
    short = 2 * length - MOST_EDITS <= _short_pairs(t)
    # A fixed number of partitions, as AQE would merge the texts into few before they grow.
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = texts.where(short).repartition(tasks).withColumns({"v": F.col("text"), "at": F.lit(1)})
    for _ in range(MOST_EDITS):
        first = F.when(fits(deleted + 1), F.col("at")).otherwise(room)
        out = out.withColumn("p", F.explode(F.sequence(first, room))).withColumns({
            "v": F.when(p < room, F.concat(
                F.substring("v", F.lit(1), p - 1), F.substring("v", p + 1, length)))
            .otherwise(F.col("v")),
            "at": p})
    return out.where(2 * length - deleted <= _short_pairs(t)).drop("at", "p")


def best_of_short_pairs(source: DataFrame, target: DataFrame, threshold: float) -> DataFrame:
    """text, score, best: the best ``target`` (text, best) of every source text, among the pairs of
    ``_short_pairs`` at most.

    Two texts have their longest common subsequence in common as what is left after a few
    deletions. Of the target texts of one length that leave the same, only the first counts, so
    every subsequence of a source text meets one row per length, however many names are alike.
    """
    t = threshold / 100
    kept = _subsequences(target.select("text", "best"), t).select(
        "v", F.length("text").alias("lb"), "best")
    kept = kept.repartition("v").groupBy("v", "lb").agg(F.min("best").alias("best"))
    total = F.length("text") + F.col("lb")
    score = F.lit(200.0) * F.length("v") / total
    pairs = _subsequences(source.select("text"), t).join(by_key(kept), "v").where(
        total <= _short_pairs(t)).select("text", score.alias("score"), "best")
    return _best(pairs.where(F.col("score") >= threshold))


def _best(scored: DataFrame) -> DataFrame:
    """text, score, best: the highest score of every text, then the first target."""
    return scored.groupBy("text").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "best")).alias("m")).select(
        "text", (-F.col("m.s")).alias("score"), F.col("m.best").alias("best"))


def candidate_pairs(source: DataFrame, target: DataFrame, threshold: float) -> DataFrame:
    """Pairs of distinct texts (``a``, ``b``) longer than ``_short_pairs`` that may reach the
    threshold; none is missed.

    With at most k edits, one of k + 1 pieces of ``b`` survives unchanged in ``a``, shifted
    by a bounded distance. So pieces of ``b`` are joined to the substrings of ``a`` at the
    admissible places: an equi-join on (length of b, piece count, piece number, piece text)
    with no pair outside a shared piece. Spark's bounded Levenshtein distance, a lower bound
    of the edit count, thins the pairs inside the join.
    """
    t = threshold / 100
    lb, la = F.col("lb"), F.col("la")
    tgt = target.select(F.col("text").alias("b"), F.length("text").alias("lb"))
    low, high = _bounds(lb, t)
    tgt = tgt.where(lb + high > _short_pairs(t))
    counts = F.array_distinct(F.transform(
        F.sequence(low, high), lambda n: _edits(n + F.col("lb"), t) + 1))
    tgt = tgt.where(low <= high).select("*", F.explode(counts).alias("m"))
    tgt = tgt.select("*", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("i"))
    start, end = _cut(lb, F.col("i"), F.col("m")), _cut(lb, F.col("i") + 1, F.col("m"))
    tgt = tgt.select("b", "lb", "m", "i", F.substring("b", start + 1, end - start).alias("piece"))

    src = source.select(F.col("text").alias("a"), F.length("text").alias("la"))
    low, high = _bounds(la, t)
    src = src.where(low <= high).select("*", F.explode(F.sequence(low, high)).alias("lb"))
    src = src.where(la + lb > _short_pairs(t))
    src = src.withColumn("k", _edits(la + lb, t)).withColumn("m", F.col("k") + 1)
    src = src.select("*", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("i"))
    start, end = _cut(lb, F.col("i"), F.col("m")), _cut(lb, F.col("i") + 1, F.col("m"))
    src = src.withColumns({"at": start, "size": end - start})
    i, k, at, shift = F.col("i"), F.col("k"), F.col("at"), la - lb
    first = F.greatest(F.lit(0), at - i, at + shift - (k - i))
    last = F.least(la - F.col("size"), at + i, at + shift + (k - i))
    src = src.withColumns({"first": first, "last": last}).where("first <= last")
    src = src.select(
        "a", "lb", "m", "i", "k", F.explode(F.sequence("first", "last")).alias("pos"), "size")
    src = src.select(
        "a", "lb", "m", "i", "k", F.substring("a", F.col("pos") + 1, F.col("size")).alias("piece"))
    pairs = src.join(tgt, ["lb", "m", "i", "piece"])
    return pairs.where(F.expr("levenshtein(a, b, k) >= 0")).select("a", "b").distinct()


def crossover_fuzzy(source: DataFrame, target: DataFrame, threshold: float = 85) -> DataFrame:
    """Best name match in ``target`` for every ``source`` attendee, if good enough.

    Names compare by their sorted tokens. Among equal scores the name of the smallest
    target e-mail wins. Work runs over distinct names; names whose sorted tokens are equal
    score 100 by a plain equi-join and skip the search. Short pairs meet in common subsequences;
    only longer ones are compared as candidates.
    """
    tokens = sorted_tokens(F.col("full_name"))
    people = source.where(F.length(F.trim("full_name")) > 0).select(
        "email", "full_name", tokens.alias("text"))
    known = target.where(F.col("full_name").isNotNull()).groupBy(tokens.alias("text")).agg(
        F.min(F.struct("email", "full_name")).alias("best")).where(F.length("text") > 0)
    names = people.select("text").distinct()
    same = names.join(known, "text").select(
        "text", F.lit(100.0).alias("match_score"), "best")
    rest = names.join(known.select("text"), "text", "left_anti")
    scored = candidate_pairs(rest, known, threshold).withColumn(
        "score", indel_ratio(F.col("a"), F.col("b")))
    long = (
        scored.where(F.col("score") >= threshold)
        .join(known.withColumnRenamed("text", "b"), "b")
        .select(F.col("a").alias("text"), "score", "best")
    )
    near = _best(best_of_short_pairs(rest, known, threshold).unionByName(long))
    near = near.withColumnRenamed("score", "match_score")
    found = same.unionByName(near)
    return people.join(found, "text").select(
        F.col("full_name").alias("source_name"), F.col("email").alias("source_email"),
        F.col("best.full_name").alias("target_name"), F.col("best.email").alias("target_email"),
        "match_score",
        F.when(F.col("match_score") == 100, "exact").otherwise("fuzzy").alias("match_type"),
    )


def event_pairs(people_a: DataFrame, people_b: DataFrame) -> DataFrame:
    """For every shared e-mail, each of its events on B with each of its events on A."""
    a = people_a.where("email IS NOT NULL").select(
        "email", F.col("event_name").alias("event_a")).distinct()
    b = people_b.where("email IS NOT NULL").select(
        "email", F.col("event_name").alias("event_b")).distinct()
    return b.join(a, "email").select("event_b", "event_a", "email")


def _event_sets(people: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(email, set) and (set, event): e-mails by a 128-bit signature of their distinct events.

    The signature is an order-free sum, so no set is ever gathered in one row; the events of a
    set are those of its first e-mail.
    """
    attended = stage(people.where("email IS NOT NULL").select(
        "email", F.col("event_name").alias("event")).distinct(), "events-attended")
    digest = lambda salt: F.sum(F.xxhash64("event", F.lit(salt)).cast("decimal(38,0)"))
    sets = stage(attended.groupBy("email").agg(F.struct(
        F.count("*").alias("n"), digest(1).alias("x"), digest(2).alias("y")).alias("set")),
        "event-sets")
    first = sets.groupBy("set").agg(F.min("email").alias("email"))
    return sets, attended.join(first, "email").select("set", "event")


def event_pair_counts(people_a: DataFrame, people_b: DataFrame) -> DataFrame:
    """People per (event on B, event on A), most frequent first.

    Equal to counting ``event_pairs``, without listing them: shared e-mails with the same events
    on both platforms are counted as one pair of event sets, and each side's set is expanded
    only after that, B first, so at most (event on B, set on A) rows meet the events on A.
    """
    sets_a, events_a = _event_sets(people_a)
    sets_b, events_b = _event_sets(people_b)
    shared = sets_a.select("email", F.col("set").alias("set_a")).join(
        sets_b.select("email", F.col("set").alias("set_b")), "email").groupBy(
        "set_a", "set_b").agg(F.count("*").alias("n"))
    by_b = shared.join(events_b.select(F.col("set").alias("set_b"), F.col("event").alias("event_b")),
                       "set_b").groupBy("event_b", "set_a").agg(F.sum("n").alias("n"))
    return by_b.join(events_a.select(F.col("set").alias("set_a"), F.col("event").alias("event_a")),
                     "set_a").groupBy("event_b", "event_a").agg(F.sum("n").alias("n")).orderBy(
        F.col("n").desc(), "event_b", "event_a")


def event_pair_matrix(counts: DataFrame, events: list[str] | None = None) -> DataFrame:
    """Pair counts with one column per event on A, 0 where there is no pair.

    Unless given, all event names are read in a first pass; they are the column names of the
    result, so more than ``MOST_COLUMNS`` are an error. ``event_pair_counts`` is the form
    without a bound on the number of events.
    """
    if events is None:
        names = counts.select("event_a").distinct().limit(MOST_COLUMNS + 1).collect()
        if len(names) > MOST_COLUMNS:
            raise ValueError(f"more than {MOST_COLUMNS} events: use event_pair_counts")
        events = sorted(r["event_a"] for r in names)
    return counts.groupBy("event_b").pivot("event_a", events).agg(F.sum("n")).na.fill(0)


def crossover_engagement(matched: DataFrame, n: int = 15) -> DataFrame:
    """Shared attendees with the most events over both platforms."""
    total = (F.col("events_a") + F.col("events_b")).alias("total_events")
    return matched.select("email", "full_name", "events_a", "events_b", total).orderBy(
        F.col("total_events").desc(), "email").limit(n)


def engagement_averages(matched: DataFrame) -> DataFrame:
    """Mean events per shared attendee on each platform."""
    return matched.agg(
        (F.sum("events_a") / F.count("*")).alias("avg_events_a"),
        (F.sum("events_b") / F.count("*")).alias("avg_events_b"))


def event_value_counts(people: DataFrame, matched: DataFrame) -> DataFrame:
    """Rows per event for the shared attendees only."""
    return people.join(matched.select("email"), "email", "left_semi").groupBy("event_name").agg(
        F.count("*").alias("n")).orderBy(F.col("n").desc(), "event_name")
