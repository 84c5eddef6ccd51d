"""Full runs: raw snapshot -> flat tables -> facts, with a manifest row per stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from turnstile.operators import flatten_events as events
from turnstile.operators import flatten_forms as forms
from turnstile.operators import flatten_people as people
from turnstile.operators import flatten_sales as sales
from turnstile.operators.enrich import exclude_rsvp_guests, tickets_with_definitions
from turnstile.plans.attendance_fact import build_attendance_fact
from turnstile.plans.payments_fact import build_payments_fact
from turnstile.schemas import raw_schema
from turnstile.session import stage as staged
from turnstile.sources.bronze import bronze_read, resolve_snapshots, snapshot_ids, snapshot_list
from turnstile.sources.manifest import RunManifest
from turnstile.sources.summaries import save_summaries, summarise
from turnstile.sources.tables import table_read, table_write

FLATTENERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "events": events.flatten_events,
    "contacts": people.flatten_contacts,
    "members": people.flatten_members,
    "guests": people.flatten_guests,
    "ticket_definitions": sales.flatten_ticket_definitions,
    "tickets": sales.flatten_tickets,
    "order_summaries": sales.flatten_order_summaries,
    "event_orders": sales.flatten_event_orders,
    "payments": sales.flatten_payments,
    "rsvps": people.flatten_rsvps,
    "form_submissions": forms.flatten_submissions_wide,
    "coupons": sales.flatten_coupons,
    "automations": forms.flatten_automations,
}


# Raw entities that a flat table reads besides its own.
ALSO_READ = {"guests": ("events", "contacts"), "tickets": ("ticket_definitions",)}
# What each fact reads.
NEEDED = {
    "attendance_fact": ("guests", "events", "contacts", "members", "ticket_definitions", "tickets",
                        "order_summaries", "payments"),
    "payments_fact": ("payments", "event_orders", "events", "contacts", "members",
                      "order_summaries"),
}


def out_of_date(refilled: list[str]) -> tuple[list[str], list[str]]:
    """Flat tables and facts that raw snapshots of some entities make stale, in build order."""
    flat = [e for e in FLATTENERS if {e, *ALSO_READ.get(e, ())}.intersection(refilled)]
    return flat, [fact for fact, needed in NEEDED.items() if set(needed).intersection(flat)]


def empty_raw(spark: SparkSession, entity: str) -> DataFrame:
    """A snapshot of an entity without records."""
    return spark.createDataFrame([], T.StructType(
        raw_schema(entity).fields + [T.StructField("_ord", T.LongType())]))


def flatten_entity(entity: str, raw: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """The flat tables of one entity of one snapshot, by name; ``raw`` gives its records.

    Guests of RSVP events are left out and guest gaps filled from contacts; tickets get their
    definition columns; events split into ``events`` and ``rsvp_events``; form submissions
    come wide and long.
    """
    records = raw(entity)
    flat = FLATTENERS[entity](records)
    if entity == "events":
        parts = events.split_events_by_type(flat)
        return {"events": parts["ticketing"], "rsvp_events": parts["rsvp"]}
    if entity == "guests":
        flat = exclude_rsvp_guests(flat, events.flatten_events(raw("events")))
        flat = people.enrich_guests(flat, raw("contacts"))
    elif entity == "tickets":
        templates = sales.flatten_ticket_definitions(raw("ticket_definitions"))
        flat = tickets_with_definitions(flat, templates)
    elif entity == "form_submissions":
        return {entity: flat, "form_submissions_long": forms.flatten_submissions_long(records)}
    return {entity: flat}


def build_flat_tables(
    spark: SparkSession, raw_root: str, table_root: str, snapshot: str,
    entities: list[str] | None = None, array_files: bool = False,
    manifest: RunManifest | None = None, names: dict[str, dict[str, str]] | None = None,
    summary_root: str | None = None,
) -> RunManifest:
    """Flatten the entities of one snapshot. A failing entity is recorded, others go on.

    With ``summary_root`` every written table is summarised there (``sources.summaries``).

    Records that do not parse go to the table ``rejects_<entity>`` with their text, and their
    number to the manifest. ``names`` gives the source's field names per entity.
    """
    manifest = manifest or RunManifest(spark, snapshot)
    parsed: dict[str, DataFrame] = {}

    def whole(entity: str) -> DataFrame:
        """The records of an entity; their text is parsed once per run, whoever reads them."""
        if entity not in parsed:
            parsed[entity] = staged(bronze_read(
                spark, raw_root, entity, snapshot, array_file=array_files,
                names=(names or {}).get(entity)), f"parsed-{entity}")
        return parsed[entity]

    def raw(entity: str) -> DataFrame:
        return whole(entity).where("_corrupt_record IS NULL")

    for entity in entities or list(FLATTENERS):
        try:
            with manifest.stage(entity) as stage:
                records = whole(entity)
                if records.isEmpty():
                    continue
                extra = {}
                rejects = records.where("_corrupt_record IS NOT NULL").select(
                    "_ord", "_corrupt_record")
                n_rejects = rejects.count()
                if n_rejects:
                    extra = {"rejected_rows": str(n_rejects), "rejects": table_write(
                        rejects, table_root, f"rejects_{entity}", snapshot)}
                main, *others = flatten_entity(entity, raw).items()
                for name, flat in others:
                    extra[name] = table_write(flat, table_root, name, snapshot)
                path = table_write(stage.counted(main[1]), table_root, main[0], snapshot)
                for name in [main[0], *(n for n, _ in others)] if summary_root else []:
                    save_summaries(summarise(
                        table_read(spark, table_root, name, snapshot), name, snapshot), summary_root)
                stage.record(raw_path=f"{raw_root}/{entity}", table_path=path, extra_paths=extra)
        except Exception:  # noqa: BLE001 - recorded in the manifest
            continue
    return manifest


def flat_table(spark: SparkSession, table_root: str, entity: str, snapshot: str) -> DataFrame:
    """A flat table of a snapshot; one that was never written has no rows."""
    try:
        return table_read(spark, table_root, entity, snapshot)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return flatten_entity(entity, lambda name: empty_raw(spark, name))[entity]


def build_facts(
    spark: SparkSession, table_root: str, snapshot: str,
    manifest: RunManifest | None = None, include_inactive: bool = False,
    facts: list[str] | None = None,
) -> RunManifest:
    """Build the facts (both, unless named) of one snapshot from its flat tables.

    Entities without records count as empty; a fact is refused if an entity it needs failed.
    """
    manifest = manifest or RunManifest(spark, snapshot)

    def inputs(fact: str) -> list[DataFrame]:
        if broken := manifest.failed().intersection(NEEDED[fact]):
            raise RuntimeError(f"{fact} needs entities that failed: {', '.join(sorted(broken))}")
        return [flat_table(spark, table_root, name, snapshot) for name in NEEDED[fact]]

    for name in facts if facts is not None else list(NEEDED):
        with manifest.stage(name) as stage:
            fact = (build_attendance_fact(*inputs(name), include_inactive)
                    if name == "attendance_fact" else build_payments_fact(*inputs(name)))
            stage.record(table_path=table_write(stage.counted(fact), table_root, name, snapshot))
    return manifest


def run_snapshots(
    spark: SparkSession, raw_root: str, table_root: str, which: str = "latest",
    array_files: bool = False,
) -> list[RunManifest]:
    """Full runs of the ``latest`` snapshot, of ``all`` or of one id; newest first."""
    runs = []
    for snapshot in resolve_snapshots(snapshot_list(spark, raw_root), which):
        run = build_flat_tables(spark, raw_root, table_root, snapshot, array_files=array_files)
        runs.append(build_facts(spark, table_root, snapshot, run))
    return runs


def backfill(
    spark: SparkSession, raw_root: str, table_root: str, start: str, end: str,
    entities: list[str], array_files: bool = False, summary_root: str | None = None,
) -> list[RunManifest]:
    """Bring every snapshot dated in [start, end) up to date with the raw data of ``entities``.

    By the same steps as a first run, those flat tables that read one of the entities and those
    facts that read one of these tables are built again (``out_of_date``); all other tables, and
    all tables of other snapshots, keep their files.
    """
    ids = sorted({i for e in entities for i in snapshot_ids(spark, raw_root, e, start, end)})
    flat, facts = out_of_date(entities)
    runs = []
    for i in ids:
        run = build_flat_tables(spark, raw_root, table_root, i, flat, array_files,
                                summary_root=summary_root)
        runs.append(build_facts(spark, table_root, i, run, facts=facts))
    return runs


def incremental_cutoff(table: DataFrame, updated: str = "updated_datetime") -> str | None:
    """Latest change already in a table; a pull only needs newer records."""
    return table.agg(F.max(updated)).first()[0]
