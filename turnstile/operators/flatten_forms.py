"""Form submissions and automations to flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from turnstile.functions.text import sanitize_key
from turnstile.functions.values import first_filled
from turnstile.operators.shaping import last_entries, shape, stamps, variant_text

MOST_COLUMNS = 10_000


def _header() -> dict:
    return {
        "submission_id": first_filled(F.col("id"), F.col("_id")),
        "form_id": F.col("formId"),
        "namespace": F.col("namespace"),
        "status": F.col("status"),
        "submitter_contact_id": F.col("submitter.contactId"),
        "submitter_member_id": F.col("submitter.memberId"),
    }


def flatten_submissions_wide(raw: DataFrame) -> DataFrame:
    """One row per submission; answers in the ``fields`` map under ``field_*`` keys."""
    entries = F.transform(F.map_entries("submissions"), lambda e: F.struct(
        F.concat(F.lit("field_"), sanitize_key(e["key"])).alias("key"),
        variant_text(e["value"]).alias("value"),
    ))
    return shape(raw, {
        **_header(),
        **stamps("created", first_filled(F.col("createdDate"), F.col("_createdDate"))),
        **stamps("updated", first_filled(F.col("updatedDate"), F.col("_updatedDate"))),
        "seen": F.col("seen"),
        "fields": last_entries(F.coalesce(entries, F.array())),
    })


def flatten_submissions_long(raw: DataFrame) -> DataFrame:
    """One row per answer; a submission without answers keeps one row with null field."""
    created = first_filled(F.col("createdDate"), F.col("_createdDate"))
    head = shape(raw, {
        **_header(),
        "created_date": stamps("x", created)["x_date"],
        "_answers": F.col("submissions"),
    })
    rows = head.select(
        *[c for c in head.columns if c != "_answers"],
        F.explode_outer("_answers").alias("field_name", "_value"),
    )
    return rows.withColumn("field_value", variant_text(F.col("_value"))).drop("_value")


def pivot_submissions(submissions: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Wide export with one column per ``field_*`` key of ``flatten_submissions_wide``.

    Unless given, all distinct keys are read in a first pass; they are the column names of the
    result, so more than ``MOST_COLUMNS`` are an error. For such tables keep the map, or the
    long form of ``flatten_submissions_long``.
    """
    if keys is None:
        found = submissions.select(F.explode(F.map_keys("fields")).alias("k")).distinct().limit(
            MOST_COLUMNS + 1).collect()
        if len(found) > MOST_COLUMNS:
            raise ValueError(f"more than {MOST_COLUMNS} keys: use flatten_submissions_long")
        keys = sorted(r["k"] for r in found)
    plain = [c for c in submissions.columns if c != "fields"]
    return submissions.select(
        *plain, *[F.element_at("fields", F.lit(k)).alias(k) for k in keys]
    )


def flatten_automations(raw: DataFrame) -> DataFrame:
    """One row per automation with its trigger and actions."""
    trigger = F.col("configuration.trigger")
    actions = F.coalesce(F.col("configuration.actions"), F.array())
    first = F.get(actions, F.lit(0))
    keyed = F.filter(actions, lambda a: F.length(a["actionKey"]) > 0)
    return shape(raw, {
        "automation_id": F.col("id"),
        "name": F.col("name"),
        "description": F.col("description"),
        "status": F.col("status"),
        "origin": F.col("origin"),
        "app_id": F.col("applicationInfo.appDefId"),
        "trigger_key": trigger["triggerKey"],
        "trigger_app_id": trigger["appId"],
        "action_count": F.size(actions),
        "first_action_key": first["actionKey"],
        "first_action_app_id": first["appId"],
        "all_action_keys": F.when(
            F.size(actions) > 0, F.array_join(F.transform(keyed, lambda a: a["actionKey"]), "; ")
        ),
        **stamps("created", first_filled(F.col("createdDate"), F.col("_createdDate"))),
        **stamps("updated", first_filled(F.col("updatedDate"), F.col("_updatedDate"))),
    })
