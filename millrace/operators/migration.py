"""What a breaking schema change asks of its consumers: failure modes, a checklist and a way back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import contract_diff


def failure_modes(changes: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """``contract_id, version, subscriber_id, fields, scale_changed, mode``: a row for each subscriber of a contract with a breaking change.

    ``fields`` are the registered fields that a change touches. The mode says whether such a field will fail its checks, whether values are likely to be a
    hundred times off, or that nothing registered is touched and all checks are to be run again.
    """
    hits = contract_diff.concerned(changes, subscriptions).groupBy("contract_id", "version", "subscriber_id").agg(F.array_sort(F.collect_set("field")).alias("fields"))
    broken = changes.where("breaking").groupBy("contract_id", "version").agg(F.max(F.col("change") == "scale_changed").alias("scale_changed"))
    all_ = broken.join(subscriptions.select("contract_id", "subscriber_id").distinct(), "contract_id").join(hits, ["contract_id", "version", "subscriber_id"], "left")
    fields = F.coalesce("fields", F.array().cast("array<string>"))
    mode = F.concat_ws("; ", F.when(F.size(fields) > 0, F.concat(F.lit("checks fail on "), F.array_join(fields, ", "))), F.when(F.col("scale_changed"), "values may be a hundred times off"))
    mode = F.when(F.length(mode) > 0, mode).otherwise("no registered field is touched; run all checks again")
    return all_.select("contract_id", "version", "subscriber_id", fields.alias("fields"), "scale_changed", mode.alias("mode"))


def checklist(changes: DataFrame, contract_id: str, version: str, most: int = 12) -> list[dict]:
    """What is to be done before a version is rolled out: a change of scale first, then at most ``most`` breaking fields in order; one general task if there is none."""
    mine = changes.where((F.col("contract_id") == contract_id) & (F.col("version") == version) & F.col("breaking"))
    scale = not mine.where("change = 'scale_changed'").isEmpty()
    fields = [r.path for r in mine.select("path").distinct().orderBy("path").limit(most).collect()]
    tasks = [{"task": "Agree on one scale: shares of 0 to 1 or percentages.", "owner": "platform"}] if scale else []
    tasks += [{"task": f"Adapt readers of {f}.", "owner": "consumers"} for f in fields]
    return tasks or [{"task": "Agree on a date with all consumers.", "owner": "platform"}]


def way_back(changes: DataFrame, contract_id: str, version: str) -> dict[str, list[str]]:
    """Sections of a plan to go back to the version before; a change of scale adds one of its own, a critical one an escalation."""
    mine = changes.where((F.col("contract_id") == contract_id) & (F.col("version") == version) & F.col("breaking"))
    if mine.isEmpty():
        return {"summary": ["Nothing breaks; there is no need to go back."]}
    scale = not mine.where("change = 'scale_changed'").isEmpty()
    plan = {
        "summary": [f"Take {contract_id} back to the version before {version}."], "producer": ["Pin the producer to its last release.", "Hold back new batches."], "consumers": ["Tell the registered subscribers."],
        "data": ["Quarantine batches that were written since."], "verification": ["Run all checks; none that is critical may fail."], "records": ["Keep both versions and their difference."],
    }
    if scale:
        plan |= {"scale": ["Convert at one place only.", "Draw new baselines."], "escalation": ["A change of scale is critical: tell the owner of the platform."]}
    return plan


def impact(changes: DataFrame, subscriptions: DataFrame, contract_id: str, version: str) -> dict:
    """The whole report on one version as a document."""
    mine = changes.where((F.col("contract_id") == contract_id) & (F.col("version") == version))
    breaking = sorted({r.path for r in mine.where("breaking").select("path").collect()})  # as many as the schema has fields
    modes = [r.asDict() for r in failure_modes(mine, subscriptions.where(F.col("contract_id") == contract_id)).orderBy("subscriber_id").collect()] if breaking else []
    plan = way_back(changes, contract_id, version)
    return {
        "contract_id": contract_id, "version": version, "compatibility_verdict": "BREAKING" if breaking else "COMPATIBLE", "breaking_fields": breaking, "migration_checklist": checklist(changes, contract_id, version) if breaking else [],
        "rollback_plan": " ".join(x for part in plan.values() for x in part), "rollback_plan_sections": plan, "consumers": modes,
    }
