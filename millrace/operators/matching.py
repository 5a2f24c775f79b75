"""Joins of findings with a registry of subscriptions, and checks of references between tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a registry may have to be sent to every executor; a larger one is joined by shuffle.
REGISTRY_ROWS = 10_000


# What a check id may start with before its field.
FAMILIES = ("cross.ingest", "cross.week2", "cross.week4", "week1", "week2", "week3", "week4", "week5", "langsmith")


def _small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it is checked to be small."""
    return F.broadcast(df) if df.limit(REGISTRY_ROWS + 1).count() <= REGISTRY_ROWS else df


def check_tail(check_id: Column, families: Sequence[str] = FAMILIES) -> Column:
    """A check id without the family it starts with."""
    names = "|".join(f.replace(".", r"\.") for f in families)
    return F.regexp_replace(F.trim(check_id), rf"^({names})\.", "")


def field_concerns_check(field: Column, check_id: Column, families: Sequence[str] = FAMILIES) -> Column:
    """Whether a registered field is concerned by a failing check.

    It is if the check's tail is the field or a part of it, or lies under the same top field, or if the id holds the
    field anywhere. A blank field concerns nothing.
    """
    field, tail, dot = F.trim(field), check_tail(check_id, families), F.lit(".")
    under = lambda c: tail.startswith(F.concat(c, dot))
    return (F.length(field) > 0) & ((tail == field) | under(field) | under(F.substring_index(field, ".", 1)) | F.contains(F.trim(check_id), field))


def concerned_subscribers(violations: DataFrame, subscriptions: DataFrame, families: Sequence[str] = FAMILIES) -> DataFrame:
    """``violation_id, subscriber_id, fields, matched``: who must be told of each violation, with the registered fields and their reasons.

    ``violations``: ``violation_id, contract_id, check_id``; ``subscriptions``: one row for each ``contract_id, subscriber_id, field, reason``.
    An equi-join on the contract with the rule as its condition; both arrays are as long as a subscription has fields.
    """
    j = violations.join(_small(subscriptions), "contract_id").where(field_concerns_check(F.col("field"), F.col("check_id"), families))
    matched = F.array_sort(F.collect_set(F.struct("field", "reason")))
    return j.groupBy("violation_id", "subscriber_id").agg(F.array_sort(F.collect_set("field")).alias("fields"), matched.alias("matched"))


def subscriber_summaries(violations: DataFrame, subscriptions: DataFrame, families: Sequence[str] = FAMILIES) -> DataFrame:
    """``violation_id, subscribers``: for each violation the subscribers to be told, in order of their ids, as
    ``subscriber_id, subscriber_team, validation_mode, contact, matched_breaking_fields``; a violation that concerns nobody has an empty array."""
    who = subscriptions.groupBy("contract_id", "subscriber_id").agg(*(F.min(c).alias(c) for c in ("subscriber_team", "validation_mode", "contact")))
    found = concerned_subscribers(violations, subscriptions, families).join(violations.select("violation_id", "contract_id"), "violation_id")
    found = found.join(_small(who), ["contract_id", "subscriber_id"])
    entry = F.struct("subscriber_id", "subscriber_team", "validation_mode", "contact", F.col("matched").alias("matched_breaking_fields"))
    told = found.groupBy("violation_id").agg(F.array_sort(F.collect_list(entry)).alias("subscribers"))
    return violations.select("violation_id").join(told, "violation_id", "left").withColumn("subscribers", F.coalesce("subscribers", F.array().cast(told.schema["subscribers"].dataType)))


def missing_references(rows: DataFrame, reference: Column, known: DataFrame, key: str) -> DataFrame:
    """Rows whose reference is not among ``known[key]``; a null reference is missing. An anti-join that the planner may broadcast."""
    ids = known.select(F.col(key).alias("_known")).where("_known is not null").distinct()
    return rows.withColumn("_reference", reference).join(ids, F.col("_reference") == F.col("_known"), "left_anti").drop("_reference")


def longest_prefix(rows: DataFrame, text: str, weights: DataFrame) -> DataFrame:
    """``rows`` with the ``weight`` of the longest ``prefix`` in ``weights`` that ``text`` starts with; 1 where there is none.

    Every prefix of each distinct text is looked up, an equi-join, so no pairs that do not match are made.
    """
    w = weights.groupBy("prefix").agg(F.max("weight").alias("w"))
    texts = rows.select(text).where(F.col(text).isNotNull()).distinct()
    heads = texts.select(text, F.explode(F.sequence(F.lit(0), F.length(text))).alias("n")).withColumn("prefix", F.left(F.col(text), F.col("n")))
    best = heads.join(_small(w), "prefix").groupBy(text).agg(F.max_by("w", "n").alias("w"))
    return rows.join(best, text, "left").withColumn("weight", F.coalesce("w", F.lit(1.0))).drop("w")


# Modes of a subscription.
MODES = ("AUDIT", "WARN", "ENFORCE")


def invalid_subscriptions(subscriptions: DataFrame, contracts: DataFrame | None = None) -> DataFrame:
    """``subscription, problem``: what is wrong with subscriptions, by eight rules on their form and, given ``contracts``, that their contract is known.

    ``subscriptions`` has a number ``subscription``, ``contract_id, subscriber_id, subscriber_team, fields_consumed`` (an array), ``validation_mode, contact`` and
    ``breaking_fields`` (an array of ``field, reason``), one row each.
    """
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    some = lambda array, bad: F.coalesce(F.exists(array, bad), F.lit(False))
    rows = subscriptions
    known = F.lit(True)
    if contracts is not None:
        rows = rows.join(contracts.select("contract_id", F.lit(True).alias("_known")).distinct(), "contract_id", "left")
        known = F.coalesce("_known", F.lit(False))
    empty = lambda c: F.coalesce(F.size(c), F.lit(0)) < 1
    problem = F.array(
        F.when(blank("contract_id"), "no contract_id").when(~known, "unknown contract_id"), F.when(blank("subscriber_id"), "no subscriber_id"), F.when(blank("subscriber_team"), "no subscriber_team"),
        F.when(empty("fields_consumed") | some("fields_consumed", blank), "fields_consumed is empty or holds a blank"),
        F.when(~F.coalesce(F.upper(F.trim("validation_mode")).isin(*MODES), F.lit(False)), "unknown validation_mode"), F.when(blank("contact"), "no contact"),
        F.when(empty("breaking_fields"), "no breaking_fields"),
        F.when(some("breaking_fields", lambda b: blank(b["field"])), "a breaking field without field"), F.when(some("breaking_fields", lambda b: blank(b["reason"])), "a breaking field without reason"),
    )
    return rows.select("subscription", F.explode(F.filter(problem, lambda p: p.isNotNull())).alias("problem"))
