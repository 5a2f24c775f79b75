"""Differences between two versions of a declared schema, and whom they concern.

Schemas are flattened to rows ``path, attribute, value``, so many contracts and versions are compared by one full join.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Attributes of a field that are compared, and bounds of shares and of percentages.
ATTRIBUTES = ("type", "required", "format", "pattern", "minimum", "maximum", "minLength", "maxLength", "minItems", "maxItems", "enum")
SHARE, HUNDRED = (-0.001, 1.001), 99


def flatten_schema(schema: dict, at: str = "") -> Iterable[tuple[str, str, str | None]]:
    """``(path, attribute, value)`` of a schema ``{field: spec}``; every field has the attribute ``present``.

    Paths run through ``properties`` and ``items`` by those names; enumerations are compared as sets of texts.
    """
    for name, spec in sorted(schema.items()):
        path = f"{at}.{name}" if at else name
        yield from _flatten_spec(spec if isinstance(spec, dict) else {"type": spec}, path)


def _flatten_spec(spec: dict, path: str) -> Iterable[tuple[str, str, str | None]]:
    yield path, "present", "true"
    for a in ATTRIBUTES:
        if a in spec:
            value = spec[a]
            if a == "enum":
                value = sorted(map(str, value))
            elif a == "required":
                value = bool(value)
            yield path, a, json.dumps(value) if not isinstance(value, str) else value
    for name, inner in sorted((spec.get("properties") or {}).items()):
        yield from _flatten_spec(inner if isinstance(inner, dict) else {}, f"{path}.properties.{name}")
    if isinstance(spec.get("items"), dict):
        yield from _flatten_spec(spec["items"], f"{path}.items")


def schema_rows(spark: SparkSession, schemas: dict[tuple[str, str], dict]) -> DataFrame:
    """``contract_id, version, path, attribute, value`` of schemas by contract and version."""
    rows = [(c, v, *x) for (c, v), s in schemas.items() for x in flatten_schema(s)]
    return spark.createDataFrame(rows, "contract_id string, version string, path string, attribute string, value string")


def diff(rows: DataFrame) -> DataFrame:
    """Changes between each version of a contract and the one before it.

    ``contract_id, version, path, change, attribute, old_value, new_value, breaking``. A field that comes or goes is one change, whatever it
    holds; it is breaking if it goes or comes as required. Any other attribute that changes is breaking, loosened or tightened. A
    range that grows from shares of 0 to 1 to percentages is ``scale_changed`` alone.
    """
    versions = rows.select("contract_id", "version").distinct()
    versions = versions.withColumn("before", F.lag("version").over(W.partitionBy("contract_id").orderBy("version"))).where("before is not null")
    new = versions.join(rows, ["contract_id", "version"]).select("contract_id", "version", "path", "attribute", F.col("value").alias("new_value"))
    old = versions.join(rows.withColumnRenamed("version", "before"), ["contract_id", "before"]).select("contract_id", "version", "path", "attribute", F.col("value").alias("old_value"))
    j = new.join(old, ["contract_id", "version", "path", "attribute"], "full").where("not (old_value <=> new_value)")
    whole = j.where("attribute = 'present'").select("contract_id", "version", "path", F.when(F.col("old_value").isNull(), "added").otherwise("removed").alias("change"))
    inside = whole.select("contract_id", "version", F.col("path").alias("outer"))
    # only the outermost field that comes or goes
    ancestors = F.transform(F.sequence(F.lit(1), F.size(F.split("path", r"\."))), lambda i: F.array_join(F.slice(F.split("path", r"\."), F.lit(1), i), "."))
    listed = whole.withColumn("outer", F.explode_outer(F.filter(ancestors, lambda a: a != F.col("path"))))
    covered = listed.join(inside, ["contract_id", "version", "outer"], "left_semi").select("contract_id", "version", "path").distinct()
    outer = whole.join(covered, ["contract_id", "version", "path"], "left_anti")
    must = j.where("attribute = 'required' and new_value = 'true'").select("contract_id", "version", "path", F.lit(True).alias("must"))
    fields = outer.join(must, ["contract_id", "version", "path"], "left").select(
        "contract_id", "version", "path", "change", F.lit(None).cast("string").alias("attribute"), F.lit(None).cast("string").alias("old_value"), F.lit(None).cast("string").alias("new_value"),
        ((F.col("change") == "removed") | F.coalesce("must", F.lit(False))).alias("breaking"),
    )
    attributes = j.where("attribute <> 'present'").join(whole.select("contract_id", "version", "path"), ["contract_id", "version", "path"], "left_anti")
    number = lambda c, a: F.max(F.when(F.col("attribute") == a, F.col(c).try_cast("double")))
    bounds = rows.where("attribute in ('minimum', 'maximum')")
    before = versions.join(bounds.withColumnRenamed("version", "before"), ["contract_id", "before"]).groupBy("contract_id", "version", "path").agg(number("value", "minimum").alias("a0"), number("value", "maximum").alias("a1"))
    after = bounds.groupBy("contract_id", "version", "path").agg(number("value", "maximum").alias("b1"))
    scale = before.join(after, ["contract_id", "version", "path"]).where((F.col("a0") >= SHARE[0]) & (F.col("a1") <= SHARE[1]) & (F.col("b1") >= HUNDRED)).select("contract_id", "version", "path", F.lit(True).alias("scaled"))
    attributes = attributes.join(scale, ["contract_id", "version", "path"], "left")
    kept = attributes.where("not (coalesce(scaled, false) and attribute = 'minimum')")
    scaled = F.coalesce("scaled", F.lit(False)) & (F.col("attribute") == "maximum")
    return fields.unionByName(kept.select("contract_id", "version", "path", F.when(scaled, "scale_changed").otherwise("changed").alias("change"), "attribute", "old_value", "new_value", F.lit(True).alias("breaking")))


def concerned(changes: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """``contract_id, version, subscriber_id, path, field, reason``: breaking changes that touch a registered field.

    A change touches a field if one is the other or a leading part of it, without ``items`` and ``properties``, or if the field, or any leading part
    of it, is found anywhere in the path. Schemas are compared within their contract, so the pairs are as many as their fields.
    """
    plain = F.regexp_replace(F.regexp_replace("path", r"\.properties\.", "."), r"\.items\.", ".")
    field = F.trim("field")
    heads = F.transform(F.sequence(F.lit(1), F.size(F.split(field, r"\."))), lambda i: F.array_join(F.slice(F.split(field, r"\."), F.lit(1), i), "."))
    # a leading part that is empty says nothing
    hit = F.exists(heads, lambda h: (F.length(h) > 0) & F.contains(F.col("plain"), h)) | F.contains(F.col("path"), field)
    wanted = subscriptions.where(F.length(field) > 0).select("contract_id", "subscriber_id", "field", *([c for c in ("reason",) if c in subscriptions.columns])).distinct()
    rows = changes.where("breaking").select("contract_id", "version", "path", plain.alias("plain"))
    return rows.join(wanted, "contract_id").where(hit).drop("plain").select("contract_id", "version", "subscriber_id", "path", *wanted.columns[2:])


def verdict(changes: DataFrame) -> DataFrame:
    """``contract_id, version, changes, breaking, verdict``."""
    return changes.groupBy("contract_id", "version").agg(F.count(F.lit(1)).alias("changes"), F.count_if("breaking").alias("breaking")).withColumn(
        "verdict", F.when(F.col("breaking") > 0, "BREAKING").otherwise("COMPATIBLE")
    )


def infer_kinds(df: DataFrame, column: str, first: int | None = None, order: str | None = None) -> DataFrame:
    """``key, kinds``: the kinds of the values of each key of a variant object, nulls ignored; of all rows, or of the ``first`` in ``order``."""
    if first is not None and order is None:
        raise ValueError("the first rows are a matter of their order")
    rows = df if first is None else df.orderBy(order).limit(first)
    entries = rows.select(F.explode(F.try_variant_get(F.col(column), "$", "map<string,variant>")).alias("key", "v"))
    kind: Column = F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0)
    return entries.where(~F.is_variant_null("v")).groupBy("key").agg(F.array_sort(F.collect_set(kind)).alias("kinds"))
