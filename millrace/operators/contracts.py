"""Contracts: declared schemas compiled to clauses, quality rules and relational tests, and contracts drawn from data."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import quality
from .checks import RESULT, Clause, run_checks
from .datasets import unique_result
from .matching import missing_references

# JSON type names of Spark types.
_TYPES = {T.StringType: "string", T.BooleanType: "boolean", T.ArrayType: "array", T.StructType: "object", T.MapType: "object", T.DoubleType: "number", T.FloatType: "number", T.DecimalType: "number"}


@dataclass(frozen=True)
class Contract:
    """``schema``: field to spec, with ``required, unique, enum, pattern, minimum, maximum, minLength, maxLength, minItems, maxItems, properties, items``.
    ``rules`` are quality rules as text. ``references`` maps a field to the name of a table and its key."""

    contract_id: str
    schema: dict
    rules: Sequence[str] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    @classmethod
    def from_document(cls, document: dict) -> Contract:
        """From a parsed YAML or JSON document with ``id``, ``schema`` and ``quality``; what has another form is left out."""
        schema = document.get("schema")
        rules = document.get("quality")
        texts = [r for r in rules if isinstance(r, str)] if isinstance(rules, list) else []
        return cls(str(document.get("id", "")), {k: v for k, v in schema.items() if isinstance(v, dict)} if isinstance(schema, dict) else {}, texts)


def _bounds(spec: dict) -> list[tuple[str, str, str, Callable[[Column], Column]]]:
    """``(keyword, kind, expected, condition)`` of values out of bounds; nulls are the matter of ``required``."""
    under, over = (lambda a, b: a < b), (lambda a, b: a > b)
    out: list[tuple[str, str, str, Callable[[Column], Column]]] = []
    for word, test in (("minimum", under), ("maximum", over)):
        if word in spec:
            out.append((word, "range", f"{word} {spec[word]}", lambda v, test=test, b=float(spec[word]): test(v.cast("double"), b)))
    if "enum" in spec:
        members = [str(x) for x in spec["enum"]]
        out.append(("enum", "enum", ", ".join(members), lambda v: ~v.cast("string").isin(*members)))
    if "pattern" in spec:
        out.append(("pattern", "pattern", spec["pattern"], lambda v: ~v.rlike(spec["pattern"])))
    for word, size, test in (("minLength", F.length, under), ("maxLength", F.length, over), ("minItems", F.size, under), ("maxItems", F.size, over)):
        if word in spec:
            out.append((word, "size", f"{word} {spec[word]}", lambda v, size=size, test=test, b=spec[word]: F.when(v.isNotNull(), test(size(v), b))))
    return out


def _total(array: Column, each: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.aggregate(F.transform(array, lambda e: each(e)), F.lit(0).cast("bigint"), lambda a, n: a + n), F.lit(0).cast("bigint"))


def compile_clauses(contract: Contract) -> list[Clause]:
    """The clauses of a contract's schema; nested fields are counted inside their row, for each element of arrays.

    A missing or null required field is an ERROR, a value out of bounds a FAIL. A required field inside an object or element that is
    itself missing does not count. ``unique`` and references need tables; see :func:`validate`.
    """
    clauses: list[Clause] = []

    def yes(c: Column) -> Column:
        return F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))

    def walk(path: str, spec: dict, over) -> None:
        """``over(f)`` is the sum of ``f(value)`` over the values found at ``path`` in one row."""
        name = f"{contract.contract_id}.{path}"
        if spec.get("required"):
            clauses.append(Clause(f"{name}.required", path, "required", over(lambda v: yes(v.isNull())), "present", failing="ERROR"))
        for word, kind, expected, bad in _bounds(spec):
            clauses.append(Clause(f"{name}.{word}", path, kind, over(lambda v, bad=bad: yes(bad(v))), expected))
        for inner, s in (spec.get("properties") or {}).items():
            if isinstance(s, dict):
                walk(f"{path}.{inner}", s, lambda f, inner=inner: over(lambda v: F.when(v.isNotNull(), f(v[inner])).otherwise(0)))
        items = spec.get("items")
        if isinstance(items, dict):
            parts = {k: x for k, x in (items.get("properties") or {}).items() if isinstance(x, dict)}
            for inner, s in parts.items():
                walk(f"{path}[].{inner}", s, lambda f, inner=inner: over(lambda v: _total(v, lambda e: F.when(e.isNotNull(), f(e[inner])).otherwise(0))))
            if not parts:
                walk(f"{path}[]", items, lambda f: over(lambda v: _total(v, f)))

    def top(name: str):
        return lambda f: f(F.col(name))

    for name, spec in contract.schema.items():
        walk(name, spec, top(name))
    return clauses


def validate(df: DataFrame, contract: Contract, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """All results of a contract: its schema in one aggregate, its rules in one, and one small query for each unique or referring field."""
    clauses = compile_clauses(contract)
    parts = [run_checks(df, clauses)] if clauses else []
    for name, spec in contract.schema.items():
        if spec.get("unique"):
            parts.append(unique_result(df, name, f"{contract.contract_id}.{name}.unique"))
    for name, (other, key) in contract.references.items():
        lost = missing_references(df.where(F.col(name).isNotNull()).select(name), F.col(name), (tables or {})[other], key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(run_checks(lost, [Clause(f"{contract.contract_id}.{name}.relationships", name, "relationship", F.col("n"), f"{other}.{key}")]))
    if contract.rules:
        ruled = quality.evaluate(df, list(contract.rules))
        parts.append(
            ruled.select(
                F.concat(F.lit(f"{contract.contract_id}.quality."), F.sha2("rule", 256).substr(1, 8)).alias("check_id"), F.col("rule").alias("column_name"), F.lit("quality").alias("check_type"), "status",
                F.col("observed").alias("actual_value"), F.col("rule").alias("expected"), F.when(F.col("status") == "PASS", "LOW").otherwise("CRITICAL").alias("severity"),
                F.when(F.col("status") == "PASS", 0).otherwise(1).cast("bigint").alias("records_failing"), F.lit(None).cast("array<string>").alias("sample_failing"), F.col("rule").alias("message"),
            )
        )
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT)
    return reduce(DataFrame.unionByName, parts)


def draw_schema(schema: T.StructType) -> dict:
    """The declared schema of a table: types, elements of arrays, parts of objects; integers are told from numbers."""

    def spec(kind: T.DataType) -> dict:
        out: dict = {"type": next((n for t, n in _TYPES.items() if isinstance(kind, t)), "integer" if isinstance(kind, T.IntegralType) else "string")}
        if isinstance(kind, T.StructType):
            out["properties"] = {f.name: spec(f.dataType) for f in kind}
        elif isinstance(kind, T.ArrayType):
            out["items"] = spec(kind.elementType)
        return out

    return {f.name: spec(f.dataType) | ({} if f.nullable else {"required": True}) for f in schema}


def draw_contract(df: DataFrame, contract_id: str, keys: Sequence[str] = ()) -> Contract:
    """A contract that the data keep: types, required where no row is null, ranges of numbers, uniqueness of ``keys``. One aggregate."""
    schema = draw_schema(df.schema)
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    seen = df.agg(
        *(F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(df.columns)), *(F.min(c).cast("double").alias(f"min_{i}") for i, c in enumerate(numbers)),
        *(F.max(c).cast("double").alias(f"max_{i}") for i, c in enumerate(numbers)),
    ).first()
    for i, c in enumerate(df.columns):
        if seen[f"null_{i}"] == 0:
            schema[c]["required"] = True
    for i, c in enumerate(numbers):
        if seen[f"min_{i}"] is not None:
            schema[c] |= {"minimum": seen[f"min_{i}"], "maximum": seen[f"max_{i}"]}
    for c in keys:
        schema[c]["unique"] = True
    return Contract(contract_id, schema)


def relational_tests(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = (), accepted: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """``test, column_name, failures`` of the usual table tests; nulls pass ``unique`` and ``accepted``."""
    one = df.agg(
        *(F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(not_null)),
        *(F.count_if(~F.coalesce(F.col(c).isin(*v), F.lit(True))).alias(f"a{i}") for i, (c, v) in enumerate((accepted or {}).items())), F.lit(0).alias("_"),
    )
    rows = [F.struct(F.lit("not_null").alias("test"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("failures")) for i, c in enumerate(not_null)]
    rows += [F.struct(F.lit("accepted_values").alias("test"), F.lit(c).alias("column_name"), F.col(f"a{i}").alias("failures")) for i, c in enumerate(accepted or {})]
    parts = [one.select(F.inline(F.array(*rows)))] if rows else []
    for c in unique:
        twice = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        parts.append(twice.agg(F.count(F.lit(1)).alias("failures")).select(F.lit("unique").alias("test"), F.lit(c).alias("column_name"), "failures"))
    return reduce(DataFrame.unionByName, parts)
