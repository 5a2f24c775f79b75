"""A subset of JSON Schema compiled to a condition on a VARIANT column or on a typed one. Unknown keywords are errors; ``format`` only informs."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEYWORDS = {
    "type", "required", "properties", "additionalProperties", "enum", "minimum", "maximum", "minLength", "maxLength", "pattern", "items", "minItems", "maxItems", "minProperties",
    "format", "title", "description", "$schema", "$id",
}


def _all(conditions: list[Column]) -> Column:
    return reduce(and_, conditions) if conditions else F.lit(True)


def _kind(v: Column) -> Column:
    """The JSON kind of a variant; null where the value is absent."""
    s = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit(None)).when(F.is_variant_null(v), "null").when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array")
        .when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when(s == "BIGINT", "integer").otherwise("number")
    )


def _number(v: Column) -> Column:
    return F.when(_kind(v).isin("integer", "number"), F.try_variant_get(v, "$", "double"))


def _of_type(v: Column, name: str) -> Column:
    kind = _kind(v)
    if name == "integer":  # 5.0 is a whole number, true is none
        return (kind == "integer") | ((kind == "number") & (_number(v) == F.floor(_number(v))))
    if name == "number":
        return kind.isin("integer", "number")
    return kind == name


def _known(schema: dict) -> None:
    if unknown := schema.keys() - _KEYWORDS:
        raise ValueError(f"keywords that are not known: {sorted(unknown)}")


def _static_kind(kind: T.DataType) -> str:
    for of, name in (((T.StructType, T.MapType), "object"), (T.ArrayType, "array"), (T.BooleanType, "boolean"), (T.IntegralType, "integer"), (T.NumericType, "number")):
        if isinstance(kind, of):
            return name
    return "string"


def typed_valid(c: Column, kind: T.DataType, schema: dict | bool) -> Column:
    """Whether a value that is there satisfies ``schema``, as :func:`valid` of its JSON without null fields, but on the columns themselves.

    The kind is known when the plan is made, so only what depends on the value is left to be computed. A null field is absent; null elements
    and null values of maps are JSON nulls.
    """
    if isinstance(schema, bool):
        return F.lit(schema)
    _known(schema)
    name = _static_kind(kind)
    tests: list[Column] = []
    number = name in ("integer", "number")

    def null_or(v: Column, of: T.DataType, inner: dict | bool) -> Column:
        """For elements and values of maps, which may be JSON nulls."""
        nulls = isinstance(inner, bool) and inner or isinstance(inner, dict) and ("type" not in inner or "null" in inner["type"]) and ("enum" not in inner or None in inner["enum"])
        return F.when(v.isNull(), F.lit(bool(nulls))).otherwise(F.coalesce(typed_valid(v, of, inner), F.lit(False)))

    if "type" in schema:
        names = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        if name not in names and not (name == "integer" and "number" in names):
            tests.append(c == F.floor(c) if name == "number" and "integer" in names else F.lit(False))
    if "enum" in schema:
        same = [e for e in schema["enum"] if e is not None and (isinstance(e, bool) == (name == "boolean")) and (isinstance(e, str) == (name == "string"))]
        tests.append(c.isin(*same) if same else F.lit(False))
    if number and "minimum" in schema:
        tests.append(c >= schema["minimum"])
    if number and "maximum" in schema:
        tests.append(c <= schema["maximum"])
    if name == "string":
        text = c.cast("string")
        tests += [F.length(text) >= schema["minLength"]] if "minLength" in schema else []
        tests += [F.length(text) <= schema["maxLength"]] if "maxLength" in schema else []
        tests += [text.rlike(schema["pattern"])] if "pattern" in schema else []
    if name == "array":
        tests += [F.forall(c, lambda e: null_or(e, kind.elementType, schema["items"]))] if "items" in schema else []  # type: ignore[attr-defined]
        tests += [F.size(c) >= schema["minItems"]] if "minItems" in schema else []
        tests += [F.size(c) <= schema["maxItems"]] if "maxItems" in schema else []
    properties, others = schema.get("properties", {}), schema.get("additionalProperties", True)
    if isinstance(kind, T.StructType):
        fields = {f.name: f.dataType for f in kind}
        there = lambda n: c[n].isNotNull()
        tests += [there(n) if n in fields else F.lit(False) for n in schema.get("required", [])]
        for n, of in fields.items():
            inner = properties.get(n, others)
            if inner is not True:
                tests.append(~there(n) | F.coalesce(typed_valid(c[n], of, inner), F.lit(False)))
        if "minProperties" in schema:
            tests.append(sum((there(n).cast("int") for n in fields), F.lit(0)) >= schema["minProperties"])
    elif isinstance(kind, T.MapType):
        tests += [F.coalesce(F.map_contains_key(c, n), F.lit(False)) for n in schema.get("required", [])]
        for n, inner in properties.items():
            tests.append(~F.map_contains_key(c, n) | null_or(F.element_at(c, n), kind.valueType, inner))
        if others is not True:
            rest = F.filter(F.map_entries(c), lambda e: ~e["key"].isin(*properties)) if properties else F.map_entries(c)
            tests.append(F.forall(rest, lambda e: null_or(e["value"], kind.valueType, others)))
        if "minProperties" in schema:
            tests.append(F.size(c) >= schema["minProperties"])
    return F.coalesce(_all(tests), F.lit(False))


def column_valid(df, column: str, schema: dict) -> Column:
    """Whether ``column`` of ``df`` satisfies ``schema``; false where it is null."""
    return F.col(column).isNotNull() & typed_valid(F.col(column), df.schema[column].dataType, schema)


def row_valid(df, schema: dict) -> Column:
    """Whether each row of ``df``, as an object of its columns, satisfies ``schema``."""
    return typed_valid(F.struct(*df.columns), df.schema, schema)


def valid(v: Column, schema: dict | bool) -> Column:
    """Whether the variant ``v``, which is there, satisfies ``schema``. Never null."""
    if isinstance(schema, bool):
        return F.lit(schema)
    _known(schema)
    kind, tests = _kind(v), []
    unless = lambda k, c: (kind != k) | c  # noqa: E731  a keyword holds for other kinds
    if "type" in schema:
        names = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        tests.append(reduce(lambda a, b: a | b, (_of_type(v, n) for n in names)))
    if "enum" in schema:
        same = [
            (kind == "null") if e is None else (kind == "boolean") & (F.try_variant_get(v, "$", "boolean") == e) if isinstance(e, bool)
            else (kind == "string") & (F.try_variant_get(v, "$", "string") == e) if isinstance(e, str) else F.coalesce(_number(v) == float(e), F.lit(False))
            for e in schema["enum"]
        ]
        tests.append(reduce(lambda a, b: a | b, same, F.lit(False)))
    for word, test in (("minimum", lambda a, b: a >= b), ("maximum", lambda a, b: a <= b)):
        if word in schema:
            tests.append(~kind.isin("integer", "number") | F.coalesce(test(_number(v), float(schema[word])), F.lit(False)))
    text = F.try_variant_get(v, "$", "string")
    if "minLength" in schema:
        tests.append(unless("string", F.length(text) >= schema["minLength"]))
    if "maxLength" in schema:
        tests.append(unless("string", F.length(text) <= schema["maxLength"]))
    if "pattern" in schema:
        tests.append(unless("string", text.rlike(schema["pattern"])))
    fields = F.try_variant_get(v, "$", "map<string,variant>")
    properties = schema.get("properties", {})
    for name in schema.get("required", []):
        tests.append(unless("object", F.map_contains_key(fields, name)))
    for name, inner in properties.items():
        tests.append(unless("object", ~F.map_contains_key(fields, name) | F.coalesce(valid(F.element_at(fields, name), inner), F.lit(False))))
    others = schema.get("additionalProperties", True)
    if others is not True:
        rest = F.filter(F.map_entries(fields), lambda e: ~e["key"].isin(*properties)) if properties else F.map_entries(fields)
        tests.append(unless("object", F.forall(rest, lambda e: F.coalesce(valid(e["value"], others), F.lit(False)))))
    if "minProperties" in schema:
        tests.append(unless("object", F.size(fields) >= schema["minProperties"]))
    elements = F.try_variant_get(v, "$", "array<variant>")
    if "items" in schema:
        tests.append(unless("array", F.forall(elements, lambda e: F.coalesce(valid(e, schema["items"]), F.lit(False)))))
    if "minItems" in schema:
        tests.append(unless("array", F.size(elements) >= schema["minItems"]))
    if "maxItems" in schema:
        tests.append(unless("array", F.size(elements) <= schema["maxItems"]))
    return F.coalesce(_all(tests), F.lit(False))


def text_valid(raw: Column, schema: dict) -> Column:
    """Whether a JSON text is readable and satisfies ``schema``; false for null and unreadable text."""
    v = F.try_parse_json(raw)
    return v.isNotNull() & F.coalesce(valid(v, schema), F.lit(False))
