"""Flat, related tables from deeply nested records.

A target table is a path of arrays below the record. Nested ``transform`` calls attach the record's keys and the
positions on the way down to each innermost element, ``flatten`` joins the arrays of arrays into one, and one
``inline`` emits the rows: one narrow pass per table, without shuffle and without regrouping.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _into(kind: T.DataType, step: str) -> T.DataType:
    """The type of the field that ``step``, dotted through structs, names."""
    for name in step.split("."):
        kind = kind[name].dataType  # type: ignore[index]
    return kind


def _element(schema: T.StructType, path: Sequence[str]) -> T.DataType:
    kind: T.DataType = schema
    for step in path:
        kind = _into(kind, step)
        if isinstance(kind, T.MapType):
            kind = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        kind = kind.elementType if isinstance(kind, T.ArrayType) else kind
    return kind


def _array(schema: T.StructType, path: Sequence[str], c: Column) -> Column:
    """``c``, found at ``path``, as an array: of a map its entries."""
    return F.map_entries(c) if isinstance(_into(_element(schema, path[:-1]), path[-1]), T.MapType) else c


def _field(x: Column, step: str) -> Column:
    for name in step.split("."):
        x = x[name]
    return x


def _plain(kind: T.StructType, above: str = "") -> list[str]:
    """The dotted fields of a struct that are neither arrays nor maps, those of structs inside it too."""
    out: list[str] = []
    for f in kind:
        if isinstance(f.dataType, T.StructType):
            out += _plain(f.dataType, f"{above}{f.name}.")
        elif not isinstance(f.dataType, (T.ArrayType, T.MapType)):
            out.append(above + f.name)
    return out


def _named(fields: Sequence[str]) -> dict[str, str]:
    names = {f.replace(".", "_"): f for f in fields}
    if len({n.lower() for n in names}) < len(fields):
        raise ValueError(f"two fields have one name: {fields}")
    return names


def record_key() -> Column:
    """Tells each record of a table read from Parquet from all others, repetitions of it too: its file and its row there."""
    return F.concat_ws("#", F.col("_metadata.file_name"), F.col("_metadata.row_index").cast("string"))


def _position(step: str) -> str:
    return "pos_" + step.replace(".", "_")


def flatten_table(
    df: DataFrame,
    path: Sequence[str],
    keys: Mapping[str, Column],
    ancestors: Mapping[int, Mapping[str, str]] | None = None,
    columns: Mapping[str, str] | None = None,
    value: str = "value",
) -> DataFrame:
    """The table of the elements of the array at ``path``, as ``["extracted_facts", "entity_refs"]``.

    Where a map is on the path, its entries are the elements, with ``key`` and ``value``; their positions mean nothing.

    ``keys`` are columns of the record by output name. ``ancestors`` takes fields of the elements on the way:
    for level 0, the elements of the first array, ``{"fact_id": "fact_id"}`` (output name: field). Each level
    adds its position, from 0, as ``pos_<array>``. ``columns`` picks fields of the innermost struct (output
    name: field); by default all of them that are no arrays or maps, those of a struct ``s`` as ``s_<field>``. A step
    of ``path`` may lead through structs, as ``"blast_radius.subscribers"``. An element that is not a struct becomes ``value``.

    Null and empty arrays, at any depth, give no rows; null elements of an array of structs give a row of
    nulls with its keys and position. A name that is chosen twice is an error.
    """
    ancestors = ancestors or {}
    inner = _element(df.schema, path)
    if isinstance(inner, T.StructType) and columns is None:
        columns = _named(_plain(inner))

    def level(depth: int, array: Column, carried: list[Column]) -> Column:
        def each(x: Column, i: Column) -> Column:
            here = [*carried, *(_field(x, f).alias(o) for o, f in ancestors.get(depth, {}).items()), i.alias(_position(path[depth]))]
            if depth + 1 < len(path):
                return level(depth + 1, _array(df.schema, path[: depth + 2], _field(x, path[depth + 1])), here)
            last = [_field(x, f).alias(o) for o, f in columns.items()] if isinstance(inner, T.StructType) else [x.alias(value)]
            return F.struct(*here, *last)

        return F.transform(array, each)

    rows = level(0, _array(df.schema, path[:1], F.col(path[0])), [c.alias(n) for n, c in keys.items()])
    for _ in path[1:]:
        rows = F.flatten(F.filter(rows, lambda x: x.isNotNull()))
    names = [*keys, *(n for d in range(len(path)) for n in [*ancestors.get(d, {}), _position(path[d])]), *(columns if isinstance(inner, T.StructType) else [value])]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"a name is chosen twice: {names}")
    return df.select(F.inline(rows))


def paths(schema: T.StructType) -> list[list[str]]:
    """The path of every array and map of a schema, however deep, outer ones first: the flat tables that hold all of it beside the records."""
    out: list[list[str]] = []

    def walk(kind: T.DataType, at: list[str], step: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind:
                walk(f.dataType, at, f"{step}.{f.name}" if step else f.name)
        elif isinstance(kind, (T.ArrayType, T.MapType)):
            here = [*at, step]
            out.append(here)
            walk(kind.elementType if isinstance(kind, T.ArrayType) else T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)]), here, "")

    walk(schema, [], "")
    return out


def record_table(df: DataFrame) -> DataFrame:
    """The records themselves: ``record`` and every field outside arrays and maps, those of a struct ``s`` as ``s_<field>``.

    ``df`` is a table read from Parquet.
    """
    columns = _named(_plain(df.schema))
    if "record" in map(str.lower, columns):
        raise ValueError("the records have a field of the name of their key")
    return df.select(record_key().alias("record"), *(F.col(f).alias(o) for o, f in columns.items()))


def related_tables(df: DataFrame) -> dict[str, DataFrame]:
    """All of a nested table as related flat ones: ``records`` and one for each array and map, named by its path.

    Each holds ``record`` and the positions on its way, by which it joins the table of what lies above it; nothing is left out but
    null and empty arrays. ``df`` is a table read from Parquet. An array directly inside an array is not supported.
    """
    out = {"records": record_table(df)}
    for path in paths(df.schema):
        out[".".join(path)] = flatten_table(df, path, {"record": record_key()})
    return out


def _ids(array: str, field: str) -> Column:
    ids = F.filter(F.transform(F.col(array), lambda e: e[field]), lambda v: v.isNotNull())
    return F.coalesce(ids, F.array().cast("array<string>"))


def dangling_within(
    df: DataFrame, array: str, reference: str, from_field: str, target: Sequence[str], keys: Mapping[str, Column]
) -> DataFrame:
    """References from the structs of ``array`` to ids at ``target`` (array, field) of the same record that are not there.

    ``reference`` is a field of the struct, an array of text. Compared exactly; null references are none,
    and one that a struct repeats comes once. Both sides stay inside their row and are compared by hash, so
    the work is narrow and linear in the size of a record.
    """
    rows = F.transform(
        F.col(array),
        lambda f: F.transform(
            F.array_except(F.filter(f[reference], lambda r: r.isNotNull()), _ids(*target)),
            lambda r: F.struct(*(c.alias(n) for n, c in keys.items()), f[from_field].alias("from_id"), r.alias("to_id")),
        ),
    )
    return df.select(F.inline(F.flatten(F.filter(rows, lambda x: x.isNotNull()))))


def dangling_edges(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Edges of ``edges`` whose source or target is no ``node_id`` of ``nodes`` in the same record; null ends are none."""
    ends = F.flatten(F.transform("edges", lambda e: F.array(e["source"], e["target"])))
    absent = df.withColumn("_absent", F.array_except(F.filter(ends, lambda v: v.isNotNull()), _ids("nodes", "node_id")))
    gone = lambda c: F.coalesce(F.array_contains("_absent", c), F.lit(False))
    rows = F.transform(
        F.filter("edges", lambda e: gone(e["source"]) | gone(e["target"])),
        lambda e: F.struct(*(c.alias(n) for n, c in keys.items()), e["source"].alias("from_id"), e["target"].alias("to_id")),
    )
    return absent.where(F.size("_absent") > 0).select(F.inline(rows))
