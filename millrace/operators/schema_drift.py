"""One consistent table from JSON-lines files whose fields drift, and a report of each change.

The schema of every file is gathered from its records in one pass, by partial summaries that merge. Consecutive
files of a feed are compared by tree edit distance. Whether a field that goes and one that comes are the same is decided on all
their values: a second pass gathers the values of such fields, and only of them, and joins count what they have in common.
The scripts, put together along a feed, say under which name a field first came, and are compiled into a
projection of each file onto those names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import Workspace
from ..sources.ship import ship
from . import schema_tree as st
from .skew import short

_FIELD = "path array<string>, kinds array<string>, seen bigint, least double, most double, whole boolean"
_NAMES = ["path", "kinds", "seen", "least", "most", "whole"]


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        files: dict[tuple[str, str], dict] = {}
        for feed, name, raw in zip(b["feed"], b["file_name"], b["raw"], strict=True):
            fields = files.setdefault((feed, name), {(): st.Field()})
            record = st.parse_record(raw)
            if record is not None:
                st.scan(record, fields)
        yield pd.DataFrame([(*k, list(p), sorted(f.kinds), f.seen, *f.numbers, f.whole) for k, fields in files.items() for p, f in fields.items()], columns=["feed", "file_name", *_NAMES])


def _lines(lines: DataFrame) -> DataFrame:
    return lines.where("feed is not null and file_name is not null").select("feed", "file_name", "raw")


def file_fields(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """``feed, file_name`` and, for each field of the file's records, ``path, kinds, seen, least, most, whole``; an empty path stands for the file itself.

    ``lines`` has ``feed, file_name, raw``. Lines that are no JSON objects are no records; a file without records has no
    other fields. Kinds are of non-null values.
    """
    ship(spark)
    parts = _lines(lines).mapInPandas(_summaries, f"feed string, file_name string, {_FIELD}")
    # kinds are five at most, so the sets stay small
    kinds = F.array_sort(F.array_distinct(F.flatten(F.collect_set("kinds"))))
    return parts.groupBy("feed", "file_name", "path").agg(kinds.alias("kinds"), F.sum("seen").alias("seen"), F.min("least").alias("least"), F.max("most").alias("most"), F.bool_and("whole").alias("whole"))


def file_schemas(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """``feed, file_name, fields``: the fields of a file as one row, as large as they are many, not as its records."""
    return file_fields(spark, lines).groupBy("feed", "file_name").agg(F.collect_list(F.struct(*_NAMES)).alias("fields"))


def _tree(fields) -> st.Node:
    return st.tree((tuple(f["path"]), st.Field(set(f["kinds"]), f["seen"], [f["least"], f["most"]], bool(f["whole"]))) for f in fields if len(f["path"]))


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for feed, former, name, old, new in zip(b["feed"], b["former"], b["file_name"], b["before"], b["fields"], strict=True):
            out += [(feed, former, name, p, q) for p, q in st.compared(_tree(old), _tree(new))]
        yield pd.DataFrame(out, columns=["feed", "former", "file_name", "old", "new"])


def _values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        found: set[tuple[str, str, str, str]] = set()
        for feed, name, raw, wanted in zip(b["feed"], b["file_name"], b["raw"], b["wanted"], strict=True):
            record = st.parse_record(raw)
            if record is not None:
                paths = set(wanted)
                for path, value in st.walk(record):
                    at = ".".join(path)
                    if at in paths:
                        found.update((feed, name, at, str(x)) for x in st.singles(value))
        yield pd.DataFrame([(*x, st.shape(x[3])) for x in found], columns=["feed", "file_name", "path", "value", "form"])


def _in_common(work: Workspace, lines: DataFrame, candidates: DataFrame) -> DataFrame:
    """``feed, file_name, shared``: for each file the pairs of ``candidates`` with the distinct values and forms of each side and of both.

    Every value counts, whole. Joins are on file, field and value; a pair has as many rows as its former field has distinct values.
    """
    sides = candidates.select("feed", F.col("former").alias("file_name"), F.col("old").alias("path")).unionByName(candidates.select("feed", "file_name", F.col("new").alias("path")))
    wanted = work.write(sides.groupBy("feed", "file_name").agg(F.collect_set("path").alias("wanted")), "wanted")
    values = _lines(lines).join(short(wanted), ["feed", "file_name"]).mapInPandas(_values, "feed string, file_name string, path string, value string, form string").distinct()
    values = work.write(values, "values")

    def counted(of: str) -> DataFrame:
        distinct = values.select("feed", "file_name", "path", F.col(of).alias("v"))
        distinct = distinct.distinct() if of == "form" else distinct
        sizes = distinct.groupBy("feed", "file_name", "path").agg(F.count(F.lit(1)).alias("n"))
        old = candidates.join(distinct.select("feed", F.col("file_name").alias("former"), F.col("path").alias("old"), "v"), ["feed", "former", "old"])
        both = old.join(distinct.select("feed", "file_name", F.col("path").alias("new"), "v"), ["feed", "file_name", "new", "v"])
        both = both.groupBy(*candidates.columns).agg(F.count(F.lit(1)).alias("both"))
        sized = candidates.join(sizes.select("feed", F.col("file_name").alias("former"), F.col("path").alias("old"), F.col("n").alias("a")), ["feed", "former", "old"])
        sized = sized.join(sizes.select("feed", "file_name", F.col("path").alias("new"), F.col("n").alias("b")), ["feed", "file_name", "new"])
        return sized.join(both, candidates.columns, "left").select(*candidates.columns, F.array("a", "b", F.coalesce("both", F.lit(0))).alias(of))

    pairs = counted("value").join(counted("form"), candidates.columns)
    return pairs.groupBy("feed", "file_name").agg(F.collect_list(F.struct("old", "new", "value", "form")).alias("shared"))


def _scripts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for feed, name, old, new, shared in zip(b["feed"], b["file_name"], b["before"], b["fields"], b["shared"], strict=True):
            known = {(x["old"], x["new"]): st.Shared(tuple(x["value"]), tuple(x["form"])) for x in (shared if shared is not None else ())}
            cost, ops = st.script(_tree(old), _tree(new), known)
            out += [(feed, name, path, kind, to or None, cost) for kind, path, to in ops]
        yield pd.DataFrame(out, columns=["feed", "file_name", "field", "change_kind", "to_field", "cost"])


def schema_changes(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """``feed, file_name, field, change_kind, to_field, cost``: each change at the file where it starts.

    A file is compared with the one before it in its feed, by ``file_name``; the first has none. ``field`` is a dotted
    path, the former one for ``renamed`` and ``moved``. ``cost`` is that of the file's whole script.
    """
    work = Workspace(spark, "drift")
    schemas = work.write(file_schemas(spark, lines), "schemas")
    order = schemas.select("feed", "file_name", F.lag("file_name").over(W.partitionBy("feed").orderBy("file_name")).alias("former")).where("former is not null")
    old = schemas.select("feed", F.col("file_name").alias("former"), F.col("fields").alias("before"))
    pairs = work.write(order.join(schemas, ["feed", "file_name"]).join(old, ["feed", "former"]).select("feed", "former", "file_name", "before", "fields"), "pairs")
    candidates = work.write(pairs.mapInPandas(_candidates, "feed string, former string, file_name string, old string, new string"), "candidates")
    pairs = pairs.join(_in_common(work, lines, candidates), ["feed", "file_name"], "left")
    return pairs.mapInPandas(_scripts, "feed string, file_name string, field string, change_kind string, to_field string, cost double")


def reported(changes: DataFrame) -> DataFrame:
    """Changes by kind of what the records show: a field moved to another parent is removed here and added there."""
    kind, plain = F.col("change_kind"), F.struct("field", "change_kind")
    both = F.array(F.struct("field", F.lit("removed").alias("change_kind")), F.struct(F.col("to_field").alias("field"), F.lit("added").alias("change_kind")))
    return changes.select("feed", "file_name", F.inline(F.when(kind == "moved", both).otherwise(F.array(plain))))


def _at(path: str, top: str) -> bool:
    return path == top or path.startswith(top + ".")


def _end(path: str, names: dict[str, str]) -> None:
    """End what stands in the way of ``path`` as a field of its own: its former mapping and those onto its name, which then are new fields, too."""
    todo = [path]
    while todo:
        new = todo.pop()
        for p in [p for p in names if _at(p, new)]:
            del names[p]
        taken = _first(new, names)
        for p in [p for p, f in names.items() if _at(f, taken) and not _at(new, p)]:
            if p in names:
                del names[p]
                todo.append(p)


def _names(pdf: pd.DataFrame) -> pd.DataFrame:
    """The names in force in each file of one feed that differ from the first ones, as ``{local: first}``.

    A mapping ends with its field, and where its first name is given to a new field.
    """
    current: dict[str, str] = {}  # local path -> the path under which the field first came
    out = []
    for name, ops in pdf.sort_values("file_name", kind="stable").groupby("file_name", sort=True):
        of = lambda *kinds: ops[ops["change_kind"].isin(kinds)]  # noqa: B023, E731
        renames = list(zip(of("renamed", "moved")["field"], of("renamed", "moved")["to_field"], strict=True))
        gone = [*of("removed")["field"], *(old for old, _ in renames)]
        moved: dict[str, str] = {}
        for old, new in renames:
            moved |= {new + p[len(old) :]: f for p, f in current.items() if p.startswith(old + ".")} | {new: _first(old, current)}
        current = {p: f for p, f in current.items() if not any(_at(p, g) for g in gone)} | moved
        for new in of("added")["field"]:
            _end(new, current)
        current = {p: f for p, f in current.items() if p != f}
        out.append((pdf["feed"].iloc[0], name, json.dumps(current)))
    return pd.DataFrame(out, columns=["feed", "file_name", "names"])


def _first(path: str, names: dict[str, str]) -> str:
    """The first name of ``path``, by its longest renamed part."""
    at = path
    while at:
        if at in names:
            return names[at] + path[len(at) :]
        at = at.rpartition(".")[0]
    return path


def projections(spark: SparkSession, lines: DataFrame, changes: DataFrame) -> DataFrame:
    """``feed, file_name, names``: for every file the JSON map from its own names to the first ones, empty where none changed.

    Scripts of a feed are put together in the order of its files; there are as many rows as changes of names, not as records.
    """
    ship(spark)
    named = changes.where("change_kind <> 'type_changed'").select("feed", "file_name", "field", "change_kind", "to_field")
    steps = named.groupBy("feed").applyInPandas(_names, "feed string, file_name string, names string")
    files = lines.select("feed", "file_name").where("feed is not null and file_name is not null").distinct().join(steps, ["feed", "file_name"], "left")
    latest = F.last("names", ignorenulls=True).over(W.partitionBy("feed").orderBy("file_name"))
    return files.select("feed", "file_name", F.coalesce(latest, F.lit("{}")).alias("names"))


def _parts(value: dict, above: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], object]]:
    for k, x in value.items():
        if isinstance(x, dict) and x:
            yield from _parts(x, (*above, k))
        else:
            yield (*above, k), x


def _put(into: dict, path: tuple[str, ...], value) -> bool:
    """Set ``value`` at ``path``, unless something else is there."""
    for k in path[:-1]:
        into = into.setdefault(k, {})
        if not isinstance(into, dict):
            return False
    return into.setdefault(path[-1], value) is value


def _inside(value, path: str, names: dict[str, str]):
    """``value``, an element of the list at ``path``, with the fields of its objects under their first names.

    A field that came into the list from outside it has no place there under its first name and keeps its own.
    """
    if isinstance(value, list):
        return [_inside(x, path, names) for x in value]
    if not isinstance(value, dict):
        return value
    out: dict = {}
    base = _first(path, names) + "."
    for rel, x in _parts(value):
        local = ".".join((path, *rel))
        first = _first(local, names)
        to = tuple(first[len(base) :].split(".")) if first.startswith(base) and first != base + ".".join(rel) else rel
        x = _inside(x, local, names)
        if not _put(out, to, x):
            _put(out, rel, x)
    return out


def _leaves(value, path: str, names: dict[str, str], out: dict[str, str], kinds: dict[str, str]) -> None:
    if isinstance(value, dict) and value:
        for k, x in value.items():
            _leaves(x, f"{path}.{k}" if path else k, names, out, kinds)
    elif value is not None:
        value = _inside(value, path, names) if names and isinstance(value, list) else value
        first = _first(path, names)
        to = path if first in out else first
        out[to] = value if isinstance(value, str) else json.dumps(value)
        whole = isinstance(value, int) and not isinstance(value, bool) and abs(value) < 1 << 63
        kinds[to] = "integer" if whole else st.kind_of(value)


def _project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parsed: dict[str, dict[str, str]] = {}
    for b in batches:
        out = []
        for dataset, feed, name, line, raw, names in b[["dataset", "feed", "file_name", "line_no", "raw", "names"]].itertuples(index=False):
            record = st.parse_record(raw)
            if record is None:
                continue
            if names not in parsed:
                parsed.clear() if len(parsed) > 10_000 else None
                parsed[names] = json.loads(names)
            leaves: dict[str, str] = {}
            kinds: dict[str, str] = {}
            _leaves(record, "", parsed[names], leaves, kinds)
            out.append((dataset, feed, name, line, leaves, kinds))
        yield pd.DataFrame(out, columns=["dataset", "feed", "file_name", "line_no", "fields", "kinds"])


def consistent_table(spark: SparkSession, lines: DataFrame, changes: DataFrame) -> DataFrame:
    """``dataset, feed, file_name, line_no, fields, kinds``: every record, with its fields under the names they first had.

    ``fields`` maps dotted paths to values as text, arrays as JSON whose objects have the first names, too; null values have no entry, objects are given by
    their parts. ``kinds`` has the JSON kind of each, whole numbers as ``integer``. All records are kept; lines that are no JSON objects are none.
    """
    ship(spark)
    columns = ["dataset", "feed", "file_name", "line_no", "raw"]
    named = lines.select(*columns).join(projections(spark, lines, changes), ["feed", "file_name"])
    return named.mapInPandas(_project, "dataset string, feed string, file_name string, line_no bigint, fields map<string,string>, kinds map<string,string>")


#: A table of more columns than this is taken for data whose keys are values.
MOST_COLUMNS = 5_000


def reconciled_types(table: DataFrame) -> DataFrame:
    """``dataset, field, kinds, type``: the kinds that the values of each field have over all files, and the one type that holds them all.

    Whole numbers are ``bigint``, with fractions ``double``, truth values ``boolean``; texts, lists and whatever comes in several kinds are ``string``.
    """
    seen = table.select("dataset", F.explode("kinds").alias("field", "kind")).distinct()
    kinds = seen.groupBy("dataset", "field").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))  # six at most
    only = lambda *k: F.size(F.array_except("kinds", F.array(*map(F.lit, k)))) == 0
    kind = F.when(only("integer"), "bigint").when(only("integer", "number"), "double").when(only("boolean"), "boolean").otherwise("string")
    return kinds.select("dataset", "field", "kinds", kind.alias("type"))


def typed_tables(spark: SparkSession, table: DataFrame) -> dict[str, DataFrame]:
    """One table for each dataset of a :func:`consistent_table`: ``feed, file_name, line_no`` and a column for each field, named by its path and of its reconciled type.

    Every value fits its column, so none is lost. The driver reads the list of fields.
    """
    types = reconciled_types(table).orderBy("dataset", "field").limit(MOST_COLUMNS + 1).collect()
    if len(types) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} fields")
    own = ["feed", "file_name", "line_no"]
    columns: dict[str, list] = {}
    for r in types:
        taken = {c.lower() for c in own} | {x[0].lower() for x in columns.get(r.dataset, ())}
        name = r.field
        while name.lower() in taken:  # columns differ by more than case, and from those of the file
            name += "_"
        columns.setdefault(r.dataset, []).append((name, r.field, r.type))
    return {
        d: table.where(F.col("dataset") == d).select(*own, *(F.try_element_at("fields", F.lit(path)).cast(kind).alias(name) for name, path, kind in fields)) for d, fields in columns.items() if d is not None
    }
