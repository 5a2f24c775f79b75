"""Quality rules written as text, compiled to aggregates and evaluated in one pass for each path of arrays."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUMBER = r"-?\d+(?:\.\d+)?"
_PATH = r"[A-Za-z_][\w.]*(?:\[\*\][\w.]*)?"
_COMPARE = {">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, "<": lambda a, b: a < b, "=": lambda a, b: a == b}


@dataclass(frozen=True)
class Rule:
    """``observed`` is an aggregate, ``holds`` the condition on it (null counts as broken unless there are no rows)."""

    text: str
    observed: Column
    holds: Column


def _values(path: str) -> tuple[Column, bool]:
    """The column of a dotted path, or for ``a[*].b`` the array of its values."""
    head, star, tail = path.partition("[*]")
    if not star:
        return F.col(path), False
    tail = tail.lstrip(".")
    return (F.transform(F.col(head), lambda e: e[tail]) if tail else F.col(head)), True


def _aggregate(name: str, path: str) -> Column:
    c, many = _values(path)
    if name == "missing_count":
        return F.coalesce(F.sum(F.coalesce(F.size(F.filter(c, lambda v: v.isNull())), F.lit(0)) if many else c.isNull().cast("int")), F.lit(0))
    if name == "duplicate_count":
        if many:
            raise ValueError("duplicates are counted of plain columns")
        return F.count(c) - F.count_distinct(c)
    if name == "cardinality":
        return F.max(F.coalesce(F.size(c), F.lit(0)))
    if many:
        return F.min(F.array_min(c)) if name == "min" else F.max(F.array_max(c))
    return F.min(c) if name == "min" else F.max(c)


def compile_rule(text: str) -> Rule:
    """Read one rule; a form that is not known is an error, not skipped.

    ``row_count >= n``; ``missing_count(x) = 0``, ``duplicate_count(x) = 0``; ``min(x)``, ``max(x)``, ``max(cardinality(x))`` compared with a
    number or with another ``min`` or ``max``; ``x in {a, b}``; ``a = b + c``; ``a >= b`` or ``a >= number`` for every row. Paths may be
    dotted, ``a[*].b`` reaches into an array.
    """
    t = " ".join(text.split())
    sign = r"(>=|<=|=|>|<)"
    if m := re.fullmatch(rf"row_count {sign} (\d+)", t):
        n = F.count(F.lit(1))
        return Rule(t, n, _COMPARE[m[1]](n, int(m[2])))
    if m := re.fullmatch(rf"max\(cardinality\(({_PATH})\)\) {sign} ({_NUMBER})", t):
        n = _aggregate("cardinality", m[1])
        return Rule(t, n, _COMPARE[m[2]](n, float(m[3])))
    if m := re.fullmatch(rf"(missing_count|duplicate_count|min|max)\(({_PATH})\) {sign} ({_NUMBER})", t):
        n = _aggregate(m[1], m[2])
        return Rule(t, n, _COMPARE[m[3]](n, float(m[4])))
    if m := re.fullmatch(rf"(min|max)\(({_PATH})\) {sign} (min|max)\(({_PATH})\)", t):
        a, b = _aggregate(m[1], m[2]), _aggregate(m[4], m[5])
        return Rule(t, a, _COMPARE[m[3]](a, b))
    if m := re.fullmatch(rf"({_PATH}) in \{{(.*)\}}", t):
        members = [x.strip().strip("'\"") for x in m[2].split(",")]
        bad = F.count_if(~F.coalesce(F.col(m[1]).cast("string").isin(*members), F.lit(False)))
        return Rule(t, bad, bad == 0)
    if m := re.fullmatch(rf"({_PATH}) = ({_PATH}) \+ ({_PATH})", t):
        bad = F.count_if(~F.coalesce(F.col(m[1]) == F.try_add(F.col(m[2]), F.col(m[3])), F.lit(False)))
        return Rule(t, bad, bad == 0)
    if m := re.fullmatch(rf"({_PATH}) {sign} ({_NUMBER}|{_PATH})", t):
        right = F.lit(float(m[3])) if re.fullmatch(_NUMBER, m[3]) else F.col(m[3])
        bad = F.count_if(~F.coalesce(_COMPARE[m[2]](F.col(m[1]), right), F.lit(False)))
        return Rule(t, bad, bad == 0)
    raise ValueError(f"not a rule: {text}")


def evaluate(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    """``rule, observed, status`` for each rule, from one aggregate over the table."""
    compiled = [compile_rule(r) for r in rules]
    one = df.agg(*(c.observed.cast("string").alias(f"o{i}") for i, c in enumerate(compiled)), *(c.holds.alias(f"h{i}") for i, c in enumerate(compiled)))
    rows = F.array(
        *(F.struct(F.lit(c.text).alias("rule"), F.col(f"o{i}").alias("observed"), F.when(F.coalesce(f"h{i}", F.col(f"o{i}").isNull()), "PASS").otherwise("FAIL").alias("status")) for i, c in enumerate(compiled))
    )
    return one.select(F.inline(rows))
