"""Conditions on single values that checks are made of. Each is a boolean column, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of identifiers, digests, versions and names.
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}\n?\z"
SHA256 = r"^[a-f0-9]{64}\n?\z"
COMMIT = r"^[a-f0-9]{40}\n?\z"
SEMVER = r"^\d+\.\d+\.\d+(-[0-9A-Za-z.-]+)?(\+[0-9A-Za-z.-]+)?\n?\z"
PASCAL = r"^[A-Z][a-zA-Z0-9]*\n?\z"

_DATE = r"(\d{4}-\d{2}-\d{2}|\d{8}|\d{4}-W\d{2}(-\d)?|\d{4}W\d{2}(\d)?)"
_CLOCK = r"(\d{2}(:?\d{2}(:?\d{2}([.,]\d{1,9})?)?)?)"
_ZONE = r"(Z|[+-]\d{2}(:?\d{2}(:?\d{2}(\.\d+)?)?)?)?"
ISO8601 = rf"^{_DATE}([T ]{_CLOCK}{_ZONE})?\z"


def is_false(c: Column) -> Column:
    """True where the condition is false or unknown."""
    return ~F.coalesce(c, F.lit(False))


def falsy_text(c: Column) -> Column:
    return c.isNull() | (c == "")


def matches(c: Column, pattern: str) -> Column:
    """Full-value match; a null is the text "None", a convention kept for results that must agree."""
    return F.coalesce(c, F.lit("None")).rlike(pattern)


def in_unit_interval(c: Column) -> Column:
    """Numbers of 0 to 1; NaN counts as within, as neither bound is passed."""
    return F.coalesce((F.isnan(c.cast("double"))) | ((c >= 0) & (c <= 1)), F.lit(False))


def moment(c: Column) -> Column:
    """The moment of an ISO 8601 text in the forms that ISO8601 accepts in extended form; else null. No zone is UTC."""
    t = F.when(c.rlike(ISO8601), F.regexp_replace(F.regexp_replace(c, ",", "."), r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3"))
    t = F.regexp_replace(t, r"^(.{10}[T ])(\d{2})(\d{2})(\d{2})", "$1$2:$3:$4")
    day = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.concat(t, F.lit("T00:00:00Z")))
    whole = F.when(t.rlike(r"(Z|[+-]\d{2}(:?\d{2})?)$") & t.rlike("[T ]"), t).otherwise(F.concat(t, F.lit("Z")))
    return F.try_to_timestamp(F.coalesce(day, whole))


def has_zone(c: Column) -> Column:
    return F.coalesce(c.rlike(r"[T ].*(Z|[+-]\d{2}(:?\d{2})?)$"), F.lit(False))


def iso_readable(c: Column) -> Column:
    """True for ISO 8601 dates and times: shape by pattern, calendar by parsing; week dates by shape alone."""
    week = c.rlike(r"^\d{4}-?W(0[1-9]|[1-4]\d|5[0-3])")
    return F.coalesce(c.rlike(ISO8601) & (week | moment(c).isNotNull()), F.lit(False))


def ordered(earlier: Column, later: Column, strict: bool = False) -> Column:
    """True if both can be read, agree on having a zone, and ``later`` is not before (strict: is after) ``earlier``."""
    a, b = moment(earlier), moment(later)
    after = b > a if strict else b >= a
    return F.coalesce(after & (has_zone(earlier) == has_zone(later)), F.lit(False))
