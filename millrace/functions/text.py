"""Columns for identifiers and times held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?\s?(Z|z|[+-]\d{2}:?\d{2})?$"
_BASIC = r"^(\d{4})(\d{2})(\d{2})[T ]?(\d{2})(\d{2})(\d{2})(\.\d+)?(Z|[+-]\d{2}:?\d{2})?$"


def blank_to_null(c: Column) -> Column:
    """The text without outer white space; null where nothing is left."""
    t = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.when(F.length(t) > 0, t)


def instant(c: Column) -> Column:
    """The moment that a text names, or null where it cannot be read.

    Read are ISO 8601 in extended and basic form, with ``T`` or a blank, with or without fraction and
    offset, and epoch seconds or milliseconds. Without an offset the time is UTC, whatever the time zone
    of the session.
    """
    t = F.trim(c)
    iso = F.when(t.rlike(r"(Z|z|[+-]\d{2}:?\d{2})$"), t).otherwise(F.concat(t, F.lit("Z")))
    basic = F.regexp_replace(t, _BASIC, "$1-$2-$3T$4:$5:$6$7$8")
    basic = F.when(basic.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), basic).otherwise(F.concat(basic, F.lit("Z")))
    return (
        F.when(t.rlike(_ISO), F.try_to_timestamp(iso))
        .when(t.rlike(r"^\d{12,13}$"), F.timestamp_millis(F.expr("0L") + t.try_cast("bigint")))
        .when(t.rlike(r"^\d{9,10}$"), F.timestamp_seconds(t.try_cast("bigint")))
        .when(t.rlike(_BASIC), F.try_to_timestamp(basic))
    )


def uuid_key(c: Column) -> Column:
    """A binary key that is equal for all spellings of one UUID (case, braces, ``urn:uuid:``, no hyphens, blanks).

    Sixteen bytes for a UUID; any other text keeps its own bytes, without outer blanks, after sixteen
    zero bytes, so the two kinds cannot meet. Null for null and blank.
    """
    t = blank_to_null(c)
    digits = F.regexp_replace(F.lower(t), r"^urn:uuid:|^\{|\}$|-", "")
    return F.when(digits.rlike(r"^[0-9a-f]{32}$"), F.unhex(digits)).otherwise(
        F.concat(F.unhex(F.lit("0" * 32)), F.encode(t, "UTF-8"))
    )


def packed_id(c: Column) -> Column:
    """A binary key for an id of which only letter case and outer blanks do not matter; half as long for a UUID."""
    t = F.lower(blank_to_null(c))
    return F.when(
        t.rlike(r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"), F.unhex(F.regexp_replace(t, "-", ""))
    ).otherwise(F.concat(F.unhex(F.lit("0" * 32)), F.encode(t, "UTF-8")))


def unpacked_id(c: Column) -> Column:
    """The lower-case id of a :func:`packed_id`."""
    h = F.lower(F.hex(c))
    return F.when(
        F.octet_length(c) == 16,
        F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4), h.substr(21, 12)),
    ).otherwise(F.decode(F.substring(c, 17, 1 << 30), "UTF-8"))
