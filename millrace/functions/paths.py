"""Paths and times as other tools write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_path(c: Column) -> Column:
    """A path with forward slashes, without outer blanks and without ``file::``."""
    return F.regexp_replace(F.trim(F.regexp_replace(c, r"\\", "/")), "^file::", "")


def node_path(node_id: Column, metadata: Column) -> Column:
    """The path of a file node: that of its metadata, else the one in its id."""
    path = F.try_element_at(metadata, F.lit("path"))
    return F.coalesce(F.when(F.length(F.trim(path)) > 0, plain_path(path)), plain_path(node_id))


def relative_path(c: Column, root: str) -> Column:
    """A path below ``root``, without it and without leading ``./``."""
    path = plain_path(c)
    base = root.rstrip("/") + "/"
    below = F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 30)).otherwise(path)
    return F.regexp_replace(below, r"^(\./)+", "")


def commit_time(c: Column) -> Column:
    """A time as version control prints it, ``2025-01-31 12:00:00 +0100``, in ISO 8601; others as they are."""
    return F.regexp_replace(F.trim(c), r"^(\d{4}-\d{2}-\d{2}) (\d{2}:\d{2}:\d{2}) ([+-]\d{2}):?(\d{2})$", "$1T$2$3:$4")
