"""Sizes of texts in tokens of the public word-and-punctuation tokenizer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"\s\p{Z}\x0b\x1c-\x1f\x85"
#: A longest run of letters, digits and underscores, or a longest run of other characters that are not white space.
TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{_SPACE}]+"


def token_count(text: Column) -> Column:
    """Tokens of the whole text as a bigint; 0 for null and empty texts."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)).cast("bigint"), F.lit(0).cast("bigint"))
