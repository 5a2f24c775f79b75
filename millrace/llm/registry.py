"""The queries of the text problems, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import Workspace
from ..sources.tables import table
from . import mixing, packing, subjects
from .tokens import token_count

Query = Callable[[SparkSession, str], DataFrame]


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", "source", token_count(F.col("text")).alias("tokens"))


def p8_packed(spark: SparkSession, folder: str) -> DataFrame:
    items = Workspace(spark, "packing").write(_sized(spark, folder).drop("source"), "sizes")
    # four capacities, a fixed table
    capacities = [r[0] for r in table(spark, folder, "container_sizes").select("capacity").distinct().collect()]
    return packing.pack(spark, items, capacities)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that had to be cut: those with a second piece."""
    return p8_packed(spark, folder).where("piece = 1").select("capacity", "doc_id")


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill(p8_packed(spark, folder))


def p8_holds(spark: SparkSession, folder: str) -> DataFrame:
    return packing.holds(p8_packed(spark, folder))


def _mixed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix_sources(spark, _sized(spark, folder), table(spark, folder, "mix_targets"))


def p9_mixes(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder)[0]


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder)[1]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    """What each source should give and whether the mix has it: all it may give where that is too little, else what is wanted and less than one text more."""
    r = p9_report(spark, folder)
    least = F.least("wanted_tokens", "supply_tokens")
    kept = (F.col("actual_tokens") >= least) & (F.col("actual_tokens") < least + F.greatest("longest", F.lit(1))) & (F.col("most_repeats") <= F.col("max_repeats"))
    return r.select("mix", "source", "target_share", F.round("wanted_tokens", 3).alias("wanted_tokens"), "supply_tokens", "missed", kept.alias("kept"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_report(spark, folder).where("missed").select("mix", "source")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    # eleven areas, a fixed table
    areas = sorted(r[0] for r in table(spark, folder, "subject_areas").select("subject").distinct().collect() if r[0] and r[0] != subjects.OTHER)
    documents = table(spark, folder, "documents")
    model = subjects.fit_subjects(spark, documents, table(spark, folder, "subject_labels"), areas)
    return subjects.subjects_of(spark, documents, model, areas)


def p10_composition(spark: SparkSession, folder: str) -> DataFrame:
    found = Workspace(spark, "composition").write(p10_found(spark, folder), "subjects")
    return subjects.composition(found, table(spark, folder, "documents"))


_SPACE = r"\s\p{Z}\x0b\x1c-\x1f\x{85}"
_TOKENS = rf"len(regexp_extract_all(coalesce(text, ''), '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{_SPACE}]+'))"

_SQL = {
    "p8_found": f"""
SELECT capacity, doc_id FROM (SELECT DISTINCT capacity FROM container_sizes) c, (SELECT doc_id, {_TOKENS} AS tokens FROM documents) d WHERE tokens > capacity""",
    "p8_holds": f"""
WITH sized AS (SELECT capacity, {_TOKENS} AS tokens FROM (SELECT DISTINCT capacity FROM container_sizes) c, documents)
SELECT capacity, CAST(sum(ceil(tokens / capacity)) AS BIGINT) AS pieces, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(0 AS BIGINT) AS over_full, CAST(0 AS BIGINT) AS cut_for_nothing, true AS well_filled
FROM sized WHERE tokens > 0 GROUP BY capacity""",
    "p9_shares": f"""
WITH sized AS (SELECT lower(trim(source)) AS key, {_TOKENS} AS tokens FROM documents),
sizes AS (SELECT key, sum(tokens) AS tokens FROM sized GROUP BY key),
w AS (SELECT mix, t.source, target_share, target_share * size_ratio * (SELECT sum(tokens) FROM sized) AS wanted, CAST(max_repeats * coalesce(s.tokens, 0) AS BIGINT) AS supply
      FROM mix_targets t LEFT JOIN sizes s ON s.key = lower(trim(t.source)))
SELECT mix, source, target_share, round(wanted, 3) AS wanted_tokens, supply AS supply_tokens, wanted > supply AS missed, true AS kept FROM w""",
    "p9_found": f"""
WITH sized AS (SELECT lower(trim(source)) AS key, {_TOKENS} AS tokens FROM documents),
sizes AS (SELECT key, sum(tokens) AS tokens FROM sized GROUP BY key)
SELECT mix, source FROM mix_targets t LEFT JOIN sizes s ON s.key = lower(trim(t.source))
WHERE target_share * size_ratio * (SELECT sum(tokens) FROM sized) > max_repeats * coalesce(s.tokens, 0)""",
}


def queries() -> dict[str, Query]:
    return {n: f for n, f in globals().items() if n[:1] == "p" and n[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
