"""Checks of what models read and write: drift of texts, prompts, structured outputs, traces; settings, hooks and figures for monitoring."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, fields, replace
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.environment import number_or
from . import checks, datasets, json_schema, numeric_drift, vectors

# Required parts of a verdict and of a prompt, and the names of their checks.
VERDICT_SCHEMA = {
    "type": "object",
    "required": ["verdict_id", "target_ref", "rubric_id", "rubric_version", "scores", "overall_verdict", "overall_score", "confidence", "evaluated_at"],
    "properties": {
        "verdict_id": {"type": "string", "minLength": 1}, "target_ref": {"type": "string", "minLength": 1}, "rubric_id": {"type": "string", "minLength": 1}, "rubric_version": {"type": "string", "minLength": 1},
        "scores": {
            "type": "object", "minProperties": 1,
            "additionalProperties": {"type": "object", "required": ["score", "evidence", "notes"], "properties": {"score": {"type": "integer", "minimum": 1, "maximum": 5}, "evidence": {"type": "array", "items": {"type": "string"}}, "notes": {"type": "string"}}},
        },
        "overall_verdict": {"type": "string", "enum": ["PASS", "FAIL", "WARN"]}, "overall_score": {"type": "number"}, "confidence": {"type": "number", "minimum": 0.0, "maximum": 1.0}, "evaluated_at": {"type": "string"},
    },
}
VERDICT_CHECK, RATE_CHECK, DRIFT_CHECK = "week2.verdict_record.schema", "week2.verdict_record.violation_rate", "week3.extracted_facts.text.embedding_drift"


def prompt_schema(longest: int) -> dict:
    text = {"type": "string", "minLength": 1}
    return {
        "type": "object", "required": ["doc_id", "source_path", "content_preview"], "additionalProperties": False,
        "properties": {"doc_id": text, "source_path": text, "content_preview": {"type": "string", "maxLength": longest}},
    }


@dataclass(frozen=True)
class Settings:
    """Limits of these checks. ``from_environment`` reads ``<PREFIX><NAME>`` for each; what is no number is left as it is."""

    drift_limit: float = 0.15
    sample: int = 200
    rate_multiplier: float = 1.5
    rate_least: float = 0.001
    prompt_length: int = 8000
    features: int = 384

    def __post_init__(self) -> None:
        object.__setattr__(self, "sample", max(1, self.sample))
        object.__setattr__(self, "features", max(16, self.features))

    @classmethod
    def from_environment(cls, prefix: str = "AI_CHECK_", environment: Mapping[str, str] | None = None) -> Settings:
        environment = os.environ if environment is None else environment
        return cls(**{f.name: number_or(environment.get(prefix + f.name.upper()), f.default) for f in fields(cls)})

    def changed(self, **given) -> Settings:
        """With the values given that are not None."""
        return replace(self, **{k: v for k, v in given.items() if v is not None})


def prompts(extractions: DataFrame, longest: int) -> DataFrame:
    """``doc_id, source_path, content_preview``: the prompt of each record, with the start of its first fact; ``longest`` is a limit of the prompt, not of what is read."""
    first = F.coalesce(F.try_element_at("extracted_facts", F.lit(1))["text"], F.lit(""))
    return extractions.select("doc_id", "source_path", F.left(first, F.lit(longest)).alias("content_preview"))


def prompt_check(extractions: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """The prompts to be quarantined, which do not satisfy their schema, and one row ``quarantined_count, status``."""
    made = prompts(extractions, settings.prompt_length)
    bad = made.where(~json_schema.row_valid(made, prompt_schema(settings.prompt_length)))
    n = F.count(F.lit(1))
    return bad, bad.agg(n.alias("quarantined_count"), F.when(n > 0, "FAIL").otherwise("PASS").alias("status"))


def invalid_verdicts(verdicts: DataFrame, schema: dict = VERDICT_SCHEMA) -> Column:
    return ~json_schema.row_valid(verdicts, schema)


def verdict_check(verdicts: DataFrame, baseline_rate: float, settings: Settings = Settings(), schema: dict = VERDICT_SCHEMA) -> DataFrame:
    """``total_outputs, schema_violations, violation_rate, baseline_violation_rate, trend, status``: rising against the baseline is a warning."""
    trend = numeric_drift.counted_trend(verdicts, invalid_verdicts(verdicts, schema), baseline_rate, settings.rate_multiplier, settings.rate_least)
    return trend.select("n", "failures", F.round("rate", 6).alias("violation_rate"), F.lit(round(baseline_rate, 6)).alias("baseline_violation_rate"), "trend", "status").toDF(
        "total_outputs", "schema_violations", "violation_rate", "baseline_violation_rate", "trend", "status"
    )


def verdict_violations(verdicts: DataFrame, contract_id: str, check: DataFrame | None = None, most: int | None = 50, schema: dict = VERDICT_SCHEMA) -> DataFrame:
    """Records for the violation log: one for each invalid verdict, the first ``most`` by id, and one of a rising rate, from ``check`` as of :func:`verdict_check`."""
    bad = verdicts.where(invalid_verdicts(verdicts, schema)).select("verdict_id")
    bad = bad if most is None else bad.orderBy("verdict_id").limit(most)
    row = lambda kind, check_id, severity, n, verdict: [
        F.lit(kind).alias("type"), F.lit(check_id).alias("check_id"), F.lit(severity).alias("severity"), F.lit(contract_id).alias("source_contract_id"), verdict.alias("verdict_id"), n.cast("bigint").alias("records_failing"),
    ]
    rows = bad.select(*row("llm_output_schema", VERDICT_CHECK, "CRITICAL", F.lit(1), F.col("verdict_id")))
    if check is not None:
        rows = rows.unionByName(check.where("trend = 'rising'").select(*row("llm_output_schema_trend", RATE_CHECK, "WARNING", F.col("schema_violations"), F.lit(None).cast("string"))))
    return rows


def sample_texts(texts: DataFrame, column: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` of the texts that are not blank, without replacement, by a seeded draw of their numbers in order; all of them where there are no more.

    The driver draws ``n`` numbers; the texts are numbered by ranges, so none is sorted in one task.
    """
    kept = texts.select(F.trim(column).alias(column)).where(F.length(column) > 0)
    there = kept.count()
    if there <= n:
        return kept
    drawn = np.random.Generator(np.random.PCG64(seed)).choice(there, size=n, replace=False)
    numbers = texts.sparkSession.createDataFrame([(int(i),) for i in drawn], "i bigint")  # n rows
    ordered = kept.repartitionByRange(column).sortWithinPartitions(column).withColumn("m", F.monotonically_increasing_id())
    part, inside = F.shiftright("m", 33), F.col("m").bitwiseAND((1 << 33) - 1)
    sizes = {r.p: r.n for r in ordered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row for each partition
    before, at = {}, 0
    for p in sorted(sizes):
        before[p], at = at, at + sizes[p]
    ahead = texts.sparkSession.createDataFrame(list(before.items()), "p bigint, ahead bigint")
    placed = ordered.withColumn("p", part).join(F.broadcast(ahead), "p").withColumn("i", F.col("ahead") + inside)
    return placed.join(F.broadcast(numbers), "i", "left_semi").select(column)


Embed = Callable[[DataFrame, str], DataFrame]


def hashed(settings: Settings) -> Embed:
    return lambda df, column: vectors.hashed_embeddings(df.select(F.lit(0).alias("_key"), column), "_key", column, settings.features).select("embedding")


def embed_with(df: DataFrame, key: str, text: str, embed: Callable[[list[str]], list[list[float]]], batch: int = 100) -> DataFrame:
    """``key, embedding`` from a function of the caller's, such as a client of a model service, that is given up to ``batch`` texts at once on the executors."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        import pandas as pd

        for b in batches:
            texts = [t or "" for t in b[text]]
            out = [v for i in range(0, len(texts), batch) for v in embed(texts[i : i + batch])]
            yield pd.DataFrame({key: b[key], "embedding": [[float(x) for x in v] for v in out]})

    return df.select(key, text).mapInPandas(run, f"{key} {kind}, embedding array<double>")


def text_drift(texts: DataFrame, column: str, base: DataFrame | None, settings: Settings = Settings(), embed: Embed | None = None) -> tuple[DataFrame, DataFrame]:
    """``drift, status`` of the mean embedding of a sample of texts against a stored one, and the mean itself, ``dim, mean``, to be stored.

    Without ``base``, the first time, the drift is 0 and passes; without texts the status is WARN. A base of other dimensions is compared in those both have.
    """
    found = vectors.centroid((embed or hashed(settings))(sample_texts(texts, column, settings.sample), column), "embedding")
    if base is None:
        some = found.agg(F.count(F.lit(1)).alias("n"))
        return some.select(F.when(F.col("n") > 0, F.lit(0.0)).alias("drift"), F.when(F.col("n") > 0, "PASS").otherwise("WARN").alias("status")), found
    return vectors.cosine_drift(found, base, settings.drift_limit), found


def trace_check(runs: DataFrame, most: int = 30) -> tuple[DataFrame, DataFrame]:
    """``total_traces, checks_failed, status`` of traced calls, and the results that failed, at most ``most``, in order of their ids."""
    results = checks.run_checks(runs, datasets.runs())
    failed = results.where("status = 'FAIL'")
    whole = runs.agg(F.count(F.lit(1)).alias("total_traces")).join(F.broadcast(failed.agg(F.count(F.lit(1)).alias("checks_failed"))))  # two tables of one row
    return whole.withColumn("status", F.when(F.col("checks_failed") > 0, "FAIL").otherwise("PASS")), failed.orderBy("check_id").limit(most)


# States as numbers; what is none of them is -1.
STATES = {"PASS": 0, "WARN": 1, "FAIL": 2, "ERROR": 3}


def monitoring(drift: Mapping, prompt: Mapping, outputs: Mapping, traces: Mapping, settings: Settings, now: str) -> dict:
    """Figures and states of one run, for a dashboard."""
    states = {"embedding_drift": drift, "prompt_input": prompt, "output_schema": outputs, "traces": traces}
    figures = {
        "embedding_drift": drift.get("drift"), "output_violation_rate": outputs.get("violation_rate"), "output_baseline_rate": outputs.get("baseline_violation_rate"), "output_violations": outputs.get("schema_violations"),
        "outputs": outputs.get("total_outputs"), "traces": traces.get("total_traces"), "trace_checks_failed": traces.get("checks_failed"), "prompts_quarantined": prompt.get("quarantined_count"),
    }
    return {
        "version": "1", "timestamp": now, "settings": asdict(settings), "gauges": {k: float(v or 0) for k, v in figures.items()},
        "states": {k: str(v.get("status", "")) for k, v in states.items()}, "codes": {k: STATES.get(str(v.get("status", "")).upper(), -1) for k, v in states.items()}, "trend": str(outputs.get("trend", "")),
    }


class Hooks:
    """Functions that are told of each run's figures; one that fails does not stop the others."""

    def __init__(self) -> None:
        self._hooks: list[Callable[[dict], None]] = []

    def register(self, hook: Callable[[dict], None]) -> None:
        self._hooks.append(hook)

    def tell(self, figures: dict) -> int:
        """How many took it."""
        took = 0
        for hook in self._hooks:
            try:
                hook(figures)
                took += 1
            except Exception:  # a hook is no part of the run
                continue
        return took


def run_all(spark: SparkSession, extractions: DataFrame, verdicts: DataFrame, runs: DataFrame, base: DataFrame | None, baseline_rate: float, now: str, settings: Settings = Settings(), hooks: Hooks | None = None) -> tuple[dict, DataFrame]:
    """The figures of all checks as a document, and the records for the violation log."""
    texts = extractions.select(F.explode("extracted_facts.text").alias("text"))
    drift, _ = text_drift(texts, "text", base, settings)
    _, prompt = prompt_check(extractions, settings)
    outputs = verdict_check(verdicts, baseline_rate, settings)
    traces, failed = trace_check(runs)
    parts = {k: df.first().asDict() for k, df in (("drift", drift), ("prompt", prompt), ("outputs", outputs), ("traces", traces))}
    log = [verdict_violations(verdicts, "verdicts", outputs)]
    log.append(failed.select(F.lit("trace_schema").alias("type"), "check_id", "severity", F.lit("runs").alias("source_contract_id"), F.lit(None).cast("string").alias("verdict_id"), "records_failing"))
    if parts["drift"]["status"] == "FAIL":
        log.append(spark.createDataFrame([("embedding_drift", DRIFT_CHECK, "HIGH", "extractions", None, 1)], log[0].schema))
    document = monitoring(**parts, settings=settings, now=now)
    if hooks:
        hooks.tell(document)
    return document, reduce(DataFrame.unionByName, log)
