"""Made-up datasets of any size with a seed, and the text helpers they are made with. Ids are digests of the seed and the row, so every run gives the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def entity_kind(text: Column) -> Column:
    """What a name is likely to be: an amount, a date, an organisation by its last word, a place by its first, a person of two or three words, else other."""
    words = F.size(F.split(F.trim(text), r"\s+"))
    return (
        F.when(text.rlike(r"[$€£]|\b(USD|EUR|ETB)\b"), "AMOUNT").when(text.rlike(r"\b(19|20)\d{2}\b"), "DATE").when(text.rlike(r"(?i)\b(bank|ministry|authority|agency|ltd|inc|plc|group|board|union|university|company)\b"), "ORG")
        .when(text.rlike(r"(?i)\b(city|region|district|street|county|river)\b"), "LOCATION").when(words.between(2, 3), "PERSON").otherwise("OTHER")
    )


def capitalized_phrases(text: Column, most: int = 8, least: int = 3) -> Column:
    """The first ``most`` different runs of capitalized words of ``least`` characters or more, in order."""
    found = F.regexp_extract_all(text, F.lit(r"\b[A-Z][A-Za-z&\-]+(?:\s+[A-Z][A-Za-z&\-]+)*"), F.lit(0))
    return F.slice(F.array_distinct(F.filter(found, lambda p: F.length(p) >= least)), 1, most)


def truncated(text: Column, most: int) -> Column:
    """The text up to the last whole word within ``most`` characters; whole if it fits."""
    head = F.left(text, F.lit(most))
    return F.when(F.length(text) <= most, text).otherwise(F.when(head.rlike(r"\s"), F.regexp_replace(head, r"\s+\S*$", "")).otherwise(head))


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("/", *(p.cast("string") for p in parts)))
    return F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), F.concat(F.lit("4"), h.substr(14, 3)), F.concat(F.lit("8"), h.substr(18, 3)), h.substr(21, 12))


def _at(i: Column, step: int = 3600) -> Column:
    return F.date_format(F.timestamp_seconds(F.lit(1736510400) + i * step), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def dataset(spark: SparkSession, name: str, rows: int, seed: int = 42) -> DataFrame:
    """``rows`` clean records of ``intents``, ``verdicts``, ``extractions``, ``snapshots``, ``events`` or ``runs``; made where they are used, row by row."""
    i, s = F.col("id"), F.lit(seed)
    draw = lambda k, lo, hi: (F.pmod(F.xxhash64(i, s, F.lit(k)), F.lit(10_001)) / 10_000.0) * (hi - lo) + lo
    whole = lambda k, lo, hi: F.floor(draw(k, lo, hi + 0.999)).cast("bigint")
    pick = lambda k, *of: F.element_at(F.array(*map(F.lit, of)), (F.pmod(F.xxhash64(i, s, F.lit(k)), F.lit(len(of))) + 1).cast("int"))
    base = spark.range(rows)
    if name == "intents":
        ref = F.struct(F.concat(F.lit("src/part_"), i % 9, F.lit(".py")).alias("file"), whole("a", 1, 40).alias("line_start"), (whole("a", 1, 40) + whole("b", 0, 30)).alias("line_end"), F.lit("run").alias("symbol"), F.round(draw("c", 0.55, 0.99), 2).alias("confidence"))
        return base.select(_uuid(s, i, F.lit(name)).alias("intent_id"), F.concat(F.lit("Intent "), i).alias("description"), F.array(ref).alias("code_refs"), F.array(pick("t", "auth", "pii", "billing")).alias("governance_tags"), _at(i).alias("created_at"))
    if name == "verdicts":
        score = lambda k: F.struct(whole(k, 1, 5).alias("score"), F.array(F.lit("line 1")).alias("evidence"), F.lit("").alias("notes"))
        mean = (whole("x", 1, 5) + whole("y", 1, 5)) / 2.0
        return base.select(
            _uuid(s, i, F.lit(name)).alias("verdict_id"), F.concat(F.lit("src/part_"), i % 9, F.lit(".py")).alias("target_ref"), F.sha2(s.cast("string"), 256).alias("rubric_id"), F.lit("1.0.0").alias("rubric_version"),
            F.create_map(F.lit("clarity"), score("x"), F.lit("coverage"), score("y")).alias("scores"), F.when(mean >= 3.5, "PASS").when(mean >= 2.5, "WARN").otherwise("FAIL").alias("overall_verdict"), mean.alias("overall_score"), F.round(draw("c", 0.6, 0.95), 2).alias("confidence"), _at(i).alias("evaluated_at"),
        )
    if name == "extractions":
        who = F.transform(F.sequence(F.lit(0), whole("n", 0, 2).cast("int")), lambda k: F.struct(_uuid(s, i, k).alias("entity_id"), F.concat(F.lit("Board "), k).alias("name"), F.lit("ORG").alias("type"), F.concat(F.lit("board "), k).alias("canonical_value")))
        facts = F.transform(F.sequence(F.lit(0), whole("f", 0, 3).cast("int")), lambda k: F.struct(
            _uuid(s, i, F.lit("fact"), k).alias("fact_id"), F.concat(F.lit("Fact "), k, F.lit(" of record "), i).alias("text"), F.array(_uuid(s, i, F.lit(0))).alias("entity_refs"), F.round(F.lit(0.5) + F.pmod(F.xxhash64(i, k, s), F.lit(50)) / 100.0, 2).alias("confidence"), F.lit(1).cast("bigint").alias("page_ref"), F.lit(None).cast("string").alias("source_excerpt")))
        return base.select(
            _uuid(s, i, F.lit(name)).alias("doc_id"), F.concat(F.lit("docs/"), i, F.lit(".pdf")).alias("source_path"), F.sha2(F.concat_ws("/", s, i), 256).alias("source_hash"), facts.alias("extracted_facts"), who.alias("entities"), F.lit("gpt-extract-1").alias("extraction_model"),
            whole("p", 500, 5000).alias("processing_time_ms"), F.struct(whole("i", 100, 4000).alias("input"), whole("o", 10, 900).alias("output")).alias("token_count"), _at(i).alias("extracted_at"),
        )
    if name == "snapshots":
        nodes = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda k: F.struct(F.concat(F.when(k % 2 == 0, "file::src/part_").otherwise("pipeline::step_"), k).alias("node_id"), F.when(k % 2 == 0, "FILE").otherwise("PIPELINE").alias("type"), k.cast("string").alias("label"), F.create_map(F.lit("path"), F.concat(F.lit("src/part_"), k)).alias("metadata")))
        edges = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda k: F.struct(nodes[k]["node_id"].alias("source"), nodes[k + 1]["node_id"].alias("target"), F.lit("PRODUCES").alias("relationship"), F.lit(0.9).alias("confidence")))
        return base.select(_uuid(s, i, F.lit(name)).alias("snapshot_id"), F.lit("repos/made-up").alias("codebase_root"), F.left(F.sha2(F.concat_ws("/", s, i), 256), F.lit(40)).alias("git_commit"), nodes.alias("nodes"), edges.alias("edges"), _at(i).alias("captured_at"))
    if name == "events":
        payload = F.struct(_uuid(s, i, F.lit("doc")).alias("doc_id"), F.lit("filed").alias("status"), whole("b", 100, 100_000).alias("bytes"))
        meta = F.struct(F.lit(None).cast("string").alias("causation_id"), _uuid(s, i, F.lit("c")).alias("correlation_id"), F.lit("user_1").alias("user_id"), F.lit("intake").alias("source_service"))
        return base.select(_uuid(s, i, F.lit(name)).alias("event_id"), F.lit("DocumentProcessed").alias("event_type"), _uuid(s, i % 7).alias("aggregate_id"), F.lit("Document").alias("aggregate_type"), (F.floor(i / 7) + 1).alias("sequence_number"), payload.alias("payload"), meta.alias("metadata"), F.lit("1.0").alias("schema_version"), _at(i, 60).alias("occurred_at"), _at(i + 1, 60).alias("recorded_at"))
    if name == "runs":
        a, b = whole("a", 10, 900), whole("b", 10, 900)
        return base.select(
            _uuid(s, i, F.lit(name)).alias("id"), F.concat(F.lit("call "), i).alias("name"), pick("k", "llm", "chain", "tool", "retriever", "embedding").alias("run_type"), F.create_map(F.lit("q"), F.lit("x")).alias("inputs"), F.create_map(F.lit("n"), a).alias("outputs"), F.lit(None).cast("string").alias("error"),
            _at(i, 60).alias("start_time"), _at(i + 1, 60).alias("end_time"), (a + b).alias("total_tokens"), a.alias("prompt_tokens"), b.alias("completion_tokens"), F.round(draw("c", 0, 0.2), 4).alias("total_cost"), F.array(F.lit("made-up")).alias("tags"), F.lit(None).cast("string").alias("parent_run_id"), _uuid(s, i % 5).alias("session_id"),
        )
    raise ValueError(f"not a dataset: {name}")


def inject_scale(extractions: DataFrame) -> DataFrame:
    """The fault of a changed scale: confidences above 0 and up to 1 become percentages; others stay as they are."""
    wrong = lambda c: F.when((c > 0) & (c <= 1), F.round(c * 100, 1)).otherwise(c)
    return extractions.withColumn("extracted_facts", F.transform("extracted_facts", lambda f: F.when(f.isNotNull(), f.withField("confidence", wrong(f["confidence"])))))
