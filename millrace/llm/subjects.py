"""Subject areas of documents, from averaged word and subword embeddings with independent logistic outputs.

Readers name areas for whole documents; a document is about an area if at least a quarter of its sentences that
belong to any area belong to it. So the model scores sentences, and is trained in two passes:

1. On the labelled documents. At first each sentence is to score as its document; then the scores decide
   which of its sentences carry the named areas and which carry none.
2. On these and all unlabelled documents, which the first model has labelled: words that no
   labelled document has are learned from the company they keep.

Each round sums the gradients of all partitions on one shard of the sentences and takes one step on the
driver; what is sent is the model and the gradients, summed up among the executors first where there are many partitions. The
number of rounds is fixed: with the corpus the shards grow in size, and every stage takes each shard once at least, so
every sentence is learned from in every stage. Every document is scored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..sources.shared import Workspace
from ..sources.ship import ship
from . import sentence_model as sm

OTHER = "other"


@dataclass(frozen=True)
class Training:
    """Settings of a fit. At most about ``labelled`` labelled documents are learned from, and all others.

    Sentences are cut into shards of about ``shard`` documents, at least ``shards`` and at most ``most_shards`` of them. All labelled documents
    together weigh as ``unlabelled`` others for each of their number, as if these came in parts of ``unlabelled``.

    A document counts as much as it has sentences, but no more than ``weighed`` of them, so that a very long one
    does not outweigh all others; all its sentences are learned from.
    """

    labelled: int = 20_000
    unlabelled: int = 12_000
    rounds: tuple[int, int, int] = (24, 16, 16)
    rate: float = 0.05
    shards: int = 4
    shard: int = 3_000
    most_shards: int = 16
    partitions: int = 12
    weighed: int = 32


_cache: dict[str, object] = {}


def _once(key: str, make: Callable[[], object]) -> object:
    """``make()``, kept in this Python worker under ``key``."""
    if key not in _cache:
        _cache[key] = make()
    return _cache[key]


def _sample(df: DataFrame, most: int) -> DataFrame:
    """About ``most`` documents, all of them where there are fewer; the same ones each time."""
    there = df.count()
    if there <= most:
        return df
    return df.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < F.lit(int((1 << 30) * most / there)))


def _learnable(docs: DataFrame, how: Training, shards: int, guess: sm.Model | None = None) -> DataFrame:
    """``shard, rows, named, weight``: the sentences of ``doc_id, text, named, counts`` as table rows.

    Where ``named`` is null, the areas are those that ``guess`` finds; a text is read once for both.
    """
    weighed, key = how.weighed, uuid.uuid4().hex
    sent = docs.sparkSession.sparkContext.broadcast(guess) if guess else None

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features: sm.Features = _once("features", sm.Features)  # type: ignore[assignment]
        for b in batches:
            texts = [sm.sentences(t) for t in b["text"]]
            named = list(b["named"])
            blank = [i for i, x in enumerate(named) if x is None]
            if blank:
                scorer: sm.Scorer = _once(key, lambda: sm.Scorer(sent.value))  # type: ignore[assignment, union-attr]
                for i, x in zip(blank, scorer.documents([texts[i] for i in blank]), strict=True):
                    named[i] = x
            out = []
            for parts, areas, counts, at in zip(texts, named, b["counts"], b["at"], strict=True):
                if len(features.rows) > features.most:
                    features.clear()
                weight = counts * min(1.0, weighed / max(1, len(parts)))
                out += [((at + i) % shards, features.sentence_rows(w), np.asarray(areas, np.float32), weight) for i, w in enumerate(parts)]
            yield pd.DataFrame(out, columns=["shard", "rows", "named", "weight"])

    # a document's sentences go to shards in turn, from a place of its own where it may have fewer than there are shards
    at = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(shards)) if shards > how.shards else F.lit(0)
    return docs.select("text", "named", "counts", at.cast("int").alias("at")).mapInPandas(cut, "shard int, rows array<int>, named array<float>, weight float")


_GRADIENT = ["weight", "ids", "t", "o", "b"]
_GRADIENT_SCHEMA = "weight double, ids binary, t binary, o binary, b binary"
#: So many gradients are summed up by the driver; more are first summed up among the executors.
_FEW = 24


def _packed(weight: float, grads: list[np.ndarray]) -> pd.DataFrame:
    ids = np.flatnonzero(grads[0].any(axis=1)).astype(np.int32)
    return pd.DataFrame([(weight, ids.tobytes(), grads[0][ids].tobytes(), grads[1].tobytes(), grads[2].tobytes())], columns=_GRADIENT)


def _summed(parts, areas: int) -> tuple[float, list[np.ndarray]]:
    """The sum of packed gradients, always in the same order, so that it is the same each time."""
    grads = [np.zeros((sm.ROWS, sm.WIDTH), np.float32), np.zeros((sm.WIDTH, areas), np.float32), np.zeros(areas, np.float32)]
    for weight, ids, t, o, b in sorted(parts, key=lambda p: (p[0], bytes(p[4]))):
        grads[0][np.frombuffer(ids, np.int32)] += np.frombuffer(t, np.float32).reshape(-1, sm.WIDTH)
        grads[1] += np.frombuffer(o, np.float32).reshape(sm.WIDTH, areas)
        grads[2] += np.frombuffer(b, np.float32)
    return sum(p[0] for p in parts), grads


def _partitions(spark: SparkSession, how: Training) -> int:
    return max(how.partitions, spark.sparkContext.defaultParallelism)


def _fit(spark: SparkSession, tables: list[DataFrame], areas: int, how: Training) -> sm.Model:
    model, before = sm.Model.new(areas), None
    sc, partitions = spark.sparkContext, _partitions(spark, how)
    for stage, rounds in enumerate(how.rounds):
        adam = sm.Adam(model, how.rate)
        if stage:
            before = sm.Model(*(x.copy() for x in model.parts()))
        for k in range(max(rounds, len(tables))):
            sent = sc.broadcast((model, before))

            def shard_gradient(batches: Iterator[pd.DataFrame], sent=sent, stage=stage) -> Iterator[pd.DataFrame]:
                now, old = sent.value
                total, weight = None, 0.0
                for b in batches:
                    if not len(b):
                        continue
                    batch, named = sm.batch_of(list(b["rows"])), np.stack(list(b["named"]))
                    target, w = (named, np.ones_like(named)) if old is None else sm.retarget(sm.probabilities(old, sm.hidden(old, batch)), named, stage == 1)
                    grads, n = sm.gradient(now, batch, target, w * b["weight"].to_numpy(np.float32)[:, None])
                    total = grads if total is None else [x + y for x, y in zip(total, grads, strict=True)]
                    weight += n
                if total is not None:
                    yield _packed(weight, total)

            def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                parts = [p for b in batches for p in b[_GRADIENT].itertuples(index=False, name=None)]
                if parts:
                    yield _packed(*_summed(parts, areas))

            found = tables[k % len(tables)].mapInPandas(shard_gradient, _GRADIENT_SCHEMA)
            if partitions > _FEW:
                found = found.repartition(math.isqrt(partitions)).mapInPandas(combine, _GRADIENT_SCHEMA)
            parts = [tuple(r) for r in found.collect()]
            sent.destroy()
            if not parts:
                continue
            whole, grads = _summed(parts, areas)
            adam.step(model, [g / whole for g in grads])
    return model


def score(spark: SparkSession, documents: DataFrame, model: sm.Model, columns: list[str]) -> DataFrame:
    """``columns`` of ``documents`` and ``named``: a number for each area, 1 where the text is chiefly about it. Null texts are left out."""
    ship(spark)
    sent, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex
    kept = documents.where(F.col("text").isNotNull()).select(*columns, *([] if "text" in columns else ["text"]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer: sm.Scorer = _once(key, lambda: sm.Scorer(sent.value))  # type: ignore[assignment]
        for b in batches:
            yield b[columns].assign(named=[x.astype(np.float32) for x in scorer.documents([sm.sentences(t) for t in b["text"]])])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*columns).schema)
    return kept.mapInPandas(run, f"{fields}, named array<float>")


def fit_subjects(spark: SparkSession, documents: DataFrame, labels: DataFrame, areas: list[str], how: Training = Training()) -> sm.Model:
    """A model of ``areas`` from ``labels`` (``doc_id, subject``, one row for each area).

    Subjects are read without regard to letter case and outer blanks; those that are no area count as "no area".
    Without labels no text is about anything.
    """
    ship(spark)
    documents = documents.select("doc_id", "text")
    named = labels.select("doc_id", F.lower(blank_to_null(F.col("subject"))).alias("subject")).where("subject is not null")
    named = _sample(named.groupBy("doc_id").agg(F.collect_set("subject").alias("subjects")), how.labelled)
    vector = F.array(*(F.array_contains("subjects", a).cast("float") for a in areas))
    taught = documents.join(named.select("doc_id", vector.alias("named")), "doc_id").where(F.length("text") > 0)

    def tables(work: Workspace, docs: DataFrame, shards: int, guess: sm.Model | None = None) -> list[DataFrame]:
        path = f"{work.path}/sentences"
        _learnable(docs, how, shards, guess).write.partitionBy("shard").mode("overwrite").parquet(path)
        schema = "rows array<int>, named array<float>, weight float, shard int"
        one = spark.read.schema(schema).parquet(path)
        return [one.where(F.col("shard") == s).coalesce(_partitions(spark, how)) for s in range(shards)]

    work = Workspace(spark, "subjects")
    taught = work.write(taught, "taught")
    plain = F.lit(1.0).alias("counts")
    model = _fit(spark, tables(work, taught.select("*", plain).repartition(how.partitions, "doc_id"), how.shards), len(areas), how)
    if how.unlabelled:
        rest = documents.where(F.length("text") > 0).join(taught.select("doc_id"), "doc_id", "left_anti").select("doc_id", "text", F.lit(None).cast("array<float>").alias("named"), plain)
        others = rest.count()
        weight = max(1.0, others / how.unlabelled)  # of a labelled document
        both = rest.unionByName(taught.select("doc_id", "text", "named", F.lit(weight).alias("counts")))
        shards = min(how.most_shards, max(how.shards, math.ceil(others / how.shard)))
        more = Workspace(spark, "subjects")
        model = _fit(spark, tables(more, both, shards, model), len(areas), how)
        more.drop("sentences")
    for name in ("sentences", "taught"):
        work.drop(name)
    return model


def subjects_of(spark: SparkSession, documents: DataFrame, model: sm.Model, areas: list[str]) -> DataFrame:
    """``doc_id, subject``: each area a document is chiefly about; ``other`` where it is about none.

    Documents without tokens (null, empty, nothing but white space) have no row.
    """
    scored = score(spark, documents.where(F.col("text").rlike(r"[^\s\p{Z}\x0b\x1c-\x1f\x85]")), model, ["doc_id"])
    names = F.filter(F.transform(F.arrays_zip("named", F.array(*map(F.lit, areas)).alias("area")), lambda z: F.when(z["named"] > 0, z["area"])), lambda x: x.isNotNull())
    return scored.select("doc_id", F.explode(F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(OTHER)))).alias("subject"))


def composition(subjects: DataFrame, documents: DataFrame) -> DataFrame:
    """Per area the documents about it and their share of all documents that have any subject."""
    whole = subjects.select("doc_id").distinct().agg(F.count(F.lit(1)).alias("whole"))
    counts = subjects.groupBy("subject").agg(F.count(F.lit(1)).alias("documents"))
    return counts.crossJoin(F.broadcast(whole)).select("subject", "documents", (F.col("documents") / F.col("whole")).alias("share"))
