"""Subject areas: sentences, gradients, the parts in Spark, held-out accuracy."""

import random

import numpy as np
import pytest
from conftest import rows
from millrace.llm import sentence_model as sm
from millrace.llm.subjects import Training, composition, fit_subjects, subjects_of
from millrace.llm.tokens import TOKEN, token_count
from pyspark.sql import functions as F

WORDS = {"law": "court judge statute verdict appeal clause plaintiff", "sport": "goal match striker stadium referee league trophy", "energy": "grid turbine reactor voltage fuel boiler substation"}
PLAIN = ["the page was scanned twice", "nobody objected to the wording", "the train of thought breaks off here"]


def make(r, areas, n=8):
    """A text whose sentences of any area are of each of ``areas`` in turn."""
    out = []
    for i in range(n):
        a = areas[i % len(areas)] if areas and r.random() < 0.7 else None
        out.append(" ".join(r.sample(WORDS[a].split(), 3)) + " was noted" if a else r.choice(PLAIN))
    return ". ".join(x.capitalize() for x in out) + "."


def test_tokens(spark):
    import re

    texts = ["a b_1, --c!", "", None, " \t\n", "Ünïté²  ñ’s", "3.14 x", "日本語 テキスト", "é", "a" * 50_000 + " " + "!? " * 1000]
    got = rows(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", token_count(F.col("t"))))
    assert got == [(i, len(re.findall(r"\w+|[^\w\s]+", t or ""))) for i, t in enumerate(texts)]
    assert TOKEN.startswith("[")


def test_sentences():
    assert sm.sentences("1. (p. 8, 0.97) It was instal-\nled. OK?\n\nNext 12 one") == [["p"], ["0", "0", "0", "it", "was", "installed"], ["ok"], ["next", "0", "one"]]
    assert sm.sentences("") == sm.sentences("12. 13!") == []


def test_gradient_is_that_of_the_loss():
    r = np.random.default_rng(0)
    model = sm.Model.new(3)
    lists = [r.integers(0, sm.ROWS, 7).astype(np.int32) for _ in range(4)]
    batch, target, weight = sm.batch_of(lists), r.integers(0, 2, (4, 3)).astype(np.float32), r.random((4, 3)).astype(np.float32)

    def loss():
        p = sm.probabilities(model, sm.hidden(model, batch)).astype(np.float64)
        return -(weight * (target * np.log(p) + (1 - target) * np.log(1 - p))).sum()

    grads, n = sm.gradient(model, batch, target, weight)
    assert n == pytest.approx(weight.sum() / 3)
    for part, g, at in ((model.table, grads[0], (lists[1][2], 5)), (model.out, grads[1], (4, 1)), (model.bias, grads[2], (2,))):
        kept = part[at]
        part[at] = kept + 1e-2
        up = loss()
        part[at] = kept - 1e-2
        down = loss()
        part[at] = kept
        assert (up - down) / 2e-2 == pytest.approx(g[at], rel=2e-2, abs=1e-3)


def test_scorer_equals_the_plain_way():
    r = random.Random(1)
    model, features = sm.Model.new(3), sm.Features()
    texts = [make(r, ["law", "sport"]) for _ in range(5)] + ["", "12", make(r, ["energy"], 300)]
    want = []
    for t in texts:
        s = [features.sentence_rows(w) for w in sm.sentences(t)]
        want.append(list(sm.document_areas(sm.probabilities(model, sm.hidden(model, sm.batch_of(s)))) if s else [False] * 3))
    scorer = sm.Scorer(model, most=10)
    assert [list(x) for x in scorer.documents([sm.sentences(t) for t in texts], at_once=3)] == want


def test_a_quarter_of_the_sentences():
    p = np.zeros((9, 3))
    p[:4, 0], p[4, 1] = 0.9, 0.9
    assert list(sm.document_areas(p)) == [True, False, False]
    p[5, 2] = p[6, 2] = 0.6
    assert list(sm.document_areas(p)) == [True, False, True]
    assert not sm.document_areas(np.zeros((4, 3))).any()


def test_held_out_accuracy_and_edges(spark):
    r = random.Random(2)
    areas, docs, labels, truth = sorted(WORDS), [], [], {}
    for i in range(300):
        mine = r.choice([["law"], ["sport"], ["energy"], ["law", "energy"], []])
        docs.append((i, make(r, mine, 14), 1, "x"))
        truth[i] = set(mine) or {"other"}
        if i % 2:
            labels += [(i, (a.upper() + " "), "reader", "x") for a in truth[i]]
    docs += [(900, None, 1, "x"), (901, "", 1, "x"), (902, " \n", 1, "x"), (903, "?!", 1, "x"), (904, make(r, ["law"], 5000), 1, "x")]
    labels += [(900, "law", "r", "x"), (777, "law", "r", "x"), (1, None, "r", "x"), (1, "astrology", "r", "x")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, named int, subject string")
    how = Training(unlabelled=200, partitions=2, shards=2)
    model = fit_subjects(spark, d, spark.createDataFrame(labels, "doc_id bigint, subject string, labelled_by string, text string"), areas, how)
    found = subjects_of(spark, d, model, areas).cache()
    got: dict[int, set] = {}
    for x in found.collect():
        got.setdefault(x.doc_id, set()).add(x.subject)
    assert got.keys() == truth.keys() | {903, 904} and got[903] == {"other"} and got[904] == {"law"}
    held = [i for i in truth if not i % 2]
    hits, all_ = sum(len(got[i] & truth[i]) for i in held), sum(len(got[i]) + len(truth[i]) for i in held)
    assert 2 * hits / all_ > 0.9
    c = {x.subject: x.documents for x in composition(found, d).collect()}
    assert sum(c.values()) == found.count()


def test_without_labels_or_documents(spark):
    d = spark.createDataFrame([(1, "court judge")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, subject string")
    how = Training(rounds=(1, 1, 1), partitions=1, shards=1)
    assert rows(subjects_of(spark, d, fit_subjects(spark, d, none, ["law"], how), ["law"])) == [(1, "other")]
    assert subjects_of(spark, d.where("false"), fit_subjects(spark, d.where("false"), none, ["law"], how), ["law"]).count() == 0


def test_words_of_unlabelled_documents_are_all_learned(spark, monkeypatch):
    """The second pass sees every document, however many there are."""
    import millrace.llm.subjects as subjects

    seen = []
    fit = subjects._fit
    monkeypatch.setattr(subjects, "_fit", lambda spark, tables, areas, how: seen.append([t.count() for t in tables]) or fit(spark, tables, areas, how))
    d = spark.createDataFrame([(i, "Court judge. Goal match.") for i in range(100)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, "law") for i in range(10)], "doc_id bigint, subject string")
    fit_subjects(spark, d, labels, ["law"], Training(unlabelled=30, shard=30, rounds=(1, 1, 1), partitions=1, shards=1))
    assert sum(seen[0]) == 20 and len(seen[1]) == 3 and sum(seen[1]) == 200 and min(seen[1]) > 20


def test_gradients_summed_among_executors_give_the_same(spark, monkeypatch):
    import millrace.llm.subjects as subjects

    r = random.Random(3)
    d = spark.createDataFrame([(i, make(r, [a])) for i, a in enumerate(sorted(WORDS) * 6)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, a) for i, a in enumerate(sorted(WORDS) * 6)], "doc_id bigint, subject string")
    how = Training(rounds=(3, 1, 1), unlabelled=0, partitions=6, shards=1)
    one = fit_subjects(spark, d, labels, sorted(WORDS), how)
    monkeypatch.setattr(subjects, "_FEW", 2)
    two = fit_subjects(spark, d, labels, sorted(WORDS), how)
    assert all(np.allclose(x, y, atol=1e-4) for x, y in zip(one.parts(), two.parts(), strict=True))
