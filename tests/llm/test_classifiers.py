import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanlens.llm import language, toxicity

DOCS = "doc_id long, text string, lang string, source string, score double, accepted string"
SF = "/root/testdata/sf0.1"


def odd_rows():
    return [(-1, None, "en", None, 1.0, None), (-2, "", "xx", None, None, None), (-3, "123 456!", None, None, None, "a"),
            (None, "the and of", None, "s", None, None), (-4, "É" * 200_000, "fr", None, None, None), (-4, "the the", "en", None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").withColumns(
        {"score": F.lit(None).cast("double"), "accepted": F.lit("x")}
    )


def test_language_accuracy_and_odd_rows(spark, docs):
    model = language.train(docs)
    assert model.languages == ["de", "en", "es", "fr"]
    both = docs.unionByName(spark.createDataFrame(odd_rows(), DOCS))
    out = language.predict(both, model)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score", "accepted"]
    joined = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in joined]) > 0.98
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in joined)
    odd = {r.doc_id: r for r in out.where("doc_id < 0 or doc_id is null").collect() if r.doc_id != -4}
    assert [odd[i].lang_pred for i in (-1, -2, -3)] == ["und"] * 3 and odd[-1].score == 0
    assert odd[None].lang_pred == "en" and not odd[None].held_out
    scores = [r.score for r in out.collect()]
    assert 0 <= min(scores) and max(scores) <= 1 and len(scores) == both.count()


def test_language_is_the_same_in_pieces(docs):
    model = language.train(docs, sample=200)
    texts = ["the house of ons " * 9, None, "", "der die das und " * 3, "a", "É"]
    whole = model.probabilities(pa.array(texts))
    alone = np.concatenate([model.probabilities(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(whole, alone, atol=1e-6)


def test_language_without_training_rows(spark):
    frame = spark.createDataFrame(odd_rows(), DOCS).where("lang is null")
    assert language.train(frame) is None
    assert {r.lang_pred for r in language.predict(frame, None).collect()} == {"und"}
    empty = spark.createDataFrame([], DOCS)
    assert language.predict(empty, language.train(empty)).collect() == []


def test_toxicity_accuracy_and_odd_rows(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    extra = spark.createDataFrame([(None, 1), (-1, 1), (-2, None), (7, 5), (8, 1), (8, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels.select("doc_id", "toxic").unionByName(extra.where("doc_id is null or doc_id < 0")))
    out = toxicity.score(docs, model)
    assert out.columns == [*(c for c in docs.columns if c != "score"), "score"]
    held = out.where(toxicity.held_out(F.col("doc_id"))).join(labels, "doc_id").collect()
    right = np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in held])
    assert right > 0.95 > np.mean([r.toxic == 0 for r in held])
    odd = toxicity.score(spark.createDataFrame(odd_rows(), DOCS), model).collect()
    assert len(odd) == 6 and all(0 <= r.score < 0.5 for r in odd)
    kept = toxicity.reject(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == toxicity.score(docs, toxicity.train(docs, labels)).where("score < 0.5").count()


def hot_rows(n):
    words = ["the house and", "der die das", "le la les"]
    rows = [(7, f"{words[i % 3]} {i}", ["en", "de", "fr"][i % 3], None, None, None) for i in range(n)]
    rows += [(1000 + i, f"{words[i % 3]} x{i}", ["en", "de", "fr"][i % 3], None, None, None) for i in range(90)]
    return rows


@pytest.fixture()
def collected(monkeypatch):
    """Rows that reach the driver from tasks, per collect."""
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    sizes, plain = [], Frame.collect
    monkeypatch.setattr(Frame, "collect", lambda self: sizes.append(out := plain(self)) or out)
    return sizes


def test_repeated_ids_are_learned_from_once(spark, collected):
    frame = spark.createDataFrame(hot_rows(1000), DOCS).cache()
    model = language.train(frame, sample=60)
    assert model.languages == ["de", "en", "fr"] and sum(map(len, collected)) < 60 + 10
    again = language.train(frame.repartition(7), sample=60)
    assert np.array_equal(model.table, again.table)
    collected.clear()
    marks = [(7, 1)] * 400 + [(1000 + i, i % 2) for i in range(90)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    assert toxicity.train(frame, labels, sample=50) is not None
    assert sum(map(len, collected)) <= 2 * 50 + 10


def test_one_id_may_hold_all_rows(spark):
    frame = spark.createDataFrame(hot_rows(600)[:600], DOCS)
    assert language.train(frame, sample=9).languages == ["de", "en", "fr"]
    nobody = frame.withColumn("doc_id", F.lit(None).cast("long"))
    assert language.train(nobody) is None and toxicity.train(nobody, nobody.selectExpr("doc_id", "1 as toxic")) is None


def test_columns_of_any_name_stay(spark):
    rows = [(1, "a b c", "x", 0.5, True), (2, None, "y", None, False)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _score string, score double, _toxic boolean")
    model = toxicity.Model(np.array([1]), np.array([1.0]), -3.0, 1.0, 0.0)
    scored = toxicity.score(frame, model, "_toxic_score")
    assert scored.columns == [*frame.columns, "_toxic_score"]
    assert sorted(map(str, scored.drop("_toxic_score").collect())) == sorted(map(str, frame.collect()))
    assert toxicity.score(frame, model).columns == ["doc_id", "text", "_score", "_toxic", "score"]
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.reject(frame, labels).columns == frame.columns


def test_mean_embedding_is_that_of_a_plain_loop(docs):
    model = language.train(docs, sample=200)
    text = "Der Hüte, und  x1y ABc"
    hashed = [b[f[0] : f[1]] for b, f in language.subwords(pa.array([text]))]
    plain = np.mean([model.table[int(k)] for k in np.concatenate(hashed)], axis=0)
    scores = plain @ model.last + model.bias
    expected = np.exp(scores / model.temperature) / np.exp(scores / model.temperature).sum()
    assert np.allclose(model.probabilities(pa.array([text]))[0], expected, atol=1e-5)


def test_risk_falls_as_its_definition_says():
    """Objective of the fitted weights by a plain loop: below that of no weights."""
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 50, 8)).astype(np.int32) for _ in range(400)]
    positive = [np.unique(np.append(r, 99)).astype(np.int32) for r in rows[:60]]
    mixed = rows[60:] + [np.unique(np.append(r, 99)).astype(np.int32) for r in rows[:40]]

    def risk(kept, weights, bias, prior=0.1):
        table = dict(zip(kept.tolist(), weights.tolist(), strict=True))
        margin = lambda row: bias + sum(table.get(int(c), 0.0) for c in row)
        as_one = lambda rows: sum(np.log1p(np.exp(-margin(r))) for r in rows) / len(rows)
        as_zero = lambda rows: sum(np.log1p(np.exp(margin(r))) for r in rows) / len(rows)
        return prior * as_one(positive) + max(0.0, as_zero(mixed) - prior * as_zero(positive))

    kept, weights, bias = toxicity.fit(positive, mixed, 0.1)
    start = risk(kept, np.zeros(len(kept)), float(np.log(0.1 / 0.9)))
    assert risk(kept, weights, bias) < 0.5 * start
    worse = weights.copy()
    worse[list(kept).index(99)] -= 1.0
    assert risk(kept, worse, bias) > risk(kept, weights, bias)


def test_risk_is_that_of_its_definition():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 50, 8)).astype(np.int32) for _ in range(400)]
    positive = [np.unique(np.append(r, 99)).astype(np.int32) for r in rows[:60]]
    mixed = rows[60:] + [np.unique(np.append(r, 99)).astype(np.int32) for r in rows[:40]]
    kept, weights, bias = toxicity.fit(positive, mixed, 0.1)
    assert 99 in kept and weights[list(kept).index(99)] == weights.max() > 1
    assert toxicity.fit(positive, mixed, 0.1)[2] == bias


def test_toxicity_without_model(spark):
    empty_labels = spark.createDataFrame([], "doc_id long, toxic int")
    frame = spark.createDataFrame(odd_rows(), DOCS)
    assert toxicity.train(frame, empty_labels) is None
    assert {r.score for r in toxicity.score(frame, None).collect()} == {0.0}
    empty = spark.createDataFrame([], DOCS)
    assert toxicity.reject(empty, empty_labels).collect() == []


def test_cut_has_the_least_corrected_error():
    rng = np.random.default_rng(2)
    positive = rng.normal(2, 1, 80)
    unlabelled = np.concatenate([rng.normal(2, 1, 60), rng.normal(-2, 1, 540)])
    slope, offset = toxicity.calibrate(positive, unlabelled, 0.1)
    cut = -offset / slope

    def error(at):
        missed = np.mean(positive < at)
        return 0.1 * missed + max(0.0, np.mean(unlabelled >= at) - 0.1 * (1 - missed))

    assert abs(error(cut) - min(error(at) for at in np.concatenate([positive, unlabelled]))) < 1e-9
    assert toxicity.SLOPES[0] <= slope <= toxicity.SLOPES[1]
    assert abs(np.mean(1 / (1 + np.exp(-(slope * unlabelled + offset)))) - 0.1) < 0.03
