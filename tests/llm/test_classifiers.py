"""Classifiers on Spark: sampling, scoring, held-out accuracy on the given tables."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larder.llm import classifier, quality, queries, subwords, toxicity

QUICK = subwords.Settings(steps=120, repeats=True)


def learn(key):
    return queries.remainder(key, 3) != 1


def test_edge_rows(spark, edges, nothing):
    rows, docs = edges
    marks = [(i, i % 2) for i in range(40)] + [(3, None), (None, 1), (4, 1), (999, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    for labels_ in (labels, labels.where("doc_id < 0")):
        found = toxicity.score_toxicity(docs, labels_, learn, settings=QUICK).collect()
        assert len(found) == len(rows)
        assert all(0 <= r.score <= 1 for r in found)
        by_text = {}
        texts = {r[0]: r[1] for r in rows if r[0] is not None}
        for r in found:
            if r.doc_id is not None:
                by_text.setdefault((texts[r.doc_id] or "").strip(" \t\n").lower(), set()).add(round(r.score, 12))
        assert all(len(x) == 1 for x in by_text.values())
    kept = toxicity.score_toxicity(docs.withColumn("label", F.lit(1)), labels, learn, keep=True, score="s", settings=QUICK)
    assert kept.columns == [*docs.columns, "label", "s"] and kept.count() == len(rows)
    with pytest.raises(ValueError):
        classifier.apply(docs.withColumn("Score", F.lit(1)), "doc_id", "text", subwords.train(None, np.zeros(0), QUICK), QUICK, True)
    assert toxicity.score_toxicity(nothing, labels, learn, settings=QUICK).count() == 0


def test_sample_is_bounded_and_repeatable(spark, edges):
    _, docs = edges
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(60)], "doc_id long, toxic int")

    def sample(docs, bounds):
        return classifier.training_sample(docs, labels, "doc_id", "text", "toxic", lambda key: key != 7, bounds)

    texts, marks = sample(docs, classifier.Sample(rows=6))
    assert sorted(marks.tolist()) == [0] * 6 + [1] * 6
    again, _ = sample(docs.repartition(5), classifier.Sample(rows=6))
    assert texts.to_pylist() == again.to_pylist()
    few, _ = sample(docs, classifier.Sample(rows=1000, text_bytes=2000))
    assert 0 < sum(len(t.encode()) for t in few.to_pylist()) <= 2000


def decisions(spark, folder, score, name, mod, held):
    """Of the held-out labelled documents: how many of a class get which decision, as {(label, predicted): count}."""
    docs, labels = (queries.table(spark, folder, t) for t in ("documents", "labels"))
    scored = score(docs, labels, lambda key: queries.remainder(key, mod) != held)
    scored = scored.join(labels, "doc_id").where(queries.remainder(F.col("doc_id"), mod) == held)
    module = {"toxic": toxicity, "quality": quality}[name]
    rows = scored.groupBy(name, module.predicted("score").alias("predicted")).count().collect()
    return {(r[name], r.predicted): r["count"] for r in rows}


def recall(found, label):
    return found.get((label, label), 0) / (found.get((label, 0), 0) + found.get((label, 1), 0))


@pytest.mark.parametrize(("folder", "toxic", "clean"), [("sf0.01", 0.75, 0.97), ("sf0.1", 0.9, 0.99)])
def test_held_out_toxicity(spark, folder, toxic, clean):
    """At the smaller size four of the 18 toxic documents hold no insult of the others."""
    found = decisions(spark, f"/root/testdata/{folder}", toxicity.score_toxicity, "toxic", 3, 1)
    assert recall(found, 1) >= toxic and recall(found, 0) >= clean


@pytest.mark.parametrize(("folder", "poor", "good"), [("sf0.01", 0.8, 0.98), ("sf0.1", 0.97, 0.99)])
def test_held_out_quality(spark, folder, poor, good):
    found = decisions(spark, f"/root/testdata/{folder}", quality.score_quality, "quality", 5, 0)
    assert recall(found, 0) >= poor and recall(found, 1) >= good


def plain_features(text, settings):
    """Buckets of all features of a text, repeated as often as they occur."""
    return [b for word in text.lower().split() for b in plain_word(word, settings)]


def plain_word(word, settings):
    return subwords.features(pa.array([word]), settings)[0].tolist()


TEXTS = ["a good tale of the sea", "you utter fool of a man", "the sea and the man", "a fool and a liar", "", "sea sea sea"]
MARKS = [0, 1, 0, 1, 0, 0]


def test_one_step_of_training():
    """One update over one batch, against the gradient feature by feature."""
    settings = subwords.Settings(buckets=1 << 10, steps=1, batch=8, seed=3)
    found = subwords.train(pa.array(TEXTS), np.array(MARKS), settings)
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-0.5, 0.5, (settings.buckets, settings.size)).astype(np.float32) / settings.size
    output = random.normal(0, 0.5, (settings.size, 2)).astype(np.float32)
    vectors, output = vectors.astype(float), output.astype(float)
    bias = np.log((np.bincount(MARKS) + 1) / (len(MARKS) + 2))
    slopes, outputs, biases = {}, np.zeros_like(output), np.zeros(2)
    for text, mark in zip(TEXTS, MARKS):
        own = plain_features(text, settings)
        mean = sum((vectors[b] for b in own), np.zeros(settings.size)) / max(1, len(own))
        power = np.exp(mean @ output + bias)
        wrong = power / power.sum() - np.eye(2)[mark]
        outputs += np.outer(mean, wrong) / len(TEXTS)
        biases += wrong / len(TEXTS)
        for b in own:
            slopes[b] = slopes.get(b, 0) + output @ wrong / len(own)
    for b, slope in slopes.items():
        vectors[b] -= slope / np.sqrt(1e-8 + (slope**2).mean())
    assert np.allclose(found.output, output - outputs, atol=1e-5)
    assert np.allclose(found.bias, bias - biases, atol=1e-5)
    assert np.allclose(found.vectors, vectors, atol=1e-3)  # 32-bit sums under the root


def test_screen_against_plain_ratios():
    """Kept are the buckets whose two-by-two table has a ratio above the bound; none kept: all count."""
    settings = subwords.Settings(buckets=1 << 12, screen=True, steps=20, batch=8, seed=3)
    texts = [f"word{i} and {'fool' if i % 3 == 0 else 'sage'} x{i * i}" for i in range(60)]
    marks = np.array([int(i % 3 == 0 and i != 3) for i in range(60)])
    found = subwords.train(pa.array(texts), marks, settings)
    sets = [set(plain_features(t, settings)) for t in texts]
    every = set().union(*sets)
    for b in range(settings.buckets):
        table = np.array([[sum(m == c and (b in s) == has for s, m in zip(sets, marks)) for has in (True, False)] for c in (0, 1)])
        expected = table.sum(axis=1, keepdims=True) * table.sum(axis=0) / len(texts)
        ratio = 2 * sum(o * np.log(o / e) for o, e in zip(table.ravel(), expected.ravel()) if o)
        assert (found.kept[b] == 1) == (ratio > 2 * np.log(len(every))), b
    assert 0 < found.kept.sum() < len(every)
    scores = subwords.score(pa.array(["fool", "a fool", "sage", "", "qq", "fools"]), found.logits(), found.bias, found.kept, settings)
    bias = subwords.softmax(found.bias[None].astype(float))[0]
    assert scores[0, 1] == pytest.approx(scores[1, 1]) and scores[0, 1] > 0.7 > 0.3 > scores[2, 1]
    assert np.allclose(scores[3], bias, atol=1e-6) and np.allclose(scores[4], bias, atol=1e-6)
    assert scores[5, 1] > 0.7  # never seen, near a word that was
    # Too few texts to tell anything: nothing is screened.
    few = subwords.train(pa.array(TEXTS), np.array(MARKS), settings)
    assert few.kept.all()


def test_long_texts_do_not_crowd_out_a_class(spark):
    """The first text in the order of the sample is larger than all of a class's share."""
    keys = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    ranked = keys.where("toxic = 1").orderBy(F.xxhash64(F.lit(1), "doc_id"))
    first = ranked.first().doc_id
    text = F.when(F.col("doc_id") == first, F.repeat(F.lit("x"), 18 << 20)).otherwise(F.concat(F.lit("word "), "doc_id"))
    docs = keys.select("doc_id", text.alias("text"))
    every = lambda key: F.lit(True)
    texts, marks = classifier.training_sample(docs, keys, "doc_id", "text", "toxic", every, classifier.Sample())
    assert [(marks == c).sum() for c in (0, 1)] == [100, 99]
    # Large ones that fit stand last.
    few = classifier.Sample(rows=100, text_bytes=40_000)
    large = docs.select("doc_id", F.when(F.col("doc_id") == first, F.repeat(F.lit("y"), 12_000)).otherwise(F.col("text")).alias("text"))
    texts, marks = classifier.training_sample(large, keys, "doc_id", "text", "toxic", every, few)
    assert [(marks == c).sum() for c in (0, 1)] == [100, 100] and len(texts[199].as_py()) == 12_000


def test_a_class_without_a_text_that_fits_is_an_error(spark):
    docs = spark.createDataFrame([(1, "a" * 5000), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    with pytest.raises(ValueError):
        classifier.training_sample(
            docs, labels, "doc_id", "text", "toxic", lambda key: F.lit(True), classifier.Sample(10, 2000)
        )
