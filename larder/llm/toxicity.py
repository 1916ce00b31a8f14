"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word that never occurred in training still shares its character n-grams with words that did, so
misspelt insults fall near the known ones. A few insults make a long text toxic, so only features that tell the classes apart
beyond chance are averaged; else the many rare words of few training texts are learned by heart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import classifier, subwords

SETTINGS = subwords.Settings(buckets=1 << 20, longest=6, screen=True, seed=10)
SAMPLE = classifier.Sample()
THRESHOLD = 0.7


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    keep: bool = False,
    score: str = "score",
    settings: subwords.Settings = SETTINGS,
    sample: classifier.Sample = SAMPLE,
) -> DataFrame:
    """Fit on the labelled rows for which ``learn`` (a function of the key column) is true; score every row.

    Labels and keys only choose what is learned from; the score of a text depends on its words alone. Rules for
    nulls, empty texts and clashing names are those of ``classifier.apply``. Without any labelled row all
    texts have nearly the same score, about one half. Texts without any feature that counts all have the score of the bias.
    """
    texts, marks = classifier.training_sample(docs, labels, key, text, label, learn, sample)
    model = subwords.train(texts, marks, settings)
    return classifier.apply(docs, key, text, model, settings, keep, score)


def predicted(score: str, threshold: float = THRESHOLD):
    return (F.col(score) >= threshold).cast("int")
