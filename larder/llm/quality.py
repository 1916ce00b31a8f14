"""Quality classifier: supervised subword embeddings.

Hashed word and character n-gram vectors and a pair feature for repeated words are averaged per text, as far as they tell the
classes apart beyond chance; a softmax layer on top gives the class probabilities. All are learned together in numpy by
stochastic gradient descent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import classifier, subwords

SETTINGS = subwords.Settings(repeats=True, screen=True, seed=7)
SAMPLE = classifier.Sample()
THRESHOLD = 0.3


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
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
