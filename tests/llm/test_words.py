"""Words, blocks and subword features against plain versions."""

import re

import numpy as np
import pyarrow as pa

from larder.llm import subwords, words

TEXTS = [None, "", " ", "A b\tb\x0bC", "\u00c4 a\u00a0b\x1c", "x" * 300, "b b b"]


def test_encode_equals_plain_split():
    found = words.encode(pa.array(TEXTS))
    names = found.words.to_pylist()
    for i, text in enumerate(TEXTS):
        plain = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        assert [names[c] for c in found.codes[found.offsets[i] : found.offsets[i + 1]]] == plain


def test_encode_of_a_slice():
    whole = words.encode(pa.array(TEXTS).slice(3, 2))
    assert [whole.words[c].as_py() for c in whole.codes] == ["a", "b", "b", "c", "\u00c4", "a\u00a0b\x1c"]


def test_blocks_keep_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (1, 5, 900, 2, 3, 0, 4)] + [None]})
    for cut in (words.blocks, words.merged):
        parts = list(cut([batch, batch], "text", 8))
        assert [x for p in parts for x in p.column("text").to_pylist()] == 2 * batch.column("text").to_pylist()
        assert all(len(p) == 1 or sum(len(x or "") for x in p.column("text").to_pylist()) <= 8 for p in parts)


def test_features_depend_on_the_word_alone():
    settings = subwords.Settings()
    together, firsts = subwords.features(pa.array(["abc", "d", "abcabc"]), settings)
    assert np.diff(firsts).tolist() == [1 + 3 + 2 + 1, 1 + 1, 1 + 6 + 5 + 4]
    for i, word in enumerate(["abc", "d", "abcabc"]):
        alone, _ = subwords.features(pa.array([word]), settings)
        assert together[firsts[i] : firsts[i + 1]].tolist() == alone.tolist()


def test_misspelt_words_share_features():
    settings = subwords.Settings()
    a, b = (set(subwords.features(pa.array([w]), settings)[0].tolist()) for w in ("worthless", "w0rthless"))
    assert len(a & b) > len(a) / 3


def test_repeats_are_marked_within_a_text():
    settings = subwords.Settings(repeats=True)
    found = subwords.encoded(pa.array(["a a b", "b", "b b b", ""]), settings)
    names = [*found.words.to_pylist()]
    assert [names[c] for c in found.codes] == ["a", "a", "\n", "b", "b", "b", "b", "\n", "b", "\n"]
    assert found.offsets.tolist() == [0, 4, 5, 10, 10]


def test_training_separates_and_averages():
    texts = pa.array(["good words here"] * 20 + ["awful words here"] * 20)
    labels = np.array([0] * 20 + [1] * 20)
    settings = subwords.Settings(steps=60)
    model = subwords.train(texts, labels, settings)
    score = lambda *t: subwords.score(pa.array(t), model.logits(), model.bias, settings)[:, 1]
    one = score("good words here", "awful words here", "awfull words here", "", None)
    assert one[0] < 0.3 and one[1] > 0.7 and one[2] > 0.5
    assert one[3] == one[4]
    # A text said twice has the same average.
    assert np.allclose(score("awful words"), score("awful words awful words"))
    # The score is the softmax of the averaged vectors.
    found = words.encode(pa.array(["awful words"]))
    ids, _ = subwords.features(found.words, settings)
    logits = model.vectors[ids].mean(axis=0) @ model.output + model.bias
    assert np.allclose(score("awful words")[0], np.exp(logits[1]) / np.exp(logits).sum(), atol=1e-5)


def test_training_on_nothing():
    settings = subwords.Settings(steps=5)
    model = subwords.train(pa.array([], pa.string()), np.zeros(0, int), settings)
    assert np.isfinite(subwords.score(pa.array(["a"]), model.logits(), model.bias, settings)).all()
