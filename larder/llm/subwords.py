"""Texts as averages of learned vectors of hashed words and character n-grams, with a softmax on top."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from larder.llm import words as W

PART_BYTES = 2 << 20  # of training texts looked at together
PART_WORDS = 1 << 15  # distinct words whose features are made together


@dataclass(frozen=True)
class Settings:
    """``buckets``: rows of the vector table (a power of two), half for words and half for n-grams of
    ``shortest`` to ``longest`` bytes, counted with the marks of a word's begin and end. ``repeats``: the word
    pair of two equal words counts too, and is one feature whatever the word. ``steps`` updates of ``batch`` texts each are
    made, however many texts there are. ``screen``: only features that stand in more texts of one class than chance explains
    are averaged (see ``telling``)."""

    buckets: int = 1 << 19
    size: int = 4
    shortest: int = 3
    longest: int = 5
    classes: int = 2
    steps: int = 600
    batch: int = 32
    rate: float = 1.0
    repeats: bool = False
    screen: bool = False
    seed: int = 11


@dataclass
class Model:
    vectors: np.ndarray  # bucket x size
    output: np.ndarray  # size x class
    bias: np.ndarray  # class
    kept: np.ndarray  # bucket: 1 if it counts in averages, else 0

    def logits(self) -> np.ndarray:
        """What a feature of each bucket adds to the class sums: an average of vectors followed by the
        output layer is the average of these."""
        return np.ascontiguousarray((self.vectors @ self.output * self.kept[:, None]).T, dtype=np.float32)


def grams(words: pa.Array, settings: Settings):
    """The features of all words, one kind after the other: the word itself, then n-grams by length.

    Yields buckets, the word of each, and the number each word has; a word's features of a kind stand
    together. Memory is in proportion to the bytes of the words.
    """
    half = settings.buckets // 2
    shift = np.uint64(65 - settings.buckets.bit_length() + 1)
    data, starts = W.raw(words)
    sizes = np.diff(starts)
    every = np.arange(len(sizes))
    yield (W.hashes(words, settings.seed) % np.uint64(half)).astype(np.int32), every, np.ones(len(sizes), np.int64)
    # Each word with marks around it: 1 before, 2 behind; text bytes are 9 and higher.
    ends = np.cumsum(sizes + 2)
    marked = np.full(len(data) + 2 * len(sizes), 2, np.uint64)
    begins = ends - sizes - 2
    marked[begins] = 1
    inner = np.ones(len(marked), bool)
    inner[begins] = inner[ends - 1] = False
    marked[inner] = data
    owner = np.repeat(every.astype(np.int32), sizes + 2)
    left = np.repeat(ends, sizes + 2) - np.arange(len(marked))  # bytes from here to the word's end
    rolled = np.zeros(len(marked), np.uint64)
    for n in range(1, settings.longest + 1):
        rolled = rolled[: max(0, len(marked) - n + 1)] * W.MIX + marked[n - 1 :]
        if n >= settings.shortest:
            here = np.flatnonzero(left[: len(rolled)] >= n)
            buckets = ((rolled[here] + np.uint64(n)) * W.MIX >> shift).astype(np.int32)
            yield buckets + np.int32(half), owner[here], np.maximum(sizes + 3 - n, 0)


def features(words: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets word after word, and where each word's begin. Made from some words at a time, as most memory goes to
    what stands between."""
    tables, amounts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for at in range(0, len(words), PART_WORDS):
        kinds = list(grams(words.slice(at, PART_WORDS), settings))
        amount = sum(count for _, _, count in kinds)
        table, done = np.empty(amount.sum(), np.int32), np.cumsum(amount) - amount
        for buckets, owner, count in kinds:
            within = np.arange(len(buckets)) - (np.cumsum(count) - count)[owner]
            table[done[owner] + within] = buckets
            done += count
        tables.append(table)
        amounts.append(amount)
    return np.concatenate(tables), np.concatenate([[0], np.cumsum(np.concatenate(amounts))])


REPEAT = "\n"  # white space, so no word is equal to it


def encoded(texts: pa.Array, settings: Settings) -> W.Words:
    """Words of the texts; with ``repeats``, each word equal to the one before is followed by a mark."""
    found = W.encode(texts)
    if not settings.repeats:
        return found
    same = np.concatenate([[False], found.codes[1:] == found.codes[:-1]]) if len(found.codes) else np.zeros(0, bool)
    same[found.offsets[:-1][found.offsets[:-1] < len(same)]] = False
    at = np.flatnonzero(same)
    words = pa.concat_arrays([found.words, pa.array([REPEAT], found.words.type)])
    codes = np.insert(found.codes, at + 1, len(found.words))
    return W.Words(words, codes, found.offsets + np.concatenate([[0], np.cumsum(same)])[found.offsets])


def counted(texts: pa.Array, settings: Settings):
    """Distinct words of all texts; then, text after text, each one's number, its distinct words and how often each occurs.

    Works through blocks of texts, so that only distinct words and counts are kept of more than one block.
    """
    vocabularies, pairs, amounts, known, first = [pa.array([], pa.string())], [], [], 0, 0
    for part in W.blocks([pa.record_batch([texts.cast(pa.string())], names=["text"])], "text", PART_BYTES):
        found = encoded(part.column("text"), settings)
        text = np.repeat(np.arange(first, first + len(part)), np.diff(found.offsets))
        pair, times = np.unique(text << 32 | found.codes + known, return_counts=True)
        vocabularies.append(found.words.cast(pa.string()))
        pairs.append(pair)
        amounts.append(times)
        known, first = known + len(found.words), first + len(part)
    coded = pa.concat_arrays(vocabularies).dictionary_encode()
    pair = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
    times = np.concatenate(amounts) if amounts else np.zeros(0, np.int64)
    return coded.dictionary, pair >> 32, np.asarray(coded.indices, dtype=np.int64)[pair & 0xFFFFFFFF], times


def softmax(logits: np.ndarray) -> np.ndarray:
    power = np.exp(logits - logits.max(axis=1, keepdims=True))
    return power / power.sum(axis=1, keepdims=True)


def train(texts: pa.Array, labels: np.ndarray, settings: Settings) -> Model:
    """Vectors and output layer learned together by stochastic gradient descent.

    A text without words counts as the bias alone. Without texts the model says the same for all.
    """
    random = np.random.default_rng(settings.seed)
    model = Model(
        random.uniform(-0.5, 0.5, (settings.buckets, settings.size)).astype(np.float32) / settings.size,
        random.normal(0, 0.5, (settings.size, settings.classes)).astype(np.float32),
        np.zeros(settings.classes, np.float32),
        np.ones(settings.buckets, np.float32),
    )
    if not len(labels):
        return model
    words, text, word, times = counted(texts, settings)
    buckets, firsts = features(words, settings)
    if settings.screen:
        model.kept[:] = telling(text, word, buckets, firsts, labels, settings)
        chosen = np.flatnonzero((model.kept > 0)[buckets])
        buckets, firsts = buckets[chosen], np.searchsorted(chosen, firsts)
        # Words without any such feature add nothing to a text.
        has = firsts[1:] > firsts[:-1]
        place, with_any = np.cumsum(has) - 1, has[word]
        text, word, times = text[with_any], place[word[with_any]], times[with_any]
        firsts = np.concatenate([firsts[:-1][has], firsts[-1:]])
    amounts = np.diff(firsts)
    targets = np.eye(settings.classes, dtype=np.float32)[labels]
    model.bias[:] = np.log((targets.sum(axis=0) + 1) / (len(labels) + settings.classes))
    # Weighed so that a text's features add up to 1.
    whole = np.bincount(text, times * amounts[word], len(labels))
    share = (times / whole[text]).astype(np.float32)
    edges = np.searchsorted(text, np.arange(len(labels) + 1))

    # Only buckets that occur in the sample are trained. Squared gradients so far: rare features, as in AdaGrad, go on
    # with larger steps.
    present, buckets = distinct(buckets, settings.buckets)
    vectors = model.vectors[present]
    squares = np.full(len(present), 1e-8, np.float32)
    step = 0
    while step < settings.steps:
        order = random.permutation(len(labels))
        for at in range(0, len(order), settings.batch):
            if step == settings.steps:
                break
            rows = order[at : at + settings.batch]
            counts = edges[rows + 1] - edges[rows]
            pick = spans(edges[rows], counts)
            used, inverse = distinct(word[pick], len(amounts))
            mix = np.zeros((len(rows), len(used)), np.float32)  # text x word
            mix[np.repeat(np.arange(len(rows)), counts), inverse] = share[pick]
            ids = buckets[spans(firsts[used], amounts[used])]
            # Vectors summed up per word and averaged per text.
            summed = sums(vectors[ids], np.concatenate([[0], np.cumsum(amounts[used])]))
            mean = mix @ summed
            wrong = softmax(mean @ model.output + model.bias) - targets[rows]
            rate = settings.rate * (1 - step / settings.steps)
            step += 1
            slope = np.repeat((wrong @ model.output.T).T @ mix, amounts[used], axis=1)
            touched, inverse = distinct(ids, len(present))
            total = np.stack([np.bincount(inverse, one, len(touched)) for one in slope], axis=1).astype(np.float32)
            model.output -= rate * (mean.T @ wrong) / len(rows)
            model.bias -= rate * wrong.mean(axis=0)
            squares[touched] += (total**2).mean(axis=1)
            vectors[touched] -= rate * total / np.sqrt(squares[touched])[:, None]
    model.vectors[present] = vectors
    return model


def telling(text, word, buckets, firsts, labels, settings: Settings) -> np.ndarray:
    """1 for each bucket whose number of texts differs between the classes by more than chance, else 0.

    The log-likelihood ratio of "stands in a text" against the class must be above 2 ln(number of buckets that occur), which is
    what the largest of as many ratios reaches by chance. If none is, all count. One text's buckets are looked at together.
    """
    sizes = np.bincount(labels, minlength=settings.classes).astype(float)
    seen = np.zeros((settings.classes, settings.buckets), np.int32)
    edges, amounts = np.searchsorted(text, np.arange(len(labels) + 1)), np.diff(firsts)
    for i, label in enumerate(labels):
        own = word[edges[i] : edges[i + 1]]
        here, _ = distinct(buckets[spans(firsts[own], amounts[own])], settings.buckets)
        seen[label, here] += 1
    part = sizes[:, None] / sizes.sum()
    present = np.flatnonzero(seen.any(axis=0))
    least = 2 * np.log(max(1, len(present)))
    kept = np.zeros(settings.buckets, np.float32)

    def gain(found: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(found > 0, found * np.log(found / (found.sum(axis=0) * part)), 0).sum(axis=0)

    for at in range(0, len(present), PART_WORDS):
        here = present[at : at + PART_WORDS]
        found = seen[:, here].astype(float)
        kept[here] = 2 * (gain(found) + gain(sizes[:, None] - found)) > least
    return kept if kept.any() else np.ones(settings.buckets, np.float32)


def distinct(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, all below ``limit``, in order, and the place of each value among them."""
    seen = np.zeros(limit, bool)
    seen[values] = True
    found = np.flatnonzero(seen)
    place = np.empty(limit, np.int32)
    place[found] = np.arange(len(found))
    return found, place[values]


def sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of each stretch ``edges[i]:edges[i + 1]``; none is empty."""
    return np.add.reduceat(values, edges[:-1], axis=0) if len(edges) > 1 else values[:0]


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All positions of the stretches that begin at ``starts`` and have ``counts`` entries."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def score(
    texts: pa.Array, logits: np.ndarray, bias: np.ndarray, kept: np.ndarray | Settings, settings: Settings | None = None
) -> np.ndarray:
    """Class probabilities of each text, from all of its words; a text without a feature that counts has those of the bias.
    ``kept`` may be left out where the settings do not screen features."""
    if settings is None:
        kept, settings = None, kept
    found = encoded(texts, settings)
    text = np.repeat(np.arange(len(texts)), np.diff(found.offsets))
    amounts, per_word = np.zeros(len(found.words)), np.zeros((len(bias), len(found.words)))
    for buckets, owner, count in grams(found.words, settings):
        amounts += np.bincount(owner, kept[buckets], len(amounts)) if settings.screen else count
        for k in range(len(bias)):
            per_word[k] += np.bincount(owner, logits[k][buckets], len(amounts))
    whole = np.maximum(np.bincount(text, amounts[found.codes], len(texts)), 1)
    sums = np.stack([np.bincount(text, one[found.codes], len(texts)) for one in per_word], axis=1)
    return softmax(sums / whole[:, None] + bias)
