"""Toxicity by subword bags: embeddings of character n-grams, averaged, under a linear softmax.

A word, a run without white space whose outer punctuation is cut off (A-Z in lower case), is the bag of its character
n-grams from ``SHORTEST`` to ``LONGEST`` characters, with marks at both ends, and of itself. Each falls by a hash into
one of ``BUCKETS`` rows of an embedding. A word is the mean of its rows, a text the mean of its words, and a softmax
over two classes makes a probability of it. Embedding and softmax are trained together, so a spelling never seen before
lies near the words it shares n-grams with.

Training runs in numpy on the driver over a bounded sample: at most ``SAMPLE_ROWS`` labelled rows of each class, chosen
by a hash of their id. Of each the driver gets the weights of its buckets, worked out in the tasks over the whole text:
at most one number for each bucket, whatever the text's length. As the model is linear in the embedding, what a bucket
adds to the logit is one number; only that table goes to the tasks that score, which read whole texts, each distinct
word of a few megabytes of text once. A single text longer than that is worked on whole.

Null and empty texts have no words: their score is the model's offset. Rows of labels with a null id or label are
ignored; an id labelled both ways is learnt with its higher label, one that repeats among the documents with one of its texts. Without labels of both classes nothing can be learnt: every score is then the label there
is, or 0 if there is none. Equal texts get equal scores. An empty table gives an empty result. A column with the name
of the result is replaced; others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.words import Words, keys, slices, words

#: Labelled rows of each class that training sees at most.
SAMPLE_ROWS = 1500
#: A score from here on predicts a toxic text.
THRESHOLD = 0.5

SHORTEST, LONGEST = 3, 6
#: At most 1 << 16, so that two bytes name a bucket.
BUCKETS = 1 << 16
DIMENSIONS = 8
STEPS = 2400
BATCH = 32
RATE = 5.0
#: Share of a text's n-grams that a step looks at.
KEEP = 0.3
#: An n-gram that fewer of the sample's texts hold is left out.
FEWEST_TEXTS = 8

#: Weights are sent in thousandths or so, which half precision holds well.
_SCALE = 1024

_BYTES = np.arange(256)
_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)


def trimmed(column: pa.Array) -> Words:
    """Words of a column without the ASCII punctuation around them; what is nothing else is no word."""
    found = words(column)
    if not len(found.row):
        return found
    inside = _WORD[found.data]
    place = np.arange(len(inside))
    following = np.minimum.accumulate(np.where(inside, place, len(inside))[::-1])[::-1]
    preceding = np.maximum.accumulate(np.where(inside, place, -1))
    start = following[found.start]
    some = start < found.end
    row, start, end = found.row[some], start[some], preceding[found.end[some] - 1] + 1
    return Words(found.rows, found.data, row, start, end, keys(found.data, start, end))


def subwords(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word side by side, and where each word's begin; the last is the word itself."""
    size = end - start + 2
    ends = np.cumsum(size)
    begins = ends - size
    # <word><word>...
    marked = np.full(int(ends[-1]) if len(ends) else 0, ord(">"), np.uint8)
    marked[begins] = ord("<")
    target = np.arange(len(marked)) - np.repeat(begins, size)
    body = (target > 0) & (target < np.repeat(size, size) - 1)
    marked[body] = data[(np.repeat(start, size) + target - 1)[body]]
    # Characters begin at bytes that continue none.
    character = np.flatnonzero((marked & 0xC0) != 0x80)
    word = np.searchsorted(ends, character, side="right")
    after = np.append(character, len(marked))
    parts, owner = [], []
    for n in range(SHORTEST, LONGEST + 1):
        if len(character) < n:
            break
        first = np.flatnonzero(word[: len(word) - n + 1] == word[n - 1 :])
        parts.append(keys(marked, character[first], after[first + n]))
        owner.append(word[first])
    parts.append(keys(marked, begins, ends))
    owner.append(np.arange(len(size)))
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    bucket = (np.concatenate(parts) % np.uint64(BUCKETS)).astype(np.int64)[order]
    return bucket, np.searchsorted(owner[order], np.arange(len(size)))


def _distinct(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each distinct word, where each word's begin, and which of them each word is."""
    _, first, which = np.unique(found.key, return_index=True, return_inverse=True)
    return *subwords(found.data, found.start[first], found.end[first]), which


def _bags(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text, its buckets and their weights, which add up to one."""
    found = trimmed(column)
    bounds = np.searchsorted(found.row, np.arange(found.rows + 1))
    if not len(found.row):
        return [(np.zeros(0, np.int32), np.zeros(0, np.float32))] * found.rows
    bucket, begins, which = _distinct(found)
    sizes = np.diff(np.append(begins, len(bucket)))
    bags = []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        word, times = np.unique(which[low:high], return_counts=True)
        size = sizes[word]
        place = np.arange(size.sum()) + np.repeat(begins[word] - (np.cumsum(size) - size), size)
        share = np.repeat(times / (max(1, high - low) * size), size)
        own, at = np.unique(bucket[place], return_inverse=True)
        bags.append((own.astype(np.int32), np.bincount(at, share, len(own)).astype(np.float32)))
    return bags


@F.arrow_udf(T.BinaryType())
def _bag(column: pa.Array) -> pa.Array:
    """Buckets and weights of each text, packed in four bytes each."""
    packed = []
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    for part in slices(batch, 0):
        for bucket, weight in _bags(part.column(0)):
            packed.append(bucket.astype("<u2").tobytes() + (weight * _SCALE).astype("<f2").tobytes())
    return pa.array(packed, pa.binary())


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = len(packed) // 4
    return np.frombuffer(packed, "<u2", size), np.frombuffer(packed, "<f2", size, 2 * size)


@dataclass
class Model:
    adds: np.ndarray  # of each bucket to the logit
    offset: float
    constant: float | None = None

    def score(self, column: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(column), self.constant)
        scores = []
        for part in slices(pa.RecordBatch.from_arrays([column], names=["text"]), 0):
            found = trimmed(part.column(0))
            total = np.zeros(found.rows)
            if len(found.row):
                bucket, begins, which = _distinct(found)
                value = np.add.reduceat(self.adds[bucket], begins) / np.diff(np.append(begins, len(bucket)))
                total = np.bincount(found.row, value[which], found.rows)
            logit = total / np.maximum(1, found.counts()) + self.offset
            scores.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
        return np.concatenate(scores) if scores else np.zeros(0)


def trained(
    bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, odds: float, steps: int = STEPS, seed: int = 7
) -> Model:
    """The model of some texts, given as buckets and scaled weights. Each step takes as many texts of either class.

    ``odds`` are those of the label 1 among all texts; the offset is moved from even odds to them.
    """
    if len(np.unique(labels)) < 2:
        return Model(np.zeros(0), 0.0, float(labels[0]) if len(labels) else 0.0)
    random = np.random.default_rng(seed)
    texts = np.zeros(BUCKETS, np.int64)
    for bucket, _ in bags:
        texts[bucket] += 1
    common = texts >= FEWEST_TEXTS
    bags = [(b[common[b]], w[common[b]]) for b, w in bags]
    # Buckets that no step touches stay zero, so they say nothing about a text.
    embedding = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    softmax = random.standard_normal((DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    squares = [np.full_like(a, 1e-8) for a in (embedding, softmax, bias)]
    classes = [np.flatnonzero(labels == k) for k in (0, 1)]
    for step in range(steps):
        chosen = np.concatenate([random.choice(c, BATCH // 2) for c in classes])
        bucket = np.concatenate([bags[i][0] for i in chosen])
        weight = np.concatenate([bags[i][1] for i in chosen]).astype(np.float32)
        text = np.repeat(np.arange(BATCH), [len(bags[i][0]) for i in chosen])
        # Each step looks at a part of every bag, so that no text is known by a few rare n-grams.
        kept = random.random(len(bucket)) < KEEP
        bucket, weight, text = bucket[kept], weight[kept] / np.float32(KEEP * _SCALE), text[kept]
        terms = embedding[bucket] * weight[:, None]
        hidden = np.stack([np.bincount(text, terms[:, d], BATCH) for d in range(DIMENSIONS)], axis=1)
        logits = hidden @ softmax + bias
        logits -= logits.max(axis=1, keepdims=True)
        error = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
        error[np.arange(BATCH), labels[chosen]] -= 1
        error /= BATCH
        back = (error @ softmax.T).astype(np.float32)[text] * weight[:, None]
        touched, at = np.unique(bucket, return_inverse=True)
        slope = np.stack([np.bincount(at, back[:, d], len(touched)) for d in range(DIMENSIONS)], axis=1)
        rate = 1 - step / steps
        # Adagrad, the embedding only where this step's texts touch it.
        squares[0][touched] += slope**2
        embedding[touched] -= (RATE * rate * slope / np.sqrt(squares[0][touched])).astype(np.float32)
        for own, square, gradient in ((softmax, squares[1], hidden.T @ error), (bias, squares[2], error.sum(axis=0))):
            square += gradient**2
            own -= (0.1 * rate * gradient / np.sqrt(square)).astype(np.float32)
    direction = (softmax[:, 1] - softmax[:, 0]).astype(np.float64)
    return Model((embedding @ direction).astype(np.float64), float(bias[1] - bias[0]) + float(np.log(odds)))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", steps: int = STEPS) -> Model:
    """The model learnt from the labels of ``docs`` that are not held out."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    number = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picked = [
        known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS) for k in (0, 1)
    ]
    # At most 2 * SAMPLE_ROWS ids, hence broadcast; as many rows go to the driver.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(picked[0].union(picked[1])), "doc_id")
        .select("doc_id", "label", _bag("text").alias("bag"))
        .groupBy("doc_id", "label")
        .agg(F.min("bag").alias("bag"))
        .toArrow()
        .sort_by("doc_id")
    )
    bags = [_unpacked(value.as_buffer()) for value in rows.column("bag")]
    odds = number.get(1, 0) / max(1, number.get(0, 0))
    return trained(bags, rows.column("label").to_numpy().astype(np.int64), odds, steps)


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability, from 0 to 1, that ``text`` is toxic."""

    @F.arrow_udf(T.DoubleType())
    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.score(column), pa.float64())

    return docs.withColumn(into, score(F.col(text)))
