"""A small convolutional network over bytes that tells good texts from bad ones.

A text's UTF-8 bytes are cut into overlapping chunks that cover it from beginning to end. Each byte becomes a short
vector; filters eight bytes wide slide over a chunk, and of each filter's answers the largest counts. A document is
the mean and the maximum of its chunks' answers; a logistic layer makes one probability of them.

Training runs in numpy on the driver over a bounded sample: at most ``SAMPLE_ROWS`` labelled rows of each class,
chosen by a hash of their id, whole texts. Scoring runs in the tasks over whole texts; bytes are looked at in blocks of
chunks, only the answers of a batch's chunks are held together, so a very long text takes a fifth of its size.

Null and empty texts are one empty chunk and get a score like any other. Rows of labels with a null id or label are
ignored; an id labelled both ways is learnt with its lower label. Without labels of both classes nothing can be
learnt: every score is then the label there is, or 1 if there is none, so nothing is rejected without evidence. An
empty table gives an empty result. A column with the name of the result is replaced; others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.words import flat

#: Labelled rows of each class that training sees at most.
SAMPLE_ROWS = 2000
STEPS = 2400
#: A score from here on predicts a good text.
THRESHOLD = 0.7

WIDTH, DIMENSIONS, FILTERS = 8, 4, 24
CHUNK = 512
#: Chunks overlap, so that every run of ``WIDTH`` bytes lies within one.
STEP = CHUNK - WIDTH
_BLOCK = 2048  # chunks


def chunk_starts(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and first byte of every chunk of the given byte ranges; an empty range has one chunk."""
    count = np.maximum(1, -(-np.maximum(0, end - begin - WIDTH) // STEP))
    row = np.repeat(np.arange(len(begin)), count)
    within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, begin[row] + within * STEP


def cut(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Chunks from the given starts; bytes from ``end`` on are zero."""
    place = np.arange(CHUNK)
    padded = np.concatenate((data, np.zeros(CHUNK, np.uint8)))
    chunks = padded[start[:, None] + place]
    chunks[place >= (end - start)[:, None]] = 0
    return chunks


def _normal(random: np.random.Generator, *shape: int, scale: float) -> np.ndarray:
    return (random.standard_normal(shape) * scale).astype(np.float32)


@dataclass
class Network:
    bytes_: np.ndarray  # 256 x DIMENSIONS
    filters: np.ndarray  # WIDTH * DIMENSIONS x FILTERS
    bias: np.ndarray
    weights: np.ndarray  # 2 * FILTERS: of the mean, of the maximum
    offset: np.ndarray
    constant: float | None = None
    _moments: dict = field(default_factory=dict)

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        random = np.random.default_rng(seed)
        return cls(
            _normal(random, 256, DIMENSIONS, scale=1.0),
            _normal(random, WIDTH * DIMENSIONS, FILTERS, scale=(WIDTH * DIMENSIONS) ** -0.5),
            np.zeros(FILTERS, np.float32),
            _normal(random, 2 * FILTERS, scale=0.1),
            np.zeros(1, np.float32),
        )

    def answers(self, chunks: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """The largest answer of each filter in each chunk and, if asked, where it is."""
        size = len(chunks)
        vectors = self.bytes_[chunks].reshape(size, CHUNK * DIMENSIONS)
        best = np.full((size, FILTERS), -np.inf, np.float32)
        place = np.zeros((size, FILTERS), np.int64) if places else None
        # Windows of one phase lie side by side, so they multiply without being copied out one by one.
        for phase in range(WIDTH):
            count = (CHUNK - phase) // WIDTH
            part = vectors[:, phase * DIMENSIONS : (phase + count * WIDTH) * DIMENSIONS]
            found = (part.reshape(size * count, -1) @ self.filters).reshape(size, count, FILTERS)
            if places:
                at = found.argmax(axis=1)
                top = np.take_along_axis(found, at[:, None], axis=1)[:, 0]
                place = np.where(top > best, at * WIDTH + phase, place)
            else:
                top = found.max(axis=1)
            np.maximum(best, top, out=best)
        return np.maximum(best + self.bias, 0), place

    def pooled(self, answers: np.ndarray, first: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Mean and maximum over the chunks of each document; ``first`` has each document's first chunk.

        In the mean a chunk counts by its ``share`` of the document, so a short last one hardly counts.
        """
        mean = np.add.reduceat(answers * share[:, None], first)
        return np.hstack((mean, np.maximum.reduceat(answers, first)))

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(pooled @ self.weights + self.offset[0], -30, 30)))

    def score(self, column: pa.Array) -> np.ndarray:
        if self.constant is not None or not len(column):
            return np.full(len(column), self.constant or 0.0)
        data, offsets = flat(column)
        row, start = chunk_starts(offsets[:-1], offsets[1:])
        answers = np.empty((len(row), FILTERS), np.float32)
        size = np.empty(len(row))
        for at in range(0, len(row), _BLOCK):
            part = slice(at, at + _BLOCK)
            low, high = start[part][0], start[part][-1] + CHUNK
            chunks = cut(data[low:high], start[part] - low, offsets[row[part] + 1] - low)
            answers[part] = self.answers(chunks)[0]
            size[part] = _sizes(chunks)
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        return self.probability(self.pooled(answers, first, _shares(size, first)).astype(np.float64))

    def _learn(self, chunks: np.ndarray, first: np.ndarray, labels: np.ndarray, rate: float, step: int) -> float:
        answers, place = self.answers(chunks, places=True)
        share = _shares(_sizes(chunks), first).astype(np.float32)
        pooled = self.pooled(answers, first, share)
        guess = self.probability(pooled)
        error = ((guess - labels) / len(labels)).astype(np.float32)
        count = np.diff(np.append(first, len(chunks)))
        document = np.repeat(np.arange(len(first)), count)
        from_mean = error[:, None] * self.weights[:FILTERS]
        is_top = answers == pooled[document, FILTERS:]
        slope = from_mean[document] * share[:, None] + is_top * (error[:, None] * self.weights[FILTERS:])[document]
        slope = (slope * (answers > 0)).astype(np.float32)
        # Only the window with the largest answer learns.
        window = chunks[np.arange(len(chunks))[:, None, None], place[:, :, None] + np.arange(WIDTH)]
        vectors = self.bytes_[window].reshape(len(chunks), FILTERS, -1)
        to_filters = np.einsum("cf,cfk->kf", slope, vectors)
        to_vectors = (slope[:, :, None] * self.filters.T).reshape(-1, DIMENSIONS)
        to_bytes = np.stack(
            [np.bincount(window.ravel(), to_vectors[:, d], 256) for d in range(DIMENSIONS)], axis=1
        )
        decay = 1e-4
        steps = {
            "bytes_": to_bytes,
            "filters": to_filters + decay * self.filters,
            "bias": slope.sum(axis=0),
            "weights": pooled.T @ error + decay * self.weights,
            "offset": error.sum(keepdims=True),
        }
        for name, gradient in steps.items():  # Adam
            mean, square = self._moments.get(name, (0.0, 0.0))
            mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
            self._moments[name] = mean, square
            change = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            setattr(self, name, (getattr(self, name) - change).astype(np.float32))
        return float(-np.mean(np.log(np.where(labels > 0, guess, 1 - guess) + 1e-9)))

    @classmethod
    def trained(
        cls, samples: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, batch: int = 64, seed: int = 7
    ) -> Network:
        """``samples`` has the chunks of each document; as many documents of either class go into each step.

        Of half of the documents a step takes only a short passage, so that length alone says nothing, the others
        it takes whole.
        """
        network = cls.fresh(seed)
        if len(np.unique(labels)) < 2:
            network.constant = float(labels[0]) if len(labels) else 1.0
            return network
        random = np.random.default_rng(seed)
        classes = [np.flatnonzero(labels == k) for k in (0, 1)]
        for step in range(1, steps + 1):
            chosen = np.concatenate([random.choice(c, batch // 2) for c in classes])
            parts = [
                _passage(samples[i], random) if random.random() < 0.5 else samples[i] for i in chosen
            ]
            first = np.cumsum([0] + [len(p) for p in parts[:-1]])
            rate = 0.01 * min(1.0, 2 * (1 - (step - 1) / steps))
            network._learn(np.concatenate(parts), first, labels[chosen].astype(np.float32), rate, step)
        network._moments = {}
        return network


def _sizes(chunks: np.ndarray) -> np.ndarray:
    return np.maximum(1, np.count_nonzero(chunks, axis=1))


def _shares(size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each chunk's share of its document."""
    return size / np.repeat(np.add.reduceat(size, first), np.diff(np.append(first, len(size))))


def _passage(chunks: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """A chunk of its own with 20 to 300 bytes of one of the given chunks, cut at blanks."""
    chunk = chunks[random.integers(len(chunks))]
    blanks = np.flatnonzero(chunk == 0x20)
    size = np.count_nonzero(chunk)
    start = random.choice(np.append(0, blanks + 1))
    end = min(size, start + random.integers(20, 300))
    following = blanks[blanks >= end]
    end = following[0] if len(following) else size
    passage = np.zeros((1, CHUNK), np.uint8)
    passage[0, : max(0, end - start)] = chunk[start:end]
    return passage if end - start >= 20 else chunks


@F.arrow_udf(T.BinaryType())
def _sample_chunks(column: pa.Array) -> pa.Array:
    """All chunks of each text, side by side."""
    data, offsets = flat(column)
    found = []
    for begin, end in zip(offsets[:-1], offsets[1:], strict=True):
        _, start = chunk_starts(np.array([begin]), np.array([end]))
        found.append(cut(data[begin:end], start - begin, np.full(len(start), end - begin)).tobytes())
    return pa.array(found, pa.binary())


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", steps: int = STEPS) -> Network:
    """The network learnt from the labels of ``docs`` that are not held out."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    picked = [
        known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS) for k in (0, 1)
    ]
    # At most 2 * SAMPLE_ROWS ids, hence broadcast.
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(picked[0].union(picked[1])), "doc_id")
        .select("doc_id", "label", _sample_chunks("text").alias("chunks"))
        .orderBy("doc_id", "chunks")
        .limit(2 * SAMPLE_ROWS)
        .collect()
    )
    samples = [np.frombuffer(r.chunks, np.uint8).reshape(-1, CHUNK) for r in rows]
    return Network.trained(samples, np.array([r.label for r in rows], np.int64), steps)


def score_quality(docs: DataFrame, network: Network, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability, from 0 to 1, that ``text`` is good."""

    @F.arrow_udf(T.DoubleType())
    def score(column: pa.Array) -> pa.Array:
        return pa.array(network.score(column), pa.float64())

    return docs.withColumn(into, score(F.col(text)))
