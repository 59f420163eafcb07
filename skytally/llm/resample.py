"""Importance resampling towards a target distribution, on hashed word runs.

A ``Split`` pre-tokeniser, a plain pattern that nothing has to be trained for, cuts the text (A-Z in lower case) into
words and their offsets. Pairs of offsets, first word and last word of a window, name the features: all runs of
``shortest`` to ``longest`` words. A feature falls into the bucket that the CRC of its UTF-8 bytes names; what a bucket
gains is the logarithm of its share in the target over its share in the documents, both smoothed by one. A document
weighs the mean gain of its features, floored; Gumbel noise that depends on nothing but its id makes a draw without
replacement of the sort: the highest scores are drawn.

Texts are read once. Each becomes its buckets and their counts, a written table from which the tasks add up the bucket
histogram and, knowing the gains, each document's weight. Only ``buckets`` numbers reach the driver.

Scores are integers within narrow bounds (a few ten thousand values), so ranks need no total order in one task: rows
are counted by score, the rank is the number of rows with a higher score plus the place among equal scores. Equal rows
are counted together within each task first, so an id repeated a million times is a few rows there.

Null and empty texts have no features and weigh 0. Repeated rows are judged one by one and take consecutive ranks.
Equal scores go to the smaller id; ids may be null, which come last and draw their noise from an empty id. Texts are
cut in pieces of about a megabyte at word boundaries, so a very long text costs its buckets only. An empty table gives
an empty result; without target texts every gain follows from the documents alone. Only the id and the text are looked
at, so other columns can't clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, pre_tokenizers

from skytally.llm.storage import stored

#: A word: digits, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEED = 2024
_PIECE = 1 << 20  # characters
_SEPARATORS = frozenset(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def _pieces(text: str) -> Iterator[str]:
    """The text in parts of about ``_PIECE`` characters that cut no word."""
    start = 0
    while start < len(text):
        end = start + _PIECE
        while end < len(text) and text[end] not in _SEPARATORS:
            end += 1
        yield text[start:end]
        start = end


class Features:
    """Counts the features of texts by bucket."""

    def __init__(self, shortest: int, longest: int, buckets: int) -> None:
        self.shortest, self.longest, self.buckets = shortest, longest, buckets
        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)

    def count(self, text: str) -> tuple[int, Counter]:
        """Number of words, and features by bucket."""
        lowered = text.encode("utf-8", "replace").lower().decode("utf-8")  # A-Z only
        words, found = 0, Counter()
        before: list[str] = []  # words whose windows reach into the next piece
        for piece in _pieces(lowered):
            offsets = [pair for _, pair in self.split.pre_tokenize_str(piece)]
            words += len(offsets)
            run = before + [piece[start:end] for start, end in offsets]
            for n in range(self.shortest, self.longest + 1):
                first = max(0, len(before) - n + 1)
                windows = run[first:] if n == 1 else [" ".join(run[i : i + n]) for i in range(first, len(run) - n + 1)]
                for feature, times in Counter(windows).items():
                    found[zlib.crc32(feature.encode()) % self.buckets] += times
            before = run[len(run) - self.longest + 1 :] if self.longest > 1 else []
        return words, found


_COUNTED = (
    T.StructType().add("n_words", T.LongType()).add("n_features", T.LongType()).add("buckets", T.BinaryType())
)
#: What a text's buckets are packed as: no text has more features than these counts hold.
_PAIR = np.dtype([("bucket", "<i4"), ("count", "<u4")])


def counted(docs: DataFrame, id_column: str, text: str, shortest: int, longest: int, buckets: int) -> DataFrame:
    """id, n_words, n_features and the counts of each text's buckets, packed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(shortest, longest, buckets)
        for batch in batches:
            words, sizes, packed = [], [], []
            for value in batch.column(1):
                n, found = features.count(value.as_py() or "")
                words.append(n)
                sizes.append(found.total())
                packed.append(np.fromiter(found.items(), _PAIR, len(found)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                names=["id", *_COUNTED.fieldNames()],
            )

    read = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))
    return read.mapInArrow(count, T.StructType([read.schema["id"], *_COUNTED.fields]))


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and counts of all rows in a row, and where each row's begin (one more at the end)."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    pairs = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]].view(_PAIR)
    return pairs["bucket"], pairs["count"].astype(np.int64), (ends - ends[0]) // _PAIR.itemsize


def histogram(features: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket. Tasks add up their rows, so at most ``buckets`` rows a task are shuffled."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            bucket, count, _ = _unpacked(batch.column(0))
            np.add.at(total, bucket, count)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    parts = features.select("buckets").mapInArrow(add, "bucket int, n long")
    rows = parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(buckets, np.int64)
    for row in rows:
        total[row.bucket] = row.n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over its share in the source, floored."""
    size = float(len(source))
    over = (target + 1.0) * (source.sum() + size)
    under = (source + 1.0) * (target.sum() + size)
    return np.floor(1000 * np.log(over / under)).astype(np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """id, n_words, n_features and the floored mean gain of each text's features."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, count, ends = _unpacked(batch.column(3))
            sums = np.concatenate(([0], np.cumsum(gain[bucket] * count)))
            number = batch.column(2).to_numpy(zero_copy_only=False)
            weight = np.diff(sums[ends]) // np.maximum(number, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(weight, pa.int64())], names=["id", "n_words", "n_features", "weight"]
            )

    kept = [features.schema[name] for name in ("id", "n_words", "n_features")]
    return features.mapInArrow(weigh, T.StructType([*kept, T.StructField("weight", T.LongType())]))


def noise(id_column: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variable that depends on the id alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    h = F.conv(F.substr(F.sha2(text, 256), F.lit(1), F.lit(8)), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def _ranked(scored: DataFrame, fewest_words: int, percent: int) -> DataFrame:
    """``scored`` with the ranks of the rows that are drawn."""
    can = F.col("n_words") >= fewest_words
    by_score = stored(scored.filter(can).groupBy("score").agg(F.count("*").alias("n")), "score-counts")
    # Scores have a few ten thousand values, so this window sorts that many rows at most.
    above = F.coalesce(
        F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    total = by_score.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    drawn = percent * total // 100
    # Those scores from which at least one row is drawn.
    reached = stored(by_score.withColumn("above", above).filter(F.col("above") < drawn).drop("n"), "scores-reached")
    lowest = reached.agg(F.min("score")).first()[0]
    columns = ["id", "n_words", "n_features", "weight", "score"]
    if lowest is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    candidate = can & (F.col("score") >= lowest)
    rest = scored.filter(~candidate).select(*columns, F.lit(None).cast("long").alias("rank"))
    # Equal rows of a task are one row until they have their places.
    together = (
        scored.filter(candidate)
        .withColumn("task", F.spark_partition_id())
        .groupBy(*columns, "task")
        .agg(F.count("*").alias("n"))
        .join(reached, "score")
    )
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("id"), "n_words", "n_features", "task")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = together.withColumn("first", F.col("above") + before).withColumn(
        "place", F.explode(F.sequence(F.col("first") + 1, F.col("first") + F.col("n")))
    )
    ranks = placed.select(*columns, F.when(F.col("place") <= drawn, F.col("place")).alias("rank"))
    return ranks.unionByName(rest)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shortest: int = 1,
    longest: int = 1,
    buckets: int = 10_000,
    fewest_words: int = 20,
    percent: int = 10,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_features, weight, score, rank (null where it is not drawn).

    ``target`` needs the column ``text`` too. Of the rows with at least ``fewest_words`` words ``percent`` in a
    hundred are drawn.
    """
    shape = (shortest, longest, buckets)
    features = stored(counted(docs, id_column, text, *shape), "features")
    wanted = counted(target.withColumn("id", F.lit(0)).select("id", text), "id", text, *shape)
    gain = gains(histogram(features, buckets), histogram(wanted, buckets))
    score = F.col("weight") + noise(F.col("id"), seed)
    scored = stored(weighed(features, gain).withColumn("score", score), "weighed")
    return _ranked(scored, fewest_words, percent).withColumnRenamed("id", id_column)
