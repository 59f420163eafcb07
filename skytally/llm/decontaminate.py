"""Test items inside training documents: rare n-gram seeds find them, local alignment scores them.

1. Items become their runs of ``SEED`` words. One pass over the documents finds all places of any of these runs and
   cuts out passages around them, wide enough for a whole item on either side.
2. Runs that at most ``FEW_ITEMS`` items have are seeds: each joins every passage that holds it to so many items. A run
   that more items have joins them only together with a rare word. An alignment that reaches the score matches so
   many of the item's words that one of its rarest is among them, whichever it matches: of the item's words, in
   order of the passages and items that hold them, the first ones, one more than may be missed. So a passage that
   shares nothing with an item but common runs meets it only if it also holds such a word; no pair that can reach
   the score is lost. Passages with the same words and runs are judged once, for all their documents.
3. Seeds join passages to items. A pair whose words can't reach the score in any alignment is left out (see ``bound``).
   The others are aligned word by word (Smith-Waterman: 1 for a match, -0.5 for another, missing or added word); the
   score is the best local alignment's sum over the item's number of words. Edited and paraphrased copies lose a
   little, unrelated text scores near zero.

The runs go to the tasks in blocks of a fixed size, one pass for each block, so a benchmark of any size is
searched completely and no task holds more than a block.

Words are what stands between white space, A-Z in lower case. Items of fewer than ``SEED`` words say nothing and match
nothing; null texts count as empty. Ids are whole numbers; rows without one are left out of the search. Repeated
rows give one result per id and item, the best; ties go to the first place. Other columns are not looked at. Empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.storage import stored, with_row
from skytally.llm.words import grams, slices, words

SEED = 4
#: A document that scores so much with an item contains it.
SCORE = 0.5
MATCH, OTHER = 1.0, -0.5
#: A run of more items is a seed only together with one of the item's rare words.
FEW_ITEMS = 4
#: Runs of items that one pass over the documents looks for.
BLOCK_RUNS = 500_000

_LONGS = T.ArrayType(T.LongType(), False)
_ITEMS = T.StructType().add("item_id", T.LongType()).add("words", _LONGS).add("runs", _LONGS)
_PASSAGES = (
    T.StructType()
    .add("doc_id", T.LongType())
    .add("start", T.LongType())
    .add("passage", T.BinaryType())
    .add("words", _LONGS)
    .add("runs", _LONGS)
)
_SCORES = (
    T.StructType()
    .add("passage", T.BinaryType())
    .add("item_id", T.LongType())
    .add("score", T.DoubleType())
    .add("first_word", T.LongType())
    .add("end_word", T.LongType())
)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _read_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            found = words(part.column(1))
            first, run = grams(found, SEED)
            runs = np.bincount(found.row[first], minlength=part.num_rows)
            columns = [part.column(0), _lists(found.key, found.counts()), _lists(run, runs)]
            yield pa.RecordBatch.from_arrays(columns, names=_ITEMS.names)


def _digests(*columns: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """One digest a row of columns of lists (values, counts)."""
    parts = [np.split(values, np.cumsum(counts)[:-1]) for values, counts in columns]
    hashes = (hashlib.sha256(b"".join(hashlib.sha256(x.tobytes()).digest() for x in row)) for row in zip(*parts, strict=True))
    return [x.digest() for x in hashes]


class _Runs:
    """Exact membership in a set of keys, most misses told by a table of their upper bits."""

    BITS = 22

    def __init__(self, keys: np.ndarray) -> None:
        self.sorted = np.unique(keys)
        self.upper = np.zeros(1 << self.BITS, bool)
        self.upper[self.sorted >> np.uint64(64 - self.BITS)] = True

    def places(self, keys: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.upper[keys >> np.uint64(64 - self.BITS)])
        if not len(maybe):
            return maybe
        at = np.minimum(np.searchsorted(self.sorted, keys[maybe]), len(self.sorted) - 1)
        return maybe[self.sorted[at] == keys[maybe]]


def _passages(known: _Runs, margin: int):
    """For mapInArrow over (doc_id, text): stretches of words around all places of known runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found = words(part.column(1))
                first, key = grams(found, SEED)
                hit = known.places(key)
                if not len(hit):
                    continue
                word, key = first[hit], key[hit]
                count = found.counts()
                begin = np.cumsum(count) - count
                row = found.row[word]
                low = np.maximum(begin[row], word - margin)
                high = np.minimum(begin[row] + count[row], word + SEED + margin)
                # Stretches that touch become one.
                new = np.concatenate(([True], (row[1:] != row[:-1]) | (low[1:] > np.maximum.accumulate(high)[:-1])))
                passage = np.cumsum(new) - 1
                start = low[new]
                end = np.maximum.reduceat(high, np.flatnonzero(new))
                size = end - start
                inside = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
                text, runs = found.key[inside], np.bincount(passage)
                columns = [
                    part.column(0).take(pa.array(row[new])),
                    pa.array(start - begin[row[new]]),
                    pa.array(_digests((text, size), (key, runs)), pa.binary()),
                    _lists(text, size),
                    _lists(key, runs),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_PASSAGES.names)

    return run


def _best(texts: np.ndarray, items: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each pair and the word of the text behind its last one; rows are padded, 0 in a text."""
    pairs, length = texts.shape
    ramp = np.arange(length) * -OTHER
    above = np.zeros((pairs, length + 1))
    score, end = np.zeros(pairs), np.zeros(pairs, np.int64)
    for at in range(items.shape[1]):
        same = (texts == items[:, at : at + 1]) & (at < sizes)[:, None]
        down = np.maximum(above[:, :-1] + np.where(same, MATCH, OTHER), above[:, 1:] + OTHER)
        down = np.maximum(down, 0)
        # A gap in the item's direction: the best cell to the left, less its distance.
        here = np.maximum.accumulate(down + ramp, axis=1) - ramp
        above = np.concatenate((np.zeros((pairs, 1)), here), axis=1)
        where = here.argmax(axis=1)
        top = here[np.arange(pairs), where]
        better = top > score + 1e-9
        score[better], end[better] = top[better], where[better] + 1
    return score, end


def align(texts: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score (share of the item's words), first word and word behind the last one in the text, pair by pair."""
    score, first, end = np.zeros(len(texts)), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    order = sorted(range(len(texts)), key=lambda i: (len(texts[i]), len(items[i])))
    at = 0
    while at < len(order):
        # As many pairs at once as fill some megabytes; lengths in a block are alike.
        some = order[at : at + max(1, 200_000 // max(1, len(texts[order[min(at + 255, len(order) - 1)]])))][:256]
        at += len(some)
        sizes = np.array([len(items[i]) for i in some])
        for back in (False, True):
            wide = max(len(texts[i]) for i in some)
            text = np.zeros((len(some), wide), np.int64)
            item = np.zeros((len(some), sizes.max()), np.int64)
            for k, i in enumerate(some):
                own = texts[i][: end[i]][::-1] if back else texts[i]
                text[k, : len(own)] = own
                item[k, : len(items[i])] = items[i][::-1] if back else items[i]
            found, last = _best(text, item, sizes)
            if back:
                first[some] = end[some] - last
            else:
                score[some], end[some] = found / sizes, last
    return score, first, end


def bound(text: np.ndarray, item: np.ndarray) -> float:
    """No alignment has a higher score, in words.

    A matched word stands in both. An alignment covers a stretch of the text, where every word that the item lacks
    costs at least as much as another word does.
    """
    known = np.isin(text, item)
    sums = np.concatenate(([0.0], np.cumsum(np.where(known, MATCH, OTHER))))
    stretch = (sums - np.minimum.accumulate(sums)).max()
    return min(float(stretch), MATCH * np.isin(item, text[known]).sum())


def _score(least: float):
    """For mapInArrow over (passage, item_id, words, item_words): scores of at least ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def arrays(column: str, batch: pa.RecordBatch = batch) -> list[np.ndarray]:
                lists = batch.column(column)
                values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
                return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]

            texts, items = arrays("words"), arrays("item_words")
            able = [k for k, (t, i) in enumerate(zip(texts, items, strict=True)) if bound(t, i) >= least * len(i) - 1e-9]
            score, first, end = align([texts[k] for k in able], [items[k] for k in able])
            good = np.flatnonzero(score >= least)
            rows = pa.array(np.array(able, np.int64)[good])
            found = [pa.array(x[good]) for x in (score, first, end)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("passage").take(rows), batch.column("item_id").take(rows), *found], names=_SCORES.names
            )

    return run


def seeded(passages: DataFrame, items: DataFrame, score: float) -> DataFrame:
    """Pairs (passage, item_id) that share a run and can reach the score as far as their seeds tell."""
    held = items.select("item_id", F.explode(F.array_distinct("runs")).alias("run")).distinct()
    few = F.col("n_items") <= FEW_ITEMS
    counts = stored(held.groupBy("run").agg(F.count("*").alias("n_items")), "run-counts")
    held = stored(held.join(counts, "run"), "item-runs")
    hits = passages.select("passage", F.explode(F.array_distinct("runs")).alias("run"))
    direct = hits.join(held.filter(few), "run").select("passage", "item_id")

    # Runs of many items: which passages and items have any, and how rare their words are.
    common = counts.filter(~few).select("run")
    theirs = stored(hits.join(common, "run"), "common-hits")
    asked = items.join(held.filter(~few).select("item_id").distinct(), "item_id", "left_semi")
    asked = asked.select("item_id", F.size("words").alias("size"), F.posexplode("words").alias("place", "word"))
    asked = stored(asked, "item-words")
    vocabulary = asked.select("word").distinct()
    spoken = passages.join(theirs.select("passage").distinct(), "passage", "left_semi")
    spoken = spoken.select("passage", F.explode(F.array_distinct("words")).alias("word"))
    spoken = stored(spoken.join(vocabulary, "word", "left_semi"), "passage-words")
    holders = spoken.select("word").unionAll(asked.select("item_id", "word").distinct().select("word"))
    frequency = holders.groupBy("word").agg(F.count("*").alias("holders"))
    order = Window.partitionBy("item_id").orderBy("holders", "word", "place")
    missed = F.col("size") - F.ceil(F.col("size") * score - 1e-9)
    rare = asked.join(frequency, "word").withColumn("rank", F.row_number().over(order))
    rare = rare.filter(F.col("rank") <= missed + 1).select("item_id", "word").distinct()
    sides = (
        theirs.join(spoken, "passage").select("passage", "run", "word"),
        held.filter(~few).select("item_id", "run").join(rare, "item_id").select("item_id", "run", "word"),
    )
    together = sides[0].join(sides[1], ["run", "word"]).select("passage", "item_id")
    return direct.unionAll(together).distinct()


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    score: float = SCORE,
    block_runs: int = BLOCK_RUNS,
) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, score, first_word, end_word."""
    named = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    items = stored(named.filter("item_id is not null").distinct().mapInArrow(_read_items, _ITEMS), "items")
    total = items.agg(F.sum(F.size("runs")), F.max(F.size("words"))).first()
    blocks = math.ceil((total[0] or 0) / block_runs)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.filter("doc_id is not null")
    every = items.select("item_id", F.explode("runs").alias("run"))
    parts = []
    for block in range(blocks):
        own = every.filter(F.pmod(F.xxhash64("run"), F.lit(blocks)) == block).select("run").distinct()
        keys = own.toArrow()["run"].to_numpy().view(np.uint64)
        parts.append(rows.mapInArrow(_passages(_Runs(keys), total[1]), _PASSAGES))
    none = docs.sparkSession.createDataFrame([], _PASSAGES)
    passages = stored(reduce(DataFrame.union, parts, none), "passages")

    # Equal passages are judged once, whatever document they stand in.
    different = stored(passages.dropDuplicates(["passage"]).drop("doc_id", "start"), "different-passages")
    pairs = stored(seeded(different, items, score), "seeded")
    whole = items.select("item_id", F.col("words").alias("item_words"))
    both = pairs.join(different.drop("runs"), "passage").join(whole, "item_id")
    scores = both.select("passage", "item_id", "words", "item_words").mapInArrow(_score(score), _SCORES)
    places = passages.select("doc_id", "start", "passage")
    scored = stored(scores, "scored-passages").join(places, "passage").select(
        "doc_id",
        "item_id",
        "score",
        (F.col("first_word") + F.col("start")).alias("first_word"),
        (F.col("end_word") + F.col("start")).alias("end_word"),
    )
    best = F.max(F.struct("score", F.negative("first_word").alias("back"), "end_word")).alias("best")
    return scored.groupBy("doc_id", "item_id").agg(best).select(
        F.col("doc_id").alias(id_column),
        "item_id",
        "best.score",
        F.negative("best.back").alias("first_word"),
        "best.end_word",
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item was found. Every row is judged by its text, whatever its id."""
    docs, row = with_row(docs, "leak-rows")
    leaks = find_leaks(docs, benchmark, row, text).select(row).distinct()
    return docs.join(leaks, row, "left_anti").drop(row)
