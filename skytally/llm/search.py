"""Ranked lexical search: the best documents of each query item, grouped by which of its terms they hold.

1. Documents are cut into terms once. Of each stay the number of its terms and the counts of those that some item has,
   a written table. Its sums give N, L and each term's document frequency.
2. Tasks take that table in blocks of documents. A block is a bitmap of term by document, beside what a term adds to a
   document's score for a weight of one. The bits of an item's terms, packed, are each document's mask; equal masks
   form a group. What the terms of a mask can add at most in this block bounds the scores of the group. Groups are
   evaluated in descending order of that bound: those that fill the list first, then all whose bound reaches the
   last score listed. The others can't change the list, which each task carries on from block to block.
3. Lists of all tasks meet per item; each has ``top`` rows at most.

Items are the queries of this search, set against all documents. They are worked off in blocks of at most about
``ITEM_BYTES`` of text, one reading of the documents each, so neither the terms sent to the tasks nor a task's lists
grow with the number of items.

All arithmetic is in 64-bit integers, but for a term's weight. Null texts have no terms; an item or a document without
terms is in no result. Equal item rows are one item; rows with one id and different texts are items of their own.
Repeated documents are listed one by one, each with a rank; equal scores go to the smaller id, ids that are null come
last. Very long texts are cut into terms in slices that hold one text at least. Empty tables give an empty result. Only
id and text are looked at, so other columns can't clash. Terms are told apart by 64-bit keys; the odds that one of a
billion different words passes for one of 100,000 query terms are 1 in 100,000.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.storage import stored
from skytally.llm.words import slices, words

#: Results of an item.
TOP = 20
#: Of the normalisation, how much depends on a document's length, in percent.
LENGTH_SHARE = 25
#: Text of the items worked off together.
ITEM_BYTES = 1 << 18
#: Cells (term, document) of a block.
_CELLS = 1 << 23
_MOST_DOCUMENTS = 4096

_BYTES = np.arange(256)
#: Bytes of a term, once A-Z are lowered.
TERM = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)


class Items:
    """Query items as numbers: their terms, and how often each term stands in them."""

    def __init__(self, texts: pa.Array) -> None:
        found = words(texts, TERM)
        self.keys, term = np.unique(found.key, return_inverse=True)
        pair, times = np.unique(found.row * max(1, len(self.keys)) + term, return_counts=True)
        self.term = pair % max(1, len(self.keys))
        self.times = times.astype(np.int64)
        self.first = np.searchsorted(pair // max(1, len(self.keys)), np.arange(len(texts) + 1))

    def __len__(self) -> int:
        return len(self.first) - 1


_POSTINGS = (
    T.StructType()
    .add("id", T.LongType())
    .add("n", T.LongType())
    .add("terms", T.ArrayType(T.IntegerType()))
    .add("counts", T.ArrayType(T.IntegerType()))
)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def postings(docs: DataFrame, keys: np.ndarray) -> DataFrame:
    """id, n (terms with repeats) and the counts of known terms, for documents with any term."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found = words(part.column(1), TERM)
                n = found.counts()
                place = np.searchsorted(keys, found.key)
                known = keys[np.minimum(place, len(keys) - 1)] == found.key
                pair, times = np.unique(found.row[known] * len(keys) + place[known], return_counts=True)
                sizes = np.bincount(pair // len(keys), minlength=found.rows)
                rows = pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n.astype(np.int64)), _lists(pair % len(keys), sizes), _lists(times, sizes)],
                    names=_POSTINGS.fieldNames(),
                )
                yield rows.filter(pa.array(n > 0))

    return docs.mapInArrow(read, _POSTINGS)


def _ints(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def frequencies(found: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term. Tasks add up first, so a term in every document is one row a task."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(_ints(batch.column(0).flatten()), minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    total = np.zeros(terms, np.int64)
    for row in found.select("terms").mapInArrow(add, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        total[row.term] = row.n
    return total


class Best:
    """The best documents so far of one item."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.missing = np.zeros(0, bool)

    def least(self) -> int:
        """A document below this score can't enter the list."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, id: np.ndarray, missing: np.ndarray) -> None:
        new = score >= self.least()
        score, id, missing = (
            np.concatenate(pair)
            for pair in ((self.score, score[new]), (self.id, id[new]), (self.missing, missing[new]))
        )
        order = np.lexsort((id, missing, -score))[: self.top]
        self.score, self.id, self.missing = score[order], id[order], missing[order]


class Block:
    """Documents of a task side by side: a bitmap of their terms, and what each term adds to each of them."""

    def __init__(self, id: pa.Array, norm: np.ndarray, row: np.ndarray, term: np.ndarray, count: np.ndarray, terms: int):
        self.missing = id.is_null().to_numpy(zero_copy_only=False)
        self.id = id.fill_null(0).to_numpy(zero_copy_only=False)
        size = len(self.id)
        here = np.unique(term)
        self.line = np.full(terms, -1)
        self.line[here] = np.arange(len(here))
        self.adds = np.zeros((len(here), size), np.int32)  # below a million, as a count cancels out
        self.adds[self.line[term], row] = 1_000_000_000 * count // (1000 * count + 12 * norm[row])
        self.has = np.zeros((len(here), size), bool)
        self.has[self.line[term], row] = True
        self.most = self.adds.max(axis=1, initial=0).astype(np.int64)

    def masks(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct masks of these terms, as rows of bits, and which of them each document has."""
        packed = np.packbits(self.has[lines], axis=0)  # bytes x documents
        padded = np.zeros((-(-len(packed) // 8) * 8, packed.shape[1]), np.uint8)
        padded[: len(packed)] = packed
        numbers = np.ascontiguousarray(padded.T).view(np.uint64)
        group = np.zeros(len(numbers), np.int64)
        first = np.zeros(1, np.int64)
        for column in numbers.T:  # 64 terms at a time, earlier ones as the number of their group
            value, part = np.unique(column, return_inverse=True)
            _, first, group = np.unique(group * len(value) + part, return_index=True, return_inverse=True)
        return self.has[lines][:, first].T, group

    def search(self, term: np.ndarray, weight: np.ndarray, best: Best) -> None:
        """Bring the documents of this block that belong there into an item's list."""
        line = self.line[term]
        weight, line = weight[line >= 0], line[line >= 0]
        weight, line = weight[weight > 0], line[weight > 0]
        if not len(line):
            return
        mask, group = self.masks(line)
        bound = mask @ (weight * self.most[line])
        open_ = bound >= best.least()
        if not open_.any():
            return
        if len(best.score) < best.top:
            # The groups of the highest bounds, as many as may fill the list.
            order = np.argsort(-bound, kind="stable")
            enough = np.searchsorted(np.cumsum(np.bincount(group)[order]), best.top) + 1
            early = np.zeros(len(bound), bool)
            early[order[:enough]] = True
            self._evaluate(np.flatnonzero((early & open_)[group]), line, weight, best)
            open_ &= ~early & (bound >= best.least())
        self._evaluate(np.flatnonzero(open_[group]), line, weight, best)

    def _evaluate(self, documents: np.ndarray, line: np.ndarray, weight: np.ndarray, best: Best) -> None:
        if len(documents):
            score = weight @ self.adds[np.ix_(line, documents)].astype(np.int64)
            best.add(score, self.id[documents], self.missing[documents])


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, ``size`` at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            held.append(part)
            rows += part.num_rows
            batch = batch.slice(part.num_rows)
            if rows == size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


_LISTED = T.StructType().add("item", T.IntegerType()).add("id", T.LongType()).add("score", T.LongType())


def _search_block(docs: DataFrame, texts: pa.Array, top: int) -> DataFrame | None:
    """Lists of some items, one from each task: item (its number), id, score."""
    items = Items(texts)
    terms = len(items.keys)
    if not terms:
        return None
    found = stored(postings(docs, items.keys), "postings")
    total = found.agg(F.count("*").alias("n"), F.sum("n").alias("length")).first()
    if not total["n"]:
        return None
    n_documents, length = int(total["n"]), int(total["length"])
    weight = np.floor(
        1000 * np.log((2 * n_documents + 2) / (2 * frequencies(found, terms) + 1.0))
    ).astype(np.int64)
    weights = items.times * weight[items.term]
    size = max(64, min(_MOST_DOCUMENTS, _CELLS // terms))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = [Best(top) for _ in range(len(items))]
        for part in _blocks(batches, size):
            n = _ints(part.column(1))
            norm = 100 - LENGTH_SHARE + LENGTH_SHARE * n * n_documents // length
            row = np.repeat(np.arange(len(n)), _ints(part.column(2).value_lengths()))
            block = Block(
                part.column(0), norm, row, _ints(part.column(2).flatten()), _ints(part.column(3).flatten()), terms
            )
            for item, best in enumerate(lists):
                own = slice(items.first[item], items.first[item + 1])
                block.search(items.term[own], weights[own], best)
        sizes = [len(best.score) for best in lists]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(lists), dtype=np.int32), sizes)),
                    pa.array(np.concatenate([b.id for b in lists]), mask=np.concatenate([b.missing for b in lists])),
                    pa.array(np.concatenate([b.score for b in lists])),
                ],
                names=_LISTED.fieldNames(),
            )

    return found.filter(F.size("terms") > 0).mapInArrow(search, _LISTED)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    item_column: str = "item_id",
    text: str = "text",
    top: int = TOP,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """item, rank (from 1), id and score of the ``top`` documents of each item that score above 0. Ids are longs."""
    spark = docs.sparkSession
    read = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    queries = items.select(F.col(item_column).alias("item_id"), F.col(text).cast("string").alias("text"))
    queries = stored(queries.filter(F.col("text").isNotNull()).distinct(), "items")
    size = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / item_bytes))
    result = None
    for number in range(blocks):
        own = queries.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).toArrow()
        if not own.num_rows:
            continue
        listed = _search_block(read, own.column("text").combine_chunks(), top)
        if listed is None:
            continue
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = listed.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = spark.createDataFrame(
            own.select(["item_id"]).append_column("item", pa.array(np.arange(own.num_rows, dtype=np.int32)))
        )
        part = ranked.join(F.broadcast(names), "item").select(
            F.col("item_id").cast(queries.schema["item_id"].dataType).alias(item_column),
            "rank", F.col("id").alias(id_column), "score",
        )
        part = stored(part, "search") if blocks > 1 else part
        result = part if result is None else result.unionByName(part)
    if result is None:
        schema = T.StructType([
            T.StructField(item_column, queries.schema["item_id"].dataType), T.StructField("rank", T.IntegerType()),
            T.StructField(id_column, T.LongType()), T.StructField("score", T.LongType()),
        ])
        return spark.createDataFrame([], schema)
    return result
