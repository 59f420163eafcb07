"""A class-based n-gram model of text: exchange clustering puts words into classes, classes predict classes.

The probability of a word is that of its class after the class before, times that of the word within its class.
Both are counted over all training texts:

1. All words are counted in one pass and one shuffle. Words are named by 64-bit keys.
2. Every word that was seen at least ``SEEN`` times gets the class of its own neighbours. Words that make up at least
   ``CLASS_SHARE`` of the training tokens (by arithmetic, at most 1 / CLASS_SHARE words do) are exchanged in rounds,
   together with the endings, one of ``ENDINGS`` buckets, that stand for all others meanwhile. Words and endings are the
   symbols of these rounds; their number has a bound that the corpus can't exceed.
3. Training texts are written as symbols. Each round counts, over all of them, which classes follow and precede each
   symbol, and moves symbols to the class that raises the likelihood most. Tasks find each symbol's best class; the
   driver holds the classes of the symbols and the counts of class after class. Half of the symbols may move in a
   round, since all decide on the same counts. The best round's classes are kept.
4. Then each other word seen at least ``SEEN`` times is exchanged: its tokens are brought together, counted by the
   classes beside them, and it leaves its ending's class for the one that raises the likelihood most. Any number of words
   can: their classes are a table. Only words seen less often keep the class of their ending.
5. Scoring reads every text once. Counts and classes of words that make up at least ``COUNT_SHARE`` of the tokens (at
   most 1 / COUNT_SHARE of them) go to the tasks; all other words are joined to the complete table, and then
   meet their neighbours again by place.

Class transitions are interpolated with class frequencies; within a class, ``DISCOUNT`` is taken from each known word
and makes up the probability of the class's unknown word. So the probabilities of all words and one unknown word
for each class sum to one.

A text is its words, separated by white space, A-Z in lower case, and one end. Null counts as empty: its end alone.
Of equally good classes the larger one counts. A very long text is read whole, its rare words are rows of their own.
Without training texts there is nothing to learn: both scores are then 0. Repeated rows and ids are scored one by
one, ids are whole numbers or null, a null id is trained on and scored as any other. Other columns are not looked at. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.storage import stored
from skytally.llm.words import Words, keys, mixed, slices, words

CLASSES = 64
#: Rounds of exchange.
ROUNDS = 6
#: Share of all tokens from which a word is a symbol of its own.
CLASS_SHARE = 1e-5
#: Share of all tokens from which a word's count is sent to the tasks.
COUNT_SHARE = 1e-6
#: Buckets for the last three bytes of all other words.
ENDINGS = 4096
#: A word seen so often gets the class of its own neighbours.
SEEN = 5
DISCOUNT = 0.5
#: Weight of the class frequencies in a transition, in tokens.
PRIOR = 20.0

END_KEY = np.uint64(0x5D1E9C0F3B7A2468)
_SLICE = 8 << 20


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def _endings(found: Words) -> np.ndarray:
    start = np.maximum(found.start, found.end - 3)
    return (keys(found.data, start, found.end) % np.uint64(ENDINGS)).astype(np.int32)


_COUNTS = T.StructType().add("word", T.LongType()).add("ending", T.IntegerType()).add("n", T.LongType())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 0, _SLICE):
            found = words(part.column(0))
            key, first, n = np.unique(found.key, return_index=True, return_counts=True)
            ending = _endings(found)[first]
            # The ends of all texts; they have no bucket.
            key, ending, n = np.append(key, END_KEY), np.append(ending, ENDINGS), np.append(n, part.num_rows)
            columns = [pa.array(key.view(np.int64)), pa.array(ending.astype(np.int32)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=_COUNTS.names)


@dataclass
class Symbols:
    """Known words by key, in order: counts of the common ones, symbols of the most common ones."""

    key: np.ndarray
    count: np.ndarray
    symbol: np.ndarray  # -1: its ending's
    class_: np.ndarray | None = None  # once all words have theirs

    @property
    def own(self) -> int:
        return int((self.symbol >= 0).sum())

    @property
    def size(self) -> int:
        """Symbols of words, of endings, and the end."""
        return self.own + ENDINGS + 1

    def of(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """Symbol of each word, and its count (0: not among the common words)."""
        symbol = self.own + _endings(found)
        count = np.zeros(len(found.key), np.int64)
        if len(self.key):
            at = np.minimum(np.searchsorted(self.key, found.key), len(self.key) - 1)
            known = self.key[at] == found.key
            count[known] = self.count[at[known]]
            named = known & (self.symbol[at] >= 0)
            symbol[named] = self.symbol[at[named]]
        return symbol.astype(np.int32), count


    def classes_of(self, found: Words, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each word, that of its ending where it is not among the common words, and its count."""
        symbol, count = self.of(found)
        of = classes[symbol]
        if len(self.key):
            at = np.minimum(np.searchsorted(self.key, found.key), len(self.key) - 1)
            of = np.where(count > 0, self.class_[at], of)
        return of, count


_ENCODED = T.StructType().add("symbols", T.ArrayType(T.IntegerType(), False))


def _encode(symbols: Symbols):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, _SLICE):
                found = words(part.column(0))
                symbol, _ = symbols.of(found)
                offsets = np.concatenate(([0], np.cumsum(found.counts()))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(symbol))
                yield pa.RecordBatch.from_arrays([lists], names=_ENCODED.names)

    return run


_NEIGHBOURS = T.StructType().add("cell", T.IntegerType()).add("n", T.LongType())


def _neighbours(classes: np.ndarray):
    """How often each class follows (side 0) and precedes (side 1) each symbol, summed over a task."""
    size, end = len(classes), len(classes) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(size * 2 * CLASSES, np.int64)
        for batch in batches:
            lists = batch.column(0)
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()[offsets[0] : offsets[-1]]
            # Every text is followed by an end, and the first one also preceded by one.
            stream = np.insert(flat, np.append(0, offsets[1:] - offsets[0]), end)
            of = classes[stream].astype(np.int64)
            left, right = stream[:-1].astype(np.int64), stream[1:].astype(np.int64)
            table += np.bincount(left * (2 * CLASSES) + of[1:], minlength=len(table))
            table += np.bincount(right * (2 * CLASSES) + CLASSES + of[:-1], minlength=len(table))
        cell = np.flatnonzero(table)
        for at in range(0, len(cell), 1 << 16):
            part = cell[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(table[part])], names=_NEIGHBOURS.names
            )

    return run


def neighbours(encoded: DataFrame, classes: np.ndarray) -> DataFrame:
    """symbol, cells, ns: the counts of each symbol, one row with at most 2 * CLASSES of them."""
    counted = encoded.mapInArrow(_neighbours(classes), _NEIGHBOURS).groupBy("cell").agg(F.sum("n").alias("n"))
    width = 2 * CLASSES
    cell = F.struct((F.col("cell") % width).alias("cell"), "n")
    rows = counted.groupBy(F.floor(F.col("cell") / width).cast("int").alias("symbol")).agg(F.collect_list(cell).alias("cells"))
    return stored(rows.select("symbol", "cells.cell", F.col("cells.n").alias("n")), "neighbours")


def _lists_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, and of all their cells: which of them they belong to, the cell and its count."""
    cells, ns = batch.column(1), batch.column(2)
    owner = np.repeat(np.arange(batch.num_rows), cells.value_lengths().to_numpy(zero_copy_only=False))
    return batch.column(0).to_numpy(), owner, cells.flatten().to_numpy().astype(np.int64), ns.flatten().to_numpy().astype(np.float64)


def _nlogn(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


_CELLS = T.StructType().add("cell", T.IntegerType()).add("n", T.DoubleType())


def transitions(table: DataFrame, classes: np.ndarray) -> np.ndarray:
    """How often a class follows a class."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES)
        for batch in batches:
            symbol, owner, cell, n = _lists_of(batch)
            after = cell < CLASSES
            total += np.bincount(classes[symbol[owner[after]]] * CLASSES + cell[after], n[after], CLASSES * CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES * CLASSES, dtype=np.int32)), pa.array(total)], names=_CELLS.names)

    counts = np.zeros(CLASSES * CLASSES)
    for row in table.mapInArrow(add, _CELLS).groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[row["cell"]] = row["n"]
    return counts.reshape(CLASSES, CLASSES)


def likelihood(counts: np.ndarray) -> float:
    """The part of the log likelihood that depends on the classes."""
    return float(_nlogn(counts).sum() - _nlogn(counts.sum(axis=0)).sum() - _nlogn(counts.sum(axis=1)).sum())


def best_classes(
    own: np.ndarray, owner: np.ndarray, cell: np.ndarray, n: np.ndarray, counts: np.ndarray
) -> np.ndarray:
    """The class in which each word raises the likelihood most, all others staying where they are.

    ``own`` is each word's class now. A cell below CLASSES is the class of the word's followers, the others are those
    of its predecessors; ``owner`` tells whose count ``n`` is. ``counts`` has the class transitions with these words.
    """
    size = len(own)
    sides = np.zeros((2, size, CLASSES))
    np.add.at(sides, (cell // CLASSES, owner, cell % CLASSES), n)
    gain = np.zeros((size, CLASSES))
    for side, table in enumerate((counts.T, counts)):
        pick = cell // CLASSES == side
        who, beside, times = owner[pick], cell[pick] % CLASSES, n[pick][:, None]
        # The transitions without the word itself: those of its own class lack it.
        base = table[beside]
        base[np.arange(len(who)), own[who]] -= times[:, 0]
        same = np.flatnonzero(own[who] == beside)
        base[same] -= sides[1 - side, who[same]]
        np.maximum(base, 0, out=base)
        change = _nlogn(base + times) - _nlogn(base)
        order = np.argsort(who, kind="stable")
        begin = np.flatnonzero(np.append(True, np.diff(who[order]) > 0)) if len(who) else np.zeros(0, np.int64)
        if len(begin):
            gain[who[order][begin]] += np.add.reduceat(change[order], begin)
    # Where a class both precedes and follows the word, the two changes meet in one transition.
    word, class_ = np.nonzero((sides[0] > 0) & (sides[1] > 0))
    after, before = sides[0, word, class_], sides[1, word, class_]
    base = np.maximum(counts[class_, class_] - np.where(own[word] == class_, after + before, 0), 0)
    gain[word, class_] += _nlogn(base + after + before) - _nlogn(base + after) - _nlogn(base + before) + _nlogn(base)
    tokens = sides[1].sum(axis=1)[:, None]
    sizes = np.tile(counts.sum(axis=1), (size, 1))
    sizes[np.arange(size), own] -= tokens[:, 0]
    np.maximum(sizes, 0, out=sizes)
    gain -= 2 * (_nlogn(sizes + tokens) - _nlogn(sizes))
    # An empty class is as good as one in which everyone has the same neighbours; the larger one is meant.
    gain += 1e-6 * tokens * np.log1p(sizes)
    gain[:, CLASSES - 1] = -np.inf  # the end's own class
    return np.where(tokens[:, 0] > 0, gain.argmax(axis=1), own)


_WORDS = 256  # at a time


def _exchange(classes: np.ndarray, counts: np.ndarray):
    """For mapInArrow over (symbol, cells, ns): the best class of each symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _WORDS):
                symbol, owner, cell, n = _lists_of(batch.slice(at, _WORDS))
                best = best_classes(classes[symbol].astype(np.int64), owner, cell, n, counts)
                yield pa.RecordBatch.from_arrays([pa.array(symbol), pa.array(best.astype(np.int32))], names=["symbol", "class"])

    return run


def exchange(table: DataFrame, classes: np.ndarray, counts: np.ndarray, movable: np.ndarray) -> np.ndarray:
    """The classes after each movable symbol has gone where the likelihood gains most, the others staying."""
    best = table.mapInArrow(_exchange(classes, counts), "symbol int, class int").toArrow()
    after = classes.copy()
    after[best["symbol"].to_numpy()] = best["class"].to_numpy()
    return np.where(movable, after, classes)


#: Tokens that are worked on together, about.
_PACK = 1 << 19
_TOKENS = T.StructType().add("pack", T.LongType()).add("tokens", T.BinaryType())


def _open_tokens(symbols: Symbols, classes: np.ndarray, packs: int):
    """For mapInArrow over (text): every token that is no symbol of its own, and the classes of it and beside it.

    A word's hash chooses its pack; the tokens of a pack in a slice are one row.
    """
    end = CLASSES - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, _SLICE):
                found = words(part.column(0))
                symbol, _ = symbols.of(found)
                of = classes[symbol].astype(np.int32)
                stream = np.concatenate(([end], np.insert(of, np.cumsum(found.counts()), end)))
                place = np.arange(len(of)) + found.row + 1
                some = np.flatnonzero(symbol >= symbols.own)
                if not len(some):
                    continue
                pack = (mixed(found.key[some]) % np.uint64(packs)).astype(np.int64)
                order = np.argsort(pack, kind="stable")
                some, pack = some[order], pack[order]
                at = place[some]
                beside = ((stream[at] * CLASSES + stream[at + 1]) * CLASSES + stream[at - 1]).astype(np.int64)
                token = np.stack((found.key[some].view(np.int64), beside), axis=1)
                first = np.flatnonzero(np.append(True, pack[1:] != pack[:-1]))
                packed = [token[low:high].tobytes() for low, high in zip(first, np.append(first[1:], len(pack)), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(pack[first]), pa.array(packed, pa.binary())], names=_TOKENS.names)

    return run


def _combined(tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different tokens (word, beside) in order, and how often each stands there."""
    word, beside = np.concatenate(tokens, axis=1)
    order = np.lexsort((beside, word))
    word, beside = word[order], beside[order]
    first = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (beside[1:] != beside[:-1])))
    return word[first], beside[first], np.diff(np.append(first, len(word)))


_MOVED = T.StructType().add("word", T.LongType()).add("class", T.IntegerType()).add("n", T.DoubleType())


def _moves(counts: np.ndarray):
    """For applyInArrow over the tokens of a pack: the class of each word seen often enough.

    A row for each class transition, with class -1, says by how much these moves change it.
    """

    def run(table: pa.Table) -> pa.Table:
        tokens = [np.frombuffer(x.as_buffer(), np.int64).reshape(-1, 2).T for x in table.column("tokens")]
        # Tokens with the same word and neighbours are one row with their number.
        word, beside, n = _combined(tokens)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        often = np.repeat(np.add.reduceat(n, first) >= SEEN, np.diff(np.append(first, len(word))))
        word, beside, n = word[often], beside[often], n[often]
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else first[:0]
        key, own, best = word[first], beside[first] // CLASSES**2, []
        owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word))))
        cells = np.concatenate((beside // CLASSES % CLASSES, CLASSES + beside % CLASSES))
        pair, at = np.unique(np.tile(owner, 2) * (2 * CLASSES) + cells, return_inverse=True)
        n = np.bincount(at, np.tile(n, 2), len(pair))
        owner, cell = pair // (2 * CLASSES), pair % (2 * CLASSES)
        for at in range(0, len(first), _WORDS):
            part = slice(*np.searchsorted(owner, (at, at + _WORDS)))
            best.append(best_classes(own[at : at + _WORDS], owner[part] - at, cell[part], n[part], counts))
        found = np.concatenate(best) if best else own
        change = np.zeros((CLASSES, CLASSES))
        after = cell < CLASSES
        for sign, class_ in ((-1, own), (1, found)):
            np.add.at(change, (class_[owner[after]], cell[after]), sign * n[after])
            np.add.at(change, (cell[~after] - CLASSES, class_[owner[~after]]), sign * n[~after])
        cell = np.flatnonzero(change)
        columns = [
            np.concatenate((key, cell)),
            np.concatenate((found, np.full(len(cell), -1))).astype(np.int32),
            np.concatenate((np.zeros(len(key)), change.ravel()[cell])),
        ]
        return pa.table([pa.array(x) for x in columns], names=_MOVED.names)

    return run


@dataclass
class Model:
    """What training has found. ``counts`` is the table of all words but the symbols; all else has a bounded size."""

    counts: DataFrame  # word, ending, n, class
    total: int  # training tokens
    different: int  # different ones
    ends: int  # training texts
    symbols: Symbols
    classes: np.ndarray  # of each symbol
    transition: np.ndarray  # log10, from the row's class to the column's
    within: np.ndarray  # log10 of each class's tokens
    unseen: np.ndarray  # log10 of the tokens set aside for a class's unknown word
    reached: list[float]  # the likelihood after each round


def train(texts: DataFrame, text: str = "text") -> Model:
    read = texts.select(F.col(text).alias("text"))
    counted = read.mapInArrow(_count, _COUNTS)
    counts = stored(counted.groupBy("word").agg(F.first("ending").alias("ending"), F.sum("n").alias("n")), "words")
    total, different = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # At most 1 / COUNT_SHARE rows: their shares can't sum to more than one.
    common = counts.filter((F.col("n") >= total * COUNT_SHARE) & (F.col("ending") < ENDINGS)).toArrow()
    key = common["word"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    n = common["n"].to_numpy()[order]
    named = n >= total * CLASS_SHARE
    symbol = np.where(named, np.cumsum(named) - 1, -1).astype(np.int32)
    symbols = Symbols(key[order], n, symbol)

    encoded = stored(read.mapInArrow(_encode(symbols), _ENCODED), "symbols")
    # The most common symbols start in different classes. The end stays alone in the last one.
    of_word = F.col("ending") < ENDINGS
    other = counts.filter((F.col("n") < total * CLASS_SHARE) & of_word)
    endings = other.groupBy("ending").agg(F.sum("n").alias("n")).toArrow()
    tokens = np.zeros(symbols.size)
    tokens[symbol[named]] = n[named]
    tokens[symbols.own + endings["ending"].to_numpy()] = endings["n"].to_numpy()
    classes = np.zeros(symbols.size, np.int32)
    classes[np.argsort(-tokens, kind="stable")] = np.arange(symbols.size) % (CLASSES - 1)
    classes[-1] = CLASSES - 1
    random = np.random.default_rng(5)
    best, reached = (-np.inf, classes, encoded, np.zeros((CLASSES, CLASSES))), []
    for round_ in range(ROUNDS + 1):
        table = neighbours(encoded, classes)
        follow = transitions(table, classes)
        reached.append(likelihood(follow))
        if reached[-1] > best[0]:
            best = (reached[-1], classes, table, follow)
        if round_ < ROUNDS:
            movable = random.random(len(classes)) < (0.9 if round_ == 0 else 0.5)
            movable[-1] = False
            classes = exchange(best[2], best[1], best[3], movable)
    _, classes, _, follow = best

    # All other words that were seen often enough, however many they are.
    packs = max(1, int(endings["n"].to_numpy().sum()) // _PACK)
    tokens = read.mapInArrow(_open_tokens(symbols, classes, packs), _TOKENS)
    moved = stored(tokens.groupBy("pack").applyInArrow(_moves(follow), _MOVED), "moved-words")
    for row in moved.filter(F.col("class") < 0).groupBy("word").agg(F.sum("n").alias("n")).collect():
        follow[row["word"] // CLASSES, row["word"] % CLASSES] += row["n"]
    np.maximum(follow, 0, out=follow)
    by_ending = F.element_at(
        F.array(*[F.lit(int(c)) for c in classes[symbols.own :]]), F.col("ending") + 1
    )
    own_class = moved.filter(F.col("class") >= 0).select("word", "class")
    other = other.join(own_class, "word", "left").withColumn("class", F.coalesce("class", by_ending))
    other = stored(other, "word-classes")

    frequency = (follow.sum(axis=0) + 1) / (follow.sum() + CLASSES)
    transition = np.log10((follow + PRIOR * frequency) / (follow.sum(axis=1, keepdims=True) + PRIOR))
    held, members = np.zeros(CLASSES), np.zeros(CLASSES)
    np.add.at(held, classes[symbol[named]], n[named])
    np.add.at(members, classes[symbol[named]], 1)
    for row in other.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        held[row["class"]] += row["n"]
        members[row["class"]] += row["words"]
    end = counts.filter(~of_word).agg(F.sum("n")).first()[0]
    held[CLASSES - 1] += end or 0
    members[CLASSES - 1] += 1
    # A class without words in training holds an unknown word only.
    within = np.log10(np.maximum(held, 1))
    unseen = np.log10(np.where(members > 0, DISCOUNT * members, 1))
    # At most 1 / COUNT_SHARE rows again.
    theirs = other.filter(F.col("n") >= total * COUNT_SHARE).select("word", "class").toArrow()
    class_ = np.where(symbol >= 0, classes[symbol], 0)
    class_[np.searchsorted(symbols.key, theirs["word"].to_numpy().view(np.uint64))] = theirs["class"].to_numpy()
    symbols.class_ = class_
    return Model(other, int(total), int(different), int(end or 0), symbols, classes, transition, within, unseen, reached)


_PARTS = (
    T.StructType()
    .add("row", T.LongType())
    .add("doc_id", T.LongType())
    .add("place", T.LongType())
    .add("word", T.LongType())
    .add("ending_class", T.IntegerType())
    .add("before", T.IntegerType())
    .add("after", T.IntegerType())
    .add("n_tokens", T.LongType())
    .add("n_known", T.LongType())
    .add("base", T.DoubleType())
    .add("score", T.DoubleType())
)


def _parts(model: Model):
    """Per text one row with all that the task knows, and one for each token whose word it doesn't know.

    Such a token has its place, and the classes before and behind it where the task knows those (else -1).
    """
    symbols, classes, transition, within = model.symbols, model.classes, model.transition, model.within
    every = np.log10(model.total + model.different + 1)
    end = CLASSES - 1
    end_base = np.log10(model.ends + 1) - every
    end_score = np.log10(model.ends - DISCOUNT) - within[end]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, _SLICE):
                found = words(part.column(2))
                texts = part.num_rows
                of, count = symbols.classes_of(found, classes)
                known = count > 0
                size = found.counts()
                at = np.cumsum(size)
                stream = np.insert(of, at, end)
                sure = np.insert(known, at, True)
                before, sure_before = np.append(end, stream[:-1]), np.append(True, sure[:-1])
                row = np.repeat(np.arange(texts), size + 1)
                both = sure & sure_before
                score = np.bincount(row[both], transition[before[both], stream[both]], texts) + end_score
                value = np.log10(np.maximum(count, 1) - DISCOUNT) - within[of]
                score += np.bincount(found.row[known], value[known], texts)
                base = np.bincount(found.row[known], np.log10(count[known] + 1), texts) - size * every + end_base
                n_known = np.bincount(found.row[known], minlength=texts) + 1
                rows = part.column(0)
                null, none = pa.nulls(texts, pa.int64()), pa.nulls(texts, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows, part.column(1), null, null, none, none, none,
                        pa.array(size + 1), pa.array(n_known), pa.array(base), pa.array(score),
                    ],
                    names=_PARTS.names,
                )
                open_ = np.flatnonzero(~known)
                if not len(open_):
                    continue
                place = open_ + found.row[open_]
                left = np.where(sure_before[place], before[place], -1)
                right = np.where(sure[place + 1], stream[place + 1], -1)
                null, unknown = pa.nulls(len(open_), pa.int64()), pa.nulls(len(open_), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.take(pa.array(found.row[open_])), null, pa.array(place), pa.array(found.key[open_].view(np.int64)),
                        *[pa.array(x.astype(np.int32)) for x in (of[open_], left, right)],
                        null, null, unknown, unknown,
                    ],
                    names=_PARTS.names,
                )

    return run


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: id, n_tokens, n_known, base_score, score, perplexity.

    ``base_score`` is the log10 probability under add-one unigrams, ``score`` that under the model.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
    )
    if not model.total:
        split = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
        zero = F.lit(0.0)
        return rows.select(
            F.col("doc_id").alias(id_column),
            (F.size(split) + 1).cast("long").alias("n_tokens"),
            F.lit(0).cast("long").alias("n_known"),
            zero.alias("base_score"),
            zero.alias("score"),
            F.lit(1.0).alias("perplexity"),
        )
    parts = stored(rows.mapInArrow(_parts(model), _PARTS), "scored-parts")
    rare = model.counts.filter(F.col("n") < model.total * COUNT_SHARE).select("word", "n", "class")

    def value_of(values: np.ndarray, index: Column) -> Column:
        return F.element_at(F.array(*[F.lit(float(x)) for x in values.ravel()]), (index + 1).cast("int"))

    def step(first: Column, second: Column) -> Column:
        return value_of(model.transition, first * CLASSES + second)

    # Neighbours that both had to be joined follow each other in the text, so a window finds the one before.
    joined = parts.filter(F.col("place").isNotNull()).join(rare, "word", "left")
    joined = joined.withColumn("class", F.coalesce("class", "ending_class"))
    follows = F.lag("class").over(Window.partitionBy("row").orderBy("place"))
    joined = joined.withColumn("before", F.when(F.col("before") >= 0, F.col("before")).otherwise(follows))
    n, class_ = F.col("n"), F.col("class")
    token = F.when(n.isNotNull(), F.log10(n - DISCOUNT)).otherwise(value_of(model.unseen, class_))
    token = token - value_of(model.within, class_) + step(F.col("before"), class_)
    token = token + F.when(F.col("after") >= 0, step(class_, F.col("after"))).otherwise(0.0)
    looked_up = joined.groupBy("row").agg(
        F.count("n").alias("n_known"),
        F.sum(F.log10(F.coalesce(n, F.lit(0)) + 1)).alias("base"),
        F.sum(token).alias("score"),
    )
    own = parts.filter(F.col("place").isNull()).select("row", "doc_id", "n_tokens", "n_known", "base", "score")
    joined = own.unionByName(looked_up, allowMissingColumns=True)
    return (
        joined.groupBy("row")
        .agg(
            F.max("doc_id").alias(id_column),
            F.max("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.sum("base").alias("base_score"),
            F.sum("score").alias("score"),
        )
        .drop("row")
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
    )
