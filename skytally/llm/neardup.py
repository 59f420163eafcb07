"""Near copies: a Jaccard join on runs of five words, with MinHash bands for candidates.

1. One pass over the texts gives each a digest of its words, the number of its different runs and its bands: keys
   made of ``rows`` MinHash values each. ``banding`` chooses rows and bands for the wanted recall.
2. Texts with the same words are one class from here on, represented by their smallest id.
3. Representatives are shuffled on their band keys. In every bucket the smallest id is the hub, and each other
   member is compared with the hub, not with every member.
4. Compared means verified: the Jaccard similarity of the complete sets of runs. Linked texts form components.
5. What the hubs leave open is settled in two more rounds. Members of a bucket meet in random blocks of a few, which
   joins most of what belongs together. Then all texts of buckets with several components are compared exactly, without
   bands: their runs are put in order of the number of texts that hold them, rarest first. Two texts as similar as
   wanted share a run among their first ones, a fifth of the larger text's and a ninth of the smaller one's, so a join on
   these runs misses none (a prefix filter). Pairs must be of different components, their sizes must fit, and their first
   common run must leave enough runs behind it on both sides. Texts that share most of their runs but are less alike
   have runs of their own in front, and don't meet at all.
6. Pairs of both rounds go on to step 4 if their sketches, four bits of every MinHash value, differ in no more bits than
   ``SKETCH_RECALL`` of all pairs at the threshold do; texts of few runs go on in any case.

A bucket whose members are near copies of each other is done after step 3, with one row for each member: a group of
copies that holds a third of all rows never becomes pairs of all its members.

``jaccard_links`` also counts the links of each document. Linked documents are in one component, so every two
representatives of a component are compared, by their complete sets of runs and without bands or sketches. A component
is dealt into blocks of at most about ``LINK_DOCS`` representatives or ``LINK_RUNS`` runs, and each two blocks meet in
one task: rows grow with members times blocks, comparisons with the square of the component, as the counts do.

Where texts have few different ways to differ, so that even their rarest runs are shared by many, the join of step 5 grows
with the squares of these numbers.

Words are what stands between white space, A-Z in lower case. A text of one to four words has one run, all of it. Null
and empty texts have the same (no) words and are one class. Of a class the smallest id counts. A very long text is read
whole; its sets of runs are rows and arrays of that length. Ids are whole numbers; rows without one are left out,
repeated rows are one document. Other columns of the table are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from operator import add
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.components import components
from skytally.llm.storage import stored, with_row
from skytally.llm.words import Words, grams, mixed, slices, words

RUN, SIMILARITY, RECALL = 5, 0.8, 0.9995
#: MinHash values of one text at most.
HASHES = 160
#: MinHash values behind a sketch; the bands are made of the first ones of them.
SKETCH_HASHES = 256
#: Share of the pairs at the threshold whose sketches pass, and runs from which a text's sketch is looked at.
SKETCH_RECALL, SKETCH_RUNS = 0.9999, 64
#: Members of a random block, about.
BLOCK = 4
#: Representatives, or runs of theirs, in a block of a component whose links are counted, about.
LINK_DOCS, LINK_RUNS = 2048, 1 << 20


def banding(similarity: float = SIMILARITY, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Rows and bands: the most rows (fewest idle candidates) that reach the recall at the similarity."""

    def bands(rows: int) -> int:
        return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))

    best = 1
    while (best + 1) * bands(best + 1) <= hashes:
        best += 1
    return best, bands(best)


def run_sets(found: Words, n: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of every run of ``n`` words; a text with fewer words is one run."""
    first, key = grams(found, n)
    row = found.row[first]
    count = found.counts()
    begin = np.cumsum(count) - count
    for short in np.flatnonzero((count > 0) & (count < n)):
        keys = found.key[begin[short] : begin[short] + count[short]]
        whole = np.frombuffer(hashlib.sha256(keys.tobytes()).digest(), "<u8", 1)
        row, key = np.append(row, short), np.append(key, whole)
    if (np.diff(row) < 0).any():
        order = np.argsort(row, kind="stable")
        row, key = row[order], key[order]
    return row, key


def _coefficients(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(11)
    return random.integers(0, 2**32, (2, hashes), dtype=np.uint32) | np.array([[1], [0]], np.uint32)


def minhashes(row: np.ndarray, key: np.ndarray, texts: int, hashes: int) -> np.ndarray:
    """MinHash values (texts x hashes); rows of texts without runs are not meaningful."""
    values = np.full((texts, hashes), 0xFFFFFFFF, np.uint32)
    if len(row):
        begin = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        present = row[begin]
        low = (key >> np.uint64(32)).astype(np.uint32)
        for at, (factor, shift) in enumerate(zip(*_coefficients(hashes), strict=True)):
            values[present, at] = np.minimum.reduceat(low * factor + shift, begin)
    return values


def band_keys(values: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """Band keys (texts x bands), each made of ``rows`` values."""
    texts = len(values)
    folded = np.arange(bands, dtype=np.uint64) * np.ones((texts, 1), np.uint64)
    wide = values.astype(np.uint64).reshape(texts, bands, rows)
    for at in range(rows):
        folded = mixed(folded * np.uint64(0x9E3779B97F4A7C15) + wide[:, :, at] + np.uint64(1))
    return folded.view(np.int64)


def sketches(values: np.ndarray) -> np.ndarray:
    """Four bits of every value, in 64-bit numbers."""
    nibbles = values & np.uint32(15)
    nibbles = np.pad(nibbles, ((0, 0), (0, -values.shape[1] % 16))).reshape(len(values), -1, 16).astype(np.uint64)
    return np.bitwise_or.reduce(nibbles << (np.uint64(4) * np.arange(16, dtype=np.uint64)), axis=2).view(np.int64)


def sketch_bits(hashes: int, similarity: float, recall: float = SKETCH_RECALL) -> int:
    """In how many bits two sketches may differ.

    A value that differs, as 1 - similarity of them do, differs in two of four bits on average.
    """
    apart = 1 - similarity
    deviation = math.sqrt(hashes * (5 * apart - 4 * apart**2))
    return math.ceil(2 * apart * hashes + NormalDist().inv_cdf(recall) * deviation)


_SIGNATURES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("runs", T.IntegerType()),
        T.StructField("bands", T.ArrayType(T.LongType(), False)),
        T.StructField("sketch", T.ArrayType(T.LongType(), False)),
    ]
)


def signatures(docs: DataFrame, id_column: str, text: str, rows: int, bands: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                found = words(part.column(1))
                count = found.counts()
                end = np.cumsum(count)
                begin = end - count
                digests = [
                    hashlib.sha256(found.key[b:e].tobytes()).digest()[:16] for b, e in zip(begin, end, strict=True)
                ]
                row, key = run_sets(found)
                texts = part.num_rows
                values = minhashes(row, key, texts, max(SKETCH_HASHES, rows * bands))
                keys, sketch = band_keys(values[:, : rows * bands], rows, bands), sketches(values)
                # A text without words is in no bucket.
                inside = np.bincount(row, minlength=texts) > 0
                offsets = np.concatenate(([0], np.cumsum(inside * bands))).astype(np.int32)
                order = np.lexsort((key, row))
                row, key = row[order], key[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
                different = np.bincount(row[new], minlength=texts).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[inside].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(digests, pa.binary()), pa.array(different), lists,
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(texts + 1, dtype=np.int32) * sketch.shape[1]), pa.array(sketch.ravel())
                        ),
                    ],
                    names=_SIGNATURES.names,
                )

    known = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return known.filter("id is not null").mapInArrow(run, _SIGNATURES)


def _members(column: pa.Array, bits: int) -> np.ndarray:
    """The different runs of each text in order: the row in the upper ``bits``, the run's key below."""
    row, key = run_sets(words(column))
    packed = (row.astype(np.uint64) << np.uint64(64 - bits)) | (key >> np.uint64(bits))
    packed.sort()
    return packed[np.concatenate(([True], packed[1:] != packed[:-1]))] if len(packed) else packed


def _different(column: pa.Array) -> pa.ListArray:
    """The different runs of each text, in order."""
    row, key = run_sets(words(column))
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    offsets = np.concatenate(([0], np.cumsum(np.bincount(row[new], minlength=len(column)))))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(key[new].view(np.int64)))


def jaccard(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Similarity of the sets of runs of two texts, row by row."""
    size = len(left)
    bits = max(1, size.bit_length())
    a, b = _members(left, bits), _members(right, bits)
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = both[1:][both[1:] == both[:-1]]
    count = lambda packed: np.bincount((packed >> np.uint64(64 - bits)).astype(np.int64), minlength=size)
    common = count(shared)
    return common / np.maximum(1, count(a) + count(b) - common)


_PAIRS = T.StructType(
    [T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("similarity", T.DoubleType())]
)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 2, 1 << 20):
            found = jaccard(part.column(2), part.column(3))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found)], names=_PAIRS.names)


def verified(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """Similarity of each pair (a, b), from the complete texts (id, text)."""
    pairs = stored(pairs, f"{name}-candidates")
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return stored(both.mapInArrow(_verify, _PAIRS), f"{name}-verified")


def _sizes_fit(a: Column, b: Column, similarity: float) -> Column:
    """Sets whose sizes differ more can't be so similar."""
    return F.least(a, b) >= F.greatest(a, b) * (similarity - 1e-9)


def _alike(a: Column, b: Column, runs: Column, other_runs: Column, hashes: int, similarity: float) -> Column:
    """Whether two sketches let a pair pass."""
    differ = reduce(add, [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(math.ceil(hashes / 16))])
    return (F.least(runs, other_runs) < SKETCH_RUNS) | (differ <= sketch_bits(hashes, similarity))


def _meeting(left: DataFrame, hashes: int, similarity: float) -> DataFrame:
    """Pairs (a, b) of members of one bucket and random block, of different components, that may be similar."""
    own = ("id", "runs", "component", "pivot", "sketch")
    right = left.select("bucket", "block", *[F.col(c).alias(f"other_{c}") for c in own])
    # Distances from the hub can't differ by more than the pair's own: the Jaccard distance is a metric.
    farther = F.abs(F.col("pivot") - F.col("other_pivot")) > 1 - similarity + 1e-9
    may = (
        (F.col("id") < F.col("other_id"))
        & (F.col("component") != F.col("other_component"))
        & _sizes_fit(F.col("runs"), F.col("other_runs"), similarity)
        & ~F.coalesce(farther, F.lit(False))
        & _alike(F.col("sketch"), F.col("other_sketch"), F.col("runs"), F.col("other_runs"), hashes, similarity)
    )
    met = left.join(right, ["bucket", "block"]).filter(may)
    return met.select(F.col("id").alias("a"), F.col("other_id").alias("b")).distinct()


_KEYS = T.StructType().add("id", T.LongType()).add("keys", T.ArrayType(T.LongType(), False))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different runs of each text (id, text)."""
    for batch in batches:
        for part in slices(batch, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), _different(part.column(1))], names=_KEYS.names)


def open_pairs(members: DataFrame, texts: DataFrame, hashes: int, similarity: float) -> DataFrame:
    """Pairs (a, b) of ``members`` (id, component, sketch), of different components, that may be similar; none is lost
    but by its sketches."""
    members = members.dropDuplicates(["id"])
    sets = stored(texts.join(members.select("id"), "id", "left_semi").select("id", "text").mapInArrow(_keys, _KEYS), "open-sets")
    rows = sets.select("id", F.size("keys").alias("runs"), F.explode("keys").alias("run"))
    holders = rows.groupBy("run").agg(F.count("*").alias("holders"))
    order = Window.partitionBy("id").orderBy("holders", "run")
    ranked = rows.join(holders, "run").withColumn("place", F.row_number().over(order))
    size = F.col("runs")
    first = size - F.ceil(size * similarity - 1e-6) + 1
    ranked = ranked.filter((F.col("place") <= first) & (F.col("holders") > 1))
    ranked = stored(ranked.join(members.select("id", "component"), "id"), "rarest-runs")
    ends = ranked.groupBy("run").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    ranked = ranked.join(ends.filter("low <> high").select("run"), "run", "left_semi")
    smaller = ranked.filter(F.col("place") <= size - F.ceil(size * (2 * similarity / (1 + similarity)) - 1e-6) + 1)
    larger = ranked.select("run", *[F.col(c).alias(f"other_{c}") for c in ("id", "runs", "place", "component")])
    behind = F.least(size - F.col("place"), F.col("other_runs") - F.col("other_place")) + 1
    may = (
        (F.col("component") != F.col("other_component"))
        & ((size < F.col("other_runs")) | ((size == F.col("other_runs")) & (F.col("id") < F.col("other_id"))))
        & _sizes_fit(size, F.col("other_runs"), similarity)
        & (behind >= (size + F.col("other_runs")) * (similarity / (1 + similarity)) - 1e-6)
    )
    met = smaller.join(larger, "run").filter(may)
    met = stored(met.select("id", "runs", "other_id", "other_runs").distinct(), "open-pairs")
    signs = members.select("id", "sketch")
    others = signs.select(F.col("id").alias("other_id"), F.col("sketch").alias("other_sketch"))
    met = met.join(signs, "id").join(others, "other_id")
    passing = met.filter(
        _alike(F.col("sketch"), F.col("other_sketch"), F.col("runs"), F.col("other_runs"), hashes, similarity)
    )
    return passing.select(F.least("id", "other_id").alias("a"), F.greatest("id", "other_id").alias("b"))


def _joined(
    docs: DataFrame, id_column: str, text: str, similarity: float, recall: float
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Copies (digest, member, copy_of), linked representatives (copy_of, component, runs, n_links), texts (id, text)."""
    rows, bands = banding(similarity, recall)
    signed = stored(signatures(docs, id_column, text, rows, bands), "signatures")
    least = F.min(F.struct("id", "runs", "bands", "sketch")).alias("least")
    classes = stored(signed.groupBy("digest").agg(least).select("digest", "least.*"), "copy-classes")
    copies = signed.select("digest", F.col("id").alias("member")).distinct()
    copies = stored(copies.join(classes.select("digest", F.col("id").alias("copy_of")), "digest"), "copies")

    placed = classes.select("id", "runs", F.posexplode("bands").alias("band", "bucket"))
    shared = placed.groupBy("bucket").agg(F.min(F.struct("id", "runs")).alias("hub"), F.count("*").alias("n"))
    shared = stored(shared.filter("n > 1"), "buckets")
    members = stored(placed.join(shared, "bucket"), "bucket-members")
    wanted = members.select("id").distinct()
    whole = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    texts = stored(whole.join(wanted, "id", "left_semi").dropDuplicates(["id"]), "candidate-texts")

    fits = _sizes_fit(F.col("runs"), F.col("hub.runs"), similarity)
    others = members.filter((F.col("id") != F.col("hub.id")) & fits)
    stars = others.select(F.col("hub.id").alias("a"), F.col("id").alias("b"))
    compared = from_hub = verified(stars.distinct(), texts, "hub")
    pivots = from_hub.select(F.col("a").alias("hub_id"), F.col("b").alias("id"), F.col("similarity").alias("pivot"))
    members = (
        members.withColumn("hub_id", F.col("hub.id"))
        .join(pivots, ["hub_id", "id"], "left")
        .withColumn("pivot", F.when(F.col("id") == F.col("hub_id"), 1.0).otherwise(F.col("pivot")))
    )
    members = stored(members.select("bucket", "band", "n", "id", "runs", "pivot"), "members-from-hub")
    linked = compared.filter(F.col("similarity") >= similarity)
    for everyone in (False, True):
        joined = components(linked)
        at = members.join(joined.withColumnRenamed("node", "id"), "id", "left")
        at = stored(at.withColumn("component", F.coalesce("component", "id")), "members-by-component")
        # Buckets with more than one component.
        ends = at.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        apart = at.join(ends.filter("low <> high").select("bucket"), "bucket", "left_semi")
        open_ = apart.join(classes.select("id", "sketch"), "id")
        hashes = max(SKETCH_HASHES, rows * bands)
        if everyone:
            pairs = open_pairs(open_.select("id", "component", "sketch"), texts, hashes, similarity)
        else:
            block = F.pmod(F.xxhash64("id", "bucket"), F.ceil(F.col("n") / BLOCK))
            pairs = _meeting(stored(open_.withColumn("block", block), "open-members"), hashes, similarity)
        pairs = pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti")
        compared = compared.union(verified(pairs, texts, "all" if everyone else "block"))
        linked = compared.filter(F.col("similarity") >= similarity)
    joined = components(linked)
    ends = linked.select("a").union(linked.select("b"))
    links = stored(ends.groupBy("a").agg(F.count("*").alias("n_links")), "links")
    runs = classes.select(F.col("id").alias("copy_of"), "runs")
    found = links.join(joined, links.a == joined.node).select(F.col("a").alias("copy_of"), "component", "n_links")
    return copies, stored(found.join(runs, "copy_of"), "linked"), texts


def _by_document(copies: DataFrame, found: DataFrame, id_column: str) -> DataFrame:
    return copies.join(found, "copy_of", "left").select(
        F.col("member").alias(id_column),
        F.coalesce("component", "copy_of").alias("class_id"),
        "copy_of",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """One row per document: id, class_id (smallest id of its near copies), copy_of, n_links.

    ``copy_of`` is the smallest id among documents with the same words; ``n_links`` counts only those links of that
    document that were verified on the way to the classes, see ``jaccard_links`` for all of them.
    """
    copies, found, _ = _joined(docs, id_column, text, similarity, recall)
    return _by_document(copies, found, id_column)


_SETS = (
    T.StructType()
    .add("id", T.LongType())
    .add("component", T.LongType())
    .add("copies", T.LongType())
    .add("blocks", T.LongType())
    .add("own", T.LongType())
    .add("keys", T.ArrayType(T.LongType(), False))
)
_LINKS = T.StructType().add("id", T.LongType()).add("n_links", T.LongType())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, batch.schema.get_field_index("text")):
            lists = _different(part.column("text"))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in _SETS.names[:-1]], lists], names=_SETS.names)


def common_runs(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """In how many runs each set on the left and each on the right agree; a set has a run once."""
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))

    def placed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        key = np.concatenate(sets)
        at = np.minimum(np.searchsorted(shared, key), max(0, len(shared) - 1))
        known = shared[at] == key if len(shared) else np.zeros(len(key), bool)
        row, at = row[known], at[known]
        order = np.argsort(at, kind="stable")
        return row[order], at[order], np.bincount(at, minlength=len(shared))

    (a_row, a_at, a_count), (b_row, b_at, b_count) = placed(left), placed(right)
    found = np.zeros((len(left), len(right)))
    # Runs of many sets as a product of 0-1 matrices, a few thousand runs at once; the others pair by pair.
    many = a_count * b_count * 512 > len(left) * len(right)
    number = np.cumsum(many) - 1
    for low in range(0, int(many.sum()), 4096):
        sides = []
        for row, at, size in ((a_row, a_at, len(left)), (b_row, b_at, len(right))):
            inside = many[at] & (number[at] >= low) & (number[at] < low + 4096)
            marks = np.zeros((size, min(4096, int(many.sum()) - low)), np.float32)
            marks[row[inside], number[at[inside]] - low] = 1
            sides.append(marks)
        found += sides[0] @ sides[1].T
    begin = np.cumsum(b_count) - b_count
    few = np.flatnonzero(~many[a_at])
    times = b_count[a_at[few]]
    ends = np.cumsum(times)
    start = 0
    while start < len(few):  # a million pairs at once
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + (1 << 20), side="right")))
        n = times[start:stop]
        other = np.repeat(begin[a_at[few[start:stop]]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        np.add.at(found, (np.repeat(a_row[few[start:stop]], n), b_row[other]), 1)
        start = stop
    return found


def _count_links(similarity: float):
    """For applyInArrow: links between two blocks of one component, or inside several whole components."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        component, own = table.column("component").to_numpy(), table.column("own").to_numpy()
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        lists = table.column("keys").combine_chunks()
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        links = np.zeros(len(ids), np.int64)
        order = np.argsort(component, kind="stable")
        new = np.concatenate(([True], component[order[1:]] != component[order[:-1]]))
        for rows in np.split(order, np.flatnonzero(new)[1:]):
            left, right = (rows[own[rows] == low], rows[own[rows] == high]) if low < high else (rows, rows)
            if not (len(left) and len(right)):
                continue
            sets = [[values[offsets[r] : offsets[r + 1]] for r in side] for side in (left, right)]
            sizes = [np.array([len(x) for x in side], np.float64) for side in sets]
            common = common_runs(*sets).astype(np.float64)
            linked = common / np.maximum(1, sizes[0][:, None] + sizes[1] - common) >= similarity
            if low < high:
                links[right] += copies[left] @ linked
            else:
                np.fill_diagonal(linked, False)
            links[left] += linked @ copies[right]
        return pa.table({"id": pa.array(ids), "n_links": pa.array(links)})

    return run


def jaccard_links(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    block_docs: int = LINK_DOCS,
    block_runs: int = LINK_RUNS,
) -> DataFrame:
    """One row per document: id, class_id and copy_of as ``near_duplicates`` gives them, n_links.

    ``n_links`` is the number of documents of the class, with other words, whose similarity is high enough.
    """
    copies, found, texts = _joined(docs, id_column, text, similarity, recall)
    times = copies.groupBy("copy_of").agg(F.count("*").alias("copies"))
    members = found.drop("n_links").join(times, "copy_of")
    sizes = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("runs").alias("all_runs"))
    blocks = F.greatest(F.ceil(F.col("n") / block_docs), F.ceil(F.col("all_runs") / block_runs))
    sizes = stored(sizes.withColumn("blocks", blocks.cast("long")), "component-sizes")
    whole = F.sum(F.when(F.col("blocks") == 1, F.col("all_runs")))
    packs = math.ceil((sizes.agg(whole).first()[0] or 1) / block_runs)
    members = members.join(sizes.select("component", "blocks"), "component").select(
        F.col("copy_of").alias("id"), "component", "copies", "blocks", F.pmod(F.xxhash64("copy_of"), "blocks").alias("own")
    )
    sets = stored(texts.join(members, "id").select(*_SETS.names[:-1], "text").mapInArrow(_sets, _SETS), "run-sets")
    # Whole components fill packs, those of several blocks have a cell for each two blocks.
    pack = F.pmod(F.xxhash64("component"), F.lit(packs))
    cells = sets.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        (F.col("blocks") > 1).alias("divided"),
        F.when(F.col("blocks") > 1, F.col("component")).otherwise(pack).alias("part"),
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        *[c for c in _SETS.names if c != "blocks"],
    )
    counted = cells.groupBy("divided", "part", "low", "high").applyInArrow(_count_links(similarity), _LINKS)
    links = stored(counted.groupBy("id").agg(F.sum("n_links").alias("n_links")), "all-links")
    all_links = found.drop("n_links").join(links.withColumnRenamed("id", "copy_of"), "copy_of")
    return _by_document(copies, all_links, id_column)


def drop_near(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class, the one with the smallest id. Rows are judged by their text, also those
    without id and those that share one; an id comes before none, equal ids are decided by the order of the rows."""
    docs, row = with_row(docs, "near-rows")
    classes = near_duplicates(docs, row, text).select(row, "class_id")
    named = classes.join(docs.select(row, F.col(id_column).alias("named")), row)
    first = F.min(F.struct(F.col("named").isNull().alias("none"), "named", F.col(row).alias("kept")))
    stay = stored(named.groupBy("class_id").agg(first.alias("first")).select(F.col("first.kept").alias(row)), "near-kept")
    return docs.join(stay, row, "left_semi").drop(row)
