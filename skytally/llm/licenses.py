"""License statements by diagonal voting.

1. Tasks hash every run of three words of every text. A run that stands in some template is kept with its place and
   the words around it, as numbers of template words.
2. The runs join the places of the templates where they stand. A template that begins at word p of a text puts all its
   runs on the diagonal p (place in the text less place in the template); rows are counted by diagonal.
3. Neighbouring diagonals of a template are merged, which bridges inserted and missing words: they may lie ``GAP`` of
   the template's length apart, but at least three words.
4. The span is verified: of the template's words ``SHARE`` must stand there in their order, and all words that tell one
   license from another (``TELLING``). So a statement counts however long it is, with a word put in or left out.

The phrases are exact: they count where one diagonal has all their runs, that is word by word, and are not merged.

A text is one row of the result, repeated ids included. Null and texts of fewer than three words have no spans. Of copies
that overlap in the same template the merged one counts. Very long texts are read whole, in slices that hold one text
at least; a run that repeats very often is one row for each place. An empty table gives an empty result. Only the id and
text columns are looked at, so other columns can't clash. The templates are fixed, a few kilobytes, hence broadcast.
Words are compared by 64-bit keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.words import grams, slices, words

#: Words of a run.
K = 3
#: Share of a statement's words that must be found.
SHARE = 0.8
#: Share of a statement's length by which diagonals of one copy may differ.
GAP = 0.4
#: Words that tell a license from others: where a statement has one, it must be found.
TELLING = frozenset({"lesser", "affero", "2", "3", "mozilla", "noncommercial", "sharealike"})

# Phrases that name a license, and its label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further statements, from the public texts of the licenses.
STATEMENTS = {
    "gnu general public license version 3": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met": "bsd",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}


_BYTES = np.arange(256)
_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)


def _gap(size: int) -> int:
    return max(3, int(GAP * size))


class Templates:
    """Phrases and statements as keys of words and runs."""

    def __init__(self, phrases: dict[str, str], statements: dict[str, str]) -> None:
        self.texts = [*phrases, *statements]
        self.labels = [*phrases.values(), *statements.values()]
        found = words(pa.array(self.texts), _WORD)
        first, run = grams(found, K)
        place = found.place()
        self.words = np.unique(found.key)
        number = np.searchsorted(self.words, found.key)
        self.numbers = [number[found.row == t] for t in range(len(self.texts))]
        self.telling = [np.array([w in TELLING for w in text.split()]) for text in self.texts]
        self.sizes = [len(n) for n in self.numbers]
        #: Template, place and key of every run.
        self.runs = list(zip(found.row[first].tolist(), place[first].tolist(), run.view(np.int64).tolist(), strict=True))
        self.known = np.unique(run)
        longest = max(self.sizes)
        #: Words before and behind a run that a copy around it can reach.
        self.before, self.behind = longest + _gap(longest), 2 * (longest + _gap(longest))

    def share(self, template: int, around: np.ndarray, low: int, high: int) -> tuple[float, int, int]:
        """Share of the template's words in their order within a stretch of numbers, and where they begin and end."""
        own, inside = self.numbers[template], around[max(0, low) : max(0, high)]
        # Longest common subsequence; of equal ones the shortest, then the first stretch.
        best = [[(0, 0, 0)] * (len(inside) + 1) for _ in range(len(own) + 1)]
        for i, a in enumerate(own, 1):
            for j, b in enumerate(inside, 1):
                if a == b:
                    n, start, _ = best[i - 1][j - 1]
                    here = (n + 1, start if n else j - 1, j)
                    best[i][j] = max(here, best[i - 1][j], best[i][j - 1], key=lambda x: (x[0], x[1] - x[2]))
                else:
                    best[i][j] = max(best[i - 1][j], best[i][j - 1], key=lambda x: (x[0], x[1] - x[2]))
        n, start, end = best[-1][-1]
        stretch = set(inside[start:end].tolist())
        if any(number not in stretch for number in own[self.telling[template]]):
            return 0.0, 0, 0
        return n / len(own), max(0, low) + start, max(0, low) + end


_RUN = T.StructType().add("at", T.LongType()).add("run", T.LongType()).add("around", T.ArrayType(T.IntegerType()))
_READ = (
    T.StructType().add("row", T.LongType()).add("n_words", T.LongType()).add("hits", T.ArrayType(_RUN))
)


def _hits(templates: Templates):
    """For mapInArrow over (row, id, text): the number of words, and the runs that stand in a template."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = templates.known
        for batch in batches:
            for part in slices(batch, 2):
                found = words(part.column(2), _WORD)
                first, key = grams(found, K)
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                hit = np.flatnonzero(known[at] == key)
                word, key = first[hit], key[hit]
                count = found.counts()
                begin = np.cumsum(count) - count
                row = found.row[word]
                low = np.maximum(begin[row], word - templates.before)
                high = np.minimum(begin[row] + count[row], word + templates.behind)
                size = high - low
                inside = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
                place = np.minimum(np.searchsorted(templates.words, found.key[inside]), len(templates.words) - 1)
                number = np.where(templates.words[place] == found.key[inside], place, -1).astype(np.int32)
                around = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(number)
                )
                runs = pa.StructArray.from_arrays(
                    [pa.array(word - begin[row]), pa.array(key.view(np.int64)), around], names=_RUN.names
                )
                offsets = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=part.num_rows)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(count.astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), runs)],
                    names=["row", "id", "n_words", "hits"],
                )

    return run


_FOUND = T.StructType().add("share", T.DoubleType()).add("start", T.LongType()).add("end", T.LongType())


def _verified(templates: Templates):
    """Share, first word and word behind the last one of a copy, from its diagonals and the words around its first run."""

    @F.arrow_udf(_FOUND)
    def verify(template: pa.Array, first: pa.Array, last: pa.Array, at: pa.Array, around: pa.Array) -> pa.Array:
        rows = []
        for t, low, high, place, near in zip(template, first, last, at, around, strict=True):
            t, low, high, place = t.as_py(), low.as_py(), high.as_py(), place.as_py()
            if t is None:
                rows.append(None)
                continue
            size = templates.sizes[t]
            zero = place - min(place, templates.before)  # the place of the first number around
            share, start, end = templates.share(
                t, near.values.to_numpy(), low - _gap(size) - zero, high + size + _gap(size) - zero
            )
            rows.append({"share": share, "start": zero + start, "end": zero + end})
        return pa.array(rows, pa.struct([("share", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    return verify


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] = PHRASES,
    statements: dict[str, str] = STATEMENTS,
) -> DataFrame:
    """One row per text: id, n_words, spans (label, start, end, share, exact phrase or not), in words from 0."""
    spark = docs.sparkSession
    templates = Templates(phrases, statements)
    read = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(text).cast("string").alias("text")
    )
    shape = T.StructType([_READ["row"], read.schema["id"], *_READ.fields[1:]])
    hits = read.mapInArrow(_hits(templates), shape).select("row", "id", "n_words", F.explode_outer("hits").alias("hit"))
    values = ", ".join(f"({t}, {templates.sizes[t]}, {at}, {run}L)" for t, at, run in templates.runs)
    known = F.broadcast(spark.sql(f"SELECT * FROM VALUES {values} AS runs(template, size, place, run)"))
    joined = hits.join(known, F.col("hit.run") == F.col("run"), "left").withColumn("diagonal", F.col("hit.at") - F.col("place"))

    exact = F.col("template") < len(phrases)
    voted = joined.groupBy("row", "template", "diagonal").agg(
        F.first("id").alias("id"),
        F.first("n_words").alias("n_words"),
        F.first("size").alias("size"),
        F.count("*").alias("votes"),
        F.min(F.struct("hit.at", "hit.around")).alias("first"),
    )
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    near = F.col("diagonal") - F.lag("diagonal").over(order) <= F.greatest(F.lit(3), F.floor(F.col("size") * GAP))
    copies = (
        voted.withColumn("new", F.when(~exact & near, 0).otherwise(1))
        .withColumn("copy", F.sum("new").over(order))
        .groupBy("row", "template", "copy")
        .agg(
            F.first("id").alias("id"),
            F.first("n_words").alias("n_words"),
            F.first("size").alias("size"),
            F.max("votes").alias("votes"),
            F.min("diagonal").alias("low"),
            F.max("diagonal").alias("high"),
            F.min("first").alias("first"),
        )
    )
    whole = F.col("votes") == F.col("size") - (K - 1)
    asked = F.when(~exact, F.col("template"))
    copies = copies.withColumn("found", _verified(templates)(asked, "low", "high", "first.at", "first.around"))
    label = F.element_at(F.array(*[F.lit(v) for v in templates.labels]), F.col("template") + 1)
    span = F.when(
        exact,
        F.when(
            whole,
            F.struct(
                label.alias("label"), F.col("low").alias("start"), (F.col("low") + F.col("size")).alias("end"),
                F.lit(1.0).alias("share"), F.lit(True).alias("phrase"),
            ),
        ),
    ).otherwise(
        F.when(
            F.col("found.share") >= SHARE - 1e-9,
            F.struct(
                label.alias("label"), F.col("found.start").alias("start"), F.col("found.end").alias("end"),
                F.col("found.share").alias("share"), F.lit(False).alias("phrase"),
            ),
        )
    )
    return (
        copies.groupBy("row")
        .agg(
            F.first("id").alias(id_column),
            F.max("n_words").alias("n_words"),
            F.sort_array(F.collect_list(span)).alias("spans"),
        )
        .drop("row")
    )
