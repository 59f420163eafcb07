"""Byte-pair encoding of whole texts, and back, with a public vocabulary file.

Texts are normalised and cut into words as the file asks; the different words of some megabytes of text then lie
side by side in one flat array of symbols. Each round looks at the pairs next to every change, finds their ranks by
binary search over the sorted pair keys, and merges each word's lowest-ranked pair wherever it stands in the word.
Rounds end when no word has a known pair left.

The vocabulary (a few megabytes, bounded by its file) is read by the driver and broadcast, so executors don't need
the file. A text of any length is worked off in pieces cut at white space.

Null and empty texts have no tokens and decode to an empty text. Rows are encoded one by one, so repeated rows and
ties don't matter. An empty table gives an empty result. Columns named like the results are replaced.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from skytally.llm.words import slices

#: Characters of text whose words are encoded together.
GROUP_CHARS = 4 << 20
#: A longer text is cut at white space.
PIECE_CHARS = 1 << 20

_NONE = np.iinfo(np.int32).max


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves, the others for the characters from 256 on, in order.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(other)) for b in range(256)]


@dataclass
class Vocabulary:
    """Symbols and merges of a vocabulary with word ends."""

    symbols: list[str]  # by id
    first: np.ndarray  # id of each byte's symbol inside a word
    last: np.ndarray  # and at the end of a word
    pair_keys: np.ndarray  # sorted
    pair_ranks: np.ndarray
    merged: np.ndarray  # id, by rank
    specials: dict[str, int]
    pattern: str

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        symbols = [""] * (1 + max(*ids.values(), *specials.values()))
        for symbol, number in (ids | specials).items():
            symbols[number] = symbol
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] * len(symbols) + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        alphabet = byte_alphabet()
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        return cls(
            symbols,
            np.array([ids[c] for c in alphabet], np.int32),
            np.array([ids[c + end] for c in alphabet], np.int32),
            keys[order],
            order.astype(np.int32),
            np.array([ids[a + b] for a, b in pairs], np.int32),
            specials,
            split["pattern"]["Regex"],
        )

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_words", "_special", "_symbols")}

    @cached_property
    def _words(self) -> regex.Pattern:
        return regex.compile(self.pattern)

    @cached_property
    def _special(self) -> regex.Pattern:
        return regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")

    @cached_property
    def _symbols(self) -> pa.Array:
        return pa.array(self.symbols, pa.large_string())

    def words(self, text: str) -> list[str]:
        """The words of a text, special tokens among them in their own spelling."""
        if any(special in text for special in self.specials):
            parts = self._special.split(text)
        else:
            parts = [text]
        found = []
        for at, part in enumerate(parts):
            if at % 2:
                found.append(part)
            elif part:
                # A capital sigma has one small form here, wherever it stands.
                low = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                found += self._words.findall(low)
        return found

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, or no rank."""
        keys = left.astype(np.int64) * len(self.symbols) + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NONE)

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        words = words.cast(pa.large_string())
        _, offsets, data = words.buffers()
        begins = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
        raw = np.frombuffer(data, np.uint8)[begins[0] : begins[-1]] if data else np.zeros(0, np.uint8)
        begins = begins - begins[0]
        symbol = self.first[raw]
        symbol[begins[1:] - 1] = self.last[raw[begins[1:] - 1]]
        word = np.repeat(np.arange(len(words), dtype=np.int32), np.diff(begins))
        ended_symbols, ended_words = [], []
        rank = np.full(len(symbol), _NONE, np.int32)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside] = self.ranks(symbol[inside], symbol[inside + 1])
        while len(symbol):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbol)))
            low = np.repeat(lowest, sizes)
            over = low == _NONE
            if over.any():
                ended_symbols.append(symbol[over])
                ended_words.append(word[over])
                going = ~over
                symbol, word, rank, low = symbol[going], word[going], rank[going], low[going]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == low)
            # Of overlapping equal pairs (a a a) the first, third and so on are merged.
            new_run = np.concatenate(([True], np.diff(at) != 1))
            run_start = np.flatnonzero(new_run)[np.cumsum(new_run) - 1]
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            symbol[at] = self.merged[rank[at]]
            kept = np.ones(len(symbol), bool)
            kept[at + 1] = False
            moved = (np.cumsum(kept) - 1)[at]
            symbol, word, rank = symbol[kept], word[kept], rank[kept]
            changed = np.concatenate((moved, moved[moved > 0] - 1))
            rank[changed] = _NONE
            changed = changed[changed < len(symbol) - 1]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed] = self.ranks(symbol[changed], symbol[changed + 1])
        if not ended_words:
            return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        word, symbol = np.concatenate(ended_words), np.concatenate(ended_symbols)
        order = np.argsort(word, kind="stable")
        return symbol[order], np.bincount(word, minlength=len(words))

    def encode_list(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence of words in a row, and how many each word has; each different word is encoded once."""
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        ids, sizes = self.encode_words(coded.dictionary)
        begins = np.concatenate(([0], np.cumsum(sizes)))
        which = coded.indices.to_numpy()
        specials = pc.index_in(coded.dictionary, pa.array(list(self.specials), pa.large_string()))
        if specials.null_count < len(specials):
            special = specials.fill_null(-1).to_numpy()
            for at in np.flatnonzero(special >= 0):
                # The symbols of a special token's spelling give way to its id.
                ids[begins[at]] = list(self.specials.values())[special[at]]
                sizes[at] = 1
        count = sizes[which]
        before = np.cumsum(count) - count
        return ids[np.repeat(begins[which] - before, count) + np.arange(count.sum())], count

    def encode(self, texts: list[str | None]) -> pa.Array:
        """Token ids of each text."""
        done: list[list[np.ndarray]] = [[] for _ in texts]
        words: list[str] = []
        shares: list[tuple[int, int]] = []
        size = 0

        def flush() -> None:
            nonlocal words, shares, size
            if words:
                ids, count = self.encode_list(words)
                ends = np.cumsum(np.concatenate(([0], count)))
                at = 0
                for row, n in shares:
                    done[row].append(ids[ends[at] : ends[at + n]])
                    at += n
            words, shares, size = [], [], 0

        for row, text in enumerate(texts):
            for piece in pieces(text or ""):
                found = self.words(piece)
                words += found
                shares.append((row, len(found)))
                size += len(piece)
                if size >= GROUP_CHARS:
                    flush()
        flush()
        lists = [np.concatenate(d) if d else np.zeros(0, np.int32) for d in done]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
        flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))

    def decode(self, ids: pa.Array) -> pa.Array:
        """The text of each list of ids: its symbols with a blank between any two."""
        symbols = pc.take(self._symbols, ids.values)
        blank = pa.scalar(" ", pa.large_string())
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, symbols), blank).cast(pa.string())


def pieces(text: str) -> Iterator[str]:
    """The text in parts that end at white space; a part without any is as long as it is."""
    start = 0
    while len(text) - start > PIECE_CHARS:
        cut = regex.compile(r"\s").search(text, start + PIECE_CHARS)
        if not cut:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def encode(
    docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``docs`` with the token ids of ``text`` and, if ``decoded`` names a column, the text they decode to.

    ``vocabulary`` is the path of a vocabulary file on the driver.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary.read(vocabulary))
    new = {ids.lower(), (decoded or ids).lower()}
    source = docs.drop(*[c for c in docs.columns if c.lower() in new - {text.lower()}])
    at = [c.lower() for c in source.columns].index(text.lower())
    kept = [i for i, c in enumerate(source.columns) if c.lower() not in new]
    schema = T.StructType([source.schema[i] for i in kept]).add(ids, T.ArrayType(T.IntegerType(), False))
    if decoded:
        schema = schema.add(decoded, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for part in slices(batch, at):
                found = vocabulary.encode(part.column(at).to_pylist())
                columns = [part.column(i) for i in kept] + [found]
                if decoded:
                    columns.append(vocabulary.decode(found))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)
