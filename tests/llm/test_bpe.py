import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skytally.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(vocabulary, library, texts):
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    found = vocabulary.encode(texts)
    assert found.to_pylist() == expected
    assert vocabulary.decode(found).to_pylist() == [library.decode(e, skip_special_tokens=False) for e in expected]


def test_random_texts(vocabulary, library):
    r = random.Random(1)
    alphabet = "aabbeeétthhoonΣςİ'sdrvmléß 123 .,!?<|>\n\t 日本😀é"
    same(vocabulary, library, ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(4000)])


def test_edges(vocabulary, library):
    same(vocabulary, library, [
        "", " ", "<|endoftext|>", "a<|startoftext|>B<|endoftext|><|endoftext|> x", "<|ENDOFTEXT|>", "a" * 5000,
        "ha" * 3000 + " x", "'S 'LL it's IT'S", "\x00\x1f\x85 ", "ΑΣ ΑΣΑ"])


def test_long_texts_are_worked_off_in_pieces(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 50)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 120)
    r = random.Random(2)
    same(vocabulary, library, [" ".join(r.choice(["it's", "Σx", "12", "hello", "\n", "<|endoftext|>"]) for _ in range(n)) for n in (0, 1, 30, 400, 7, 90)])


def test_every_character_of_the_basic_plane(vocabulary, library):
    import unicodedata

    known = [chr(c) for c in range(0x3000) if unicodedata.category(chr(c)) not in ("Cs", "Cn")]
    same(vocabulary, library, [f"a{c}b 1{c}" for c in known])


def test_columns(spark, library):
    rows = [(1, "Hello world", "i"), (1, "Hello world", "i"), (None, None, None), (2, "", "i"), (3, "it's " * 100_000, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = bpe.encode(docs, PATH, decoded="decoded")
    assert found.columns == ["doc_id", "text", "ids", "decoded"]
    by = [(r.doc_id, len(r.ids), r.decoded[:13]) for r in found.collect()]
    hello = library.encode("hello world").ids
    assert sorted(by, key=repr) == [(1, len(hello), "hello</w> wor"), (1, len(hello), "hello</w> wor"), (2, 0, ""), (3, 200_000, "it</w> 's</w>"), (None, 0, "")]
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    renamed = bpe.encode(docs.select("doc_id", "text"), PATH, ids="text")
    assert renamed.columns == ["doc_id", "text"] and renamed.first().text == hello
