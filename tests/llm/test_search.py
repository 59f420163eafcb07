import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from skytally.llm import search

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in re.findall(TERM, text or "")]


def plain(docs, items, top):
    cut = [(id, terms(text)) for id, text in docs]
    cut = [(id, t) for id, t in cut if t]
    number, length = len(cut), sum(len(t) for _, t in cut)
    df = Counter(w for _, t in cut for w in set(t))
    found = []
    for item, text in sorted(set(items), key=repr):
        asked, scores = Counter(terms(text)), []
        for id, t in cut:
            tf, score = Counter(t), 0
            m = 75 + 25 * len(t) * number // length
            for w, times in asked.items():
                if tf[w]:
                    weight = math.floor(1000 * math.log((2 * number + 2) / (2 * df[w] + 1)))
                    score += times * weight * (1_000_000_000 * tf[w] // (1000 * tf[w] + 12 * m))
            if score > 0:
                scores.append((-score, id is None, id or 0, id))
        found += [(item, rank, id, -s) for rank, (s, _, _, id) in enumerate(sorted(scores)[:top], 1)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("cells", [1 << 23, 1])
@pytest.mark.parametrize("item_bytes", [1 << 18, 300])
def test_equals_a_plain_loop(spark, monkeypatch, cells, item_bytes):
    monkeypatch.setattr(search, "_CELLS", cells)
    choice = random.Random(5)
    vocabulary = ["the", "THE", "é", "Été", "12", "x-y", *[f"w{i}" for i in range(150)]]
    weights = [1 / (1 + i) for i in range(len(vocabulary))]

    def text(most):
        return " ".join(choice.choices(vocabulary, weights, k=choice.randint(0, most)))

    docs = [(i, text(60)) for i in range(300)]
    docs += [docs[3], docs[3], (None, "w5 w6"), (None, "w5 w6"), (901, None), (902, ""), (903, "?\x00!"), (904, "w7 " * 30_000)]
    items = [(i, text(90)) for i in range(12)] + [(50, None), (51, ""), (52, "unheard"), (3, "the w9"), (3, "the w9"), (53, "w5 w6 w7")]
    items.append((54, " ".join(f"w{i}" for i in range(150))))  # more terms than bits in a number
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, score int").repartition(3)
    asked = spark.createDataFrame([(*i, 0) for i in items], "item_id int, text string, rank int")
    found = search.ranked_search(df, asked, top=4, item_bytes=item_bytes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain(docs, items, 4)


def test_masks_tell_documents_apart():
    has = np.random.default_rng(2).random((150, 400)) < 0.02
    block = search.Block.__new__(search.Block)
    block.has = has
    mask, group = block.masks(np.arange(150))
    assert (mask[group] == has.T).all() and len({tuple(m) for m in mask}) == len(mask)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs, spark.createDataFrame([(1, "?")], items.schema))):
        found = search.ranked_search(d, i)
        assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]
