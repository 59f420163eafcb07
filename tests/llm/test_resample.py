import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from skytally.llm import resample

TEXTS = [
    (1, "The the cat SAT on the mat"), (2, "one two, three-four ÉTÉ été"), (3, None), (4, ""), (4, "the cat"), (4, "the cat"),
    (None, "the dog and the cat"), (7, "\x00!? "), (8, "ünder 12 ab " * 900), (9, "a b c d e f g h i j " * 3),
]


def plain(docs, target, shortest, longest, buckets, fewest, percent):
    def features(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        runs = [" ".join(words[i : i + n]) for n in range(shortest, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    total_s, total_t = s.total(), t.total()
    rows = []
    for id, text in docs:
        n, found = features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((id, n, len(found), weight, score))
    able = sorted((r for r in rows if r[1] >= fewest), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = able[: percent * len(able) // 100]
    ranks = [(*r, i + 1) for i, r in enumerate(drawn)]
    rest = Counter(rows) - Counter(drawn)
    return sorted([*ranks, *[(*r, None) for r in rest.elements()]], key=repr)


@pytest.mark.parametrize("shape", [(1, 1, 10_000), (1, 3, 97), (2, 2, 50)])
@pytest.mark.parametrize("piece", [1 << 20, 5])
def test_equals_a_plain_loop(spark, monkeypatch, shape, piece):
    features = resample.Features(*shape)
    monkeypatch.setattr(resample, "_PIECE", piece)
    long = TEXTS[8][1]
    whole = features.count(long)
    monkeypatch.undo()
    assert features.count(long) == whole
    docs = spark.createDataFrame([(*d, "x") for d in TEXTS], "doc_id long, text string, score string").repartition(3)
    target = spark.createDataFrame([("the cat été", 1), (None, 2), ("the cat", 3)], "text string, id int")
    found = resample.resample(docs, target, shortest=shape[0], longest=shape[1], buckets=shape[2], fewest_words=2, percent=60)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    expected = plain(TEXTS, ["the cat été", None, "the cat"], *shape, 2, 60)
    assert sorted(map(tuple, found.collect()), key=repr) == expected


def test_empty_tables_and_one_hot_id(spark):
    docs = spark.createDataFrame([(5, "same words here")] * 500 + [(6, "other words")] * 20, "doc_id long, text string").repartition(4)
    none = docs.limit(0)
    assert resample.resample(none, none).count() == 0
    found = resample.resample(docs, none.select("text"), fewest_words=1, percent=50).collect()
    assert sorted(r.rank for r in found if r.rank) == list(range(1, 261)) and len(found) == 520
    assert resample.resample(docs, docs, percent=0).filter("rank is not null").count() == 0
