import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skytally.llm import decontaminate


def plain_alignment(text, item):
    best, cell = 0.0, [[0.0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            cell[i][j] = max(0.0, cell[i - 1][j - 1] + (1 if a == b else -0.5), cell[i - 1][j] - 0.5, cell[i][j - 1] - 0.5)
            best = max(best, cell[i][j])
    return best / len(item)


def test_alignment_against_a_plain_table():
    r = random.Random(3)
    pairs = []
    for _ in range(150):
        item = [r.randint(1, 9) for _ in range(r.randint(4, 20))]
        text = [r.randint(1, 9) for _ in range(r.randint(4, 40))]
        if r.random() < 0.5:
            text[3:3] = [w for w in item if r.random() > 0.2]
        pairs.append((text, item))
    score, first, end = decontaminate.align([np.array(t, np.int64) for t, _ in pairs], [np.array(i, np.int64) for _, i in pairs])
    for k, (text, item) in enumerate(pairs):
        assert abs(score[k] - plain_alignment(text, item)) < 1e-9
        assert abs(plain_alignment(text[first[k] : end[k]], item) - score[k]) < 1e-9


def corpus():
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijk") for _ in range(4))
    items = [[word() for _ in range(r.randint(12, 40))] for _ in range(30)]
    docs, truth = [], set()
    for number in range(200):
        body = [word() for _ in range(r.randint(0, 150))]
        if number % 3 == 0:
            which = r.randrange(30)
            copy = [w if r.random() > 0.06 else word() for w in items[which]]
            at = r.randint(0, len(body))
            body[at:at] = copy
            truth.add((number, which))
        elif number % 3 == 1:
            body += items[r.randrange(30)][:5]  # a phrase is no copy
        docs.append((number, " ".join(body)))
    return docs, list(enumerate(map(" ".join, items))), truth


@pytest.mark.parametrize("block", [100, 500_000])
def test_copies_are_found_and_others_left_alone(spark, block):
    docs, items, truth = corpus()
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(frame, bench, block_runs=block).collect()
    assert {(r.doc_id, r.item_id) for r in found} == truth
    texts, wanted = dict(docs), dict(items)
    for r in found:
        cut = texts[r.doc_id].split()[r.first_word : r.end_word]
        assert abs(plain_alignment(cut, wanted[r.item_id].split()) - r.score) < 1e-9


def test_a_passage_in_very_many_documents_is_still_found(spark):
    item = " ".join(f"w{i}" for i in range(20))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, item).otherwise(F.concat(F.lit("w1 w2 w3 w4 x"), "id")).alias("text"))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert decontaminate.find_leaks(docs, bench).count() == 1000


def test_edges(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta"
    rows = [(1, item.lower()), (1, "x " + item), (2, None), (3, ""), (4, "alpha beta gamma"), (None, item), (5, "q " * 150_000 + item + " r" * 150_000)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    bench = spark.createDataFrame([(7, item, "n"), (7, item, "n"), (8, "alpha beta", "n"), (9, None, "n"), (None, item, "n")], "item_id long, text string, runs string")
    found = sorted(tuple(r) for r in decontaminate.find_leaks(docs, bench).collect())
    assert found == [(1, 7, 1.0, 0, 8), (5, 7, 1.0, 150_000, 150_008)]
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == ["2", "3", "4"]
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0


def test_a_widespread_edited_copy_beside_a_few_whole_ones(spark):
    """The runs that the edited copies keep are far more frequent than the item's median run."""
    words = [f"w{i}" for i in range(40)]
    edited = " ".join("x" if k % 5 == 4 else w for k, w in enumerate(words))
    docs = spark.range(1003).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.when(F.col("id") < 3, " ".join(words)).otherwise(edited), F.concat(F.lit("end"), F.col("id") % 500)).alias("text"),
    )
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    found = decontaminate.find_leaks(docs, bench).collect()
    assert len(found) == 1003
    assert {round(r.score, 4) for r in found if r.doc_id >= 3} == {round(plain_alignment(edited.split(), words), 4)}
    half = docs.withColumn("text", F.when(F.col("doc_id") < 3, " ".join(words)).otherwise(" ".join(words[:24])))
    assert decontaminate.find_leaks(half, bench).count() == 1003


def test_the_bound_is_never_below_the_score():
    r = random.Random(5)
    for _ in range(400):
        item = [r.randint(1, 30) for _ in range(r.randint(4, 20))]
        text = [r.randint(1, 30) for _ in range(r.randint(0, 40))]
        if r.random() < 0.7:
            text[3:3] = [w for w in item if r.random() > 0.2]
        found = decontaminate.bound(np.array(text, np.int64), np.array(item, np.int64))
        assert found >= plain_alignment(text, item) * len(item) - 1e-9


def common_phrase(r, documents, items):
    """Texts that share nothing but a phrase."""
    word = lambda: "".join(r.choice("abcdefghijk") for _ in range(6))
    text = lambda n: " ".join([*(word() for _ in range(n)), "which of the following", *(word() for _ in range(n))])
    return [(i, text(15)) for i in range(documents)], [(i, text(8)) for i in range(items)]


def test_a_common_phrase_pairs_nothing(spark):
    r = random.Random(6)
    stored = []
    for size in (1, 2, 4):
        docs, items = common_phrase(r, 300 * size, 60 * size)
        passages = spark.createDataFrame(docs, "doc_id long, text string")
        bench = spark.createDataFrame(items, "item_id long, text string")
        read = bench.mapInArrow(decontaminate._read_items, decontaminate._ITEMS)
        keys = read.select(F.explode("runs").alias("run")).distinct().toArrow()["run"].to_numpy().view(np.uint64)
        cut = passages.mapInArrow(decontaminate._passages(decontaminate._Runs(keys), 20), decontaminate._PASSAGES)
        assert cut.count() == 300 * size
        stored.append(decontaminate.seeded(cut, read, 0.5).count())
    assert stored == [0, 0, 0]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_pair_that_reaches_the_score_is_lost_to_common_runs(spark, monkeypatch, seed):
    """Few different words, so that most runs are common to many items: as if every run were a seed, and by brute force."""
    r = random.Random(seed)
    vocabulary = ["which", "of", "the", "following", *[f"w{i}" for i in range(30)]]
    weights = [8, 8, 8, 8, *[1] * 30]
    phrase = ["which", "of", "the", "following"]
    items = []
    for i in range(25):
        body = r.choices(vocabulary, weights, k=r.randint(5, 25))
        items.append((i, body[:3] + phrase + body[3:]))
    docs = []
    for i in range(120):
        base = r.choice(items)[1] if i % 2 else r.choices(vocabulary, weights, k=30) + phrase
        copy = [w if r.random() > r.choice([0, 0.1, 0.25, 0.4]) else r.choice(vocabulary) for w in base]
        docs.append((i, r.choices(vocabulary, weights, k=r.randint(0, 20)) + copy))
    runs = lambda words: {tuple(words[k : k + 4]) for k in range(len(words) - 3)}
    expected = {
        (d, i) for d, text in docs for i, item in items if runs(text) & runs(item) and plain_alignment(text, item) >= 0.5 - 1e-9
    }
    frame = spark.createDataFrame([(d, " ".join(t)) for d, t in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_leaks(frame, bench).collect()}
    monkeypatch.setattr(decontaminate, "FEW_ITEMS", 10**9)
    assert found == {(r.doc_id, r.item_id): r.score for r in decontaminate.find_leaks(frame, bench).collect()}
    # An alignment can also lie beyond the passages around the runs of an item.
    assert set(found) <= expected and len(expected) > 40 and len(expected - set(found)) <= 1
