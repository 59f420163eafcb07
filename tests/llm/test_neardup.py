import random
import re

import pytest
from pyspark.sql import functions as F

from skytally.llm import neardup


def runs(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(docs):
    sets = [(i, runs(t)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if similarity(a, b) >= 0.8:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    docs = []
    for _ in range(25):
        base = [word() for _ in range(r.choice([3, 6, 30, 80, 300]))]
        for _ in range(r.choice([1, 2, 8])):
            copy = [w if r.random() > r.choice([0, 0.01, 0.03, 0.06]) else word() for w in base]
            docs.append((len(docs), " ".join(copy)))
    shared = " ".join(word() for _ in range(60))
    docs += [(len(docs) + k, shared + " " + " ".join(word() for _ in range(40))) for k in range(20)]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_against_all_pairs(spark, seed):
    docs = corpus(seed)
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, bands string")
    found = neardup.near_duplicates(frame).collect()
    assert {r.doc_id: r.class_id for r in found} == brute(docs)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(120_000))
    rows = [(5, "one two"), (4, "ONE  two\n"), (6, None), (7, ""), (8, " \t"), (9, "a b c d e"), (10, "a b c d e f"),
            (2, "a b c d e"), (2, "a b c d e"), (None, "one two"), (11, long), (12, long + " end")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, class_id int")
    found = {r.doc_id: (r.class_id, r.copy_of, r.n_links) for r in neardup.near_duplicates(docs).collect()}
    assert found == {5: (4, 4, 0), 4: (4, 4, 0), 6: (6, 6, 0), 7: (6, 6, 0), 8: (6, 6, 0), 9: (2, 2, 0), 2: (2, 2, 0), 10: (10, 10, 0),
                     11: (11, 11, 1), 12: (11, 12, 1)}
    kept = neardup.drop_near(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [2, 4, 6, 10, 11]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_a_large_group_of_copies_needs_few_comparisons(spark):
    base = " ".join(f"w{i}" for i in range(200))
    docs = spark.range(0, 600, 1, 8).select(F.col("id").alias("doc_id"), F.concat(F.lit(base + " x"), F.col("id").cast("string")).alias("text"))
    found = neardup.near_duplicates(docs)
    assert found.filter("class_id = 0").count() == 600
    assert found.agg(F.sum("n_links")).first()[0] < 4 * 600


def test_bands_reach_the_recall():
    rows, bands = neardup.banding(0.8, 0.9995)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9995 and rows * bands <= neardup.HASHES


def test_sketches_tell_similar_sets_from_others():
    import numpy as np

    random = np.random.default_rng(2)
    hashes, passed = neardup.SKETCH_HASHES, {0.8: 0, 0.5: 0}
    for similarity_ in passed:
        for _ in range(300):
            union = random.integers(0, 2**63, 2000, dtype=np.uint64) * np.uint64(2)
            part = random.random(2000)
            a = union[part < similarity_ + (1 - similarity_) / 2]
            b = union[(part < similarity_) | (part >= similarity_ + (1 - similarity_) / 2)]
            sketch = [neardup.sketches(neardup.minhashes(np.zeros(len(x), np.int64), x, 1, hashes))[0] for x in (a, b)]
            differ = sum(int(v).bit_count() for v in (sketch[0] ^ sketch[1]).view(np.uint64))
            passed[similarity_] += differ <= neardup.sketch_bits(hashes, 0.8)
    assert passed[0.8] >= 294 and passed[0.5] <= 6


def links(docs):
    """Links of every document, all pairs compared."""
    texts = {i: runs(t) for i, t in docs}
    order = {i: " ".join((t or "").lower().split()) for i, t in docs}
    return {i: sum(order[i] != order[j] and similarity(texts[i], texts[j]) >= 0.8 for j in texts) for i in texts}


@pytest.mark.parametrize("blocks", [{}, {"block_docs": 3}, {"block_runs": 50}])
def test_links_against_all_pairs(spark, blocks):
    docs = corpus(3)
    base = docs[-1][1].split()
    group = [" ".join(base[:k] + ["other"] + base[k + 1 :]) for k in range(0, 60, 3)]
    docs += [(len(docs) + k, text) for k, text in enumerate(group + group[:7] + [" ".join(base + ["end"] * k) for k in range(30)])]
    docs += [(len(docs), None), (len(docs) + 1, "")]
    frame = spark.createDataFrame([*docs, docs[-5], (None, docs[-5][1])], "doc_id long, text string")
    found = neardup.jaccard_links(frame, **blocks).collect()
    assert {r.doc_id: r.class_id for r in found} == brute(docs)
    assert {r.doc_id: r.n_links for r in found} == links(docs)
    assert len(found) == len(docs)


def test_every_link_of_a_large_group_is_counted(spark):
    base = " ".join(f"w{i}" for i in range(200))
    docs = spark.range(0, 600, 1, 8).select(F.col("id").alias("doc_id"), F.concat(F.lit(base + " x"), F.col("id").cast("string")).alias("text"))
    found = neardup.jaccard_links(docs, block_docs=100)
    assert found.filter("class_id = 0 and n_links = 599").count() == 600
    assert neardup.jaccard_links(docs.limit(0)).count() == 0


def boilerplate(spark, n):
    """Texts that share 120 words and differ in 22: 0.7 alike, so no two are linked."""
    shared = " ".join(f"s{i}" for i in range(120))
    own = F.concat_ws(" ", *[F.concat(F.lit(f"u{i}x"), F.col("id").cast("string")) for i in range(22)])
    return spark.range(0, n, 1, 8).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit(shared), own).alias("text"))


def test_a_group_of_much_the_same_texts_makes_no_pairs(spark):
    docs = boilerplate(spark, 400).withColumnRenamed("doc_id", "id")
    members = docs.select("id", F.col("id").alias("component"), F.array(*[F.lit(0).cast("long")] * 16).alias("sketch"))
    assert neardup.open_pairs(members, docs, 256, 0.8).count() == 0
    assert neardup.near_duplicates(boilerplate(spark, 400)).filter("class_id <> doc_id").count() == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_open_pairs_against_all_pairs(spark, seed):
    docs = corpus(seed)
    sets = {i: runs(t) for i, t in docs}
    frame = spark.createDataFrame(docs, "id long, text string").filter("text <> ''")
    members = frame.select("id", F.col("id").alias("component"), F.array(*[F.lit(0).cast("long")] * 16).alias("sketch"))
    found = {(r.a, r.b) for r in neardup.open_pairs(members, frame, 256, 0.8).collect()}
    order = {i: " ".join(t.split()) for i, t in docs}
    alike = {(i, j) for i in sets for j in sets if i < j and similarity(sets[i], sets[j]) >= 0.8}
    assert alike <= found and len(alike) > 20 and order
    assert len(found) < 3 * len(alike)


def test_bands_and_sketches_together_reach_most_pairs():
    """At the threshold itself, for texts of few and of many runs."""
    import numpy as np

    random = np.random.default_rng(6)
    rows, bands = neardup.banding()
    for size in (9, 45, 90, 180, 900, 1800):
        passed, pairs = 0, 250
        for _ in range(pairs):
            union = random.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2)
            common, apart = round(size * 0.8), size - round(size * 0.8)
            a, b = union[: common + apart // 2], np.append(union[:common], union[common + apart // 2 :])
            values = [neardup.minhashes(np.zeros(len(x), np.int64), x, 1, neardup.SKETCH_HASHES) for x in (a, b)]
            keys = [neardup.band_keys(v[:, : rows * bands], rows, bands)[0] for v in values]
            sketch = [neardup.sketches(v)[0] for v in values]
            differ = sum(int(v).bit_count() for v in (sketch[0] ^ sketch[1]).view(np.uint64))
            small = min(len(a), len(b)) < neardup.SKETCH_RUNS
            passed += (keys[0] == keys[1]).any() and (small or differ <= neardup.sketch_bits(neardup.SKETCH_HASHES, 0.8))
        assert passed >= 0.99 * pairs, (size, passed)


def test_rows_are_judged_by_their_text(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(7, text), (7, "another text of its own with a few words"), (None, text + " more"), (None, "and one without id here now"), (3, text + " end")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, row_key int")
    kept = neardup.drop_near(docs)
    assert kept.columns == docs.columns and sorted(r.row_key for r in kept.collect()) == [1, 3, 4]
