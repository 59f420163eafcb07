import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from skytally.llm import brown
from skytally.llm.queries import QUERIES


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + ["\0end"]


def test_base_score_and_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 7 == 2 for d in docs}
    count = Counter(w for d in docs if not held[d.doc_id] for w in split(d.text))
    total, different = sum(count.values()), len(count)
    found = {r.doc_id: r for r in QUERIES["op5_brown_classes"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    base = score = 0
    for d in docs:
        tokens, r = split(d.text), found[d.doc_id]
        expected = sum(math.log10((count[w] + 1) / (total + different + 1)) for w in tokens)
        assert abs(r.base_score - expected) < 1e-6 * abs(expected)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[d.doc_id], len(tokens), total)
        assert r.n_known == sum(w in count for w in tokens)
        if r.held_out:
            base, score = base + r.base_score, score + r.score
    assert score > base


def test_score_by_hand_and_mass(spark):
    """Each text's score follows from counts, and the probabilities after any class sum to one."""
    texts = ["the cat sat", "the dog sat", "a dog ran", "le chat", None, "the the cat"] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = brown.train(docs)
    count = Counter(w for t in texts for w in split(t))
    names = sorted(w for w in count if w != "\0end")
    import pyarrow as pa

    from skytally.llm.words import words

    key = words(pa.array([" ".join(names)])).key
    symbol = dict(zip(names, model.symbols.symbol[np.searchsorted(model.symbols.key, key)], strict=True))
    of = {w: model.classes[symbol[w]] for w in names} | {"\0end": brown.CLASSES - 1}
    log = lambda before, w: model.transition[of[before], of[w]] + math.log10(count[w] - 0.5) - model.within[of[w]]
    found = {r.doc_id: r for r in brown.score(docs, model).collect()}
    for i, text in enumerate(texts):
        tokens = split(text)
        expected = sum(log(a, b) for a, b in zip(["\0end", *tokens[:-1]], tokens, strict=True))
        assert abs(found[i].score - expected) < 1e-9
        assert abs(found[i].perplexity - 10 ** (-expected / len(tokens))) < 1e-6
    within = np.zeros(brown.CLASSES)
    for w in count:
        within[of[w]] += 10 ** (math.log10(count[w] - 0.5) - model.within[of[w]])
    within += 10 ** (model.unseen - model.within)
    mass = (10**model.transition) @ within
    assert np.allclose(mass, 1)


def plain_best(own, follows, precedes, counts):
    """Every class tried: the likelihood of all transitions with the word in it."""
    reached = []
    for c in range(brown.CLASSES):
        moved = counts.copy()
        moved[own] -= follows
        moved[:, own] -= precedes
        moved[c] += follows
        moved[:, c] += precedes
        reached.append(brown.likelihood(moved) if c < brown.CLASSES - 1 else -np.inf)
    return reached


def test_best_classes_against_trying_all(monkeypatch):
    monkeypatch.setattr(brown, "CLASSES", 7)
    random = np.random.default_rng(3)
    stream = random.integers(0, 40, 3000)
    classes = random.integers(0, 6, 40)
    counts = np.zeros((7, 7))
    np.add.at(counts, (classes[stream[:-1]], classes[stream[1:]]), 1)
    keep = [w for w in range(40) if not ((stream[:-1] == w) & (stream[1:] == w)).any()]
    follows, precedes = np.zeros((40, 7)), np.zeros((40, 7))
    np.add.at(follows, (stream[:-1], classes[stream[1:]]), 1)
    np.add.at(precedes, (stream[1:], classes[stream[:-1]]), 1)
    both = np.hstack((follows, precedes))[keep]
    owner, cell = np.nonzero(both)
    best = brown.best_classes(classes[keep], owner, cell, both[owner, cell], counts)
    for k, w in enumerate(keep):
        reached = plain_best(classes[w], follows[w], precedes[w], counts)
        # The ends of the stream have one neighbour, and transitions between the word and itself are left out above.
        assert reached[best[k]] >= max(reached) - 1e-6 * abs(max(reached))
    assert len(keep) > 5


def test_likelihood_rises_from_round_to_round(spark):
    """Two languages that never mix; every word that was seen often enough has a class, the likelihood rises."""
    random = np.random.default_rng(0)
    rows = []
    for i in range(600):
        names = [f"{'ab'[i % 2]}{k}" for k in range(40)]
        rows.append((i, " ".join(random.choice(names, 30, p=(w := 1 / np.arange(1, 41)) / w.sum()))))
    model = brown.train(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(model.reached) == brown.ROUNDS + 1
    best = [max(model.reached[: k + 1]) for k in range(len(model.reached))]
    assert model.reached[1] > model.reached[0] and best == sorted(best)


def test_words_seen_often_enough_get_a_class_of_their_own_neighbours(spark, monkeypatch):
    """Rare words of one meaning but other endings go where the common one is, not where their endings are."""
    monkeypatch.setattr(brown, "CLASS_SHARE", 0.01)
    random = np.random.default_rng(1)
    rows = []
    for i in range(12_000):
        kind = i % 2
        middle = f"{'xy'[kind]}{random.integers(0, 6)}q{random.integers(0, 90):02}"
        if random.random() < 0.3:
            middle = ["xavier", "yvonne"][kind]
        rows.append((i, f"{['one alpha', 'two gamma'][kind]} {middle} {['beta', 'delta'][kind]}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = brown.train(docs)
    count = Counter(t.split()[2] for _, t in rows if "q" in t)
    import pyarrow as pa

    from skytally.llm.words import words

    of = {r["word"]: (r["n"], r["class"]) for r in model.counts.collect()}
    found = {w: of[int(words(pa.array([w])).key.view(np.int64)[0])] for w in count}
    assert all(found[w][0] == n for w, n in count.items()) and len(count) > 300
    classes = [{c for w, (n, c) in found.items() if n >= brown.SEEN and w[0] == kind} for kind in "xy"]
    assert all(classes) and not classes[0] & classes[1]
    assert {c for _, (n, c) in found.items() if n < brown.SEEN} or min(count.values()) >= brown.SEEN


def test_edges(spark):
    schema = "doc_id long, text string, row string, n long"
    rows = [(1, "a b", "x", 1), (1, "a b", "x", 1), (None, None, None, None), (2, "", "x", 1), (3, "w" * 200_000 + " a" * 200_000, "x", 1), (4, "never seen", "x", 1)]
    docs = spark.createDataFrame(rows, schema)
    model = brown.train(docs.filter("doc_id < 4 or doc_id is null"))
    found = sorted((repr(r.doc_id), r.n_tokens, r.n_known) for r in brown.score(docs, model).collect())
    assert found == [("1", 3, 3), ("1", 3, 3), ("2", 1, 1), ("3", 200_002, 200_002), ("4", 3, 1), ("None", 1, 1)]
    assert all(math.isfinite(r.score) and r.score < 0 for r in brown.score(docs, model).collect())
    nothing = brown.train(docs.limit(0))
    assert {(r.base_score, r.score, r.n_known) for r in brown.score(docs, nothing).collect()} == {(0.0, 0.0, 0)}
    assert brown.score(docs.limit(0), model).count() == 0


def test_rare_words_are_looked_up(spark, monkeypatch):
    """Words whose counts stay in the table get the same scores as words that the tasks know."""
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("the"), F.col("id") % 7, F.col("id") % 50, F.col("id")).alias("text")
    )
    monkeypatch.setattr(brown, "CLASS_SHARE", 0.2)
    plain = {r.doc_id: r for r in brown.score(docs, brown.train(docs.filter("doc_id < 250"))).collect()}
    monkeypatch.setattr(brown, "COUNT_SHARE", 0.05)
    joined = {r.doc_id: r for r in brown.score(docs, brown.train(docs.filter("doc_id < 250"))).collect()}
    for i, r in plain.items():
        assert (r.n_tokens, r.n_known) == (joined[i].n_tokens, joined[i].n_known)
        assert abs(r.base_score - joined[i].base_score) < 1e-9
        assert abs(r.score - joined[i].score) < 1e-9
