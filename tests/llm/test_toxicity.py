import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from skytally.llm import toxicity
from skytally.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def ngrams(word):
    marked = f"<{word}>"
    found = [marked[i : i + n] for n in range(toxicity.SHORTEST, toxicity.LONGEST + 1) for i in range(len(marked) - n + 1)]
    return [*found, marked]


def bucket(gram):
    data = np.frombuffer(gram.encode(), np.uint8)
    return int(toxicity.keys(data, np.array([0]), np.array([len(data)]))[0] % np.uint64(toxicity.BUCKETS))


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    inside = lambda c: c.isdigit() and c.isascii() or "a" <= c <= "z" or ord(c) > 0x7F
    words = []
    for raw in lowered.replace("\t", " ").replace("\n", " ").split(" "):
        places = [i for i, c in enumerate(raw) if inside(c)]
        if places:
            words.append(raw[places[0] : places[-1] + 1])
    return words


TEXTS = ["You (idiot)! st*pid é, ÉTÉ\n", None, "", "... !!", "a", "ab ab ab, ünderground\tx1", "the idiot " * 40_000]


def test_scores_equal_a_plain_loop():
    random = np.random.default_rng(4)
    model = toxicity.Model(random.normal(0, 3, toxicity.BUCKETS), -0.5)
    expected = []
    for text in TEXTS:
        words = tokens(text)
        value = {w: np.mean([model.adds[bucket(g)] for g in ngrams(w)]) for w in set(words)}
        values = [value[w] for w in words]
        logit = (np.mean(values) if values else 0) + model.offset
        expected.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
    assert np.allclose(model.score(pa.array(TEXTS)), expected)


def test_bags_add_up():
    for text, (own, weight) in zip(TEXTS[:-1], toxicity._bags(pa.array(TEXTS[:-1])), strict=True):
        words, plain = tokens(text), {}
        for word in words:
            grams = ngrams(word)
            for gram in grams:
                plain[bucket(gram)] = plain.get(bucket(gram), 0) + 1 / len(grams) / len(words)
        assert sorted(own) == sorted(plain)
        assert np.allclose(weight, [plain[b] for b in own])


def test_unseen_spellings_lie_near():
    random = np.random.default_rng(1)
    clean = [" ".join(random.choice(["the", "of", "and", "river", "stone"], 30)) for _ in range(60)]
    toxic = [f"{c} idiot {d}" for c, d in zip(clean[:30], clean[30:], strict=True)]
    bags = [(b, w * toxicity._SCALE) for b, w in toxicity._bags(pa.array(clean + toxic))]
    model = toxicity.trained(bags, np.array([0] * 60 + [1] * 30), 0.5, steps=300)
    known, near, far = model.score(pa.array([f"{clean[5]} {w}" for w in ("idiot", "idiott", "water")]))
    assert known > 0.8 and near > far + 0.2 and far < 0.5


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = QUERIES["op11_toxicity_subwords"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    right = scored.filter("held_out").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")), F.count("*")).first()
    assert right[1] > 600 and right[0] > 0.93


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, "the of and " * 30, "s"), (2, "you idiot", "s"), (3, None, "s"), (4, "", "s"), (4, "", "s"), (None, "the of", "s"),
         (5, "the of and " * 60_000, None), (6, "?! ...", None)],
        "doc_id long, text string, score string",
    )
    none = toxicity.train(docs, spark.createDataFrame([], LABELS))
    assert {r.score for r in toxicity.score_toxicity(docs, none).collect()} == {0.0}
    one = toxicity.train(docs, spark.createDataFrame([(1, 0, 1), (None, 1, 0), (3, 0, None)], LABELS))
    assert {r.score for r in toxicity.score_toxicity(docs, one).collect()} == {1.0}
    both = toxicity.train(docs, spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (4, 0, 0), (6, 0, 1)], LABELS), steps=20)
    found = toxicity.score_toxicity(docs, both)
    assert found.columns == ["doc_id", "text", "score"] and found.count() == 8
    scores = {r.doc_id: r.score for r in found.collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[3] == scores[4] == scores[6]
    assert toxicity.score_toxicity(docs.limit(0), both).count() == 0
    assert toxicity.train(docs.limit(0), spark.createDataFrame([(1, 1, 0)], LABELS)).constant == 0.0


def test_held_out_labels_change_nothing(spark):
    docs = spark.createDataFrame([(i, f"t{i} same words {i % 3} " * 9) for i in range(60)], "doc_id long, text string")
    out = [r[0] for r in docs.filter(toxicity.held_out(F.col("doc_id"))).select("doc_id").collect()]
    assert out
    models = [
        toxicity.train(docs, spark.createDataFrame([(i, 0, flip if i in out else i % 2) for i in range(60)], LABELS), steps=20)
        for flip in (0, 1)
    ]
    assert np.array_equal(models[0].adds, models[1].adds) and models[0].offset == models[1].offset
