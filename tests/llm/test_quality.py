import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from skytally.llm import quality
from skytally.llm.queries import QUERIES


def test_chunks_cover_every_window():
    for size in (0, 1, 7, 8, 511, 512, 513, 1015, 1016, 5000):
        data = (np.arange(size) % 250 + 1).astype(np.uint8)
        row, start = quality.chunk_starts(np.array([0]), np.array([size]))
        assert (row == 0).all() and start[0] == 0
        seen = {s + p for s in start for p in range(quality.CHUNK - quality.WIDTH + 1) if s + p + quality.WIDTH <= size}
        assert seen == set(range(max(0, size - quality.WIDTH + 1)))
        chunks = quality.cut(data, start, np.full(len(start), size))
        covered = {int(s) + i for s, c in zip(start, chunks) for i in np.flatnonzero(c)}
        assert covered == set(range(size))


def test_pooled_answers_equal_a_plain_convolution():
    network = quality.Network.fresh(3)
    text = bytes(np.random.default_rng(1).integers(1, 128, 1400, dtype=np.uint8))
    row, start = quality.chunk_starts(np.array([0]), np.array([len(text)]))
    best, size = [], []
    for s in start:
        size.append(min(quality.CHUNK, len(text) - s))
        chunk = text[s : s + quality.CHUNK].ljust(quality.CHUNK, b"\0")
        windows = [network.bytes_[list(chunk[p : p + 8])].ravel() for p in range(quality.CHUNK - 7)]
        best.append(np.maximum(np.max(np.array(windows) @ network.filters, axis=0) + network.bias, 0))
    plain = np.concatenate((np.average(best, axis=0, weights=size), np.max(best, axis=0)))
    expected = 1 / (1 + np.exp(-(plain @ network.weights + network.offset[0])))
    assert abs(network.score(pa.array([text.decode()]))[0] - expected) < 1e-5


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = QUERIES["op3_quality_conv"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    right = scored.filter("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right[1] > 60 and right[0] > 0.93


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, "the of and " * 30, "s"), (2, "### $$$ ", "s"), (3, None, "s"), (4, "", "s"), (4, "", "s"),
         (None, "the of", "s"), (5, "the of and " * 60_000, None)],
        "doc_id long, text string, score string",
    )
    labels = "doc_id long, quality int, toxic int"
    none = quality.train(docs, spark.createDataFrame([], labels))
    assert {r.score for r in quality.score_quality(docs, none).collect()} == {1.0}
    one = quality.train(docs, spark.createDataFrame([(1, 0, 0), (None, 1, 0), (3, None, 0)], labels))
    assert {r.score for r in quality.score_quality(docs, one).collect()} == {0.0}
    both = quality.train(docs, spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, 1, 1), (4, 0, 0)], labels), steps=40)
    found = quality.score_quality(docs, both)
    assert found.columns == ["doc_id", "text", "score"] and found.count() == 7
    scores = {r.doc_id: r.score for r in found.collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[3] == scores[4]
    assert quality.score_quality(docs.limit(0), both).count() == 0
    assert quality.train(docs.limit(0), spark.createDataFrame([(1, 1, 0)], labels)).constant == 1.0


def test_held_out_labels_change_nothing(spark):
    docs = spark.createDataFrame([(i, f"t{i} " * 9) for i in range(40)], "doc_id long, text string")
    out = [r[0] for r in docs.filter(quality.held_out(F.col("doc_id"))).select("doc_id").collect()]
    assert out
    networks = [
        quality.train(docs, spark.createDataFrame([(i, flip if i in out else i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int"), steps=20)
        for flip in (0, 1)
    ]
    assert np.array_equal(networks[0].filters, networks[1].filters)
