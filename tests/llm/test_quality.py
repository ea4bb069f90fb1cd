"""The quality classifier: its gradient's result, blocks against whole texts, held-out accuracy, odd inputs."""

import numpy as np
import pyarrow as pa
import pytest

from folioforge.llm import quality

DIR = "/root/testdata/sf0.01"
DOCS, LABELS = "doc_id long, text string, score double", "doc_id long, quality int"


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    return quality.learn(docs, labels)


def plain_score(model, data):
    """The network over all passages at once, one after another."""
    w = {k: v.astype(float) for k, v in model.weights.items()}
    x = np.concatenate([quality.encoded(data[i : i + quality.PASSAGE]) for i in range(0, max(1, len(data)), quality.PASSAGE)]).astype(float)
    h = np.tanh(x @ w["W"] + w["b"])
    e = [sum(np.tanh(r @ w["V"]) / (1 + np.exp(-(r @ w["U"]))) * w["a"]) for r in h]
    p = np.exp(e) / np.exp(e).sum()
    return 1 / (1 + np.exp(-(sum(a * r for a, r in zip(p, h, strict=True)) @ w["w"] + w["c"][0])))


def test_held_out_labels(spark, model):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").join(spark.read.parquet(f"{DIR}/labels.parquet"), "doc_id").where(quality.held_out(quality.F.col("doc_id")))
    rows = quality.score(docs, model, ["doc_id", "quality"]).collect()
    right = [(r["score"] >= quality.THRESHOLD) == r["quality"] for r in rows]
    assert len(right) > 50 and np.mean(right) >= 0.97


def test_attention_finds_the_poor_passage(model):
    good = "The and of it was on a tion thener. " * 40
    data = np.frombuffer((good + "BUY!! NOW!! ALL!! OF!! IT!! " * 15 + good).encode(), np.uint8)
    weights = model.attention(data)
    assert abs(weights.sum() - 1) < 1e-4 and len(weights) == -(-len(data) // quality.PASSAGE)


def test_blocks_give_what_whole_texts_give(model, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [b"", b"a", "é ü".encode(), bytes(rng.integers(97, 123, 3000, np.uint8)), b"word " * 900, b" " * 1500]
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        monkeypatch.setattr(quality, "BLOCK", 2048)
        whole = model.score(data)
        monkeypatch.setattr(quality, "BLOCK", 2)
        assert model.score(data) == pytest.approx(whole, abs=1e-5) and whole == pytest.approx(plain_score(model, data), abs=1e-3)


def test_gradient_finds_one_bad_passage_in_a_bag():
    """A bag is poor if any of its passages has the first feature: mean pooling alone can't tell from one in twelve."""
    rng = np.random.default_rng(4)
    bags, y = [], []
    for i in range(400):
        x = np.zeros((12, quality.FEATURES), np.float32)
        x[:, 1:40] = rng.random((12, 39)) * 0.3
        if i % 4 == 0:
            x[rng.integers(12), 0] = 1
        bags.append(x)
        y.append(float(i % 4 > 0))
    model = quality.Model(0.5, quality.fit(bags[:300], np.array(y[:300])))
    hits = 0
    for x, label in zip(bags[300:], y[300:], strict=True):
        h, e = model.vectors(x)
        p = np.exp(e - e.max())
        z = (p / p.sum()) @ h
        hits += ((z @ model.weights["w"] + model.weights["c"][0]) > 0) == label
    assert hits >= 97


def test_odd_inputs(spark, model):
    rows = [(1, None, 1.0), (2, "", 1.0), (None, "x", None), (3, "Hello there. " * 20000, 0.5), (3, "Hello there. " * 20000, 0.5)]
    docs = spark.createDataFrame(rows, DOCS)
    got = quality.score(docs.drop("score"), model, ["doc_id"]).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] in (1, 2)} == {model.score(np.zeros(0, np.uint8))}
    assert quality.score(docs.where("false").drop("score"), model, ["doc_id"]).count() == 0
    kept = quality.drop_poor(docs, spark.createDataFrame([], LABELS))
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == 5
    with pytest.raises(ValueError, match="clash"):
        quality.score(docs, model, ["score"])


def test_labels_of_one_value_or_none(spark):
    docs = spark.createDataFrame([(i, f"text {i}", 0.0) for i in range(20)], DOCS)
    assert quality.learn(docs, spark.createDataFrame([], LABELS)).mean == 0.5
    assert quality.learn(docs, spark.createDataFrame([(i, 1) for i in range(20)] + [(None, 0), (3, None)], LABELS)).mean == 1.0
    assert quality.scores(quality.Model(0.25), pa.array(["a", ""], pa.large_string())).tolist() == [0.25, 0.25]
