import math
import random

import numpy as np
from pyspark.sql import functions as F

from marlstone.llm import toxicity as tx
from marlstone.llm.queries import held_out


def plain_ftrl(examples, l1, alpha, beta, l2, epochs):
    """One coordinate after the other, from the published update."""
    z, n = {}, {}
    w = lambda i: 0.0 if (abs(z.get(i, 0)) <= l1 and i != "b") else -(z.get(i, 0) - (0 if i == "b" else math.copysign(l1, z[i]))) / ((beta + math.sqrt(n.get(i, 0))) / alpha + l2)
    for _ in range(epochs):
        for features, y in examples:
            at = [*features, "b"]
            ws = {i: w(i) for i in at}
            g = 1 / (1 + math.exp(-sum(ws.values()))) - y
            for i in at:
                old = math.sqrt(n.get(i, 0))
                n[i] = n.get(i, 0) + g * g
                z[i] = z.get(i, 0) + g - (math.sqrt(n[i]) - old) / alpha * ws[i]
    return {i: w(i) for i in z if i != "b" and w(i)}, w("b")


def test_fit_equals_plain_updates():
    r = random.Random(0)
    examples = [(np.array(sorted(r.sample(range(30), 5))), r.randrange(2)) for _ in range(40)]
    model = tx.fit_ftrl(examples, bits=5, l1=0.3, alpha=0.5, l2=0.2, epochs=3)
    weights, bias = plain_ftrl([(e.tolist(), y) for e, y in examples], 0.3, 0.5, 1.0, 0.2, 3)
    assert set(model.index.tolist()) == set(weights) and abs(model.bias - bias) < 1e-9
    assert all(abs(weights[int(i)] - float(w)) < 1e-5 for i, w in zip(model.index, model.weight))


def test_features():
    f = tx.Features()
    assert len(f.all("")) == 0 and len(f.all("One")) == 1 and len(f.all("a b c d")) == 4 + 3 + 2
    assert sorted(f.all("A, b!")) == sorted(f.all("a B"))
    assert set(f.all("b a")) != set(f.all("a b"))


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    model = tx.fit(docs, labels, ~held_out("doc_id", 5, 0))
    assert 0 < len(model.index) < 50_000
    rows = tx.score(docs.join(labels.where(held_out("doc_id", 5, 0)), "doc_id"), model).select("toxic", "predicted", "score").collect()
    hits = [r.predicted for r in rows if r.toxic == 1]
    assert sum(hits) / len(hits) > 0.8
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(clean) / len(clean) < 0.01


def test_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 0), (6, 1), (7, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = tx.fit(odd, labels, F.lit(True))
    rows = tx.score(odd, model).select("doc_id", "text", "score", "predicted").collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    bias = 1 / (1 + math.exp(-model.bias))
    assert all(abs(r.score - bias) < 1e-9 for r in rows if not r.text)
    assert len({r.score for r in rows if r.text == "one two three four five six seven"}) == 1
    assert tx.score(empty, model).collect() == []
    none = tx.fit(empty, labels, F.lit(True))
    assert {r.score for r in tx.score(odd, none).collect()} == {0.5}


def test_sample_is_bounded_and_by_hash(docs, sf_dir, spark):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    a, b = (tx.fit(docs, labels, F.lit(True), train_rows=10) for _ in range(2))
    assert a.index.tolist() == b.index.tolist() and a.bias == b.bias


def test_repeated_rows_and_long_texts_keep_the_sample_bounded(spark):
    """An id that fills a table teaches once; beyond most_features rows are left out, but not the first."""
    docs = spark.createDataFrame([(i, f"word{i} " * 3) for i in range(20)] + [(1, "same again")] * 300, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    a = tx.fit(docs, labels, F.lit(True))
    b = tx.fit(docs.dropDuplicates(["doc_id", "text"]), labels, F.lit(True))
    assert a.bias == b.bias and a.index.tolist() == b.index.tolist()
    assert tx.fit(docs, labels, F.lit(True), most_features=1).bias != a.bias
