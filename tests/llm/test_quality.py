"""The quality classifier: held-out accuracy, the linear-time identity, gradients, edges."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tapeloom.llm import quality as qu

SF = "/root/testdata/sf0.1"


def pairs_by_loops(machine, index, value):
    total = machine.bias + sum(machine.weights[i] * x for i, x in zip(index, value, strict=True))
    for a in range(len(index)):
        for b in range(a):
            total += machine.factors[index[a]] @ machine.factors[index[b]] * value[a] * value[b]
    return total


def random_rows(seed=1, rows=7, features=30):
    rng = np.random.default_rng(seed)
    n = rng.integers(0, 9, rows)
    machine = qu.Machine(0.3, rng.normal(size=features), rng.normal(size=(features, qu.FACTORS)))
    return machine, n, rng.integers(0, features, n.sum()), rng.normal(size=n.sum())


def test_score_equals_all_pairs():
    machine, n, index, value = random_rows()
    start = np.cumsum(n) - n
    want = [pairs_by_loops(machine, index[a : a + k], value[a : a + k]) for a, k in zip(start, n, strict=True)]
    assert machine.logits(n, index, value) == pytest.approx(want)


def test_gradient_is_that_of_the_loss(monkeypatch):
    monkeypatch.setattr(qu, "DECAY", 0.0)
    machine, n, index, value = random_rows(2)
    label = np.arange(len(n)) % 2
    loss = lambda m: np.mean(np.log1p(np.exp(-(2 * label - 1) * m.logits(n, index, value))))
    i, f, step = int(index[0]), 3, 1e-6
    up = qu.Machine(machine.bias, machine.weights.copy(), machine.factors.copy())
    up.factors[i, f] += step
    slope = (loss(up) - loss(machine)) / step
    seen = np.zeros((len(machine.weights), qu.FACTORS + 1))
    qu.learn(machine, n, index, value, label, seen, epochs=1)
    assert np.sqrt(seen[i, f + 1]) == pytest.approx(abs(slope), rel=1e-4)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = qu.predict(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"]]
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.995
    assert np.mean([s >= 0.3 for s in good]) > 0.99 and np.mean([s < 0.3 for s in bad]) > 0.85


def test_features_of_a_text_do_not_depend_on_its_block():
    texts = ["The cat.\nThe cat.\n", "", "AAA bbb!! 12 éé", "x", "\n", " ", "w " * 50]
    n, index, value = qu.features(pa.array(texts), [np.arange(7.0)])
    start = np.cumsum(n) - n
    for k, text in enumerate(texts):
        alone = qu.features(pa.array([text]), [np.array([float(k)])])
        assert (alone[1] == index[start[k] : start[k] + n[k]]).all() and alone[2] == pytest.approx(value[start[k] : start[k] + n[k]])
    assert n[1] == len(qu.STATISTICS) + 1
    repeated = qu.STATISTICS.index("repeated_lines")
    bins = lambda k: index[start[k] + n[k] - len(qu.STATISTICS) - 1 :][repeated] - qu.BUCKETS - qu.BINS * repeated
    assert bins(0) > bins(6) == 0


def test_edges(spark):
    rows = [(i, t, "x") for i, t in enumerate([None, "", "Good text here.", "bad bad bad bad"] * 30)] + [(None, "Good text here.", "x"), (2, "Good text here.", "x"), (500, "long " * 200_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(2, 120) if i % 4 > 1] + [(3, None), (None, 1), (2, 0), (2, 0)], "doc_id long, quality int")
    labels = labels.withColumn("quality", 1 - labels.quality)
    got = [tuple(r) for r in qu.predict(docs, labels).collect()]
    assert len(got) == len(rows) and got == [tuple(r) for r in qu.predict(docs, labels).collect()]
    assert {r[1] for r in got if r[0] is None} == {False}
    by_text = {}
    for (doc, text, _), r in zip(sorted(rows, key=str), sorted(got, key=str), strict=True):
        assert by_text.setdefault(text or "", r[2]) == r[2] or doc is None
    assert by_text["Good text here."] > 0.8 > 0.2 > by_text["bad bad bad bad"]
    assert qu.predict(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in qu.predict(docs, labels.limit(0)).collect()} == {0.5}
    assert {r["predicted"] for r in qu.predict(docs.where("doc_id is null"), labels).collect()} == {1}
