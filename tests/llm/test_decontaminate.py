"""Benchmark search against a plain edit distance over every window."""

import random
import re

import numpy as np

from tapeloom.llm import decontaminate as d

SF = "/root/testdata/sf0.01"


def plain_words(t):
    return ["".join(c) for c in re.findall(r"(?:[^\W_])+", (t or "").lower())]


def plain_best(item, doc):
    """Least edits from item to any stretch of doc."""
    prev = [0] * (len(doc) + 1)
    for i, x in enumerate(item, 1):
        cur = [i]
        for j, y in enumerate(doc, 1):
            cur.append(min(prev[j - 1] + (x != y), prev[j] + 1, cur[j - 1] + 1))
        prev = cur
    return min(prev)


def test_edit_distance_matches_plain():
    rng = np.random.default_rng(3)
    for _ in range(200):
        item, window = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(0, 15))
        cost, a, b = d.edit_distance(item.astype(np.uint64), window.astype(np.uint64))
        assert cost == plain_best(item.tolist(), window.tolist())
        assert plain_best(item.tolist(), window[a:b].tolist()) == cost


def test_planted_edits_are_found_and_clean_text_is_left(spark):
    rng = random.Random(11)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs, want = [], {}
    for k in range(300):
        i, t = rng.choice(items)
        words = t.split()
        for _ in range(rng.randint(0, int(0.2 * len(plain_words(t))))):
            at = rng.randrange(len(words))
            what = rng.random()
            words[at : at + 1] = [] if what < 0.3 and len(words) > 1 else ["zzz"] if what < 0.6 else [words[at], "yyy"]
        text = " ".join(["qqq"] * rng.randint(0, 30) + words + ["www"] * rng.randint(0, 30))
        docs.append((k, text))
        n = len(plain_words(t))
        want[k] = (i, plain_best(plain_words(t), plain_words(text)), int(0.2 * n + 1e-9))
    text_of = {i: plain_words(t) for i, t in items}
    for k in range(300, 400):  # clean: words of items, shuffled, and items with too many edits
        words = text_of[rng.choice(items)[0]][:]
        if k % 2:
            rng.shuffle(words)
        else:
            for at in rng.sample(range(len(words)), int(0.2 * len(words)) + 2):
                words[at] = f"other{at}"
        docs.append((k, " ".join(words)))
    found = d.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in found}
    due = {(k, i): e for k, (i, e, most) in want.items() if e <= most}
    assert sum(got.get(x) == e for x, e in due.items()) >= 0.98 * len(due)
    text = {k: plain_words(t) for k, t in docs}
    for (k, i), e in got.items():  # whatever is found is that near
        assert e == plain_best(text_of[i], text[k]) <= int(0.2 * len(text_of[i]) + 1e-9)
    assert not {k for k, _ in got if k >= 300 and min(plain_best(t, text[k]) - int(0.2 * len(t) + 1e-9) for t in text_of.values()) > 0}


def test_largest_edits_are_found_at_every_length():
    """Recall of the LSH at the full edit budget, and how many unrelated windows pass it."""
    rng = np.random.default_rng(5)
    for n in (10, 20, 50, 100):
        most, found, passed = int(0.2 * n + 1e-9), 0, 0
        for _ in range(100):
            words = [f"a{x}" for x in rng.integers(0, 10**6, n)]
            other = [f"b{x}" for x in rng.integers(0, 10**6, n)]
            items = d.Items([1], [" ".join(words)])
            copy = list(words)
            for _ in range(most):
                at, what = rng.integers(len(copy)), rng.integers(3)
                copy[at : at + 1] = [] if what == 0 else ["x"] if what == 1 else [copy[at], "y"]
            hits = items.match([" ".join(["p"] * 7 + copy + ["q"] * 7)])
            found += bool(hits)
            symbols, first = d.normal_words([" ".join(other)])
            passed += items.near(symbols, first, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))[0]
        assert found >= 97
        assert passed <= 12


def test_items_of_very_different_lengths_stay_small():
    texts = [" ".join(f"w{i}_{j}" for j in range(50)) for i in range(200)] + [" ".join(f"v{j}" for j in range(5000))]
    items = d.Items(list(range(201)), texts)
    assert items.values.nbytes < 201 * 1200
    assert [(r, i, c) for r, i, _, _, c in items.match([texts[200], texts[3], "none of them"])] == [(0, 200, 0), (1, 3, 0)]


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("d1", "one two three four five")], "doc_id string, text string")
    bench = spark.createDataFrame([("i1", "one two three four five")], "item_id string, text string")
    assert [tuple(r)[:2] for r in d.search(docs, bench).collect()] == [("d1", "i1")]


def test_documents_match_exact_containment(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(r["item_id"], " ".join(plain_words(r["text"]))) for r in bench.collect()]
    want = {(r["doc_id"], i) for r in docs.collect() for i, t in items if f" {t} " in f" {' '.join(plain_words(r['text']))} "}
    got = {(r["doc_id"], r["item_id"]) for r in d.search(docs, bench).collect()}
    assert got == want and want
    left = d.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} - {r["doc_id"] for r in left.select("doc_id").collect()} == {x for x, _ in want}


def test_items_of_null_and_equal_ids(spark):
    long, short = " ".join(f"w{i}" for i in range(20)), "one two three four five"
    docs = spark.createDataFrame([(1, long.replace("w3", "x")), (2, short), (3, "secret item of no id"), (4, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, long), (7, short), (None, "secret item of no id")], "item_id long, text string")
    got = [(r["doc_id"], r["item_id"], r["edits"], r["similarity"]) for r in d.search(docs, bench).collect()]
    assert sorted(got) == [(1, 7, 1, 0.95), (2, 7, 0, 1.0)]
    assert [r["doc_id"] for r in d.decontaminate(docs, bench).collect()] == [4]


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "a b c d", 1), (4, "a b c d", 1), (4, "a b c d", 1)], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([(1, "a b, C"), (2, None), (None, "a"), (3, "!!"), (4, "")], "item_id long, text string")
    got = [(r["doc_id"], r["item_id"], r["word_start"], r["word_end"]) for r in d.search(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([(None, 1, 0, 3), (4, 1, 0, 3), (4, 1, 0, 3)], key=str)
    assert d.search(docs.limit(0), bench).count() == 0
    assert d.search(docs, bench.limit(0)).count() == 0
    assert d.decontaminate(docs, bench).count() == 2


def test_one_word_again_and_again_is_bounded():
    """A text and an item of one repeated word: every place of the text meets every place of the item."""
    import tracemalloc

    items = d.Items([1, 2], ["a " * 60, "a b " * 30])
    tracemalloc.start()
    assert items.match(["a " * 50_000, "x"]) == [(0, 0, 0, 60, 0)]
    assert tracemalloc.get_traced_memory()[1] < 150e6
    tracemalloc.stop()


def test_several_passes_leave_the_same_documents(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["the first item of words here now", "none of these", None, "", "and a second item of words there then", "none of these"])], "doc_id long, text string")
    items = spark.createDataFrame([(None, "the first item of words here now"), (2, "a second item of words there then"), (2, "x y z")], "item_id long, text string")
    want = sorted(map(str, d.decontaminate(docs, items).collect()))
    assert len(want) == 4
    monkeypatch.setattr(d, "ITEMS_PER_PASS", 1)
    assert sorted(map(str, d.decontaminate(docs, items).collect())) == want
    assert sorted(d.search(docs, items).select("doc_id", "item_id").collect()) == [(4, 2)]
