"""Substring dedup against plain counting of every window."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapeloom.llm import phrases as p
from tapeloom.llm import textblocks

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, n_words long, places string, kept string"


def plain(rows, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, split, strict=True):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((d, len(w), len(gone), p.sha256_of(kept)))
    return sorted(out, key=str)


def got(df, window, **more):
    rows = p.digest(p.remove(df, window, **more)).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(5, 25))] for _ in range(6)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [rng.choice(vocab) for _ in range(rng.randint(0, 12))]
            x = rng.choice(passages)
            a = rng.randint(0, len(x) - 1)
            w += x[a:] if rng.random() < 0.7 else []
        rows.append((i, rng.choice([" ", "\n", "  ", "\t"]).join(w)))
    return rows


@pytest.mark.parametrize(("window", "shard_words"), [(8, 10**6), (8, 40), (12, 300), (3, 5000), (1, 100)])
def test_matches_plain_counting(spark, window, shard_words):
    rows = [*corpus(window + shard_words), (1, "a b " * 40), (1, "a b " * 40), (None, "a b " * 40), (7, None), (8, ""), (9, " \n\t ")]
    df = spark.createDataFrame([(d, t, 0, "x", "y") for d, t in rows], SCHEMA)
    assert got(df, window, shard_words=shard_words) == plain(rows, window)


def hashed(words):
    raw, at = textblocks.utf8(pa.array([" ".join(words)]))
    first, end, _ = textblocks.words(raw, at)
    return textblocks.word_hashes(raw, first, end)


def test_automaton_locates_every_occurrence():
    rng = random.Random(1)
    words = [f"w{rng.randrange(700)}" for _ in range(5000)]
    passages = [words[i : i + rng.randint(6, 9)] for i in (rng.randrange(4900) for _ in range(300))]
    machine = p.Automaton(pa.array([" ".join(x) for x in passages]), 6)
    known = {tuple(x[i : i + 6]) for x in passages for i in range(len(x) - 5)}
    cuts = np.array([0, 1000, 1003, 5000])
    want = [i for i in range(4995) if tuple(words[i : i + 6]) in known and not any(i < c < i + 6 for c in cuts)]
    assert machine.locate(hashed(words), cuts).tolist() == want
    none = p.Automaton(pa.array([], pa.string()), 6)
    assert none.locate(np.arange(9).astype(np.uint64), np.array([0, 9])).tolist() == []


def test_common_passage_is_a_row_a_block_and_shard(spark):
    """A passage that all documents share isn't gathered by its occurrences."""
    rng = random.Random(2)
    own = lambda: " ".join(f"u{rng.randrange(10**9)}" for _ in range(20))
    rows = [(i, f"{own()} {' '.join(f'c{j}' for j in range(60))} {own()}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    source = p._source(df, "doc_id", "text")
    level = np.ceil(np.log2(p._sketch(source, 35) + 1)).astype(np.uint64)
    runs = p._runs(source.withColumn("shard", F.pmod("_h", F.lit(4)).cast("int")), 35, level)
    assert max(r["count"] for r in runs.groupBy("g").count().collect()) <= 10
    assert got(df, 35) == plain(rows, 35)


def test_one_text_of_one_word_again_and_again(spark):
    rows = [(1, "a " * 50), (2, "b c d " * 20), (3, "e f g h")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), 8) == plain(rows, 8)


def test_marked_runs_are_what_is_removed(spark):
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {d: n for d, _, n, _ in plain(rows, 8)}
    for r in p.recurring(df, 8).collect():
        spans = [(s["start"], s["end"]) for s in r["covered"]]
        assert sum(b - a for a, b in spans) == gone[r["doc_id"]]
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False)) and all(0 <= a < b <= r["n_words"] for a, b in spans)


def test_ids_of_any_type(spark):
    df = spark.createDataFrame([("x", "a b c d"), ("y", "b c d e"), (None, None)], "doc_id string, text string")
    assert got(df, 3) == plain([("x", "a b c d"), ("y", "b c d e"), (None, None)], 3)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA), 8) == []


def test_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert got(df, 35) == plain(rows, 35)
