"""Near-duplicate classes against all pairs, and the signatures against weighted Jaccard."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tapeloom.llm import neardup as nd

SF = "/root/testdata/sf0.001"


def bag(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()


def similarity(a, b):
    both = sum((a & b).values())
    either = sum((a | b).values())
    return both / either if either else 0.0


def plain_classes(rows):
    texts = sorted({t or "" for _, t in rows})
    bags = [bag(t) for t in texts]
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= 0.8 - 1e-9:
                parent[top(i)] = top(j)
    of = {t: top(i) for i, t in enumerate(texts)}
    least = {}
    for d, t in rows:
        c = of[t or ""]
        least[c] = d if c not in least or least[c] is None or (d is not None and d < least[c]) else least[c]
    return sorted(((d, least[of[t or ""]]) for d, t in rows), key=str)


def got(df):
    return sorted(((r["doc_id"], r["class_id"]) for r in nd.classes(df).collect()), key=str)


@pytest.mark.parametrize(("a", "b"), [((1, 1, 1, 0), (1, 1, 0, 1)), ((7, 1, 0, 3), (5, 2, 1, 3)), ((100, 3), (80, 6)), ((1,), (9,))])
def test_signatures_estimate_weighted_jaccard(a, b):
    m = 4096
    rng = np.random.default_rng(2)
    e = rng.integers(0, 1 << 62, len(a)).astype(np.uint64)
    both = np.array([*a, *b])
    row = np.repeat([0, 1], len(a))
    own = both > 0
    s = nd.signatures(row[own], np.concatenate((e, e))[own], both[own], 2, m)
    want = sum(map(min, a, b)) / sum(map(max, a, b))
    assert abs((s[0] == s[1]).mean() - want) < 4 * (want * (1 - want) / m) ** 0.5 + 1e-9


def test_bands_miss_no_more_than_before():
    for s in (0.8, 0.85, 0.9, 0.95):
        assert (1 - s**nd.ROWS) ** nd.BANDS <= (1 - s**4) ** 24


def test_documents_match_all_pairs(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert got(df) == plain_classes(rows)
    assert len({c for _, c in plain_classes(rows)}) < len(rows)


def test_large_near_group_chains_and_edges(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):  # near copies of one text, not all near each other
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((i + 100, " ".join(w)))
    chain = [f"c{i}" for i in range(80)]
    for i in range(12):  # each near the next only
        rows.append((i + 1000, " ".join(chain[i * 3 :] + [f"d{j}" for j in range(i * 3)])))
    half = [f"h{i}" for i in range(40)]
    for i in range(60):  # share half a text, aren't near
        rows.append((i + 2000, " ".join(half + [f"h{i}_{j}" for j in range(30)])))
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "one  two"), (6, "one three"), (None, "one two"), (7, "a a a a a a a a a a"), (8, "a a a a a a a a a"), (8, "a a a a a a a a a"), (9, "lone text that has no copy")]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, node long, bands string")
    assert got(df) == plain_classes(rows)
    kept = nd.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted({c for _, c in plain_classes(rows)}, key=str)
    assert nd.deduplicate(df.limit(0)).count() == 0


def test_columns_of_any_name_and_ids_of_any_type(spark):
    rows = [("b", "one two three four five six", 1, 2, 3, 4), ("a", "one two three four five six", 5, 6, 7, 8), (None, "seven", 9, 0, 1, 2), ("c", None, 1, 2, 3, 4)]
    df = spark.createDataFrame(rows, "doc_id string, text string, _id int, _node int, _rows int, _Node_ int")
    kept = nd.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[2], rows[3]], key=str)
    assert sorted(((r["doc_id"], r["class_id"]) for r in nd.classes(df).collect()), key=str) == sorted([("b", "a"), ("a", "a"), (None, None), ("c", "c")], key=str)


def test_near_copies_caught_against_exact_pairs(spark):
    """Recall for the stated query set: every row whose id is divisible by 50, against all rows, at sf0.1."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()]
    bags = {d: bag(t) for d, t in rows}
    where = {}
    for d, b in bags.items():
        for x in b:
            where.setdefault(x, []).append(d)
    class_of = dict(got(spark.createDataFrame(rows, "doc_id long, text string")))
    due = 0
    for q in (d for d in bags if d % 50 == 0):
        size = sum(bags[q].values())
        met = {d for x in bags[q] for d in where[x] if d != q and 0.8 * size - 1 <= sum(bags[d].values()) <= size / 0.8 + 1}
        for d in met:
            if similarity(bags[q], bags[d]) >= 0.8:
                due += 1
                assert class_of[q] == class_of[d]
    assert due > 20
