"""Cross-tokenizer alignment against plain loops over tokens, and the matrix products against dense ones."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tapeloom.llm import alignment as al

SF = "/root/testdata/sf0.001"
EDGE = [
    (1, None, "x"), (2, "", "x"), (3, "a", "x"), (3, "a", "x"), (None, "<|endoftext|> and <s> été \U0001f600\n\n\tend  ", None),
    (5, "zq" * 60000, "y"), (6, "▁ ▁", "y"), (7, "word " * 20000, "y"), (8, " two  spaces", "z"), (9, "ﬁ ½ Å", "z"),
]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(al.BYTE_LEVEL)
    a.encode_special_tokens = True
    of = {i: x for x, i in al.byte_level(open(al.BYTE_LEVEL, "rb").read()).items()}
    sp = sentencepiece.SentencePieceProcessor(model_file=al.PIECES)
    piece = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()

    def one(text):
        """Spans and ids of A and B, groups and links by loops; None for a text without tokens."""
        if not text:
            return None
        ids = a.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
        spans = []
        for xs, own in zip(ids, (of.get, piece), strict=True):
            if b"".join(map(own, xs)) != (" " + text).encode():
                return None
            at, out = 0, []
            for x in xs:
                out.append((at, at + len(own(x)), x))
                at = out[-1][1]
            spans.append(out)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, i, j = [], 0, 0
        for end in ends:
            ga, gb = [], []
            while i < len(spans[0]) and spans[0][i][1] <= end:
                ga.append(ids[0][i])
                i += 1
            while j < len(spans[1]) and spans[1][j][1] <= end:
                gb.append(ids[1][j])
                j += 1
            groups.append((ga, gb))
        links, j = [], 0
        for m, (s, e, x) in enumerate(spans[0]):
            while j and spans[1][j - 1][1] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][0] < e:
                if spans[1][j][1] > s:
                    links.append((m, j, min(e, spans[1][j][1]) - max(s, spans[1][j][0]), x, spans[1][j][2]))
                j += 1
        return ids, groups, links

    return one


def expected(rows, one):
    found = [(doc, one(text)) for doc, text in rows]
    counts = Counter(link[3:] for _, f in found if f for link in f[2])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for doc, f in found:
        if f is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, 0, ""))
            continue
        (a, b), groups, links = f
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        held = [counts[x[3:]] for x in links]
        out.append((doc, len(a), len(b), len(groups), len(links), sum(n == most[x[4]] for n, x in zip(held, links, strict=True)), sum(held), sum(len(x) * len(y) for x, y in groups), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_loops(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted((tuple(r) for r in al.link_counts(docs).collect()), key=str)
    assert got == expected([tuple(r) for r in docs.select("doc_id", "text").collect()], plain)


def test_edges(spark, plain):
    docs = spark.createDataFrame(EDGE, "doc_id long, text string, n_a string")
    got = sorted((tuple(r) for r in al.link_counts(docs).collect()), key=str)
    assert got == expected([r[:2] for r in EDGE], plain)
    assert [r for r in got if r[0] in (1, 2)] == [(1, 0, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, 0, "")]
    assert al.link_counts(docs.limit(0)).count() == 0 and al.align(docs.limit(0)).count() == 0
    assert al.link_counts(docs.where("doc_id = 1")).count() == 1


def test_aligned_rows_and_shared_groups(spark, plain):
    docs = spark.createDataFrame([r for r in EDGE if r[0] in (1, 3, 8) or r[0] is None], "doc_id long, text string, b string")
    aligned = al.align(docs)
    for row in aligned.collect():
        text = next(r[1] for r in EDGE if r[0] == row["doc_id"])
        want = plain(text)
        if want is None:
            assert not row["a"] and not row["link_a"]
            continue
        (a, b), groups, links = want
        assert (row["a"], row["b"]) == (a, b) and row["a_end"][-1] == row["b_end"][-1] == len((" " + text).encode())
        assert list(zip(row["link_a"], row["link_b"], row["link_bytes"], strict=True)) == [x[:3] for x in links]
        assert row["group_a"] == list(np.cumsum([len(x) for x, _ in groups])) and row["group_b"] == list(np.cumsum([len(x) for _, x in groups]))
    shared = al.shared_groups(aligned.where("doc_id = 8"))
    _, groups, _ = plain(" two  spaces")
    assert shared.count() == sum(len(x) * len(y) for x, y in groups)


def test_products_equal_dense_ones():
    rng = np.random.default_rng(3)
    for _ in range(30):
        width = int(rng.integers(1, 60))
        ends = [np.unique(np.append(rng.integers(1, width + 1, rng.integers(0, width)), width)) for _ in range(2)]
        dense = []
        for e in ends:
            m = np.zeros((len(e), width), dtype=int)
            for t, (s, x) in enumerate(zip(np.concatenate(([0], e)), e, strict=False)):
                m[t, s:x] = 1
            dense.append(m)
        want = dense[0] @ dense[1].T
        for slab in (1, 7, 1000):
            i, j, v = al.overlaps(*ends, slab)
            got = np.zeros_like(want)
            got[i, j] = v
            assert (got == want).all() and len(i) == (want > 0).sum()
        common = np.intersect1d(*ends)
        a, b = (al.group_incidence(e, common) for e in ends)
        bt = al.transpose(b, len(common))
        pairs = {(i, j) for limit in (1, 3, 1000) for x, y in al.shared_links(a, bt, len(ends[1]), limit) for i, j in zip(x.tolist(), y.tolist(), strict=True)}
        group = [np.searchsorted(common, e) for e in ends]
        assert pairs == {(i, j) for i in range(len(ends[0])) for j in range(len(ends[1])) if group[0][i] == group[1][j]}
        assert al.product_sizes(a, bt).sum() == len(pairs)
    # terms of one column that come out of order are summed
    m = al.Csr(np.array([0, 3]), np.array([2, 0, 1]), np.array([1, 2, 3]))
    c = al.product(m, al.Csr(np.array([0, 1, 2, 4]), np.array([1, 0, 0, 1]), np.array([1, 1, 5, 7])), 2)
    assert (c.indices.tolist(), c.values.tolist()) == ([0, 1], [8, 9])


def test_ranks_encode_as_the_tokenizer_does():
    both = al.Tokenizers(open(al.BYTE_LEVEL, "rb").read(), open(al.PIECES, "rb").read())
    a = Tokenizer.from_file(al.BYTE_LEVEL)
    a.encode_special_tokens = True
    rng = random.Random(4)
    kinds = ["abcdefghij eat ing the", "0123456789 .,", "éèüß Жди 中文 ال", "\n\t  \r  ", "!?#$%&*()<|>'\"_-", "\U0001f600‍́กิ�\x00\x7f"]
    texts = ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(1, 400))) for _ in range(2000)]
    for text in texts:
        assert both._a.encode_ordinary(" " + text) == a.encode(" " + text, add_special_tokens=False).ids
