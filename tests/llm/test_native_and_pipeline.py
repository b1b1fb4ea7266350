"""Sharding, fingerprints, mixing and the pipeline against SQL, plain versions and edge rows."""

import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tapeloom.llm import merkle, mixing, queries, sharding, sql

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, size long, rank long, tree string, _pid int"
EDGE = [
    (1, None, "a", 0, 0, "", 0),
    (2, "", None, 0, 0, "", 0),
    (None, "x. y\n\nz \U0001f600", "b", 0, 0, "", 0),
    (4, "same text here", "b", 0, 0, "", 0),
    (4, "same text here", "b", 0, 0, "", 0),
    (5, "w " * 20000, None, 0, 0, None, 0),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


def plain(value):
    return f"{value:.6g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in Path(SF).iterdir():
        con.execute(f"create view {f.stem} as select * from '{f}'")
    want = con.sql(sql.ORACLES[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    cols = want.columns
    assert sorted(tuple(plain(r[c]) for c in cols) for r in got.collect()) == sorted(tuple(map(plain, r)) for r in want.fetchall())


def test_shards_balance_and_edges(spark, edge):
    rows = sharding.shard_by_bytes(spark.read.parquet(f"{SF}/documents.parquet"), 5).collect()
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
    assert max(load.values()) - min(load.values()) <= 2 * max(r["size"] for r in rows)
    for s in range(5):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    got = sharding.shard_by_bytes(edge).collect()
    assert len(got) == len(EDGE)
    text = {1: "", 2: "", None: EDGE[2][1], 4: EDGE[3][1], 5: EDGE[5][1]}
    assert all(r["size"] == len(text[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in got)
    assert sharding.shard_by_bytes(edge.limit(0)).count() == 0


def test_fingerprints(spark, edge):
    got = merkle.fingerprint_edits(edge).collect()
    assert len(got) == len(EDGE)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == by[2]["fingerprint"]
    assert by[2]["near_next"] == 1.0  # the next by descending id is 1: both are empty
    order = sorted(EDGE, key=lambda r: (r[0] is not None, r[0]), reverse=True)
    for i, (d, t, *_) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        assert by[d]["n_chars"] == len(t)
        if d != 4:
            half = len(t) // 2
            import hashlib

            assert by[d]["edited_sha256"] == hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()
    assert merkle.fingerprint_edits(edge.limit(0)).count() == 0
    assert merkle.fingerprint_edits(edge.where("doc_id = 5")).first()["near_next"] == 1.0


def test_ranges_are_partitions_and_ids_are_numbers(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(3000)], "doc_id long, text string")
    out = merkle.with_next(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "shufflepartitionidpassthrough" in plan
    assert plan.count("hashpartitioning(_range") == 1  # that of the guests, a row a range
    assert {r["doc_id"]: r["next_text"] for r in out.collect()} == {i: f"text {(i - 1) % 3000}" for i in range(3000)}
    with pytest.raises(ValueError, match="whole number"):
        merkle.with_next(df.select(F.col("doc_id").cast("string"), "text"))


def test_differing_branches(spark):
    a, b = "h1\np one. p two.\n\ns2\nq", "h1\np one. p 2.\n\ns2\nq\nr"
    df = spark.createDataFrame([(a, b)], "a string, b string").select(merkle.differing(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("d"))
    assert [tuple(x) for x in df.first()["d"]] == [(0, 1), (1, 2)]


def test_targets_and_flow():
    assert mixing.capped_targets([100, 10, 90], [5, 2, 1]) == pytest.approx([100 / 0.6 * 0.85, 30, 100 / 0.6 * 0.17])
    assert mixing.capped_targets([0, 0], [5, 2]) == [0, 0]
    # pattern 1 serves both sources; only pattern 0 may repeat to fill source 0
    flow = mixing.route([10, 20], [[0], [0, 1]], [15, 25])
    assert sum(f.get(0, 0) for f in flow) == 15 and sum(f.get(1, 0) for f in flow) == 25
    assert sum(flow[0].values()) + sum(flow[1].values()) == 40


def cheapest(capacity, members, quota, repeats=3):
    """Plain search over how much each pattern gives: most words first, then least repetition cost."""
    import itertools

    best = None
    for given in itertools.product(*(range(repeats * c + 1) for c in capacity)):
        for split in _splits(given, members):
            filled = [0] * len(quota)
            for p, parts in enumerate(split):
                for s, x in zip(members[p], parts, strict=True):
                    filled[s] += x
            if all(f <= q for f, q in zip(filled, quota, strict=True)):
                cost = sum(max(0, g - c) + max(0, g - 2 * c) for g, c in zip(given, capacity, strict=True))
                best = min(best or (1, 1), (-sum(given), cost))
    return best


def _splits(given, members):
    import itertools

    return itertools.product(*([(g,)] if len(m) == 1 else [(x, g - x) for x in range(g + 1)] for g, m in zip(given, members, strict=True)))


@pytest.mark.parametrize(("capacity", "members", "quota"), [([2, 3], [[0], [0, 1]], [4, 6]), ([1, 2, 2], [[0], [0, 1], [1]], [5, 4]), ([3, 1], [[0, 1], [1]], [2, 8])])
def test_flow_is_cheapest(capacity, members, quota):
    flow = mixing.route(capacity, members, quota)
    given = [sum(f.values()) for f in flow]
    cost = sum(max(0, g - c) + max(0, g - 2 * c) for g, c in zip(given, capacity, strict=True))
    assert (-sum(given), cost) == cheapest(capacity, members, quota)


def test_mix_overlapping_sources_and_edges(spark, edge):
    df = spark.createDataFrame([(i, "w " * 10, ["a"] if i < 40 else ["a", "b"] if i < 60 else ["b"]) for i in range(100)], "doc_id long, text string, m array<string>")
    got = mixing.mix(df, members_col="m").collect()
    assert all(r["taken"] == r["copies"] * 10 for r in got)
    assert abs(sum(r["taken"] for r in got) - 1000) <= 40
    assert max(r["copies"] for r in got) <= 3
    rows = mixing.mix(edge).collect()
    assert len(rows) == len(EDGE) and {r["size"] for r in rows} == {0, 4, 3, 20000}
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix(edge.limit(0)).count() == 0
    assert mixing.mixed(edge.limit(0)).count() == 0
    assert mixing.mixed(edge).columns == edge.columns


def test_mixed_keeps_columns_of_any_name_and_ids_of_any_type(spark):
    rows = [(f"d{i}", "w " * 10, "a" if i < 20 else None, i, i, i, i, i) for i in range(40)] + [("e", None, "a", 0, 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string, _id int, _key int, _copies int, _row int, _n int")
    out = mixing.mixed(df)
    assert out.columns == df.columns
    got = Counter(map(tuple, out.collect()))
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(df).collect()}
    assert got == Counter({r: want[r[0]] for r in rows if want[r[0]]})


def test_many_sets_of_sources_are_joined_by_a_shuffle(spark, monkeypatch):
    df = spark.createDataFrame([(i, "w " * (i % 7), [str(i % 11), str(i % 5)]) for i in range(200)], "doc_id long, text string, m array<string>")
    want = sorted(map(tuple, mixing.mix(df, members_col="m").collect()))
    monkeypatch.setattr(mixing, "BROADCAST_PATTERNS", 3)
    assert sorted(map(tuple, mixing.mix(df, members_col="m").collect())) == want


def test_components_are_solved_apart():
    members = [[0, 1], [1], [2], [3, 4], [4]]
    whole = mixing._route([10, 20, 30, 40, 50], members, [25, 9, 70, 60, 20])
    parts = mixing.route([10, 20, 30, 40, 50], members, [25, 9, 70, 60, 20])
    assert [sum(f.values()) for f in whole] == [sum(f.values()) for f in parts]
    assert sorted(map(sorted, mixing._components(members, 5))) == [[0, 1], [2], [3, 4]]


def test_flow_of_many_sources_is_quick():
    n = 20_000
    flow = mixing.route([10] * n, [[i] for i in range(n)], [5 + i % 30 for i in range(n)])
    assert [f[i] for i, f in enumerate(flow)] == [min(30, 5 + i % 30) for i in range(n)]


def test_shared_folder(spark, monkeypatch):
    from tapeloom.llm import shared

    table = shared.cut(spark.range(3))
    assert table.count() == 3
    assert shared.clear(spark) > 0 and shared.clear(spark) == 0

    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"getConf": staticmethod(lambda: {}), "master": "spark://host:7077"})

    with pytest.raises(ValueError, match="checkpoint"):
        shared.shared_dir(Cluster())


def test_pipeline_on_an_empty_table_and_clashing_names(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for table, rows in (("documents", docs.limit(0)), ("benchmark", spark.read.parquet(f"{SF}/benchmark.parquet"))):
        rows.write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    names = ("_id", "_node", "_rows", "_row", "_n", "_key", "_copies", "class_id", "size", "shard", "kind", "n", "g")
    more = docs.where("doc_id < 40").withColumns({x: F.lit(1) for x in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, SF)
        assert out.columns == more.columns, name
        assert out.select(F.min("_n"), F.max("_row")).first() == (1, 1)
    assert corpus_pipeline.shards(spark, more, SF).count() == more.count()


@pytest.mark.parametrize("stage", ["op5", "op7", "op8", "op9"])
def test_a_text_of_megabytes(spark, stage):
    """One text of 6 MB among small ones goes through; a worker then holds some sixty times its size."""
    import random

    from tapeloom.llm import decontaminate, langid, neardup, phrases

    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(800_000))
    tail = long[-3000:]
    df = spark.createDataFrame([(1, long, "en"), (2, tail, "en"), (3, "short one", "en")], "doc_id long, text string, lang string").repartition(1)
    if stage == "op5":
        assert {r["class_id"] for r in neardup.classes(df).collect()} == {1, 2, 3}
    elif stage == "op7":
        got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in phrases.remove(df).collect()}
        whole = tail.split()[1:]
        assert got[1] == (800_000, got[2][1]) and len(whole) <= got[2][1] <= len(whole) + 1
    elif stage == "op8":
        assert {r["lang_pred"] for r in langid.identify(df, langid.fit(df)).collect()} == {"en"}
    else:
        bench = spark.createDataFrame([(1, " ".join(tail.split()[100:140]))], "item_id long, text string")
        assert sorted(r["doc_id"] for r in decontaminate.search(df, bench).collect()) == [1, 2]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, kept = [docs], {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], SF)
        rows = out.collect()
        kept[name] = rows
        if name != "shards":
            assert out.columns == docs.columns
            seen.append(spark.createDataFrame(rows, docs.schema))
    ids = {k: Counter(r["doc_id"] for r in v) for k, v in kept.items()}
    assert not ({r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"])} - set(ids["language"]))
    from tests.llm.test_decontaminate import plain_words
    from tests.llm.test_neardup import plain_classes

    classes = plain_classes([(r["doc_id"], r["text"]) for r in kept["language"]])
    assert set(ids["near_duplicates"]) == {c for _, c in classes}
    items = [" ".join(plain_words(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in kept["near_duplicates"] if not any(f" {t} " in f" {' '.join(plain_words(r['text']))} " for t in items)}
    assert set(ids["benchmark"]) == clean
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(seen[3]).collect()}
    assert ids["mix"] == Counter({d: n for d, n in want.items() if n})
    assert ids["shards"] == ids["mix"]
    assert Counter(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()) == ids["shards"]
