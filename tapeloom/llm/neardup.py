"""Near-duplicate classes: BagMinHash signatures of shingle multisets, banding, exact verification, components.

The weight of a shingle is the number of times it occurs. Weights are cut into intervals [0, 1), [1, 2), [2, 4),
[4, 8) and so on; each shingle has a Poisson process on each interval, as wide as the interval is, whose points
carry a time, a component of the signature and a place in the interval. A shingle of weight w sees the points at
places below w, so two documents share exactly the points of the lesser weight: the first point of each component
is shared with a probability that equals their weighted Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.shared import cut, own_name
from tapeloom.llm.textblocks import blocks, list_column, mix, rolling, utf8, word_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
#: Bands of rows each: at similarity 0.8 a pair shares no band with probability (1 - 0.8^6)^42 = 2.8e-6, at 0.85 with 2e-9.
BANDS, ROWS = 42, 6
#: Bytes of text that a task works on at once: shingles, processes and signatures take some hundred times as much.
BLOCK = 1_000_000
#: One in so many shingles, by hash, serves to tell how much of a text others share.
SAMPLE = 16


def shingle_bags(column: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row its distinct shingles, in order: row number, hash, count. Fewer than k words are one shingle."""
    raw, at = utf8(column)
    first, end, row_first = words(raw, at)
    hashes = word_hashes(raw, first, end)
    n = np.diff(row_first)
    size = np.minimum(n, k)
    per = np.where(n > 0, n - size + 1, 0)
    row = np.repeat(np.arange(len(n)), per)
    start = np.arange(len(row)) - (np.cumsum(per) - per)[row] + row_first[row]
    shingles = rolling(hashes, start, start + size[row])
    by = np.lexsort((shingles, row))
    row, shingles = row[by], shingles[by]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (shingles[1:] != shingles[:-1])
    at_ = np.flatnonzero(new)
    return row[at_], shingles[at_], np.diff(np.append(at_, len(row)))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(row: np.ndarray, shingle: np.ndarray, count: np.ndarray, rows: int, m: int = BANDS * ROWS) -> np.ndarray:
    """rows x m times of the first points; infinite throughout for a row without shingles.

    A process is followed until a time by which its row's components have very likely all been hit; rows where one
    hasn't are gone over again to twice that time, so the result is exact.
    """
    out = np.full((rows, m), np.inf)
    total = np.bincount(row, weights=count, minlength=rows)
    until = np.where(total > 0, (np.log(m) + 4.0) / np.maximum(total, 1), 0.0)
    todo = total > 0
    level_of = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 2))).astype(np.int64), 0)
    # one process for each shingle and interval: interval 0 is [0, 1), interval j is [2^(j-1), 2^j)
    reps = level_of + 1
    e = np.repeat(np.arange(len(row)), reps)
    level = np.arange(len(e)) - (np.cumsum(reps) - reps)[e]
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0).astype(np.float64)
    width = np.where(level > 0, low, 1.0)
    seed = mix(shingle[e] + level.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    while todo.any():
        own = np.flatnonzero(todo[row[e]])
        time, step = np.zeros(len(own)), 0
        while len(own):
            step += 1
            draw = mix(seed[own] + np.uint64(step * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            time = time - np.log(_uniform(draw)) / (m * width[own])
            go = time <= until[row[e[own]]]
            own, time, draw = own[go], time[go], draw[go]
            more = mix(draw ^ np.uint64(0xD6E8FEB86659FD93))
            component = (more % np.uint64(m)).astype(np.int64)
            # halving the interval again and again draws the bits of the place, highest first
            seen = low[own] + _uniform(mix(more)) * width[own] < count[e[own]]
            np.minimum.at(out, (row[e[own[seen]]], component[seen]), time[seen])
        todo = np.isinf(out).any(axis=1) & (total > 0)
        until = np.where(todo, until * 2, until)
    return out


def expanded(row: np.ndarray, shingle: np.ndarray, count: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's multiset as a sorted set of (shingle, occurrence) hashes, and its size: set overlap is multiset overlap."""
    e = np.repeat(np.arange(len(row)), count)
    nth = np.arange(len(e)) - (np.cumsum(count) - count)[e]
    every = mix(shingle[e] + nth.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    every = every[np.lexsort((every, row[e]))]
    return every, np.bincount(row[e], minlength=rows)


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, node (the text's MD5), n (shingles), the bands' hashes and a sample of the shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in blocks(whole, limit=BLOCK):
                row, shingle, count = shingle_bags(part.column("text"))
                rows = part.num_rows
                bits = signatures(row, shingle, count, rows).view(np.uint64).reshape(rows, BANDS, ROWS)
                band = np.zeros((rows, BANDS), dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)
                for i in range(ROWS):
                    band = mix(band ^ bits[:, :, i]) + np.uint64(i + 1)
                n = np.bincount(row, weights=count, minlength=rows).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * BANDS), pa.array(band.ravel().view(np.int64)))
                some = shingle % np.uint64(SAMPLE) == 0
                sample = list_column(np.bincount(row[some], minlength=rows), pa.array(shingle[some].view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("node"), pa.array(n), lists, sample], ["doc_id", "node", "n", "bands", "sample"])

    longs = T.ArrayType(T.LongType())
    schema = T.StructType([docs.schema["doc_id"], T.StructField("node", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("bands", longs), T.StructField("sample", longs)])
    return docs.mapInArrow(run, schema)


def _bags(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in blocks(whole, limit=BLOCK):
                row, shingle, count = shingle_bags(part.column("text"))
                every, sizes = expanded(row, shingle, count, part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("node"), list_column(sizes, pa.array(every.view(np.int64)))], ["node", "bag"])

    return texts.select("node", "text").mapInArrow(run, "node binary, bag array<long>")


def _verified(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose multiset overlap reaches the similarity."""
    with_a = pairs.join(bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a")), "a")
    with_both = with_a.join(bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("bag_a"), batch.column("bag_b"), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return with_both.select("a", "b", "bag_a", "bag_b").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """Connected components: node, comp (the least node). Each round every node takes the least label around it, and
    that label's own label; rounds are written tables.

    Groups are summed before the shuffle. The two joins meet a node with very many neighbours, or a component of very
    many nodes, under one key with a single row on the other side: AQE's skew join splits such a key.
    """
    pairs = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).where("x <> y")
    both = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
    label = cut(both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("comp")))
    both = cut(both)
    while True:
        # the least label around a node, then the label of that label
        near = both.join(label.select(F.col("node").alias("y"), "comp"), "y").groupBy("x").agg(F.min("comp").alias("m"))
        hop = label.join(near.withColumnRenamed("x", "node"), "node").select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        jump = cut(hop)
        parent = jump.select(F.col("node").alias("p"), F.col("comp").alias("up"))
        new = cut(jump.join(parent, F.col("comp") == F.col("p"), "left").select("node", "old", F.least("comp", F.coalesce("up", "comp")).alias("comp")))
        label = new.select("node", "comp")
        if new.where("old <> comp").isEmpty():
            return label


def classes(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The near-duplicate class of every document: doc_id, class_id (least id in the class), n_shingles. See ``_classes``."""
    return _classes(docs, similarity, id_col, text_col).select("doc_id", "class_id", "n_shingles")


def _classes(docs: DataFrame, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """doc_id, node (the text), n_shingles, and of the class its least id and the text that goes with it.

    Two texts are linked where the weighted Jaccard similarity of their bags of five-word shingles reaches
    ``similarity``; classes are the components of the links. Equal texts are one node. Texts of one to four words
    are one shingle. Texts without words (null counts as empty) are linked to equal texts only. Rows of equal
    id and text are copies. Ids may be of any type that sorts. An empty table gives an empty result; other columns
    are ignored. A task holds a block of text or one longer text, some sixty times its size.

    Candidates are texts that share a bucket (band). All members of a bucket are verified against its leader, the
    text of which most is shared: originals come before their variants. So the copies and variants of one text
    are one component without pairs among them. Where a bucket then still holds several components, its texts are
    joined by an exact prefix filter on their bags, across components only, and verified. No pair of a bucket
    that reaches the similarity is left out: it is connected already or verified.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.unhex(F.md5(text)).alias("node"))
    signed = cut(_signed(source))
    rep = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "n", "bands", "sample")  # null ids last
    nodes = cut(signed.groupBy("node").agg(F.min(rep).alias("r")).select("node", F.col("r.doc_id").alias("rep"), F.col("r.n").alias("n"), F.col("r.bands").alias("bands"), F.col("r.sample").alias("sample")))
    member = nodes.where("n > 0").select("node", "n", F.explode("bands").alias("bucket"))
    shared = cut(member.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket"))
    member = cut(member.join(shared.hint("merge"), "bucket").select("bucket", "node", "n"))
    wanted = cut(member.select("node").distinct())
    sample = nodes.join(wanted, "node", "left_semi").select("node", F.size("sample").alias("all"), F.explode("sample").alias("shingle"))
    common = cut(sample.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("shingle"))
    score = cut(sample.join(common, "shingle").groupBy("node").agg((F.count(F.lit(1)) / F.max("all")).alias("score")))
    member = cut(member.join(score, "node", "left").select("bucket", "node", "n", F.coalesce("score", F.lit(0.0)).alias("score")))
    comp = _link(source, nodes.select("node", "rep"), wanted, member, similarity)
    named = cut(nodes.select("node", "rep").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    least = cut(named.groupBy("comp").agg(F.min(F.struct(F.col("rep").isNull().alias("no_id"), "rep", "node")).alias("l")).select("comp", F.col("l.rep").alias("class_id"), F.col("l.node").alias("class_node")))
    by_node = cut(named.join(least, "comp").select("node", "class_id", "class_node"))
    return signed.select("doc_id", "node", F.col("n").alias("n_shingles")).join(by_node, "node")


def _rest(active: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of different components that may still reach the similarity: an exact prefix filter.

    active: node, n, comp. c of a bag's n entries occur in bags of other components. A pair needs an overlap of
    (n + m) * similarity / (1 + similarity), and can't have more than either's c. With entries ordered by how few
    bags have them, those that no other component has first, it must share one of the first n - need + 1 of both,
    where the smaller bag needs 2 * similarity / (1 + similarity) of its n at least, the larger one similarity, and
    both together what the pair needs. What is shared up to the last such entry, and what is left after it on the
    shorter side, bounds the overlap.
    """
    ratio = similarity / (1 + similarity)
    entry = bags.join(active.hint("merge"), "node").select("node", "n", "comp", F.explode("bag").alias("e"))
    across = cut(entry.groupBy("e").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("df")).where("lo <> hi").select("e", "df"))
    own = entry.join(across.hint("merge"), "e").groupBy("node", "n", "comp").agg(F.array_sort(F.collect_list(F.struct("df", "e"))).alias("es")).withColumn("c", F.size("es"))
    slots = lambda share: (F.col("c") - F.ceil(F.col("n") * share - 1e-9) + 1).cast("int")
    prefix = own.where(slots(similarity) > 0).select("node", "n", "comp", "c", slots(2 * ratio).alias("inner"), F.posexplode(F.slice("es", F.lit(1), slots(similarity))))
    prefix = cut(prefix.select("node", "n", "comp", "c", "inner", "pos", F.col("col.e").alias("e")))
    larger = prefix.select("e", *[F.col(x).alias(f"r_{x}") for x in ("node", "n", "comp", "c", "pos")])
    need = (F.col("n") + F.col("r_n")) * ratio - 1e-6
    after = F.least(F.col("c") - F.col("pos"), F.col("r_c") - F.col("r_pos"))
    ordered = (F.col("n") < F.col("r_n")) | ((F.col("n") == F.col("r_n")) & (F.col("node") < F.col("r_node")))
    met = prefix.where("pos < inner").join(larger.hint("merge"), "e").where(ordered & (F.col("comp") != F.col("r_comp")) & (F.least("pos", "r_pos") + after >= need) & (F.col("pos") <= F.col("c") - need) & (F.col("r_pos") <= F.col("r_c") - need))
    shared = met.groupBy("node", "r_node", "n", "r_n").agg(F.count(F.lit(1)).alias("k"), F.max("pos").alias("i"), F.max("r_pos").alias("j"), F.max("c").alias("c"), F.max("r_c").alias("r_c"))
    left = F.least(F.col("c") - F.col("i"), F.col("r_c") - F.col("j")) - 1
    return shared.where(F.col("k") + left >= need).select(F.least("node", "r_node").alias("a"), F.greatest("node", "r_node").alias("b"))


def _merge(comp: DataFrame, links: DataFrame) -> DataFrame:
    """node, comp after the links have joined components."""
    if links.isEmpty():
        return comp
    of_a, of_b = (comp.select(F.col("node").alias(x), F.col("comp").alias(f"c{x}")) for x in "ab")
    edges = links.join(of_a, "a").join(of_b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).where("a <> b").distinct()
    merged = components(cut(edges))
    return cut(comp.join(merged.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")))


def _link(source: DataFrame, reps: DataFrame, wanted: DataFrame, member: DataFrame, similarity: float) -> DataFrame:
    """Components of the verified links: node, comp. reps: node, rep (its least id); member: bucket, node, n, score."""
    # the row with a text's least id stands for all its copies: these don't meet under the text's key
    of = wanted.join(reps.hint("merge"), "node").select(F.col("node").alias("_n"), F.col("rep").alias("_r"))
    one = source.join(of.hint("merge"), (F.col("node") == F.col("_n")) & F.col("doc_id").eqNullSafe(F.col("_r")), "left_semi")
    bags = cut(_bags(one.select("node", "text")).dropDuplicates(["node"]))
    comp = wanted.select("node", F.col("node").alias("comp"))
    lead = member.groupBy("bucket").agg(F.max(F.struct("score", "node", "n")).alias("l")).select("bucket", F.col("l.node").alias("l_node"), F.col("l.n").alias("l_n"))
    # sizes further apart than the similarity can't overlap enough
    near = F.least("n", "l_n") >= F.greatest("n", "l_n") * similarity - 1e-9
    met = member.join(cut(lead).hint("merge"), "bucket").where((F.col("node") != F.col("l_node")) & near)
    pairs = cut(met.select(F.least("node", "l_node").alias("a"), F.greatest("node", "l_node").alias("b")).distinct())
    comp = _merge(comp, cut(_verified(pairs, bags, similarity)))
    placed = member.select("bucket", "node", "n").join(comp.hint("merge"), "node")
    open_ = cut(placed.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket"))
    active = cut(placed.join(open_.hint("merge"), "bucket", "left_semi").select("node", "n", "comp").distinct())
    rest = cut(_rest(active, bags, similarity).join(pairs, ["a", "b"], "left_anti"))
    return _merge(comp, cut(_verified(rest, bags, similarity)))


def deduplicate(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, with all its columns: the one with the least id. Of rows with one id and text one stays.

    Classes as in ``_classes``. Of two rows with the least id the one whose text's hash is less stays. Null ids come
    last. Columns may have any names; an empty table gives an empty one.
    """
    found = cut(_classes(docs, similarity, id_col, text_col).select("doc_id", "node", "class_id", "class_node"))
    id_, node_, rows_ = (own_name(x, docs) for x in ("_id", "_node", "_rows"))
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("class_node"))
    keep = cut(found.where(first).groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias(rows_)).withColumnsRenamed({"doc_id": id_, "node": node_}))
    node = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    stay = docs.join(keep, F.col(id_col).eqNullSafe(F.col(id_)) & (node == F.col(node_)))
    once = stay.where(F.col(rows_) == 1).select(docs.columns)
    if keep.where(F.col(rows_) > 1).isEmpty():
        return once
    return once.unionByName(stay.where(F.col(rows_) > 1).dropDuplicates([id_, node_]).select(docs.columns))
