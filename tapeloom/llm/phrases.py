"""Substring dedup: recurring passages are confirmed, compiled to sharded automata, and located by streaming all documents.

A window is ``window`` consecutive words of one text. Its anchor is a 5-gram in it, chosen by content, so equal
windows have equal anchors, and neighbouring windows mostly share one: an anchor stands for a run of windows.

1. Sketch. Grams are counted in CELLS counters, whatever the corpus. The anchor of a window is the gram whose counter
   is least (by powers of two), then the one of least hash. A window that sticks out of a very common passage takes
   its anchor from the part that sticks out, so only windows within such passages meet under a common anchor.
2. Confirm. Documents are dealt to shards. Runs of windows, as hashes, meet by anchor; equal runs of a block are one
   row before the shuffle, with the shards they stand in. Windows that start at two places or more are confirmed.
   Each distinct passage of them is cut once, from a document of one shard that holds it, and goes once to every
   shard whose documents may hold it: a passage that a third of all documents share is a row a shard, and its
   occurrences are never gathered.
3. Compile. Each shard makes its passages' key phrases (words that all windows of a passage share) an Aho-Corasick
   automaton (pyahocorasick).
4. Locate. Each document is streamed once through the automaton of its shard. At each hit the windows around it are
   compared with the passages, word by word, and covered words go.

Every passage that can occur in a document is in its shard's automaton, so one pass over a document finds all
occurrences, and the work grows with the corpus, not with corpus times passages. Steps 2 and 4 read one exchange of
the documents by shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tapeloom.llm.shared import shuffle_partitions
from tapeloom.llm.textblocks import joined_words, blocks, list_column, rolling, runs, utf8, word_hashes, words

WINDOW = 35
GRAM = 5
#: Counters of the sketch: 2^16 of 8 bytes are what the driver and a task hold, whatever the corpus.
CELL_BITS = 16
#: Bytes of a window's hash that travel beside the 64 bits of its anchor.
SHORT = 6
#: Bytes of text that a task works on at once: hashes and prefix sums take some fifty times as much.
BLOCK = 500_000
#: Words of documents in a shard, on average.
SHARD_WORDS = 1_000_000
#: A key phrase has so many words at most.
KEY_WORDS = 8
#: Windows whose words are compared at once.
COMPARED = 50_000


class Block:
    """Words and windows of a block of texts."""

    def __init__(self, column: pa.Array, window: int):
        self.raw, at = utf8(column)
        self.first, self.end, self.row_first = words(self.raw, at)
        self.hashes = word_hashes(self.raw, self.first, self.end)
        valid = np.maximum(np.diff(self.row_first) - window + 1, 0)  # windows of each row
        self.row = np.repeat(np.arange(len(valid)), valid)
        #: first word of each window, in the block
        self.start = np.arange(len(self.row)) + (self.row_first[:-1] - (np.cumsum(valid) - valid))[self.row]
        self.window = window

    def windows(self) -> np.ndarray:
        """Short hashes of the windows."""
        return rolling(self.hashes, self.start, self.start + self.window) & np.uint64(2 ** (8 * SHORT) - 1)

    def grams(self) -> np.ndarray:
        gram = min(GRAM, self.window)
        at = np.arange(max(len(self.hashes) - gram + 1, 0))
        return rolling(self.hashes, at, at + gram)

    def runs(self, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of windows with one anchor: the anchor, the first window's number, how many windows, whether some may be equal.

        All windows of a run have words in common: where a gram comes again and again, its run is cut.
        """
        if not len(self.start):
            return (np.zeros(0, dtype=np.int64),) * 4
        grams = self.grams()
        order = (level[grams >> np.uint64(64 - CELL_BITS)] << np.uint64(58)) | (grams & np.uint64(2**58 - 1))
        width = self.window - min(GRAM, self.window) + 1
        anchor = _sliding_min(order, width)[self.start]
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (self.row[1:] != self.row[:-1])
        at = np.arange(len(anchor))
        new |= (at - np.maximum.accumulate(np.where(new, at, 0))) % width == 0
        first = np.flatnonzero(new)
        # where a window begins with its anchor and the next one has that anchor too, the gram comes again
        comes_again = order[self.start] == anchor
        comes_again[:-1] &= ~new[1:]
        comes_again[-1] = False
        return anchor[first].view(np.int64), first, np.diff(np.append(first, len(anchor))), np.logical_or.reduceat(comes_again, first)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of x[i : i + width] for every i; shorter at the end."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[:-step] = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:-step]
        have += step
    return out


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only what is needed, under names of our own; _h deals documents out and depends on their content alone."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("_h"))


def _sketch(source: DataFrame, window: int) -> np.ndarray:
    """How often the grams of each cell occur. The driver gets a row a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, dtype=np.int64)
        for whole in batches:
            for part in blocks(whole, limit=BLOCK):
                cells = Block(part.column("text"), window).grams() >> np.uint64(64 - CELL_BITS)
                total += np.bincount(cells.astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    counts = np.zeros(1 << CELL_BITS, dtype=np.int64)
    for r in source.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        counts[r["cell"]] = r["n"]
    return counts


def _runs(source: DataFrame, window: int, level: np.ndarray) -> DataFrame:
    """Runs of windows: g (anchor), n (places in the block, 2 at most, 4 more if it may hold equal windows), shards (where it stands), w (short hashes)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in blocks(whole, limit=BLOCK):
                b = Block(part.column("text"), window)
                anchor, first, length, own = b.runs(level)
                if not len(first):
                    continue
                shard = part.column("shard").to_numpy()[b.row[first]]
                short = np.ascontiguousarray(b.windows().view(np.uint8).reshape(-1, 8)[:, :SHORT]).tobytes()
                same: dict[bytes, int] = {}
                ends = zip((first * SHORT).tolist(), ((first + length) * SHORT).tolist(), anchor.tolist(), strict=True)
                of = np.array([same.setdefault((g, short[x:y]), len(same)) for x, y, g in ends])
                run, place, n = np.unique(of, return_index=True, return_counts=True)
                pair = np.unique(np.stack([of, shard], axis=1), axis=0)
                lists = list_column(np.bincount(pair[:, 0], minlength=len(run)), pa.array(pair[:, 1].astype(np.int32)))
                n = (np.minimum(n, 2) + 4 * own[place]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(anchor[place]), pa.array(n), lists, pa.array([w for _, w in same], pa.binary())], ["g", "n", "shards", "w"])

    return source.select("text", "shard").mapInArrow(emit, "g long, n int, shards array<int>, w binary")


REQUEST = "home int, g long, w_first long, w_last long, n int, shards array<int>"


def _confirm(runs_: DataFrame) -> DataFrame:
    """Confirmed passages: home (a shard that holds one), anchor, first and last window, windows, shards that may hold some of it.

    Each distinct confirmed window of an anchor is in one passage.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            g = batch.column("g").to_numpy()
            if held and held[0].column("g")[0].as_py() == g[-1]:
                held.append(batch)
                continue
            whole = int(np.searchsorted(g, g[-1], side="left"))  # the last anchor may go on
            yield from _confirmed([*held, batch.slice(0, whole)])
            held = [batch.slice(whole)]
        yield from _confirmed(held)

    return runs_.repartition(shuffle_partitions(runs_.sparkSession), "g").sortWithinPartitions("g").mapInArrow(run, REQUEST)


def _confirmed(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The passages of whole anchor groups. Anchors with one place are left out before any window is looked at."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    g = np.concatenate([b.column("g").to_numpy() for b in batches])
    n = np.concatenate([b.column("n").to_numpy() for b in batches])
    group = np.cumsum(np.concatenate(([0], g[1:] != g[:-1])))
    keep = np.bincount(group, weights=n)[group] > 1
    if not keep.any():
        return
    ends = np.cumsum([b.num_rows for b in batches])
    parts = [b.filter(pa.array(keep[e - b.num_rows : e])) for b, e in zip(batches, ends, strict=True)]
    g, group, n = g[keep], group[keep], (n[keep] & 3).astype(np.int64)
    raw, at = utf8(pa.concat_arrays([p.column("w").cast(pa.large_binary()) for p in parts]))
    lists = pa.concat_arrays([p.column("shards").cast(pa.large_list(pa.int32())) for p in parts])
    size = np.diff(at) // SHORT
    row = np.repeat(np.arange(len(size)), size)
    short = np.zeros((len(row), 8), dtype=np.uint8)
    short[:, :SHORT] = raw.reshape(-1, SHORT)
    w = short.view(np.uint64).ravel()
    by = np.lexsort((w, group[row]))
    new = np.ones(len(by), dtype=bool)
    new[1:] = (w[by][1:] != w[by][:-1]) | (group[row[by]][1:] != group[row[by]][:-1])
    head = np.flatnonzero(new)
    distinct = np.empty(len(w), dtype=np.int64)
    distinct[by] = np.cumsum(new) - 1
    again = np.add.reduceat(n[row[by]], head) > 1
    if not again.any():
        return
    places = np.sort(by[head][again])  # its first place: lexsort keeps the order of equal windows
    cut = np.ones(len(places), dtype=bool)
    cut[1:] = (np.diff(places) != 1) | (np.diff(row[places]) != 0)
    piece_of = np.full(len(head), -1, dtype=np.int64)
    piece_of[distinct[places]] = np.cumsum(cut) - 1
    a = places[np.flatnonzero(cut)]
    b = places[np.append(np.flatnonzero(cut)[1:], len(places)) - 1]
    sizes = lists.value_lengths().to_numpy()
    offset = np.cumsum(sizes) - sizes
    shards = lists.flatten().to_numpy()
    piece = piece_of[distinct]
    met = np.unique(np.stack([row, piece], axis=1)[piece >= 0], axis=0)
    each = np.repeat(np.arange(len(met)), sizes[met[:, 0]])
    nth = np.arange(len(each)) - (np.cumsum(sizes[met[:, 0]]) - sizes[met[:, 0]])[each]
    pair = np.unique(np.stack([met[each, 1], shards[offset[met[each, 0]] + nth]], axis=1), axis=0)
    goes = list_column(np.bincount(pair[:, 0], minlength=len(a)), pa.array(pair[:, 1].astype(np.int32)))
    yield pa.RecordBatch.from_arrays(
        [pa.array(shards[offset[row[a]]]), pa.array(g[row[a]]), pa.array(w[a].view(np.int64)), pa.array(w[b].view(np.int64)), pa.array((b - a + 1).astype(np.int32)), goes],
        ["home", "g", "w_first", "w_last", "n", "shards"],
    )


def _cut_passages(docs: pa.Table, wanted: pa.Table, window: int, level: np.ndarray) -> pa.Table:
    """The words of a shard's wanted passages, a row for each shard that they go to: shard, text.

    A passage has fewer windows than a window has words, so its first and last window make up the whole.
    """
    left = {x: wanted.column(x).to_numpy() for x in ("g", "n")} | {x: wanted.column(x).to_numpy().view(np.uint64) for x in ("w_first", "w_last")}
    of = np.arange(wanted.num_rows)
    pieces, found = [], []
    for whole in docs.to_batches():
        for part in blocks(whole, limit=BLOCK):
            if not len(of):
                break
            b = Block(part.column("text"), window)
            anchor, first, length, _ = b.runs(level)
            anchor, w = np.repeat(anchor, length), b.windows()
            by = np.argsort(w, kind="stable")
            lo = np.searchsorted(w[by], left["w_first"][of], side="left")
            k = np.searchsorted(w[by], left["w_first"][of], side="right") - lo
            r = np.repeat(of, k)
            i = by[np.arange(len(r)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(lo, k)]
            last = np.minimum(i + left["n"][r] - 1, len(w) - 1)
            fits = (anchor[i] == left["g"][r]) & (i + left["n"][r] <= len(w)) & (w[last] == left["w_last"][r]) & (b.row[i] == b.row[last])
            r, at = np.unique(r[fits], return_index=True)
            i, last = i[fits][at], last[fits][at]
            data = b.raw.tobytes()
            pieces += [data[x:y] for x, y in zip(b.first[b.start[i]].tolist(), b.end[b.start[last] + window - 1].tolist(), strict=True)]
            found.append(r)
            of = np.setdiff1d(of, r, assume_unique=True)
    if len(of):
        raise ValueError("a confirmed passage isn't in its shard: the documents changed while they were read")
    lists = wanted.column("shards").take(pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *found]))).combine_chunks()
    text = pa.array(pieces, pa.binary()).cast(pa.string())
    lists = lists if isinstance(lists, pa.ListArray) else lists.chunk(0)
    return pa.table({"shard": lists.flatten(), "text": text.take(pa.array(np.repeat(np.arange(len(pieces)), lists.value_lengths().to_numpy())))})


class Automaton:
    """The passages of a shard: an Aho-Corasick automaton of their key phrases, and their words."""

    def __init__(self, passages: pa.Array, window: int):
        import ahocorasick

        raw, at = utf8(passages)
        first, end, row_first = words(raw, at)
        self.window, self.hashes = window, word_hashes(raw, first, end)
        self.vocabulary, code = np.unique(self.hashes, return_inverse=True)
        n = np.diff(row_first) - window + 1
        row = np.repeat(np.arange(len(n)), n)
        start = np.arange(len(row)) + (row_first[:-1] - (np.cumsum(n) - n))[row]
        w = rolling(self.hashes, start, start + window)
        by = np.argsort(w, kind="stable")
        self.windows, self.at = w[by], start[by]
        # the words from the last window's first one to the first window's last one are in all windows of a passage
        head, size = row_first[:-1] + n - 1, np.minimum(window - n + 1, KEY_WORDS)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        stream = _letters(code)
        for a, k in zip(head.tolist(), size.tolist(), strict=True):
            self.machine.add_word(stream[2 * a : 2 * (a + k)], k)
        if len(n):
            self.machine.make_automaton()

    def locate(self, hashes: np.ndarray, row_first: np.ndarray) -> np.ndarray:
        """First words of the windows of the stream that are windows of passages."""
        if not len(self.hashes) or not len(hashes):
            return np.zeros(0, dtype=np.int64)
        code = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        code = np.where(self.vocabulary[code] == hashes, code, len(self.vocabulary))
        hit = np.array(list(self.machine.iter(_letters(code))), dtype=np.int64).reshape(-1, 2)
        last = hit[:, 0] // 2
        row = np.searchsorted(row_first, last, side="right") - 1
        near = np.zeros(len(hashes) + 1, dtype=np.int64)
        lo = np.maximum(last - self.window + 1, row_first[row])
        hi = np.minimum(last - hit[:, 1] + 1, row_first[row + 1] - self.window) + 1
        np.add.at(near, lo[hi > lo], 1)
        np.add.at(near, hi[hi > lo], -1)
        start = np.flatnonzero(np.cumsum(near) > 0)
        w = rolling(hashes, start, start + self.window)
        of = np.minimum(np.searchsorted(self.windows, w), len(self.windows) - 1)
        maybe = self.windows[of] == w
        start, of = start[maybe], self.at[of[maybe]]
        equal = np.ones(len(start), dtype=bool)
        step = np.arange(self.window)
        for i in range(0, len(start), COMPARED):
            s, o = start[i : i + COMPARED, None] + step, of[i : i + COMPARED, None] + step
            equal[i : i + COMPARED] = (hashes[s] == self.hashes[o]).all(axis=1)
        return start[equal]


def _letters(codes: np.ndarray) -> str:
    """Two letters a word, the second from another range, so that nodes have few branches and matches are whole words."""
    pair = np.stack([codes // 256 + 0x10000, codes % 256 + 0x100], axis=1).astype(np.uint32)
    return pair.tobytes().decode("utf-32-le")


def _located(docs: DataFrame, window: int, id_col: str, text_col: str, shard_words: int, each: Callable[[pa.RecordBatch, Automaton], pa.RecordBatch], columns: Callable[[T.StructField], T.StructType]) -> DataFrame:
    """What ``each`` makes of every block of documents and the automaton of its shard."""
    spark = docs.sparkSession
    source = _source(docs, id_col, text_col)
    counts = _sketch(source, window)
    n_shards = max(shuffle_partitions(spark), -(-int(counts.sum()) // shard_words))
    level = np.ceil(np.log2(counts + 1)).astype(np.uint64)
    source = source.withColumn("shard", F.pmod("_h", F.lit(n_shards)).cast("int")).drop("_h")
    wanted = _confirm(_runs(source, window, level))

    def cut(key: tuple, docs: pa.Table, wanted: pa.Table) -> pa.Table:
        return _cut_passages(docs, wanted, window, level)

    def locate(key: tuple, docs: pa.Table, passages: pa.Table) -> pa.Table:
        machine = Automaton(pa.concat_arrays([pa.array([], pa.large_string()), *(x.cast(pa.large_string()) for x in passages.column("text").chunks)]), window)
        return pa.Table.from_batches([each(part, machine) for whole in docs.to_batches() for part in blocks(whole, limit=BLOCK)], target)

    schema = columns(source.schema["doc_id"])
    target = to_arrow_schema(schema)
    by_shard = source.groupBy("shard")
    passages = by_shard.cogroup(wanted.groupBy("home")).applyInArrow(cut, "shard int, text string")
    return by_shard.cogroup(passages.groupBy("shard")).applyInArrow(locate, schema)


def recurring(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """Every document with the runs of words that recurring windows cover.

    Returns doc_id (of the type it has), text, n_words and covered (array of start, end; words from 0, end exclusive,
    disjoint and in order). A window counts as recurring where its word sequence also starts anywhere else in the
    corpus. Null text has no words. Repeated rows are separate documents, so each makes the other's windows recur.
    An empty table gives an empty result; other columns are ignored, whatever their names.
    A task holds a shard's documents and, of a block of text or one longer text, some sixty times its size.
    """
    return _located(docs, window, id_col, text_col, shard_words, _marked, _MARKED)


def remove(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """Every document without the words that recurring windows cover: doc_id, kept (the others, joined by one space), n_words, n_removed.

    What recurs is what ``recurring`` says. A text without words is kept as the empty text.
    """
    return _located(docs, window, id_col, text_col, shard_words, _removed, _REMOVED)


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_MARKED = lambda doc_id: T.StructType([doc_id, T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("covered", T.ArrayType(_SPAN))])
_REMOVED = lambda doc_id: T.StructType([doc_id, T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])


class _Covered:
    """Words of a block and which of them recurring windows cover."""

    def __init__(self, part: pa.RecordBatch, machine: Automaton):
        self.raw, at = utf8(part.column("text"))
        self.first, self.end, self.row_first = words(self.raw, at)
        starts = machine.locate(word_hashes(self.raw, self.first, self.end), self.row_first)
        edge = np.zeros(len(self.first) + 1, dtype=np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + machine.window, -1)
        self.covered = np.cumsum(edge)[:-1] > 0


def _marked(part: pa.RecordBatch, machine: Automaton) -> pa.RecordBatch:
    c = _Covered(part, machine)
    row_first = c.row_first
    a, b = runs(c.covered)
    # a run may go over into the next text: it is cut there
    inner = row_first[1:-1]
    inner = inner[(inner > 0) & (inner < len(c.first))]
    inner = np.unique(inner[c.covered[inner] & c.covered[inner - 1]]) if len(inner) else inner
    a, b = np.sort(np.concatenate((a, inner))), np.sort(np.concatenate((b, inner)))
    of = np.searchsorted(row_first, a, side="right") - 1
    span = [pa.field("start", pa.int32()), pa.field("end", pa.int32())]
    spans = pa.StructArray.from_arrays([pa.array((a - row_first[of]).astype(np.int32)), pa.array((b - row_first[of]).astype(np.int32))], fields=span)
    lists = list_column(np.bincount(of, minlength=part.num_rows), spans)
    return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), pa.array(np.diff(row_first)), lists], ["doc_id", "text", "n_words", "covered"])


def _removed(part: pa.RecordBatch, machine: Automaton) -> pa.RecordBatch:
    c = _Covered(part, machine)
    stay = np.flatnonzero(~c.covered)
    kept_first = np.searchsorted(stay, c.row_first)
    kept = joined_words(c.raw, c.first[stay], c.end[stay], kept_first)
    n_words = np.diff(c.row_first)
    return pa.RecordBatch.from_arrays([part.column("doc_id"), kept, pa.array(n_words), pa.array(n_words - np.diff(kept_first))], ["doc_id", "kept", "n_words", "n_removed"])


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def sha256_of(words_: list[str]) -> str:
    return hashlib.sha256(" ".join(words_).encode()).hexdigest()
