"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit distance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tapeloom.llm.shared import cut
from tapeloom.llm.textblocks import blocks, code_points, letters, lowered, mix, rolling, runs

#: A window matches an item from this similarity on: 1 - edits / words of the item.
SIMILARITY = 0.8
#: Random walks that embed a text, and repetitions of the LSH over each: a window matches one of them or goes.
WALKS, REPETITIONS = 8, 12
#: Coordinates of an embedding that one repetition samples.
SAMPLED = 3
#: One pass over the documents takes so many items, or fewer with so many words.
ITEMS_PER_PASS, WORDS_PER_PASS = 20_000, 1_000_000
#: Cells of embeddings that a task holds at once.
CELLS = 2_000_000
#: Windows are placed in parts of about so many.
PLACED = 500_000


def normal_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters and digits, in lower case) of all texts; of each text its first word's number."""
    points, starts = code_points(texts)
    own = lowered()[points]
    digits = (points >= 48) & (points <= 57)
    first, end = runs(letters()[points] | digits)
    return rolling(mix(own.astype(np.uint64) + np.uint64(1)), first, end), np.searchsorted(first, np.append(starts, len(points)), side="left")


def embed(symbols: np.ndarray, first: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray, walk: int = 0) -> np.ndarray:
    """CGK random walks over windows symbols[first:first+n]; what lies outside [low, high) is padding.

    Step j writes the symbol under the pointer; a bit drawn from walk, j and the symbol says whether it moves on.
    Walks over texts a few edits apart mostly meet again soon, so their embeddings differ in few places. A walk is at
    its window's end after some 2 n steps; what follows would agree for any two texts and is left out.
    """
    steps = 2 * int(n.max(initial=0))
    out = np.zeros((len(first), steps), dtype=np.uint64)
    at = np.zeros(len(first), dtype=np.int64)
    for j in range(steps):
        place = first + at
        ok = (at < n) & (place >= low) & (place < high)
        symbol = np.where(ok, symbols[np.clip(place, 0, len(symbols) - 1)], np.uint64(0))
        out[:, j] = symbol
        draw = np.uint64(((j + 1) * 0x9E3779B97F4A7C15 + walk * 0xD1342543DE82EF95) & (2**64 - 1))
        at += (mix(symbol + draw) & np.uint64(1)).astype(np.int64)
    return out


def sample(symbols: np.ndarray, first: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray, walk: int, places: np.ndarray) -> np.ndarray:
    """The embeddings' values at ``places`` (shares of 2 n): windows x repetitions x SAMPLED, 32 bits each. All n are of like size."""
    own = embed(symbols, first, n, low, high, walk)
    at = (places[None] * (2 * n)[:, None, None]).astype(np.int64)
    return (own[np.arange(len(n))[:, None, None], at] >> np.uint64(32)).astype(np.uint32)


def chunks(n: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of windows of like length (within a factor of two), as many as CELLS has room for, in order within a length."""
    size = np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)
    for s in np.unique(size):
        own = np.flatnonzero(size == s)
        step = max(1, CELLS // (2 << int(s)))
        for at in range(0, len(own), step):
            yield own[at : at + step]


def distinct(found: np.ndarray) -> np.ndarray:
    """Distinct columns (row, item, start), in order; starts lie within a block of text, so one number holds all three."""
    if not found.shape[1]:
        return found
    items, low = int(found[1].max()) + 1, int(found[2].min())
    places = int(found[2].max()) - low + 1
    key = np.unique((found[0] * items + found[1]) * places + found[2] - low)
    pair, start = np.divmod(key, places)
    return np.stack([*np.divmod(pair, items), start + low])


def edit_distance(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Least edits that turn the item into some stretch of the window, and that stretch."""
    m = len(window)
    cost, start, steps = np.zeros(m + 1, dtype=np.int64), np.arange(m + 1), np.arange(m + 1)
    for x in item:
        swap = cost[:-1] + (window != x)
        new = cost + 1
        from_ = start.copy()
        better = swap < new[1:]
        new[1:][better] = swap[better]
        from_[1:][better] = start[:-1][better]
        # insertions run along the row: the least of cost - place so far
        slope = new - steps
        least = np.minimum.accumulate(slope)
        came = np.maximum.accumulate(np.where(slope == least, steps, 0))
        cost, start = least + steps, from_[came]
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), end


class Items:
    """The benchmark: words, sampled coordinates of the embeddings, and the seeds that any match must hold.

    An item of n words matched with d edits has one of d + 1 equal stretches intact, so a document without any
    of its n // (d + 1) word sequences can't match: such sequences place the windows.
    """

    def __init__(self, ids: list[int | None], texts: list[str], similarity: float = SIMILARITY, seed: int = 7):
        symbols, first = normal_words(texts)
        n = np.diff(first)
        kept = np.flatnonzero(n)
        self.ids = [ids[i] for i in kept]
        self.symbols, self.first, self.n = symbols, first[:-1][kept], n[kept]
        self.edits = np.floor((1 - similarity) * self.n + 1e-9).astype(np.int64)
        self.places = np.random.default_rng(seed).random((WALKS, REPETITIONS, SAMPLED))
        self.values = np.zeros((len(kept), WALKS, REPETITIONS, SAMPLED), dtype=np.uint32)
        for k in chunks(self.n):
            for w in range(WALKS):
                self.values[k, w] = sample(symbols, self.first[k], self.n[k], self.first[k], self.first[k] + self.n[k], w, self.places[w])
        size = np.clip(self.n // (self.edits + 1), 1, 4)
        self.seeds = {}
        for q in np.unique(size):
            of = np.concatenate([np.full(self.n[i] - q + 1, i) for i in np.flatnonzero(size == q)])
            off = np.concatenate([np.arange(self.n[i] - q + 1) for i in np.flatnonzero(size == q)])
            h = rolling(symbols, self.first[of] + off, self.first[of] + off + q)
            by = np.argsort(h, kind="stable")
            quick = np.zeros(1 << 20, dtype=bool)
            quick[(h >> np.uint64(44)).astype(np.int64)] = True
            self.seeds[int(q)] = (h[by], of[by], off[by], quick)

    def candidates(self, symbols: np.ndarray, row_first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row, item and window start of all windows that a seed places, in parts of about PLACED windows, each without repeats.

        A seed that stands often in text and items places a window for each pair of places; a part holds PLACED of
        them, or those of one place in the text, before repeats go.
        """
        for q, (h, of, off, quick) in self.seeds.items():
            if len(symbols) < q:
                continue
            start = np.arange(len(symbols) - q + 1)
            own = rolling(symbols, start, start + q)
            start = start[quick[(own >> np.uint64(44)).astype(np.int64)]]
            row = np.searchsorted(row_first, start, side="right") - 1
            inside = start + q <= row_first[row + 1]
            start, row = start[inside], row[inside]
            a, b = np.searchsorted(h, own[start], side="left"), np.searchsorted(h, own[start], side="right")
            until = np.cumsum(b - a)
            at = 0
            while at < len(start):
                end = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + PLACED, side="right")))
                k = (b - a)[at:end]
                entry = np.repeat(a[at:end] - (np.cumsum(k) - k), k) + np.arange(k.sum())
                found = np.stack([np.repeat(row[at:end], k), of[entry], np.repeat(start[at:end], k) - off[entry]])
                if found.shape[1]:
                    yield tuple(distinct(found))
                at = end

    def near(self, symbols: np.ndarray, row_first: np.ndarray, rows: np.ndarray, items: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which windows agree with their item on all coordinates of some repetition of some walk.

        Windows of an item with the same words are embedded once, so repeated text costs no more than its distinct windows.
        """
        low, high = row_first[rows], row_first[rows + 1]
        inside = np.maximum(starts, low), np.minimum(starts + self.n[items], high)
        same = np.stack([items, starts - inside[0], inside[1] - inside[0], rolling(symbols, *inside).view(np.int64)])
        by = np.lexsort(same)
        new = np.ones(len(by), dtype=bool)
        new[1:] = (same[:, by[1:]] != same[:, by[:-1]]).any(axis=0)
        own, of = by[new], np.empty(len(by), dtype=np.int64)
        of[by] = np.cumsum(new) - 1
        out = np.zeros(len(own), dtype=bool)
        for k in chunks(self.n[items[own]]):
            for w in range(WALKS):
                left = k[~out[k]]
                at = own[left]
                item = items[at]
                values = sample(symbols, starts[at], self.n[item], low[at], high[at], w, self.places[w])
                out[left] = (values == self.values[item, w]).all(axis=2).any(axis=1)
        return out[of]

    def match(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(row, item's number, first word, end word, edits): the best window of each item in each text, words from 0."""
        if not self.ids or not texts:
            return []
        symbols, row_first = normal_words(texts)
        passed = [np.zeros((3, 0), dtype=np.int64)]
        for rows, items, starts in self.candidates(symbols, row_first):
            near = self.near(symbols, row_first, rows, items, starts)
            passed.append(np.stack([rows[near], items[near], starts[near]]))
        rows, items, starts = distinct(np.concatenate(passed, axis=1))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        last: dict[int, tuple[bytes, tuple[int, int, int]]] = {}  # of each item the window verified last, and its answer
        for r, i, s in zip(rows.tolist(), items.tolist(), starts.tolist(), strict=True):
            d, n = int(self.edits[i]), int(self.n[i])
            if (r, i) in done and s - done[r, i] <= d:
                continue  # the last window verified reaches so far
            done[r, i] = s
            a, b = max(int(row_first[r]), s - 2 * d), min(int(row_first[r + 1]), s + n + 2 * d)
            words = symbols[a:b].tobytes()
            if i not in last or last[i][0] != words:
                last[i] = words, edit_distance(self.symbols[self.first[i] : self.first[i] + n], symbols[a:b])
            cost, x, y = last[i][1]
            if cost <= d:
                offer = (cost, a + x - int(row_first[r]), a + y - int(row_first[r]))
                best[r, i] = min(best.get((r, i), offer), offer)
        return [(r, i, x, y, cost) for (r, i), (cost, x, y) in sorted(best.items())]


def _passes(benchmark: DataFrame, item_col: str, item_text: str, similarity: float) -> Iterator[Items]:
    """The stated query set, items without an id too, a block of items at a time."""
    rows = benchmark.select(F.col(item_col).alias("i"), F.col(item_text).alias("t")).where("t is not null").orderBy("i", "t").toLocalIterator()
    block: list = []
    held = 0
    for r in rows:
        block.append(r)
        held += r["t"].count(" ") + 1
        if len(block) == ITEMS_PER_PASS or held >= WORDS_PER_PASS:
            yield Items([x["i"] for x in block], [x["t"] for x in block], similarity)
            block, held = [], 0
    if block:
        yield Items([x["i"] for x in block], [x["t"] for x in block], similarity)


def search(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Every benchmark item in every document, by word edit distance.

    Returns doc_id, item_id, word_start, word_end (words from 0, end exclusive; words are runs of letters and
    digits, case ignored), edits and similarity: the window with the fewest edits, the first of equals. Null
    and wordless texts and items match nothing. Items of null id are left out, as a match can't name them
    (``decontaminate`` keeps them). Items of one id are items of their own, each with a row for its own match. Rows
    of repeated documents repeat. Ids may be of any type. No shuffle: items go to the documents in blocks, of which
    each is one more scan of the documents.

    At the largest number of edits an item is missed with a probability below 1 % (300 random edits each: none of 10 and
    20 words, 0.7 % of 50, 0.3 % of 100), and less often with fewer edits; of unrelated windows 10 % (10 words), 4 % (20)
    or none in 300 (50 and 100) go on to the exact edit distance. A task holds a block of text or one longer text, some sixty times its size.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    item_type = benchmark.schema[item_col].dataType
    kinds = [source.schema["doc_id"].dataType, item_type, T.IntegerType(), T.IntegerType(), T.IntegerType(), T.DoubleType()]
    names = ["doc_id", "item_id", "word_start", "word_end", "edits", "similarity"]
    schema = T.StructType([T.StructField(x, k) for x, k in zip(names, kinds, strict=True)])
    arrow_item = to_arrow_type(item_type)
    out = None
    for items in _passes(benchmark.where(F.col(item_col).isNotNull()), item_col, item_text, similarity):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, sizes = shared.value.ids, shared.value.n.tolist()
            for whole in batches:
                for part in blocks(whole):
                    hits = shared.value.match(part.column("text").to_pylist())
                    if hits:
                        row, item, a, b, cost = map(list, zip(*hits, strict=True))
                        likeness = [1 - c / sizes[i] for c, i in zip(cost, item, strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [part.column("doc_id").take(pa.array(row)), pa.array([ids[i] for i in item], arrow_item), *(pa.array(x, pa.int32()) for x in (a, b, cost)), pa.array(likeness)],
                            names,
                        )

        found = source.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents, with all their columns, in which no item is found, items of null id and of equal ids included.

    Matches as in ``search``. Documents of null or wordless text stay, equal rows stay or go together, columns may
    have any names, and an empty table or benchmark leaves all as it is.
    """
    spark = docs.sparkSession
    passes = [spark.sparkContext.broadcast(items) for items in _passes(benchmark, item_col, item_text, similarity)]

    def found(part: pa.RecordBatch, items: Items) -> np.ndarray:
        hit = np.zeros(part.num_rows, dtype=bool)
        hit[[h[0] for h in items.match([t or "" for t in part.column(text_col).to_pylist()])]] = True
        return hit

    def keep(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for part in blocks(whole, text_col):
                    yield part.filter(pa.array(~found(part, shared.value)))

        return run

    def leaking(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for part in blocks(whole, text_col):
                    yield pa.RecordBatch.from_arrays([part.column(text_col).filter(pa.array(found(part, shared.value)))], [text_col])

        return run

    if len(passes) <= 1:
        return docs.mapInArrow(keep(passes[0]), docs.schema) if passes else docs
    # each pass is a scan of its own, so that a task never holds more than one pass; texts go as 256-bit hashes
    hashed = lambda c: F.sha2(F.coalesce(F.col(c), F.lit("")), 256)
    texts = docs.select(text_col)
    leaks = reduce(DataFrame.unionByName, [texts.mapInArrow(leaking(p), texts.schema) for p in passes]).select(hashed(text_col).alias("_leak")).distinct()
    return docs.join(cut(leaks), hashed(text_col) == F.col("_leak"), "left_anti")
