"""Text quality by a factorisation machine over hashed words, structure and metadata.

score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise part is taken in time linear in the
features by the sum-of-squares identity: half the sum over factors of (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.shared import cut
from tapeloom.llm.textblocks import _BYTE, SEPARATOR, blocks, list_column, rolling, utf8, word_hashes, words

#: Words are hashed to so many features; each structure statistic and metadata column has BINS more.
BUCKETS, BINS = 1 << 14, 32
FACTORS = 6
#: The machine learns from about so many labelled rows, thinned by a hash of id and text.
MAX_ROWS = 24_000
#: The rows learned from lie in so many parts, which learn side by side; after each of ROUNDS their models are averaged.
PARTS, ROUNDS, EPOCHS, BATCH = 8, 8, 2, 64
RATE, DECAY = 0.15, 1e-4
#: Numeric columns that serve as metadata where a table has them.
METADATA = ("n_chars",)
#: Texts are worked on in blocks of about so many bytes.
BLOCK = 1_000_000

STATISTICS = (
    "bytes", "words", "word_length", "distinct_words", "same_as_before", "top_word", "upper", "digits", "symbols", "beyond_ascii", "white",
    "lines", "repeated_lines", "line_length", "plain_words", "symbol_ends", "sentence_ends", "words_with_digits", "single_characters", "longest_run", "entropy",
)


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # features
    factors: np.ndarray  # features x FACTORS

    def logits(self, n: np.ndarray, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        """n: entries of each row; index, value: the entries of all rows, in order."""
        return self.bias + _per_row(self.weights[index] * value, n) + _pairs(self.factors, n, index, value)[0]


def _per_row(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums over the entries of each row, each added up in the row's own order."""
    out = np.zeros((len(n), *x.shape[1:]))
    some = np.flatnonzero(n)
    if len(some):
        out[some] = np.add.reduceat(x, (np.cumsum(n) - n)[some], axis=0)
    return out


def _pairs(factors: np.ndarray, n: np.ndarray, index: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairwise part of each row by the sum-of-squares identity, and its sums of v x by factor."""
    held = factors[index] * value[:, None]
    sums = _per_row(held, n)
    return 0.5 * (sums**2 - _per_row(held**2, n)).sum(axis=1), sums


def _log_bin(x: np.ndarray) -> np.ndarray:
    return np.minimum(BINS - 1, np.floor(2 * np.log2(np.maximum(x, 0) + 1))).astype(np.int64)


def _share_bin(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Shares in bins that are finer near zero; what has nothing to share is in a bin of its own."""
    share = np.sqrt(np.clip(x / np.maximum(of, 1), 0, 1))
    return np.where(of > 0, np.minimum(BINS - 2, (share * (BINS - 1)).astype(np.int64)), BINS - 1)


def _table(test) -> np.ndarray:
    return np.array([test(i) for i in range(256)], dtype=np.int64)


_UPPER, _DIGIT = _table(lambda i: 65 <= i <= 90), _table(lambda i: 48 <= i <= 57)
_LETTER = _table(lambda i: 65 <= i <= 90 or 97 <= i <= 122 or i >= 128)
_SYMBOL = _table(lambda i: 33 <= i <= 126 and not chr(i).isalnum())
_END = _table(lambda i: i in b".!?")


def _between(mask: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(mask)))
    return sums[end] - sums[first]


def _grouped(row: np.ndarray, key: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, key and count of each distinct pair, in order."""
    by = np.lexsort((key, row))
    row, key = row[by], key[by]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(new)
    return row[at], key[at], np.diff(np.append(at, len(row)))


def _highest(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros(rows, dtype=np.int64)
    np.maximum.at(out, row, value)
    return out


def features(column: pa.Array, metadata: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the number of its features; of all the features and their values.

    A text's distinct words, lower-cased in ASCII and hashed, share a length of 1 by the logarithm of their counts.
    Each structure statistic and each metadata column, put into bins, is one feature of value 1/2.
    """
    raw, at = utf8(column)
    rows = len(column)
    lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    first, end, row_first = words(raw, at)
    n_words = np.diff(row_first)
    of_word = np.repeat(np.arange(rows), n_words)
    hashes = word_hashes(lower, first, end)
    row, key, count = _grouped(of_word, hashes, rows)

    size, n_bytes = end - first, np.diff(at)
    shares = lambda mask: _between(mask[raw], at[:-1], at[1:])
    in_words = lambda mask: _between(mask[raw], first, end)
    counted = lambda flags: np.bincount(of_word, weights=flags, minlength=rows)
    same = np.zeros(len(first), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    letters = in_words(_LETTER)
    last, before_last = raw[end - 1], raw[np.maximum(end - 2, 0)]
    plain = letters + (_SYMBOL[last] > 0) == size
    # lines: a text has one more than line feeds
    feeds = np.flatnonzero(raw == 10)
    feeds_row = np.searchsorted(at, feeds, side="right") - 1
    line_row = np.concatenate((np.arange(rows), feeds_row))
    line_first = np.concatenate((at[:-1], feeds + 1))
    by = np.lexsort((line_first, line_row))
    line_row, line_first = line_row[by], line_first[by]
    line_end = np.empty_like(line_first)
    line_end[:-1] = line_first[1:] - 1
    line_end[np.flatnonzero(np.diff(line_row, append=rows))] = at[1:]
    line_end = np.maximum(line_end, line_first)
    distinct_lines = np.bincount(_grouped(line_row, rolling(_BYTE[raw], line_first, line_end), rows)[0], minlength=rows)
    n_lines = np.bincount(line_row, minlength=rows)
    # runs of one byte, and the spread of bytes
    edge = np.ones(len(raw), dtype=bool)
    edge[1:] = raw[1:] != raw[:-1]
    edge[at[(at > 0) & (at < len(raw))]] = True
    starts = np.flatnonzero(edge)
    longest = _highest(np.searchsorted(at, starts, side="right") - 1, np.diff(np.append(starts, len(raw))), rows)
    hist_row, _, hist = _grouped(np.repeat(np.arange(rows), n_bytes), raw, rows)
    p = hist / np.maximum(n_bytes, 1)[hist_row]
    entropy = np.bincount(hist_row, weights=-p * np.log2(p), minlength=rows)

    bins = [
        _log_bin(n_bytes), _log_bin(n_words), _log_bin(counted(size) / np.maximum(n_words, 1)), _share_bin(np.bincount(row, minlength=rows), n_words), _share_bin(counted(same), n_words),
        _share_bin(_highest(row, count, rows), n_words), _share_bin(shares(_UPPER), shares(_LETTER)), _share_bin(shares(_DIGIT), n_bytes), _share_bin(shares(_SYMBOL), n_bytes),
        _share_bin(shares(_table(lambda i: i >= 128)), n_bytes), _share_bin(shares(SEPARATOR.astype(np.int64)), n_bytes), _log_bin(n_lines), _share_bin(n_lines - distinct_lines, n_lines),
        _log_bin(n_bytes / n_lines), _share_bin(counted(plain), n_words), _share_bin(counted((size > 1) & (_SYMBOL[last] > 0) & (_SYMBOL[before_last] > 0)), n_words),
        _share_bin(shares(_END), n_words), _share_bin(counted(in_words(_DIGIT) > 0), n_words), _share_bin(counted(size == 1), n_words), _log_bin(longest), np.minimum(BINS - 1, (entropy * 4).astype(np.int64)),
    ]
    for known in metadata:  # null has a bin of its own
        bins.append(np.where(np.isnan(known), BINS - 1, np.minimum(BINS - 2, _log_bin(np.nan_to_num(known)))))
    dense = np.stack(bins, axis=1) + BUCKETS + BINS * np.arange(len(bins))

    bucket, weight = (key % np.uint64(BUCKETS)).astype(np.int64), np.log1p(count)
    norm = np.sqrt(np.bincount(row, weights=weight**2, minlength=rows))
    own = np.bincount(row, minlength=rows)
    n = own + dense.shape[1]
    index, value = np.empty(n.sum(), dtype=np.int64), np.full(n.sum(), 0.5)
    start = np.cumsum(n) - n
    place = np.arange(len(row)) + (start - (np.cumsum(own) - own))[row]
    index[place], value[place] = bucket, weight / norm[row]
    index[(start + own)[:, None] + np.arange(dense.shape[1])] = dense
    return n, index, value


def is_held_out(doc_id: Column) -> Column:
    """Rows that are not learned from: CRC-32 of the id as text, modulo 5, is 0. A null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _metadata(docs: DataFrame) -> list[str]:
    return [c for c in METADATA if c in docs.columns]


def _source(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    known = [F.col(c).cast("double").alias(f"m{i}") for i, c in enumerate(_metadata(docs))]
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *known, *more)


def _of(part: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return features(part.column("text"), [part.column(f"m{i}").to_numpy(zero_copy_only=False).astype(np.float64) for i in range(n)])


def learn(machine: Machine, n: np.ndarray, index: np.ndarray, value: np.ndarray, label: np.ndarray, seen: np.ndarray, epochs: int = EPOCHS) -> None:
    """AdaGrad on the logistic loss, in batches in the rows' order. seen: the squared gradients so far, a row a feature."""
    start = np.cumsum(n) - n
    for _ in range(epochs):
        for a in range(0, len(n), BATCH):
            rows = slice(a, a + BATCH)
            entries = slice(start[a], start[a] + n[rows].sum())
            i, x, k = index[entries], value[entries], n[rows]
            pairs, sums = _pairs(machine.factors, k, i, x)
            off = 1 / (1 + np.exp(-(machine.bias + _per_row(machine.weights[i] * x, k) + pairs))) - label[rows]
            of_entry = np.repeat(np.arange(len(k)), k)
            by_entry = (off[of_entry] * x)[:, None]
            part = np.concatenate((by_entry, by_entry * (sums[of_entry] - machine.factors[i] * x[:, None])), axis=1)
            touched, at = np.unique(i, return_inverse=True)
            grad = np.stack([np.bincount(at, weights=part[:, f], minlength=len(touched)) for f in range(part.shape[1])], axis=1) / len(k)
            grad[:, 0] += DECAY * machine.weights[touched]
            grad[:, 1:] += DECAY * machine.factors[touched]
            seen[touched] += grad**2
            step = RATE * grad / np.sqrt(seen[touched] + 1e-8)
            machine.weights[touched] -= step[:, 0]
            machine.factors[touched] -= step[:, 1:]
            machine.bias -= RATE * off.mean()


def _trainer(shared, epochs: int):
    """One part's round: learns on from the shared machine and gives its own, packed."""

    def train(rows: pa.Table) -> pa.Table:
        began, seen = shared.value
        rows = rows.sort_by([("at", "ascending")]).combine_chunks()
        own, seen = Machine(began.bias, began.weights.copy(), began.factors.copy()), seen.copy()
        index, value = (rows.column(c).combine_chunks() for c in ("index", "value"))
        n = index.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        learn(own, n, index.flatten().to_numpy(zero_copy_only=False).astype(np.int64), value.flatten().to_numpy(zero_copy_only=False), rows.column("label").to_numpy(), seen, epochs)
        packed = np.concatenate(([own.bias], own.weights, own.factors.ravel(), seen.ravel())).astype(np.float32).tobytes()
        return pa.table({"part": rows.column("part")[:1], "n": pa.array([len(n)]), "machine": pa.array([packed], pa.binary())})

    return train


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Machine | None:
    """A machine learned from documents with a label (the mean, where an id has several); None where there is none.

    At most about ``max_rows`` labelled ids, then rows, are kept, by hash; a row's whole text counts. The rows'
    features lie in PARTS parts by a hash of the text, in an order by hash; in each round every part learns from the
    averaged machine on, and what comes to the driver is PARTS machines, whose size is fixed. Reruns agree.
    """
    spark = docs.sparkSession
    kept = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.avg(label_col).alias("label"))
    n_ids = kept.count()
    if not n_ids:
        return None
    draw = lambda *c: F.pmod(F.xxhash64(*c, F.lit("quality")), F.lit(1_000_000)) / 1_000_000
    few = kept.where(draw(F.col("_id").cast("string")) < max_rows / n_ids)
    # about max_rows ids and numbers: the broadcast is bounded by the parameter
    met = docs.join(F.broadcast(few), F.col(id_col) == F.col("_id"))
    n_rows = met.count()
    if not n_rows:
        return None
    sample = _source(met, id_col, text_col, F.col("label")).where(draw(F.col("doc_id").cast("string"), "text") < max_rows / n_rows)
    n_meta = len(_metadata(docs))
    width = BUCKETS + BINS * (len(STATISTICS) + n_meta)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in blocks(whole, limit=BLOCK):
                n, index, value = _of(part, n_meta)
                yield pa.RecordBatch.from_arrays([part.column("part"), part.column("at"), part.column("label"), list_column(n, pa.array(index.astype(np.int32))), list_column(n, pa.array(value))], ["part", "at", "label", "index", "value"])

    hashed = F.xxhash64("text", F.col("doc_id").cast("string"))
    placed = sample.withColumn("at", hashed).withColumn("part", F.pmod("at", F.lit(PARTS)).cast("int"))
    table = cut(placed.mapInArrow(extract, "part int, at long, label double, index array<int>, value array<double>"))

    rng = np.random.default_rng(11)
    mean = float(np.clip(table.agg(F.avg("label")).first()[0] or 0.5, 0.01, 0.99))
    machine = Machine(np.log(mean / (1 - mean)), np.zeros(width), rng.normal(scale=0.05, size=(width, FACTORS)))
    seen = np.zeros((width, FACTORS + 1))
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast((machine, seen))

        got = sorted(table.groupBy("part").applyInArrow(_trainer(shared, EPOCHS), "part int, n long, machine binary").collect())
        total = sum(r["n"] for r in got)
        mixed = sum(np.frombuffer(r["machine"], dtype=np.float32).astype(np.float64) * (r["n"] / total) for r in got)
        weights, factors, seen = np.split(mixed[1:], [width, width * (FACTORS + 1)])
        machine, seen = Machine(float(mixed[0]), weights, factors.reshape(width, FACTORS)), seen.reshape(width, FACTORS + 1)
        shared.destroy()
    return machine


def score(docs: DataFrame, machine: Machine | None, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (how likely the label is 1, 0 to 1) and predicted (1 from ``threshold`` on) of every row.

    The whole text counts; null counts as empty, which has structure but no words. Without a machine every score is
    one half. Equal texts with equal metadata have equal scores. Null ids and repeated rows stay; further columns are
    left out.
    """
    source = _source(docs, id_col, text_col)
    n_meta = len(_metadata(docs))
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for whole in batches:
            for part in blocks(whole, limit=BLOCK):
                if own is None:
                    found = np.full(part.num_rows, 0.5)
                else:
                    found = 1 / (1 + np.exp(-np.clip(own.logits(*_of(part, n_meta)), -500, 500)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    scored = source.mapInArrow(run, T.StructType([source.schema["doc_id"], T.StructField("score", T.DoubleType())]))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a machine learned from the labels of those that aren't held out."""
    return score(docs, fit(docs.where(~is_held_out(F.col("doc_id"))), labels))
