"""Language identification: scripts narrow the languages, Viterbi over word scores labels spans."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.shared import cut
from tapeloom.llm.textblocks import blocks, code_points, letters, list_column, lowered, runs

#: Letter trigrams are hashed to so many buckets.
BUCKETS = 1 << 16
#: What a change of language between two words costs, in natural-log units.
SWITCH = 12.0
#: Documents of more words are labelled in pieces of so many.
PIECE = 2048
#: The classifier learns from about so many rows of each language.
MAX_ROWS_PER_LANG = 4000
#: A script counts as one of a language's from this share of its letters on.
SCRIPT_SHARE = 0.01
#: A text is in a language if its mean log score a letter lies within so many standard deviations of the labelled rows'.
#: Short clean texts with keys, addresses or a licence line in them go to about 7, foreign ones of 50 letters and more begin at about 10.
SPREAD = 8.0
#: Labelled texts are scored in blocks of about so many characters: their trigrams are sorted, which takes many times that in memory.
SCORED_CHARS = 300_000

#: First code points of Unicode blocks and the script that starts there; script 0 is Latin and what isn't listed.
SCRIPT_STARTS = (
    (0x0000, 0), (0x0370, 1), (0x0400, 2), (0x0530, 3), (0x0590, 4), (0x0600, 5), (0x0700, 0), (0x0900, 6), (0x0980, 7),
    (0x0A00, 0), (0x0B80, 8), (0x0C00, 0), (0x0E00, 9), (0x0E80, 0), (0x10A0, 10), (0x1100, 11), (0x1200, 12), (0x13A0, 0),
    (0x1F00, 1), (0x2000, 0), (0x3040, 13), (0x3100, 14), (0xA000, 0), (0xAC00, 11), (0xD7B0, 0), (0xF900, 14), (0xFB00, 0), (0x20000, 14), (0x30000, 0),
)
SCRIPTS = 15


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # BUCKETS x languages, log probabilities
    scripts: np.ndarray  # SCRIPTS x languages, whether the language is written in it
    own: np.ndarray | None = None  # 3 x languages, of labelled texts: mean log score a letter, its variance, and that of a letter within a text


def _features(texts: list[str]) -> tuple[np.ndarray, ...]:
    """Of all letters: hashed trigram and script. Of all words: first letter's place among letters, start, end, text."""
    points, starts = code_points(texts)
    alpha = letters()[points]
    first, end = runs(alpha)
    own = np.where(alpha, lowered()[points], 0).astype(np.uint32)
    before, after = np.empty_like(own), np.empty_like(own)
    before[0], before[1:] = 0, own[:-1]
    after[-1], after[:-1] = 0, own[1:]
    mixed = (before * np.uint32(0x9E3779B1)) ^ (own * np.uint32(0x85EBCA6B)) ^ (after * np.uint32(0xC2B2AE35))
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    hashed = (mixed >> np.uint32(16))[alpha]
    edges, kinds = zip(*SCRIPT_STARTS, strict=True)
    script = np.array(kinds, dtype=np.uint8)[np.searchsorted(np.array(edges), points[first], side="right") - 1]
    return hashed, script, np.cumsum(end - first) - (end - first), first, end, np.searchsorted(starts, first, side="right") - 1, starts


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", max_rows: int = MAX_ROWS_PER_LANG, bounded: bool = True) -> Model:
    """Trigram and script counts for each language and, if ``bounded``, how well its own texts fit.

    Languages with more than ``max_rows`` rows are thinned by a hash of the id to about that many; whole texts
    count. What reaches the driver is the model: one number for each bucket and language. Null texts and null
    languages are skipped; without any labelled row the model has no language.
    """
    rows = labelled.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row for each language
    langs = sorted(counts)
    at = {x: i for i, x in enumerate(langs)}
    shares = F.lit(1.0)
    for lang, n in counts.items():
        if n > max_rows:
            shares = F.when(F.col("lang") == lang, max_rows / n).otherwise(shares)
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("langid")), F.lit(1_000_000)) / 1_000_000
    sample = rows.where(draw < shares).select("text", "lang")
    if bounded and langs:
        sample = cut(sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = np.zeros((len(langs), BUCKETS), dtype=np.int64)
        written = np.zeros((len(langs), SCRIPTS), dtype=np.int64)
        for whole in batches:
            for part in blocks(whole):
                own = np.array([at[x] for x in part.column("lang").to_pylist()])
                hashed, script, _, first, end, doc, _ = _features(part.column("text").to_pylist())
                of_word = own[doc]
                of_letter = np.repeat(of_word, end - first)
                grams += np.bincount(of_letter * BUCKETS + hashed, minlength=grams.size).reshape(grams.shape)
                written += np.bincount(of_word * SCRIPTS + script, weights=end - first, minlength=written.size).astype(np.int64).reshape(written.shape)
        both = np.concatenate([grams, written], axis=1)
        i, j = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(both[i, j])], ["lang", "feature", "n"])

    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((SCRIPTS, 0), bool))
    table = sample.mapInArrow(count, "lang int, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    both = np.zeros((len(langs), BUCKETS + SCRIPTS))
    both[table["lang"], table["feature"]] = table["n"]
    grams, written = both[:, :BUCKETS], both[:, BUCKETS:]
    weights = np.log((grams + 0.5) / (grams.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    scripts = written >= SCRIPT_SHARE * np.maximum(1, written.sum(axis=1, keepdims=True))
    model = Model(langs, np.ascontiguousarray(weights.T.astype(np.float32)), scripts.T & (written.T > 0))
    if bounded:
        model.own = _own_scores(sample, model, grams)
    return model


def _own_scores(sample: DataFrame, model: Model, grams: np.ndarray) -> np.ndarray:
    """How the labelled texts score in their own language; see ``Model.own``.

    A text's own trigrams are taken out of the counts before it is scored, so it scores as one that wasn't learned
    from. Equal texts count once, and only words in the language's scripts. One row for each language comes back.
    """
    at = {x: i for i, x in enumerate(model.langs)}
    shared = sample.sparkSession.sparkContext.broadcast((grams, grams.sum(axis=1), model.scripts))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums, scripts = shared.value
        for whole in batches:
            for part in blocks(whole, limit=SCORED_CHARS):
                own = np.array([at[x] for x in part.column("lang").to_pylist()])
                hashed, script, start, first, end, doc, _ = _features(part.column("text").to_pylist())
                if not len(first):
                    continue
                of_letter = np.repeat(doc, end - first)
                pair, which, k = np.unique(of_letter * BUCKETS + hashed, return_inverse=True, return_counts=True)
                of, gram = pair // BUCKETS, pair % BUCKETS
                all_ = np.bincount(of_letter, minlength=len(own))
                value = np.log((grams[own[of], gram] - k + 0.5) / (sums[own[of]] - all_[of] + 0.5 * BUCKETS))[which]
                word = np.add.reduceat(value, start)
                fits = scripts[script, own[doc]]
                word, size, doc = word[fits], (end - first)[fits], doc[fits]
                n = np.bincount(doc, weights=size, minlength=len(own))
                mean = np.bincount(doc, weights=word, minlength=len(own)) / np.maximum(n, 1)
                spread = np.bincount(doc, weights=(word - mean[doc] * size) ** 2, minlength=len(own))
                has = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(own[has].astype(np.int32)), *(pa.array(x[has]) for x in (n, mean, spread))], ["lang", "n", "mean", "spread"])

    found = sample.dropDuplicates(["text", "lang"]).mapInArrow(score, "lang int, n double, mean double, spread double")
    table = found.groupBy("lang").agg(F.avg("mean").alias("m"), F.var_pop("mean").alias("v"), (F.sum("spread") / F.sum("n")).alias("w")).toPandas()
    out = np.zeros((3, len(model.langs)))
    out[:, table["lang"]] = table[["m", "v", "w"]].to_numpy().T
    return out


def viterbi(scores: np.ndarray, first: np.ndarray, n: np.ndarray, switch: float = SWITCH, piece: int = PIECE) -> np.ndarray:
    """The best label of every word. scores: words x languages; first, n: of each document, its words.

    All documents take a step at once, so a step costs the documents that still run. A document of more than ``piece``
    words is cut into pieces, which go along with the others: best paths through a piece from each label are found
    first, then chained, which gives every piece the values it starts from. The result is that of one walk.
    """
    k = scores.shape[1]
    labels = np.zeros(len(scores), dtype=np.uint8 if k < 256 else np.int32)
    first, n = first[n > 0], n[n > 0]
    if not len(n) or not k:
        return labels
    own = np.arange(k, dtype=labels.dtype)
    back = np.zeros(scores.shape, dtype=labels.dtype)
    count = -(-n // piece)
    of = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(of)) - (np.cumsum(count) - count)[of]
    at = first[of] + nth * piece
    size = np.minimum(piece, n[of] - nth * piece)
    last = nth == count[of] - 1
    start = np.zeros((len(of), k))
    inner = np.flatnonzero(~last)
    if len(inner):
        from_each = np.where(np.eye(k, dtype=bool), 0.0, -np.inf)
        through = np.zeros((len(of), k, k))
        through[inner] = _walk(np.tile(from_each, (len(inner), 1)), scores, np.repeat(at[inner], k), np.repeat(size[inner], k), switch).reshape(-1, k, k)
        for p in inner.tolist():
            start[p + 1] = (start[p][:, None] + through[p]).max(axis=0)
    end = _walk(start, scores, at, size, switch, back)
    state = end.argmax(axis=1).astype(labels.dtype)
    if len(inner):
        # the label that each label at the end of a piece came from, ahead of the piece
        later = np.flatnonzero(nth > 0)
        came = np.zeros((len(of), k), dtype=labels.dtype)
        came[later] = _trace(np.tile(own, len(later)), back, np.repeat(at[later], k), np.repeat(size[later], k)).reshape(-1, k)
        for p in inner[::-1].tolist():
            state[p] = came[p + 1][state[p + 1]]
    _trace(state, back, at, size, labels)
    return labels


def _running(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by length, the longest first; how many of them have more than t words, for each t."""
    by = np.argsort(-n, kind="stable")
    return by, np.searchsorted(-n[by], -np.arange(int(n.max(initial=0))), side="left")


def _walk(value: np.ndarray, scores: np.ndarray, first: np.ndarray, n: np.ndarray, switch: float, back: np.ndarray | None = None) -> np.ndarray:
    """Values of the best paths at the ends of the stretches, from those at their starts; back gets each word's label before."""
    by, running = _running(n)
    first, value = first[by], value[by].copy()
    for t, k in enumerate(running):
        v = value[:k]
        best = v.max(axis=1) - switch
        if back is not None:
            back[first[:k] + t] = np.where(v >= best[:, None], np.arange(v.shape[1], dtype=back.dtype), v.argmax(axis=1).astype(back.dtype)[:, None])
        value[:k] = np.maximum(v, best[:, None]) + scores[first[:k] + t]
    out = np.empty_like(value)
    out[by] = value
    return out


def _trace(state: np.ndarray, back: np.ndarray, first: np.ndarray, n: np.ndarray, labels: np.ndarray | None = None) -> np.ndarray:
    """Labels before the stretches, from those at their ends; labels gets those of all words."""
    by, running = _running(n)
    first, state = first[by], state[by].copy()
    for t in range(len(running) - 1, -1, -1):
        k = running[t]
        at, s = first[:k] + t, state[:k]
        if labels is not None:
            labels[at] = s
        state[:k] = back[at, s]
    out = np.empty_like(state)
    out[by] = state
    return out


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """Language of every document and of its spans.

    Returns doc_id, lang_pred (the language of most letters; ``und`` where the text is null or has no letter),
    score (its share of the letters, 0 for ``und``) and spans (array of start, end, lang; code points from 0, end
    exclusive; from the first word of a run of words in one language to its last). A word is a run of letters.
    Ties go to the language that sorts first. A text takes some sixty times its size of memory in its task. Every word gets the best of the model's languages, also where none
    fits; ``select_languages`` judges that. One row for each row; other columns are ignored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # buckets x languages, whatever the corpus
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())])
    kinds = [docs.schema[id_col].dataType, T.StringType(), T.DoubleType(), T.ArrayType(span)]
    schema = T.StructType([T.StructField(x, k) for x, k in zip(NAMES, kinds, strict=True)])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in blocks(whole):
                found = _label([t or "" for t in part.column("text").to_pylist()], shared.value, switch)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *found], NAMES)

    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(label, schema)


def select_languages(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5, switch: float = SWITCH, spread: float = SPREAD) -> DataFrame:
    """The documents, with all their columns, that are mainly in one language of the model's.

    Words in a script that no language of the model's is written in are in no language. Left out are documents
    without letters, those of whose letters no language has a share of ``least``, and those of which the words in
    the main language score worse a letter than its labelled texts do, by more than ``spread`` standard deviations
    for a text of that many letters. A model without ``own`` sets no such bound. Null and empty texts go, equal rows
    stay or go together, columns may have any names, and an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in blocks(whole, text_col):
                yield part.filter(pa.array(_in_language([t or "" for t in part.column(text_col).to_pylist()], shared.value, least, switch, spread)))

    return docs.mapInArrow(run, docs.schema)


def _labelled_words(features: tuple[np.ndarray, ...], rows: int, m: Model, switch: float) -> tuple[np.ndarray, ...]:
    """Of all words (one at least): text, first letter, end, label, log score under it, whether in a script of some language; starts of the texts."""
    hashed, script, at, first, end, doc, starts = features
    scores = np.add.reduceat(m.weights[hashed], at, axis=0)
    allowed = m.scripts[script]
    known = allowed.any(axis=1)
    allowed |= ~known[:, None]
    free = scores.copy()
    scores[~allowed] -= 1e6
    n = np.bincount(doc, minlength=rows)
    labels = viterbi(scores, np.cumsum(n) - n, n, switch).astype(np.int64)
    return doc, first, end, labels, free[np.arange(len(labels)), labels], known, starts


def _in_language(texts: list[str], m: Model, least: float, switch: float, spread: float) -> np.ndarray:
    """Whether each text is in a language; see ``select_languages``."""
    rows, features = len(texts), _features(texts)
    if not m.langs or not len(features[3]):
        return np.zeros(rows, dtype=bool)
    doc, first, end, labels, score, known, _ = _labelled_words(features, rows, m, switch)
    size = (end - first).astype(np.float64)
    sums = lambda x: np.bincount((doc * len(m.langs) + labels)[known], weights=x[known], minlength=rows * len(m.langs)).reshape(rows, -1)
    shares, total = sums(size), np.bincount(doc, weights=size, minlength=rows)
    main = shares.argmax(axis=1)
    n = shares[np.arange(rows), main]
    keep = (n > 0) & (n >= least * total)
    if m.own is not None:
        mean, of_text, of_letter = m.own[:, main]
        keep &= sums(score.astype(np.float64))[np.arange(rows), main] >= n * (mean - spread * np.sqrt(of_text + of_letter / np.maximum(n, 1)))
    return keep


def _label(texts: list[str], m: Model, switch: float) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Language, score and spans of each text."""
    rows, features = len(texts), _features(texts)
    if not m.langs or not len(features[3]):
        return pa.array(["und"] * rows), pa.array(np.zeros(rows)), pa.array([[]] * rows, pa.list_(SPAN))
    doc, first, end, labels, _, _, starts = _labelled_words(features, rows, m, switch)
    shares = np.bincount(doc * len(m.langs) + labels, weights=(end - first).astype(np.float64), minlength=rows * len(m.langs)).reshape(rows, -1)
    total = shares.sum(axis=1)
    lang = [m.langs[b] if x else "und" for b, x in zip(shares.argmax(axis=1), total, strict=True)]
    score = np.where(total > 0, shares.max(axis=1) / np.maximum(total, 1), 0.0)
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (labels[1:] != labels[:-1]))))
    last = np.concatenate((new[1:], [len(doc)])) - 1
    of = doc[new]
    spans = pa.StructArray.from_arrays(
        [pa.array((first[new] - starts[of]).astype(np.int32)), pa.array((end[last] - starts[of]).astype(np.int32)), pa.array(m.langs, pa.string()).take(pa.array(labels[new]))], fields=list(SPAN)
    )
    return pa.array(lang), pa.array(score), list_column(np.bincount(of, minlength=rows), spans)


SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
NAMES = ["doc_id", "lang_pred", "score", "spans"]


def is_held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text leaves 2 modulo 4. A null id isn't."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that aren't held out and label all rows; adds held_out to what ``identify`` returns."""
    model = fit(docs.where(~is_held_out(F.col(id_col))), text_col, lang_col, id_col, bounded=False)
    return identify(docs, model, id_col, text_col).withColumn("held_out", is_held_out(F.col("doc_id")))
