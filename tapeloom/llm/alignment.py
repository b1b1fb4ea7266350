"""Cross-tokenizer alignment: token-byte incidence matrices in CSR, multiplied row by row.

A text is encoded by two tokenizers, A (byte-level BPE) and B (pieces with byte fallback). Both tile the bytes of a
space and the text. The incidence matrix of a tokenizer has a row a token, a column a byte and a one where the token
covers the byte. Gustavson's product A·Bᵀ has an entry where an A and a B token overlap, and its value is the number
of shared bytes. Where tokens of both end at one byte the sequence is cut into groups; the product of the token-group
matrices has an entry for every A and B token of one group.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.shared import cut
from tapeloom.llm.textblocks import blocks, list_column
from tapeloom.llm.tokens import PATTERN

#: Where the public vocabularies lie unless a path is given.
BYTE_LEVEL, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Texts are aligned in blocks of about so many bytes. Id pairs are counted once a block.
BLOCK = 2_000_000
#: Matrices are multiplied in slabs of about so many columns, cut where a group ends: so a long text's product is made in parts.
SLAB = 1_000_000
#: Shared-group links leave a task in batches of about so many.
LINKS = 1_000_000


class Csr(NamedTuple):
    """A sparse matrix by rows: entries of row i are indptr[i]:indptr[i+1] of indices (columns) and values."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray


def incidence(ends: np.ndarray) -> Csr:
    """Rows of tokens that tile columns 0 to ends[-1]: token t covers the columns from the end of the one before up to ends[t]."""
    width = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate(([0], ends)), np.arange(width), np.ones(width, dtype=np.int64))


def transpose(m: Csr, columns: int) -> Csr:
    by = np.argsort(m.indices, kind="stable")
    row = np.repeat(np.arange(len(m.indptr) - 1), np.diff(m.indptr))
    indptr = np.zeros(columns + 1, dtype=np.int64)
    np.cumsum(np.bincount(m.indices, minlength=columns), out=indptr[1:])
    return Csr(indptr, row[by], m.values[by])


def product_sizes(a: Csr, b: Csr) -> np.ndarray:
    """Of each row of a·b the number of terms, before those of one column are summed."""
    terms = np.concatenate(([0], np.cumsum(np.diff(b.indptr)[a.indices])))
    return terms[a.indptr[1:]] - terms[a.indptr[:-1]]


def product(a: Csr, b: Csr, columns: int) -> Csr:
    """a·b by Gustavson: row i gathers row k of b for each of its entries (i, k); terms of one column are summed."""
    rows = len(a.indptr) - 1
    size = np.diff(b.indptr)[a.indices]
    row = np.repeat(np.repeat(np.arange(rows), np.diff(a.indptr)), size)
    at = np.arange(len(row)) + np.repeat(b.indptr[a.indices] - (np.cumsum(size) - size), size)
    key = row * columns + b.indices[at]
    value = np.repeat(a.values, size) * b.values[at]
    if (key[1:] < key[:-1]).any():
        by = np.argsort(key, kind="stable")
        key, value = key[by], value[by]
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    indptr = np.zeros(rows + 1, dtype=np.int64)
    np.cumsum(np.bincount(key[first] // columns, minlength=rows), out=indptr[1:])
    return Csr(indptr, key[first] % columns, np.add.reduceat(value, first) if len(first) else value)


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray, slab: int = SLAB) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlap links of two tilings of the same bytes, in order: A token, B token, shared bytes."""
    ends = a_ends[np.isin(a_ends, b_ends, assume_unique=True)]
    parts, start, i, j = [], 0, 0, 0
    while start < (ends[-1] if len(ends) else 0):
        stop = ends[min(np.searchsorted(ends, start + slab), len(ends) - 1)]
        i_end, j_end = np.searchsorted(a_ends, stop) + 1, np.searchsorted(b_ends, stop) + 1
        a, b = incidence(a_ends[i:i_end] - start), incidence(b_ends[j:j_end] - start)
        c = product(a, transpose(b, int(stop - start)), j_end - j)
        parts.append((np.repeat(np.arange(i, i_end), np.diff(c.indptr)), c.indices + j, c.values))
        start, i, j = stop, i_end, j_end
    if not parts:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def group_incidence(ends: np.ndarray, common: np.ndarray) -> Csr:
    """A row a token, a column a group: the group whose end is the first at or after the token's."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(common, ends), np.ones(len(ends), dtype=np.int64))


def shared_links(a: Csr, bt: Csr, columns: int, limit: int = LINKS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A and B tokens of one group: all pairs of A·Bᵀ over groups, in batches of about ``limit``, however large a group."""
    size = product_sizes(a, bt)
    until = np.cumsum(size)
    i = 0
    while i < len(size):
        end = max(i + 1, int(np.searchsorted(until, (until[i - 1] if i else 0) + limit, side="right")))
        if size[i] > limit:  # one token's row is cut by columns: it holds the B tokens of one group
            row = bt.indices[bt.indptr[a.indices[i]] : bt.indptr[a.indices[i] + 1]]
            for at in range(0, len(row), limit):
                yield np.full(len(row[at : at + limit]), i), row[at : at + limit]
        else:
            part = Csr(a.indptr[i : end + 1] - a.indptr[i], a.indices[a.indptr[i] : a.indptr[end]], a.values[a.indptr[i] : a.indptr[end]])
            c = product(part, bt, columns)
            yield np.repeat(np.arange(i, end), np.diff(c.indptr)), c.indices
        i = end


# Tokenizers


def _read(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file, read by Spark so that it may lie in any store."""
    return bytes(spark.read.format("binaryFile").load(path if "://" in path else f"file://{path}").select("content").first()["content"])


def byte_level(content: bytes) -> dict[bytes, int]:
    """Bytes of every entry of a byte-level BPE file: its characters stand for bytes by the format's rule.

    Printable Latin-1 bytes stand for themselves and the others, in order, for the code points from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(plain))}
    file = json.loads(content)
    special = {x["content"] for x in file.get("added_tokens", [])}
    return {bytes(of[c] for c in entry): i for entry, i in file["model"]["vocab"].items() if entry not in special}


class Tokenizers:
    """Both tokenizers of a task, from the files' contents."""

    def __init__(self, byte_level_file: bytes, piece_file: bytes):
        import sentencepiece
        import tiktoken

        ranks = byte_level(byte_level_file)  # an entry's id is its place in the order of merges
        self._a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_proto=piece_file)
        n = self._b.get_piece_size()
        pieces = [self._b.id_to_piece(i) for i in range(n)]
        self._b_bytes = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64), np.array([len(x) for x in self._b_bytes])
        for piece, i in ranks.items():
            self.sizes[0][i] = len(piece)

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, list[int]]]:
        """A's and B's ids of each text; none where there is no text or B's bytes aren't those of a space and the text."""
        out = []
        for text, b in zip(texts, self._b.encode([t or "" for t in texts], num_threads=1), strict=True):
            if text and b"".join(map(self._b_bytes.__getitem__, b)) == b" " + text.encode():
                out.append((self._a.encode_to_numpy(" " + text, disallowed_special=()), b))
            else:
                out.append((np.zeros(0, dtype=np.uint32), []))
        return out


class Aligned:
    """A block of texts: ids, first token of each text and ends, each for A and B; ends of groups; overlap links."""

    def __init__(self, texts: list[str | None], tokenizers: Tokenizers):
        both = tokenizers.encode(texts)
        self.n = [np.array([len(x[k]) for x in both], dtype=np.int64) for k in (0, 1)]
        self.ids = [np.concatenate([x[0] for x in both]).astype(np.int64), np.fromiter(chain.from_iterable(x[1] for x in both), dtype=np.int64, count=self.n[1].sum())]
        self.ends = [np.cumsum(tokenizers.sizes[k][self.ids[k]]) for k in (0, 1)]
        self.doc = [np.repeat(np.arange(len(texts)), n) for n in self.n]
        at_end = [np.isin(x, y, assume_unique=True) for x, y in (self.ends, self.ends[::-1])]
        self.last = at_end  # of each token, whether a group ends with it
        self.common = self.ends[0][at_end[0]]
        self.groups = np.bincount(self.doc[0][at_end[0]], minlength=len(texts))
        self.link_a, self.link_b, self.link_bytes = overlaps(*self.ends)
        self.links = np.bincount(self.doc[0][self.link_a], minlength=len(texts))

    def group_matrices(self) -> tuple[Csr, Csr]:
        """Token-group matrix of A, and B's transposed."""
        a, b = (group_incidence(x, self.common) for x in self.ends)
        return a, transpose(b, len(self.common))


def _group_texts(block: Aligned, names: list[pa.Array]) -> list[bytes]:
    """Of each text the string ``a1,a2|b1;a3|b2,b3``. names: of A and B, decimal ids followed by a comma, a bar or semicolon, or nothing."""
    group = [np.searchsorted(block.common, x) for x in block.ends]
    code = []
    for k in (0, 1):
        ending = block.last[k].astype(np.int64)
        if k:  # nothing follows a text's last token
            final = np.cumsum(block.n[1])[block.n[1] > 0] - 1
            ending[final] = 2
        code.append(block.ids[k] * 3 + ending + (k and len(names[0])))
    # a group's A tokens, then its B tokens; both sequences are in order of groups
    place = [np.arange(len(group[0])) + np.searchsorted(group[1], group[0], side="left"), np.arange(len(group[1])) + np.searchsorted(group[0], group[1], side="right")]
    order = np.empty(len(group[0]) + len(group[1]), dtype=np.int64)
    order[place[0]], order[place[1]] = code
    pieces = pa.concat_arrays(names).take(pa.array(order))
    return pc.binary_join(list_column(block.n[0] + block.n[1], pieces), b"").to_pylist()


def _names(tokenizers: Tokenizers) -> list[pa.Array]:
    return [pa.array([f"{i}{end}".encode() for i in range(len(n)) for end in ends]) for n, ends in zip(tokenizers.sizes, ((",", "|", ""), (",", ";", "")), strict=True)]


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _texts(part: pa.RecordBatch) -> pa.RecordBatch:
    """Null texts as empty ones, which have no tokens either."""
    return pa.RecordBatch.from_arrays([part.column("doc_id"), pc.fill_null(part.column("text"), "")], ["doc_id", "text"])


def _loaded(docs: DataFrame, byte_level_path: str, piece_path: str):
    """The two vocabulary files, broadcast: their sizes are fixed."""
    spark = docs.sparkSession
    return spark.sparkContext.broadcast((_read(spark, byte_level_path), _read(spark, piece_path)))


def align(docs: DataFrame, byte_level_path: str = BYTE_LEVEL, piece_path: str = PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens, overlap links and groups of every text.

    Returns a row a document: doc_id; a and b (ids), a_end and b_end (end of each token in the bytes of a space and
    the text); link_a, link_b (numbers of tokens that overlap) and link_bytes (how many bytes they share);
    group_a and group_b (of each group the number of the token after its last). The pairs of tokens that share a
    group follow from these; ``shared_groups`` lists them.

    Texts that are null, empty, or changed by B's normalisation have no tokens: their arrays are empty. Repeated
    rows stay, null ids too. A long text's matrices are multiplied in parts.
    """
    files = _loaded(docs, byte_level_path, piece_path)
    source = _source(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(*files.value)
        for whole in batches:
            for part in blocks(_texts(whole), limit=BLOCK):
                x = Aligned(part.column("text").to_pylist(), tokenizers)
                byte_start = np.concatenate(([0], np.cumsum([e.sum() for e in np.split(tokenizers.sizes[0][x.ids[0]], np.cumsum(x.n[0])[:-1])])))[:-1]
                first = [np.cumsum(n) - n for n in x.n]
                columns = [list_column(x.n[k], pa.array(x.ids[k].astype(np.int32))) for k in (0, 1)]
                columns += [list_column(x.n[k], pa.array(x.ends[k] - byte_start[x.doc[k]])) for k in (0, 1)]
                doc = x.doc[0][x.link_a]
                columns += [list_column(x.links, pa.array(v.astype(np.int32))) for v in (x.link_a - first[0][doc], x.link_b - first[1][doc], x.link_bytes)]
                for k in (0, 1):
                    at = np.flatnonzero(x.last[k])
                    columns.append(list_column(x.groups, pa.array((at + 1 - first[k][x.doc[k][at]]).astype(np.int32))))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *_ARRAYS])

    kinds = {"a_end": T.LongType(), "b_end": T.LongType()}
    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], *(T.StructField(c, T.ArrayType(kinds.get(c, T.IntegerType()))) for c in _ARRAYS)]))


_ARRAYS = ["a", "b", "a_end", "b_end", "link_a", "link_b", "link_bytes", "group_a", "group_b"]


def shared_groups(aligned: DataFrame) -> DataFrame:
    """Shared-group links of ``align``'s rows: doc_id, a_token, b_token (numbers in the text), a row a link.

    All of them: a group of n A tokens and m B tokens has n·m, so only ask for texts where that is wanted. Batches
    are bounded, whatever a group's size.
    """
    source = aligned.select("doc_id", "group_a", "group_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (ga, gb) in enumerate(zip(batch.column("group_a"), batch.column("group_b"), strict=True)):
                ends = [np.asarray(g.values.to_numpy(zero_copy_only=False) if len(g) else [], dtype=np.int64) for g in (ga, gb)]
                if not len(ends[0]):
                    continue
                ones = [np.repeat(np.arange(len(e)), np.diff(np.concatenate(([0], e)))) for e in ends]
                a, b = (Csr(np.arange(len(o) + 1), o, np.ones(len(o), dtype=np.int64)) for o in ones)
                for left, right in shared_links(a, transpose(b, len(ends[0])), len(ones[1])):
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(np.full(len(left), i))), pa.array(left), pa.array(right)], ["doc_id", "a_token", "b_token"])

    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], T.StructField("a_token", T.LongType()), T.StructField("b_token", T.LongType())]))


def link_counts(docs: DataFrame, byte_level_path: str = BYTE_LEVEL, piece_path: str = PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of every text its links, weighed by how many links of all texts hold the same two ids linked.

    Returns a row a document: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose count is the highest
    of any with their B id, ties included), count_sum (of the counts over links), n_shared (pairs of tokens that share
    a group), groups_sha256. Edge rows as in ``align``: zeros and an empty string.

    A text is encoded once. A block of texts keeps its links as numbers of its own list of id pairs, so what is
    shuffled to count the pairs is a row a block and pair; the counts come back to the block as one row.
    """
    files = _loaded(docs, byte_level_path, piece_path)
    source = _source(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(*files.value)
        names = _names(tokenizers)
        n_b = len(tokenizers.sizes[1])
        block = TaskContext.get().partitionId() << 32
        for whole in batches:
            for part in blocks(_texts(whole), limit=BLOCK):
                x = Aligned(part.column("text").to_pylist(), tokenizers)
                rows = part.num_rows
                pairs, which = np.unique(x.ids[0][x.link_a] * n_b + x.ids[1][x.link_b], return_inverse=True)
                own, times = np.unique(x.doc[0][x.link_a] * max(1, len(pairs)) + which, return_counts=True)
                of, nth = np.divmod(own, max(1, len(pairs)))
                held = np.bincount(of, minlength=rows)
                shared = np.bincount(x.doc[0], weights=product_sizes(*x.group_matrices()), minlength=rows).astype(np.int64)
                hashed = [hashlib.sha256(t).hexdigest() if t else "" for t in _group_texts(x, names)]
                total = np.bincount(which, minlength=len(pairs))
                pad = lambda kind, n=rows: pa.nulls(n, kind)
                doc_columns = [pa.array(v) for v in (*x.n, x.groups, x.links, shared)] + [pa.array(hashed, pa.string())]
                doc_columns += [list_column(held, pa.array(v.astype(np.int32))) for v in (nth, times)]
                of_block = pa.array(np.full(rows, block))
                yield pa.RecordBatch.from_arrays([of_block, part.column("doc_id"), *doc_columns, pad(pa.list_(pa.int64())), pad(pa.list_(pa.int64()))], _BLOCK_NAMES)
                nothing = [pa.nulls(1, c.type) for c in (part.column("doc_id"), *doc_columns)]
                yield pa.RecordBatch.from_arrays([pa.array([block]), *nothing, *(list_column(np.array([len(v)]), pa.array(v.astype(np.int64))) for v in (pairs, total))], _BLOCK_NAMES)
                block += 1

    longs = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_shared")]
    lists = [T.StructField(c, T.ArrayType(t)) for c, t in (("nth", T.IntegerType()), ("times", T.IntegerType()), ("pairs", T.LongType()), ("totals", T.LongType()))]
    id_field = T.StructField("doc_id", source.schema["doc_id"].dataType)
    schema = T.StructType([T.StructField("block", T.LongType()), id_field, *longs, T.StructField("groups_sha256", T.StringType()), *lists])
    made = cut(source.mapInArrow(run, schema))
    listed = made.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "totals")).alias("nth", "p")).select("block", "nth", F.col("p.pairs").alias("pair"), F.col("p.totals").alias("n"))
    n_b = F.lit(_pieces(files.value[1]))
    counts = cut(listed.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair") % n_b))
    best = counts.groupBy("b").agg(F.max("count").alias("most"))
    known = counts.join(best, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = listed.select("block", "nth", "pair").join(known, "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("nth", "count", "best"))).alias("known"))
    back = back.select("block", F.col("known.count").alias("counts"), F.col("known.best").alias("bests"))
    of_texts = made.where("pairs is null").drop("pairs", "totals").withColumnRenamed("block", "of")
    out = [id_field, *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_shared")), T.StructField("groups_sha256", T.StringType())]
    return of_texts.groupBy("of").cogroup(back.groupBy("block")).applyInArrow(_weigh, T.StructType(out))


_BLOCK_NAMES = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "nth", "times", "pairs", "totals"]


def _pieces(content: bytes) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=content).get_piece_size()


def _weigh(texts: pa.Table, known: pa.Table) -> pa.Table:
    """Sums over a block's texts; known: the counts of the block's id pairs, one row, or none where there is no link."""
    texts = texts.combine_chunks()
    counts, bests = (np.asarray(known.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)) if known.num_rows else np.zeros(0, dtype=np.int64) for c in ("counts", "bests"))
    nth, times = (texts.column(c).combine_chunks() for c in ("nth", "times"))
    doc = np.repeat(np.arange(texts.num_rows), nth.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    nth, times = nth.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sums = []
    for value in (times * bests[nth].astype(np.int64), times * counts[nth].astype(np.int64)) if len(nth) else (times, times):
        out = np.zeros(texts.num_rows, dtype=np.int64)
        np.add.at(out, doc, value)
        sums.append(pa.array(out))
    kept = texts.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    for name, column in zip(("n_best", "count_sum", "n_shared", "groups_sha256"), (*sums, texts.column("n_shared"), texts.column("groups_sha256")), strict=True):
        kept = kept.append_column(name, column)
    return kept
