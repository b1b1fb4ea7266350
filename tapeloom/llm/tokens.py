"""Token counts of sections: encode whole documents once, attribute tokens by their spans."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.textblocks import blocks

#: Where the public vocabularies lie unless a path is given.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the byte-level BPE cuts text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Who gets a token that crosses a boundary: the section with most of its bytes (the earlier of equals), the first, or the last.
RULES = ("majority", "first", "last")


def load_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The vocabulary, read by Spark so that the path may lie in any store. Its size is that of the file."""
    content = spark.read.format("binaryFile").load(path if "://" in path else f"file://{path}").select("content").first()["content"]
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in bytes(content).splitlines() if line)}


def attribute(tok_start: np.ndarray, tok_end: np.ndarray, sec_start: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interval join of token spans and sections, both in order: of each section its tokens, shares and crossing tokens."""
    n = len(sec_start)
    first = np.searchsorted(sec_start, tok_start, side="right") - 1
    last = np.searchsorted(sec_start, tok_end - 1, side="right") - 1
    whole = first == last
    count = np.bincount(first[whole], minlength=n)
    share = count.astype(np.float64)
    crossing = np.zeros(n, dtype=np.int64)
    for i in np.flatnonzero(~whole):
        a, b = first[i], last[i]
        edges = np.concatenate(([tok_start[i]], sec_start[a + 1 : b + 1], [tok_end[i]]))
        held = np.diff(edges)
        share[a : b + 1] += held / held.sum()
        crossing[a : b + 1] += held > 0
        count[{"majority": a + int(held.argmax()), "first": a, "last": b}[rule]] += 1
    return count, share, crossing


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, rule: str = "majority", id_col: str = "doc_id", text_col: str = "text", fields: list[str] | None = None) -> DataFrame:
    """Tokens of every section of every document.

    Sections are the lines of the text, each with its line feed, or the columns ``fields``, which are joined by
    line feeds to one document. A document is encoded once, as a whole; its tokens' character spans are joined
    to the sections' spans; a token over several sections counts whole in one of them by ``rule`` and, in
    token_share, in each by its part of the token's bytes. So both columns sum to the document's tokens.

    Returns doc_id, section (from 0), start and end (code points), n_tokens, token_share, n_crossing. Null text
    counts as empty and gives one empty section. Null fields are empty sections. Repeated rows stay.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(load_ranks(spark, vocabulary))
    parts = F.array(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields)) if fields else None
    source = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.array_join(parts, "\n") if fields else F.coalesce(F.col(text_col), F.lit(""))).alias("text"),
        (F.transform(parts, lambda x: F.octet_length(x) + 1) if fields else F.lit(None).cast("array<int>")).alias("lengths"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        own = ranks.value
        encoder = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=own, special_tokens={})
        size_of = np.zeros(max(own.values()) + 1, dtype=np.int64)
        for piece, i in own.items():
            size_of[i] = len(piece)
        for whole in batches:
            for part in blocks(whole):
                texts = part.column("text").to_pylist()
                raw = [t.encode("utf-8", "surrogatepass") for t in texts]
                buffer = np.frombuffer(b"".join(raw), dtype=np.uint8)
                sizes = np.array([len(x) for x in raw], dtype=np.int64)
                starts = np.cumsum(sizes) - sizes
                ids = [encoder.encode_ordinary(t) for t in texts]
                spans = size_of[np.fromiter((i for x in ids for i in x), dtype=np.int64, count=sum(map(len, ids)))]
                tok_end = np.cumsum(spans)
                if fields:
                    ends = [np.minimum(np.cumsum(n), s) for n, s in zip(part.column("lengths").to_pylist(), sizes, strict=True)]
                    cuts = np.concatenate([s + np.concatenate(([0], e[:-1])) for s, e in zip(starts, ends, strict=True)])
                    doc = np.repeat(np.arange(len(texts)), len(fields))
                else:
                    lines = np.flatnonzero(buffer == 10) + 1
                    lines = lines[~np.isin(lines, starts + sizes)]  # nothing follows a last line feed
                    cuts = np.concatenate((starts, lines))
                    doc = np.concatenate((np.arange(len(texts)), np.searchsorted(starts + sizes, lines, side="right")))
                    by = np.lexsort((cuts, doc))
                    cuts, doc = cuts[by], doc[by]
                # sections without bytes hold no token: they aren't joined
                until = np.concatenate((cuts[1:], [len(buffer)]))
                full = until > cuts
                n, share, crossing = (np.zeros(len(cuts), dtype=t) for t in (np.int64, np.float64, np.int64))
                n[full], share[full], crossing[full] = attribute(tok_end - spans, tok_end, cuts[full], rule)
                chars = np.concatenate(([0], np.cumsum((buffer & 0xC0) != 0x80)))
                section = np.arange(len(cuts)) - np.searchsorted(doc, doc, side="left")
                base = chars[starts[doc]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(doc)), pa.array(section), pa.array(chars[cuts] - base), pa.array(chars[until] - base), pa.array(n), pa.array(share), pa.array(crossing)],
                    ["doc_id", "section", "start", "end", "n_tokens", "token_share", "n_crossing"],
                )

    longs = [T.StructField(x, T.DoubleType() if x == "token_share" else T.LongType()) for x in ("section", "start", "end", "n_tokens", "token_share", "n_crossing")]
    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], *longs]))
