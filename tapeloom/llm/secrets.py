"""Secret scan: fixed patterns and sliding-window entropy."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.textblocks import blocks

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of 32 and more are the runs of 1 and more that are long enough.
HEX = re.compile(r"[0-9a-f]{32,}")
#: A text without one of these, in lower case, has no assignment.
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

#: Length of the window over which entropy is measured.
WINDOW = 20
#: Candidate strings of each character class, and the entropy (bits a character) from which a window counts.
CLASSES = (
    ("hex", re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{20,}"), 3.0),
    ("base36", re.compile(r"(?<![0-9a-z])[0-9a-z]{20,}"), 3.6),
    ("base64", re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"), 3.9),
)
CANDIDATE = CLASSES[2][1]
#: What is no secret within a candidate: identifiers, placeholders, counting sequences. What stands around it is looked at.
ALLOWED = re.compile(
    r"(?<![0-9A-Za-z])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![0-9A-Za-z])"
    r"|example|placeholder|changeme|dummy|sample|x{4,}|0123456789|abcdefghij",
    re.ASCII | re.IGNORECASE,
)
_C_LOG_C = [0.0, *(c * log2(c) for c in range(1, WINDOW + 1))]


def hot_windows(s: str, threshold: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged spans of the windows whose entropy reaches the threshold and that hold a digit and a letter.

    Counts change by one character in and one out, so a step costs the same whatever the window's length.
    """
    spans: list[tuple[int, int]] = []
    counts: dict[str, int] = {}
    total, digits = 0.0, 0
    least = log2(window)
    table = _C_LOG_C if window == WINDOW else [0.0, *(c * log2(c) for c in range(1, window + 1))]
    for i, ch in enumerate(s):
        if i >= window:
            old = s[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += table[c - 1] - table[c]
            digits -= old.isdigit()
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += table[c + 1] - table[c]
        digits += ch.isdigit()
        if i >= window - 1 and 0 < digits < window and least - total / window >= threshold - 1e-9:
            start = i - window + 1
            if spans and spans[-1][1] >= start:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    low = text.lower()
    assign = [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if any(k in low for k in KEYWORDS) else []
    access = [m.span() for m in ACCESS.finditer(text) if len(m[0]) >= 16] if "AKIA" in text else []
    return {"assign": assign, "access": access, "hex": [m.span() for m in HEX.finditer(text)]}


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Spans of high entropy in candidate strings of any class, without what the allow-list covers, merged."""
    found = []
    for outer in CANDIDATE.finditer(text):
        at, parts = 0, []
        for x in ALLOWED.finditer(outer[0]):
            parts.append((at, x.start()))
            at = x.end()
        parts.append((at, len(outer[0])))
        for a, b in parts:
            if b - a < WINDOW:
                continue
            part, first = outer[0][a:b], outer.start() + a
            for _, pattern, threshold in CLASSES:
                for inner in pattern.finditer(part):
                    found += [(first + inner.start() + x, first + inner.start() + y) for x, y in hot_windows(inner[0], threshold)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


KINDS = ("assign", "access", "hex", "entropy")


def find(text: str | None) -> list[tuple[str, int, int]]:
    """All spans as (kind, start, end) in code points by start, then kind."""
    text = text or ""
    every = {**base_spans(text), "entropy": entropy_spans(text)}
    return sorted(((k, a, b) for k, spans in every.items() for a, b in spans), key=lambda x: (x[1], KINDS.index(x[0])))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every secret of every text: doc_id and secrets (array of kind, start, end; code points, end exclusive).

    Kinds: assign, access and hex by pattern, entropy by windows. Null text counts as empty and has none. One
    row for each row, repeated rows too; ids may be of any type; an empty table gives an empty result; other columns
    are ignored. A task holds some three megabytes of text, or one longer text, at once.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in blocks(whole):
                rows = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, kind)], ["doc_id", "secrets"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    return source.mapInArrow(run, T.StructType([source.schema["doc_id"], T.StructField("secrets", T.ArrayType(span))]))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their spans and all spans as text."""
    as_text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("secrets", lambda x: x["kind"] != "entropy")
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(F.col("secrets")).alias("spans"),
    )


def spans_sha256(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
