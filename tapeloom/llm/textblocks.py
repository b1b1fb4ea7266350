"""Numpy views of text for tasks that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Texts are worked on in blocks of about so many characters, whatever the size of a batch.
BLOCK_CHARS = 3_000_000


def blocks(batch: pa.RecordBatch, text_col: str = "text", limit: int = BLOCK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each; one longer text is a slice of its own."""
    column = batch.column(text_col)
    sizes = np.diff(utf8(column)[1]) if len(column) else np.zeros(0, dtype=np.int64)
    at = 0
    while at < len(sizes):
        total, end = sizes[at], at + 1
        while end < len(sizes) and total + sizes[end] <= limit:
            total += sizes[end]
            end += 1
        yield batch.slice(at, end - at)
        at = end


@cache
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


@cache
def lowered() -> np.ndarray:
    """For each code point its lower case, where that is one code point."""
    return np.fromiter((ord(x) if len(x := chr(i).lower()) == 1 else i for i in range(0x110000)), dtype=np.uint32, count=0x110000)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a line feed, and the start of each text."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    return points, np.cumsum(lengths) - lengths


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def list_column(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """A list column from the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


# Words from UTF-8 bytes: no Python string is made.

#: Bytes that separate words: space and U+0009 to U+000D.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        n = 1 << (n - 1).bit_length()
        inverse = pow(_BASE, -1, 1 << 64)
        _powers = tuple(np.concatenate((np.ones(1, dtype=np.uint64), np.cumprod(np.full(n - 1, b, dtype=np.uint64)))) for b in (_BASE, inverse))
    return _powers


def rolling(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes modulo 2^64 of values[first:end], wherever these stand."""
    up, down = powers(len(values) + 1)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)))
    return mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column without nulls, and the offsets of its rows in them."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last-plus-one byte of every word, and of every row the number of its first word (rows + 1 of them)."""
    inside = ~SEPARATOR[raw]
    start, stop = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    edge = at[(at > 0) & (at < len(raw))]
    start[edge] |= inside[edge]
    stop[edge - 1] |= inside[edge - 1]
    first = np.flatnonzero(start)
    return first, np.flatnonzero(stop) + 1, np.searchsorted(first, at, side="left")


def word_hashes(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    return rolling(_BYTE[raw], first, end)


def joined_words(raw: np.ndarray, first: np.ndarray, end: np.ndarray, row_first: np.ndarray) -> pa.Array:
    """Each row's words, joined by one space. row_first: of every row the number of its first word (rows + 1 of them)."""
    size = end - first
    n = np.diff(row_first)
    some = (n > 0).astype(np.int64)
    rank = np.repeat(np.cumsum(some) - some, n)  # rows with words before the word's row
    before = np.cumsum(size) - size
    at = before + np.arange(len(size)) - rank
    total = int(size.sum() + (n - some).sum())
    out = np.full(total, 32, dtype=np.uint8)
    nth = np.arange(int(size.sum())) - np.repeat(before, size)
    out[np.repeat(at, size) + nth] = raw[np.repeat(first, size) + nth]
    offsets = np.zeros(len(n) + 1, dtype=np.int64)
    bytes_of = np.bincount(np.repeat(np.arange(len(n)), n), weights=size, minlength=len(n)).astype(np.int64)
    np.cumsum(bytes_of + n - some, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())
