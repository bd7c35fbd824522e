"""Helpers shared by the operators of this subpackage.

Text columns reach Python as Arrow buffers; the functions here find words and
hash them with array operations over the UTF-8 bytes, so no operator loops over
words or characters in Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Words are runs of anything but ASCII white space (Java and RE2 syntax).
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of one Arrow batch sent to a Python worker; with it a worker's memory
#: is bounded by a few batches plus the longest single text.
BATCH_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2^64
_STEP_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Bound Arrow batches by bytes (and rows) for this session's Python stages."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's first word (n + 1 entries)."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # a text's border also ends a word
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a fixed bijection of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        up, down = np.full(size, _STEP, np.uint64), np.full(size, _STEP_INV, np.uint64)
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"], _POWERS["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: a polynomial from prefix sums, then mixed
    with the length. Equal bytes give equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mix(mix(value) + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its windows of ``width`` words;
    a text of fewer words has one, of all of them, and a text without words none."""
    n = len(words)
    out = []
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        rolled += mix(words[k:k + len(rolled)] + np.uint64(k)) * np.uint64(2 * k + 3)
    rolled = mix(rolled)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(rolled[a:b - width + 1]))
        elif b > a:
            whole = np.asarray([b - a], np.uint64)
            for k in range(a, b):
                whole = mix(whole * np.uint64(31) + words[k:k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def ragged(values: list[np.ndarray], kind=pa.int64()) -> pa.ListArray:
    sizes = np.fromiter((len(v) for v in values), np.int64, len(values))
    flat = np.concatenate(values) if len(values) else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), pa.int32()),
                                    pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat, kind))
