"""SimHash near-duplicates: exact links of 64-bit fingerprints by bit-sliced comparison.

**Fingerprints.** A bit is 1 if it is set in over half the XXH64 (seed 42) of a
text's windows of three words. Texts are read in pieces, their windows counted in
eight byte lanes of a word, so a task holds a piece and 64 counters a text.

**Regions.** Two fingerprints that differ in at most three bits agree in one of
four blocks of the bits not yet used. Distinct fingerprints go to the region of each
of their four blocks' values; a region of more than ``most`` fingerprints is split
again by four blocks of the bits left, and so on. Pairs that differ in three bits or
fewer meet in some region of each split, so no link is lost, and no region is
compared that is larger than ``most``, however many fingerprints share a block.

**Bit-sliced comparison.** Regions come to a task sorted, and a block of them is
stored vertically: one bit plane for each of the 64 bits, a bit for each
fingerprint. Moving the planes by s places and XORing them gives, 64 pairs a word,
where the fingerprints s places apart differ. Two planes at a time go through a
carry-save adder into a two-bit counter and an overflow plane; when all pairs of the
block have overflowed the distance (s places apart) is abandoned, mostly after a
dozen planes. Links within a block are merged at once, and only a forest of them
leaves the task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, mix
from wardflow.llm.jaccard import connected
from wardflow.session import discard, materialize, scratch_path

BITS, WIDTH, SEED = 64, 3, 42
#: Fingerprints link at so many differing bits or fewer; the counters hold just that.
RADIUS = 3
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20
#: Fingerprints of a region that are compared without another split.
MOST = 2048
#: Splits after which at most six bits are left, that is 64 fingerprints a region.
LEVELS = 9
#: Fingerprints of one block of regions, about.
BLOCK = 1 << 15

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Byte to eight lanes of a 64-bit word, lane i holding bit i.
_LANES = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.uint8).copy().view(np.uint64)[:, 0]


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The lower-case words of a text in lists of about PIECE bytes' worth, cut
    at white space; a single longer word is one list's."""
    at = 0
    while at < len(text):
        end = min(at + PIECE, len(text))
        if end < len(text):
            found = _SPACE.search(text, end)
            end = found.start() if found else len(text)
        yield text[at:end].translate(_LOWER).split()
        at = end


def window_digests(text: bytes) -> Iterator[bytes]:
    """Big-endian XXH64 of all windows of three words, joined, piece by piece; of
    all words if there are one or two; nothing if there are none."""
    digest, last, any_window = xxhash.xxh64_digest, [], False
    for words in pieces(text):
        words = last + words
        if len(words) >= WIDTH:
            any_window = True
            yield b"".join([digest(b" ".join(w), SEED) for w in zip(words, words[1:], words[2:])])
        last = words[-(WIDTH - 1):]
    if last and not any_window:
        yield digest(b" ".join(last), SEED)


def bit_counts(digests: bytes) -> np.ndarray:
    """How many of the hashes have each bit set; entry i is bit i of the value."""
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)[:, ::-1]
    lanes = np.add.reduceat(_LANES[rows], np.arange(0, len(rows), 255), axis=0)  # 255 hashes fill a lane at most
    return np.ascontiguousarray(lanes).view(np.uint8).astype(np.int64).sum(0)


def fingerprint(text: bytes) -> int:
    """Zero for a text without words."""
    counts, n = np.zeros(BITS, np.int64), 0
    for some in window_digests(text):
        counts += bit_counts(some)
        n += len(some) // 8
    return int((np.uint64(1) << np.flatnonzero(2 * counts > n).astype(np.uint64)).sum(dtype=np.uint64)) if n else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row, ``fp`` as a signed long."""
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    bounded_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            raw = pc.fill_null(b.column(1), "").cast(pa.large_binary())
            fps = np.fromiter((fingerprint(t.as_py()) for t in raw), np.uint64, len(raw))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, fp long")


@lru_cache(maxsize=None)
def _splits(way: int) -> list[tuple[int, int]]:
    """(way, mask of the block's bits) of the RADIUS + 1 blocks that split a region
    of this way. A way is the blocks chosen so far, as digits after a leading 1."""
    left, digits = list(range(BITS)), []
    while way > 1:
        way, k = divmod(way, RADIUS + 1)
        digits.append(k)
    blocks = _cut(left)
    own = 1
    for k in reversed(digits):
        own = own * (RADIUS + 1) + k
        left = [b for b in left if b not in blocks[k]]
        blocks = _cut(left)
    return [(own * (RADIUS + 1) + k, sum(1 << b for b in bits)) for k, bits in enumerate(blocks)]


def _cut(left: list[int]) -> list[list[int]]:
    at = [len(left) * k // (RADIUS + 1) for k in range(RADIUS + 2)]
    return [left[a:b] for a, b in zip(at, at[1:])]


def _split(batches):
    """(region, way, fp) of each row's blocks, from (region, way, fp)."""
    for batch in batches:
        region, way, fp = (np.asarray(c).view(np.uint64) for c in batch.columns)
        out = []
        for w in np.unique(way).tolist():
            mine = way == w
            for to, mask in _splits(w):
                key = mix(mix(fp[mine] & np.uint64(mask)) ^ region[mine] + np.uint64(to))
                out.append((key, np.full(len(key), to, np.uint64), fp[mine]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) if out else pa.nulls(0, pa.int64())
                                          for c in (zip(*out) if out else [()] * 3)], ["region", "way", "fp"])


def regions(classes: DataFrame, most: int = MOST) -> tuple[DataFrame, list[str]]:
    """((region, way, fp) such that any two fingerprints within RADIUS share a region, scratch paths).

    ``way`` tells which blocks were used, ``region`` hashes their values. A region has
    at most ``most`` members, or after LEVELS splits those that the few bits left allow.
    """
    spark, scratch = classes.sparkSession, []
    schema = "region long, way long, fp long"

    def stored(frame: DataFrame, name: str) -> DataFrame:
        scratch.append(scratch_path(spark, name))
        return materialize(frame, name, scratch[-1])

    held = classes.select(F.lit(0).cast("long").alias("region"), F.lit(1).cast("long").alias("way"), "fp")
    out = None
    for level in range(1, LEVELS + 1):
        each = stored(held.mapInArrow(_split, schema), "simhash-entries")
        large = each.groupBy("region", "way").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > most)
        large = stored(large.select("region", "way"), "simhash-large")
        ends = level == LEVELS or large.isEmpty()
        done = each if ends else each.join(large, ["region", "way"], "left_anti")
        out = done if out is None else out.union(done)
        if ends:
            return out, scratch
        held = each.join(large, ["region", "way"], "left_semi").select("region", "way", "fp")


def planes(fps: np.ndarray) -> np.ndarray:
    """(64, words): plane b has bit b of every fingerprint, fingerprint i at bit i % 64 of word i // 64."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    words = -(-len(fps) // 64)
    full = np.zeros((BITS, words * 64), np.uint8)
    full[:, :len(fps)] = bits.T
    return np.packbits(full, axis=1, bitorder="little").view(np.uint64)


def _moved(x: np.ndarray, s: int, words: int) -> np.ndarray:
    """Bits s places further on, as the first ``words`` words."""
    q, r = divmod(s, 64)
    out = np.zeros(words, np.uint64)
    near = x[q:q + words]
    out[:len(near)] = near >> np.uint64(r)
    if r:
        far = x[q + 1:q + 1 + words]
        out[:len(far)] |= far << np.uint64(64 - r)
    return out


def near_pairs(fps: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of all pairs within RADIUS among ``fps`` whose regions end at ``ends``
    (ascending), largest regions first: for each s the pairs s places apart."""
    stored = planes(fps)
    starts = np.concatenate(([0], ends[:-1]))
    sizes = ends - starts
    for s in range(1, int(sizes.max(initial=0))):
        live = int(np.searchsorted(-sizes, -s, "left"))  # regions of more than s members
        last = int(ends[live - 1])
        words = -(-last // 64)
        within = np.zeros(words * 64, np.uint8)
        mark = np.zeros(last + 1, np.int32)
        np.add.at(mark, starts[:live], 1)
        np.add.at(mark, ends[:live] - s, -1)
        within[:last] = np.cumsum(mark[:-1]) > 0
        pairs = np.packbits(within, bitorder="little").view(np.uint64)
        low, high, over = np.zeros(words, np.uint64), np.zeros(words, np.uint64), ~pairs
        for b in range(0, BITS, 2):
            x = stored[b, :words] ^ _moved(stored[b], s, words)
            y = stored[b + 1, :words] ^ _moved(stored[b + 1], s, words)
            odd = x ^ y
            carry = (x & y) | (low & odd)
            low ^= odd
            over |= high & carry
            high ^= carry
            if b % 8 == 6 and not (~over).any():
                break
        else:
            i = np.flatnonzero(np.unpackbits((~over).view(np.uint8), bitorder="little"))
            if len(i):
                yield i, i + s


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least connected index of each of ``n`` places."""
    root = np.arange(n)
    for i, j in pairs:
        a, b = root[i], root[j]
        while (apart := a != b).any():
            low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
            a, b = root[i], root[j]
    return root


def _compare(fps: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect what is linked within equal keys (sorted)."""
    border = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True]))) if len(keys) else np.zeros(1, np.int64)
    sizes = np.diff(border)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 1]
    if not len(order):
        return fps[:0], fps[:0]
    sizes = sizes[order]
    ends = np.cumsum(sizes)
    at = np.repeat(border[order] - (ends - sizes), sizes) + np.arange(ends[-1])
    mine = fps[at]
    root = forest(len(mine), near_pairs(mine, ends))
    more = np.flatnonzero(root != np.arange(len(mine)))
    return mine[more], mine[root[more]]


def links(classes: DataFrame, most: int = MOST) -> tuple[DataFrame, list[str]]:
    """((a, b): links that connect all of ``classes`` (fp) within RADIUS of each other, scratch paths)."""
    entries, scratch = regions(classes, most)
    dealt = entries.repartition("region", "way").sortWithinPartitions("region", "way")

    def run(batches):
        kept_fps, kept_keys, size = [], [], 0
        for b in batches:
            key = np.asarray(b.column(0)).view(np.uint64) ^ mix(np.asarray(b.column(1)).view(np.uint64))
            kept_fps.append(np.asarray(b.column(2)).view(np.uint64))
            kept_keys.append(key)
            size += b.num_rows
            if size < BLOCK:
                continue
            fps, keys = np.concatenate(kept_fps), np.concatenate(kept_keys)
            other = np.flatnonzero(keys != keys[-1])
            cut = int(other[-1]) + 1 if len(other) else 0  # the last region may go on
            a, z = _compare(fps[:cut], keys[:cut])
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(z.view(np.int64))], ["a", "b"])
            kept_fps, kept_keys, size = [fps[cut:]], [keys[cut:]], len(fps) - cut
        if kept_fps:
            a, z = _compare(np.concatenate(kept_fps), np.concatenate(kept_keys))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(z.view(np.int64))], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long"), scratch


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits) and ``component_id``,
    the least id reachable by links, itself included.

    Null, empty and blank texts have fingerprint zero and are linked like any others;
    texts of one or two words have the hash of all of them. Rows of equal
    fingerprints are linked, repeated rows too. A null id is never the least one (a
    component of null ids only has null). An empty table gives no rows, other columns
    are not read, and a very long text is read in pieces.
    """
    spark = docs.sparkSession
    rows = materialize(fingerprints(docs, id_col, text_col), "simhash-rows")
    classes = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    edges, scratch = links(classes.select("fp"), most)
    path = scratch_path(spark, "simhash-links")
    edges = materialize(edges.distinct(), "simhash-links", path)
    labels = connected(edges, "simhash")
    named = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"), "least")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = materialize(named.join(least, "label").select("fp", "component_id"), "simhash-components")
    for p in (*scratch, path):
        discard(spark, p)
    return rows.join(named, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
