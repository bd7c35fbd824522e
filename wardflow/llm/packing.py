"""Packing: whole documents into training sequences of fixed length, online and
in bounded space.

Every partition keeps at most ``open_windows`` unfinished windows. A document's
ids, ended by one end id, first fill whole windows of their own; what is left
goes into the open window that it fits best. If it fits none and no more may be
opened, the fullest is emitted, with the head of the document in its gap when
that gap is worth a cut. At its end a partition merges its open windows, so one
part-filled window is left over; leftovers of all partitions are merged in
rounds of the same packer over ever fewer partitions, each round reading what
the one before has written, and the last padded window is the only one not full
by more than ``min_cut`` - 1 ids.
"""

from __future__ import annotations

import os
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.bytebpe import Encoder, digest
from wardflow.llm.common import bounded_batches
from wardflow.session import materialize

_OUT = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "ids binary, part int")
FAN_IN = 64


class Packer:
    """The open windows of one partition. ``emit(window)`` gets finished ones;
    a window is a list of (document, start, ids, document's tokens)."""

    def __init__(self, size: int, open_windows: int, min_cut: int, emit):
        self.size, self.most, self.min_cut, self.emit = size, open_windows, min_cut, emit
        self.windows: list[list] = []
        self.filled: list[int] = []

    def document(self, doc, ids: np.ndarray) -> None:
        at, n = 0, len(ids)
        while n - at >= self.size:
            self.emit([(doc, at, ids[at:at + self.size], n)])
            at += self.size
        if at < n:
            self.piece(doc, at, ids[at:], n)

    def piece(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids):
            n = len(ids)
            fits = [(self.size - f, i) for i, f in enumerate(self.filled) if f + n <= self.size]
            if fits:
                i = min(fits)[1]
            elif len(self.windows) < self.most:
                self.windows.append([])
                self.filled.append(0)
                i = len(self.windows) - 1
            else:
                i = max(range(len(self.filled)), key=self.filled.__getitem__)
                gap = self.size - self.filled[i]
                if gap >= self.min_cut:
                    self.windows[i].append((doc, start, ids[:gap], total))
                    start, ids = start + gap, ids[gap:]
                self._close(i)
                continue
            self.windows[i].append((doc, start, ids, total))
            self.filled[i] += n
            if self.filled[i] == self.size:
                self._close(i)
            return

    def _close(self, i: int) -> None:
        self.emit(self.windows.pop(i))
        self.filled.pop(i)

    def leftover(self) -> list:
        """Merge the open windows; at most one part-filled window remains."""
        rest = sorted((p for w in self.windows for p in w), key=lambda p: -len(p[2]))
        self.windows, self.filled, self.most = [], [], 1
        for p in rest:
            self.piece(*p)
        return self.windows[0] if self.windows else []


def _writer(size: int, open_windows: int, min_cut: int, keep_ids: bool, round_no: int, last: bool, feed):
    """The task function: ``feed(batches)`` yields (document, start or None, ids, tokens)."""
    def run(batches):
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        base, count, rows = (round_no << 56) | (task << 32), 0, []

        def emit(window, done=True):
            nonlocal count
            at = 0
            for doc, start, ids, total in window:
                keep = ids.astype("<u4").tobytes() if keep_ids or not done else None
                rows.append((doc, start, len(ids), digest(ids), total, base + count if done else None,
                             at if done else None, keep, None if done else task))
                at += len(ids)
            count += done

        packer = Packer(size, open_windows, min_cut, emit)
        for doc, start, ids, total in feed(batches):
            if start is None:
                packer.document(doc, ids)
            else:
                packer.piece(doc, start, ids, total)
            if len(rows) >= 4096:
                yield rows[:]
                rows.clear()
        emit(packer.leftover(), done=last)
        if rows:
            yield rows
    return run


def _to_arrow(fn, id_type: pa.DataType):
    types = [id_type, *[pa.int64()] * 6, pa.binary(), pa.int32()]
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "part"]

    def run(batches):
        for rows in fn(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    return run


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", size: int = 2048,
         end_id: int = 1, open_windows: int = 64, min_cut: int = 8, keep_ids: bool = True) -> DataFrame:
    """One row per piece: id, ``start`` (its document's ids before it), ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and, with
    ``keep_ids``, ``ids`` (little-endian unsigned 32-bit).

    A null or empty text is its end id alone. Repeated rows and ids are packed
    each. An empty table gives no rows. Other columns are not read, so their
    names don't matter. Pieces of one sequence have offsets without gaps from 0.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    bounded_batches(spark)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind, id_type = source.schema["id"].dataType.simpleString(), to_arrow_type(source.schema["id"].dataType)

    def texts(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder.of(vocabulary)
        end = np.asarray([end_id], np.uint32)
        for b in batches:
            ids, at = encoder.encode(b.column(1))
            for doc, x, y in zip(b.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                yield doc, None, np.concatenate((ids[x:y], end)), 0

    def pieces(batches):
        for b in batches:
            names = b.schema.names
            cols = [b.column(names.index(c)).to_pylist() for c in ("id", "start", "ids", "doc_tokens")]
            for doc, start, ids, total in zip(*cols):
                yield doc, start, np.frombuffer(ids, "<u4"), total

    def one_round(frame, feed, number, last):
        fn = _to_arrow(_writer(size, open_windows, min_cut, keep_ids, number, last, feed), id_type)
        return materialize(frame.mapInArrow(fn, f"id {kind}, {_OUT}"), f"pack-{number}")

    rounds = [one_round(source, texts, 0, False)]
    while True:
        left = rounds[-1].where("sequence_id IS NULL")
        parts = left.agg(F.countDistinct("part")).first()[0]  # one number
        if not parts:
            break
        tasks = -(-parts // FAN_IN)
        # `part % tasks` deals the leftover windows evenly; one task at the end holds FAN_IN windows at most
        left = left.repartition(tasks, F.col("part") % tasks) if tasks > 1 else left.coalesce(1)
        rounds.append(one_round(left, pieces, len(rounds), tasks == 1))
        if tasks == 1:
            break
    out = reduce(DataFrame.unionByName, (r.where("sequence_id IS NOT NULL") for r in rounds))
    keep = [F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(*keep, *(["ids"] if keep_ids else []))
