"""Vector code compression: product quantisation with exact integer arithmetic,
nearest entries found by slice and intersect.

A vector is cut into equal consecutive parts; every part position has a codebook
of a few entries, fitted by rounds of assignment and replacement by the mean.

**Nearest entry.** Per dimension of a part the entries' coordinates are sorted,
and the place j in that order carries a mask of the entries before it (bit e of a
uint64 word is entry e). A part takes the squared distance to one seed entry as
its initial radius; an entry at most that far away lies within the radius in every
dimension. Two binary searches a dimension give the slice of such entries as the
upper prefix mask without the lower one, the masks of all dimensions are ANDed, and
only the entries left are compared exactly. The nearest entry is always among
them, since the seed is, so the result is that of a full comparison.

**Spark.** A round is one scan: tasks add up their parts by entry and send
parts x entries x dimensions numbers, which one aggregation sums. The driver holds
the codebooks, of that same size whatever the table's.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches
from wardflow.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
_WORD = 64


def _floor_root(square: np.ndarray) -> np.ndarray:
    """floor(sqrt(square)) of non-negative integers, exactly."""
    root = np.sqrt(square.astype(np.float64)).astype(np.int64)
    root -= root * root > square
    return root + ((root + 1) * (root + 1) <= square)


@dataclass
class Slices:
    """One part position's entries, (entries, dimensions), ready for the search."""

    entries: np.ndarray
    coords: list[np.ndarray] = field(init=False)
    masks: list[np.ndarray] = field(init=False)
    widest: int = field(init=False)
    order: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n, dims = self.entries.shape
        words = -(-n // _WORD)
        self.coords, self.masks = [], []
        for d in range(dims):
            order = np.argsort(self.entries[:, d], kind="stable")
            own = np.zeros((n + 1, words), np.uint64)
            own[np.arange(1, n + 1), order // _WORD] = np.uint64(1) << (order % _WORD).astype(np.uint64)
            self.coords.append(self.entries[order, d])
            self.masks.append(np.bitwise_or.accumulate(own, axis=0))
        spread = [int(c[-1]) - int(c[0]) for c in self.coords]
        self.widest = int(np.argmax(spread)) if dims else 0
        self.order = np.argsort(self.entries[:, self.widest], kind="stable") if dims else np.arange(n)

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """(rows, words): the masks of the entries within each row's radius in all dimensions."""
        at = self.coords[self.widest]
        place = np.searchsorted(at, x[:, self.widest])
        left, right = np.maximum(place - 1, 0), np.minimum(place, len(at) - 1)
        nearer = np.abs(x[:, self.widest] - at[left]) <= np.abs(x[:, self.widest] - at[right])
        seed = self.order[np.where(nearer, left, right)]
        radius = _floor_root(((x - self.entries[seed]) ** 2).sum(1))
        found = np.full((len(x), self.masks[0].shape[1]), ~np.uint64(0))
        for d, (coords, masks) in enumerate(zip(self.coords, self.masks)):
            low = np.searchsorted(coords, x[:, d] - radius, "left")
            high = np.searchsorted(coords, x[:, d] + radius, "right")
            found &= masks[high] & ~masks[low]
        return found

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest entry (ties to the lower index) and its squared distance."""
        best, error = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
        if not x.shape[1]:
            return best, np.zeros(len(x), np.int64)
        found = self.candidates(x)
        for e in range(len(self.entries)):
            rows = np.flatnonzero((found[:, e // _WORD] >> np.uint64(e % _WORD)) & np.uint64(1))
            far = ((x[rows] - self.entries[e]) ** 2).sum(1)
            less = far < error[rows]
            best[rows[less]], error[rows[less]] = e, far[less]
        return best, error


@dataclass
class Codebooks:
    """``entries``: (parts, entries, dimensions of a part), integers; ``dims``: length of the vectors."""

    entries: np.ndarray
    dims: int

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _integers(column: pa.Array, dims: int, parts: int) -> np.ndarray:
    """(rows, parts, dimensions of a part) of a list column; see ``bound``."""
    flat = np.asarray(column.flatten(), np.float64).reshape(len(column), dims)
    most = bound(dims)
    whole = np.clip(np.floor(flat * SCALE), -most, most).astype(np.int64)
    short = -dims % parts
    return np.pad(whole, ((0, 0), (0, short))).reshape(len(column), parts, (dims + short) // parts)


def bound(dims: int) -> int:
    """Integer components are held at +-bound: the largest at which no vector's
    squared distance exceeds a long (for 64 dimensions those of |x| >= 32,768)."""
    return int((2 ** 62 // max(dims, 1)) ** 0.5) // 2


def usable(vectors: DataFrame, id_col: str, vector_col: str, keep: dict[str, str]) -> DataFrame:
    """(id, vector, the columns ``keep`` under new names) of vectors without null or
    non-finite components."""
    held = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector"),
                          *[F.col(f"`{c}`").alias(name) for c, name in keep.items()])
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return held.where(F.col("vector").isNotNull() & finite)


def _start(rows: DataFrame, entries: int) -> np.ndarray | None:
    """The vectors of the smallest ids, ascending: ids first, so that each partition
    sends ``entries`` ids, and rows only up to the last of these."""
    last = rows.select("id").where("id IS NOT NULL").orderBy("id").limit(entries).agg(F.max("id")).first()[0]
    first = rows if last is None else rows.where(F.col("id") <= F.lit(last))
    got = first.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()  # ``entries`` rows
    if not got:
        return None
    dims = len(got[0][0])
    same = [r[0] for r in got if len(r[0]) == dims]
    return np.asarray(same, np.float64).reshape(len(same), dims)


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS,
        entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks from all usable vectors; None if there are none.

    Each position's codebook starts as that part of the vectors of the ``entries``
    smallest ids (repeated ids: least vector first; null ids last). A round assigns
    all vectors and replaces each entry by its parts' floor(sum / count); unused
    entries stay. All vectors have the length of the first; others are left out. A
    length that ``parts`` doesn't divide is filled up with zeros.
    """
    if not 1 <= entries <= 256:
        raise ValueError("codes have two hex digits: 1 to 256 entries")
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = usable(vectors, id_col, vector_col, {})
    first = _start(rows, entries)
    if first is None:
        return None
    dims = first.shape[1]
    column = pa.array(list(first), pa.list_(pa.float64()))
    books = _integers(column, dims, parts).transpose(1, 0, 2).copy()
    rows = rows.where(F.size("vector") == dims).select("vector")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)  # parts x entries x dimensions numbers

        def run(batches):
            held = shared.value
            slices = [Slices(b) for b in held]
            total, count = np.zeros(held.shape, np.int64), np.zeros(held.shape[:2], np.int64)
            for b in batches:
                x = _integers(b.column(0), dims, parts)
                for p, s in enumerate(slices):
                    best, _ = s.nearest(x[:, p])
                    np.add.at(total[p], best, x[:, p])
                    count[p] += np.bincount(best, minlength=len(count[p]))
            p, e = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p), pa.array(e), pa.array(count[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))], ["p", "e", "n", "t"])

        sums = (rows.mapInArrow(run, "p long, e long, n long, t array<long>")
                .select("p", "e", "n", F.posexplode("t")).groupBy("p", "e", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("t")))
        new = books.copy()
        for r in sums.collect():  # parts x entries x dimensions rows at most
            new[r.p, r.e, r.pos] = r.t // r.n
        shared.unpersist()
        if (new == books).all():
            break  # the rounds left would change nothing
        books = new
    return Codebooks(books, dims)


def encode(vectors: DataFrame, books: Codebooks | None, id_col: str = "vec_id", vector_col: str = "embedding",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per usable vector of the codebooks' length: ``id``, ``code`` (entry
    indexes in part order, two hex digits each), ``error`` (squared distance to the
    vector that the code stands for) and the columns ``keep`` as k0, k1, ...

    Other columns are not read, whatever their names. Without codebooks, or from an
    empty table, there are no rows. Vectors of no components have the code of
    zeros and no error.
    """
    rows = usable(vectors, id_col, vector_col, {c: f"k{i}" for i, c in enumerate(keep)})
    names = ["id", *[f"k{i}" for i in range(len(keep))]]
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)
    if books is None:
        return rows.where("false").selectExpr(*names, "'' AS code", "0L AS error")
    spark = vectors.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(books)

    def run(batches):
        held = shared.value
        slices = [Slices(b) for b in held.entries]
        digits = np.asarray([f"{e:02x}" for e in range(256)], "S2")
        for b in batches:
            x = _integers(b.column(b.num_columns - 1), held.dims, len(slices))
            code, error = np.zeros((b.num_rows, len(slices)), np.int64), np.zeros(b.num_rows, np.int64)
            for p, s in enumerate(slices):
                code[:, p], far = s.nearest(x[:, p])
                error += far
            text = digits[code].view(f"S{2 * len(slices)}")[:, 0].astype(str) if b.num_rows else []
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(text, pa.string()), pa.array(error)], [*names, "code", "error"])

    wanted = rows.where(F.size("vector") == books.dims).select(*names, "vector")
    return wanted.mapInArrow(run, f"{schema}, code string, error long")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label") -> DataFrame:
    """``fit`` and ``encode`` with the defaults, and ``label_error``, the error
    summed over equal ``group_col`` (nulls together; null if it exceeds a long). One
    row per usable vector, repeated rows included."""
    books = fit(vectors, id_col, vector_col)
    rows = materialize(encode(vectors, books, id_col, vector_col, (group_col,)), "vector-codes")
    total = materialize(rows.groupBy(F.col("k0").alias("g")).agg(F.expr("try_sum(error)").alias("label_error")), "vector-groups")
    return rows.join(total, rows["k0"].eqNullSafe(total["g"])).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.sha256 if books else "").alias("codebooks_sha256"))
