"""Jaccard join of word n-gram sets as a metric-space join, exact and in regions.

Jaccard distance d is a metric, and documents link when d <= r = 0.2. Far apart
as almost all documents are (d = 1), document pivots alone would tell nothing,
so the space is cut twice:

* **Voronoi regions.** The first pivots are the one-shingle sets {s}: d(X, {s})
  is 1 - 1/|X| if X holds s, else 1, so X is nearest to the pivots it holds,
  ties broken by one global order of shingles (frequent ones last). If
  d(X, Y) <= r, the two share at least ceil(0.8 |X|) shingles, so one of the
  first |X| - ceil(0.8 |X|) + 1 of X in that order is among the first of Y. X is
  therefore replicated to just those regions: no linked pair is lost, and no
  other region need see X. If the first shingle that X and Y share is the j-th of
  X, they share |X| - j + 1 at most, which bounds |Y|: X meets only members of the
  region whose sizes are within its bound, and it within theirs.
* **Document pivots.** Within a region, one document is the pivot and the others
  are compared with it. It is chosen in two steps, per batch of documents and
  then among those batch pivots, so a region that a third of all documents share
  sends one entry per batch and is never in one task. Members within r of their
  pivot are connected, which settles most regions without a pair among their
  members. In a region that still holds several components, the few members
  nearest to those they link with become pivots for all others, and finally the
  pairs left are compared. A round's links are merged into components before the next round looks
  for what is left.
* **Triangle-inequality windows.** |X D Y|, the size of the symmetric difference,
  is a metric too. Each class carries its distances to the parts of a fixed
  division of all shingles (how many of each it holds; the division is halved
  until a part holds eight of its shingles or so); by the triangle inequality
  these differ by |X D Y| in sum at most. A pair outside the window that d <= r
  leaves open is dropped on its sizes and these numbers alone. What is left is
  compared exactly, on the whole sets.

Documents of equal sets are one class from the start, and copies are never
compared.

Shingles are 64-bit hashes; sets are told apart by 128 bits and their size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, lower_ascii, mix, ragged, shingle_hashes, span_hashes, text_buffer, word_spans
from wardflow.session import discard, materialize, scratch_path

WIDTH = 5
#: Linked: 100 |X n Y| >= PERCENT |X u Y|.
PERCENT = 80
#: Shingles put last in the order: the most frequent ones, at most so many
#: (16 bytes each, sent to the executors). Any such list gives the same result.
FREQUENT = 1 << 18
#: Parts of the shingle space, for the windows: 2^LEAST_BITS at least.
LEAST_BITS = 7
#: Bytes of one Arrow batch: some forty bytes of arrays are held for each of them.
SET_BATCH_BYTES = 1 << 19
#: Region entries (24 bytes) that one group of the second step holds, about.
GROUP_ENTRIES = 250_000
#: Pivots of a region and size class in the second round.
HUBS = 8
#: Sizes in one size class differ by this factor at most.
SIZE_CLASS = 1.12
#: Bits of the filter that keeps uninvolved documents from the second reading.
FILTER_BITS = 1 << 25


def _sets(column: pa.Array) -> list[np.ndarray]:
    data, offsets = text_buffer(column)
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, offsets)
    return shingle_hashes(span_hashes(data, starts, ends), first, WIDTH)


def _keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit hashes of each set."""
    first = np.asarray([mix(u + np.uint64(0x1B873593)).sum(dtype=np.uint64) for u in sets], np.uint64)
    second = np.asarray([mix(mix(u) ^ np.uint64(0x94D049BB133111EB)).sum(dtype=np.uint64) for u in sets], np.uint64)
    return first.view(np.int64), second.view(np.int64)


def frequent_shingles(texts: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts), sorted by hash, of shingles that many documents share:
    those in two or more documents of one batch, the most frequent first."""
    def run(batches):
        for b in batches:
            sets = _sets(b.column(0))
            key, n = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_counts=True)
            some = n >= 2
            yield pa.RecordBatch.from_arrays([pa.array(key[some].view(np.int64)), pa.array(n[some])], ["s", "n"])

    rows = (texts.mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "s").limit(most).toPandas())
    keys = rows["s"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows["n"].to_numpy(np.int64)[order]


def _prefix(u: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The regions of a set: its first shingles, rare ones before frequent ones."""
    n = len(u)
    size = n - (PERCENT * n + 99) // 100 + 1 if n else 0
    if n and len(frequent):
        at = np.minimum(np.searchsorted(frequent, u), len(frequent) - 1)
        common = frequent[at] == u
        if common.any():
            return u[np.lexsort((u, np.where(common, counts[at], 0)))[:size]]
    return u[:size]


def _partner(n: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The greatest size of a set that links with one of ``n`` shingles, if the first
    shingle they share is at ``place`` (from 0) of the latter."""
    return np.minimum(((100 + PERCENT) * (n - place) - PERCENT * n) // PERCENT, 100 * n // PERCENT)


def _parts(u: np.ndarray) -> np.ndarray:
    """How many shingles lie in each part; parts are the leading bits of the hash."""
    bits = max(LEAST_BITS, int(max(len(u) - 1, 1) // 8).bit_length())
    return np.bincount((u >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.int16)


def connected(edges: DataFrame, name: str) -> DataFrame:
    """(node, label) for all nodes of ``edges`` (a, b): the least node reachable.
    Each round takes the least label around and then the label's own label; a
    round is stored before the next, and the loop ends when nothing changes."""
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}-labels")
    while True:
        near = (both.join(labels.toDF("b", "l"), "b").groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l"))
                .join(labels, "node").select("node", "label", F.least("l", "label").alias("l")))
        jump = near.join(labels.toDF("l", "ll"), "l", "left").select("node", "label", F.least("l", F.coalesce("ll", "l")).alias("next"))
        step = materialize(jump, f"{name}-labels")
        if step.where(F.col("next") < F.col("label")).isEmpty():
            return step.select("node", "label")
        labels = step.select("node", F.col("next").alias("label"))


def _spare(shared: Column, a: Column, b: Column) -> Column:
    """How far two sets are from the border of being linked: not below 0 if they are."""
    return 100 * shared - PERCENT * (a + b - shared)


class _Space:
    """The classes, their regions, and exact comparison of pairs of classes."""

    def __init__(self, texts: DataFrame):
        bounded_batches(texts.sparkSession, SET_BATCH_BYTES)
        self.spark: SparkSession = texts.sparkSession
        self.texts = texts  # id, text, h
        kind = texts.schema["id"].dataType.simpleString()
        shared = self.spark.sparkContext.broadcast(frequent_shingles(texts.select("text")))  # FREQUENT entries at most

        def run(batches):
            frequent, counts = shared.value
            for b in batches:
                sets = _sets(b.column(1))
                k1, k2 = _keys(sets)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), pa.array([len(u) for u in sets], pa.int64()), pa.array(k1), pa.array(k2),
                     ragged([_prefix(u, frequent, counts) for u in sets]),
                     ragged([_parts(u) for u in sets], pa.int16())],
                    ["id", "h", "n", "k1", "k2", "regions", "parts"])

        rows = materialize(texts.mapInArrow(
            run, f"id {kind}, h long, n long, k1 long, k2 long, regions array<long>, parts array<smallint>"), "jaccard-rows",
            wide := scratch_path(self.spark, "jaccard-rows"))
        self.rows = materialize(rows.drop("regions", "parts"), "jaccard-ids")
        classes = rows.where("n > 0").groupBy("n", "k1", "k2").agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("least"), F.count(F.lit(1)).alias("copies"),
            F.first("regions").alias("regions"), F.first("parts").alias("parts"))
        self.classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()), "jaccard-classes")
        discard(self.spark, wide)
        scratch = scratch_path(self.spark, "jaccard-entries"), scratch_path(self.spark, "jaccard-between")
        inside, between = self._regions(*scratch)
        both = inside.union(between)
        meet = both.where("pn <= u AND n <= pu")
        self.first = materialize(meet.select(*_pairs("cls", "pivot", "n", "pn")).distinct(), "jaccard-candidates")
        self.members = materialize(both.select("s", "cls", "n", "u").union(both.select("s", "pivot", "pn", "pu")).distinct(), "jaccard-members")
        for path in scratch:
            discard(self.spark, path)

    def _regions(self, entries_path: str, between_path: str) -> tuple[DataFrame, DataFrame]:
        """(s, cls, n, u, pivot, pn, pu): of the members of each region within a batch,
        and of the batch pivots of each region; ``n`` is the size, ``u`` the bound on
        sizes that it can link with there. Both come from one reading, stored once:
        another reading may cut other batches, with other pivots."""
        listed = self.classes.select("cls", "n", "regions")
        total = self.classes.agg(F.sum(F.size("regions"))).first()[0] or 0
        buckets = max(1, -(-int(total) // GROUP_ENTRIES))

        def unpacked(size: np.ndarray) -> list[pa.Array]:
            return [pa.array(size >> 32), pa.array(size & 0xFFFFFFFF)]

        def entries(batches):
            for b in batches:
                sizes = np.diff(np.asarray(b.column(2).offsets))
                cls, n = np.repeat(np.asarray(b.column(0)), sizes), np.repeat(np.asarray(b.column(1)), sizes)
                regions = np.asarray(b.column(2).flatten())
                place = np.arange(len(regions)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                size = n << 32 | _partner(n, place)
                order = np.lexsort((cls, regions))
                cls, regions, size = cls[order], regions[order], size[order]
                head = np.concatenate(([True], regions[1:] != regions[:-1])) if len(regions) else np.zeros(0, bool)
                at = np.flatnonzero(head)[np.cumsum(head) - 1] if len(cls) else np.zeros(0, np.int64)
                rest, none = ~head, pa.nulls(int((~head).sum()), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(regions[rest]), pa.array(cls[rest]), *unpacked(size[rest]), pa.array(cls[at][rest]),
                                                  *unpacked(size[at][rest]), none, pa.nulls(len(none), pa.binary())], names)
                regions, cls, size = regions[head], cls[head], size[head]
                to = mix(regions.view(np.uint64)) % np.uint64(buckets)
                order = np.argsort(to, kind="stable")
                entry = np.stack((regions[order], cls[order], size[order]), 1)
                at = np.flatnonzero(np.concatenate(([True], np.diff(to[order]) != 0))) if len(order) else np.zeros(0, np.int64)
                blobs = [x.tobytes() for x in np.split(entry, at[1:])] if len(at) else []
                yield pa.RecordBatch.from_arrays([*[pa.nulls(len(at), pa.int64())] * 7, pa.array(to[order][at].view(np.int64)),
                                                  pa.array(blobs, pa.binary())], names)

        def join_pivots(t: pa.Table) -> pa.Table:
            entry = np.concatenate([np.frombuffer(x.as_buffer(), np.int64).reshape(-1, 3) for x in t.column("entries")])
            entry = entry[np.lexsort((entry[:, 1], entry[:, 0]))]
            head = np.concatenate(([True], entry[1:, 0] != entry[:-1, 0]))
            pivot = entry[np.flatnonzero(head)[np.cumsum(head) - 1]][~head]
            entry = entry[~head]
            return pa.table([pa.array(entry[:, 0]), pa.array(entry[:, 1]), *unpacked(entry[:, 2]), pa.array(pivot[:, 1]), *unpacked(pivot[:, 2])], names[:7])

        names = ["s", "cls", "n", "u", "pivot", "pn", "pu", "bucket", "entries"]
        schema = ", ".join(f"{c} long" for c in names[:7])
        stored = materialize(listed.mapInArrow(entries, f"{schema}, bucket long, entries binary"), "jaccard-entries", entries_path)
        between = stored.where("bucket IS NOT NULL").select("bucket", "entries").groupBy("bucket").applyInArrow(join_pivots, schema)
        return stored.where("bucket IS NULL").select(*names[:7]), materialize(between, "jaccard-between", between_path)

    def _sets_of(self, wanted: DataFrame, path: str) -> DataFrame:
        """(cls, u): the whole sets of the classes ``wanted`` (cls), by a second
        reading, stored at ``path``."""
        involved = wanted.join(self.classes.select("cls", "n", "k1", "k2"), "cls")
        bit = F.pmod("k1", F.lit(FILTER_BITS))
        words = involved.groupBy(F.floor(bit / 32).cast("int").alias("w")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(k1, {FILTER_BITS}) % 32 as int))")).alias("bits")).toPandas()  # FILTER_BITS / 32 rows at most
        table = np.zeros(FILTER_BITS // 32, np.uint64)
        table[words["w"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint64)
        shared = self.spark.sparkContext.broadcast(table)

        def run(batches):
            for b in batches:
                sets = _sets(b.column(0))
                k1, k2 = _keys(sets)
                place = k1 % FILTER_BITS
                keep = (shared.value[place // 32] >> (place % 32).astype(np.uint64)) & np.uint64(1) == 1
                seen: dict = {}
                for i in np.flatnonzero(keep).tolist():
                    seen.setdefault((int(k1[i]), int(k2[i])), i)  # copies in one batch go once
                at = [i for i in seen.values() if len(sets[i])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(sets[i]) for i in at], pa.int64()), pa.array(k1[at]), pa.array(k2[at]), ragged([sets[i] for i in at])],
                    ["n", "k1", "k2", "u"])

        read = self.texts.select("text").mapInArrow(run, "n long, k1 long, k2 long, u array<long>")
        return materialize(read.groupBy("n", "k1", "k2").agg(F.first("u").alias("u")).join(involved, ["n", "k1", "k2"])
                           .select("cls", "u"), "jaccard-sets", path)

    def compare(self, pairs: DataFrame, name: str) -> DataFrame:
        """(a, b, linked, spare) of distinct pairs of classes, a < b, with their sizes na
        and nb: first by the window, then, if the window leaves it open, by the whole sets."""
        parts = self.classes.select("cls", "parts")
        seen = pairs.join(parts.toDF("a", "pa"), "a").join(parts.toDF("b", "pb"), "b")

        def coarse(p, other):  # sizes of a pair are one halving apart at most
            halved = F.transform(F.sequence(F.lit(0), (F.size(p) / 2 - 1).cast("int")),
                                 lambda i: (F.get(p, 2 * i) + F.get(p, 2 * i + 1)).cast("smallint"))
            return F.when(F.size(p) > F.size(other), halved).otherwise(F.col(p))
        apart = F.aggregate(F.zip_with(coarse("pa", "pb"), coarse("pb", "pa"), lambda x, y: F.abs(x - y).cast("int")),
                            F.lit(0), lambda acc, d: acc + d)
        # |X D Y| >= apart, so |X n Y| <= (|X| + |Y| - apart) / 2
        most = F.floor((F.col("na") + F.col("nb") - apart) / 2)
        seen = materialize(seen.select("a", "b", "na", "nb", (_spare(most, F.col("na"), F.col("nb")) >= 0).alias("open")), name)
        near, shut = seen.where("open"), seen.where("NOT open").select("a", "b", F.lit(False).alias("linked"), F.lit(None).cast("long").alias("spare"))
        if near.isEmpty():
            return shut
        path = scratch_path(self.spark, "jaccard-sets")
        full = self._sets_of(near.select(F.col("a").alias("cls")).union(near.select("b")).distinct(), path)
        near = near.join(full.toDF("a", "ua"), "a").join(full.toDF("b", "ub"), "b")
        shared = F.size(F.array_intersect("ua", "ub")).cast("long")
        near = near.select("a", "b", _spare(shared, F.col("na"), F.col("nb")).alias("spare")).select("a", "b", (F.col("spare") >= 0).alias("linked"), "spare")
        compared = materialize(near.union(shut), name)
        discard(self.spark, path)
        return compared


def _pairs(x: str, y: str, nx: str, ny: str) -> list[Column]:
    first = F.col(x) < F.col(y)
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b"),
            F.when(first, F.col(nx)).otherwise(F.col(ny)).alias("na"), F.when(first, F.col(ny)).otherwise(F.col(nx)).alias("nb")]


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n) / F.log(F.lit(SIZE_CLASS)))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``h`` (hash of its text), ``n`` (shingles) and
    ``least``, the (id, h) of the least id reachable by links, null if it has no links.

    Null, empty and blank texts have no shingle and are a component of their own.
    A text of fewer than five words has one, of all its words. Rows with equal
    sets are linked whatever their ids, repeated rows too; a null id is never the
    least one (a component of null ids only has null). An empty table gives no
    rows, and other columns are not read.
    """
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"))
    space = _Space(texts)
    members = space.members
    first = space.compare(space.first, "jaccard-first")
    tested, links = first, first.where("linked").select("a", "b", "spare")
    for step in ("hubs", "rest"):
        labels = connected(links, f"jaccard-{step}")
        held = members.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select("s", "cls", "n", "u", F.coalesce("label", "cls").alias("label"))
        open_regions = held.groupBy("s").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.min("n").alias("low")).where("x < y").select("s", "low")
        held = materialize(held.join(open_regions, "s").where("u >= low").select("s", "cls", "n", "u", "label"), f"jaccard-open-{step}")
        if held.isEmpty():
            break
        sized = held.withColumn("w", _size_class(F.col("n")))
        if step == "hubs":  # the members of the region and size class that are nearest to those they link with
            nearness = links.select(F.explode(F.array("a", "b")).alias("cls"), "spare").groupBy("cls").agg(F.avg("spare").alias("spare"))
            rank = F.row_number().over(Window.partitionBy("s", "w").orderBy(F.desc("spare"), "cls"))
            other = sized.join(nearness, "cls").withColumn("r", rank).where(F.col("r") <= HUBS)
            other = other.select("s", "w", F.col("cls").alias("y"), F.col("n").alias("ny"), F.col("u").alias("uy"), F.col("label").alias("ly"))
            order = "label <> ly"
        else:  # what is left between components, from the greater set to the lesser
            lesser = F.sequence(_size_class(F.ceil(F.col("n") * PERCENT / 100)), _size_class(F.least("n", "u")))
            other = sized.select("s", F.explode(lesser).alias("w"), F.col("cls").alias("y"), F.col("n").alias("ny"), F.col("u").alias("uy"), F.col("label").alias("ly"))
            order = "label <> ly AND n <= ny"
        pairs = sized.join(other, ["s", "w"]).where(f"{order} AND n <= uy AND ny <= u").select(*_pairs("cls", "y", "n", "ny"))
        pairs = pairs.distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti")
        found = space.compare(pairs, f"jaccard-{step}")
        tested = tested.union(found)
        links = links.union(found.where("linked").select("a", "b", "spare"))
    labels = connected(links, "jaccard-last")
    named = space.classes.select("cls", "n", "k1", "k2", "least", "copies").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    alone = named.where("label IS NULL AND copies > 1").select("n", "k1", "k2", F.col("least").alias("component"))
    groups = named.where("label IS NOT NULL")
    groups = groups.join(groups.groupBy("label").agg(F.min("least").alias("component")), "label").select("n", "k1", "k2", "component")
    named = materialize(alone.union(groups), "jaccard-components")
    return space.rows.join(named, ["n", "k1", "k2"], "left").select("id", "h", "n", F.col("component").alias("least"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``component_id`` (see ``groups``)."""
    found = groups(docs, id_col, text_col)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                        F.when(F.col("least").isNotNull(), F.col("least.id")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the least id (of rows with
    one id, that of the least text hash; of wholly repeated rows, any). Rows without a
    shingle stay as they are."""
    same = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("h") == F.col("least.h"))
    acts = groups(docs, id_col, text_col).where("least IS NOT NULL").groupBy("id", "h").agg(
        F.max(same).alias("__stays"), F.count(F.lit(1)).alias("__rows")).where("NOT __stays OR __rows > 1")
    acts = materialize(acts, "jaccard-verdicts")
    names = docs.columns
    held = docs.toDF(*[f"c{i}" for i in range(len(names))])  # whatever they are called
    key, text = f"c{names.index(id_col)}", F.col(f"c{names.index(text_col)}").cast("string")
    held = held.withColumn("own", F.xxhash64(F.coalesce(text, F.lit(""))))
    judged = held.join(acts, F.col(key).eqNullSafe(F.col("id")) & (F.col("own") == F.col("h")), "left")
    once = judged.where("__stays").dropDuplicates([key, "own"])
    return judged.where("__stays IS NULL").unionByName(once).drop("own", "id", "h", "__stays", "__rows").toDF(*names)
