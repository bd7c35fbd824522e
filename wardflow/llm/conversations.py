"""Conversation structure repair: the cheapest edits that make the roles of a
conversation read (system)? (user assistant)+, or nothing at all.

**Cost DP.** A node is (row, state); the state says what the repaired rows so far
end in (nothing, a system row, a user row, an assistant row). Arcs are the edits:
Keep, Rerole, Delete and Insert, with their letters and costs. Least costs to the
end are found backwards, row by row.

**Prefix-doubling path ranking.** Arcs on some cheapest path are the optimal ones.
Nodes are ranked by the least letter of an optimal arc, then, as two ranks of a length
make the rank of twice the length, by the least audit of 2, 4, 8, ... letters,
until all audits are at their end. At each node the arc of the least letter and rank
behind it is taken, and the path is unrolled through doubled pointers: the nodes at
multiples of 2^k, then those of 2^(k-1) between them.

**Long conversations.** Rows are range-partitioned by conversation and turn, so
one conversation may span many tasks. A task cuts its rows into segments of at most
SEGMENT rows. A conversation of one segment is solved at once; else each segment
gives its min-plus matrix of four states by four, a chain over these (one per
segment) gives the costs behind every segment, each segment is solved for all four
states it may be entered in, and a second chain picks them. Arcs out of a node bear
different letters, so what is behind a segment's end never decides between them.

The repaired rows then pass a task in order, conversation by conversation, as a
stream: SHA-256 has no other order. No conversation's rows are ever held together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wardflow.llm.common import bounded_batches
from wardflow.session import materialize

#: Letters in ASCII order; letter 0 stands for the end.
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED = 1  # for a truncated row that stays
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant row is put behind a state, whichever fits.
NEXT = (USER, USER, ASSISTANT, USER)
FAULTS = ("", "blank", "duplicate", "truncated")
SEGMENT = 1 << 15
#: Rows of short segments that are solved together.
TOGETHER = 1 << 14
_FAR = 1 << 50
_SPACES = " \t\n\x0b\x0c\r"


# ------------------------------------------------------------- costs, ranks, paths

def costs_behind(codes: bytes, end: tuple[int, ...], final: bool) -> np.ndarray:
    """(rows + 1, 4): least cost from each node to the end, given those at the end.
    A row's code is its role's initial (1 s, 2 u, 3 a) plus 4 times its fault."""
    out = [0] * (4 * len(codes) + 4)
    d0, d1, du, da = end
    if final:
        du = min(du, COST[INSERT] + da)
        d0, d1 = min(d0, COST[INSERT] + du), min(d1, COST[INSERT] + du)
    out[-4:] = d0, d1, du, da
    at = 4 * len(codes)
    for code in reversed(codes):
        at -= 4
        fault, initial = code >> 2, code & 3
        b0, b1, bu, ba = 3 + d0, 3 + d1, 3 + du, 3 + da
        if fault not in (1, 2):
            stays = TRUNCATED if fault == 3 else 0
            user = du + stays + (0 if initial == 2 else 2)
            assistant = da + stays + (0 if initial == 3 else 2)
            b0, b1, bu, ba = min(b0, user), min(b1, user), min(bu, assistant), min(ba, user)
            if initial == 1:
                b0 = min(b0, d1 + stays)
        du, da = min(bu, 2 + ba), min(ba, 2 + bu)
        d0, d1 = min(b0, 2 + du), min(b1, 2 + du)
        out[at:at + 4] = d0, d1, du, da
    return np.minimum(np.asarray(out, np.int64).reshape(-1, 4), _FAR)


def optimal_arcs(codes: np.ndarray, behind: np.ndarray, may_insert: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(source, letter, target) of the arcs on cheapest paths. Positions of several
    segments stand one after another; ``codes`` is -1 at a segment's end."""
    source, letter, target = [], [], []

    def add(rows: np.ndarray, state: int, edit: int, to: int, step: int, extra) -> None:
        reached = behind[rows + step, to]
        best = rows[(behind[rows, state] == reached + COST[edit] + extra) & (reached < _FAR)]
        source.append(4 * best + state)
        target.append(4 * (best + step) + to)
        letter.append(np.full(len(best), edit))

    some, fault, initial = np.flatnonzero(codes >= 0), codes >> 2, codes & 3
    stays = some[(fault[some] != 1) & (fault[some] != 2)]
    inserts = np.flatnonzero(may_insert)
    for state in range(4):
        to = NEXT[state]
        add(some, state, DELETE, state, 1, 0)
        add(inserts, state, INSERT, to, 0, 0)
        same = initial[stays] == (2 if to == USER else 3)
        for rows, edit in ((stays[same], KEEP), (stays, REROLE)):
            add(rows, state, edit, to, 1, TRUNCATED * (fault[rows] == 3))
    first = stays[initial[stays] == 1]
    add(first, NONE, KEEP, SYSTEM, 1, TRUNCATED * (fault[first] == 3))
    return np.concatenate(source), np.concatenate(letter), np.concatenate(target)


def _least(n: int, at: np.ndarray, value: np.ndarray, empty: int) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, at, value)
    out[out == np.iinfo(np.int64).max] = empty
    return out


def ranked_successors(n: int, source: np.ndarray, letter: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``n`` nodes of an acyclic graph the letter and target of the arc
    on the path of least letters to an end (0 and itself at an end)."""
    least = _least(n, source, letter, 0)
    ends = np.flatnonzero(least == 0)
    first = letter == least[source]
    jump_from, jump_to = np.concatenate((source[first], ends)), np.concatenate((target[first], ends))
    rank = least
    while True:  # rank and jumps are of 2^k letters
        behind = _least(n, jump_from, rank[jump_to], 0)
        stays = rank[jump_to] == behind[jump_from]
        pair = np.stack(np.divmod(np.unique(jump_from[stays] * n + jump_to[stays]), n))
        rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + behind, return_inverse=True)[1].astype(np.int64)
        if (least[pair[1]] == 0).all():
            break
        begin, end = np.searchsorted(pair[0], pair[1], "left"), np.searchsorted(pair[0], pair[1], "right")
        size = end - begin
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
        jump_from, jump_to = np.repeat(pair[0], size), pair[1][inner]
    order = np.lexsort((rank[target], letter, source))
    chosen = order[np.concatenate(([True], source[order][1:] != source[order][:-1]))] if len(order) else order
    successor = np.arange(n)
    successor[source[chosen]] = target[chosen]
    return least, successor


def unrolled(letters: np.ndarray, successor: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The audits from ``starts`` and the ends they reach, through doubled pointers."""
    pointers = [successor]
    while (letters[pointers[-1][starts]] != 0).any():
        pointers.append(pointers[-1][pointers[-1]])
    node, owner = starts[letters[starts] != 0], np.flatnonzero(letters[starts] != 0)
    for pointer in reversed(pointers[:-1]):
        node, owner = np.stack((node, pointer[node]), 1).reshape(-1), np.repeat(owner, 2)
        node, owner = node[letters[node] != 0], owner[letters[node] != 0]
    text, cut = LETTERS[letters[node]], np.searchsorted(owner, np.arange(len(starts) + 1))
    return [text[a:b].tobytes() for a, b in zip(cut, cut[1:])], pointers[-1][starts]


def solve(segments: list[tuple[bytes, tuple[int, ...], bool]], entries: tuple[int, ...]) -> list[tuple[list[bytes], list[int]]]:
    """For each segment (codes, costs at its end, whether it is the last): the least
    cheapest audits from the states ``entries``, and the states they leave it in."""
    codes, behind, inserts, starts, at = [], [], [], [], 0
    for c, end, final in segments:
        own = np.full(len(c) + 1, -1)
        own[:-1] = np.frombuffer(c, np.uint8)
        codes.append(own)
        behind.append(costs_behind(c, end, final))
        inserts.append(np.arange(len(own)) < len(c) + final)
        starts += [4 * at + e for e in entries]
        at += len(own)
    arcs = optimal_arcs(np.concatenate(codes), np.concatenate(behind), np.concatenate(inserts))
    letters, successor = ranked_successors(4 * at, *arcs)
    audits, ends = unrolled(letters, successor, np.asarray(starts))
    k = len(entries)
    return [(audits[i:i + k], (ends[i:i + k] % 4).tolist()) for i in range(0, len(audits), k)]


BASE = (0, _FAR, _FAR, 0)  # a conversation may end with nothing or after an assistant row


def _segment_matrix(codes: bytes) -> list[int]:
    units = [tuple(0 if e == k else _FAR for e in range(4)) for k in range(4)]
    return np.stack([costs_behind(codes, u, False)[0] for u in units], 1).reshape(-1).tolist()


# ------------------------------------------------------------- rows and segments

def damage(conversations: DataFrame) -> DataFrame:
    """Faults put into rows by crc32(conv_id:turn) % 20: 0 drops the row, 1 empties
    its text, 2 removes its [.!?], 3 repeats it, 4 makes its role user."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"),
                                (F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn"))) % 20).alias("k"))
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.where("k <> 0").select(
        "conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (key, turn, role, text, id) with ``code``: role initial and first fault."""
    signed = rows.withColumn("sig", F.sha2(F.concat_ws("\0", "role", "text"), 256))
    again = signed.groupBy("key", "sig").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("turn", "id")).alias("earliest"))
    # stored, so that the join below shuffles both sides and Spark can split a hot one
    again = materialize(again.where("n > 1").drop("n"), "conversation-repeats")
    last = F.right(F.rtrim("text", F.lit(_SPACES)), F.lit(1))
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), 1)
             .when(F.col("earliest").isNotNull() & ~F.struct("turn", "id").eqNullSafe(F.col("earliest")), 2)
             .when(~last.isin(".", "!", "?"), 3).otherwise(0))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    return signed.join(again, ["key", "sig"], "left").select(
        "key", "turn", "role", "text", "id", (initial + 4 * fault).cast("int").alias("code"))


ROWS = "key string, part long, seg long, seq long, turn long, role string, text string, code int, codes binary"


def segmented(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Rows in order, numbered (part, seg, seq), and for each segment one row
    (seq -1) with the codes of its rows."""
    order = [F.col("key"), F.asc_nulls_first("turn"), F.col("role"), F.col("h"), F.col("id")]
    ordered = rows.withColumn("h", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "turn", "role", "text", "code")
    names = [c.split()[0] for c in ROWS.split(", ")]

    def run(batches):
        part, seg, key, codes = TaskContext.get().partitionId(), 0, None, bytearray()

        def closed():
            values = [[key], [part], [seg], [-1], [None], [None], [None], [None], [bytes(codes)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], names)

        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.binary()]
        for b in batches:
            keys, mine = b.column(0).to_pylist(), np.asarray(b.column(4)).tolist()
            segs, seqs, ended = [], [], []
            for k, code in zip(keys, mine):
                if codes and (k != key or len(codes) == size):
                    ended.append(closed())
                    seg, codes = seg + 1, bytearray()
                key = k
                segs.append(seg)
                seqs.append(len(codes))
                codes.append(code)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.string()), pa.array([part] * len(segs), pa.int64()), pa.array(segs, pa.int64()),
                 pa.array(seqs, pa.int64()), b.column(1), b.column(2).cast(pa.string()), b.column(3).cast(pa.string()),
                 b.column(4), pa.nulls(len(segs), pa.binary())], names)
            yield from ended
        if codes:
            yield closed()

    return ordered.mapInArrow(run, ROWS)


def audits(stored: DataFrame) -> DataFrame:
    """(key, part, seg, audit) of all segments of ``stored`` (see ``segmented``)."""
    segs = stored.where("codes IS NOT NULL").select("key", "part", "seg", "codes")
    cut = materialize(segs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "conversation-cut")

    def whole(batches):
        for b in batches:
            codes, got = b.column(3).to_pylist(), {}
            by_size = sorted(range(len(codes)), key=lambda i: len(codes[i]))
            while by_size:  # neighbours in length, so that few rounds of doubling are idle
                now, rows = [], 0
                while by_size and rows < TOGETHER:
                    now.append(by_size.pop())
                    rows += len(codes[now[-1]])
                for i, (audit, _) in zip(now, solve([(codes[i], BASE, True) for i in now], (NONE,))):
                    got[i] = audit[0].decode()
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([got[i] for i in range(len(codes))], pa.string())],
                                             ["key", "part", "seg", "audit"])

    def matrices(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([_segment_matrix(c) for c in b.column(3).to_pylist()], pa.list_(pa.int64()))],
                ["key", "part", "seg", "m"])

    def costs(t: pa.Table) -> pa.Table:  # one entry a segment of the conversation
        t = t.sort_by([("part", "ascending"), ("seg", "ascending")])
        behind = costs_behind(b"", BASE, True)[0]
        ends = []
        for m in reversed(t.column("m").to_pylist()):
            ends.append(behind.tolist())
            behind = np.minimum((np.asarray(m).reshape(4, 4) + behind).min(1), _FAR)
        final = [i == t.num_rows - 1 for i in range(t.num_rows)]
        return pa.table({"part": t.column("part"), "seg": t.column("seg"), "ends": pa.array(ends[::-1], pa.list_(pa.int64())), "final": final})

    def every_entry(batches):
        for b in batches:
            out = [solve([(c, BASE if f else tuple(e), f)], (0, 1, 2, 3))[0] for c, e, f in zip(*(b.column(k).to_pylist() for k in (3, 4, 5)))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([[a.decode() for a in x] for x, _ in out], pa.list_(pa.string())),
                 pa.array([x for _, x in out], pa.list_(pa.int64()))], ["key", "part", "seg", "audits", "exits"])

    def entered(t: pa.Table) -> pa.Table:
        t = t.sort_by([("part", "ascending"), ("seg", "ascending")])
        state, states = NONE, []
        for exits in t.column("exits").to_pylist():
            states.append(state)
            state = exits[state]
        return pa.table({"part": t.column("part"), "seg": t.column("seg"), "entry": pa.array(states, pa.int64())})

    done = segs.join(cut, "key", "left_anti").mapInArrow(whole, "key string, part long, seg long, audit string")
    pieces = materialize(segs.join(cut, "key", "left_semi").select("key", "part", "seg", "codes"), "conversation-segments")
    ends = (pieces.mapInArrow(matrices, "key string, part long, seg long, m array<long>")
            .groupBy("key").applyInArrow(costs, "part long, seg long, ends array<long>, final boolean"))
    solved = materialize(pieces.join(materialize(ends, "conversation-costs"), ["part", "seg"]).select("key", "part", "seg", "codes", "ends", "final")
                         .mapInArrow(every_entry, "key string, part long, seg long, audits array<string>, exits array<long>"), "conversation-solved")
    entry = solved.select("key", "part", "seg", "exits").groupBy("key").applyInArrow(entered, "part long, seg long, entry long")
    picked = solved.join(materialize(entry, "conversation-entries"), ["part", "seg"]).select(
        "key", "part", "seg", F.get("audits", F.col("entry")).alias("audit"))
    return materialize(done.union(picked), "conversation-audits")


# ------------------------------------------------------------- repaired rows

class _Stream:
    """Passes sorted rows (``Repair.stream``) one by one, with what one
    conversation needs: its state, and the audit of the segment at hand."""

    def __init__(self, batches) -> None:
        self.batches = batches

    def __iter__(self) -> Iterator[tuple]:
        """("start", conv, ...), ("row", turn, code) and ("edit", letter, role, text) events."""
        for b in self.batches:
            for key, part, seg, seq, turn, role, text, code, audit, conv in zip(*(c.to_pylist() for c in b.columns)):
                if part < 0:
                    yield "start", conv, None, None
                    state = NONE
                elif audit is not None:
                    letters, at = audit, 0
                    state = yield from self._inserted(letters, at, state)
                    at = len(letters) - len(letters.lstrip("I"))
                else:
                    yield "row", turn, code, None
                    edit = letters[at]
                    if edit == "K":
                        state = (state, SYSTEM, USER, ASSISTANT)[code & 3]
                        yield "edit", edit, role, text
                    elif edit == "R":
                        state = NEXT[state]
                        yield "edit", edit, "user" if state == USER else "assistant", text
                    else:
                        yield "edit", edit, None, None
                    at += 1
                    state = yield from self._inserted(letters, at, state)
                    while at < len(letters) and letters[at] == "I":
                        at += 1

    @staticmethod
    def _inserted(letters: str, at: int, state: int) -> Iterator[tuple]:
        while at < len(letters) and letters[at] == "I":
            state = NEXT[state]
            yield "edit", "I", "user" if state == USER else "assistant", ""
            at += 1
        return state


class Repair:
    """The repair of a table of conversations (conv_id, turn, role, text).

    Rows are taken by turn, nulls first, then by role and a hash of the text. A null
    role or text is one space; a null conv_id is a conversation of its own; other
    columns are not read. Every conv_id of the rows and of ``every`` has a
    result, without rows an empty audit. Very long texts pass one at a time; an empty
    table gives no rows.
    """

    def __init__(self, rows: DataFrame, every: DataFrame | None = None, segment: int = SEGMENT):
        spark = rows.sparkSession
        bounded_batches(spark)
        space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        self.kind = rows.schema["conv_id"].dataType.simpleString()
        own = rows.select(_key(F.col("conv_id")).alias("key"), F.col("turn").cast("long").alias("turn"),
                          space("role").alias("role"), space("text").alias("text"), F.monotonically_increasing_id().alias("id"))
        stored = materialize(segmented(faults(materialize(own, "conversation-rows")), segment), "conversation-sorted")
        ids = rows.select("conv_id") if every is None else rows.select("conv_id").union(every.select("conv_id"))
        ids = ids.select(_key(F.col("conv_id")).alias("key"), F.col("conv_id").alias("conv")).distinct()
        none = lambda kind: F.lit(None).cast(kind)
        texts = stored.where("codes IS NULL").select(
            "key", "part", "seg", "seq", "turn", "role", "text", "code", none("string").alias("audit"), none(self.kind).alias("conv"))
        plans = audits(stored).select("key", "part", "seg", F.lit(-1).cast("long"), none("long"), none("string"), none("string"), none("int"),
                                      "audit", none(self.kind))
        marks = ids.select("key", *[F.lit(-1).cast("long")] * 3, none("long"), none("string"), none("string"), none("int"), none("string"), "conv")
        self.stream = texts.union(plans).union(marks).repartition("key").sortWithinPartitions("key", "part", "seg", "seq")

    def edits(self) -> DataFrame:
        """(conv_id, place, edit, role, text): the audit row by row, in order of ``place``;
        the repaired conversation is the rows that are no deletions (D, null role)."""
        def run(batches):
            held, conv, place = [], None, 0
            for event, a, b, c in _Stream(batches):
                if event == "start":
                    conv, place = a, 0
                elif event == "edit":
                    held.append((conv, place, a, b, c))
                    place += 1
                    if len(held) == 1000:
                        yield batch(held)
                        held = []
            if held:
                yield batch(held)

        kind = self.stream.schema["conv"].dataType
        kinds = [to_arrow_type(kind), pa.int64(), pa.string(), pa.string(), pa.string()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], ["conv_id", "place", "edit", "role", "text"])

        return self.stream.mapInArrow(run, f"conv_id {self.kind}, place long, edit string, role string, text string")

    def summary(self) -> DataFrame:
        """One row per conversation: faults, cost, audit and the hash of the repaired rows."""
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        kinds = [to_arrow_type(self.stream.schema["conv"].dataType), *[pa.int64()] * 6, pa.string(), pa.string()]

        def run(batches):
            done, one = [], None
            for event, a, b, c in _Stream(batches):
                if event == "start":
                    if one:
                        done.append(one.row())
                    one = _Tally(a)
                    if len(done) == 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done), kinds)], names)
                        done = []
                elif event == "row":
                    one.row_seen(a, b)
                else:
                    one.edited(a, b, c)
            if one:
                done.append(one.row())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done), kinds)], names)

        schema = f"conv_id {self.kind}, " + ", ".join(f"{n} long" for n in names[1:7]) + ", audit string, repaired_sha256 string"
        return self.stream.mapInArrow(run, schema)


class _Tally:
    """What is counted of one conversation while its rows pass."""

    def __init__(self, conv) -> None:
        self.conv, self.faults, self.illegal, self.cost = conv, [0, 0, 0, 0], 0, 0
        self.first = self.turn = self.initial = None
        self.turns = self.fault = 0
        self.audit: list[str] = []
        self.hash, self.any = hashlib.sha256(), False

    def row_seen(self, turn: int | None, code: int) -> None:
        self.fault, initial = code >> 2, code & 3
        self.faults[self.fault] += 1
        if turn is not None and turn != self.turn:
            self.first, self.turn, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        self.illegal += self.initial is not None and (self.initial, initial) not in ((1, 2), (2, 3), (3, 2))
        self.initial = initial

    def edited(self, letter: str, role: str | None, text: str | None) -> None:
        self.audit.append(letter)
        self.cost += {"D": 3, "I": 2, "K": 0, "R": 2}[letter] + (TRUNCATED if letter in "KR" and self.fault == 3 else 0)
        if letter != "D":
            self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
            self.any = True

    def row(self) -> tuple:
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())
