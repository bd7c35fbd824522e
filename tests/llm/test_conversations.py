"""Conversation repair against an exhaustive search and a forward DP in plain Python."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from wardflow.llm import conversations as C

BLANK = re.compile(r"[^\x20\x09-\x0d]")
FIT = re.compile(r"(s?(ua)+)?")


def plain(rows):
    """rows: (turn, role, text) of one conversation in order; forward DP over (cost, audit, repaired)."""
    seen, faults = set(), []
    for _, role, text in rows:
        last = BLANK.findall(text)
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))

    def closed(best):
        for _ in range(3):
            for s, to, role in (("", "u", "user"), ("s", "u", "user"), ("u", "a", "assistant"), ("a", "u", "user")):
                if s in best:
                    c, a, r = best[s]
                    step = (c + 2, a + "I", (*r, role + ":"))
                    if to not in best or step[:2] < best[to][:2]:
                        best[to] = step
        return best
    best = closed({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        new, cut = {}, int(fault == "truncated")

        def put(s, one):
            if s not in new or one[:2] < new[s][:2]:
                new[s] = one
        for s, (c, a, r) in best.items():
            put(s, (c + 3, a + "D", r))
            if fault in ("blank", "duplicate"):
                continue
            to, name = ("a", "assistant") if s == "u" else ("u", "user")
            put(to, (c + 2 + cut, a + "R", (*r, f"{name}:{text}")))
            if role[:1] == to or (s == "" and role[:1] == "s"):
                put(role[:1], (c + cut, a + "K", (*r, f"{role}:{text}")))
        best = closed(new)
    cost, audit, fixed = min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(fixed).encode()).hexdigest())


def exhaustive(rows):
    """Least (cost, audit) of all edit sequences with two inserts in a row at most."""
    faults = []
    for k, (_, role, text) in enumerate(rows):
        last = BLANK.findall(text)
        faults.append("gone" if not last or (role, text) in [r[1:] for r in rows[:k]] else "cut" if last[-1] not in ".!?" else "")
    found = []

    def go(i, roles, cost, audit, inserts):
        if i == len(rows):
            if FIT.fullmatch(roles):
                found.append((cost, audit))
        else:
            go(i + 1, roles, cost + 3, audit + "D", 0)
            if faults[i] != "gone":
                more = faults[i] == "cut"
                go(i + 1, roles + (rows[i][1][:1] or "?"), cost + more, audit + "K", 0)
                for x in "ua":
                    go(i + 1, roles + x, cost + 2 + more, audit + "R", 0)
        if inserts < 2:
            for x in "ua":
                go(i, roles + x, cost + 2, audit + "I", inserts + 1)
    go(0, "", 0, "", 0)
    return min(found)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def want(rows, every):
    by = {c: [] for c, *_ in every}
    for c, *r in rows:
        by.setdefault(c, []).append(tuple(r))
    return {c: plain(sorted(v, key=lambda r: (r[0] is not None, r[0] or 0))) for c, v in by.items()}


def got(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def made(seed, convs, length):
    r = random.Random(seed)
    return [(c, t, r.choice(("user", "assistant", "assistant", "user", "system", "tool", "", "u2")),
             r.choice(("", " \t", "Yes.", "No", "So it is! ", "a b c", f"text {r.random()}.", f"text {r.random()}")))
            for c in range(convs) for t in range(r.randint(1, length))]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", range(40))
def test_solver_is_exhaustive(seed):
    rows = [(t, role, text) for _, t, role, text in made(seed, 1, 4)]
    codes = bytearray()
    seen = set()
    for _, role, text in rows:
        last = BLANK.findall(text)
        fault = 1 if not last else 2 if (role, text) in seen else 3 if last[-1] not in ".!?" else 0
        seen.add((role, text))
        codes.append("?sua".find(role[:1] or "?") % 4 * (role[:1] in tuple("sua")) + 4 * fault)
    (audit,), _ = C.solve([(bytes(codes), C.BASE, True)], (C.NONE,))[0]
    cost, least = exhaustive(rows)
    assert audit.decode() == least == plain(rows)[6] and cost == plain(rows)[5]


def test_ranking_of_a_graph_with_equal_letters():
    """Two arcs of one letter: only what comes later tells them apart."""
    source, letter, target = np.asarray([0, 0, 1, 2, 3, 4]), np.asarray([1, 1, 2, 2, 4, 3]), np.asarray([1, 2, 3, 4, 5, 5])
    least, successor = C.ranked_successors(6, source, letter, target)
    assert successor[0] == 2 and C.unrolled(least, successor, np.asarray([0]))[0] == [b"DIK"]


def test_many_short_conversations(spark):
    rows = made(1, 300, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(C.Repair(C.damage(df), df).summary()) == want(damaged(rows), rows)
    assert got(C.Repair(df).summary()) == want(rows, rows)


def test_a_conversation_across_tasks_and_segments(spark):
    """One conversation holds most rows; segments of 16 rows, in many tasks."""
    rows = [(7, *r[1:]) for r in made(2, 1, 3)] + [(5, t, *r[2:]) for t, r in enumerate(made(3, 220, 4))] + made(4, 3, 30)
    rows = list({(c, t): (c, t, role, text) for c, t, role, text in rows}.values())
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(C.Repair(C.damage(df), df, segment=16).summary()) == want(damaged(rows), rows)
    assert got(C.Repair(C.damage(df), df, segment=1).summary()) == want(damaged(rows), rows)


def test_null_empty_tied_and_clashing(spark):
    long = "word " * 100_000 + "end."
    rows = [(None, None, None, None), (None, 1, "user", "hi."), (1, None, "user", None), (1, 0, "user", long), (1, 1, "assistant", long),
            (1, 1, "assistant", long), (2, 5, "system", "Be kind."), (3, 3, "", "."), (4, -2, "user", "x" * 200_000)]
    df = spark.createDataFrame([(*r, "k", 1, "a") for r in rows], SCHEMA + ", key string, part long, audit string")
    assert got(C.Repair(df).summary()) == want([(c, t, " " if a is None else a, " " if b is None else b) for c, t, a, b in rows], rows)
    assert got(C.Repair(C.damage(df), df).summary()) == want(damaged(rows), rows)
    assert C.Repair(spark.createDataFrame([], SCHEMA)).summary().count() == 0


def test_conversation_without_rows(spark):
    rows = [(c, 0, "user", "Hi.") for c in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = got(C.Repair(C.damage(df), df).summary())
    gone = [c for c in range(60) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone and all(out[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)


def test_edits_give_the_audit_and_the_repaired_rows(spark):
    rows = made(6, 40, 8)
    df = spark.createDataFrame(rows, SCHEMA)
    repair = C.Repair(df)
    by = {}
    for r in sorted(repair.edits().collect(), key=lambda r: (r.conv_id, r.place)):
        by.setdefault(r.conv_id, []).append(r)
    for conv, one in got(repair.summary()).items():
        mine = by.get(conv, [])
        assert "".join(r.edit for r in mine) == one[6]
        kept = [r for r in mine if r.edit != "D"]
        assert FIT.fullmatch("".join(r.role[0] for r in kept))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == one[7]
