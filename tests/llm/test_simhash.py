"""Fingerprints and components against plain versions; bit-sliced pairs against XOR and popcount."""
import random

import numpy as np
import pytest
import xxhash
from helpers import edge, edge_rows, empty, prose, words

from wardflow.llm import simhash as S


def plain_fingerprint(text):
    w = [x.encode() for x in words(text)]
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def check(spark, df, rows, most):
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = plain_components(fps)
    least = {}
    for (i, _), c in zip(rows, comp):
        least[c] = min((x for x in (least.get(c), i) if x is not None), default=None)
    want = sorted((str(i), f"{f:016x}", str(least[c])) for (i, _), f, c in zip(rows, fps, comp))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in S.join(df, most=most).collect())
    assert got == want
    return want


def test_edge_rows(spark):
    check(spark, edge(spark), [(r[0], r[1]) for r in edge_rows()], 2048)
    assert S.join(empty(spark)).count() == 0


def test_near_copies(spark):
    r, rows = random.Random(5), []
    for i in range(60):
        base = prose(100 + i, r.choice((40, 200, 900))).split(" ")
        rows.append((10 * i, " ".join(base)))
        for k in range(1, r.randint(1, 4)):
            other = list(base)
            other[r.randrange(len(other))] = "changed"
            rows.append((10 * i + k, " ".join(other)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = check(spark, df, rows, 2048)
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want})  # some differ and are linked


@pytest.mark.parametrize("most", [2, 40])
def test_split_regions_lose_no_link(spark, most):
    """Fingerprints that share blocks on purpose, compared in regions split down to ``most``."""
    r = random.Random(most)
    fps = set()
    for _ in range(12):
        base = r.getrandbits(64) & ~0xFFFF_FFFF | 0x1234_5678  # half of the bits are common to all
        for _ in range(25):
            fps.add(base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))))
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    edges, _ = S.links(df, most)
    edges = [(a & (2 ** 64 - 1), b & (2 ** 64 - 1)) for a, b in edges.collect()]
    assert all((a ^ b).bit_count() <= 63 for a, b in edges)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        root[find(a)] = find(b)
    want = plain_components(fps)
    assert len({find(f) for f in fps}) == len(set(want))
    assert all(find(f) == find(fps[c]) for f, c in zip(fps, want))


@pytest.mark.parametrize("n", [2, 63, 64, 65, 300])
def test_bit_sliced_pairs(n):
    r = random.Random(n)
    base = [r.getrandbits(64) for _ in range(max(1, n // 6))]
    fps = np.asarray([r.choice(base) ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for _ in range(n)], np.uint64)
    cut = sorted({n, *(r.randrange(1, n + 1) for _ in range(4))})
    sizes = sorted(np.diff([0, *cut]).tolist(), reverse=True)
    ends = np.cumsum(sizes)
    group = np.repeat(np.arange(len(sizes)), sizes)
    got = {(int(a), int(b)) for i, j in S.near_pairs(fps, ends) for a, b in zip(i, j)}
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if group[i] == group[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= 3}
    assert got == want


def test_pieces_do_not_show(monkeypatch):
    text = prose(9, 3000) + "\n\t " + "x" * 500 + " Ünd so  WEITER"
    whole = S.fingerprint(text.encode())
    assert whole == plain_fingerprint(text)
    for size in (1, 7, 100):
        monkeypatch.setattr(S, "PIECE", size)
        assert S.fingerprint(text.encode()) == whole
    assert S.fingerprint(b"two words") == plain_fingerprint("two words")


def test_a_very_long_text_in_bounded_memory():
    import tracemalloc
    text = (prose(11, 20_000) + " ").encode() * 60  # 7 MB or so
    tracemalloc.start()
    S.fingerprint(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * S.PIECE * 10  # some objects per word of a piece, whatever the text's length
