"""Product quantisation against a plain-Python version; the sliced search against full comparison."""
import hashlib
import math
import random

import numpy as np
import pytest

from wardflow.llm import vector_codes as V


def brute(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label), all usable and of one length."""
    whole = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows]
    w = len(whole[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in whole]
    first = sorted(range(len(whole)), key=lambda k: (whole[k][0] is None, whole[k][0] or 0, rows[k][1]))[:entries]
    books = [[list(cut[k][p]) for k in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            got = [near(c[p], books[p])[1] for c in cut]
            for e in range(len(books[p])):
                mine = [c[p] for c, g in zip(cut, got) if g == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by = {}
    for (_, _, lab), e in zip(whole, errors):
        by[lab] = by.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{e:02x}" for _, e in f), err, by[lab], sha) for (i, _, lab), f, err in zip(whole, found, errors))


def got(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, id int, code string")
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in V.compress(df).collect())


def vectors(seed, n, dims=16):
    r = random.Random(seed)
    return [(i, [float(np.float32(r.gauss(0, 1))) for _ in range(dims)], r.choice((0, 1, None))) for i in range(n)]


def test_equals_the_plain_version(spark):
    rows = vectors(1, 150)
    rows += [rows[40], rows[40], (7, rows[3][1], 1), (None, rows[5][1], 0), (500, [0.0] * 16, 2)]  # repeated, tied and null ids
    assert got(spark, rows) == brute(rows)


def test_unusable_rows_are_left_out(spark):
    rows = vectors(2, 40)
    bad = [(100, None, 1), (-5, [float("nan")] + [0.0] * 15, 1), (-6, [float("inf")] * 16, 1), (-7, [None] * 16, 1), (900, [1.0] * 8, 1), (901, [], 1)]
    assert got(spark, rows + bad) == brute(rows)


@pytest.mark.parametrize("n", [1, 3, 16])
def test_few_rows(spark, n):
    rows = vectors(3, n)
    assert got(spark, rows) == brute(rows)


def test_empty_equal_odd_and_huge(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None, None)]) == []
    same = [(i, [0.25] * 16, 0) for i in range(30)]
    assert got(spark, same) == brute(same)
    assert [r[1:4] for r in got(spark, [(1, [], 0), (2, [], 0)])] == [("00" * 8, 0, 0)] * 2
    odd = [(i, [float(i)] * 5, 0) for i in range(4)]  # five dimensions: filled up with zeros to eight parts
    assert [r[2] for r in got(spark, odd)] == [0, 0, 0, 0]
    huge = vectors(4, 20, 8) + [(99, [3e38] * 8, 0)]
    assert all(0 <= r[2] < 2 ** 63 for r in got(spark, huge))


@pytest.mark.parametrize("entries, dims, spread", [(16, 8, 4000), (64, 4, 30), (200, 3, 5), (1, 8, 100), (70, 1, 50)])
def test_sliced_search_is_exact(entries, dims, spread):
    r = np.random.default_rng(entries)
    book, x = r.integers(-spread, spread, (entries, dims)), r.integers(-2 * spread, 2 * spread, (500, dims))
    far = ((x[:, None] - book) ** 2).sum(2)
    best, error = V.Slices(book).nearest(x)
    assert (best == far.argmin(1)).all() and (error == far.min(1)).all()
    masks = V.Slices(book).candidates(x)
    kept = np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little")[:, :entries]
    assert kept[np.arange(500), far.argmin(1)].all()


def test_slices_leave_far_entries_out():
    r = np.random.default_rng(0)
    book = r.integers(-4000, 4000, (16, 8))
    x = book[r.integers(0, 16, 500)] + r.integers(-300, 300, (500, 8))
    kept = np.unpackbits(V.Slices(book).candidates(x).view(np.uint8), axis=1, bitorder="little")[:, :16]
    assert kept.mean() < 0.4
