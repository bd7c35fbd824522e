import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import SF, edge, edge_rows, empty, words  # noqa: E402

from wardflow.llm import jaccard  # noqa: E402


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(id, size, least id reachable) per row, comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            x, y = sets[i], sets[j]
            both = len(x & y)
            if both and 100 * both >= 80 * (len(x) + len(y) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), d if not s else least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def got(frame):
    return sorted(map(tuple, jaccard.join(frame).collect()), key=str)


def near_copies(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    rows, base = [], [[r.choice(vocabulary) for _ in range(r.choice((6, 12, 40, 90)))] for _ in range(12)]
    for i in range(220):
        text = list(r.choice(base))
        if r.random() < 0.3:  # a passage that many share
            text = passage + text
        for _ in range(r.choice((0, 0, 1, 1, 2, 4))):
            text[r.randrange(len(text))] = r.choice(vocabulary)
        if r.random() < 0.3:  # growing tails make chains of links
            text += [r.choice(vocabulary) for _ in range(r.randrange(1, 6))]
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_brute_force(spark, seed, monkeypatch):
    rows = near_copies(seed)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(frame) == brute(rows)
    if seed == 0:  # any list of frequent shingles gives the same result
        import numpy as np
        monkeypatch.setattr(jaccard, "frequent_shingles", lambda texts: (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        assert got(frame) == brute(rows)


def test_batches_of_another_reading(spark, monkeypatch):
    """Regions stay whole if tables are read again in other batches."""
    rows = near_copies(5)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    store, conf = jaccard.materialize, "spark.sql.execution.arrow.maxRecordsPerBatch"

    def cut(df, name, path=None):
        out = store(df, name, path)
        spark.conf.set(conf, "1" if name == "jaccard-classes" else "4000")
        return out
    monkeypatch.setattr(jaccard, "materialize", cut)
    assert got(frame) == brute(rows)


def test_few_pairs_of_many_near_copies(spark, monkeypatch):
    """Far fewer pairs are compared than a group of near copies has, linked or not."""
    r = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        text = list(base)
        for k in r.sample(range(150), r.randrange(1, 8)):
            text[k] = f"x{i}.{k}"
        rows.append((i, " ".join(text)))
    compared, seen = jaccard._Space.compare, []

    def counted(self, pairs, name):
        seen.append(pairs.count())
        return compared(self, pairs, name)
    monkeypatch.setattr(jaccard._Space, "compare", counted)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)
    assert sum(seen) < len(rows) * (len(rows) - 1) // 2 // 4


def test_sizes_that_can_link(spark):
    """The bounds on the sizes of partners drop no pair on the border, whichever is greater."""
    rows = []
    for n in (5, 9, 10, 14, 24, 45, 50):   # words; all end alike, so the shared shingles lie anywhere in the order
        tail = [f"t{n}.{i}" for i in range(n)]
        rows += [(len(rows) + k, " ".join([f"h{n}.{i}" for i in range(k)] + tail)) for k in range(n // 3 + 1)]
        rows += [(len(rows) + k, " ".join(tail[:k] + [f"m{n}.{k}"] + tail[k + 1:])) for k in range(n)]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)


def test_batches_of_sets_are_small(spark):
    """The arrays held for a batch are many times its bytes."""
    assert got(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")) == [(1, 2, 1), (2, 2, 1)]
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 1 << 19


def test_edges(spark):
    rows = [(i, t) for i, t, *_ in edge_rows()]
    assert got(edge(spark)) == brute(rows)
    assert jaccard.join(empty(spark)).count() == 0


def test_driver_table(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(frame) == brute([(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()])


def test_keep_one(spark):
    frame = edge(spark).unionByName(spark.createDataFrame([(r + (1, 2, 3, "l", 4, "w", 0.5, 5, 6, 7, 8, "zz", "q", "c", 9))
                                                           for r in [(50, edge_rows()[7][1] + " tail", "en", "s", 1)]], edge(spark).schema))
    kept = jaccard.keep_one(frame)
    assert kept.columns == frame.columns
    rows = kept.collect()
    groups = brute([(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()])
    with_words = [r.doc_id for r in rows if words(r.text)]
    assert set(with_words) == {c for _, n, c in groups if n}
    numbered = brute([(k, r.text) for k, r in enumerate(frame.select("text").collect())])  # two groups can have one least id
    assert len(with_words) == len({c for _, n, c in numbered if n})
    assert sum(not words(r.text) for r in rows) == sum(not words(t) for _, t, *_ in edge_rows())  # texts without words stay
    assert jaccard.keep_one(empty(spark)).count() == 0
