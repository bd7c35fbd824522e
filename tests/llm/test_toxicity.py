import os
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import edge, edge_rows, empty, words  # noqa: E402

from wardflow.llm import toxicity  # noqa: E402


def brute(v, a=0):
    """All maximal segments by their definition: the best one, then left and right of it."""
    best, span = 0, None
    for i in range(len(v)):
        total = 0
        for j in range(i, len(v)):
            total += v[j]
            if total > best:
                best, span = total, (i, j + 1)
    if span is None:
        return []
    i, j = span
    return brute(v[:i], a) + [(a + i, a + j, best)] + brute(v[j:], a + j)


@pytest.mark.parametrize("seed", range(30))
def test_segments(seed):
    v = np.random.default_rng(seed).integers(-7, 6, 40) + 0.25 * np.random.default_rng(seed + 99).random(40)
    got, want = toxicity.segments(v.astype(float)), brute(v.tolist())
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want])


@pytest.mark.parametrize("pattern", [(-1, -1, -1, 0.5), (0.5, -0.25), (-0.25, 0.5), (1, -1), (-1, 2, -3, 2)])
def test_segments_in_linear_time(pattern):
    """Sums that fall or rise all along, which a scan without links walks over and over."""
    import time
    v = np.asarray(pattern * 12, float)
    assert [x[:2] for x in toxicity.segments(v)] == [x[:2] for x in brute(v.tolist())]

    def seconds(n):
        t = time.perf_counter()
        toxicity.segments(np.tile(np.asarray(pattern, float), n))
        return time.perf_counter() - t
    assert seconds(400_000) < 8 * max(seconds(100_000), 0.05)  # 4 if linear, 16 if quadratic
    assert seconds(400_000) < 10


def corpus(spark, n=600):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(n):
        text = [f"word{k}" for k in rng.integers(0, 400, 120)]
        toxic = int(i % 4 == 0)
        if toxic:
            for k in rng.integers(0, 120, 5):
                text[k] = ("vilething", "vilethings,", "Rotten!")[k % 3]
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_and_passages(spark):
    docs, labels = corpus(spark)
    train = labels.where("crc32(cast(doc_id as string)) % 5 <> 0")
    model = toxicity.fit(docs, train)
    got = toxicity.scan(docs, model).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in held)
    assert right / len(held) > 0.97
    texts = dict(docs.collect())
    for r in got:
        for p in r.passages:
            inside = texts[r.doc_id][p.start:p.end].lower()
            assert inside == inside.strip() and any(w in inside for w in ("vilething", "rotten"))
    odd = toxicity.scan(edge(spark), model)
    rows = odd.collect()
    assert len(rows) == len(edge_rows()) and "label" in odd.columns
    assert sorted(r.n_words for r in rows) == sorted(len(words(t)) for _, t, *_ in edge_rows())
    assert all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scan(empty(spark), model).count() == 0


def test_without_labels_or_texts(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r.score < 0.5 for r in toxicity.scan(edge(spark), toxicity.fit(edge(spark), none)).collect())
    toxicity.fit(empty(spark), none)
    odd = spark.createDataFrame([(None, 1), (1, None), (5, 0), (5, 1)], "doc_id long, toxic int")
    toxicity.fit(edge(spark), odd)
