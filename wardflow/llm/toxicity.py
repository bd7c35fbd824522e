"""Toxic passages as maximum-scoring segments, calibrated by extreme values.

1. Words (and, for words too rare to judge, their stems of 6 and 4 bytes) get
   the log-odds of standing in toxic against clean training texts, under an
   informative Dirichlet prior: pseudo-counts in proportion to how often the
   whole corpus has the word. Words are counted once per text, and
   ``caution`` standard errors are taken off towards 0.
2. A text is a sequence of these scores, less a small drift. One linear scan
   (the algorithm of Ruzzo and Tompa) finds all its disjoint maximum-scoring
   segments.
3. Such scores follow an extreme-value law: n words of clean text are expected
   to hold K n exp(-lambda S) segments of score S or more. lambda solves
   sum p(w) exp(lambda s(w)) = 1 over the clean word frequencies, K is fitted to
   the clean training texts. Segments with fewer expected than ``significance``
   are reported, and Karlin and Altschul's sum statistic over the best of them
   gives one p-value per text, which a logistic curve turns into the score.

Labels are read for a bounded sample of the training rows (``labelled_rows``);
word frequencies of the prior cover all texts, and all texts are scanned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, lower_ascii, span_hashes, text_buffer, word_spans

STEMS = (6, 4)
_TRIM = np.zeros(256, bool)
_TRIM[[ord(c) for c in ".,;:!?\"'()"]] = True
_SALT = np.asarray([0, 0x5851F42D4C957F2D, 0x14057B7EF767814F], np.uint64)


def features(data: np.ndarray, offsets: np.ndarray):
    """Hashes of words and stems (3 x words; 0 where there is no stem), starts,
    ends, and each text's first word."""
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, offsets)
    core = ends.copy()
    for _ in range(3):  # closing punctuation is not part of a word
        core -= _TRIM[data[np.maximum(core - 1, 0)]] & (core - 1 > starts) if len(core) else 0
    out = np.zeros((1 + len(STEMS), len(starts)), np.uint64)
    out[0] = span_hashes(data, starts, core)
    for k, size in enumerate(STEMS, 1):
        long = core - starts > size
        out[k, long] = span_hashes(data, starts[long], starts[long] + size) ^ _SALT[k]
    return out, starts, ends, first


def _at(lexicon: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of ``keys`` in the sorted lexicon, -1 if not there."""
    if not len(lexicon):
        return np.full(len(keys), -1)
    place = np.minimum(np.searchsorted(lexicon, keys), len(lexicon) - 1)
    return np.where(lexicon[place] == keys, place, -1)


def segments(values: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in order.

    Only runs of positive values can begin or end one, so the scan steps over
    runs; each run joins the candidates as Ruzzo and Tompa describe. A candidate
    keeps a link to the last one before it of a smaller sum, so the search for the
    candidate to join skips what an earlier search has passed, and candidates that
    nothing can join any more are given out at once: the scan is linear in time.
    """
    up = values > 0
    if not up.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate(([False], up, [False])).astype(np.int8)))
    total = np.concatenate(([0.0], np.cumsum(values)))
    out: list[tuple[int, int, float]] = []
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, link
    for start, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
        before, after, j = float(total[start]), float(total[end]), len(stack) - 1
        while j >= 0 and stack[j][2] >= before:
            j = stack[j][4]
        while j >= 0 and stack[j][3] < after:  # joined; what has a smaller sum before it is behind its link
            start, _, before, _, link = stack[j]
            del stack[j:]
            j = link
        if j < 0:
            out += [(a, b, y - x) for a, b, x, y, _ in stack]
            stack.clear()
        stack.append((start, end, before, after, j))
    return out + [(a, b, y - x) for a, b, x, y, _ in stack]


class Model:
    """Scores of the lexicon, and the calibration."""

    def __init__(self, lexicon: np.ndarray, score: np.ndarray, drift: float, rate: float):
        self.lexicon, self.score, self.drift, self.rate = lexicon, score, drift, rate
        self.k, self.slope, self.base = 0.1, 0.0, 0.0

    def values(self, keys: np.ndarray) -> np.ndarray:
        place = _at(self.lexicon, keys[0])
        for row in keys[1:]:
            more = np.flatnonzero(place < 0)
            place[more] = _at(self.lexicon, row[more])
        out = np.full(keys.shape[1], -self.drift)
        known = place >= 0
        out[known] = self.score[place[known]] - self.drift
        return out

    def evidence(self, scores: list[float], n: int) -> float:
        """-log10 of the text's p-value: the best sum statistic over its r best
        segments, paid for by a factor 2^r. Segments of which clean text of this
        length holds more than about one in three say nothing."""
        best, total = 0.0, 0.0
        for r, s in enumerate(sorted(scores, reverse=True), 1):
            normal = self.rate * s - math.log(max(self.k * n, 1.0))
            if normal < 1:
                break
            total += normal
            log_p = -total + (r - 1) * math.log(max(total, 1e-9)) - math.lgamma(r + 1) - math.lgamma(r)
            best = max(best, -log_p / math.log(10) - r * math.log10(2))
        return best

    def probability(self, x: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, self.base + self.slope * x))))


def _counts(texts: DataFrame) -> DataFrame:
    """(key, toxic, clean) over ``label`` and ``text``: sums per task, then over all."""
    def run(batches):
        for b in batches:
            data, offsets = text_buffer(b.column(1))
            label = np.asarray(b.column(0).to_pylist(), np.int64)
            keys, _, _, first = features(data, offsets)
            text = np.repeat(np.arange(len(label)), np.diff(first))
            for row in keys:
                key, back = np.unique(row, return_inverse=True)
                once = np.unique(back * len(label) + text)  # a word counts once per text
                bad = np.bincount(once // len(label), weights=label[once % len(label)], minlength=len(key)).astype(np.int64)
                every = np.bincount(once // len(label), minlength=len(key))
                key, bad, every = (x[key != 0] for x in (key, bad, every))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(bad), pa.array(every - bad)], ["key", "toxic", "clean"])

    return (texts.mapInArrow(run, "key long, toxic long, clean long").groupBy("key")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def _corpus_counts(texts: DataFrame, lexicon: np.ndarray) -> np.ndarray:
    """How many of all texts have each key of the lexicon; then the texts and words in all."""
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)  # lexicon_size keys at most
    size = len(lexicon)

    def run(batches):
        total = np.zeros(size + 2, np.int64)
        for b in batches:
            keys, _, _, first = features(*text_buffer(b.column(0)))
            total[size:] += (b.num_rows, keys.shape[1])
            text = np.repeat(np.arange(b.num_rows), np.diff(first))
            for row in keys:
                place = _at(shared.value, row)
                known = place >= 0
                once = np.unique(place[known] * b.num_rows + text[known])
                total[:size] += np.bincount(once // max(b.num_rows, 1), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["place", "n"])

    out = np.zeros(size + 2)
    for r in texts.mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["place"]] = r["n"]
    return out


def _rate(p: np.ndarray, s: np.ndarray, drift: float) -> float:
    """lambda > 0 with the expected exp(lambda score) of clean words 1."""
    rest = max(0.0, 1.0 - p.sum())

    def excess(x):
        return float((p * np.exp(np.minimum(x * (s - drift), 600))).sum() + rest * math.exp(-x * drift) - 1)
    low, high = 1e-3, 8.0
    if excess(high) <= 0:
        return high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) <= 0 else (low, mid)
    return max(low, 1e-2)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        labelled_rows: int = 40_000, lexicon_size: int = 1 << 16, rare: int = 8, prior_texts: float = 100.0, drift: float = 1.0, caution: float = 2.0) -> Model:
    """Learn from ``labels``: of its ids at most ``labelled_rows`` are used, those of
    the least hash, so a rerun takes the same. An id labelled twice is toxic if
    any row says so; null ids and labels are left out."""
    bounded_batches(docs.sparkSession)
    sample = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("__id"))
              .agg(F.max(F.col(label_col).cast("int")).alias("label"))
              .orderBy(F.xxhash64("__id"), "__id").limit(labelled_rows))
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"))
    train = texts.join(F.broadcast(sample), "__id").select("label", "text")  # labelled_rows ids and labels at most
    found = _counts(train)
    sizes = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    t, c = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    flat = F.abs(F.log((F.col("toxic") + 0.5) / (t + 1)) - F.log((F.col("clean") + 0.5) / (c + 1))) / F.sqrt(
        1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    rows = (found.where(F.col("toxic") + F.col("clean") >= rare).withColumn("z", flat)
            .orderBy(F.desc("z"), "key").limit(lexicon_size).collect())
    rows.sort(key=lambda r: r["key"] & 0xFFFFFFFFFFFFFFFF)
    lexicon = np.asarray([r["key"] for r in rows], np.int64).view(np.uint64)
    toxic, clean = (np.asarray([r[k] for r in rows], float) for k in ("toxic", "clean"))

    corpus = _corpus_counts(texts.select("text"), lexicon)
    n_texts, n_words = max(corpus[-2], 1.0), max(corpus[-1], 1.0)
    alpha = prior_texts * (corpus[:-2] + 0.5) / (n_texts + 1)
    odds = (np.log((toxic + alpha) / (t + prior_texts - toxic - alpha + 1)) - np.log((clean + alpha) / (c + prior_texts - clean - alpha + 1)))
    error = np.sqrt(1 / (toxic + alpha) + 1 / (clean + alpha))
    score = np.sign(odds) * np.maximum(0, np.abs(odds) - caution * error)
    share = (clean + alpha) / (c + prior_texts) * n_texts / n_words  # of clean words, about
    model = Model(lexicon, score, drift, _rate(share, score, drift))

    # calibration on the training sample: at most labelled_rows rows of a few numbers
    seen = scan(train.withColumnRenamed("label", "__label"), model, "text", spans=False).select("__label", "n_words", "scores").collect()
    u = [r["n_words"] * math.exp(-model.rate * max(r["scores"], default=0.0)) for r in seen if r["__label"] == 0 and r["n_words"]]
    model.k = max(len(u) / sum(u), 1e-6) if u and sum(u) > 0 else model.k
    x = np.asarray([model.evidence(r["scores"], r["n_words"]) for r in seen])
    y = np.asarray([r["__label"] for r in seen], float)
    model.slope, model.base = _logistic(x, y)
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and base of a lightly damped logistic curve, by Newton steps."""
    w = np.zeros(2)
    if not len(x):
        return 0.0, -2.0
    design = np.stack((np.minimum(x, 20.0), np.ones(len(x))), 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + np.asarray([0.05, 0.001]) * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag([0.05, 0.001]) + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def scan(docs: DataFrame, model: Model, text_col: str = "text", significance: float = 0.05, spans: bool = True) -> DataFrame:
    """``docs`` without its text, with ``n_words``, ``scores`` (of all segments),
    ``evidence``, ``score`` (0 to 1) and, with ``spans``, ``passages``: array of
    (start, end, score, expected) in code points, of the significant segments.

    Null, empty and blank texts have no words, no segments and the score of no
    evidence. Rows are scanned one by one; an empty table gives none. Columns
    that have a result's name give way to it; all others stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # lexicon_size entries at most
    results = ("n_words", "scores", "evidence", "score", "passages")
    others = [c for c in docs.columns if c != text_col and c not in results]
    held = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], F.col(f"`{text_col}`").cast("string").alias("text"))
    fields = "".join(f"c{i} {f.dataType.simpleString()}, " for i, f in enumerate(held.schema.fields[:-1]))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches):
        m = shared.value
        for b in batches:
            data, offsets = text_buffer(b.column(len(others)))
            keys, starts, ends, first = features(data, offsets)
            values = m.values(keys)
            positive = np.concatenate(([0], np.cumsum(values > 0)))
            n = np.diff(first)
            scores = [[] for _ in n]
            passages = [[] for _ in n]
            for i in np.flatnonzero(positive[first[1:]] > positive[first[:-1]]).tolist():
                a = int(first[i])
                found = segments(values[a:first[i + 1]])
                scores[i] = [s for _, _, s in found]
                if spans:
                    for x, y, s in found:
                        expected = m.k * n[i] * math.exp(-m.rate * s)
                        if expected <= significance:
                            lead = (data[offsets[i]:ends[a + y - 1]] & 0xC0) != 0x80
                            begin = int(lead[:starts[a + x] - offsets[i]].sum())
                            passages[i].append({"start": begin, "end": int(lead.sum()), "score": s, "expected": expected})
            evidence = [m.evidence(s, int(k)) for s, k in zip(scores, n)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(n.astype(np.int64)), pa.array(scores, pa.list_(pa.float64())), pa.array(evidence, pa.float64()),
                 pa.array([m.probability(min(e, 20.0)) for e in evidence], pa.float64()), pa.array(passages, kind)],
                [*b.schema.names[:-1], "n_words", "scores", "evidence", "score", "passages"])

    out = held.mapInArrow(run, fields + "n_words long, scores array<double>, evidence double, score double, "
                          "passages array<struct<start:long,end:long,score:double,expected:double>>")
    return out.toDF(*others, *results)
