import collections
import math
import os
import sys

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from helpers import SF, edge, edge_rows, empty, words  # noqa: E402

from wardflow.llm import gated_lm as lm  # noqa: E402


def small_net(seed=3):
    rng = np.random.default_rng(seed)
    names = np.sort(rng.integers(1, 1 << 62, 40).astype(np.uint64))
    return lm.Network(names, np.sort(rng.integers(1, 500, 40))[::-1], 300, seed=seed), rng


def test_probabilities_sum_to_one():
    net, rng = small_net()
    states = rng.standard_normal((4, lm.STATE)).astype(np.float32)
    total = sum(np.exp(net.output(states, np.full(4, k), False)[0]) for k in range(len(net.names)))
    assert np.allclose(total, 1, atol=1e-5)


def test_gradient():
    """Truncated backpropagation agrees with differences of the loss over one window."""
    net, rng = small_net()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    target = rng.integers(0, len(net.names), (5, 3))
    before, fresh = rng.integers(0, len(net.names) + 1, (5, 3)), np.zeros((5, 3), bool)
    fresh[0], fresh[2, 1] = True, True
    start = np.zeros((3, lm.STATE))

    def loss():
        states, _, kept = net.forward(before, fresh, start)
        return states.astype(np.float64), kept

    def value():
        states, _ = loss()
        return -net.output(states.reshape(-1, lm.STATE), target.ravel(), False)[0].sum()
    states, kept = loss()
    _, grads, back = net.output(states.reshape(-1, lm.STATE), target.ravel(), True)
    token, dx = net.backward(before, fresh, kept, back.reshape(5, 3, lm.STATE), grads)
    for name, g in (("c", grads["c"]), ("w", grads["w"]), ("wb", grads["wb"]), ("h", grads["h"])):
        at = tuple(rng.integers(0, n) for n in net.p[name].shape)
        old = net.p[name][at]
        net.p[name][at] = old + 1e-3
        up = value()
        net.p[name][at] = old - 1e-3
        down = value()
        net.p[name][at] = old
        assert abs((up - down) / 2e-3 - g[at]) < 2e-2 * max(1, abs(g[at])), name
    k = token[0]
    old = net.p["x"][k, 5]
    net.p["x"][k, 5] = old + 1e-3
    up = value()
    net.p["x"][k, 5] = old - 1e-3
    assert abs((up - value()) / 2e-3 - dx[0, 5]) < 2e-2


def test_state_is_carried_and_documents_do_not_touch():
    net, rng = small_net()
    net.load(net.flat() * 8)
    sizes = rng.integers(1, 4 * lm.WINDOW, 30)
    ids, at = rng.integers(0, len(net.names), sizes.sum()), np.concatenate(([0], np.cumsum(sizes)))
    together = lm.score_documents(net, ids, at)
    for d in range(30):
        own = ids[at[d]:at[d + 1]]
        alone = lm.score_documents(net, own, np.asarray([0, len(own)]))
        state, want, last = np.zeros((1, lm.STATE), np.float32), 0.0, net.start
        for k, w in enumerate(own):  # word by word, no windows
            s, state, _ = net.forward(np.asarray([[last]]), np.asarray([[k == 0]]), state)
            want += net.output(s.reshape(1, -1), np.asarray([w]), False)[0][0]
            last = w
        assert np.isclose(alone[0], together[d], rtol=1e-4) and np.isclose(want, together[d], rtol=1e-4)


def base(rows, training):
    count = collections.Counter(w for (_, t), use in zip(rows, training) if use for w in [*words(t), None])
    n, v = sum(count.values()), len(count)
    return [(d, len(words(t)) + 1, sum(count[w] > 0 for w in [*words(t), None]), n,
             sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*words(t), None])) for d, t in rows]


def check(frame, rows, training, got):
    want = sorted(base(rows, training), key=str)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=lambda x: str((x[0], x[1])))
    want = sorted(want, key=lambda x: str((x[0], x[1])))
    for a, b in zip(got, want):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9)
    assert len(got) == len(want)


def test_scores_are_those_of_a_plain_loop():
    """Token by token in double precision: gates, class and word softmax, state carried."""
    rng = np.random.default_rng(8)
    net = lm.Network(np.unique(rng.integers(1, 1 << 62, 300).astype(np.uint64)), np.arange(300, 0, -1)[:300], 50.0)
    for k, v in net.p.items():
        net.p[k] = (v + rng.standard_normal(v.shape) * (1.5 if k in ("c", "w") else 0.4)).astype(np.float32)
    sizes = [1, 70, 0 + 2, 33, 200]
    at = np.concatenate(([0], np.cumsum(sizes)))
    ids = rng.integers(0, len(net.names), at[-1])
    p, s = {k: v.astype(float) for k, v in net.p.items()}, lm.STATE

    def share(logits, i):
        return logits[i] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()
    want = []
    for a, b in zip(at, at[1:]):
        state, before, total = np.zeros(s), net.start, 0.0
        for token in ids[a:b]:
            x, h = p["x"][before], state @ p["h"]
            gates = 1 / (1 + np.exp(-(x[:2 * s] + h[:2 * s])))
            new = np.tanh(x[2 * s:] + gates[s:] * h[2 * s:])
            state = new + gates[:s] * (state - new)
            kind = net.kind[token]
            lo, hi = net.first[kind], net.first[kind + 1]
            total += share(state @ p["c"] + p["cb"], kind) + share(p["w"][lo:hi] @ state + p["wb"][lo:hi], token - lo)
            before = token
        want.append(total)
    assert np.allclose(lm.score_documents(net, ids, at), want, rtol=1e-4, atol=1e-3)
    far = np.asarray([[0.0, -200.0], [-150.0, -149.0], [1.0, 2.0]], np.float32)  # rows too far apart for one top
    work = far.copy()
    total, top = lm._exponentials(work)
    assert np.allclose(np.log(total) + top, np.logaddexp(far[:, 0], far[:, 1]), atol=1e-5)


def test_tasks_begin_from_common_parameters(spark):
    """Tasks of one text each learn the same, whichever worker ran another before."""
    one, many = small_net()[0], small_net()[0]
    for net, tasks in ((one, 1), (many, 12)):
        lm._round(spark.range(0, tasks, 1, tasks).select("id", F.lit("a b c d e f g " * 40).alias("text")), net, "lm-test")
    assert not np.array_equal(one.flat(), small_net()[0].flat())
    assert np.allclose(one.flat(), many.flat(), atol=1e-6)


def test_base_and_held_out(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 3000)  # most words then take the joined way
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    train = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    got = lm.score_texts(frame, train).collect()
    import zlib
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    check(frame, rows, [not held[d] for d, _ in rows], got)
    out = [r for r in got if held[r.doc_id]]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # better than the words' shares alone
    assert all(r.score < 0 for r in got)


def test_lm_edges(spark):
    rows = [(i, t) for i, t, *_ in edge_rows()]
    got = lm.score_texts(edge(spark), F.lit(True)).collect()
    check(None, rows, [True] * len(rows), got)
    none = lm.score_texts(edge(spark), F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and np.isfinite(r.score) for r in none)
    assert lm.score_texts(empty(spark), F.lit(True)).count() == 0


def test_pipeline_stages(spark):
    """Each stage against what it is to do with the rows before it."""
    import corpus_pipeline as pipeline
    from test_jaccard import brute as components
    from test_langid_decontaminate import brute as contained
    from test_quality_secrets import base_spans
    from wardflow.session import materialize

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (None, "the of and to", "en", "s", 1)], docs.schema)
    docs = docs.union(junk)
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), "test-stage")
        if name == "packing":
            break
        assert out.columns == docs.columns
        rows = out.collect()
        if name == "language_id":
            assert {r.doc_id for r in rows} == set(before) - {9001, 9002}
        elif name == "near_duplicates":
            least = {c for _, _, c in components([(d, r.text) for d, r in before.items()])}
            assert {r.doc_id for r in rows} == least
        elif name == "benchmark_decontamination":
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            bad = {d for d, *_ in contained([(d, r.text) for d, r in before.items()], bench)}
            assert bad and {r.doc_id for r in rows} == set(before) - bad
        else:
            for r in rows:
                assert not base_spans(r.text) and r.n_chars == len(r.text)
                assert (r.text == before[r.doc_id].text) or "[secret]" in r.text
            assert {r.doc_id for r in rows} == set(before)
        before, docs = {r.doc_id: r for r in rows}, out
    tokens = {}
    for r in out.collect():
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
        total = r.doc_tokens
        assert total >= 1
    assert set(tokens) == set(before)


def test_whole_pipeline_runs(spark):
    import corpus_pipeline as pipeline

    got = pipeline.run(spark, SF)
    assert got.count() > 0 and "sequence_id" in got.columns


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline as pipeline

    names = ("language_kept", "language_p", "secret_spans", "__base", "__tokens", "__said", "__host", "__text")
    docs = edge(spark).withColumns({n: F.lit(f"own {n}") for n in names})
    for stage in (pipeline.language_id, pipeline.secret_scans):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r.language == "zz" and all(r[n] == f"own {n}" for n in names) for r in rows)
