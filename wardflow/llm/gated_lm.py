"""A gated recurrent language model, trained and applied inside Spark tasks.

* Words are counted over all training texts. The ``vocabulary`` most frequent
  are the network's; every other word is its unknown word, times the word's
  smoothed share of all such words. Both the network and the unigram base thus
  give every text, of any words, a probability.
* The network is a gated recurrent unit in numpy. Its output is factored into
  classes of about equal mass, P(class | state) P(word | class, state), so a word
  costs about the square root of the vocabulary. The output biases begin at the
  logarithms of the counts: untrained, the network is the unigram model.
* Training is truncated backpropagation through time with Adagrad. Documents are
  dealt to lanes that step together; the state runs on over the windows of a
  document and starts anew with the next. Every task trains on its own texts from
  common parameters, and the mean of all tasks' parameters, weighted by tokens, is
  where the next round begins. Each training text is used in one of ``ROUNDS``, so
  the work follows the corpus; what is averaged has the fixed size of the network,
  and is summed in a tree of tasks.
* Scoring carries the state over all windows of a document, from first to last
  word. The counts of the ``HEAD`` most frequent words go to the tasks; those of
  all others are joined.
"""

from __future__ import annotations

import copy

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import bounded_batches, lower_ascii, span_hashes, text_buffer, word_spans
from wardflow.session import materialize

#: Network: words, classes, state, window (steps of backpropagation), lanes.
VOCABULARY, CLASSES, STATE, WINDOW = 2048, 48, 16, 32
TRAIN_LANES, SCORE_LANES = 192, 512
#: Words whose counts are sent to the tasks (16 bytes each).
HEAD = 1 << 17
#: Tokens that a task holds at once, besides a longer single document.
HOLD = 3_000_000
#: Eighths of the training texts used in each round of averaging.
ROUNDS = ((0,), (1, 2), (3, 4, 5, 6, 7))
FAN_IN = 32
RATE = 0.06
END = np.uint64(0x656E642D6F662D74)  # stands for the end of a text among word hashes


def word_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words, then one end per text) and each text's bounds."""
    data, offsets = text_buffer(column)
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, offsets)
    n = np.diff(first) + 1
    at = np.concatenate(([0], np.cumsum(n)))
    out = np.full(at[-1], END, np.uint64)
    out[np.arange(len(starts)) + np.repeat(np.arange(len(n)), n - 1)] = span_hashes(data, starts, ends)
    return out, at


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray | np.float32]:
    """exp(logits - top) in place; the sum of each row and ``top``, one number for all
    rows, or each row's own where the logits lie too far apart for that."""
    top = logits.max()
    if top - logits.min() > 60:
        top = logits.max(axis=1)
        logits -= top[:, None]
    else:
        logits -= top
    np.exp(logits, out=logits)
    return logits @ np.ones(logits.shape[1], np.float32), top


class Network:
    """Parameters of one network; ``words`` are hashes by class, the unknown word
    last among equals. Ids are places in ``words``; ``start`` precedes a text."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, unknown: float, seed: int = 1):
        mass = np.concatenate((counts, [unknown])).astype(float) + 1
        names = np.concatenate((words, [np.uint64(0)]))
        order = np.argsort(-mass, kind="stable")
        mass, names = mass[order], names[order]
        share = (np.cumsum(mass) - mass / 2) / mass.sum()
        kind = np.minimum((share * CLASSES).astype(np.int64), CLASSES - 1)
        kind = np.unique(kind, return_inverse=True)[1].astype(np.int16)  # sorted by radix
        self.names, self.kind = names, kind
        self.first = np.concatenate((np.searchsorted(kind, np.arange(kind[-1] + 1)), [len(kind)]))
        self.unknown = int(np.flatnonzero(order == len(words))[0])
        known = np.flatnonzero(np.arange(len(names)) != self.unknown)
        by_hash = known[np.argsort(names[known], kind="stable")]
        self.sorted, self.places = names[by_hash], by_hash
        self.start = len(names)
        rng = np.random.default_rng(seed)
        total = np.add.reduceat(mass, self.first[:-1])
        shape = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        self.p = {"x": shape(len(names) + 1, 3 * STATE), "h": shape(STATE, 3 * STATE), "c": shape(STATE, len(total)) * 0,
                  "cb": np.log(total / total.sum()).astype(np.float32), "w": shape(len(names), STATE) * 0,
                  "wb": np.log(mass / total[kind]).astype(np.float32)}
        self.p["c"] += shape(*self.p["c"].shape)
        self.p["w"] += shape(*self.p["w"].shape)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.full(len(hashes), self.unknown)
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.places[at], self.unknown)

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at:at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size

    # one window: tokens (steps x lanes), fresh marks the first token of a text
    def forward(self, before: np.ndarray, fresh: np.ndarray, state: np.ndarray):
        s, wh = STATE, self.p["h"]
        x = self.p["x"][before]
        kept = []
        states = np.empty((*before.shape, s), np.float32)
        for t in range(len(before)):
            prev = state
            if fresh[t].any():
                prev = np.where(fresh[t][:, None], np.float32(0), state)
            a = prev @ wh
            gates = a[:, :2 * s] + x[t, :, :2 * s]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates[:, :s], gates[:, s:]
            new = r * a[:, 2 * s:]
            new += x[t, :, 2 * s:]
            np.tanh(new, out=new)
            state = prev - new
            state *= z
            state += new
            states[t] = state
            kept.append((prev, z, r, new, a[:, 2 * s:]))
        return states, state, kept

    def output(self, states: np.ndarray, target: np.ndarray, gradient: bool):
        """Natural log-probabilities of the targets, and with ``gradient`` those by
        parameter and state. ``states``: positions x state."""
        p = self.p
        order = np.argsort(self.kind[target], kind="stable")  # a class is a slice from here on
        states, target = states[order], target[order]
        kind = self.kind[target]
        rows = np.arange(len(target))
        e = states @ p["c"]
        e += p["cb"]
        chosen = e[rows, kind]
        total, top = _exponentials(e)
        logp = chosen - top - np.log(total)
        grads = {}
        if gradient:
            e /= total[:, None]
            e[rows, kind] -= 1
            grads = {"c": states.T @ e, "cb": e.sum(axis=0), "w": np.zeros_like(p["w"]), "wb": np.zeros_like(p["wb"])}
            back = e @ p["c"].T
        bounds = np.searchsorted(kind, np.arange(len(self.first)))
        for k in range(len(self.first) - 1):
            a, b = self.first[k], self.first[k + 1]
            u, v = bounds[k], bounds[k + 1]
            if b - a < 2 or u == v:
                continue
            own, place, row = states[u:v], target[u:v] - a, rows[:v - u]
            inner = own @ p["w"][a:b].T
            inner += p["wb"][a:b]
            chosen = inner[row, place]
            ti, top = _exponentials(inner)
            logp[u:v] += chosen - top - np.log(ti)
            if gradient:
                inner /= ti[:, None]
                inner[row, place] -= 1
                grads["w"][a:b], grads["wb"][a:b] = inner.T @ own, inner.sum(axis=0)
                back[u:v] += inner @ p["w"][a:b]
        out = np.empty_like(logp)
        out[order] = logp
        if gradient:
            unsorted = np.empty_like(back)
            unsorted[order] = back
        return out, grads, unsorted if gradient else None

    def backward(self, before, fresh, kept, back, grads):
        s, wh = STATE, self.p["h"]
        dx = np.empty((*before.shape, 3 * s), np.float32)
        dh, dwh = np.zeros_like(back[0]), np.zeros_like(wh)
        da, work = np.empty((before.shape[1], 3 * s), np.float32), np.empty((before.shape[1], s), np.float32)
        for t in range(len(before) - 1, -1, -1):
            prev, z, r, new, an = kept[t]
            d = dh
            d += back[t]
            keep = 1 - z
            dn = d * keep
            np.multiply(new, new, out=work)
            np.subtract(1, work, out=work)
            dn *= work
            np.subtract(prev, new, out=work)
            work *= d
            work *= z
            np.multiply(work, keep, out=da[:, :s])
            np.multiply(dn, an, out=work)
            work *= r
            np.subtract(1, r, out=keep)
            np.multiply(work, keep, out=da[:, s:2 * s])
            np.multiply(dn, r, out=da[:, 2 * s:])
            dx[t, :, :2 * s], dx[t, :, 2 * s:] = da[:, :2 * s], dn
            dwh += prev.T @ da
            dh = da @ wh.T
            d *= z
            dh += d
            if fresh[t].any():
                dh[fresh[t]] = 0
        grads["h"] = dwh
        token = before.ravel()
        order = np.argsort(token, kind="stable")
        heads = np.flatnonzero(np.concatenate(([True], np.diff(token[order]) != 0)))
        return token[order][heads], np.add.reduceat(dx.reshape(-1, 3 * s)[order], heads, axis=0)


def lanes(sizes: np.ndarray, count: int) -> list[np.ndarray]:
    """Documents dealt to lanes, longest first, each to the shortest lane so far."""
    import heapq

    heap = [(0, i) for i in range(min(count, max(len(sizes), 1)))]
    out: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-sizes, kind="stable").tolist():
        n, i = heapq.heappop(heap)
        out[i].append(d)
        heapq.heappush(heap, (n + int(sizes[d]), i))
    return [np.asarray(x, np.int64) for x in out]


def _windows(net: Network, ids: np.ndarray, at: np.ndarray, count: int):
    """Windows of all documents in lanes: (before, target, fresh, position); lanes
    that have ended drop out, so position maps back to ``ids``."""
    sizes = np.diff(at)
    dealt = lanes(sizes, count)
    mixed = np.random.default_rng(0)  # long and short ones in turn
    order = [np.concatenate([np.arange(at[d], at[d + 1]) for d in mixed.permutation(x)]) if len(x) else np.zeros(0, np.int64) for x in dealt]
    order.sort(key=len, reverse=True)  # so that the lanes still running are the first ones
    lengths = np.asarray([len(x) for x in order])
    head = np.zeros(len(ids) + 1, bool)
    head[at] = True
    before = np.concatenate(([net.start], ids[:-1])) if len(ids) else ids
    before = np.where(head[:-1], net.start, before)
    t = 0
    while t < (lengths[0] if len(lengths) else 0):
        running = int((lengths > t).sum())
        steps = int(min(WINDOW, lengths[running - 1] - t))
        place = np.stack([x[t:t + steps] for x in order[:running]], 1)
        yield before[place], ids[place], head[place], place
        t += steps


def score_documents(net: Network, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural log-likelihood of each document, state carried over its windows."""
    out = np.zeros(len(ids))
    state = None
    for before, target, fresh, place in _windows(net, ids, at, SCORE_LANES):
        state = np.zeros((before.shape[1], STATE), np.float32) if state is None else state[:before.shape[1]]
        states, state, _ = net.forward(before, fresh, state)
        out[place.ravel()] = net.output(states.reshape(-1, STATE), target.ravel(), False)[0]
    return np.add.reduceat(out, at[:-1]) if len(at) > 1 else np.zeros(0)


def train_documents(net: Network, ids: np.ndarray, at: np.ndarray, memory: dict) -> int:
    """One pass of truncated backpropagation; ``memory`` holds Adagrad's sums."""
    state = None
    for before, target, fresh, _ in _windows(net, ids, at, TRAIN_LANES):
        state = np.zeros((before.shape[1], STATE), np.float32) if state is None else state[:before.shape[1]]
        states, state, kept = net.forward(before, fresh, state)
        _, grads, back = net.output(states.reshape(-1, STATE), target.ravel(), True)
        scale = np.float32(1 / (TRAIN_LANES * WINDOW))  # a window of few lanes moves little
        token, dx = net.backward(before, fresh, kept, (back * scale).reshape(*before.shape, STATE), grads)
        grads["h"] = grads["h"] / scale  # already scaled through ``back``
        for k, g in grads.items():
            g = np.clip(g * scale, -1, 1)
            m = memory.setdefault(k, np.full_like(net.p[k], 1e-6))
            m += g * g
            net.p[k] -= RATE * g / np.sqrt(m)
        dx = np.clip(dx, -1, 1)
        m = memory.setdefault("x", np.full_like(net.p["x"], 1e-6))
        m[token] += dx * dx
        net.p["x"][token] -= RATE * dx / np.sqrt(m[token])
    return len(ids)


def _held(batches, net: Network, columns):
    """Documents of many batches together, up to HOLD tokens: (rows, hashes, ids, bounds)."""
    rows, hashes, sizes, held = [], [], [], 0
    for b in batches:
        words, at = word_ids(b.column(b.num_columns - 1))
        rows.append([b.column(i) for i in range(columns)])
        hashes.append(words)
        sizes.append(np.diff(at))
        held += len(words)
        if held >= HOLD:
            yield rows, np.concatenate(hashes), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
            rows, hashes, sizes, held = [], [], [], 0
    if held:
        yield rows, np.concatenate(hashes), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))


def _round(texts: DataFrame, net: Network, name: str) -> None:
    """Train on ``texts`` in all tasks and set ``net`` to their weighted mean."""
    shared = texts.sparkSession.sparkContext.broadcast(net)  # fixed size

    def train(batches):
        own: Network = copy.copy(shared.value)  # a reused worker keeps the broadcast object for its next task
        own.p = {k: v.copy() for k, v in own.p.items()}
        memory, n = {}, 0
        for _, hashes, at in _held(batches, own, 0):
            n += train_documents(own, own.ids(hashes), at, memory)
        if n:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([float(n)]),
                                              pa.array([(own.flat().astype(np.float64) * n).tobytes()], pa.binary())], ["part", "weight", "total"])

    def add(batches):
        weight, total, part = 0.0, None, 0
        for b in batches:
            for p, w, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                v = np.frombuffer(v.as_buffer(), np.float64)
                weight, total, part = weight + w, v.copy() if total is None else total + v, p
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([weight]), pa.array([total.tobytes()], pa.binary())],
                                             ["part", "weight", "total"])

    schema = "part int, weight double, total binary"
    sums = materialize(texts.mapInArrow(train, schema), name)
    while (n := sums.count()) > 1:  # tasks left
        groups = -(-n // FAN_IN)
        dealt = sums.repartition(groups, F.col("part") % groups) if groups > 1 else sums.coalesce(1)
        sums = materialize(dealt.mapInArrow(add, schema), name)
    for r in sums.collect():  # one row, or none without texts
        net.load(np.frombuffer(r["total"], np.float64) / r["weight"])


def word_counts(texts: DataFrame) -> DataFrame:
    """(w, c): hashes and counts of all tokens."""
    def run(batches):
        for b in batches:
            w, n = np.unique(word_ids(b.column(0))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], ["w", "c"])

    return materialize(texts.mapInArrow(run, "w long, c long").groupBy("w").agg(F.sum("c").alias("c")), "lm-counts")


class LanguageModel:
    """Counts and network; ``fit`` learns both from (id, text) rows."""

    def __init__(self, spark: SparkSession, counts: DataFrame):
        self.spark, self.counts = spark, counts
        total = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
        self.tokens, self.distinct = int(total[0] or 0), int(total[1])
        top = counts.orderBy(F.desc("c"), "w").limit(HEAD).toPandas()  # HEAD rows at most
        words, c = top["w"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
        n = min(VOCABULARY, len(words))
        self.rare_tokens, self.rare_words = self.tokens - int(c[:n].sum()), self.distinct - n
        self.net = Network(words[:n], c[:n], self.rare_tokens)
        order = np.argsort(words)
        self.words, self.c = words[order], c[order]

    @classmethod
    def fit(cls, texts: DataFrame) -> "LanguageModel":
        bounded_batches(texts.sparkSession)
        model = cls(texts.sparkSession, word_counts(texts.select("text")))
        eighth = F.pmod(F.xxhash64("id", "text"), F.lit(8))
        for k, some in enumerate(ROUNDS):
            _round(texts.where(eighth.isin(*some)).select("text"), model.net, f"lm-round-{k}")
        return model

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` (any columns, ``text`` last) without its text, with ``n_tokens``,
        ``n_known``, ``base_score`` and ``score`` (log10)."""
        shared = self.spark.sparkContext.broadcast((self.net, self.words, self.c))  # fixed size, HEAD entries at most
        kept = docs.columns[:-1]
        held = docs.toDF(*[f"c{i}" for i in range(len(kept))], "text")
        fields = "".join(f"c{i} {f.dataType.simpleString()}, " for i, f in enumerate(held.schema.fields[:-1]))

        def run(batches):
            net, words, c = shared.value
            task, count = TaskContext.get().partitionId() << 33, 0
            for rows, hashes, at in _held(batches, net, len(kept)):
                ids = net.ids(hashes)
                own = score_documents(net, ids, at) / np.log(10)
                place = np.minimum(np.searchsorted(words, hashes), max(len(words) - 1, 0))
                here = words[place] == hashes if len(words) else np.zeros(len(hashes), bool)
                log_c = np.where(here, np.log10(c[place] + 1.0) if len(words) else 0.0, 0.0)
                rare = ids == net.unknown
                text = np.repeat(np.arange(len(at) - 1), np.diff(at))
                per = lambda v: np.bincount(text, weights=v, minlength=len(at) - 1)
                away = np.flatnonzero(~here)
                key, n = np.unique(np.stack((text[away].astype(np.uint64), hashes[away])), axis=1, return_counts=True) \
                    if len(away) else (np.zeros((2, 0), np.uint64), np.zeros(0, np.int64))
                bounds = np.searchsorted(key[0], np.arange(len(at)))
                kind = pa.list_(pa.int64())
                tail = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(key[1].view(np.int64))).cast(kind)
                times = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(n.astype(np.int64))).cast(kind)
                size = len(at) - 1
                table = [pa.concat_arrays([r[i] for r in rows]) for i in range(len(kept))]
                cols = [*table, pa.array(np.arange(size) + task + count), pa.array(np.diff(at)), pa.array(per(here).astype(np.int64)),
                        pa.array(per(log_c)), pa.array(own), pa.array(per(np.where(rare, log_c, 0.0))), pa.array(per(rare).astype(np.int64)), tail, times]
                names = [*[f"c{i}" for i in range(len(kept))], "row", "n_tokens", "known", "head", "own", "rare", "n_rare", "tail", "times"]
                count += size
                whole = pa.RecordBatch.from_arrays(cols, names)
                for x in range(0, size, 2000):
                    yield whole.slice(x, 2000)

        rows = materialize(held.mapInArrow(run, fields + "row long, n_tokens long, known long, head double, own double, rare double, "
                                           "n_rare long, tail array<long>, times array<long>"), "lm-rows")
        away = rows.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select("row", F.col("t.tail").alias("w"), F.col("t.times").alias("n"))
        more = (away.join(self.counts, "w").groupBy("row")
                .agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more")))
        every = float(np.log10(self.tokens + self.distinct + 1))
        unknown = float(np.log10(self.rare_tokens + self.rare_words + 1))
        zero = lambda c: F.coalesce(F.col(c), F.lit(0))
        out = rows.join(more, "row", "left").select(
            *[F.col(f"c{i}").alias(f"k{i}") for i in range(len(kept))], "n_tokens", (F.col("known") + zero("more_known")).alias("n_known"),
            (F.col("head") + zero("more") - F.col("n_tokens") * every).alias("base_score"),
            (F.col("own") + F.col("rare") + zero("more") - F.col("n_rare") * unknown).alias("score"))
        return out.toDF(*kept, "n_tokens", "n_known", "base_score", "score")


def score_texts(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows where ``training`` holds and score all of them: id,
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    A null, empty or blank text is its end alone. Repeated rows count and score each.
    Without training rows every token is unknown to a network that knows nothing
    else. An empty table gives none; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), training.alias("training"), F.col(text_col).cast("string").alias("text"))
    model = LanguageModel.fit(rows.where(F.coalesce("training", F.lit(False))).select("id", "text"))
    return model.score(rows.select("id", "text")).select(
        F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
