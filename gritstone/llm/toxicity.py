"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word's input is a trained vector of the word and the mean of trained vectors of its character n-grams, both by hashed tables. Words go
through gated recurrent units in both directions over windows of ``LENGTH`` words, each half overlapping the next; attention weighs the
states of a window and a logistic unit scores their sum. All windows of a whole text are scored; a text's score is a logistic function of
its highest window's logit, its mean window probability and the expected number of toxic windows.

Training takes at most ``per_class`` labelled documents of either class, those of the smallest hashes of their ids; part of them is held
back to fit the last function. Toxic documents teach by their highest windows, clean ones by their highest and by random ones, chosen
anew with the current network before each pass.

Null and empty texts have no windows and get the score of a text without any sign. Repeated rows get equal results. An empty table gives
an empty result; labels of one class only (or none) give 0 for all. Columns other than doc_id and text (labels: doc_id, toxic) are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gritstone.llm.langid import smallest_hashes
from gritstone.session import ship

LENGTH = 48
STRIDE = LENGTH // 2
WORDS, GRAMS = 1 << 13, 1 << 15
DIM_WORD, DIM_GRAM, HIDDEN, ATTENTION = 8, 12, 8, 8
_MARKS = "\"'`.,;:!?()[]{}<>*#$%&=|/\\~^_-+@"


def normal(token: str) -> str:
    return token.strip(_MARKS).lower() or "."


def gram_slots(word: str) -> list[int]:
    """Table rows of a word's character n-grams of three and five, and of the word with its ends."""
    w = f"<{word}>".encode("utf-8", "surrogatepass")
    n = len(w)
    return [zlib.crc32(w[i : i + k]) % GRAMS for k in (3, 5) for i in range(max(1, n - k + 1))]


def word_slot(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"), 7) % WORDS


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all windows in the joined words of texts with so many words, and each window's text."""
    begins = np.r_[0, np.cumsum(counts)[:-1]]
    number = np.where(counts > 0, np.maximum(1, -(-(counts - STRIDE) // STRIDE)), 0)
    of = np.repeat(np.arange(len(counts)), number)
    within = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
    starts = begins[of] + within * STRIDE
    return starts, np.minimum(starts + LENGTH, begins[of] + counts[of]), of


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights, and their gradients by hand."""

    NAMES = ("word", "gram", "inp", "bias", "rec", "att", "query", "out", "off")

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        f = lambda *shape, s=1.0: (rng.standard_normal(shape) * s).astype(np.float32)
        d = DIM_WORD + DIM_GRAM
        self.word, self.gram = f(WORDS, DIM_WORD, s=0.1), f(GRAMS, DIM_GRAM, s=0.1)
        self.inp, self.bias = f(2, d, 3 * HIDDEN, s=d**-0.5), np.zeros((2, 1, 3 * HIDDEN), np.float32)
        self.rec = f(2, HIDDEN, 3 * HIDDEN, s=HIDDEN**-0.5)
        self.att, self.query = f(2 * HIDDEN, ATTENTION, s=0.3), f(ATTENTION, s=0.3)
        self.out, self.off = f(2 * HIDDEN, s=0.3), np.zeros(1, np.float32)

    def embed(self, slots: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Inputs of distinct words: their word rows, and the means of their n-grams' rows."""
        sizes = np.diff(np.r_[offsets, len(flat)]).astype(np.float32)
        means = np.add.reduceat(self.gram[flat], offsets, axis=0) / sizes[:, None]
        return np.concatenate([self.word[slots], means], axis=1)

    def project(self, inputs: np.ndarray) -> np.ndarray:
        """What inputs add to the gates of both directions: (2, words, 3 * HIDDEN)."""
        return inputs @ self.inp + self.bias

    def states(self, gates: np.ndarray, ids: np.ndarray, keep: bool = False):
        """States of both directions at each place of windows of word ids (n, LENGTH): (LENGTH, 2, n, HIDDEN)."""
        n, h = len(ids), HIDDEN
        all_ = np.empty((LENGTH, 2, n, h), np.float32)
        saved = []
        s = np.zeros((2, n, h), np.float32)
        for t in range(LENGTH):
            x = np.stack([gates[0].take(ids[:, t], axis=0), gates[1].take(ids[:, LENGTH - 1 - t], axis=0)])
            r = s @ self.rec
            zr = _sigmoid(x[..., : 2 * h] + r[..., : 2 * h])
            z, reset = zr[..., :h], zr[..., h:]
            cand = np.tanh(x[..., 2 * h :] + reset * r[..., 2 * h :])
            if keep:
                saved.append((s, z, reset, cand, r[..., 2 * h :]))
            s = cand + z * (s - cand)
            all_[t, 0] = s[0]
            all_[LENGTH - 1 - t, 1] = s[1]
        return (all_, saved) if keep else all_

    def pool(self, states: np.ndarray, mask: np.ndarray):
        """Attention over states, and logits."""
        n = states.shape[2]
        both = states.transpose(0, 2, 1, 3).reshape(LENGTH, n, 2 * HIDDEN)
        key = np.tanh(both @ self.att)
        score = key @ self.query + mask
        score -= score.max(axis=0)
        weight = np.exp(score)
        weight /= weight.sum(axis=0)
        context = np.einsum("tn,tnh->nh", weight, both)
        return both, key, weight, context, context @ self.out + self.off[0]

    def logits(self, gates: np.ndarray, ids: np.ndarray, mask: np.ndarray, batch: int = 1024) -> np.ndarray:
        return np.concatenate([self.pool(self.states(gates, ids[i : i + batch]), mask[:, i : i + batch])[-1] for i in range(0, len(ids), batch)]) if len(ids) else np.zeros(0, np.float32)

    def gradients(self, slots: np.ndarray, flat: np.ndarray, offsets: np.ndarray, ids: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss; word ids point into the given distinct words."""
        h, n = HIDDEN, len(ids)
        inputs = self.embed(slots, flat, offsets)
        gates = self.project(inputs)
        states, saved = self.states(gates, ids, keep=True)
        both, key, weight, context, logit = self.pool(states, mask)
        d_logit = (_sigmoid(logit) - labels) / n
        g = {"out": context.T @ d_logit, "off": np.array([d_logit.sum()])}
        d_context = d_logit[:, None] * self.out
        d_weight = np.einsum("nh,tnh->tn", d_context, both)
        d_both = weight[:, :, None] * d_context
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["query"] = np.einsum("tn,tna->a", d_score, key)
        d_key = d_score[:, :, None] * self.query * (1 - key * key)
        g["att"] = np.einsum("tnh,tna->ha", both, d_key)
        d_both += d_key @ self.att.T
        d_states = d_both.reshape(LENGTH, n, 2, h).transpose(0, 2, 1, 3)
        d_gates = np.zeros_like(gates)
        g["rec"] = np.zeros_like(self.rec)
        ds = np.zeros((2, n, h), np.float32)
        for t in range(LENGTH - 1, -1, -1):
            s, z, reset, cand, r_cand = saved[t]
            ds = ds + np.stack([d_states[t, 0], d_states[LENGTH - 1 - t, 1]])
            dc = ds * (1 - z) * (1 - cand * cand)
            dz = ds * (s - cand) * z * (1 - z)
            dr = dc * r_cand * reset * (1 - reset)
            d_rec = np.concatenate([dz, dr, dc * reset], axis=2)
            d_x = np.concatenate([dz, dr, dc], axis=2)
            g["rec"] += s.transpose(0, 2, 1) @ d_rec
            np.add.at(d_gates[0], ids[:, t], d_x[0])
            np.add.at(d_gates[1], ids[:, LENGTH - 1 - t], d_x[1])
            ds = ds * z + d_rec @ self.rec.transpose(0, 2, 1)
        g["inp"] = inputs.T @ d_gates
        g["bias"] = d_gates.sum(axis=1, keepdims=True)
        d_in = (d_gates @ self.inp.transpose(0, 2, 1)).sum(axis=0)
        g["word"] = np.zeros_like(self.word)
        np.add.at(g["word"], slots, d_in[:, :DIM_WORD])
        g["gram"] = np.zeros_like(self.gram)
        sizes = np.diff(np.r_[offsets, len(flat)])
        np.add.at(g["gram"], flat, np.repeat(d_in[:, DIM_WORD:] / sizes[:, None], sizes, axis=0).astype(np.float32))
        return g


class Vocabulary:
    """Words seen so far and, if there is a network, what they add to its gates; word 0 stands for places after a window's end."""

    def __init__(self, network: Network | None = None, most: int = 300_000):
        self.network, self.most = network, most
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.slots, self.grams, self.done = [word_slot("")], [gram_slots("")], 0
        self.gates = np.zeros((2, 1024, 3 * HIDDEN), np.float32)

    def ids(self, text: str) -> np.ndarray:
        known, out = self.known, []
        tokens = text.split()
        try:
            return np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens))
        except KeyError:
            pass
        for t in tokens:
            i = known.get(t)
            if i is None:
                w = normal(t)
                i = known.get(w)
                if i is None:
                    i = known[w] = len(self.slots)
                    self.slots.append(word_slot(w))
                    self.grams.append(gram_slots(w))
                known[t] = i
            out.append(i)
        return np.array(out, np.int32)

    def flat(self, rows: np.ndarray | range) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = [self.grams[i] for i in rows]
        sizes = np.array([len(x) for x in own])
        return np.array([self.slots[i] for i in rows]), np.concatenate([np.array(x, np.int64) for x in own]), np.r_[0, np.cumsum(sizes)[:-1]]

    def project(self) -> np.ndarray:
        """Gates of all words known by now; only new ones are computed."""
        n = len(self.slots)
        if n > self.done:
            if n > self.gates.shape[1]:
                more = np.zeros((2, max(n, 2 * self.gates.shape[1]), 3 * HIDDEN), np.float32)
                more[:, : self.done] = self.gates[:, : self.done]
                self.gates = more
            assert self.network is not None
            self.gates[:, self.done : n] = self.network.project(self.network.embed(*self.flat(range(self.done, n))))
            self.grams[self.done : n] = [None] * (n - self.done)  # only their gates are needed from now on
            self.done = n
        return self.gates


def _cut(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of windows, 0 after their ends, and the attention's mask."""
    at = starts[:, None] + np.arange(LENGTH)
    inside = at < ends[:, None]
    return np.where(inside, ids[np.minimum(at, len(ids) - 1)], 0), np.where(inside, np.float32(0), np.float32(-1e9)).T


class Scorer:
    """A trained network with the function from windows to a text's score."""

    def __init__(self, network: Network, weights: np.ndarray | None = None):
        self.network = network
        self.weights = np.array([0.0, 1.0, 0.0, 0.0]) if weights is None else weights

    def __getstate__(self):
        return self.network, self.weights

    def __setstate__(self, state):
        self.network, self.weights = state

    @property
    def vocabulary(self) -> Vocabulary:
        if not hasattr(self, "_vocabulary"):
            self._vocabulary = Vocabulary(self.network)
        return self._vocabulary

    def features(self, texts: list[str], most_words: int = 60_000) -> np.ndarray:
        """Of each whole text: the highest window's logit, the mean window probability, log of 1 + expected toxic windows."""
        out = np.tile(np.array([-12.0, 0.0, 0.0]), (len(texts), 1))
        own: list[np.ndarray] = []
        rows: list[int] = []
        held = 0
        for i, t in enumerate(texts):
            if len(self.vocabulary.slots) > self.vocabulary.most and not held:
                self.vocabulary.clear()
            ids = self.vocabulary.ids(t)
            if len(ids):
                own.append(ids)
                rows.append(i)
                held += len(ids)
            if held >= most_words or held and i == len(texts) - 1:
                out[rows] = self._features(own)
                own, rows, held = [], [], 0
        if held:
            out[rows] = self._features(own)
        return out

    def _features(self, own: list[np.ndarray]) -> np.ndarray:
        joined = np.concatenate(own)
        starts, ends, of = windows(np.array([len(x) for x in own]))
        gates = self.vocabulary.project()
        logits = np.empty(len(starts))
        for i in range(0, len(starts), 1024):
            ids, mask = _cut(joined, starts[i : i + 1024], ends[i : i + 1024])
            logits[i : i + 1024] = self.network.logits(gates, ids, mask)
        firsts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        p = np.add.reduceat(_sigmoid(logits), firsts)
        number = np.diff(np.r_[firsts, len(of)])
        return np.stack([np.clip(np.maximum.reduceat(logits, firsts), -12, 12), p / number, np.log1p(p)], axis=1)

    def scores(self, texts: list[str]) -> np.ndarray:
        return _sigmoid(self.features(texts) @ self.weights[1:] + self.weights[0])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, turns: int = 50) -> np.ndarray:
    """Offset and weights by Newton's method."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(turns):
        p = np.clip(_sigmoid(x @ w), 1e-6, 1 - 1e-6)
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (p - y) + ridge * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(texts: list[str], labels: np.ndarray, passes: int = 6, rate: float = 0.02, batch: int = 128, seed: int = 3) -> Scorer | None:
    """A scorer from whole texts; a quarter of them is held back for the last function."""
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    network, vocabulary = Network(seed), Vocabulary()
    own = [vocabulary.ids(t) for t in texts]
    back = rng.random(len(texts)) < 0.25
    usable = [i for i in range(len(texts)) if not back[i] and len(own[i])]
    joined, counts = np.concatenate([own[i] for i in usable]), np.array([len(own[i]) for i in usable])
    starts, ends, of = windows(counts)
    y = labels[usable].astype(np.float32)
    # First order of windows: how often their words' n-grams are in toxic texts rather than in others.
    slots, flat, offsets = vocabulary.flat(range(len(vocabulary.slots)))
    sizes = np.diff(np.r_[offsets, len(flat)])
    seen = np.zeros((2, GRAMS))
    for i, label in zip(usable, labels[usable]):
        words = np.unique(own[i])
        seen[int(label), np.unique(np.concatenate([flat[offsets[w] : offsets[w] + sizes[w]] for w in words]))] += 1
    odds = np.log((seen[1] + 0.5) / (y.sum() + 1)) - np.log((seen[0] + 0.5) / (len(y) - y.sum() + 1))
    of_word = np.maximum.reduceat(odds[flat], offsets)
    rank = np.array([np.sort(of_word[joined[s:e]])[-3:].sum() for s, e in zip(starts, ends)])
    moments = {k: (np.zeros_like(getattr(network, k)), np.zeros_like(getattr(network, k))) for k in Network.NAMES}
    step = 0
    for turn in range(passes):
        if turn:
            gates = network.project(network.embed(slots, flat, offsets))
            rank = np.concatenate([network.logits(gates, *_cut(joined, starts[i : i + 4096], ends[i : i + 4096])) for i in range(0, len(starts), 4096)])
        order = np.lexsort((-rank, of))
        place = np.arange(len(of)) - np.searchsorted(of, of)  # place among its text's windows, highest first
        chosen = order[(place < 2) | ((y[of] == 0) & (rng.random(len(of)) < 0.15))]
        rng.shuffle(chosen)
        for i in range(0, len(chosen), batch):
            which = chosen[i : i + batch]
            ids, mask = _cut(joined, starts[which], ends[which])
            words, local = np.unique(ids, return_inverse=True)
            g = network.gradients(*vocabulary.flat(words), local.reshape(ids.shape), mask, y[of[which]])
            step += 1
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            for k, v in g.items():
                v = v * min(1.0, 1.0 / max(norm, 1e-9))
                m, s = moments[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                lr = rate * min(1.0, step / 20) * (1 - 0.8 * turn / max(1, passes - 1))
                getattr(network, k)[...] -= lr * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
    scorer = Scorer(network)
    held = np.flatnonzero(back)
    if len(set(labels[held].tolist())) < 2:
        held = np.arange(len(texts))
    scorer.weights = _logistic(scorer.features([texts[i] for i in held]), labels[held].astype(float))
    return scorer


def train(df: DataFrame, labels: DataFrame, per_class: int = 1200, seed: int = 13, **settings) -> Scorer | None:
    """A scorer from the documents of ``df`` (training rows only) with labels; at most ``per_class`` of either class reach the driver."""
    named = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = df.where("text is not null").select("doc_id").distinct().join(named, "doc_id")
    chosen = smallest_hashes(ids, "toxic", per_class, seed).select("doc_id", "toxic").collect()
    if not chosen:
        return None
    table = df.sparkSession.createDataFrame(chosen, ids.select("doc_id", "toxic").schema)  # 2 * per_class rows at most
    rows = df.where("text is not null").select("doc_id", "text").join(F.broadcast(table), "doc_id").dropDuplicates(["doc_id"]).toPandas()
    rows = rows.sort_values("doc_id")
    return fit(rows["text"].tolist(), rows["toxic"].to_numpy(np.int64), **settings)


def score(df: DataFrame, scorer: Scorer | None, passing: list[str], text: str = "text") -> DataFrame:
    """The columns ``passing`` with ``score`` of each whole text."""
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(scorer)
    rows = df.select(*passing, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(len(passing)).to_pylist()]
            scores = own.scores(texts) if own is not None else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(passing))), pa.array(scores, pa.float64())], names=[*passing, "score"])

    return rows.mapInArrow(run, df.select(*passing, F.lit(0.0).alias("score")).schema)
