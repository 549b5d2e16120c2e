"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Two layers of one kind, trained end to end in numpy:

* over the characters of a word: a bidirectional GRU and attention pooling give
  the word's character vector;
* over the words of a window: the character vector and a word embedding (one
  for all words that few sample documents hold) go through a second bidirectional GRU and attention pooling to a logit.

A text is read as overlapping windows of 32 words, 16 apart, all of them; its
logit is the largest of its windows.  Words are lower-cased and lose punctuation at their ends; one longer than 16
characters counts as several words of at most 16.

Training uses at most ``sample`` labelled documents per class (those with the
least hash of their id), on the driver: in turns: first on random windows
with the label of the document, then on the windows that decide each document
(the highest of a toxic one, the two highest of a clean one).  Scoring runs
in tasks; character vectors are computed once per distinct word and kept up to
a bound.

Defined results: a null or empty text scores 0; without labelled rows of both
classes every text scores the share of label 1 (0 without any label); null
labels teach nothing; rows that repeat a ``doc_id`` are scored one by one; no
rows give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dichot.llm.spark import ready, written
from dichot.llm.text import slices

SAMPLE = 2000
WINDOW, STRIDE = 32, 16
CHARS, LETTERS = 16, 96
CHAR_SIZE, CHAR_UNITS = 8, 8
WORD_SIZE, WORD_UNITS, WORD_ROWS = 8, 8, 4096
TURNS, INNER = 6, 3
COMMON = 3
CACHE_WORDS = 250_000
#: characters cut from both ends of a word
EDGES = ".,;:!?\"'()[]#*$%&|-"
CHUNK = 1024
THRESHOLD = 0.7


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def _soft(x: np.ndarray) -> np.ndarray:
    """Softsign, the squashing function of the states; a gate is half of one plus it."""
    out = np.abs(x)
    out += 1
    return np.divide(x, out, out=out)


def _gate(x: np.ndarray) -> np.ndarray:
    out = _soft(x)
    out += 1
    out *= np.float32(0.5)
    return out


def _slope(gate: np.ndarray) -> np.ndarray:
    return 0.5 * (1 - np.abs(2 * gate - 1)) ** 2


def _sum_rows(at: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """The values of equal rows, added up."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    new = np.flatnonzero(np.diff(at, prepend=-1))
    out = np.zeros((rows, values.shape[1]), dtype=np.float32)
    out[at[new]] = np.add.reduceat(values[order], new, axis=0)
    return out


class Layer:
    """Bidirectional GRU with attention pooling over rows of a table.

    ``table`` holds one input row per symbol, ``at`` (n, steps) the symbols of
    each sequence, from the left."""

    def __init__(self, rng: np.random.Generator, inputs: int, units: int) -> None:
        def weight(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.units = units
        self.p = {}
        for d in "fb":
            self.p["w" + d], self.p["u" + d] = weight(inputs, 3 * units), weight(units, 3 * units)
            self.p["c" + d] = np.zeros(3 * units, dtype=np.float32)
        self.p["v"] = weight(2 * units, 1)

    def project(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The input part of all gates for every symbol, in both directions."""
        return table @ self.p["wf"] + self.p["cf"], table @ self.p["wb"] + self.p["cb"]

    def pool(self, projected, at: np.ndarray, size: np.ndarray, keep: bool = False):
        """Pooled states (n, 2 * units) of sequences of ``size`` symbols each, and
        what :meth:`back` needs.  Sequences are taken longest first, so that each
        step only touches those that reach it."""
        if not keep and len(at) > CHUNK:
            order = np.argsort(-size, kind="stable")
            out = np.empty((len(at), 2 * self.units), dtype=np.float32)
            for i in range(0, len(at), CHUNK):
                mine = order[i:i + CHUNK]
                out[mine] = self._pool(projected, at[mine], size[mine], False)[0]
            return out, None
        order = np.argsort(-size, kind="stable")
        pooled, kept = self._pool(projected, at[order], size[order], keep)
        out = np.empty_like(pooled)
        out[order] = pooled
        return out, (order, *kept) if keep else None

    def _pool(self, projected, at: np.ndarray, size: np.ndarray, keep: bool):
        h, n, steps = self.units, len(at), int(size[0]) if len(size) else 0
        states = np.zeros((steps, n, 2 * h), dtype=np.float32)
        reach = np.searchsorted(-size, -np.arange(steps), side="left")
        traces = {}
        for d, table in zip("fb", projected):
            u, state, trace = self.p["u" + d], np.zeros((n, h), dtype=np.float32), []
            for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
                k = reach[t]
                before = state[:k]
                x, y = table.take(at[:k, t], axis=0), before @ u
                gates = _gate(x[:, :2 * h] + y[:, :2 * h])
                new = _soft(x[:, 2 * h:] + gates[:, h:] * y[:, 2 * h:])
                if keep:
                    before = before.copy()
                    trace.append((t, k, before, gates[:, :h], gates[:, h:], new, y[:, 2 * h:]))
                state[:k] += (1 - gates[:, :h]) * (new - before)
                states[t, :k, (0 if d == "f" else h):(h if d == "f" else 2 * h)] = state[:k]
            traces[d] = trace
        score = np.where(np.arange(steps)[:, None] < size, (states @ self.p["v"])[:, :, 0], np.float32(-1e9))
        share = np.exp(score - score.max(axis=0)) if steps else score
        share /= share.sum(axis=0)
        pooled = np.einsum("tn,tnk->nk", share, states)
        return pooled, (states, share, traces, at) if keep else None

    def back(self, d_pooled: np.ndarray, kept, table: np.ndarray):
        """Gradients of the parameters and of ``table``."""
        order, states, share, traces, at = kept
        d_pooled = d_pooled[order]
        h, g = self.units, {}
        along = (states * d_pooled[None]).sum(axis=2)
        d_score = share * (along - (share * along).sum(axis=0))
        g["v"] = np.einsum("tnk,tn->k", states, d_score)[:, None]
        d_states = share[:, :, None] * d_pooled[None] + d_score[:, :, None] * self.p["v"][:, 0]
        d_table = np.zeros_like(table)
        for d in "fb":
            u, part = self.p["u" + d], slice(0, h) if d == "f" else slice(h, 2 * h)
            d_u, rows, values = np.zeros_like(u), [], []
            carry = np.zeros((len(at), h), dtype=np.float32)
            for t, k, before, z, r, new, yn in reversed(traces[d]):
                total = carry[:k] + d_states[t, :k, part]
                d_new = total * (1 - z) * (1 - np.abs(new)) ** 2
                d_z = total * (before - new) * _slope(z)
                d_r = d_new * yn * _slope(r)
                d_y = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_u += before.T @ d_y
                carry[:k] = total * z + d_y @ u.T
                rows.append(at[:k, t])
                values.append(np.concatenate([d_z, d_r, d_new], axis=1))
            d_proj = _sum_rows(np.concatenate(rows), np.concatenate(values), len(table))
            g["u" + d], g["c" + d], g["w" + d] = d_u, d_proj.sum(axis=0), table.T @ d_proj
            d_table += d_proj @ self.p["w" + d].T
        return g, d_table


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    words = text.lower().split()
    if max(map(len, words), default=0) > CHARS:
        words = [w[i:i + CHARS] for w in words for i in range(0, len(w), CHARS)]
    return words


def windows(n: int) -> range:
    """Starts of the windows of a text of ``n`` words; together they cover it."""
    return range(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(w.ljust(CHARS, "\0") for w in words).encode("utf-32-le"), dtype=np.uint32).reshape(-1, CHARS)
    at = np.where(codes < 64, codes, 64 + codes % 32)
    at = np.where((codes >= 97) & (codes <= 122), codes - 96, at)
    at = np.where((codes >= 1) & (codes < 64), codes % 32 + 32, at)
    return at.astype(np.int64), np.array([len(w) for w in words])


class Network:
    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.rng = rng
        self.chars, self.words = Layer(rng, CHAR_SIZE, CHAR_UNITS), Layer(rng, 2 * CHAR_UNITS + WORD_SIZE, WORD_UNITS)
        self.p = {"letters": (0.5 * rng.standard_normal((LETTERS, CHAR_SIZE))).astype(np.float32),
                  "rows": (0.1 * rng.standard_normal((WORD_ROWS, WORD_SIZE))).astype(np.float32),
                  "out": (rng.standard_normal((2 * WORD_UNITS, 1)) / 4).astype(np.float32), "bias": np.zeros(1, dtype=np.float32)}
        self.fixed: float | None = None
        self.common: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        self.seen: dict[str, int] = {}
        self.row: dict[str, int] = {}
        self.ahead = self.behind = np.zeros((0, 3 * WORD_UNITS), dtype=np.float32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("seen", "row", "ahead", "behind")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._reset()

    def vectors(self, words: list[str], keep: bool = False):
        """Input rows of words: character vector and word embedding."""
        at, there = _letters(words)
        pooled, kept = self.chars.pool(self.chars.project(self.p["letters"]), at, there, keep)
        rows = np.array([self.common.get(w, 0) for w in words])
        return np.concatenate([pooled, self.p["rows"][rows]], axis=1), rows, kept

    def _index(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The table row of every word; computes those of new words."""
        new = set().union(*texts).difference(self.seen)
        if len(self.seen) + len(new) > CACHE_WORDS and self.seen:
            self._reset()
            new = set().union(*texts)
        plain = {w: w.strip(EDGES) or w for w in new}
        fresh = list(set(plain.values()).difference(self.row))
        for i in range(0, len(fresh), 8192):
            part = fresh[i:i + 8192]
            first, last = len(self.row), len(self.row) + len(part)
            self.row.update(zip(part, range(first, last)))
            if last > len(self.ahead):
                more = np.zeros((last + 32768 - len(self.ahead), 3 * WORD_UNITS), dtype=np.float32)
                self.ahead, self.behind = np.concatenate([self.ahead, more]), np.concatenate([self.behind, more])
            self.ahead[first:last], self.behind[first:last] = self.words.project(self.vectors(part)[0])
        self.seen.update({w: self.row[x] for w, x in plain.items()})
        get = self.seen.__getitem__
        return [np.fromiter(map(get, t), dtype=np.int64, count=len(t)) for t in texts]

    def window_logits(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The logit of every window of every non-empty text."""
        index = self._index(texts)
        starts, ends, counts, base = [], [], [], 0
        for a in index:
            s = np.arange(0, max(1, len(a) - (WINDOW - STRIDE)), STRIDE)
            starts.append(base + s)
            ends.append(np.minimum(base + s + WINDOW, base + len(a)))
            counts.append(len(s))
            base += len(a)
        flat = np.concatenate([*index, np.zeros(WINDOW, dtype=np.int64)])
        start, end = np.concatenate(starts), np.concatenate(ends)
        logit = np.empty(len(start), dtype=np.float32)
        for i in range(0, len(start), 2048):
            place = start[i:i + 2048, None] + np.arange(WINDOW)
            pooled, _ = self.words.pool((self.ahead, self.behind), flat[place], end[i:i + 2048] - start[i:i + 2048])
            logit[i:i + 2048] = (pooled @ self.p["out"])[:, 0] + self.p["bias"]
        return np.split(logit, np.cumsum(counts)[:-1])

    def score(self, texts: list[str | None]) -> list[float]:
        split = [words_of(t) for t in texts]
        if self.fixed is not None:
            return [self.fixed if w else 0.0 for w in split]
        full = [w for w in split if w]
        best = iter([float(_sigmoid(x.max().astype(np.float64))) for x in self.window_logits(full)] if full else [])
        return [next(best) if w else 0.0 for w in split]

    def _params(self):
        for owner in (self, self.chars, self.words):
            for k in owner.p:
                yield owner.p, k

    def step(self, picked: list[list[str]], labels: np.ndarray, weight: np.ndarray, state: dict, rate: float) -> float:
        """One Adam step on windows and their labels; the mean loss."""
        picked = [[w.strip(EDGES) or w for w in x] for x in picked]
        vocabulary = sorted(set().union(*picked))
        place = {w: i for i, w in enumerate(vocabulary)}
        table, rows, kept_chars = self.vectors(vocabulary, keep=True)
        drop = 2 * (self.rng.random((len(vocabulary), 1)) < 0.5).astype(np.float32)
        table[:, 2 * CHAR_UNITS:] *= drop
        at = np.zeros((len(picked), WINDOW), dtype=np.int64)
        for i, w in enumerate(picked):
            at[i, :len(w)] = [place[x] for x in w]
        there = np.array([len(w) for w in picked])
        pooled, kept = self.words.pool(self.words.project(table), at, there, keep=True)
        p = _sigmoid((pooled @ self.p["out"])[:, 0] + self.p["bias"])
        d = (weight * (p - labels) / len(labels)).astype(np.float32)
        grads = {id(self.p): {"out": pooled.T @ d[:, None], "bias": np.array([d.sum()])}}
        g_words, d_table = self.words.back(d[:, None] * self.p["out"][:, 0], kept, table)
        g_chars, d_letters = self.chars.back(np.ascontiguousarray(d_table[:, :2 * CHAR_UNITS]), kept_chars, self.p["letters"])
        d_rows = _sum_rows(rows, d_table[:, 2 * CHAR_UNITS:] * drop, WORD_ROWS)
        grads[id(self.p)] |= {"letters": d_letters, "rows": d_rows}
        grads[id(self.words.p)], grads[id(self.chars.p)] = g_words, g_chars
        state["t"] = t = state.get("t", 0) + 1
        for owner, k in self._params():
            g = np.clip(grads[id(owner)][k], -1, 1).astype(np.float32)
            m, v = state.get((id(owner), k), (np.zeros_like(g), np.zeros_like(g)))
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            state[id(owner), k] = m, v
            owner[k] -= (rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)).astype(np.float32)
        return float(-np.log(np.maximum(np.where(labels > 0, p, 1 - p), 1e-9)).mean())

    def fit(self, texts: list[list[str]], labels: np.ndarray, batch: int = 32) -> list[float]:
        state: dict = {}
        losses = []
        held = Counter(w for t in texts for w in {x.strip(EDGES) or x for x in t})
        often = sorted((w for w, n in held.items() if n >= COMMON), key=lambda w: (-held[w], w))[:WORD_ROWS - 1]
        self.common = {w: i + 1 for i, w in enumerate(often)}
        weight = np.where(labels > 0, max(1.0, (labels == 0).sum() / labels.sum()) ** 0.5, 1.0)
        for turn in range(TURNS):
            if turn == 0:
                picks = [(j, int(s)) for j, t in enumerate(texts) for s in self.rng.choice(
                    windows(len(t)), size=min(3, len(windows(len(t)))), replace=False)]
            else:
                self._reset()
                picks = []
                for i in range(0, len(texts), 256):
                    for j, logit in enumerate(self.window_logits(texts[i:i + 256]), i):
                        for s in np.argsort(-logit)[:1 if labels[j] else 2]:
                            picks.append((j, int(s) * STRIDE))
            for inner in range(INNER):
                rate = 0.015 if turn < TURNS - 1 else 0.015 / 3 ** (inner + 1)
                order, total = self.rng.permutation(len(picks)), []
                for i in range(0, len(order), batch):
                    mine = [picks[k] for k in order[i:i + batch]]
                    told = [j for j, _ in mine]
                    total.append(self.step([texts[j][s:s + WINDOW] for j, s in mine], labels[told], weight[told], state, rate))
                losses.append(float(np.mean(total)))
        self._reset()
        return losses


def train(labelled: DataFrame, sample: int = SAMPLE) -> Network:
    """Fit a network on ``labelled`` (``doc_id, text, toxic``): at most ``sample``
    documents per class reach the driver."""
    ready(labelled)
    rows = []
    for label in (0, 1):
        mine = labelled.where((F.col("toxic") == label) & F.col("text").isNotNull())
        rows += [(r["text"], label) for r in mine.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("text").collect()]
    pairs = [(w, y) for w, y in ((words_of(t), y) for t, y in rows) if w]
    labels = np.array([y for _, y in pairs], dtype=np.float32)
    net = Network()
    if not 0 < labels.sum() < len(labels):
        net.fixed = float(labels.mean()) if len(labels) else 0.0
        return net
    net.fit([w for w, _ in pairs], labels)
    return net


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``sample`` ids a class that have a text.

    The ids are chosen from ids alone; their texts are then picked out where they
    lie, by a broadcast of the chosen ids, so no text is shuffled."""
    told = docs.where(F.col("text").isNotNull()).select("doc_id").join(labels.select("doc_id", "toxic"), "doc_id").distinct()
    ids = [r for label in (0, 1) for r in told.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()]
    chosen = docs.sparkSession.createDataFrame(ids, told.schema)
    return written(docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "labelled")


def score(docs: DataFrame, net: Network) -> DataFrame:
    """``doc_id, score`` for every row of ``docs`` (``doc_id``, ``text``)."""
    spark = ready(docs)
    # parameters of fixed size (under 1 MB)
    shared = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(shared.value.score(part.column("text").to_pylist()), pa.float64())],
                    names=["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
