"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its own embedding beside the mean embedding of its character n-grams, so spelling
families count as much as known words.  Texts are scored in overlapping windows, all of them, and a
document is as toxic as its worst window.  Training has labels of documents only: it alternates
between scoring all windows of the sample and learning from the worst window of each document.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, give_back, lower_ascii, setting, span_hashes, text_bytes, text_slices

#: Labelled documents that training reads at most, of either label.
TRAIN_TOXIC, TRAIN_CLEAN = 1200, 2400
#: Of a longer document, training reads so many pieces of so many characters, spread evenly over it.
TRAIN_PIECES, PIECE = 24, 4000
#: Parts of the sample that are scored by networks trained on the others, to calibrate scores.
FOLDS = 3
WINDOW, STRIDE = 64, 48
WORDS, GRAMS, DIM, HIDDEN = 1 << 13, 1 << 14, 8, 8
#: The logit of a text without any word.
NOTHING = -12.0

_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("0"), ord("9") + 1), *range(128, 256)]] = True


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document) of runs of letters, digits and bytes above ASCII."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_WORD[data]
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = offsets[:-1][(np.diff(offsets) > 0) & (offsets[:-1] > 0)]
    first[edges] = inside[edges + 1]
    last[edges - 1] = inside[edges]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


@dataclass
class Vocabulary:
    """Different words of a slice: bucket of each, and its character n-grams in one flat array."""

    word: np.ndarray
    grams: np.ndarray
    cut: np.ndarray  # start of each word's n-grams

    @staticmethod
    def of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 20_000) -> tuple[Vocabulary, np.ndarray]:
        """And the index into it of every token."""
        hashes = span_hashes(data, starts, ends)
        _, at, index = np.unique(hashes, return_index=True, return_inverse=True)
        index = index.reshape(-1).astype(np.int32)
        bucket = (hashes[at] % np.uint64(WORDS)).astype(np.int32)
        del hashes
        s, e = starts[at], ends[at]
        size = (e - s + 2).astype(np.int32)  # with a mark on either side
        bounds = np.concatenate([[0], np.cumsum(np.maximum(size - 2, 0) + np.maximum(size - 4, 0))]).astype(np.int64)
        grams = np.empty(bounds[-1], np.int32)
        for i in range(0, len(size), block):
            own = slice(i, min(len(size), i + block))
            grams[bounds[own.start] : bounds[own.stop]] = Vocabulary._grams(data, s[own], size[own])
        return Vocabulary(bucket, grams, bounds), index

    @staticmethod
    def _grams(data: np.ndarray, s: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Buckets of the 3- and 5-grams of marked words, word after word."""
        cut = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        flat = np.zeros(cut[-1], np.uint8)
        word_of = np.repeat(np.arange(len(size), dtype=np.int32), size)
        place = np.arange(len(flat), dtype=np.int32) - cut[word_of]
        inner = (place > 0) & (place < size[word_of] - 1)
        flat[inner] = data[s[word_of[inner]] + place[inner] - 1]
        counts = [np.maximum(size - n + 1, 0) for n in (3, 5)]
        bounds = np.concatenate([[0], np.cumsum(counts[0] + counts[1])]).astype(np.int64)
        grams = np.empty(bounds[-1], np.int32)
        for n, before in ((3, 0), (5, counts[0])):
            p = np.flatnonzero(place + n <= size[word_of])
            own = word_of[p]
            grams[bounds[own] + (before if n == 3 else before[own]) + place[p]] = (span_hashes(flat, p, p + n) % np.uint64(GRAMS)).astype(np.int32)
        return grams

    def part(self, ids: np.ndarray) -> Vocabulary:
        n = np.diff(self.cut)[ids]
        cut = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.cut[ids] - cut[:-1], n) + np.arange(cut[-1])
        return Vocabulary(self.word[ids], self.grams[at], cut)


def _windows(doc: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """(token numbers or -1, document) of all windows of WINDOW tokens at every STRIDE; the last may be short."""
    count = np.bincount(doc, minlength=documents)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    windows = np.where(count > 0, 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(documents), windows)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = first[owner] + rank * STRIDE
    at = start[:, None] + np.arange(WINDOW)[None, :]
    return np.where(at < (first + count)[owner][:, None], at, -1), owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _sum_rows(index: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Row sums by index."""
    out = np.zeros((size, rows.shape[1]), np.float32)
    order = np.argsort(index, kind="stable")
    own = index[order]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    if len(first):
        out[own[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


class Network:
    """The parameters, and forward and backward passes over windows of word indices (-1: none)."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        normal = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        self.p = {"words": normal(WORDS, DIM, s=0.1), "grams": normal(GRAMS, DIM, s=0.3), "att": normal(2 * HIDDEN, HIDDEN, s=0.3), "att_b": np.zeros(HIDDEN, np.float32), "att_v": normal(HIDDEN, s=0.3), "out": normal(2 * HIDDEN, s=0.3), "out_b": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"in_{d}": normal(2 * DIM, 3 * HIDDEN, s=0.3), f"bias_{d}": np.zeros(3 * HIDDEN, np.float32), f"rec_{d}": normal(HIDDEN, 3 * HIDDEN, s=0.3)}
        #: Slope and intercept that turn a document's worst logit into its score.
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, v: Vocabulary) -> np.ndarray:
        """A row per word, and one of zeros for places without a word."""
        out = np.zeros((len(v.word) + 1, 2 * DIM), np.float32)
        out[:-1, :DIM] = self.p["words"][v.word]
        if len(v.grams):
            # Marked words have at least three bytes, so each has an n-gram.
            for i in range(0, len(v.word), 10_000):
                own = v.cut[i : i + 10_001]
                rows = self.p["grams"][v.grams[own[0] : own[-1]]]
                out[i : i + len(own) - 1, DIM:] = np.add.reduceat(rows, own[:-1] - own[0], axis=0) / np.diff(own)[:, None]
        return out

    def _gru(self, projected: np.ndarray, ids: np.ndarray, mask: np.ndarray, d: str, keep: list) -> np.ndarray:
        rec, h = self.p[f"rec_{d}"], np.zeros((len(ids), HIDDEN), np.float32)
        states = np.zeros((ids.shape[1], len(ids), HIDDEN), np.float32)
        for t in range(ids.shape[1]) if d == "f" else range(ids.shape[1] - 1, -1, -1):
            a, u = projected[ids[:, t]], h @ rec
            gates = _sigmoid(a[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n = np.tanh(a[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            m = mask[:, t, None]
            new = h + m * (1 - z) * (n - h)
            keep.append((t, h, z, r, n, u[:, 2 * HIDDEN :], m))
            h = states[t] = new
        return states

    def forward(self, x: np.ndarray, ids: np.ndarray, keep: dict) -> np.ndarray:
        """Logits of windows; ``ids`` index the rows of ``x``, whose last row means no word."""
        ids = np.where(ids < 0, len(x) - 1, ids)
        mask = (ids < len(x) - 1).astype(np.float32)
        projected = self.project(x)
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._gru(projected[d], ids, mask, d, kept[d]) for d in "fb"], axis=2)
        hidden = np.tanh(states @ self.p["att"] + self.p["att_b"])
        energy = hidden @ self.p["att_v"] + (mask.T - 1) * 1e4
        weight = np.exp(energy - energy.max(0))
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * states).sum(0)
        keep |= {"ids": ids, "kept": kept, "states": states, "hidden": hidden, "weight": weight, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["out_b"]

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {d: x @ self.p[f"in_{d}"] + self.p[f"bias_{d}"] for d in "fb"}

    def backward(self, v: Vocabulary, x: np.ndarray, keep: dict, error: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients for the logits' errors."""
        g = {"out": keep["pooled"].T @ error, "out_b": error.sum(keepdims=True)}
        d_pooled = error[:, None] * self.p["out"]
        d_states = keep["weight"][:, :, None] * d_pooled
        inner = (keep["states"] * d_pooled).sum(2)
        d_energy = keep["weight"] * (inner - (keep["weight"] * inner).sum(0))
        d_hidden = d_energy[:, :, None] * self.p["att_v"] * (1 - keep["hidden"] ** 2)
        g["att_v"] = (d_energy[:, :, None] * keep["hidden"]).sum((0, 1))
        g["att"] = np.einsum("tbi,tbj->ij", keep["states"], d_hidden)
        g["att_b"] = d_hidden.sum((0, 1))
        d_states += d_hidden @ self.p["att"].T
        d_x = np.zeros_like(x)
        for k, d in enumerate("fb"):
            rec, own = self.p[f"rec_{d}"], d_states[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            d_rec, d_h, inner_all = np.zeros_like(rec), np.zeros_like(own[0]), []
            for t, h, z, r, n, u, m in reversed(keep["kept"][d]):
                total = d_h + own[t]
                d_n = total * m * (1 - z) * (1 - n * n)
                d_z = total * m * (h - n) * z * (1 - z)
                d_r = d_n * u * r * (1 - r)
                d_a = np.concatenate([d_z, d_r, d_n], axis=1)
                d_u = np.concatenate([d_z, d_r, d_n * r], axis=1)
                d_rec += h.T @ d_u
                d_h = total * (1 - m * (1 - z)) + d_u @ rec.T
                inner_all.append((t, d_a))
            d_in = _sum_rows(np.concatenate([keep["ids"][:, t] for t, _ in inner_all]), np.concatenate([a for _, a in inner_all]), len(x))
            g |= {f"rec_{d}": d_rec, f"in_{d}": x.T @ d_in, f"bias_{d}": d_in.sum(0)}
            d_x += d_in @ self.p[f"in_{d}"].T
        size = np.diff(v.cut)
        g["words"] = _sum_rows(v.word, d_x[:-1, :DIM], WORDS)
        g["grams"] = _sum_rows(v.grams, np.repeat(d_x[:-1, DIM:] / size[:, None], size, axis=0), GRAMS)
        return g

    def window_logits(self, v: Vocabulary, ids: np.ndarray, block: int = 1024) -> np.ndarray:
        """The logits of :meth:`forward`, without what training keeps.

        The projection of "no word" closes the update gate, so short windows need no mask there.
        """
        x, h = self.inputs(v), HIDDEN
        half = np.repeat(np.array([0.5, 0.5, 1.0], np.float32), h)  # sigmoid(x) is 0.5 + 0.5 tanh(x / 2)
        projected = {d: x @ (self.p[f"in_{d}"] * half) + self.p[f"bias_{d}"] * half for d in "fb"}
        rec = {d: self.p[f"rec_{d}"] * half for d in "fb"}
        for p in projected.values():
            p[-1, :h] = 30.0
        out = np.empty(len(ids), np.float32)
        for i in range(0, len(ids), block):
            own = ids[i : i + block].T
            at = np.where(own < 0, len(x) - 1, own).astype(np.intp, order="C")
            steps, n = at.shape
            states = np.empty((steps, n, 2 * h), np.float32)
            a, u, gate, new = (np.empty((n, k), np.float32) for k in (3 * h, 3 * h, 2 * h, h))
            for k, d in enumerate("fb"):
                state = np.zeros((n, h), np.float32)
                for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                    np.take(projected[d], at[t], axis=0, out=a, mode="clip")
                    np.dot(state, rec[d], out=u)
                    np.add(a[:, : 2 * h], u[:, : 2 * h], out=gate)
                    np.tanh(gate, out=gate)
                    gate *= 0.5
                    gate += 0.5
                    np.multiply(gate[:, h:], u[:, 2 * h :], out=new)
                    new += a[:, 2 * h :]
                    np.tanh(new, out=new)
                    state -= new
                    state *= gate[:, :h]
                    state += new
                    states[t, :, k * h : (k + 1) * h] = state
            energy = np.tanh(states @ self.p["att"] + self.p["att_b"]) @ self.p["att_v"]
            energy[at == len(x) - 1] = -1e4
            weight = np.exp(energy - energy.max(0))
            value = states @ self.p["out"]
            out[i : i + n] = (weight * value).sum(0) / weight.sum(0)
        return out + self.p["out_b"]

    def score(self, worst: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * worst + self.shift, -30, 30)))


def _worst(logits: np.ndarray, owner: np.ndarray, documents: int) -> np.ndarray:
    out = np.full(documents, NOTHING, np.float64)
    np.maximum.at(out, owner, logits)
    return out


class _Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def step(self, g: dict[str, np.ndarray], decay: float = 1e-4) -> None:
        self.t += 1
        for k in ("words", "grams"):
            self.p[k] *= 1 - decay
        size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        for k, x in g.items():
            x = x * min(1.0, 5.0 / (size + 1e-9))
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.01 * (x * x - self.v[k])
            self.p[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-6)


def _start(net: Network, v: Vocabulary, index: np.ndarray, doc: np.ndarray, toxic: np.ndarray, used: np.ndarray) -> dict[str, np.ndarray]:
    """Start the first embedding dimension from how the labels of the ``used`` documents divide.

    It is the smoothed log odds of a word's or n-gram's documents, in standard errors.  Returns which
    buckets speak for toxicity and are in enough toxic documents; the others stay zero, like unknown words.
    """
    size = len(v.word)
    held = np.zeros((2, size), np.int32)  # toxic and clean documents with each word
    cut = np.searchsorted(doc, np.arange(0, len(toxic) + 100, 100))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        own = used[doc[a:b]]
        pairs = np.unique(doc[a:b][own].astype(np.int64) * size + index[a:b][own])
        for k, bad in enumerate((True, False)):
            np.add.at(held[k], pairs[toxic[pairs // size] == bad] % size, 1)
    n = [int((toxic & used).sum()), int((~toxic & used).sum())]
    least = max(3, n[0] // 200)
    on = {}
    sums = {"words": np.zeros((2, WORDS)), "grams": np.zeros((2, GRAMS))}
    for i in range(0, size, 20_000):
        own = v.part(np.arange(i, min(size, i + 20_000)))
        for k in (0, 1):
            part = held[k][i : i + 20_000]
            sums["words"][k] += np.bincount(own.word, part, WORDS)
            sums["grams"][k] += np.bincount(own.grams, np.repeat(part, np.diff(own.cut)), GRAMS)
    for k, both in sums.items():
        t, c = np.minimum(both[0], n[0]), np.minimum(both[1], n[1])
        on[k] = t >= least
        t, c = t + n[0] / sum(n), c + n[1] / sum(n)
        odds = np.log(t / n[0]) - np.log(c / n[1])
        odds /= np.sqrt(1 / t + 1 / c)
        on[k] &= odds >= 1
        net.p[k][:, 0] = 0.5 * np.clip(odds, -3, 3)
        net.p[k][~on[k]] = 0
    return on


@dataclass
class _Sample:
    """Windows of the training documents: word numbers, owners and labels."""

    vocabulary: Vocabulary
    index: np.ndarray
    doc: np.ndarray
    windows: np.ndarray
    owner: np.ndarray
    toxic: np.ndarray

    def logits(self, net: Network, ids: np.ndarray, block: int = 4096) -> np.ndarray:
        """Of windows, a block at a time, so that only a block's words have embeddings in memory."""
        out = np.empty(len(ids), np.float32)
        for i in range(0, len(ids), block):
            words, local = np.unique(ids[i : i + block], return_inverse=True)
            local = local.reshape(-1, WINDOW)
            if words[0] == -1:
                words, local = words[1:], local - 1
            out[i : i + block] = net.window_logits(self.vocabulary.part(words), local)
        return out

    def train(self, used: np.ndarray, rounds: int, batch: int, seed: int) -> Network:
        """A network fitted on the ``used`` documents."""
        rng, net = np.random.default_rng(seed), Network(seed)
        on = _start(net, self.vocabulary, self.index, self.doc, self.toxic, used)
        ids, home = self.windows[used[self.owner]], self.owner[used[self.owner]]
        adam, bad = _Adam(net.p, 0.01), self.toxic[home]
        some = lambda rows, n: rng.permutation(rows)[:n]
        for k in range(rounds):
            if k == 0:
                chosen = [some(np.flatnonzero(bad), 4000), some(np.flatnonzero(~bad), 4000)]
            else:
                logits = self.logits(net, ids)
                order = np.lexsort((-logits, home))
                rank = np.arange(len(order)) - np.searchsorted(home[order], home[order])
                top = order[rank == 0]
                sure, hard = np.flatnonzero(bad & (logits > 2)), np.flatnonzero(~bad & (logits > -2))
                chosen = [top[bad[top]], some(sure, 2000), some(top[~bad[top]], 2000), some(hard, 2000), some(np.flatnonzero(~bad), 1000)]
            chosen = np.unique(np.concatenate(chosen))
            adam.rate = 0.01 if k < rounds - 2 else 0.003
            steps = max(30, -(-len(chosen) // batch))
            pool = np.concatenate([rng.permutation(chosen) for _ in range(-(-steps * batch // len(chosen)))])
            share = np.clip(bad[chosen].mean(), 0.05, 0.95)
            for s in range(steps):
                pick = pool[s * batch : (s + 1) * batch]
                words, local = np.unique(ids[pick], return_inverse=True)
                local = local.reshape(len(pick), WINDOW)
                if words[0] == -1:
                    words, local = words[1:], local - 1
                v = self.vocabulary.part(words)
                x, keep = net.inputs(v), {}
                out = net.forward(x, local, keep)
                weight = np.where(bad[pick], 0.5 / share, 0.5 / (1 - share))
                g = net.backward(v, x, keep, ((_sigmoid(out) - bad[pick]) * weight / len(pick)).astype(np.float32))
                for name, rows in on.items():
                    g[name][~rows] = 0
                adam.step(g)
        return net

    def worst(self, net: Network, used: np.ndarray) -> np.ndarray:
        """The worst logit of each ``used`` document."""
        own = used[self.owner]
        return _worst(self.logits(net, self.windows[own]), self.owner[own], len(used))[used]


def _sampled(texts: list[str | None], toxic: np.ndarray, seed: int) -> tuple[_Sample, np.ndarray, int] | None:
    """The sample, the fold of each document and how many folds; None without words or two of both labels."""
    rng = np.random.default_rng(seed)
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    data = lower_ascii(data)
    starts, ends, doc = (x.astype(np.int32) for x in _tokens(data, offsets))
    folds = min(FOLDS, int(toxic.sum()), int((~toxic).sum()))
    if not len(starts) or folds < 2:
        return None
    vocabulary, index = Vocabulary.of(data, starts, ends)
    at, owner = _windows(doc, len(texts))
    del data, starts, ends
    windows = np.concatenate([np.where(at[i : i + 4096] < 0, -1, index[np.maximum(at[i : i + 4096], 0)]).astype(np.int32) for i in range(0, len(at), 4096)])
    del at
    part = np.empty(len(toxic), np.int64)
    for own in (np.flatnonzero(toxic), np.flatnonzero(~toxic)):
        part[own] = rng.permutation(len(own)) % folds
    return _Sample(vocabulary, index, doc, windows, owner, toxic), part, folds


def _constant(toxic: np.ndarray, seed: int) -> Network:
    net, base = Network(seed), (toxic.sum() + 1) / (len(toxic) + 2)
    net.scale, net.shift = 0.0, float(np.log(base / (1 - base)))
    return net


def fit_network(texts: list[str | None], toxic: np.ndarray, prior: float | None = None, rounds: int = 7, batch: int = 256, seed: int = 5) -> Network:
    """Train on documents and their labels (0 or 1).  Without two of both labels the score is a constant.

    All documents train the network.  What turns its logits into scores is fitted on logits that
    ``FOLDS`` further networks give to the documents they have not seen; ``prior`` is the share of toxic
    documents there, if the sample has another.
    """
    toxic = np.asarray(toxic, bool)
    sampled = _sampled(texts, toxic, seed)
    if sampled is None:
        return _constant(toxic, seed)
    sample, part, folds = sampled
    worst = np.empty(len(toxic))
    for f in range(folds):
        worst[part == f] = sample.worst(sample.train(part != f, rounds, batch, seed), part == f)
    net = sample.train(np.ones(len(toxic), bool), rounds, batch, seed)
    net.scale, net.shift = _calibrate(worst, toxic, prior)
    return net


def fit_apart(rows: DataFrame, prior: float | None = None, rounds: int = 7, batch: int = 256, seed: int = 5) -> Network:
    """The network of :func:`fit_network` from (__id, __y, __text) rows, one for each id.

    Each of its FOLDS + 1 networks is a task of its own with the whole sample, so neither texts nor
    features reach the driver, only the last network and the logits of the documents.
    """
    last = FOLDS

    def run(group: pa.Table) -> pa.Table:
        f = group.column("__fold")[0].as_py()
        found = sorted(zip(*(group.column(c).to_pylist() for c in ("__id", "__text", "__y")), strict=True), key=lambda r: r[0])
        texts, toxic = [t for _, t, _ in found], np.array([y for *_, y in found], bool)
        del group, found
        sampled = _sampled(texts, toxic, seed)
        net, worst, own = None, np.zeros(0), np.zeros(len(toxic), bool)
        if sampled is None:
            net = _constant(toxic, seed) if f == last else None
        else:
            sample, part, folds = sampled
            if f == last:
                net = sample.train(np.ones(len(toxic), bool), rounds, batch, seed)
            elif f < folds:
                own = part == f
                worst = sample.worst(sample.train(~own, rounds, batch, seed), own)
        columns = [[None if net is None else pickle.dumps(net)], [np.flatnonzero(own).tolist()], [worst.tolist()], [toxic[own].tolist()]]
        kinds = [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_())]
        sample = sampled = None
        give_back()
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["net", "at", "worst", "toxic"])

    # 24 partitions for the four networks: their numbers hash to different ones.
    each = rows.select("__id", "__y", "__text", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("__fold")).repartition(6 * (last + 1), "__fold")
    with setting(rows.sparkSession, spark__sql__execution__arrow__maxBytesPerBatch=str(Scratch.BYTES)):
        parts = each.groupBy("__fold").applyInArrow(run, "net binary, at array<long>, worst array<double>, toxic array<boolean>").collect()
    nets = [r["net"] for r in parts if r["net"] is not None]
    if not nets:
        return _constant(np.zeros(0, bool), seed)
    net = pickle.loads(nets[0])
    at = np.array([i for r in parts for i in r["at"]], np.int64)
    if len(at):
        order = np.argsort(at)
        worst, toxic = (np.array([x for r in parts for x in r[k]], t)[order] for k, t in (("worst", float), ("toxic", bool)))
        net.scale, net.shift = _calibrate(worst, toxic, prior)
    return net


#: The score of a document that is as likely toxic as not.
EVEN = 0.7
#: Share of documents whose label says nothing about their worst logit, as far as calibration goes.
LAPSE = 0.05


def _calibrate(worst: np.ndarray, toxic: np.ndarray, prior: float | None) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through the labels over the worst logits; even odds score ``EVEN``.

    Of all curves on a grid of slopes and places the likeliest, where each document ignores the curve
    with probability ``LAPSE``: a few that the networks cannot know do not flatten it.
    """
    share = toxic.mean()
    prior = share if prior is None else min(max(prior, 1e-3), 1 - 1e-3)
    weight = np.where(toxic, prior / share, (1 - prior) / (1 - share))
    x = np.unique(np.quantile(worst, np.linspace(0, 1, 400)))
    places = (x[1:] + x[:-1]) / 2 if len(x) > 1 else x
    # Finite samples: a label counts for a little less than certain.
    sure = np.where(toxic, (toxic.sum() + 1) / (toxic.sum() + 2), (~toxic).sum() / ((~toxic).sum() + 2))
    spread = float(np.std(worst)) + 1e-6
    best = (-np.inf, 1.0, 0.0)
    for slope in np.geomspace(0.3, 60, 25) / spread:
        p = LAPSE / 2 + (1 - LAPSE) * _sigmoid(slope * (worst[None, :] - places[:, None]))
        good = np.where(toxic, sure * np.log(p) + (1 - sure) * np.log(1 - p), sure * np.log(1 - p) + (1 - sure) * np.log(p)) @ weight
        k = int(good.argmax())
        best = max(best, (float(good[k]), float(slope), float(-slope * places[k])))
    return best[1], best[2] + float(np.log(EVEN / (1 - EVEN)))


def _spread(text: Column) -> Column:
    """A text, or of a long one ``TRAIN_PIECES`` pieces at even distances, whole pieces apart by a line break."""
    pieces = F.ceil(F.length(text) / F.lit(PIECE)).cast("int")
    at = F.transform(F.sequence(F.lit(0), F.lit(TRAIN_PIECES - 1)), lambda k: F.floor(k * (pieces - 1) / F.lit(TRAIN_PIECES - 1)).cast("int"))
    some = F.array_join(F.transform(at, lambda k: F.substring(text, k * PIECE + 1, F.lit(PIECE))), "\n")
    return F.when(pieces <= TRAIN_PIECES, text).otherwise(some)


def train_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", keep: Column | None = None, most: tuple[int, int] = (TRAIN_TOXIC, TRAIN_CLEAN), id_col: str = "doc_id", text_col: str = "text") -> Network:
    """Fit on at most ``most`` (toxic, clean) labelled rows, chosen by a hash of the id, for which ``keep`` holds.

    Null ids and labels do not count; an id whose labels differ counts as toxic; of rows with one id the
    least text is read, so the sample has at most sum(most) rows, each of bounded length; it is trained on
    by executors.  Without two rows of both labels the score is a constant.
    """
    own = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    own = own.where(keep) if keep is not None else own
    own = own.groupBy(F.col(id_col).alias("__id")).agg(F.max((F.col(label_col) != 0).cast("int")).alias("__y"))
    order = [F.md5(F.concat(F.lit("toxicity:"), F.col("__id").cast("string"))), F.col("__id")]
    picked = own.where("__y = 1").orderBy(*order).limit(most[0]).unionByName(own.where("__y = 0").orderBy(*order).limit(most[1]))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__text"))
    count = own.agg(F.count("*").alias("n"), F.sum("__y").alias("t")).first()
    prior = count["t"] / count["n"] if count["n"] else None
    found = rows.join(F.broadcast(picked), "__id").groupBy("__id", "__y").agg(F.min(_spread(F.col("__text"))).alias("__text"))
    return fit_apart(found, prior)


def _judge(net: Network, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(worst logit, windows, start and end of the worst window in bytes, or -1) of each document."""
    n, low = len(offsets) - 1, lower_ascii(data)
    starts, ends, doc = _tokens(low, offsets)
    first = np.full(n, -1, np.int64)
    if not len(starts):
        return np.full(n, NOTHING), np.zeros(n, np.int64), first, first.copy()
    vocabulary, index = Vocabulary.of(low, starts, ends)
    at, owner = _windows(doc, n)
    logits = net.window_logits(vocabulary, np.where(at < 0, -1, index[np.maximum(at, 0)]).astype(np.int32))
    worst, best, last = _worst(logits, owner, n), first.copy(), first.copy()
    hit = np.flatnonzero(logits >= worst[owner])[::-1]
    best[owner[hit]] = hit  # the earliest of equal windows is written last
    some = best >= 0
    rows = at[best[some]]
    first[some] = starts[rows[:, 0]] - offsets[:-1][some]
    last[some] = ends[rows.max(1)] - offsets[:-1][some]
    return worst, np.bincount(owner, minlength=n), first, last


def score_toxicity(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, windows, worst_start, worst_end) of every row, whole texts.

    score is in (0, 1); worst_start and worst_end are the byte span of the worst window (null without
    a word).  Null, empty and wordless texts have no window and the least score.  Repeated rows get
    equal scores; other columns are ignored; an empty table gives an empty result.
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    cell = docs.sparkSession.sparkContext.broadcast(net)  # some hundred KB, fixed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches, "__text", 1 << 20):
            worst, windows, first, last = _judge(cell.value, data, offsets)
            columns = [batch.column(0), pa.array(cell.value.score(worst)), pa.array(windows.astype(np.int64)), pa.array(first, mask=first < 0), pa.array(last, mask=last < 0)]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "score", "windows", "worst_start", "worst_end"])
        give_back()

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    scored = rows.mapInArrow(run, f"`{id_col}` {kind}, score double, windows long, worst_start long, worst_end long")
    return Scratch(docs.sparkSession, "toxicity").result(scored)


def drop_toxic(docs: DataFrame, net: Network, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``threshold``.

    Null, empty and wordless texts stay, repeated rows are judged alike, an empty table stays empty.
    """
    cell, schema = docs.sparkSession.sparkContext.broadcast(net), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_slices(batches, text_col, 1 << 20):
            yield batch.filter(pa.array(cell.value.score(_judge(cell.value, data, offsets)[0]) < threshold))
        give_back()

    return docs.mapInArrow(run, schema)
