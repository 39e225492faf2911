"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is the vector of its own hash bucket plus the mean of the vectors of its first
and last characters' buckets.  Two gated recurrent layers read a window of ``WINDOW`` words
forwards and backwards, attention pools their states, a logistic unit scores the window.
Windows overlap (``STRIDE``), all windows of a whole text are scored, and the highest counts.

Training has labels of documents only, so each round scores all windows of a document and
learns from the highest one.  The sample is bounded by parameters; scoring is a map over
documents, in which the input projections of words are remembered.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from citewell.llm.common import map_batches

WINDOW, STRIDE = 64, 48
#: Labelled rows of each class to learn from, at most, and the longest text to learn from, in characters.
PER_CLASS, LONGEST = 1500, 20_000

_WORD_BUCKETS, _CHAR_BUCKETS, _DEPTH, _HIDDEN, _POOL = 1 << 13, 1 << 14, 16, 8, 8
_WORDS = re.compile(r"\w+")
_REMEMBER = 120_000
#: Windows that are read, and words whose vectors are made, side by side: the driver trains, so this bounds its memory.
_SIDE_BY_SIDE = 1024


def buckets(word: str) -> list[int]:
    """The word's bucket, and those of its first two to six and last three and four characters."""
    framed = f"^{word}$"
    parts = [framed[:n] for n in (3, 4, 5, 6, 7)] + [framed[-n:] for n in (4, 5)]
    return [zlib.crc32(word.encode()) % _WORD_BUCKETS] + [zlib.crc32(f"{i > 4}{p}".encode()) % _CHAR_BUCKETS for i, p in enumerate(parts)]


def _features(words: Iterable[str]) -> np.ndarray:
    """The buckets of words, a row for each, without a list for each."""
    return np.fromiter(itertools.chain.from_iterable(map(buckets, words)), np.int32).reshape(-1, 8)


def windows(n: int) -> list[tuple[int, int]]:
    """Begin and end of the windows over ``n`` words; the last one ends with the text."""
    return [(a, min(a + WINDOW, n)) for a in range(0, max(n - WINDOW + STRIDE, 1), STRIDE)] if n else []


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass
class Network:
    """Weights by name, and what is added to the logit so that 0.5 parts the classes best."""

    weights: dict[str, np.ndarray]
    shift: float = 0.0

    @classmethod
    def fresh(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape):
            return (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

        weights = {"words": np.zeros((_WORD_BUCKETS, _DEPTH), np.float32), "chars": np.zeros((_CHAR_BUCKETS, _DEPTH), np.float32)}
        for way in "fb":
            weights |= {f"in_{way}": normal(_DEPTH, 3 * _HIDDEN), f"bias_{way}": np.zeros(3 * _HIDDEN, np.float32), f"state_{way}": normal(_HIDDEN, 3 * _HIDDEN)}
        weights |= {"attend": normal(2 * _HIDDEN, _POOL), "query": normal(_POOL), "out": normal(2 * _HIDDEN), "out_bias": np.zeros(1, np.float32)}
        return cls(weights)

    def inputs(self, features: np.ndarray) -> np.ndarray:
        """Vectors of words from their buckets, those of ``_SIDE_BY_SIDE`` words at once."""
        words, chars, vectors = self.weights["words"], self.weights["chars"], np.empty((len(features), _DEPTH), np.float32)
        for at in range(0, len(features), _SIDE_BY_SIDE):
            part = features[at : at + _SIDE_BY_SIDE]
            vectors[at : at + _SIDE_BY_SIDE] = words[part[:, 0]] + chars[part[:, 1:]].mean(axis=1)
        return vectors

    def projected(self, features: np.ndarray) -> np.ndarray:
        """Gate inputs of words: forwards, then backwards."""
        vectors, w = self.inputs(features), self.weights
        gates = np.empty((len(vectors), 6 * _HIDDEN), np.float32)
        for way, side in (("f", slice(0, 3 * _HIDDEN)), ("b", slice(3 * _HIDDEN, 6 * _HIDDEN))):
            gates[:, side] = vectors @ w[f"in_{way}"]
            gates[:, side] += w[f"bias_{way}"]
        return gates

    def _read(self, gates: np.ndarray, places: np.ndarray, mask: np.ndarray, way: str, keep: bool):
        """States of one direction (windows, steps, hidden); ``places`` and ``mask`` run in its order."""
        h, n = _HIDDEN, len(places)
        state, u = np.zeros((n, h), np.float32), self.weights[f"state_{way}"]
        states, kept = np.zeros((n, places.shape[1], h), np.float32), []
        side = slice(0, 3 * h) if way == "f" else slice(3 * h, 6 * h)
        gates = np.ascontiguousarray(gates[:, side])
        for t in range(places.shape[1]):
            x, hu = gates[places[:, t]], state @ u
            zr = _sigmoid(x[:, : 2 * h] + hu[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * hu[:, 2 * h :])
            after = new + z * (state - new)
            m = mask[:, t : t + 1]
            after = state + m * (after - state)
            if keep:
                kept.append((state, z, r, new, hu[:, 2 * h :]))
            state = after
            states[:, t] = state
        return states, kept

    def forward(self, gates: np.ndarray, places: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Logits of windows; ``places`` (windows, steps) index ``gates`` and count only up to ``lengths``."""
        w, steps = self.weights, np.arange(places.shape[1])
        mask = (steps < lengths[:, None]).astype(np.float32)
        turned = np.where(mask > 0, lengths[:, None] - 1 - steps, steps)
        ahead, kept_f = self._read(gates, places, mask, "f", keep)
        back, kept_b = self._read(gates, np.take_along_axis(places, turned, 1), mask, "b", keep)
        both = np.concatenate([ahead, np.take_along_axis(back, turned[:, :, None], 1)], axis=2)
        hidden = np.tanh(both @ w["attend"])
        scores = np.where(mask > 0, hidden @ w["query"], -1e9)
        share = np.exp(scores - scores.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        pooled = (share[:, :, None] * both).sum(axis=1)
        logits = pooled @ w["out"] + w["out_bias"][0]
        return logits, (mask, turned, kept_f, kept_b, both, hidden, share, pooled) if keep else None

    def backward(self, features: np.ndarray, places: np.ndarray, kept, slope: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of all weights from that of the logits."""
        w, h = self.weights, _HIDDEN
        mask, turned, kept_f, kept_b, both, hidden, share, pooled = kept
        grads = {"out": slope @ pooled, "out_bias": slope.sum(keepdims=True)}
        d_pooled = slope[:, None] * w["out"]
        d_both = share[:, :, None] * d_pooled[:, None]
        d_share = (both * d_pooled[:, None]).sum(axis=2)
        d_scores = share * (d_share - (share * d_share).sum(axis=1, keepdims=True))
        grads["query"] = np.einsum("nt,ntp->p", d_scores, hidden)
        d_hidden = d_scores[:, :, None] * w["query"] * (1 - hidden**2)
        grads["attend"] = np.einsum("nth,ntp->hp", both, d_hidden)
        d_both += d_hidden @ w["attend"].T
        vectors = self.inputs(features)
        d_vectors = np.zeros_like(vectors)
        for way, steps_kept, order, d_states in (
            ("f", kept_f, places, d_both[:, :, :h]),
            ("b", kept_b, np.take_along_axis(places, turned, 1), np.take_along_axis(d_both[:, :, h:], turned[:, :, None], 1)),
        ):
            u, d_u = w[f"state_{way}"], np.zeros_like(w[f"state_{way}"])
            d_state = np.zeros((len(places), h), np.float32)
            d_gates = np.zeros((len(vectors), 3 * h), np.float32)
            for t in reversed(range(places.shape[1])):
                state, z, r, new, hu = steps_kept[t]
                d_all = d_state + d_states[:, t]
                d = d_all * mask[:, t : t + 1]
                d_new = d * (1 - z) * (1 - new**2)
                d_x = np.hstack([d * (state - new) * z * (1 - z), d_new * hu * r * (1 - r), d_new])
                d_hu = np.hstack([d_x[:, : 2 * h], d_new * r])
                d_u += state.T @ d_hu
                d_state = d_all - d + d * z + d_hu @ u.T
                np.add.at(d_gates, order[:, t], d_x)
            grads |= {f"state_{way}": d_u, f"in_{way}": vectors.T @ d_gates, f"bias_{way}": d_gates.sum(axis=0)}
            d_vectors += d_gates @ w[f"in_{way}"].T
        grads["words"], grads["chars"] = np.zeros_like(w["words"]), np.zeros_like(w["chars"])
        np.add.at(grads["words"], features[:, 0], d_vectors)
        np.add.at(grads["chars"], features[:, 1:].ravel(), np.repeat(d_vectors / (features.shape[1] - 1), features.shape[1] - 1, axis=0))
        return grads


class Texts:
    """Words of several texts as numbers, and the windows over them."""

    def __init__(self, texts: list[str], number):
        # Text by text: the words of all texts at once, as strings, take ten times the memory of their numbers.
        found = [np.fromiter(map(number, _WORDS.findall(t.lower())), np.int32) for t in texts]
        starts = np.cumsum([0, *map(len, found)])
        self.flat = np.concatenate([np.zeros(0, np.int32), *found])
        spans = [(i, int(starts[i]) + a, b - a) for i, words in enumerate(found) for a, b in windows(len(words))]
        self.owner, self.begin, self.length = np.array(spans, np.int64).reshape(-1, 3).T

    def places(self, chosen: np.ndarray) -> np.ndarray:
        return self.flat[np.minimum(self.begin[chosen, None] + np.arange(WINDOW), len(self.flat) - 1)]


def logits(network: Network, gates: np.ndarray, texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest window logit of each of ``n`` texts, and which window has it; -inf without words."""
    best, which = np.full(n, -np.inf), np.full(n, -1)
    made = np.zeros(len(texts.owner))
    order = np.argsort(texts.length, kind="stable")
    for at in range(0, len(order), _SIDE_BY_SIDE):
        chosen = order[at : at + _SIDE_BY_SIDE]
        lengths = texts.length[chosen]
        made[chosen] = network.forward(gates, texts.places(chosen)[:, : int(lengths.max())], lengths)[0]
    np.maximum.at(best, texts.owner, made)
    top = made == best[texts.owner]
    which[texts.owner[top][::-1]] = np.flatnonzero(top)[::-1]
    return best, which


def train(texts: list[str], labels: list[int], rounds: int = 14, batch: int = 128, seed: int = 7) -> Network | None:
    """A network from whole labelled texts; None unless both labels occur."""
    if len(set(labels)) < 2:
        return None
    known: dict[str, int] = {}
    read = Texts(texts, lambda w: known.setdefault(w, len(known)))
    features, truth = _features(known), np.array(labels, np.float32)
    network, rng = Network.fresh(seed), np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in network.weights.items()}
    square = {k: np.zeros_like(v) for k, v in network.weights.items()}
    weight = np.where(truth == 1, len(truth) / (2 * truth.sum()), len(truth) / (2 * (1 - truth).sum())).astype(np.float32)
    step, least_steps = 0, 300
    rounds = max(rounds, -(-least_steps * batch // max(len(texts), 1)))
    for turn in range(rounds):
        best, which = logits(network, network.projected(features), read, len(texts))
        if turn == 0:  # nothing is known yet: any window
            which = np.full(len(texts), -1)
            shuffled = rng.permutation(len(read.owner))
            which[read.owner[shuffled]] = shuffled
        rows = rng.permutation(np.flatnonzero(which >= 0))
        for at in range(0, len(rows), batch):
            chosen = rows[at : at + batch]
            windows_, truth_ = which[chosen], truth[chosen]
            lengths = read.length[windows_]
            words, places = np.unique(read.places(windows_)[:, : int(lengths.max())], return_inverse=True)
            places = places.reshape(len(chosen), -1)
            out, kept = network.forward(network.projected(features[words]), places, lengths, keep=True)
            slope = (weight[chosen] * (_sigmoid(out) - truth_) / len(chosen)).astype(np.float32)
            grads = network.backward(features[words], places, kept, slope)
            step += 1
            for name, grad in grads.items():
                mean[name] += 0.1 * (grad - mean[name])
                square[name] += 0.01 * (grad**2 - square[name])
                rate = 0.01 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                network.weights[name] -= rate * mean[name] / (np.sqrt(square[name]) + 1e-6)
    best, _ = logits(network, network.projected(features), read, len(texts))
    order = np.argsort(-best, kind="stable")
    hits = np.cumsum(truth[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + truth.sum())
    top = int(f1.argmax())
    if np.isfinite(best[order[top]]):
        after = best[order[min(top + 1, len(order) - 1)]]
        network.shift = -float((best[order[top]] + (after if np.isfinite(after) else best[order[top]] - 1)) / 2)
    return network


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", column: str = "text", label: str = "toxic") -> Network | None:
    """A network from ``docs`` that ``labels`` (key, label) marks 0 or 1.

    The sample is bounded: ``PER_CLASS`` rows of each class by a hash of the key, texts up to
    ``LONGEST`` characters.  Null texts and labels teach nothing; a row labelled twice counts once,
    with its higher label.  None unless both classes are there.
    """
    marks = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key")).agg(F.max(label).alias("mark"))
    picked = marks.withColumn(
        "place", F.row_number().over(Window.partitionBy("mark").orderBy(F.xxhash64("key"), "key"))
    ).where(F.col("place") <= 2 * PER_CLASS).drop("place")  # some are too long or have no document
    found = docs.where(F.length(column) <= LONGEST).select(F.col(key).alias("key"), F.col(column).alias("text")).join(
        F.broadcast(picked), "key"  # bounded: 2 * PER_CLASS keys of each class
    )
    best = Window.partitionBy("mark").orderBy(F.xxhash64("key"), "key", "text")
    rows = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= PER_CLASS).select("key", "mark", "text").collect()
    rows.sort(key=lambda r: (r.key, r.text))
    return train([r.text for r in rows], [r.mark for r in rows])


def score(
    docs: DataFrame, network: Network | None, keep: tuple[str, ...] = ("doc_id",), column: str = "text", output: str = "score"
) -> DataFrame:
    """``keep`` and ``output``, the score (0 to 1) of every row: the highest of its windows.

    Null and empty texts and those without a word score 0, as does every text without a network.
    Repeated rows get equal scores; other columns are left out.
    """
    kinds = dict(docs.dtypes)
    schema = "".join(f"`{k}` {kinds[k]}, " for k in keep) + f"`{output}` double"
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def start():
        net, known, gates = shared.value, {}, [np.zeros((0, 6 * _HIDDEN), np.float32)]

        def made(*columns):
            texts = [t or "" for t in columns[-1]]
            if net is None or not texts:
                return *columns[:-1], [0.0] * len(texts)
            if len(known) > _REMEMBER:
                known.clear()
                gates[0] = gates[0][:0]
            before = len(known)
            read = Texts(texts, lambda w: known.setdefault(w, len(known)))
            if len(known) > before:
                new = list(known)[before:]
                gates[0] = np.vstack([gates[0], net.projected(_features(new))])
            best, _ = logits(net, gates[0], read, len(texts))
            return *columns[:-1], _sigmoid(best + net.shift)

        return made

    return map_batches(docs.select(*keep, F.col(column)), schema, start)
