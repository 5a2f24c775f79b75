"""Sentences and a linear model over averaged word and subword embeddings, in numpy.

A sentence is the mean of the embeddings of its words, their subwords (runs of :data:`GRAM` characters with
marked ends) and its word pairs, each hashed into one table. Independent logistic outputs score every area.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np

#: Rows of the embedding table: words and pairs share the lower part, subwords the upper.
WORD_ROWS, GRAM_ROWS, WIDTH, GRAM = 1 << 15, 1 << 14, 16, 4
ROWS = WORD_ROWS + GRAM_ROWS

_BROKEN_WORD = re.compile(r"(?<=\w)-[ \t]*\n[ \t]*(?=\w)")
_BREAK = re.compile(r"(?<=[.!?])\s+|\n\s*\n")
_WORD = re.compile(r"[^\W\d_]+|\d+")


def sentences(text: str) -> list[list[str]]:
    """Lower-case words of each sentence that has a letter; words broken at a line's end are put together, numbers are alike."""
    found = []
    for part in _BREAK.split(_BROKEN_WORD.sub("", text)):
        words = ["0" if w[0].isdigit() else w for w in _WORD.findall(part.lower())]
        if any(w != "0" for w in words):
            found.append(words)
    return found


class Features:
    """Codes for words, with the table rows of each; kept per process, so that a word is hashed once."""

    def __init__(self, most: int = 500_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.rows: list[np.ndarray] = []
        self.hash: list[int] = []

    def of(self, word: str) -> int:
        at = self.code.get(word)
        if at is None:
            h, marked = zlib.crc32(word.encode()), f"<{word}>"
            grams = {zlib.crc32(marked[i : i + GRAM].encode()) % GRAM_ROWS + WORD_ROWS for i in range(max(1, len(marked) - GRAM + 1))} if len(word) > 2 else set()
            at = self.code[word] = len(self.rows)
            self.rows.append(np.array([h % WORD_ROWS, *sorted(grams)], dtype=np.int32))
            self.hash.append(h)
        return at

    def sentence_rows(self, words: list[str]) -> np.ndarray:
        """Table rows of a sentence: words, subwords and pairs of neighbours."""
        codes = [self.of(w) for w in words]
        h = np.array([self.hash[c] for c in codes], dtype=np.int64)
        pairs = ((h[:-1] * 31 + h[1:] * 17 + 7) % WORD_ROWS).astype(np.int32)
        return np.concatenate([*(self.rows[c] for c in codes), pairs])


@dataclass
class Model:
    table: np.ndarray  # ROWS x WIDTH
    out: np.ndarray  # WIDTH x areas
    bias: np.ndarray  # areas

    @classmethod
    def new(cls, areas: int, seed: int = 11) -> Model:
        r = np.random.default_rng(seed)
        return cls(r.normal(0, 0.3, (ROWS, WIDTH)).astype(np.float32), r.normal(0, 0.3, (WIDTH, areas)).astype(np.float32), np.full(areas, -2.0, np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.table, self.out, self.bias]


@dataclass
class Batch:
    """Sentences as flat row numbers with the start of each."""

    rows: np.ndarray
    starts: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(np.append(self.starts, len(self.rows)))


def batch_of(lists: list[np.ndarray]) -> Batch:
    lengths = np.array([len(x) for x in lists], dtype=np.int64)
    return Batch(np.concatenate(lists) if lists else np.empty(0, np.int32), np.cumsum(lengths) - lengths)


def hidden(model: Model, batch: Batch) -> np.ndarray:
    if not len(batch.starts):
        return np.empty((0, WIDTH), np.float32)
    return np.add.reduceat(model.table[batch.rows], batch.starts, axis=0) / batch.lengths[:, None].astype(np.float32)


def probabilities(model: Model, h: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(h @ model.out + model.bias, -30, 30)))


def gradient(model: Model, batch: Batch, target: np.ndarray, weight: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Summed gradient of the weighted logistic loss, and the sum of weights."""
    h = hidden(model, batch)
    p = probabilities(model, h)
    delta = ((p - target) * weight).astype(np.float32)
    back = (delta @ model.out.T) / batch.lengths[:, None].astype(np.float32)
    order = np.argsort(batch.rows, kind="stable")
    ids, first = np.unique(batch.rows[order], return_index=True)
    of = np.repeat(np.arange(len(batch.starts)), batch.lengths)[order]
    table = np.zeros_like(model.table)
    if len(ids):
        table[ids] = np.add.reduceat(back[of], first, axis=0)
    return [table, h.T @ delta, delta.sum(0)], float(weight.sum() / max(1, weight.shape[1]))


class Adam:
    def __init__(self, model: Model, rate: float):
        self.rate, self.t = rate, 0
        self.m = [np.zeros_like(x) for x in model.parts()]
        self.v = [np.zeros_like(x) for x in model.parts()]

    def step(self, model: Model, grads: list[np.ndarray]) -> None:
        self.t += 1
        for x, g, m, v in zip(model.parts(), grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-8)


def retarget(p: np.ndarray, named: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """Targets and weights of sentences from their scores ``p`` and the areas ``named`` for their document.

    A sentence belongs to the best of the named areas if that scores well enough, else to none. An area that is
    not named but scores high is left open at first and believed later: it is touched on in passing.
    """
    best = (p * named).argmax(1)
    target, weight = np.zeros_like(p), np.ones_like(p)
    rows = np.arange(len(p))
    yes = (p[rows, best] >= (0.35 if first else 0.5)) & (named.sum(1) > 0)
    target[rows[yes], best[yes]] = 1
    stray = (p >= 0.8) & (named == 0)
    if first:
        weight[stray] = 0
    else:
        target[stray] = 1
    return target, weight


def document_areas(p: np.ndarray, share: float = 0.25, least: float = 0.5) -> np.ndarray:
    """Which areas hold at least ``share`` of the sentences that belong to any area; a sentence belongs to its best one."""
    best = p.argmax(1)
    sure = p[np.arange(len(p)), best] >= least
    counts = np.bincount(best[sure], minlength=p.shape[1])
    return (counts > 0) & (counts >= share * counts.sum() - 1e-9)


class Scorer:
    """Scores whole texts; the vector of a word is summed up once for each process."""

    def __init__(self, model: Model, most: int = 200_000):
        self.model, self.most = model, most
        self._clear()

    def _clear(self) -> None:
        self.features = Features()
        self.vectors = np.empty((1024, WIDTH), np.float32)
        self.sizes = np.empty(1024, np.int64)
        self.hashes = np.empty(1024, np.int64)
        self.known = 0

    def _learn(self) -> None:
        there = len(self.features.rows)
        if there > len(self.vectors):
            grow = max(there, 2 * len(self.vectors)) - len(self.vectors)
            self.vectors = np.concatenate([self.vectors, np.empty((grow, WIDTH), np.float32)])
            self.sizes, self.hashes = (np.concatenate([x, np.empty(grow, np.int64)]) for x in (self.sizes, self.hashes))
        for c in range(self.known, there):
            rows = self.features.rows[c]
            self.vectors[c] = self.model.table[rows].sum(0)
            self.sizes[c], self.hashes[c] = len(rows), self.features.hash[c]
        self.known = there

    def documents(self, texts: list[list[list[str]]], at_once: int = 200) -> list[np.ndarray]:
        """For each text, given by its sentences, which areas it is chiefly about; some hundred texts are scored together."""
        out: list[np.ndarray] = []
        for i in range(0, len(texts), at_once):
            out += self._some(texts[i : i + at_once])
        return out

    def _some(self, texts: list[list[list[str]]]) -> list[np.ndarray]:
        if len(self.features.rows) > self.most:
            self._clear()
        of, codes, lengths, doc = self.features.of, [], [], []
        for d, text in enumerate(texts):
            for words in text:
                codes += [of(w) for w in words]
                lengths.append(len(words))
                doc.append(d)
        none = np.zeros(len(self.model.bias), bool)
        if not doc:
            return [none for _ in texts]
        self._learn()
        code, length = np.array(codes), np.array(lengths)
        starts = np.cumsum(length) - length
        hash_ = self.hashes[code]
        pair = np.zeros((len(code), WIDTH), np.float32)
        pair[:-1] = self.model.table[(hash_[:-1] * 31 + hash_[1:] * 17 + 7) % WORD_ROWS]
        pair[starts + length - 1] = 0
        sums = np.add.reduceat(self.vectors[code] + pair, starts, axis=0)
        size = np.add.reduceat(self.sizes[code], starts) + length - 1
        p = probabilities(self.model, sums / size[:, None])
        doc = np.array(doc)
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        return [document_areas(p[a:b]) if b > a else none for a, b in zip(first[:-1], first[1:], strict=True)]
