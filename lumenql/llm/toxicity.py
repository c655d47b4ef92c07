"""Toxicity by a subsequence string kernel, Nystroem landmarks and a support vector machine.

A word is compared with landmark words by the gapped subsequences that they share: every
three characters in order, within a span of six, count with a weight that decays with the
span. Inserted characters, gaps and punctuation inside an insult only stretch spans, so
such words stay near the plain one. Nystroem landmarks turn the kernel into a few dozen
coordinates; a squared-hinge support vector machine separates words by the labelled
sentences that hold them. As the machine is linear in the kernel's features, it is folded
into one weight for each subsequence, and scoring a word needs no landmark.

The machine is fitted on words, not on whole sentences: summed over a sentence, the few
subsequences of an insult drown in those of the words around it (README has figures).

A document's score is a logistic function of how many of its words are beyond the margin,
and how far; its parameters come from documents that the words' machine has not seen.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretoken import Cache

ORDER, SPAN, DECAY = 3, 6, 0.7
#: Symbols: 0 for what only makes gaps, a to z, classes of other letters, word start and end.
SYMBOLS, START, STOP = 52, 50, 51
#: Bounds of the fit, all on its bounded sample of labelled rows. Landmarks of the kernel; words that the machine is
#: fitted on, of them at most MARKED_WORDS for their odds and the rest by use; words among which plain landmarks are chosen.
LANDMARKS, MACHINE_WORDS, MARKED_WORDS, SPREAD_WORDS = 128, 20_000, 4000, 512
#: Labelled documents that the fit reads at most, and characters of the longest that it takes.
TRAIN_DOCS, TRAIN_CHARS = 4000, 100_000
PREDICT = 0.7
_SENTENCE = re.compile(r"[.!?\n]+")
_SPACED = re.compile(r"(?:(?<=\s)|^)((?:\S\s){2,}\S)(?=\s|$)")
_GAPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def _symbol(char: str) -> int:
    if "a" <= char <= "z":
        return ord(char) - 96
    return 27 + ord(char) % 23 if char.isalpha() else 0


_symbols = Cache(_symbol, 1 << 12)


def tokens(text: str) -> list[str]:
    """Lower-cased words; single characters that stand in a row also make one word together."""
    low = text.lower()
    out = low.split()
    if sum(len(w) == 1 for w in out) > 2:
        out += [m[1].replace(" ", "") for m in _SPACED.finditer(low)]
    return out


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number, subsequence and value of the words' kernel features, each word of unit length.

    """
    get = _symbols.__getitem__
    rows = [[START, *map(get, w), STOP] for w in words]
    size = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.fromiter((c for r in rows for c in r), np.int64, int(size.sum()))
    word = np.repeat(np.arange(len(rows)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(flat))
    keys, values = [], []
    base = word * SYMBOLS**ORDER
    for a, b in _GAPS:
        at = np.flatnonzero(left > b)
        x, y, z = flat[at], flat[at + a], flat[at + b]
        keep = (x > 0) & (y > 0) & (z > 0)
        keys.append((base[at] + (x * SYMBOLS + y) * SYMBOLS + z)[keep])
        values.append(np.full(int(keep.sum()), DECAY ** (b + 1)))
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key)
    key, value = key[order], value[order]
    if len(key):
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        key, value = key[begin], np.add.reduceat(value, begin)
    word, code = np.divmod(key, SYMBOLS**ORDER)
    norm = np.sqrt(np.bincount(word, value * value, len(rows)))
    return word, code, value / norm[word]


@dataclass
class Model:
    """Weights of subsequences, bias, and the logistic layer over a document's words."""

    weight: np.ndarray
    bias: float
    layer: np.ndarray

    def words(self, words: list[str]) -> np.ndarray:
        """Signed distance of each word from the margin's middle."""
        if not words:
            return np.zeros(0)
        word, code, value = features(words)
        return np.bincount(word, self.weight[code] * value, len(words)) + self.bias

    def score(self, summary: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summary @ self.layer[1:] + self.layer[0], -30, 30)))


def summarize(scores: np.ndarray) -> list[float]:
    """What the logistic layer sees of a document: its largest word scores and its hits."""
    if not len(scores):
        return [-1.5, -1.5, 0.0, 0.0, 0.0]
    top = np.sort(scores)[::-1]
    hits = int((scores > 0).sum())
    return [max(-1.5, min(2.0, top[0])), max(-1.5, min(2.0, top[min(2, len(top) - 1)])), np.log1p(hits), np.log1p(np.maximum(scores, 0).sum()), 10 * hits / (len(scores) + 20)]


def _machine(z: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights (bias last) of a linear squared-hinge machine, by Newton steps with halving."""
    z = np.c_[z, np.ones(len(z))]
    ridge = np.r_[np.ones(z.shape[1] - 1), 1e-6]
    w = np.zeros(z.shape[1])
    loss = lambda w: 0.5 * ridge @ (w * w) + cost @ np.maximum(0, 1 - y * (z @ w)) ** 2
    for _ in range(30):
        slack = 1 - y * (z @ w)
        on = slack > 0
        gradient = ridge * w - 2 * z[on].T @ (cost[on] * slack[on] * y[on])
        step = np.linalg.solve(np.diag(ridge) + 2 * z[on].T @ (z[on] * cost[on, None]), gradient)
        rate, now = 1.0, loss(w)
        while rate > 1e-4 and loss(w - rate * step) > now:
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-6:
            break
    return w


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _fit_words(texts: list[str], toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Folded kernel weights and bias from labelled sentences."""
    seen = [Counter(), Counter()]
    sentences = [1, 1]
    for text, y in zip(texts, toxic):
        for sentence in [*_SENTENCE.split(text)]:
            held = set(tokens(sentence))
            if held:
                sentences[y] += 1
                seen[y].update(held)
    odds = lambda w: np.log((seen[1][w] + 0.5) / sentences[1]) - np.log((seen[0][w] + 0.5) / sentences[0])
    by_use = sorted({*seen[0], *seen[1]}, key=lambda w: (-seen[1][w] - seen[0][w], crc32(w.encode())))
    marked = sorted((w for w in seen[1] if seen[1][w] >= 3), key=lambda w: (-odds(w) * np.sqrt(seen[1][w]), w))
    words = list(dict.fromkeys([*marked[:MARKED_WORDS], *by_use]))[:MACHINE_WORDS]
    if not words:
        return np.zeros(SYMBOLS**ORDER), -1.0
    spread = sorted(by_use[:SPREAD_WORDS], key=lambda w: crc32(w.encode()))
    landmarks = list(dict.fromkeys([*marked[: LANDMARKS * 3 // 4], *spread]))[:LANDMARKS]
    table = np.zeros((SYMBOLS**ORDER, len(landmarks)), dtype=np.float32)
    word, code, value = features(landmarks)
    table[code, word] = value
    kernel = np.zeros((len(words), len(landmarks)))
    for begin in range(0, len(words), 1000):
        word, code, value = features(words[begin : begin + 1000])
        cut = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, int)
        if len(cut):
            kernel[begin + word[cut]] = np.add.reduceat(table[code] * value[:, None], cut, axis=0)
    among = np.zeros((len(landmarks), len(landmarks)))
    word, code, value = features(landmarks)
    np.add.at(among, word, table[code] * value[:, None])
    size, turn = np.linalg.eigh((among + among.T) / 2)
    root = turn[:, size > 1e-6] / np.sqrt(size[size > 1e-6])
    z = kernel @ root
    pos, neg = (np.array([seen[y][w] / sentences[y] for w in words]) for y in (1, 0))
    scale = 2000.0
    fit = _machine(np.r_[z, z], np.r_[np.ones(len(z)), -np.ones(len(z))], scale * np.r_[pos, 3 * neg + 0.5 / sentences[1]])
    return (table @ (root @ fit[:-1])).astype(np.float64), float(fit[-1])


def fit(texts: list[str], toxic: list[int]) -> Model:
    """A model from labelled documents. Without both labels every score is the toxic share."""
    y = np.array(toxic, dtype=np.int64)
    if len(set(toxic)) < 2:
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return Model(np.zeros(SYMBOLS**ORDER), -1.0, np.r_[np.log(rate / (1 - rate)), np.zeros(5)])
    fold = np.array([crc32(t.encode("utf-8", "replace")) % 2 for t in texts])
    summary = np.zeros((len(texts), 5))
    for k in (0, 1):
        rows = np.flatnonzero(fold != k)
        model = Model(*_fit_words([texts[i] for i in rows], y[rows]), np.zeros(6))
        known: dict[str, float] = {}
        for i in np.flatnonzero(fold == k):
            own = tokens(texts[i])
            new = sorted({w for w in own if w not in known})
            known.update(zip(new, model.words(new).tolist()))
            summary[i] = summarize(np.array([known[w] for w in own]))
    layer = _logistic(summary, y)
    return Model(*_fit_words(texts, y), layer)


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", most: int = TRAIN_DOCS) -> Model:
    """Fit on at most ``most`` labelled documents of up to ``TRAIN_CHARS`` characters, in the order of a hash of their ids.

    The fit's bounds are the parameters at the head of this module; scoring reads all
    documents whole. Nulls do not train, a document with two labels is toxic if one says so,
    and of texts that share an id the first by its characters trains.
    """
    picked = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).cast("long").alias("__id")).agg(F.max(label).cast("int").alias("__y"))
    picked = picked.orderBy(F.xxhash64("__id"), "__id").limit(most)
    rows = docs.where(F.col(text_col).isNotNull() & (F.length(text_col) <= TRAIN_CHARS)).select(F.col(id_col).cast("long").alias("__key"), F.col(text_col).alias("__text"))
    found = rows.join(F.broadcast(picked), F.col("__key") == F.col("__id")).select("__id", "__text", "__y")
    found = found.groupBy("__id", "__y").agg(F.min("__text").alias("__text"))  # one text for each of ``most`` ids
    pairs = sorted((r[0], r[1], r[2]) for r in found.select("__id", "__text", "__y").collect())
    return fit([t for _, t, _ in pairs], [y for _, _, y in pairs])


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, n_hits`` of every row; null texts count as empty, very long ones are scored whole, other columns are ignored, and an empty table gives no row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model, known = shared.value, _Known(shared.value)
        for batch in batches:
            rows, hits = [], []
            for text in batch.column(1):
                s = known.scores(tokens(text.as_py() or ""))
                rows.append(summarize(s))
                hits.append(int((s > 0).sum()))
            out = model.score(np.array(rows).reshape(-1, 5))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64()), pa.array(hits, pa.int64())], ["doc_id", "score", "n_hits"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, n_hits long")


class _Known:
    """Scores of words that a task has met, in two generations of bounded size."""

    SIZE = 100_000

    def __init__(self, model: Model):
        self.model, self.young, self.old = model, {}, {}

    def scores(self, words: list[str]) -> np.ndarray:
        young, old = self.young, self.old
        new = {w for w in words if w not in young}
        if new:
            moved = {w: old[w] for w in new if w in old}
            fresh = sorted(new.difference(moved))
            if len(young) + len(new) > self.SIZE:
                self.old, self.young = young, {}
                moved |= {w: young[w] for w in set(words) if w in young}
                young = self.young
            young.update(moved)
            for begin in range(0, len(fresh), 2000):
                part = fresh[begin : begin + 2000]
                young.update(zip(part, self.model.words(part).tolist()))
        return np.fromiter(map(young.__getitem__, words), np.float64, len(words))
