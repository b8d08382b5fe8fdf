"""Document quality by a linear-chain conditional random field over lines.

Every line gets features of its own and of its neighbours. The field labels
lines good or bad; forward-backward marginals of good, weighted by line length,
make the document's score, which a logistic curve turns into a probability.
Lines inherit their document's label for training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.byte_bpe import small_batches

#: Training rows: those labelled documents whose hashed id is smallest, with all their lines.
TRAINING_DOCUMENTS = 4_000
_SHARES = ("upper", "digit", "symbol", "pipe", "sentence", "high")
_CUTS = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.4])
_WORD_CUTS = np.array([0.2, 0.4, 0.6, 0.75, 0.9, 0.97])
_BASE = 4 + (len(_SHARES) + 2) * (len(_CUTS) + 1)
N_FEATURES = 3 * _BASE + 3


def _byte_classes() -> np.ndarray:
    kind = np.zeros(256, np.int64)  # 0: lower-case letters and all else
    kind[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 1
    kind[[ord(c) for c in "0123456789"]] = 2
    kind[[ord(c) for c in "#$%&*@^_=+<>[]{}\\/~`"]] = 3
    kind[ord("|")] = 4
    kind[[ord(c) for c in ".,;:!?'\"()-"]] = 5
    kind[128:] = 6
    kind[[ord(c) for c in " \t\r\f\v"]] = 7
    return kind


_KIND = _byte_classes()


def line_features(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features, bytes) of each line by itself."""
    data = [line.encode() for line in lines]
    sizes = np.array([len(d) for d in data], np.int64)
    owner = np.repeat(np.arange(len(lines)), sizes)
    kinds = _KIND[np.frombuffer(b"".join(data), np.uint8)]
    counts = np.bincount(owner * 8 + kinds, minlength=8 * len(lines)).reshape(-1, 8)
    shares = counts[:, 1:7] / np.maximum(1, sizes - counts[:, 7])[:, None]
    words = [line.split() for line in lines]
    n_words = np.array([len(w) for w in words])
    distinct = np.array([len(set(w)) for w in words]) / np.maximum(1, n_words)
    same_next = np.array([sum(map(str.__eq__, w, w[1:])) for w in words]) / np.maximum(1, n_words)
    steps = [np.searchsorted(_CUTS, shares[:, k]) for k in range(shares.shape[1])]
    steps += [np.searchsorted(_WORD_CUTS, distinct), np.searchsorted(_CUTS, same_next)]
    out = np.zeros((len(lines), _BASE), np.float32)
    out[:, 0] = np.log1p(sizes) / 8
    out[:, 1] = np.log1p(n_words) / 6
    out[:, 2] = np.minimum(sizes / np.maximum(1, n_words), 30) / 10
    out[:, 3] = n_words < 4
    for k, step in enumerate(steps):
        out[np.arange(len(lines)), 4 + k * (len(_CUTS) + 1) + step] = 1
    return out, sizes


def with_neighbours(own: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after in its document."""
    before = np.zeros_like(own)
    before[1:] = own[:-1]
    before[first] = 0
    after = np.zeros_like(own)
    after[:-1] = own[1:]
    after[last] = 0
    edges = np.stack([np.ones(len(own)), first, last], axis=1).astype(np.float32)
    return np.concatenate([own, before, after, edges], axis=1)


def document_lines(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, line bytes, lines per document); lines without words are skipped."""
    split = [[line for line in t.split("\n") if line.strip()] for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    lines = [line for s in split for line in s]
    if not lines:
        return np.zeros((0, N_FEATURES), np.float32), np.zeros(0, np.int64), counts
    own, sizes = line_features(lines)
    ends = np.cumsum(counts[counts > 0])
    first, last = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
    last[ends - 1] = True
    first[np.concatenate([[0], ends[:-1]])] = True
    return with_neighbours(own, first, last), sizes, counts


@dataclass
class LineField:
    """A trained field: label weights, transition scores, logistic curve, share of label 1."""

    weights: np.ndarray  # (features,): score of good against bad
    transitions: np.ndarray  # (2, 2) log potentials
    curve: tuple[float, float]
    prior: float

    def score(self, texts: list[str]) -> np.ndarray:
        features, sizes, counts = document_lines(texts)
        good, _ = marginals(features @ self.weights, self.transitions, counts)
        mean = _weighted_means(good, sizes, counts)
        slope, start = self.curve
        out = 1 / (1 + np.exp(-(slope * mean + start)))
        return np.where(counts == 0, self.prior, out)


def _weighted_means(good: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(counts)), counts)
    weight = np.bincount(owner, sizes, len(counts))
    return np.bincount(owner, sizes * good, len(counts)) / np.maximum(weight, 1)


def marginals(scores: np.ndarray, transitions: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(good) by line, expected transition counts) by scaled forward-backward.

    Documents are walked side by side, longest first, one line position at a time.
    """
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    lengths = counts[order]
    potential = np.exp(transitions)
    half = np.clip(scores, -30, 30) / 2
    emit = np.stack([np.exp(-half), np.exp(half)], axis=1)
    alpha, beta = np.ones_like(emit), np.ones_like(emit)
    longest = int(lengths[0]) if len(lengths) else 0
    for t in range(longest):
        at = starts[: np.searchsorted(-lengths, -t, side="left")] + t
        a = emit[at] if t == 0 else (alpha[at - 1] @ potential) * emit[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    pairs = np.zeros((2, 2))
    for t in range(longest - 1, 0, -1):
        at = starts[: np.searchsorted(-lengths, -t, side="left")] + t
        right = emit[at] * beta[at]
        both = alpha[at - 1][:, :, None] * potential[None] * right[:, None, :]
        pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = right @ potential.T
        beta[at - 1] = b / b.sum(axis=1, keepdims=True)
    joint = alpha * beta
    return joint[:, 1] / joint.sum(axis=1), pairs


def fit(features: np.ndarray, sizes: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 150) -> LineField:
    """Maximise the penalised likelihood by gradient ascent with per-weight steps.

    Without documents of both labels every text gets the share of label 1, or
    0.5 if there are no labels at all.
    """
    prior = float(labels.mean()) if len(labels) else 0.5
    if not 0 < prior < 1:
        return LineField(np.zeros(N_FEATURES), np.zeros((2, 2)), (0.0, float(np.log((prior + 1e-3) / (1 - prior + 1e-3)))), prior)
    truth = np.repeat(labels, counts)
    inner = np.maximum(counts - 1, 0)
    seen = np.array([[inner[labels == 0].sum(), 0], [0, inner[labels == 1].sum()]], float)
    weights, transitions = np.zeros(N_FEATURES), np.zeros((2, 2))
    sums_w, sums_t = np.full(N_FEATURES, 1e-8), np.full((2, 2), 1e-8)
    n = max(1, len(truth))
    for _ in range(rounds):
        good, pairs = marginals(features @ weights, transitions, counts)
        step_w = (features.T @ (truth - good)) / n - 1e-4 * weights
        step_t = (seen - pairs) / n - 1e-2 * transitions
        sums_w += step_w**2
        sums_t += step_t**2
        weights += 0.3 * step_w / np.sqrt(sums_w)
        transitions += 0.1 * step_t / np.sqrt(sums_t)
    good, _ = marginals(features @ weights, transitions, counts)
    filled = counts > 0
    mean, target = _weighted_means(good, sizes, counts)[filled], labels[filled]
    return LineField(weights, transitions, _logistic(mean, target), prior)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and start of a penalised logistic regression, by Newton's method."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(25):
        p = 1 / (1 + np.exp(-design @ beta))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        beta += np.linalg.solve(hessian, design.T @ (y - p) - 0.1 * beta)
    return float(beta[0]), float(beta[1])


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, documents: int = TRAINING_DOCUMENTS) -> LineField:
    """Fit on at most ``documents`` labelled rows that are not held out.

    Labels that are null or contradict each other are left out. Features, not
    texts, reach the driver: a short vector for each line of the documents.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("quality"))
        .where("low = quality").select("doc_id", "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    )
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                features, sizes, counts = document_lines(part.column("text").to_pylist())
                cuts, ends = np.cumsum(counts) - counts, np.cumsum(counts)
                packed = np.packbits(features[:, 4:_BASE].astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.string()),
                        part.column("quality").cast(pa.int32()),
                        pa.array([features[a:b, :4].astype("<f4").tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                        pa.array([packed[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                        pa.array([sizes[a:b].astype("<i8").tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                    ],
                    names=["doc_id", "quality", "numbers", "steps", "sizes"],
                )

    found = rows.mapInArrow(describe, "doc_id string, quality int, numbers binary, steps binary, sizes binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["quality"], r["sizes"]))
    parts = [np.frombuffer(r["sizes"], "<i8") for r in found]
    counts = np.array([len(p) for p in parts], np.int64)
    labels_found = np.array([r["quality"] for r in found], float)
    if not counts.sum():
        return fit(np.zeros((0, N_FEATURES), np.float32), np.zeros(0), counts, labels_found if len(set(labels_found)) < 2 else labels_found[:0])
    numbers = np.concatenate([np.frombuffer(r["numbers"], "<f4").reshape(-1, 4) for r in found])
    width = -(-(_BASE - 4) // 8)
    steps = np.concatenate([np.frombuffer(r["steps"], np.uint8).reshape(-1, width) for r in found])
    own = np.concatenate([numbers, np.unpackbits(steps, axis=1)[:, : _BASE - 4]], axis=1).astype(np.float32)
    ends = np.cumsum(counts[counts > 0])
    first, last = np.zeros(len(own), bool), np.zeros(len(own), bool)
    last[ends - 1] = True
    first[np.concatenate([[0], ends[:-1]])] = True
    return fit(with_neighbours(own, first, last), np.concatenate(parts), counts, labels_found)


def score_quality(docs: DataFrame, model: LineField) -> DataFrame:
    """(doc_id, score), one row per input row, in one pass without a shuffle.

    A null text counts as empty; a text without words gets the share of label 1
    among the training rows. The model is a few hundred numbers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                scores = shared.value.score([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores.astype(float))], names=["doc_id", "score"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: LineField, at_least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``at_least``, unchanged, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                scores = shared.value.score([t or "" for t in part.column("text").to_pylist()])
                yield part.filter(pa.array(scores >= at_least))

    return docs.mapInArrow(run, docs.schema)
