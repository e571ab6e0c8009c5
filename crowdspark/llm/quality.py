"""Quality classifier: EM estimates how accurate overlapping heuristics are; their posterior trains a hashed scorer."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.llm.common import mix, small_slices, text_bytes, words

#: Size of the hashed feature space.
FEATURES = 1 << 14
#: Documents that the scorer is fitted on, at most; the labellers' accuracies are estimated on all documents.
FIT_DOCS = 6000
EM_STEPS = 60
FIT_STEPS = 120
THRESHOLD = 0.5
ABSTAIN, BAD, GOOD = 0, 1, 2
LABELLERS = ("capitals", "sign tails", "bars", "stutter", "distinct words", "length", "sentences", "line starts")

SIGNALS = ("words", "capitals", "sign tails", "bars", "stutter", "distinct", "ends")

_UPPER, _LOWER, _DIGIT, _SIGN, _END = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_SIGN[33:48] = _SIGN[58:65] = _SIGN[91:97] = _SIGN[123:127] = True
_END[[33, 46, 63]] = True


def _named(name: str) -> int:
    return crc32(name.encode()) % FEATURES


_BUCKETS = np.array([[_named(f"#{name}{i}") for i in range(13)] for name in SIGNALS])
_EMPTY, _CONSTANT = _named("#empty"), _named("#constant")


def read(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signals ``[text, signal]`` of a text column, and its hashed features as ``text, index, value``.

    Signals: words; shares of words in capitals, with a repeated sign at the end, that are a bar, that repeat
    the word before (if three or more do), that end a sentence; share of distinct words. Features: how often
    each word shape and each pair of neighbouring shapes occurs, and the signals in steps of a tenth. A shape is
    the kinds of letters in a word, its first sign and its last one.
    """
    data, _ = text_bytes(texts)
    hashes, starts, ends, bounds = words(texts)
    count = np.diff(bounds)
    texts_n = len(count)
    row = np.repeat(np.arange(texts_n), count)
    signals = np.zeros((texts_n, len(SIGNALS)))
    signals[:, 0] = count
    if not len(row):
        return signals, np.arange(texts_n), np.full(texts_n, _EMPTY), np.ones(texts_n)

    def inside(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind[data], dtype=np.int32)])
        return total[ends] - total[starts]

    upper, lower, digit = inside(_UPPER), inside(_LOWER), inside(_DIGIT)
    last = data[ends - 1]
    doubled = (ends - starts > 1) & _SIGN[last] & (data[np.maximum(ends - 2, 0)] == last)
    capitals = (upper >= 2) & (lower == 0)
    bars = (ends - starts == 1) & (last == 124)
    same = np.zeros(len(row), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    per = lambda flag: np.bincount(row, flag, minlength=texts_n)
    repeats = per(same)
    whole = np.maximum(count, 1)
    signals[:, 1:5] = np.stack([per(capitals), per(doubled), per(bars), np.where(repeats >= 3, repeats, 0)], 1) / whole[:, None]
    # a word's first place in its row: a sort of the row's number above 44 bits of the hash
    keys = np.sort((row.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    signals[:, 5] = np.bincount((keys >> np.uint64(44)).astype(np.int64), new, minlength=texts_n) / whole
    signals[:, 6] = per(_END[last]) / whole
    kinds = np.where(capitals, 3, np.minimum(upper, 1) + 2 * (upper > 1)).astype(np.uint64)
    tail = np.where(_SIGN[last], last, 0).astype(np.uint64)
    head = np.where(_SIGN[data[starts]], data[starts], 0).astype(np.uint64)
    shapes = (((kinds * np.uint64(2) + (lower > 0)) * np.uint64(2) + (digit > 0)) * np.uint64(2) + doubled) * np.uint64(1 << 16)
    shapes = (shapes + tail * np.uint64(256) + head).astype(np.uint64)
    before = np.concatenate([np.zeros(1, np.uint64), shapes[:-1]])
    single = mix(shapes + np.uint64(1)) % np.uint64(FEATURES)
    double = mix(shapes * np.uint64(1 << 24) + before + np.uint64(7)) % np.uint64(FEATURES)
    inner = np.concatenate([[False], row[1:] == row[:-1]])
    where = np.concatenate([row, row[inner]]).astype(np.uint64) * np.uint64(FEATURES) + np.concatenate([single, double[inner]])
    if texts_n * FEATURES <= 4 * len(where):  # few long texts: count by place
        dense = np.bincount(where.astype(np.int64), minlength=texts_n * FEATURES)
        places = np.flatnonzero(dense).astype(np.uint64)
        times = dense[dense > 0]
    else:
        places, times = np.unique(where, return_counts=True)
    r, i = (places // np.uint64(FEATURES)).astype(np.int64), (places % np.uint64(FEATURES)).astype(np.int64)
    steps = np.minimum(9, signals * 10).astype(np.int64)
    steps[:, 0] = np.minimum(12, np.log2(signals[:, 0] + 1))
    full = np.flatnonzero(count)
    extra = np.concatenate([_BUCKETS[np.arange(len(SIGNALS)), steps], np.where(count, _CONSTANT, _EMPTY)[:, None]], 1)
    extra_row = np.repeat(np.arange(texts_n), extra.shape[1])
    kept = np.isin(extra_row, full) | (extra.ravel() == _EMPTY)
    return (signals, np.concatenate([r, extra_row[kept]]), np.concatenate([i, extra.ravel()[kept]]),
            np.concatenate([np.sqrt(times / whole[r]), np.ones(kept.sum())]))


def _band(value: np.ndarray, good: float, bad: float) -> np.ndarray:
    """Votes by a signal that is low in good text."""
    return np.where(value <= good, GOOD, np.where(value >= bad, BAD, ABSTAIN))


def votes(signals: np.ndarray) -> np.ndarray:
    """Votes ``[text, labeller]``."""
    n, capitals, tails, bars, stutter, distinct, ends = signals.T
    long, odd = n >= 40, signals[:, 1:5]
    out = np.stack([
        _band(capitals, 0.05, 0.15),
        _band(tails, 0.02, 0.1),
        _band(bars, 0.01, 0.08),
        _band(stutter, 0.04, 0.12),
        np.where(long & (distinct < 0.15), BAD, np.where(long & (distinct > 0.3), GOOD, ABSTAIN)),
        np.where(n < 4, BAD, np.where(long, GOOD, ABSTAIN)),
        np.where(long, np.where((ends >= 0.02) & (ends <= 0.4), GOOD, BAD), ABSTAIN),
        np.where(odd.max(1) < 0.05, GOOD, np.where(odd.sum(1) > 0.12, BAD, ABSTAIN)),
    ], 1)
    out[n == 0] = [ABSTAIN] * 5 + [BAD] + [ABSTAIN] * 2
    return out


def codes(vote: np.ndarray) -> np.ndarray:
    """A number for each row of votes."""
    return vote @ 3 ** np.arange(len(LABELLERS))


def decode(pattern: int) -> tuple[int, ...]:
    return tuple(pattern // 3 ** i % 3 for i in range(len(LABELLERS)))


def expectation_maximisation(counts: dict[int, int], steps: int = EM_STEPS) -> tuple[dict[int, float], np.ndarray, float]:
    """Posterior of good per vote pattern, accuracies ``[labeller, class, vote]`` and the share of good documents.

    Labellers are taken as independent given the class. Starts from each pattern's majority; a small
    count stands behind every accuracy, so that a labeller that never errs stays finite. Without votes a
    pattern gets the share of good documents.
    """
    if not counts:
        return {}, np.full((len(LABELLERS), 2, 3), 1 / 3), 0.5
    patterns = sorted(counts)
    votes_of = np.array([decode(p) for p in patterns])
    weight = np.array([counts[p] for p in patterns], np.float64)
    good, bad = (votes_of == GOOD).sum(1), (votes_of == BAD).sum(1)
    # one labeller that finds junk outweighs several that find nothing odd
    posterior = np.where(bad > 0, np.where(bad >= good, 0.02, 0.25), np.where(good > 0, 0.98, 0.5))
    prior = np.array([[1.0, 2.0, 0.5], [1.0, 0.5, 2.0]])  # of bad, of good documents: abstain, bad, good
    for _ in range(steps):
        share = float((weight @ posterior + 1) / (weight.sum() + 2))
        table = np.empty((len(LABELLERS), 2, 3))
        for j in range(len(LABELLERS)):
            for v in (ABSTAIN, BAD, GOOD):
                mine = votes_of[:, j] == v
                table[j, 0, v] = (weight * (1 - posterior))[mine].sum()
                table[j, 1, v] = (weight * posterior)[mine].sum()
        table += prior[None]
        table /= table.sum(2, keepdims=True)
        logs = np.log(table)
        # an abstention says nothing
        logs[:, :, ABSTAIN] = 0
        score = math.log(share) - math.log(1 - share) + sum(
            logs[j, 1, votes_of[:, j]] - logs[j, 0, votes_of[:, j]] for j in range(len(LABELLERS)))
        new = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        done = np.abs(new - posterior).max() < 1e-7
        posterior = new
        if done:
            break
    return dict(zip(patterns, posterior.tolist())), table, share


def fit_scorer(row: np.ndarray, index: np.ndarray, value: np.ndarray, label: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Logistic weights over hashed features for soft labels; both classes count alike."""
    weights = np.zeros(FEATURES)
    if not len(label):
        return weights
    balance = label * 0.5 / max(label.sum(), 1e-9) + (1 - label) * 0.5 / max((1 - label).sum(), 1e-9)
    moment, square = np.zeros(FEATURES), np.zeros(FEATURES)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.bincount(row, weights[index] * value, minlength=len(label))))
        gradient = np.bincount(index, (balance * (p - label))[row] * value, minlength=FEATURES) + 1e-5 * weights
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient ** 2
        weights -= 0.2 * (moment / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return weights


class QualityModel:
    """Posteriors by vote pattern, labeller accuracies, share of good documents, scorer weights."""

    def __init__(self, posteriors: dict[int, float], accuracies: np.ndarray, share: float, weights: np.ndarray):
        self.posteriors, self.accuracies, self.share, self.weights = posteriors, accuracies, share, weights

    def judge(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Posterior and score of each text; a text without words scores 0."""
        signals, row, index, value = read(texts)
        total = np.bincount(row, self.weights[index] * value, minlength=len(texts))
        score = np.where(signals[:, 0] > 0, 1 / (1 + np.exp(-np.clip(total, -30, 30))), 0.0)
        return np.array([self.posteriors.get(c, self.share) for c in codes(votes(signals)).tolist()]), score


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"))


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS) -> QualityModel:
    """Estimate the labellers on all documents, and fit the scorer on at most ``fit_docs`` of them.

    The vote patterns of all documents are counted by Spark (at most 3^8 different ones). The fitted documents
    are those with the smallest hashes of their text.
    """
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in small_slices(batches):
            counts.update(codes(votes(read(batch.column(0))[0])).tolist())
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())],
                                             names=["pattern", "n"])

    rows = _texts(docs).mapInArrow(vote, "pattern int, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    counts = {r.pattern: r.n for r in rows}
    posteriors, accuracies, share = expectation_maximisation(counts)
    total = sum(counts.values())

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches):
            signals, row, index, value = read(batch.column(0))
            order = np.argsort(row, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=batch.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(codes(votes(signals)).astype(np.int32)),
                pa.ListArray.from_arrays(ends, index[order].astype(np.int32)),
                pa.ListArray.from_arrays(ends, value[order])], names=["pattern", "i", "v"])

    # a share a little above the wanted one, so that few rows reach the sort; hashes spread evenly
    share_taken = min(1.0, 1.3 * fit_docs / max(total, 1))
    edge = int(-(1 << 63) + share_taken * ((1 << 64) - 1))
    order = F.xxhash64(F.coalesce("text", F.lit("")))
    sample = _texts(docs).where(order <= F.lit(min(edge, (1 << 63) - 1))).orderBy(order, "text").limit(fit_docs)
    taken = sample.mapInArrow(featurise, "pattern int, i array<int>, v array<double>").collect()
    empty = np.empty(0)
    fitted = fit_scorer(
        np.repeat(np.arange(len(taken)), [len(r.i) for r in taken]),
        np.concatenate([np.array(r.i, np.int64) for r in taken] or [empty.astype(np.int64)]),
        np.concatenate([np.array(r.v) for r in taken] or [empty]),
        np.array([posteriors.get(r.pattern, share) for r in taken]))
    return QualityModel(posteriors, accuracies, share, fitted)


def classify(docs: DataFrame, model: QualityModel | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, posterior, score, keep`` of every document.

    ``posterior`` is the labellers' probability of a good document, ``score`` that of the hashed linear scorer,
    and ``keep`` whether the score reaches ``threshold``. A null or blank text has only the vote of the length
    labeller and is not kept. Repeated rows are judged alike; a null ``doc_id`` stays null; other columns are
    not read. Every text is read whole, and nothing is shuffled but counts.
    """
    model = fit(docs) if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches):
            posterior, score = model.judge(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(posterior), pa.array(score),
                                              pa.array(score >= threshold)],
                                             names=["doc_id", "posterior", "score", "keep"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, posterior double, score double, keep boolean")


def keep_good(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    model = fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches):
            yield batch.filter(pa.array(model.judge(batch.column("text"))[1] >= threshold))

    return docs.mapInArrow(run, docs.schema)
