"""Importance resampling towards a target: hashed word runs, whose hashes an automaton emits, weigh documents for a draw."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.llm.common import small_slices, text_bytes, written
from crowdspark.operators.ordering import group_positions

BUCKETS = 10_000
#: Words of a document that may be drawn.
MIN_WORDS = 20
#: Per cent of those documents that are drawn, and the seed of the draw.
PERCENT, SEED = 10, 2024
#: A longer word stands in the automaton by a number, so that its depth is bounded.
LONG_WORD = 256
#: CRC-32 as it is used by zip files, reflected.
POLYNOMIAL = 0xEDB88320

#: Bytes of words in lower case, all others a space: digits, letters, and everything beyond ASCII.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
FEATURES = "doc_id long, n_words long, n_features long, buckets array<int>, counts array<int>"
_LONG = re.compile(b"[^ ]{%d,}" % (LONG_WORD + 1))


def _shift_powers() -> np.ndarray:
    """Row j: what 2^j zero bytes after it make of each bit of a CRC, as 32 columns."""
    bit = np.array([(1 << (i - 1)) if i else POLYNOMIAL for i in range(32)], np.uint32)
    power = np.array([1 << i for i in range(32)], np.uint32)
    for _ in range(8):
        power = _apply(bit, power)
    out = [power]
    for _ in range(31):
        out.append(_apply(out[-1], out[-1]))
    return np.array(out)


def _apply(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), np.uint32)
    for i in range(32):
        out ^= np.where(values >> np.uint32(i) & np.uint32(1), matrix[i], np.uint32(0))
    return out


_SHIFTS = _shift_powers()


def compose(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of joined byte strings, from those of both and the length of the second."""
    first = first.copy()
    for j in range(int(length.max(initial=0)).bit_length()):
        some = np.flatnonzero(length >> j & 1)
        first[some] = _apply(_SHIFTS[j], first[some])
    return first ^ second


def payloads(rows: list[bytes]) -> np.ndarray:
    """The payloads that an automaton emits over some texts: ``crc << 32 | length`` of each word, 0 after each text.

    The dictionary holds the distinct words of these texts between delimiters, so that no key is part of another and
    each word is found once, in order; it is bounded by the texts' own bytes.
    """
    stand_ins: dict[bytes, int] = {}

    def stand_in(match: re.Match) -> bytes:
        return b"\x01%d" % stand_ins.setdefault(match.group(), len(stand_ins))

    text = b" " + b"".join([_LONG.sub(stand_in, row) + b" \n " for row in rows])
    automaton = ahocorasick.Automaton()
    for word in set(text.split()) - {b"\n"}:
        if word[:1] != b"\x01":
            automaton.add_word(f" {word.decode('latin-1')} ", zlib.crc32(word) << 32 | len(word))
    for word, number in stand_ins.items():
        automaton.add_word(f" \x01{number} ", zlib.crc32(word) << 32 | len(word))
    # bytes.split takes the row mark for white space
    automaton.add_word(" \n ", 0)
    automaton.make_automaton()
    return np.fromiter(chain.from_iterable(automaton.iter(text.decode("latin-1"))), np.uint64).reshape(-1, 2)[:, 1]


def hashed_runs(found: np.ndarray, n_rows: int, max_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; the text and the bucket of each run of 1 to ``max_words`` words."""
    mark = found == 0
    owner = (np.cumsum(mark) - mark)[~mark]
    found = found[~mark]
    crc, length = (found >> np.uint64(32)).astype(np.uint32), (found & np.uint64(0xFFFFFFFF)).astype(np.int64)
    space, one = np.uint32(zlib.crc32(b" ")), np.ones(len(crc), np.int64)
    texts, run, out = [owner], crc, [crc % np.uint32(buckets)]
    for n in range(1, max_words):
        run = run[: max(len(crc) - n, 0)]
        spaced = compose(run, np.full(len(run), space), one[: len(run)])
        run = compose(spaced, crc[n:], length[n:])
        same = owner[: len(run)] == owner[n:]
        texts.append(owner[n:][same])
        out.append(run[same] % np.uint32(buckets))
    return np.bincount(owner, minlength=n_rows), np.concatenate(texts), np.concatenate(out).astype(np.int64)


def hashed_features(docs: DataFrame, doc_id: str = "doc_id", max_words: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """Per row: ``doc_id, n_words, n_features, buckets, counts`` of the runs of 1 to ``max_words`` words of its whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches):
            data, offsets = text_bytes(batch.column("text"))
            data = data.tobytes().translate(WORD_BYTES)
            words, owner, bucket = hashed_runs(
                payloads([data[a:b] for a, b in zip(offsets, offsets[1:])]), batch.num_rows, max_words, buckets)
            cells, counts = np.unique(owner * buckets + bucket, return_counts=True)
            ends = pa.array(np.searchsorted(cells, np.arange(batch.num_rows + 1) * buckets).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(np.bincount(owner, minlength=batch.num_rows), pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array((cells % buckets).astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32)))], names=[c.split()[0] for c in FEATURES.split(", ")])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, FEATURES)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Features of all rows in each bucket: a task sends its sums, at most one for each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(total, batch.column("buckets").flatten().to_numpy(), batch.column("counts").flatten().to_numpy())
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    out = [0] * buckets
    sums = features.select("buckets", "counts").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in sums.toArrow().to_pylist():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """A bucket's log ratio of both smoothed shares, in thousandths, floored."""
    n, m, size = sum(corpus), sum(target), len(corpus)
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(n + size) / (float(s + 1) * float(m + size))))
                     for s, t in zip(corpus, target)], np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the floored mean gain of a row's features, 0 without any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, n = batch.column("counts"), batch.column("n_features").to_numpy()
            each = gain[batch.column("buckets").flatten().to_numpy()] * counts.flatten().to_numpy()
            ends = np.concatenate([[0], np.cumsum(counts.value_lengths().to_numpy())])
            sums = np.concatenate([[0], np.cumsum(each)])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), batch.column("n_features"), pa.array(
                (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(n, 1))], names=["doc_id", "n_words", "n_features", "weight"])

    return features.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, max_words: int = 1, buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row: a draw without replacement by importance weights.

    Words are runs of ASCII letters and digits and of signs beyond ASCII, A-Z lower-cased. Each run of 1 to
    ``max_words`` words, joined by a space, falls into the bucket of its CRC-32. A row's weight is the mean log
    ratio of its buckets' shares in ``target`` and in ``docs``; its score adds a Gumbel number of seed and doc_id. Of
    the rows of ``min_words`` words or more, the highest scores are drawn (``percent`` of them, floored), ties to the
    smaller doc_id; ``rank`` counts them from 1 and is null for all others.

    Null or empty texts have no features and weight 0. Repeated rows have the same score and a rank each; a
    null doc_id has the number of the empty id and comes first of equal scores. Empty tables give an empty result, or
    gains over no features. Other columns are not read.
    """
    features = written(hashed_features(docs, max_words=max_words, buckets=buckets), "features")
    wanted = written(hashed_features(target.select(F.lit(None).alias("doc_id"), "text"), max_words=max_words, buckets=buckets), "target")
    gain = gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    unit = "(cast(conv(substr(sha2(concat('{}:', coalesce(cast(doc_id as string), '')), 256), 1, 8), 16, 10) as double) + 0.5) / 4294967296"
    scored = written(weighed(features, gain).selectExpr(
        "monotonically_increasing_id() as row", "doc_id", "n_words", "n_features", "weight",
        f"weight + floor(-1000 * ln(-ln({unit.format(seed)}))) as score"), "scored")
    # scores are whole thousandths of logarithms, so there are few different ones whatever the number of rows
    counts = scored.where(F.col("n_words") >= min_words).groupBy("score").agg(F.count("*").alias("n")).toArrow().to_pylist()
    draws = percent * sum(r["n"] for r in counts) // 100
    before, cut = [], None
    for r in sorted(counts, key=lambda r: -r["score"]):
        if (before[-1][2] if before else 0) >= draws:
            break
        cut, above = r["score"], before[-1][2] if before else 0
        before.append((cut, above, above + r["n"]))
    out = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select(*out, none)
    drawn = (F.col("n_words") >= min_words) & (F.col("score") >= cut)
    firsts = scored.sparkSession.createDataFrame([b[:2] for b in before], "score long, above long")
    placed = group_positions(scored.where(drawn), ["score"], ["doc_id", "row"]).join(firsts, "score")
    rank = F.col("above") + F.col("position")
    return scored.where(~drawn).select(*out, none).unionAll(placed.select(*out, F.when(rank <= draws, rank).alias("rank")))
