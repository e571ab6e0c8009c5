"""Helpers of the operators: words of Arrow text columns as 64-bit hashes, written tables, components."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.session import shared_folder

#: Bytes of text that one numpy step handles; bounds a worker's memory whatever the batch holds.
STEP_BYTES = 1 << 20
#: Longer words are hashed one by one.
_LONG_WORD = 512
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of letters and digits, and all beyond ASCII.
_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read the table again."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column and the offsets of its rows; null counts as empty."""
    binary = pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type)
    texts = pc.fill_null(texts, b"" if binary else "").cast(pa.large_binary() if binary else pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]]
    return data, offsets - offsets[0]


def small_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about STEP_BYTES of text, or a single longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = text_bytes(batch.column(column))[1][1:]
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + STEP_BYTES)))
            yield batch.slice(start, stop - start)
            start = stop


def _hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time."""
    sizes = ends - starts
    hashes = sizes.astype(np.uint64) * _MULTIPLIER
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    some = np.flatnonzero((sizes > 0) & (sizes <= _LONG_WORD))
    at = 0
    while len(some):
        chunk = eights[starts[some] + at] & _KEEP[np.minimum(sizes[some] - at, 8)]
        h = (hashes[some] ^ chunk) * _MULTIPLIER
        hashes[some] = h ^ (h >> np.uint64(29))
        at += 8
        some = some[sizes[some] > at]
    for i in np.flatnonzero(sizes > _LONG_WORD):
        hashes[i] = int.from_bytes(blake2b(data[starts[i]: ends[i]].tobytes(), digest_size=8).digest(), "little")
    return mix(hashes)


def _word_step(data: np.ndarray, first: np.ndarray, letters: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of the words in some bytes; first: marks bytes that begin a row, and one more."""
    filled = ~_SPACE[data]
    cut = np.empty(len(data) + 1, bool)  # no word reaches over this edge
    cut[0] = cut[-1] = True
    cut[1:-1] = ~(filled[1:] & filled[:-1])
    cut |= first
    starts, ends = np.flatnonzero(filled & cut[:-1]), np.flatnonzero(filled & cut[1:]) + 1
    low, high = starts, ends
    if letters:
        low, high = starts.copy(), ends.copy()
        for edge, step, shift in ((low, 1, 0), (high, -1, -1)):
            some = np.arange(len(edge))
            while len(some := some[(low[some] < high[some])]) and len(
                    some := some[~_LETTER[data[edge[some] + shift]]]):
                edge[some] += step
    return _hash_words(data, low, high), starts, ends


def words(texts: pa.Array, lower: bool = False, letters: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without ASCII white space) of a text column: hashes, first bytes, ends, and row bounds.

    Row r has the words ``bounds[r]:bounds[r + 1]``; starts and ends are byte positions in the column's
    bytes. ``lower`` lower-cases A-Z first; ``letters`` leaves a word's outer ASCII signs out of its hash. Works in steps that end at white space, so that a row of any
    length needs little more memory than its own bytes and words.
    """
    data, offsets = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    parts, at = [], 0
    while at < len(data):
        stop = at + STEP_BYTES
        while stop < len(data) and not _SPACE[data[stop]]:
            stop += 1
        stop = min(stop, len(data))
        hashes, starts, ends = _word_step(data[at:stop], first[at: stop + 1], letters)
        parts.append((hashes, starts + at, ends + at))
        at = stop
    if not parts:
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), empty, empty, np.zeros(len(offsets), np.int64)
    hashes, starts, ends = (np.concatenate(p) for p in zip(*parts))
    return hashes, starts, ends, np.searchsorted(starts, offsets)


_ROLL = np.random.default_rng(11).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; positions too near the end are left out."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:count] * _ROLL[0]
    for i in range(1, n):
        total = total + hashes[i: i + count] * _ROLL[i]
    return mix(total)


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles of one text; with fewer words, the whole sequence as one."""
    if 0 < len(hashes) < n:
        total = (hashes * _ROLL[-len(hashes):]).sum(keepdims=True)
        return mix(total + np.uint64(len(hashes)))
    return np.unique(ngrams(hashes, n))


def members(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in a short sorted array."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``a`` of distinct pairs a > b has one ``b``, and no ``b`` is an ``a``: no step would change them."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("up").alias("ups"), F.max("down").alias("down")).where(
        "ups > 1 or (ups = 1 and down = 1)").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``a, b`` pairs: ``node, component`` (the smallest node of its component).

    Alternates large-star and small-star steps on the edge table, each one aggregate and one equi-join;
    a node with very many edges costs a split join, never one task. Pairs of a node with itself and pairs
    with null are ignored. Nodes without edges do not appear.
    """
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _are_stars(edges):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: larger neighbours move to the smallest of the neighbourhood
        large = edges.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a").select(
            F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")  # repeats go with the last distinct
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        # small star: a node and its smaller neighbours move to the smallest of them
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.*").where("a <> b").distinct()
        edges = written(small, "edges")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component")))
