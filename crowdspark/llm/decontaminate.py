"""Benchmark decontamination: latent semantic retrieval and rare words find passages; common-subsequence and answer checks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.llm.common import members, small_slices, words, written

#: Directions of the latent space.
RANK = 96
#: Extra random directions of the sketch, and rounds that sharpen it.
OVERSAMPLE, ROUNDS = 16, 1
#: Words between two passages' starts; passages have 3, 6, 12, ... steps, the least that holds an item wherever it starts.
STEP = 8
#: A passage is a candidate at so much cosine, and at so large a part of the item's own length in latent space.
MIN_COSINE, MIN_LENGTH = 0.45, 0.5
#: A word of a larger share of all documents does not steer the search, unless it is among an item's rarest few.
COMMON, RAREST = 0.1, 6
#: Share of an item's words that a document has in order: enough by itself, or with the answer.
SURE, LIKELY, ANSWER = 0.8, 0.6, 0.8
#: Words at an item's end that are its answer if its last sentence is longer.
ANSWER_WORDS = 8
#: One of so many words of an item is asked for beyond the fewest of its rare words that a leak must hold.
RARE_SHARE = 8
#: Items handled in one pass over the documents, at most; they and their words travel with the tasks. More items
#: take several passes.
BLOCK_ITEMS = 2000

#: Leading bits of a word's hash that tell most unknown words.
MAYBE_BITS = 18

LEAKS = ("doc_id long, item_id long, cosine double, lcs_words long, item_words long, coverage double, answer_found boolean, "
         "word_start long, word_end long")
_WORD = re.compile(r"[^ \t-\r]+")


def item_words(items: list[str]) -> list[np.ndarray]:
    """Word hashes of each text: lower case, without outer signs."""
    hashes, _, _, bounds = words(pa.array(items, pa.string()), lower=True, letters=True)
    return [hashes[a:b] for a, b in zip(bounds, bounds[1:])]


def answer_length(text: str) -> int:
    """Words of the last sentence, at most ANSWER_WORDS and at least three."""
    found = _WORD.findall(text)
    n = 0
    for word in reversed(found):
        if n and word[-1] in ".!?":
            break
        n += 1
    return min(len(found), max(3, min(ANSWER_WORDS, n)))


def common_subsequence(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, one bit per item word (Hyyro's recurrence)."""
    places: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    state = full
    for w in text.tolist():
        hit = places.get(w)
        if hit:
            both = state & hit
            state = ((state + both) | (state - both)) & full
    return len(item) - state.bit_count()


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of all documents, and of those with each word of the sorted ``vocabulary``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(len(vocabulary) + 1, np.int64), 0
        for batch in small_slices(batches):
            hashes, _, _, bounds = words(batch.column(0), lower=True, letters=True)
            known = np.flatnonzero(members(hashes, vocabulary))
            row = np.searchsorted(bounds, known, "right") - 1
            pairs = np.unique(row * len(vocabulary) + np.searchsorted(vocabulary, hashes[known]))
            counts[:-1] += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
            total += batch.num_rows
        counts[-1] = total
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(counts[some])], names=["i", "n"])

    out = np.zeros(len(vocabulary) + 1, np.int64)
    for r in docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "i long, n long").groupBy("i").agg(
            F.sum("n").alias("n")).collect():
        out[r.i] = r.n
    return int(out[-1]), out[:-1]


def latent_space(items: DataFrame, vocabulary: np.ndarray, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors ``[word, direction]`` of the items' TF-IDF rows by a distributed randomised SVD.

    Each round sends every row through the directions in hand and adds up, by word, what comes back; Spark
    keeps the rows. Only sums of the size words x directions meet, in ranges of words.
    """
    size, width = len(vocabulary), min(rank + OVERSAMPLE, len(vocabulary))
    block = 256

    def turn(directions: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size, width))
            some = False
            for batch in small_slices(batches):
                for row in item_words(batch.column("text").to_pylist()):
                    row = row[members(row, vocabulary)]
                    if len(row):
                        at, times = np.unique(np.searchsorted(vocabulary, row), return_counts=True)
                        value = times * idf[at]
                        value = value / max(np.sqrt((value ** 2).sum()), 1e-12)
                        total[at] += value[:, None] * (value @ directions[at])[None, :]
                        some = True
            if some:
                for i in range(0, size, block):
                    yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([total[i: i + block].tobytes()], pa.binary())],
                                                     names=["i", "part"])

        def add(keys, group):
            total = sum(np.frombuffer(x, np.float64) for x in group.column("part").to_pylist())
            return pa.table({"i": [keys[0].as_py()], "part": pa.array([total.tobytes()], pa.binary())})

        out = np.zeros((size, width))
        # at most 64 sums of each range meet
        for r in items.coalesce(64).mapInArrow(run, "i long, part binary").groupBy("i").applyInArrow(
                add, "i long, part binary").collect():
            part = np.frombuffer(r.part, np.float64).reshape(-1, width)
            out[r.i: r.i + len(part)] = part
        return out

    directions = np.random.default_rng(3).standard_normal((size, width))
    for _ in range(ROUNDS):
        directions = np.linalg.qr(turn(directions))[0]
    back = turn(directions)
    # A'A restricted to the sketched directions: its eigenvectors turn them into singular vectors
    values, vectors = np.linalg.eigh((directions.T @ back + back.T @ directions) / 2)
    best = np.argsort(-values)[: min(rank, len(values))]
    return (directions @ vectors[:, best])[:, values[best] > 1e-9]


class LeakFinder:
    """The items of one block in latent space, and the checks of candidate passages."""

    def __init__(self, ids: list[int], texts: list[str], vocabulary: np.ndarray, idf: np.ndarray, space: np.ndarray,
                 all_words: np.ndarray, frequency: np.ndarray):
        self.ids, self.words = ids, item_words(texts)
        self.answers = [answer_length(t) for t in texts]
        self.vocabulary = vocabulary
        self.vectors = (idf[:, None] * space).astype(np.float32)
        self.norms = np.sqrt((self.vectors ** 2).sum(1)) * (1 + 1e-5)
        self.maybe = np.zeros(1 << MAYBE_BITS, bool)
        self.maybe[vocabulary >> np.uint64(64 - MAYBE_BITS)] = True
        points = np.array([self.vectors[np.searchsorted(vocabulary, w[members(w, vocabulary)])].sum(0) for w in self.words])
        self.lengths = np.sqrt((points ** 2).sum(1))
        self.points = points / np.maximum(self.lengths, 1e-12)[:, None]
        steps, self.classes = 3, []  # (steps of a passage, items)
        left = {i for i, w in enumerate(self.words) if len(w) and self.lengths[i] > 0}
        while left:
            mine = sorted(i for i in left if len(self.words[i]) <= (steps - 1) * STEP + 1)
            if mine:
                self.classes.append((steps, np.array(mine)))
            left -= set(mine)
            steps *= 2
        self._index_rare_words(all_words, frequency)

    def _index_rare_words(self, all_words: np.ndarray, frequency: np.ndarray) -> None:
        """For each item the words of which every leak of it holds at least ``self.least`` in one passage.

        A leak holds a share of LIKELY of the item's words, so of any words that make up all but that share, and
        ``least`` more, it holds ``least``. The rarest serve.
        """
        self.steps, self.least, pairs = np.zeros(len(self.words), np.int64), np.ones(len(self.words), np.int64), []
        for i, item in enumerate(self.words):
            n, steps = len(item), 3
            while n > (steps - 1) * STEP + 1:
                steps *= 2
            enough = next(c for c in range(n + 1) if c / n >= LIKELY)
            self.steps[i], self.least[i] = steps, min(enough, 1 + n // RARE_SHARE)
            word, times = np.unique(item, return_counts=True)
            order = np.argsort(frequency[np.searchsorted(all_words, word)], kind="stable")
            taken = np.searchsorted(np.cumsum(times[order]), n - enough + self.least[i]) + 1
            pairs += [(w, i) for w in word[order[:taken]].tolist()]
        pairs.sort()
        self.rare, begin = np.unique(np.array([w for w, _ in pairs], np.uint64), return_index=True)
        self.rare_bounds, self.rare_items = np.append(begin, len(pairs)), np.array([i for _, i in pairs], np.int64)
        self.maybe_rare = np.zeros(1 << MAYBE_BITS, bool)
        self.maybe_rare[self.rare >> np.uint64(64 - MAYBE_BITS)] = True

    def rare_candidates(self, hashes: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], set[int]]:
        """``(text, item): first steps`` of all passages that hold enough of an item's rare words: no leak is left out."""
        at = np.flatnonzero(self.maybe_rare[hashes >> np.uint64(64 - MAYBE_BITS)])
        at = at[members(hashes[at], self.rare)]
        word = np.searchsorted(self.rare, hashes[at])
        many = self.rare_bounds[word + 1] - self.rare_bounds[word]
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        item, place = self.rare_items[np.repeat(self.rare_bounds[word], many) + nth], np.repeat(at, many)
        text = np.searchsorted(bounds, place, "right") - 1
        order = np.argsort(text * len(self.words) + item, kind="stable")
        text, item, place = text[order], item[order], (place - bounds[text])[order]
        other = np.arange(len(order)) + self.least[item] - 1
        first = np.flatnonzero(other < len(order))
        other = other[first]
        near = (text[first] == text[other]) & (item[first] == item[other]) & (
            place[other] - place[first] < (self.steps[item[first]] + 2) * STEP)
        first, other = first[near], other[near]
        found: dict[tuple[int, int], set[int]] = {}
        for t, i, a, b in zip(text[first].tolist(), item[first].tolist(), place[first].tolist(), place[other].tolist()):
            low = max(0, (b - STEP) // STEP - int(self.steps[i]) + 1)
            found.setdefault((t, i), set()).update(range(low, (a + STEP) // STEP + 1))
        return found

    def candidates(self, hashes: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], set[int]]:
        """``(text, item): first steps`` of the passages at or above the limits in latent space."""
        count = np.diff(bounds)
        blocks = -(-count // STEP)
        first = np.concatenate([[0], np.cumsum(blocks)])
        known = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - MAYBE_BITS)])
        known = known[members(hashes[known], self.vocabulary)]
        if not len(known):
            return {}
        word = np.searchsorted(self.vocabulary, hashes[known])
        row = np.searchsorted(bounds, known, "right") - 1
        block = first[row] + (known - bounds[row]) // STEP
        before = np.concatenate([[0], np.cumsum(np.bincount(block, minlength=first[-1]))])  # known words before a step
        reach = np.concatenate([[0], np.cumsum(self.norms[word])])
        total = np.concatenate([np.zeros((1, self.vectors.shape[1])), np.cumsum(self.vectors[word], 0, dtype=np.float64)])
        here = np.flatnonzero(np.diff(before))  # passages that begin with a known word's step, or just before it
        found: dict[tuple[int, int], set[int]] = {}
        for steps, items in self.classes:
            floor = MIN_LENGTH * self.lengths[items]
            begin = np.unique((here[:, None] - np.arange(steps)[None, :]).ravel()) if len(here) * steps < first[-1] else (
                np.arange(first[-1]))
            begin = begin[begin >= 0]
            text = np.searchsorted(first, begin, "right") - 1
            low, high = before[begin], before[np.minimum(begin + steps, first[text + 1])]
            # the length of a sum is at most the sum of the lengths
            some = np.flatnonzero(reach[high] - reach[low] >= floor.min())
            if not len(some):
                continue
            passages = total[high[some]] - total[low[some]]
            length = np.sqrt((passages ** 2).sum(1))
            near = np.flatnonzero(length >= max(floor.min(), 1e-9))
            passages, length, some = passages[near], length[near], some[near]
            cosine = (passages / length[:, None]).astype(np.float32) @ self.points[items].T.astype(np.float32)
            p, i = np.nonzero((cosine >= MIN_COSINE) & (length[:, None] >= floor[None, :]))
            at = some[p]
            for t, item, step in zip(text[at].tolist(), items[i].tolist(), (begin[at] - first[text[at]]).tolist()):
                found.setdefault((t, item), set()).add(step)
        return found

    def cosine(self, item: int, passage: np.ndarray) -> float:
        """Of an item and a passage in latent space; 0 where one of them has no words there."""
        total = self.vectors[np.searchsorted(self.vocabulary, passage[members(passage, self.vocabulary)])].sum(0, dtype=np.float64)
        return float(total @ self.points[item] / max(np.sqrt((total ** 2).sum()), 1e-12))

    def leaks(self, hashes: np.ndarray, bounds: np.ndarray) -> list[tuple]:
        """``(text, item id, cosine, common words, item's words, coverage, answer found, start, end)`` of each leak.

        Every candidate passage is compared, widened by a step on both sides; of several leaked ones the row has that
        with the answer, the most common words and the highest cosine, and the first of such.
        """
        found = self.candidates(hashes, bounds)
        for key, begins in self.rare_candidates(hashes, bounds).items():
            found.setdefault(key, set()).update(begins)
        out = []
        for (text, item), begins in sorted(found.items()):
            wanted, low, high, steps = self.words[item], bounds[text], bounds[text + 1], int(self.steps[item])
            answer, best = wanted[-self.answers[item]:], []
            for step in sorted(begins):
                start = max(low, low + step * STEP - STEP)
                stop = min(high, low + (step + steps) * STEP + STEP)
                part = hashes[start:stop]
                # in any order at least as many are common as in order
                if members(wanted, np.unique(part)).sum() < LIKELY * len(wanted) - 1e-6:
                    continue
                common = common_subsequence(wanted, part)
                coverage = common / len(wanted)
                if coverage < LIKELY:
                    continue
                has_answer = common_subsequence(answer, part) >= ANSWER * len(answer)
                if coverage >= SURE or has_answer:
                    cosine = self.cosine(item, hashes[low + step * STEP: min(high, low + (step + steps) * STEP)])
                    best.append((bool(has_answer), common, cosine, -step, int(start - low), int(stop - low)))
            if best:
                has_answer, common, cosine, _, start, stop = max(best)
                out.append((text, self.ids[item], cosine, common, len(wanted), common / len(wanted), has_answer, start, stop))
        return out


def _steering(vocabulary: np.ndarray, total: int, frequency: np.ndarray, items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The words that steer the search and their inverse document frequencies."""
    kept = frequency <= COMMON * total
    for item in items:
        at = np.searchsorted(vocabulary, np.unique(item))
        kept[at[np.argsort(frequency[at], kind="stable")[:RAREST]]] = True
    idf = np.log((total + 1.0) / np.maximum(frequency[kept], 0.5) + 0.01).clip(0.01)
    return vocabulary[kept], idf


def benchmark_blocks(benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> list[DataFrame]:
    """The distinct ``item_id, text`` rows of the benchmark in blocks of about ``block_items``."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(
        "item_id is not null and text is not null").distinct()
    blocks = -(-items.count() // block_items)
    if blocks <= 1:
        return [items] * blocks
    items = written(items, "items")
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) for b in range(blocks)]


def leak_finder(docs: DataFrame, items: DataFrame, rank: int = RANK) -> LeakFinder | None:
    """The finder of one block of items, None if they have no words. Word frequencies come from all documents."""
    held = items.orderBy("item_id", "text").collect()
    held = [r for r, w in zip(held, item_words([r.text for r in held])) if len(w)] if held else []
    if not held:
        return None
    texts = [r.text for r in held]
    all_words = np.unique(np.concatenate(item_words(texts)))
    total, frequency = document_frequencies(docs, all_words)
    vocabulary, idf = _steering(all_words, total, frequency, item_words(texts))
    space = latent_space(items, vocabulary, idf, rank)
    return LeakFinder([r.item_id for r in held], texts, vocabulary, idf, space, all_words, frequency)


def _block_leaks(docs: DataFrame, items: DataFrame, rank: int) -> DataFrame:
    """The leaks of one block of items; only this block travels with the tasks."""
    finder = leak_finder(docs, items, rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches):
            hashes, _, _, bounds = words(batch.column("text"), lower=True, letters=True)
            out = finder.leaks(hashes, bounds)
            if out:
                columns = list(zip(*out))
                types = [pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(columns[0])), *(pa.array(c, t) for c, t in zip(columns[1:], types))],
                    names=[c.split()[0] for c in LEAKS.split(", ")])

    if finder is None:
        return docs.sparkSession.createDataFrame([], LEAKS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, LEAKS)


def find_leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Benchmark items found in documents, one row per document and item: ``doc_id, item_id, cosine, lcs_words,
    item_words, coverage, answer_found, word_start, word_end`` (the words of the document that were compared).

    Every text is cut into overlapping passages. Those near an item in latent space are compared with it, and those
    that hold enough of its rare words, which no leak lacks. An item counts as leaked if its words occur in order in
    one passage for 80 %, or for 60 % with its answer, the last words of the item, among them. Null or empty texts
    have no leaks; repeated rows have theirs each; a null ``doc_id`` stays null; other columns are not read.
    Documents are not shuffled. Beyond ``block_items`` items the leaks of each block are written before the next.
    """
    blocks = benchmark_blocks(benchmark, block_items)
    if not blocks:
        return docs.sparkSession.createDataFrame([], LEAKS)
    if len(blocks) == 1:
        return _block_leaks(docs, blocks[0], rank)
    return reduce(DataFrame.unionAll, [written(_block_leaks(docs, b, rank), "leaks") for b in blocks])


def keep_clean(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` without a leaked item, with all their columns.

    One block of items filters the rows where they are. Of several, each writes the leaked texts' SHA-256 before
    the next begins.
    """
    blocks = benchmark_blocks(benchmark, block_items)
    if len(blocks) > 1:
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        gone = reduce(DataFrame.unionAll, [written(_leaked_texts(docs, b, rank), "leaked") for b in blocks]).distinct()
        keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.sha2(text, 256).alias("digest"))
        return keyed.join(gone, "digest", "left_anti").select("row.*")
    finder = leak_finder(docs, blocks[0], rank) if blocks else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches):
            hashes, _, _, bounds = words(batch.column("text"), lower=True, letters=True)
            clean = np.ones(batch.num_rows, bool)
            clean[[leak[0] for leak in finder.leaks(hashes, bounds)]] = False
            yield batch.filter(pa.array(clean))

    return docs if finder is None else docs.mapInArrow(run, docs.schema)


def _leaked_texts(docs: DataFrame, items: DataFrame, rank: int) -> DataFrame:
    """``digest``: the SHA-256 of each text with an item of one block."""
    finder = leak_finder(docs, items, rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches):
            hashes, _, _, bounds = words(batch.column("text"), lower=True, letters=True)
            leaked = sorted({leak[0] for leak in finder.leaks(hashes, bounds)})
            if leaked:
                texts = batch.column("text").take(pa.array(leaked)).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([sha256(t.encode()).hexdigest() for t in texts])], names=["digest"])

    if finder is None:
        return docs.sparkSession.createDataFrame([], "digest string")
    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "digest string").distinct()
