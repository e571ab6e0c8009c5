"""Source divergence audit: term stripes (document frequency and counts by source) merged by key, which emit divergences."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.llm.common import small_slices, written

#: A term is kept in a language with so many documents; this is added to each count.
MIN_DOCUMENTS, SMOOTHING = 30, 5
#: Probabilities are whole numbers of this part.
UNIT = 1_000_000_000
TOP_TERMS = 50
#: A task's stripes are spilt at so many counts, or after so many bytes of text: the bound of its memory.
SPILL_COUNTS, SPILL_BYTES = 400_000, 256 << 20
#: Bytes of one text that are split into terms at once.
STEP = 4 << 20
#: Cells of a table of stripes by sources, or of sources by sources, that a task holds.
CELLS = 1 << 22

#: Bytes of terms in lower case, all others a space: letters, and everything beyond ASCII.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
STRIPES = "lang string, term string, documents long, sources array<string>, counts array<long>"
EMITTED = "lang string, source string, part string, item string, value long"


def _schema(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


class Stripes:
    """The stripes of a task, kept source by source: counts of terms, and document frequencies of each language."""

    def __init__(self):
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.documents: dict[str, Counter] = defaultdict(Counter)
        self.bytes = 0

    def fold(self, lang: str, source: str, text: bytes) -> Iterator[pa.RecordBatch]:
        """Add a whole document; yields stripes when they are spilt, also within a long document."""
        data, seen, at = text.translate(LETTERS), set(), 0
        counts = self.counts[lang, source]
        while at < len(data):
            stop = len(data) if len(data) - at <= STEP else data.rfind(b" ", at, at + STEP) + 1
            if stop <= at:  # a longer term
                stop = data.find(b" ", at) + 1 or len(data)
            terms = data[at:stop].split()
            counts.update(terms)
            seen.update(terms)
            self.bytes += stop - at
            at = stop
            if self.full() and at < len(data):
                yield from self.spill()
                counts = self.counts[lang, source]
        self.documents[lang].update(seen)
        if self.full():
            yield from self.spill()

    def full(self) -> bool:
        return self.bytes >= SPILL_BYTES or sum(map(len, self.counts.values())) >= SPILL_COUNTS

    def spill(self) -> Iterator[pa.RecordBatch]:
        """One row per language and term, and one with the empty term that names all sources; the stripes are empty then."""
        for lang in sorted({lang for lang, _ in self.counts} | set(self.documents)):
            stripes = {b"": [0, [], []]}
            for term, n in self.documents[lang].items():
                stripes[term] = [n, [], []]
            for (owner, source), counts in self.counts.items():
                if owner != lang:
                    continue
                stripes[b""][1].append(source)
                stripes[b""][2].append(0)
                for term, n in counts.items():
                    stripe = stripes.get(term)
                    if stripe is None:
                        stripe = stripes[term] = [0, [], []]
                    stripe[1].append(source)
                    stripe[2].append(n)
            rows = list(stripes.values())
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(rows), pa.string()), pa.array(list(stripes), pa.binary()).cast(pa.string()),
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.string())),
                pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=_schema(STRIPES))
        self.__init__()


def task_stripes(docs: DataFrame) -> DataFrame:
    """The stripes that each partition folds its whole documents into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes = Stripes()
        for batch in small_slices(batches):
            texts = pc.fill_null(batch.column("text"), "").cast(pa.binary())
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
                yield from stripes.fold(lang, source, text.as_buffer().to_pybytes())
        yield from stripes.spill()

    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]).mapInArrow(
        run, STRIPES)


def _merge(batch: pa.RecordBatch, min_documents: int, whole: bool) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """The merged stripes of a sorted batch, and the rows of its last key, which may go on (none if ``whole``)."""
    lang, term = batch.column("lang"), batch.column("term")
    new = np.ones(batch.num_rows, bool)
    if batch.num_rows > 1:
        same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(term[1:], term[:-1]))
        new[1:] = ~same.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(new)
    stop = batch.num_rows if whole else int(starts[-1])
    rest, batch, new = batch.slice(stop), batch.slice(0, stop), new[:stop]
    starts = np.flatnonzero(new)
    if not len(starts):
        return batch, rest
    documents = np.add.reduceat(batch.column("documents").to_numpy(), starts)
    terms = batch.column("term").take(pa.array(starts))
    keep = (documents >= min_documents) | pc.equal(terms, "").to_numpy(zero_copy_only=False)
    # the counts of one stripe and source are summed
    group = np.repeat(np.cumsum(new) - 1, pc.list_value_length(batch.column("sources")).to_numpy())
    names = pc.list_flatten(batch.column("sources")).dictionary_encode()
    cells, at = np.unique(group * max(len(names.dictionary), 1) + names.indices.to_numpy(zero_copy_only=False), return_inverse=True)
    sums = np.zeros(len(cells), np.int64)
    np.add.at(sums, at, pc.list_flatten(batch.column("counts")).to_numpy())
    owner = cells // max(len(names.dictionary), 1)
    offsets = pa.array(np.searchsorted(owner, np.arange(len(starts) + 1)).astype(np.int32))
    merged = pa.RecordBatch.from_arrays([
        batch.column("lang").take(pa.array(starts)), terms, pa.array(documents),
        pa.ListArray.from_arrays(offsets, names.dictionary.take(pa.array(cells % max(len(names.dictionary), 1)))),
        pa.ListArray.from_arrays(offsets, pa.array(sums))], names=_schema(STRIPES))
    return merged.filter(pa.array(keep)), rest


def merged_stripes(stripes: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """One stripe per language and kept term, and the one of the empty term.

    A task has sent one stripe of a term, or one for each spill, so the most common term is few rows; they are merged
    batch by batch in key order, and a key that fills a batch is merged before the next one is read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch.cast(rest.schema)]).combine_chunks().to_batches()[0]
            done, rest = _merge(batch, min_documents, False)
            if rest.num_rows > 1:  # one row is enough to go on
                rest = _merge(rest, 0, True)[0]
            if done.num_rows:
                yield done
        if rest is not None:
            yield _merge(rest, min_documents, True)[0]

    return stripes.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(run, STRIPES)


def share(counts: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * kept)), by long division, so that nothing overflows."""
    rest, below, out = counts + SMOOTHING, total + SMOOTHING * kept, 0
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + more
    return out + 1


def divergences(merged: DataFrame, totals: dict[str, tuple[int, list[str], np.ndarray]], top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value`` that tasks emit from their stripes: partial sums of pairs, and leading terms.

    ``totals``: the number of kept terms of each language, its sources and their sums of counts; it is far smaller than
    the pairs of the result. Sources come in blocks of rows, so that a task's table of pairs is bounded by CELLS.
    """
    most = max((len(s) for _, s, _ in totals.values()), default=0)
    height = max(1, CELLS // max(most, 1))
    blocks = -(-most // height)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sums = None, None

        def pairs() -> pa.RecordBatch:
            lang, block = key
            sources = totals[lang][1]
            rows = sources[block * height: (block + 1) * height]
            some = np.array([a != b for a in rows for b in sources], bool)
            return emit(lang, np.repeat(rows, len(sources))[some], "pair", np.tile(sources, len(rows))[some], sums.ravel()[some])

        for batch in batches:
            blocks_of, langs = batch.column("block").to_numpy(), batch.column("lang").to_pylist()
            edges = [0, *(i for i in range(1, len(langs)) if langs[i] != langs[i - 1] or blocks_of[i] != blocks_of[i - 1]), len(langs)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                lang, block = langs[a], int(blocks_of[a])
                kept, sources, below = totals[lang]
                if block * height >= len(sources):
                    continue
                if key != (lang, block):
                    if key is not None:
                        yield pairs()
                    key = (lang, block)
                    sums = np.zeros((len(sources[block * height: (block + 1) * height]), len(sources)), np.int64)
                step = max(1, CELLS // len(sources))
                for at in range(a, b, step):
                    part = batch.slice(at, min(step, b - at))
                    part = part.filter(pc.not_equal(part.column("term"), ""))
                    if part.num_rows:
                        yield from one(lang, block, part, kept, sources, below, sums)
        if key is not None:
            yield pairs()

    def one(lang, block, part, kept, sources, below, sums) -> Iterator[pa.RecordBatch]:
        flat = pc.index_in(pc.list_flatten(part.column("sources")), pa.array(sources)).to_numpy()
        rows = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column("sources")).to_numpy())
        counts = np.zeros((part.num_rows, len(sources)), np.int64)
        counts[rows, flat] = pc.list_flatten(part.column("counts")).to_numpy()
        p = share(counts, below, kept)
        for i in range(len(sums)):
            sums[i] += np.abs(p - p[:, block * height + i, None]).sum(0)
        if block:
            return
        over = p - share(counts.sum(1), below.sum(), kept)[:, None]
        over[counts == 0] = 0
        order = np.empty(part.num_rows, np.int64)
        order[pc.sort_indices(part.column("term").cast(pa.binary())).to_numpy()] = np.arange(part.num_rows)
        for s, source in enumerate(sources):
            some = np.flatnonzero(over[:, s] > 0)
            some = some[np.lexsort((order[some], -over[some, s]))[:top]]
            if len(some):
                yield emit(lang, [source] * len(some), "term", part.column("term").take(pa.array(some)), over[some, s])

    def emit(lang, source, part, item, value) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([lang] * len(value), pa.string()), pa.array(source, pa.string()), pa.array([part] * len(value), pa.string()),
            item if isinstance(item, pa.Array) else pa.array(item, pa.string()), pa.array(value, pa.int64())], names=_schema(EMITTED))

    each = merged.select("lang", "term", "sources", "counts", F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1))).alias("block"))
    return each.sortWithinPartitions("lang", "block").mapInArrow(run, EMITTED)


def audit_sources(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """How sources of a language differ: ``lang, source, part, item, value, rank``.

    Terms are runs of letters and of signs beyond ASCII, A-Z lower-cased; a language keeps those of ``min_documents``
    rows or more. A group (language and source) gives a kept term the share p (``share``). Part ``pair``: the sum of
    differences of p to each other source of the language; part ``term``: the ``top`` terms of the group whose p is
    above the language's, with the difference. Ranks go by falling value, then item. All arithmetic is of whole numbers.

    Null lang, source or text count as ''. A group without terms has its pairs, with value 0 if no term is kept; a
    language of one source has no pairs. Repeated rows count each. An empty table has an empty result. Other columns
    are not read.
    """
    merged = written(merged_stripes(task_stripes(docs), min_documents), "stripes")
    # the sources of a language and its sums: far fewer rows than the pairs of the result
    found = merged.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c")).groupBy("lang", "c.sources").agg(
        F.sum("c.counts").alias("n")).toArrow()
    kept = {r["lang"]: r["n"] for r in merged.where("term <> ''").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    sums: dict[str, dict[str, int]] = defaultdict(dict)
    for row in found.to_pylist():
        sums[row["lang"]][row["sources"]] = row["n"]
    totals = {lang: (kept.get(lang, 0), sorted(n), np.array([n[s] for s in sorted(n)], np.int64)) for lang, n in sums.items()}
    emitted = written(divergences(merged, totals, top), "divergences")
    pairs = emitted.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = "row_number() over (partition by lang, source order by value desc, item) as rank"
    return pairs.selectExpr("*", ranked).unionAll(
        emitted.where("part = 'term'").selectExpr("*", ranked).where(F.col("rank") <= top))
