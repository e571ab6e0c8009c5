"""Lexical retrieval packing: a BM25 inverted index per shard fills each window with a seed's unused neighbours."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.llm.common import small_slices

WINDOW = 2048
#: A shard is closed at so many documents or tokens: the bound of a worker's memory and of an index.
SHARD_DOCS = 4096
SHARD_TOKENS = 4_000_000
#: The rarest terms of a seed that ask the index.
QUERY_TERMS = 24
#: A cache of encoded words is emptied at so many entries; a bound of a worker's memory.
CACHE_WORDS = 700_000
K1, B = 1.2, 0.75

PLAIN_WORD = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
WORD_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+").findall
ODD_CONTROL = re.compile("[\x1c-\x1f]").search
ODD_SPACE = re.compile(r"[^\S\x1c-\x1f]+")

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


class WordPieces:
    """Token ids of texts, where white space always separates tokens: a different word is encoded once.

    The vocabulary drops white space and never merges over it, so the ids of a text are those of its words
    in turn. A word of Latin letters, digits and ASCII signs is split and lower-cased here as the
    vocabulary's own normaliser and splitter do, and its parts go straight to the merge model; any other
    word goes through the whole tokenizer.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), np.uint32(end_id).tobytes()
        self.model, self.words, self.parts = self.tokenizer.model, {}, {}
        # the byte-level alphabet: printable Latin-1 characters stand for themselves, the others follow 255
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def _part(self, part: str) -> bytes:
        spelt = part.encode().decode("latin-1").translate(self.alphabet)
        ids = np.array([token.id for token in self.model.tokenize(spelt)], np.uint32).tobytes()
        if len(self.parts) >= CACHE_WORDS:
            self.parts.clear()
        self.parts[part] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if PLAIN_WORD(word) and "<|" not in word:
            ids = b"".join([self.parts.get(p) or self._part(p) for p in WORD_PARTS(word.lower())])
        else:
            ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.uint32).tobytes()
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        self.words[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text, then the end id."""
        # str.split also splits at four control characters that are no white space to the vocabulary
        words = ODD_SPACE.split(text) if ODD_CONTROL(text) else text.split()
        known, new = self.words.get, self._word
        found = [known(word) or new(word) for word in words if word]
        found.append(self.end)
        return b"".join(found)


@lru_cache(maxsize=1)
def word_pieces(path: str, end_id: int) -> WordPieces:
    """A Python worker keeps the vocabulary and the words it has encoded from task to task."""
    return WordPieces(path, end_id)


class Bm25Index:
    """An inverted index over the term ids of a shard's documents."""

    def __init__(self, documents: list[np.ndarray]):
        docs, terms, counts = [], [], []
        for d, ids in enumerate(documents):
            term, count = np.unique(ids, return_counts=True)
            docs.append(np.full(len(term), d, np.int32))
            terms.append(term)
            counts.append(count)
        self.documents = [(t, c) for t, c in zip(terms, counts)]
        lengths = np.array([len(x) for x in documents], np.float64)
        doc, term, count = (np.concatenate(x) for x in (docs, terms, counts))
        order = np.argsort(term, kind="stable")
        self.doc, term, count = doc[order], term[order], count[order]
        size = int(term.max()) + 1
        frequency = np.bincount(term, minlength=size)
        self.first = np.concatenate([[0], np.cumsum(frequency)])
        self.idf = np.log1p((len(documents) - frequency + 0.5) / (frequency + 0.5))
        norm = K1 * (1 - B + B * lengths / max(lengths.mean(), 1.0))
        self.weight = self.idf[term] * count * (K1 + 1) / (count + norm[self.doc])
        self.frequency = frequency

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share the seed's highest-weighted terms, best BM25 score first."""
        terms, counts = self.documents[seed]
        shared = self.frequency[terms] > 1
        terms, counts = terms[shared], counts[shared]
        if len(terms) > QUERY_TERMS:
            picked = np.argsort(-self.idf[terms] * np.minimum(counts, 4), kind="stable")[:QUERY_TERMS]
            terms = terms[picked]
        if not len(terms):
            return np.empty(0, np.int64)
        spans = [slice(self.first[t], self.first[t + 1]) for t in terms]
        docs = np.concatenate([self.doc[s] for s in spans])
        weights = np.concatenate([self.weight[s] for s in spans])
        free = unused[docs]
        scores = np.bincount(docs[free], weights[free], minlength=len(unused))
        found = np.flatnonzero(scores)
        return found[np.argsort(-scores[found], kind="stable")]


def pack_shard(ids: list[np.ndarray], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces ``(document, start, length)`` over a shard's token ids.

    Full windows are cut from the front of long documents. Each remaining end, the longest first, seeds a
    window, which its neighbours fill, best first, then any unused end; the piece that does not fit goes on
    in the next window. The last, unfilled window is cut at powers of two, so that nothing is padded.
    """
    sequences, rest = [], {}
    for d, x in enumerate(ids):
        whole = len(x) // window * window
        sequences += [[(d, s, window)] for s in range(0, whole, window)]
        if whole < len(x):
            rest[d] = whole
    if not rest:
        return sequences
    names = np.array(list(rest))
    index = Bm25Index([ids[d][rest[d]:] for d in names])
    unused = np.ones(len(names), bool)
    lengths = np.array([len(ids[d]) - rest[d] for d in names])
    # from here on documents are places in names
    order, turn = np.argsort(-lengths, kind="stable"), 0
    open_, room, carry, candidates, at = [], window, None, [], 0
    while True:
        if carry is None:
            while at < len(candidates) and not unused[candidates[at]]:
                at += 1
            if at < len(candidates):
                place = int(candidates[at])
            else:
                while turn < len(order) and not unused[order[turn]]:
                    turn += 1
                if turn == len(order):
                    break
                place = int(order[turn])
            unused[place] = False
            start = rest[names[place]]
        else:
            (place, start), carry = carry, None
        if not open_:  # this piece is the window's seed
            candidates, at = index.neighbours(place, unused), 0
        d = int(names[place])
        left = len(ids[d]) - start
        took = min(left, room)
        open_.append((d, start, took))
        room -= took
        if took < left:
            carry = (place, start + took)
        if room == 0:
            sequences.append(open_)
            open_, room, candidates, at = [], window, [], 0
    total = window - room
    while total:
        size, part = 1 << (total.bit_length() - 1), []
        need = size
        while need:
            d, start, length = open_.pop(0)
            took = min(length, need)
            part.append((d, start, took))
            need -= took
            if took < length:
                open_.insert(0, (d, start + took, length - took))
        sequences.append(part)
        total -= size
    return sequences


def pack_documents(docs: DataFrame, tokenizer_path: str | Callable[[], str], end_id: int = 1, window: int = WINDOW,
                   shard_docs: int = SHARD_DOCS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pack every document into sequences of at most ``window`` tokens; one row per piece.

    Columns: ``doc_id, start, length`` (the piece in its document's ids), ``ids_crc32``, ``doc_tokens`` (with
    the end id), ``sequence_id, offset`` (the piece in its sequence, gapless from 0). A null or empty text
    is its end id alone. Repeated rows are packed each by itself; a null ``doc_id`` stays null. Other columns
    are not read. ``tokenizer_path`` is a file that every executor has, or a function that names it there.

    A shard is a run of rows of one input partition, so nothing is shuffled and memory is bounded by
    ``shard_docs`` and ``shard_tokens`` (a single longer document is a shard by itself). Sequences are full
    except for a shard's last ones, which are cut at powers of two: those need no padding.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = word_pieces(tokenizer_path if isinstance(tokenizer_path, str) else tokenizer_path(), end_id)
        partition, made = TaskContext.get().partitionId(), 0
        doc_ids, blobs, tokens = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal made, doc_ids, blobs, tokens
            ids = [np.frombuffer(b, np.uint32) for b in blobs]
            out = []
            for number, sequence in enumerate(pack_shard(ids, window), made):
                offset = 0
                for d, start, length in sequence:
                    crc = zlib.crc32(memoryview(blobs[d])[4 * start: 4 * (start + length)])
                    out.append((doc_ids[d], start, length, crc, len(ids[d]), (partition << 36) + number, offset))
                    offset += length
                made += 1
            doc_ids, blobs, tokens = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=PIECE_NAMES)

        for batch in small_slices(batches):
            doc_ids += batch.column("doc_id").to_pylist()
            new = [pieces.encode(t) for t in pc.fill_null(batch.column("text"), "").to_pylist()]
            blobs += new
            tokens += sum(map(len, new)) // 4
            if len(blobs) >= shard_docs or tokens >= shard_tokens:
                yield flush()
        if blobs:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, PIECES)


PIECE_NAMES = [c.split()[0] for c in PIECES.split(", ")]
