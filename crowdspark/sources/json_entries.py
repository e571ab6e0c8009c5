"""Entries of large JSON documents, read by many tasks.

A document is cut into blocks of bytes. Whether a block begins inside a string, and how deep, is not known from the
block alone: a first pass counts quotes and brackets of every block, for either case, a running sum over the few numbers
of the blocks gives the state at each block's beginning, and a second pass cuts out the entries that begin in a block.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crowdspark.sources.contents import PIECE

#: Bytes of a document that one row of blocks stands for.
BLOCK_BYTES = 8 << 20
COMPRESSED = r"\.(gz|bz2|zst|lz4)$"

_QUOTE, _SLASH, _COMMA = ord('"'), ord("\\"), 2
_KIND = np.zeros(256, np.int8)
_KIND[[ord("{"), ord("[")]], _KIND[[ord("}"), ord("]")]], _KIND[ord(",")] = 1, -1, _COMMA
_KEY = re.compile(rb'("(?:[^"\\]|\\.)*")\s*:\s*$', re.DOTALL)


def _open(path: str) -> pa.NativeFile:
    system, name = FileSystem.from_uri(path)
    if re.search(COMPRESSED, path):
        with system.open_input_stream(name, compression="detect") as stream:
            return pa.BufferReader(stream.read())
    return system.open_input_file(name)


def _trailing_slashes(data: bytes, before: int = 0) -> int:
    """Backslashes at the end of ``data``, and those before it if it holds nothing else."""
    n = len(data) - len(data.rstrip(b"\\"))
    return n + before if n == len(data) else n


def _slashes_before(file: pa.NativeFile, place: int) -> int:
    total, step = 0, 64
    while place:
        data = file.read_at(min(step, place), place - min(step, place))
        n = _trailing_slashes(data)
        total, place, step = total + n, place - n, step * 2
        if n < len(data):
            break
    return total


def _marks(data: bytes, slashes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of brackets and commas, what they are, and the parity of the quotes before each and in all.

    A quote after an odd number of backslashes is part of a string; ``slashes`` are those in front of ``data``.
    """
    b = np.frombuffer(data, np.uint8)
    quotes = (b == _QUOTE).astype(np.uint8)
    back = np.flatnonzero(b == _SLASH)
    if len(back):
        first = np.append(True, np.diff(back) > 1)
        last = np.append(first[1:], True)
        run = back[last] - back[first] + 1
        if back[0] == 0:
            run[0] += slashes
        after = back[last][run % 2 == 1] + 1
        quotes[after[after < len(b)]] = 0
    if slashes % 2 and b[0] != _SLASH:
        quotes[0] = 0
    parity = np.bitwise_xor.accumulate(quotes)
    kinds = _KIND[b]
    places = np.flatnonzero(kinds)
    return places, kinds[places], parity[places], int(parity[-1])


def _pieces(file: pa.NativeFile, start: int, stop: int) -> Iterator[tuple[int, bytes, int]]:
    """Place, bytes and backslashes before, of pieces from ``start``; those after ``stop`` as long as they are asked for."""
    slashes = _slashes_before(file, start)
    while data := file.read_at(min(PIECE, stop - start) if start < stop else PIECE, start):
        yield start, data, slashes
        start, slashes = start + len(data), _trailing_slashes(data, slashes)


def _steps(file: pa.NativeFile, start: int, stop: int, parity: int, depth: int):
    """Pieces with the marks outside of strings: place, bytes, places, kinds, depth after each."""
    for place, data, slashes in _pieces(file, start, stop):
        places, kinds, inside, total = _marks(data, slashes)
        outside = inside == parity
        places, kinds = places[outside], kinds[outside]
        deep = depth + np.cumsum(np.where(kinds == _COMMA, 0, kinds))
        yield place, data, places, kinds, deep
        parity, depth = parity ^ total, int(deep[-1]) if len(deep) else depth


def _summary(file: pa.NativeFile, start: int, stop: int) -> tuple[int, int, int]:
    """Parity of the quotes of a block, and how much deeper it ends if it begins outside or inside of a string."""
    parity, deeper = 0, [0, 0]
    for place, data, slashes in _pieces(file, start, stop):
        if place >= stop:
            break
        _, kinds, inside, total = _marks(data, slashes)
        kinds = np.where(kinds == _COMMA, 0, kinds)
        for case in (0, 1):
            deeper[case] += int(kinds[inside ^ parity == case].sum())
        parity ^= total
    return parity, *deeper


def _last_array(file: pa.NativeFile, start: int, stop: int, parity: int, depth: int) -> int | None:
    """Place of the last bracket of a block that opens a value of the outermost object."""
    found = None
    for place, _, places, kinds, deep in _steps(file, start, stop, parity, depth):
        if place >= stop:
            break
        opened = places[(kinds == 1) & (deep == 2)]
        found = place + int(opened[-1]) if len(opened) else found
    return found


def _entries(file: pa.NativeFile, start: int, stop: int, parity: int, depth: int, level: int) -> Iterator[tuple[bool, int, bytes]]:
    """Entries of that level that begin in the block, read to their ends: first of its container or not, place, bytes."""
    held, begun, opened = [], None, False
    for place, data, places, kinds, deep in _steps(file, start, stop, parity, depth):
        starts = (kinds > 0) & (deep == level)
        bounds = starts | ((kinds == -1) & (deep == level - 1))
        begin = 0
        for at, kind, begins in zip(places[bounds].tolist(), kinds[bounds].tolist(), starts[bounds].tolist()):
            if begun is not None:
                yield opened, begun, b"".join(held) + data[begin:at]
            held, begun = [], None
            if place + at >= stop:
                return
            if begins:
                begun, begin, opened = place + at, at + 1, kind == 1
        if begun is not None:
            held.append(data[begin:])
        elif place + len(data) >= stop:
            return
    if begun is not None:
        yield opened, begun, b"".join(held)


def _key_before(file: pa.NativeFile, place: int) -> str | None:
    size = 256
    while True:
        data = file.read_at(min(size, place), place - min(size, place))
        if found := _KEY.search(data):
            return json.loads(found[1])
        if size >= place:
            return None
        size *= 4


def _map_blocks(df: DataFrame, schema: str, run) -> DataFrame:
    """``run(file, row)`` yields the values of the new columns for a row of blocks; a file stays open while rows are its."""
    names = [part.split()[0] for part in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:
                    path, file = row["path"], _open(row["path"])
                out, size = [], 0
                for values in run(file, row):
                    out.append(values)
                    size += len(values[-1]) if isinstance(values[-1], str) else 32
                    if size > PIECE:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, v)) for v in out], arrow)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, v)) for v in out], arrow)

    types = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    arrow = pa.schema([(n, types[part.split()[1]]) for n, part in zip(names, schema.split(", "))])
    return df.mapInArrow(work, schema)


def json_blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of all files of ``path`` with the state at their beginnings: ``path, start, stop, parity, depth``.

    A compressed file cannot be read from its middle and is one block.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(
        F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), "^s3[an]:", "s3:").alias("path"), "length")
    whole = F.col("path").rlike(COMPRESSED)
    step = F.when(whole, F.col("length")).otherwise(F.lit(block_bytes)).cast("bigint")
    blocks = files.withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, step))).select(
        "path", "start", F.when(whole, F.lit(2**62)).otherwise(F.least(F.col("start") + step, F.col("length"))).alias("stop"))
    blocks = blocks.repartition(spark.sparkContext.defaultParallelism * 4, "path", "start")

    def summarise(file, row):
        yield row["path"], row["start"], row["stop"], *_summary(file, row["start"], row["stop"])

    sums = _map_blocks(blocks, "path string, start bigint, stop bigint, quotes bigint, outside bigint, inside bigint", summarise)
    # one row of numbers for each block
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumn("parity", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    deeper = F.when(F.col("parity") == 0, F.col("outside")).otherwise(F.col("inside"))
    placed = placed.withColumn("_deeper", deeper).withColumn("depth", F.coalesce(F.sum("_deeper").over(before), F.lit(0)))
    return placed.select("path", "start", "stop", "parity", "depth")


def _spread(blocks: DataFrame) -> DataFrame:
    """The states of a file's blocks come out of one task; reading is spread again."""
    return blocks.repartition(blocks.sparkSession.sparkContext.defaultParallelism * 4, "path", "start")


def object_entries(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The entries of the object that each file holds, each as an object of its own: ``value``.

    Files may be of any size and are read by many tasks, twice each; only a single entry has to fit into a task. An entry
    that does not parse is left to the caller and harms no other. Empty files and empty objects have no rows.
    """
    def cut(file, row):
        for _, _, entry in _entries(file, row["start"], row["stop"], row["parity"], row["depth"], 1):
            if entry.strip():
                yield ("{" + entry.decode("utf-8", "replace") + "}",)

    return _map_blocks(_spread(json_blocks(spark, path, block_bytes)), "value string", cut)


def array_entries(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The elements of the arrays that the object of each file holds: ``name`` of the array, ``value`` as text.

    As ``object_entries``; a third pass finds which array reaches into a block. Values that are objects count as arrays
    of their entries, plain values have no rows.
    """
    def arrays(file, row):
        state = row["path"], row["start"], row["stop"], row["parity"], row["depth"]
        yield *state, _last_array(file, *state[1:])

    blocks = _map_blocks(_spread(json_blocks(spark, path, block_bytes)),
                         "path string, start bigint, stop bigint, parity bigint, depth bigint, opened bigint", arrays)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("opened", F.last("opened", ignorenulls=True).over(before))

    def cut(file, row):
        name = None if row["opened"] is None else _key_before(file, row["opened"])
        for first, place, entry in _entries(file, row["start"], row["stop"], row["parity"], row["depth"], 2):
            name = _key_before(file, place) if first else name
            if entry.strip():
                yield name, entry.decode("utf-8", "replace")

    return _map_blocks(_spread(blocks), "name string, value string", cut)
