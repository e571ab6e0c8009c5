"""Ranged reads of file contents by path."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

#: Bytes of a file that are read at once.
PIECE = 1 << 20
#: Tasks for each core that open files.
TASKS_PER_CORE = 4


def file_digests(files: DataFrame, size: int | None = None, out: str = "digest") -> DataFrame:
    """``files`` with the SHA-1 of the first ``size`` bytes of each ``path``, or of all; null if it cannot be read.

    A task opens its own files and reads no more bytes than it hashes, a piece at a time; contents never leave it. The
    list of files is short, whatever they hold, so it is dealt to all cores first.
    """
    files = files.repartition(files.sparkSession.sparkContext.defaultParallelism * TASKS_PER_CORE, "path")

    def digest(path: str | None) -> str | None:
        try:
            system, name = FileSystem.from_uri(path)
            done, left = sha1(), size
            with system.open_input_file(name) as file:
                while piece := file.read(PIECE if left is None else min(PIECE, left)):
                    done.update(piece)
                    left = None if left is None else left - len(piece)
            return done.hexdigest()
        except (OSError, pa.ArrowInvalid, TypeError):
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(out, pa.array([digest(p) for p in batch.column("path").to_pylist()], pa.string()))

    return files.mapInArrow(run, StructType([*files.schema.fields, StructField(out, StringType())]))
