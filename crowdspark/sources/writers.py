"""Writers of the survey files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdspark.defaults import (
    CHECK_PREFIX, CLEANED_EXCLUDED_COLUMNS, CLEANED_FIRST_COLUMNS, TAG_PREFIX,
)


def first_then_rest(columns: Sequence[str], first: Sequence[str]) -> list[str]:
    """The listed columns that exist, then all others in their order."""
    front = [c for c in first if c in columns]
    return front + [c for c in columns if c not in front]


def without_prefixes(columns: Sequence[str], prefixes: Sequence[str]) -> list[str]:
    return [c for c in columns if not c.startswith(tuple(prefixes))] if prefixes else list(columns)


def project_cleaned(df: DataFrame, first: Sequence[str] = CLEANED_FIRST_COLUMNS,
                    exclude: Sequence[str] = CLEANED_EXCLUDED_COLUMNS, exclude_tags: bool = True,
                    exclude_checks: bool = True) -> DataFrame:
    """Columns of the cleaned capture table in order; tags and checks are left out by default."""
    columns = [c for c in first_then_rest(df.columns, first) if c not in exclude]
    prefixes = [TAG_PREFIX] * exclude_tags + [CHECK_PREFIX] * exclude_checks
    return df.select(*[F.col(f"`{c}`") for c in without_prefixes(columns, prefixes)])


def write_table(df: DataFrame, path: str, first: Sequence[str] = (), mode: str = "error", compression: str = "none",
                file_rows: int = 0) -> None:
    """CSV with the listed columns first and the rows sorted by them.

    A hash of the row breaks ties, so that equal keys do not all end in one task. A compressed file is read by one task,
    so give ``file_rows``, the most rows of a file (0: as many as its task has), with ``compression``.
    """
    ordered = df.select(*first_then_rest(df.columns, first))
    keys = [c for c in first if c in df.columns]
    (ordered.orderBy(*keys, F.xxhash64(*df.columns)) if keys else ordered).write.mode(mode).options(
        header=True, escape='"', compression=compression, maxRecordsPerFile=file_rows).csv(path)


def split_by_season(df: DataFrame, path: str, mode: str = "error") -> None:
    """One folder per season, so that later reads prune to the seasons they need."""
    # rows of a season meet in a few tasks, and a large season is cut by a second, spreading key
    spread = df.repartitionByRange("season", F.xxhash64(*df.columns))
    spread.write.mode(mode).partitionBy("season").options(header=True, escape='"').csv(path)


def write_season_files(df: DataFrame, path: str, order_by: Sequence[str | Column], mode: str = "error") -> None:
    """Sorted files per season; a large season is spread over several range-partitioned files."""
    ordered = df.repartitionByRange("season", *order_by).sortWithinPartitions("season", *order_by)
    ordered.write.mode(mode).partitionBy("season").options(header=True, escape='"').csv(path)


def manifest_lines(manifest: DataFrame) -> DataFrame:
    """One line ``{"<capture id>": {...}}`` per record, as text in ``value``."""
    record = F.struct(*[c for c in manifest.columns if c not in ("capture_id", "batch")])
    return manifest.withColumn("value", F.to_json(F.create_map("capture_id", record)))


def write_manifest(manifest: DataFrame, path: str, mode: str = "error") -> None:
    manifest_lines(manifest).select("value").write.mode(mode).text(path)


def write_manifest_batches(manifest: DataFrame, path: str, identifier: str, name: str, mode: str = "error") -> None:
    """One folder per batch, ``batch=<id>__batch_<n>__<name>``; ``overwrite`` replaces the batches it writes and no others."""
    label = F.concat(F.lit(f"{identifier}__batch_"), F.col("batch").cast("string"), F.lit(f"__{name}"))
    lines = manifest_lines(manifest).select("value", label.alias("batch"))
    lines.repartitionByRange("batch", F.xxhash64("value")).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(
        "batch").text(path)


COMMITS = "_commits"


def append_tracker(df: DataFrame, path: str, columns: Sequence[str] = ("capture_id", "subject_id"),
                   batch: str | None = None) -> None:
    """Append processed ids to the tracker table.

    With a ``batch`` id the rows are committed once: they go into the batch's own folder, which replaces what an
    interrupted run left there, and then a commit names it. A batch that is committed already is not written again.
    ``read_tracker`` reads committed batches only.
    """
    if batch is None:
        df.select(*columns).write.mode("append").options(header=True).csv(path)
    elif batch not in committed_batches(df.sparkSession, path, every=True):
        _commit(df.select(*columns), path, batch, [])


def _commit(df: DataFrame, path: str, batch: str, replaces: Sequence[str]) -> None:
    """Write the rows of a batch, then the commit that makes them, and nothing of ``replaces``, visible."""
    df.write.mode("overwrite").options(header=True).csv(f"{path}/batch={batch}")
    done = df.sparkSession.createDataFrame([(batch, list(replaces))], "batch string, replaces array<string>")
    done.coalesce(1).write.mode("overwrite").json(f"{path}/{COMMITS}/batch={batch}")


def committed_batches(spark: SparkSession, path: str, every: bool = False) -> list[str]:
    """The batches that make up the tracker; with ``every``, also those that were compacted into others."""
    try:
        rows = spark.read.schema("name string, batch string, replaces array<string>").json(f"{path}/{COMMITS}/*").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    names, replaced = {r.batch for r in rows}, {b for r in rows for b in r.replaces or []}
    return sorted(names | replaced if every else names - replaced)


def read_tracker(spark: SparkSession, path: str, schema: str = "capture_id string, subject_id string") -> DataFrame:
    """The rows of all committed batches; empty if there are none."""
    batches = committed_batches(spark, path)
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).options(header=True).csv([f"{path}/batch={b}" for b in batches]).na.fill("")


def compact_tracker(spark: SparkSession, path: str, batch: str, schema: str = "capture_id string, subject_id string",
                    files: int = 1) -> None:
    """One batch of ``files`` files in place of all committed ones; readers see either them or it."""
    old = committed_batches(spark, path)
    if old and batch not in committed_batches(spark, path, every=True):
        _commit(read_tracker(spark, path, schema).distinct().coalesce(files), path, batch, old)
