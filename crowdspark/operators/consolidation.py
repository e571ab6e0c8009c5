"""Consolidation of several image tables of the same survey."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdspark.functions.text import clean_file_name, empty_to_null


def _all_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def union_seasons(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of tables with differing columns; missing columns are empty."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).na.fill("")


def full_outer(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], flag: str, suffix: str) -> DataFrame:
    """Full outer join on pairs of columns; left columns win, clashing right columns take the suffix."""
    renamed = {b: f"_key_{i}" for i, (_, b) in enumerate(on)}
    others = {c: (c + suffix if c in left.columns else c) for c in right.columns if c not in renamed}
    other = right.select(*[F.col(a).alias(b) for a, b in {**renamed, **others}.items()], F.lit("1").alias(flag))
    same = [left[a] == other[renamed[b]] for a, b in on]
    joined = left.join(other, reduce(lambda x, y: x & y, same), "full_outer")
    keys = {a: F.coalesce(F.col(a), F.col(renamed[b])) for a, b in on}
    return joined.withColumns(keys).drop(*renamed.values())


def consolidate_sources(database: DataFrame, cleaned: DataFrame, labels: DataFrame) -> DataFrame:
    """All images of three tables: the database export, the cleaned seasons and the label set.

    The first two match on path, season, site and roll, the label set on path, season and site. The
    capture is the database's, else the cleaned one. ``in_db``, ``in_clean`` and ``in_labels`` tell the
    origin. Copies named `` (2)`` get their plain name.
    """
    merged = full_outer(database.withColumn("in_db", F.lit("1")), cleaned, [
        ("image_path", "PathFilename"), ("season", "season"), ("site", "site"), ("roll", "roll")], "in_clean", "_cleaned")
    merged = merged.withColumn("capture", F.coalesce(empty_to_null(F.col("capture")), F.col("capture_cleaned")))
    merged = merged.drop("capture_cleaned")
    merged = full_outer(merged, labels, [("image_path", "image_path"), ("season", "season"), ("site", "site")],
                        "in_labels", "_labels")
    return _all_text(merged).withColumn("image_path", clean_file_name(F.col("image_path")))


def select_by_season(df: DataFrame, groups: Sequence[tuple[Sequence[str], Mapping[str, str]]]) -> DataFrame:
    """Per group of seasons another set of source columns, under common names.

    ``groups`` holds (seasons, {source column: name}). Written as one pass with a choice per column
    instead of one scan per group.
    """
    names = list(dict.fromkeys(n for _, columns in groups for n in columns.values()))
    chosen = []
    for name in names:
        value: Column | None = None
        for seasons, columns in groups:
            source = next((s for s, n in columns.items() if n == name), None)
            picked = F.col(source).cast("string") if source else F.lit("")
            value = (F if value is None else value).when(F.col("season").isin(list(seasons)), picked)
        chosen.append(F.coalesce(value, F.lit("")).alias(name))
    covered = [s for seasons, _ in groups for s in seasons]
    return df.where(F.col("season").isin(covered)).select(*chosen)


def keep_known_images(df: DataFrame, not_existing: DataFrame | Sequence[str] = (), early_seasons: Sequence[str] = (),
                      path: str = "image_path_rel") -> DataFrame:
    """Drop images that do not exist, and rows of early seasons that no trusted table knows.

    ``not_existing`` is a table whose first column holds paths, of any size, or a short list of them.
    """
    unknown = F.col("season").isin(list(early_seasons)) & (F.col("invalid") == "")
    if not isinstance(not_existing, DataFrame):
        not_existing = df.sparkSession.createDataFrame([(p,) for p in not_existing], "path string")
    missing = not_existing.select(F.col(not_existing.columns[0]).alias("_missing"))
    return df.where(~unknown).join(missing, F.col(path) == F.col("_missing"), "left_anti")


def invalid_flags(df: DataFrame) -> DataFrame:
    """``include``, ``image_is_invalid`` and ``image_datetime_uncertain`` from the ``invalid`` code.

    Code 0 is a valid image, 1 to 3 are excluded, an empty code is unknown.
    """
    valid, excluded = F.col("invalid") == "0", F.col("invalid").isin("1", "2", "3")
    flag = F.when(excluded, "1").when(valid, "0").otherwise("")
    return df.withColumns({
        "include": F.when(valid, "1").when(excluded, "0").otherwise(""),
        "image_is_invalid": flag, "image_datetime_uncertain": flag})
