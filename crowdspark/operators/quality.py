"""Checks of images, files and tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdspark.defaults import (
    BLACK_SHARE, BLACK_THRESHOLD, CHECK_PREFIX, CHECKS_DELETE, CHECKS_INVALIDATE, CHECKS_TIME, IMAGE_CHECKS,
    MAX_DAYS_WITHOUT_IMAGE, MAX_IMAGES_PER_CAPTURE, MAX_YEAR, MIN_YEAR, WHITE_SHARE, WHITE_THRESHOLD,
)
from crowdspark.functions.text import base_name, filled
from crowdspark.session import stable
from crowdspark.sources.contents import file_digests


def check_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c.startswith(CHECK_PREFIX)]


def init_checks(df: DataFrame, checks: Sequence[str] = IMAGE_CHECKS) -> DataFrame:
    """All check columns, 0."""
    return df.withColumns({CHECK_PREFIX + c: F.lit(0) for c in checks})


def time_checks(captures: DataFrame, max_days: float = MAX_DAYS_WITHOUT_IMAGE, min_year: int = MIN_YEAR,
                max_year: int = MAX_YEAR, max_images: int = MAX_IMAGES_PER_CAPTURE) -> DataFrame:
    """Flag long pauses to the next image, years out of range and images beyond the expected rank."""
    year = F.year("datetime")
    failed = {
        "time_lapse": F.col("days_to_next_image_taken") > max_days,
        "time_too_new": year > max_year,
        "time_too_old": year < min_year,
        "captures_with_too_many_images": F.col("image_rank_in_capture") > max_images,
    }
    return captures.withColumns({CHECK_PREFIX + c: F.when(f, 1).otherwise(0) for c, f in failed.items()})


def is_failed(check: str) -> Column:
    return F.coalesce(F.col(check).try_cast("double") == 1, F.lit(False))


def has_check(df: DataFrame, checks: Sequence[str]) -> Column:
    """Whether at least one of the named checks failed; checks the table lacks are ignored."""
    failed = F.lit(False)
    for check in checks:
        if CHECK_PREFIX + check in df.columns:
            failed = failed | is_failed(CHECK_PREFIX + check)
    return failed


def issue_is_resolved(df: DataFrame) -> Column:
    """An image is settled if it is invalid or its last action was ``ok``."""
    resolved = F.lit(False)
    if "image_is_invalid" in df.columns:
        resolved = resolved | (filled(F.col("image_is_invalid")) == "1")
    if "action_taken" in df.columns:
        resolved = resolved | (F.substring_index(filled(F.col("action_taken")), "#", -1) == "ok")
    return resolved


def propose_actions(captures: DataFrame, delete: Sequence[str] = CHECKS_DELETE,
                    invalidate: Sequence[str] = CHECKS_INVALIDATE, inspect: Sequence[str] = CHECKS_TIME) -> DataFrame:
    """An action list with one row per image that has unresolved failed checks."""
    action = (
        F.when(has_check(captures, delete), "delete")
        .when(has_check(captures, invalidate), "invalidate")
        .when(has_check(captures, inspect), "inspect")
    )
    names = [F.when(is_failed(c), F.lit(c.removeprefix(CHECK_PREFIX))) for c in check_columns(captures.columns)]
    proposed = captures.where(~issue_is_resolved(captures)).withColumns({
        "action_site": F.lit(""), "action_roll": F.lit(""),
        "action_from_image": F.col("image_name"), "action_to_image": F.col("image_name"),
        "action_to_take": action, "action_to_take_reason": F.array_join(F.array(*names), "|"),
        "datetime_current": F.lit(""), "datetime_new": F.lit(""),
    }).where(F.col("action_to_take").isNotNull())
    listed = [
        "season", "site", "roll", "image_rank_in_roll", "capture", "image_rank_in_capture", "image_name",
        "action_site", "action_roll", "action_from_image", "action_to_image", "action_to_take",
        "action_to_take_reason", "datetime_current", "datetime_new", "datetime", "datetime_exif",
        "datetime_file_creation", "days_to_last_image_taken", "days_to_next_image_taken", "image_path",
        "image_path_rel",
    ]
    return proposed.select(*[c for c in listed if c in proposed.columns])


def check_stats(df: DataFrame) -> DataFrame:
    """Failures, rows and share of each check column."""
    checks = check_columns(df.columns)
    long = df.select(*[F.col(c).try_cast("double").alias(c) for c in checks]).unpivot([], checks, "check", "result")
    stats = long.groupBy("check").agg(F.count_if(F.col("result") == 1).alias("failed"), F.count(F.lit(1)).alias("total"))
    return stats.withColumn("percent", F.round(100 * F.col("failed") / F.col("total"), 2))


def group_shares(df: DataFrame, keys: Sequence[str], places: int = 2) -> DataFrame:
    """Rows per group, all rows and the group's percentage."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).scalar()
    counts = counts.withColumn("total", total)
    return counts.withColumn("percent", F.round(100 * F.col("count") / F.col("total"), places))


def value_shares(df: DataFrame, column: str, places: int = 3) -> DataFrame:
    """Rows per value of one column, the most frequent first."""
    shares = group_shares(df, [column], places).withColumnRenamed("percent", "percentage")
    return shares.orderBy(F.col("count").desc(), column)


def flag_distribution(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows per combination of flag values."""
    return df.groupBy(*flags).agg(F.count(F.lit(1)).alias("count"))


def site_roll_timeline(df: DataFrame, datetime: str = "datetime") -> DataFrame:
    """Images per site, roll and day in long form; days without any image are left out."""
    return df.where(F.col(datetime).isNotNull()).groupBy("site", "roll", F.to_date(datetime).alias("day")).agg(
        F.count(F.lit(1)).alias("images"))


def site_roll_timeline_wide(df: DataFrame, site_rolls: Sequence[str] | None = None, datetime: str = "datetime") -> DataFrame:
    """One row per day, one ``site#roll`` column per roll, 0 where a roll has no image that day.

    Pass ``site_rolls`` for many rolls: without it the column names cost one distinct job.
    """
    long = site_roll_timeline(df, datetime).withColumn("_site_roll", F.concat_ws("#", "site", "roll"))
    wide = long.groupBy("day").pivot("_site_roll", list(site_rolls) if site_rolls else None)
    return wide.agg(F.sum("images")).na.fill(0)


def image_exposure(images: DataFrame, black: tuple[int, float] = (BLACK_THRESHOLD, BLACK_SHARE),
                   white: tuple[int, float] = (WHITE_THRESHOLD, WHITE_SHARE)) -> DataFrame:
    """``all_black``, ``all_white`` and ``corrupt_file`` of a table from Spark's ``image`` source.

    The source decodes on the executors; a file that cannot be decoded has a negative height. Only the
    comparison of the decoded pixels runs in Python, one Arrow batch at a time.
    """
    def exposure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dark, bright = [], []
            for height, width, channels, data in zip(batch.height, batch.width, batch.nChannels, batch.data):
                if height <= 0 or channels != 3:
                    dark.append(0)
                    bright.append(0)
                    continue
                pixels = np.frombuffer(data, dtype=np.uint8).reshape(height * width, 3)
                dark.append(int((pixels < black[0]).all(axis=1).mean() > black[1]))
                bright.append(int((pixels > white[0]).all(axis=1).mean() > white[1]))
            yield pd.DataFrame({
                "path": batch.origin, CHECK_PREFIX + "all_black": dark, CHECK_PREFIX + "all_white": bright,
                CHECK_PREFIX + "corrupt_file": (batch.height < 0).astype("int32"),
            })

    schema = f"path string, {CHECK_PREFIX}all_black int, {CHECK_PREFIX}all_white int, {CHECK_PREFIX}corrupt_file int"
    return images.select("image.origin", "image.height", "image.width", "image.nChannels", "image.data").mapInPandas(
        exposure, schema)


def _repeated(files: DataFrame, *keys: str) -> DataFrame:
    """Files whose keys occur more than once; the counts are aggregated before the shuffle."""
    counts = files.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*keys)
    return files.join(counts, list(keys), "left_semi")


def _same_content(files: DataFrame, prefix_bytes: int) -> DataFrame:
    """``files`` (with ``path, length``) of equal size and equal start, with ``_hash`` of the whole content.

    Sizes come from the listing. Only files that share a size are opened, for their first bytes; only those that
    share these too are read whole. Files that fit into the first bytes are not read again.
    """
    starts = stable(file_digests(files, prefix_bytes, "_start").where("_start is not null"))
    same = _repeated(starts, "length", "_start")
    short = same.where(F.col("length") <= prefix_bytes).withColumn("_hash", F.col("_start"))
    long = file_digests(same.where(F.col("length") > prefix_bytes), None, "_hash")
    return stable(short.unionByName(long).where("_hash is not null").drop("_start"))


def duplicate_files(files: DataFrame, order_by: Sequence[str] = ("path",), prefix_bytes: int = 1024) -> DataFrame:
    """Pairs of a file and the first file of equal content: ``path, first_path, length``.

    Expects ``path`` and ``length``. Without ``content`` the files are opened by path, in stages: those of equal size,
    then those of equal start. A ``content`` column is hashed where it is, and never crosses a shuffle. Files that
    cannot be read are left out.
    """
    columns = [F.col(c) for c in dict.fromkeys(["path", "length", *order_by])]
    if "content" in files.columns:
        hashed = files.select(*columns, F.sha1("content").alias("_hash"))
    else:
        hashed = _same_content(_repeated(files.select(*columns), "length"), prefix_bytes)
    firsts = hashed.groupBy("length", "_hash").agg(
        F.min_by("path", F.struct(*order_by)).alias("first_path"), F.count(F.lit(1)).alias("_n"))
    firsts = firsts.where(F.col("_n") > 1).drop("_n")
    return hashed.join(firsts, ["length", "_hash"]).where(F.col("path") != F.col("first_path")).select(
        "path", "first_path", "length")


def match_files(find: DataFrame, search: DataFrame, verify_single: bool = False, prefix_bytes: int = 1024) -> DataFrame:
    """The searched file of each file to find: equal size, and equal content if several share the size.

    Both tables need ``path`` and ``length``. Files without a match keep null. Sizes with one searched file match by
    size alone unless ``verify_single``; all others match on size and hash, of ``content`` if both tables have it, else
    of the files themselves, of which only those are opened whose size is on both sides and has to be compared.
    """
    tables = [t.select("path", "length", F.lit(side).alias("_side"), *(["content"] if "content" in t.columns else []))
              for side, t in enumerate((find, search))]
    per_size = tables[1].groupBy("length").agg(F.count(F.lit(1)).alias("_n"), F.min("path").alias("_only"))
    if all("content" in t.columns for t in tables):
        hashed = tables[0].unionByName(tables[1]).select("path", "length", "_side", F.sha1("content").alias("_hash"))
    else:
        compared = per_size if verify_single else per_size.where(F.col("_n") > 1)
        sizes = compared.select("length").join(find.select("length").distinct(), "length", "left_semi")
        both = tables[0].drop("content").unionByName(tables[1].drop("content"))
        hashed = _same_content(both.join(sizes, "length", "left_semi"), prefix_bytes)
    firsts = hashed.where("_side = 1").groupBy("length", "_hash").agg(F.min("path").alias("path_found"))
    same = hashed.where("_side = 0").join(firsts, ["length", "_hash"]).select("path", "path_found")
    matched = tables[0].select("path", "length").join(per_size, "length", "left").join(same, "path", "left")
    found = F.col("path_found") if verify_single else F.when(F.col("_n") == 1, F.col("_only")).otherwise(
        F.col("path_found"))
    return matched.select(F.col("path").alias("path_search"), found.alias("path_found")).withColumn(
        "name_found", base_name(F.col("path_found")))


def coverage_check(reference: DataFrame, result: DataFrame, on: Sequence[str], compare: Sequence[str] = ()) -> DataFrame:
    """Reference rows that are missing from the result or differ in a compared column."""
    right = result.select(*[F.col(c).alias(f"_r_{c}") for c in dict.fromkeys([*on, *compare])], F.lit(1).alias("_found"))
    same = [reference[c] == right[f"_r_{c}"] for c in on]
    problem = F.when(F.col("_found").isNull(), "missing")
    for c in compare:
        problem = problem.when((F.col(c) != "") & ~F.col(c).eqNullSafe(F.col(f"_r_{c}")), f"different {c}")
    joined = reference.join(right, same, "left").withColumn("problem", problem)
    return joined.where(F.col("problem").isNotNull()).select(*on, "problem")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)
