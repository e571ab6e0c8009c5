"""Time-ordered images of a roll: ranks, time gaps and capture events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdspark.defaults import (
    CAPTURE_GAP_SECONDS, FLAGS_REMOVED_FROM_CLEANED, GROUP_KEYS, HOT_GROUP_ROWS, MAX_DAYS_WITHOUT_IMAGE,
    MAX_IMAGES_PER_CAPTURE, MAX_YEAR, MIN_YEAR,
)
from crowdspark.functions import text
from crowdspark.functions.times import epoch_seconds, split_date_time
from crowdspark.operators.ordering import SLICE, before_slice, join_summary, ordered_slices, split_hot_groups
from crowdspark.operators.quality import time_checks
from crowdspark.session import stable

SECONDS_PER_DAY = 86400.0


def _local_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_gap: float) -> DataFrame:
    """Position, neighbours and breaks of each row within its window partition."""
    w = Window.partitionBy(*keys).orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumns({
        "_rn": F.row_number().over(w),
        "_prev": F.lag("_s").over(w),
        "_next": F.lead("_s").over(w),
    })
    df = df.withColumn("_break", F.when(F.col("_s") - F.col("_prev") > max_gap, 1).otherwise(0))
    return df.withColumns({
        "_breaks": F.sum("_break").over(running),
        "_start": F.max(F.when(F.col("_break") == 1, F.col("_rn"))).over(running),
    })


def _slice_summary(local: DataFrame, keys: Sequence[str], max_gap: float) -> DataFrame:
    """What the slices before and after each slice contribute to its rows."""
    summary = local.groupBy(*keys, SLICE).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_s").alias("_s_min"),
        F.max("_s").alias("_s_max"),
        F.sum("_break").alias("_n_breaks"),
        F.max(F.when(F.col("_break") == 1, F.col("_rn"))).alias("_last_start"),
    )
    w = Window.partitionBy(*keys).orderBy(SLICE)
    summary = summary.withColumns({
        "_before": before_slice(summary, keys, "_n"),
        "_prev_s": F.lag("_s_max").over(w),
        "_next_s": F.lead("_s_min").over(w),
    })
    summary = summary.withColumn("_head", F.when(F.col("_s_min") - F.col("_prev_s") > max_gap, 1).otherwise(0))
    # position of the image that opens the last capture of the slice, null if it was opened earlier
    head_start = F.when((F.col("_head") == 1) | F.col("_prev_s").isNull(), F.col("_before") + 1)
    opened = F.coalesce(F.col("_before") + F.col("_last_start"), head_start)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_all_breaks", F.col("_n_breaks") + F.col("_head"))
    summary = summary.withColumns({
        "_breaks_before": before_slice(summary, keys, "_all_breaks") + F.col("_head"),
        "_open_start": F.greatest(F.max(opened).over(earlier), head_start),
    })
    return summary.select(*keys, SLICE, "_before", "_prev_s", "_next_s", "_breaks_before", "_open_start")


def group_into_captures(
    inventory: DataFrame, *, keys: Sequence[str] = GROUP_KEYS, datetime: str = "datetime",
    unique_id: str = "image_path_original", max_gap: float = CAPTURE_GAP_SECONDS,
    hot_group_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Rank the images of each roll by time and id and group them into captures.

    A new capture starts when the gap to the previous image is larger than ``max_gap`` seconds. Adds
    the rank in the roll, the gaps to the neighbours, ``capture``, ``image_rank_in_capture`` and
    ``capture_id``. One shuffle serves all of them. Rolls above ``hot_group_rows`` are cut into
    range slices, so no task holds a whole one.
    """
    keys, order = list(keys), [datetime, unique_id]
    base = [c for c in inventory.columns if c not in CAPTURE_COLUMNS]
    rows = inventory.select(*base).withColumn("_s", epoch_seconds(F.col(datetime)))
    cold, hot = split_hot_groups(rows, keys, hot_group_rows)
    parts = [
        _local_columns(cold, keys, order, max_gap)
        .withColumns({"_before": F.lit(0), "_breaks_before": F.lit(0), "_open_start": F.lit(1),
                      "_prev_s": F.lit(None).cast("double"), "_next_s": F.lit(None).cast("double")})
    ]
    if hot is not None:
        local = _local_columns(ordered_slices(hot, [*keys, *order]), [SLICE, *keys], order, max_gap)
        parts.append(join_summary(local, _slice_summary(local, keys, max_gap), keys))
    columns = [*base, *_capture_columns(keys)]
    grouped = parts[0].select(*columns)
    return grouped if hot is None else grouped.unionByName(parts[1].select(*columns))


CAPTURE_COLUMNS = (
    "image_rank_in_roll", "seconds_to_last_image_taken", "seconds_to_next_image_taken",
    "days_to_last_image_taken", "days_to_next_image_taken", "capture", "image_rank_in_capture", "capture_id",
)


def _capture_columns(keys: Sequence[str]) -> list[Column]:
    rank = F.col("_before") + F.col("_rn")
    last = F.coalesce(F.col("_s") - F.coalesce(F.col("_prev"), F.col("_prev_s")), F.lit(0.0))
    following = F.coalesce(F.coalesce(F.col("_next"), F.col("_next_s")) - F.col("_s"), F.lit(0.0))
    capture = (1 + F.col("_breaks_before") + F.col("_breaks")).cast("int")
    start = F.coalesce(F.col("_before") + F.col("_start"), F.col("_open_start"))
    return [
        rank.cast("int").alias("image_rank_in_roll"),
        last.alias("seconds_to_last_image_taken"),
        following.alias("seconds_to_next_image_taken"),
        F.round(last / SECONDS_PER_DAY, 2).alias("days_to_last_image_taken"),
        F.round(following / SECONDS_PER_DAY, 2).alias("days_to_next_image_taken"),
        capture.alias("capture"),
        (rank - start + 1).cast("int").alias("image_rank_in_capture"),
        F.concat_ws("#", *keys, capture.cast("string")).alias("capture_id"),
    ]


def add_image_names(captures: DataFrame) -> DataFrame:
    """New image name, path and relative path from season, site, roll and rank."""
    name = text.image_name(F.col("image_rank_in_roll"), F.col("image_name_original"))
    return captures.withColumn("image_name", name).withColumns({
        "image_path": text.join_path(text.parent(F.col("image_path_original")), F.col("image_name")),
        "image_path_rel": text.join_path(text.parent(F.col("image_path_original_rel")), F.col("image_name")),
    })


def capture_inventory(inventory: DataFrame, *, max_gap: float = CAPTURE_GAP_SECONDS,
                      max_days: float = MAX_DAYS_WITHOUT_IMAGE, min_year: int = MIN_YEAR, max_year: int = MAX_YEAR,
                      max_images: int = MAX_IMAGES_PER_CAPTURE, **options) -> DataFrame:
    """Captures, new image names and time checks of an image inventory."""
    grouped = add_image_names(group_into_captures(inventory, max_gap=max_gap, **options))
    return time_checks(grouped, max_days=max_days, min_year=min_year, max_year=max_year, max_images=max_images)


def flagged(df: DataFrame, flags: Mapping[str, Sequence[str]]) -> Column:
    """Whether any flag column of the table holds one of its listed values."""
    condition = F.lit(False)
    for column, values in flags.items():
        if column in df.columns:
            condition = condition | F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    return condition


def remove_flagged(df: DataFrame, flags: Mapping[str, Sequence[str]] = FLAGS_REMOVED_FROM_CLEANED) -> DataFrame:
    """Drop the rows of flagged images; flag columns the table lacks are ignored."""
    return df.where(~flagged(df, flags))


def regroup_after_actions(captures: DataFrame, *, unique_id: str = "image_name",
                          flags: Mapping[str, Sequence[str]] = FLAGS_REMOVED_FROM_CLEANED,
                          max_days: float = MAX_DAYS_WITHOUT_IMAGE, min_year: int = MIN_YEAR,
                          max_year: int = MAX_YEAR, max_images: int = MAX_IMAGES_PER_CAPTURE, **options) -> DataFrame:
    """Drop removed images and number ranks and captures again, without gaps."""
    grouped = group_into_captures(remove_flagged(captures, flags), unique_id=unique_id, **options)
    return time_checks(grouped, max_days=max_days, min_year=min_year, max_year=max_year, max_images=max_images)


def regroup_touched(captures: DataFrame, actions: DataFrame, *, image: str = "image_name", keys: Sequence[str] = GROUP_KEYS,
                    flags: Mapping[str, Sequence[str]] = FLAGS_REMOVED_FROM_CLEANED, **options) -> DataFrame:
    """``regroup_after_actions`` of the rolls that ``actions`` touch; the rows of all others pass by unchanged.

    ``captures`` are grouped captures to which the actions were applied, ``actions`` has the ``image`` of each. A roll is
    touched if an action names one of its images or if it holds an image that is to be removed. The rolls are a short list, so
    that the rows of untouched rolls are not shuffled but filtered where they are.
    """
    named = captures.join(actions.select(F.col("image").alias(image)).distinct(), image, "left_semi").select(*keys)
    touched = stable(named.unionByName(captures.where(flagged(captures, flags)).select(*keys)).distinct())
    again = regroup_after_actions(captures.join(touched, list(keys), "left_semi"), unique_id=image, keys=keys, flags=flags, **options)
    rest = captures.join(touched, list(keys), "left_anti")
    return again.unionByName(rest.select(*again.columns))


def capture_number(capture_id: str = "capture_id") -> Column:
    return F.element_at(F.split(F.col(capture_id), "#"), -1).try_cast("int")


def sort_by_capture(df: DataFrame) -> DataFrame:
    """Season, site and roll as text, then the capture number; a range-partitioned sort."""
    parts = F.split("capture_id", "#")
    return df.orderBy(parts[0], parts[1], parts[2], capture_number())


def image_rank(df: DataFrame) -> Column:
    """The image's rank within its capture, from the first rank column the table has."""
    column = next((c for c in ("image_rank_in_capture", "image") if c in df.columns), None)
    return F.col(column).try_cast("int") if column else F.lit(None).cast("int")


def sort_images(df: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Images by season, site, roll, capture number and image rank."""
    return df.orderBy("season", "site", "roll", F.col("capture").try_cast("int"), image_rank(df), *tie)


def season_captures(images: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """One row per capture with the local date and time of its first image."""
    date, time = split_date_time(images.columns)
    info = ["season", "site", "roll", "capture"]
    rows = images.select("capture_id", F.struct(*order_by).alias("_ord"), F.struct(
        *info, date.alias("capture_date_local"), time.alias("capture_time_local")).alias("_info"))
    firsts = rows.groupBy("capture_id").agg(F.min_by("_info", "_ord").alias("_info"))
    return firsts.select("capture_id", "_info.*")


def capture_times(images: DataFrame, order_by: Sequence[str], keys: Sequence[str] = (*GROUP_KEYS, "capture"),
                  datetime: str = "datetime") -> DataFrame:
    """The first non-empty time of each capture; captures without any keep the empty text."""
    known = F.when(F.col(datetime) != "", F.struct(*order_by, F.col(datetime).alias("_value")))
    firsts = images.groupBy(*keys).agg(F.min(known).alias("_first"))
    return firsts.select(*keys, F.coalesce("_first._value", F.lit("")).alias(datetime))
