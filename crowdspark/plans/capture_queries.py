"""Queries of the capture, check and time operators over ``events`` as an image inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.functions import times
from crowdspark.operators import captures, ordering, quality
from crowdspark.plans.registry import query
from crowdspark.plans.sql_views import REQUIRES, VIEWS
from crowdspark.plans.tables import Tables

# v_captures with the time checks; the smallest gaps of the data are seconds, so days are not reached
VIEWS["v_checked"] = """
SELECT *, CASE WHEN days_to_next_image_taken > 0.3 THEN 1 ELSE 0 END AS image_check__time_lapse,
  CASE WHEN year(datetime) > 9999 THEN 1 ELSE 0 END AS image_check__time_too_new,
  CASE WHEN year(datetime) < 1970 THEN 1 ELSE 0 END AS image_check__time_too_old,
  CASE WHEN image_rank_in_capture > 3 THEN 1 ELSE 0 END AS image_check__captures_with_too_many_images
FROM v_captures"""
REQUIRES["v_checked"] = ["v_captures"]
# file checks and flags taken from the event columns, so that every check occurs
VIEWS["v_flagged"] = """
SELECT *, CASE WHEN event_type = 'error' AND value < 40 THEN 1 ELSE 0 END AS image_check__corrupt_file,
  CASE WHEN event_type = 'view' AND value > 200 THEN 1 ELSE 0 END AS image_check__all_black,
  CASE WHEN event_type = 'purchase' AND value < 3 THEN 1 ELSE 0 END AS image_check__empty_exif,
  CASE WHEN value > 150 THEN '1' ELSE '' END AS image_is_invalid,
  CASE WHEN event_type = 'error' AND value < 20 THEN '1' ELSE '' END AS image_was_deleted,
  CASE WHEN event_type = 'signup' AND value > 120 THEN '1' ELSE '' END AS image_no_upload,
  CASE WHEN event_type = 'click' THEN 'timechange#ok' WHEN event_type = 'view' THEN 'ok#invalidate' ELSE '' END
    AS action_taken
FROM v_checked"""
REQUIRES["v_flagged"] = ["v_checked"]

GAP, MAX_DAYS = 21600, 0.3
IMAGE_COLUMNS = ("season", "site", "roll", "image_path_original")


def grouped(t: Tables, **options) -> DataFrame:
    return captures.group_into_captures(t.inventory, max_gap=GAP, **options)


def checked(t: Tables) -> DataFrame:
    return captures.capture_inventory(t.inventory, max_gap=GAP, max_days=MAX_DAYS)


def flagged(t: Tables) -> DataFrame:
    value, kind = F.col("value"), F.col("event_type")
    return checked(t).withColumns({
        "image_check__corrupt_file": F.when((kind == "error") & (value < 40), 1).otherwise(0),
        "image_check__all_black": F.when((kind == "view") & (value > 200), 1).otherwise(0),
        "image_check__empty_exif": F.when((kind == "purchase") & (value < 3), 1).otherwise(0),
        "image_is_invalid": F.when(value > 150, "1").otherwise(""),
        "image_was_deleted": F.when((kind == "error") & (value < 20), "1").otherwise(""),
        "image_no_upload": F.when((kind == "signup") & (value > 120), "1").otherwise(""),
        "action_taken": F.when(kind == "click", "timechange#ok").when(kind == "view", "ok#invalidate").otherwise(""),
    })


@query("v_gaps", """
SELECT season, site, roll, image_path_original, CAST(image_rank_in_roll AS INTEGER) AS image_rank_in_roll FROM v_gaps""")
def rank_in_roll(t: Tables) -> DataFrame:
    """Rank of each image in its roll, by time and path."""
    return grouped(t).select(*IMAGE_COLUMNS, "image_rank_in_roll")


@query("v_captures", """
SELECT season, site, roll, image_path_original, seconds_to_last_image_taken, seconds_to_next_image_taken,
  days_to_last_image_taken, days_to_next_image_taken FROM v_captures""")
def time_deltas(t: Tables) -> DataFrame:
    """Seconds and days to the previous and next image."""
    return grouped(t).select(*IMAGE_COLUMNS, "seconds_to_last_image_taken", "seconds_to_next_image_taken",
                             "days_to_last_image_taken", "days_to_next_image_taken")


CAPTURES_SQL = """
SELECT season, site, roll, image_path_original, capture_id, capture, image_rank_in_capture, image_rank_in_roll
FROM v_captures"""


@query("v_captures", CAPTURES_SQL)
def group_into_captures(t: Tables) -> DataFrame:
    """Capture number, rank in the capture and capture id."""
    return grouped(t).select(*IMAGE_COLUMNS, "capture_id", "capture", "image_rank_in_capture", "image_rank_in_roll")


@query("v_captures", CAPTURES_SQL)
def group_into_captures_sliced(t: Tables) -> DataFrame:
    """W1-W4 with a low limit, so that the larger rolls take the range-sliced way for hot groups."""
    return grouped(t, hot_group_rows=15).select(
        *IMAGE_COLUMNS, "capture_id", "capture", "image_rank_in_capture", "image_rank_in_roll")


@query("v_captures", """
SELECT image_path_original, image_name, '/img/EV/' || site || '/' || site || '_R' || roll || '/' || image_name AS image_path,
  'EV/' || site || '/' || site || '_R' || roll || '/' || image_name AS image_path_rel FROM v_captures""")
def new_image_names(t: Tables) -> DataFrame:
    """New names and paths."""
    return captures.add_image_names(grouped(t)).select("image_path_original", "image_name", "image_path", "image_path_rel")


@query("v_checked", """
SELECT image_path_original, image_check__time_lapse, image_check__time_too_new, image_check__time_too_old,
  image_check__captures_with_too_many_images FROM v_checked""")
def time_checks(t: Tables) -> DataFrame:
    """Time checks of every image."""
    return checked(t).select("image_path_original", *quality.check_columns(checked(t).columns))


@query("v_flagged", """
SELECT check_name AS "check", CAST(sum(failed) AS BIGINT) AS failed, count(*) AS total,
  round(100 * sum(failed) / count(*), 2) AS percent
FROM (UNPIVOT (SELECT image_check__time_lapse, image_check__time_too_new, image_check__time_too_old,
    image_check__captures_with_too_many_images, image_check__corrupt_file, image_check__all_black,
    image_check__empty_exif FROM v_flagged) ON COLUMNS(*) INTO NAME check_name VALUE failed)
GROUP BY check_name""")
def check_stats(t: Tables) -> DataFrame:
    """Failures of each check."""
    return quality.check_stats(flagged(t))


@query("v_inventory", """
SELECT season, site, roll, count(*) AS "count", CAST(sum(count(*)) OVER () AS BIGINT) AS total,
  round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percent
FROM v_inventory GROUP BY season, site, roll""")
def season_site_roll_stats(t: Tables) -> DataFrame:
    """Images of each season, site and roll."""
    return quality.group_shares(t.inventory, ["season", "site", "roll"])


@query("v_inventory", """
SELECT site, roll, strftime(datetime, '%Y-%m-%d') AS day, count(*) AS images FROM v_inventory GROUP BY 1, 2, 3""")
def site_roll_timeline(t: Tables) -> DataFrame:
    """Images per site, roll and day."""
    return quality.site_roll_timeline(t.inventory).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("v_inventory", """
SELECT strftime(datetime, '%Y-%m-%d') AS day, count(*) FILTER (roll = '1') AS "ALL#1", count(*) FILTER (roll = '2') AS "ALL#2",
  count(*) FILTER (roll = '3') AS "ALL#3", count(*) FILTER (roll = '4') AS "ALL#4", count(*) FILTER (roll = '5') AS "ALL#5"
FROM v_inventory GROUP BY 1""")
def site_roll_timeline_wide(t: Tables) -> DataFrame:
    """The same with one column per roll (all sites as one here)."""
    rolls = [f"ALL#{r}" for r in range(1, 6)]
    wide = quality.site_roll_timeline_wide(t.inventory.withColumn("site", F.lit("ALL")), rolls)
    return wide.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("v_flagged", """
SELECT season, site, roll, image_rank_in_roll, capture, image_rank_in_capture, image_name, '' AS action_site,
  '' AS action_roll, image_name AS action_from_image, image_name AS action_to_image,
  CASE WHEN image_check__corrupt_file = 1 THEN 'delete'
    WHEN image_check__all_black = 1 OR image_check__empty_exif = 1 THEN 'invalidate' ELSE 'inspect' END AS action_to_take,
  concat_ws('|', CASE WHEN image_check__time_lapse = 1 THEN 'time_lapse' END,
    CASE WHEN image_check__captures_with_too_many_images = 1 THEN 'captures_with_too_many_images' END,
    CASE WHEN image_check__corrupt_file = 1 THEN 'corrupt_file' END,
    CASE WHEN image_check__all_black = 1 THEN 'all_black' END,
    CASE WHEN image_check__empty_exif = 1 THEN 'empty_exif' END) AS action_to_take_reason,
  '' AS datetime_current, '' AS datetime_new
FROM v_flagged
WHERE image_check__time_lapse + image_check__captures_with_too_many_images + image_check__corrupt_file
    + image_check__all_black + image_check__empty_exif > 0
  AND NOT (image_is_invalid = '1' OR split_part(action_taken, '#', -1) = 'ok')""")
def propose_actions(t: Tables) -> DataFrame:
    """Action list of the images with unresolved failed checks."""
    columns = ["season", "site", "roll", "image_rank_in_roll", "capture", "image_rank_in_capture", "image_name",
               "action_site", "action_roll", "action_from_image", "action_to_image", "action_to_take",
               "action_to_take_reason", "datetime_current", "datetime_new"]
    return quality.propose_actions(flagged(t)).select(*columns)


REGROUPED = """
WITH kept AS (SELECT * FROM v_flagged WHERE image_was_deleted <> '1'),
deltas AS (
  SELECT image_name AS name, season, site, roll, datetime, row_number() OVER w AS rank_in_roll,
    coalesce(epoch(datetime) - epoch(lag(datetime) OVER w), 0.0) AS gap
  FROM kept WINDOW w AS (PARTITION BY season, site, roll ORDER BY datetime, image_name)),
numbered AS (
  SELECT *, CAST(1 + sum(CASE WHEN gap > 21600 THEN 1 ELSE 0 END) OVER (
    PARTITION BY season, site, roll ORDER BY rank_in_roll) AS INTEGER) AS new_capture FROM deltas)
SELECT name AS image_name, CAST(rank_in_roll AS INTEGER) AS image_rank_in_roll, new_capture AS capture,
  season || '#' || site || '#' || roll || '#' || new_capture AS capture_id,
  CAST(row_number() OVER (PARTITION BY season, site, roll, new_capture ORDER BY rank_in_roll) AS INTEGER)
    AS image_rank_in_capture
FROM numbered"""


@query("v_flagged", REGROUPED)
def regroup_after_actions(t: Tables) -> DataFrame:
    """Numbers without gaps after the deleted images are gone."""
    return captures.regroup_after_actions(flagged(t), max_gap=GAP).select(
        "image_name", "image_rank_in_roll", "capture", "capture_id", "image_rank_in_capture")


@query("v_flagged", REGROUPED)
def regroup_touched(t: Tables) -> DataFrame:
    """W9 of the rolls that an action touches; all others pass by."""
    rows = flagged(t)
    named = rows.where("event_type = 'signup'").select(F.col("image_name").alias("image"))
    return captures.regroup_touched(rows, named, max_gap=GAP).select(
        "image_name", "image_rank_in_roll", "capture", "capture_id", "image_rank_in_capture")


@query("v_flagged", """
SELECT image_name, image_path_original FROM v_flagged
WHERE image_was_deleted <> '1' AND image_is_invalid <> '1'""")
def remove_flagged_images(t: Tables) -> DataFrame:
    """images without a report flag; flag columns the table lacks are ignored."""
    from crowdspark.defaults import FLAGS_REMOVED_FROM_REPORT
    return captures.remove_flagged(flagged(t), FLAGS_REMOVED_FROM_REPORT).select("image_name", "image_path_original")


@query("v_captures", """
SELECT capture_id, any_value(season) AS season, any_value(site) AS site, any_value(roll) AS roll,
  CAST(any_value(capture) AS INTEGER) AS capture,
  strftime(min(datetime), '%Y-%m-%d') AS capture_date_local, strftime(min(datetime), '%H:%M:%S') AS capture_time_local
FROM v_captures GROUP BY capture_id""")
def season_captures(t: Tables) -> DataFrame:
    """Captures with the local date and time of their first image."""
    images = grouped(t).withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
    return captures.season_captures(images, ["image_rank_in_roll"])


@query("v_captures", """
SELECT season, site, roll, capture, coalesce(
    min_by(strftime(datetime, '%Y-%m-%d %H:%M:%S'), image_rank_in_roll) FILTER (value >= 30), '') AS datetime
FROM v_captures GROUP BY season, site, roll, capture""")
def capture_times(t: Tables) -> DataFrame:
    """The first known time of each capture, empty if none is known."""
    known = F.when(F.col("value") >= 30, F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")).otherwise("")
    return captures.capture_times(grouped(t).withColumn("datetime", known), ["image_rank_in_roll"])


@query("v_captures", """
SELECT image_path_original, row_number() OVER (ORDER BY season, site, roll, capture, image_rank_in_capture) AS position
FROM v_captures""")
def canonical_positions(t: Tables) -> DataFrame:
    """O1, O2: position of each image in the canonical order (season, site, roll, capture, rank)."""
    order = ["season", "site", "roll", "capture", "image_rank_in_capture"]
    return ordering.group_positions(grouped(t), [], order, hot_group_rows=2000).select("image_path_original", "position")


@query("v_captures", """
SELECT capture_id, coalesce(max(path) FILTER (image_rank_in_capture = 1), '') AS image1,
  coalesce(max(path) FILTER (image_rank_in_capture = 2), '') AS image2,
  coalesce(max(path) FILTER (image_rank_in_capture = 3), '') AS image3
FROM (SELECT *, image_path_original_rel AS path FROM v_captures) GROUP BY capture_id""")
def first_images_per_capture(t: Tables) -> DataFrame:
    """The paths of the first three images of each capture."""
    from crowdspark.operators.predictions import first_images
    return first_images(grouped(t), 3, ["image_rank_in_capture"], path="image_path_original_rel")


@query("v_inventory", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS local_date, strftime(ts, '%H:%M:%S') AS local_time,
  strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS zone_time,
  CAST(epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '2024-01-10 00:00:00') AS DOUBLE) AS seconds_since,
  strftime(date_trunc('second', ts) - INTERVAL 90 SECOND, '%Y-%m-%d %H:%M:%S') AS shifted
FROM events""")
def date_functions(t: Tables) -> DataFrame:
    """Parse times of three formats, convert to a zone, subtract and shift."""
    ts = F.col("ts")
    written = F.when(F.col("event_type") == "view", F.date_format(ts, "yyyy:MM:dd HH:mm:ss")).when(
        F.col("event_type") == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss'Z'")).otherwise(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    rows = t.read("events").withColumn("datetime", written)
    date, time = times.split_date_time(["datetime"])
    parsed = times.parse_datetime(F.col("datetime"))
    start = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    return rows.select(
        "event_id", date.alias("local_date"), time.alias("local_time"),
        F.date_format(times.utc_to_zone(parsed), "yyyy-MM-dd HH:mm:ss").alias("zone_time"),
        times.seconds_between(start, parsed).alias("seconds_since"),
        F.date_format(times.shift_seconds(parsed, F.lit(-90)), "yyyy-MM-dd HH:mm:ss").alias("shifted"))


@query("v_captures", """
SELECT capture_id, image_path_original, CASE WHEN starts_with(image_path_original_rel, 'EV/') THEN image_path_original_rel
  ELSE 'EV/' || image_path_original_rel END AS path FROM v_captures""")
def cleaned_season_paths(t: Tables) -> DataFrame:
    """Path and capture id of a cleaned season table that lacks them."""
    from crowdspark.sources.readers import complete_season
    rows = grouped(t).drop("capture_id").withColumn("image_path_rel", F.when(
        F.col("event_id") % 2 == 0, F.regexp_replace("image_path_original_rel", "^EV/", "")).otherwise(
        F.col("image_path_original_rel")))
    return complete_season(rows).select("capture_id", "image_path_original", "path")


@query("v_captures", """
SELECT capture_id, season, site, roll, CAST(capture AS INTEGER) AS capture, image_rank_in_capture, image_name,
  strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, event_type FROM v_captures""")
def project_cleaned(t: Tables) -> DataFrame:
    """K6: columns of the cleaned table, in order, without checks and tags."""
    from crowdspark.sources.writers import project_cleaned as project
    rows = checked(t).drop("event_id", "value", "props", "image_path_rel").withColumns({
        "datetime": F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"), "exif__EXIF:Make": F.lit("x")})
    return project(rows)
