"""Queries of the action, structure, file and tag operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.functions import maps, text
from crowdspark.operators import actions, manifests, quality, structure
from crowdspark.plans.capture_queries import flagged
from crowdspark.plans.registry import query
from crowdspark.plans.sql_views import REQUIRES, VIEWS
from crowdspark.plans.tables import Tables
from crowdspark.session import shared_folder, stable
from crowdspark.sources.readers import inventory_from_paths, list_images

LIST_COLUMNS = ("action_no", *actions.TARGETS, "action_to_take", "action_to_take_reason", "datetime_current", "datetime_new")

VIEWS["v_actions"] = """
SELECT image_name AS image, 'timechange' AS action, 'clock' AS reason, 3600.0::DOUBLE AS shift_time_by_seconds,
  'a' || site AS action_no FROM v_flagged WHERE CAST(site[2:] AS INTEGER) % 10 = 3
UNION ALL SELECT image_name, 'invalidate', 'human', 0.0, 'b' || site FROM v_flagged
  WHERE CAST(site[2:] AS INTEGER) % 10 = 4 AND roll = '2'
UNION ALL SELECT image_name, 'delete', 'test', 0.0, 'c' || site FROM v_flagged
  WHERE CAST(site[2:] AS INTEGER) % 10 = 5 AND roll <= '2'
UNION ALL SELECT image_name, 'mark_datetime_uncertain', 'range', 0.0, 'e' FROM v_flagged WHERE site BETWEEN 'U30' AND 'U39'
UNION ALL SELECT image_name, 'mark_no_upload', 'bad', 0.0, 'd' || event_id FROM v_flagged WHERE event_type = 'error' AND value > 100
UNION ALL SELECT image_name, 'ok', 'fine', 0.0, 'd' || event_id FROM v_flagged WHERE event_type = 'signup' AND value < 5"""
REQUIRES["v_actions"] = ["v_flagged"]
VIEWS["v_files"] = """
SELECT doc_id, lang, '/root/DOC/' || lang || '/' || lang || CASE WHEN doc_id % 10 = 0 THEN '-' ELSE '_' END
  || CASE WHEN doc_id % 7 = 0 THEN 'r' ELSE 'R' END || replace(source, 'src', '') || '/IMG' || doc_id
  || CASE WHEN doc_id % 11 = 0 THEN '.png' ELSE '.JPG' END AS path, n_chars AS length, text FROM documents"""
# broken action list rows, taken from the event numbers
VIEWS["v_broken_list"] = """
SELECT event_id AS action_no, CASE WHEN value > 100 THEN 'U1' ELSE '' END AS action_site,
  CASE WHEN event_id % 3 = 0 THEN '1' ELSE '' END AS action_roll, CASE WHEN event_id % 5 = 0 THEN 'X' ELSE '' END AS action_from_image,
  CASE WHEN event_id % 7 = 0 THEN 'X' ELSE '' END AS action_to_image,
  CASE event_type WHEN 'click' THEN 'timechange' WHEN 'view' THEN 'delete' WHEN 'error' THEN 'destroy' WHEN 'signup' THEN 'ok'
    ELSE 'invalidate' END AS action_to_take,
  CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 13 = 0 THEN 'a#b' ELSE 'r' END AS action_to_take_reason,
  CASE event_id % 4 WHEN 0 THEN '2024-01-01 00:00:00' WHEN 1 THEN 'bad' ELSE '' END AS datetime_current,
  CASE WHEN event_id % 4 <= 1 THEN '2024-01-01 00:00:01' ELSE '' END AS datetime_new FROM events"""


def list_rows(df: DataFrame, **values) -> DataFrame:
    """Action list rows; columns that are not given are empty."""
    return df.select(*[values[c].alias(c) if c in values else F.lit("").alias(c) for c in LIST_COLUMNS])


def action_list(t: Tables, images: DataFrame) -> DataFrame:
    """An action list of all scopes, taken from the captures themselves."""
    number = F.substring("site", 2, 10).cast("int") % 10
    place, name, lit = F.struct("site", "roll", "image_rank_in_roll"), F.col("image_name"), F.lit
    sites = images.select("site").distinct()
    ends = images.where((number == 5) & (F.col("roll") <= "2")).groupBy("site").agg(
        F.min_by("image_name", place).alias("first"), F.max_by("image_name", place).alias("last"))
    wide = images.where(F.col("site").between("U30", "U39")).agg(
        F.min_by("image_name", place).alias("first"), F.max_by("image_name", place).alias("last")).where("first IS NOT NULL")
    parts = [
        list_rows(sites.where(number == 3), action_no=F.concat(lit("a"), "site"), action_site=F.col("site"),
                  action_to_take=lit("timechange"), action_to_take_reason=lit("clock"),
                  datetime_current=lit("2024-01-01 00:00:00"), datetime_new=lit("2024-01-01 01:00:00")),
        list_rows(sites.where(number == 4), action_no=F.concat(lit("b"), "site"), action_site=F.col("site"),
                  action_roll=lit("2"), action_to_take=lit("invalidate"), action_to_take_reason=lit("human")),
        list_rows(ends, action_no=F.concat(lit("c"), "site"), action_from_image=F.col("first"),
                  action_to_image=F.col("last"), action_to_take=lit("delete"), action_to_take_reason=lit("test")),
        list_rows(wide, action_no=lit("e"), action_from_image=F.col("first"), action_to_image=F.col("last"),
                  action_to_take=lit("mark_datetime_uncertain"), action_to_take_reason=lit("range")),
        list_rows(images.where((F.col("event_type") == "error") & (F.col("value") > 100)),
                  action_no=F.concat(lit("d"), F.col("event_id").cast("string")), action_from_image=name,
                  action_to_image=name, action_to_take=lit("mark_no_upload"), action_to_take_reason=lit("bad")),
        list_rows(images.where((F.col("event_type") == "signup") & (F.col("value") < 5)),
                  action_no=F.concat(lit("d"), F.col("event_id").cast("string")), action_from_image=name,
                  action_to_image=name, action_to_take=lit("ok"), action_to_take_reason=lit("fine")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def broken_list(t: Tables) -> DataFrame:
    number, lit = F.col("event_id"), F.lit
    return t.read("events").select(
        number.alias("action_no"), F.when(F.col("value") > 100, "U1").otherwise("").alias("action_site"),
        F.when(number % 3 == 0, "1").otherwise("").alias("action_roll"),
        F.when(number % 5 == 0, "X").otherwise("").alias("action_from_image"),
        F.when(number % 7 == 0, "X").otherwise("").alias("action_to_image"),
        F.when(F.col("event_type") == "click", "timechange").when(F.col("event_type") == "view", "delete")
        .when(F.col("event_type") == "error", "destroy").when(F.col("event_type") == "signup", "ok")
        .otherwise("invalidate").alias("action_to_take"),
        F.when(number % 11 == 0, "").when(number % 13 == 0, "a#b").otherwise("r").alias("action_to_take_reason"),
        F.when(number % 4 == 0, "2024-01-01 00:00:00").when(number % 4 == 1, "bad").otherwise("").alias("datetime_current"),
        F.when(number % 4 <= 1, "2024-01-01 00:00:01").otherwise("").alias("datetime_new"))


# --- actions -------------------------------------------------------------------------------------

@query("v_broken_list", """
SELECT action_no, problem FROM (SELECT *, unnest([
  CASE WHEN action_to_take = 'destroy' THEN 'action is not allowed' END,
  CASE WHEN action_to_take = 'timechange' AND (datetime_current = '' OR datetime_new = '')
    THEN 'timechange needs datetime_current and datetime_new' END,
  CASE WHEN action_to_take <> 'timechange' AND (datetime_current <> '' OR datetime_new <> '')
    THEN 'datetimes are only for timechange' END,
  CASE WHEN action_to_take_reason = '' THEN 'reason is missing' END,
  CASE WHEN contains(action_to_take_reason, '#') THEN 'reason must not contain #' END,
  CASE WHEN datetime_current = 'bad' THEN 'datetime format is wrong' END,
  CASE WHEN action_roll <> '' AND action_site = '' THEN 'roll needs a site' END,
  CASE WHEN action_roll = '' AND action_site = '' AND action_from_image = '' THEN 'no site, roll or image given' END,
  CASE WHEN action_from_image <> '' AND (action_roll <> '' OR action_site <> '') THEN 'image excludes site and roll' END,
  CASE WHEN (action_from_image = '') <> (action_to_image = '') THEN 'from and to image must both be given' END]) AS problem
  FROM v_broken_list) WHERE problem IS NOT NULL""")
def validate_actions(t: Tables) -> DataFrame:
    """G1: broken rules of every action list row."""
    return actions.validate_actions(broken_list(t))


@query("v_broken_list", """
SELECT action_no, CASE WHEN action_site <> '' AND action_roll <> '' THEN 'site_roll' WHEN action_site <> '' THEN 'site'
  WHEN action_from_image <> '' AND action_to_image <> action_from_image THEN 'image_range' ELSE 'single_image' END AS scope
FROM v_broken_list""")
def action_scope(t: Tables) -> DataFrame:
    """Scope of every action list row."""
    return broken_list(t).select("action_no", actions.action_scope().alias("scope"))


@query("v_actions", "SELECT * FROM v_actions")
def generate_actions(t: Tables) -> DataFrame:
    """The images of site, roll, range and single-image actions."""
    images = stable(flagged(t))
    return actions.generate_actions(action_list(t, images), images)


@query("v_flagged", """
SELECT action_no, problem FROM (
  SELECT 'r' || site AS action_no, CASE WHEN count(*) FILTER (roll = '3') = 0 OR count(*) FILTER (roll = '1') = 0
    THEN 'image of range is unknown' ELSE 'last image of range precedes the first' END AS problem
  FROM v_flagged GROUP BY site)""")
def range_problems(t: Tables) -> DataFrame:
    """Ranges that run backwards or name unknown images."""
    images = stable(flagged(t))
    place = F.col("image_rank_in_roll")
    ranges = images.groupBy("site").agg(
        F.min_by("image_name", F.when(F.col("roll") == "3", place)).alias("first"),
        F.max_by("image_name", F.when(F.col("roll") == "1", place)).alias("last"))
    listed = list_rows(ranges, action_no=F.concat(F.lit("r"), "site"), action_from_image=F.coalesce("first", F.lit("?")),
                       action_to_image=F.coalesce("last", F.lit("?")), action_to_take=F.lit("delete"))
    return actions.range_problems(listed, images)


@query("v_actions", """
SELECT image, action, n AS count, CAST(action = 'timechange' AS INTEGER) AS is_error
FROM (SELECT image, action, count(*) AS n FROM (SELECT image, action FROM v_actions UNION ALL
  SELECT image, 'timechange' FROM v_actions WHERE action = 'invalidate' UNION ALL
  SELECT image, 'timechange' FROM v_actions WHERE action = 'timechange') GROUP BY 1, 2) WHERE n > 1""")
def repeated_actions(t: Tables) -> DataFrame:
    """Images with the same action twice."""
    images = stable(flagged(t))
    generated = actions.generate_actions(action_list(t, images), images, check=False)
    extra = generated.where(F.col("action").isin("invalidate", "timechange")).withColumn("action", F.lit("timechange"))
    return actions.repeated_actions(generated.unionByName(extra)).withColumn("is_error", F.col("is_error").cast("int"))


@query("v_actions v_flagged", """
WITH per_image AS (
  SELECT image, sum(shift_time_by_seconds) AS shift, string_agg(action, '#' ORDER BY action_no, action) AS taken,
    string_agg(reason, '#' ORDER BY action_no, action) AS reasons, bool_or(action = 'delete') AS deleted,
    bool_or(action = 'invalidate') AS invalid, bool_or(action IN ('delete', 'invalidate', 'mark_no_upload')) AS no_upload,
    bool_or(action = 'mark_datetime_uncertain') AS uncertain FROM v_actions GROUP BY image)
SELECT image_name, strftime(datetime + to_seconds(coalesce(shift, 0)), '%Y-%m-%d %H:%M:%S') AS datetime,
  concat_ws('#', nullif(action_taken, ''), taken) AS action_taken, coalesce(reasons, '') AS action_taken_reason,
  CASE WHEN deleted THEN '1' ELSE image_was_deleted END AS image_was_deleted,
  CASE WHEN invalid THEN '1' ELSE image_is_invalid END AS image_is_invalid,
  CASE WHEN no_upload THEN '1' ELSE image_no_upload END AS image_no_upload,
  CASE WHEN uncertain THEN '1' ELSE '' END AS image_datetime_uncertain
FROM v_flagged LEFT JOIN per_image ON image = image_name""")
def apply_actions(t: Tables) -> DataFrame:
    """Times shifted, flags set, actions and reasons appended."""
    images = stable(flagged(t))
    done = actions.apply_actions(images, actions.generate_actions(action_list(t, images), images))
    return done.select("image_name", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"), "action_taken",
                       "action_taken_reason", "image_was_deleted", "image_is_invalid", "image_no_upload",
                       "image_datetime_uncertain")


@query("v_actions v_flagged", """
SELECT image, action FROM v_actions WHERE image NOT IN (SELECT image_name FROM v_flagged WHERE event_type <> 'view')""")
def unknown_images(t: Tables) -> DataFrame:
    """Actions for images the captures lack."""
    images = stable(flagged(t))
    generated = actions.generate_actions(action_list(t, images), images, check=False)
    return actions.unknown_images(generated, images.where(F.col("event_type") != "view")).select("image", "action")


# --- files ---------------------------------------------------------------------------------------

@query("v_files", DUPLICATES_SQL := """
SELECT path, first_path, length FROM (
  SELECT path, length, doc_id, first_value(path) OVER (PARTITION BY text ORDER BY doc_id) AS first_path FROM v_files)
WHERE path <> first_path""")
def duplicate_files(t: Tables) -> DataFrame:
    """Files and the first file of equal content, by size, start and whole content."""
    return quality.duplicate_files(t.documents_as_files, ["doc_id"])


@query("v_files", """
WITH search AS (SELECT * FROM v_files WHERE doc_id % 3 <> 0), sizes AS (
  SELECT length, count(*) AS n, min(path) AS only_path FROM search GROUP BY length)
SELECT f.path AS path_search, coalesce(CASE WHEN n = 1 THEN only_path ELSE (
    SELECT min(path) FROM search s WHERE s.length = f.length AND s.text = f.text) END, '') AS path_found
FROM v_files f LEFT JOIN sizes USING (length) WHERE doc_id % 3 = 0""")
def match_files(t: Tables) -> DataFrame:
    """Files matched by size, and by content where several share the size."""
    files = t.documents_as_files
    matched = quality.match_files(files.where(F.col("doc_id") % 3 == 0), files.where(F.col("doc_id") % 3 != 0))
    return matched.select("path_search", F.coalesce("path_found", F.lit("")).alias("path_found"))


def on_disk(t: Tables) -> DataFrame:
    """``documents_as_files`` as files below a new folder: ``path, length`` of the listing and the path in the table.

    A folder holds a thousand numbers, so that many tasks can list them.
    """
    folder = shared_folder(t.spark, "files")
    root = folder.removeprefix("file:")

    def write(batches):
        from pyarrow.fs import FileSystem
        made = set()
        for batch in batches:
            system, name = FileSystem.from_uri(root)
            for number, content in zip(batch.column("doc_id").to_pylist(), batch.column("content").to_pylist()):
                part = f"{name}/{number // 1000:09}"
                if part not in made:
                    system.create_dir(part)
                    made.add(part)
                with system.open_output_stream(f"{part}/{number:012}.jpg") as out:
                    out.write(content)
            yield batch.select(["doc_id", "path"])

    names = stable(t.documents_as_files.select("doc_id", "path", "content").mapInArrow(write, "doc_id bigint, path string"))
    listed = list_images(t.spark, folder).select("path", F.col("length").alias("bytes"))
    number = F.regexp_extract("path", r"([0-9]+)\.jpg$", 1).cast("bigint")
    return listed.withColumn("doc_id", number).join(names.withColumnRenamed("path", "name"), "doc_id").withColumnRenamed("bytes", "length")


@query("v_files", f"SELECT path, first_path FROM ({DUPLICATES_SQL})")
def duplicate_files_by_path(t: Tables) -> DataFrame:
    """D5 over files: sizes from the listing, then starts and whole contents of those that may be equal."""
    files = on_disk(t)
    found = quality.duplicate_files(files.select("path", "length", "doc_id"), ["doc_id"])
    names = files.select("path", "name")
    return found.join(names, "path").select(F.col("name").alias("_name"), "first_path").join(
        names.withColumnsRenamed({"path": "first_path", "name": "_first"}), "first_path").select(
        F.col("_name").alias("path"), F.col("_first").alias("first_path"))


@query("v_files", """
SELECT f.path, (SELECT min(s.doc_id) FROM v_files s WHERE s.text = f.text AND s.doc_id % 3 <> 0) AS found
FROM v_files f WHERE f.doc_id % 3 = 0""")
def match_files_by_path(t: Tables) -> DataFrame:
    """J11 over files, every match verified by content; of equal files the first by name."""
    files = on_disk(t)
    number = F.regexp_extract("path_found", r"([0-9]+)\.jpg$", 1).cast("bigint")
    # names in the order of their numbers
    matched = quality.match_files(files.where("doc_id % 3 = 0").select("path", "length"),
                                  files.where("doc_id % 3 <> 0").select("path", "length"), verify_single=True)
    return matched.join(files.select(F.col("path").alias("path_search"), "name"), "path_search").select(
        F.col("name").alias("path"), number.alias("found"))


@query("", "SELECT doc_id, strlen(text) AS length FROM documents WHERE text IS NOT NULL")
def listed_images(t: Tables) -> DataFrame:
    """Name and size of all images below a folder."""
    return on_disk(t).select("doc_id", "length")


@query("v_files", """
SELECT path, unnest(list_filter([
  CASE WHEN NOT regexp_full_match(split_part(path, '/', -2), '[a-zA-Z0-9]+_R[0-9]+') THEN 'roll folder must be <site>_R<number>'
    WHEN ends_with(path, '.png') THEN 'file must end in .jpg' END], lambda x: x IS NOT NULL)) AS problem FROM v_files""")
def structure_report(t: Tables) -> DataFrame:
    """Problems of folder and file names."""
    return structure.structure_report(t.documents_as_files)


@query("v_files", """
SELECT path, CAST(regexp_full_match(name, '[a-zA-Z0-9]+') AS INTEGER) AS site_ok,
  CAST(regexp_full_match(name, 'R[0-9]+') AS INTEGER) AS roll_ok,
  CAST(regexp_full_match(name, '[a-zA-Z0-9]+_R[0-9]+') AS INTEGER) AS folder_ok
FROM (SELECT path, CASE doc_id % 3 WHEN 0 THEN lang || (doc_id % 4) WHEN 1 THEN split_part(split_part(path, '/', -2), '_', 2)
  ELSE split_part(path, '/', -2) END AS name FROM v_files)""")
def name_checks(t: Tables) -> DataFrame:
    """Site, roll and folder names."""
    folder = F.element_at(F.split("path", "/"), -2)
    site = F.concat(F.element_at(F.split("path", "/"), -3), (F.col("doc_id") % 4).cast("string"))
    roll = F.coalesce(F.get(F.split(folder, "_"), F.lit(1)), F.lit(""))
    name = F.when(F.col("doc_id") % 3 == 0, site).when(F.col("doc_id") % 3 == 1, roll).otherwise(folder)
    rows = t.documents_as_files.withColumn("name", name)
    return rows.select("path", text.valid_site_code(F.col("name")).cast("int").alias("site_ok"),
                       text.valid_roll_code(F.col("name")).cast("int").alias("roll_ok"),
                       text.valid_roll_folder(F.col("name")).cast("int").alias("folder_ok"))


@query("v_files", """
SELECT 'DOC' AS season, lang AS site, split_part(split_part(split_part(path, '/', -2), '_', 2), 'R', 2) AS roll,
  split_part(path, '/', -1) AS image_name_original, path AS image_path_original,
  substr(path, 7) AS image_path_original_rel
FROM v_files WHERE doc_id % 10 <> 0 AND doc_id % 7 <> 0""")
def inventory_from_files(t: Tables) -> DataFrame:
    """Inventory rows from the paths of well-named folders."""
    good = text.valid_roll_folder(F.element_at(F.split("path", "/"), -2))
    return inventory_from_paths(t.documents_as_files.where(good))


@query("v_files", """
SELECT path AS source, lang || '/' || md5(path)[1:2] AS target,
  CAST(count(*) OVER (PARTITION BY lang || '/' || md5(path)[1:2]) > 1 AS INTEGER) AS target_is_repeated,
  CAST(lang || '/' || md5(path)[1:2] IN (SELECT lang || '/' || md5(path)[2:3] FROM v_files) AS INTEGER) AS target_exists
FROM v_files""")
def rename_plan(t: Tables) -> DataFrame:
    """Sources and destinations with their conflicts."""
    files = t.documents_as_files
    lang = F.element_at(F.split("path", "/"), -3)
    inventory = files.select(F.col("path").alias("image_path_original"),
                             F.concat(lang, F.lit("/"), F.substring(F.md5("path"), 1, 2)).alias("image_path"))
    existing = files.select(F.concat(lang, F.lit("/"), F.substring(F.md5("path"), 2, 2)).alias("path"))
    plan = structure.rename_plan(inventory, existing)
    return plan.withColumns({c: F.col(c).cast("int") for c in ("target_is_repeated", "target_exists")})


@query("v_files", """
SELECT path, CASE WHEN doc_id % 4 = 0 THEN 'missing' ELSE 'found' END AS state FROM v_files""")
def images_on_disk(t: Tables) -> DataFrame:
    """images whose file exists, and those whose file is missing."""
    files = t.documents_as_files
    listing = files.where(F.col("doc_id") % 4 != 0)
    found = manifests.images_on_disk(files.select("path"), listing).withColumn("state", F.lit("found"))
    return found.unionByName(manifests.images_missing(files.select("path"), listing).withColumn("state", F.lit("missing")))


# --- tags ----------------------------------------------------------------------------------------

@query("", """
SELECT event_id, CASE WHEN value > 200 OR value < 1 THEN '' ELSE 'exif__Composite:Size,exif__EXIF:DateTimeOriginal,exif__EXIF:Make'
    END AS tags,
  CASE WHEN value > 200 OR value < 1 OR event_type = 'error' THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS datetime_exif,
  CAST(value > 200 AS INTEGER) AS image_check__corrupt_exif, CAST(value < 1 AS INTEGER) AS image_check__empty_exif,
  CASE WHEN NOT (value > 200 OR value < 1 OR event_type = 'error') THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    WHEN event_type = 'view' THEN '' ELSE strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') END AS datetime FROM events""")
def exif_tags(t: Tables) -> DataFrame:
    """Tags of the wanted groups, their time, and checks of missing tags."""
    taken = F.when(F.col("event_type") == "error", "unknown").otherwise(F.date_format("ts", "yyyy:MM:dd HH:mm:ss"))
    tags = F.create_map(
        F.lit("EXIF:Make"), F.col("event_type"), F.lit("EXIF:DateTimeOriginal"), taken, F.lit("File:Size"), F.lit("1"),
        F.lit("Composite:Size"), F.col("value").cast("string"), F.lit("MakerNotes:PreviewImage"), F.lit("binary"))
    rows = t.read("events").withColumn("tags", F.when(F.col("value") < 1, F.create_map().cast("map<string,string>")).when(
        F.col("value") <= 200, tags))
    rows = quality.init_checks(rows, ["corrupt_exif", "empty_exif"]).withColumns(maps.tag_checks(F.col("tags")))
    created = F.when(F.col("event_type") == "view", "").otherwise(
        F.date_format(F.col("ts") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss"))
    exif = F.coalesce(F.date_format(maps.exif_datetime(F.col("tags")), "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    names = F.coalesce(F.array_join(F.array_sort(F.map_keys(maps.select_tags(F.col("tags")))), ","), F.lit(""))
    return rows.select("event_id", names.alias("tags"), exif.alias("datetime_exif"), "image_check__corrupt_exif",
                       "image_check__empty_exif", maps.best_datetime(exif, created).alias("datetime"))
