"""Queries of the legacy, consolidation and training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.functions import hashing, text
from crowdspark.functions.answers import binary_answer
from crowdspark.operators import captures, consolidation, datasets, legacy, quality, subjects
from crowdspark.plans import tables
from crowdspark.plans.capture_queries import grouped
from crowdspark.plans.registry import query
from crowdspark.plans.sql_views import REQUIRES, VIEWS
from crowdspark.plans.tables import Tables
from crowdspark.sources import readers

ORDER = ("created_at", "line_no", "part_no", "price")
NAMES_SQL = """CASE WHEN k % 50 = 0 THEN 'tutorial' WHEN k % 3 = 0 THEN 'S' || (k % 9 + 1) ELSE CAST(k % 9 + 1 AS VARCHAR) END AS season,
  'B0' || (k % 5) AS site, CASE WHEN k % 2 = 0 THEN '1' ELSE 'r1' END AS roll,
  CASE WHEN k % 50 = 0 THEN 'SER_Stutorial' ELSE 'SER_S' || (k % 9 + 1) END AS season_id"""
IMAGE_SQL = "'PICT' || (({0}) // 10000) || 'X' || printf('%04d', ({0}) % 10000) || '.JPG'"
VIEWS["v_legacy"] = f"""
SELECT *, CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN first || ';' || second || ';' || first || ';' || second WHEN 3 THEN first
    WHEN 4 THEN second || ';' || first ELSE 'NONE0001.JPG' END AS filenames,
  CASE WHEN species IN ('', 'nothing') THEN '' WHEN q > 45 THEN '51+' WHEN q > 38 THEN '11-50' WHEN q > 36 THEN ''
    ELSE CAST(q % 9 + 1 AS VARCHAR) END AS "count"
FROM (SELECT l_orderkey AS k, l_orderkey || '-' || (l_suppkey % 5) AS classification_id, 'u' || (l_suppkey % 3) AS user_name,
    CAST(l_orderkey AS VARCHAR) AS subject_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created_at, l_linenumber,
    l_linenumber AS line_no, l_partkey AS part_no, l_extendedprice AS price, CAST(l_quantity AS INTEGER) AS q,
    {IMAGE_SQL.format("l_orderkey * 2")} AS first, {IMAGE_SQL.format("l_orderkey * 2 + 1")} AS second,
    CASE l_returnflag || l_linestatus WHEN 'NO' THEN '' WHEN 'NF' THEN 'nothing' WHEN 'AF' THEN 'zebra' ELSE 'lion' END AS species,
    CASE WHEN l_tax = 0 THEN '' WHEN l_tax >= 0.04 THEN '1' ELSE '0' END AS moving,
    CASE WHEN l_discount >= 0.05 THEN '1' ELSE '0' END AS eating, {NAMES_SQL.replace("k %", "l_orderkey %")} FROM lineitem)"""
VIEWS["v_legacy_resolved"] = f"""
SELECT l.*, CASE WHEN k % 4 = 0 THEN 'SER_S9#X#1#' || k WHEN filenames = '' OR l_linenumber = 2 OR l_linenumber > 4 OR o_custkey IS NULL
      OR season = 'tutorial' THEN '' ELSE season_id || '#' || site || '#1#' || o_custkey END AS capture_id,
  CASE WHEN season = 'tutorial' THEN 'not_eligible' WHEN k % 4 = 0 AND o_custkey IS NOT NULL THEN NULL
    WHEN filenames = '' THEN 'without_images' WHEN l_linenumber = 2 THEN 'too_many_images'
    WHEN l_linenumber > 4 OR o_custkey IS NULL THEN 'capture_not_found' END AS reject_reason
FROM v_legacy l LEFT JOIN orders ON o_orderkey = k"""
REQUIRES["v_legacy_resolved"] = ["v_legacy"]
VIEWS["v_legacy_kept"] = """
SELECT * REPLACE (CASE WHEN species IN ('', 'nothing') THEN 'blank' ELSE species END AS species),
  first_value(classification_id) OVER (PARTITION BY user_name, subject_id ORDER BY created_at, line_no, part_no, price) AS first_id
FROM v_legacy_resolved WHERE reject_reason IS NULL QUALIFY classification_id = first_id"""
REQUIRES["v_legacy_kept"] = ["v_legacy_resolved"]
VIEWS["v_training"] = """
SELECT *, 'S' || l_linenumber || '#A' || l_suppkey || '#1#' || (l_orderkey % 100) AS capture_id,
  'SER/S' || l_linenumber || '/A' || l_suppkey || '/A' || l_suppkey || '_R1/S' || l_linenumber || '_A' || l_suppkey || '_R1_'
    || CASE l_partkey % 3 WHEN 0 THEN 'PICT' WHEN 1 THEN 'IMG' ELSE 'IMAG' END || l_partkey || '.JPG' AS image,
  CASE WHEN l_returnflag = 'N' THEN 'empty' WHEN l_returnflag = 'A' THEN 'zebra' ELSE 'lion' END AS species,
  CASE WHEN l_returnflag = 'N' THEN 'empty' ELSE 'species' END AS empty,
  CASE WHEN l_returnflag = 'N' THEN '0' WHEN l_quantity > 40 THEN 'many' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS "count",
  CASE WHEN l_quantity = 1 THEN '1900-01-01-00-00-00' ELSE strftime(l_shipdate, '%Y-%m-%d-%H-%M-%S') END AS "timestamp",
  CASE WHEN l_tax >= 0.05 THEN 1 ELSE 0 END AS Standing, 'A' || l_suppkey AS location, 'S' || l_linenumber AS season,
  CAST('0x' || substr(md5('S' || l_linenumber || '#A' || l_suppkey || '#1#' || (l_orderkey % 100)), 1, 6) AS BIGINT) / 16777215.0
    AS unit, l_extendedprice AS price
FROM lineitem"""
VIEWS["v_splits"] = """
SELECT *, CASE WHEN unit <= 0.9 THEN 'train' WHEN unit <= 0.9::DOUBLE + 0.05::DOUBLE THEN 'val' ELSE 'test' END
  || '_' || lower(season) AS split_name FROM v_training"""
REQUIRES["v_splits"] = ["v_training"]


def resolved(t: Tables) -> DataFrame:
    images = legacy.image_captures(tables.legacy_images(t))
    return legacy.resolve_captures(tables.legacy_export(t), tables.legacy_subjects(t), images)


def training(t: Tables) -> DataFrame:
    return datasets.training_rows(tables.training_source(t), "S", {"51+": "many"}, ["Standing"])


# --- legacy export -------------------------------------------------------------------------------

@query("v_legacy_resolved", """
SELECT classification_id, price, capture_id, coalesce(reject_reason, '') AS reject_reason FROM v_legacy_resolved""")
def resolve_captures(t: Tables) -> DataFrame:
    """Capture of every annotation, by subject or by image names."""
    return resolved(t).select("classification_id", "price", "capture_id", F.coalesce("reject_reason", F.lit("")).alias("reject_reason"))


@query("v_legacy_resolved", """
SELECT coalesce(reject_reason, 'kept') AS reason, count(*) AS count FROM v_legacy_resolved GROUP BY 1""")
def legacy_reject_stats(t: Tables) -> DataFrame:
    """rows per reject reason."""
    return legacy.reject_stats(resolved(t))


@query("v_legacy_kept", "SELECT classification_id, user_name, subject_id, species, line_no, part_no, price FROM v_legacy_kept")
def legacy_first_classification(t: Tables) -> DataFrame:
    """All rows of the first classification of each user and subject."""
    rows = legacy.map_legacy_answers(resolved(t).where(F.col("reject_reason").isNull()))
    return legacy.first_classification_rows(rows, ORDER).select(
        "classification_id", "user_name", "subject_id", "species", "line_no", "part_no", "price")


@query("v_legacy_kept", """
SELECT classification_id, species, list_reduce(list("count" ORDER BY created_at, line_no, part_no, price), lambda a, b:
    CASE WHEN a = '11-50' OR b = '11-50' THEN '11-50' WHEN a = '51+' OR b = '51+' THEN '51+' WHEN a = '' OR b = '' THEN ''
      WHEN TRY_CAST(a AS INTEGER) + TRY_CAST(b AS INTEGER) > 10 THEN '11-50'
      ELSE CAST(TRY_CAST(a AS INTEGER) + TRY_CAST(b AS INTEGER) AS VARCHAR) END) AS "count",
  max(moving) AS moving, max(eating) AS eating, max(capture_id) AS capture_id,
  max_by(part_no, row(created_at, line_no, part_no, price)) AS part_no
FROM v_legacy_kept GROUP BY classification_id, species""")
def consolidate_annotations(t: Tables) -> DataFrame:
    """One row per classification and species, counts folded in order."""
    images = legacy.image_captures(tables.legacy_images(t))
    rows = legacy.extract_legacy_annotations(tables.legacy_export(t), tables.legacy_subjects(t), images, ORDER)
    return rows.select("classification_id", "species", "count", "moving", "eating", "capture_id", "part_no")


@query("v_legacy", """
SELECT question, answer, count(*) AS count, CAST(sum(count(*)) OVER (PARTITION BY question) AS BIGINT) AS total,
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY question), 2) AS percent
FROM (SELECT 'species' AS question, CASE WHEN species IN ('', 'nothing') THEN 'blank' ELSE species END AS answer FROM v_legacy
  UNION ALL SELECT 'count', "count" FROM v_legacy UNION ALL SELECT 'moving', moving FROM v_legacy
  UNION ALL SELECT 'season', season FROM v_legacy) GROUP BY question, answer""")
def legacy_answer_stats(t: Tables) -> DataFrame:
    """Answers and seasons of the legacy export."""
    rows = legacy.map_legacy_answers(tables.legacy_export(t))
    return legacy.legacy_answer_stats(rows, ["species", "count", "moving", "season"])


@query("v_legacy", """
SELECT subject_id, season, site, roll, coalesce(list_aggregate(list_transform(list_filter(string_split(filenames, ';'), lambda x: x <> ''),
    lambda x: season_code || '/' || site || '/' || site || '_R1/' || season_code || '_' || site || '_R1_' || x), 'string_agg', ';'), '')
    AS filenames, '' AS retired_at
FROM (SELECT *, CASE WHEN starts_with(lower(season), 's') THEN upper(season) ELSE 'S' || upper(season) END AS season_code FROM v_legacy)
QUALIFY row_number() OVER (PARTITION BY subject_id ORDER BY created_at DESC, line_no DESC, part_no DESC, price DESC) = 1""")
def subjects_from_annotations(t: Tables) -> DataFrame:
    """The last annotation of each subject with corrected file paths."""
    return subjects.subjects_from_annotations(
        tables.legacy_export(t), ORDER, ["season", "site", "roll", "filenames", "retired_at"])


# --- training data -------------------------------------------------------------------------------

@query("v_splits", """
SELECT capture_id, price, image, species, empty, "count", "timestamp", Standing, split_name FROM v_splits""")
def training_rows(t: Tables) -> DataFrame:
    """Database rows as training rows with their split."""
    return training(t).select("capture_id", "price", "image", "species", "empty", "count", "timestamp", "Standing", "split_name")


@query("v_splits", """
WITH images AS (
  SELECT capture_id, image, row_number() OVER (PARTITION BY capture_id ORDER BY min(row(l_shipdate, l_partkey, l_extendedprice, l_orderkey))) AS n
  FROM v_splits GROUP BY capture_id, image),
wide AS (SELECT capture_id, coalesce(max(image) FILTER (n = 1), '') AS image1, coalesce(max(image) FILTER (n = 2), '') AS image2,
  coalesce(max(image) FILTER (n = 3), '') AS image3 FROM images GROUP BY capture_id)
SELECT capture_id, species, "count", split_name, image1, image2, image3 FROM (
  SELECT * FROM v_splits QUALIFY row_number() OVER (PARTITION BY capture_id, species
    ORDER BY l_shipdate DESC, l_partkey DESC, l_extendedprice DESC, l_orderkey DESC) = 1) JOIN wide USING (capture_id)""")
def capture_records(t: Tables) -> DataFrame:
    """One record per capture and species with the first three images."""
    return datasets.capture_records(training(t), ["shipped", "part_no", "price", "l_orderkey"], ["count", "split_name"])


@query("v_splits", """
SELECT capture_id, price, 'A' || l_suppkey || '/' || image AS image, split_name FROM v_splits WHERE starts_with(split_name, 'test_')""")
def test_split_only(t: Tables) -> DataFrame:
    """rows of the test splits with their paths prefixed by the location."""
    rows = training(t).select("capture_id", "price", "image", "location", "season", "split_name")
    rows = rows.withColumns({"site": F.col("location"), "location": F.col("location"), "split_name": F.regexp_replace(
        "split_name", "^test_", "test_x_")}).withColumns({"season": F.lower("season"), "location": F.lit("x")})
    tested = datasets.test_split_only(rows)
    return tested.select("capture_id", "price", F.concat("site", F.substring("image", 2, 1000)).alias("image"),
                         F.replace("split_name", F.lit("_x_"), F.lit("_")).alias("split_name"))


@query("v_splits", """
SELECT capture_id, round(unit, 9) AS unit, sha1(capture_id) AS anonymized, CASE WHEN unit <= 0.5 THEN 'a' ELSE 'b' END AS half
FROM (SELECT DISTINCT capture_id, unit FROM v_splits)""")
def hash_functions(t: Tables) -> DataFrame:
    """Position in 0..1, split and anonymous id of every capture."""
    unit = hashing.hash_to_unit(F.col("capture_id"))
    return training(t).select("capture_id").distinct().select(
        "capture_id", F.round(unit, 9).alias("unit"), hashing.anonymous_id(F.col("capture_id")).alias("anonymized"),
        hashing.assign_split(unit, [0.5, 0.5], ["a", "b"]).alias("half"))


@query("", """
SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
  ORDER BY md5('123:' || o_orderkey), o_orderkey) AS n FROM orders) WHERE n <= 1500""")
def random_sample(t: Tables) -> DataFrame:
    """1500 rows of each stratum without replacement."""
    rows = t.read("orders").select("o_orderkey", "o_orderpriority")
    return datasets.random_sample(rows, 1500, "o_orderkey", ["o_orderpriority"])


@query("", "SELECT o_orderkey, row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey) AS position FROM orders")
def shuffled_positions(t: Tables) -> DataFrame:
    """Position of every row in the repeatable random order, through range slices."""
    from crowdspark.operators.ordering import group_positions
    rows = t.read("orders").select("o_orderkey", hashing.shuffle_key(7, F.col("o_orderkey")).alias("random"))
    return group_positions(rows, [], ["random", "o_orderkey"], hot_group_rows=5000).select("o_orderkey", "position")


@query("", """
SELECT o_orderkey FROM orders ORDER BY md5('123:' || o_orderkey), o_orderkey""")
def shuffle(t: Tables) -> DataFrame:
    """All rows in a repeatable random order."""
    return datasets.shuffle(t.read("orders").select("o_orderkey"), "o_orderkey")


@query("", """
SELECT doc_id, 'blank' AS source FROM labels WHERE quality = 0 UNION ALL SELECT doc_id, 'species' FROM labels WHERE quality = 1""")
def mix_sources(t: Tables) -> DataFrame:
    """Two tables under one another with a class flag."""
    rows = t.read("labels")
    return datasets.mix_sources({"blank": rows.where("quality = 0").select("doc_id"),
                                 "species": rows.where("quality = 1").select("doc_id")})


@query("", "SELECT p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS label_index FROM (SELECT DISTINCT p_type FROM part)")
def label_to_index(t: Tables) -> DataFrame:
    """Labels numbered alphabetically."""
    return datasets.label_to_index(t.read("part"), "p_type")


@query("v_annotations", """
SELECT subject_id, price, CASE question__species WHEN 'zebra' THEN 'equid' WHEN 'lion' THEN 'cat' ELSE question__species END AS species
FROM v_annotations""")
def standardize_species(t: Tables) -> DataFrame:
    """Species under their grouped names; the mapping is a table."""
    names = t.annotations.select(F.col("question__species").alias("species")).distinct().where("species IN ('zebra', 'lion')")
    mapping = names.select("species", F.when(F.col("species") == "zebra", "equid").otherwise("cat").alias("grouped"),
                           F.col("species").alias("standardized"))
    rows = t.annotations.select("subject_id", "price", F.col("question__species").alias("species"))
    return datasets.standardize_species(rows, mapping, "grouped")


@query("v_training", """
SELECT t.price, CAST(o_custkey AS VARCHAR) AS subject_id, t.image[5:] AS path
FROM v_training t JOIN orders ON o_orderkey = l_orderkey WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def blank_images(t: Tables) -> DataFrame:
    """Corrected paths of the images of blank subjects, through a link table."""
    rows = tables.training_source(t).select(F.col("l_orderkey").alias("capture_id"), "price", "path")
    links = t.read("orders").select(F.col("o_orderkey").alias("capture_id"), F.col("o_custkey").cast("string").alias("subject_id"))
    blanks = t.read("customer").where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("subject_id"))
    return datasets.blank_images(rows, links, blanks).select("price", "subject_id", "path")


@query("", "SELECT c_custkey AS o_custkey FROM customer WHERE c_acctbal < 0 INTERSECT SELECT o_custkey FROM orders")
def common_ids(t: Tables) -> DataFrame:
    """Ids of both tables."""
    blanks = t.read("customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return datasets.common_ids(blanks, t.read("orders"), "o_custkey")


@query("", """
SELECT doc_id, CAST(quality AS INTEGER) AS quality, CAST(floor(toxic * 0.7 + 0.5) AS INTEGER) AS toxic FROM labels""")
def binarize(t: Tables) -> DataFrame:
    """Shares as 0/1 answers."""
    return t.read("labels").select(
        "doc_id", binary_answer(F.col("quality").cast("string")).alias("quality"),
        binary_answer((F.col("toxic") * 0.7).cast("string")).alias("toxic"))


# --- consolidation of sources --------------------------------------------------------------------

VIEWS["v_db"] = """
SELECT 'S' || (o_orderkey % 10 + 1) AS season, 'A' || (o_orderkey % 7) AS site, '1' AS roll,
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS capture,
  'p' || o_orderkey || CASE WHEN o_orderkey % 9 = 0 THEN ' (2)' ELSE '' END AS image_path, CAST(o_orderkey % 5 AS VARCHAR) AS invalid,
  strftime(o_orderdate, '%Y-%m-%d') AS datetime, o_orderkey FROM orders"""
VIEWS["v_consolidated"] = """
WITH db AS (SELECT * FROM v_db WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0),
  clean AS (SELECT * FROM v_db WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0),
  labels AS (SELECT * FROM v_db WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0),
  merged AS (SELECT coalesce(d.image_path, c.image_path) AS image_path, coalesce(d.season, c.season) AS season,
      coalesce(d.site, c.site) AS site, coalesce(d.roll, c.roll) AS roll,
      coalesce(nullif(d.capture, ''), CASE WHEN c.image_path IS NOT NULL THEN 'c' || c.o_orderkey END) AS capture, d.invalid AS invalid,
      CASE WHEN d.image_path IS NOT NULL THEN '1' END AS in_db, CASE WHEN c.image_path IS NOT NULL THEN '1' END AS in_clean
    FROM db d FULL JOIN clean c ON d.image_path = c.image_path AND d.season = c.season AND d.site = c.site AND d.roll = c.roll)
SELECT replace(coalesce(m.image_path, l.image_path), ' (2)', '') AS image_path, coalesce(m.season, l.season) AS season,
  coalesce(m.site, l.site) AS site, coalesce(m.roll, '') AS roll, coalesce(m.capture, '') AS capture, coalesce(m.invalid, '') AS invalid,
  coalesce(in_db, '') AS in_db, coalesce(in_clean, '') AS in_clean, CASE WHEN l.image_path IS NULL THEN '' ELSE '1' END AS in_labels,
  coalesce(l.datetime, '') AS datetime
FROM merged m FULL JOIN labels l ON m.image_path = l.image_path AND m.season = l.season AND m.site = l.site"""
REQUIRES["v_consolidated"] = ["v_db"]


def consolidated(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    rows = t.read("orders").select(
        F.format_string("S%d", key % 10 + 1).alias("season"), F.format_string("A%d", key % 7).alias("site"), F.lit("1").alias("roll"),
        F.when(key % 4 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("capture"),
        F.concat(F.format_string("p%d", key), F.when(key % 9 == 0, " (2)").otherwise("")).alias("image_path"),
        (key % 5).cast("string").alias("invalid"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("datetime"), "o_orderkey")
    database = rows.where((key % 2 == 0) | (key % 3 == 0)).drop("o_orderkey", "datetime")
    cleaned = rows.where((key % 3 == 0) | (key % 5 == 0)).select(
        "season", "site", "roll", F.concat(F.lit("c"), key.cast("string")).alias("capture"), F.col("image_path").alias("PathFilename"))
    labels = rows.where((key % 5 == 0) | (key % 7 == 0)).select("season", "site", "image_path", "datetime")
    return consolidation.consolidate_sources(database, cleaned, labels)


@query("v_consolidated", "SELECT * FROM v_consolidated")
def consolidate_sources(t: Tables) -> DataFrame:
    """All images of three tables by two full outer joins."""
    return consolidated(t)


@query("v_consolidated", """
SELECT season, image_path AS image_path_rel, CASE WHEN season IN ('S1', 'S2') THEN capture ELSE '' END AS capture,
  CASE WHEN season IN ('S1', 'S2') THEN invalid ELSE in_clean END AS invalid FROM v_consolidated WHERE season IN ('S1', 'S2', 'S3')""")
def select_by_season(t: Tables) -> DataFrame:
    """P10: other source columns for other seasons."""
    common = {"season": "season", "image_path": "image_path_rel"}
    return consolidation.select_by_season(consolidated(t), [
        (["S1", "S2"], {**common, "capture": "capture", "invalid": "invalid"}), (["S3"], {**common, "in_clean": "invalid"})])


@query("v_consolidated", """
SELECT image_path, season, invalid, CASE WHEN invalid = '0' THEN '1' WHEN invalid IN ('1', '2', '3') THEN '0' ELSE '' END AS include,
  CASE WHEN invalid = '0' THEN '0' WHEN invalid IN ('1', '2', '3') THEN '1' ELSE '' END AS image_is_invalid,
  CASE WHEN invalid = '0' THEN '0' WHEN invalid IN ('1', '2', '3') THEN '1' ELSE '' END AS image_datetime_uncertain
FROM v_consolidated WHERE image_path NOT IN ('p10', 'p11') AND NOT (season IN ('S1', 'S2', 'S3') AND invalid = '')""")
def known_image_flags(t: Tables) -> DataFrame:
    """Known images with the flags of their code."""
    kept = consolidation.keep_known_images(consolidated(t), ["p10", "p11"], ["S1", "S2", "S3"], path="image_path")
    return consolidation.invalid_flags(kept).select(
        "image_path", "season", "invalid", "include", "image_is_invalid", "image_datetime_uncertain")


@query("v_consolidated", """
SELECT season, in_clean, in_db, in_labels, count(*) AS count FROM v_consolidated GROUP BY ALL""")
def flag_distribution(t: Tables) -> DataFrame:
    """Rows per combination of season and origin."""
    return quality.flag_distribution(consolidated(t), ["season", "in_clean", "in_db", "in_labels"])


@query("v_consolidated", """
SELECT season, count(*) AS count, CAST(sum(count(*)) OVER () AS BIGINT) AS total,
  round(100.0 * count(*) / sum(count(*)) OVER (), 3) AS percentage FROM v_consolidated GROUP BY season""")
def value_shares(t: Tables) -> DataFrame:
    """Rows per value of a column."""
    return quality.value_shares(consolidated(t), "season")


@query("v_db v_consolidated", """
SELECT d.image_path, d.season, CASE WHEN c.image_path IS NULL THEN 'missing' ELSE 'different datetime' END AS problem
FROM v_db d LEFT JOIN v_consolidated c ON d.image_path = c.image_path AND d.season = c.season
WHERE c.image_path IS NULL OR d.datetime <> c.datetime""")
def coverage_check(t: Tables) -> DataFrame:
    """Rows of a table that the result lacks or holds with another time."""
    key = F.col("o_orderkey")
    rows = t.read("orders").select(
        F.format_string("S%d", key % 10 + 1).alias("season"),
        F.concat(F.format_string("p%d", key), F.when(key % 9 == 0, " (2)").otherwise("")).alias("image_path"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("datetime"))
    return quality.coverage_check(rows, consolidated(t), ["image_path", "season"], ["datetime"])


@query("v_captures", """
SELECT site, roll, capture, count(*) AS count FROM v_captures GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(t: Tables) -> DataFrame:
    """Keys that occur more than once."""
    return quality.duplicate_keys(grouped(t), ["site", "roll", "capture"])


@query("v_subjects", """
WITH pairs AS (SELECT DISTINCT capture, CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'L' || o_orderkey END
  ELSE subject_id END AS subject_id FROM v_subjects)
SELECT 'S#' || capture AS capture_id, subject_id FROM pairs WHERE subject_id <> ''""")
def subject_to_capture(t: Tables) -> DataFrame:
    """Pairs of capture and subject, with the label set's subject where the own one is empty."""
    key = F.col("o_orderkey")
    rows = t.subject_export.select(
        key.cast("string").alias("capture"), F.when(key % 3 == 0, "").otherwise(F.col("subject_id")).alias("subject_id"),
        F.when(key % 2 == 0, "").otherwise(F.concat(F.lit("L"), key.cast("string"))).alias("subject_id_labels"))
    listed = rows.select(F.concat(F.lit("S#"), "capture").alias("capture_id"), "capture")
    return subjects.subject_to_capture(listed, rows, ["capture"])


@query("v_subjects", """
SELECT capture_id, count(DISTINCT subject_id) AS n_subjects FROM (
  SELECT site || '#' || roll AS capture_id, subject_id FROM v_subjects) GROUP BY 1 HAVING count(DISTINCT subject_id) > 1""")
def captures_with_several_subjects(t: Tables) -> DataFrame:
    """Captures that break the rule of one subject each."""
    rows = readers.parse_subjects(t.subject_export)
    pairs = rows.select(F.concat_ws("#", subjects.metadata_field("#site"), subjects.metadata_field("#roll")).alias("capture_id"),
                        "subject_id")
    return subjects.captures_with_several_subjects(pairs)


@query("", """
SELECT season, site, any_value(path) AS path FROM (SELECT 'A' AS season, CAST(o_custkey AS VARCHAR) AS site, '' AS path FROM orders
  WHERE o_orderstatus = 'F' UNION ALL SELECT 'B', '', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'O')
GROUP BY season, site, path""")
def union_seasons(t: Tables) -> DataFrame:
    """Union of tables with differing columns, different rows only."""
    rows = t.read("orders")
    a = rows.where("o_orderstatus = 'F'").select(F.lit("A").alias("season"), F.col("o_custkey").cast("string").alias("site"))
    b = rows.where("o_orderstatus = 'O'").select(F.lit("B").alias("season"), F.col("o_orderkey").cast("string").alias("path"))
    return consolidation.union_seasons([a, b]).distinct()


# --- readers that take tables --------------------------------------------------------------------

@query("", """
SELECT 'f' || o.o_orderkey AS image_path, CAST(o.o_custkey AS VARCHAR) AS subject_id, o.o_orderstatus AS season, 'x' AS site,
  '' AS datetime, s.species FROM orders o JOIN (SELECT o_custkey, string_agg(name, '#' ORDER BY name) AS species FROM (
    SELECT DISTINCT o_custkey, o_orderpriority[3:] AS name FROM orders) GROUP BY o_custkey) s USING (o_custkey)""")
def labelled_images(t: Tables) -> DataFrame:
    """Images with the labels of their sequence."""
    rows, key = t.read("orders"), F.col("o_orderkey").cast("string")
    categories = rows.select(F.col("o_orderpriority").alias("id"), F.substring("o_orderpriority", 3, 100).alias("name")).distinct()
    images = rows.select(key.alias("id"), F.concat(F.lit("f"), key).alias("file_name"), F.col("o_custkey").cast("string").alias("seq_id"),
                         F.col("o_orderstatus").alias("season"), F.lit("x").alias("location"), F.lit(None).cast("string").alias("datetime"))
    annotations = rows.select(key.alias("image_id"), F.col("o_orderpriority").alias("category_id"))
    return readers.labelled_images(categories, images, annotations)


@query("v_training", """
SELECT 'S' || l_linenumber AS season, 'A' || l_suppkey AS site, image[5:] AS image_path, price FROM v_training QUALIFY row_number() OVER (PARTITION BY image, l_partkey % 3
  ORDER BY l_shipdate, price, l_orderkey) = 1""")
def database_export(t: Tables) -> DataFrame:
    """The first row of each path, with its season and corrected path."""
    rows = tables.training_source(t).withColumnRenamed("path", "file")
    export = readers.database_export(rows, {"file": "PathFilename"}, ["season", "site", "PathFilename", "price"],
                                     ["shipped", "price", "l_orderkey"])
    return export.select("season", "site", "image_path", "price")


@query("v_inventory", """
SELECT event_id, 'S7' AS season, image_name_original AS "ImageName",
  'S7/' || site || '/' || site || '_R' || roll || '/S7_' || site || '_R' || roll || '_' || image_name_original AS "PathFilename",
  strftime(datetime, '%Y-%m-%d %H:%M:%S') AS oldtime FROM v_inventory""")
def season_rows(t: Tables) -> DataFrame:
    """Rows of a season file with corrected path and time."""
    rows = t.inventory.select("event_id", "site", "roll", F.col("image_path_original").alias("path"),
                              F.date_format("datetime", "yyyy:MM:dd HH:mm:ss").alias("oldtime"))
    return readers.season_rows(rows, F.lit("S7")).select("event_id", "season", "ImageName", "PathFilename", "oldtime")


@query("", """
SELECT CAST(o_orderkey AS VARCHAR) AS subject_id, CASE WHEN o_orderkey % 2 = 0 THEN 'l0' ELSE 's0' END AS url_0,
  CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 's1' END AS url_1, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 's2' END AS url_2 FROM orders""")
def subject_urls(t: Tables) -> DataFrame:
    """Up to three addresses per subject, of the wanted quality or the standard one."""
    standard = F.create_map(F.lit("standard"), F.array(*[F.lit(f"s{i}") for i in range(4)]))
    large = F.map_concat(standard, F.create_map(F.lit("large"), F.array(F.lit("l0"))))
    rows = t.read("orders").select(F.col("o_orderkey").cast("string").alias("subject_id"),
                                   F.when(F.col("o_orderkey") % 2 == 0, large).otherwise(standard).alias("location"))
    return readers.subject_urls(rows, "large")


@query("v_splits", """
SELECT DISTINCT 'SER_S' || l_linenumber AS season_id, 'R1' AS roll, 'S' || l_linenumber AS season_code,
  'S' || l_linenumber || '/A' || l_suppkey || '/x.JPG' AS path FROM v_splits""")
def legacy_codes(t: Tables) -> DataFrame:
    """Season and roll codes and the path with its season."""
    rows = tables.training_source(t).select("season", "site", "roll").distinct()
    code = text.season_code(F.col("season"))
    return rows.select(
        text.season_identifier(F.col("season"), "SER_S").alias("season_id"), text.roll_code(F.col("roll")).alias("roll"),
        code.alias("season_code"), text.season_path(F.concat_ws("/", "site", F.lit("x.JPG")), code).alias("path"))


@query("v_captures", """
SELECT capture_id, any_value(site) AS site FROM v_captures GROUP BY capture_id
ORDER BY any_value(season), any_value(site), any_value(roll), any_value(capture)""")
def sort_by_capture(t: Tables) -> DataFrame:
    """O1: captures in canonical order."""
    return captures.sort_by_capture(grouped(t).select("capture_id", "site").distinct())
