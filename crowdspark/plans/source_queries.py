"""Queries of the readers and writers: tables written in the survey's formats and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdspark.functions import text
from crowdspark.functions.times import epoch_seconds, file_time_local
from crowdspark.operators import classifications, manifests, predictions, quality
from crowdspark.plans import tables
from crowdspark.plans.capture_queries import grouped
from crowdspark.plans.registry import query
from crowdspark.plans.report_queries import manifest, metadata
from crowdspark.plans.tables import Tables
from crowdspark.session import shared_folder
from crowdspark.sources import readers, writers
from crowdspark.sources.json_entries import object_entries


def text_schema(rows: DataFrame) -> str:
    """The columns of a table as they stand in CSV: with a schema, its files are split over tasks."""
    return ", ".join(f"`{c}` string" for c in rows.columns)


@query("v_captures", """
SELECT capture_id, image_name_original, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, props,
  CAST(image_rank_in_capture AS VARCHAR) AS image_rank_in_capture FROM v_captures""")
def csv_round_trip(t: Tables) -> DataFrame:
    """CSV with quotes in its JSON column, written in order and read as text."""
    folder = shared_folder(t.spark, "captures")
    rows = grouped(t).select("props", "capture_id", "image_rank_in_capture", "image_name_original",
                             F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"))
    first = ["capture_id", "image_rank_in_capture"]
    writers.write_table(rows, folder, first)
    return readers.read_table(t.spark, folder, text_schema(rows.select(*writers.first_then_rest(rows.columns, first))))


#: How an export is written: its text is several times smaller, and a file is still of a size for one task.
EXPORT = {"compression": "gzip", "file_rows": 250_000}


@query("v_classifications", """
SELECT classification_id, user_id, created_at, season, CAST(live AS INTEGER) AS live, subject_ids FROM v_classifications""")
def classifications_round_trip(t: Tables) -> DataFrame:
    """S3: a classification export as compressed CSV, its JSON columns parsed after reading."""
    folder = shared_folder(t.spark, "classifications")
    writers.write_table(t.classifications.drop("price"), folder, **EXPORT)
    rows = readers.read_classifications(t.spark, folder, text_schema(t.classifications.drop("price")))
    return rows.select("classification_id", "user_id", "created_at",
                       classifications.subject_season(F.col("subject_data"), F.col("subject_ids")).alias("season"),
                       classifications.is_live(F.try_parse_json("metadata")).cast("int").alias("live"),
                       "subject_ids")


@query("v_subjects", """
SELECT subject_id, CAST(o_orderkey AS VARCHAR) AS o_orderkey, site, roll, 'https://img.example.org/' || o_orderkey || '_0.jpg' AS url
FROM v_subjects""")
def subjects_round_trip(t: Tables) -> DataFrame:
    """A subject export as CSV, its maps parsed after reading."""
    folder = shared_folder(t.spark, "subjects")
    writers.write_table(t.subject_export.drop("created_at"), folder)
    rows = readers.read_subjects(t.spark, folder, text_schema(t.subject_export.drop("created_at"))).withColumn("upload_metadata", F.col("metadata"))
    return rows.select("subject_id", "o_orderkey", *metadata("#site", "#roll"), F.try_element_at("locations", F.lit("0")).alias("url"))


@query("v_legacy", """
SELECT classification_id, subject_id, season, filenames, species, "count", '' AS young_present FROM v_legacy""")
def legacy_round_trip(t: Tables) -> DataFrame:
    """A legacy export as CSV with its own header, renamed on reading."""
    folder = shared_folder(t.spark, "legacy")
    names = {"young_present": "babies", "classification_id": "id", "retirement_reason": "retire_reason", "count": "species_count"}
    rows = tables.legacy_export(t).withColumnsRenamed(names)
    writers.write_table(rows, folder)
    return readers.read_legacy_classifications(t.spark, folder, schema=text_schema(rows)).select(
        "classification_id", "subject_id", "season", "filenames", "species", "count", "young_present")


@query("v_manifest", "SELECT *, 'somebody' AS attribution, 'CC0' AS license FROM v_manifest")
def manifest_round_trip(t: Tables) -> DataFrame:
    """A manifest as one JSON object per line."""
    folder = shared_folder(t.spark, "manifest")
    writers.write_manifest(manifest(t), folder)
    return readers.read_manifest(t.spark, folder, lines=True).select(
        "capture_id", *metadata("#site", "#roll", "#season", "#capture", "attribution", "license"),
        F.array_join("images", ";").alias("images"))


@query("v_manifest", """
SELECT capture_id, 'EV__batch_' || batch || '__all' AS batch, CAST(batch AS VARCHAR) AS number FROM (
  SELECT capture_id, CASE WHEN position <= round_even(total / 3, 0) THEN 1 WHEN position <= round_even(2 * total / 3, 0) THEN 2 ELSE 3 END
    AS batch FROM (SELECT capture_id, row_number() OVER (ORDER BY capture_id) AS position, count(*) OVER () AS total FROM v_manifest))""")
def manifest_batches_round_trip(t: Tables) -> DataFrame:
    """K4: one folder of manifest lines per batch."""
    folder = shared_folder(t.spark, "batches")
    writers.write_manifest_batches(manifests.batch_assign(manifest(t), ["capture_id"], n_batches=3), folder, "EV", "all")
    lines = t.spark.read.text(folder).withColumn("capture_id", F.map_keys(F.from_json("value", "map<string, string>"))[0])
    number = F.replace(text.manifest_file_part(F.concat("batch", F.lit(".json")), "batch"), F.lit("batch_"), F.lit(""))
    return lines.select("capture_id", "batch", number.alias("number"))


@query("v_flat", """
SELECT capture_id, s0 AS l0, s4 AS eating, CASE WHEN eats THEN '1' ELSE '0' END AS top_eating FROM v_flat""")
def predictions_round_trip(t: Tables) -> DataFrame:
    """Predictions as JSON lines."""
    folder = shared_folder(t.spark, "predictions")
    t.species_predictions.select(F.to_json(F.create_map("capture_id", "prediction")).alias("value")).write.text(folder)
    rows = readers.read_predictions(t.spark, folder, lines=True)
    flat = predictions.species_prediction_map()

    def value(key):
        return F.try_element_at("flat", F.lit(key))

    return rows.withColumn("flat", flat).select(
        "capture_id", value("machine_confidence_species_l0").alias("l0"), value("machine_confidence_eating").alias("eating"),
        value("machine_topprediction_eating").alias("top_eating"))


@query("v_inventory", """
SELECT site, roll AS season, image_name_original, CAST(row_number() OVER (PARTITION BY roll ORDER BY datetime, image_name_original) AS VARCHAR)
  AS position FROM v_inventory""")
def season_files_round_trip(t: Tables) -> DataFrame:
    """K2, K7: sorted files per season, read back by season."""
    from crowdspark.operators.ordering import group_positions
    folder = shared_folder(t.spark, "seasons")
    rows = t.inventory.select("site", F.col("roll").alias("season"), "datetime", "image_name_original")
    placed = group_positions(rows, ["season"], ["datetime", "image_name_original"], hot_group_rows=1500)
    writers.write_season_files(placed, folder, ["datetime", "image_name_original"])
    written = t.spark.read.options(header=True, escape='"').csv(folder)
    return written.select("site", F.col("season").cast("string").alias("season"), "image_name_original", "position")


@query("v_manifest v_order_captures", """
SELECT capture_id FROM v_manifest WHERE capture_id NOT IN (SELECT 'EV#U' || capture || '#1#1' FROM v_order_captures)""")
def tracker_round_trip(t: Tables) -> DataFrame:
    """Ids appended to a tracker in two runs, and what is still pending."""
    folder = shared_folder(t.spark, "tracker")
    done = t.order_captures.select(F.concat(F.lit("EV#U"), F.col("capture"), F.lit("#1#1")).alias("capture_id"),
                                   F.col("capture").alias("subject_id"))
    writers.append_tracker(done.where(F.col("subject_id") < "5"), folder)
    writers.append_tracker(done.where(F.col("subject_id") >= "5"), folder)
    return manifests.pending(manifest(t).select("capture_id"), readers.read_table(t.spark, folder), "capture_id")


@query("v_consensus", """
SELECT DISTINCT 'EV_S' || species_is_plurality_consensus AS season_id, question__species FROM v_consensus""")
def find_reports(t: Tables) -> DataFrame:
    """All reports below a folder in one read, the season id from the file name."""
    from crowdspark.operators.consensus import plurality_consensus
    folder = shared_folder(t.spark, "reports")
    rows = plurality_consensus(t.annotations, tables.ANNOTATION_ORDER).select("species_is_plurality_consensus", "question__species")
    for flag in (0, 1):
        rows.where(F.col("species_is_plurality_consensus") == flag).write.options(header=True).csv(f"{folder}/site/EV_S{flag}_report.csv")
    return readers.read_reports(t.spark, folder).select("season_id", "question__species").distinct()


@query("", """
SELECT event_id, CASE WHEN base < 30 AND event_id % 17 >= 13 AND event_id % 50 <> 0 THEN 1 ELSE 0 END AS image_check__all_black,
  CASE WHEN base > 200 AND event_id % 17 >= 13 AND event_id % 50 <> 0 THEN 1 ELSE 0 END AS image_check__all_white,
  CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS image_check__corrupt_file
FROM (SELECT event_id, least(CAST(floor(value * 2) AS INTEGER), 255) AS base FROM events)""")
def image_exposure(t: Tables) -> DataFrame:
    """Dark, bright and unreadable images; the pixels are made from the event values."""
    key, base = F.col("event_id"), F.least(F.floor(F.col("value") * 2).cast("int"), F.lit(255))
    filled = (key % 17).cast("int") * 3
    pixels = F.concat(F.repeat(F.lpad(F.hex(base.cast("bigint")), 2, "0"), filled), F.repeat(F.lit("80"), 48 - filled))
    broken = key % 50 == 0
    image = F.struct(
        key.cast("string").alias("origin"), F.when(broken, -1).otherwise(4).alias("height"), F.when(broken, -1).otherwise(4).alias("width"),
        F.when(broken, -1).otherwise(3).alias("nChannels"), F.lit(16).alias("mode"),
        F.when(broken, F.lit(b"")).otherwise(F.unhex(pixels)).alias("data"))
    checks = quality.image_exposure(t.read("events").select(image.alias("image")))
    return checks.withColumn("event_id", F.col("path").cast("bigint")).drop("path")


@query("v_order_captures", "SELECT DISTINCT capture_id, capture AS subject_id FROM v_order_captures")
def tracker_commits(t: Tables) -> DataFrame:
    """K5: batches of ids, one of them run twice and one interrupted, then compacted: each id once."""
    folder = shared_folder(t.spark, "commits")
    done = t.order_captures.select("capture_id", F.col("capture").alias("subject_id"))
    number = F.pmod(F.xxhash64("capture_id"), F.lit(3))
    for batch in (0, 1, 1, 2):
        writers.append_tracker(done.where(number == batch), folder, batch=f"run{batch}")
    # rows without a commit, as an interrupted run leaves them
    done.write.options(header=True).csv(f"{folder}/batch=broken")
    writers.compact_tracker(t.spark, folder, "all", files=2)
    return writers.read_tracker(t.spark, folder)


@query("v_inventory", "SELECT site, roll AS season, image_name_original FROM v_inventory WHERE roll IN ('1', '2', '3')")
def split_by_season_round_trip(t: Tables) -> DataFrame:
    """K2: one folder per season; reading some seasons opens theirs alone."""
    folder = shared_folder(t.spark, "split")
    writers.split_by_season(t.inventory.select("site", F.col("roll").alias("season"), "image_name_original"), folder)
    rows = t.spark.read.schema("site string, image_name_original string, season string").options(header=True, escape='"').csv(folder)
    return rows.where(F.col("season").isin("1", "2", "3")).select("site", "season", "image_name_original")


@query("", """
SELECT event_id, CASE event_type WHEN 'click' THEN 'touch' WHEN 'view' THEN 'look' WHEN 'error' THEN 'fault' ELSE event_type END AS kind
FROM events""")
def mapped_values(t: Tables) -> DataFrame:
    """A mapping with overriding entries, applied by a join."""
    names = readers.mapping_table(t.spark, {"click": "press", "view": "look"}, {"click": "touch", "error": "fault"})
    return t.read("events").select("event_id", "event_type").join(names, F.col("event_type") == F.col("key"), "left").select(
        "event_id", F.coalesce("value", "event_type").alias("kind"))


@query("", """
SELECT event_id, strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS local_time, strftime(ts, '%Y-%m-%d %H:%M:%S') AS utc FROM events""")
def file_times(t: Tables) -> DataFrame:
    """C11: file times as local wall-clock times of a zone, and in UTC."""
    # the same instant in every session time zone
    instant = F.timestamp_micros((epoch_seconds(F.col("ts").cast("timestamp_ntz")) * 1000000).cast("bigint"))
    return t.read("events").select("event_id", file_time_local(instant).alias("local_time"), file_time_local(instant, "").alias("utc"))


@query("v_classifications", """
SELECT classification_id, price, reason AS reject_reason FROM (
  SELECT *, CASE WHEN part = '8' THEN 'malformed' WHEN workflow_id <> '10' OR version < 310 THEN 'not_eligible_workflow'
    WHEN part = '7' THEN 'malformed' WHEN NOT live THEN 'project_is_not_live' WHEN seen THEN 'seen_before'
    WHEN part = '6' THEN 'malformed' END AS reason
  FROM (SELECT *, split_part(classification_id, '-', 5) AS part FROM v_classifications)) WHERE reason IS NOT NULL""")
def rejected_rows(t: Tables) -> DataFrame:
    """quarantine of rows with missing fields and with JSON that does not parse, and of those that fail a filter."""
    part = F.element_at(F.split("classification_id", "-"), 5)
    rows = t.classifications.withColumns({
        "user_name": F.when(part != "8", F.col("user_name")),
        "metadata": F.when(part == "7", F.lit('{"live_project":')).otherwise(F.col("metadata")),
        "annotations": F.when(part == "6", F.lit("[{]")).otherwise(F.col("annotations"))})
    return classifications.rejected_rows(rows, workflow_id="10", version_min="310").select("classification_id", "price", "reject_reason")


#: Entries of the longest array of a document; one task writes a document.
DOCUMENT_ROWS = 1_000_000


def write_document(parts: list[DataFrame | str], folder: str, document_rows: int = DOCUMENT_ROWS) -> None:
    """JSON documents of fixed pieces and of entries (``value``) with commas between them, one file each.

    There is one document, or as many as the longest part has ``document_rows``; entries are dealt by a hash.
    """
    entries = [p for p in parts if not isinstance(p, str)]
    n = max(1, *(-(-p.count() // document_rows) for p in entries))
    lines = None
    for i, part in enumerate(parts):
        if isinstance(part, str):
            rows = entries[0].sparkSession.range(n).select(
                F.col("id").alias("document"), F.lit(i).alias("part"), F.lit(0).alias("rank"), F.lit(part).alias("value"))
        else:
            dealt = part.select(F.pmod(F.xxhash64("value"), F.lit(n)).alias("document"), "value")
            rank = F.row_number().over(Window.partitionBy("document").orderBy("value"))
            rows = dealt.withColumn("rank", rank).select(
                "document", F.lit(i).alias("part"), "rank", F.concat(F.when(F.col("rank") == 1, "").otherwise(","), "value").alias("value"))
        lines = rows if lines is None else lines.unionByName(rows)
    lines.repartition(n, "document").sortWithinPartitions("document", "part", "rank").select("document", "value").write.partitionBy("document").text(folder)


@query("v_flat", """
SELECT capture_id, s0 AS l0, s4 AS eating, CASE WHEN eats THEN '1' ELSE '0' END AS top_eating FROM v_flat""")
def prediction_document(t: Tables) -> DataFrame:
    """Predictions as one JSON object, read in blocks by many tasks."""
    folder = shared_folder(t.spark, "document")
    entries = t.species_predictions.select(
        F.concat(F.to_json(F.array("capture_id")).substr(F.lit(2), F.length(F.to_json(F.array("capture_id"))) - 2), F.lit(": "),
                 F.to_json("prediction")).alias("value"))
    write_document(["{", entries, "}"], folder)
    rows = readers.keyed_json(object_entries(t.spark, folder, 1 << 16), "prediction", predictions.PREDICTION_STRUCT)
    rows = rows.withColumn("flat", predictions.species_prediction_map())

    def value(key):
        return F.try_element_at("flat", F.lit(key))

    return rows.select("capture_id", value("machine_confidence_species_l0").alias("l0"), value("machine_confidence_eating").alias("eating"),
                       value("machine_topprediction_eating").alias("top_eating"))


@query("", """
SELECT 'f' || o.o_orderkey AS image_path, CAST(o.o_custkey AS VARCHAR) AS subject_id, o.o_orderstatus AS season, 'x' AS site,
  '' AS datetime, s.species FROM orders o JOIN (SELECT o_custkey, string_agg(name, '#' ORDER BY name) AS species FROM (
    SELECT DISTINCT o_custkey, o_orderpriority[3:] AS name FROM orders) GROUP BY o_custkey) s USING (o_custkey)""")
def label_document(t: Tables) -> DataFrame:
    """A label file of three arrays in one object, read in blocks."""
    folder, rows = shared_folder(t.spark, "labels"), t.read("orders")
    key = F.col("o_orderkey").cast("string")
    categories = rows.select(F.col("o_orderpriority").alias("id"), F.substring("o_orderpriority", 3, 100).alias("name")).distinct()
    images = rows.select(key.alias("id"), F.concat(F.lit("f"), key).alias("file_name"), F.col("o_custkey").cast("string").alias("seq_id"),
                         F.col("o_orderstatus").alias("season"), F.lit("x").alias("location"))
    annotations = rows.select(key.alias("image_id"), F.col("o_orderpriority").alias("category_id"))
    parts = ['{"info": {"year": 2020}, "categories": [', categories, '], "images": [', images, '], "annotations": [', annotations, "]}"]
    write_document([p if isinstance(p, str) else p.select(F.to_json(F.struct("*")).alias("value")) for p in parts], folder)
    return readers.read_label_json(t.spark, folder, block_bytes=1 << 16)
