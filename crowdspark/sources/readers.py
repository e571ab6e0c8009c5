"""Readers of the survey files. Text columns stay text; the empty field is the only missing value."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType, LocalFileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdspark.defaults import LEGACY_HEADER
from crowdspark.functions import text
from crowdspark.functions.times import parse_datetime
from crowdspark.operators.ordering import first_n_per_group
from crowdspark.operators.predictions import PREDICTION_STRUCT
from crowdspark.session import stable
from crowdspark.sources.contents import TASKS_PER_CORE
from crowdspark.sources.json_entries import array_entries, object_entries

IMAGE_EXTENSIONS = ("jpg", "jpeg", "bmp", "png", "ppm")
MANIFEST_STRUCT = "struct<upload_metadata: map<string,string>, info: map<string,string>, images: variant>"


def read_table(spark: SparkSession, path: str | Sequence[str], schema: str | None = None,
               multi_line: bool | None = None) -> DataFrame:
    """CSV with header, quotes doubled inside quotes, all columns text, missing fields empty.

    Give ``schema`` for large inputs: without it Spark reads the header of the first file. With a schema, files
    are split over tasks, so a field must not hold a line break; ``multi_line=True`` reads such files, each in
    one task, as is done without a schema.
    """
    multi_line = schema is None if multi_line is None else multi_line
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line, inferSchema=False)
    reader = reader.schema(schema) if schema else reader
    return reader.csv(path if isinstance(path, str) else list(path)).na.fill("")


def complete_season(df: DataFrame) -> DataFrame:
    """Add ``path`` and ``capture_id`` to a cleaned season table that lacks them."""
    if "path" not in df.columns and "image_path_rel" in df.columns:
        df = df.withColumn("path", text.season_path(F.col("image_path_rel"), F.col("season")))
    return df if "capture_id" in df.columns else df.withColumn("capture_id", text.capture_id())


def read_cleaned_season(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Cleaned season table in canonical order."""
    from crowdspark.operators.captures import sort_images
    return sort_images(complete_season(read_table(spark, path, schema)))


def read_classifications(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Classification export; its JSON columns stay text until they are needed."""
    return read_table(spark, path, schema)


def parse_subjects(df: DataFrame) -> DataFrame:
    """Subject export with parsed ``locations`` and ``metadata``; ``created_at`` is optional."""
    created = F.col("created_at") if "created_at" in df.columns else F.lit("")
    return df.withColumns({
        "locations": F.from_json("locations", "map<string,string>"),
        "metadata": F.from_json("metadata", "map<string,string>"),
        "created_at": created,
    })


def read_subjects(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return parse_subjects(read_table(spark, path, schema))


def read_legacy_classifications(spark: SparkSession, path: str, header: Mapping[str, str] = LEGACY_HEADER,
                                schema: str | None = None) -> DataFrame:
    """Flat legacy export with its columns renamed; ``schema`` has the names of the export."""
    return read_table(spark, path, schema).withColumnsRenamed(dict(header))


def keyed_json(df: DataFrame, value: str, value_type: str) -> DataFrame:
    """Rows of a JSON object ``{capture_id: value}``, one input row per object; objects that do not parse have none."""
    entries = F.from_json(F.col("value"), f"map<string, {value_type}>")
    return df.select(F.explode(entries).alias("capture_id", value))


def read_objects(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """JSON objects as text in ``value``: one per line, or one for each entry of the one object that a file holds.

    Either way files are split over tasks.
    """
    return spark.read.text(path) if lines else object_entries(spark, path)


def read_predictions(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Predictions, from one JSON object per file or from one object per line."""
    return keyed_json(read_objects(spark, path, lines), "prediction", PREDICTION_STRUCT)


def manifest_images(images: Column) -> Column:
    """Images of a manifest record, given as a list or as ``{original_images: [...]}``."""
    return F.coalesce(F.try_variant_get(images, "$.original_images", "array<string>"),
                      F.try_variant_get(images, "$", "array<string>"))


def read_manifest(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Manifest, from one JSON object per file or from one object per line."""
    records = keyed_json(read_objects(spark, path, lines), "record", MANIFEST_STRUCT)
    return records.select("capture_id", "record.upload_metadata", "record.info",
                          manifest_images(F.col("record.images")).alias("images"))


#: Rows of a listing that a task holds at once.
LISTED_ROWS = 10_000


def list_images(spark: SparkSession, directory: str, extensions: Sequence[str] = IMAGE_EXTENSIONS) -> DataFrame:
    """Path, size and modification time of all images below a directory; contents are not read.

    Folders are listed by tasks, a level at a time, so the driver sees how many there are and no names. Spark's own reader,
    whose driver holds all names and makes a task of every few files, serves patterns and systems that ``pyarrow.fs`` lacks;
    it leaves out files without bytes.
    """
    pattern = rf"(?i)\.({'|'.join(extensions)})$"
    files = _listing(spark, directory)
    if files is None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory)
        files = files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "length", "modificationTime")
    return files.where(F.col("path").rlike(pattern))


def _listing(spark: SparkSession, directory: str) -> DataFrame | None:
    """All files below a directory, by ``pyarrow.fs``; None if it cannot tell which system a path means."""
    sc = spark.sparkContext
    local = directory.startswith("file:") or "://" not in directory and sc.master.startswith("local")
    if any(c in directory for c in "*?[{") or not local and "://" not in directory:
        return None
    root, prefix = (os.path.abspath(re.sub("^file:/+", "/", directory)), "") if local else (directory.rstrip("/"), "")
    if not local:
        try:
            # names come back without the scheme, and some without the host, of the directory
            name = FileSystem.from_uri(root)[1]
        except (pa.ArrowException, OSError):
            return None
        if not root.endswith(name):
            return None
        prefix = root.removesuffix(name)

    def is_hidden(name: str) -> bool:
        """Names that Spark's readers pass over."""
        return name.startswith(".") or name.startswith("_") and "=" not in name

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for folder in (f for batch in batches for f in batch.column("path").to_pylist()):
            system, name = (LocalFileSystem(), folder) if local else FileSystem.from_uri(folder)
            found = [i for i in system.get_file_info(FileSelector(name)) if not is_hidden(i.base_name)]
            for start in range(0, len(found), LISTED_ROWS):
                part = found[start:start + LISTED_ROWS]
                yield pa.RecordBatch.from_pydict({
                    "path": [prefix + i.path for i in part],
                    "length": pa.array([None if i.type == FileType.Directory else i.size for i in part], pa.int64()),
                    "millis": pa.array([None if i.mtime_ns is None else i.mtime_ns // 1_000_000 for i in part], pa.int64())})

    folders, n, levels = spark.createDataFrame([(root,)], "path string"), 1, []
    while n:
        dealt = folders.repartition(min(n, sc.defaultParallelism * TASKS_PER_CORE))
        levels.append(stable(dealt.mapInArrow(children, "path string, length bigint, millis bigint")))
        folders = levels[-1].where("length is null").select("path")
        n = folders.count()
    rows = reduce(DataFrame.unionByName, levels).where("length is not null")
    return rows.select("path", "length", F.timestamp_millis("millis").alias("modificationTime"))


def inventory_from_paths(files: DataFrame, season: str | None = None, path: str = "path") -> DataFrame:
    """Inventory rows from paths ``.../<root>/<site>/<site>_R<roll>/<file>``; the season defaults to the root's name."""
    parts = F.split(F.col(path), "/")
    root, site, folder, name = (F.element_at(parts, i) for i in (-4, -3, -2, -1))
    return files.select(
        (F.lit(season) if season else root).alias("season"), site.alias("site"),
        F.element_at(F.split(F.element_at(F.split(folder, "_"), 2), "R"), 2).alias("roll"),
        name.alias("image_name_original"), F.col(path).alias("image_path_original"),
        F.concat_ws("/", root, site, folder, name).alias("image_path_original_rel"),
    )


def labelled_images(categories: DataFrame, images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Image rows with the sorted labels of their sequence, joined by ``#``.

    ``categories(id, name)``, ``images(id, file_name, seq_id, season, location, datetime)``,
    ``annotations(image_id, category_id)``. The labels of a sequence come from a closed list. Images and annotations are
    never broadcast: tables read in blocks look as small as their list of blocks.
    """
    labels = (
        annotations.join(images.select(F.col("id").alias("image_id"), "seq_id").hint("merge"), "image_id")
        .join(F.broadcast(categories.select(F.col("id").alias("category_id"), "name")), "category_id")
        .select("seq_id", "name").distinct()
        .groupBy("seq_id").agg(F.array_join(F.array_sort(F.collect_list("name")), "#").alias("species"))
    )
    return images.join(labels.hint("merge"), "seq_id", "left").select(
        F.col("file_name").alias("image_path"), F.col("seq_id").alias("subject_id"), "season",
        F.col("location").alias("site"), F.coalesce("datetime", F.lit("")).alias("datetime"), "species")


LABEL_ARRAYS = {
    "categories": "id string, name string",
    "images": "id string, file_name string, seq_id string, season string, location string, datetime string",
    "annotations": "image_id string, category_id string",
}


def read_label_json(spark: SparkSession, path: str, **options) -> DataFrame:
    """Label file with ``categories``, ``images`` and ``annotations`` arrays; large files are split over tasks."""
    elements = array_entries(spark, path, **options)
    return labelled_images(*[
        elements.where(F.col("name") == name).select(F.from_json("value", schema).alias("_row"))
        .where("_row IS NOT NULL").select("_row.*") for name, schema in LABEL_ARRAYS.items()])


def database_export(df: DataFrame, header: Mapping[str, str], columns: Sequence[str], order_by: Sequence[str],
                    path: str = "PathFilename") -> DataFrame:
    """Renamed and selected columns, first row per path, season with ``S``, corrected image path."""
    rows = first_n_per_group(df.withColumnsRenamed(dict(header)), [path], list(order_by), 1)
    return rows.select(*columns).withColumns({
        "season": F.concat(F.lit("S"), F.col("season")), "image_path": text.correct_image_name(F.col(path))})


def season_rows(df: DataFrame, season: Column) -> DataFrame:
    """A per-season cleaned file: file name, season, corrected path and reparsed old time."""
    rows = df.withColumns({"season": season, "ImageName": text.base_name(F.col("path"))})
    return rows.withColumns({
        "PathFilename": text.legacy_image_path(F.col("season"), F.col("site"), F.col("roll"), F.col("ImageName")),
        "oldtime": F.date_format(parse_datetime(F.col("oldtime")), "yyyy-MM-dd HH:mm:ss"),
    })


def read_seasons(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, str] | None = None) -> DataFrame:
    """Union of per-season files (season -> path) whose columns may differ; missing columns are empty.

    Seasons with a schema are split over tasks.
    """
    from functools import reduce
    schemas = schemas or {}
    frames = [season_rows(read_table(spark, path, schemas.get(season)), F.lit(season)) for season, path in paths.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).na.fill("")


def read_reports(spark: SparkSession, root: str, postfix: str = "_report.csv", schema: str | None = None) -> DataFrame:
    """All reports ``root/<site>/<season id><postfix>`` in one read, with ``season_id`` from the name.

    A report may be one file or the folder that a Spark job wrote. With a schema, as in ``read_table``, they are split.
    """
    reader = spark.read.options(header=True, escape='"', multiLine=schema is None)
    reports = (reader.schema(schema) if schema else reader).csv(f"{root}/*/*{postfix}")
    season = F.regexp_extract(F.col("_metadata.file_path"), "/([^/]*)" + re.escape(postfix), 1)
    return reports.withColumn("season_id", season).na.fill("")


def subject_urls(subjects: DataFrame, quality: str = "standard", n: int = 3, prefix: str = "url_") -> DataFrame:
    """Up to ``n`` image addresses of a quality per subject, ``standard`` if the quality is missing.

    ``subjects(subject_id, location map<string, array<string>>)``.
    """
    urls = F.coalesce(F.try_element_at("location", F.lit(quality)), F.try_element_at("location", F.lit("standard")))
    return subjects.select("subject_id", *[
        F.coalesce(F.get(urls, F.lit(i)), F.lit("")).alias(f"{prefix}{i}") for i in range(n)])


def read_subject_urls(spark: SparkSession, path: str, lines: bool = False, **options) -> DataFrame:
    """Addresses from a JSON object ``{subject_id: {location: {quality: [urls]}}}``, or from one such object per line."""
    rows = keyed_json(read_objects(spark, path, lines), "record", "struct<location: map<string, array<string>>>")
    return subject_urls(rows.select(F.col("capture_id").alias("subject_id"), "record.location"), **options)


def mapping_table(spark: SparkSession, mapping: Mapping[str, str], override: Mapping[str, str] | None = None) -> DataFrame:
    """A mapping as a two-column table, entries of ``override`` first."""
    rows = list({**mapping, **(override or {})}.items())
    return spark.createDataFrame(rows, "key string, value string")
