"""Readers and writers on files."""

import json
import struct
import zlib

from pyspark.sql import functions as F

from crowdspark.functions.times import file_time_local
from crowdspark.operators import quality
from crowdspark.sources import readers, writers
from crowdspark.sources.contents import file_digests


def png(path, color, size=10):
    """A plain image of one colour."""
    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    rows = b"".join(b"\0" + bytes(color) * size for _ in range(size))
    header = struct.pack(">IIBBBBB", size, size, 8, 2, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b""))


def test_table_keeps_quotes_and_empties(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,meta,x\n1,"{""a"":""b, c""}",\n2,"line\nbreak",NA\n')
    got = [tuple(r) for r in readers.read_table(spark, str(tmp_path / "a.csv")).orderBy("id").collect()]
    assert got == [("1", '{"a":"b, c"}', ""), ("2", "line\nbreak", "NA")]


def test_images(spark, tmp_path):
    folder = tmp_path / "S1" / "A1" / "A1_R2"
    folder.mkdir(parents=True)
    png(folder / "dark.png", (1, 2, 3))
    png(folder / "bright.png", (250, 251, 252))
    png(folder / "grey.png", (100, 1, 250))
    (folder / "broken.png").write_bytes(b"no image")
    (folder / "notes.txt").write_text("x")
    root = str(tmp_path / "S1")
    files = readers.list_images(spark, root)
    assert files.count() == 4
    inventory = readers.inventory_from_paths(files).where("image_name_original = 'dark.png'").first()
    assert (inventory["season"], inventory["site"], inventory["roll"]) == ("S1", "A1", "2")
    assert inventory["image_path_original_rel"] == "S1/A1/A1_R2/dark.png"
    assert len(files.select(file_time_local(F.col("modificationTime"))).first()[0]) == 19
    images = spark.read.format("image").option("recursiveFileLookup", True).option("pathGlobFilter", "*.png").load(root)
    got = {r["path"].split("/")[-1]: tuple(r)[1:] for r in quality.image_exposure(images).collect()}
    assert got == {"dark.png": (1, 0, 0), "bright.png": (0, 1, 0), "grey.png": (0, 0, 0), "broken.png": (0, 0, 1)}


def test_listing_takes_tasks_by_folders(spark, tmp_path):
    """As Spark's own listing, but without a task for every few files, and with no list on the driver."""
    for i in range(300):
        folder = tmp_path / f"A{i % 3}" / f"A{i % 3}_R{i % 2}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"a b%20{i}.JPG").write_bytes(b"x" * (i + 1))
    (tmp_path / "_hidden").mkdir()
    for name in ("_hidden/x.jpg", ".x.jpg", "_x.jpg", "_a=b.jpg", "x.txt", "top.png"):
        (tmp_path / name).write_bytes(b"y")
    want = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path))
    want = want.where("path rlike '(?i)(jpg|png)$'").select(F.regexp_replace("path", "^file:/+", "/"), "length", "modificationTime")
    for directory in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}/"):
        files = readers.list_images(spark, directory)
        assert sorted(map(tuple, files.collect())) == sorted(map(tuple, want.collect())) and files.count() == 302
        assert "binaryFile" not in files._jdf.queryExecution().toString()
    assert readers.list_images(spark, str(tmp_path / "A[01]")).count() == 200
    # a file without bytes is listed; Spark's reader leaves it out
    (tmp_path / "empty.jpg").write_bytes(b"")
    assert readers.list_images(spark, str(tmp_path)).where("length = 0").count() == 1


def test_keyed_json(spark, tmp_path):
    manifest = {"c1": {"upload_metadata": {"#site": "A"}, "info": {"uploaded": False}, "images": ["a", "b"]},
                "c2": {"upload_metadata": {"#site": "B"}, "info": {"uploaded": True}, "images": {"original_images": ["c"]}}}
    (tmp_path / "m.json").write_text(json.dumps(manifest))
    got = {r["capture_id"]: (r["images"], r["upload_metadata"]["#site"]) for r in readers.read_manifest(spark, str(tmp_path / "m.json")).collect()}
    assert got == {"c1": (["a", "b"], "A"), "c2": (["c"], "B")}
    prediction = {"c1": {"predictions_top": {"species": "x"}, "confidences_top": {}, "aggregated_pred": {"species": {"x": "1"}}}}
    (tmp_path / "p.json").write_text(json.dumps(prediction))
    assert readers.read_predictions(spark, str(tmp_path / "p.json")).first()["prediction"]["aggregated_pred"] == {"species": {"x": "1"}}
    urls = {"s1": {"location": {"standard": ["1", "2", "3", "4"]}}, "s2": {"location": {"standard": ["1"], "large": ["9"]}}}
    (tmp_path / "u.json").write_text(json.dumps(urls))
    got = sorted(tuple(r) for r in readers.read_subject_urls(spark, str(tmp_path / "u.json"), quality="large").collect())
    assert got == [("s1", "1", "2", "3"), ("s2", "9", "", "")]


def test_label_json(spark, tmp_path):
    data = {"categories": [{"id": "1", "name": "lion"}, {"id": "2", "name": "ant"}],
            "images": [{"id": "i1", "file_name": "f1", "seq_id": "q", "season": "S1", "location": "A"},
                       {"id": "i2", "file_name": "f2", "seq_id": "q", "season": "S1", "location": "A", "datetime": "d"}],
            "annotations": [{"image_id": "i1", "category_id": "1"}, {"image_id": "i2", "category_id": "2"}]}
    (tmp_path / "l.json").write_text(json.dumps(data))
    got = sorted((r["image_path"], r["datetime"], r["species"]) for r in readers.read_label_json(spark, str(tmp_path / "l.json")).collect())
    assert got == [("f1", "", "ant#lion"), ("f2", "d", "ant#lion")]


def test_cleaned_season(spark, tmp_path):
    (tmp_path / "s.csv").write_text("season,site,roll,capture,image_rank_in_capture,image_path_rel\n"
                                    "S1,A,1,10,1,A/x.JPG\nS1,A,1,2,2,S1/A/y.JPG\nS1,A,1,2,1,A/z.JPG\n")
    got = [(r["capture_id"], r["path"]) for r in readers.read_cleaned_season(spark, str(tmp_path / "s.csv")).collect()]
    assert got == [("S1#A#1#2", "S1/A/z.JPG"), ("S1#A#1#2", "S1/A/y.JPG"), ("S1#A#1#10", "S1/A/x.JPG")]


def test_seasons_and_reports(spark, tmp_path):
    for season, extra in (("S4", ""), ("S5", ",more")):
        (tmp_path / f"{season}.csv").write_text(f"site,roll,path,oldtime{extra}\nB04,1,x/PICT1.JPG,2010:01:02 03:04:05{',m' if extra else ''}\n")
    rows = readers.read_seasons(spark, {s: str(tmp_path / f"{s}.csv") for s in ("S4", "S5")}).orderBy("season").collect()
    assert [(r["PathFilename"], r["oldtime"], r["more"]) for r in rows] == [
        ("S4/B04/B04_R1/S4_B04_R1_PICT1.JPG", "2010-01-02 03:04:05", ""), ("S5/B04/B04_R1/S5_B04_R1_PICT1.JPG", "2010-01-02 03:04:05", "m")]
    (tmp_path / "root" / "APN").mkdir(parents=True)
    (tmp_path / "root" / "APN" / "APN_S1_report.csv").write_text("a\n1\n")
    assert readers.read_reports(spark, str(tmp_path / "root")).first()["season_id"] == "APN_S1"


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("S1", "b", "2"), ("S2", "a", "1"), ("S1", "a", "3")], "season string, name string, v string")
    writers.write_table(df, str(tmp_path / "t"), ["name", "season"])
    assert readers.read_table(spark, str(tmp_path / "t")).columns == ["name", "season", "v"]
    writers.split_by_season(df, str(tmp_path / "s"))
    assert (tmp_path / "s" / "season=S1").is_dir()
    assert spark.read.options(header=True).csv(str(tmp_path / "s")).count() == 3


def test_mapping_override(spark):
    table = readers.mapping_table(spark, {"a": "1", "b": "2"}, {"b": "3"})
    assert {r["key"]: r["value"] for r in table.collect()} == {"a": "1", "b": "3"}


def test_files_are_opened_by_many_tasks(spark, tmp_path):
    """A list of files is small, so that Spark would join its partitions into one; their contents are not."""
    names = [str(tmp_path / f"{i}.jpg") for i in range(40)]
    for name in names:
        open(name, "wb").write(b"x")
    files = spark.createDataFrame([(n, 1) for n in names], "path string, length bigint").coalesce(1)
    digests = file_digests(files.groupBy("path").agg(F.max("length").alias("length")))
    tasks = digests.withColumn("task", F.spark_partition_id()).select("task", "digest").collect()
    assert len(tasks) == 40 and len({r.task for r in tasks}) > 4 and len({r.digest for r in tasks}) == 1


def test_a_written_export_is_split_over_tasks(spark, tmp_path):
    """With a schema a large file of an export is read by several tasks."""
    from crowdspark.plans import load_all
    load_all()
    from crowdspark.plans.source_queries import text_schema
    rows = spark.range(20000).select(F.col("id").cast("string").alias("classification_id"), F.lit('{"a":"b,c"}').alias("metadata"))
    writers.write_table(rows.coalesce(1), str(tmp_path / "export"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100000)
    try:
        got = readers.read_classifications(spark, str(tmp_path / "export"), text_schema(rows))
        assert got.rdd.getNumPartitions() > 2
        assert got.exceptAll(rows).isEmpty() and got.count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_compressed_export_is_read_by_many_tasks(spark, tmp_path):
    """Its files are small, however many rows a task writes, and hold the same texts."""
    from crowdspark.plans import load_all
    load_all()
    from crowdspark.plans.source_queries import text_schema
    rows = spark.range(5000).select(F.col("id").cast("string").alias("classification_id"), F.lit('{"a":"b,c\\\\"}').alias("metadata"),
                                    F.when(F.col("id") % 2 == 0, "").otherwise('"x"').alias("user_id"))
    for name, options in (("plain", {}), ("small", {"compression": "gzip", "file_rows": 400})):
        writers.write_table(rows.coalesce(1), str(tmp_path / name), **options)
    plain, small = ([f for f in (tmp_path / n).iterdir() if f.name.startswith("part")] for n in ("plain", "small"))
    assert len(plain) == 1 and len(small) == 13 and sum(f.stat().st_size for f in small) * 4 < plain[0].stat().st_size
    got = readers.read_classifications(spark, str(tmp_path / "small"), text_schema(rows))
    assert got.exceptAll(rows).isEmpty() and got.count() == 5000


def test_the_export_of_the_round_trip_is_compressed(spark, tmp_path, monkeypatch):
    from crowdspark.plans import load_all
    load_all()
    from crowdspark.plans import source_queries
    from crowdspark.plans.tables import Tables
    monkeypatch.setattr(source_queries, "shared_folder", lambda spark, name: str(tmp_path / name))
    got = source_queries.classifications_round_trip(Tables(spark, "/root/testdata/sf0.001"))
    parts = [f.name for f in (tmp_path / "classifications").iterdir() if f.name.startswith("part")]
    assert parts and all(n.endswith(".csv.gz") for n in parts) and got.count() > 5000
