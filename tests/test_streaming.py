"""Streams over growing folders."""

import datetime
import random

from crowdspark.operators.captures import group_into_captures
from crowdspark.operators.classifications import extract_annotations
from crowdspark.plans.classification_queries import FILTERS, MULTI, SINGLE
from crowdspark.plans.tables import Tables
from crowdspark.streaming import arrivals, incremental

SF_DIR = "/root/testdata/sf0.001"


def test_annotations_of_a_stream(spark, tmp_path):
    rows = Tables(spark, SF_DIR).classifications.drop("price")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.repartition(3).write.options(header=True, escape='"').csv(folder)
    stream = incremental.classification_stream(spark, folder, ", ".join(f"{c} string" for c in rows.columns))
    annotations = incremental.annotation_stream(stream, SINGLE, MULTI, **FILTERS)
    query = annotations.writeStream.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).format(
        "parquet").start(out)
    query.awaitTermination(120)
    got = spark.read.parquet(out)
    # the batch result is the first classification of each user and subject of the stream's rows
    batch = extract_annotations(rows, ["created_at", "classification_id"], SINGLE, MULTI, **FILTERS)
    assert got.count() >= batch.count() > 0
    assert batch.join(got, batch.columns, "left_anti").count() == 0


def test_items_are_processed_once(spark, tmp_path):
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    for ids in (["a", "b", "b"], ["b", "c"], ["a", "d"]):
        spark.createDataFrame([(i,) for i in ids], "capture_id string").coalesce(1).write.mode("append").parquet(folder)
        items = spark.readStream.schema("capture_id string").parquet(folder)
        incremental.process_once(items, "capture_id", out, state).awaitTermination(120)
    assert sorted(r["capture_id"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d"]


def test_a_batch_reads_nothing_that_was_written_before(spark, tmp_path):
    """Each batch has its own new files as input, and its keys are looked up in the state."""
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    for n in range(4):
        spark.createDataFrame([(f"{n}-{i}",) for i in range(5)] + [("again",)], "id string").coalesce(1).write.mode("append").parquet(folder)
        query = incremental.process_once(spark.readStream.schema("id string").parquet(folder), "id", out, state)
        query.awaitTermination(120)
        assert sum(p["numInputRows"] for p in query.recentProgress) == 6
    assert spark.read.parquet(out).count() == 21


IMAGES = "season string, site string, roll string, datetime timestamp_ntz, image_path_original string, extra double"


def images(n=120):
    """Two rolls, gaps of exactly 5 and 6 seconds, equal times, and a null in another column."""
    rng, rows = random.Random(3), []
    for roll in ("1", "2"):
        at = datetime.datetime(2020, 1, 1)
        for i in range(n // 2):
            at += datetime.timedelta(seconds=rng.choice([0, 1, 5, 6, 400]))
            rows.append(("S1", "A", roll, at, f"{roll}/{i:03}", None if i % 7 == 0 else i / 3))
    return rows


def run_captures(spark, folder, out, state):
    stream = arrivals.capture_stream(spark.readStream.schema(IMAGES).option("maxFilesPerTrigger", 1).parquet(folder), delay="1 day",
                                     close_after=3600)
    query = stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True).format("parquet").start(out)
    query.awaitTermination(200)


def test_captures_of_shuffled_files_and_a_restart(spark, tmp_path):
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    rows = images()
    shuffled = random.Random(5).sample(rows, len(rows))
    for part in (shuffled[:50], shuffled[50:]):
        spark.createDataFrame(part, IMAGES).coalesce(1).write.mode("append").parquet(folder)
    run_captures(spark, folder, out, state)
    arrivals.end_mark(spark, IMAGES, "datetime", "2020-02-01 00:00:00").coalesce(1).write.mode("append").parquet(folder)
    for _ in range(2):  # the second run finds nothing new
        run_captures(spark, folder, out, state)
        got = spark.read.parquet(out)
        want = group_into_captures(spark.createDataFrame(rows, IMAGES))
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    # an image behind the watermark is dropped, a later one goes on with the numbers
    more = [("S1", "A", "1", datetime.datetime(2020, 1, 1), "late", 0.0), ("S1", "A", "1", datetime.datetime(2020, 2, 2), "next", 0.0),
            ("S1", "A", "1", None, "no time", 0.0)]
    spark.createDataFrame(more, IMAGES).coalesce(1).write.mode("append").parquet(folder)
    arrivals.end_mark(spark, IMAGES, "datetime", "2020-03-01 00:00:00").coalesce(1).write.mode("append").parquet(folder)
    run_captures(spark, folder, out, state)
    new = spark.read.parquet(out).where("image_path_original in ('late', 'next', 'no time')").collect()
    assert [(r.image_path_original, r.image_rank_in_roll, r.seconds_to_next_image_taken) for r in new] == [("next", 61, 0.0)]


def test_first_rows_of_keys(spark, tmp_path):
    from pyspark.sql import functions as F
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    schema = "k string, at timestamp_ntz, n int, name string"
    day = lambda d: datetime.datetime(2020, 1, d)
    parts = [[("a", day(5), 1, "late"), ("a", day(4), 10, "ten"), ("a", day(4), 9, "nine"), ("b", day(6), None, "null"), ("b", day(6), 0, "zero")],
             [("a", day(4), 2, "two"), ("c", None, 0, "no time")], [(None, day(20), 0, "mark")], [("a", day(21), 0, "again"), (None, day(30), 0, "m")]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = arrivals.first_rows_stream(spark.readStream.schema(schema).parquet(folder), ["k"], F.col("at"), ["n"], delay="4 days")
        stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True).format("parquet").start(out).awaitTermination(100)
    assert sorted((r.k, r.n, r.name) for r in spark.read.parquet(out).collect()) == [("a", 2, "two"), ("b", None, "null")]


def test_many_files_of_one_arrival_lose_no_image(spark):
    """The watermark moves when all files of a part are read, not between them."""
    from crowdspark.plans.stream_queries import captures_of_a_stream
    tables = Tables(spark, SF_DIR)
    tables.inventory = tables.inventory.repartition(30, "event_id")
    assert captures_of_a_stream(tables).count() == tables.inventory.count()


def test_parts_arrive_by_a_key_and_lose_no_row(spark):
    """A part is filtered by its time and key, each named once, whatever the other columns cost."""
    from pyspark.sql import functions as F
    from crowdspark.plans import stream_queries as s
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(days=i % 40) for i in range(400)]
    rows = spark.createDataFrame([(f"{d} 10:00:00 UTC", i, "x") for i, d in enumerate(days)] + [(None, 1, "none"), (f"{days[0]}", None, "key")],
                                 "at string, k int, other string").withColumn("costly", F.sha2("other", 256))
    end = arrivals.end_mark(spark, "at string, k int, other string, costly string", "at", "2100-01-01 00:00:00 UTC")
    parts = s.arriving(rows, "at", "k", end)
    assert len(parts) == s.FILES
    arrived = [[r for r in p.collect() if r.other is not None] for p in parts]
    assert sorted(map(str, sum(arrived, []))) == sorted(map(str, rows.collect())) and all(len(a) > 50 for a in arrived)
    for before, after in zip(arrived, arrived[1:]):
        newest, oldest = max(r["at"][:10] for r in before if r["at"]), min(r["at"][:10] for r in after)
        assert (datetime.date.fromisoformat(newest) - datetime.date.fromisoformat(oldest)).days <= s.LATE_DAYS
    plan = parts[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(") == 1 and "sha2" not in plan[plan.index("xxhash64("):]
    assert [p.count() for p in s.arriving(rows.where("at is null"), "at", "k", end)] == [2]
    assert sum(p.count() for p in s.arriving(rows.where(F.col("at").startswith("2020-01-01")), "at", "k", end)) == 12


def test_first_classifications_wait_without_their_texts(spark, tmp_path):
    """A row keeps the columns that are asked for, and the rows are those of the batch operator."""
    from crowdspark.operators.classifications import eligible_classifications
    from crowdspark.plans.classification_queries import ORDER
    folder, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    rows = Tables(spark, SF_DIR).classifications
    end = arrivals.end_mark(spark, ", ".join(f"{n} {k}" for n, k in rows.dtypes), "created_at", "2100-01-01 00:00:00 UTC")
    for part in (rows, end):
        part.write.mode("append").parquet(folder)
        stream = incremental.first_classification_stream(spark.readStream.schema(rows.schema).parquet(folder), ORDER, delay="3 days",
                                                         keep=["price", "user_id"], **FILTERS)
        stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True).format("parquet").start(out).awaitTermination(100)
    columns = ["classification_id", "user_name", "user_id", "workflow_id", "created_at", "subject_ids", "price"]
    got, want = spark.read.parquet(out), eligible_classifications(rows, ORDER, **FILTERS)
    assert got.columns == columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*columns).collect())) and want.count() > 500
