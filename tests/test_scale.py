"""Ranges by blocks, files in stages, samples by threshold, rolls by touch, and tracker commits."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from crowdspark.operators import actions, captures, consolidation, datasets, ordering, quality
from crowdspark.operators.ordering import lowest_hashes
from crowdspark.sources import contents, writers


def inventory(spark, sizes):
    rows = [("S", "A", str(roll), rank, f"{roll}-{rank}") for roll, size in enumerate(sizes, 1) for rank in range(1, size + 1)]
    return spark.createDataFrame(rows, "season string, site string, roll string, image_rank_in_roll int, image_name string")


def test_blocks_cover_each_rank_once(spark):
    rng = random.Random(1)
    pairs = [(a, a + rng.randint(0, 300)) for a in (rng.randint(0, 200) for _ in range(80))] + [(0, 0), (5, 5), (0, 2**31 - 1)]
    rows = spark.createDataFrame(pairs, "a long, b long").withColumn("blocks", actions.covering_blocks("a", "b")).collect()
    for row in rows:
        spans = sorted((b.block << b.level, (b.block + 1) << b.level) for b in row.blocks)
        edges = [row.a, *(e for _, e in spans)]
        assert [s for s, _ in spans] == edges[:-1] and edges[-1] == row.b and len(spans) <= 62


def test_ranges_meet_their_own_images_only(spark):
    """Many short ranges on one roll, one over three rolls: the join makes the rows of the result, with no filter after it."""
    images = inventory(spark, [900, 3, 40])
    rng = random.Random(2)
    ends = [(rng.randint(1, 890), rng.randint(1, 8)) for _ in range(200)]
    ranges = [(f"r{i}", f"1-{a}", f"1-{a + n}") for i, (a, n) in enumerate(ends)] + [("long", "1-890", "3-7")]
    table = spark.createDataFrame(ranges, "action_no string, action_from_image string, action_to_image string")
    got = actions.images_for_range(table, images)
    order = [f"{roll}-{rank}" for roll, size in enumerate([900, 3, 40], 1) for rank in range(1, size + 1)]
    want = [(no, image) for no, a, b in ranges for image in order[order.index(a): order.index(b) + 1]]
    assert sorted((r.action_no, r.image) for r in got.collect()) == sorted(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "image_rank_in_roll" in plan and ">= _from_rank" not in plan and "<= _to_rank" not in plan


def test_images_of_sites_and_rolls(spark):
    images = inventory(spark, [2, 1])
    table = spark.createDataFrame([("s", "A", ""), ("r", "A", "2"), ("x", "B", "1")], "action_no string, action_site string, action_roll string")
    assert sorted((r.action_no, r.image) for r in actions.images_for_site(table, images).collect()) == [
        ("r", "2-1"), ("s", "1-1"), ("s", "1-2"), ("s", "2-1")]


@pytest.fixture
def files(spark, tmp_path):
    data = {"a": b"x" * 5000, "b": b"x" * 5000, "c": b"x" * 4999 + b"y", "d": b"y" + b"x" * 4999, "e": b"tiny", "f": b"tiny", "g": b"alone",
            "h": b"x" * 5000}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    return spark.createDataFrame([(str(tmp_path / n), len(c)) for n, c in data.items()], "path string, length long")


def test_files_are_compared_in_stages(spark, files, tmp_path, monkeypatch):
    opened = []
    whole = contents.file_digests

    def counted(df, size=None, out="digest"):
        opened.append((size, sorted(r.path[-1] for r in df.select("path").collect())))
        return whole(df, size, out)

    monkeypatch.setattr(quality, "file_digests", counted)
    got = quality.duplicate_files(files)
    assert sorted((r.path[-1], r.first_path[-1]) for r in got.collect()) == [("b", "a"), ("f", "e"), ("h", "a")]
    # the lone size is never opened, the file with another start is not read whole, short files are read once
    assert opened == [(1024, list("abcdefh")), (None, list("abch"))]
    missing = files.unionByName(spark.createDataFrame([(str(tmp_path / "none"), 5000)], files.schema))
    assert quality.duplicate_files(missing).count() == 3 and quality.duplicate_files(files.limit(0)).count() == 0


def test_files_are_matched_in_stages(files):
    name = F.substring("path", -1, 1)
    find, search = files.where(name.isin("a", "e", "g", "d")), files.where(name.isin("b", "c", "f", "h"))
    for verify in (False, True):
        got = {r.path_search[-1]: r.path_found and r.path_found[-1] for r in quality.match_files(find, search, verify).collect()}
        assert got == {"a": "b", "d": None, "e": "f", "g": None}


def test_samples_by_threshold(spark):
    rows = [(i, "ab"[i % 10 == 0]) for i in range(3000)] + [(9000, None), (9001, None)]
    table = spark.createDataFrame(rows, "id int, k string").repartition(5)
    for n in (0, 1, 57, 5000):
        got = sorted((r.k or "", r.id) for r in datasets.random_sample(table, n, "id", ["k"]).collect())
        want = []
        for k in {r[1] for r in rows}:
            hashed = sorted((hashlib.md5(f"123:{i}".encode()).hexdigest(), i) for i, key in rows if key == k)
            want += [(k or "", i) for _, i in hashed[:n]]
        assert got == sorted(want)
    assert datasets.random_sample(table, 100, "id").count() == 100
    quotas = table.where("k is not null").withColumns({"h": F.md5(F.col("id").cast("string")), "q": F.when(F.col("k") == "a", 3).otherwise(7)})
    assert {r.k: r["count"] for r in lowest_hashes(quotas, ["k"], "h", ["id"], F.col("q")).groupBy("k").count().collect()} == {"a": 3, "b": 7}


def test_only_touched_rolls_are_grouped_again(spark):
    base = inventory(spark, [30, 20, 10]).withColumns({
        "datetime": F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, image_rank_in_roll * 4)"),
        "image_path_original": F.col("image_name"), "image_path_original_rel": F.col("image_name"), "image_name_original": F.lit("a.jpg"),
        "image_was_deleted": F.lit("")})
    grouped = captures.capture_inventory(base)
    names = [r.image_name for r in grouped.where("roll = '2'").orderBy("image_rank_in_roll").collect()]
    acted = grouped.withColumn("image_was_deleted", F.when(F.col("image_name").isin(names[3], names[4]), "1").otherwise(""))
    listed = spark.createDataFrame([(names[3],), (names[4],)], "image string")
    whole = captures.regroup_after_actions(acted)
    part = captures.regroup_touched(acted, listed)
    assert sorted(map(str, part.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    assert {r.capture for r in part.where("roll = '2'").collect()} == {1, 2}
    marked = captures.regroup_touched(acted.withColumn("extra", F.col("capture") * 0 + 7), listed).where("roll <> '2'")
    assert marked.count() == 40 and marked.where("extra = 7").count() == 40


def test_a_batch_is_committed_once(spark, tmp_path):
    path = str(tmp_path / "tracker")
    ids = lambda *names: spark.createDataFrame([(n, n) for n in names], "capture_id string, subject_id string")
    assert writers.read_tracker(spark, path).count() == 0
    for names, batch in ((("a", "b"), "1"), (("a", "b"), "1"), (("c",), "2"), (("other",), "2")):
        writers.append_tracker(ids(*names), path, batch=batch)
    ids("lost").write.options(header=True).csv(f"{path}/batch=3")  # an interrupted run
    assert sorted(r.capture_id for r in writers.read_tracker(spark, path).collect()) == ["a", "b", "c"]
    writers.append_tracker(ids("d"), path, batch="3")
    writers.compact_tracker(spark, path, "all")
    assert writers.committed_batches(spark, path) == ["all"]
    writers.append_tracker(ids("late"), path, batch="1")  # compacted, so committed
    assert sorted(r.capture_id for r in writers.read_tracker(spark, path).collect()) == ["a", "b", "c", "d"]


def test_paths_that_do_not_exist_may_be_a_table(spark):
    images = spark.createDataFrame([("a", "S1", "0"), ("b", "S1", "0"), ("c", "S1", ""), (None, "S2", "0")],
                                   "image_path_rel string, season string, invalid string")
    gone = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "file string, n int")
    for missing in (gone, ["a"]):
        kept = consolidation.keep_known_images(images, missing, ["S1"])
        assert sorted(str(r["image_path_rel"]) for r in kept.collect()) == ["None", "b"]
    assert consolidation.keep_known_images(images).count() == 4


def test_rows_without_keys_are_numbered_in_slices(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    placed = ordering.group_positions(rows, [], ["v"])
    assert all(r["position"] == r["v"] + 1 for r in placed.collect())
    labels = datasets.label_to_index(rows.unionByName(rows), "v")
    assert sorted(tuple(r) for r in labels.collect()) == [(i, i) for i in range(1000)]
    assert ordering.group_positions(rows.limit(0), [], ["v"]).count() == 0
