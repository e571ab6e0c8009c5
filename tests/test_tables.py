"""Legacy, report, manifest and dataset operators on small tables."""

import pytest
from pyspark.sql import functions as F

from crowdspark.functions import hashing, maps, text, times
from crowdspark.operators import consolidation, datasets, legacy, manifests, predictions, reports, subjects


def folded(spark, *counts):
    rows = spark.createDataFrame([("c", "lion", n, "1" if i else "0", i) for i, n in enumerate(counts)],
                                 "classification_id string, species string, count string, moving string, ord int")
    result = legacy.consolidate_annotations(rows, ["ord"]).collect()
    assert len(result) == 1
    return result[0]["count"]


@pytest.mark.parametrize("counts, expected", [
    (["2", "2"], "4"), (["6", "6"], "11-50"), (["6", "6", "51+"], "11-50"), (["51+", "6", "6"], "51+"), (["51+", "11-50"], "11-50"),
    (["1", ""], ""), (["", "51+"], "51+"), (["", "3"], ""), (["51+"], "51+"), (["7"], "7"), (["5", "5", "", "51+"], "51+"),
    (["5", "6", "", "51+"], "11-50"), (["11-50", "1"], "11-50"), (["1", "2", "3"], "6")])
def test_count_consolidation(spark, counts, expected):
    assert folded(spark, *counts) == expected


def test_consolidation_equals_the_fold(spark):
    import itertools

    def fold(counts):
        state = counts[0]
        for new in counts[1:]:
            pair = (state, new)
            state = next((x for x in ("11-50", "51+", "") if x in pair), None)
            if state is None:
                total = int(pair[0]) + int(pair[1])
                state = "11-50" if total > 10 else str(total)
        return state

    cases = [p for n in (1, 2, 3, 4) for p in itertools.product(["3", "9", "", "51+", "11-50"], repeat=n)]
    rows = spark.createDataFrame([(str(i), "lion", v, j) for i, p in enumerate(cases) for j, v in enumerate(p)],
                                 "classification_id string, species string, count string, ord int")
    got = {r["classification_id"]: r["count"] for r in legacy.consolidate_annotations(rows, ["ord"]).collect()}
    assert got == {str(i): fold(p) for i, p in enumerate(cases)}


def test_legacy_answers(rows):
    mapped = legacy.map_legacy_answers(rows("species moving", [("", "true"), ("nothing", "false"), ("lion", "")]), ["moving"])
    assert [tuple(r) for r in mapped.collect()] == [("blank", "1"), ("blank", "0"), ("lion", "")]


def test_capture_by_images(spark, rows):
    images = rows("image_id capture_id", [
        ("SER_S9#B04#R1#PICT0002.JPG", "cap2"), ("SER_S9#B04#R1#PICT0001.JPG", "cap1")])
    found = rows("classification_id subject_id season site roll filenames", [
        ("1", "a", "9", "B04", "1", "PICT0002.JPG;PICT0001.JPG"), ("2", "b", "S9", "B04", "r1", ""), ("3", "c", "9", "B04", "1", "x"),
        ("4", "d", "9", "B04", "1", "a;b;c;d"), ("5", "e", "tutorial", "B04", "1", "x"), ("6", "f", "9", "B04", "1", "")])
    known = rows("subject_id capture_id", [("f", "cap9")])
    got = {r["classification_id"]: (r["capture_id"], r["reject_reason"]) for r in legacy.resolve_captures(found, known, images).collect()}
    assert got == {"1": ("cap1", None), "2": ("", "without_images"), "3": ("", "capture_not_found"), "4": ("", "too_many_images"),
                   "5": ("", "not_eligible"), "6": ("cap9", None)}


@pytest.mark.parametrize("path, expected", [
    ("S1/G12/G12_R1/PICT3981.JPG", "S1/G12/G12_R1/S1_G12_R1_PICT3981.JPG"),
    ("S8/O09/O09_R3/S8_O09_R3_IMAG9279.JPG", "S8/O09/O09_R3/S8_O09_R3_IMAG9279.JPG"),
    ("S4/J12/J12_R2/IMG_6068.JPG", "S4/J12/J12_R2/S4_J12_R2_IMG6068.JPG"), ("x.JPG", "x.JPG")])
def test_image_names(rows, path, expected):
    assert rows("p", [(path,)]).select(text.correct_image_name(F.col("p"))).first()[0] == expected


def test_report_rules(rows):
    captures = rows("capture_id season", [("c1", "S"), ("c2", "S"), ("c3", "S")])
    aggregated = rows("capture_id subject_id season question__species species_is_plurality_consensus", [
        ("c1", "s1", "x", "zebra", "1"), ("c1", "s1", "x", "lion", "0"), ("c2", "s2", "x", "human", "1")])

    def report(**options):
        return sorted((r["capture_id"], r["season"], r["question__species"]) for r in reports.species_report(captures, aggregated, **options).collect())

    assert report() == [("c1", "S", "lion"), ("c1", "S", "zebra"), ("c2", "S", "human"), ("c3", "S", "")]
    # c2 lost its only label and is dropped, c3 never had one and stays
    assert report(exclude_humans=True, exclude_non_consensus=True) == [("c1", "S", "zebra"), ("c3", "S", "")]
    assert report(exclude_humans=True, exclude_captures_without_data=True) == [("c1", "S", "lion"), ("c1", "S", "zebra")]


def test_losing_subject_is_removed_everywhere(rows):
    aggregated = rows("ord capture_id subject_id", [("1", "c1", "s1"), ("2", "c1", "s2"), ("3", "c2", "s2"), ("4", "c3", "s3")])
    assert sorted(r["subject_id"] for r in reports.deduplicate_captures(aggregated, ["ord"]).collect()) == ["s1", "s3"]


def test_merge_sides(rows):
    base, add = rows("id a", [("1", "x")]), rows("id a b", [("1", "y", "z")])
    assert reports.merge_tables(base, add, "id").columns == ["id", "a", "b"]
    assert reports.merge_tables(base, add, "id", "left").columns == ["b", "id", "a"]


@pytest.mark.parametrize("n", [1, 3, 5, 8, 12, 50])
def test_balanced_sample(spark, n):
    labels = ["zebra"] * 6 + ["lion"] * 3 + ["elephant"] * 2 + ["giraffe"]
    df = spark.createDataFrame(list(enumerate(labels)), "id int, label string")
    sample = [r["label"] for r in reports.balanced_sample(df, "label", n, "id").collect()]
    rounds = next(r for r in range(1, 50) if sum(min(labels.count(s), r) for s in set(labels)) >= min(n, 12))
    assert len(sample) == min(n, 12)
    assert all(sample.count(s) <= min(labels.count(s), rounds) for s in set(labels))
    # only the commonest labels may miss their share
    short = [s for s in set(labels) if sample.count(s) < min(labels.count(s), rounds)]
    assert all(labels.count(s) >= labels.count(o) for s in short for o in set(labels) - set(short)) or n < 4


@pytest.mark.parametrize("n, size", [(10, 3), (7, 7), (5, 8), (21, 4)])
def test_batches(spark, n, size):
    df = spark.range(n).select(F.format_string("c%03d", "id").alias("capture_id"))
    batches = [r["batch"] for r in manifests.batch_assign(df, ["capture_id"], n_batches=size).orderBy("capture_id").collect()]
    ends = [round(b * n / size) for b in range(size + 1)]
    assert batches == [b + 1 for b in range(size) for _ in range(ends[b], ends[b + 1])]
    shuffled = manifests.batch_assign(df, [], max_size=4, seed=1, hot_group_rows=2)
    assert shuffled.groupBy("batch").count().agg(F.sum("count")).first()[0] == n


def test_empty_prediction_needs_a_known_label(spark):
    df = spark.createDataFrame([("c", {"predictions_top": {}, "confidences_top": {}, "aggregated_pred": {"other": {"a": "1"}}})],
                               f"capture_id string, prediction {predictions.PREDICTION_STRUCT}")
    with pytest.raises(Exception, match="expected, found: other"):
        df.select(predictions.empty_prediction_map()).collect()


def test_prediction_columns_are_found(spark):
    prediction = {"predictions_top": {"species": "lion"}, "confidences_top": {"species": "0.9"},
                  "aggregated_pred": {"species": {"lion": "0.9", "zebra": "0.1"}, "young": {"0": "0.3", "1": "0.7"}}}
    species = spark.createDataFrame([("c1", prediction)], f"capture_id string, prediction {predictions.PREDICTION_STRUCT}")
    flat = predictions.combine_predictions(species.limit(0), species)
    assert predictions.prediction_names(flat) == [
        "machine_confidence_species_lion", "machine_confidence_species_zebra", "machine_confidence_young",
        "machine_topconfidence_species", "machine_topprediction_species"]


def test_metadata_patch(spark):
    df = spark.createDataFrame([({"#site": "A", "#roll": "1", "#capture": "2", "capture_id": "old"},)], "m map<string,string>")
    patched = df.select(manifests.patch_metadata(F.col("m"), "S1")).first()[0]
    assert patched["#season"] == "S1" and patched["#capture_id"] == "S1#A#1#2" and "capture_id" not in patched
    assert len(patched["capture_id_anonymized"]) == 40


def test_hash_split(spark):
    df = spark.range(2000).select(F.concat(F.lit("S#"), "id").alias("capture_id"))
    units = df.select(hashing.hash_to_unit(F.col("capture_id")).alias("u"))
    assert units.where("u < 0 or u > 1").count() == 0
    splits = units.select(hashing.assign_split(F.col("u"), [0.9, 0.05, 0.05], ["train", "val", "test"]).alias("s")).groupBy("s").count()
    shares = {r["s"]: r["count"] / 2000 for r in splits.collect()}
    assert abs(shares["train"] - 0.9) < 0.03 and abs(shares["test"] - 0.05) < 0.02
    assert spark.range(1).select(hashing.assign_split(F.lit(1.0), [0.5, 0.4], ["a", "b"])).first()[0] == "b"


def test_samples(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("k"))
    first = sorted(r["id"] for r in datasets.random_sample(df, 10, "id", ["k"]).collect())
    assert len(first) == 20 and first == sorted(r["id"] for r in datasets.random_sample(df.repartition(5), 10, "id", ["k"]).collect())
    assert first != sorted(r["id"] for r in datasets.random_sample(df, 10, "id", ["k"], seed=4).collect())


def test_times(rows):
    df = rows("t", [("2019:01:02 03:04:05",), ("2019-01-02 03:04:05",), ("2019-01-02 03:04:05Z",), ("x",)])
    parsed = [str(r[0]) for r in df.select(times.parse_datetime(F.col("t"))).collect()]
    assert parsed == ["2019-01-02 03:04:05"] * 3 + ["None"]
    utc = F.lit("2018-09-01 10:00:00").cast("timestamp_ntz")
    assert str(df.select(times.utc_to_zone(utc, "Africa/Johannesburg")).first()[0]) == "2018-09-01 12:00:00"


def test_tags(spark):
    df = spark.createDataFrame([({"EXIF:Make": "x", "File:Size": "1", "MakerNotes:PreviewImage": "b", "DateTime": "bad",
                                  "EXIF:DateTime": "2019:01:02 03:04:05"},), ({},), (None,)], "tags map<string,string>")
    checks = maps.tag_checks(F.col("tags"))
    got = df.select(maps.select_tags(F.col("tags")).alias("t"), maps.exif_datetime(F.col("tags")).cast("string").alias("d"),
                    *[v.alias(k) for k, v in checks.items()]).collect()
    assert set(got[0]["t"]) == {"exif__EXIF:Make", "exif__EXIF:DateTime"} and got[0]["d"] == "2019-01-02 03:04:05"
    assert [(r["image_check__corrupt_exif"], r["image_check__empty_exif"]) for r in got] == [(0, 0), (0, 1), (1, 0)]


def test_invalid_flags(rows):
    flags = consolidation.invalid_flags(rows("invalid", [("0",), ("1",), ("3",), ("",)])).collect()
    assert [(r["include"], r["image_is_invalid"]) for r in flags] == [("1", "0"), ("0", "1"), ("0", "1"), ("", "")]


def test_last_subject_wins(rows):
    df = rows("ord subject_id v", [("1", "a", "x"), ("2", "a", "y"), ("1", "b", "z")])
    assert sorted((r["subject_id"], r["v"]) for r in subjects.last_per_subject(df, ["ord"]).collect()) == [("a", "y"), ("b", "z")]


def test_deduplication_takes_tasks_by_rows(spark, rows, monkeypatch):
    """One exchange of the captures and one of the rows, both of as many tasks as there are rows for."""
    from crowdspark.operators import ordering
    monkeypatch.setattr(ordering, "ROWS_PER_TASK", 10, raising=False)
    # two subjects share a capture; those without one lose nothing
    data = [(f"{i:03}", f"c{i // 2}" if i < 150 else None, f"s{i:03}") for i in range(200)]
    kept = reports.deduplicate_captures(spark.createDataFrame(data, "ord string, capture_id string, subject_id string"), ["ord"])
    assert sorted(r["subject_id"] for r in kept.collect()) == [s for i, (_, _, s) in enumerate(data) if i >= 150 or i % 2 == 0]
    assert kept.rdd.getNumPartitions() >= 20


def test_rows_without_lists_are_not_exchanged_by_list(rows):
    data = [("1", "a", "S1", "B01", "1", n) for n in ("", "x.JPG;x.JPG;x.JPG;x.JPG", None, "PICT0001.JPG")]
    found = rows("classification_id subject_id season site roll filenames", [(str(i), *r[1:]) for i, r in enumerate(data)])
    images = rows("image_id capture_id", [("SER_S1#B01#R1#PICT0001.JPG", "cap1")])
    got = legacy.resolve_captures(found, rows("subject_id capture_id", [("z", "cap9")]), images)
    assert {r["classification_id"]: (r["capture_id"], r["reject_reason"]) for r in got.collect()} == {
        "0": ("", "without_images"), "1": ("", "too_many_images"), "2": ("", "capture_not_found"), "3": ("cap1", None)}
    # the join by list is below the union, so the other rows pass it by
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.index("Union") < plan.index("filenames#", plan.index("Join"))


def test_legacy_rows_are_exchanged_by_subject_and_by_classification(spark, rows):
    """Captures of subjects and lists come to the rows, whose missing keys find what they found in joins; nothing is checkpointed."""
    columns = "classification_id user_name subject_id season site roll filenames species count moving at"
    data = [("a", "u", "s1", "S1", "B01", "1", "PICT0002.JPG;PICT0001.JPG", "lion", "6", "0", "1"),
            ("a", "u", "s1", "S1", "B01", "1", "PICT0002.JPG;PICT0001.JPG", "lion", "7", "1", "2"),
            ("a", "u", "s1", "S1", "B01", "1", "PICT0001.JPG", "lion", "", "", "3"), ("b", "u", "s1", "S1", "B01", "1", "PICT0001.JPG", "lion", "1", "", "4"),
            ("c", "u", "s2", "S1", "B01", "1", "", "zebra", "2", "", "1"), ("d", "u", "s3", None, "B01", "1", "PICT0001.JPG", "lion", "1", "", "1"),
            ("e", "u", None, "S1", "B01", "1", "PICT0001.JPG", "lion", "1", "", "1"), ("f", "v", "s1", "S1", "B01", "1", "none.JPG", "lion", "3", "", "1"),
            ("f", "v", "s1", "S1", "B01", "1", "PICT0002.JPG", None, "3", "", "2")]
    images = rows("image_id capture_id", [("SER_S1#B01#R1#PICT0001.JPG", "x#1"), ("SER_S1#B01#R1#PICT0002.JPG", "x#2"), ("B01#R1#PICT0001.JPG", "x#3")])
    known = rows("subject_id capture_id", [("s2", "x#4"), ("s2", "x#5"), (None, "x#6"), ("s9", None)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        resolved = legacy.resolve_captures(rows(columns, data), known, images)
        assert sorted((r.classification_id, r.at, r.capture_id, r.reject_reason) for r in resolved.collect()) == [
            ("a", "1", "x#1", None), ("a", "2", "x#1", None), ("a", "3", "x#1", None), ("b", "4", "x#1", None), ("c", "1", "x#5", None),
            ("d", "1", "", "capture_not_found"), ("e", "1", "x#1", None), ("f", "1", "", "capture_not_found"), ("f", "2", "x#2", None)]
        flags = {c: F.lit("") for c in ("standing", "resting", "eating", "interacting", "young_present")}
        got = legacy.extract_legacy_annotations(rows(columns, data).withColumns(flags), known, images, ["at"])
        assert sorted((r.classification_id, r.species or "", r["count"], r.moving, r.capture, r.at) for r in got.collect()) == [
            ("a", "lion", "11-50", "1", "1", "3"), ("c", "zebra", "2", "", "5", "1"), ("f", "", "3", "", "2", "2")]
        plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert plan.split("REPARTITION_BY_COL")[0].count("Exchange") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
