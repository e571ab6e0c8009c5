"""Captures, hot groups and actions on small inventories."""

import pytest
from pyspark.sql import functions as F

from crowdspark.operators import actions, captures, ordering, quality, structure
from crowdspark.sources.writers import first_then_rest


def inventory(spark, images):
    """``images``: (roll, path, seconds)."""
    rows = spark.createDataFrame([("S1", "A1", r, f"{p}.JPG", f"/x/{p}.JPG", f"S1/{p}.JPG", s) for r, p, s in images],
                                 "season string, site string, roll string, image_name_original string, "
                                 "image_path_original string, image_path_original_rel string, s int")
    start = F.lit("2017-10-26 10:38:31").cast("timestamp_ntz")
    return rows.select("*", (start + F.make_dt_interval(secs=F.col("s"))).alias("datetime")).drop("s")


IMAGES = [("1", "a", 0), ("1", "b", 5), ("1", "c", 11), ("1", "d", 11), ("1", "e", 100), ("2", "f", 3), ("1", "g", 14)]


def test_captures(spark):
    result = captures.capture_inventory(inventory(spark, IMAGES)).collect()
    got = {r["image_name_original"][0]: (r["capture"], r["image_rank_in_capture"], r["image_rank_in_roll"]) for r in result}
    # a gap of exactly five seconds stays in the capture
    assert got == {"a": (1, 1, 1), "b": (1, 2, 2), "c": (2, 1, 3), "d": (2, 2, 4), "g": (2, 3, 5), "e": (3, 1, 6), "f": (1, 1, 1)}
    names = {r["image_name_original"][0]: (r["image_name"], r["image_path"], r["image_path_rel"], r["capture_id"]) for r in result}
    assert names["e"] == ("S1_A1_R1_IMAG0006.JPG", "/x/S1_A1_R1_IMAG0006.JPG", "S1/S1_A1_R1_IMAG0006.JPG", "S1#A1#1#3")


@pytest.mark.parametrize("limit", [1, 3, 100])
def test_hot_groups_give_the_same_captures(spark, limit):
    many = [("1", f"p{i:03d}", (i * i * 7) % 997) for i in range(200)] + [("2", f"q{i}", 4 * i) for i in range(50)]
    plain = captures.group_into_captures(inventory(spark, many), hot_group_rows=10_000)
    split = captures.group_into_captures(inventory(spark, many), hot_group_rows=limit)
    assert sorted(plain.collect()) == sorted(split.select(*plain.columns).collect())


def test_positions_of_hot_groups(spark):
    df = spark.range(500).select((F.col("id") % 3 == 0).alias("k"), (F.col("id") * 37 % 501).alias("v"))
    plain = ordering.group_positions(df, ["k"], ["v"], hot_group_rows=10_000)
    split = ordering.group_positions(df, ["k"], ["v"], hot_group_rows=200)
    assert sorted(plain.collect()) == sorted(split.collect())
    everything = ordering.group_positions(df, [], ["v", "k"], hot_group_rows=10)
    assert sorted(r["position"] for r in everything.collect()) == list(range(1, 501))


def test_time_checks(spark):
    images = inventory(spark, [("1", f"p{i}", i) for i in range(5)] + [("1", "late", 40 * 86400)])
    result = captures.capture_inventory(images, max_year=2016).collect()
    too_many = [r["image_name_original"] for r in result if r["image_check__captures_with_too_many_images"]]
    assert sorted(too_many) == ["p3.JPG", "p4.JPG"]
    assert [r["image_name_original"] for r in result if r["image_check__time_lapse"]] == ["p4.JPG"]
    assert all(r["image_check__time_too_new"] for r in result) and not any(r["image_check__time_too_old"] for r in result)


def action_list(spark, *actions_given):
    columns = ["action_site", "action_roll", "action_from_image", "action_to_image", "action_to_take",
               "action_to_take_reason", "datetime_current", "datetime_new"]
    data = [(i, *[a.get(c, "") for c in columns]) for i, a in enumerate(actions_given)]
    return spark.createDataFrame(data, "action_no int, " + ", ".join(f"{c} string" for c in columns))


def prepared(spark):
    return captures.capture_inventory(inventory(spark, IMAGES))


def test_actions_end_to_end(spark):
    images = prepared(spark)
    listed = action_list(
        spark,
        {"action_from_image": "S1_A1_R1_IMAG0001.JPG", "action_to_image": "S1_A1_R1_IMAG0002.JPG", "action_to_take": "timechange",
         "action_to_take_reason": "clock", "datetime_current": "2017-10-26 10:38:31", "datetime_new": "2017-10-27 10:38:31"},
        {"action_from_image": "S1_A1_R1_IMAG0003.JPG", "action_to_image": "S1_A1_R1_IMAG0003.JPG", "action_to_take": "delete",
         "action_to_take_reason": "test"},
        {"action_site": "A1", "action_roll": "2", "action_to_take": "invalidate", "action_to_take_reason": "human"},
        {"action_site": "A1", "action_to_take": "ok", "action_to_take_reason": "seen"})
    assert actions.validate_actions(listed).count() == 0
    generated = actions.generate_actions(listed, images)
    assert generated.groupBy("action").count().collect().__len__() == 4
    done = {r["image_name"]: r for r in actions.apply_actions(images, generated).collect()}
    assert str(done["S1_A1_R1_IMAG0001.JPG"]["datetime"]) == "2017-10-27 10:38:31"
    assert done["S1_A1_R1_IMAG0001.JPG"]["action_taken"] == "timechange#ok"
    assert done["S1_A1_R1_IMAG0003.JPG"]["image_was_deleted"] == "1" and done["S1_A1_R1_IMAG0003.JPG"]["image_no_upload"] == "1"
    assert done["S1_A1_R2_IMAG0001.JPG"]["image_is_invalid"] == "1" and done["S1_A1_R2_IMAG0001.JPG"]["image_was_deleted"] == ""
    # after the actions the capture numbers have no gaps
    again = captures.regroup_after_actions(actions.apply_actions(images, generated)).collect()
    assert len(again) == len(IMAGES) - 1
    assert sorted({r["capture"] for r in again if r["roll"] == "1"}) == [1, 2, 3]


def test_range_crosses_rolls_and_reports_problems(spark):
    images = prepared(spark)
    forward = action_list(spark, {"action_from_image": "S1_A1_R1_IMAG0005.JPG", "action_to_image": "S1_A1_R2_IMAG0001.JPG",
                                  "action_to_take": "delete", "action_to_take_reason": "x"})
    found = actions.generate_actions(forward, images).select("image").collect()
    assert sorted(r["image"] for r in found) == ["S1_A1_R1_IMAG0005.JPG", "S1_A1_R1_IMAG0006.JPG", "S1_A1_R2_IMAG0001.JPG"]
    backward = action_list(spark, {"action_from_image": "S1_A1_R2_IMAG0001.JPG", "action_to_image": "S1_A1_R1_IMAG0005.JPG"},
                           {"action_from_image": "S1_A1_R1_IMAG0001.JPG", "action_to_image": "none"})
    problems = {r["action_no"]: r["problem"] for r in actions.range_problems(backward, images).collect()}
    assert problems == {0: "last image of range precedes the first", 1: "image of range is unknown"}
    assert actions.images_for_range(backward, images).count() == 0


def test_repeated_and_unknown_actions(spark):
    images = prepared(spark)
    shift = {"action_site": "A1", "action_to_take": "timechange", "action_to_take_reason": "x",
             "datetime_current": "2000-01-01 00:01:00", "datetime_new": "2000-01-01 00:00:00"}
    with pytest.raises(ValueError, match="several time changes"):
        actions.generate_actions(action_list(spark, shift, shift), images)
    generated = actions.generate_actions(action_list(spark, shift, shift), images, check=False)
    assert {r["shift_time_by_seconds"] for r in generated.collect()} == {-60.0}
    assert all(r["is_error"] for r in actions.repeated_actions(generated).collect())
    single = action_list(spark, {"action_from_image": "none", "action_to_image": "none", "action_to_take": "ok",
                                 "action_to_take_reason": "x"})
    assert actions.unknown_images(actions.generate_actions(single, images), images).count() == 1


def test_proposed_actions(spark):
    images = prepared(spark).withColumns({
        "image_check__all_black": (F.col("image_rank_in_roll") == 1).cast("int"),
        "image_check__corrupt_file": (F.col("image_rank_in_roll") == 2).cast("int"),
        "action_taken": F.when(F.col("image_rank_in_roll") == 1, "invalidate#ok").otherwise("")})
    proposed = quality.propose_actions(images).collect()
    assert [(r["image_name"], r["action_to_take"], r["action_to_take_reason"]) for r in proposed] == [
        ("S1_A1_R1_IMAG0002.JPG", "delete", "corrupt_file")]


def test_structure(rows):
    files = rows("path", [("/r/A1/A1_R1/x.JPG",), ("/r/A-1/A-1_R1/x.JPG",), ("/r/A1/A2_R1/x.png",), ("/r/A1/A1_r1/x.JPG",)])
    problems = sorted(tuple(r) for r in structure.structure_report(files).collect())
    assert problems == sorted([
        ("/r/A-1/A-1_R1/x.JPG", "site folder must be alphanumeric"),
        ("/r/A-1/A-1_R1/x.JPG", "roll folder must be <site>_R<number>"),
        ("/r/A1/A2_R1/x.png", "roll folder does not start with its site"),
        ("/r/A1/A2_R1/x.png", "file must end in .jpg"),
        ("/r/A1/A1_r1/x.JPG", "roll folder must be <site>_R<number>")])


def test_column_order():
    assert first_then_rest(["c", "a", "b"], ["a", "x"]) == ["a", "c", "b"]
