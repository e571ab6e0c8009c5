"""Classification exports: eligibility, nested answers and flattening."""

import json

import pytest
from pyspark.sql import functions as F

from crowdspark.operators import classifications as c

FILTERS = {"workflow_id": "10337", "version_min": "383.0", "start": "2019-04-01", "end": "2019-12-31", "season": "MAD_S1"}


def export(spark, *changes):
    """One export row per dict of changes to an eligible row."""
    data = []
    for i, change in enumerate(changes):
        row = {
            "classification_id": str(i), "user_name": f"u{i}", "user_id": str(i), "workflow_id": "10337",
            "workflow_version": "383.2", "created_at": "2019-04-02 14:55:29 UTC",
            "metadata": {"live_project": True, "subject_selection_state": {"already_seen": False}},
            "annotations": [{"task": "T0", "value": [{"choice": "ZEBRA", "answers": {}, "filters": {}}]}],
            "subject_data": {f"sub{i}": {"retired": None, "#season": "MAD_S1"}}, "subject_ids": f"sub{i}", **change}
        data.append(tuple(v if isinstance(v, str) else json.dumps(v) for v in row.values()))
    return spark.createDataFrame(data, ", ".join(f"{k} string" for k in row))


def reasons(spark, *changes, **filters):
    rows = c.with_reject_reason(export(spark, *changes), **(filters or FILTERS))
    return [r["reject_reason"] for r in rows.orderBy(F.col("classification_id").cast("int")).collect()]


def test_filters(spark):
    assert reasons(
        spark, {}, {"workflow_id": "1"}, {"workflow_version": "382.9"}, {"workflow_version": "400"},
        {"created_at": "2018-01-01 00:00:00 UTC"}, {"created_at": "2020-01-01 00:00:00 UTC"},
        {"created_at": "2020-04-02T14:55:29"}, {"metadata": {"live_project": False}}, {"metadata": {}},
        {"subject_data": {"sub9": {"#season": "MAD_S2"}}}, {"subject_data": {"sub10": {}}},
        {"metadata": {"subject_selection_state": {"already_seen": True}}}, {"metadata": "{"}, {"annotations": "["},
    ) == [None, "not_eligible_workflow", "not_eligible_workflow", None, "not_in_date_range", "not_in_date_range", None,
          "project_is_not_live", None, "season_does_not_match", "season_does_not_match", "seen_before", "malformed", "malformed"]


def test_without_workflow_every_version_passes(spark):
    assert reasons(spark, {"workflow_id": "x", "workflow_version": "1"}, version_min="400") == [None]


@pytest.mark.parametrize("start, end, passes", [
    ("2019-04-02", None, True), ("2019-04-03", None, False), (None, "2019-04-02", True), (None, "2019-04-01", False),
    ("2019-04-02", "2019-04-02", True), (None, None, True)])
def test_date_range_is_inclusive(spark, start, end, passes):
    assert export(spark, {}).select(c.in_date_range(start, end)).first()[0] is passes


def test_first_classification_of_a_user(spark):
    rows = export(spark, {"user_name": "a", "subject_ids": "s"}, {"user_name": "a", "subject_ids": "s"},
                  {"user_name": "a", "subject_ids": "s", "workflow_id": "2"}, {"user_name": "b", "subject_ids": "s"})
    kept = c.first_classifications(rows, ["classification_id"]).collect()
    assert sorted(r["classification_id"] for r in kept) == ["0", "2", "3"]


def answers(spark, annotations):
    rows = c.explode_classifications(export(spark, {"annotations": annotations}))
    found = rows.orderBy("identification_no").collect()
    return [{a["question"]: a["answers"] for a in r["answers"]} for r in found]


def survey(choice, **given):
    return {"choice": choice, "answers": given, "filters": {}}


def test_survey_answers(spark):
    task = {"task": "T0", "value": [
        survey("GIRAFFE", HOWMANY="1150", WHATBEHAVIORSDOYOUSEE=["EATING", "MOVING"], ARETHEREANYYOUNGPRESENT="NO", DONTCARE="X"),
        survey("LION")]}
    assert answers(spark, [task]) == [
        {"species": ["giraffe"], "count": ["11-50"], "whatbehaviorsdoyousee": ["eating", "moving"], "young_present": ["0"]},
        {"species": ["lion"]}]


def test_question_answers(spark):
    assert answers(spark, [{"task": "T0", "value": "NOANIMALSPRESENT"}]) == [{"species": ["blank"]}]
    assert answers(spark, [{"task": "T0", "value": ["ONGAMETRAIL", "YES"]}]) == [{"species": ["ongametrail"]}, {"species": ["1"]}]
    assert answers(spark, [{"task": "T0", "value": []}]) == []


def test_repeated_main_answer_is_dropped(spark):
    tasks = [{"task": "T0", "value": [survey("NOTHINGHERE", HOWMANY="1"), survey("ZEBRA")]}, {"task": "T1", "value": "NOANIMALSPRESENT"}]
    assert answers(spark, tasks) == [{"species": ["blank"], "count": ["1"]}, {"species": ["zebra"]}]


def test_flat_table_finds_its_columns(spark):
    rows = export(
        spark,
        {"annotations": [{"task": "T0", "value": [survey("ZEBRA", WHATBEHAVIORSDOYOUSEE=["EATING"], HOWMANY="5")]}]},
        {"annotations": [{"task": "T0", "value": [survey("LION", WHATBEHAVIORSDOYOUSEE=["MOVING", "EATING"])]}]},
        {"annotations": [{"task": "T0", "value": "NOANIMALSPRESENT"}]})
    table = c.extract_annotations(rows, ["classification_id"], **FILTERS)
    questions = [q for q in table.columns if q.startswith("question__")]
    assert questions == ["question__species", "question__count", "question__moving", "question__eating"]
    got = {r["subject_id"]: tuple(r[q] for q in questions) for r in table.collect()}
    assert got == {"sub0": ("zebra", "5", "0", "1"), "sub1": ("lion", "", "1", "1"), "sub2": ("blank", "", "", "")}


def test_too_many_columns_are_an_error(spark):
    with pytest.raises(ValueError):
        c.bounded_rows(spark.range(10), limit=9)


def test_reject_stats(spark):
    rows = export(spark, {"user_name": "a", "subject_ids": "s"}, {"user_name": "a", "subject_ids": "s"}, {"workflow_id": "2"})
    stats = {r["reason"]: r["count"] for r in c.reject_stats(rows, workflow_id="10337").collect()}
    assert stats == {"kept": 1, "duplicate": 1, "not_eligible_workflow": 1}


def test_legacy_rows_of_first_classifications_are_exchanged_once(rows):
    """The first classification is found where a user's rows meet, and rows without a user or subject are left out."""
    from crowdspark.operators.legacy import first_classification_rows
    df = rows("user_name subject_id classification_id at species", [
        ("u", "1", "b", "2", "lion"), ("u", "1", "a", "1", "zebra"), ("u", "1", "a", "3", "lion"), ("v", "1", "c", "5", "lion"),
        (None, "1", "d", "1", "lion"), ("v", None, "e", "1", "lion")])
    found = first_classification_rows(df, ["at"])
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") == 1
    assert sorted((r.classification_id, r.species) for r in found.collect()) == [("a", "lion"), ("a", "zebra"), ("c", "lion")]


def test_equal_classifications_are_parsed_once(spark):
    """Statistics over counted texts are those over all rows."""
    values = ['[{"task":"T0","value":[{"choice":"ZEBRA","answers":{}},{"choice":"LION","answers":{}},{"choice":"LION","answers":{}}]}]',
              '[{"task":"T0","value":"LION"}]', "[", "[]"]
    users = [("not-logged-in-1", ""), ("a", "1"), ("b", "2")]
    rows = export(spark, *[{"annotations": values[i % 4], "user_name": users[i % 3][0], "user_id": users[i % 3][1],
                            "workflow_id": str(i % 2)} for i in range(60)])
    plain = c.explode_classifications(rows)

    def counted(*columns):
        equal = c.equal_classifications(rows, columns)
        assert equal.count() <= 12 * len(values) and equal.agg(F.sum("n")).first()[0] == 60
        return c.explode_classifications(equal, [*columns, "n"])

    def same(a, b):
        assert a.count() > 0 and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect())) and a.dtypes == b.select(*a.columns).dtypes

    same(c.answer_stats(c.annotations_long(counted()), "n"), c.answer_stats(c.annotations_long(plain)))
    same(c.workflow_stats(counted("workflow_id", "workflow_version"), "n"), c.workflow_stats(plain))
    people = counted("user_name", "user_id")
    same(c.top_users(people, 2, "n"), c.top_users(plain, 2))
    assert tuple(c.anonymous_count(people, "n").first()) == tuple(c.anonymous_count(plain).first()) == (15, 45)
    assert tuple(c.anonymous_count(people.limit(0), "n").first()) == (0, 0)


def test_only_rows_that_plain_texts_leave_are_parsed(spark):
    good = {"classification_id": "1", "user_name": "u", "user_id": "1", "workflow_id": "10", "workflow_version": "310.1",
            "created_at": "2000-01-01 10:00:00 UTC", "metadata": "{}", "annotations": "[]",
            "subject_data": '{"7":{"#season":"S1"}}', "subject_ids": "7"}
    odd = [{}, {"subject_data": '{"7":{"#season":"\\u0053\\u0031"}}'}, {"subject_data": '{"7":{"#season":"S2"}}'},
           {"subject_data": '{"8":{"#season":"S1"}}'}, {"subject_data": '{"7":{"#season":"S1"'}, {"subject_data": None},
           {"created_at": "1999-12-31 10:00:00 UTC"}, {"created_at": "2001-01-01 00:00:00 UTC"}, {"created_at": "2000-02-30 10:00:00 UTC"},
           {"created_at": "soon"}, {"created_at": None}, {"metadata": "{"}, {"metadata": '{"live_project":false}'},
           {"workflow_id": None}, {"workflow_version": "309.9"}, {"annotations": "["}]
    rows = [good | change | {"user_name": f"u{i}"} for i, change in enumerate(odd)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{name} string" for name in good))
    filters = {"workflow_id": "10", "version_min": "310", "start": "2000-01-01", "end": "2000-12-31"}
    for season in ("S1", "7", None):
        got = c.eligible_classifications(df, ["created_at"], season=season, **filters)
        want = c.with_reject_reason(df, season=season, **filters).where("reject_reason is null")
        names = sorted(r.user_name for r in got.collect())
        assert names == sorted(r.user_name for r in want.collect()) and (season != "S1" or names == ["u0", "u1", "u8", "u9"])
    plan = c.eligible_classifications(df, ["created_at"], season="S1", **filters)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("gettimestamp(") == 1 and "Contains(" in plan
