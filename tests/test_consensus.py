"""Consensus rules on small subjects."""

import random

import pytest
from pyspark.sql import functions as F

from crowdspark.operators import ordering
from crowdspark.operators.consensus import (
    first_n_users, plurality_by_first_n_users, plurality_consensus, question_types,
)


def annotations(spark, votes):
    """``votes``: (user, classification, species, count, standing) in order of appearance."""
    data = [(i, "s1", u, c, s, n, st) for i, (u, c, s, n, st) in enumerate(votes)]
    return spark.createDataFrame(
        data, "ord int, subject_id string, user_name string, classification_id string, question__species string, "
              "question__count string, question__standing string")


def consensus(spark, votes, **options):
    result = plurality_consensus(annotations(spark, votes), ["ord"], **options).collect()
    return {r["question__species"]: r.asDict() for r in result}


def simple(*species):
    return [(f"u{i}", f"c{i}", s, "1" if s != "blank" else "", "") for i, s in enumerate(species)]


def test_plurality_wins(spark):
    result = consensus(spark, simple("zebra", "lion", "zebra"))
    assert {s: r["species_is_plurality_consensus"] for s, r in result.items()} == {"zebra": 1, "lion": 0}
    assert result["zebra"]["n_users_identified_this_species"] == 2
    assert result["zebra"]["p_users_identified_this_species"] == pytest.approx(2 / 3)


def test_tie_goes_to_the_first_named(spark):
    result = consensus(spark, simple("lion", "zebra"))
    assert result["lion"]["species_is_plurality_consensus"] == 1
    assert result["zebra"]["species_is_plurality_consensus"] == 0


def test_blank_needs_a_majority_of_users(spark):
    tie = consensus(spark, simple("blank", "zebra"))
    assert set(tie) == {"zebra"} and tie["zebra"]["species_is_plurality_consensus"] == 1
    blank = consensus(spark, simple("blank", "zebra", "blank"))
    assert {s: r["species_is_plurality_consensus"] for s, r in blank.items()} == {"blank": 1, "zebra": 0}
    assert blank["zebra"]["p_users_identified_this_species"] == pytest.approx(1 / 3)
    assert blank["blank"]["pielous_evenness_index"] == 0


def test_all_blank(spark):
    result = consensus(spark, simple("blank", "blank"))
    assert result["blank"]["n_species_ids_per_user_median"] == 0
    assert result["blank"]["species_is_plurality_consensus"] == 1


def test_several_species_by_high_median(spark):
    votes = [("u1", "c1", "zebra", "1", ""), ("u1", "c1", "lion", "1", ""), ("u2", "c2", "zebra", "1", ""),
             ("u2", "c2", "lion", "1", ""), ("u3", "c3", "zebra", "1", ""), ("u4", "c4", "giraffe", "1", "")]
    result = consensus(spark, votes)
    # 2, 2, 1, 1 species per user: the high median is 2
    assert result["zebra"]["n_species_ids_per_user_median"] == 2
    assert [s for s, r in result.items() if r["species_is_plurality_consensus"]] == ["zebra", "lion"] or \
        {s for s, r in result.items() if r["species_is_plurality_consensus"]} == {"zebra", "lion"}
    assert result["zebra"]["pielous_evenness_index"] == pytest.approx(0.9206, abs=1e-3)


def test_counts(spark):
    votes = [(f"u{i}", f"c{i}", "zebra", n, "") for i, n in enumerate(["1", "2", "11-50", "51+"])]
    result = consensus(spark, votes)["zebra"]
    assert (result["question__count_median"], result["question__count_min"], result["question__count_max"]) == ("11-50", "1", "51+")


def test_empty_counts_are_zero_and_print_empty(spark):
    votes = [("u1", "c1", "zebra", "", ""), ("u2", "c2", "zebra", "3", "")]
    result = consensus(spark, votes)["zebra"]
    assert (result["question__count_min"], result["question__count_max"]) == ("", "3")


def test_proportions(spark):
    votes = [("u1", "c1", "zebra", "1", "1"), ("u2", "c2", "zebra", "1", "0"), ("u3", "c3", "zebra", "1", ""),
             ("u4", "c4", "lion", "1", "")]
    result = consensus(spark, votes)
    assert result["zebra"]["question__standing"] == pytest.approx(1 / 3)
    assert result["lion"]["question__standing"] is None


def test_text_decimals_and_consensus_only(spark):
    result = consensus(spark, simple("zebra", "lion", "zebra"), consensus_only=True, text_decimals=True)
    assert set(result) == {"zebra"}
    assert result["zebra"]["p_users_identified_this_species"] == "0.67"
    assert result["zebra"]["question__standing"] == ""


def test_order_of_rows_does_not_matter(spark):
    votes = simple("lion", "zebra", "zebra", "lion", "giraffe")
    first = plurality_consensus(annotations(spark, votes), ["ord"]).collect()
    shuffled = annotations(spark, votes).repartition(3).orderBy(F.desc("ord"))
    assert sorted(first) == sorted(plurality_consensus(shuffled, ["ord"]).collect())


def test_first_users(spark):
    votes = simple("lion", "zebra", "zebra") + [("u0", "c9", "lion", "1", "")]
    kept = first_n_users(annotations(spark, votes), 2, ["ord"]).collect()
    assert sorted((r["user_name"], r["user_rank"]) for r in kept) == [("u0", 1), ("u0", 1), ("u1", 2)]


def test_question_types():
    types = question_types(["question__species", "question__count", "question__horns_count", "question__moving"])
    assert list(types.values()) == ["main", "count", "count", "prop"]


def many_votes(spark, n=400):
    """Subjects of 1 to 60 rows with repeated users, blanks and empty counts."""
    rng = random.Random(8)
    rows = []
    for i in range(n):
        user = f"u{rng.randint(0, 12)}"
        species = rng.choice(["zebra", "lion", "blank", "giraffe"])
        subject = f"s{min(rng.randint(0, 9), rng.randint(0, 9))}"
        rows.append((i, subject, user, f"{subject}-{user}", species, rng.choice(["", "1", "3", "11-50", "51+"]),
                     rng.choice(["", "0", "1"])))
    return spark.createDataFrame(
        rows, "ord int, subject_id string, user_name string, classification_id string, question__species string, "
              "question__count string, question__standing string")


@pytest.mark.parametrize("n_users", [(), (1, 3, 7)])
def test_hot_subjects_take_another_way_to_the_same_result(spark, n_users):
    rows = many_votes(spark)
    plain = plurality_consensus(rows, ["ord"], hot_group_rows=None, n_users=n_users)
    split = plurality_consensus(rows, ["ord"], hot_group_rows=50, n_users=n_users)
    assert plain.columns == split.columns and plain.count() > 20
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_one_scan_and_one_exchange(spark, tmp_path):
    path = str(tmp_path / "rows")
    many_votes(spark).write.parquet(path)
    for n_users in ((), (1, 2, 3, 4, 5)):
        plan = plurality_consensus(spark.read.parquet(path), ["ord"], n_users=n_users)._jdf.queryExecution().toString()
        plan = plan[plan.index("Physical Plan"):]
        assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_first_users_match_the_consensus_of_their_rows(spark):
    rows = many_votes(spark)
    whole = plurality_by_first_n_users(rows, [2, 5], ["ord"])
    for n in (2, 5):
        want = plurality_consensus(first_n_users(rows, n, ["ord"]).drop("user_rank"), ["ord"])
        got = whole.where(F.col("max_users_used") == n).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("n_users", [(), (1, 3)])
def test_tasks_grow_with_the_rows(spark, monkeypatch, n_users):
    data = [(i, f"s{i % 90}", f"u{i % 7}", f"c{i}", "zebra" if i % 3 else "lion", "1", "1") for i in range(900)]
    rows = spark.createDataFrame(data, "ord int, subject_id string, user_name string, classification_id string, "
                                       "question__species string, question__count string, question__standing string")
    few = plurality_consensus(rows, ["ord"], n_users=n_users)
    monkeypatch.setattr(ordering, "ROWS_PER_TASK", 60, raising=False)
    many = plurality_consensus(rows, ["ord"], n_users=n_users)
    assert many.rdd.getNumPartitions() >= 900 * max(1, len(n_users)) // 60
    assert sorted(map(tuple, many.collect()), key=str) == sorted(map(tuple, few.collect()), key=str)
