"""Large groups of near copies in the n-gram join: one pair for each crowded shingle first, and no link is lost."""

import random

import pytest
from pyspark.sql import functions as F

from crowdspark.llm import ngram_join
from tests.llm.test_operators import documents, prose


def near_copies(n=70, seed=4):
    """Copies of one text with some words replaced: links between some, others left apart; and a few strangers."""
    rng = random.Random(seed)
    base = prose(1, 150).split()
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
        rows.append((1000 - i, " ".join(words)))
    return rows + [(i, prose(50 + i, 80)) for i in range(5)] + [(900, rows[3][1]), (2000, None), (2001, "")]


def plain_components(rows, n_words, percent):
    sets = {}
    for i, text in rows:
        words = (text or "").split()
        sets[i] = {tuple(words[k:k + n_words]) for k in range(max(1, len(words) - n_words + 1))} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets.items())


@pytest.mark.parametrize("crowd", [2, 16, 10**9])
def test_crowds_keep_every_link(spark, monkeypatch, crowd):
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    monkeypatch.setattr(ngram_join, "LEADERS", 1)
    rows = near_copies()
    got = sorted(tuple(r) for r in ngram_join.near_duplicates(documents(spark, rows), 4, 85).collect())
    assert got == plain_components(rows, 4, 85)


def test_ids_as_wide_as_a_decimal(spark):
    docs = documents(spark, [(1, prose(3)), (2, prose(3)), (3, prose(4))]).withColumn(
        "doc_id", F.expr("cast(doc_id as decimal(38,0)) + 100000000000000000000000000000"))
    got = sorted((int(r.doc_id) % 10, int(r.component_id) % 10) for r in ngram_join.near_duplicates(docs).collect())
    assert got == [(1, 1), (2, 1), (3, 3)]


@pytest.mark.parametrize("bitmaps", [4096, 0])
def test_first_rows_of_equal_sets(spark, monkeypatch, bitmaps):
    monkeypatch.setattr(ngram_join, "BITMAPS", bitmaps)
    rows = spark.range(0, 70000, 1, 3).select(
        (F.shiftleft(F.spark_partition_id().cast("long"), 36) + F.col("id") % 40000).alias("row"), F.lit("wide").alias("prefix"))
    one = rows.where("row % 7 in (0, 3) or row < 9").select(F.col("row").alias("set_id"))
    got = sorted(tuple(r) for r in ngram_join.first_rows(rows, one).collect())
    assert got == sorted((r.set_id, "wide") for r in one.collect()) and len(got) > 20000


def plan_without_broadcasts(spark, make):
    """The physical plan of ``make()`` in a session that broadcasts nothing by itself."""
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in plain}
    try:
        for key, value in plain.items():
            spark.conf.set(key, value)
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_descriptions_are_not_exchanged(spark):
    docs = documents(spark, near_copies())
    described = ngram_join.written(ngram_join.describe_sets(docs, ngram_join.shingle_frequencies(docs)), "sets")
    one = described.where("name is not null").groupBy("name").agg(F.min("row").alias("set_id"))
    plan = plan_without_broadcasts(spark, lambda: ngram_join.first_rows(described, one))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_postings_are_exchanged_once(spark, monkeypatch):
    sketch = ", ".join(f"id * {i + 3} as p{i}" for i in range(ngram_join.SKETCH))
    mixed = ngram_join.written(spark.range(40).selectExpr(
        "id as set_id", "id % 3 as shingle", "0 as at", "id as g", "20L as n", *sketch.split(", ")), "postings")
    monkeypatch.setattr(ngram_join, "written", lambda df, name: df)
    monkeypatch.setattr(ngram_join, "wide_near", lambda pairs, sets, percent: pairs)
    plan = plan_without_broadcasts(spark, lambda: ngram_join.prefix_pairs(mixed, None, 85))
    assert plan.count("- Exchange hashpartitioning(shingle") == 1 and "ReusedExchange" in plan
