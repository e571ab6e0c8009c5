"""Queries of the classification operators over ``lineitem`` as a JSON export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.operators import classifications
from crowdspark.plans.registry import query
from crowdspark.plans.sql_views import REQUIRES, VIEWS
from crowdspark.plans.tables import Tables

ORDER = ("created_at", "classification_id", "price")
FILTERS = {"workflow_id": "10", "version_min": "310.5", "start": "1996-01-01", "end": "2000-12-31", "season": "S1"}
SINGLE, MULTI = ("species", "count", "young_present"), {"whatbehaviorsdoyousee": ("eating", "moving")}

VIEWS["v_reasons"] = """
SELECT *, CASE WHEN NOT (workflow_id = '10' AND version >= 310) THEN 'not_eligible_workflow'
  WHEN day < DATE '1996-01-01' OR day > DATE '2000-12-31' THEN 'not_in_date_range'
  WHEN NOT live THEN 'project_is_not_live' WHEN season <> 'S1' THEN 'season_does_not_match'
  WHEN seen THEN 'seen_before' END AS reject_reason FROM v_classifications"""
REQUIRES["v_reasons"] = ["v_classifications"]
VIEWS["v_eligible"] = """
SELECT * FROM v_reasons WHERE reject_reason IS NULL
QUALIFY row_number() OVER (PARTITION BY user_name, subject_ids, workflow_id ORDER BY created_at, classification_id, price) = 1"""
REQUIRES["v_eligible"] = ["v_reasons"]


def exploded(t: Tables, *columns: str) -> DataFrame:
    """Identifications with ``columns``, those of equal classifications once, with their number ``n``."""
    rows = classifications.equal_classifications(t.classifications, columns)
    return classifications.explode_classifications(rows, [*columns, "n"])


@query("v_reasons", """
SELECT classification_id, price, coalesce(reject_reason, 'passed') AS reject_reason FROM v_reasons""")
def reject_reasons(t: Tables) -> DataFrame:
    """The first filter each classification fails."""
    rows = classifications.with_reject_reason(t.classifications, **FILTERS)
    return rows.select("classification_id", "price", F.coalesce("reject_reason", F.lit("passed")).alias("reject_reason"))


@query("v_reasons v_eligible", """
SELECT reject_reason AS reason, count(*) AS count FROM v_reasons WHERE reject_reason IS NOT NULL GROUP BY 1
UNION ALL SELECT 'kept', (SELECT count(*) FROM v_eligible)
UNION ALL SELECT 'duplicate', count(*) - (SELECT count(*) FROM v_eligible) FROM v_reasons WHERE reject_reason IS NULL""")
def reject_stats(t: Tables) -> DataFrame:
    """rows per reject reason."""
    return classifications.reject_stats(t.classifications, **FILTERS)


@query("v_eligible", "SELECT classification_id, user_name, subject_ids, workflow_id, workflow_version, created_at, price FROM v_eligible")
def eligible_classifications(t: Tables) -> DataFrame:
    """Eligible classifications, the first of each user, subject and workflow."""
    return classifications.eligible_classifications(t.classifications, ORDER, **FILTERS).select(
        "classification_id", "user_name", "subject_ids", "workflow_id", "workflow_version", "created_at", "price")


@query("v_eligible v_extracted", """
SELECT e.classification_id, e.user_name, e.user_id, e.created_at, e.subject_ids AS subject_id, e.workflow_id,
  e.workflow_version, identification_no, species AS question__species, animals AS question__count,
  young_present AS question__young_present, eating AS question__eating, moving AS question__moving
FROM v_eligible e JOIN v_extracted x ON e.classification_id = x.classification_id AND e.price = x.price""")
def extract_annotations(t: Tables) -> DataFrame:
    """Annotation table of the eligible classifications."""
    return classifications.extract_annotations(t.classifications, ORDER, SINGLE, MULTI, **FILTERS)


@query("v_extracted", """
SELECT question, answer, count(*) AS count, CAST(sum(count(*)) OVER (PARTITION BY question) AS BIGINT) AS total,
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY question), 2) AS percent
FROM (SELECT 'species' AS question, species AS answer FROM v_extracted
  UNION ALL SELECT 'count', animals FROM v_extracted WHERE animals <> ''
  UNION ALL SELECT 'young_present', young_present FROM v_extracted WHERE young_present <> ''
  UNION ALL SELECT 'whatbehaviorsdoyousee', 'eating' FROM v_extracted WHERE eating = '1'
  UNION ALL SELECT 'whatbehaviorsdoyousee', 'moving' FROM v_extracted WHERE moving = '1')
GROUP BY question, answer""")
def annotation_answer_stats(t: Tables) -> DataFrame:
    """Answers of each question over all classifications."""
    return classifications.answer_stats(classifications.annotations_long(exploded(t)), "n")


@query("v_extracted", """
SELECT question, answer, CAST(question = 'whatbehaviorsdoyousee' AS INTEGER) AS is_multi
FROM (SELECT 'species' AS question, species AS answer FROM v_extracted
  UNION SELECT 'count', animals FROM v_extracted WHERE animals <> ''
  UNION SELECT 'young_present', young_present FROM v_extracted WHERE young_present <> ''
  UNION SELECT 'whatbehaviorsdoyousee', 'eating' FROM v_extracted WHERE eating = '1'
  UNION SELECT 'whatbehaviorsdoyousee', 'moving' FROM v_extracted WHERE moving = '1')""")
def question_answer_domain(t: Tables) -> DataFrame:
    """Different answers and type of each question."""
    domain = classifications.question_domain(classifications.annotations_long(exploded(t)))
    return domain.withColumn("is_multi", F.col("is_multi").cast("int"))


@query("v_extracted", """
SELECT workflow_id, workflow_version, count(*) AS count FROM v_extracted GROUP BY ALL""")
def workflow_stats(t: Tables) -> DataFrame:
    """Identifications of each workflow and version."""
    return classifications.workflow_stats(exploded(t, "workflow_id", "workflow_version"), "n")


@query("v_extracted", """
SELECT count(*) FILTER (user_id = '') AS not_logged_in, count(*) AS total FROM v_extracted""")
def anonymous_count(t: Tables) -> DataFrame:
    """Identifications of users that were not logged in."""
    return classifications.anonymous_count(exploded(t, "user_name", "user_id"), "n")


@query("v_extracted", """
SELECT user_name, count(*) AS count FROM v_extracted WHERE user_id <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_users(t: Tables) -> DataFrame:
    """O3: the ten most active users."""
    return classifications.top_users(exploded(t, "user_name", "user_id"), 10, "n")


@query("v_classifications", """
SELECT classification_id, price, task_no, 'T' || task_no AS task,
  CASE WHEN kind IN ('AF', 'AO') OR (kind = 'RO' AND task_no = 1) THEN 'survey_task' ELSE 'question_task' END AS task_type,
  CAST(kind <> 'NO' AS INTEGER) AS is_completed
FROM v_classifications JOIN (SELECT 0 AS task_no UNION ALL SELECT 1) ON task_no = 0 OR kind = 'RO'""")
def task_overview(t: Tables) -> DataFrame:
    """Type and completion of every task."""
    tasks = classifications.task_overview(t.classifications, ["classification_id", "price"])
    return tasks.withColumn("is_completed", F.col("is_completed").cast("int"))


@query("v_classifications", """
SELECT classification_id, price, workflow_version FROM v_classifications WHERE workflow_id = '11' AND season = 'S0'""")
def match_conditions(t: Tables) -> DataFrame:
    """Equality of several columns."""
    season = classifications.subject_season(F.col("subject_data"), F.col("subject_ids"))
    rows = t.classifications.withColumn("season", season)
    return rows.where(classifications.match_conditions({"workflow_id": "11", "season": "S0"})).select(
        "classification_id", "price", "workflow_version")
