"""Queries of the consensus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.operators import consensus
from crowdspark.plans.registry import query
from crowdspark.plans.sql_views import REQUIRES, VIEWS
from crowdspark.plans.tables import ANNOTATION_ORDER, Tables


def consensus_sql(source: str, keys: str) -> str:
    """The consensus of an annotation view, as common table expressions ending in ``v_consensus``."""
    same = " AND ".join(f"s.{k} = u.{k}" for k in keys.split(", "))
    columns = ", ".join(f"s.{k}" for k in keys.split(", "))
    answers = ""
    for mode, aggregate in (("median", "percentile_disc(0.5) WITHIN GROUP (ORDER BY n_animals DESC)"),
                            ("min", "min(n_animals)"), ("max", "max(n_animals)")):
        answers += f""",
        CASE {aggregate} WHEN 0 THEN '' WHEN 11 THEN '11-50' WHEN 12 THEN '51+'
          ELSE CAST({aggregate} AS VARCHAR) END AS question__count_{mode}"""
    for q in ("standing", "young_present"):
        answers += f""",
        CASE WHEN count(*) FILTER (question__{q} <> '') > 0
          THEN count(*) FILTER (question__{q} = '1') / count(*)::DOUBLE END AS question__{q}"""
    return f"""
    SELECT {columns}, s.question__species, question__count_median, question__count_min, question__count_max,
      question__standing, question__young_present, n_users_identified_this_species,
      n_users_identified_this_species / CASE WHEN is_empty THEN n_classifications ELSE n_users_saw_a_species END::DOUBLE
        AS p_users_identified_this_species,
      n_species_ids_per_user_median, n_species_ids_per_user_max, n_users_classified_this_subject,
      n_users_saw_a_species, n_users_classified_this_subject - n_users_saw_a_species AS n_users_saw_no_species,
      n_users_saw_a_species / n_users_classified_this_subject::DOUBLE AS p_users_saw_a_species,
      CASE WHEN is_empty OR count(*) OVER p < 2 THEN 0.0
        ELSE ln(sum(n_users_identified_this_species) OVER p)
          / ln(count(*) OVER p) - sum(n_users_identified_this_species * ln(n_users_identified_this_species)) OVER p
          / (sum(n_users_identified_this_species) OVER p) / ln(count(*) OVER p) END AS pielous_evenness_index,
      CAST(CASE WHEN is_empty THEN s.question__species = 'blank'
        ELSE row_number() OVER (p ORDER BY n_rows DESC, first_seen) <= n_species_ids_per_user_median END AS INTEGER)
        AS species_is_plurality_consensus
    FROM (
      SELECT {keys}, question__species, count(DISTINCT classification_id) AS n_users_identified_this_species,
        count(*) AS n_rows, min(row(created_at, line_no, part_no, price, quantity)) AS first_seen{answers}
      FROM (SELECT *, CASE question__count WHEN '' THEN 0 WHEN '11-50' THEN 11 WHEN '51+' THEN 12
              ELSE CAST(question__count AS INTEGER) END AS n_animals FROM {source})
      GROUP BY {keys}, question__species) s
    JOIN (
      SELECT u.*, c.n_classifications,
        u.n_users_classified_this_subject - n_users_saw_a_species > n_users_saw_a_species AS is_empty
      FROM (
        SELECT {keys}, count(*) AS n_users_classified_this_subject,
          count(*) FILTER (n_species > 0) AS n_users_saw_a_species,
          CAST(coalesce(max(n_species), 0) AS INTEGER) AS n_species_ids_per_user_max,
          CAST(coalesce(percentile_disc(0.5) WITHIN GROUP (ORDER BY CASE WHEN n_species > 0 THEN n_species END DESC), 0)
            AS INTEGER) AS n_species_ids_per_user_median
        FROM (SELECT {keys}, user_name, count(*) FILTER (question__species <> 'blank') AS n_species
              FROM {source} GROUP BY {keys}, user_name)
        GROUP BY {keys}) u
      JOIN (SELECT {keys}, count(DISTINCT classification_id) AS n_classifications FROM {source} GROUP BY {keys}) c
        USING ({keys})) u ON {same}
    WHERE is_empty OR s.question__species <> 'blank'
    WINDOW p AS (PARTITION BY {columns})"""


VIEWS["v_consensus"] = consensus_sql("v_annotations", "subject_id")
REQUIRES["v_consensus"] = ["v_annotations"]

ROUNDED = ["p_users_identified_this_species", "p_users_saw_a_species", "pielous_evenness_index"]


def rounded(df: DataFrame, columns=ROUNDED, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("v_consensus", """
SELECT * REPLACE (round(p_users_identified_this_species, 6) AS p_users_identified_this_species,
  round(p_users_saw_a_species, 6) AS p_users_saw_a_species, round(abs(pielous_evenness_index), 6) AS pielous_evenness_index)
FROM v_consensus""")
def plurality_consensus(t: Tables) -> DataFrame:
    """Consensus species, votes, users, counts, proportions and evenness of every subject."""
    return rounded(consensus.plurality_consensus(t.annotations, ANNOTATION_ORDER))
