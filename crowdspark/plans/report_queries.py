"""Queries of the subject, report, prediction and manifest operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.operators import consensus, manifests, predictions, reports, subjects
from crowdspark.plans.capture_queries import checked, flagged
from crowdspark.plans.consensus_queries import consensus_sql
from crowdspark.plans.registry import query
from crowdspark.plans.sql_views import REQUIRES, VIEWS
from crowdspark.plans.tables import ANNOTATION_ORDER, Tables, text
from crowdspark.sources.readers import parse_subjects

VIEWS["v_subjects"] = """
SELECT CAST(o_orderkey // 2 AS VARCHAR) AS subject_id, o_orderkey, o_custkey, 'S' || (year(o_orderdate) - 1994) AS season,
  'C' || (o_custkey % 50) AS site, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey % 3 + 1 AS VARCHAR) ELSE '' END AS roll,
  CAST(o_orderkey AS VARCHAR) AS capture,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'OR#C' || (o_custkey % 50) || '#' || o_orderkey ELSE '' END AS capture_id,
  o_orderstatus AS retirement_reason, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S UTC') AS retired_at
FROM orders"""
VIEWS["v_order_captures"] = """
SELECT 'OR#Q' || (o_orderkey % 7) || '#1#' || o_orderkey AS capture_id, 'OR' AS season, 'Q' || (o_orderkey % 7) AS site,
  '1' AS roll, CAST(o_orderkey AS VARCHAR) AS capture, strftime(o_orderdate, '%Y-%m-%d') AS capture_date_local FROM orders"""
VIEWS["v_aggregated"] = """
SELECT *, 'OR#Q' || ((CAST(subject_id AS BIGINT) - CAST(subject_id AS BIGINT) % 2) % 7) || '#1#'
  || (CAST(subject_id AS BIGINT) - CAST(subject_id AS BIGINT) % 2) AS capture_id FROM v_consensus"""
REQUIRES["v_aggregated"] = ["v_consensus"]
VIEWS["v_winners"] = """
SELECT * FROM v_aggregated WHERE subject_id NOT IN (
  SELECT a.subject_id FROM v_aggregated a JOIN (SELECT capture_id, min(subject_id) AS first_subject
    FROM v_aggregated GROUP BY capture_id) f USING (capture_id) WHERE a.subject_id <> f.first_subject)"""
REQUIRES["v_winners"] = ["v_aggregated"]
VIEWS["v_report"] = """
SELECT c.*, coalesce(w.subject_id, '') AS subject_id, coalesce(question__species, '') AS question__species,
  coalesce(question__count_median, '') AS question__count_median,
  coalesce(CAST(species_is_plurality_consensus AS VARCHAR), '') AS species_is_plurality_consensus,
  coalesce(CAST(n_users_saw_a_species AS VARCHAR), '') AS n_users_saw_a_species
FROM v_order_captures c LEFT JOIN v_winners w USING (capture_id)
WHERE w.subject_id IS NULL OR (species_is_plurality_consensus = 1 AND question__species <> 'human'
  AND question__species <> 'blank')"""
REQUIRES["v_report"] = ["v_order_captures", "v_winners"]
SCORE = "CAST(CAST(floor(abs(CAST(embedding[{}] AS DOUBLE)) * 1000) AS BIGINT) AS VARCHAR)"
VIEWS["v_flat"] = "SELECT vec_id, label, 'EM#' || label || '#1#' || vec_id AS capture_id, embedding[1] > 0 AS eats, " \
    "embedding[8] > 0 AS blank, vec_id % 3 <> 0 AS has_empty, vec_id % 2 = 0 AS by_empty, " \
    + ", ".join(f"{SCORE.format(i + 1)} AS s{i}" for i in range(9)) + " FROM embeddings"
FLAT_COLUMNS = (
    "machine_topprediction_species", "machine_topprediction_eating", "machine_topconfidence_species",
    "machine_topconfidence_eating", "machine_confidence_species_l0", "machine_confidence_species_l1",
    "machine_confidence_species_l2", "machine_confidence_eating", "machine_confidence_empty",
    "machine_confidence_species", "machine_topprediction_is_empty", "machine_confidence_is_empty",
)
FLAT_SQL = """'l' || label AS machine_topprediction_species, CASE WHEN eats THEN '1' ELSE '0' END AS machine_topprediction_eating,
  s0 AS machine_topconfidence_species, s1 AS machine_topconfidence_eating, s0 AS machine_confidence_species_l0,
  s1 AS machine_confidence_species_l1, s2 AS machine_confidence_species_l2, s4 AS machine_confidence_eating,
  CASE WHEN has_empty AND by_empty THEN s5 ELSE '' END AS machine_confidence_empty,
  CASE WHEN has_empty AND by_empty THEN s6 ELSE '' END AS machine_confidence_species,
  CASE WHEN has_empty AND NOT by_empty THEN CASE WHEN blank THEN 'empty' ELSE 'not_empty' END ELSE '' END
    AS machine_topprediction_is_empty,
  CASE WHEN has_empty AND NOT by_empty THEN s8 ELSE '' END AS machine_confidence_is_empty"""
REPORT_FILTERS = {"exclude_non_consensus": True, "exclude_humans": True, "exclude_blanks": True}


def aggregated(t: Tables) -> DataFrame:
    columns = ["subject_id", "question__species", "question__count_median", "n_users_saw_a_species",
               "species_is_plurality_consensus"]
    result = consensus.plurality_consensus(t.annotations, ANNOTATION_ORDER)
    return t.with_capture(result.select(*columns))


def winners(t: Tables) -> DataFrame:
    return reports.deduplicate_captures(aggregated(t), ["subject_id"])


def report(t: Tables) -> DataFrame:
    return reports.species_report(t.order_captures, winners(t), **REPORT_FILTERS)


def flat_predictions(t: Tables) -> DataFrame:
    return predictions.combine_predictions(t.empty_predictions, t.species_predictions)


# --- consensus over the first users, and its statistics -------------------------------------------

@query("v_annotations", f"""
WITH firsts AS (
  SELECT subject_id, user_name, row_number() OVER (PARTITION BY subject_id ORDER BY first_seen) AS user_rank
  FROM (SELECT subject_id, user_name, min(row(created_at, line_no, part_no, price, quantity)) AS first_seen
        FROM v_annotations GROUP BY subject_id, user_name)),
v_some AS (
  SELECT a.*, max_users_used FROM v_annotations a JOIN firsts USING (subject_id, user_name)
  JOIN (SELECT 1 AS max_users_used UNION ALL SELECT 3) ON user_rank <= max_users_used)
SELECT subject_id, max_users_used, question__species, question__count_median, n_users_identified_this_species,
  n_species_ids_per_user_median, n_users_classified_this_subject, species_is_plurality_consensus
FROM ({consensus_sql("v_some", "subject_id, max_users_used")})""")
def plurality_by_first_n_users(t: Tables) -> DataFrame:
    """The consensus of the first one and the first three users."""
    result = consensus.plurality_by_first_n_users(t.annotations, [1, 3], ANNOTATION_ORDER)
    return result.select("subject_id", "max_users_used", "question__species", "question__count_median",
                         "n_users_identified_this_species", "n_species_ids_per_user_median",
                         "n_users_classified_this_subject", "species_is_plurality_consensus")


@query("v_consensus", """
WITH v_scoped AS (
  SELECT 'all' AS scope, * FROM v_consensus UNION ALL
  SELECT 'consensus', * FROM v_consensus WHERE species_is_plurality_consensus = 1),
v_long AS (
  SELECT scope, 'question__species' AS question, question__species AS answer FROM v_scoped
  UNION ALL SELECT scope, 'question__count_median', question__count_median FROM v_scoped
  UNION ALL SELECT scope, 'question__count_min', question__count_min FROM v_scoped
  UNION ALL SELECT scope, 'question__count_max', question__count_max FROM v_scoped
  UNION ALL SELECT scope, 'question__standing', coalesce(CAST(CAST(round_even(question__standing, 0) AS BIGINT) AS VARCHAR), '')
    FROM v_scoped
  UNION ALL SELECT scope, 'question__young_present',
    coalesce(CAST(CAST(round_even(question__young_present, 0) AS BIGINT) AS VARCHAR), '') FROM v_scoped)
SELECT scope, question, answer, count(*) AS count, CAST(sum(count(*)) OVER (PARTITION BY scope, question) AS BIGINT) AS total,
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY scope, question), 2) AS percent
FROM v_long GROUP BY scope, question, answer""")
def plurality_answer_stats(t: Tables) -> DataFrame:
    """Answer shares over all species and over the consensus species."""
    return consensus.plurality_answer_stats(consensus.plurality_consensus(t.annotations, ANNOTATION_ORDER))


@query("v_consensus", """
SELECT n_classifications, count(*) AS count, CAST(sum(count(*)) OVER () AS BIGINT) AS total,
  round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percent
FROM (SELECT subject_id, max(n_users_classified_this_subject) AS n_classifications FROM v_consensus GROUP BY subject_id)
GROUP BY n_classifications""")
def classifications_per_subject(t: Tables) -> DataFrame:
    """Subjects by number of users."""
    return consensus.classifications_per_subject(consensus.plurality_consensus(t.annotations, ANNOTATION_ORDER))


# --- subjects ------------------------------------------------------------------------------------

@query("v_subjects", """
SELECT subject_id, capture_id, season, site, roll, capture, '' AS platform_created_at, retired_at AS platform_retired_at,
  retirement_reason AS platform_retirement_reason, 'https://img.example.org/' || o_orderkey || '_0.jpg' AS platform_url_0,
  CASE WHEN o_orderkey % 3 >= 1 THEN 'https://img.example.org/' || o_orderkey || '_1.jpg' ELSE '' END AS platform_url_1,
  CASE WHEN o_orderkey % 3 >= 2 THEN 'https://img.example.org/' || o_orderkey || '_2.jpg' ELSE '' END AS platform_url_2
FROM v_subjects QUALIFY row_number() OVER (PARTITION BY subject_id ORDER BY o_orderkey DESC) = 1""")
def extract_subjects(t: Tables) -> DataFrame:
    """Subjects with addresses and metadata, the last row of each."""
    return subjects.extract_subjects(parse_subjects(t.subject_export), ["o_orderkey"])


@query("v_subjects", """
SELECT retirement_reason, count(*) AS count, CAST(sum(count(*)) OVER () AS BIGINT) AS total,
  round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percent FROM v_subjects GROUP BY 1""")
def retirement_stats(t: Tables) -> DataFrame:
    """Rows of each retirement reason."""
    return subjects.retirement_stats(t.subject_export)


@query("v_subjects", """
SELECT '#season' AS field, CAST(0 AS BIGINT) AS missing UNION ALL SELECT '#site', 0 UNION ALL SELECT '#capture', 0
UNION ALL SELECT '#roll', count(*) FILTER (roll = '') FROM v_subjects
UNION ALL SELECT '#capture_id', count(*) FILTER (capture_id = '') FROM v_subjects""")
def missing_subject_fields(t: Tables) -> DataFrame:
    """Subjects without each metadata field."""
    return subjects.missing_fields(parse_subjects(t.subject_export))


@query("v_annotations v_subjects", """
SELECT subject_id, user_name, question__species, price FROM v_annotations
WHERE subject_id IN (SELECT subject_id FROM v_subjects WHERE retirement_reason = 'F')""")
def select_annotations(t: Tables) -> DataFrame:
    """Annotations of the listed subjects."""
    listed = t.subject_export.where(F.col("retirement_reason") == "F")
    return subjects.select_annotations(t.annotations, listed).select("subject_id", "user_name", "question__species", "price")


@query("v_consensus v_subjects", """
SELECT c.subject_id, c.question__species, s.site, s.retired_at
FROM v_consensus c LEFT JOIN (SELECT * FROM v_subjects WHERE o_orderkey % 2 = 0) s USING (subject_id)""")
def merge_tables(t: Tables) -> DataFrame:
    """Aggregations with the columns of their subjects that they lack."""
    base = consensus.plurality_consensus(t.annotations, ANNOTATION_ORDER).select("subject_id", "question__species")
    add = parse_subjects(t.subject_export.where(F.col("o_orderkey") % 2 == 0)).select(
        "subject_id", F.lit("x").alias("question__species"), subjects.metadata_field("#site").alias("site"), "retired_at")
    return reports.merge_tables(base, add, "subject_id")


# --- reports -------------------------------------------------------------------------------------

@query("v_winners", """
SELECT subject_id, capture_id, question__species FROM v_winners""")
def deduplicate_captures(t: Tables) -> DataFrame:
    """Aggregations without the subjects that lose their capture to an earlier one."""
    return winners(t).select("subject_id", "capture_id", "question__species")


@query("v_report", "SELECT * FROM v_report")
def species_report(t: Tables) -> DataFrame:
    """Captures with their consensus species; captures without any aggregation stay."""
    return report(t)


@query("v_order_captures v_winners", """
SELECT c.*, subject_id, question__species FROM v_order_captures c JOIN v_winners USING (capture_id)
WHERE question__species <> 'human'""")
def species_report_with_data(t: Tables) -> DataFrame:
    """Captures with aggregations only, and without the additional columns."""
    full = reports.species_report(t.order_captures, winners(t), exclude_humans=True, exclude_captures_without_data=True)
    return full.select(*reports.exclude_columns(full.columns, ["n_users", "species_is", "question__count"]))


@query("v_report", """
SELECT question, answer, count(*) AS count, CAST(sum(count(*)) OVER (PARTITION BY question) AS BIGINT) AS total,
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY question), 1) AS percent
FROM (SELECT 'question__species' AS question, question__species AS answer FROM v_report
  UNION ALL SELECT 'question__count_median', question__count_median FROM v_report) GROUP BY question, answer""")
def report_stats(t: Tables) -> DataFrame:
    """Answers of the report's questions."""
    return reports.report_stats(report(t))


@query("v_flagged", """
SELECT DISTINCT location, season, question, answer FROM (
  SELECT site AS location, roll AS season, 'question__species' AS question, event_type AS answer FROM v_flagged
  UNION ALL SELECT site, roll, 'question__moving', CAST(CAST(floor(value / 100 + 0.5) AS BIGINT) AS VARCHAR) FROM v_flagged
  UNION ALL SELECT site, roll, 'question__eating', image_is_invalid FROM v_flagged)""")
def question_answer_overview(t: Tables) -> DataFrame:
    """Different answers per location and season, binary answers rounded half up."""
    rows = flagged(t).select(
        F.col("site").alias("location"), F.col("roll").alias("season"), F.col("event_type").alias("question__species"),
        (F.col("value") / 100).cast("string").alias("question__moving"), F.col("image_is_invalid").alias("question__eating"))
    return reports.question_answer_overview(rows)


@query("v_flagged v_captures", """
SELECT capture_id, image_rank_in_capture, image_name AS image_path_rel, 'https://img.example.org/' || image_name AS url
FROM v_captures WHERE capture_id IN (SELECT capture_id FROM v_flagged WHERE event_type = 'purchase')""")
def report_images(t: Tables) -> DataFrame:
    """Images of the captures of a report, with their address."""
    images = flagged(t).drop("image_path_rel").withColumn("image_path_rel", F.col("image_name"))
    chosen = images.where(F.col("event_type") == "purchase")
    return reports.report_images(images, chosen, "https://img.example.org")


@query("v_consensus", """
WITH counts AS (SELECT question__species AS label, count(*) AS n FROM v_consensus
  WHERE species_is_plurality_consensus = 1 GROUP BY 1),
rounds AS (SELECT min(r) AS r FROM (SELECT r, (SELECT sum(least(n, r)) FROM counts) AS reached FROM range(1, 60000) t(r))
  WHERE reached >= least(10000, (SELECT sum(n) FROM counts))),
quotas AS (SELECT label, greatest(0, least(least(n, r), least(10000, sum(n) OVER ()) - coalesce(sum(least(n, r)) OVER (
  ORDER BY n, label DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS quota FROM counts, rounds)
SELECT subject_id, question__species FROM (
  SELECT subject_id, question__species, row_number() OVER (PARTITION BY question__species ORDER BY
    md5('123:' || subject_id), subject_id) AS position FROM v_consensus WHERE species_is_plurality_consensus = 1)
JOIN quotas ON label = question__species WHERE position <= quota""")
def balanced_sample(t: Tables) -> DataFrame:
    """A sample of consensus rows with species as balanced as possible."""
    rows = consensus.plurality_consensus(t.annotations, ANNOTATION_ORDER, consensus_only=True)
    return reports.balanced_sample(rows.select("subject_id", "question__species"), "question__species", 10000, "subject_id")


# --- predictions ---------------------------------------------------------------------------------

@query("v_flat", f"SELECT capture_id, {FLAT_SQL} FROM v_flat")
def flatten_predictions(t: Tables) -> DataFrame:
    """Flat species and empty predictions, one column each."""
    return predictions.spread_predictions(flat_predictions(t), FLAT_COLUMNS)


@query("v_flat", f"""
WITH flat AS (SELECT capture_id, {FLAT_SQL} FROM v_flat),
long AS (
  SELECT 'machine_topprediction_is_empty' AS question, machine_topprediction_is_empty AS answer FROM flat
  UNION ALL SELECT 'machine_topprediction_species', machine_topprediction_species FROM flat
    WHERE machine_topprediction_is_empty <> 'empty'
  UNION ALL SELECT 'machine_topprediction_eating', machine_topprediction_eating FROM flat
    WHERE machine_topprediction_is_empty <> 'empty')
SELECT question, answer, count(*) AS count, CAST(sum(count(*)) OVER (PARTITION BY question) AS BIGINT) AS total,
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY question), 1) AS percent FROM long GROUP BY question, answer""")
def prediction_stats(t: Tables) -> DataFrame:
    """Top predictions; captures predicted empty count for that question only."""
    return reports.prediction_stats(predictions.spread_predictions(flat_predictions(t), FLAT_COLUMNS))


@query("v_flat v_order_captures", """
SELECT c.capture_id, c.season, c.site, c.roll, c.capture, c.capture_date_local,
  coalesce('l' || label, '') AS machine_topprediction_species
FROM v_order_captures c LEFT JOIN v_flat f ON c.capture = CAST(f.vec_id AS VARCHAR)""")
def prediction_report(t: Tables) -> DataFrame:
    """Captures with their predictions, empty where there are none."""
    flat = predictions.spread_predictions(flat_predictions(t), ["machine_topprediction_species"])
    number = F.element_at(F.split("capture_id", "#"), -1)
    flat = flat.withColumn("capture_id", F.format_string("OR#Q%d#1#%s", number.cast("bigint") % 7, number))
    return reports.prediction_report(t.order_captures, flat)


# --- manifests -----------------------------------------------------------------------------------

VIEWS["v_manifest"] = """
SELECT capture_id, min(site) AS site, min(roll) AS roll, min(season) AS season, CAST(min(capture) AS VARCHAR) AS capture,
  string_agg(image_name, ';' ORDER BY image_rank_in_capture) AS images
FROM v_flagged WHERE image_no_upload <> '1' GROUP BY capture_id"""
REQUIRES["v_manifest"] = ["v_flagged"]


def manifest(t: Tables) -> DataFrame:
    return manifests.manifest_records(flagged(t), "somebody", "CC0", ["image_rank_in_capture"], path="image_name")


def metadata(*keys: str) -> list:
    return [F.coalesce(F.try_element_at("upload_metadata", F.lit(k)), F.lit("")).alias(k.strip("#")) for k in keys]


@query("v_manifest", "SELECT *, 'somebody' AS attribution, 'CC0' AS license FROM v_manifest")
def manifest_records(t: Tables) -> DataFrame:
    """Upload records with their images, without images that must not be uploaded."""
    return manifest(t).select("capture_id", *metadata("#site", "#roll", "#season", "#capture", "attribution", "license"),
                              F.array_join("images", ";").alias("images"))


BATCHES = """
WITH placed AS (SELECT capture_id, row_number() OVER (ORDER BY {order}) AS position, count(*) OVER () AS total FROM v_manifest)
SELECT capture_id, CAST(min(b) AS INTEGER) AS batch FROM placed JOIN range(1, {n} + 1) t(b)
  ON round_even(b * total / {n}, 0) >= position GROUP BY capture_id"""


@query("v_manifest", BATCHES.format(order="capture_id", n="7"))
def batch_assign(t: Tables) -> DataFrame:
    """Seven near-equal batches in capture order."""
    return manifests.batch_assign(manifest(t).select("capture_id"), ["capture_id"], n_batches=7)


@query("v_manifest", BATCHES.format(order="md5('123:' || capture_id), capture_id",
                                    n="CAST(ceil((SELECT count(*) FROM v_manifest) / 400) AS INTEGER)"))
def batch_assign_shuffled(t: Tables) -> DataFrame:
    """Batches of at most 400 captures in a repeatable random order, through range slices."""
    return manifests.batch_assign(manifest(t).select("capture_id"), [], max_size=400, seed=123, hot_group_rows=1000)


@query("v_flat", """
SELECT 'EM#' || label || '#1#' || vec_id AS capture_id, '#l' || label AS topprediction,
  s0 AS topconfidence, s4 AS confidence_eating, CASE WHEN has_empty AND by_empty THEN s5 ELSE '' END AS confidence_empty,
  's' || vec_id AS site, 1 AS machine_learning
FROM v_flat UNION ALL SELECT 'none', '#', '', '', '', 'x', 0""")
def add_predictions(t: Tables) -> DataFrame:
    """Manifest metadata with the predictions and the flag whether there are any."""
    records = t.read("embeddings").select(
        F.format_string("EM#%d#1#%d", F.col("label"), F.col("vec_id")).alias("capture_id"),
        F.create_map(F.lit("#site"), F.concat(F.lit("s"), text("vec_id")), F.lit("#machine_confidence_eating"), F.lit("old"))
        .alias("upload_metadata"), F.struct(F.lit(False).alias("uploaded")).alias("info"))
    extra = t.read("region").where(F.col("r_regionkey") == 0).select(
        F.lit("none").alias("capture_id"), F.create_map(F.lit("#site"), F.lit("x")).alias("upload_metadata"),
        F.struct(F.lit(False).alias("uploaded")).alias("info"))
    result = predictions.add_predictions(records.unionByName(extra), t.empty_predictions, t.species_predictions, all_scores=True)

    def value(key):
        return F.coalesce(F.try_element_at("upload_metadata", F.lit("#machine_" + key)), F.lit(""))

    return result.select(
        "capture_id", F.concat(F.lit("#"), value("topprediction_species")).alias("topprediction"),
        value("topconfidence_species").alias("topconfidence"), value("confidence_eating").alias("confidence_eating"),
        value("confidence_empty").alias("confidence_empty"), F.try_element_at("upload_metadata", F.lit("#site")).alias("site"),
        F.col("info.machine_learning").cast("int").alias("machine_learning"))


@query("v_manifest v_order_captures", """
SELECT m.capture_id, sha1(m.capture_id) AS anonymized, CASE WHEN c.capture IS NULL THEN 0 ELSE 1 END AS uploaded,
  coalesce(c.capture, '') AS subject_id, CASE WHEN c.capture IS NULL THEN '' ELSE sha1(m.capture_id) END AS recorded,
  CASE WHEN c.capture IS NULL THEN '' ELSE 'set 1' END AS set_name
FROM v_manifest m LEFT JOIN v_order_captures c ON m.site = 'U' || c.capture AND m.capture = '1' AND m.roll = '1'""")
def record_upload(t: Tables) -> DataFrame:
    """Manifest with the state of its uploads and the anonymous ids."""
    tracker = t.order_captures.select(
        F.concat(F.lit("EV#U"), F.col("capture"), F.lit("#1#1")).alias("capture_id"), F.col("capture").alias("subject_id"))
    result = manifests.record_upload(manifests.upload_metadata(manifest(t)), tracker, "1", "set 1", "20240101000000")
    return result.select(
        "capture_id", F.try_element_at("upload_metadata", F.lit("capture_id_anonymized")).alias("anonymized"),
        F.col("info.uploaded").cast("int").alias("uploaded"), F.coalesce("info.subject_id", F.lit("")).alias("subject_id"),
        F.coalesce("info.anonymized_capture_id", F.lit("")).alias("recorded"),
        F.coalesce("info.subject_set_name", F.lit("")).alias("set_name"))


@query("v_manifest v_order_captures", """
SELECT capture_id FROM v_manifest WHERE capture_id NOT IN (SELECT 'EV#U' || capture || '#1#1' FROM v_order_captures)""")
def pending_uploads(t: Tables) -> DataFrame:
    """Captures the tracker does not list."""
    tracker = t.order_captures.select(F.concat(F.lit("EV#U"), F.col("capture"), F.lit("#1#1")).alias("capture_id"))
    return manifests.pending(manifest(t).select("capture_id"), tracker, "capture_id")


@query("v_subjects", """
SELECT o_orderkey, season, CASE WHEN capture_id <> '' THEN capture_id
    WHEN roll = '' THEN '' ELSE season || '#' || site || '#' || roll || '#' || capture END AS capture_id,
  CASE WHEN capture_id <> '' THEN sha1(capture_id)
    WHEN roll = '' THEN '' ELSE sha1(season || '#' || site || '#' || roll || '#' || capture) END AS anonymized
FROM v_subjects""")
def patch_metadata(t: Tables) -> DataFrame:
    """Metadata with the missing season, capture id and anonymous id."""
    rows = parse_subjects(t.subject_export).withColumn("upload_metadata", manifests.patch_metadata(F.col("metadata"), "S0"))
    return rows.select("o_orderkey", *metadata("#season", "#capture_id"),
                       F.coalesce(F.try_element_at("upload_metadata", F.lit("capture_id_anonymized")), F.lit("")).alias("anonymized"))


@query("v_flat", """
SELECT capture_id, CAST(label <> vec_id % 10 OR s0 <> s1 AS INTEGER) AS needs_update, '#machine_species' AS kept_keys FROM v_flat""")
def needs_metadata_update(t: Tables) -> DataFrame:
    """Whether predictions differ from the stored metadata."""
    rows = t.read("embeddings")
    new = manifests.keys_with_prefix(F.create_map(F.lit("#machine_species"), text("label"), F.lit("other"), F.lit("x")), "#machine")
    from crowdspark.plans.tables import score
    both = F.create_map(F.lit("#machine_species"), text("label"), F.lit("#machine_score"), score(0))
    stored = F.create_map(F.lit("#machine_species"), (F.col("vec_id") % 10).cast("string"), F.lit("#machine_score"), score(1))
    return rows.select(
        F.format_string("EM#%d#1#%d", F.col("label"), F.col("vec_id")).alias("capture_id"),
        manifests.needs_update(both, stored).cast("int").alias("needs_update"),
        F.array_join(F.map_keys(new), ",").alias("kept_keys"))


@query("v_manifest", """
SELECT DISTINCT site, 'EV' AS id, 'batch_' || roll AS batch, site || '_manifest' AS name FROM v_manifest""")
def manifest_file_parts(t: Tables) -> DataFrame:
    """Id, batch and name of manifest files."""
    from crowdspark.functions.text import manifest_file_part
    name = F.concat(F.lit("/out/EV__batch_"), F.col("roll"), F.lit("__"), F.col("site"), F.lit("_manifest.json"))
    kept = checked(t).join(manifest(t).select("capture_id"), "capture_id", "left_semi").withColumn("file", name)
    return kept.select("site", *[manifest_file_part(F.col("file"), p).alias(p) for p in ("id", "batch", "name")]).distinct()


@query("v_eligible v_extracted", """
WITH v_some AS (
  SELECT e.classification_id, e.user_name, e.subject_ids AS subject_id, species AS question__species, animals AS question__count,
    moving AS question__moving, e.created_at, identification_no, e.price
  FROM v_eligible e JOIN v_extracted x ON e.classification_id = x.classification_id AND e.price = x.price)
SELECT subject_id, question__species, count(DISTINCT classification_id) AS n_users_identified_this_species FROM (
  SELECT *, count(DISTINCT CASE WHEN question__species <> 'blank' THEN user_name END) OVER (PARTITION BY subject_id) AS n_some,
    count(DISTINCT user_name) OVER (PARTITION BY subject_id) AS n_all FROM v_some)
WHERE question__species <> 'blank' OR n_all - n_some > n_some GROUP BY 1, 2""")
def export_to_consensus(t: Tables) -> DataFrame:
    """From the JSON export to the labels: F7, R1, R2 and A1 in one plan."""
    from crowdspark.operators.classifications import extract_annotations
    from crowdspark.plans.classification_queries import FILTERS, MULTI, ORDER, SINGLE
    annotations = extract_annotations(t.classifications, ORDER, SINGLE, MULTI, **FILTERS)
    labels = consensus.plurality_consensus(annotations, ["created_at", "classification_id", "identification_no"], checkpoint=True)
    return labels.select("subject_id", "question__species", "n_users_identified_this_species")
