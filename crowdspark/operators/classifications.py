"""Crowd classification exports: eligibility, nested answers and the flat annotation table.

An export row holds JSON text. Tasks, identifications and answers of one row are handled inside the row
with array functions, so nothing is shuffled until the first-classification rule and the aggregates.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from crowdspark.defaults import (
    ANSWERS, ANSWERS_BY_QUESTION, CLASSIFICATION_COLUMNS, MAX_COLUMNS, QUESTION_DELIMITER, QUESTION_NAMES,
    QUESTION_ORDER, QUESTION_PREFIX, QUESTIONS_IGNORED, REQUIRED_CLASSIFICATION_COLUMNS,
)
from crowdspark.functions.text import lookup
from crowdspark.operators.ordering import first_n_per_group
from crowdspark.operators.quality import group_shares


# --- eligibility ---------------------------------------------------------------------------------

def major_version(version: Column) -> Column:
    return F.substring_index(version, ".", 1)


def is_eligible_workflow(workflow_id: str | None, version_min: str | None = None) -> Column:
    """Workflow equals ``workflow_id`` and its major version is at least ``version_min``.

    Without a workflow id every row passes, whatever the version.
    """
    if workflow_id is None:
        return F.lit(True)
    eligible = F.col("workflow_id") == workflow_id
    if version_min is not None:
        least = int(str(version_min).split(".")[0])
        eligible = eligible & (major_version(F.col("workflow_version")).try_cast("int") >= least)
    return F.coalesce(eligible, F.lit(False))


def in_date_range(start: str | None = None, end: str | None = None, created_at: str = "created_at") -> Column:
    """The date of ``yyyy-MM-dd HH:mm:ss UTC`` lies within both bounds; other texts pass."""
    if start is None and end is None:
        return F.lit(True)

    def day(text: Column) -> Column:
        found = F.when(text.rlike(r"^\S+ \S+ \S+$"), F.try_to_timestamp(F.substring_index(text, " ", 1), F.lit("yyyy-MM-dd")))
        return found.cast("date")

    def inside(found: Column) -> Column:
        after = F.lit(True) if start is None else found >= F.lit(start).cast("date")
        return after if end is None else after & (found <= F.lit(end).cast("date"))

    return F.coalesce(once(F.col(created_at), lambda text: once(day(text), inside)), F.lit(True))


def is_live(metadata: Column) -> Column:
    """``live_project`` of the parsed metadata, true if missing."""
    return F.coalesce(F.try_variant_get(metadata, "$.live_project", "boolean"), F.lit(True))


def already_seen(metadata: Column, use_seen_before: bool = False) -> Column:
    """Whether the platform had shown the subject to the user before, false if missing."""
    seen = F.try_variant_get(metadata, "$.subject_selection_state.already_seen", "boolean")
    if use_seen_before:
        seen = F.coalesce(F.try_variant_get(metadata, "$.seen_before", "boolean"), seen)
    return F.coalesce(seen, F.lit(False))


def subject_season(subject_data: Column, subject_id: Column) -> Column:
    """``#season`` of the row's subject, empty if missing."""
    data = F.from_json(subject_data, "map<string, map<string, string>>")
    return F.coalesce(F.try_element_at(F.try_element_at(data, subject_id), F.lit("#season")), F.lit(""))


def may_be_season(subject_data: Column, season: str) -> Column:
    """Whether the JSON text can hold the name of the season; texts without it need no parsing.

    Only a name that is no number, and only a text without escapes, can be ruled out by its letters.
    """
    if not re.fullmatch(r"[A-Za-z]\w*", season) or season in {"Infinity", "NaN"}:
        return F.lit(True)
    return subject_data.contains(season) | subject_data.contains("\\")


def match_conditions(conditions: Mapping[str, str]) -> Column:
    """All named columns equal their values."""
    return reduce(lambda a, b: a & b, [F.col(c) == v for c, v in conditions.items()], F.lit(True))


def is_complete(columns: Sequence[str]) -> Column:
    """All required columns exist and are filled in."""
    if not set(REQUIRED_CLASSIFICATION_COLUMNS) <= set(columns):
        return F.lit(False)
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in REQUIRED_CLASSIFICATION_COLUMNS])


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed a single time, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_reject_reason(df: DataFrame, workflow_id: str | None = None, version_min: str | None = None,
                       start: str | None = None, end: str | None = None, season: str | None = None,
                       include_not_live: bool = False, use_seen_before: bool = False) -> DataFrame:
    """The first filter each row fails, null for rows that pass all.

    The filters on plain columns come first; JSON text is parsed only for rows that pass them, each
    column once. Rows whose JSON does not parse are ``malformed``.
    """
    def by_season(live_or_malformed: Column, seen: Column) -> Column:
        if not season:
            return live_or_malformed.when(seen, "seen_before")
        found = subject_season(F.col("subject_data"), F.col("subject_ids"))
        return live_or_malformed.when(found != season, "season_does_not_match").when(seen, "seen_before")

    def by_metadata(metadata: Column) -> Column:
        reason = F.when(metadata.isNull(), "malformed")
        if not include_not_live:
            reason = reason.when(~is_live(metadata), "project_is_not_live")
        reason = by_season(reason, already_seen(metadata, use_seen_before))
        return reason.when(F.try_parse_json("annotations").isNull(), "malformed")

    reason = (
        F.when(~is_complete(df.columns), "malformed")
        .when(~is_eligible_workflow(workflow_id, version_min), "not_eligible_workflow")
        .when(~in_date_range(start, end), "not_in_date_range")
        .otherwise(once(F.try_parse_json("metadata"), by_metadata))
    )
    return df.withColumn("reject_reason", reason)


CLASSIFICATION_KEY = ("user_name", "subject_ids", "workflow_id")


def first_classifications(df: DataFrame, order_by: Sequence[str], key: Sequence[str] = CLASSIFICATION_KEY) -> DataFrame:
    """The first classification of each user, subject and workflow."""
    return first_n_per_group(df, key, list(order_by), 1)


def without_rejected(df: DataFrame, also: Column | None = None, **filters) -> DataFrame:
    """Rows that pass all filters, and those of ``also`` whatever they hold.

    Which filter a row fails does not matter here, so those on plain texts come first, and only the rows they leave are
    parsed.
    """
    also = F.lit(False) if also is None else also
    plain = {name: filters.pop(name, None) for name in ("workflow_id", "version_min", "start", "end")}
    rows = df.where(also | is_eligible_workflow(plain["workflow_id"], plain["version_min"]))
    if filters.get("season"):
        rows = rows.where(also | may_be_season(F.col("subject_data"), filters["season"]))
    rows = rows.where(also | in_date_range(plain["start"], plain["end"]))
    return with_reject_reason(rows, **filters).where(also | F.col("reject_reason").isNull()).drop("reject_reason")


def eligible_classifications(df: DataFrame, order_by: Sequence[str], **filters) -> DataFrame:
    """Rows that pass all filters, without repeated classifications of a user."""
    return first_classifications(without_rejected(df, **filters), order_by)


def rejected_rows(df: DataFrame, **filters) -> DataFrame:
    """Rows that fail a filter, with the reason."""
    return with_reject_reason(df, **filters).where(F.col("reject_reason").isNotNull())


def reject_stats(df: DataFrame, **filters) -> DataFrame:
    """Rows per reject reason; repeated classifications count as ``duplicate``, kept rows as ``kept``."""
    reasons = with_reject_reason(df, **filters)
    per_key = reasons.groupBy("reject_reason", *CLASSIFICATION_KEY).agg(F.count(F.lit(1)).alias("_n"))
    outcome = F.when(F.col("reject_reason").isNotNull(), F.array(F.struct(F.col("reject_reason").alias("reason"), F.col("_n").alias("n"))))
    outcome = outcome.otherwise(F.array(
        F.struct(F.lit("kept").alias("reason"), F.lit(1).cast("bigint").alias("n")),
        F.struct(F.lit("duplicate").alias("reason"), (F.col("_n") - 1).alias("n"))))
    totals = per_key.select(F.inline(outcome)).groupBy("reason").agg(F.sum("n").alias("count"))
    return totals.where(F.col("count") > 0)


# --- nested answers ------------------------------------------------------------------------------

TASKS = "array<struct<task: string, value: variant>>"


def as_array(value: Column) -> Column:
    """The items of a variant array, null for any other variant."""
    return F.try_variant_get(value, "$", "array<variant>")


def variant_items(value: Column) -> Column:
    """The items of a variant array, or the value as its only item."""
    return F.coalesce(as_array(value), F.array(value))


def variant_texts(value: Column) -> Column:
    """The texts of a variant string or array of strings, in lower case."""
    texts = F.coalesce(F.try_variant_get(value, "$", "array<string>"), F.array(F.try_variant_get(value, "$", "string")))
    return F.transform(texts, F.lower)


def is_survey(item: Column) -> Column:
    """A survey identification is an object with a ``choice``; anything else answers a question task."""
    return F.try_variant_get(item, "$.choice", "string").isNotNull()


def map_answer(question: Column, answer: Column, names: Mapping[str, str] = QUESTION_NAMES,
               by_question: Mapping[str, Mapping[str, str]] = ANSWERS_BY_QUESTION,
               answers: Mapping[str, str] = ANSWERS) -> Column:
    """The answer's name for this question, then its general name; ``question`` is the export's own name.

    Both steps are one lookup of a literal map, built here from the mappings.
    """
    exported = {**{q: q for q in by_question if q not in names}, **names}
    specific = {f"{raw}\t{a}": answers.get(new, new) for raw, q in exported.items()
                for a, new in by_question.get(q, {}).items()}
    return lookup(specific, F.concat(question, F.lit("\t"), answer), lookup(answers, answer))


def _answer(question: Column, texts: Column, multi: Column, names: Mapping[str, str],
            by_question: Mapping[str, Mapping[str, str]], answers: Mapping[str, str]) -> Column:
    mapped = F.transform(texts, lambda a: map_answer(question, a, names, by_question, answers))
    return F.struct(lookup(names, question).alias("question"), mapped.alias("answers"), multi.alias("is_multi"))


def completed_items(annotations: Column) -> Column:
    """The values of all completed tasks of an export row, as one array of variants."""
    tasks = F.try_variant_get(F.try_parse_json(annotations), "$", TASKS)
    return F.flatten(F.transform(F.filter(tasks, task_is_completed), lambda t: variant_items(t["value"])))


def main_answers(items: Column, names: Mapping[str, str], by_question: Mapping[str, Mapping[str, str]],
                 answers: Mapping[str, str]) -> Column:
    """The mapped choice of each survey item, and the mapped text of each question item."""
    texts = F.transform(items, lambda i: F.lower(F.coalesce(
        F.try_variant_get(i, "$.choice", "string"), F.try_variant_get(i, "$", "string"))))
    return F.transform(texts, lambda a: map_answer(F.lit("choice"), a, names, by_question, answers))


def item_answers(item: Column, names: Mapping[str, str] = QUESTION_NAMES, ignored: Sequence[str] = QUESTIONS_IGNORED,
                 by_question: Mapping[str, Mapping[str, str]] = ANSWERS_BY_QUESTION,
                 answers: Mapping[str, str] = ANSWERS) -> Column:
    """The identification in an item: an array of (question, answers, is_multi).

    A survey item gives its lower-case answers, without the ignored questions, and its choice; an item of
    a question task gives one answer.
    """
    def answered(question: Column, texts: Column, multi: Column) -> Column:
        return _answer(question, texts, multi, names, by_question, answers)

    entries = F.map_entries(F.try_variant_get(item, "$.answers", "map<string, variant>"))
    kept = F.filter(entries, lambda e: ~F.lower(e["key"]).isin(list(ignored)))
    given = F.transform(kept, lambda e: answered(F.lower(e["key"]), variant_texts(e["value"]), as_array(e["value"]).isNotNull()))
    choice = F.array(answered(F.lit("choice"), F.array(F.lower(F.try_variant_get(item, "$.choice", "string"))), F.lit(False)))
    question = F.array(answered(F.lit("question"), variant_texts(item), as_array(item).isNotNull()))
    none = F.array().cast("array<struct<question: string, answers: array<string>, is_multi: boolean>>")
    return F.when(is_survey(item), F.concat(F.coalesce(given, none), choice)).otherwise(question)


def task_type(value: Column) -> Column:
    """``survey_task`` if any item has a choice, else ``question_task``."""
    return F.when(F.exists(variant_items(value), is_survey), "survey_task").otherwise("question_task")


def task_is_completed(task: Column) -> Column:
    """The task's value is not an empty list or text."""
    value = task["value"]
    size = F.coalesce(F.array_size(as_array(value)), F.length(F.try_variant_get(value, "$", "string")))
    return F.coalesce(size > 0, F.lit(False))


def task_overview(df: DataFrame, keep: Sequence[str] = ("classification_id",)) -> DataFrame:
    """One row per task with its type and whether it was completed."""
    tasks = F.try_variant_get(F.try_parse_json("annotations"), "$", TASKS)
    rows = df.select(*keep, F.posexplode(tasks).alias("task_no", "task"))
    return rows.select(*keep, "task_no", F.col("task.task").alias("task"), task_type(F.col("task.value")).alias("task_type"),
                       task_is_completed(F.col("task")).alias("is_completed"))


def explode_classifications(df: DataFrame, columns: Sequence[str] = CLASSIFICATION_COLUMNS,
                            rename: Mapping[str, str] = MappingProxyType({"subject_ids": "subject_id"}),
                            names: Mapping[str, str] = QUESTION_NAMES, ignored: Sequence[str] = QUESTIONS_IGNORED,
                            by_question: Mapping[str, Mapping[str, str]] = ANSWERS_BY_QUESTION,
                            answers: Mapping[str, str] = ANSWERS) -> DataFrame:
    """One row per identification: classification columns, number and array of answers.

    If a classification gives the same main answer twice, its first identification is kept. The main
    answers are carried along as an array of the row, so the rule needs no shuffle.
    """
    rows = df.select(*columns, completed_items(F.col("annotations")).alias("_items"))
    rows = rows.withColumn("_main", main_answers(F.col("_items"), names, by_question, answers))
    # the outer form: for the inner one the optimizer adds a filter that parses the JSON a second time
    rows = rows.select(*columns, "_main", F.posexplode_outer("_items").alias("_no", "_item"))
    rows = rows.where(F.array_position("_main", F.get("_main", F.col("_no"))) == F.col("_no") + 1)
    return rows.select(
        *[F.col(c).alias(rename.get(c, c)) for c in columns], (F.col("_no") + 1).alias("identification_no"),
        item_answers(F.col("_item"), names, ignored, by_question, answers).alias("answers"))


def equal_classifications(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Rows with equal ``columns`` and equal answers as one row, with their number ``n``.

    Exports repeat the same few answers. Statistics parse each text once where they are counted first; rows without
    equals are exchanged once, and none is lost.
    """
    return df.groupBy(*columns, "annotations").agg(F.count(F.lit(1)).alias("n"))


def annotations_long(exploded: DataFrame) -> DataFrame:
    """One row per answer."""
    keep = [c for c in exploded.columns if c != "answers"]
    rows = exploded.select(*keep, F.inline("answers"))
    return rows.select(*keep, "question", F.explode("answers").alias("answer"), "is_multi")


def question_domain(long: DataFrame) -> DataFrame:
    """Different answers of each question and whether several may be given."""
    return long.groupBy("question", "answer").agg(F.bool_or("is_multi").alias("is_multi"))


def bounded_rows(df: DataFrame, limit: int = MAX_COLUMNS) -> list[Row]:
    """The rows of a table whose values become columns; too many of them are an error."""
    found = df.limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} values would become columns; pass the wanted ones")
    return found


def collect_domain(long: DataFrame) -> tuple[list[str], dict[str, list[str]]]:
    """Single-answer questions, and the answers of each multi-answer question, in column order.

    Only what becomes a column reaches the driver: the questions, and the answers of multi-answer
    questions. More than ``MAX_COLUMNS`` of them is an error, not a cut.
    """
    questions = long.groupBy("question").agg(F.bool_or("is_multi").alias("is_multi"))
    kinds = {r["question"]: r["is_multi"] for r in bounded_rows(questions)}
    multi: dict[str, list[str]] = {}
    for row in sorted(bounded_rows(long.where("is_multi").select("question", "answer").distinct())):
        multi.setdefault(row["question"], []).append(row["answer"])
    return ordered_questions([q for q, is_multi in sorted(kinds.items()) if not is_multi]), multi


def ordered_questions(questions: Sequence[str], preferred: Sequence[str] = QUESTION_ORDER) -> list[str]:
    """Preferred questions first, the rest in the given order."""
    front = [q for q in preferred if q in questions]
    return front + [q for q in questions if q not in front]


def flatten_annotations(exploded: DataFrame, single: Sequence[str], multi: Mapping[str, Sequence[str]]) -> DataFrame:
    """One column per question; a multi-answer question has one 0/1 column per answer.

    Questions that were not answered are empty.
    """
    def given(question: str) -> Column:
        return F.try_element_at(F.filter("answers", lambda a: a["question"] == question), F.lit(-1))["answers"]

    columns = {q: F.coalesce(F.get(given(q), F.lit(0)), F.lit("")) for q in single}
    for question, answers in multi.items():
        for answer in answers:
            chosen = F.array_contains(given(question), answer)
            columns[answer] = F.when(chosen, "1").when(given(question).isNotNull(), "0").otherwise("")
    keep = [c for c in exploded.columns if c != "answers"]
    prefix = QUESTION_PREFIX + QUESTION_DELIMITER
    return exploded.select(*keep, *[columns[q].alias(prefix + q) for q in ordered_questions(list(columns))])


def extract_annotations(df: DataFrame, order_by: Sequence[str], single: Sequence[str] | None = None,
                        multi: Mapping[str, Sequence[str]] | None = None, **filters) -> DataFrame:
    """Annotation table of a classification export: eligible rows, exploded and flattened.

    Without ``single`` and ``multi`` the questions are found by one extra pass.
    """
    exploded = explode_classifications(eligible_classifications(df, order_by, **filters))
    if single is None or multi is None:
        single, multi = collect_domain(annotations_long(exploded))
    return flatten_annotations(exploded, single, multi)


# --- statistics ----------------------------------------------------------------------------------

def n_rows(weight: str | None) -> Column:
    """The number of rows, or the sum of ``weight`` where a row stands for several."""
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def answer_stats(long: DataFrame, weight: str | None = None) -> DataFrame:
    """Count, total and percentage of each answer."""
    counts = long.groupBy("question", "answer").agg(n_rows(weight).alias("count"))
    totals = counts.groupBy("question").agg(F.sum("count").alias("total"))
    joined = counts.join(totals, "question")
    return joined.withColumn("percent", F.round(100 * F.col("count") / F.col("total"), 2))


def workflow_stats(exploded: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows of each workflow and version."""
    return exploded.groupBy("workflow_id", "workflow_version").agg(n_rows(weight).alias("count"))


def is_anonymous() -> Column:
    return (F.col("user_id") == "") & F.col("user_name").startswith("not-logged-in-")


def anonymous_count(exploded: DataFrame, weight: str | None = None) -> DataFrame:
    anonymous = F.count_if(is_anonymous()) if weight is None else F.sum(F.when(is_anonymous(), F.col(weight)).otherwise(0))
    return exploded.agg(F.coalesce(anonymous, F.lit(0)).alias("not_logged_in"), F.coalesce(n_rows(weight), F.lit(0)).alias("total"))


def top_users(exploded: DataFrame, k: int = 10, weight: str | None = None) -> DataFrame:
    """The k most active users that were logged in."""
    named = exploded.where(~is_anonymous())
    return named.groupBy("user_name").agg(n_rows(weight).alias("count")).orderBy(
        F.col("count").desc(), "user_name").limit(k)


def season_stats(df: DataFrame) -> DataFrame:
    return group_shares(df, ["season"])
