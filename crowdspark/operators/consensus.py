"""Plurality consensus of crowd annotations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdspark.defaults import (
    COUNT_MODES, COUNT_ORDINALS, COUNT_QUESTIONS, EMPTY_ANSWER, HOT_GROUP_ROWS, MAIN_COLUMN, MAIN_QUESTION,
    QUESTION_DELIMITER, QUESTION_PREFIX,
)
from crowdspark.functions.answers import (
    count_to_ordinal, ordinal_to_count, rounded_answer, two_decimals,
)
from crowdspark.operators.ordering import count_and_split, exchange_by, first_n_per_group
from crowdspark.session import stable


def question_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c.startswith(QUESTION_PREFIX + QUESTION_DELIMITER)]


def question_types(questions: Sequence[str], count_questions: Sequence[str] = COUNT_QUESTIONS,
                   main: str = MAIN_QUESTION) -> dict[str, str]:
    """``count``, ``main`` or ``prop`` for each question column, by its name."""
    def kind(question: str) -> str:
        if any(c in question for c in count_questions):
            return "count"
        return "main" if main in question else "prop"
    return {q: kind(q) for q in questions}


def high_median(value: str) -> Column:
    """The middle value, or the larger of the two middle values, from a map of counts by value."""
    return F.expr(f"percentile_disc(0.5) within group (order by `{value}` desc)")


def high_medians(df: DataFrame, keys: Sequence[str], value: str, out: str, aggregates: Mapping[str, str]) -> DataFrame:
    """Per group: high median, minimum, maximum and number of the non-null values, and other aggregates.

    The high median is the middle value, or the larger of the two middle values. Equal values are counted
    before the group is brought together, so a task holds one row per different value and not the rows.
    ``aggregates`` names further columns of ``df`` with the function (``sum`` or ``min``) that combines them.
    """
    values = df.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_n"), *[getattr(F, f)(c).alias(c) for c, f in aggregates.items()])
    values = values.repartition(*keys[:1])
    known = F.when(F.col(value).isNotNull(), F.col("_n"))
    w = Window.partitionBy(*keys)
    values = values.withColumns({
        "_above": F.sum(known).over(w.orderBy(F.col(value).desc_nulls_last())),
        "_known": F.sum(known).over(w),
    })
    return values.groupBy(*keys).agg(
        F.max(F.when(2 * F.col("_above") >= F.col("_known"), F.col(value))).alias(f"{out}_median"),
        F.min(value).alias(f"{out}_min"),
        F.max(value).alias(f"{out}_max"),
        F.coalesce(F.max("_known"), F.lit(0)).alias(f"{out}_n"),
        F.sum("_n").alias("_n_rows"),
        *[getattr(F, f)(c).alias(c) for c, f in aggregates.items()],
    )


def proportion_affirmative(yes: Column, answered: Column, rows: Column) -> Column:
    """Share of ``1`` among all rows, null if nobody answered."""
    return F.when(answered > 0, yes / rows)


def pielou_evenness(votes: Column, window) -> Column:
    """Evenness of the votes within the window, 0 below two species."""
    share = votes / F.sum(votes).over(window)
    n_species = F.count(votes).over(window)
    entropy = -F.sum(share * F.log(share)).over(window)
    return F.when(n_species < 2, F.lit(0.0)).otherwise(entropy / F.log(n_species))


def user_statistics(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Users, blank and non-blank users, species per user and classifications of each subject of ``_narrow`` rows."""
    per_user = rows.groupBy(*keys, "_user").agg(F.count_if("_seen").alias("_n_species"))
    per_user = per_user.withColumn("_n_species", F.when(F.col("_n_species") > 0, F.col("_n_species")))
    users = high_medians(per_user, keys, "_n_species", "_ids", {}).select(
        *keys,
        F.coalesce("_ids_median", F.lit(0)).cast("int").alias("n_species_ids_per_user_median"),
        F.coalesce("_ids_max", F.lit(0)).cast("int").alias("n_species_ids_per_user_max"),
        F.col("_n_rows").alias("n_users_classified_this_subject"),
        F.col("_ids_n").alias("n_users_saw_a_species"),
        (F.col("_n_rows") - F.col("_ids_n")).alias("n_users_saw_no_species"),
        (F.col("_ids_n") / F.col("_n_rows")).alias("p_users_saw_a_species"),
    )
    classifications = rows.groupBy(*keys).agg(F.count_distinct("_classification").alias("n_classifications"))
    return users.join(classifications, list(keys))


def species_statistics(rows: DataFrame, keys: Sequence[str], main: str, questions: Sequence[str], types: Mapping[str, str],
                       modes: Sequence[str], ordinals: Mapping[str, int]) -> DataFrame:
    """Votes, first appearance and answer aggregates of each subject and species of ``_narrow`` rows."""
    counts = [q for q in questions if types[q] == "count"]
    flags = [q for q in questions if types[q] == "prop"]
    by = [*keys, main]
    sums = {f"_{part}_{q}": "sum" for q in flags for part in ("yes", "answered")}
    first = f"_ord_{counts[0]}" if counts else "_none"
    rows = rows.withColumn("_none", F.lit(None).cast("int")) if not counts else rows
    species = high_medians(rows, by, first, first, {"_first": "min", **sums})
    for q in counts[1:]:
        species = species.join(high_medians(rows, by, f"_ord_{q}", f"_ord_{q}", {}).drop("_n_rows"), by)
    votes = rows.groupBy(*by).agg(F.count_distinct("_classification").alias("n_users_identified_this_species"))
    answers = [ordinal_to_count(F.col(f"_ord_{q}_{m}"), ordinals).alias(f"{q}_{m}") for q in counts for m in modes]
    answers += [proportion_affirmative(F.col(f"_yes_{q}"), F.col(f"_answered_{q}"), F.col("_n_rows")).alias(q)
                for q in flags]
    return species.join(votes, by).select(*by, "n_users_identified_this_species", "_n_rows", "_first", *answers)


def _narrow(annotations: DataFrame, keys: Sequence[str], order: str, user: str, classification: str, main: str, empty: str,
            questions: Sequence[str], types: Mapping[str, str], ordinals: Mapping[str, int]) -> DataFrame:
    """The columns that the consensus needs: names, order, ordinal counts and 0/1 answers."""
    counts = [q for q in questions if types[q] == "count"]
    flags = [q for q in questions if types[q] == "prop"]
    return annotations.select(
        *keys, F.col(user).alias("_user"), F.col(classification).alias("_classification"), F.col(main),
        (F.col(main) != empty).alias("_seen"), F.col(order).alias("_first"),
        *[count_to_ordinal(F.col(q), ordinals).alias(f"_ord_{q}") for q in counts],
        *[(F.col(q) == "1").cast("int").alias(f"_yes_{q}") for q in flags],
        *[(F.col(q) != "").cast("int").alias(f"_answered_{q}") for q in flags],
    )


def _in_place(rows: DataFrame, keys: Sequence[str], main: str, questions: Sequence[str], types: Mapping[str, str],
              modes: Sequence[str], ordinals: Mapping[str, int]) -> DataFrame:
    """Species and subject statistics of ``_narrow`` rows in the partitioning that they have.

    All windows and aggregates begin with ``keys``, so rows that are partitioned by (some of) them are sorted in their
    task and never exchanged again. One row of each user, and of each classification, carries its number to the subject.
    """
    counts = [q for q in questions if types[q] == "count"]
    flags = [q for q in questions if types[q] == "prop"]
    by = [*keys, main]
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    of_user = Window.partitionBy(*keys, "_user").orderBy("_classification")
    of_subject, of_species = Window.partitionBy(*keys), Window.partitionBy(*by)
    firsts = F.row_number().over(of_user) == 1
    species_ids = F.count_if("_seen").over(of_user.rowsBetween(*whole))
    rows = rows.withColumns({"_user_row": firsts, "_ids": F.when(firsts & (species_ids > 0), species_ids)})
    rows = rows.withColumn("_new", F.row_number().over(
        Window.partitionBy(*keys, "_classification").orderBy("_classification")) == 1)
    rows = rows.withColumns({
        "_users": F.count_if("_user_row").over(of_subject), "_saw": F.count("_ids").over(of_subject),
        "_classifications": F.count_if("_new").over(of_subject), "_most": F.max("_ids").over(of_subject),
        "_median": high_median("_ids").over(of_subject)})
    rows = rows.withColumns({f"_middle_{q}": high_median(f"_ord_{q}").over(of_species) for q in counts})
    parts = {"median": "_middle_", "min": "_ord_", "max": "_ord_"}
    species = rows.groupBy(*by).agg(
        F.count_distinct("_classification").alias("n_users_identified_this_species"), F.count(F.lit(1)).alias("_n_rows"),
        F.min("_first").alias("_first"),
        *[(F.min if m == "min" else F.max)(f"{parts[m]}{q}").alias(f"_{m}_{q}") for q in counts for m in modes],
        *[F.sum(f"_{part}_{q}").alias(f"_{part}_{q}") for q in flags for part in ("yes", "answered")],
        *[F.max(c).alias(c) for c in ("_users", "_saw", "_classifications", "_most", "_median")],
    )
    answers = [ordinal_to_count(F.col(f"_{m}_{q}"), ordinals).alias(f"{q}_{m}") for q in counts for m in modes]
    answers += [proportion_affirmative(F.col(f"_yes_{q}"), F.col(f"_answered_{q}"), F.col("_n_rows")).alias(q) for q in flags]
    return species.select(
        *by, "n_users_identified_this_species", "_n_rows", "_first", *answers,
        F.coalesce("_median", F.lit(0)).cast("int").alias("n_species_ids_per_user_median"),
        F.coalesce("_most", F.lit(0)).cast("int").alias("n_species_ids_per_user_max"),
        F.col("_users").alias("n_users_classified_this_subject"), F.col("_saw").alias("n_users_saw_a_species"),
        (F.col("_users") - F.col("_saw")).alias("n_users_saw_no_species"),
        (F.col("_saw") / F.col("_users")).alias("p_users_saw_a_species"), F.col("_classifications").alias("n_classifications"))


def _spread(rows: DataFrame, keys: Sequence[str], main: str, questions: Sequence[str], types: Mapping[str, str],
            modes: Sequence[str], ordinals: Mapping[str, int]) -> DataFrame:
    """The same statistics of hot subjects: every count is aggregated before its exchange, so no task holds a whole one."""
    species = species_statistics(rows, keys, main, questions, types, modes, ordinals)
    return species.join(user_statistics(rows, keys), list(keys))


def _consensus(species: DataFrame, keys: Sequence[str], main: str, empty: str, questions: Sequence[str],
               types: Mapping[str, str], modes: Sequence[str], consensus_only: bool, text_decimals: bool) -> DataFrame:
    """Votes, evenness, ranks and the consensus flag from the statistics of subjects and species."""
    species = species.withColumn("_is_empty", F.col("n_users_saw_no_species") > F.col("n_users_saw_a_species"))
    votes = F.col("n_users_identified_this_species")
    of_subject = Window.partitionBy(*keys)
    by_votes = of_subject.orderBy(F.col("_n_rows").desc(), F.col("_first"))
    result = (
        species.where(F.col("_is_empty") | (F.col(main) != empty))
        .withColumns({
            "p_users_identified_this_species":
                votes / F.when(F.col("_is_empty"), F.col("n_classifications")).otherwise(F.col("n_users_saw_a_species")),
            "pielous_evenness_index":
                F.when(F.col("_is_empty"), F.lit(0.0)).otherwise(pielou_evenness(votes, of_subject)),
            "_rank": F.row_number().over(by_votes),
        })
        .withColumn(
            "species_is_plurality_consensus",
            F.when(F.col("_is_empty"), F.col(main) == empty)
            .otherwise(F.col("_rank") <= F.col("n_species_ids_per_user_median")).cast("int"))
    )
    if consensus_only:
        result = result.where(F.col("species_is_plurality_consensus") == 1)
    answers = [c for q in questions for c in result.columns if c == q or c in {f"{q}_{m}" for m in modes}]
    statistics = [
        "n_users_identified_this_species", "p_users_identified_this_species", "n_species_ids_per_user_median",
        "n_species_ids_per_user_max", "n_users_classified_this_subject", "n_users_saw_a_species",
        "n_users_saw_no_species", "p_users_saw_a_species", "pielous_evenness_index",
        "species_is_plurality_consensus",
    ]
    result = result.select(*dict.fromkeys([*keys, main, *answers, *statistics]))
    if text_decimals:
        decimals = ["p_users_identified_this_species", "p_users_saw_a_species", "pielous_evenness_index"]
        decimals += [q for q in questions if types[q] == "prop"]
        result = result.withColumns({c: F.coalesce(two_decimals(F.col(c)), F.lit("")) for c in decimals})
    return result


def plurality_consensus(
    annotations: DataFrame, order_by: Sequence[str], *, keys: Sequence[str] = ("subject_id",),
    user: str = "user_name", classification: str = "classification_id", main: str = MAIN_COLUMN,
    empty: str = EMPTY_ANSWER, questions: Sequence[str] | None = None,
    count_questions: Sequence[str] = COUNT_QUESTIONS, modes: Sequence[str] = COUNT_MODES,
    ordinals: Mapping[str, int] = COUNT_ORDINALS, consensus_only: bool = False, text_decimals: bool = False,
    checkpoint: bool = False, hot_group_rows: int | None = HOT_GROUP_ROWS, n_users: Sequence[int] = (),
) -> DataFrame:
    """One row per subject and species, flagged if the species is part of the consensus.

    A subject is blank if more users saw nothing than saw something; then ``blank`` is the consensus.
    Otherwise the ``median`` most named species are, where ``median`` is the high median of the species
    per user. ``order_by`` decides ties between equally often named species (first named wins).
    A single numeric order column is the fastest: its minimum stays in a hash aggregate.

    The annotations are exchanged once, with few columns, by subject; medians, votes and ranks are worked out
    in that partitioning. A count of the key columns sets the number of tasks and finds subjects above ``hot_group_rows``
    annotations, which are spread by user and species instead; ``None`` skips the count. Set ``checkpoint`` if the annotations come
    from a costly plan. With ``n_users``, each subject has one result for the first n users of each n, named
    ``max_users_used``; rows are copied for each n after the exchange, inside their task.
    """
    keys = list(keys)
    annotations = stable(annotations) if checkpoint else annotations
    questions = list(questions) if questions is not None else question_columns(annotations.columns)
    types = question_types(questions, count_questions)
    order = order_by[0] if len(order_by) == 1 else "_order"
    annotations = annotations if len(order_by) == 1 else annotations.withColumn(order, F.struct(*order_by))
    if hot_group_rows is None:
        n_rows, cold, hot = None, annotations, None
    else:
        n_rows, cold, hot = count_and_split(annotations, keys, hot_group_rows)
    out = [*keys, "max_users_used"] if n_users else keys

    def narrow(rows: DataFrame) -> DataFrame:
        return _narrow(rows, keys, order, user, classification, main, empty, questions, types, ordinals)

    rest = (out, main, questions, types, modes, ordinals)
    rows = exchange_by(narrow(cold), keys, n_rows and n_rows * max(1, len(n_users)))
    species = _in_place(_each_size(rows, keys, n_users) if n_users else rows, *rest)
    finish = (out, main, empty, questions, types, modes, consensus_only, text_decimals)
    result = _consensus(species, *finish)
    if hot is None:
        return result
    if n_users:
        hot = first_n_users(hot, max(n_users), order_by, keys[0], user)
        sizes = F.filter(F.array(*[F.lit(n) for n in n_users]), lambda n: n >= F.col("user_rank"))
        hot = stable(hot.withColumn("max_users_used", F.explode(sizes)).drop("user_rank"))
        large = _narrow(hot, out, order, user, classification, main, empty, questions, types, ordinals)
    else:
        large = narrow(hot)
    return result.unionByName(_consensus(_spread(large, *rest), *finish))


def _each_size(rows: DataFrame, keys: Sequence[str], n_users: Sequence[int]) -> DataFrame:
    """``_narrow`` rows of the first n users of each subject for every n, in the partitioning that they have."""
    firsts = rows.withColumn("_joined", F.min("_first").over(Window.partitionBy(*keys, "_user")))
    ranked = firsts.withColumn("_user_rank", F.dense_rank().over(Window.partitionBy(*keys).orderBy("_joined", "_user")))
    sizes = F.filter(F.array(*[F.lit(n) for n in n_users]), lambda n: n >= F.col("_user_rank"))
    return ranked.where(F.col("_user_rank") <= max(n_users)).withColumn("max_users_used", F.explode(sizes)).drop("_joined", "_user_rank")


def first_n_users(annotations: DataFrame, n: int, order_by: Sequence[str], subject: str = "subject_id",
                  user: str = "user_name", rank: str = "user_rank") -> DataFrame:
    """Annotations of the first ``n`` users of each subject, with the user's rank by first appearance."""
    firsts = annotations.groupBy(subject, user).agg(F.min(F.struct(*order_by)).alias("_first"))
    firsts = first_n_per_group(firsts, [subject], ["_first"], n, rank=rank).drop("_first")
    return annotations.join(firsts, [subject, user])


def plurality_by_first_n_users(annotations: DataFrame, n_users: Sequence[int], order_by: Sequence[str],
                               subject: str = "subject_id", user: str = "user_name", **options) -> DataFrame:
    """The consensus from the first n users of each subject, for every n of ``n_users``.

    Users are ranked, and their annotations copied for each n, after the one exchange by subject, so what is shuffled does
    not grow with the number of n.
    """
    return plurality_consensus(annotations, order_by, keys=(subject,), user=user, n_users=n_users, **options)


def answer_shares(df: DataFrame, questions: Sequence[str], keys: Sequence[str] = (), places: int = 1,
                  answer=rounded_answer, counts_as_text: Sequence[str] = ("count",)) -> DataFrame:
    """Count, total and percentage of each answer of each question column."""
    values = [
        (F.col(q).cast("string") if any(c in q for c in counts_as_text) else answer(F.col(q).cast("string")))
        .alias(q) for q in questions
    ]
    long = df.select(*keys, *[F.coalesce(v, F.lit("")).alias(q) for v, q in zip(values, questions)])
    long = long.unpivot(list(keys), list(questions), "question", "answer")
    counts = long.groupBy(*keys, "question", "answer").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(*keys, "question"))
    return counts.withColumn("total", total).withColumn(
        "percent", F.round(100 * F.col("count") / F.col("total"), places))


def plurality_answer_stats(aggregated: DataFrame) -> DataFrame:
    """Answer shares over all rows and over the consensus rows."""
    questions = question_columns(aggregated.columns)
    scopes = F.when(F.col("species_is_plurality_consensus") == 1, F.array(F.lit("all"), F.lit("consensus")))
    scoped = aggregated.withColumn("scope", F.explode(scopes.otherwise(F.array(F.lit("all")))))
    return answer_shares(scoped, questions, keys=["scope"], places=2)


def classifications_per_subject(aggregated: DataFrame, subject: str = "subject_id") -> DataFrame:
    """How many subjects have each number of users."""
    subjects = aggregated.groupBy(subject).agg(
        F.max("n_users_classified_this_subject").alias("n_classifications"))
    counts = subjects.groupBy("n_classifications").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("total", total).withColumn("percent", F.round(100 * F.col("count") / F.col("total"), 2))
