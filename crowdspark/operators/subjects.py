"""Subjects of the crowd platform and their link to captures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdspark.defaults import SUBJECT_METADATA
from crowdspark.functions import text
from crowdspark.operators.ordering import first_n_per_group
from crowdspark.operators.quality import group_shares

#: Address columns at most.
MAX_ADDRESSES = 1000
SUBJECT_FIELDS = ("retirement_reason", "retired_at", "created_at")


def metadata_field(field: str) -> Column:
    return F.coalesce(F.try_element_at("metadata", F.lit(field)), F.lit(""))


def last_per_subject(df: DataFrame, order_by: Sequence[str], subject: str = "subject_id") -> DataFrame:
    """The last row of each subject."""
    return first_n_per_group(df, [subject], [F.col(c).desc() for c in order_by], 1)


def address_count(subjects: DataFrame, limit: int = MAX_ADDRESSES) -> int:
    """One more than the largest number of an address; more than ``limit`` raise an error."""
    keys = F.transform(F.map_keys("locations"), lambda k: k.try_cast("int"))
    last = subjects.agg(F.max(F.array_max(keys))).first()[0]
    if last is not None and last >= limit:
        raise ValueError(f"a subject has more than {limit} addresses")
    return 0 if last is None else last + 1


def extract_subjects(subjects: DataFrame, order_by: Sequence[str], season: str | None = None, n_urls: int | None = None,
                     metadata: Sequence[str] = SUBJECT_METADATA, fields: Sequence[str] = SUBJECT_FIELDS,
                     prefix: str = "platform_") -> DataFrame:
    """One row per subject: ids, ``<prefix>url_<i>`` addresses and retirement fields.

    Every address is exported: without ``n_urls`` the number of columns is that of the subject with the most.
    Needs the parsed export (``locations`` and ``metadata`` maps). Missing fields are empty. Leave
    ``#capture_id`` out of ``metadata`` if the export does not have it. A repeated subject keeps its
    last row.
    """
    n_urls = address_count(subjects) if n_urls is None else n_urls
    columns = {"subject_id": F.col("subject_id")}
    columns |= {m.removeprefix("#"): metadata_field(m) for m in metadata}
    columns |= {f"{prefix}url_{i}": F.coalesce(F.try_element_at("locations", F.lit(str(i))), F.lit(""))
                for i in range(n_urls)}
    columns |= {prefix + f: F.coalesce(F.col(f), F.lit("")) for f in fields}
    rows = subjects if not season else subjects.where(metadata_field("#season") == season)
    rows = last_per_subject(rows, order_by)
    first = [c for c in ("subject_id", "capture_id", "season", "site", "roll", "capture") if c in columns]
    ordered = first + sorted(c for c in columns if c not in first)
    return rows.select(*[columns[c].alias(c) for c in ordered])


def retirement_stats(subjects: DataFrame) -> DataFrame:
    """Rows per retirement reason; every export row counts, also repeated subjects."""
    return group_shares(subjects, ["retirement_reason"])


def missing_fields(subjects: DataFrame, metadata: Sequence[str] = SUBJECT_METADATA) -> DataFrame:
    """Number of rows that lack each metadata field."""
    missing = subjects.select(*[
        (~F.map_contains_key("metadata", m)).cast("bigint").alias(m) for m in metadata])
    return missing.unpivot([], list(metadata), "field", "missing").groupBy("field").agg(
        F.sum("missing").alias("missing"))


def subjects_from_annotations(annotations: DataFrame, order_by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last annotation of each subject with corrected file paths; absent columns are empty."""
    last = last_per_subject(annotations, order_by)
    values = {c: F.col(c) if c in last.columns else F.lit("") for c in columns}
    if "filenames" in last.columns and "filenames" in values:
        names = F.filter(F.split("filenames", ";"), lambda n: n != "")
        paths = F.transform(names, lambda n: text.legacy_image_path(F.col("season"), F.col("site"), F.col("roll"), n))
        values["filenames"] = F.array_join(paths, ";")
    return last.select("subject_id", *[v.alias(c) for c, v in values.items()])


def select_annotations(annotations: DataFrame, subjects: DataFrame) -> DataFrame:
    """Annotations of the listed subjects."""
    return annotations.join(subjects.select("subject_id").distinct(), "subject_id", "left_semi")


def subject_to_capture(captures: DataFrame, subjects: DataFrame, keys: Sequence[str],
                       subject: str = "subject_id", substitute: str = "subject_id_labels") -> DataFrame:
    """Capture and subject pairs; an empty subject id is replaced by the label set's, blank ones dropped."""
    found = F.coalesce(text.empty_to_null(F.col(subject)), text.empty_to_null(F.col(substitute)))
    pairs = captures.select("capture_id", *keys).join(subjects.select(*keys, found.alias("subject_id")), list(keys))
    return pairs.where(F.col("subject_id").isNotNull()).select("capture_id", "subject_id").distinct()


def captures_with_several_subjects(pairs: DataFrame) -> DataFrame:
    """Captures that violate the rule of one subject per capture."""
    return pairs.groupBy("capture_id").agg(F.count_distinct("subject_id").alias("n_subjects")).where(
        F.col("n_subjects") > 1)
