"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes, confirmed by full digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Rule rows are repeated this often, and each expression picks one copy: a rule that very many URLs
#: ask for (a whole top-level domain) is spread over as many join keys.
SALTS = 16
#: Different (host labels, path characters) of the rules, at most: they become part of the plan.
MAX_SHAPES = 4096
#: Hexadecimal digits of the digest that the join sees.
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules ``rule`` (host, then a path that begins with ``/``) and ``verdict``, with their digests and shapes.

    A rule without ``/`` means the whole host with any path. Of equal rules ``block`` stays (the larger
    name sorts last). Null or empty rules are ignored.
    """
    text = F.col("rule")
    host = F.lower(F.substring_index(text, "/", 1))
    path = F.when(F.instr(text, "/") > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise(F.lit(""))
    return (
        rules.where("rule is not null and rule <> ''").groupBy("rule").agg(F.max("verdict").alias("verdict"))
        .select("rule", "verdict", F.concat(host, path).alias("expression"),
                F.size(F.split(host, r"\.")).alias("labels"), F.length(path).alias("path_chars"))
        .withColumn("digest", F.sha2("expression", 256))
    )


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """Add ``host, path, rule, verdict`` to every row of ``urls``.

    A rule fits its host and all subdomains if the path starts with the rule's path. The longest fitting
    rule wins, at equal length the one with the longer host; without one, ``rule`` is null and the verdict
    is ``default``. Null URLs and URLs without ``://`` have an empty host and fit no rule. Columns named
    like the four results are replaced.

    Each distinct (host, path) is expanded only into the shapes that rules have (number of host labels and
    length of path; their number is bounded by the longest rule). Expressions meet rules on 8 hex digits of
    SHA-256 and a salt; the full digest confirms. Spark broadcasts the rules only below its own size limit.
    """
    rules = prepare_rules(rules)
    shapes = rules.select("labels", "path_chars").distinct().orderBy("labels", "path_chars").limit(MAX_SHAPES + 1).collect()
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"rules of more than {MAX_SHAPES} shapes")
    if not shapes:
        shapes = [Row(labels=1 << 30, path_chars=0)]  # fits nothing
    own = [c for c in urls.columns if c.lower() not in {"host", "path", "rule", "verdict"}]
    rows = urls.withColumns({"_host": url_host(F.col(url)), "_path": url_path(F.col(url))})
    distinct = rows.where("_host <> ''").select("_host", "_path").distinct().hint("rebalance")
    expressions = (
        distinct.withColumns({"n": F.size(F.split("_host", r"\.")), "shapes": F.array(*[
            F.struct(F.lit(s.labels).alias("labels"), F.lit(s.path_chars).alias("path_chars")) for s in shapes])})
        .select("_host", "_path", F.explode(F.expr(
            "filter(shapes, s -> s.labels <= n and s.path_chars <= length(_path))")).alias("s"))
        .select("_host", "_path", F.expr(
            "concat(substring_index(_host, '.', -s.labels), substring(_path, 1, s.path_chars))").alias("expression"))
        .withColumn("full", F.sha2("expression", 256))
        .select("_host", "_path", "full", F.substring("full", 1, PREFIX_DIGITS).alias("short"),
                F.pmod(F.xxhash64("_host", "_path"), F.lit(SALTS)).cast("int").alias("salt"))
    )
    index = rules.select("rule", "verdict", "digest", "labels", F.substring("digest", 1, PREFIX_DIGITS).alias("short"),
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    best = (
        expressions.join(index, ["short", "salt"]).where("full = digest")
        .groupBy("_host", "_path")
        .agg(F.max(F.struct(F.length("rule").alias("chars"), "labels", "rule", "verdict")).alias("best"))
    )
    return rows.join(best, ["_host", "_path"], "left").select(
        *own, F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
