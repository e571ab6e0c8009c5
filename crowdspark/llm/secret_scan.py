"""Secret scans: candidate values are counted by owners over the whole corpus, copied examples apart from owned credentials."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdspark.llm.common import written

#: Kinds of spans in the order in which they are listed; the last one is what the ownership method adds.
KINDS = ("assign", "access", "hex", "owned")
#: A name, a sign and a value; group 2 is the value. Letters of the name in either case, ASCII only.
ASSIGN = ("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
          "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
#: A run without a name before it; shorter ones are words, longer ones are data.
BARE = "[A-Za-z0-9+/_-]{20,}"
ASSIGN_LENGTH, BARE_LENGTH = 6, 200
#: What a value must have to look like a live credential.
LIVE_LENGTH, LIVE_CHARACTERS = 12, 8
#: Values of documentation and tests.
PLACEHOLDER = "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Xx]{4}|[Yy][Oo][Uu][Rr]_|[Cc][Hh][Aa][Nn][Gg][Ee]|12345678|00000000|abcdef"
#: A value with so many owners is a widely copied example.
EXAMPLE_OWNERS = 3
#: A value's rows are dealt to so many groups before they are counted or joined, so that a very common one is many tasks' work.
SALTS = 64


def looks_live(value: Column) -> Column:
    """Whether a value has the length, the letters, the digits and the variety of a credential."""
    return ((F.length(value) >= LIVE_LENGTH) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_CHARACTERS) & ~value.rlike(PLACEHOLDER))


def _matches(text: Column, pattern: str, kind: int, group: int, keep) -> Column:
    """The leftmost matches of a text that do not overlap: array of ``kind, gap, size, digest, live, mixed`` in order.

    ``gap`` is the number of code points between a match and the one before it, so that starts are running sums.
    Matches that fail ``keep`` have a null digest: they take room but are no candidates.
    """
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    found = F.transform(F.filter(parts, lambda p: p["all"].isNotNull()), lambda p: F.struct(
        F.lit(kind).cast("tinyint").alias("kind"), F.length(p["gap"]).alias("gap"), F.length(p["all"]).alias("size"),
        F.when(keep(p["value"]), F.unhex(F.sha2(p["value"], 256))).alias("digest"), looks_live(p["value"]).alias("live"),
        (p["value"].rlike("[a-z]") & p["value"].rlike("[A-Z]") & p["value"].rlike("[0-9]")).alias("mixed")))
    return F.when(text.rlike(pattern), found)


def _without_assigned(text: Column) -> Column:
    """A text of the same length in which kept assignments are spaces."""
    parts = F.arrays_zip(F.split(text, ASSIGN, -1).alias("gap"), F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)).alias("all"),
                         F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)).alias("value"))
    blank = F.array_join(F.transform(parts, lambda p: F.concat(p["gap"], F.when(
        F.length(p["value"]) >= ASSIGN_LENGTH, F.repeat(F.lit(" "), F.length(p["all"]))).otherwise(
        F.coalesce(p["all"], F.lit(""))))), "")
    return F.when(text.rlike(ASSIGN), blank).otherwise(text)


def candidates(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """Per row of ``docs``: a row number, ``doc_id``, owner, repository and the matches of all kinds.

    Values do not leave this step, only their SHA-256.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
                        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"))
    text, every = F.col("text"), lambda v: F.length(v) > 0
    # a run that holds an access key or hex digits is covered by their own spans
    bare = _matches(F.col("rest"), BARE, 3, 0, lambda v: (
        F.length(v) <= BARE_LENGTH) & v.rlike("[0-9]") & v.rlike("[A-Za-z]") & ~v.rlike(ACCESS) & ~v.rlike(HEX))
    none = F.array().cast("array<struct<kind:tinyint,gap:int,size:int,digest:binary,live:boolean,mixed:boolean>>")
    return texts.withColumn("rest", F.when(text.rlike(BARE), _without_assigned(text)).otherwise("")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository", F.concat(*[F.coalesce(c, none) for c in (
            _matches(text, ASSIGN, 0, 2, lambda v: F.length(v) >= ASSIGN_LENGTH), _matches(text, ACCESS, 1, 0, every),
            _matches(text, HEX, 2, 0, every), bare)]).alias("found"))


def placed(found: DataFrame) -> DataFrame:
    """One row per candidate with ``start, end`` in code points; ``salt`` deals the rows of one digest."""
    return found.select("row", "owner", "repository", F.posexplode("found").alias("at", "f")).selectExpr(
        "row", "owner", "repository", "f.*",
        "sum(f.gap + f.size) over (partition by row, f.kind order by at) as end").where("digest is not null").selectExpr(
        "row", "owner", "repository", "kind", "end - size as start", "end", "digest", "live", "mixed", f"pmod(row, {SALTS}) as salt")


def ownership(spans: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """``digest, salt, owners, repositories, verdict, assigned`` of every value, for each salt that it has.

    Occurrences are first counted by value, salt, owner and repository, with partial sums; only those few rows of a value
    come together. ``verdict``: ``example`` with ``example_owners`` owners or more, else ``live`` if the value looks live,
    else ``weak``. ``assigned``: it is a base match somewhere.
    """
    places = written(spans.groupBy("digest", "salt", "owner", "repository").agg(
        F.max("live").alias("live"), F.min("kind").alias("kind")), "secret_places")
    owners = places.groupBy("digest", "owner").agg(
        F.countDistinct("repository").alias("repositories"), F.max("live").alias("live"), F.min("kind").alias("kind"))
    values = owners.groupBy("digest").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.max("live").alias("live"),
        (F.min("kind") < 3).alias("assigned"))
    judged = values.select("digest", "owners", "repositories", "assigned", F.when(
        F.col("owners") >= example_owners, "example").when(F.col("live"), "live").otherwise("weak").alias("verdict"))
    return places.select("digest", "salt").distinct().join(judged, "digest")


def scan_secrets(docs: DataFrame, owner: Column | str = "source", repository: Column | None = None,
                 example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """Secrets of every row: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example``.

    Base spans are the leftmost matches of each kind that do not overlap: ``assign`` (a name such as token, a sign and a
    value of 6 characters), ``access`` (AKIA and 16 characters) and ``hex`` (24 digits); each n_ counts one kind. The method
    adds ``owned``: runs without a name that look like a credential and belong to fewer than ``example_owners`` owners over
    the whole corpus, if they mix capitals, small letters and digits or are assigned as a value anywhere. Values that many
    owners share are examples; ``n_live`` and ``n_example`` count a row's spans of each verdict. Base spans always stay.

    ``spans`` lists all as ``kind:start:end`` by start, then kind; ``base_sha256`` is the digest of the list of base
    spans. Positions are code points, ends exclusive. Null or empty texts have no spans. ``owner`` and ``repository``
    (of an owner; else lang, if there is one) may be null, which is one owner without a name. Repeated rows have a result
    each; a null doc_id stays null; other columns are not read. Built-in expressions only.
    """
    owner = F.col(owner) if isinstance(owner, str) else owner
    if repository is None:
        repository = F.col("lang") if "lang" in docs.columns else F.lit("")
    found = written(candidates(docs, owner, repository), "secret_matches")
    spans = written(placed(found), "secret_spans")
    judged = spans.join(ownership(spans, example_owners), ["digest", "salt"]).where(
        "kind < 3 or (verdict = 'live' and (mixed or assigned))")
    listed = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "verdict"))).alias("s"))
    names = "array(" + ", ".join(map(repr, KINDS)) + ")"

    def joined(only: str) -> str:
        return (f"array_join(transform(filter(coalesce(s, array()), x -> {only}), "
                f"x -> concat_ws(':', get({names}, x.kind), x.start, x.end)), ',')")

    def count(only: str, name: str) -> str:
        return f"cast(size(filter(coalesce(s, array()), x -> {only})) as bigint) as {name}"

    return found.select("row", "doc_id").join(listed, "row", "left").selectExpr(
        "doc_id", *[count(f"x.kind = {i}", f"n_{KINDS[i]}") for i in range(3)],
        f"sha2({joined('x.kind < 3')}, 256) as base_sha256", f"{joined('true')} as spans",
        count("x.verdict = 'live'", "n_live"), count("x.verdict = 'example'", "n_example"))
