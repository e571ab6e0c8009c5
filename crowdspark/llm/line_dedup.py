"""Line deduplication: content-defined chunks of lines, or passages of any lines, that occur again are removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdspark.llm.common import written

#: Lines that the rolling hash covers, and the mean number of lines to a boundary.
ROLL_LINES, MEAN_LINES = 3, 4
#: A single line of so many words is a chunk by itself and counts like several lines.
LONG_LINE_WORDS = 50
#: Factor of the rolling hash, and its modulus (a prime).
FACTOR, MODULUS = 31, 1_000_003


def line_chunks(text: str) -> str:
    """SQL for the chunks of a text: an array of ``struct(n_lines, line, chunk, long)`` in order; lines count from 0.

    A line's hash is made of the first 32 bits of its MD5. The rolling hash after a line covers it and the
    ROLL_LINES - 1 lines before it; a chunk ends where it is divisible by MEAN_LINES, so boundaries depend on
    nearby lines only and survive shifts. A line of LONG_LINE_WORDS words is bounded on both sides.
    ``transform(array(x), y -> ...)[0]`` binds y to x, so that each part is worked out once for a text.
    """
    rolled = " + ".join(f"{FACTOR ** i} * coalesce(get(p.hashes, i - {i}), 0)" for i in range(ROLL_LINES))
    prepared = f"""transform(array(split({text}, '\\n')), lines -> struct(
        lines as lines,
        transform(lines, l -> cast(conv(substr(md5(l), 1, 8), 16, 10) as bigint) % {MODULUS}) as hashes,
        transform(lines, l -> size(split(trim(l), '[ \\t]+')) >= {LONG_LINE_WORDS}) as long))[0]"""
    ends = f"""transform(array({prepared}), p -> struct(
        p.lines as lines, p.long as long,
        filter(transform(p.hashes, (h, i) -> if(
            i = size(p.hashes) - 1 or get(p.long, i) or coalesce(get(p.long, i + 1), false)
            or ({rolled}) % {MODULUS} % {MEAN_LINES} = 0, i, -1)), i -> i >= 0) as ends))[0]"""
    return f"""transform(array({ends}), q -> transform(q.ends, (e, i) -> struct(
        e - coalesce(get(q.ends, i - 1), -1) as n_lines, coalesce(get(q.ends, i - 1), -1) + 1 as line,
        array_join(slice(q.lines, coalesce(get(q.ends, i - 1), -1) + 2, e - coalesce(get(q.ends, i - 1), -1)), '\\n') as chunk,
        get(q.long, e) as long)))[0]"""


def doc_key() -> Column:
    """A digest of a document's id and text."""
    return F.md5(F.concat_ws("\u0001", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                             F.coalesce(F.col("text").cast("string"), F.lit(""))))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """``doc_key, place``, first ``line``, ``chunk`` and ``long`` of every chunk to remove: one that occurs before, byte for byte.

    Only chunks of several lines, or of one long line, count; blank ones do not. Of equal chunks the first
    by (doc_id, digest of the document, place) stays. Digests are counted first, with partial sums; only
    chunks whose digest repeats are brought together with their text, again with partial minima, and it is
    the text itself that decides.
    """
    chunks = docs.select("doc_id", doc_key().alias("doc_key"), F.posexplode(F.expr(
        line_chunks("coalesce(cast(text as string), '')"))).alias("place", "c")).where(
        "(c.n_lines > 1 or c.long) and trim(translate(c.chunk, '\\n\\t\\r', '   ')) <> ''")
    digests = chunks.withColumn("digest", F.md5("c.chunk"))
    often = digests.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    some = written(
        digests.join(often, "digest", "left_semi").select(
            "digest", F.col("c.chunk").alias("chunk"), "doc_id", "doc_key", "place", "c.line", "c.long"), "chunks")
    first = some.groupBy("digest", "chunk").agg(F.min(F.struct("doc_id", "doc_key", "place")).alias("first"))
    return some.join(first, ["digest", "chunk"]).where(
        "doc_key <> first.doc_key or place <> first.place").select("doc_key", "place", "line", "chunk", "long")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated line chunks of ``text``, plus ``removed_chunks`` and ``removed_lines``.

    All rows and other columns stay. A text that loses all its chunks becomes empty; a null text stays null.
    Rows with equal doc_id and text are one document and end alike. Columns named ``doc_key``, ``chunks``,
    ``removed_chunks`` or ``removed_lines`` are replaced. Built-in expressions only.
    """
    own = [c for c in docs.columns if c.lower() not in {"doc_key", "chunks", "removed_chunks", "removed_lines"}]
    docs = docs.select(*own)
    gone = repeated_chunks(docs).groupBy("doc_key").agg(F.collect_set("place").alias("gone"))
    joined = docs.withColumn("doc_key", doc_key()).join(gone, "doc_key", "left")
    cut = F.expr(f"""transform(array({line_chunks("text")}), chunks -> struct(
        array_join(transform(filter(transform(chunks, (c, i) -> if(array_contains(gone, i), null, c.chunk)),
                                    c -> c is not null), c -> c), '\\n') as text,
        aggregate(transform(chunks, (c, i) -> if(array_contains(gone, i), c.n_lines, 0)), 0, (n, x) -> n + x) as lines))[0]""")
    own_text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.col("_cut.text"))
    return joined.withColumn("_cut", F.when(F.col("gone").isNotNull(), cut)).select(
        *[own_text.alias("text") if c == "text" else F.col(c) for c in own],
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("removed_chunks"), F.coalesce("_cut.lines", F.lit(0)).alias("removed_lines"))


def chunk_passages(docs: DataFrame) -> DataFrame:
    """``doc_key, first, last`` of every repeated chunk that has two lines or more, or is a long line; blank edges aside."""
    filled = """filter(transform(split(chunk, '\n'), (l, i) -> if(trim(translate(l, '\t\r', '  ')) <> '', line + i, null)),
        i -> i is not null)"""
    chunks = repeated_chunks(docs).select("doc_key", "long", F.expr(filled).alias("lines")).where("long or size(lines) > 1")
    return chunks.select("doc_key", F.array_min("lines").alias("first"), F.array_max("lines").alias("last"))


def line_pairs(text: str) -> str:
    """SQL for the least passages of a text: an array of ``struct(first, last, digest)``, line numbers from 0.

    Each line with the next one, blank lines aside, and each line of LONG_LINE_WORDS words by itself. A repeated
    passage of several lines is a row of repeated pairs wherever it begins, so no boundary has to fall on its edge.
    ``digest`` is the SHA-256 of the lines and all between them. A line has no fewer than 2 * LONG_LINE_WORDS - 1
    characters if it has LONG_LINE_WORDS words, so that few are split.
    """
    filled = f"""transform(array(split({text}, '\n')), lines -> struct(lines as lines, filter(
        sequence(0, size(lines) - 1), i -> trim(translate(get(lines, i), '\t\r', '  ')) <> '') as filled))[0]"""
    ends = f"""transform(array({filled}), p -> struct(p.lines as lines, concat(
        transform(slice(p.filled, 1, greatest(size(p.filled) - 1, 0)), (i, k) -> struct(i as first, get(p.filled, k + 1) as last)),
        transform(filter(p.filled, i -> length(get(p.lines, i)) >= {2 * LONG_LINE_WORDS - 1}
            and size(split(trim(get(p.lines, i)), '[ \t]+')) >= {LONG_LINE_WORDS}), i -> struct(i as first, i as last))) as ends))[0]"""
    return f"""transform(array({ends}), q -> transform(q.ends, e -> struct(e.first as first, e.last as last,
        unhex(sha2(array_join(slice(q.lines, e.first + 1, e.last - e.first + 1), '\n'), 256)) as digest)))[0]"""


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``doc_key, first, last`` of every pair of lines, or long line, that occurs before.

    Of equal ones the first by (doc_id, digest of the document, first line) stays. Digests are counted first,
    by eight bytes and with partial sums; only those that repeat are brought together, whole.
    """
    pairs = docs.select("doc_id", doc_key().alias("doc_key"), F.expr(
        f"inline({line_pairs("coalesce(cast(text as string), '')")})")).withColumn("short", F.xxhash64("digest"))
    often = pairs.groupBy("short").agg(F.count("*").alias("n")).where("n > 1").select("short")
    some = written(pairs.join(often, "short", "left_semi").drop("short"), "line_pairs")
    least = some.groupBy("digest").agg(F.min(F.struct("doc_id", "doc_key", "first")).alias("least"))
    return some.join(least, "digest").where("doc_key <> least.doc_key or first <> least.first").select("doc_key", "first", "last")


def dedup_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated passages of ``text``, plus ``removed_lines``.

    Repeated content-defined chunks go first (``chunk_passages``, byte for byte). Their boundaries look at three lines, so
    the edges of a repeated passage lie in other chunks; pairs of neighbouring lines then find what is left of it. A passage is a run of two or more lines that are not blank, or one line of LONG_LINE_WORDS words, equal byte for
    byte (by SHA-256); it goes whole, wherever it lies in its document, but for the places that come first. The first
    place of a line always stays, so nothing is lost from all documents. All rows and other columns stay; a null
    text stays null. Rows with equal doc_id and text are one document and end alike. Columns named ``doc_key``,
    ``gone`` or ``removed_lines`` are replaced. Built-in expressions only.
    """
    own = [c for c in docs.columns if c.lower() not in {"doc_key", "gone", "removed_lines"}]
    docs = docs.select(*own)
    gone = chunk_passages(docs).unionByName(repeated_lines(docs)).groupBy("doc_key").agg(F.collect_set(F.struct("first", "last")).alias("gone"))
    joined = docs.withColumn("doc_key", doc_key()).join(gone, "doc_key", "left")
    kept = """transform(array(split(cast(text as string), '\n')), lines -> transform(array(array_except(
        sequence(0, size(lines) - 1), flatten(transform(gone, g -> sequence(g.first, g.last))))), kept -> struct(
        array_join(transform(kept, i -> get(lines, i)), '\n') as text, size(lines) - size(kept) as lines))[0])[0]"""
    own_text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.col("_kept.text"))
    return joined.withColumn("_kept", F.when(F.col("gone").isNotNull(), F.expr(kept))).select(
        *[own_text.alias("text") if c == "text" else F.col(c) for c in own],
        F.coalesce("_kept.lines", F.lit(0)).alias("removed_lines"))
