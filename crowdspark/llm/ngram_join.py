"""N-gram Jaccard join: rare-first prefixes with length, position and suffix filters, verified once per pair."""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.llm.common import components, mix, ngrams, shingle_set, small_slices, words, written

WORDS, PERCENT = 4, 85
#: Buckets of the table of shingle frequencies that orders shingles; its size does not depend on the corpus.
FREQUENCY_BITS = 18
#: MinHash values by which a set finds the set it is first compared with.
LEADERS = 8
#: 64-bit words of a set's parity sketch, whose bits tell whether an odd number of shingles fell on them: two
#: sketches differ in no more bits than their sets in shingles.
SKETCH = 10
#: Of a prefix shingle that so many sets share, each set is compared with one of them first.
CROWD = 16
#: While shingles bring together more pairs of different groups than this for each set, groups are linked first, until
#: a turn leaves more than the second share of the pairs.
PAIRS_PER_SET, WORTH, PICKS = 4, 0.5, 8
#: The list of documents of candidate pairs is broadcast up to so many rows, about 16 MB; beyond, texts are shuffled.
BROADCAST_ROWS = 500_000
#: Bitmaps (4 KB for 32768 rows) of the first rows of equal sets are broadcast up to so many, 16 MB; beyond, sets are shuffled.
BITMAPS = 4096

SETS = "row long, doc_id {}, n long, name binary, leaders array<long>, sketch array<long>, wide binary, prefix array<long>"
_SEEDS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def set_name(shingles: np.ndarray) -> bytes:
    """A 128-bit name of a set of shingles."""
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def wide_sketch(shingles: np.ndarray) -> bytes:
    """A parity sketch with a bit or more for each shingle, a power of two of them; half as wide by folding.

    Empty for sets that are no larger than half a plain sketch, which serves them as well.
    """
    if len(shingles) <= 32 * SKETCH:
        return b""
    bits = 1 << (len(shingles) - 1).bit_length()
    odd = np.bincount((mix(shingles) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def wide_apart(x: np.ndarray, y: np.ndarray) -> int:
    """Bits in which two wide sketches (64-bit words) differ, the wider one folded: no more than their sets' shingles."""
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def id_type(docs: DataFrame) -> str:
    """Ids are whole numbers: of 64 bits, or as wide as a decimal."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return kind if kind.startswith("decimal") else "bigint"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast(id_type(docs)).alias("doc_id"), F.col("text").cast("string").alias("text"))


def shingle_frequencies(docs: DataFrame, n_words: int = WORDS) -> np.ndarray:
    """How often shingles of each hash bucket occur in all documents; 2^FREQUENCY_BITS counts.

    The counts order shingles from rare to frequent. Shingles of one bucket count alike and then go by hash,
    so the order is total, the same everywhere, and its table has a fixed size whatever the corpus.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << FREQUENCY_BITS, np.int64)
        for batch in small_slices(batches):
            hashes, _, _, bounds = words(batch.column(0), lower=True)
            grams = ngrams(hashes, n_words)
            inside = np.ones(len(grams), bool)
            for i in range(1, n_words):  # an n-gram must not reach into the next text
                edge = bounds[1:-1] - i
                inside[edge[(edge >= 0) & (edge < len(grams))]] = False
            counts += np.bincount(grams[inside] >> np.uint64(64 - FREQUENCY_BITS), minlength=len(counts))
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    total = _texts(docs).select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << FREQUENCY_BITS, np.int64)
    rows = total.toArrow()
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    # ranks need less room in every task than counts
    return np.unique(out, return_inverse=True)[1].astype(np.int32)


def prefix_length(n: int, percent: int) -> int:
    """Shingles of which two linked sets must share one: all but as many as they must share, and one more."""
    return n - -(-percent * n // 100) + 1


def describe_sets(docs: DataFrame, frequencies: np.ndarray, n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per document: row number, set size, set name, MinHash leaders, parity sketches, rare-first prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for batch in small_slices(batches):
            hashes, _, _, bounds = words(batch.column("text"), lower=True)
            sizes, ids, leaders, sketches, wide, prefixes = [], [], [], [], [], []
            for a, b in zip(bounds, bounds[1:]):
                s = shingle_set(hashes[a:b], n_words)
                sizes.append(len(s))
                if not len(s):
                    ids.append(None)
                    leaders.append([])
                    sketches.append([])
                    wide.append(b"")
                    prefixes.append([])
                    continue
                ids.append(set_name(s))
                spread = s * np.uint64(0x2545F4914F6CDD1D)
                leaders.append(mix(np.array([((spread ^ seed) * (seed | np.uint64(1))).min() for seed in _SEEDS[:LEADERS]],
                                            np.uint64) + _SEEDS[:LEADERS]).astype(np.int64))
                odd = np.bincount(mix(s) % np.uint64(64 * SKETCH), minlength=64 * SKETCH) & 1
                sketches.append(np.packbits(odd.astype(bool)).view(np.int64))
                wide.append(wide_sketch(s))
                order = np.argsort(frequencies[s >> np.uint64(64 - FREQUENCY_BITS)], kind="stable")
                prefixes.append(s[order[: prefix_length(len(s), percent)]].astype(np.int64))
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(row - batch.num_rows, row)), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                pa.array(leaders, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64())),
                pa.array(wide, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))], names=[c.split()[0] for c in SETS.split(", ")])

    return _texts(docs).mapInArrow(run, SETS.format(id_type(docs)))


def whole_sets(docs: DataFrame, wanted: DataFrame, n_words: int = WORDS) -> DataFrame:
    """``set_id, shingles`` of the sets in ``wanted`` (``set_id, name``, and ``doc_id`` of one document that has it).

    Rows that repeat an id and its text give the set once in each task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in small_slices(batches):
            hashes, _, _, bounds = words(batch.column("text"), lower=True)
            sets = [shingle_set(hashes[a:b], n_words) for a, b in zip(bounds, bounds[1:])]
            right = []
            for i, (key, want) in enumerate(zip(batch.column("set_id").to_pylist(), batch.column("name").to_pylist())):
                if key not in seen and len(sets[i]) and set_name(sets[i]) == want:
                    seen.add(key)
                    right.append(i)
            yield pa.RecordBatch.from_arrays([batch.column("set_id").take(pa.array(right, pa.int64())),
                                              pa.array([sets[i].tobytes() for i in right], pa.binary())],
                                             names=["set_id", "shingles"])

    wanted = written(wanted, "wanted")
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = _texts(docs).join(F.broadcast(wanted) if few else wanted, "doc_id")
    return texts.select("set_id", "name", "text").mapInArrow(run, "set_id long, shingles binary")


def verify(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs ``a, b`` of set ids whose whole sets are linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    first = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x"))
    second = sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near(percent: int, n: str = "n", m: str = "m", p: str = "p", q: str = "q") -> str:
    """Whether sizes ``n, m`` and sketches ``p0.., q0..`` allow a link: the length and suffix filters.

    Linked sets differ in at most n + m - 2 * ceil(percent * (n + m) / (100 + percent)) shingles.
    """
    apart = " + ".join(f"bit_count({p}{i} ^ {q}{i})" for i in range(SKETCH))
    needed = f"({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent}"
    return f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m}) and {apart} <= {n} + {m} - 2 * ({needed})"


def sketched(sets: DataFrame, name: str, size: str, letter: str) -> DataFrame:
    """``name`` (the set id), ``size`` and the words of the sketch as columns."""
    return sets.select(F.col("set_id").alias(name), F.col("n").alias(size),
                       *[F.col("sketch")[i].alias(f"{letter}{i}") for i in range(SKETCH)])


def wide_near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` that the suffix filter passes with wide sketches as well, if both sets have one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            total = batch.column("n").to_numpy() + batch.column("m").to_numpy()
            most = total + 2 * (-percent * total // (100 + percent))
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                keep[i] = not len(x) or not len(y) or wide_apart(x, y) <= most[i]
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    first = sets.select(F.col("set_id").alias("a"), "n", F.col("wide").alias("x"))
    second = sets.select(F.col("set_id").alias("b"), F.col("n").alias("m"), F.col("wide").alias("y"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "n", "m", "x", "y").mapInArrow(run, "a long, b long")


def first_rows(described: DataFrame, one: DataFrame) -> DataFrame:
    """The rows of ``described`` that ``one`` names (``set_id``, their row numbers), as ``set_id``.

    A description is as wide as its prefix, so it stays where it is: row numbers run on within a task, and a bit for each
    tells whether it is wanted.
    """
    bits = one.groupBy(F.bitmap_bucket_number("set_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("set_id")).alias("bits"))
    bits = written(bits, "first_rows")
    if bits.limit(BITMAPS + 1).count() > BITMAPS:
        return described.join(one.select(F.col("set_id").alias("row")), "row", "left_semi").withColumnRenamed("row", "set_id")
    at = F.bitmap_bit_position("row")
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = described.withColumn("bucket", F.bitmap_bucket_number("row")).join(F.broadcast(bits), "bucket")
    return rows.where(F.get(F.array(*[byte.bitwiseAND(1 << i) for i in range(8)]), F.pmod(at, F.lit(8)).cast("int")) > 0).select(
        *described.columns).withColumnRenamed("row", "set_id")


def leader_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a set and a set that shares one of its MinHash values: at most LEADERS for a set.

    It is the one whose values are shared most, so a central one of a group of near copies; of several the largest by
    a hash of id and value, which is another one for each value.
    Those that the length and suffix filters rule out are left out.
    """
    keys = sets.select("set_id", F.explode("leaders").alias("key"))
    times = keys.groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    shared = keys.join(times, "key")
    weight = shared.groupBy("set_id").agg(F.sum("times").alias("weight"))
    best = F.struct(F.col("weight"), F.xxhash64("set_id", "key").alias("m"), F.col("set_id"))
    least = shared.join(weight, "set_id").groupBy("key").agg(F.max(best).alias("best")).select("key", F.col("best.set_id").alias("b"))
    pairs = keys.join(least, "key").where("set_id <> b").select(F.col("set_id").alias("a"), "b").distinct()
    return pairs.join(sketched(sets, "a", "n", "p"), "a").join(sketched(sets, "b", "m", "q"), "b").where(near(percent)).select("a", "b")


def shared_postings(sets: DataFrame) -> DataFrame:
    """``set_id, at, shingle, times`` of the prefix shingles that several sets have."""
    postings = sets.select("set_id", F.posexplode("prefix").alias("at", "shingle"))
    often = postings.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1")
    return postings.join(often, "shingle")


def crowd_pairs(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a set and one other set of each prefix shingle that CROWD sets or more share.

    It is another one for each shingle, so a set that is linked with some of a large group of near copies finds one of
    them, whichever its leaders are. There are no more pairs than postings; those that the length and suffix
    filters rule out are left out.
    """
    crowd = shared.where(F.col("times") >= CROWD).select("set_id", "shingle")
    one = crowd.groupBy("shingle").agg(F.max(F.struct(F.xxhash64("set_id", "shingle").alias("h"), "set_id")).alias("one"))
    pairs = crowd.join(one.select("shingle", F.col("one.set_id").alias("b")), "shingle").where("set_id <> b").select(
        F.greatest("set_id", "b").alias("a"), F.least("set_id", "b").alias("b")).distinct()
    return pairs.join(sketched(sets, "a", "n", "p"), "a").join(sketched(sets, "b", "m", "q"), "b").where(near(percent)).select("a", "b")


def mixed_postings(shared: DataFrame, sets: DataFrame, groups: DataFrame) -> DataFrame:
    """The postings of shingles that sets of different groups ``g`` have, with sizes and sketches.

    ``groups`` has ``node, component`` of sets that are connected already: their links cannot change the
    result. A shingle whose sets all are in one group gives no pair.
    """
    named = shared.drop("times").join(groups.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "g", F.coalesce("component", "set_id")).drop("component")
    mixed = named.groupBy("shingle").agg(F.min("g").alias("low"), F.max("g").alias("high")).where("low <> high").select("shingle")
    return named.join(mixed, "shingle", "left_semi").join(sketched(sets, "set_id", "n", "p"), "set_id")


def pairs_ahead(mixed: DataFrame) -> float:
    """Pairs of sets of different groups that shingles bring together, for each of their sets; 0 without any."""
    each = mixed.groupBy("shingle", "g").agg(F.count("*").cast("double").alias("n"))
    total = each.groupBy("shingle").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same")).agg(
        F.sum("n"), F.sum(F.col("n") * F.col("n") - F.col("same")) / 2).first()
    return total[1] / total[0] if total[0] else 0.0


def group_pairs(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """PICKS pairs for each shingle and group: sets of the group, and sets of the group that has most sets there.

    Which sets they are changes with the shingle and the pick, so a group that is linked with a few sets of a large one
    meets one of them. There are no more pairs than PICKS for each posting, whatever the sizes of the groups.
    """
    picks = [F.max(F.struct(F.xxhash64("set_id", "shingle", F.lit(k)).alias("h"), F.col("set_id"))).alias(f"k{k}") for k in range(PICKS)]
    each = mixed.groupBy("shingle", "g").agg(F.count("*").alias("n"), *picks).select(
        "shingle", "g", "n", F.array(*[F.col(f"k{k}.set_id") for k in range(PICKS)]).alias("picks"))
    most = each.groupBy("shingle").agg(F.max(F.struct("n", "g", "picks")).alias("most")).select(
        "shingle", F.col("most.g").alias("h"), F.col("most.picks").alias("others"))
    pairs = each.join(most, "shingle").where("g <> h").select(
        F.explode(F.arrays_zip("picks", "others")).alias("p")).select(F.col("p.picks").alias("a"), F.col("p.others").alias("b")).distinct()
    return pairs.join(sketched(sets, "a", "n", "p"), "a").join(sketched(sets, "b", "m", "q"), "b").where(near(percent)).select("a", "b")


def prefix_pairs(some: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of different groups that share a prefix shingle and pass all filters."""
    # what both can still share from this shingle on must reach the overlap that a link needs
    position = f"{100 + percent} * (1 + least(x.n - x.at - 1, y.n - y.at - 1) + least(x.at, y.at)) >= {percent} * (x.n + y.n)"
    # neither side renames its columns before the join: Spark then exchanges the postings once for both
    pairs = some.alias("x").join(some.alias("y"), "shingle").where(
        f"x.g < y.g and {position} and {near(percent, 'x.n', 'y.n', 'x.p', 'y.p')}").selectExpr("x.set_id as a", "y.set_id as b").distinct()
    return wide_near(written(pairs, "pairs"), sets, percent)


def confirmed(docs: DataFrame, pairs: DataFrame, sets: DataFrame, n_words: int, percent: int) -> DataFrame:
    """The links among candidate pairs, verified on the whole sets of their documents."""
    pairs = written(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("set_id")).unionAll(pairs.select("b")).distinct().join(
        sets.select("set_id", "doc_id", "name"), "set_id")
    return written(verify(pairs, written(whole_sets(docs, wanted, n_words), "whole_sets"), percent), "links")


def joined_groups(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component`` of the groups after further links."""
    return written(components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(links)), "groups")


def near_duplicates(docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    Words are runs without ASCII white space, A-Z lower-cased. Two documents link when 100 * intersection >=
    ``percent`` * union of their sets of ``n_words``-word shingles (fewer words: the whole sequence as one
    shingle); ``component_id`` is the smallest doc_id that links reach. Null or empty texts have no shingles and
    are linked with nothing. Rows may repeat a doc_id; each has its own text's result. A null doc_id has the
    component of its text's links, or null. Other columns are not read. Sets are compared by 64-bit hashes of
    their shingles.

    1. Equal sets are one set from here on; a group of copies costs one aggregate.
    2. Each set is compared with one leader for each of its MinHash values, and with one other set of each of its
       crowded prefix shingles. The verified links connect a group of near copies through a few of its members, whatever
       its size.
    3. While the prefixes bring together far more pairs than sets, one pair of each shingle and group is compared.
    4. Rare-first prefixes are joined, but for sets that are connected already; pairs that pass the length,
       position and suffix filters are verified once, so no link between different groups is lost.
    """
    frequencies = shingle_frequencies(docs, n_words)
    described = written(describe_sets(docs, frequencies, n_words, percent), "sets")
    # a set goes by the row number of its first document from here on
    one = written(described.where("name is not null and doc_id is not null").groupBy("name").agg(F.min("row").alias("set_id")), "names")
    sets = written(first_rows(described, one), "distinct_sets")
    shared = written(shared_postings(sets), "postings")
    first = leader_pairs(sets, percent).unionAll(crowd_pairs(shared, sets, percent))
    groups = written(components(confirmed(docs, first.distinct(), sets, n_words, percent)), "groups")
    mixed = written(mixed_postings(shared, sets, groups), "postings")
    ahead, before = pairs_ahead(mixed), math.inf
    # a turn that spares little says that what is left apart is hardly linked: the whole join decides
    while ahead > PAIRS_PER_SET and ahead < WORTH * before:
        groups = joined_groups(groups, confirmed(docs, group_pairs(mixed, sets, percent), sets, n_words, percent))
        mixed = written(mixed_postings(shared, sets, groups), "postings")
        ahead, before = pairs_ahead(mixed), ahead
    joined = joined_groups(groups, confirmed(docs, prefix_pairs(mixed, sets, percent), sets, n_words, percent))
    of_set = one.join(joined.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "name", F.coalesce("component", "set_id").alias("group"))
    rows = described.select("doc_id", "n", "name").join(of_set, "name", "left")
    least = rows.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "group", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of the smallest doc_id.

    Rows with a null doc_id stay. Documents without shingles are no near duplicates and stay. Rows are told apart by
    120 bits of hashes of doc_id and text: of rows that share a doc_id but not the text each is judged by its own text, and
    of rows that repeat both one stays, the least as JSON.
    """
    named = (F.col("doc_id").cast("long"), F.col("text").cast("string"))
    row = F.when(F.col("doc_id").isNotNull(), F.concat(
        F.xxhash64(*named).cast("string"), F.lpad(F.pmod(F.xxhash64(F.lit("row"), *named), F.lit(10**18)).cast("string"), 18, "0")).cast(
        "decimal(38,0)"))
    rows = docs.select(row.alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), "text").where("_row is not null")
    found = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), n_words, percent)
    judged = found.groupBy(F.col("doc_id").alias("_row")).agg(
        F.min("component_id").alias("group"), F.expr("count(*) > 1 and max(n_shingles) > 0").alias("repeated"))
    kept = written(judged.join(rows.select("_row", "doc_id").distinct(), "_row").groupBy("group").agg(
        F.min(F.struct("doc_id", "_row", "repeated")).alias("kept")).select("kept._row", "kept.repeated"), "kept")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    left = docs.select(whole.alias("whole"), row.alias("_row")).join(kept, "_row", "left").where(
        "_row is null or repeated is not null")
    if not kept.where("repeated").limit(1).count():
        return left.select("whole.*")
    once = left.where("_row is not null and repeated").groupBy("_row").agg(
        F.min_by("whole", F.to_json("whole")).alias("whole"))
    return left.where("_row is null or not repeated").select("whole.*").unionAll(once.select("whole.*"))
