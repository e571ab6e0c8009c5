"""Exact top-k inner products: a ball tree per shard, branch and bound, the kth score shared between shards."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.llm.common import written

#: Vectors of one shard at most, of one tree leaf, and queries that travel together.
SHARD_ROWS = 4096
LEAF_ROWS = 64
BLOCK_QUERIES = 256
#: Centres that vectors are dealt to; a crowded centre is dealt on by a hash of the id.
MAX_CENTRES = 512
LOW = np.iinfo(np.int64).min

TREE = "shard long, dim int, kind string, ids binary, vectors binary, query_id long, number long, floor long, floor_id long"


def whole_vectors(table: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """``id, x``: each component x as floor(scale * x); rows without id, vector or with non-finite parts go."""
    return (
        table.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
        .where("id is not null and v is not null and size(v) > 0")
        .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))))
        .select("id", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("x"))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column whose rows have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _safe(vectors: np.ndarray, queries: np.ndarray) -> bool:
    """Whether inner products are exact in doubles."""
    if not vectors.size or not queries.size:
        return True
    return float(np.abs(vectors).max()) * float(np.abs(queries).max()) * vectors.shape[1] < 2.0 ** 52


class BallTree:
    """Centres, radii and smallest ids of a binary tree over integer vectors; the leaves hold row ranges."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        centres, radii, firsts, self.spans, self.children = [], [], [], [], []
        todo = [(0, len(ids), None)]
        while todo:
            start, stop, parent = todo.pop()
            part = self.vectors[start:stop].astype(np.float64)
            centre = part.mean(axis=0)
            distance = np.sqrt(((part - centre) ** 2).sum(axis=1))
            node = len(centres)
            centres.append(centre)
            radii.append(distance.max())
            firsts.append(self.ids[start:stop].min())
            self.spans.append((start, stop))
            self.children.append([])
            if parent is not None:
                self.children[parent].append(node)
            if stop - start > leaf_rows and radii[-1] > 0:
                # split along the line through two far points
                far = part[distance.argmax()]
                other = part[((part - far) ** 2).sum(axis=1).argmax()]
                side = part @ (other - far)
                turn = np.argsort(side, kind="stable")
                middle = (stop - start) // 2
                for name in ("ids", "vectors"):
                    whole = getattr(self, name)
                    whole[start:stop] = whole[start:stop][turn]
                todo += [(start, start + middle, node), (start + middle, stop, node)]
        self.centres, self.radii, self.firsts = np.array(centres), np.array(radii), np.array(firsts)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray, floor_ids: np.ndarray):
        """Per query the up to k best ``(score, id)``, best first, among those not worse than its floor.

        Nodes are opened in the order of their upper bound q.c + |q| r. A node whose bound is below the
        current kth score cannot add anything; at equal score it must hold a smaller id.
        """
        exact = _safe(self.vectors, queries)
        data = self.vectors.astype(np.float64) if exact else self.vectors
        lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        dots = queries.astype(np.float64) @ self.centres.T
        # the slack covers rounding of centres, radii and bounds
        bounds = dots + lengths[:, None] * self.radii[None, :]
        bounds = np.floor(bounds + 1e-6 + 1e-9 * np.abs(bounds))
        for i, (own, floor, floor_id) in enumerate(zip(query_ids, floors, floor_ids)):
            query = queries[i].astype(np.float64) if exact else queries[i]
            best: list[tuple[int, int]] = []  # heap of (score, -id): its root is the worst kept
            worst = (int(floor), -int(floor_id))  # a candidate must be at least as good
            queue = [(-bounds[i, 0], 0)]
            while queue:
                bound, node = heapq.heappop(queue)
                if -bound < worst[0]:
                    break
                if -bound == worst[0] and -int(self.firsts[node]) < worst[1]:
                    continue
                if self.children[node]:
                    for child in self.children[node]:
                        if bounds[i, child] >= worst[0]:
                            heapq.heappush(queue, (-bounds[i, child], child))
                    continue
                start, stop = self.spans[node]
                scores = data[start:stop] @ query
                for j in np.flatnonzero(scores >= worst[0]):
                    entry = (int(scores[j]), -int(self.ids[start + j]))
                    if entry < worst or -entry[1] == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    else:
                        heapq.heappushpop(best, entry)
                    if len(best) == k:
                        worst = max(worst, best[0])
            yield [(score, -minus) for score, minus in sorted(best, reverse=True)]


def _centres(vectors: DataFrame, count: int) -> DataFrame:
    """Up to ``count`` vectors per dimension by a hash of the vector: the centres are a bounded sample."""
    return (vectors.select("x", F.size("x").alias("dim")).distinct()
            .orderBy(F.xxhash64("x"), "x").limit(count))


def top_k(table: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 20, scale: float = 64.0,
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The k highest integer inner products of each query with every other row: ``query_id, rank, <key>, score``.

    ``is_query`` is a condition on ``id``. Components are floor(scale * x). Ties go to the smaller id; a
    query with fewer than k others returns them all. Rows without id or vector, or with null or non-finite
    components, take no part; vectors of different length are not compared. A repeated id is a candidate
    as often as it occurs, never for a query of its own id; each row of a repeated query id has its own
    results. Inner products must fit a long.

    1. Vectors go to the nearest of up to 512 sampled centres; crowded centres are dealt on by id, so that
       a shard has about ``shard_rows`` rows whatever repeats. Each shard builds its ball tree once.
    2. A query first searches the tree of its own shard. Its kth score there is the floor that all other
       shards share from then on.
    3. Blocks of queries meet the shards whose outer ball can still beat a floor, and search there.
    4. The results of a query, at most k from a shard, are ranked.
    """
    if not 0 < k <= 1000:
        raise ValueError("k must be between 1 and 1000")
    spark = table.sparkSession
    vectors = written(whole_vectors(table, key, vector, scale), "vectors")
    total = vectors.count()
    wanted = int(min(MAX_CENTRES, max(1, total // shard_rows)))
    rows = _centres(vectors, wanted).collect()
    centres = {}
    for dim in {r.dim for r in rows}:
        centres[dim] = np.array([r.x for r in rows if r.dim == dim], np.float64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            dims = np.diff(np.asarray(x.offsets))
            place = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                if dim in centres:
                    c = centres[dim]
                    v = _matrix(x.take(pa.array(mine))).astype(np.float64)
                    place[mine] = ((v ** 2).sum(1)[:, None] - 2 * v @ c.T + (c ** 2).sum(1)[None, :]).argmin(1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), x, pa.array(dims.astype(np.int32)), pa.array(place)],
                                             names=["id", "x", "dim", "place"])

    dealt = written(vectors.mapInArrow(deal, "id long, x array<long>, dim int, place long"), "dealt")
    crowd = dealt.groupBy("dim", "place").agg(F.ceil(F.count("*") / F.lit(float(shard_rows))).alias("parts"))
    sharded = dealt.join(F.broadcast(crowd), ["dim", "place"]).select(  # at most 512 rows a dimension
        "id", "x", "dim", F.xxhash64("dim", "place", F.pmod(F.xxhash64("id"), F.col("parts"))).alias("shard"),
        is_query.alias("is_query"))

    def build(keys, group):
        ids = group.column("id").to_numpy().astype(np.int64)
        data = _matrix(group.column("x"))
        asks = np.flatnonzero(group.column("is_query").to_numpy(zero_copy_only=False))
        asked, queries = ids[asks].copy(), data[asks].copy()
        tree = BallTree(ids.copy(), data)
        shard, dim = keys[0].as_py(), keys[1].as_py()
        out = [(shard, dim, "tree", tree.ids.tobytes(), tree.vectors.tobytes(), None, None, None, None)]
        root = np.concatenate([tree.centres[0], tree.radii[:1]])
        out.append((shard, dim, "ball", None, root.tobytes(), None, None, None, int(tree.firsts[0])))
        found = tree.search(asked, queries, k, np.full(len(asks), LOW), np.zeros(len(asks), np.int64))
        seen = Counter()  # equal rows of an id are in one shard; their numbers tell them apart
        for i, best in enumerate(found):
            row = int(asked[i]), queries[i].tobytes()
            seen[row] += 1
            pairs = np.array(best, np.int64).reshape(-1, 2)
            full = len(best) == k
            out.append((shard, dim, "query", pairs.tobytes(), row[1], row[0], seen[row],
                        best[-1][0] if full else LOW, best[-1][1] if full else 0))
        types = [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)],
                        names=["shard", "dim", "kind", "ids", "vectors", "query_id", "number", "floor", "floor_id"])

    built = written(sharded.groupBy("shard", "dim").applyInArrow(build, TREE), "trees")
    trees = built.where("kind = 'tree'").select("shard", "dim", F.col("ids").alias("tree_ids"),
                                                F.col("vectors").alias("tree_vectors"))
    balls = built.where("kind = 'ball'").select("shard", "dim", "vectors", "floor_id")
    asked = built.where("kind = 'query'").withColumn("ask", F.xxhash64("query_id", "number", "vectors"))

    # blocks of queries from one shard, and the shards' outer balls in blocks
    blocks = (
        asked.withColumn("part", F.pmod("ask", F.ceil(F.count("*").over(_by("shard")) / F.lit(float(BLOCK_QUERIES)))))
        .groupBy("shard", "dim", "part")
        .agg(F.sort_array(F.collect_list(F.struct("ask", "query_id", "vectors", "floor", "floor_id"))).alias("asks"))
        .withColumnRenamed("shard", "home")
    )
    ball_blocks = (
        balls.withColumn("part", F.pmod("shard", F.lit(int(max(1, total // shard_rows // 512)))))
        .groupBy("dim", "part").agg(F.collect_list(F.struct("shard", "vectors", "floor_id")).alias("balls"))
        .drop("part")
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Which queries of a block still need which shard."""
        for batch in batches:
            for row in batch.to_pylist():
                x = np.array([np.frombuffer(a["vectors"], np.int64) for a in row["asks"]]).astype(np.float64)
                floors = np.array([a["floor"] for a in row["asks"]])
                balls_ = np.array([np.frombuffer(b["vectors"], np.float64) for b in row["balls"]])
                bound = x @ balls_[:, :-1].T + np.sqrt((x ** 2).sum(1))[:, None] * balls_[None, :, -1]
                open_ = np.floor(bound + 1e-6 + 1e-9 * np.abs(bound)) >= floors[:, None]
                for j, ball in enumerate(row["balls"]):
                    picked = np.flatnonzero(open_[:, j])
                    if ball["shard"] != row["home"] and len(picked):
                        asks = [row["asks"][i] for i in picked]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([ball["shard"]]),
                            pa.array([np.array([(a["ask"], a["query_id"], a["floor"], a["floor_id"]) for a in asks],
                                               np.int64).tobytes()], pa.binary()),
                            pa.array([b"".join(a["vectors"] for a in asks)], pa.binary())], names=["shard", "asks", "x"])

    routed = blocks.join(ball_blocks, "dim").repartition("home", "part").mapInArrow(
        route, "shard long, asks binary, x binary")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree = None, None
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["tree_ids"], np.int64)
                if row["shard"] != shard:
                    shard, tree = row["shard"], BallTree(
                        ids.copy(), np.frombuffer(row["tree_vectors"], np.int64).reshape(len(ids), -1).copy())
                asks = np.frombuffer(row["asks"], np.int64).reshape(-1, 4)
                x = np.frombuffer(row["x"], np.int64).reshape(len(asks), -1)
                out = []
                for ask, best in zip(asks, tree.search(asks[:, 1], x, k, asks[:, 2], asks[:, 3])):
                    out += [(ask[0], ask[1], i, s) for s, i in best]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.array(out, np.int64).T],
                                                     names=["ask", "query_id", "id", "score"])

    elsewhere = routed.join(trees, "shard").mapInArrow(search, "ask long, query_id long, id long, score long")

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ask, query, pairs in zip(*(batch.column(c).to_pylist() for c in ("ask", "query_id", "ids"))):
                p = np.frombuffer(pairs, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), ask)), pa.array(np.full(len(p), query)),
                                                  pa.array(p[:, 1]), pa.array(p[:, 0])],
                                                 names=["ask", "query_id", "id", "score"])

    at_home = asked.select("ask", "query_id", "ids").mapInArrow(own, "ask long, query_id long, id long, score long")
    ranked = at_home.unionAll(elsewhere).withColumn("rank", F.row_number().over(
        _by("ask", "query_id").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")


def _by(*columns):
    from pyspark.sql import Window
    return Window.partitionBy(*columns)
