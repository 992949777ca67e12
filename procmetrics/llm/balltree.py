"""Exact top-k by inner product with ball trees.

Vectors are dealt by a hash of their id into shards of bounded size. Each shard builds a ball
tree; the inner products of a query q with a ball of centre c and radius r are at most
``q . c + |q| r``. A block of queries walks the tree by the largest such bound, drops
queries whose current kth score beats a node's bound, and multiplies what is left in the leaves. Every
query first searches its home shard; the kth score found there is what all other shards start from.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import store

SCALE = 64
#: Values (rows times dimensions) of a shard, on average.
SHARD_VALUES = 1 << 19
LEAF, BLOCK = 256, 512
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
FOUND = "query_id long, vec_id long, score long"


class BallTree:
    """A ball tree over the rows of an integer matrix."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        order = np.lexsort((ids, *vectors.T)) if vectors.shape[1] else np.argsort(ids)
        ids, vectors = ids[order], vectors[order]
        # of equal vectors only the k + 1 smallest ids can be in a top k (one may be the query's own)
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        place = np.arange(len(ids))
        keep = place - np.maximum.accumulate(np.where(new, place, 0)) <= k
        self.ids, self.x = ids[keep], vectors[keep]
        # products and their sums are whole numbers; doubles hold them exactly below 2**53
        big = float(np.abs(self.x).max(initial=0)) if self.x.size else 0.0
        self.bound = big
        self.nodes: list[tuple] = []
        self._build(np.arange(len(self.ids)))

    def _build(self, rows: np.ndarray) -> None:
        """Nodes (centre, radius, left, right, rows), split where a random direction of spread halves the rows."""
        pending = [(rows, None, 0)]
        while pending:
            rows, parent, side = pending.pop()
            x = self.x[rows].astype(np.float64)
            centre = x.mean(axis=0)
            far = np.sqrt(((x - centre) ** 2).sum(axis=1))
            at = len(self.nodes)
            if parent is not None:
                self.nodes[parent][2 + side] = at
            leaf = len(rows) <= LEAF
            self.nodes.append([centre, float(far.max(initial=0)), -1, -1, rows if leaf else None])
            if leaf:
                continue
            a = x[far.argmax()]
            b = x[((x - a) ** 2).sum(axis=1).argmax()]
            half = len(rows) // 2
            cut = np.argpartition(x @ (b - a), half)
            pending += [(rows[cut[:half]], at, 0), (rows[cut[half:]], at, 1)]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int):
        """Scores and ids (each b x k, score ``_LOW`` where there is none) of all that may be among the best k.

        ``floors``: scores that are reached k times elsewhere; what is below is left out.
        """
        b = len(query_ids)
        best, who = np.full((b, k), _LOW), np.full((b, k), _HIGH)
        floor, floor_id = floors.copy(), np.full(b, _HIGH)
        exact = self.bound * float(np.abs(queries).max(initial=0)) * max(1, queries.shape[1]) < 2.0 ** 53
        kind = np.float64 if exact else np.int64
        q, qf = queries.astype(kind), queries.astype(np.float64)
        length = np.sqrt((qf ** 2).sum(axis=1))

        def upper(node, some):
            u = qf[some] @ node[0] + length[some] * node[1]
            return u + 1e-9 * np.abs(u) + 1e-6

        every = np.arange(b)
        u = upper(self.nodes[0], every)
        heap = [(-u.max(initial=-np.inf), 0, every, u)]
        while heap:
            _, at, some, u = heapq.heappop(heap)
            live = u >= floor[some]
            some = some[live]
            if not len(some):
                continue
            node = self.nodes[at]
            if node[4] is None:
                for child in node[2:4]:
                    u = upper(self.nodes[child], some)
                    live = u >= floor[some]
                    if live.any():
                        heapq.heappush(heap, (-u[live].max(), child, some[live], u[live]))
                continue
            ids = self.ids[node[4]]
            scores = np.rint(q[some] @ self.x[node[4]].T.astype(kind)).astype(np.int64)
            good = ((scores > floor[some, None]) | ((scores == floor[some, None]) & (ids < floor_id[some, None]))) & (
                ids != query_ids[some, None])
            hit = good.any(axis=1)
            rows = some[hit]
            if not len(rows):
                continue
            s = np.concatenate([best[rows], np.where(good[hit], scores[hit], _LOW)], axis=1)
            i = np.concatenate([who[rows], np.where(good[hit], ids, _HIGH)], axis=1)
            order = np.lexsort((i, -s.astype(np.float64) if exact else ~s), axis=1)[:, :k]
            best[rows] = s = np.take_along_axis(s, order, axis=1)
            who[rows] = i = np.take_along_axis(i, order, axis=1)
            better = (s[:, -1] > floor[rows]) | ((s[:, -1] == floor[rows]) & (i[:, -1] < floor_id[rows]))
            floor[rows[better]], floor_id[rows[better]] = s[better, -1], i[better, -1]
        return best, who


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _search(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come by (dim, shard), vectors before queries
        now, ids, vectors, tree = None, [], [], None
        for b in batches:
            dims, shards, kinds = (b.column(c).to_numpy() for c in ("dim", "shard", "kind"))
            edges = np.flatnonzero((np.diff(dims) != 0) | (np.diff(shards) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *edges], [*edges, b.num_rows], strict=True):
                if lo == hi:
                    continue
                part, key = b.slice(lo, hi - lo), (dims[lo], shards[lo])
                if key != now:
                    now, ids, vectors, tree = key, [], [], None
                own, x = part.column("id").to_numpy(), _matrix(part.column("vec"), int(dims[lo]))
                if kinds[lo] == 0:
                    ids.append(own)
                    vectors.append(x)
                    continue
                if not ids:
                    continue
                if tree is None:
                    tree = BallTree(np.concatenate(ids), np.concatenate(vectors), k)
                floors = part.column("floor").fill_null(_LOW).to_numpy(zero_copy_only=False)
                for at in range(0, len(own), BLOCK):
                    cut = slice(at, at + BLOCK)
                    best, who = tree.search(own[cut], x[cut], floors[cut], k)
                    row, col = np.nonzero(best != _LOW)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[cut][row]), pa.array(who[row, col]), pa.array(best[row, col])],
                        names=["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, shard_values: int = SHARD_VALUES) -> DataFrame:
    """The ``k`` largest inner products of each query with all other rows of ``vectors`` (vec_id, embedding).

    Queries are the rows whose vec_id is divisible by ``every``. A component x counts as floor(64 x). Rows whose
    id or vector is null, or whose vector holds a null or non-finite component, take no part; an id that is
    repeated stands for its smallest vector; vectors of different lengths are not compared. Ties go to the smaller vec_id; with fewer than k
    candidates all are returned. Components and scores have to fit 64 bits. Other columns are not read; an
    empty table gives an empty result.
    """
    d = vectors.where("vec_id is not null and embedding is not null").select(
        F.col("vec_id").cast("long").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    d = d.where(~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    d = d.select("id", F.transform("e", lambda x: F.floor(x * SCALE)).alias("vec")).groupBy("id").agg(F.min("vec").alias("vec"))
    d = store(d.withColumn("dim", F.size("vec")), "vectors")
    values = d.agg(F.sum(F.col("dim").cast("long"))).first()[0] or 0
    shards = max(1, -(-values // shard_values))
    home = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    base = d.select("dim", home.alias("shard"), F.lit(0).alias("kind"), "id", "vec", F.lit(None).cast("long").alias("floor"))
    ask = d.where(F.col("id") % every == 0)

    def search(queries: DataFrame) -> DataFrame:
        return (base.unionByName(queries).repartition(F.col("dim"), F.col("shard"))
                .sortWithinPartitions("dim", "shard", "kind", "id").mapInArrow(_search(k), FOUND))

    near = store(search(ask.select("dim", home.alias("shard"), F.lit(1).alias("kind"), "id", "vec",
                                   F.lit(None).cast("long").alias("floor"))), "near")
    floors = (near.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n"), F.min("score").alias("floor"))
              .select("id", F.when(F.col("n") >= k, F.col("floor")).alias("floor")))
    far = (ask.join(floors, "id", "left").withColumn("home", home)
           .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
           .select("dim", "shard", F.lit(1).alias("kind"), "id", "vec", "floor"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (near.unionByName(search(far)).withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = """
with v as (
  select vec_id, [floor(64 * x::double)::bigint for x in embedding] as vec from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
q as (select * from v where vec_id % 20 = 0),
s as (select q.vec_id as query_id, v.vec_id,
        list_sum([a * v.vec[i] for a, i in q.vec])::bigint as score
      from q join v on q.vec_id <> v.vec_id)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from s qualify rank <= 20
"""
