"""Exact top-k inner product by a ball tree per shard, branch and bound, with a shared k-th score.

Vectors are dealt by hash into shards of about ``SHARD_ROWS``; each shard meets each block of
queries in one task. A task builds a ball tree (split at the median of the direction between two
far points), and takes the nodes for a query in falling order of their bound ``q . centre + |q| radius``
until the bound falls below the k-th score known.

The k-th score is shared in two rounds. Round one searches every query in one shard only, the first, which
gives a lower bound of its final k-th score. Round two sends that bound to all other shards, so they
prune from the start with it. The k best of all shards are ranked at the end. Bounds carry a
slack for rounding and only strictly smaller ones prune, so ties are whole and the result is exact.

Defined results: vectors that are null or hold null or non-finite parts take no part; nor do those with a part beyond
``LARGEST`` in integer form, whose products would leave exact arithmetic, and rows without a ``vec_id``; vectors of different
lengths count missing parts as 0; a repeated row is a row of its own and a candidate for its twin; ties
go to the smaller vec_id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heliolake.llm.common import stored, table

K = 5
SCALE = 256
EVERY = 50
SHARD_ROWS = 8192
QUERY_BLOCK = 1024
LEAF = 64
#: Integer parts up to this size make sums that are exact in 64 bits for vectors of up to 2^9 parts (2^53 / 2^44).
LARGEST = 1 << 22


@dataclass
class Node:
    lo: int
    hi: int
    centre: np.ndarray
    radius: float
    children: tuple[Node, Node] | None = None


class BallTree:
    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.x = x
        self.root = self._build(0, len(x)) if len(x) else None
        self.x = x[self.order]

    def _build(self, lo: int, hi: int) -> Node:
        own = self.order[lo:hi]
        points = self.x[own]
        centre = points.mean(0)
        away = ((points - centre) ** 2).sum(1)
        node = Node(lo, hi, centre, float(np.sqrt(away.max())))
        if hi - lo <= LEAF or node.radius == 0:
            return node
        a = points[away.argmax()]
        b = points[((points - a) ** 2).sum(1).argmax()]
        side = points @ (b - a)
        mid = (hi - lo) // 2
        self.order[lo:hi] = own[np.argpartition(side, mid)]
        node.children = (self._build(lo, lo + mid), self._build(lo + mid, hi))
        return node

    def search(self, queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, kth: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """For each query its best ``(score, place)`` by falling score and rising id, at most ``k``.

        Nodes are visited in falling order of their mean bound over the queries still open there; a query
        leaves a node when its bound is below its own k-th score, which rises as leaves are read.
        """
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        if self.root is None:
            return best
        norms = np.sqrt((queries ** 2).sum(1))
        floor = kth.copy()
        rows, ids = rows[self.order], ids[self.order]
        stack = [(self.root, np.arange(len(queries)))]
        while stack:
            node, live = stack.pop()
            bound = queries[live] @ node.centre + norms[live] * node.radius
            live = live[bound * (1 + 1e-9) + 1e-6 + 1e-9 * np.abs(bound) >= floor[live]]
            if not len(live):
                continue
            if node.children:
                nearer = [float((queries[live] @ c.centre + norms[live] * c.radius).sum()) for c in node.children]
                # the child with the higher bound is taken first
                for i in np.argsort(nearer):
                    stack.append((node.children[int(i)], live))
                continue
            scores = queries[live] @ self.x[node.lo:node.hi].T
            scores[rows[None, node.lo:node.hi] == own[live][:, None]] = -np.inf
            for j, q in enumerate(live):
                found = np.flatnonzero((scores[j] >= floor[q]) & np.isfinite(scores[j]))
                if not len(found):
                    continue
                merged = best[q] + [(int(scores[j][f]), node.lo + int(f)) for f in found]
                merged.sort(key=lambda s: (-s[0], ids[s[1]]))
                best[q] = merged[:k]
                if len(best[q]) == k:
                    floor[q] = max(floor[q], best[q][-1][0])
        return [[(s, int(self.order[p])) for s, p in b] for b in best]


def _matrix(parts: pd.Series) -> np.ndarray:
    width = max((len(p) for p in parts), default=0)
    out = np.zeros((len(parts), width))
    for i, p in enumerate(parts):
        out[i, :len(p)] = p
    return out


def _searcher(k: int):
    def run(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries):
            x, q = _matrix(vectors["v"]), _matrix(queries["qv"])
            width = max(x.shape[1], q.shape[1])
            x, q = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, q))
            rows, ids = vectors["row"].to_numpy(), vectors["vec_id"].to_numpy()
            found = BallTree(x).search(q, queries["query_row"].to_numpy(), rows, ids, queries["kth"].fillna(-np.inf).to_numpy(float), k)
            for (row, qid), hits in zip(zip(queries["query_row"], queries["query_id"]), found):
                out += [(row, qid, int(rows[p]), int(ids[p]), s) for s, p in hits]
        return pd.DataFrame(out, columns=["query_row", "query_id", "row", "vec_id", "score"]).astype("int64")
    return run


def integer_vectors(table_: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``row, vec_id, v``: usable vectors with floor(scale * x), numbered once and stored."""
    x = F.col(vector_col)
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double"))
    usable = usable & F.forall(x, lambda c: F.abs(c.cast("double")) * scale < LARGEST)
    rows = table_.where(F.col(id_col).isNotNull()).where(usable).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "search-vectors")


def _best(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits per query; a query has at most ``k`` hits per shard, and ranks keep the first k rows per task."""
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best for each row of ``queries`` (rows of ``integer_vectors``)."""
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-queries.count() // query_block))
    hashed = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    dealt = vectors.withColumn("shard", hashed(shards))
    # new names for the queries' columns, since both sides of a cogroup may come from one table
    asked = queries.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("v").alias("qv"),
                           F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int").alias("qblock"))
    schema = "query_row long, query_id long, row long, vec_id long, score long"

    def search(data: DataFrame, asks: DataFrame, first: int, last: int) -> DataFrame:
        """Every shard from ``first`` to ``last`` against every block: both sides copied once per partner."""
        left = data.where(F.col("shard").between(first, last)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        right = asks.withColumn("qshard", F.explode(F.sequence(F.lit(first), F.lit(last))))
        return left.groupBy("shard", "block").cogroup(right.groupBy("qshard", "qblock")).applyInPandas(_searcher(k), schema)

    opening = stored(search(dealt, asked.withColumn("kth", F.lit(None).cast("double")), 0, 0), "search-opening")
    kth = opening.groupBy("query_row").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("kth")).where(F.col("n") == k)
    hits = opening
    if shards > 1:
        informed = asked.join(kth.select("query_row", "kth"), "query_row", "left")
        hits = opening.unionByName(search(dealt, informed, 1, shards - 1))
    return _best(hits, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: the 5 highest integer inner products for every vector whose vec_id is divisible by 50."""
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, row_number() OVER () AS r FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.r AS qr, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
