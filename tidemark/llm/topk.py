"""Exact top-k by inner product, score at a time over an impact-ordered index.

A block of vectors is indexed by posting segments: for a dimension and a quantised impact level, the vectors with that
level there. Segments are processed from the greatest impact down, for a batch of queries at once as sparse sums
over whole levels. After each tier of levels every vector has a lower and an upper bound; vectors whose upper bound is under
the k-th lower bound are ruled out. Processing stops when that proof leaves few, and those are rescored exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import materialize

K, SCALE = 5, 256
EVERY = 50
LEVELS = 16
#: Rows of a block of vectors and of queries, queries processed at once, and vectors per query that end the processing.
VECTORS, QUERIES, AT_ONCE, FEW = 8192, 1024, 128, 256
#: Tiers of levels, from the greatest down: each goes to this share of the greatest level.
TIERS = (0.5, 0.25, 0.0)


class Block:
    """Posting segments of one block, by tier."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        top = int(np.abs(vectors).max(initial=0))
        self.step = max(1, -(-top // LEVELS))
        levels = vectors // self.step
        height = np.abs(levels)
        greatest = int(height.max(initial=0))
        self.tiers, above = [], greatest + 1
        for share in TIERS:
            floor = int(np.ceil(share * greatest)) if share else 0
            if floor < above:
                # what a tier's segments add, and the most a component below them can be
                self.tiers.append((np.where((height >= floor) & (height < above), levels, 0).astype(np.float64), self.step * max(floor, 1)))
                above = floor

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the positions and scores of its k best vectors; ``own``: (queries, vectors) pairs left out."""
        n, q = len(self.vectors), queries.astype(np.float64)
        score = np.zeros((len(q), n))
        weight = np.abs(q).sum(axis=1, keepdims=True)
        # a processed component is its level's lower edge, up to step - 1 short of its value
        high = (self.step - 1) * np.maximum(q, 0).sum(axis=1, keepdims=True)
        low = (self.step - 1) * np.minimum(q, 0).sum(axis=1, keepdims=True)
        alive, k = ~own, min(k, n)
        for place, (levels, below) in enumerate(self.tiers):
            score += self.step * (q @ levels.T)
            last = place == len(self.tiers) - 1
            rest = 0.0 if last else weight * below
            least = np.where(own, -np.inf, score + low - rest)
            proof = np.partition(least, n - k, axis=1)[:, n - k, None]
            alive = ~own & (score + high + rest >= proof)
            if alive.sum(axis=1).max() <= FEW:
                break
        found = []
        for i, row in enumerate(queries):
            at = np.flatnonzero(alive[i])
            found.append((at, self.vectors[at] @ row))
        return found


def _search_block(table: pa.Table) -> pa.Table:
    query = table.column("query").to_numpy(zero_copy_only=False)
    ids = table.column("vec_id").to_numpy()
    vectors = np.array(table.column("v").combine_chunks().flatten().to_numpy()).reshape(len(ids), -1)
    asked, kept = np.flatnonzero(query), np.flatnonzero(~query)
    rows: list[tuple[np.ndarray, ...]] = []
    if len(asked) and len(kept):
        block, names = Block(vectors[kept]), ids[kept]
        for a in range(0, len(asked), AT_ONCE):
            some = asked[a : a + AT_ONCE]
            own = names[None, :] == ids[some][:, None]
            for who, (at, score) in zip(some, block.search(vectors[some], own, K), strict=True):
                order = np.lexsort((names[at], -score))[:K]
                rows.append((np.full(len(order), ids[who]), names[at][order], score[order]))
    parts = [np.concatenate(c) if rows else np.zeros(0, np.int64) for c in (zip(*rows, strict=True) if rows else ((), (), ()))]
    return pa.table({"query_id": parts[0], "vec_id": parts[1], "score": parts[2].astype(np.int64)})


def top_scores(embeddings: DataFrame, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``K`` highest inner products of each query, ties to the smaller vec_id.

    Components become floor(scale * x). Queries are the rows whose vec_id is divisible by ``every``; candidates are all
    rows with another vec_id and as many components. Vectors that are NULL or empty, hold NULL or non-finite components or have
    no vec_id take no part. Of rows that repeat a vec_id one takes part, that with the smallest vector.

    Blocks of queries meet blocks of vectors; a task holds one of each and returns ``K`` rows per query.
    """
    x = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where("vec_id IS NOT NULL AND x IS NOT NULL AND size(x) > 0")
    rows = rows.where(F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    rows = rows.select("vec_id", F.transform("x", lambda e: F.floor(e * scale)).alias("v"))
    rows = materialize(rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dims", F.size("v")), "vectors")
    is_query = F.col("vec_id") % every == 0
    n, asked = rows.agg(F.count("*"), F.count_if(is_query)).first()
    blocks, turns = max(1, -(-n // VECTORS)), max(1, -(-asked // QUERIES))
    spread = lambda k, m: F.pmod(F.xxhash64("vec_id", F.lit(k)), F.lit(m)).cast("int")
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    kept = rows.select("dims", spread(1, blocks).alias("block"), each(turns).alias("turn"), F.lit(False).alias("query"), "vec_id", "v")
    some = rows.where(is_query).select("dims", each(blocks).alias("block"), spread(2, turns).alias("turn"), F.lit(True).alias("query"), "vec_id", "v")
    found = kept.unionByName(some).groupBy("dims", "block", "turn").applyInArrow(_search_block, "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= K).select("query_id", "rank", "vec_id", "score")


TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda e: cast(floor(256 * cast(e AS double)) AS bigint)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS bigint) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS integer) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
