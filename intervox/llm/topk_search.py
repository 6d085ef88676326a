"""Exact top-k inner-product search on an impact-ordered, score-at-a-time index.

Components are quantised to integers, floor(scale * x). The index holds, for each shard of vectors and each dimension,
posting segments of one impact level (LEVEL wide) with exact impacts. For a query the segments of all dimensions are
processed by descending gain, the most that a posting can add above the least contribution of its dimension; what is
left to gain bounds every vector from above. Processing stops only when that bound proves that no more than a small
part of the shard can be among the k best; those possible members are then rescored exactly.

Shards and query blocks are of bounded size; a task searches one shard for one block, and each query's k best of all
shards are ranked last. Every vector is in the index, and no pair is left out unproven.

Defined cases: vectors that are null, empty or hold a null or non-finite component take no part; shorter vectors are
padded with zeros; every row is a vector of its own, so repeated rows are so many candidates and so many queries, and
only the query's own row isn't its candidate; ties go to the smaller vec_id; null vec_ids take no part; with fewer
candidates than k all are returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, written

SCALE, LEVEL, K = 256, 16, 5
#: Components of a shard; queries of a block, at most and, where there are fewer tasks than partitions, at least.
SHARD, BLOCK, LEAST_BLOCK = 1 << 22, 4096, 64
#: Share of a shard that may be left to exact rescoring; it is tested whenever the bound has fallen to so much of what
#: it was at the last test.
POSSIBLE, FALLEN = 1 / 16, 0.85

_INDEX = "shard long, dim int, level long, ids binary, impacts binary"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, q (array<long>) of the vectors that take part."""
    x = F.col(vector_col).cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & ~odd)
    return rows.select(F.col(id_col).try_cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("q"))


def build_index(vectors: DataFrame, shards: int) -> DataFrame:
    """Posting segments of quantised vectors: shard, dim, level, and the packed ids and exact impacts.

    dim -1 holds the shard's vec_ids and, as impacts, its rows; ids elsewhere are positions in it.
    """

    def build(table: pa.Table) -> pa.Table:
        x, ids, rows, shard = _matrix(table["q"]), table["vec_id"].to_numpy(), table["row"].to_numpy(), table["shard"][0].as_py()
        order = np.lexsort((rows, ids))
        x, ids, rows = x[order], ids[order], rows[order]
        kind = np.int32 if np.abs(x).max(initial=0) < 1 << 31 else np.int64
        out = [(shard, -1, 0, ids.astype(np.int64).tobytes(), rows.astype(np.int64).tobytes())]
        for d in range(x.shape[1]):
            level = np.floor_divide(x[:, d], LEVEL)
            by = np.argsort(-level, kind="stable")
            cut = np.flatnonzero(np.r_[True, np.diff(level[by]) != 0])
            for a, b in zip(cut, [*cut[1:], len(by)]):
                out.append((shard, d, int(level[by[a]]), by[a:b].astype(np.int32).tobytes(), x[by[a:b], d].astype(kind).tobytes()))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["shard", "dim", "level", "ids", "impacts"])

    rows = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    return rows.groupBy("shard").applyInArrow(build, _INDEX)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = [x.values.to_numpy(zero_copy_only=False) for x in column]
    out = np.zeros((len(rows), max(map(len, rows))), np.int64)
    for i, x in enumerate(rows):
        out[i, : len(x)] = x
    return out


class Shard:
    """A shard's segments, ready for queries."""

    def __init__(self, index: pa.Table):
        rows = list(zip(*[index[c].to_pylist() for c in ("dim", "level", "ids", "impacts")]))
        self.vec_ids, self.rows = next([np.frombuffer(x, np.int64) for x in r[2:]] for r in rows if r[0] == -1)
        rows = sorted((r for r in rows if r[0] >= 0), key=lambda r: (r[0], r[1]))
        self.dim = np.asarray([r[0] for r in rows])
        self.ids = [np.frombuffer(r[2], np.int32) for r in rows]
        self.impacts = [np.frombuffer(r[3], np.int32 if len(r[3]) == len(r[2]) else np.int64) for r in rows]
        self.low = np.asarray([x.min() for x in self.impacts], np.int64)
        self.high = np.asarray([x.max() for x in self.impacts], np.int64)
        self.vectors = np.zeros((len(self.vec_ids), int(self.dim.max()) + 1), np.int64)
        for d, ids, x in zip(self.dim, self.ids, self.impacts):
            self.vectors[ids, d] = x

    def search(self, own: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
        """vec_ids and scores of the k best but row `own`, best first, and the share of segments that was processed."""
        dims = self.vectors.shape[1]
        q = np.r_[q, np.zeros(max(0, dims - len(q)), np.int64)][:dims]
        weight = q[self.dim]
        most = np.maximum(weight * self.low, weight * self.high)
        floor = np.full(dims, np.iinfo(np.int64).max)
        np.minimum.at(floor, self.dim, np.minimum(weight * self.low, weight * self.high))
        gain = most - floor[self.dim]
        order = np.argsort(-gain, kind="stable")
        # After each segment: the most that a vector can still gain, the next segment's gain in every dimension.
        by = np.lexsort((-gain, self.dim))
        following = np.zeros(len(by), np.int64)
        same = self.dim[by[1:]] == self.dim[by[:-1]]
        following[by[:-1]] = np.where(same, gain[by[1:]], 0)
        start = np.zeros(dims, np.int64)
        np.maximum.at(start, self.dim, gain)
        left = start.sum() + np.cumsum((following - gain)[order])
        score = np.zeros(len(self.vec_ids), np.int64)
        others = self.rows != own
        k = min(k, int(others.sum()))
        if k == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), 0.0
        possible = np.flatnonzero(others)
        done, tested = 0, int(start.sum())
        for done, s in enumerate(order, 1):
            if weight[s]:
                score[self.ids[s]] += weight[s] * self.impacts[s] - floor[self.dim[s]]
            if left[done - 1] <= FALLEN * tested or done == len(order):
                tested = left[done - 1]
                mine = score[others]
                least = np.partition(mine, len(mine) - k)[len(mine) - k]
                may = score + left[done - 1] >= least
                if may.sum() <= max(4 * k, POSSIBLE * len(score)) or done == len(order):
                    possible = np.flatnonzero(may & others)
                    break
        exact = self.vectors[possible] @ q
        best = np.lexsort((self.vec_ids[possible], -exact))[:k]
        return self.vec_ids[possible[best]], exact[best], done / len(order)


def search(index: DataFrame, queries: DataFrame, shards: int, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score, processed: the k best of every query (vec_id, row, q) over all shards of the index."""
    asked = queries.count()
    blocks = max(1, -(-asked // BLOCK), min(-(-asked // LEAST_BLOCK), -(-partitions(queries.sparkSession) // shards)))
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("row").alias("query"), "q", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).alias("block"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def find(own: pa.Table, segments: pa.Table) -> pa.Table:
        out = ([], [], [], [], [])
        if own.num_rows and segments.num_rows:
            shard = Shard(segments)
            for query_id, query, q in zip(own["query_id"].to_pylist(), own["query"].to_pylist(), own["q"]):
                ids, scores, processed = shard.search(query, q.values.to_numpy(zero_copy_only=False).astype(np.int64), k)
                for column, x in zip(out, ([query_id] * len(ids), [query] * len(ids), ids, scores, [processed] * len(ids))):
                    column.extend(x)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["query_id", "query", "vec_id", "score", "processed"])

    found = asked.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")).applyInArrow(find, "query_id long, query long, vec_id long, score long, processed double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "processed")


def top_k(vectors: DataFrame, is_query: F.Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score, processed for the rows of vectors where is_query holds."""
    # Numbers of rows of a written table: they stay as they are once it is there.
    rows = written(quantised(vectors, id_col, vector_col).withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, dims = rows.agg(F.count("*"), F.max(F.size("q"))).first()
    shards = max(1, -(-n * (dims or 0) // SHARD))
    return search(written(build_index(rows, shards), "index"), rows.where(is_query), shards, k)
