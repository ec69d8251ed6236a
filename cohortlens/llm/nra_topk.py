"""Exact top-k inner products by no-random-access aggregation.

Candidates are dealt into shards. A shard keeps, for each dimension, the list
of its components in order; a query reads every list from the end that its own
component prefers, some entries a round (all queries of a block read on
together, and the bounds are matrix products). A candidate's lower bound takes
the worst value of each list it has not been met in, its upper bound the value
the list has reached. Reading stops when no candidate outside those that may
still qualify has an upper bound above the k-th lower bound; these are then
resolved to exact integer scores. Queries come in blocks; a block meets each
shard once, and the shards' best are merged by Spark.

Vectors that are null, empty, or hold null or non-finite components take no part; a
query meets only candidates of its own length. Ties go to the smaller id; rows
that repeat an id are candidates of their own, but never for their own id.
Scores are 64-bit integers; components so large that a score may not fit are
an error. Query rows that repeat an id share one ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD = 4096
BLOCK = 256


class Lists:
    """The sorted lists of one shard, read from both ends."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.n, self.dims = vectors.shape
        order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, order, axis=0).astype(np.float64)  # smallest first
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(self.n)[:, None], axis=0)
        self.values = vectors.astype(np.float64)
        self.read: dict[int, tuple[np.ndarray, ...]] = {}

    def known(self, depth: int) -> tuple[np.ndarray, ...]:
        """What is known of each component after `depth` entries of each list:
        the value if it has been met, else the worst and the best it can be;
        for lists read from the largest and from the smallest entry."""
        if depth not in self.read:
            high, low = self.rank >= self.n - depth, self.rank < depth
            self.read[depth] = (np.where(high, self.values, self.sorted[0]), np.where(low, self.values, self.sorted[-1]),
                                np.where(high, self.values, self.sorted[-depth]), np.where(low, self.values, self.sorted[depth - 1]))
        return self.read[depth]

    def top(self, own: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the k best candidates for each query, but those
        with its own id. All queries read on together; who is done leaves."""
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(own)
        open_ = np.arange(len(own))
        weights = queries.astype(np.float64)
        # float sums of whole numbers: a little room for what they round off
        slack = 1e-9 * (np.abs(weights) @ np.abs(self.values).max(axis=0))
        for depth in [*(d for d in (self.n // 8, self.n // 4, self.n // 2, 3 * self.n // 4) if d > k), self.n]:
            worst_high, worst_low, best_high, best_low = self.known(depth)
            up, down = np.maximum(weights[open_], 0), np.minimum(weights[open_], 0)
            lower = up @ worst_high.T + down @ worst_low.T
            upper = up @ best_high.T + down @ best_low.T
            others = self.ids[None, :] != own[open_, None]
            lower[~others] = -np.inf
            at_least = np.partition(lower, -k, axis=1)[:, -k] if self.n >= k else np.full(len(open_), -np.inf)
            maybe = others & (upper >= (at_least - slack[open_])[:, None])
            done = (maybe.sum(axis=1) <= max(4 * k, self.n // 8)) | (depth == self.n)
            for i in np.flatnonzero(done):
                rest, query = np.flatnonzero(maybe[i]), open_[i]
                score = self.vectors[rest] @ queries[query]
                best = np.lexsort((self.ids[rest], -score))[:k]
                out[query] = self.ids[rest][best], score[best]
            open_ = open_[~done]
            if not len(open_):
                break
        return out


def fits(queries: np.ndarray, vectors: np.ndarray) -> None:
    """Raises where a score may not fit 64 bits."""
    most = [float(np.abs(x.astype(np.float64)).max(initial=0.0)) for x in (queries, vectors)]
    if most[0] * most[1] * vectors.shape[1] >= 2.0**62:
        raise ValueError(f"components of {most[0]:.0f} and {most[1]:.0f} are too large for 64-bit scores")


def whole_numbers(vectors: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component; null if any is missing or not finite."""
    good = vectors.isNotNull() & ~F.exists(vectors, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(good, F.transform(vectors, lambda x: F.floor(x.cast("double") * scale)))


def top_k(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query row's k best candidates."""
    rows = vectors.select(F.col(vec_id).alias("id"), whole_numbers(F.col(embedding)).alias("v"), is_query.alias("q")).where((F.size("v") > 0) & F.col("id").isNotNull()).withColumn("dims", F.size("v"))
    sizes = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("q"), 1)).alias("nq"))
    sizes = sizes.select(F.col("dims").alias("d"), F.ceil(F.col("n") / SHARD).cast("int").alias("shards"), F.ceil(F.col("nq") / BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(F.broadcast(sizes), F.col("dims") == F.col("d"))  # a row for each length of vector
    pick = lambda n: F.pmod(F.xxhash64("id", "v"), n).cast("int")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups of rows that stand together, as one row of bytes each."""

        def out(dims: int, part: int, ids: list[np.ndarray], data: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), pa.array([part], pa.int32()), pa.array([np.concatenate(ids).tobytes()], pa.binary()), pa.array([np.concatenate(data).tobytes()], pa.binary())], names=["dims", "part", "ids", "data"])

        at, ids, data = None, [], []
        for batch in batches:
            dims, part, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            flat, ends = batch.column(3).flatten().to_numpy(zero_copy_only=False), np.cumsum(dims, dtype=np.int64)
            cuts = np.flatnonzero(np.concatenate(([True], (dims[1:] != dims[:-1]) | (part[1:] != part[:-1])))) if len(dims) else []
            for a, b in zip(cuts, [*cuts[1:], len(dims)], strict=True):
                if at != (dims[a], part[a]):
                    if at is not None:
                        yield out(*at, ids, data)
                    at, ids, data = (dims[a], part[a]), [], []
                ids.append(own[a:b].copy())
                data.append(flat[ends[a] - dims[a] : ends[b - 1]].copy())
        if at is not None:
            yield out(*at, ids, data)

    def groups(df: DataFrame, part: Column) -> DataFrame:
        cut = df.select("dims", part.alias("part"), "id", "v").repartition("dims", "part").sortWithinPartitions("dims", "part", "id")
        return cut.mapInArrow(packed, "dims int, part int, ids binary, data binary")

    shards = groups(dealt, pick(F.col("shards")))
    blocks = groups(dealt.where("q"), pick(F.col("blocks"))).select(F.col("dims").alias("qd"), F.col("ids").alias("qids"), F.col("data").alias("qdata"))
    # the stated query set against all shards, in blocks: each block goes to every shard of its length
    sent = blocks.join(F.broadcast(sizes), F.col("qd") == F.col("d")).select("qd", "qids", "qdata", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("to"))
    met = shards.join(sent, (F.col("dims") == F.col("qd")) & (F.col("part") == F.col("to"))).select("dims", "ids", "data", "qids", "qdata")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, bytes, Lists] | None = None
        for batch in batches:
            for dims, ids, data, qids, qdata in zip(*batch.columns, strict=True):
                dims, ids, data, qids, qdata = (x.as_py() for x in (dims, ids, data, qids, qdata))
                matrix = lambda b: np.frombuffer(b, np.int64).reshape(-1, dims)  # noqa: B023, E731
                if last is None or last[0] != ids or last[1] != data:
                    last = ids, data, Lists(np.frombuffer(ids, np.int64), matrix(data))
                asked = np.frombuffer(qids, np.int64)
                fits(matrix(qdata), last[2].vectors)
                found = [(q, *x) for q, x in zip(asked, last[2].top(asked, matrix(qdata), k), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.full(len(i), q) for q, i, _ in found])), pa.array(np.concatenate([i for _, i, _ in found])), pa.array(np.concatenate([s for _, _, s in found]))], names=["query_id", "vec_id", "score"])

    best = met.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
