"""Vector codes: product quantisation with norm-of-sum bounds.

Vectors become whole numbers and are cut into equal consecutive parts; each
part position has a codebook, refined by rounds of assignment and averaging.
Every codebook a round has used is retained. A vector keeps, for each part,
its entry, a lower bound of its distance to all other entries and the round
in which that bound was taken (its stamp). In a later round the bound is
lowered by the largest true displacement of another entry between the stamp's
codebook and the present one, the norm of the sum of its moves, and not by the
sum of the moves' norms. Only where the present distance to the own entry,
taken exactly, does not stay below it, all entries are measured again, in
whole numbers, so that results are those of a plain scan.

A round is one pass of Arrow batches over the table of vectors and states and
one sum of bounded size (a number for each entry and component); the tables
between rounds are written to the shared folder.

Null vectors, empty ones and those with null or non-finite components are left
out. Rows that repeat an id are vectors of their own; the first entries are
the vectors of the smallest ids (null ids last, ties by the vector). With fewer
vectors than entries the codebooks are as short. Ties go to the lower entry,
entries that no part uses stay. All vectors need the same length, a multiple
of the number of parts, and components small enough for exact 64-bit sums;
else a ValueError says so. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import kept, lists, others

STATE = ["__code", "__low", "__stamp", "__error"]
#: labels whose sums are sent to all tasks; more of them are joined by shuffles with salted keys
SENT_LABELS = 100_000
SALTS = 64


def floored(vectors: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component; null if a component is missing or
    not finite, or if there is none."""
    bad = F.exists(vectors, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vectors.isNotNull() & (F.size(vectors) > 0) & ~bad, F.transform(vectors, lambda x: F.floor(x.cast("double") * scale)))


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries, as 64-bit integers."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * largest * largest * x.shape[1] < 1 << 53:  # every term is a whole number that a double holds
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for i in range(x.shape[1]):
        out += (x[:, i, None] - entries[None, :, i]) ** 2
    return out


class Assigner:
    """One round's assignment of vectors to the last of the codebooks."""

    def __init__(self, history: np.ndarray):
        self.history = history  # (round, part, entry, component)
        self.now = len(history) - 1
        # net displacement of each entry since each round: the largest, who moved so far, and the second largest
        net = np.sqrt(((history[-1][None] - history) ** 2).sum(-1).astype(np.float64))  # (round, part, entry)
        self.most = net.argmax(-1)
        top = np.sort(net, axis=-1)
        self.first = top[..., -1]
        self.second = top[..., -2] if net.shape[-1] > 1 else np.zeros_like(self.first)
        self.scanned = 0

    def part(self, p: int, x: np.ndarray, code: np.ndarray, low: np.ndarray, stamp: np.ndarray) -> np.ndarray:
        """Brings code, low and stamp of part p up to date in place; returns
        the squared distances to the own entries."""
        entries = self.history[-1][p]
        if self.now:
            own = ((x - entries[code]) ** 2).sum(1)
            moved = np.where(self.most[stamp, p] == code, self.second[stamp, p], self.first[stamp, p])
            again = np.flatnonzero(np.sqrt(own.astype(np.float64)) * (1 + 1e-9) >= low.astype(np.float64) - moved * (1 + 1e-9))
        else:
            own, again = np.zeros(len(x), np.int64), np.arange(len(x))
        self.scanned += len(again)
        for rows in np.array_split(again, max(1, len(again) // 4096)):
            if not len(rows):
                continue
            d = squared(x[rows], entries)
            best = d.argmin(1)  # the first of equals
            code[rows], own[rows], stamp[rows] = best, d[np.arange(len(rows)), best], self.now
            d[np.arange(len(rows)), best] = np.iinfo(np.int64).max
            # rounded down, so that it stays a lower bound
            low[rows] = np.sqrt(d.min(1).astype(np.float64)) * (1 - 1e-6)
        return own


def assigned(state: DataFrame, history: np.ndarray, vector: str = "__v") -> DataFrame:
    """The table of vectors with codes, bounds and stamps for the last codebook."""
    parts = history.shape[1]
    shared = state.sparkSession.sparkContext.broadcast(history)  # rounds x entries x components

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigner = Assigner(shared.value)
        for batch in batches:
            n, names = len(batch), batch.schema.names
            x = batch.column(names.index(vector)).flatten().to_numpy(zero_copy_only=False).reshape(n, parts, -1)
            column = lambda c, t: batch.column(names.index(c)).flatten().to_numpy(zero_copy_only=False).reshape(n, parts).astype(t)  # noqa: B023, E731
            if assigner.now:
                code, low, stamp = column("__code", np.int64), column("__low", np.float32), column("__stamp", np.int64)
            else:
                code, low, stamp = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.float32), np.zeros((n, parts), np.int64)
            error = np.zeros(n, np.int64)
            for p in range(parts):
                mine = code[:, p].copy(), low[:, p].copy(), stamp[:, p].copy()
                error += assigner.part(p, x[:, p], *mine)
                code[:, p], low[:, p], stamp[:, p] = mine
            each = np.full(n, parts)
            made = {"__code": lists(each, pa.array(code.ravel(), pa.int16())), "__low": lists(each, pa.array(low.ravel(), pa.float32())),
                    "__stamp": lists(each, pa.array(stamp.ravel(), pa.int16())), "__error": pa.array(error)}
            keep = [c for c in names if c not in STATE]
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in keep), *made.values()], names=[*keep, *made])

    made = [("__code", T.ArrayType(T.ShortType())), ("__low", T.ArrayType(T.FloatType())), ("__stamp", T.ArrayType(T.ShortType())), ("__error", T.LongType())]
    return state.mapInArrow(run, T.StructType([*state.drop(*STATE).schema.fields, *(T.StructField(*x) for x in made)]))


def averaged(state: DataFrame, codebook: np.ndarray, vector: str = "__v") -> np.ndarray:
    """The next codebook: floor(sum / count) of the parts of each entry."""
    parts, entries, width = codebook.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, parts, width)
            code = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, parts)
            for p in range(parts):
                order = np.argsort(code[:, p], kind="stable")
                used, starts = np.unique(code[order, p], return_index=True)
                if len(used):
                    total[p, used, :width] += np.add.reduceat(x[order, p], starts, axis=0)
                    total[p, used, width] += np.diff([*starts, len(order)])
        cells = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(total.ravel()[cells])], names=["cell", "value"])

    found = state.select(vector, "__code").mapInArrow(sums, "cell int, value bigint").groupBy("cell").agg(F.sum("value").alias("value"))
    total = np.zeros(parts * entries * (width + 1), np.int64)
    for row in found.collect():  # at most a number for each entry and component, and a count
        total[row["cell"]] = row["value"]
    total = total.reshape(parts, entries, width + 1)
    n = total[..., width:]
    return np.where(n > 0, total[..., :width] // np.maximum(n, 1), codebook)


def digest(codebook: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, codebook.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0) -> tuple[DataFrame, np.ndarray]:
    """The columns of `vectors` but the embedding, with `code` (an array of
    entry numbers, one for each part) and `error` (the squared distances,
    summed), which take the place of columns of these names; and the final
    codebooks as an array (part, entry, component)."""
    carried = [c for c in others(vectors, ["code", "error"]) if c.lower() != f"`{embedding}`".lower()]
    rows = vectors.select(F.col(f"`{vec_id}`").alias("__id"), F.struct(*carried).alias("__row"), floored(F.col(f"`{embedding}`"), scale).alias("__v")).where("__v IS NOT NULL")
    state = kept(rows, "codes-0")
    sizes = state.agg(F.min(F.size("__v")), F.max(F.size("__v")), F.max(F.array_max(F.transform("__v", lambda x: F.abs(x))))).first()
    names = [f"__row.{c}" for c in carried]
    if sizes[0] is None:
        none = state.select(*names, F.array().cast("array<smallint>").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return none, np.zeros((parts, 0, 0), np.int64)
    shortest, longest, largest = sizes
    if shortest != longest or shortest % parts:
        raise ValueError(f"vectors of {shortest} to {longest} components can't be cut into {parts} equal parts")
    if largest < 0 or 4 * largest * largest * longest >= 1 << 63:
        raise ValueError(f"components of {largest} are too large for exact 64-bit distances")
    first = state.select("__id", "__v").orderBy(F.asc_nulls_last("__id"), "__v").limit(entries).collect()
    width = longest // parts
    history = np.array([r["__v"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)[None]
    for at in range(rounds):
        state = kept(assigned(state, history), f"codes-{at + 1}")
        history = np.concatenate([history, averaged(state, history[-1])[None]])
    out = assigned(state, history).select(*names, F.col("__code").alias("code"), F.col("__error").alias("error"))
    return out, history[-1]


def summed_by(df: DataFrame, label: str, value: str, name: str) -> DataFrame:
    """Adds the sum of `value` over all rows of equal label, nulls together.
    `df` should be a written table. Few labels are sent to all tasks; the sums
    of many are copied under each salt, so that a hot label is no hot key."""
    sums = df.groupBy(F.col(label).alias("__label")).agg(F.sum(value).alias(name))
    sums = kept(sums, "label-sums")
    if sums.count() <= SENT_LABELS and (sums.agg(F.sum(F.length(F.col("__label").cast("string")))).first()[0] or 0) <= 16 * SENT_LABELS:
        return df.join(F.broadcast(sums), F.col(label).eqNullSafe(F.col("__label"))).drop("__label")
    salted = sums.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = df.withColumn("__own", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, F.col(label).eqNullSafe(F.col("__label")) & (F.col("__own") == F.col("__salt"))).drop("__label", "__salt", "__own")


def decoded(codes: DataFrame, codebook: np.ndarray, code: str = "code", scale: float = 256.0) -> DataFrame:
    """Adds `approximation`, the vector that a code stands for."""
    parts = codebook.tolist()
    books = F.array(*(F.array(*(F.array(*(F.lit(float(x) / scale) for x in entry)) for entry in part)) for part in parts))
    return codes.withColumn("approximation", F.flatten(F.transform(F.col(code), lambda c, p: books[p][c.cast("int")])))
