"""Mixing sources to target weights by fitting each source's budget of words.

Sources, in code point order with null last, weigh 5, 2, 1 and so on again;
they share a multiple of all words by weight, no source more than `most` times
its own words (what is left goes to the others by weight). A source repeats
all its documents as often as its target holds them whole. For the remaining
budget the documents are counted by exact length: each length gives the same
share of its documents, rounded down, and what then is still missing is fitted
as a bounded knapsack (a subset sum over the lengths left, each as often as
documents of it are left). The documents of a length that are taken are the
first by a seeded hash of id and text, so that reruns agree.

The histogram has a row for each length of a source, at most the square root
of twice its words, and is fitted in one task for each source; the dynamic
programme holds `window` words. Lengths beyond that window are taken longest
first, which is exact but for the last one. Ranks by hash come from counts in
hashed buckets, and only the bucket in which the cut falls is ranked, so that
a source or length with a third of all rows meets in no task.

A null text has no words; documents without words take part with size 0 and
are taken with 0 words. Null sources are one source of their own. Rows that
repeat an id are documents of their own; of equal rows some may be taken once
more than others, as a set of rows the result is the same in each run. The new
columns take the place of columns of these names. An empty table stays empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import kept, others

WEIGHTS = (5.0, 2.0, 1.0)
WINDOW = 1 << 18
BUCKETS = 1 << 12
SENT_SOURCES = 10_000


def words(text: Column) -> Column:
    """The number of words [^\\x20\\x09-\\x0D]+; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def ranked(sources: DataFrame, column: str) -> DataFrame:
    """Adds `place`, from 0, in ascending order with nulls last, without one
    task that sorts everything: rows are cut into ranges and each range starts
    where those before it end. `sources` has distinct values of the column."""
    cut = sources.repartitionByRange(F.asc_nulls_last(column)).withColumn("__range", F.spark_partition_id())
    cut = kept(cut, "ranges")
    counts = sorted((r["__range"], r["n"]) for r in cut.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect())  # a row a partition
    before = dict(zip([r for r, _ in counts], np.cumsum([0, *(n for _, n in counts)]).tolist(), strict=False))
    start = F.element_at(F.create_map(*(F.lit(x) for pair in before.items() for x in pair)), F.col("__range")) if before else F.lit(0)
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(F.asc_nulls_last(column)))
    return cut.withColumn("place", inside - 1 + start).drop("__range")


def targets(sources: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Adds `target` to (source, words, ...): share times all words by weight,
    `most` times a source's words at most. Each round's excess goes to the
    sources below their limit, until none is above; only sums reach the driver."""
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    df = kept(ranked(sources, "source").withColumn("weight", turn), "sources")
    total = df.agg(F.sum("words")).first()[0] or 0
    level = 0.0  # words for each unit of weight
    limited = F.lit(False)
    while True:
        full, weight = df.agg(F.sum(F.when(limited, most * F.col("words"))), F.sum(F.when(~limited, F.col("weight")))).first()
        if not weight:
            break
        now = (share * total - (full or 0.0)) / weight
        if now <= level:
            break
        level = now
        limited = most * F.col("words") < F.col("weight") * F.lit(level)
    return df.withColumn("target", F.when(limited, most * F.col("words")).otherwise(F.col("weight") * F.lit(level)))


def nearest_sum(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take so that their sum comes as near to the
    budget as it can (the lower one of two): a bounded knapsack over all sums
    up to twice the budget."""
    top = 2 * budget
    took = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return took
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    item = np.full(top + 1, -1, np.int64)  # the item that first reached a sum
    items: list[tuple[int, int]] = []  # (length number, copies)
    for k, (length, count) in enumerate(zip(lengths.tolist(), counts.tolist(), strict=True)):
        left, copies = min(count, top // length), 1
        while left and not reached[budget]:  # counts as sums of powers of two
            copies = min(copies, left)
            step = copies * length
            if step <= top:
                new = np.flatnonzero(reached[: top + 1 - step] & ~reached[step:]) + step
                item[new] = len(items)
                reached[new] = True
            items.append((k, copies))
            left, copies = left - copies, copies * 2
        if reached[budget]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - budget), axis=0)])
    while at:
        k, copies = items[item[at]]
        took[k] += copies
        at -= copies * int(lengths[k])
    return took


def fitted(lengths: np.ndarray, counts: np.ndarray, budget: float, window: int = WINDOW) -> np.ndarray:
    """How many documents of each length (ascending, above 0) fill the budget,
    which is at most all of them together. The programme first gets the words
    of some 16 documents to fit, and all that its window holds where that
    doesn't meet the budget to the word."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = sum(a * b for a, b in zip(lengths.tolist(), counts.tolist(), strict=True))
    goal = int(min(total, math.floor(budget + 0.5)))
    best, miss = np.zeros(len(lengths), np.int64), goal
    for room in (16 * total // max(1, int(counts.sum())), window // 2):
        if not miss:
            break
        take, rest = started(lengths, counts, total, goal, min(room, window // 2))
        if 2 * rest <= window:
            order = np.argsort(-lengths, kind="stable")
            order = order[(lengths[order] <= 2 * rest) & (counts[order] > take[order])]
            take[order] += nearest_sum(lengths[order], counts[order] - take[order], rest)
        else:  # only lengths beyond the window are left: the longest that fits, one by one
            for k in range(len(lengths) - 1, -1, -1):
                more = min(int(counts[k] - take[k]), rest // int(lengths[k]))
                take[k] += more
                rest -= more * int(lengths[k])
            left = np.flatnonzero(counts > take)
            if len(left) and abs(int(lengths[left[0]]) - rest) < rest:
                take[left[0]] += 1
        off = abs(goal - sum(a * b for a, b in zip(lengths.tolist(), take.tolist(), strict=True)))
        if off < miss:
            best, miss = take, off
    return best


def started(lengths: np.ndarray, counts: np.ndarray, total: int, goal: int, room: int) -> tuple[np.ndarray, int]:
    """The same share of each length, and words still missing: brought to
    about `room` by taking more of the longest or giving back short ones."""
    take = np.array([c * goal // total for c in counts.tolist()], np.int64)
    rest = goal - sum(a * b for a, b in zip(lengths.tolist(), take.tolist(), strict=True))
    for k in range(len(lengths) - 1, -1, -1):
        if rest <= room:
            break
        more = min(int(counts[k] - take[k]), (rest - room // 2) // int(lengths[k]))
        if more > 0:
            take[k] += more
            rest -= more * int(lengths[k])
    for k in range(len(lengths)):
        if rest >= room // 2:
            break
        less = min(int(take[k]), (room // 2 - rest) // int(lengths[k]) + 1, max(0, room - rest) // int(lengths[k]))
        take[k] -= less
        rest += less * int(lengths[k])
    return take, rest


def quotas(histogram: DataFrame, window: int = WINDOW) -> DataFrame:
    """(source number, size, whole, chosen): how often all documents of a
    length are taken, and how many of them once more. `histogram` has number,
    size, n, words and target; a number's rows are at most the square root of
    twice its words."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        whole = pa.Table.from_batches(parts)
        number, size, n, total, target = (whole.column(c).to_numpy() for c in ("number", "size", "n", "words", "target"))
        for one in np.unique(number):
            at = np.flatnonzero((number == one) & (size > 0))
            if not len(at):
                continue
            at = at[np.argsort(size[at])]
            times, left = divmod(float(target[at[0]]), float(total[at[0]]))
            if left >= total[at[0]] * (1 - 1e-12):  # a quotient that falls short of a whole number by rounding
                times, left = times + 1, 0.0
            take = fitted(size[at], n[at], left, window)
            yield pa.RecordBatch.from_arrays([pa.array(number[at]), pa.array(size[at]), pa.array(np.full(len(at), int(times))), pa.array(take)], names=["number", "size", "whole", "chosen"])

    cut = histogram.select("number", "size", "n", "words", "target").repartition("number")
    return cut.mapInArrow(fit, "number bigint, size bigint, whole bigint, chosen bigint")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", share: float = 1.5, most: float = 2.0,
        weights: tuple[float, ...] = WEIGHTS, seed: int = 11, window: int = WINDOW) -> DataFrame:
    """The columns of `docs` but the text, with size, source_size, target and
    taken (words that the mix takes of the document, repeats counted) and
    times (how often it is taken)."""
    new = ["size", "source_size", "target", "taken", "times"]
    carried = [c for c in others(docs, new) if c.lower() != f"`{text}`".lower()]
    rows = docs.select(F.struct(*carried).alias("__row"), F.col(f"`{source}`").alias("source"), words(F.col(f"`{text}`")).alias("size"),
                       F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("__hash"))
    rows = kept(rows.withColumn("__bucket", F.pmod("__hash", F.lit(BUCKETS)).cast("int")), "sizes")
    counted = kept(rows.groupBy("source", "size", "__bucket").agg(F.count(F.lit(1)).alias("n")), "lengths")
    sizes = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    goals = targets(sizes, share, most, weights).select(F.col("source").alias("__source"), F.col("place").cast("bigint").alias("number"), "words", "target")
    goals = kept(goals, "targets")
    if goals.count() <= SENT_SOURCES and (goals.agg(F.sum(F.length("__source"))).first()[0] or 0) <= 100 * SENT_SOURCES:
        goals = F.broadcast(goals)  # else Spark joins by its own sizes and splits what is skewed
    numbered = counted.join(goals, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    histogram = numbered.groupBy("number", "size").agg(F.sum("n").alias("n"), F.first("words").alias("words"), F.first("target").alias("target"))
    quota = kept(quotas(histogram, window), "quotas").select(F.col("number").alias("__n"), F.col("size").alias("__s"), "whole", "chosen")
    # within a length the buckets fill up in order; at most BUCKETS rows meet in one window
    found = numbered.join(quota, (F.col("number") == F.col("__n")) & (F.col("size") == F.col("__s")), "left")
    before = F.sum("n").over(Window.partitionBy("number", "size").orderBy("__bucket")) - F.col("n")
    found = found.withColumn("chosen", F.greatest(F.lit(0), F.least(F.col("n"), F.coalesce("chosen", F.lit(0)) - before)))
    found = found.select(F.col("source").alias("__source"), F.col("size").alias("__s"), F.col("__bucket").alias("__b"), "n", "words", "target", F.coalesce("whole", F.lit(0)).alias("whole"), "chosen")
    met = rows.join(found, F.col("source").eqNullSafe(F.col("__source")) & (F.col("size") == F.col("__s")) & (F.col("__bucket") == F.col("__b")))
    rank = F.row_number().over(Window.partitionBy("source", "size", "__bucket").orderBy("__hash"))
    once_more = F.when(F.col("chosen") >= F.col("n"), 1).when(F.col("chosen") <= 0, 0).otherwise((rank <= F.col("chosen")).cast("int"))
    met = met.withColumn("times", (F.col("whole") + once_more).cast("bigint"))
    return met.select(*(f"__row.{c}" for c in carried), "size", F.col("words").alias("source_size"), "target", (F.col("size") * F.col("times")).alias("taken"), "times")
