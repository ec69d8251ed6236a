"""SimHash near-duplicates through BK-trees.

The fingerprints (distinct ones: copies count once) are dealt into shards such
that any two within the radius meet in at least one: the 64 bits are cut into
b blocks, and a shard is a choice of b - radius blocks with their values, at
least one choice of which two close fingerprints share. Each shard is a
BK-tree, whose children are keyed by their integer Hamming distance to the
parent; every fingerprint of the shard follows only edges within the radius of
its distance. Trees stay in the tasks that build them (a broadcast of them
would grow with the corpus). A task passes on spanning links, not all pairs;
components come from large-star and small-star steps over those links.

Null and empty texts have no words and fingerprint zero, linked like any
other. Rows that repeat a doc_id take part one by one; a null id never becomes
the smallest of its component unless all ids in it are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cohortlens.llm.common import blobs, kept, others
from cohortlens.session import materialize

SEED = 42
#: pairs of (query, node) that are held at a time
FRONT = 1 << 19


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(whole, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
        hashes = [xxh64_intdigest(whole[i:j], SEED) for i, j in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 8192):
        bits = np.unpackbits(np.array(hashes[k : k + 8192], "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(texts: Column, shingle: int = 4) -> Column:
    """The fingerprint of each text, as a signed 64-bit number."""

    def of(arr: pa.Array) -> pa.Array:
        return pa.array(np.fromiter((fingerprint(x, shingle) for x in blobs(arr)), np.uint64, len(arr)).view(np.int64))

    return F.arrow_udf(of, "bigint")(texts)


def shard_choices(n: int, radius: int) -> list[int]:
    """Masks of the bits that make a shard's key, one mask for each choice of
    blocks; the number of blocks by the least work for n fingerprints, with at
    least two blocks in a key (one would save copies on small tables only, and
    make the copies of a row jump as they grow)."""

    def work(blocks: int) -> float:
        bits = 64 * (blocks - radius) // blocks
        return comb(blocks, radius) * (4 + 0.3 * n / 2**bits)

    blocks = min(range(radius + 2, radius + 7), key=work)
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(x) for x in combinations(masks, blocks - radius)]


def near_pairs(values: np.ndarray, shard: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within the radius in the same shard: BK-trees of all shards
    at once, built and searched a level at a time. The rows of a shard stand
    together."""
    n = len(values)
    root_of = np.maximum.accumulate(np.where(np.concatenate(([True], shard[1:] != shard[:-1])), np.arange(n), 0))
    # building: all items sink together; the first to reach a free edge becomes the child there
    item = np.flatnonzero(root_of != np.arange(n))
    node = root_of[item]
    edges: list[np.ndarray] = []
    children: list[np.ndarray] = []
    while len(item):
        key = node * 128 + np.bitwise_count(values[item] ^ values[node])
        found, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        child = item[first]
        edges.append(found)
        children.append(child)
        sinks = np.ones(len(item), bool)
        sinks[first] = False
        node, item = child[inverse][sinks], item[sinks]
    if not edges:
        return
    edge = np.concatenate(edges)
    order = np.argsort(edge, kind="stable")
    edge, child = edge[order], np.concatenate(children)[order]
    # searching: a stack of (queries, nodes), cut so that it stays small
    busy = np.flatnonzero((root_of != np.arange(n)) | np.isin(np.arange(n), root_of[root_of != np.arange(n)]))
    stack = [(busy[i : i + 65536], root_of[busy[i : i + 65536]]) for i in range(0, len(busy), 65536)]
    while stack:
        query, at = stack.pop()
        if len(query) > FRONT:
            half = len(query) // 2
            stack += [(query[:half], at[:half]), (query[half:], at[half:])]
            continue
        far = np.bitwise_count(values[query] ^ values[at]).astype(np.int64)
        hit = (far <= radius) & (query > at)
        if hit.any():
            yield query[hit], at[hit]
        low = np.searchsorted(edge, at * 128 + np.maximum(far - radius, 0), side="left")
        high = np.searchsorted(edge, at * 128 + np.minimum(far + radius, 64), side="right")
        many = high - low
        if many.any():
            total = int(many.sum())
            step = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
            stack.append((np.repeat(query, many), child[np.repeat(low, many) + step]))


def joined(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Gives linked items one smallest label in `group`, in place."""
    while True:
        ga, gb = group[a], group[b]
        differ = ga != gb
        if not differ.any():
            return
        a, b, ga, gb = a[differ], b[differ], ga[differ], gb[differ]
        np.minimum.at(group, np.maximum(ga, gb), np.minimum(ga, gb))
        while True:
            up = group[group]
            if (up == group).all():
                break
            group[:] = up


def links(distinct: DataFrame, radius: int, n: int) -> DataFrame:
    """(a, b), a > b: spanning links between fingerprints `f`."""
    masks = shard_choices(n, radius)
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("f").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("value")) for i, m in enumerate(masks)]))
    rows = distinct.select("f", keys.alias("k")).select("f", "k.choice", "k.value")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(held: list[np.ndarray]) -> pa.RecordBatch:
            choice, value, f = held
            f = f.view(np.uint64)
            new = np.concatenate(([True], (choice[1:] != choice[:-1]) | (value[1:] != value[:-1])))
            group = np.arange(len(f))
            for a, b in near_pairs(f, np.cumsum(new), radius):
                joined(group, a, b)
            own = np.flatnonzero(group != np.arange(len(f)))
            x, y = f[own].view(np.int64), f[group[own]].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], names=["a", "b"])

        # whole shards only: the last one of a batch waits for the next batch
        rest: list[np.ndarray] | None = None
        for batch in batches:
            held = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if rest is not None:
                held = [np.concatenate(x) for x in zip(rest, held, strict=True)]
            choice, value, _ = held
            if not len(choice):
                continue
            last = int(np.flatnonzero((choice != choice[-1]) | (value != value[-1]))[-1]) + 1 if ((choice != choice[-1]) | (value != value[-1])).any() else 0
            if last:
                yield linked([x[:last] for x in held])
            rest = [x[last:].copy() for x in held]
        if rest is not None:
            yield linked(rest)

    dealt = rows.select("choice", "value", "f").repartition("choice", "value").sortWithinPartitions("choice", "value", "f")
    return dealt.mapInArrow(search, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, from edges
    (a, b) with a > b, by alternating large-star and small-star steps."""

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialize(edges)
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lowest, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(lowest.select("a", F.col("m").alias("b"))).distinct())
        edges = materialize(small)
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4, carried: list[str] | None = None) -> DataFrame:
    """The columns `carried` of docs (all by default) plus `simhash` (signed
    64-bit), `simhash_root` (equal for all rows of a component) and
    `component_id` (the smallest doc_id of it), which take the place of columns
    of these names."""
    own = others(docs if carried is None else docs.select(*carried), ["simhash", "simhash_root", "component_id"])
    held = kept(docs.select(*own, fingerprints(F.col(text), shingle).alias("simhash"), F.col(doc_id).alias("__id")), "fingerprints")
    per = held.groupBy(F.col("simhash").alias("f")).agg(F.min("__id").alias("least"))
    per = kept(per, "distinct-fingerprints")
    roots = components(links(per.select("f"), radius, per.count()))
    of = per.join(roots, F.col("f") == F.col("node"), "left").select("f", "least", F.coalesce("root", "f").alias("simhash_root"))
    smallest = of.groupBy(F.col("simhash_root").alias("r")).agg(F.min("least").alias("component_id"))
    named = of.join(smallest, F.col("simhash_root") == F.col("r")).select(F.col("f").alias("__f"), "simhash_root", "component_id")
    return held.join(named, F.col("simhash") == F.col("__f")).select(*own, "simhash", "simhash_root", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of docs with the smallest id of their component, one for each
    component."""
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # whatever they are called
    at = {c.lower(): f"c{i}" for i, c in enumerate(docs.columns)}
    found = near_duplicates(named, at[doc_id.lower()], at[text.lower()], shingle, radius)
    first = found.where(F.col(at[doc_id.lower()]).eqNullSafe(F.col("component_id")))
    # several rows with the smallest id can only come from repeated ids
    if docs.groupBy(doc_id).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        first = first.dropDuplicates(["simhash_root"])
    return first.select(*named.columns).toDF(*docs.columns)
