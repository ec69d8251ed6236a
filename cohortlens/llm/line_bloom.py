"""Line deduplication by two Bloom filters.

Pass 1 reads every line and keeps, for each task, a filter of the hashes seen
once and a filter of those seen again; the tasks' filters are merged chunk by
chunk (a bit set in two tasks counts as seen again). Pass 2 sends only lines
that the second filter suspects through a shuffle, where they are counted
exactly. Filters have no false negatives, so nothing is lost; they are of at
most `MAX_BITS` bits, so what is broadcast does not grow with the data (a
fuller filter only sends more lines to the exact count).

Null and empty texts are one empty line. A document is a doc_id: rows that
repeat an id count as one document and lose the same lines. A null id is one
document that sorts before all others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import SPACES, blobs, lists

MAX_BITS = 1 << 26
CHUNK = 4096


def line_key(line: bytes) -> bytes:
    return line.strip(SPACES).lower()


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def keys_of(text: bytes | None, least: int) -> set[bytes]:
    """The distinct keys of a text that are long enough to be judged."""
    found = {line_key(x) for x in (text or b"").split(b"\n")} if text and len(text) >= least else set()
    return {k for k in found if long_enough(k, least)}


def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) * np.uint64(0x9E3779B1) >> np.uint64(3) & mask


def has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    a, b = places(hashes, len(bitmap) * 8)
    one = lambda p: bitmap[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1
    return (one(a) & one(b)).astype(bool)


def put(bitmap: np.ndarray, hashes: np.ndarray) -> None:
    for p in places(hashes, len(bitmap) * 8):
        np.bitwise_or.at(bitmap, p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))


def see(once: np.ndarray, twice: np.ndarray, hashes: np.ndarray) -> None:
    """Adds hashes, each from another document, to the two filters."""
    values, n = np.unique(hashes, return_counts=True)
    put(twice, values[(n > 1) | has(once, values)])
    put(once, values)


def seen_again(docs: DataFrame, text: str, bits: int, least: int) -> np.ndarray:
    """The merged filter of hashes that more than one document may hold."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            found: list[int] = []
            for blob in blobs(batch.column(0)):
                found.extend(map(xxhash.xxh64_intdigest, keys_of(blob, least)))
                if len(found) > 100_000:
                    see(once, twice, np.array(found, np.uint64))
                    found = []
            see(once, twice, np.array(found, np.uint64))
        size = min(CHUNK, bits // 8)
        used = np.flatnonzero(once.reshape(-1, size).any(axis=1))
        for part in np.array_split(used, max(1, len(used) // 64)):
            rows = [(int(i), *(zlib.compress(x[i * size : (i + 1) * size].tobytes(), 1) for x in (once, twice))) for i in part]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([], [], []), (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice = None, None, None
        for batch in batches:
            out: list[tuple[int, bytes]] = []
            for chunk, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
                if chunk != at:
                    if at is not None:
                        out.append((at, twice.tobytes()))
                    at, once, twice = chunk, a, b
                else:
                    once, twice = once | a, twice | b | (once & a)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], names=["chunk", "twice"])
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([twice.tobytes()], pa.binary())], names=["chunk", "twice"])

    parts = docs.select(F.col(text)).mapInArrow(fill, "chunk int, once binary, twice binary")
    merged = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(merge, "chunk int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.collect():  # at most bits / 8 bytes in all
        out[row["chunk"] * CHUNK : row["chunk"] * CHUNK + len(row["twice"])] = np.frombuffer(row["twice"], np.uint8)
    return out


def filter_bits(docs: DataFrame, text: str) -> int:
    """About 8 bits for each line, a power of two, MAX_BITS at most."""
    lines = docs.agg(F.sum(F.length(text) - F.length(F.translate(text, "\n", "")) + 1)).first()[0] or 0
    return min(MAX_BITS, 1 << max(16, int(8 * lines).bit_length()))


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 20, documents: int = 3) -> DataFrame:
    """(id, keys): for each document the digests (XXH3, 128 bits) of the line
    keys that it loses, being held by at least `documents` documents of which
    another has a larger id."""
    bits = filter_bits(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(seen_again(docs, text, bits, least).tobytes())

    @F.arrow_udf("array<binary>")
    def suspects(texts: pa.Array) -> pa.Array:
        bitmap, counts, found = np.frombuffer(shared.value, np.uint8), [], []
        for blob in blobs(texts):
            keys = list(keys_of(blob, least))
            if keys:
                hits = has(bitmap, np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64))
                keys = [k for k, hit in zip(keys, hits.tolist(), strict=True) if hit]
            counts.append(len(keys))
            found.extend(map(xxhash.xxh3_128_digest, keys))
        return lists(np.array(counts, np.int64), pa.array(found, pa.binary()))

    pairs = docs.select(F.col(doc_id).alias("id"), F.explode(suspects(F.col(text))).alias("key"))
    # counted exactly, by document first, so that a very common line is summed before it meets in one task
    by_key = (pairs.groupBy("key", "id").agg(F.count(F.lit(1)).alias("n")).groupBy("key")
              .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last")).where(F.col("n") >= documents))
    lost = pairs.join(by_key.select(F.col("key").alias("k"), "last"), F.col("key") == F.col("k")).where(~F.col("id").eqNullSafe(F.col("last")))
    return lost.groupBy("id").agg(F.collect_set("key").alias("keys"))


def without(texts: pa.Array, keys: pa.Array) -> pa.Array:
    """Texts without the lines whose key's digest is listed."""
    out, dropped = [], []
    for blob, gone in zip(blobs(texts), keys, strict=True):
        gone = gone.as_py()
        if gone is None or blob is None:
            out.append(None)
            dropped.append(0)
            continue
        gone, lines = set(gone), blob.split(b"\n")
        stay = [x for x in lines if xxhash.xxh3_128_digest(line_key(x)) not in gone]
        out.append(b"\n".join(stay))
        dropped.append(len(lines) - len(stay))
    return pa.StructArray.from_arrays([pa.array(out, pa.binary()).cast(pa.string()), pa.array(dropped, pa.int64())], names=["kept", "n_dropped"])


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 20, documents: int = 3,
                kept: str = "kept_text", n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """The columns of `docs` plus the remaining text, the number of lines
    before, and the number of lines dropped; they take the place of columns of
    these names."""
    lost = repeated_lines(docs, doc_id, text, least, documents).select(F.col("id").alias("__lost_id"), F.col("keys").alias("__lost_keys"))
    both = docs.join(lost, docs[doc_id].eqNullSafe(F.col("__lost_id")), "left")
    result = F.arrow_udf(without, "struct<kept: string, n_dropped: bigint>")(F.when(F.col("__lost_keys").isNotNull(), docs[text]), F.col("__lost_keys"))
    whole = F.coalesce(docs[text], F.lit(""))
    return (both.withColumn("__result", result)
            .withColumns({kept: F.coalesce(F.col("__result.kept"), whole), n_dropped: F.col("__result.n_dropped"),
                          n_lines: (F.length(whole) - F.length(F.translate(whole, "\n", "")) + 1).cast("bigint")})
            .drop("__lost_id", "__lost_keys", "__result"))
