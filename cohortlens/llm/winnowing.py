"""Benchmark decontamination by winnowing.

Texts are sequences of words. Of every `size - gram + 1` consecutive hashes of
`gram`-word strings the smallest is kept as a fingerprint, so any `size`
common words share at least one. Items of fewer words than `size` are one
window, with the hash of the whole item as fingerprint. Documents' and items'
fingerprints are joined (a Bloom filter of at most `MAX_BITS` bits of the
items' fingerprints goes first, so that few of the documents' are shuffled;
fuller filters only pass more), and each hit is extended over equal words to
the left and right; stretches of at least one window count.

Null texts have no words. Rows that repeat a doc_id are judged one by one;
rows that repeat an item_id are one item with the windows of all its rows. Items
with a null id mark words but are listed nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cohortlens.llm.common import blobs, kept, lists, mixed, others, signed

MAX_BITS = 1 << 26
GRAM = 5
#: bytes that stand in words: digits, letters (in lower case) and all beyond ASCII
WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_BYTES).split()


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, found), np.uint64, len(found))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k words in a row, by first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return out


def winnowed(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct fingerprints of a text of at least `size` words."""
    grams = gram_hashes(hashes, GRAM)
    width = size - GRAM + 1
    if len(grams) < width:
        return np.zeros(0, np.uint64)
    low = grams
    for i in range(1, width):
        low = np.minimum(low[: len(grams) - width + 1], grams[i : i + len(grams) - width + 1])
    return np.unique(low)


def fingerprints(hashes: np.ndarray, size: int, short: tuple[int, ...]) -> np.ndarray:
    """Of a document: the winnowed ones and, for the lengths of short items,
    all hashes of so many words."""
    return np.unique(np.concatenate([winnowed(hashes, size), *(gram_hashes(hashes, n) for n in short)]))


def item_fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    return winnowed(hashes, size) if len(hashes) >= size else gram_hashes(hashes, len(hashes)) if len(hashes) else np.zeros(0, np.uint64)


def bloom_places(values: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64(bits - 1)
    return [values & mask, (values >> np.uint64(24)) & mask, (values >> np.uint64(38)) & mask]


def bloom(fps: DataFrame) -> np.ndarray:
    """A filter of the column fp, 16 bits for each value, MAX_BITS at most."""
    n = fps.count()
    bits = min(MAX_BITS, 1 << max(16, int(16 * n).bit_length()))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for p in bloom_places(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits):
                np.bitwise_or.at(own, p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))
        full = own.view(np.int64)
        at = np.flatnonzero(full)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(full[at])], names=["at", "word"])

    out = np.zeros(bits // 64, np.int64)
    for r in fps.select("fp").mapInArrow(fill, "at bigint, word bigint").groupBy("at").agg(F.bit_or("word").alias("word")).toLocalIterator():  # at most bits / 64 rows
        out[r["at"]] = r["word"]
    return out.view(np.uint8)


def covered(hashes: np.ndarray, found: list[bytes], items: list[tuple[int | None, list[bytes]]], size: int) -> tuple[np.ndarray, list[bool]]:
    """(hit words of a document, whether each item occurs): every place of an
    item's fingerprint is extended over equal words both ways."""
    hit = np.zeros(len(found), bool)
    met = []
    prepared = [(item, word_hashes(item)) for _, item in items]
    # the places of all items' fingerprints in the document, by number of words
    chosen: dict[int, list[np.ndarray]] = {}
    for item, own in prepared:
        chosen.setdefault(GRAM if len(item) >= size else len(item), []).append(item_fingerprints(own, size))
    places: dict[int, dict[int, list[int]]] = {}
    for n, values in chosen.items():
        grams = gram_hashes(hashes, n) if n else np.zeros(0, np.uint64)
        at = np.flatnonzero(np.isin(grams, np.concatenate(values)))
        places[n] = {}
        for p, h in zip(at.tolist(), grams[at].tolist(), strict=True):
            places[n].setdefault(h, []).append(p)
    for item, own in prepared:
        occurs, reached = False, {}  # by diagonal, the word up to which a stretch has been followed
        gram, fps = (GRAM if len(item) >= size else len(item)), set(item_fingerprints(own, size).tolist())
        for q, h in enumerate(gram_hashes(own, gram).tolist() if item else ()):
            for p in places[gram].get(h, ()) if h in fps else ():
                if reached.get(p - q, -1) > p:
                    continue
                a = 0
                while p - a > 0 and q - a > 0 and found[p - a - 1] == item[q - a - 1]:
                    a += 1
                b = 0
                while p + b < len(found) and q + b < len(item) and found[p + b] == item[q + b]:
                    b += 1
                reached[p - q] = p + max(b, 1)
                if a + b >= min(size, len(item)):
                    hit[p - a : p + b] = True
                    occurs = True
        met.append(occurs)
    return hit, met


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = 10, prefix: str = "") -> DataFrame:
    """The columns of `docs` plus `n_words`, `n_hit`, `hit_spans` (array of
    from, to in words) and `item_ids` (array of the occurring items' ids), each
    with the prefix; they take the place of columns of the same names."""
    spark = docs.sparkSession
    new = [prefix + c for c in ("n_words", "n_hit", "hit_spans", "item_ids")]
    own = others(docs, [c for c in new if c.lower() != text.lower()])

    def item_words(arr: pa.Array) -> pa.Array:
        counts, values, lengths = [], [], []
        for blob in blobs(arr):
            h = word_hashes(words(blob))
            f = item_fingerprints(h, size)
            counts.append(len(f))
            values.append(f)
            lengths.append(len(h))
        fps = lists(np.array(counts, np.int64), pa.array(signed(np.concatenate([*values, np.zeros(0, np.uint64)]))))
        return pa.StructArray.from_arrays([fps, pa.array(lengths, pa.int64())], names=["fps", "n"])

    items = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).alias("item_text")).distinct()
    items = items.withColumn("w", F.arrow_udf(item_words, "struct<fps: array<bigint>, n: bigint>")(F.col("item_text"))).where("w.n > 0")
    items = kept(items.select("item", "item_text", "w.fps", F.col("w.n").alias("n")), "benchmark-items")
    short = tuple(r["n"] for r in items.where(F.col("n") < size).select("n").distinct().collect())  # fewer than `size` rows
    bench = items.select(F.explode("fps").alias("fp"), "item", "item_text")
    seen = spark.sparkContext.broadcast(bloom(bench.select("fp").distinct()).tobytes())

    def judge(arr: pa.Array) -> pa.Array:
        bitmap = np.frombuffer(seen.value, np.uint8)
        lengths, counts, values = [], [], []
        for blob in blobs(arr):
            h = word_hashes(words(blob))
            f = fingerprints(h, size, short)
            ok = np.ones(len(f), bool)
            for p in bloom_places(f, len(bitmap) * 8):
                ok &= (bitmap[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            lengths.append(len(h))
            counts.append(int(ok.sum()))
            values.append(f[ok])
        fps = lists(np.array(counts, np.int64), pa.array(signed(np.concatenate([*values, np.zeros(0, np.uint64)]))))
        return pa.StructArray.from_arrays([pa.array(lengths, pa.int64()), fps], names=["n", "fps"])

    judged = docs.withColumn("__j", F.arrow_udf(judge, "struct<n: bigint, fps: array<bigint>>")(F.col(text))).withColumn("__row", F.monotonically_increasing_id())
    judged = kept(judged.select(*own, "__row", F.col("__j.n").alias("__n"), F.col("__j.fps").alias("__fps")), "winnowed")
    suspects = judged.where(F.size("__fps") > 0)
    pairs = suspects.select("__row", F.explode("__fps").alias("fp")).join(bench.select("fp", "item", "item_text"), "fp").select("__row", "item", "item_text").distinct()
    listed = pairs.groupBy(F.col("__row").alias("__r")).agg(F.collect_list(F.struct("item", "item_text")).alias("__items"))

    def extend(texts: pa.Array, found: pa.Array) -> pa.Array:
        hits, spans, ids = [], [], []
        for blob, candidates in zip(blobs(texts), found, strict=True):
            own = words(blob)
            items = [(c["item"], words(c["item_text"].encode())) for c in candidates.as_py() or []]
            hit, met = covered(word_hashes(own), own, items, size)
            edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))).tolist()
            hits.append(int(hit.sum()))
            spans.append([{"from": a, "to": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
            ids.append(sorted({i for (i, _), m in zip(items, met, strict=True) if m and i is not None}))
        return pa.StructArray.from_arrays([pa.array(hits, pa.int64()), pa.array(spans, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))), pa.array(ids, pa.list_(pa.int64()))], names=["n", "spans", "ids"])

    checked = (judged.where(F.size("__fps") > 0).select("__row", text).join(listed, F.col("__row") == F.col("__r"))
               .select(F.col("__row").alias("__r"), F.arrow_udf(extend, "struct<n: bigint, spans: array<struct<from: bigint, to: bigint>>, ids: array<bigint>>")(F.col(text), F.col("__items")).alias("__hit"))
               .where("__hit.n > 0"))
    none = F.array().cast("array<struct<from: bigint, to: bigint>>")
    return (judged.join(checked, F.col("__row") == F.col("__r"), "left")
            .select(*own, F.col("__n").alias(new[0]), F.coalesce("__hit.n", F.lit(0)).cast("bigint").alias(new[1]), F.coalesce("__hit.spans", none).alias(new[2]),
                    F.coalesce("__hit.ids", F.array().cast("array<bigint>")).alias(new[3])))
