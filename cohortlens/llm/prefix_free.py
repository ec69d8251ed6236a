"""Removal of repeated substrings through prefix-free parsing.

Parsing: a rolling hash runs over each text, and of every `LOOK` hashes in a
row the smallest is the trigger (the last of equal ones). Which trigger a
`span`-byte string has depends on its own bytes alone, so equal strings have
equal triggers, wherever they stand; strings with one trigger stand together
and make a phrase, which reaches from the first of them to the end of the last.
(The classical rule, hash modulo p, has no bound on the distance of triggers;
this one has a trigger in every string.)

Dictionary: the distinct phrases, each with its first place in the corpus.
Phrases are dealt by the bytes that all strings of a trigger share, its
`span - LOOK + 1` bytes from the trigger on. Every other occurrence of a phrase
repeats an earlier one as a whole. Where several phrases share a trigger, they
are cut into phrases of `STEP` strings by their distance from the trigger, and
judged again; only where these still differ are strings compared one by one: a
string is a suffix of its phrase up to the trigger, followed by what the parse
has after it. Equal (suffix,
continuation) pairs are the neighbours in corpus order that agree in `span`
bytes; as just this depth is asked for, equal pairs are brought together by
128-bit hashes, and no order is computed beyond it.

The order of places is doc_id, then start. A null id comes before all others.
Rows that repeat an id are ordered by a hash of their text; rows that are equal
in both are one document. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cohortlens.llm.common import PrefixHash, blobs, kept, mixed, others, signed

LOOK = 64
GRAM = 16
#: strings in a phrase of the second round
STEP = 8
#: bytes parsed at a time
PART = 1 << 19


def triggers(grams: np.ndarray) -> np.ndarray:
    """The trigger of the string at each place with LOOK hashes from there on."""
    low = np.uint64(0xFFFFFFFF)
    best = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    width = 1
    while width < LOOK:  # a power of two
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    return (low - (best & low)).astype(np.int64)


def identity(hashes: PrefixHash, first: np.ndarray, last: np.ndarray, trigger: np.ndarray, span: int) -> np.ndarray:
    """A phrase's hash: its bytes and where they stand around the trigger."""
    return mixed(hashes.of(first, last + span) + (trigger - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (last - first).astype(np.uint64))


def parse(texts: list[bytes], span: int) -> tuple[np.ndarray, ...]:
    """(text, key, phrase, first, last, trigger) of the phrases of each text:
    hashes of the shared bytes and of the phrase, the first and last start of
    its strings, and how far the trigger is from the first."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    many = np.maximum(sizes - span + 1, 0)
    owner = np.repeat(np.arange(len(texts)), many)
    if not len(owner):
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none.view(np.uint64), none, none, none
    start = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(ends - sizes, many)
    hashes = PrefixHash(data)
    trigger = triggers(hashes.grams(GRAM))[start]
    new = np.flatnonzero(np.concatenate(([True], (trigger[1:] != trigger[:-1]) | (owner[1:] != owner[:-1]))))
    last = start[np.concatenate((new[1:], [len(start)])) - 1]
    first, trigger, owner = start[new], trigger[new], owner[new]
    key = hashes.of(trigger, trigger + span - LOOK + 1)
    phrase = identity(hashes, first, last, trigger, span)
    base = (ends - sizes)[owner]
    return owner, key, phrase, first - base, last - base, trigger - first


def phrases(docs: DataFrame, span: int) -> DataFrame:
    """(id, row, key, phrase, first, last, trigger): each phrase of a document
    once; the document's own repeats come as stretches with last = -end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            texts: list[bytes] = []
            held: list[tuple[int, int]] = []  # row of the batch, start of the part
            size = 0
            for i, blob in enumerate(blobs(batch.column(2))):
                for k in range(0, max(1, len(blob or b"") - span + 1), PART):
                    texts.append((blob or b"")[k : k + PART + span - 1])
                    held.append((i, k))
                    size += len(texts[-1])
                    if size >= PART:
                        yield made(texts, held, ids, rows)
                        texts, held, size = [], [], 0
            if texts:
                yield made(texts, held, ids, rows)

    def made(texts: list[bytes], held: list[tuple[int, int]], ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        owner, key, phrase, first, last, trigger = parse(texts, span)
        where = np.array(held, np.int64).reshape(-1, 2)
        first, last, at = first + where[owner, 1], last + where[owner, 1], where[owner, 0]
        order = np.lexsort((np.arange(len(at)), phrase, key, at))
        same = np.zeros(len(at), bool)
        a, b = order[:-1], order[1:]
        same[b] = (at[a] == at[b]) & (key[a] == key[b]) & (phrase[a] == phrase[b])
        # repeats inside the document, overlapping ones as one stretch
        r = np.flatnonzero(same)
        if len(r):
            cut = np.concatenate(([True], (at[r[1:]] != at[r[:-1]]) | (first[r[1:]] > last[r[:-1]] + span)))
            head = r[cut]
            tail = r[np.concatenate((np.flatnonzero(cut)[1:], [len(r)])) - 1]
            spread = mixed(phrase[head] + first[head].astype(np.uint64) + signed_ids(ids[at[head]]))
            at, key, phrase = np.concatenate((at[~same], at[head])), np.concatenate((key[~same], spread)), np.concatenate((phrase[~same], spread))
            first, last = np.concatenate((first[~same], first[head])), np.concatenate((last[~same], -(last[tail] + span)))
            trigger = np.concatenate((trigger[~same], trigger[head]))
        return phrase_rows(ids[at], rows[at], key, phrase, first, last, trigger)

    return docs.mapInArrow(run, PHRASES)


PHRASES = "id bigint, row bigint, key bigint, phrase bigint, first int, last int, trigger tinyint"


def phrase_rows(ids: np.ndarray, rows: np.ndarray, key: np.ndarray, phrase: np.ndarray, first: np.ndarray, last: np.ndarray, trigger: np.ndarray) -> pa.RecordBatch:
    columns = (ids, rows, signed(key), signed(phrase), first.astype(np.int32), last.astype(np.int32), trigger.astype(np.int8))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[c.split()[0] for c in PHRASES.split(", ")])


def shorter(docs: DataFrame, span: int) -> DataFrame:
    """The listed phrases cut by distance from the trigger into phrases of at
    most STEP strings, as rows of phrases()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, r, blob, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), blobs(batch.column(2)), batch.column(3), strict=True):
                key, first, last, trigger = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in listed.values.flatten())
                for part in np.unique(first // PART):
                    own = first // PART == part
                    base = part * PART
                    hashes = PrefixHash(np.frombuffer(blob[base : base + PART + 2 * LOOK + span], np.uint8))
                    a, b, t = first[own] - base, last[own] - base, (first + trigger)[own] - base
                    low = (t - b) // STEP
                    many = (t - a) // STEP - low + 1
                    at = np.repeat(np.arange(len(a)), many)
                    step = low[at] + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
                    a, b, t = np.maximum(a[at], t[at] - STEP * step - STEP + 1), np.minimum(b[at], t[at] - STEP * step), t[at]
                    shared = hashes.of(t - STEP * step, t - STEP * step + span - STEP + 1)
                    deal = mixed(shared + key[own][at].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + step.astype(np.uint64))
                    yield phrase_rows(np.full(len(a), i, np.int64), np.full(len(a), r, np.int64), deal, identity(hashes, a, b, t, span), a + base, b + base, t - a)

    return docs.mapInArrow(run, PHRASES)


def signed_ids(ids: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(ids, np.int64).view(np.uint64)


def strings(docs: DataFrame, span: int) -> DataFrame:
    """(id, row, key, hash, start) of each string of the listed phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for i, r, blob, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), blobs(batch.column(2)), batch.column(3), strict=True):
                for p in listed.as_py() or ():
                    starts = range(p["first"], p["last"] + 1)
                    out[3] += [xxh64_intdigest(blob[x : x + span]) for x in starts]
                    out[4] += starts
                    n = len(starts)
                    out[0] += [i] * n
                    out[1] += [r] * n
                    out[2] += [p["key"]] * n
                    if len(out[0]) > 100_000:
                        yield send(out)
                        out = [[], [], [], [], []]
            yield send(out)

    def send(out: list[list]) -> pa.RecordBatch:
        hashes = pa.array(np.array(out[3], np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), hashes, pa.array(out[4], pa.int32())], names=["id", "row", "key", "hash", "start"])

    return docs.mapInArrow(run, "id bigint, row bigint, key bigint, hash bigint, start int")


def cut_out(texts: Column, spans: Column) -> Column:
    """struct<kept, n_bytes, n_removed, n_spans> of texts without the spans."""

    def of(arr: pa.Array, listed: pa.Array) -> pa.Array:
        kept, sizes, removed, runs = [], [], [], []
        for blob, found in zip(blobs(arr), listed, strict=True):
            blob, n = blob or b"", 0
            if found.is_valid and len(found):
                flat = found.values.flatten()
                a, b = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in flat)
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.flatnonzero(np.concatenate(([True], a[1:] > b[:-1])))
                left, right = a[new], b[np.concatenate((new[1:], [len(a)])) - 1]
                parts = [blob[i:j] for i, j in zip([0, *right.tolist()], [*left.tolist(), len(blob)], strict=True)]
                kept.append(b"".join(parts))
                n = len(left)
            else:
                kept.append(blob)
            sizes.append(len(blob))
            removed.append(len(blob) - len(kept[-1]))
            runs.append(n)
        return pa.StructArray.from_arrays([pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs))], names=["kept", "n_bytes", "n_removed", "n_spans"])

    return F.arrow_udf(of, "struct<kept: binary, n_bytes: bigint, n_removed: bigint, n_spans: bigint>")(texts, spans)


def judged(dealt: DataFrame, span: int, name: str) -> tuple[DataFrame, DataFrame]:
    """(stretches that repeat earlier ones as a whole; by document, the first
    occurrences of phrases that share their key with other ones)."""
    place = F.struct("id", "row", "first")
    by_phrase, by_key = Window.partitionBy("key", "phrase"), Window.partitionBy("key")
    dictionary = (dealt.repartition("key").withColumn("again", (F.min(place).over(by_phrase) < place) | (F.col("last") < 0))
                  .withColumn("shared", F.min("phrase").over(by_key) != F.max("phrase").over(by_key)))
    told = kept(dictionary.where("again or shared").drop("phrase", "shared"), name)
    # the negative end marks a document's own repeats
    whole = told.where("again").select("id", "row", F.col("first").alias("from"), F.when(F.col("last") < 0, -F.col("last")).otherwise(F.col("last") + span).alias("to"))
    listed = told.where("not again").groupBy(F.col("id").alias("i"), F.col("row").alias("r"))
    return whole, listed.agg(F.collect_list(F.struct("key", "first", "last", "trigger")).alias("listed"))


def repeats(held: DataFrame, span: int) -> DataFrame:
    """(id, row, spans): the stretches of bytes (from, to) that are covered by
    strings which also start earlier; they may overlap."""

    def texts_of(listed: DataFrame) -> DataFrame:
        return held.join(listed, (F.col("id") == F.col("i")) & (F.col("row") == F.col("r"))).select("id", "row", "text", "listed")

    whole, listed = judged(phrases(held, span), span, "phrases")
    more, listed = judged(shorter(texts_of(listed), span), span, "shorter-phrases")
    start = F.struct("id", "row", "start")
    single = strings(texts_of(listed), span)
    later = single.withColumn("first", F.min(start).over(Window.partitionBy("hash", "key"))).where(F.col("first") < start)
    later = kept(later.select("id", "row", F.col("start").alias("from"), (F.col("start") + span).alias("to")), "strings")
    spans = whole.union(more).union(later)
    return spans.groupBy(F.col("id").alias("i"), F.col("row").alias("r")).agg(F.collect_list(F.struct("from", "to")).alias("spans"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = 100) -> DataFrame:
    """The columns of docs plus `kept` (the remaining bytes), `n_bytes`,
    `n_removed` and `n_spans`, which take the place of columns of these names."""
    # only where ids repeat is a second part of the document's key needed
    repeated = docs.groupBy(doc_id).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    own = {"__id": F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(1 << 63))), "__row": F.xxhash64(text) if repeated else F.lit(0).cast("bigint")}
    held = docs.withColumns(own)
    texts = held.select(F.col("__id").alias("id"), F.col("__row").alias("row"), F.col(text).alias("text"))
    found = repeats(texts, span).toDF("__i", "__r", "__spans")
    both = held.join(found, (F.col("__id") == F.col("__i")) & (F.col("__row") == F.col("__r")), "left")
    return both.withColumn("__cut", cut_out(F.col(text), F.col("__spans"))).select(*others(docs, ["kept", "n_bytes", "n_removed", "n_spans"]), "__cut.kept", "__cut.n_bytes", "__cut.n_removed", "__cut.n_spans")
