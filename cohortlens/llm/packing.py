"""Best-fit packing of token sequences by linear grouping.

Every document is tokenized whole, cut into pieces of at most `size` ids, and
the pieces are packed into sequences of `size` ids. Lengths are whole numbers
up to `size`, so the plan is made from their histogram (at most `size` rows,
whatever the corpus): large lengths are sorted and split into groups of equal
cardinality, rounded up to the largest of their group; a linear programme over
configurations of these few lengths (column generation) says how often each
configuration is used; real lengths then take the places of the rounded ones,
and all that remains is placed by best fit, longest first. Runs of equal
sequences are handled as one, so the plan's size doesn't follow the corpus.
Spark then numbers the pieces of each length and looks up their places.

A null text is an empty one: a single end id. Rows that repeat a doc_id are
packed as documents of their own. Ties between pieces of equal length go by
doc_id, piece and content.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import blobs, held, kept, slices

END = b"\0\0\0\0"
GROUPS = 64
#: words, and characters of words, whose ids a Python worker keeps
CACHE = 400_000
CACHE_CHARS = 8_000_000
#: bytes that don't occur in texts of Latin letters (to U+023F), digits, signs and white space that the tokenizer and Python see alike
OTHER = bytes([*range(9), *range(14, 32), *range(0xC9, 256)])
#: letters whose lower case lies far out of this range
LEAVING = ("\u0130", "\u023a", "\u023e")
#: the tokenizer's words in such a text in lower case (superscripts and fractions are numbers, not letters)
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w\s]|_)+")
#: white space of the tokenizer, over which it never joins
PARTS = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: fixed values: the normalizer and pre-tokenizer of a tokenizer file that WORDS stands for
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def tokenizer(path: str):
    """Of a file, kept in each Python worker."""
    return held(("tokenizer", path), lambda: load(path))


def load(path: str):
    """(tokenizer, how Latin characters are spelled for its model or None if
    the file's words are not those of WORDS, ids by word)."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    model = Tokenizer.from_file(path)
    spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    latin = {i: spell.pre_tokenize_str(chr(i))[0][0] for i in range(0x2B0) if i != 0x20}
    return model, latin if known_words(path) else None, {}


def known_words(path: str) -> bool:
    """Whether the file's normalizer and pre-tokenizer are those that WORDS
    stands for; any other tokenizer encodes whole texts by itself."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    return parts.get("normalizer") == NORMALIZER and parts.get("pre_tokenizer") == PRE_TOKENIZER and parts["model"].get("type") == "BPE"


def simple(blob: bytes, text: str) -> bool:
    return len(blob.translate(None, OTHER)) == len(blob) and b"<|" not in blob and (text.isascii() or not any(x in text for x in LEAVING))


def words_of(blob: bytes) -> list[str]:
    """The tokenizer's words; parts between white space that hold other signs
    than Latin ones stay whole, after a null sign."""
    text = blob.decode("utf-8", "replace")
    if simple(blob, text):
        return WORDS.findall(text.lower())
    out: list[str] = []
    for part in PARTS.findall(text):
        out += WORDS.findall(part.lower()) if simple(part.encode(), part) else ["\0" + part]
    return out


def token_ids(texts: list[bytes], path: str) -> list[bytes]:
    """The ids of each text as little-endian 32-bit bytes, end id included.
    Words are cut here, and each new word goes to the tokenizer's model
    directly (which is several times faster); parts with other signs than
    Latin ones, and all texts of other kinds of tokenizers, are encoded by the
    tokenizer as a whole."""
    model, latin, by_word = tokenizer(path)
    whole = lambda x: np.array(model.encode(x, add_special_tokens=False).ids, "<u4").tobytes()
    if latin is None:
        return [whole(x.decode("utf-8", "replace")) + END for x in texts]
    spelled, out = model.model.tokenize, []
    for blob in texts:
        words = words_of(blob)
        ids = list(map(by_word.get, words))
        if None in ids:
            new = {w for w, i in zip(words, ids, strict=True) if i is None}
            if len(by_word) + len(new) > CACHE or by_word.get("", 0) + sum(map(len, new)) > CACHE_CHARS:
                by_word.clear()
                new = set(words)
            by_word[""] = by_word.get("", 0) + sum(map(len, new))  # the characters kept; no word is empty
            for w in new:
                if w[0] == "\0":
                    by_word[w] = whole(w[1:])
                else:
                    by_word[w] = array("I", [t.id for t in spelled(w if w.isascii() and w.isprintable() else w.translate(latin))]).tobytes()
            ids = map(by_word.__getitem__, words)
        out.append(b"".join(ids) + END)
    return out


def pieces(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", size: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for each piece of each text."""

    def cut(arr: pa.Array) -> pa.Array:
        offsets, start, length, crc = [0], [], [], []
        for run in slices(arr):
            for ids in token_ids(run, tokenizer_path):
                view = memoryview(ids)
                for k in range(0, len(ids), 4 * size):
                    part = view[k : k + 4 * size]
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                offsets.append(len(start))
        rows = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, crc)], names=["start", "length", "crc"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    found = F.arrow_udf(cut, "array<struct<start: bigint, length: bigint, crc: bigint>>")(F.col(text))
    return docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(found).alias("piece", "p")).select("doc_id", "piece", F.col("p.start").alias("start"), F.col("p.length").alias("length"), F.col("p.crc").alias("ids_crc32"))


def configurations(sizes: list[int], demand: np.ndarray, capacity: int, rounds: int = 400) -> list[tuple[np.ndarray, float]]:
    """(pattern, times) of the fractional optimum: simplex steps over the
    basis, each new pattern from a knapsack over the dual prices."""
    n = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(n))
        best, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        order = [(s, prices[i], i) for i, s in enumerate(sizes) if prices[i] > 1e-12]
        sized, value, index = (np.array(x) for x in zip(*order, strict=True)) if order else (np.zeros(0, int),) * 3
        for room in range(min(sizes), capacity + 1):
            fits = sized <= room
            best[room] = best[room - 1]
            if fits.any():
                gain = value[fits] + best[room - sized[fits]]
                k = int(gain.argmax())
                if gain[k] > best[room] + 1e-12:
                    best[room], take[room] = gain[k], index[fits][k]
        if best[capacity] <= 1 + 1e-9:
            break
        pattern, room = np.zeros(n), capacity
        while room > 0:
            if take[room] < 0:
                room -= 1
            else:
                pattern[take[room]] += 1
                room -= sizes[take[room]]
        times, change = np.linalg.solve(basis, demand), np.linalg.solve(basis, pattern)
        ratio = np.where(change > 1e-9, times / np.where(change > 1e-9, change, 1), np.inf)
        basis[:, int(ratio.argmin())] = pattern
    times = np.linalg.solve(basis, demand)
    return [(basis[:, j], float(times[j])) for j in range(n) if times[j] > 1e-9]


class Plan:
    """Places for runs of equal lengths: `rows` of (length, first rank,
    number, first sequence, pieces a sequence, offset)."""

    def __init__(self, histogram: dict[int, int], size: int = 2048, groups: int = GROUPS):
        self.size, self.rows, self.sequences = size, [], 0
        self.left = {s: n for s, n in histogram.items() if n}
        self.rank = dict.fromkeys(histogram, 0)
        self.rooms: list[int] = []
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.configured(groups)
        self.best_fit()

    def put(self, length: int, times: int, first: int, each: int, offset: int) -> None:
        """`each` pieces of this length into each of `times` sequences."""
        n = times * each
        self.rows.append((length, self.rank[length], n, first, each, offset))
        self.rank[length] += n
        self.left[length] -= n

    def keep(self, room: int, first: int, times: int) -> None:
        if room > 0 and times > 0:
            if room not in self.open:
                bisect.insort(self.rooms, room)
                self.open[room] = []
            self.open[room].append((first, times))

    def configured(self, groups: int) -> None:
        """The large lengths: grouping, configurations, substitution."""
        large = sorted((s for s in self.left if s > self.size // 8), reverse=True)
        total = sum(self.left[s] for s in large)
        if not total:
            return
        share = -(-total // groups)
        runs: list[list[list[int]]] = [[]]  # of each group, the longest first
        room = share
        for s in large:
            n = self.left[s]
            while n:
                if not room:
                    runs.append([])
                    room = share
                m = min(n, room)
                runs[-1].append([s, m])
                n, room = n - m, room - m
        # groups that round up to one length count as one
        merged: dict[int, list[list[int]]] = {}
        for run in runs:
            merged.setdefault(run[0][0], []).extend(run)
        sizes = list(merged)
        demand = np.array([sum(n for _, n in merged[s]) for s in sizes], float)
        for pattern, times in sorted(configurations(sizes, demand, self.size), key=lambda x: -x[1]):
            wanted = [(s, round(a)) for s, a in zip(sizes, pattern, strict=True) if a > 0.5]
            times = int(times + 1e-7)
            while times and all(sum(n for _, n in merged[s]) >= a for s, a in wanted):
                whole = min(times, *(merged[s][0][1] // a for s, a in wanted)) if wanted else 0
                offset = 0
                if whole:
                    for s, a in wanted:
                        length = merged[s][0][0]
                        self.put(length, whole, self.sequences, a, offset)
                        self.shorten(merged[s], whole * a)
                        offset += a * length
                else:  # one sequence over the border between two lengths
                    whole = 1
                    for s, a in wanted:
                        while a:
                            length, m = merged[s][0][0], min(a, merged[s][0][1])
                            self.put(length, 1, self.sequences, m, offset)
                            self.shorten(merged[s], m)
                            offset, a = offset + m * length, a - m
                self.keep(self.size - offset, self.sequences, whole)
                self.sequences += whole
                times -= whole

    @staticmethod
    def shorten(runs: list[list[int]], n: int) -> None:
        runs[0][1] -= n
        if not runs[0][1]:
            runs.pop(0)

    def best_fit(self) -> None:
        for s in sorted(self.left, reverse=True):
            while n := self.left[s]:
                k = bisect.bisect_left(self.rooms, s)
                if k == len(self.rooms):  # new sequences
                    each = min(self.size // s, n)
                    times = n // each
                    self.put(s, times, self.sequences, each, 0)
                    self.keep(self.size - each * s, self.sequences, times)
                    self.sequences += times
                    continue
                room = self.rooms[k]
                first, times = self.open[room].pop()
                if not self.open[room]:
                    del self.open[room]
                    self.rooms.pop(k)
                each = min(room // s, n)
                used = min(times, n // each)
                self.put(s, used, first, each, self.size - room)
                self.keep(room - each * s, first, used)
                self.keep(room, first + used, times - used)


def pack(found: DataFrame, size: int = 2048, per_bucket: int = 200_000) -> DataFrame:
    """Adds sequence_id and offset to the rows of pieces(), which must be a
    written table (it is read three times)."""
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `size` rows
    plan = np.array(sorted(Plan(histogram, size).rows), np.int64).reshape(-1, 6)
    place = found.sparkSession.sparkContext.broadcast(plan)

    # rank among the pieces of one length: inside a bucket of hashed ids, plus the buckets before
    buckets = max(1, sum(histogram.values()) // per_bucket)
    dealt = found.withColumn("__bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counts = dealt.groupBy("length", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(F.col("length").alias("__length"), F.col("__bucket").alias("__b"), (F.sum("n").over(Window.partitionBy("length").orderBy("__bucket")) - F.col("n")).alias("__before"))
    inside = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = dealt.withColumn("__inside", F.row_number().over(inside) - 1)
    ranked = ranked.join(before, (F.col("length") == F.col("__length")) & (F.col("__bucket") == F.col("__b")))

    def places(length: pa.Array, rank: pa.Array) -> pa.Array:
        rows, length, rank = place.value, length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        at = np.searchsorted((rows[:, 0] << 48) + rows[:, 1], (length << 48) + rank, side="right") - 1
        nth = rank - rows[at, 1]
        return pa.StructArray.from_arrays([pa.array(rows[at, 3] + nth // rows[at, 4]), pa.array(rows[at, 5] + nth % rows[at, 4] * length)], names=["sequence_id", "offset"])

    placed = F.arrow_udf(places, "struct<sequence_id: bigint, offset: bigint>")(F.col("length"), F.col("__inside") + F.col("__before"))
    return ranked.withColumn("__at", placed).select(*found.columns, F.col("__at.sequence_id").alias("sequence_id"), F.col("__at.offset").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", size: int = 2048) -> DataFrame:
    return pack(kept(pieces(docs, tokenizer_path, doc_id, text, size), "pieces"), size)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, each of bounded
    length. Needs unique ids in `docs`."""

    def ids(arr: pa.Array) -> pa.Array:
        return pa.array([list(np.frombuffer(token_ids([x or b""], tokenizer_path)[0], "<u4")) for x in blobs(arr)], pa.list_(pa.int64()))

    whole = docs.select(F.col(doc_id).alias("__id"), F.arrow_udf(ids, "array<bigint>")(F.col(text)).alias("__ids"))
    cut = packed.join(whole, F.col("doc_id").eqNullSafe(F.col("__id"))).select("sequence_id", F.struct("offset", F.slice("__ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("ids")).alias("part"))
    return cut.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["ids"])).alias("ids"))
