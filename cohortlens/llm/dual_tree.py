"""Ranked lexical search by a dual tree over items and documents.

Items and documents are sparse vectors over the items' terms: an item holds
weight times repeats, a document the whole-number impact of each term. Both
sides get trees, split again and again at the term that parts a node best;
every node holds the largest value of each coordinate below it. The inner
product of two nodes' maxima is an upper bound for all pairs below them: where
it stays under the weakest k-th score of the node's items, the whole batch of
pairs is left out, which is exact; else both nodes are opened. Leaves are
scored in 64-bit whole numbers.

Documents are read once and become lists of (term number, frequency), kept as
a table; document counts of the terms are sums over it. Then each task builds
trees over blocks of its documents and searches them one after another with
the items' tree, so that the bounds rise as it reads, starting from the k-th
scores of a first search over a sample (any documents' scores bound the k-th
best from below, so the sample decides the speed only). Each task returns the
k best of an item, and Spark merges these. Items are taken in rounds of a
bounded size, so that what is sent to the tasks is bounded.

Terms are compared as bytes, only A-Z is lower-cased. Null and empty texts
have no terms: such documents aren't counted, such items return nothing. Rows
that repeat an id are items or documents of their own; equal scores stand by
ascending document id, null ids last. Columns but ids and texts aren't read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cohortlens.llm.common import blobs, kept, lists

#: bytes that end a term become blanks, A-Z becomes a-z
CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: what is sent to the tasks at once: bytes of the items' texts in a round
ROUND_BYTES = 4 << 20
BLOCK = 4096
LEAF = 16
ITEM_LEAF = 4
SAMPLE = 20_000
FAR = np.iinfo(np.int64).max


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(CLEAN).split()


class Sparse:
    """Rows of (term, value), flat with offsets; terms ascend in a row."""

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, values: np.ndarray):
        self.at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        self.terms, self.values = terms, values

    def __len__(self) -> int:
        return len(self.at) - 1

    def places(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The flat places of all entries of these rows, and the rows' sizes."""
        sizes = self.at[rows + 1] - self.at[rows]
        ends = np.cumsum(sizes)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.at[rows] - (ends - sizes), sizes), sizes

    def rows(self, rows: np.ndarray) -> Sparse:
        at, sizes = self.places(rows)
        return Sparse(sizes, self.terms[at], self.values[at])


def largest(terms: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms in order and the largest value of each."""
    order = np.argsort(terms, kind="stable")
    found, starts = np.unique(terms[order], return_index=True)
    return found, np.maximum.reduceat(values[order], starts) if len(found) else values[:0]


class Tree:
    """Nodes in breadth-first order, each with the rows below it (a range of
    `order`), its children (a range of nodes, empty for a leaf) and maxima."""

    def __init__(self, rows: Sparse, weight: np.ndarray, leaf: int):
        self.order = np.arange(len(rows))
        spans, children, at = [(0, len(rows))], [], 0
        while at < len(spans):
            a, b = spans[at]
            if b - a <= leaf:
                children.append((len(spans), len(spans)))
            else:
                cut = self.split(rows, weight, a, b)
                children.append((len(spans), len(spans) + 2))
                spans += [(a, cut), (cut, b)]
            at += 1
        self.spans, self.children = np.array(spans), np.array(children)
        self.rows = rows.rows(self.order)
        maxima: list[tuple[np.ndarray, np.ndarray]] = [None] * len(spans)  # type: ignore[list-item]
        for i in range(len(spans) - 1, -1, -1):
            (a, b), (c, d) = spans[i], children[i]
            if c < d:
                maxima[i] = largest(*(np.concatenate([maxima[j][k] for j in range(c, d)]) for k in (0, 1)))
            else:
                cut = slice(self.rows.at[a], self.rows.at[b])
                maxima[i] = largest(self.rows.terms[cut], self.rows.values[cut])
        self.maxima = Sparse(np.array([len(t) for t, _ in maxima], np.int64), *(np.concatenate([m[k] for m in maxima]) for k in (0, 1)))

    def split(self, rows: Sparse, weight: np.ndarray, a: int, b: int) -> int:
        """Orders the rows of [a, b) by whether they hold the term whose
        weighted presence differs most among them; returns the border."""
        mine, n = self.order[a:b], b - a
        at, sizes = rows.places(mine)
        found, inverse = np.unique(rows.terms[at], return_inverse=True)
        if len(found):
            share = np.bincount(inverse) / n
            gain = weight[found] ** 2 * share * (1 - share)
            best = int(gain.argmax())
            holds = np.zeros(n, bool)
            holds[np.repeat(np.arange(n), sizes)[inverse == best]] = True
            cut = int(holds.sum())
            if n // 16 < cut < n - n // 16:
                self.order[a:b] = np.concatenate([mine[holds], mine[~holds]])
                return a + cut
            if 0 < cut < n:
                self.order[a:b] = np.concatenate([mine[holds], mine[~holds]])
        return a + n // 2


class Search:
    """The items' tree and the k best documents found for each item so far."""

    def __init__(self, items: Sparse, weight: np.ndarray, k: int, floor: np.ndarray):
        self.k, self.tree = k, Tree(items, weight, ITEM_LEAF)
        self.floor = np.maximum(floor, 1)[self.tree.order]  # scores below can't be among the best
        n = len(items)
        self.scores = np.zeros((n, k), np.int64)
        self.docs = np.full((n, k), FAR)
        self.position = np.zeros(len(weight) + 1, np.int64)
        self.weakest = np.zeros(len(self.tree.spans), np.int64)
        self.scored = self.bounded = 0
        self.renew()

    def renew(self) -> None:
        """The weakest k-th score of each node's items."""
        kth = np.maximum(self.floor, self.scores[:, -1])
        spans, children = self.tree.spans, self.tree.children
        leaves = np.flatnonzero(children[:, 0] == children[:, 1])
        by_place = leaves[np.argsort(spans[leaves, 0])]
        self.weakest[by_place] = np.minimum.reduceat(kth, spans[by_place, 0])
        for i in np.flatnonzero(children[:, 0] < children[:, 1])[::-1]:
            c = children[i, 0]
            self.weakest[i] = min(self.weakest[c], self.weakest[c + 1])

    def products(self, rows: Sparse, which: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Inner products of these rows with columns of values by term."""
        if not len(which):
            return np.zeros((0, values.shape[1]), np.int64)
        self.position[terms] = np.arange(1, len(terms) + 1)
        at, sizes = rows.places(which)
        place = self.position[rows.terms[at]]
        hit = np.flatnonzero(place)
        row = np.repeat(np.arange(len(which)), sizes)[hit]
        out = np.zeros((len(which), values.shape[1]), np.int64)
        if len(hit):
            starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            out[row[starts]] = np.add.reduceat(rows.values[at[hit], None] * values[place[hit] - 1], starts, axis=0)
        self.position[terms] = 0
        return out

    def block(self, docs: Sparse, ids: np.ndarray, weight: np.ndarray) -> None:
        """Searches one block of documents; `ids` ascend with the place of ties."""
        if not len(docs) or not len(self.tree.order):
            return
        tree = Tree(docs, weight, LEAF)
        stack = [(0, np.zeros(1, np.int64))]
        while stack:
            node, items = stack.pop()
            cut = slice(tree.maxima.at[node], tree.maxima.at[node + 1])
            terms, values = tree.maxima.terms[cut], tree.maxima.values[cut, None]
            a, b = tree.children[node]
            if a < b:
                items = self.left(items, terms, values)
                if len(items):
                    items = self.opened(items)
                    stack += [(child, items) for child in range(a, b)]
                continue
            done: list[np.ndarray] = []
            while len(items):  # a leaf of documents: down to the items' leaves
                items = self.left(items, terms, values)
                is_leaf = self.tree.children[items, 0] == self.tree.children[items, 1]
                done.append(items[is_leaf])
                items = self.opened(items[~is_leaf])
            leaves = np.concatenate(done)
            for start in range(0, len(leaves), 256):
                self.score(tree, node, leaves[start : start + 256], ids)

    def left(self, items: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The item nodes that may hold a pair with this document node."""
        self.bounded += len(items)
        return items[self.products(self.tree.maxima, items, terms, values)[:, 0] >= self.weakest[items]]

    def opened(self, items: np.ndarray) -> np.ndarray:
        """The children of these nodes; leaves stay."""
        a, b = self.tree.children[items].T
        inner = a < b
        return np.concatenate([items[~inner], a[inner], b[inner] - 1])

    def score(self, tree: Tree, node: int, leaves: np.ndarray, ids: np.ndarray) -> None:
        a, b = tree.spans[node]
        docs = tree.rows
        cut = slice(docs.at[a], docs.at[b])
        terms, place = np.unique(docs.terms[cut], return_inverse=True)
        values = np.zeros((len(terms), b - a), np.int64)
        values[place, np.repeat(np.arange(b - a), np.diff(docs.at[a : b + 1]))] = docs.values[cut]
        items = np.concatenate([np.arange(*self.tree.spans[x]) for x in leaves])
        found = self.products(self.tree.rows, items, terms, values)
        self.scored += found.size
        names = ids[tree.order[a:b]]
        better = found >= np.maximum(self.floor, self.scores[:, -1])[items, None]
        rows = np.flatnonzero(better.any(1))
        for r in rows:
            item, new = items[r], np.flatnonzero(better[r])
            scores = np.concatenate([self.scores[item], found[r, new]])
            docs_ = np.concatenate([self.docs[item], names[new]])
            best = np.lexsort((docs_, -scores))[: self.k]
            self.scores[item], self.docs[item] = scores[best], docs_[best]
        if len(rows):
            self.renew()


def vectors(docs: DataFrame, doc_id: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, tfs): of each document with a term, how many it has, and
    the numbers and frequencies of those in the vocabulary, by number."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a round's terms, at most ROUND_BYTES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows, total, terms, tfs, sizes = [], [], [], [], []
            for at, blob in enumerate(blobs(batch.column(1))):
                found = terms_of(blob)
                if not found:
                    continue
                mine = Counter(map(known.get, found))
                mine.pop(None, None)
                numbers = sorted(mine)
                rows.append(at)
                total.append(len(found))
                sizes.append(len(numbers))
                terms += numbers
                tfs += [mine[x] for x in numbers]
            each = np.array(sizes, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(total, pa.int64()), lists(each, pa.array(terms, pa.int32())), lists(each, pa.array(tfs, pa.int64()))], names=["id", "n", "terms", "tfs"])

    schema = T.StructType([T.StructField("id", docs.schema[doc_id].dataType)])
    schema.add("n", T.LongType()).add("terms", T.ArrayType(T.IntegerType())).add("tfs", T.ArrayType(T.LongType()))
    return docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`")).mapInArrow(count, schema)


def found(table: DataFrame, items: Sparse, weight: np.ndarray, documents: int, words: int, k: int, floor: np.ndarray) -> DataFrame:
    """(item number, id, score): the k best of each item in each partition."""
    shared = table.sparkSession.sparkContext.broadcast((items, weight, floor))  # bounded by a round's texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, floor = shared.value
        weight = weight.astype(np.float64)
        search = Search(items, weight, k, floor)
        names = None  # the ids in ascending order that the search has numbers for
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                cut = batch.slice(start, BLOCK)
                ids, n = cut.column(0), cut.column(1).to_pylist()
                sizes = np.diff(cut.column(2).offsets.to_numpy())
                terms, tfs = (cut.column(i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
                m = np.array([75 + 25 * x * documents // words for x in n], np.int64)
                impact = 1_000_000_000 * tfs // (1000 * tfs + 12 * np.repeat(m, sizes))
                # equal scores stand by id: the ids among the best so far and those of the block are numbered in order
                held = search.docs != FAR
                used = np.unique(search.docs[held])
                both = ids if names is None else pa.concat_arrays([names.take(pa.array(used)), ids])
                place = pc.rank(both, sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy().astype(np.int64) - 1
                search.docs[held] = place[np.searchsorted(used, search.docs[held])]
                names = both.take(pa.array(np.argsort(place)))
                search.block(Sparse(sizes, terms, impact), place[len(place) - len(ids) :], weight)
        hit = search.docs != FAR
        if hit.any():
            number = np.repeat(search.tree.order, hit.sum(1))
            yield pa.RecordBatch.from_arrays([pa.array(number), names.take(pa.array(search.docs[hit])), pa.array(search.scores[hit])], names=["item", "id", "score"])

    schema = T.StructType([T.StructField("item", T.LongType()), table.schema["id"], T.StructField("score", T.LongType())])
    return table.mapInArrow(run, schema)


def rounds_of(items: DataFrame, text: str) -> int:
    """So many rounds that each one's texts stay within ROUND_BYTES."""
    rounds = max(1, -(-(items.agg(F.sum(F.octet_length(text))).first()[0] or 0) // ROUND_BYTES))
    while True:
        dealt = items.groupBy(F.pmod(F.xxhash64(*items.columns), F.lit(rounds))).agg(F.sum(F.octet_length(text)).alias("bytes"), F.count(F.lit(1)).alias("n"))
        if dealt.where((F.col("bytes") > 2 * ROUND_BYTES) & (F.col("n") > 1)).isEmpty() or rounds > 1 << 20:
            return rounds
        rounds *= 2


def best_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): each item row's k best documents."""
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    rounds, out = rounds_of(asked, "text"), None
    for turn in range(rounds):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == turn).collect()  # at most about ROUND_BYTES of text
        counts = [Counter(terms_of(None if r["text"] is None else r["text"].encode())) for r in part]
        vocabulary = {t: i for i, t in enumerate(sorted({t for c in counts for t in c}))}
        table = kept(vectors(docs, doc_id, text, vocabulary), "terms")
        documents, words = table.agg(F.count(F.lit(1)), F.sum("n")).first()
        names = [r["item_id"] for r in part]
        if documents and vocabulary:
            df = np.zeros(len(vocabulary), np.int64)
            for r in table.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():  # a round's terms
                df[r["term"]] = r["df"]
            weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
            if max(sum(int(weight[vocabulary[t]]) * n for t, n in c.items()) for c in counts) >= FAR // 1_000_000:
                raise ValueError("an item has so many terms that its scores may not fit 64 bits")
            rows = [sorted((vocabulary[t], n) for t, n in c.items()) for c in counts]
            flat = np.array([x for r in rows for x in r], np.int64).reshape(-1, 2)
            sparse = Sparse(np.array([len(r) for r in rows], np.int64), flat[:, 0], flat[:, 1] * weight[flat[:, 0]])
            floor = np.ones(len(rows), np.int64)
            share = min(1 / 16, SAMPLE / documents)
            first = table.where(F.pmod(F.xxhash64("id", "n"), F.lit(1 << 20)) < int(share * (1 << 20)))
            place = Window.partitionBy("item").orderBy(F.desc("score"))
            start = found(first, sparse, weight, documents, words, k, floor)
            for r in start.withColumn("place", F.row_number().over(place)).where(F.col("place") == k).collect():  # a row an item
                floor[r["item"]] = r["score"]
            best = found(table, sparse, weight, documents, words, k, floor)
        else:
            best = spark.createDataFrame([], T.StructType([T.StructField("item", T.LongType()), table.schema["id"], T.StructField("score", T.LongType())]))
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
        best = best.withColumn("rank", place).where(F.col("rank") <= k)
        numbered = spark.createDataFrame(pa.table({"__item": pa.array(range(len(names)), pa.int64()), "item_id": pa.array(names, to_arrow_type(items.schema[item_id].dataType))}))
        best = best.join(numbered, F.col("item") == F.col("__item")).select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        out = best if out is None else out.unionByName(best)
    return out
