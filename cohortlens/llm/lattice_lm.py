"""Language-model scores from a subword lattice.

A word's probability is interpolated: its discounted share of the training
tokens, plus what the discounts free times its probability in the lattice of
an existing subword vocabulary. The lattice weighs every segmentation of the
word into pieces: a piece that begins a word, then pieces that go on, then the
end of the word; a forward recursion (in log space, as words may be long) sums
over all of them. The vocabulary is given, and so are its scores, from which
the pieces' probabilities start (a score is minus the rank, read as Zipf's
law); one expectation step over all distinct training words (forward and
backward, with logs where a word is long) re-estimates them. A text's score is the sum over its words and its
end, in log10: since no piece spans white space, this is the forward recursion
over the whole text.

Word counts are never broadcast: texts are dealt into blocks of about
`BLOCK` bytes, the distinct words of each block are counted, joined with the
corpus counts, and come back to the block's texts. Only the pieces' table
(a row for each piece of the vocabulary) goes through the driver.

Null and empty texts have the end token only. Rows are scored one by one, also
where they repeat an id; rows without id are training rows. Without training
rows the lattice alone scores words, and an end has probability 1.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import blobs, held, kept

BLOCK = 8 << 20
#: stands for the end of a text among the words (words hold no white space)
END = b" "
#: expected pieces that the prior counts for
PRIOR = 50_000.0
#: bytes of a word beyond which its sums surely don't fit plain numbers, or fill much memory
PLAIN = 2000


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[list[str], np.ndarray]:
    """(pieces as latin-1 text of their UTF-8 bytes, prior weights). A blank in
    front marks the begin of a word; the 256 bytes are pieces too, so that
    every word has a segmentation. Last comes the end of a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weights: dict[str, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode().decode("latin-1")
        if piece[1:].count(" "):
            continue
        rank = -model.get_score(i)
        weights[piece] = max(weights.get(piece, 0.0), 1.0 / (2.0 + min(rank, 1e6)))
    for b in range(256):
        weights.setdefault(chr(b), 1e-7)
    weights.setdefault(" ", 1e-4)
    pieces = sorted(weights)
    prior = np.array([weights[p] for p in pieces] + [0.0])
    prior[-1] = 0.3 * prior.sum()  # the end of a word
    return pieces, prior / prior.sum()


class Lattice:
    """Segmentation sums with given weights of the pieces."""

    def __init__(self, path: str, weights: np.ndarray):
        import ahocorasick

        self.pieces, _ = vocabulary(path)
        begins = np.array([p[0] == " " for p in self.pieces] + [False])
        chance = np.where(begins, weights / weights[begins].sum(), weights / weights[~begins].sum())
        self.logs = np.log(np.maximum(chance, 1e-300)).tolist()
        self.stop, self.automaton = len(self.pieces), ahocorasick.Automaton()
        for i, (p, own) in enumerate(zip(self.pieces, chance.tolist())):  # the end of a word is no piece
            self.automaton.add_word(p, (i, len(p), own))
        self.automaton.make_automaton()
        self.chance = chance

    def log_probability(self, word: bytes) -> float:
        """Natural log of the word's probability: forward recursion. Sums are
        held as mantissa, with a common log scale against underflow."""
        if len(word) < 255:  # nothing to rescale
            forward = [0.0] * (len(word) + 1) + [1.0]  # by a piece's last byte; the start is the place before 0
            for end, (_, length, chance) in self.automaton.iter(" " + word.decode("latin-1")):
                forward[end] += forward[end - length] * chance
            return (math.log(forward[-2]) if forward[-2] > 0 else self.log_space(word)) + self.logs[self.stop]
        forward, scale = [1.0] + [0.0] * (len(word) + 1), 0.0
        at = 0
        for end, (_, length, chance) in self.automaton.iter(" " + word.decode("latin-1")):
            end += 1
            if end - at >= 256:  # rescale all that pieces can still reach
                at = end - 1
                top = max(forward[max(0, at - 128) : at + 1])
                if 0 < top < 1e-100:
                    for k in range(max(0, at - 128), end + 1):
                        forward[k] /= top
                    scale += math.log(top)
            forward[end] += forward[end - length] * chance
        return (math.log(forward[-1]) if forward[-1] > 0 else self.log_space(word)) + (scale if forward[-1] > 0 else 0.0) + self.logs[self.stop]

    def log_space(self, word: bytes) -> float:
        """The same sum with logs throughout, for what is too small above."""
        forward = [0.0] + [-math.inf] * (len(word) + 1)
        for end, (i, length, _) in self.automaton.iter(" " + word.decode("latin-1")):
            a, b = forward[end + 1], forward[end + 1 - length] + self.logs[i]
            if b > -math.inf:
                top = max(a, b)
                forward[end + 1] = top + math.log(math.exp(a - top) + math.exp(b - top))
        return forward[-1]

    def expected(self, word: bytes, into: list[float]) -> None:
        """Adds the expected number of each piece in a segmentation."""
        if len(word) > PLAIN:
            return self.expected_long(word, into)
        n = len(word) + 1
        arcs = []
        forward = [0.0] * n + [1.0]  # by a piece's last byte; the start is the place before 0
        for arc in self.automaton.iter(" " + word.decode("latin-1")):
            arcs.append(arc)
            end, (_, length, chance) = arc
            forward[end] += forward[end - length] * chance
        total = forward[n - 1]
        if not total > 1e-290:  # too small for plain numbers
            return self.expected_long(word, into)
        backward = [0.0] * (n + 1)
        backward[n - 1] = 1.0 / total
        arcs.reverse()
        for end, (i, length, chance) in arcs:  # what begins after `end` has been seen
            if after := backward[end] * chance:
                start = end - length
                backward[start] += after
                if share := forward[start] * after:
                    into[i] += share
        into[self.stop] += 1.0

    def expected_long(self, word: bytes, into: list[float]) -> None:
        """The same with logs throughout and flat arrays, for long words."""
        n, logs, exp, log1p = len(word) + 1, self.logs, math.exp, math.log1p
        ends, pieces = array("q"), array("i")
        forward, backward = array("d", [-math.inf]) * (n + 1), array("d", [-math.inf]) * (n + 1)
        forward[0] = backward[n] = 0.0
        for end, (i, length, _) in self.automaton.iter(" " + word.decode("latin-1")):
            end += 1
            ends.append(end)
            pieces.append(i)
            a, b = forward[end], forward[end - length] + logs[i]
            if a < b:
                a, b = b, a
            forward[end] = a + log1p(exp(b - a)) if b > -math.inf else a
        total = forward[n]
        for end, i in zip(reversed(ends), reversed(pieces), strict=True):  # what begins at `end` has been seen
            after = backward[end] + logs[i]
            if after == -math.inf:
                continue
            start = end - len(self.pieces[i])
            into[i] += exp(forward[start] + after - total)
            a, b = backward[start], after
            if a < b:
                a, b = b, a
            backward[start] = a + log1p(exp(b - a)) if b > -math.inf else a
        into[self.stop] += 1.0


def lattice(path: str, weights: bytes | None) -> Lattice:
    """Kept in each Python worker; None: the prior weights."""
    return held(("lattice", path, weights), lambda: Lattice(path, vocabulary(path)[1] if weights is None else np.frombuffer(weights)))


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def block_words(docs: DataFrame) -> DataFrame:
    """(block, word, n, learned): the distinct words of the rows (block, held,
    text) with their number among training rows; words of a block that stand
    in several tasks come several times."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned: dict[int, Counter[bytes]] = {}
        other: dict[int, set[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            for block in {*learned, *other}:
                own = learned.get(block, Counter())
                found = sorted({*own, *other.get(block, ())})
                for i in range(0, len(found), 50_000):
                    part = found[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block, np.int64)), pa.array(part, pa.binary()), pa.array([own[w] for w in part], pa.int64())], names=["block", "word", "n"])
            learned.clear()
            other.clear()
            size = 0

        for batch in batches:
            for block, held, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), blobs(batch.column(2)), strict=True):
                words = tokens(blob)
                words.append(END)
                if held:
                    other.setdefault(block, set()).update(words)
                else:
                    learned.setdefault(block, Counter()).update(words)
                size += len(blob or b"")
                if size > 2 * BLOCK:
                    yield from flush()
        yield from flush()

    return docs.select("block", "held", "text").mapInArrow(count, "block bigint, word binary, n bigint")


def piece_weights(words: DataFrame, path: str) -> np.ndarray:
    """The pieces' weights after one expectation step over distinct words."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(path, None)
        total = [0.0] * (len(own.pieces) + 1)
        for batch in batches:
            for word in batch.column(0).to_pylist():
                if word != END:
                    own.expected(word, total)
        full = np.array(total)
        at = np.flatnonzero(full)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(full[at])], names=["piece", "n"])

    prior = vocabulary(path)[1]
    out = np.zeros(len(prior))
    for r in words.mapInArrow(step, "piece bigint, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():  # a row for each piece
        out[r["piece"]] = r["n"]
    return out + prior * PRIOR


def score_documents(docs: DataFrame, vocabulary_path: str, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    each row, learning from those where `held_out` is false."""
    sizes = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("bytes")).first()
    # neighbouring ids often stand in one file, so runs of ids make a block: as many as have about BLOCK bytes
    shift = max(0, int(math.log2(max(1.0, BLOCK * sizes["n"] / max(1, sizes["bytes"] or 0)))))
    blocks = max(1, -(-sizes["n"] >> shift))
    own = docs.select(F.col(doc_id).alias("id"), held_out.alias("held"), F.col(text).alias("text"))
    run = F.coalesce(F.shiftright(F.col("id").try_cast("bigint"), shift), F.xxhash64("id", "text"))
    own = own.withColumn("block", F.pmod(run, F.lit(blocks)))

    by_word = Window.partitionBy("word")
    counted = (block_words(own).withColumn("c", F.sum("n").over(by_word))
               .withColumn("first", F.row_number().over(by_word.orderBy("block")) == 1))
    counted = kept(counted.select("block", "word", "n", "c", "first"), "block-words")
    known = counted.where("first and c > 0")
    facts = known.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.count(F.when(F.col("c") == 1, 1)).alias("n1"), F.count(F.when(F.col("c") == 2, 1)).alias("n2")).first()
    total, types = facts["n"] or 0, facts["v"]
    discount = min(0.95, max(0.05, facts["n1"] / (facts["n1"] + 2 * facts["n2"]) if facts["n1"] else 0.05))
    weights = piece_weights(known.select("word"), vocabulary_path).tobytes()
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    freed = discount * types / total if total else 1.0

    def chances(words: pa.Array, counts: pa.Array) -> pa.Array:
        model, out = lattice(vocabulary_path, shared.value), []
        coded = words.dictionary_encode()  # a word's rows stand together
        at = coded.indices.to_numpy()
        first = np.empty(len(coded.dictionary), np.int64)
        first[at[::-1]] = np.arange(len(at))[::-1]
        for word, c in zip(coded.dictionary.to_pylist(), counts.to_numpy()[first].tolist(), strict=True):
            if word == END:
                out.append(math.log10((c - discount) / total) if c > discount else 0.0 if not total else math.log10(0.5 / total))
                continue
            spelled = model.log_probability(word)
            if c > discount:
                out.append(math.log10((c - discount) / total + freed * math.exp(max(spelled, -700))))
            else:
                out.append(spelled / math.log(10) + math.log10(freed))
        return pa.array(np.array(out)[at], pa.float64())

    table = counted.select("block", "word", "c", F.arrow_udf(chances, "double")("word", "c").alias("log10"))

    def score(_: tuple, texts: pa.Table, words: pa.Table) -> pa.Table:
        places = {w: i for i, w in enumerate(words.column("word").to_pylist())}  # a word that comes twice has one count
        counts = words.column("c").to_numpy().astype(np.float64)
        logs = words.column("log10").to_numpy()
        bases = np.log10((counts + 0.5) / (total + 0.5 * (types + 1)))
        out: list[list] = [[], [], [], []]
        for blob in (x for chunk in texts.column("text").chunks for x in blobs(chunk)):
            found = tokens(blob)
            found.append(END)
            at = np.fromiter(map(places.__getitem__, found), np.int64, len(found))
            for to, value in zip(out, (len(found), int((counts[at] > 0).sum()), float(bases[at].sum()), float(logs[at].sum())), strict=True):
                to.append(value)
        names = ["id", "held", "n_tokens", "n_known", "base_score", "score"]
        return pa.Table.from_arrays([texts.column("id").combine_chunks(), texts.column("held").combine_chunks(), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64()), pa.array(out[3], pa.float64())], names=names)

    kind = dict(own.dtypes)["id"]
    scored = own.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(score, f"id {kind}, held boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return scored.select("id", F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")
