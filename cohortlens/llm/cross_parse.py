"""Language identification by cross-parsing entropy.

From a bounded sample of labelled text of each language a suffix automaton is
built. A text is parsed with each automaton into the longest phrases that
occur in the sample; a phrase costs log2(sample length) bits, a byte that the
sample never holds costs `LITERAL` bits more than a phrase of the longest
sample, so that a small sample has no advantage, and the language whose phrases
cost the fewest bits wins. All texts of a batch step through the
automata together, one byte a step, as table lookups.

Bounds (parameters): `labels` languages, `rows` labelled rows of each, `clip`
code points of each row, `size` bytes of normalised sample in all for each language. Only the
sample is bounded; every text is parsed whole, in pieces of `PIECE` bytes at
which the parse starts anew.

A null text, a text without letters, or no learned language gives `und` and
score 0. Equal costs go to the smaller language name.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import held, slices

UNKNOWN = "und"
PIECE = 1024
LETTERS = re.compile(r"[^\W\d_]+")
LITERAL = 8.0


def normalised(text: bytes) -> bytes:
    """The runs of letters in lower case, joined by spaces."""
    return " ".join(LETTERS.findall(text.decode("utf-8", "replace").lower())).encode()


def sample(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = 64, clip: int = 4000, size: int = 32768, labels: int = 256) -> tuple[tuple[str, bytes], ...]:
    """(language, sample text) for each language of the labelled rows: the
    first ones by the hash of id and text, then by text (so rows that repeat
    an id are told apart; equal rows are one text). Of more than `labels`
    languages the commonest are learned."""
    good = labelled.select(F.xxhash64(doc_id, text).alias("h"), F.col(text).alias("t"), F.col(lang).alias("l")).where(F.col("t").rlike(r"\p{L}") & F.col("l").isNotNull())
    known = [r["l"] for r in good.groupBy("l").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(labels).collect()]
    first = Window.partitionBy("l").orderBy("h", "t")  # each partition passes on `rows` rows of a language at most
    clipped = good.where(F.col("l").isin(known)).select("l", "h", F.substring("t", 1, clip).alias("t"))
    chosen = clipped.withColumn("r", F.row_number().over(first)).where(F.col("r") <= rows)
    parts: dict[str, list[bytes]] = {}
    for row in chosen.orderBy("l", "r").collect():  # rows x clip code points for each of `labels` languages
        parts.setdefault(row["l"], []).append(normalised(row["t"].encode()))
    return tuple((name, b" ".join(x for x in dict.fromkeys(found) if x)[:size]) for name, found in sorted(parts.items()))


def byte_classes(texts: list[bytes]) -> bytes:
    """A table from bytes to fewer classes: each byte of the samples has its
    own (UTF-8 has fewer than 255), the last one is for all others."""
    own = sorted({*b"".join(texts)})
    table = bytearray([len(own)]) * 256
    for i, b in enumerate(own):
        table[b] = i
    return bytes(table)


def suffix_automaton(data: bytes, width: int) -> np.ndarray:
    """next[state, column], -1 where no transition; state 0 is the start. It
    reads just the substrings of `data`."""
    link, length, moves = [-1], [0], [{}]
    last = 0
    for c in data:
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        moves.append({})
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                moves.append(dict(moves[q]))
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    table = np.full((len(moves), width), -1, np.int32)
    for state, m in enumerate(moves):
        for c, to in m.items():
            table[state, c] = to
    return table


def automata(model: tuple[tuple[str, bytes], ...]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a model, kept in each Python worker."""
    return held(("automata", model), lambda: build(model))


def build(model: tuple[tuple[str, bytes], ...]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(byte classes, steps, first states, bits a phrase, columns, seen).
    steps[state + columns[language, class]] holds the next state times two, plus
    one if a phrase ended before this byte and the next began with it; each
    language has columns for the bytes of its sample and one for all others.
    seen[language, class] tells whether the sample holds the byte."""
    classes = byte_classes([text for _, text in model])
    tables, starts, base = [], [], 0
    # an automaton has at most two states a byte; steps are made in place, so that building takes little more than they do
    kind = np.int32 if sum(2 * len(text) + 2 for _, text in model) * (max(classes) + 2) < 2**30 else np.int64
    columns = np.zeros((len(model), max(classes) + 1), np.int32)
    seen = np.zeros(columns.shape, bool)
    for lang, (_, text) in enumerate(model):
        data = text.translate(classes)
        own = sorted({*data})
        width = len(own) + 1
        columns[lang] = len(own)
        columns[lang, own] = np.arange(len(own))
        seen[lang, own] = True
        moves = suffix_automaton(bytes(columns[lang].astype(np.uint8)[np.frombuffer(data, np.uint8)]), width).astype(kind, copy=False)
        none = moves < 0
        moves *= width
        moves += base
        moves *= 2
        fresh = np.where(none[0], base * 2, moves[0]) + 1
        np.copyto(moves, fresh[None, :].astype(kind), where=none)
        tables.append(moves.ravel())
        starts.append(base)
        base += moves.size
    bits = np.array([np.log2(len(text) + 2) for _, text in model])
    return classes, np.concatenate(tables), np.array(starts, kind), bits, columns, seen


def parsed(texts: list[bytes], model: tuple[tuple[str, bytes], ...]) -> tuple[np.ndarray, np.ndarray]:
    """(phrases, bits) of each normalised text with each language's automaton.
    Runs of bytes without those outside the sample are parsed into the phrases
    that are charged; the count also has each byte outside as one."""
    classes, steps, starts, bits, columns, seen = automata(model)
    owner, where, sizes, at = [], [], [], 0
    for i, text in enumerate(texts):
        for k in range(0, len(text), PIECE):
            owner.append(i)
            where.append(at + k)
            sizes.append(min(PIECE, len(text) - k))
        at += len(text)
    out = np.zeros((len(model), len(texts)), np.int64)
    cost = np.zeros(out.shape)
    if not owner:
        return out, cost
    data = np.frombuffer(b"".join(texts).translate(classes), np.uint8)
    begins = np.zeros(len(data), bool)
    begins[where] = True
    holder = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    pieces = np.bincount(owner, minlength=len(texts))
    sizes = np.array(sizes)
    order = np.argsort(-sizes, kind="stable")
    sizes, where, owner = sizes[order], np.array(where)[order], np.array(owner)[order]
    state = np.repeat(starts[:, None], len(order), axis=1)
    ended = np.zeros(state.shape, np.int32)
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # pieces longer than k
    for k, n in enumerate(active.tolist()):
        step = steps.take(state[:, :n] + columns.take(data[where[:n] + k], axis=1))
        ended[:, :n] += step & 1
        state[:, :n] = step >> 1
    literal = bits.max() + LITERAL
    for lang in range(len(model)):
        out[lang] = np.bincount(owner, ended[lang] + 1, len(texts)).astype(np.int64)
        known = seen[lang][data]
        outside = np.bincount(holder[~known], minlength=len(texts))
        known[1:] &= begins[1:] | ~known[:-1]  # where a run of bytes of the sample begins
        runs = np.bincount(holder[known], minlength=len(texts))
        cost[lang] = (out[lang] - pieces - outside + runs) * bits[lang] + outside * literal
    return out, cost


def phrases(texts: list[bytes], model: tuple[tuple[str, bytes], ...]) -> np.ndarray:
    """Phrases of each normalised text with each language's automaton."""
    return parsed(texts, model)[0]


def identify(texts: Column, model: tuple[tuple[str, bytes], ...]) -> Column:
    """struct<lang, score, phrases> of each text; score is the winner's share
    of the probability 2**-bits over all learned languages, phrases the
    winner's number of phrases."""

    def predict(arr: pa.Array) -> pa.Array:
        langs, scores, counts = [], [], []
        for run in slices(arr, 1 << 21):
            plain = [normalised(x) for x in run]
            if not model:
                langs += [UNKNOWN] * len(run)
                scores += [0.0] * len(run)
                counts += [0] * len(run)
                continue
            found, cost = parsed(plain, model)
            best = cost.argmin(axis=0)
            share = 1 / np.exp2(np.maximum(cost.min(axis=0)[None, :] - cost, -1000)).sum(axis=0)
            for i, text in enumerate(plain):
                known = any(map(str.isalpha, text.decode()))  # other runs are of digit-like signs
                langs.append(model[best[i]][0] if known else UNKNOWN)
                scores.append(float(share[i]) if known else 0.0)
                counts.append(int(found[best[i], i]) if known else 0)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(counts, pa.int64())], names=["lang", "score", "phrases"])

    return F.arrow_udf(predict, "struct<lang: string, score: double, phrases: bigint>")(texts)
