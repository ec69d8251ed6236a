"""Mixing to target weights, ranked search and vector codes against brute force."""

import hashlib
import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import small  # noqa: E402

from cohortlens.llm import budget_mix, dual_tree, norm_codes  # noqa: E402

ROWS = small.corpus(seed=5, n=60)


# ---- mixing -------------------------------------------------------------


def water_levels(sizes, share=1.5, most=2.0):
    """Targets by handing the excess round after round to those below their limit."""
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda x: (x is None, x)))}
    target = dict.fromkeys(sizes, 0.0)
    open_, left = set(sizes), share * sum(sizes.values())
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        given = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s, more in given.items():
            target[s] += more
            if target[s] > most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
        open_ = {s for s in open_ if target[s] < most * sizes[s] - 1e-9}
    return target


def mixed(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size string, words int, number int, __hash int")
    return [r.asDict() for r in budget_mix.mix(df).collect()]


def test_mix_targets_and_fit(spark):
    r = random.Random(3)
    rows = [(d, t, r.choice(["a", "b", "B", "é", "z", None, "empty"]), "x", 1, 2, 3) for d, t, _ in ROWS]
    rows = [(d, None if s == "empty" else t, s, *x) for d, t, s, *x in rows]
    rows += [(None, "one two three", "a", "x", 1, 2, 3)] * 3 + [(7000 + i, "w " * 11, "hot", "x", 1, 2, 3) for i in range(400)]
    out = mixed(spark, rows)
    assert len(out) == len(rows)
    sizes = {s: sum(len(small.tokens(t)) for _, t, q, *_ in rows if q == s) for s in {x[2] for x in rows}}
    want = water_levels(sizes)
    for s in sizes:
        mine = [x for x in out if x["source"] == s]
        assert {x["source_size"] for x in mine} == {sizes[s]}
        assert all(abs(x["target"] - want[s]) < 1e-6 * max(1, want[s]) for x in mine)
        assert all(x["taken"] in (x["size"] * x["times"], 0) and x["taken"] <= 2 * x["size"] for x in mine)
        whole = int(want[s] / sizes[s] + 1e-9) if sizes[s] else 0
        reached = 1  # the sums of subsets, as bits
        for x in mine:
            reached |= reached << x["size"]
        near = min(abs(i + whole * sizes[s] - want[s]) for i, bit in enumerate(bin(reached)[:1:-1]) if bit == "1")
        assert abs(sum(x["taken"] for x in mine) - want[s]) <= near + 1, s  # targets are rounded to words
    by_id = {x[0]: x for x in rows}
    assert all(x["size"] == len(small.tokens(by_id[x["doc_id"]][1])) and x["words"] == 1 for x in out)
    key = lambda x: tuple(map(str, x.values()))
    assert sorted(map(key, out)) == sorted(map(key, mixed(spark, rows[::-1])))


def test_mix_empty(spark):
    assert mixed(spark, []) == []
    assert [x["taken"] for x in mixed(spark, [(1, None, None, "x", 1, 2, 3), (2, "", "a", "x", 1, 2, 3)])] == [0, 0]


def test_fit_is_as_near_as_any_subset():
    r = random.Random(1)
    for _ in range(400):
        lengths = np.array(sorted(r.sample(range(1, 60), r.randint(1, 8))))
        counts = np.array([r.randint(1, 3) for _ in lengths])
        budget = r.uniform(0, int((lengths * counts).sum()))
        got = budget_mix.fitted(lengths, counts, budget)
        assert (got >= 0).all() and (got <= counts).all()
        sums = {0}
        for a, c in zip(lengths.tolist(), counts.tolist(), strict=True):
            sums = {x + a * i for x in sums for i in range(c + 1)}
        goal = math.floor(budget + 0.5)
        assert abs(int((got * lengths).sum()) - goal) == min(abs(x - goal) for x in sums)


def test_fit_with_lengths_beyond_the_window():
    lengths, counts = np.array([10**6, 3 * 10**6 + 1, 5 * 10**6]), np.array([3, 3, 3])
    got = budget_mix.fitted(lengths, counts, 8.2e6, window=1000)
    assert (got <= counts).all() and abs(int((got * lengths).sum()) - 8.2e6) <= 10**6


# ---- ranked search ------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, k=20):
    """[(item row, rank, doc_id, score)]"""
    found = [(d, Counter(TERM.findall(small.ascii_lower(t or "")))) for d, t in docs]
    found = [(d, c, sum(c.values())) for d, c in found if c]
    n_docs, words = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for row, (item, text) in enumerate(items):
        scores = []
        for d, c, n in found:
            m = 100 - 25 + 25 * n * n_docs // words
            score = sum(reps * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, reps in Counter(TERM.findall(small.ascii_lower(text or ""))).items() if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(row, item, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return out


def searched(spark, docs, items, parts=3, **more):
    table = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id bigint, text string, item int, score string").repartition(parts)
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id string, text string, rank int")
    return [tuple(r) for r in dual_tree.best_documents(table, asked, **more).collect()]


@pytest.mark.parametrize("k", [1, 20])
def test_search_against_brute_force(spark, k):
    docs = [(d, t) for d, t, _ in ROWS] + [(None, ROWS[4][1]), (None, ROWS[4][1]), (31, ROWS[31][1])]
    items = [("a", ROWS[4][1][:200]), ("b", "the house the GARDEN, of the red-water 12"), ("c", None), (None, "maison rouge été"), ("d", "nothing-like-this qqq"), ("e", ""), ("f", ROWS[13][1]), ("a", "door the tree")]
    items += [(f"g{i}", " ".join(random.Random(i).sample(small.EN + small.FR, 4))) for i in range(30)]
    key = lambda x: (str(x[0]), x[1], x[3], str(x[2]))
    want = [x[1:] for x in brute_search(docs, items, k)]
    assert sorted(searched(spark, docs, items, k=k), key=key) == sorted(want, key=key)


def test_search_in_rounds_and_empty(spark, monkeypatch):
    docs, items = [(d, t) for d, t, _ in ROWS], [(str(i), t[:80]) for i, t, _ in ROWS if t]
    want = sorted(searched(spark, docs, items), key=str)
    monkeypatch.setattr(dual_tree, "ROUND_BYTES", 1500)
    assert sorted(searched(spark, docs, items), key=str) == want
    assert searched(spark, [], items[:2]) == searched(spark, docs, []) == searched(spark, [(1, None), (2, "--")], items[:2]) == []


def test_search_prunes_batches():
    """Where few documents match an item well, most pairs are never scored."""
    r = np.random.default_rng(2)
    docs = [np.unique(r.integers(0, 2000, 30)) for _ in range(4000)]
    items = [d[:12] for d in docs[:64]]
    sparse = lambda rows: dual_tree.Sparse(np.array([len(x) for x in rows]), np.concatenate(rows).astype(np.int64), np.full(sum(map(len, rows)), 1000))
    search = dual_tree.Search(sparse(items), np.ones(2000), 2, np.ones(64, np.int64))
    search.block(sparse(docs), np.arange(4000), np.ones(2000))
    place = np.empty(64, np.int64)
    place[search.tree.order] = np.arange(64)
    dense = np.zeros((4000, 2000), np.int64)
    for i, d in enumerate(docs):
        dense[i, d] = 1000
    for i, d in enumerate(items):
        scores = dense[:, d].sum(1) * 1000
        want = sorted((-s, j) for j, s in enumerate(scores.tolist()) if s)[:2]
        assert [(-s, j) for s, j in zip(search.scores[place[i]].tolist(), search.docs[place[i]].tolist(), strict=True)] == want
    assert search.scored < 0.8 * 64 * 4000


# ---- vector codes -------------------------------------------------------


def plain_codes(rows, parts=16, entries=64, rounds=2):
    good = [(i, np.array([math.floor(256 * x) for x in v], np.int64)) for i, v, *_ in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1].tolist()))
    if not good:
        return [], np.zeros((parts, 0, 0), np.int64)
    x = np.stack([v for _, v in good]).reshape(len(good), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    for at in range(rounds + 1):
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(-1)
        code = d.argmin(-1)
        if at < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    if (mine := x[code[:, p] == e, p]).size:
                        books[p, e] = mine.sum(0) // len(mine)
    return [(i, c.tolist(), int(e)) for (i, _), c, e in zip(good, code, d.min(-1).sum(1), strict=True)], books


VECTORS = "vec_id bigint, embedding array<float>, label string, code int, `__v` int"


@pytest.mark.parametrize(("n", "rounds"), [(0, 2), (1, 2), (40, 2), (900, 2), (900, 5)])
def test_codes_against_plain_scan(spark, n, rounds):
    r = random.Random(n)
    rows = [(i if i % 9 else 3, [r.gauss(0, 0.2) + (i % 3) for _ in range(32)] if i % 5 else [0.25] * 32, "abc"[i % 3] if i % 7 else None, 1, 2) for i in range(n)]
    if n:
        rows += [(None, [0.5] * 32, "a", 1, 2), (901, None, "a", 1, 2), (902, [None] * 32, "a", 1, 2), (903, [float("nan")] * 32, "b", 1, 2), (904, [float("-inf")] * 32, "b", 1, 2), (905, [], "b", 1, 2)]
    out, books = norm_codes.compress(spark.createDataFrame(rows, VECTORS).repartition(3), rounds=rounds)
    want, plain = plain_codes(rows, rounds=rounds)
    got = [(x["vec_id"], x["code"], x["error"]) for x in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert books.tolist() == plain.tolist()
    assert norm_codes.digest(books) == hashlib.sha256(",".join(str(v) for v in plain.ravel().tolist()).encode()).hexdigest()


def test_bounds_spare_scans():
    """Parts whose bounds hold are not measured against all entries again."""
    r = np.random.default_rng(1)
    centres = r.integers(-1000, 1000, (8, 4))
    x = np.concatenate([c + r.integers(-20, 20, (300, 4)) for c in centres])
    history = centres[None, None]
    first = norm_codes.Assigner(history)
    code, low, stamp = np.zeros(len(x), np.int64), np.zeros(len(x), np.float32), np.zeros(len(x), np.int64)
    first.part(0, x, code, low, stamp)
    # two moves there and back: the net displacement is small, the sum of the moves is not
    history = np.concatenate([history, history + 300, history + 3])
    again = norm_codes.Assigner(history)
    own = again.part(0, x, code, low, stamp)
    plain = ((x[:, None] - history[-1][0][None]) ** 2).sum(-1)
    assert (own == plain.min(1)).all() and (code == plain.argmin(1)).all()
    assert first.scanned == len(x) and again.scanned < len(x) // 10


def test_codes_refuse_what_cannot_be_cut(spark):
    with pytest.raises(ValueError, match="equal parts"):
        norm_codes.compress(spark.createDataFrame([(1, [1.0] * 16, "a", 1, 2), (2, [1.0] * 32, "a", 1, 2)], VECTORS))
    with pytest.raises(ValueError, match="too large"):
        norm_codes.compress(spark.createDataFrame([(1, [1e30] * 16, "a", 1, 2)], VECTORS))


@pytest.mark.parametrize("sent", [0, 100])
def test_sums_by_label(spark, monkeypatch, sent):
    monkeypatch.setattr(norm_codes, "SENT_LABELS", sent)
    rows = [(i, None if i % 3 == 0 else f"l{i % 5}", i) for i in range(60)]
    out = norm_codes.summed_by(spark.createDataFrame(rows, "id int, label string, error bigint"), "label", "error", "total").collect()
    assert sorted((r["id"], r["total"]) for r in out) == [(i, sum(e for _, k, e in rows if k == la)) for i, la, _ in rows]


def test_decoding(spark):
    rows = [(i, [((i * 7 + j) % 13) / 4 - 1 for j in range(32)], "a", 1, 2) for i in range(50)]
    out, books = norm_codes.compress(spark.createDataFrame(rows, VECTORS), entries=8, rounds=1)
    for r in norm_codes.decoded(out, books).withColumn("vector", F.lit(1)).collect():
        x = np.array([math.floor(256 * v) for v in rows[r["vec_id"]][1]])
        assert round(((x - np.array(r["approximation"]) * 256) ** 2).sum()) == r["error"]
