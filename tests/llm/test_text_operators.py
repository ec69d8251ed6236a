"""The document operators against brute force on small tables with nulls,
empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import small  # noqa: E402

from cohortlens.llm import cross_parse, lattice_lm, line_bloom, packing, prefix_free, simhash_bk, winnowing  # noqa: E402
from cohortlens.llm.common import remainder_is_one  # noqa: E402

ROWS = small.corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return small.frame(spark, ROWS).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return small.frame(spark, [])


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def word_bpe():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# line dedup


def test_line_dedup_against_brute_force(docs):
    out = line_bloom.dedup_lines(docs, n_lines="lines_before", n_dropped="lines_gone")
    assert out.columns[: len(docs.columns)] == docs.columns
    got = {r["doc_id"]: (r["lines_before"], r["lines_gone"], r["kept_text"]) for r in out.collect()}
    assert got == {d: rest for d, *rest in map(lambda x: (x[0], *[tuple(x[1:])]), small.line_dedup(ROWS)) for rest in rest}
    assert sum(x[1] for x in got.values()) > 10


def test_line_dedup_repeated_and_null_ids(spark):
    line = "a line of more than twenty characters"
    rows = [(1, line, None), (1, line, None), (None, line, None), (2, line.upper() + "\nx", None)]
    got = sorted((r["doc_id"] or 0, r["kept_text"]) for r in line_bloom.dedup_lines(small.frame(spark, rows)).collect())
    assert got == [(0, ""), (1, ""), (1, ""), (2, line.upper() + "\nx")]
    two = small.frame(spark, rows[:2] + rows[3:])  # two documents only: an id counts once
    assert sum(r["n_dropped"] for r in line_bloom.dedup_lines(two).collect()) == 0


def test_full_filter_loses_nothing(docs, monkeypatch):
    monkeypatch.setattr(line_bloom, "filter_bits", lambda *_: 64)
    got = {r["doc_id"]: r["kept_text"] for r in line_bloom.dedup_lines(docs).collect()}
    assert got == {d: t for d, _, _, t in small.line_dedup(ROWS)}


# repeated substrings


def test_repeated_substrings_against_brute_force(docs):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in prefix_free.remove_repeats(docs).collect()}
    assert got == small.repeated_bytes(ROWS)
    assert got[100][1] and got[114][1] == 699


@pytest.mark.parametrize("span", [80, 100, 130])
def test_repeated_substrings_low_entropy(spark, span):
    import random

    r = random.Random(span)
    rows = [(i, "".join(r.choice("ab") if i % 3 else "ab"[k // 7 % 2] for k in range(r.randint(0, 900))), None) for i in range(25)]
    rows += [(50 + i, rows[i][1][5:700] + "|" + rows[i + 1][1], None) for i in range(10)]
    got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], hashlib.sha256(x["kept"]).hexdigest()) for x in prefix_free.remove_repeats(small.frame(spark, rows), span=span).collect()}
    assert got == small.repeated_bytes(rows, span)


def test_repeated_substrings_parts_and_ids(spark, monkeypatch):
    rows = [(None, "q" * 50 + "z" * 120, None), (1, "z" * 130, None), (1, "z" * 130, None), (2, "z" * 100, None)]
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in prefix_free.remove_repeats(small.frame(spark, rows)).collect())
    assert got == [(0, 119), (1, 130), (1, 130), (2, 100)]


def test_parsing_in_parts_is_the_same(spark, docs, monkeypatch):
    whole = {r["doc_id"]: r["n_removed"] for r in prefix_free.remove_repeats(docs).collect()}
    run = prefix_free.phrases

    def small_parts(held, span):
        code = run.__code__
        parts = type(run)(code, {**prefix_free.__dict__, "PART": 300}, run.__name__)
        return parts(held, span)

    monkeypatch.setattr(prefix_free, "phrases", small_parts)
    assert {r["doc_id"]: r["n_removed"] for r in prefix_free.remove_repeats(docs).collect()} == whole


# decontamination

ITEMS = [(1, " ".join(ROWS[1][1].split()[3:18])), (2, "One, two THREE!"), (3, None), (4, ""), (5, "house"), (6, " ".join(ROWS[4][1].split()[:10])), (6, "another row of item six"), (7, " ".join(ROWS[1][1].split()[3:18])), (None, "日本語"), (8, "never " * 12)]


def test_decontamination_against_brute_force(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    out = winnowing.decontaminate(docs, items)
    got = {r["doc_id"]: r for r in out.withColumn("ids", F.sha2(F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ","), 256)).collect()}
    for d, n, hit, count, digest, bad in small.decontaminated(ROWS, ITEMS):
        r = got[d]
        assert (hit, count, digest, bad) == (r["n_hit"], len(r["item_ids"]), r["ids"], r["n_hit"] > 0), d
        assert sum(s["to"] - s["from"] for s in r["hit_spans"]) == hit


def test_decontamination_winnows_every_long_share(spark):
    import random

    r = random.Random(5)
    items = [(i, " ".join(r.choice("abc") for _ in range(r.randint(1, 30)))) for i in range(40)]
    rows = [(i, " ".join(r.choice("abc") for _ in range(r.randint(0, 60))), None) for i in range(40)]
    out = winnowing.decontaminate(small.frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    got = {x["doc_id"]: (x["n_hit"], len(x["item_ids"])) for x in out.collect()}
    assert got == {d: (h, c) for d, _, h, c, _, _ in small.decontaminated(rows, items)}


# SimHash


def test_simhash_against_brute_force(docs):
    prints = [small.simhash(t) for _, t, _ in ROWS]
    group = small.linked(prints)
    got = {r["doc_id"]: (r["simhash"] % 2**64, r["component_id"]) for r in simhash_bk.near_duplicates(docs).collect()}
    assert got == {d: (p, ROWS[g][0]) for (d, _, _), p, g in zip(ROWS, prints, group, strict=True)}


def test_bk_trees_find_every_link():
    import numpy as np

    r = np.random.default_rng(3)
    centres = r.integers(0, 1 << 63, 20, dtype=np.uint64)
    values = [int(c) ^ sum(1 << int(b) for b in r.choice(64, r.integers(0, 7), replace=False)) for c in centres for _ in range(30)]
    values = np.unique(np.array(values, np.uint64))
    found = {(int(a), int(b)) for x, y in simhash_bk.near_pairs(values, np.zeros(len(values), int), 4) for a, b in zip(x, y, strict=True)}
    assert found == {(i, j) for i in range(len(values)) for j in range(i) if (int(values[i]) ^ int(values[j])).bit_count() <= 4}
    for n in (10, 10**6, 10**9):  # any four bits leave one choice of blocks whole
        masks = simhash_bk.shard_choices(n, 4)
        for _ in range(200):
            off = sum(1 << int(b) for b in r.choice(64, 4, replace=False))
            assert any(not off & m for m in masks)


def test_chain_of_fingerprints_is_one_component(spark):
    values, v = [0], 0
    for i in range(40):
        v ^= 0b111 << i
        values.append(v)
    df = spark.createDataFrame([(x,) for x in set(values)], "f bigint")
    roots = simhash_bk.components(simhash_bk.links(df, 4, len(values)))
    assert {r["root"] for r in roots.collect()} == {min(values)} and roots.count() == len(set(values)) - 1


def test_one_of_each_with_repeated_ids(spark):
    rows = [(1, "a b c d e", None), (1, "a b c d e", None), (2, "a b c d e", None), (None, "other words here now then", None), (None, "other words here now then", None)]
    out = simhash_bk.one_of_each(small.frame(spark, rows))
    assert out.columns == [c.split()[0] for c in small.DOCS.split(", ")]
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 1]


# packing


def test_packing_pieces_and_places(spark, docs):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    model, size = Tokenizer.from_file(word_bpe()), 64
    out = packing.pack_documents(docs, word_bpe(), size=size)
    got = {(r["doc_id"], r["piece"]): r for r in out.collect()}
    want = {}
    for d, t, _ in ROWS:
        ids = [*model.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), size):
            want[d, k // size] = (k, len(ids[k : k + size]), zlib.crc32(np.array(ids[k : k + size], "<u4").tobytes()))
    assert {k: (r["start"], r["length"], r["ids_crc32"]) for k, r in got.items()} == want
    by = {}
    for r in got.values():
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    total = sum(n for _, n, _ in want.values())
    assert len(by) <= 1.05 * total / size + 2
    first = packing.sequences(docs, out, word_bpe()).collect()
    assert sum(len(r["ids"]) for r in first) == total


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_length_once(seed):
    import random

    r = random.Random(seed)
    sizes = [[2048], [700, 1300], [1025, 1024, 1023], list(range(1, 2049)), [3, 2040, 683], [1100] * 1][seed]
    histogram = {s: r.randint(1, 500) for s in sizes}
    plan = packing.Plan(histogram)
    ranks, rooms = {s: 0 for s in histogram}, {}
    for length, rank, n, first, each, offset in sorted(plan.rows):
        assert rank == ranks[length] and n > 0
        ranks[length] += n
        for i in range(0, n, each):
            rooms.setdefault(first + i // each, []).extend((offset + k * length, length) for k in range(each))
    assert ranks == histogram
    for parts in rooms.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(rooms) == plan.sequences


# language ID


def test_language_by_fewest_phrases(docs):
    labelled = docs.where(~remainder_is_one("doc_id", 3))
    model = cross_parse.sample(labelled)
    assert [name for name, _ in model] == ["en", "fr"]
    got = {r["doc_id"]: r["x"] for r in docs.select("doc_id", cross_parse.identify(F.col("text"), model).alias("x")).collect()}
    right = [got[d]["lang"] == lang for d, t, lang in ROWS if d < 100 and len(t) > 50]
    assert sum(right) / len(right) > 0.95
    for d in (110, 111, 112, 113, 120):
        assert got[d]["lang"] == "und" and got[d]["score"] == 0
    assert all(0 <= x["score"] <= 1 for x in got.values())


def test_phrases_against_plain_parsing():
    model = (("a", b"the cat sat on the mat"), ("b", b"le chat est sur le tapis"))
    classes = cross_parse.automata(model)[0]
    texts = [b"the cat est sur zzz mat", b"q", b"", b"the cat sat on the mat", b"le le le chat"]
    found = cross_parse.phrases(texts, model)
    for i, (_, sample) in enumerate(model):
        for j, text in enumerate(texts):
            own, n, rest = sample.translate(classes), 0, text.translate(classes)
            while rest:
                k = 1
                while k < len(rest) and rest[: k + 1] in own:
                    k += 1
                rest, n = rest[k:], n + 1
            # a byte that is in no sample ends a phrase also before it
            assert abs(found[i, j] - n) <= sum(text.translate(classes).count(c) for c in set(text.translate(classes)) if bytes([c]) not in own)


def test_small_samples_win_no_foreign_text():
    english = b"the quick brown fox jumps over the lazy dog while the cat sat on the mat and looked at the birds " * 20
    text = b"the birds sat on the mat and the dog looked at the lazy cat while the fox jumps " * 12
    for small_text in (b"x", b"e", b"the", b"\xd0\xb6"):
        found, cost = cross_parse.parsed([text, small_text], (("en", english), ("xx", small_text)))
        assert cost[0, 0] < cost[1, 0]
        assert cost[1, 1] < cost[0, 1]
    # each byte outside both samples costs the same everywhere
    _, cost = cross_parse.parsed(["\u0e01".encode() * 50], (("en", english), ("xx", b"x")))
    assert cost[0, 0] == cost[1, 0] > 8 * 150
    # whole phrases and bytes outside, by hand: "th" "e" z "th" and the same over two pieces
    _, cost = cross_parse.parsed([b"thezth", b"zz", b""], (("a", b"th e"),))
    assert cost[0].tolist() == pytest.approx([3 * np.log2(6) + (np.log2(6) + 8), 2 * (np.log2(6) + 8), 0])


def test_each_byte_of_the_samples_is_told_apart():
    scripts = "".join(map(chr, [*range(97, 123), *range(0x3B1, 0x3C9), *range(0x430, 0x450), *range(0x5D0, 0x5EA), *range(0x4E00, 0x4E80), *range(0xAC00, 0xACF0)])).encode()
    model = (("a", scripts[: len(scripts) // 2]), ("b", scripts[len(scripts) // 2 :]))
    classes = cross_parse.byte_classes([x for _, x in model])
    assert len({classes[b] for b in scripts}) == len({*scripts}) > 64
    text = scripts[::-7]
    found = cross_parse.phrases([text], model)
    for i, (_, own) in enumerate(model):
        n = m = rest = 0
        while rest < len(text):
            k = 1
            while rest + k < len(text) and text[rest : rest + k + 1] in own:
                k += 1
            m += text[rest] not in own
            rest, n = rest + k, n + 1
        assert abs(found[i, 0] - n) <= m


def test_language_without_labels(nothing, docs):
    assert cross_parse.sample(nothing) == ()
    assert {r[0]["lang"] for r in docs.select(cross_parse.identify(F.col("text"), ())).collect()} == {"und"}


# language-model scores


def test_scores_against_brute_force(docs):
    got = {r["id"]: r for r in lattice_lm.score_documents(docs, vocabulary(), remainder_is_one("doc_id", 5)).collect()}
    for d, out, n, known, total, base in small.base_scores(ROWS):
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out, n, known, total)
        assert r["base_score"] == pytest.approx(base)
        assert r["score"] < 0


def test_lattice_sums_all_segmentations():
    import math

    own = lattice_lm.lattice(vocabulary(), None)
    place = {p: i for i, p in enumerate(own.pieces)}

    def all_ways(rest):
        return 1.0 if not rest else sum(own.chance[place[rest[:k]]] * all_ways(rest[k:]) for k in range(1, len(rest) + 1) if rest[:k] in place)

    for word in ("the", "house", "zürich", "日本"):
        data = word.encode()
        want = math.log(all_ways(" " + data.decode("latin-1"))) + own.logs[own.stop]
        assert own.log_probability(data) == pytest.approx(want)
        assert own.log_space(data) + own.logs[own.stop] == pytest.approx(want)
    long = ("qzx" * 2000).encode()
    assert own.log_probability(long) == pytest.approx(own.log_space(long) + own.logs[own.stop], rel=1e-9)


def test_long_words_add_their_expected_pieces():
    own = lattice_lm.lattice(vocabulary(), None)
    for word in ("the", "zürich", "日本"):
        plain, logs = ([0.0] * (own.stop + 1) for _ in range(2))
        own.expected(word.encode(), plain)
        own.expected_long(word.encode(), logs)
        assert logs == pytest.approx(plain)
    for word in ("日本語の文章には空白がない。" * 8, "q\u2603z" * 40, "http://a.example/" + "x9q" * 2000):
        found = [0.0] * (own.stop + 1)
        own.expected(word.encode(), found)
        assert found[own.stop] == 1  # one end, and pieces that cover the word and its begin
        assert sum(n * len(p) for n, p in zip(found, own.pieces)) == pytest.approx(len(word.encode()) + 1)
        assert sum(n for n, p in zip(found, own.pieces) if p[0] == " ") == pytest.approx(1)


def test_word_probabilities_stay_below_one(spark):
    rows = [(i, "a b c a", None) for i in range(30)]
    got = lattice_lm.score_documents(small.frame(spark, rows), vocabulary(), remainder_is_one("doc_id", 5)).collect()
    assert len(got) == 30 and all(r["score"] < 0 for r in got)


# empty tables


def test_empty_tables(nothing, spark):
    assert line_bloom.dedup_lines(nothing).count() == 0
    assert prefix_free.remove_repeats(nothing).count() == 0
    assert simhash_bk.near_duplicates(nothing).count() == 0
    assert simhash_bk.one_of_each(nothing).count() == 0
    assert packing.pack_documents(nothing, word_bpe()).count() == 0
    assert winnowing.decontaminate(nothing, spark.createDataFrame([], "item_id bigint, text string")).count() == 0
    assert lattice_lm.score_documents(nothing, vocabulary(), remainder_is_one("doc_id", 5)).count() == 0


def test_no_benchmark(spark, docs):
    out = winnowing.decontaminate(docs, spark.createDataFrame([], "item_id bigint, text string"))
    assert out.count() == len(ROWS) and out.where("n_hit > 0").count() == 0


def test_languages_are_learned_from_repeated_and_null_ids(spark):
    from cohortlens.llm import cross_parse
    for same in [None, 1, 2, 3, 5, 8, 13]:
        rows = [(same, " ".join([bag[(i + j) % len(bag)] for j in range(8)]), lang) for i in range(500) for bag, lang in ((small.EN, "en"), (small.FR, "fr"))]
        got = dict(cross_parse.sample(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")))
        assert set(got) == {"en", "fr"} and all(got.values()), same
    labels = [(i, "some text", f"l{i % 9}" if i % 3 else "most") for i in range(90)]
    assert [x for x, _ in cross_parse.sample(spark.createDataFrame(labels, "doc_id int, text string, lang string"), labels=1)] == ["most"]


def test_token_ids_of_other_tokenizers_and_signs():
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer
    from cohortlens.llm import packing
    r = random.Random(4)
    signs = [chr(c) for c in [*range(0x260), 0x300, 0x301, 0x2014, 0x2019, 0x4E2D, 0x1F600, 0x3000, 0x2028, 0x1E9E, 0x212A, 0x3A3]]
    texts = ["<|endoftext|> it's", "DON'T 'S 12²½", "", "a" * 3000] + ["".join(r.choice(signs if r.random() < 0.4 else list("abcXYZ '12 \n\t.,-_<|>")) for _ in range(20)) for _ in range(2000)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        model = Tokenizer.from_file(path)
        got = packing.token_ids([t.encode() for t in texts], path)
        assert got == [np.array([*model.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes() for t in texts]


def test_lattice_adds_plain_numbers():
    """Numpy scalars in the automaton made each step of the sums cost twice."""
    own = lattice_lm.lattice(vocabulary(), None)
    assert {type(x) for _, (_, _, x) in own.automaton.items()} == {float}
    for size in (0, 1, 253, 254, 255, 256, 600):  # with and without the rescaling
        word = b"ab" * (size // 2) + b"c" * (size % 2)
        assert own.log_probability(word) == pytest.approx(own.log_space(word) + own.logs[own.stop], rel=1e-9)
