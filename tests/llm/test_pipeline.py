"""The pipeline against brute force, stage by stage, on a small corpus."""

import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import small  # noqa: E402

import corpus_pipeline  # noqa: E402

ROWS = small.corpus(seed=11, n=48)
ITEMS = [(1, " ".join(ROWS[7][1].split()[5:25])), (2, "never seen words in any of these documents at all here"), (3, None)]


def by_brute_force(rows, items):
    """{stage: rows that it keeps}, the last one as (doc, piece, start, length, crc)."""
    out = {}
    rows = [r for r in rows if r[1] is not None and any(c.isalpha() for c in r[1])]
    out["language_id"] = rows
    rows = [(d, kept, lang) for (d, _, lang), (_, _, _, kept) in zip(rows, small.line_dedup(rows), strict=True)]
    out["line_dedup"] = rows
    rows = sorted(rows, key=lambda r: r[0])
    group = small.linked([small.simhash(t) for _, t, _ in rows])
    rows = [r for i, r in enumerate(rows) if group[i] == i]
    out["simhash_near_dedup"] = rows
    hit = {d for d, _, n, _, _, _ in small.decontaminated(rows, items) if n}
    rows = [r for r in rows if r[0] not in hit]
    out["benchmark_decontamination"] = rows
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = []
    for d, t, _ in rows:
        ids = [*model.encode(t, add_special_tokens=False).ids, 0]
        pieces += [(d, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes())) for k in range(0, len(ids), 2048)]
    out["best_fit_packing"] = pieces
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pipeline")
    small.frame(spark, ROWS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_and_run(spark, folder, tmp_path):
    want = by_brute_force(ROWS, ITEMS)
    assert [name for name, _ in corpus_pipeline.STAGES] == list(want)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == sorted((d, t) for d, t, _ in want[name]), name
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    assert len(want["benchmark_decontamination"]) < len(want["simhash_near_dedup"]) < len(want["line_dedup"]) < len(ROWS)
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want["best_fit_packing"])
    used = {}
    for r in got:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 2048


def test_stages_on_empty_and_null_rows(spark, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in ([], [(None, None, "en"), (None, "only words here", "en"), (None, "only words here", None), (1, "", "en")]):
        docs = small.frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == (1 if rows else 0)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
