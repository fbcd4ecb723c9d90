"""The pipeline's stages against plain versions of their decisions."""

from __future__ import annotations

import brute
import pyarrow.dataset as ds
from brute import SF

import corpus_pipeline


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    items = [(r["item_id"], r["text"]) for r in ds.dataset(f"{SF}/benchmark.parquet").to_table().to_pylist()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        kept[name] = before = {r.doc_id: r.text for r in docs.collect()}
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name != "encode":
            assert docs.columns == columns
        if name == "near_duplicates":
            assert set(after) == {c for _, c in brute.simhash_components(list(before.items())).values()}
        elif name == "benchmark_leaks":
            assert set(after) == {d for d, x in brute.leaks(list(before.items()), items).items() if not x[-1]}
        elif name == "secrets":
            assert set(after) == set(before)
            for d, text in before.items():
                found = brute.base_spans(text)
                assert ("[SECRET]" in after[d].text) == bool(found) and after[d].n_chars == len(after[d].text)
                assert all(text[a:b] not in after[d].text for k, a, b in found if k == "hex")
        elif name == "encode":
            assert set(after) == set(before) and all(r.round_trip for r in after.values())


def test_run_names_the_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "benchmark_leaks", "secrets", "encode"]
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "round_trip", "ids"] and out.count() > 0


def test_hard_documents_pass_through(spark, hard_docs):
    docs = hard_docs
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == hard_docs.columns and docs.count() > 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
