"""Every query of the subpackage on the given tables: against SQL, brute force or what it must reach."""

from __future__ import annotations

import html
import re

import brute
import numpy as np
import public_tokenizers
import pyarrow.dataset as ds
import pytest
import sentencepiece
from brute import SF
from comparison import connect, difference

import __spark_entry__ as entry
from tidegate.llm.oracles import llm_oracles
from tidegate.llm.queries import llm_queries


def rows(name: str) -> list[dict]:
    return ds.dataset(f"{SF}/{name}.parquet").to_table().to_pylist()


@pytest.fixture(scope="module")
def docs():
    return [(r["doc_id"], r["text"]) for r in rows("documents")]


def result(spark, name: str, *columns: str) -> dict:
    out = llm_queries()[name](spark, SF).collect()
    return {r[0]: tuple(r[c] for c in columns) for r in out}


def test_registered():
    assert set(llm_queries()) | {"pipeline"} <= set(entry.queries())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in llm_queries()} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_oracle(spark, name):
    assert difference(llm_queries()[name](spark, SF), llm_oracles()[name], connect(SF)) is None


def test_language_on_held_out_texts(spark):
    lang = {r["doc_id"]: r["lang"] for r in rows("documents")}
    got = result(spark, "op1_language", "held_out", "lang_pred", "score")
    assert set(got) == set(lang)
    held = [d for d, g in got.items() if g[0]]
    assert np.mean([got[d][1] == lang[d] for d in held]) >= 0.95
    assert all(0 <= g[2] <= 1 for g in got.values())


def test_secrets_base_spans(spark, docs):
    got = result(spark, "op2_secrets", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    for doc, text in docs:
        spans = brute.base_spans(text)
        counts = tuple(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex"))
        joined = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert got[doc][:4] == (*counts, brute.sha(",".join(joined)))
        assert set(joined) <= set(got[doc][4].split(",")) | {""}


def test_main_text_is_the_article(spark):
    got = result(spark, "op3_site_style", "text", "n_chars")
    for r in rows("pages"):
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.DOTALL)[1]
        parts = re.split(r"<(?:/?p|/?h1|br)>", article)
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in parts]
        want = " ".join(p for p in parts if p)
        assert got[r["page_id"]] == (want, len(want))


def test_duplicate_windows(spark, docs):
    got = result(spark, "op5_lempel_ziv", "n_words", "n_removed", "kept_sha256")
    assert got == brute.repeats(docs)


def test_neighbours_recall(spark):
    table = rows("embeddings")
    ids = np.array([r["vec_id"] for r in table])
    vectors = np.array([r["embedding"] for r in table], float)
    found: dict[int, list] = {}
    for r in llm_queries()["op6_hashing_index"](spark, SF).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    recall = []
    for q in ids[ids % 100 == 0]:
        apart = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1))
        apart[ids == q] = np.inf
        want = ids[np.lexsort((ids, apart))[:10]]
        assert [r for r, _, _ in found[q]] == list(range(1, 11))
        assert all(apart[ids == v][0] == s for _, v, s in found[q])
        recall.append(len(set(want) & {v for _, v, _ in found[q]}) / 10)
    assert np.mean(recall) >= 0.9


def test_quality_on_held_out_labels(spark):
    label = {r["doc_id"]: r["quality"] for r in rows("labels")}
    got = result(spark, "op7_quality_rules", "held_out", "score", "predicted")
    held = [d for d, g in got.items() if g[0] and d in label]
    assert np.mean([got[d][2] == label[d] for d in held]) >= 0.85
    assert all(0 <= s <= 1 and p == (s >= 0.7) for _, s, p in got.values())


def test_fingerprint_components(spark, docs):
    assert result(spark, "op8_simhash", "fingerprint", "component_id") == brute.simhash_components(docs)


def test_tokens(spark, docs):
    got = result(spark, "op9_sentencepiece", "n_tokens", "ids_sha256", "decoded_sha256")
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for doc, text in docs:
        ids = sp.encode(text or "", add_eos=True)
        assert got[doc] == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(sp.decode(ids)))


def test_leaks(spark, docs):
    items = [(r["item_id"], r["text"]) for r in rows("benchmark")]
    got = result(spark, "op10_decontaminate", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.leaks(docs, items)
