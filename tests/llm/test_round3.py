"""Alignment, Merkle manifest and token counts: hard texts, small trees of every shape, the cache over several runs."""

from __future__ import annotations

import random

import brute_round3 as plain
import pyarrow.dataset as ds
import pytest
import sentencepiece
from brute import SF, sha
from pyspark.sql import functions as F

from tidegate.llm import alignment, merkle, queries, token_counts

EXTRA = ["<|endoftext|> and <s> </s> <unk> <0x41>", "a▁b", "▁", " ", "  two  spaces ", "\n", "tab\tand\r\nline", "ﬁne ½ Ä", "日本語 text"]


@pytest.fixture(scope="module")
def documents():
    return ds.dataset(f"{SF}/documents.parquet").to_table().to_pylist()


def test_queries_equal_plain_versions(spark, documents):
    got = {r[0]: tuple(r)[1:] for r in queries.op11_alignment(spark, SF).collect()}
    assert got == plain.alignments([(r["doc_id"], r["text"]) for r in documents])
    rows = [tuple(r[c] for c in ("doc_id", "source", "lang", "n_chars", "text")) for r in documents]
    assert sorted(tuple(r) for r in queries.op12_merkle(spark, SF).collect()) == plain.merkle(rows)
    counts = {r[0]: tuple(r)[1:] for r in queries.op13_token_counts(spark, SF).collect()}
    assert [counts[r["doc_id"]] for r in documents] == plain.token_counts([r["text"] for r in documents])


class TestAlignment:
    def made(self, docs):
        found = alignment.align(docs, plain.A_FILE, plain.B_FILE)
        return found.withColumn("groups", F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise(""))

    def test_hard_texts(self, spark, hard_docs, hard_texts):
        more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(EXTRA)], "doc_id long, text string")
        rows = self.made(hard_docs.unionByName(more, allowMissingColumns=True)).collect()
        docs = [(i, t) for i, t in enumerate(hard_texts)] + [(100 + i, t) for i, t in enumerate(EXTRA)]
        want = plain.alignments([*docs, (-3, hard_texts[3]), (-1, "no id")])
        assert len(rows) == len(docs) + 2
        for r in rows:
            assert tuple(r)[1:] == want[-1 if r.row.doc_id is None else r.row.doc_id]

    def test_chunks_give_the_ids_of_the_whole_text(self, hard_texts, documents, monkeypatch):
        monkeypatch.setattr(alignment, "CHUNK_CHARS", 50_000)
        aligner = alignment.Aligner(*(alignment._read(f) for f in (plain.A_FILE, plain.B_FILE)))
        spaces = [f"{a}{s}{b}" for s in (" ", "  ", "\x1c ", " \u00a0", "\t ", " \n", "\u2003 ", "'s ", " '") for a in ("x", "1", "!", "\u00e9") for b in ("y", "2", "?", "'ll")]
        texts = [t for t in [*hard_texts, *EXTRA, *spaces, *(r["text"] for r in documents)] if t]
        given = [a.tolist() for t in texts for a, _ in aligner.tokens([t])]
        whole = [e.ids for e in aligner.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
        assert all(a == w for a, w in zip(given, whole, strict=True) if a) and sum(map(bool, given)) > 200

    def test_copies_count_each(self, spark):
        docs = spark.createDataFrame([(i, "the same text") for i in range(40)] + [(99, "the other")], "doc_id long, text string")
        rows = {r.row.doc_id: tuple(r)[1:] for r in self.made(docs).collect()}
        assert rows == plain.alignments([(i, "the same text") for i in range(40)] + [(99, "the other")])

    def test_nothing_to_align(self, spark):
        none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
        assert {tuple(r)[1:] for r in self.made(none).collect()} == {(0, 0, 0, 0, 0, 0, "")}
        assert self.made(none.limit(0)).collect() == []

    def test_pairs_are_bounded_by_the_vocabularies(self, spark, documents):
        docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in documents], "doc_id long, text string")
        sp = sentencepiece.SentencePieceProcessor(model_file=plain.B_FILE)
        with open(plain.A_FILE, "rb") as file:
            side = alignment.tokenizers.Tokenizer.from_buffer(file.read())
        a, b = alignment.bytes_a(side), alignment.bytes_b(sp)
        pairs = alignment.pair_counts(alignment.aligned(docs, plain.A_FILE, plain.B_FILE)).collect()
        for x, y in ((a[r.pair >> 32], b[r.pair & 0xFFFFFFFF]) for r in pairs):
            assert x.endswith(y) or y.endswith(x)


class TestMerkle:
    def made(self, docs, **options):
        values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
        leaves = docs.withColumn("leaf", merkle.leaf_digest(*values))
        found = merkle.manifest(leaves, keep=["doc_id"], **options)
        proof = F.sha2(merkle.siblings(F.col("proof")), 256)
        rows = found.select("row.doc_id", "leaf", "subroot", "root", proof, merkle.folded(F.col("leaf"), F.col("proof")).alias("again"))
        return sorted(map(tuple, rows.collect()), key=lambda x: (x[0] is not None, x))

    def wanted(self, rows, fanout):
        return [(*x[:5], x[3]) for x in plain.merkle(rows, fanout)]

    @pytest.mark.parametrize("fanout,local", [(2, 1), (2, 2), (3, 1), (16, 2)])
    def test_sources_of_every_size(self, spark, fanout, local):
        random.seed(fanout)
        sizes = [*range(1, 20), 27, 33, 64, 65]
        rows = [(1000 * s + i, f"s{s}", None, i, f"Text {i}") for s in sizes for i in range(s)]
        rows += [(7, None, "en", None, None), (8, None, None, 0, "")]
        random.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
        assert self.made(docs, fanout=fanout, local=local) == self.wanted(rows, fanout)

    def test_hard_rows(self, hard_docs):
        rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in hard_docs.collect()]
        assert self.made(hard_docs, fanout=2, local=1) == self.wanted(rows, 2)

    def test_one_row_and_none(self, spark):
        docs = spark.createDataFrame([(5, "s", "en", 1, "x")], "doc_id long, source string, lang string, n_chars long, text string")
        leaf = sha("1:51:s2:en1:11:x")
        assert self.made(docs) == [(5, leaf, leaf, leaf, sha(""), leaf)]
        assert self.made(docs.limit(0)) == []

    def test_clashing_names(self, spark):
        names = ["g", "key", "row", "seq", "block", "total", "members", "node", "proof", "root", "part", "at"]
        rows = [(i, "s", *range(len(names))) for i in range(40)]
        docs = spark.createDataFrame(rows, ", ".join(f"{n} long" if n != "source" else f"{n} string" for n in ["doc_id", "source", *names]))
        found = merkle.manifest(docs.withColumn("leaf", merkle.leaf_digest(F.col("doc_id"))), keep=["doc_id", *names])
        assert found.columns == ["row", "leaf", "subroot", "root", "proof"]
        kept = {tuple(r.row) for r in found.collect()}
        assert kept == {(i, *range(len(names))) for i in range(40)}


class TestTokenCounts:
    @pytest.mark.parametrize("file", [plain.A_FILE, plain.B_FILE])
    def test_hard_texts(self, spark, hard_docs, hard_texts, tmp_path, file):
        made = token_counts.count_tokens(hard_docs, file, str(tmp_path / "cache"))
        got = {r.row.doc_id: (r.n_bytes, r.n_tokens) for r in made.collect()}
        sp = sentencepiece.SentencePieceProcessor(model_file=plain.B_FILE)
        want = [x[:2] for x in plain.token_counts(hard_texts)]
        if file == plain.B_FILE:
            want = [(len((t or "").encode()), len(sp.encode(t or ""))) for t in hard_texts]
        assert [got[i] for i in range(len(hard_texts))] == want and made.count() == len(hard_texts) + 2

    def test_only_misses_are_encoded(self, spark, tmp_path, monkeypatch):
        cache = str(tmp_path / "cache")
        seen = []
        encode = token_counts._encoded

        def watched(texts, *given):
            seen.append(sorted(r.text for r in texts.collect()))
            return encode(texts, *given)

        monkeypatch.setattr(token_counts, "_encoded", watched)
        first = spark.createDataFrame([(1, "one"), (2, "two words"), (3, "one"), (4, None)], "doc_id long, text string")
        second = spark.createDataFrame([(5, "two words"), (6, "three more words"), (7, "")], "doc_id long, text string")
        for docs in (first, second, second):
            token_counts.count_tokens(docs, plain.A_FILE, cache).collect()
        assert seen == [["", "one", "two words"], ["three more words"], []]
        stored = spark.read.parquet(cache)
        assert stored.count() == 4 and stored.select("tokenizer").distinct().count() == 1
        token_counts.count_tokens(second, plain.B_FILE, cache).collect()
        assert seen[-1] == ["", "three more words", "two words"]
        assert spark.read.parquet(cache).select("tokenizer").distinct().count() == 2

    def test_stored_counts_are_used(self, spark, tmp_path):
        cache = str(tmp_path / "cache")
        version = token_counts.version_of(plain.A_FILE)
        stored = [(sha("known"), 77, version), (sha("known"), 77, version), (sha("other"), 5, "another tokenizer")]
        spark.createDataFrame(stored, token_counts.CACHE_SCHEMA).write.partitionBy("tokenizer").parquet(cache)
        docs = spark.createDataFrame([(1, "known"), (2, "other")], "doc_id long, text string")
        got = {r.row.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, plain.A_FILE, cache).collect()}
        assert got == {1: 77, 2: 1}

    def test_empty_table(self, hard_docs, tmp_path):
        assert token_counts.count_tokens(hard_docs.limit(0), plain.A_FILE, str(tmp_path / "cache")).collect() == []
