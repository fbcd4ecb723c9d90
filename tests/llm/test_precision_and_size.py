"""Held-out identifiers and tokens, very many spans, hubs, and benchmarks of several passes."""

from __future__ import annotations

import random
import re
import string
import sys
import time

import pytest
from brute import SF
from pyspark.sql import functions as F

from tidegate.llm import decontaminate, secrets
from tidegate.llm.components import components

LETTERS = string.ascii_letters + string.digits


@pytest.fixture(scope="module")
def ratios(spark):
    return secrets.train(secrets.labelled_samples(spark.read.parquet(f"{SF}/documents.parquet")))


def flagged(spark, ratios, tokens):
    rows = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", secrets.looks_random(F.col("t"), ratios).alias("x"))
    return {r.t for r in rows.collect() if r.x}


class TestSecrets:
    def test_ordinary_identifiers_are_none(self, spark, ratios):
        ordinary = [
            "/usr/local/share/application-data/index-page", "getUserAccountBalanceByIdentifier", "AbstractSingletonProxyFactoryBean",
            "a_snake_case_name_for_this", "123e4567-e89b-42d3-a456-426614174000", "MAXIMUM_NUMBER_OF_RETRIES_2", "=" * 28, "-" * 400,
            "/2024/05/17/some-title-of-post", "20240517-123456-000001-backup", "org/apache/spark/sql/Dataset", "internationalization_of_names",
        ]
        assert flagged(spark, ratios, ordinary) == set()

    def test_held_out_precision_and_recall(self, spark, ratios):
        draw = random.Random(11)
        names = {n for m in list(sys.modules.values()) for n in [*vars(m), *(getattr(m, "__name__", "").split("."))]}
        ordinary = sorted(n for n in names if re.fullmatch(r"[A-Za-z0-9_]{20,}", n))[:4000]
        assert len(ordinary) > 200

        def token(n, alphabet=LETTERS):
            return "".join(draw.choice(alphabet) for _ in range(n))

        secret = [token(20) for _ in range(300)] + [token(40, LETTERS + "+/") for _ in range(300)]
        secret += ["ghp_" + token(36) for _ in range(200)] + ["sk_live_" + token(24) for _ in range(200)]
        found = flagged(spark, ratios, ordinary + secret)
        assert len(found & set(secret)) >= 0.99 * len(secret)
        assert len(found & set(ordinary)) <= 0.02 * len(ordinary)

    def test_very_many_spans(self, spark, ratios):
        n = 100_000
        docs = spark.createDataFrame([(1, "deadbeefdeadbeefdeadbeef é " * n, 0)], "doc_id long, text string, n_chars long")
        began = time.time()
        found = secrets.scan(docs, ratios).select(secrets.masked(F.col("row.text"), F.col("spans")).alias("m")).first()
        assert found.m == "[SECRET] é " * n
        assert time.time() - began < 60

    def test_masking_overlaps_and_marks(self, spark):
        text = "\ufeffab\ufeff\U0001f600cdefgh"
        cases = [[(0, 0, 1)], [(1, 0, 4), (2, 1, 3), (4, 2, 6)], [(3, 0, 5), (5, 1, 6)], [(0, 0, 10)], [(1, 1, 9), (2, 2, 3), (8, 2, 10)], []]

        def plain(spans):
            out, at = "", 0
            for start, _, end in spans:
                out += text[at:start] + "[]" if start >= at else ""
                at = max(at, end)
            return out + text[at:]

        want = [plain(c) for c in cases]
        assert want[1] == "\ufeff[][]defgh" and want[4] == "\ufeff[]h" and want[5] == text
        rows = [(i, text, [{"start": a, "kind": k, "end": b} for a, k, b in c]) for i, c in enumerate(cases)]
        df = spark.createDataFrame(rows, "i int, t string, s array<struct<start: int, kind: int, end: int>>")
        got = [r.m for r in df.select("i", secrets.masked(F.col("t"), F.col("s"), "[]").alias("m")).orderBy("i").collect()]
        assert got == want

    def test_tops_over_several_runs(self, spark):
        draw = random.Random(5)
        values = [draw.randrange(10_000) for _ in range(3 * secrets.RUN + 7)]
        tops = secrets._topped(F.array(*[F.lit(v) for v in values]), lambda x: x)
        got = [r["top"] for r in spark.range(1).select(tops.alias("x")).first().x]
        assert got == [max([0, *values[:i]]) for i in range(len(values))]


class TestDecontaminate:
    def test_several_passes_agree_with_one(self, spark, hard_docs):
        docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300)
        docs = docs.unionByName(hard_docs.select("doc_id", "text"))
        items = spark.read.parquet(f"{SF}/benchmark.parquet").withColumn("key", F.lit("clash")).withColumn("i", F.lit(1))
        extra = [("same", "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12", None, None), (None, "w20 w21 w22", None, None), ("none", None, None, None), ("", "!", None, None)]
        items = items.select(F.col("item_id").cast("string").alias("item_id"), "text", "key", "i").unionByName(spark.createDataFrame(extra, "item_id string, text string, key string, i int"))
        columns = ("n_words", "hits", "spans", "items")

        def rows(found):
            return sorted(repr((r.row.doc_id, *[r[c] for c in columns])) for r in found.collect())

        one = decontaminate.find_items(docs, items, keep=["doc_id"])
        several = decontaminate.find_items(docs, items, keep=["doc_id"], automaton_bytes=5_000)
        assert several.columns == one.columns and several.select("row.*").columns == ["doc_id"]
        assert rows(several) == rows(one) and one.where(F.size("hits") > 0).count() > 3
        kept = decontaminate.find_items(docs, items, automaton_bytes=5_000)
        assert kept.select("row.*").columns == docs.columns and kept.count() == docs.count()

    def test_no_items(self, spark, hard_docs):
        none = spark.createDataFrame([], "item_id string, text string")
        found = decontaminate.find_items(hard_docs, none)
        assert found.count() == hard_docs.count() and found.where(F.size("hits") > 0).count() == 0

    def test_windows_once_with_all_their_items(self, spark):
        items = spark.createDataFrame([("b", "A b"), ("a", "a B!"), (None, "a b"), ("c", "")], "item_id string, text string")
        assert [(bytes(r.key), r.ids) for r in decontaminate.window_table(items).collect()] == [(b" a b ", ["a", "b"])]


class TestComponents:
    def test_hubs_and_paths(self, spark):
        star = [(0, i) for i in range(1, 5000)] + [(9_999_999, i) for i in range(4000, 5000)]
        path = [(10_000 + i, 10_001 + i) for i in range(200)]
        edges = spark.createDataFrame([e if i % 2 else e[::-1] for i, e in enumerate(star + path)], "u long, v long")
        got = {r.node: r.root for r in components(edges).collect()}
        assert got == {**{i: 0 for i in range(5000)}, 9_999_999: 0, **{10_000 + i: 10_000 for i in range(201)}}

    def test_a_hub_is_dealt_out_for_the_join(self, spark):
        """Both sides are shuffled for the join itself, which is where Spark splits a skewed partition."""
        from tidegate.llm.shared import join_hot

        edges = spark.range(1000).select((F.col("id") % 3).alias("u"), F.col("id").alias("v"))
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = join_hot(edges, least, ["u"])._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.adaptive.enabled")
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert plan.count("Exchange hashpartitioning(u") == 3
