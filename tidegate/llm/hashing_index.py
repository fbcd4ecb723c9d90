"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

A rotation learned on a sample (principal axes, then iterative quantisation) turns each vector into
a code of signs.  Within a block of rows the code's substrings are indexed; by the pigeonhole
principle, every code within a Hamming radius agrees with the query in at least one of ``m``
substrings up to ``radius // m`` bits, so probing those small balls retrieves all of them.  The codes
found are verified on all bits, and the floats of what remains give the order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.shared import share_of

#: Vectors that the rotation and the radius are learned on, and rows and queries of a block.
SAMPLE = 8_000
ROW_BLOCK = 8_192
QUERY_BLOCK = 4_096
#: Share of true neighbours that the learned radius covers in the sample.
COVER = 0.99


@dataclass(frozen=True)
class Index:
    mean: np.ndarray
    axes: np.ndarray
    radius: int
    substrings: int

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Substrings of the code of each vector, one byte each."""
        return np.packbits((vectors - self.mean) @ self.axes > 0, axis=1, bitorder="little")


def learn(vectors: np.ndarray, k: int = 10, cover: float = COVER, rounds: int = 30) -> Index:
    """Rotation by iterative quantisation; radius that covers a share of the sample's neighbours.

    Neighbours within a sample are farther off than those in the whole table, so the radius errs on
    the safe side.
    """
    mean = vectors.mean(0)
    centred = vectors - mean
    dim = vectors.shape[1]
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1]
    random = np.random.default_rng(5)
    bits = max(16, -(-dim // 8) * 8)
    while axes.shape[1] < bits:
        axes = np.concatenate((axes, np.linalg.qr(random.normal(size=(dim, dim)))[0]), axis=1)
    axes = axes[:, :bits]
    scale = centred @ axes
    rotation = np.linalg.qr(random.normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(scale @ rotation > 0, 1.0, -1.0).T @ scale)
        rotation = (left @ right).T
    index = Index(mean, axes @ rotation, bits, bits // 8)
    codes = index.codes(vectors)
    apart = []
    for q in random.permutation(len(vectors))[:300]:
        near = np.argsort(((vectors - vectors[q]) ** 2).sum(1), kind="stable")
        near = near[near != q][:k]
        apart.append(np.bitwise_count(codes[near] ^ codes[q]).sum(1))
    radius = int(np.quantile(np.concatenate(apart), cover, method="higher")) if len(vectors) > 1 else bits
    return Index(index.mean, index.axes, radius, index.substrings)


_COUNTS = np.bitwise_count(np.arange(256, dtype=np.uint8))


class Block:
    """The rows of a block with an index of each substring: rows in order of its value, and bucket sizes."""

    def __init__(self, index: Index, ids: np.ndarray, vectors: np.ndarray):
        self.index, self.ids, self.vectors = index, ids, vectors
        self.codes = index.codes(vectors)
        self.order = np.argsort(self.codes, axis=0, kind="stable").T.copy()
        self.sizes = [np.bincount(self.codes[:, j], minlength=256) for j in range(index.substrings)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Positions of all codes within ``radius`` bits."""
        ball = radius // self.index.substrings
        seen = np.zeros(len(self.ids), bool)
        for j, value in enumerate(code):
            probed = _COUNTS[np.arange(256) ^ value] <= ball
            seen[self.order[j][np.repeat(probed, self.sizes[j])]] = True
        found = np.flatnonzero(seen)
        return found[np.bitwise_count(self.codes[found] ^ code).sum(1) <= radius]

    def nearest(self, own: int, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest found; the radius grows until k are within it."""
        code = self.index.codes(vector[None])[0]
        radius, bits = self.index.radius, 8 * self.index.substrings
        while True:
            found = self.within(code, radius)
            found = found[self.ids[found] != own]
            if len(found) >= k or radius >= bits:
                break
            radius += 2
        apart = np.sqrt(((self.vectors[found] - vector) ** 2).sum(1))
        best = np.lexsort((self.ids[found], apart))[:k]
        return self.ids[found][best], apart[best]


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``id`` and ``v`` of the vectors that take part, one per id.

    Left out: NULL ids, NULL or empty vectors, those with NULL or non-finite components, zero
    vectors, and vectors of another length than most (ties: the greater length).  Of rows that repeat
    an id the smallest vector counts.
    """
    v = F.col(embedding).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = vectors.select(F.col(vec_id).alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0)
    )
    most = fine.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).first()
    if most is None:
        return fine
    return fine.where(F.size("v") == most.d).groupBy("id").agg(F.min("v").alias("v"))


def search(
    vectors: DataFrame,
    is_query: F.Column,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    row_block: int = ROW_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (Euclidean distance) of the k nearest found.

    ``is_query`` is a condition over ``id``.  The stated queries meet all rows in blocks: rows are
    dealt by hash into blocks of about ``row_block``, queries into blocks of about ``query_block``,
    and a task gets one block of either, whatever the values look like.  Each block gives the k best
    of its candidates, at least k where it has as many rows.  Which rows take part: see ``usable``.
    """
    fine = usable(vectors, vec_id, embedding)
    n, n_queries = fine.agg(F.count("*"), F.count_if(is_query)).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if not n_queries:
        return vectors.sparkSession.createDataFrame([], empty)
    sample = fine.where(share_of(F.col("id"), n, SAMPLE)).select("v").toArrow()["v"].to_pylist()
    index = learn(np.array(sample or fine.limit(1).first()[1:], float), k)
    # Plain values: a broadcast instance would make workers import this module.
    shared = vectors.sparkSession.sparkContext.broadcast((index.mean, index.axes, index.radius, index.substrings))
    rows_in, queries_in = -(-n // row_block), -(-n_queries // query_block)
    dealt = fine.select(
        F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(rows_in)).alias("a"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(queries_in - 1).cast("long"))).alias("b"),
        "id", "v",
    )
    asked = fine.where(is_query).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rows_in - 1).cast("long"))).alias("a"),
        F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(queries_in)).alias("b"),
        "id", "v",
    )

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return table["id"].to_numpy(), flat.reshape(table.num_rows, -1)

    def meet(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if rows.num_rows and queries.num_rows:
            block = Block(Index(*shared.value), *matrix(rows))
            for own, vector in zip(*matrix(queries), strict=True):
                ids, apart = block.nearest(own, vector, k)
                found += zip([own] * len(ids), ids.tolist(), apart.tolist(), strict=True)
        columns = list(zip(*found, strict=True)) or [[], [], []]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "vec_id", "score"])

    near = dealt.groupBy("a", "b").cogroup(asked.groupBy("a", "b")).applyInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


