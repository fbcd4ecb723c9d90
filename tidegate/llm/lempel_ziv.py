"""Substring deduplication by anchor blocks of the whole corpus, in place of greedy Lempel-Ziv factors.

The reference is every document; it is indexed by blocks that the content itself marks out.  A
block's anchor is the smallest hashed gram of eight words among those of a window of 35 words, and
the block spans all neighbouring windows that share the anchor.  Equal windows have equal anchors,
so a document is parsed block by block:

* an anchor found nowhere else ends a factor: no window of its block occurs again;
* a block whose anchor occurs again, always within an equal block, continues the factor whole;
* a block whose anchor also occurs within other blocks is a factor boundary, where the documents
  stop being equal.  There, and only there, the windows themselves are compared.

Windows that occur again anywhere are duplicate spans.  The result is that of comparing all
windows; only one anchor in about fourteen words, and the windows at boundaries, are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.llm.shared import explode_batches, join_hot, written

WINDOW = 35
GRAM = 8
#: Odd multipliers of the two polynomial hashes, with their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


class Rolling:
    """Hashes of any ranges of a sequence of words."""

    def __init__(self, words: list[bytes], base: int = BASES[0]):
        n = len(words)
        hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
        powers = np.full(n + 1, base, np.uint64)
        powers[0] = 1
        inverses = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
        inverses[0] = 1
        self.inverse = np.multiply.accumulate(inverses)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashed * np.multiply.accumulate(powers)[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self.inverse[start]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(32))


def blocks(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...] | None:
    """Anchor hash, block hash, first and last window start of each block; None below one window."""
    n = len(words) - window + 1
    if n < 1:
        return None
    rolling = Rolling(words)
    starts = np.arange(len(words) - gram + 1)
    grams = rolling(starts, starts + gram)
    anchor = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1).argmin(1) + np.arange(n)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    last = np.concatenate((first[1:] - 1, [n - 1]))
    at = anchor[first]
    inside = (last - first).astype(np.uint64) << np.uint64(32) | (at - first).astype(np.uint64)
    whole = rolling(first, last + window) ^ (inside * np.uint64(BASES[0]))
    return grams[at].view(np.int64), whole.view(np.int64), first, last


def _occurrences(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """``anchor``, ``block``, ``key`` and ``place`` (first start * 256 + further starts) of all blocks."""

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch | None]:
        def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            parts = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = blocks(words_of(text), window, gram)
                if found is not None:
                    anchor, whole, first, last = found
                    parts.append((anchor, whole, np.full(len(anchor), key), first * 256 + (last - first)))
            if not parts:
                return None
            columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["anchor", "block", "key", "place"])

        return each

    return explode_batches(texts, start, "anchor long, block long, key long, place long")


def _boundary_windows(flagged: DataFrame, window: int) -> DataFrame:
    """``w1``, ``w2``, ``key`` and ``start`` of the windows of the flagged blocks."""

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch | None]:
        def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            parts = []
            for key, text, places in zip(*[c.to_pylist() for c in batch.columns[:3]], strict=True):
                words = words_of(text)
                at = np.concatenate([np.arange(p // 256, p // 256 + p % 256 + 1) for p in places])
                one, two = (Rolling(words, base)(at, at + window) for base in BASES)
                parts.append((one.view(np.int64), two.view(np.int64), np.full(len(at), key), at))
            if not parts:
                return None
            columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["w1", "w2", "key", "start"])

        return each

    return explode_batches(flagged, start, "w1 long, w2 long, key long, start long")


def duplicate_spans(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] | None = None,
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """``row`` (the kept columns), ``n_words``, ``spans`` (ranges of duplicate words) and ``kept``.

    Words stand between ASCII white space.  A word is duplicate if a run of ``window`` words around
    it starts anywhere else, in the same text too; ``kept`` is the other words joined by one space.
    NULL and empty texts have no words; texts below one window lose nothing.  Rows that repeat a
    text are copies of each other.  Other columns take no part.  Rows of equal text share a key (a
    64-bit hash), so what is learned of a text is sent to all its copies.
    """
    if window - gram > 255 or gram > window:
        raise ValueError("a window takes at most 255 grams and at least one")
    keyed = docs.select(
        F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("key"),
        F.col(f"`{text}`").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"),
    )
    texts = keyed.select("key", "text")
    found = _occurrences(texts, window, gram)
    # One row per anchor; equal smallest and largest block hashes mean that all blocks are equal.
    repeated = (
        found.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("block").alias("low"), F.max("block").alias("high"))
        .where("n > 1")
        .select("anchor", (F.col("low") != F.col("high")).alias("mixed"))
    )
    hits = join_hot(found.select("anchor", "key", "place"), repeated, ["anchor"])
    grouped = hits.groupBy("key").agg(
        F.collect_set(F.when(~F.col("mixed"), F.col("place"))).alias("whole"),
        F.collect_set(F.when(F.col("mixed"), F.col("place"))).alias("mixed"),
    )
    places = written(grouped, "blocks")
    # Both joins with the texts take the same columns, so that Spark deals the texts out only once.
    boundary = join_hot(keyed, places.where(F.size("mixed") > 0).select("key", "mixed"), ["key"])
    windows = _boundary_windows(boundary.select("key", "text", "mixed", "row"), window)
    again = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    starts = join_hot(windows, again, ["w1", "w2"]).groupBy("key").agg(F.collect_set("start").alias("starts"))
    flags = places.select("key", "whole").join(starts, "key", "left")
    return _cut(join_hot(keyed, flags, ["key"], "left").select("row", "text", "whole", "starts"), window)


def _cut(joined: DataFrame, window: int) -> DataFrame:
    out = StructType([joined.schema["row"], *StructType.fromDDL("n_words long, spans array<struct<start: int, end: int>>, kept string")])
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, spans, kept = [], [], []
            for text, whole, starts in zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True):
                words = words_of(text)
                edge = np.zeros(len(words) + 1, np.int64)
                for place in whole or ():
                    edge[place // 256] += 1
                    edge[place // 256 + place % 256 + window] -= 1
                for at in starts or ():
                    edge[at] += 1
                    edge[at + window] -= 1
                gone = np.concatenate(([False], np.cumsum(edge)[:-1] > 0, [False]))
                turns = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
                ranges = list(zip(turns[::2], turns[1::2], strict=True))
                left, at = [], 0
                for a, b in ranges:
                    left += words[at:a]
                    at = b
                left += words[at:]
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in ranges])
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["row", "n_words", "spans", "kept"])

        return each

    return explode_batches(joined, start, out)


def n_removed() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + (x["end"] - x["start"]))
