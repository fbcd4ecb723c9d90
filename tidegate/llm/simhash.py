"""SimHash near-duplicates by multi-index hashing over fingerprint segments.

A fingerprint of 64 bits is cut into segments.  Two fingerprints that differ in at most ``radius``
bits differ in at most ``radius // segments`` bits of one segment, so it is enough to look up, for
each segment, all values in the small Hamming ball around it.  Matches are verified on all bits.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.components import components
from tidegate.llm.shared import map_texts, written

SEED = 42
SHINGLE = 3
#: Shingles whose bits are counted at once.
AT_ONCE = 65_536
#: A-Z to lower case.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None) -> int:
    """SimHash over the word shingles (repeats count) as a signed 64-bit number; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    size = min(SHINGLE, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    stops = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), AT_ONCE):
        part = [digest(line[a:b], SEED) for a, b in zip(starts[at : at + AT_ONCE], stops[at : at + AT_ONCE], strict=True)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of each row."""

    def start() -> Callable[[str | None], tuple]:
        return lambda value: (fingerprint(value),)

    made = map_texts(docs, [doc_id], text, start, "fp long")
    return made.select(F.col(f"row.`{doc_id}`").alias("doc_id"), "fp")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _entry(segment: int, key: Column) -> Column:
    return F.struct(F.lit(segment).alias("s"), key.alias("key"))


def _around(segment: int, part: Column, flips: list[int]) -> Column:
    values = F.array(*[F.lit(_signed(x)).cast("long") for x in flips])
    return F.transform(values, lambda flip: _entry(segment, part.bitwiseXOR(flip)))


def links(distinct: DataFrame, radius: int = 3, segments: int = 2) -> DataFrame:
    """Pairs ``u > v`` of the distinct fingerprints (column ``fp``) within ``radius`` bits, each once.

    The index holds a row per fingerprint and segment, the probes a row per fingerprint, segment and
    value in the ball (33 with two segments of 32 bits and radius 3).  A bucket only holds distinct
    fingerprints that agree in a whole segment, however many documents share one of them.
    """
    width = 64 // segments
    if width * segments != 64:
        raise ValueError("segments must divide 64")
    balls, tables = [], []
    for s in range(segments):
        bits = range(s * width, (s + 1) * width)
        mask = sum(1 << b for b in bits)
        flips = [sum(1 << b for b in c) for n in range(radius // segments + 1) for c in combinations(bits, n)]
        part = F.col("fp").bitwiseAND(F.lit(_signed(mask)))
        tables.append(_entry(s, part))
        balls.append(_around(s, part, flips))
    index = distinct.select(F.col("fp").alias("v"), F.inline(F.array(*tables)))
    probes = distinct.select(F.col("fp").alias("u"), F.inline(F.concat(*balls)))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius
    return (
        probes.join(index.hint("shuffle_hash"), ["s", "key"]).where((F.col("u") > F.col("v")) & near).select("u", "v").distinct()
    )


def groups(prints: DataFrame, radius: int, segments: int) -> DataFrame:
    """``fp`` and ``root`` for each distinct fingerprint: equal roots are one component."""
    nodes = prints.select("fp").distinct()
    roots = components(links(nodes, radius, segments))
    return nodes.join(roots, nodes.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 3, segments: int = 2
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``: the smallest id reachable over links.

    Equal fingerprints are one node, so a group of copies of any size adds one row to the search.
    NULL and word-less texts have fingerprint 0 and link like any other.  Rows are kept as they
    come: repeated rows stay; a NULL id belongs to its component, whose id is the smallest one that
    is not NULL (NULL if there is none).  Other columns take no part.  Empty in, empty out.
    """
    prints = written(fingerprints(docs, doc_id, text), "fingerprints")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    of_print = written(groups(prints, radius, segments).join(least, "fp"), "groups")
    of_root = of_print.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of_print.select("fp", "root").join(of_root, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 3, segments: int = 2
) -> DataFrame:
    """The rows of ``docs`` with one of each near-duplicate group: the one with the smallest id.

    NULL ids come last; of rows that are equal in this the first in the order of partitions stays.
    """

    def start() -> Callable[[str | None], tuple]:
        return lambda value: (fingerprint(value),)

    made = map_texts(docs, docs.columns, text, start, "fp long").withColumn("n", F.monotonically_increasing_id())
    rows = written(made, "simhash-rows")
    prints = rows.select("fp", "n", F.col(f"row.`{doc_id}`").alias("doc_id"))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "n")
    best = prints.groupBy("fp").agg(F.min(first).alias("best"))
    of_print = written(groups(prints, radius, segments).join(best, "fp"), "groups")
    heads = of_print.groupBy("root").agg(F.min("best")["n"].alias("n"))
    return rows.join(heads, "n", "left_semi").select("row.*")
