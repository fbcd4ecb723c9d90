"""Benchmark decontamination with an Aho-Corasick automaton over the windows of all test items.

Texts and items are normalised alike (A-Z to lower case, words of digits, letters and characters
beyond ASCII); a window is ten consecutive words of an item, or all words of a shorter item.  One
scan of a normalised text finds all windows; offsets lead back to the words and to the original.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import explode_batches, map_texts, written

WINDOW = 10
#: Bytes of windows and ids in one automaton, about.  A larger benchmark is scanned in several passes.
AUTOMATON_BYTES = 8_000_000

_RANGES = "array<struct<start: int, end: int>>"

#: A-Z to lower case, other ASCII characters that belong to no word to spaces.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def item_windows(words: list[bytes], window: int = WINDOW) -> list[bytes]:
    """The windows of an item, each as its words between single spaces; none without words."""
    last = max(len(words) - window, 0)
    return [b" %s " % b" ".join(words[i : i + window]) for i in range(last + 1)] if words else []


def scanner(windows: list[tuple[bytes, list]]) -> Callable[[list[bytes]], tuple[list[tuple[int, int]], set]]:
    """A function from words to hit ranges (first word, end; merged, in order) and found item ids."""
    automaton = ahocorasick.Automaton()
    for key, ids in windows:
        automaton.add_word(key.decode("latin-1"), (len(key), key.count(b" ") - 1, ids))
    if windows:
        automaton.make_automaton()

    def scan(words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        if not windows or not words:
            return [], set()
        line = b" %s " % b" ".join(words)
        found = list(automaton.iter(line.decode("latin-1")))
        if not found:
            return [], set()
        # Each match ends on the space behind its last word; spaces count words.
        spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        ends = np.searchsorted(spaces, [end for end, _ in found])
        ranges: list[tuple[int, int]] = []
        items: set = set()
        for start, end in sorted((int(e) - m[1], int(e)) for e, (_, m) in zip(ends, found, strict=True)):
            if ranges and start < ranges[-1][1]:
                ranges[-1] = ranges[-1][0], max(end, ranges[-1][1])
            else:
                ranges.append((start, end))
        for _, (_, _, ids) in found:
            items.update(ids)
        return ranges, items

    return scan


def window_table(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``key`` and ``ids``: each distinct window once, with the ids (as strings, sorted) of its items.

    Spark cuts the items and groups equal windows.  Items without words have none; a NULL id is not listed.
    """
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t"))

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            cut = [(i, k) for i, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for k in item_windows(words_of(t), window)]
            ids, keys = zip(*cut, strict=True) if cut else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(keys, pa.binary())], names=["i", "key"])

        return each

    found = explode_batches(items, start, "i string, key binary")
    return found.groupBy("key").agg(F.array_sort(F.collect_set("i")).alias("ids"))


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    keep: Sequence[str] | None = None,
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """``row``, ``n_words``, ``hits`` (ranges of hit words), ``spans`` (the same in code points of the
    original text) and ``items`` (ids as strings, sorted).

    A NULL text has no words, no hits.  Items without words never occur; of items without an id the
    hits count, though no id can be listed; items that share a window are all listed.  Other columns of
    either table take no part, whatever their names.  Windows are a written table, dealt by hash into
    blocks of about ``automaton_bytes``; the driver and a task hold one block at a time.  One block is one
    scan; with several, each scan writes what it hit under the number of the row, and the parts are
    united at the end: same result.
    """
    windows = written(window_table(benchmark, item_id, item_text, window), "windows")
    size = windows.agg(F.sum(F.length("key") + F.length(F.array_join("ids", " ")))).first()[0] or 0
    n = max(1, -(-size // automaton_bytes))
    block = F.pmod(F.xxhash64("key"), F.lit(n))
    names = list(keep or docs.columns)

    def pass_over(df: DataFrame, columns: list[str], text: str, number: int) -> DataFrame:
        part = windows.where(block == number).toArrow()
        found = list(zip(part["key"].to_pylist(), part["ids"].to_pylist(), strict=True))
        return map_texts(df, columns, text, _starter(found), f"n_words long, hits {_RANGES}, spans {_RANGES}, items array<string>")

    if n == 1:
        return pass_over(docs, names, text, 0)
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    rows = written(docs.select(row, F.col(f"`{text}`").alias("text"), F.monotonically_increasing_id().alias("n")), "decontaminate")
    parts = []
    for number in range(n):
        # The first pass counts the words of all rows, the others keep what they hit.
        made = pass_over(rows, ["n"], "text", number).select("row.n", "n_words", "hits", "spans", "items")
        parts.append(written(made if number == 0 else made.where(F.size("hits") > 0), "hits"))
    together = reduce(DataFrame.unionByName, parts).groupBy("n").agg(
        F.max("n_words").alias("n_words"),
        *[_union(F.flatten(F.collect_list(c))).alias(c) for c in ("hits", "spans")],
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return rows.join(together, "n").select("row", "n_words", "hits", "spans", "items")


def _starter(found: list[tuple[bytes, list]]) -> Callable[[], Callable]:
    def start() -> Callable:
        scan = scanner(found)

        def each(value: str | None) -> tuple:
            words = words_of(value)
            hits, items = scan(words)
            spans = []
            if hits:
                raw = value.encode("utf-8", "surrogatepass")
                at = [m.span() for m in WORD.finditer(raw)]
                points = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
                spans = [(int(points[at[s][0]]) - 1, int(points[at[e - 1][1] - 1])) for s, e in hits]
            return len(words), [{"start": s, "end": e} for s, e in hits], [{"start": s, "end": e} for s, e in spans], sorted(items)

        return each

    return start


def _union(ranges):
    """Ranges in order; overlapping ones as one."""
    return F.aggregate(
        F.array_sort(ranges),
        F.expr("cast(array() as array<struct<start: int, end: int>>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] > x["start"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )


def n_hit() -> F.Column:
    return F.aggregate("hits", F.lit(0).cast("long"), lambda acc, x: acc + (x["end"] - x["start"]))
