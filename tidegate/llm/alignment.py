"""Alignment of two tokenizers over a corpus, each distinct text once.

Rows are shuffled by their full text, so every distinct text is tokenised and aligned once.  Tokens of
the two sides that end at the same byte are linked; the counts of linked id pairs are weighted by how
many rows share a text, and what is measured of a text is joined back to all its rows.

Of two tokens that end together the bytes of one end with those of the other.  So there are at most as
many linked id pairs as both vocabularies have bytes, whatever the corpus: that table is broadcast.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidegate.llm.sentencepiece_codec import MARK
from tidegate.llm.shared import ROWS_AT_ONCE, explode_batches, join_hot, once_per_worker, written

#: Characters of texts that are tokenised in one call.
AT_ONCE = 1 << 18
#: Characters of chunks whose ids a Python worker holds before it begins anew.
CHUNK_CHARS = 4_000_000
#: Ids are packed as numbers of 16 bits, or 32 for larger vocabularies; marks as one bit per token.
ALIGNED = "key string, n long, n_a long, n_b long, a binary, b binary, last_a binary, last_b binary, pair long"
PACKED = ("n_a", "n_b", "a", "b", "last_a", "last_b")
MEASURES = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for themselves, the other bytes, in order, for those from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def bytes_a(tokenizer: tokenizers.Tokenizer) -> list[bytes]:
    known = byte_alphabet()
    return [bytes(known[c] for c in tokenizer.id_to_token(i)) for i in range(tokenizer.get_vocab_size())]


def bytes_b(sp: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]


class Aligner:
    """Tokenises texts with both sides and finds the bytes at which tokens of both end."""

    def __init__(self, model_a: bytes, model_b: bytes):
        self.a = tokenizers.Tokenizer.from_buffer(model_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.bytes_a, self.bytes_b = bytes_a(self.a), bytes_b(self.b)
        if not all(self.bytes_a) or not all(self.bytes_b):
            raise ValueError("a token without bytes ends where the one before it ends")
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))

        self.chunks = re.compile(r"(?<=\S) (?=\S)").split
        self.known: dict[str, bytes | None] = {}
        self.held = 0

    def learn(self, chunks: Iterable[str]) -> None:
        """A's ids of a space and each chunk, as bytes of 32-bit numbers; None if they do not give it back."""
        if self.held > CHUNK_CHARS:
            self.known.clear()
            self.held = 0
        new = list(set(chunks).difference(self.known))
        for chunk, found in zip(new, self.a.encode_batch_fast([" " + c for c in new], add_special_tokens=False), strict=True):
            ids = found.ids
            same = b"".join(map(self.bytes_a.__getitem__, ids)) == b" " + chunk.encode()
            self.known[chunk] = array("i", ids).tobytes() if same else None
        self.held += sum(map(len, new))

    def tokens(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none at all for a text that one of them does not give back byte by byte.

        A's words begin at a space that stands between two other characters, whatever is around, so a
        text is cut there and each distinct chunk, with the space in front, needs to be encoded once.
        """
        split = [self.chunks(t) for t in texts]
        self.learn(chain.from_iterable(split))
        none = np.zeros(0, np.int64)
        for text, chunks, ids_b in zip(texts, split, self.b.encode(texts, num_threads=1), strict=True):
            ids_a = list(map(self.known.__getitem__, chunks))
            if not text or None in ids_a or b"".join(map(self.bytes_b.__getitem__, ids_b)) != b" " + text.encode():
                yield none, none
            else:
                yield np.frombuffer(b"".join(ids_a), np.int32).astype(np.int64), np.array(ids_b, np.int64)

    def align(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each text the ids of both sides, and the places of the tokens of either that end a group."""
        out = []
        for a, b in self.tokens(texts):
            ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
            _, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
            out.append((a, b, at_a, at_b))
        return out

    def packed(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> tuple:
        """The columns PACKED of a text."""
        ids = [x.astype("<u2" if len(sizes) <= 1 << 16 else "<u4").tobytes() for x, sizes in ((a, self.sizes_a), (b, self.sizes_b))]
        marks = []
        for size, at in ((len(a), at_a), (len(b), at_b)):
            last = np.zeros(size, bool)
            last[at] = True
            marks.append(np.packbits(last, bitorder="little").tobytes())
        return len(a), len(b), *ids, *marks


def unpacked(n_a: int, n_b: int, a: bytes, b: bytes, last_a: bytes, last_b: bytes) -> tuple[np.ndarray, ...]:
    """What :meth:`Aligner.align` gave for a text."""
    ids = [np.frombuffer(x, "<u2" if len(x) == 2 * n else "<u4").astype(np.int64) for n, x in ((n_a, a), (n_b, b))]
    places = [np.flatnonzero(np.unpackbits(np.frombuffer(x, np.uint8), count=n, bitorder="little")) for n, x in ((n_a, last_a), (n_b, last_b))]
    return *ids, *places


def pairs_of(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """The id pairs that are linked, each as A id * 2**32 + B id: the last tokens of each group."""
    return a[at_a] << 32 | b[at_b]


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, text in enumerate(texts, 1):
        held += len(text)
        if held >= AT_ONCE or i == len(texts):
            yield start, i
            start, held = i, 0


def _read(file: str) -> bytes:
    with open(file, "rb") as f:
        return f.read()


def aligned(docs: DataFrame, a_file: str, b_file: str, text: str = "text") -> DataFrame:
    """One row per distinct text that is neither NULL nor empty, and the counts of linked pairs: a written table.

    A text's row has ``key`` (its digest), ``n`` (rows that have it), ``n_a`` and ``n_b`` (tokens), ``a`` and
    ``b`` (ids, packed), ``last_a`` and ``last_b`` (which tokens end a group, packed).  A pair's rows, one per
    task, have ``pair`` and in ``n`` the links of the task's texts, weighted by their rows.  Both files are read
    on the driver; their size is fixed.
    """
    files = _read(a_file), _read(b_file)
    version = hashlib.sha256(files[0] + files[1]).hexdigest()
    models = docs.sparkSession.sparkContext.broadcast(files)
    whole = docs.select(F.col(f"`{text}`").alias("text")).where("text != ''")
    distinct = whole.groupBy("text").agg(F.count("*").alias("n")).select(F.sha2("text", 256).alias("key"), "n", "text")
    out = to_arrow_schema(StructType.fromDDL(ALIGNED))

    def rows(columns: dict) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in out], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = once_per_worker("aligner", version, lambda: Aligner(*models.value))
        # What a task holds is bounded like the whole table of pairs, by the bytes of the vocabularies.
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts, weights = part.column(2).to_pylist(), part.column(1).to_numpy()
                found = [x for i, j in _parts(texts) for x in aligner.align(texts[i:j])]
                linked = [pairs_of(*x) for x in found]
                weights = np.repeat(weights, [len(x) for x in linked])
                pairs, where = np.unique(np.concatenate((pairs, *linked)), return_inverse=True)
                counts = np.bincount(where, np.concatenate((counts, weights)), len(pairs)).astype(np.int64)
                packed = dict(zip(PACKED, zip(*[aligner.packed(*x) for x in found], strict=True), strict=True))
                yield rows({"key": part.column(0), "n": part.column(1)} | packed)
        if len(pairs):
            yield rows({"n": counts, "pair": pairs})

    return written(distinct.mapInArrow(run, ALIGNED), "aligned")


def pair_counts(texts: DataFrame) -> DataFrame:
    """``pair`` (A id * 2**32 + B id) and ``n``, its links in all rows of the corpus."""
    return texts.where("key is null").groupBy("pair").agg(F.sum("n").alias("n"))


def group_texts(a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, words: tuple[np.ndarray, ...]) -> str:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``.  ``words`` are the decimal ids followed by each separator."""
    comma, bar, semicolon = words
    parts = np.empty(len(a) + len(b), object)
    in_a, in_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
    place_a = np.arange(len(a)) + np.repeat(at_b + 1 - in_b, in_a)
    place_b = np.arange(len(b)) + np.repeat(at_a + 1, in_b)
    parts[place_a], parts[place_b] = comma[a], comma[b]
    parts[place_a[at_a]], parts[place_b[at_b]] = bar[a[at_a]], semicolon[b[at_b]]
    return "".join(parts.tolist())[:-1]


def measures(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """For each distinct text ``key``, the columns of MEASURES and ``groups`` (its groups as text).

    ``n_best`` counts links whose pair has the highest count of all pairs of its B id, ties included;
    ``count_sum`` is the sum of the counts of the pairs of all links.
    """
    table = counts.orderBy("pair").toArrow()
    pairs, n = table["pair"].to_numpy(), table["n"].to_numpy()
    ids_b = pairs & 0xFFFFFFFF
    highest = np.zeros(int(ids_b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, ids_b, n)
    known = texts.sparkSession.sparkContext.broadcast((pairs, n, n == highest[ids_b]))
    names = ["key", *[f.split()[0] for f in MEASURES.split(", ")], "groups"]

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        pairs, n, best = known.value
        words = [np.zeros(0, object)] * 3

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal words
            packed = [c.to_pylist() for c in batch.columns[1:]]
            found = [unpacked(*x) for x in zip(*packed, strict=True)]
            most = max(int(x.max(initial=0)) for f in found for x in f[:2])
            if len(words[0]) <= most:
                words = [np.array([f"{i}{c}" for i in range(most + 1)], object) for c in ",|;"]
            linked = [pairs_of(*x) for x in found]
            sizes = np.array([len(x) for x in linked])
            where = np.searchsorted(pairs, np.concatenate(linked))
            row = np.repeat(np.arange(len(found)), sizes)
            sums, bests = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
            np.add.at(sums, row, n[where])
            np.add.at(bests, row, best[where])
            groups = [group_texts(*x, words) if len(x[0]) else "" for x in found]
            numbers = [*packed[:2], sizes, sizes, bests, sums]
            arrays = [batch.column(0), *(pa.array(x, pa.int64()) for x in numbers), pa.array(groups, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        return each

    source = texts.where("key is not null").select("key", *PACKED)
    return explode_batches(source, start, f"key string, {MEASURES}, groups string")


def joined(docs: DataFrame, found: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (the kept columns) and the columns of ``found`` but ``key``; NULL where a text has no row there."""
    rows = docs.select(
        F.when(F.col(f"`{text}`") != "", F.sha2(F.col(f"`{text}`"), 256)).alias("key"),
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"),
    )
    return join_hot(rows, found, ["key"], "left").drop("key")


def align(docs: DataFrame, a_file: str, b_file: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (the kept columns), the columns of MEASURES and ``groups`` of each row.

    A is a byte-level vocabulary in a ``.json`` file and sees a space and the text; B is a ``.model`` file that
    puts the space there itself.  Special tokens in texts are plain text.  Texts that are NULL or empty, or that
    either side does not give back byte by byte, have no tokens: zeros and no groups.  Rows that repeat a text
    share its measures and count each; other columns and their names take no part.  Empty in, empty out.
    """
    texts = aligned(docs, a_file, b_file, text)
    return without_nulls(joined(docs, measures(texts, pair_counts(texts)), text, keep))


def without_nulls(found: DataFrame) -> DataFrame:
    """Zeros and empty texts for the rows whose text has no tokens."""
    numbers = [c for c in found.columns if found.schema[c].dataType.simpleString() == "bigint"]
    texts = [c for c in found.columns if found.schema[c].dataType.simpleString() == "string"]
    return found.fillna(0, numbers).fillna("", texts)
