"""SentencePiece encoding and decoding by a table of distinct chunks.

Where no piece of a model goes from an ordinary character over to a whitespace marker, merges never
cross the place where a marker run begins.  A text is then a sequence of chunks (a marker run and
the characters after it), and each distinct chunk needs to be segmented only once; its ids are put
back at every place where the chunk stands.  The table is kept per task: dealing out every chunk
position of the corpus for one global table would shuffle several times the input.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.llm.shared import explode_batches

MARK = "▁"
#: Characters of chunks that a task's table holds before it is begun anew.
TABLE_CHARS = 8_000_000


def check_model(model: bytes) -> None:
    """Refuse a model for which chunks can't be segmented on their own."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not sp.is_control(i)]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a piece of this model crosses a whitespace marker")
    if sp.encode("a  b ", out_type=str) != sp.encode("a", out_type=str) + sp.encode(" b", out_type=str) + [MARK]:
        raise ValueError("this model changes white space or adds no marker in front")
    for text in ("ﬁ½　x\t́", "Ä ​\n"):
        if sp.decode(sp.encode(text)) != text:
            raise ValueError("this model normalises characters")


class Table:
    """Ids (as bytes of 32-bit numbers) and decoded text of each distinct chunk, for one task."""

    def __init__(self, model: bytes):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.runs = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.lone, self.end = [self.sp.piece_to_id(MARK)], array("i", [self.sp.eos_id()]).tobytes()
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}
        self.held = 0

    def chunks(self, text: str | None) -> list[str]:
        """The chunks of a text, each without its first marker, which encode adds by itself."""
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            return [c[1:] for c in self.runs(MARK + text.replace(" ", MARK))]
        return text.split(" ")  # every chunk is one marker and a word

    def learn(self, chunks: Iterable[str]) -> None:
        """Segment the chunks that the table lacks, all at once."""
        if self.held > TABLE_CHARS:
            self.ids.clear()
            self.texts.clear()
            self.held = 0
        new = list(set(chunks).difference(self.ids))
        if not new:
            return
        ids = self.sp.encode([c.replace(MARK, " ") for c in new], num_threads=1)
        ids = [i if c else self.lone for c, i in zip(new, ids, strict=True)]
        self.ids.update(zip(new, (array("i", i).tobytes() for i in ids), strict=True))
        # decode drops one marker in front: the chunk's own.
        self.texts.update(zip(new, self.sp.decode(ids, num_threads=1), strict=True))
        self.held += sum(map(len, new)) + 8 * len(new)

    def code(self, texts: Sequence[str | None]) -> tuple[list[np.ndarray], list[str]]:
        """Ids with the end id, and the decoded text, of each text (None: empty)."""
        split = [self.chunks(t) for t in texts]
        self.learn(chain.from_iterable(split))
        ids = [np.frombuffer(b"".join((*map(self.ids.__getitem__, c), self.end)), np.int32) for c in split]
        return ids, [" ".join(map(self.texts.__getitem__, c)) for c in split]


def encode_decode(docs: DataFrame, model_file: str, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (the kept columns), ``ids`` (with the end id, no start id) and ``decoded``.

    The model file is read on the driver and shipped with the tasks (its vocabulary is fixed, well
    below a megabyte).  NULL counts as an empty text: the end id alone, decoded to "".  Rows are
    independent, so repeated rows, any length and other columns (kept inside ``row``, whatever their
    names) make no difference; an empty table gives an empty result.
    """
    with open(model_file, "rb") as file:
        model = file.read()
    check_model(model)
    columns = [F.col(f"`{c}`") for c in keep or docs.columns]
    source = docs.select(F.struct(*columns).alias("row"), F.col(f"`{text}`").alias("text"))
    out = StructType([source.schema["row"], *StructType.fromDDL("ids array<int>, decoded string")])

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        table = Table(model)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, decoded = table.code(batch.column(1).to_pylist())
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids), pa.int32()))
            arrays = [batch.column(0), lists, pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=["row", "ids", "decoded"])

        return each

    return explode_batches(source, start, out)
