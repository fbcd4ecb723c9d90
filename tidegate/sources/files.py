"""Facts about delivered files (size, checksum, rows) and what their manifests claim."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.contract import CORRUPT_COLUMN

#: Bytes of a file that travel as one record, about; a longer line is a record of its own.
PIECE_BYTES = 4096

MANIFEST_SCHEMA = (
    "dataset_name STRING, version STRING, filename STRING, run_date STRING, checksum_algo STRING, "
    "checksum STRING, expected_rows BIGINT, file_size_bytes BIGINT, generated_at STRING"
)

ArrowMap = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _piecemaker(piece_bytes: int) -> ArrowMap:
    """Lines of splits, in order, as pieces: (file, size, start of the split, number, lines, bytes).

    The functions are made here so that they travel to the workers by value and those need nothing
    but numpy and pyarrow.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        names = ["file_path", "size", "start", "number", "lines", "content"]
        split, number, held, size = None, 0, [], 0
        rows: list[tuple] = []

        def flush() -> None:
            nonlocal number, held, size
            if held:
                rows.append((*split, number, len(held), b"\n".join(held)))
                number, held, size = number + 1, [], 0

        def sent() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            paths, sizes, starts, lines = batch.columns
            codes = paths.dictionary_encode().indices.to_numpy()
            begin = starts.to_numpy()
            turns = np.flatnonzero((codes[1:] != codes[:-1]) | (begin[1:] != begin[:-1])) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), len(codes)], strict=True):
                here = (paths[a].as_py(), sizes[a].as_py(), int(begin[a]))
                if here != split:
                    flush()
                    split, number = here, 0
                for line in lines.slice(a, b - a).to_pylist():
                    held.append(line)
                    size += len(line) + 1
                    if size >= piece_bytes:
                        flush()
            if rows:
                yield sent()
        flush()
        if rows:
            yield sent()

    return make


def _folder() -> ArrowMap:
    """md5 and lines of each file from its pieces, which come file by file and in order.

    Lines come without what ends them, a line feed, and without a byte order mark in front of the
    first.  The size of the file tells which of the two stood there, so one digest is kept with the
    mark and one without.  A size that neither explains means that the file has changed: an error.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        mark = b"\xef\xbb\xbf"
        path, size, total, lines, digests = None, 0, 0, 0, []

        def closed() -> pa.RecordBatch:
            missing = size - total
            if missing not in (0, 1, 3, 4):
                raise OSError(f"{path} changed while it was read: {total} of {size} bytes")
            digest = digests[missing >= 3]
            if missing % 3 == 1:
                digest.update(b"\n")
            values = [path], [size], [digest.hexdigest()], [lines]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["file_path", "size", "checksum", "lines"])

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("file_path", "size", "lines", "content")]
            for here, of, counted, content in zip(*columns, strict=True):
                if here != path:
                    if path is not None:
                        yield closed()
                    path, size, total, lines, digests = here, of, 0, 0, [hashlib.md5(), hashlib.md5(mark)]
                elif lines:
                    content = b"\n" + content
                for digest in digests:
                    digest.update(content)
                total += len(content)
                lines += counted
        if path is not None:
            yield closed()

    return fold


def decoded_path(path: Column) -> Column:
    """A path from file metadata, where some characters are written as codes, as it is."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def file_facts(
    spark: SparkSession, path: str | list[str], pattern: str = "*.csv", piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """``(file_path, file_name, file_size_bytes, checksum, data_rows)`` for every file.

    One way for files of any size on any file system that Spark reads: splits are read by all tasks
    and cut into pieces of whole lines, and the pieces of a file, sorted by their place, are folded
    into its md5 by one task that holds a few of them at a time.  ``data_rows`` counts physical lines
    without the header.  A file that fails or changes while it is read fails the job.
    """
    options = {"pathGlobFilter": pattern, "recursiveFileLookup": True}
    meta = F.col("_metadata")
    lines = spark.read.options(lineSep="\n", **options).text(path).select(
        meta["file_path"].alias("file_path"),
        meta["file_size"].alias("size"),
        meta["file_block_start"].alias("start"),
        F.col("value").cast("binary").alias("line"),
    )
    pieces = lines.mapInArrow(
        _piecemaker(piece_bytes), "file_path string, size long, start long, number long, lines long, content binary"
    )
    in_order = pieces.repartition("file_path").sortWithinPartitions("file_path", "start", "number")
    folded = in_order.mapInArrow(_folder(), "file_path string, size long, checksum string, lines long")
    # Scans skip files of zero bytes, so names come from the listing that Spark has made anyway.
    names = spark.read.format("binaryFile").options(**options).load(path).inputFiles()
    named = spark.createDataFrame([(p,) for p in names], "file_path string").select(
        F.regexp_replace("file_path", "^file:/+", "file:/").alias("file_path"),
        F.lit(0).cast("bigint").alias("size"),
        F.lit(None).cast("string").alias("checksum"),
        F.lit(0).cast("bigint").alias("lines"),
    )
    return (
        named.unionByName(folded)
        .groupBy("file_path")
        .agg(
            F.max("size").alias("file_size_bytes"),
            F.coalesce(F.max("checksum"), F.md5(F.lit(""))).alias("checksum"),
            (F.max("lines") - 1).alias("data_rows"),
        )
        .select(
            "file_path",
            decoded_path(F.element_at(F.split("file_path", "/"), -1)).alias("file_name"),
            "file_size_bytes",
            "checksum",
            "data_rows",
        )
    )


def read_manifests(spark: SparkSession, path: str | list[str], pattern: str = "*_manifest.json") -> DataFrame:
    """One manifest document per file; a broken document is a row with the corrupt column set.

    ``file_name`` is the data file the manifest stands next to.
    """
    return (
        spark.read.schema(f"{MANIFEST_SCHEMA}, {CORRUPT_COLUMN} STRING")
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .json(path)
        .select(
            F.regexp_replace(F.col("_metadata.file_name"), "_manifest[.]json$", ".csv").alias("file_name"),
            "*",
        )
    )


def read_manifest_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Manifests kept as JSON records, one per line, as :func:`tidegate.sinks.zones.write_manifests` writes."""
    return (
        spark.read.schema(f"{MANIFEST_SCHEMA}, {CORRUPT_COLUMN} STRING")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(path)
        .select(F.col("filename").alias("file_name"), "*")
    )
