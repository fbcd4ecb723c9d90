"""Token counts through a cache keyed by content and tokenizer digests.

A text's count depends on its content and on the tokenizer, so both are digested and looked up among
counts stored earlier.  Only distinct contents that are missing are encoded, each once however many
rows share it, and their counts are appended to the cache for the next run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.shared import explode_batches, join_hot, once_per_worker, written
from tidegate.sources.zones import exists

CACHE_SCHEMA = "content string, n_tokens long, tokenizer string"
#: Characters of texts that are encoded in one call.
AT_ONCE = 1 << 18


def version_of(tokenizer_file: str) -> str:
    """Digest of a tokenizer: the bytes of its file and the library, with its version, that runs it."""
    library = sentencepiece if tokenizer_file.endswith(".model") else tokenizers
    with open(tokenizer_file, "rb") as file:
        return hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode() + file.read()).hexdigest()


def counter(model: bytes, is_json: bool) -> Callable[[list[str]], list[int]]:
    """Numbers of tokens of texts: nothing added in front or behind, nothing cut off or filled up."""
    if not is_json:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        return lambda texts: [len(ids) for ids in sp.encode(texts, num_threads=1, add_bos=False, add_eos=False)]
    tokenizer = tokenizers.Tokenizer.from_buffer(model)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def _in_parts(texts: list[str]) -> Iterator[list[str]]:
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text)
        if held >= AT_ONCE:
            yield part
            part, held = [], 0
    if part:
        yield part


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """``content`` and ``n_tokens`` stored for one tokenizer; two runs at once may have stored a count twice."""
    if not exists(spark, cache):
        return spark.createDataFrame([], "content string, n_tokens long")
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == version)
    return stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _encoded(texts: DataFrame, tokenizer_file: str, version: str) -> DataFrame:
    """``content`` and ``n_tokens`` of each row of ``content`` and ``text``."""
    with open(tokenizer_file, "rb") as file:
        model = texts.sparkSession.sparkContext.broadcast(file.read())
    is_json = not tokenizer_file.endswith(".model")

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        count = once_per_worker("counter", version, lambda: counter(model.value, is_json))

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = [n for part in _in_parts(batch.column(1).to_pylist()) for n in count(part)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

        return each

    return explode_batches(texts.select("content", "text"), start, "content string, n_tokens long")


def count_tokens(
    docs: DataFrame, tokenizer_file: str, cache: str, text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """``row`` (the kept columns), ``n_bytes`` (of the text as UTF-8) and ``n_tokens`` of each row.

    ``cache`` is a folder that all executors reach; it is made where it is missing, and holds one folder per
    tokenizer digest.  Files named ``.json`` belong to one library, ``.model`` to the other; special tokens in
    a text are what the library makes of them by default.  Neither changes texts before it looks at them in a
    way that could be anticipated here, so the normalised content is the text itself, with NULL as the empty
    text: no bytes, and as many tokens as an empty text has.  A job that fails leaves no counts behind.  Rows
    that repeat a text, ids, extra columns and their names make no difference; empty in, empty out.
    """
    spark, version = docs.sparkSession, version_of(tokenizer_file)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.sha2(whole, 256).alias("content"),
        F.octet_length(whole).cast("long").alias("n_bytes"),
        F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"),
    )
    wanted = rows.select("content").distinct()
    missing = written(wanted.join(cached(spark, cache, version), "content", "left_anti"), "token-misses")
    # Copies are combined before they are dealt out.  Few misses are sent to the texts, by Spark's own
    # choice from the size of their table; many meet the texts where the copies were gathered.
    texts = docs.select(F.sha2(whole, 256).alias("content"), whole.alias("text"))
    texts = texts.groupBy("content").agg(F.min("text").alias("text")).join(missing, "content", "left_semi")
    counted = _encoded(texts, tokenizer_file, version).withColumn("tokenizer", F.lit(version))
    counted.write.mode("append").partitionBy("tokenizer").parquet(cache)
    return join_hot(rows, cached(spark, cache, version), ["content"], "left").select("row", "n_bytes", "n_tokens")
