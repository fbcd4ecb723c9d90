"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import explode_batches, map_texts, share_of

#: Buckets of the hash, n-gram lengths, and characters that one step of a long text takes.
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
STEP = 1 << 18
#: Training texts per language, about; languages beyond this many are refused.
TEXTS_PER_LANGUAGE = 2_000
LANGUAGES = 1_000
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str, letters: np.ndarray) -> list[np.ndarray]:
    """Buckets of the n-grams of the lower-case text, runs of other characters being one space.

    Long texts come in steps that overlap, so that no n-gram is lost or counted twice.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters[points]
    if not is_letter.any():
        return []
    kept = is_letter | np.concatenate(([False], is_letter[:-1]))
    codes = np.where(is_letter, points, np.uint32(32))[kept]
    codes = np.concatenate((np.array([32], np.uint32), codes, np.full(int(codes[-1] != 32), 32, np.uint32)))
    out = []
    longest = max(ORDERS)
    for at in range(0, len(codes), STEP):
        part = codes[at : at + STEP + longest - 1]
        mixed = np.zeros(len(part), np.uint32)
        for n in range(1, longest + 1):
            mixed = (mixed[: len(part) - n + 1] * np.uint32(0x9E3779B1)) + part[n - 1 :] * np.uint32(0x85EBCA6B) + np.uint32(n)
            if n in ORDERS:
                hashed = mixed[: min(STEP, len(mixed))]
                hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                out.append((hashed >> np.uint32(16)).astype(np.intp) % BUCKETS)
    return out


class Model:
    """Languages in order and the matrix of log probabilities, one row per bucket."""

    def __init__(self, languages: list[str], table: np.ndarray, prior: np.ndarray):
        self.languages, self.table, self.prior = languages, table, prior

    def scorer(self) -> Callable[[str | None], tuple[str, float]]:
        letters = letter_table()

        def each(text: str | None) -> tuple[str, float]:
            found = grams(text, letters) if text else []
            if not found or not self.languages:
                return UNKNOWN, 0.0
            total = self.prior.copy()
            for part in found:
                total += self.table[part].sum(0, dtype=np.float64)
            best = int(total.argmax())
            return self.languages[best], float(1 / np.exp(total - total[best]).sum())

        return each


def fit(texts: DataFrame, text: str = "text", lang: str = "lang", per_language: int = TEXTS_PER_LANGUAGE) -> Model:
    """Learn from rows with a text and a language; others are passed over.

    Of each language about ``per_language`` texts count, chosen by a hash of the text (a classifier
    fitted on a bounded sample); n-grams are counted by tasks and summed by Spark, and the driver
    receives one row per language and bucket at most.  All languages have the same prior.
    """
    rows = texts.where(f"`{text}` is not null and `{lang}` is not null")
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().orderBy(lang).limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    wanted = F.lit(False)
    for name, n in sizes.items():
        wanted = wanted | ((F.col(lang) == name) & share_of(F.col(text), n, per_language))
    sample = rows.where(wanted).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        letters = letter_table()

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts: dict[str, np.ndarray] = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for part in grams(value, letters):
                    counts.setdefault(name, np.zeros(BUCKETS, np.int64))
                    counts[name] += np.bincount(part, minlength=BUCKETS)
            names, buckets, numbers = [], [], []
            for name, count in counts.items():
                used = np.flatnonzero(count)
                names += [name] * len(used)
                buckets.append(used)
                numbers.append(count[used])
            empty = [np.zeros(0, np.int64)]
            arrays = [pa.array(names, pa.string()), *(pa.array(np.concatenate(x or empty), pa.int64()) for x in (buckets, numbers))]
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "bucket", "n"])

        return each

    counted = explode_batches(sample, start, "lang string, bucket long, n long")
    rows_ = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.ones((BUCKETS, len(languages)))
    at = {name: i for i, name in enumerate(languages)}
    columns = np.array([at[x] for x in rows_["lang"].to_pylist()], np.intp)
    table[rows_["bucket"].to_numpy(), columns] += rows_["n"].to_numpy()
    table = np.log(table / table.sum(0)).astype(np.float32)
    return Model(languages, table, np.zeros(len(languages)))


def identify(docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``row``, ``lang_pred`` and ``score`` (the posterior of the prediction) of each whole text.

    The matrix (buckets x languages, bounded) is broadcast.  ``und`` with score 0 for NULL, for texts
    without a letter, and for a model that has learned nothing; ties go to the first language by name.
    """
    # Plain values: a broadcast instance would make workers import this module.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.table, model.prior))
    return map_texts(docs, list(keep or docs.columns), text, lambda: Model(*shared.value).scorer(), "lang_pred string, score double")
