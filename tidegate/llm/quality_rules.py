"""Quality classifier as a sparse ensemble of rules.

Shallow trees are grown over statistics of texts; every path from a root to a node is a conjunctive
rule.  A logistic regression with a lasso penalty picks few of them.  The chosen rules become one
Spark column expression over the statistics, so scoring is a projection.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.shared import map_texts, share_of, written

STATISTICS = (
    "log_words",
    "mean_word",
    "longest_word",
    "upper_share",
    "digit_share",
    "space_share",
    "high_share",
    "mark_share",
    "bang_share",
    "pipe_share",
    "odd_mark_share",
    "distinct_share",
    "top_share",
    "same_as_last",
    "distinct_lines",
    "stop_words",
)
#: Labelled rows that a model is fitted on, about.
TRAINING_ROWS = 20_000
THRESHOLD = 0.7

_ODD = np.array([chr(b) in "#$%&*@^~<>{}[]\\=+_`" for b in range(256)])
_MARK = np.array([b < 128 and not chr(b).isalnum() and b > 32 and b != 127 for b in range(256)])


def statistics(text: str | None) -> tuple[float, ...]:
    """The statistics of a whole text in the order of STATISTICS; NULL counts as an empty text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(len(raw), 1)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    m = max(len(words), 1)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    used = Counter(words)
    lines = raw.split(b"\n")
    return (
        math.log1p(len(words)),
        sum(map(len, words)) / m,
        math.log1p(max(map(len, words), default=0)),
        upper / max(upper + lower, 1),
        int(count[48:58].sum()) / n,
        int(count[[9, 10, 11, 12, 13, 32]].sum()) / n,
        int(count[128:].sum()) / n,
        int(count[_MARK].sum()) / n,
        int(count[33]) / n,
        int(count[124]) / n,
        int(count[_ODD].sum()) / n,
        len(used) / m,
        max(used.values(), default=0) / m,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / m,
        len(set(lines)) / len(lines),
        sum(k for w, k in used.items() if len(w) <= 3) / m,
    )


def with_statistics(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``row`` (the kept columns) and the statistics of each whole text."""

    def start() -> Callable[[str | None], tuple]:
        return statistics

    return map_texts(docs, list(keep or docs.columns), text, start, ", ".join(f"{s} double" for s in STATISTICS))


#: A condition: index of the statistic, whether it is "greater than" (else "at most"), threshold.
Condition = tuple[int, bool, float]


@dataclass(frozen=True)
class Rules:
    """A logistic model: an intercept and weighted conjunctions."""

    intercept: float
    weighted: tuple[tuple[float, tuple[Condition, ...]], ...] = ()

    def score(self) -> Column:
        """The probability of label 1, over columns named as in STATISTICS."""
        total = F.lit(self.intercept)
        for weight, conditions in self.weighted:
            total = total + F.when(conjunction(conditions), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def conjunction(conditions: Sequence[Condition]) -> Column:
    out = F.lit(True)
    for feature, above, threshold in conditions:
        column = F.col(STATISTICS[feature])
        out = out & (column > threshold if above else column <= threshold)
    return out


def paths(tree: str) -> list[tuple[Condition, ...]]:
    """All paths from the root to other nodes of a printed tree, each simplified and ordered."""
    out, stack = [], []
    for line in tree.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            stack = [c for c in stack if c[0] < len(m[1])]
            stack.append((len(m[1]), (int(m[2]), m[3] == ">", float(m[4]))))
            tightest: dict[tuple[int, bool], float] = {}
            for _, (feature, above, value) in stack:
                held = tightest.get((feature, above), value)
                tightest[feature, above] = max(held, value) if above else min(held, value)
            out.append(tuple(sorted((f, a, v) for (f, a), v in tightest.items())))
    return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = TRAINING_ROWS,
    trees: int = 24,
    depth: int = 3,
    penalty: float = 0.002,
) -> Rules:
    """Learn from the documents that have a label.

    The model is fitted on a bounded sample: about ``rows`` labelled documents, chosen by a hash of
    their id.  Labels that are NULL don't count; of several labels of an id the largest one does.
    Without labels, or with one class only, the model is a constant, the smoothed share of label 1.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    chosen = share_of(F.col(doc_id), known.count(), rows)
    marked = known.where(chosen).groupBy(F.col(doc_id).alias("id")).agg(F.max(F.col(label).cast("double")).alias("label"))
    measured = with_statistics(docs.where(chosen), text, [doc_id]).withColumn("id", F.col(f"row.`{doc_id}`"))
    sample = written(measured.join(marked, "id").select("label", *STATISTICS).repartition(8), "quality-sample")
    n, good = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    prior = math.log((good + 1) / (n - good + 1))
    if good in (0, n):
        return Rules(prior)
    vector = array_to_vector(F.array(*[F.col(s) for s in STATISTICS]))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, minInstancesPerNode=5, featureSubsetStrategy="onethird")
    model = forest.fit(sample.select("label", vector.alias("features")))
    found = sorted({p for t in model.trees for p in paths(t.toDebugString)})
    if not found:
        return Rules(prior)
    truths = array_to_vector(F.array(*[conjunction(r).cast("double") for r in found]))
    lasso = LogisticRegression(regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=60)
    fitted = lasso.fit(sample.select("label", truths.alias("features")))
    weights = fitted.coefficients.toArray()
    return Rules(float(fitted.intercept), tuple((float(w), r) for w, r in zip(weights, found, strict=True) if abs(w) > 1e-6))


def keep_good(docs: DataFrame, rules: Rules, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, unchanged."""
    return with_statistics(docs, text).where(rules.score() >= threshold).select("row.*")
