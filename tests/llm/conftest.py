from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


#: Columns whose names the operators use inside.
CLASHING = "row string, key long, spans string, fp long, n string, ids string, score double, tree string, host string"


@pytest.fixture(scope="session")
def hard_texts() -> list[str | None]:
    """NULL, empty, white space only, one word, repeats, odd characters, a very long text."""
    block = " ".join(f"w{i}" for i in range(60))
    return [
        None,
        "",
        " \t\n ",
        "x",
        "a  b   c ",
        "same words here " * 40,
        "é ß▁ ▁▁x \U0001f600 \x00 ​ﬁ",
        block,
        "before " + block + " after",
        block,
        "A" * 5000,
        "!!! ??? ...",
        "long " + " ".join(f"z{i % 997}" for i in range(60_000)),
    ]


@pytest.fixture(scope="session")
def hard_docs(spark, hard_texts):
    """The hard texts under their place as id, a row repeated, a NULL id, and columns that clash."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(hard_texts)]
    rows += [rows[3], (None, "no id", None, None, None)]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    return spark.createDataFrame([r + (None,) * 9 for r in rows], schema)
