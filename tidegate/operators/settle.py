"""Computed columns that later filters do not look through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Append ``columns``, evaluated exactly once per row.

    Spark moves a filter below the projection that computes its columns and evaluates them again
    there.  That is right for cheap columns, but an outcome that depends on every cast and check
    of a row would be worked out twice, in one oversized filter.  Columns made by a generator
    stay put; this one makes one row of each row, within the same stage.
    """
    outcome = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(outcome)))
