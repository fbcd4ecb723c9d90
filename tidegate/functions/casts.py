"""Text to contract type.  Every conversion yields NULL on bad input, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.contract import ContractColumn


def is_text(column: ContractColumn) -> bool:
    return isinstance(column.type, T.StringType)


def to_contract_type(c: Column, column: ContractColumn) -> Column:
    if is_text(column):
        return c
    if isinstance(column.type, T.DateType):
        return F.try_to_date(c, column.parse_format)
    if isinstance(column.type, T.TimestampType):
        return F.try_to_timestamp(c, F.lit(column.parse_format))
    return c.try_cast(column.type)
