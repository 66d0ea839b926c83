"""The key/value parameter table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ParameterError(LookupError):
    """A parameter is missing, or present more than once."""


def param(params: DataFrame, code: str, *, code_col: str = "param_code", value_col: str = "value") -> str | None:
    """The one value stored under ``code``; raises unless exactly one row has it.

    Two rows at most come to the driver.
    """
    rows = params.where(F.col(code_col) == code).select(value_col).limit(2).collect()
    if len(rows) != 1:
        raise ParameterError(f"parameter {code}: expected one row, found {'none' if not rows else 'several'}")
    return rows[0][0]


def number_param(params: DataFrame, code: str, **names: str) -> float:
    """``param`` read as a number; bad text raises ``ValueError``."""
    value = param(params, code, **names)
    if value is None:
        raise ParameterError(f"parameter {code} has no value")
    return float(value)


def set_param(
    params: DataFrame, code: str, value: str, *, code_col: str = "param_code", value_col: str = "value"
) -> DataFrame:
    """The parameter table with a new value under ``code``."""
    return params.withColumn(
        value_col, F.when(F.col(code_col) == code, F.lit(value)).otherwise(F.col(value_col))
    )
