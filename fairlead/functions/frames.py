"""Helpers on whole frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluated(df: DataFrame) -> DataFrame:
    """``df`` with every column computed once per row.

    The generator of one row each keeps the optimizer from copying the formulas
    of a column into every column and predicate that uses it.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
