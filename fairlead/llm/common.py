"""Expressions and tables that the text operators share.

Every operator first selects the columns it is told to read, so further
columns, whatever their names, neither clash nor travel along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: the white space that separates words and pads lines ---
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
# --- End of fixed values ---


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: Column) -> Column:
    """Words of a text in order; none for a null text."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_CLASS + "+")).otherwise(
        F.array().cast("array<string>")
    )


def row_hash(text: Column) -> Column:
    """Tells rows apart that share an id; equal rows stay equal."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    An expression that a lambda refers to is otherwise computed again for
    every element the lambda runs over.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
