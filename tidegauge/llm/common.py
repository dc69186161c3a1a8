"""Column expressions and row identity shared by the training-data operators.

A document is identified by its id together with a hash of its text: rows that agree in both are
one document and get the same result, and a null id is an id like any other. Operators keep the
input row in one struct column, so no column name of the input can clash with theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as text and as a regular-expression class (fixed values).
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
#: What separates alphanumeric words before lower-casing (fixed values).
NON_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blank_words(text: Column) -> Column:
    """The words of ``[^\\x20\\x09-\\x0D]+``; none for null."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), BLANK_CLASS + "+", " ")
    return F.array_remove(F.split(spaced, " "), "")


def alnum_words(text: Column) -> Column:
    """Words between ASCII characters that are no letter or digit, case kept; none for null."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), NON_WORD, " ")
    return F.array_remove(F.split(spaced, " "), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; slow on whole texts, meant for short strings."""
    return F.translate(text, UPPER, LOWER)


def text_hash(text: Column) -> Column:
    """Null texts hash apart from empty ones."""
    return F.xxhash64(text, text.isNull())


def same_document(left: DataFrame, right: DataFrame, id_left: str, id_right: str, hash_left: str, hash_right: str) -> Column:
    return left[id_left].eqNullSafe(right[id_right]) & (left[hash_left] == right[hash_right])


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than needed to tell."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df
