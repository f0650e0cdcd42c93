"""Column expressions shared by the operators that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII characters that are no letters or digits, once letters are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Characters beyond ASCII that have a lower case.
_CASED = r"[[\p{IsUppercase}\p{Lt}\p{Cn}]&&[^\x00-\x7F]]"


def ascii_lower(text: Column) -> Column:
    """The text with A-Z lower-cased and everything else as it is; null counts as empty.

    ``lower`` does the same, and faster, on texts in which no other character has a
    lower case.
    """
    text = F.coalesce(text, F.lit(""))
    same = (F.octet_length(text) == F.char_length(text)) | ~F.rlike(text, F.lit(_CASED))
    return F.when(same, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words_of(text: Column) -> Column:
    """Array of a text's words: runs of ASCII letters, digits and non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def literal_rows(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small fixed table made of literals, without any Python on the executors."""
    structs = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row, strict=True))) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")
