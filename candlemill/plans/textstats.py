"""Line and word statistics of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lines_with(lines: DataFrame, parts: Sequence[str], column: str = "value") -> DataFrame:
    """How many lines contain each part, all in one scan: one row, one column per part."""
    return lines.agg(*[F.count_if(F.contains(F.col(column), F.lit(part))).alias(part) for part in parts])


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(word, n)``; words are what single blanks separate, empty ones included."""
    words = lines.select(F.explode(F.split(column, " ")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))
