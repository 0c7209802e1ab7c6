"""Joins of texts with the patterns that they contain, by equi-joins of windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windows(text: Column, width: Column) -> Column:
    """All different substrings of ``width`` characters."""
    last = F.length(text) - width + 1
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, width)))).otherwise(F.array().cast("array<string>"))


def containing(df: DataFrame, texts: Column, patterns: DataFrame, pattern: str) -> DataFrame:
    """Rows of ``df`` with each row of ``patterns`` whose column ``pattern`` is within one of the row's ``texts`` (an array).

    Windows of the shortest pattern's length (a sub-query of the plan) meet the patterns that begin
    with them; what they meet is looked for in full. A pair is given once, however often the texts hold the pattern.
    """
    width = patterns.select(F.min(F.length(pattern))).scalar()
    begun = patterns.withColumn("_window", F.substring(F.col(pattern), F.lit(1), width))
    cut = df.withColumns({"_texts": texts, "_width": width})
    cut = cut.withColumn("_window", F.explode(F.array_distinct(F.flatten(F.transform("_texts", lambda t: windows(t, F.col("_width")))))))
    met = cut.join(begun, "_window")
    return met.filter(F.exists("_texts", lambda t: F.contains(t, F.col(pattern)))).drop("_window", "_texts", "_width")


def text_containing(df: DataFrame, text: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """``containing`` for one text a row, the column ``text``: windows are cut where they first occur in the
    text, one row a place, so that no lists of texts are built and copied."""
    width = patterns.select(F.min(F.length(pattern))).scalar()
    begun = patterns.withColumn("_window", F.substring(F.col(pattern), F.lit(1), width))
    cut = df.withColumn("_width", width).filter(F.length(text) >= F.col("_width"))
    cut = cut.withColumn("_at", F.explode(F.sequence(F.lit(1), F.length(text) - F.col("_width") + 1)))
    cut = cut.withColumn("_window", F.substring(F.col(text), F.col("_at"), F.col("_width"))).filter(F.instr(F.col(text), F.col("_window")) == F.col("_at"))
    return cut.join(begun, "_window").filter(F.contains(F.col(text), F.col(pattern))).drop("_window", "_at", "_width")
