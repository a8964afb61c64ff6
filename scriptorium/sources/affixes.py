"""Readers of a spelling dictionary: its suffix rules and its stems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ordered import lines


def _flags(text: F.Column) -> F.Column:
    """Sorted distinct one-letter flags."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: c != "")))


def suffix_rules(spark: SparkSession, path: str) -> DataFrame:
    """flag, strip, add, flags, condition of the lines SFX flag strip add/flags condition; 0 is nothing, and a condition is a pattern for a word's end.

    Heads of classes (SFX flag Y count), other lines and comments are skipped. A missing condition always holds.
    """
    parts = F.split(F.trim("value"), "\\s+")
    at = lambda i: F.get(parts, F.lit(i))
    rules = lines(spark, path).filter((at(0) == "SFX") & (F.size(parts) >= 4) & ~(at(2).isin("Y", "N") & at(3).rlike("^[0-9]+$") & (F.size(parts) == 4)))
    added = F.split(at(3), "/")
    nothing = lambda c: F.when(c == "0", "").otherwise(c)
    return rules.select(at(1).alias("flag"), nothing(at(2)).alias("strip"), nothing(F.get(added, F.lit(0))).alias("add"), _flags(F.get(added, F.lit(1))).alias("flags"), F.concat(F.coalesce(at(4), F.lit(".")), F.lit("$")).alias("condition"))


def dictionary_stems(spark: SparkSession, path: str) -> DataFrame:
    """word and flags of the lines stem/flags; the first line of a file may be their count."""
    read = lines(spark, path).filter(~((F.col("line") == 0) & F.col("value").rlike("^[0-9]+$")) & (F.trim("value") != ""))
    parts = F.split(F.trim("value"), "/")
    return read.select(F.get(parts, F.lit(0)).alias("word"), _flags(F.get(parts, F.lit(1))).alias("flags"))
