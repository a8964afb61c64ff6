"""Characters of a corpus with their names and classes, and what they say about stacks."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Classes of the block by Java's character classes; fixed values.
CLASSES = {
    "base": "\\u0F40-\\u0F6C",
    "subjoined": "\\u0F90-\\u0FBC",
    "vowel_diacritic": "\\u0F71-\\u0F84\\u0F86\\u0F87\\u0FC6",
    "bottom_vowel": "\\u0F71\\u0F73-\\u0F77\\u0F80\\u0F81",
}


def characters(text: Column) -> Column:
    """array of struct at, character: the code points of a text in order. An empty text has none."""
    parts = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))
    return F.transform(parts, lambda c, i: F.struct(i.alias("at"), c.alias("character")))


def character_table(rows: DataFrame, text: str, classes: dict[str, str] = CLASSES) -> DataFrame:
    """character, codepoint, name, combining and a flag is_<class> of every distinct character of the texts.

    It has at most as many rows as Unicode has code points (1,114,112), whatever the corpus. Characters without a name are UNKNOWN. Null texts have no characters.
    """
    used = rows.select(F.explode(characters(F.col(text))["character"]).alias("character")).distinct()

    def named(batches: Iterator) -> Iterator:
        for pdf in batches:
            pdf["codepoint"] = [f"U+{ord(c):04X}" for c in pdf["character"]]
            pdf["name"] = [unicodedata.name(c, "UNKNOWN") for c in pdf["character"]]
            pdf["combining"] = [unicodedata.combining(c) for c in pdf["character"]]
            yield pdf

    told = used.mapInPandas(named, "character string, codepoint string, name string, combining int")
    return told.select("*", *[F.col("character").rlike(f"[{pattern}]").alias(f"is_{name}") for name, pattern in classes.items()])


def stack_table(rows: DataFrame, stack: str) -> DataFrame:
    """One row for each distinct stack: its occurrences, code points, names, counts by class, combining characters and complexity.

    Names are looked up once for each distinct character and joined by the stack's exploded characters, which is counted by stack and not by row. An empty stack has counts of 0 and
    empty lists; null is no stack. Other columns are ignored.
    """
    stacks = rows.filter(F.col(stack).isNotNull()).groupBy(F.col(stack).alias("stack")).agg(F.count("*").alias("occurrences"))
    table = character_table(stacks, "stack")
    points = stacks.select("*", F.inline_outer(characters(F.col("stack")))).join(table, "character", "left")
    many = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    in_order = F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "codepoint", "name"))))
    counted = points.groupBy("stack", "occurrences").agg(
        F.count("at").alias("stack_len"),
        in_order.alias("points"),
        many(F.col("is_base")).alias("base_count"),
        many(F.col("is_subjoined")).alias("subjoined_count"),
        many(F.col("is_vowel_diacritic")).alias("vowel_diacritic_count"),
        many(F.col("combining") > 0).alias("combining_count"),
        (many(F.col("is_bottom_vowel")) > 0).alias("has_bottom_vowel"),
    )
    return counted.select(
        "stack",
        "occurrences",
        "stack_len",
        F.array_join("points.codepoint", " ").alias("codepoints"),
        F.array_join("points.name", " | ").alias("unicode_names"),
        "base_count",
        "subjoined_count",
        "vowel_diacritic_count",
        "combining_count",
        (F.col("subjoined_count") > 0).alias("has_subjoined"),
        (F.col("vowel_diacritic_count") > 0).alias("has_vowel_diacritic"),
        "has_bottom_vowel",
        (F.col("subjoined_count") + F.col("vowel_diacritic_count") + F.greatest(F.lit(0), F.col("base_count") - 1)).alias("complexity"),
    )
