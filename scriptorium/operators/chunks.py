"""Packing text units into page-sized chunks: a fold per document, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import LATIN, Profile, only_script, split_units, stable_id, tokens

CHUNK = "array<struct<text:string,start:bigint>>"


def pack(units: Column, target: int, least: int, most: int) -> Column:
    """array<struct<text, start>>: greedy chunks of units joined by a space.

    A chunk is closed before a unit that would take it beyond most, if it has least; and after a unit that takes it to target. The tail
    is kept if it has least. start counts kept units and their joining spaces.
    """
    zero = F.lit(0).cast("long")
    begin = F.struct(F.array().cast(CHUNK).alias("out"), F.lit("").alias("buf"), zero.alias("start"), zero.alias("at"))

    def put(out, buf, start):
        return F.concat(out, F.array(F.struct(buf.alias("text"), start.alias("start"))))

    def step(s, u):
        fresh = s["buf"] == ""
        over = ~fresh & (F.length(s["buf"]) + 1 + F.length(u) > most) & (F.length(s["buf"]) >= least)
        empty = fresh | over
        buf = F.when(empty, u).otherwise(F.concat(s["buf"], F.lit(" "), u))
        start = F.when(empty, s["at"]).otherwise(s["start"])
        out = F.when(over, put(s["out"], s["buf"], s["start"])).otherwise(s["out"])
        full = (F.length(buf) >= target) & (F.length(buf) >= least)
        return F.struct(
            F.when(full, put(out, buf, start)).otherwise(out).alias("out"),
            F.when(full, F.lit("")).otherwise(buf).alias("buf"),
            start.alias("start"),
            (s["at"] + F.length(u) + 1).cast("long").alias("at"),
        )

    return F.aggregate(units, begin, step, lambda s: F.when(F.length(s["buf"]) >= least, put(s["out"], s["buf"], s["start"])).otherwise(s["out"]))


def chunk_documents(docs: DataFrame, p: Profile = LATIN, target: int = 1300, least: int = 900, most: int = 1800, pure: bool = False) -> DataFrame:
    """chunk_id, doc_id, char_start, char_end, char_count, text of every chunk that is no table of contents.

    With pure, also stack_count, unique_stack_count and stacks (distinct ones, sorted and joined) of those chunks alone that hold nothing but the script and spaces, and
    at least one stack.
    """
    packed = docs.select("doc_id", F.explode(pack(split_units(F.col("text"), p), target, least, most)).alias("c"))
    rows = packed.select("doc_id", F.col("c.start").alias("char_start"), F.col("c.text").alias("text"))
    rows = rows.filter(~F.col("text").contains(p.toc)).withColumn("char_count", F.length("text").cast("long"))
    more = []
    if pure:
        rows = rows.filter(only_script(F.col("text"), p, spaces=True)).withColumn("_found", tokens(F.col("text"), p)).filter(F.size("_found") > 0)
        kinds = F.array_sort(F.array_distinct("_found"))
        more = [F.size("_found").cast("long").alias("stack_count"), F.size(kinds).cast("long").alias("unique_stack_count"), F.array_join(kinds, " ").alias("stacks")]
    return rows.select(stable_id(F.col("doc_id"), F.col("char_start"), F.col("text")).alias("chunk_id"), "doc_id", "char_start", (F.col("char_start") + F.col("char_count")).alias("char_end"), "char_count", "text", *more)
