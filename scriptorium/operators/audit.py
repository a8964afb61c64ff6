"""Audits of support tables: filters, samples that no renderer dominates, and counts of what is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ["complex-pass", "placement-warning", "false-positive", "false-negative", "normal-fail", "disagreement", "mixed"]


def finally_ok(ok: Column, warnings: Column) -> Column:
    return F.coalesce(ok, F.lit(False)) & (F.coalesce(warnings, F.lit(0)) == 0)


def audit_filter(kind: str) -> Column:
    """The rows that an audit of a kind looks at: over test_kind, ok, placement_warning_count, subjoined_count, vowel_diacritic_count, complexity, skt_ok."""
    good = finally_ok(F.col("ok"), F.col("placement_warning_count"))
    stack, vowels = F.col("test_kind") == "stack", F.col("vowel_diacritic_count") >= 1
    rules = {
        "complex-pass": stack & good & (F.col("subjoined_count") >= 2) & vowels,
        "placement-warning": F.col("placement_warning_count") > 0,
        "false-positive": stack & good & (F.coalesce(F.col("skt_ok") == 0, F.lit(False)) | (F.col("complexity") >= 3) | vowels),
        "false-negative": ~good & (F.col("skt_ok") == 1),
        "normal-fail": (F.col("test_kind") == "normal") & ~good,
        "disagreement": stack & (good.cast("int") != F.coalesce("skt_ok", F.lit(-1))),
        "mixed": F.lit(True),
    }
    return F.coalesce(rules[kind], F.lit(False))


def audit_sample(rows: DataFrame, renderer: str, key: str, size: int, seed: int = 0) -> DataFrame:
    """At most size rows, dealt round-robin over the renderers from each one's size best by rank; all rows if they are no more.

    The rank is twice the good verdict, one for a vowel, and the complexity up to six; ties and the order within a renderer go by a seeded hash.
    The first window keeps size rows of a renderer in each of its salted parts before they meet, so no task sorts a whole renderer.
    """
    good = finally_ok(F.col("ok"), F.col("placement_warning_count")).cast("int")
    rank = 2 * good + (F.col("vowel_diacritic_count") >= 1).cast("int") + F.least(F.col("complexity"), F.lit(6))
    shuffled = F.sha1(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    ranked = rows.withColumns({"audit_rank": rank, "audit_hash": shuffled, "audit_salt": F.pmod(F.xxhash64(key), F.lit(32))})
    best = [F.desc("audit_rank"), "audit_hash"]
    for by in ([renderer, "audit_salt"], [renderer]):
        ranked = ranked.withColumn("audit_place", F.row_number().over(Window.partitionBy(*by).orderBy(*best))).filter(F.col("audit_place") <= size)
    turns = ranked.withColumn("audit_turn", F.row_number().over(Window.partitionBy(renderer).orderBy("audit_hash")))
    return turns.orderBy("audit_turn", renderer).limit(size).select(rows.columns)


def histogram(rows: DataFrame, columns: list[str], first: int | None = None, order: str | None = None) -> DataFrame:
    """measure, value, n of each column, over the first rows in order if a number of them is told."""
    seen = rows.orderBy(order).limit(first) if first else rows
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("string").alias("value")) for c in columns]))
    return seen.select(pairs.alias("x")).groupBy("x.measure", "x.value").agg(F.count("*").alias("n"))


def plan_totals(plan: DataFrame, groups: dict[str, Column], chunk: str) -> DataFrame:
    """grp, value, count: the totals of a plan, then the rows by each group. The percentage of reused chunks has four digits."""
    uses = plan.groupBy(chunk).agg(F.count("*").alias("n"))
    totals = uses.agg(F.sum("n").alias("rows"), F.count("*").alias("kinds"), F.count_if(F.col("n") > 1).alias("reused"))
    percent = F.format_string("%.4f%%", F.coalesce(100.0 * F.col("reused") / F.nullif(F.col("kinds"), F.lit(0)), F.lit(0.0)))
    named = {"total_rows": F.coalesce("rows", F.lit(0)).cast("string"), "unique_chunks": F.col("kinds").cast("string"), "reused_chunks": F.col("reused").cast("string"), "reused_chunk_percent": percent}
    head = totals.select(F.explode(F.array(*[F.struct(F.lit("summary").alias("grp"), F.lit(k).alias("value"), c.alias("count")) for k, c in named.items()])).alias("x")).select("x.*")
    pairs = F.explode(F.array(*[F.struct(F.lit(g).alias("grp"), c.cast("string").alias("value")) for g, c in groups.items()]))
    return head.unionByName(plan.select(pairs.alias("x")).groupBy("x.grp", "x.value").agg(F.count("*").cast("string").alias("count")))


def export_counts(rows: DataFrame, files: DataFrame, name: str, endings: list[str]) -> DataFrame:
    """ending, copied, missing: of the files name + ending of every row, how many are there. files: path."""
    wanted = rows.filter(F.coalesce(F.trim(name), F.lit("")) != "").select(F.explode(F.array(*map(F.lit, endings))).alias("ending"), F.trim(name).alias("base"))
    wanted = wanted.withColumn("path", F.concat("base", "ending")).join(files.select("path").distinct().withColumn("there", F.lit(True)), "path", "left")
    return wanted.groupBy("ending").agg(F.count("there").alias("copied"), F.count_if(F.col("there").isNull()).alias("missing"))
