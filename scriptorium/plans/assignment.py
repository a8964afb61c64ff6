"""Renderers to splits, and chunks to renderers, as an ordered fold and as rounds of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import saved
from .numbering import numbered

SPLITS = ("train", "val", "test")
RATIOS = (0.8, 0.1, 0.1)
CELL = ["category", "script", "split"]
#: Parts into which a renderer's rows are dealt before its best ones are found.
SALTS = 32


def assign_splits(renderers: DataFrame, category: str, name: str, capacity: str, seed: int = 0) -> DataFrame:
    """name, split: each name gets one split, so that a category's capacity comes near to RATIOS.

    Names go by falling capacity (their largest row's), then by a seeded hash. The first ones of a category seed the splits; each
    further one goes to the split that is least full, then has the fewest names. A name in several categories has the split
    of the last one. One ordered fold per category over (name, capacity) in constant memory. Rows without a category or name
    are left out; null capacities are 0.
    """
    import pandas as pd

    best = renderers.filter(F.col(category).isNotNull() & F.col(name).isNotNull()).groupBy(F.col(category).alias("category"), F.col(name).alias("name"))
    best = best.agg(F.max(F.coalesce(F.col(capacity), F.lit(0))).cast("long").alias("capacity"))
    total = best.groupBy("category").agg(F.sum(F.greatest(F.lit(1), "capacity")).alias("total"))
    rows = best.join(total, "category").select(F.col("category").cast("string").alias("category"), "name", "capacity", "total")
    ordered = rows.repartition("category").sortWithinPartitions("category", F.desc("capacity"), F.sha1(F.concat_ws(":", F.lit(str(seed)), "name")), "name")

    def fold(frames):
        now, filled, many = None, [], []
        for pdf in frames:
            out = []
            for group, size, total in zip(pdf["category"], pdf["capacity"], pdf["total"]):
                if group != now:
                    now, filled, many = group, [0] * len(SPLITS), [0] * len(SPLITS)
                n = sum(many)
                i = n if n < len(SPLITS) else min(range(len(SPLITS)), key=lambda s: (filled[s] / max(1.0, total * RATIOS[s]), many[s]))
                filled[i] += max(1, size)
                many[i] += 1
                out.append(SPLITS[i])
            yield pd.DataFrame({"name": pdf["name"], "category": pdf["category"], "split": out})

    folded = ordered.mapInPandas(fold, f"name {rows.schema['name'].dataType.simpleString()}, category string, split string")
    return folded.groupBy("name").agg(F.max_by("split", "category").alias("split"))


def owner(chunk: Column, seed: int) -> Column:
    """The split that a chunk belongs to, by seeded hash in the proportions of RATIOS."""
    place = F.pmod(F.xxhash64(F.lit(seed), chunk), F.lit(10_000)) / 10_000
    out, upto = F.lit(SPLITS[-1]), 1.0
    for split, ratio in reversed(list(zip(SPLITS[:-1], RATIOS[:-1]))):
        upto = sum(RATIOS[: SPLITS.index(split) + 1])
        out = F.when(place < upto, split).otherwise(out)
    return out


def assign_chunks(renderers: DataFrame, pairs: DataFrame, quotas: DataFrame, reusable: int, seed: int = 0, max_rounds: int = 40) -> DataFrame:
    """renderer, chunk, category, script, split, difficulty, reused: the hardest chunks that fill each cell's quota.

    renderers: renderer, category, script, split (one row each). pairs: renderer, chunk, difficulty of each renderer that supports
    all of a chunk. quotas: category, script, split, quota. What holds of the result:

    - a chunk is used in one split only, and by one renderer only unless it is among at most reusable chunks that are reused;
    - no (renderer, chunk) occurs twice; no cell exceeds its quota; a cell's quota is dealt evenly over its renderers while they last;
    - a cell stays short only if none of its renderers supports a further chunk that may be used.

    A sequential greedy would pass all pairs through one task. Here each round is a join: every open chunk picks one of the renderers
    that still need one, and each renderer keeps the hardest of those that picked it, up to its need. So the pairs differ from those
    of a sequential pass, and a chunk's split comes from its hash rather than from its first use. Rounds end when no
    chunk finds a renderer in need; each is saved in the shared folder. Nothing but cells and renderers is windowed whole.
    """
    fonts = renderers.select("renderer", *CELL)
    edges = pairs.select("renderer", "chunk", "difficulty").dropna().dropDuplicates(["renderer", "chunk"]).join(fonts, "renderer")
    edges = saved(edges.filter(owner(F.col("chunk"), seed) == F.col("split")))
    taken = edges.limit(0).withColumn("reused", F.lit(False))
    for reused in (False, True):
        if reused:
            used = numbered(taken.select("chunk"), "chunk", seed).filter(F.col("number") < reusable)
            edges = saved(edges.join(used.select("chunk"), "chunk", "left_semi"))
        for turn in range(max_rounds):
            free = edges.join(taken.select(*(["renderer"] if reused else []), "chunk"), ["renderer", "chunk"] if reused else ["chunk"], "left_anti")
            need = _needs(free, quotas, taken, seed + turn)
            wanted = free.join(need, "renderer")
            if not reused:
                pick = F.min_by(F.struct(*wanted.columns), F.struct(F.xxhash64(F.lit(seed + turn), "renderer", "chunk"), "renderer"))
                wanted = wanted.groupBy(F.col("chunk").alias("of")).agg(pick.alias("x")).select("x.*")
            given = saved(_hardest(wanted).select("renderer", "chunk", "difficulty", *CELL, F.lit(reused).alias("reused")))
            if given.isEmpty():
                break
            taken = taken.unionByName(given)
        else:
            raise RuntimeError("the assignment did not end")
    return taken


def _needs(free: DataFrame, quotas: DataFrame, taken: DataFrame, seed: int) -> DataFrame:
    """renderer, need: what is left of each cell's quota, dealt evenly over the renderers that have a chunk left."""
    got = taken.groupBy(*CELL).agg(F.count("*").alias("got"))
    rest = quotas.join(got, CELL, "left").select(*CELL, (F.col("quota") - F.coalesce("got", F.lit(0))).alias("rest")).filter("rest > 0")
    active = free.select("renderer", *CELL).distinct().join(rest, CELL)
    cell = Window.partitionBy(*CELL)
    place = F.row_number().over(cell.orderBy(F.xxhash64(F.lit(seed), "renderer"), "renderer"))
    many = F.count("*").over(cell)
    need = F.floor(F.col("rest") / many) + F.when(place <= F.col("rest") % many, 1).otherwise(0)
    return active.select("renderer", need.alias("need")).filter("need > 0")


def _hardest(rows: DataFrame) -> DataFrame:
    """Of each renderer the need hardest rows: first within salted parts, so that no task sorts all rows of one."""
    order = (F.desc("difficulty"), "chunk")
    salt = F.pmod(F.xxhash64("chunk"), F.lit(SALTS))
    part = rows.withColumn("salt", salt).withColumn("place", F.row_number().over(Window.partitionBy("renderer", "salt").orderBy(*order))).filter("place <= need")
    return part.withColumn("place", F.row_number().over(Window.partitionBy("renderer").orderBy(*order))).filter("place <= need")
