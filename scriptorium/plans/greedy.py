"""The sequential plan of chunks for renderers: candidates come from joins over all tasks, and a cell's turns are played over the beginnings of its lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import new_folder, saved
from .assignment import SPLITS
from .numbering import numbered_within

#: Chunks of each renderer that a cell looks at first, as a multiple of a renderer's share of the quota, and at least; doubled while they don't do.
FIRST_LOOK, LEAST_LOOK = 2, 16
SCRIPTS = ("uchen", "ume")
TAKES = "cell long, renderer string, chunk string, split string, reused boolean, nth long"


def cells_of(quotas: DataFrame) -> DataFrame:
    """quotas with cell: their turn, by category, split and script. Cells are the few combinations of these."""
    at = lambda c, names: F.array_position(F.array(*map(F.lit, names)), F.col(c))
    order = Window.orderBy("category", at("split", SPLITS), at("script", SCRIPTS))
    return quotas.select("category", "script", "split", "quota", F.row_number().over(order).cast("long").alias("cell"))


def greedy_plan(renderers: DataFrame, pairs: DataFrame, quotas: DataFrame, reusable: int, seed: int = 0) -> DataFrame:
    """renderer, chunk, category, script, split, difficulty, reused, place: what a sequential pass over cells, turns and renderers takes, row by row.

    renderers: renderer, category, script, split (one row each). pairs: renderer, chunk, difficulty of each renderer that supports all of a
    chunk. quotas: category, script, split, quota. The pass goes through the cells by category, split and script; in a cell its renderers, in a seeded order, take one
    chunk a turn until the quota is full or none can. A renderer takes the hardest chunk (then the first) that nobody has; if there is none, the
    hardest that its split owns and it hasn't used, as long as that one is reused already or fewer than reusable chunks are. The first to take a chunk makes
    it its split's. place numbers the takes in that order, from 1.

    Each cell depends on those before, so there is a job for each. It drops what others own from the lists of its renderers, which are sorted over all tasks once,
    and the turns are then played in one task over the beginnings of these lists: a few times as many rows as the cell's quota, however many pairs there
    are. Should a list's beginning not be enough for its renderer, the cell is played again with twice as long ones. Null keys and cells without a quota take no part.
    """
    spark = renderers.sparkSession
    cells = saved(cells_of(quotas.filter("quota > 0")))
    order = Window.partitionBy("cell").orderBy(F.sha1(F.concat_ws(":", F.lit(str(seed)), F.col("renderer").cast("string"))), "renderer")
    fonts = renderers.select("renderer", "category", "script", "split").dropna().join(F.broadcast(cells), ["category", "script", "split"])  # a few hundred cells at most
    fonts = saved(fonts.withColumns({"no": F.row_number().over(order), "many": F.count("*").over(Window.partitionBy("cell"))}))
    unique = pairs.select("renderer", "chunk", "difficulty").dropna().groupBy("renderer", "chunk").agg(F.max("difficulty").alias("difficulty"))
    listed = numbered_within(unique.join(fonts.select("renderer"), "renderer"), ["renderer"], [F.desc("difficulty"), "chunk"], "pos")
    listed = listed.join(fonts.select("renderer", "cell", "no", "split"), "renderer").withColumns({"id": F.col("renderer").cast("string"), "key": F.col("chunk").cast("string")})
    path = new_folder(spark, "lists")
    listed.repartition("cell").write.partitionBy("cell").parquet(path)
    lists = spark.read.parquet(path)
    done = new_folder(spark, "takes")
    spark.createDataFrame([], TAKES).write.parquet(done)
    for row in fonts.groupBy("cell", "split").agg(F.first("quota").alias("quota"), F.first("many").alias("many")).orderBy("cell").collect():
        look = max(LEAST_LOOK, -(-row["quota"] // row["many"]) * FIRST_LOOK)
        takes = spark.read.schema(TAKES).parquet(done)
        owned = takes.groupBy(F.col("chunk").alias("key")).agg(F.first("split").alias("owner"), (F.count("*") > 1).alias("shared"))
        room = reusable - owned.filter("shared").count()
        rows = lists.filter(F.col("cell") == row["cell"]).select("id", "no", "pos", "key").join(owned, "key", "left")
        # what another split owns is out for good
        rows = saved(rows.filter(F.col("owner").isNull() | (F.col("owner") == row["split"])).select("id", "no", "pos", "key", F.col("owner").isNull().alias("free"), F.coalesce("shared", F.lit(False)).alias("shared")))
        while True:
            played = saved(_looked_at(rows, look).withColumn("cell", F.lit(row["cell"])).groupBy("cell").applyInPandas(_player(row["cell"], row["split"], row["quota"], room), TAKES))
            if played.filter("renderer is null").isEmpty():
                break
            look *= 2
        played.write.mode("append").parquet(done)
    takes = numbered_within(spark.read.schema(TAKES).parquet(done), [], ["cell", "nth"]).select(F.col("renderer").alias("id"), F.col("chunk").alias("key"), "reused", "place")
    told = takes.join(lists.select("id", "key", "renderer", "chunk", "difficulty"), ["id", "key"]).join(fonts.select("renderer", "category", "script", "split"), "renderer")
    return told.select("renderer", "chunk", "category", "script", "split", "difficulty", "reused", "place")


def _looked_at(rows: DataFrame, look: int) -> DataFrame:
    """The first look free and the first look owned chunks of each renderer, with more: whether there are further ones of that kind."""
    along = Window.partitionBy("id", "free").orderBy("pos")
    return rows.withColumns({"_n": F.row_number().over(along), "more": F.count("*").over(Window.partitionBy("id", "free")) > look}).filter(F.col("_n") <= look).drop("_n")


def _player(cell: int, split: str, quota: int, room: int):
    """Plays a cell's turns over the looked-at rows; a row without a renderer says that they weren't enough."""
    import pandas as pd

    def play(rows):
        rows = rows.sort_values(["no", "pos"])
        lists, more = {}, set()
        for no, i, key, free, shared, further in zip(rows["no"], rows["id"], rows["key"], rows["free"], rows["shared"], rows["more"]):
            lists.setdefault(no, (i, [], []))[1 if free else 2].append((key, shared))
            if further:
                more.add((no, free))
        whole = {}  # all of a renderer's looked-at chunks in order, from when it comes to reuse
        for no, _, key in zip(rows["no"], rows["pos"], rows["key"]):
            whole.setdefault(no, []).append(key)
        known = {key for _, _, own in lists.values() for key, shared in own if shared}
        taken, used, new, out = set(), set(), set(), []
        fresh_at, again_at = dict.fromkeys(lists, 0), dict.fromkeys(lists, 0)

        def next_of(no):
            fresh, at = lists[no][1], fresh_at[no]
            while at < len(fresh) and fresh[at][0] in taken:
                at += 1
            fresh_at[no] = at
            if at < len(fresh):
                return fresh[at][0], False
            if (no, True) in more:
                return None, None
            keys, at = whole[no], again_at[no]
            while at < len(keys) and ((no, keys[at]) in used or not (keys[at] in known or keys[at] in new or len(new) < room)):
                at += 1
            again_at[no] = at
            if at == len(keys):
                return (None, None) if (no, False) in more else (None, False)
            return keys[at], True

        moved = True
        while moved and len(out) < quota:
            moved = False
            for no in lists:
                if len(out) >= quota:
                    break
                key, again = next_of(no)
                if again is None:
                    return pd.DataFrame([(cell, None, None, split, False, 0)], columns=["cell", "renderer", "chunk", "split", "reused", "nth"])
                if key is None:
                    continue
                taken.add(key)
                used.add((no, key))
                if again and key not in known:
                    new.add(key)
                out.append((cell, lists[no][0], key, split, again, len(out)))
                moved = True
        return pd.DataFrame(out, columns=["cell", "renderer", "chunk", "split", "reused", "nth"])

    return play
