"""Frequency, rarity and difficulty of orthographic units."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import LATIN, Profile, tokens


def exploded(docs: DataFrame, p: Profile = LATIN) -> DataFrame:
    return docs.select("doc_id", F.explode(tokens(F.col("text"), p)).alias("token"))


def frequency(docs: DataFrame, p: Profile = LATIN) -> DataFrame:
    return exploded(docs, p).groupBy("token").agg(F.count("*").alias("n"))


def rarity(freq: DataFrame) -> DataFrame:
    """Self-information of each token, clipped between the order statistics at 5 % and 95 % and scaled to [0, 1].

    The two order statistics are exact and come from the histogram of counts, whose size is the number of different counts.
    """
    total = freq.agg(F.sum("n").alias("total"))
    info = freq.crossJoin(F.broadcast(total)).select("token", "n", (-F.log(F.col("n") / F.col("total"))).alias("info"))
    by_info = info.groupBy("info").agg(F.count("*").alias("k"))
    upto = Window.orderBy("info").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = by_info.select("info", F.sum("k").over(upto).alias("upto"), F.sum("k").over(Window.partitionBy(F.lit(1))).alias("m"))
    at = lambda q: F.min(F.when(F.col("upto") > F.floor(F.lit(q) * (F.col("m") - 1)), F.col("info")))
    bounds = ranks.agg(at(0.05).alias("low"), at(0.95).alias("high"))
    scaled = (F.col("info") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
    return info.crossJoin(F.broadcast(bounds)).select("token", "n", F.coalesce(F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)), F.lit(0.0)).alias("rarity"))


def counted(docs: DataFrame, p: Profile = LATIN) -> DataFrame:
    """doc_id, token, k: how often each row's text has each token; rows that repeat an id are summed."""
    return exploded(docs, p).groupBy("doc_id", "token").agg(F.count("*").alias("k"))


def difficulty(docs: DataFrame, rare: DataFrame, p: Profile = LATIN, top: int = 10, limit: float = 0.8, counts: DataFrame | None = None, empty: float = 0.0) -> DataFrame:
    """0.5 mean of the top rarities, 0.3 share of rare tokens, 0.2 share of rare distinct tokens; unknown tokens count 1.

    Tokens are counted per document before the join, so a common token meets its rarity once a document; from there on only numbers are shuffled, one row for
    each rarity that a document has. counts: what counted gives of docs, where it is known already. empty: the score of a text without tokens.
    """
    known = (counted(docs, p) if counts is None else counts).join(rare.select("token", "rarity"), "token", "left").select("doc_id", F.coalesce("rarity", F.lit(1.0)).alias("rarity"), "k")
    known = known.groupBy("doc_id", "rarity").agg(F.sum("k").alias("k"), F.count("*").alias("kinds"))
    high = F.col("rarity") >= limit
    order = Window.partitionBy("doc_id").orderBy(F.desc("rarity")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = known.withColumn("upto", F.sum("k").over(order))
    used = F.greatest(F.lit(0), F.least(F.col("k"), top - (F.col("upto") - F.col("k"))))
    sums = placed.groupBy("doc_id").agg(
        (F.sum(F.col("rarity") * used) / F.sum(used)).alias("peak"),
        (F.sum(F.when(high, F.col("k")).otherwise(0)) / F.sum("k")).alias("share"),
        (F.sum(F.when(high, F.col("kinds")).otherwise(0)) / F.sum("kinds")).alias("kinds"),
    )
    score = F.least(F.lit(1.0), 0.5 * F.col("peak") + 0.3 * F.col("share") + 0.2 * F.col("kinds"))
    return docs.select("doc_id").join(sums, "doc_id", "left").select("doc_id", F.when(F.col("peak").isNull(), empty).otherwise(score).alias("difficulty"))


def token_stats(docs: DataFrame, p: Profile = LATIN) -> DataFrame:
    t = tokens(F.col("text"), p)
    return docs.select("doc_id", F.size(t).cast("long").alias("token_count"), F.size(F.array_distinct(t)).cast("long").alias("unique_count"), F.array_join(F.array_sort(F.array_distinct(t)), " ").alias("tokens"))


def with_membership(units: DataFrame, valid: DataFrame, on: str = "token") -> DataFrame:
    """Each unit with 1 if it is among the valid ones, else 0."""
    marked = valid.select(on).distinct().withColumn("hit", F.lit(1))
    return units.join(marked, on, "left").withColumn("is_valid", F.coalesce("hit", F.lit(0))).drop("hit")
