"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, join_counted, small, staged


def _grouped(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int, digest: bool) -> DataFrame:
    """doc_id, text_key (hash of the text as it is), keep_id, group_size, kept, text_sha256 (null where no hash was needed)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.octet_length(text).alias("bytes"))
    lengths = staged(rows.groupBy("bytes").count().filter("count > 1").select("bytes", F.lit(True).alias("long_ok")), "dedup-lengths")
    prefix = F.xxhash64(ascii_lower(F.substring("text", 1, prefix_chars)))
    by_length = rows.join(small(lengths), "bytes", "left").withColumn("prefix", F.when(F.col("long_ok"), prefix))
    shared = by_length.filter("long_ok").groupBy("bytes", "prefix").count().filter("count > 1")
    prefixes = staged(shared.select("bytes", "prefix", F.lit(True).alias("prefix_ok")), "dedup-prefixes")
    by_prefix = by_length.join(small(prefixes), ["bytes", "prefix"], "left")
    full = F.sha2(ascii_lower(F.col("text")), 256)
    hashed = by_prefix.select("doc_id", F.xxhash64("text").alias("text_key"), "prefix_ok", (full if digest else F.when(F.col("prefix_ok"), full)).alias("text_sha256"))
    hashed = staged(hashed, "dedup-hashes")
    groups = hashed.filter("prefix_ok").groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1")
    members = hashed.filter("prefix_ok").select("doc_id", "text_key", "text_sha256")
    found = join_counted(members, staged(groups, "dedup-groups"), ["text_sha256"], "group_size", "left")
    alone = hashed.filter("prefix_ok is null").select("text_sha256", "doc_id", "text_key", F.lit(None).cast(docs.schema[id_col].dataType).alias("keep_id"), F.lit(None).cast("long").alias("group_size"))
    every = found.unionByName(alone)
    own = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    out = every.select("doc_id", "text_key", own.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 256, digest: bool = False) -> DataFrame:
    """Groups rows whose texts are identical after lower-casing A-Z; the largest id of a group stays.

    Returns one row per input row: doc_id, keep_id, group_size, kept, and text_sha256 if digest is set.
    Three narrowing passes: only lengths that two rows share go on to the prefix hash, only shared
    (length, prefix) pairs go on to the full hash, so whole texts are hashed for surviving groups only
    (the digest, if asked for, needs every text). Text never goes through a shuffle while the surviving
    keys are few enough to broadcast, which is counted; beyond that they are joined by shuffle.
    All group counts combine before their shuffle, and a text that very many rows share gets its group by
    broadcast, so a group of any size is no hot task.

    Null text counts as empty; empty texts are equal. A row without an id is matched like others, but
    an id wins over none, so it is dropped where its group has an id; in a group without any id keep_id is null and all stay.
    Rows that repeat an id with the same text count in group_size and are kept or dropped together. An id that stands with
    several texts is judged text by text. An empty table gives no rows; other columns are ignored.
    """
    found = _grouped(docs, id_col, text_col, prefix_chars, digest)
    return found.select("doc_id", "keep_id", "group_size", *(["text_sha256"] if digest else []), "kept")


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns; nulls, ties and repeated rows as in exact_dedup."""
    dropped = _grouped(docs, id_col, text_col, 256, False).filter(~F.col("kept")).select("doc_id", "text_key").distinct()
    dropped = small(staged(dropped, "dedup-dropped")).alias("d")
    same = docs[id_col].eqNullSafe(F.col("d.doc_id")) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col("d.text_key"))
    return docs.join(dropped, same, "left_anti")
