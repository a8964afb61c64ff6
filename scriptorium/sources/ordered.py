"""Rows of files in the order in which they stand there, files by path, although Spark reads splits in an order of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import saved


def file_path() -> F.Column:
    """The path of a row's file, decoded. Only for frames straight from a file reader."""
    return F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def in_file_order(scan: DataFrame) -> DataFrame:
    """Adds path, line (from 0 in its file) and at (from 0 over all files in path order) to the rows of a file reader.

    Splits of files are packed into tasks by their size, so the order of tasks tells nothing. But a split's rows are read in order by one task, so
    (path, byte at which the split begins, number within the task) is the order of the files. Counts of the splits, a row for each, give every
    row its number. They are broadcast, so no row is shuffled, and a large file's rows don't meet in one task. A reader that skips headers or bad lines doesn't count them. Columns path, line and at of the files themselves
    are replaced. Without files there are no rows.
    """
    own = [c for c in scan.columns if c not in ("path", "line", "at")]
    told = scan.select(*[F.col(f"`{c}`") for c in own], file_path().alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    told = saved(told)
    splits = told.groupBy("path", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.unboundedPreceding, -1
    in_file = F.sum("_n").over(Window.partitionBy("path").orderBy("_block").rowsBetween(*before))
    in_all = F.sum("_n").over(Window.orderBy("path", "_block").rowsBetween(*before))
    splits = splits.select("path", "_block", "_first", F.coalesce(in_file, F.lit(0)).alias("_file"), F.coalesce(in_all, F.lit(0)).alias("_all"))
    place = F.col("_id") - F.col("_first")
    return told.join(F.broadcast(splits), ["path", "_block"]).select(*[F.col(f"`{c}`") for c in own], "path", (F.col("_file") + place).alias("line"), (F.col("_all") + place).alias("at"))


def lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """value, path, line, at of every line of the files below a path."""
    reader = spark.read.option("recursiveFileLookup", True)
    return in_file_order((reader.option("pathGlobFilter", glob) if glob else reader).text(path))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def csv_union(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """Rows of all CSV files below a folder, each with its own header; columns are those of any file, null where a file lacks one. Adds path, line and at.

    Only headers come to the driver, with the paths of their files; files of one header are one scan, so the plan grows with the number of different
    headers and not with the files. Quoted line ends are part of a value. A file without a line, and a folder that is empty or missing, give no rows.
    """
    if not exists(spark, folder):
        return spark.createDataFrame([], "path string, line long, at long")
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    scan = reader.text(folder).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    first = scan.filter("block = 0").groupBy("path").agg(F.min_by("value", "id").alias("header"))
    parts = None
    for row in first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header").collect():
        part = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(row["paths"])
        part = part.withColumnRenamed(part.columns[0], part.columns[0].lstrip("﻿")) if part.columns else part
        part = part.select("*", file_path().alias("path"), F.monotonically_increasing_id().alias("_id"))
        parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
    if parts is None:
        return spark.createDataFrame([], "path string, line long, at long")
    # a file of values with line ends is one split, so its rows' ids grow in its order; ids of different scans don't meet in one file
    rows = saved(parts)
    files = rows.groupBy("path").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    line = F.col("_id") - F.col("_first")
    return rows.join(F.broadcast(files.select("path", "_first", before.alias("_before"))), "path").select(*[c for c in rows.columns if c not in ("path", "_id")], "path", line.alias("line"), (F.col("_before") + line).alias("at"))
