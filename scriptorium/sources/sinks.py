"""Writers: Parquet in zstd, CSV, and the markdown catalog."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import fragment_name
from ..plans.numbering import numbered_within


def write_parquet(rows: DataFrame, path: str, by: list[str] | None = None, rows_per_file: int = 0) -> None:
    writer = rows.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """One header per file; without rows, files without a header. Files appear when the job commits, so a reader sees all or none."""
    rows.write.option("header", True).csv(path)


def write_union(frames: list[DataFrame], path: str) -> None:
    """All rows with the columns of any frame."""
    write_csv(union_all(frames), path)


def _moved(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder or file; what was at the target goes first."""
    at, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(to.getParent())
    files.delete(to, True)
    if not files.rename(at, to):
        raise OSError(f"{source} was not moved to {target}")


def _children(spark: SparkSession, path: str) -> list[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return sorted(s.getPath().getName() for s in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at))


def commit_fragments(rows: DataFrame, folder: str, batch: str, order: list[str], listed: str = "source_plan_image_ids") -> list[str]:
    """Writes the rows of each batch as a checkpoint of its own below folder and returns their names: the batch and a digest of its plan ids.

    All batches are one job, which writes beside the folder; each checkpoint then appears by one rename, so that a reader sees a batch whole or
    not at all, and a run that stops in between leaves only names that begin with an underscore, which readers skip. A batch that is committed
    again replaces itself. Each task writes a range of a batch's order, so a large batch is several files, whose names sort as their rows do. A batch with rows has at least
    one; the columns are those of rows.
    """
    spark = rows.sparkSession
    ids = rows.select(batch, F.explode(F.transform(F.split(listed, "\\|"), lambda x: F.trim(x))).alias("_id")).filter("_id <> ''")
    named = rows.select(batch).distinct().join(ids.groupBy(batch).agg(F.collect_set("_id").alias("_ids")), batch, "left")
    name = F.regexp_replace(fragment_name(F.col(batch).cast("string"), F.coalesce("_ids", F.array().cast("array<string>"))), "[.]csv$", "")
    staging = f"{folder}/_{uuid.uuid4().hex}"
    told = rows.join(named.select(batch, name.alias("_name")), batch)
    told.repartitionByRange("_name", *order).sortWithinPartitions("_name", *order).write.partitionBy("_name").option("header", True).csv(staging)
    names = [n.split("=", 1)[1] for n in _children(spark, staging) if "=" in n]
    for n in names:
        _moved(spark, f"{staging}/_name={n}", f"{folder}/{n}")
    path = spark._jvm.org.apache.hadoop.fs.Path(staging)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return names


def write_ordered(rows: DataFrame, path: str, order: list, header: bool = True) -> None:
    """CSV files whose names in order, and whose lines in order, are the whole order of the rows. Each task writes a range of it."""
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.option("header", header).csv(path)


def append_jobs(jobs: list[tuple[str, DataFrame]], kind: str = "test_kind", order: str = "at") -> DataFrame:
    """The jobs one after the other as one table, with their kind and job_id, from 1, in the jobs' order and each one's own."""
    out = None
    for i, (name, rows) in enumerate(jobs):
        told = rows.withColumns({kind: F.lit(name), "_job": F.lit(i)})
        out = told if out is None else out.unionByName(told, allowMissingColumns=True)
    return numbered_within(out, [], ["_job", order]).withColumnRenamed("place", "job_id").drop("_job")


def write_shards(rows: DataFrame, path: str, split: str = "split", shard: str = "shard") -> None:
    """zstd Parquet, a folder shard=train-00000-of-00003 per split and shard. Each is written by the tasks that hold its rows."""
    many = rows.groupBy(split).agg((F.max(shard) + 1).alias("_many"))
    named = rows.join(F.broadcast(many), split)  # a row per split
    name = F.format_string("%s-%05d-of-%05d", F.col(split), F.col(shard), F.col("_many"))
    write_parquet(named.withColumn("shard", name).drop("_many"), path, ["shard"])


def write_matrix(matrix: DataFrame, path: str, key: str) -> None:
    """A wide matrix with its key first, the columns in order, in one file by key; blanks where there is no value."""
    columns = sorted(c for c in matrix.columns if c != key)
    matrix.select(key, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in columns]).orderBy(key).coalesce(1).write.option("header", True).option("emptyValue", "").csv(path)


def subset_info(rows: DataFrame, split: str = "split", shard: str = "shard") -> DataFrame:
    """One row per split: its rows, shards and bytes, for the information file beside the shards."""
    return rows.groupBy(split).agg(F.count("*").alias("rows"), F.countDistinct(shard).alias("shards"), F.sum("bytes").alias("bytes"))


def write_bundle(rows: DataFrame, folder: str, subset_id: str, about: dict, created: str, split: str = "split", shard: str = "shard", heading: str = "") -> dict:
    """A subset with its papers below folder: shards in folder/subset_id, subset_info.json and README.md beside them, and catalog.csv above; returns the info.

    Shards are written first; the papers tell what was written, so they name no shard that isn't there. about gives further entries of the info.
    Only a row for each split reaches the driver.
    """
    spark = rows.sparkSession
    root = f"{folder}/{subset_id}"
    write_shards(rows, f"{root}/data", split, shard)
    counts = {r[split]: r for r in subset_info(rows, split, shard).collect()}
    info = about | {
        "creation_date": created,
        "nb_images": sum(r["rows"] for r in counts.values()),
        "parquet_total_size": sum(r["bytes"] for r in counts.values()),
        "data_files": {s: f"{root}/data/shard={s}-*" for s in sorted(counts)},
    }
    listed = "\n".join(f"- `{s}`: {counts[s]['rows']:,} rows" for s in sorted(counts))
    write_text(spark, f"{root}/subset_info.json", json.dumps(info, ensure_ascii=False, indent=2) + "\n")
    write_text(spark, f"{root}/README.md", f"# {subset_id}\n\n{heading}\n\n## Split counts\n\n{listed}\n")
    write_text(spark, f"{folder}/catalog.csv", f"subset_id\n{subset_id}\n")
    return info


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file by way of the file system that the path names; it appears whole."""
    to = spark._jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = to.getFileSystem(spark._jsc.hadoopConfiguration()).create(to, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    _moved(spark, path + ".tmp", path)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, with the columns of any."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def markdown_rows(rows: DataFrame) -> DataFrame:
    """value: a markdown line per row of file, family, names (array, sorted and joined); bars escaped. A file without a family is an Error row."""
    safe = lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))
    names = F.when(F.col("family").isNull(), "Error").otherwise(F.array_join(F.array_sort(F.array_distinct("names")), ", "))
    return rows.select(F.concat(F.lit("| "), safe(F.col("file")), F.lit(" | "), safe(F.coalesce("family", F.lit("Error"))), F.lit(" | "), safe(names), F.lit(" |")).alias("value"))
