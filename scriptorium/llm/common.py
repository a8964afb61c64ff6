"""What the operators share: tables, the shared folder, and the word rule."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Most rows of keys that a join may broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Rows that a key must meet to be joined apart from the others.
HOT_ROWS = 1_000
#: Copies of a hot key whose values are too wide to be broadcast.
SALTS = 16
#: Rows of an Arrow batch where the session has Spark's own 10,000: rows here are whole texts.
BATCH_ROWS = 2_000
#: Bytes of text that a Python function gets at once (one longer text goes alone).
SLICE_BYTES = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only, so that the result doesn't depend on a locale or a Unicode version."""
    return F.translate(text, UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that all executors see. Only a session of one process gets a temporary one where none is set, as in tests."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        told = spark.conf.get("spark.checkpoint.dir", None)
        if told is None and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(told or tempfile.mkdtemp(prefix="scriptorium-"))
    return context._jsc.sc().getCheckpointDir().get()


def clear_staged(spark: SparkSession) -> None:
    """Deletes what the session has staged so far. Frames that weren't written out before can't be read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/staged")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(frame: DataFrame, label: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: a cut of lineage that outlives executors."""
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/staged/{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def small(keys: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks the frame for broadcast only after counting that it is small. The frame should be cheap to count (staged)."""
    return F.broadcast(keys) if keys.limit(rows + 1).count() <= rows else keys


def join_counted(rows: DataFrame, keys: DataFrame, on: list[str], count: str, how: str = "inner") -> DataFrame:
    """rows joined with keys, which are unique by on; the column count of keys says how many rows each one meets.

    Keys that meet more than HOT_ROWS are at most a HOT_ROWS-th as many as rows. They are broadcast after a count, so that no
    task gets all rows of a hot key; the other keys join by shuffle. Both frames should be cheap to read again (staged).
    """
    hot = small(staged(keys.filter(F.col(count) > HOT_ROWS), "hot-keys"))
    rest = rows.join(hot.select(*on), on, "left_anti").join(keys.filter(F.col(count) <= HOT_ROWS), on, how)
    return rows.join(hot, on).unionByName(rest)


def join_salted(rows: DataFrame, keys: DataFrame, on: str, count: str, dealt_by: str) -> DataFrame:
    """Like join_counted for keys with wide values: only the names of hot keys are broadcast; the keys are copied SALTS times and meet their rows in as many parts."""
    hot = small(staged(keys.filter(F.col(count) > HOT_ROWS).select(on, F.lit(True).alias("_hot")), "hot-keys"))
    salted = rows.join(hot, on, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(dealt_by), F.lit(SALTS)).cast("int")).otherwise(0)).drop("_hot")
    copies = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(F.col(count) > HOT_ROWS, SALTS - 1).otherwise(0))))
    return salted.join(copies, [on, "_salt"]).drop("_salt")


def bounded_batches(spark: SparkSession) -> None:
    """Lets Arrow batches of texts stay small unless the session was told a size."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def text_slices(batch, column: int):
    """An Arrow batch in parts of about SLICE_BYTES of a column of texts (or lists of numbers), so that Python never holds a whole batch of objects."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lengths = pc.list_value_length if pa.types.is_list(batch.column(column).type) else pc.binary_length
    size = pc.fill_null(lengths(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
    for at, end in zip(cuts, cuts[1:]):
        if end > at:
            yield batch.slice(at, end - at)


def map_texts(frame: DataFrame, id_col: str, text_col: str, schema: str, function) -> DataFrame:
    """Applies function(list of texts) -> dict of columns to slices of Arrow batches; the id goes through untouched.

    The columns that function returns, and their types, are those of schema (a DDL string without the id).
    """
    import pyarrow as pa
    from pyspark.sql.types import StructField, StructType

    bounded_batches(frame.sparkSession)
    id_type = frame.schema[id_col].dataType
    own = StructType.fromDDL(schema)
    names = own.fieldNames()

    def batches(source):
        for batch in source:
            for part in text_slices(batch, 1):
                found = function(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *(_arrow(pa, found[n], own[n].dataType.simpleString()) for n in names)], names=["doc_id", *names])

    out = StructType([StructField("doc_id", id_type), *own.fields])
    return frame.select(F.col(id_col), F.col(text_col)).mapInArrow(batches, out)


def _arrow(pa, values, kind):
    types = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "int": pa.int32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    types["array<struct<kind:string,start:bigint,end:bigint>>"] = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return pa.array(values, types[kind])
