"""Readers of the tables that the pipelines take in, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import TIBETAN, Profile, only_script, parse_int_strict
from .ordered import csv_union, in_file_order, lines

FONT_COLUMNS = ["basename", "font_path", "ttc_face_index", "ps_name", "other_names", "font_size_pt", "dpi", "skt_ok"]


def font_csv(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """Fonts with a basename and a path; 24 pt and 300 dpi where blank; skt_ok 0, 1 or null. With a folder, font_path is as resolved in it."""
    raw = spark.read.option("header", True).csv(path)
    raw = raw.withColumnRenamed(raw.columns[0], raw.columns[0].lstrip("\ufeff")) if raw.columns else raw
    cell = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) if c in raw.columns else F.lit("")
    number = lambda c, d: F.when(cell(c) == "", F.lit(d)).otherwise(cell(c).try_cast("double"))
    kept = raw.filter((cell("basename") != "") & (cell("font_path") != ""))
    return kept.select(
        cell("basename").alias("basename"),
        (cell("font_path") if folder is None else resolved(cell("font_path"), folder)).alias("font_path"),
        parse_int_strict(cell("ttc_face_index")).alias("ttc_face_index"),
        *[cell(c).alias(c) for c in FONT_COLUMNS[3:5]],
        number("font_size_pt", 24.0).alias("font_size_pt"),
        parse_int_strict(cell("dpi"), 300).alias("dpi"),
        F.when(cell("skt_ok").isin("0", "1"), cell("skt_ok").cast("int")).alias("skt_ok"),
    )


def resolved(path: Column, folder: str) -> Column:
    """A path as it is if absolute, else below the folder."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(folder.rstrip("/") + "/"), path))


def first_existing(rows: DataFrame, key: str, candidates: list[Column], files: DataFrame, name: str = "found") -> DataFrame:
    """Adds the first of the candidate paths that is among the files (column path), null where none is. key is unique."""
    each = rows.select(key, F.posexplode(F.array(*candidates)).alias("_at", "path")).join(files.select("path").distinct(), "path")
    best = each.groupBy(key).agg(F.min_by("path", "_at").alias(name))
    return rows.join(best, key, "left")


def _first_of(lines: DataFrame, value: str, limit: int | None) -> DataFrame:
    """The first of equal values by at, in order; the limit counts distinct ones."""
    whole = F.struct(*[c for c in lines.columns if c != value])
    kept = lines.groupBy(value).agg(F.min_by(whole, "at").alias("x")).select(value, "x.*").orderBy("at")
    return (kept.limit(limit) if limit is not None else kept).drop("at")


def stack_list(spark: SparkSession, path: str, limit: int | None = None, p: Profile = TIBETAN) -> DataFrame:
    """stack, is_standard, n: lines of the script only, the first of equal ones, in the file's order; the limit counts distinct ones."""
    read = lines(spark, path).select(F.trim("value").alias("stack"), "at")
    return _first_of(read.filter(only_script(F.col("stack"), p)), "stack", limit).withColumns({"is_standard": F.lit(1), "n": F.lit(0).cast("long")})


def stack_csv(spark: SparkSession, path: str, limit: int | None = None, p: Profile = TIBETAN) -> DataFrame:
    """stack, is_standard, n of a frequency table with a column stack (else an error): a missing or empty hunspell_bo is 1, anything but 1 is 0.

    The column of counts is read under both spellings in use.
    """
    raw = in_file_order(spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    if "stack" not in raw.columns:
        raise ValueError(f"{path} has no column stack, but {raw.columns}")
    given = F.coalesce(F.nullif(F.col("hunspell_bo"), F.lit("")), F.lit("1")) if "hunspell_bo" in raw.columns else F.lit("1")
    counts = [F.col(c) for c in ("nb_occurences", "nb_occurrences") if c in raw.columns]
    number = parse_int_strict(F.coalesce(*counts, F.lit("0")))
    rows = raw.select(F.trim("stack").alias("stack"), F.when(F.trim(given) == "1", 1).otherwise(0).alias("is_standard"), number.alias("n"), "at")
    return _first_of(rows.filter(only_script(F.col("stack"), p)), "stack", limit)


def stacks(spark: SparkSession, path: str, limit: int | None = None, p: Profile = TIBETAN) -> DataFrame:
    """A frequency table if the name ends in .csv, else a list of lines."""
    return (stack_csv if path.lower().endswith(".csv") else stack_list)(spark, path, limit, p)


def probe_lines(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Lines that are neither blank nor comments, in the file's order."""
    read = lines(spark, path).select(F.trim("value").alias("probe"), "at").filter((F.col("probe") != "") & ~F.col("probe").startswith("#"))
    return (read.orderBy("at").limit(limit) if limit is not None else read).drop("at")


#: The texts by which ordinary fonts are tried, of the script and of Latin digits.
NORMAL_PROBES = [
    "ཀ", "ཁ", "ག", "ང", "ཅ", "ཉ", "ཏ", "ད", "ན", "པ", "བ", "མ",
    "ཙ", "ཚ", "ཛ", "ཝ", "ཞ", "ཟ", "འ", "ཡ", "ར", "ལ", "ཤ", "ས",
    "ཧ", "ཨ", "ཀི", "ཀུ", "ཀེ", "ཀོ", "ཀྱ", "ཀྲ", "ཀླ", "སྐ", "སྒ", "སྟ",
    "སྤ", "རྐ", "རྒ", "ལྟ", "བརྒྱ", "བསྒྲུབ", "མཁྱེན", "རྗེ", "རྒྱལ", "བོད་ཡིག།", "༄༅། །", "༠༡༢༣༤༥༦༧༨༩",
]
LATIN_PROBES = ["0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "(", ")", "0123456789", "(0123456789)"]


def inline_probes(spark: SparkSession) -> DataFrame:
    """test_kind, probe of the texts that need no file."""
    return spark.createDataFrame([("normal", p) for p in NORMAL_PROBES] + [("latin", p) for p in LATIN_PROBES], "test_kind string, probe string")


def numbered_texts(docs: DataFrame, text: str, order: str, limit: int | None = None, nulls_count: bool = True) -> DataFrame:
    """row_index (from 0, in order) and text of the texts that aren't null; the numbers and the limit count nulls too, or they don't."""
    from ..plans.numbering import numbered_within

    rows = docs if nulls_count else docs.filter(F.col(text).isNotNull())
    rows = rows.orderBy(order).limit(limit) if limit is not None else rows
    placed = numbered_within(rows.select(order, text), [], [order])
    return placed.filter(F.col(text).isNotNull()).select((F.col("place") - 1).alias("row_index"), text)


def alignments(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Rows of alignment files i_id-ve_id-mode.parquet with these three from the file's name."""
    rows = spark.read.schema(schema).parquet(*([paths] if isinstance(paths, str) else paths))
    file = F.regexp_replace(F.col("_metadata.file_name"), "\\.parquet$", "")
    return rows.select("*", *[F.get(F.split(file, "-"), F.lit(i)).alias(c) for i, c in enumerate(("i_id", "ve_id", "mode"))])


def page_map(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """physical_page, render_id, line_count, at of files without a header; at goes through the files in path order."""
    read = in_file_order(spark.read.schema("physical_page int, render_id string, line_count int").csv(path))
    return read.drop("path", "line").filter(F.coalesce("render_id", F.lit("")) != "")


def line_map(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """physical_page, render_id, line_index, marker_ids (whole numbers only), at of files without a header; at as in page_map."""
    read = in_file_order(spark.read.schema("physical_page int, render_id string, line_index int, marker_ids string").csv(path)).drop("path", "line")
    ids = F.transform(F.filter(F.split(F.coalesce("marker_ids", F.lit("")), " +"), lambda x: x.rlike("^[0-9]+$")), lambda x: x.cast("int"))
    return read.filter(F.coalesce("render_id", F.lit("")) != "").withColumn("marker_ids", ids)


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all committed checkpoint files below a folder, with file, line and at, by which they follow each other. Columns are those of any file; a missing or empty folder has no rows."""
    rows = csv_union(spark, path)
    return rows.withColumn("file", F.regexp_extract("path", "[^/]*$", 0)).withColumn("fragment", F.regexp_extract("path", "([^/]*)/[^/]*$", 1)).drop("path")


def markdown_table(spark: SparkSession, path: str) -> DataFrame:
    """file, family, names of a catalog table; conflict markers, rules and the header are skipped, escaped bars kept."""
    rows = spark.read.text(path).filter(F.col("value").rlike("^\\| ") & ~F.col("value").rlike("^\\| *(:?-+|File) *:?\\|"))
    cells = F.transform(F.split(F.regexp_replace("value", "^\\| | \\|$", ""), " (?<!\\\\)\\| "), lambda x: F.replace(x, F.lit("\\|"), F.lit("|")))
    return rows.select(*[F.trim(F.get(cells, F.lit(i))).alias(c) for i, c in enumerate(("file", "family", "names"))])


def files_by_extension(spark: SparkSession, folder: str, pattern: str = "*.{ttf,otf,ttc}") -> DataFrame:
    """path, length, sha256 of files below a folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return found.select("path", "length", F.sha2("content", 256).alias("sha256"))


def last_per_key(rows: DataFrame, key: str, position: str) -> DataFrame:
    """Of duplicate keys the last by position."""
    order = Window.partitionBy(key).orderBy(F.desc(position))
    return rows.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
