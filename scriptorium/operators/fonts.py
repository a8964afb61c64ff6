"""Renderers: selection, flags, names, features, and what they support."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import first_filled, only_marks_or_digits


def select_fonts(fonts: DataFrame, names: list[str] | None = None, skt_ok: int | None = None, limit: int | None = None, order: str = "at") -> DataFrame:
    """Fonts of the names, with the flag (a null flag is neither), the first of them in order. names is a parameter list."""
    if names is not None:
        fonts = fonts.filter(F.col("basename").isin(list(names)))
    if skt_ok is not None:
        fonts = fonts.filter(F.col("skt_ok") == skt_ok)
    return fonts.orderBy(order).limit(limit) if limit is not None else fonts


def flagged(fonts: DataFrame, listed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Fonts with skt_ok 1 where their basename is listed, else 0, and the size that was set for them where one was. No font is dropped.

    listed: basename. sizes: basename, font_size_pt, at; of several sizes the last one counts.
    """
    marks = listed.select("basename").distinct().withColumn("listed", F.lit(1))
    last = sizes.groupBy("basename").agg(F.max_by("font_size_pt", "at").alias("set_size"))
    out = fonts.join(marks, "basename", "left").join(last, "basename", "left")
    return out.withColumns({"skt_ok": F.coalesce("listed", F.lit(0)), "font_size_pt": F.coalesce("set_size", "font_size_pt")}).drop("listed", "set_size")


def font_of(rows: DataFrame, fonts: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with their font's columns; told "font row not found" where there is none."""
    found = fonts.select("basename", *columns, F.lit(True).alias("_known"))
    return rows.join(found, "basename", "left").withColumn("error", F.when(F.col("_known").isNull(), "font row not found")).drop("_known")


def supported_units(support: DataFrame, renderer: str, unit: str) -> DataFrame:
    """Distinct (renderer, unit) of stacks that passed without a warning, whether once or more often."""
    warned = F.coalesce("placement_warning_count", F.lit(0)) if "placement_warning_count" in support.columns else F.lit(0)
    return support.filter((F.col("test_kind") == "stack") & F.col("ok") & (warned == 0)).select(renderer, unit).distinct()


def capacities(supported: DataFrame, faces: DataFrame, renderer: str, name: str) -> DataFrame:
    """name, capacity: the largest number of units that one of a name's faces supports; 0 where none supports any."""
    sizes = supported.groupBy(renderer).agg(F.count("*").alias("units"))
    return faces.join(sizes, renderer, "left").groupBy(name).agg(F.coalesce(F.max("units"), F.lit(0)).alias("capacity"))


def scanned_faces(lines: DataFrame) -> DataFrame:
    """file, family, names of each line family|full names|postscript name of a font scanner; a line of other parts is an Error row. lines: file, line."""
    parts = F.split("line", "\\|")
    ok = F.size(parts) == 3
    filled = lambda names: F.filter(F.transform(names, lambda x: F.trim(x)), lambda x: x != "")
    names = F.array_sort(F.array_distinct(F.concat(filled(F.split(F.get(parts, F.lit(1)), ",")), filled(F.array(F.get(parts, F.lit(2)))))))
    return lines.select("file", F.when(ok, F.trim(F.get(parts, F.lit(0)))).otherwise("Error").alias("family"), F.when(ok, names).otherwise(F.array(F.lit("Error"))).alias("names"))


def faces(files: DataFrame) -> DataFrame:
    """A row per face of each font file: basename (with _ttc_ and the face's number in collections), ttc_face_index. files: path, faces (array)."""
    base = F.regexp_replace(F.regexp_extract("path", "[^/]*$", 0), "\\.[^.]*$", "")
    many = F.size("faces") > 1
    rows = files.select("path", base.alias("base"), many.alias("many"), F.posexplode("faces").alias("index", "face"))
    return rows.select("path", F.when(F.col("many"), F.concat_ws("_ttc_", "base", F.col("index").cast("string"))).otherwise(F.col("base")).alias("basename"), F.when(F.col("many"), F.col("index")).alias("ttc_face_index"), "face")


def features(fonts: DataFrame, block: tuple[int, int] = (0x0F00, 0x0FFF)) -> DataFrame:
    """Static features: how many code points of the block the character map has and their share, and whether marks are placed.

    fonts: basename, cmap (array of code points), gsub and gpos (arrays of feature tags), read_error. An unreadable font has zeros.
    """
    inside = F.size(F.array_distinct(F.filter(F.coalesce("cmap", F.array().cast("array<int>")), lambda c: c.between(*block))))
    some = lambda c, *tags: F.coalesce(F.arrays_overlap(F.col(c), F.array(*map(F.lit, tags))), F.lit(False))
    has = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    size = block[1] - block[0] + 1
    return fonts.select("basename", first_filled(F.col("read_error")).alias("read_error"), inside.cast("long").alias("cmap_count"), (inside / size).alias("cmap_coverage"), has("gsub").alias("has_gsub"), has("gpos").alias("has_gpos"), some("gpos", "mark").alias("has_mark_positioning"), some("gpos", "mkmk").alias("has_mark_to_mark"))


def valid_units(units: DataFrame, valid: DataFrame, on: str) -> DataFrame:
    """Units with is_valid: 1 where they are among the valid ones or hold only marks and digits, else 0."""
    marked = valid.select(on).distinct().withColumn("hit", F.lit(1))
    return units.join(marked, on, "left").withColumn("is_valid", F.when(F.col("hit").isNotNull() | only_marks_or_digits(F.col(on)), 1).otherwise(0)).drop("hit")


def catalog(rows: DataFrame, scripts: DataFrame, fonts: DataFrame, columns: list[str], excluded: list | None = None) -> DataFrame:
    """Catalog rows with their script's columns and their font's size and flag, empty where there is none; scripts in excluded are left out.

    Scripts and fonts are keyed tables (script_id; font_path) whose last row by at counts. Without excluded ids the usual one goes.
    """
    last = lambda t, key, kept: t.groupBy(key).agg(F.max_by(F.struct(*kept), "at").alias("m")).select(key, "m.*")
    out = rows.join(last(scripts, "script_id", columns), "script_id", "left").join(last(fonts, "font_path", ["font_size_pt", "skt_ok"]), "font_path", "left")
    gone = [str(x) for x in excluded or ["239"]]
    out = out.filter(~F.coalesce(F.col("script_id").cast("string").isin(gone), F.lit(False)))
    file = F.regexp_extract("font_path", "[^/]*$", 0)
    return out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in [*columns, "font_size_pt", "skt_ok"]} | {"font_file": file})


def missing_keys(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct keys of rows that known lacks."""
    return rows.select(key).filter(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")
