"""Page maps, catalog rows and resuming: what rendered batches leave behind, joined and reduced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import first_filled
from ..functions.text import TIBETAN, Profile, split_marker_units, strip
from .geometry import let


def sequence_of(output_sequence: Column, file_name: Column) -> Column:
    """A catalog row's number: its own, else that of its image's file name, else 0."""
    whole = lambda c: F.when(F.trim(c).rlike("^[+-]?[0-9]+$"), F.trim(c).try_cast("long"))
    stem = F.regexp_replace(F.regexp_extract(F.coalesce(file_name, F.lit("0")), "[^/]*$", 0), "\\.[^.]*$", "")
    return F.coalesce(whole(output_sequence), whole(stem), F.lit(0)).cast("long")


def latest_rows(fragments: DataFrame, *order: str) -> DataFrame:
    """The last catalog row of each number in the order of fragments and lines; rows without a number are left out. One aggregate."""
    rows = fragments.withColumn("sequence", sequence_of(F.col("output_sequence"), F.col("image_file_name"))).filter("sequence <> 0")
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(F.col("sequence").alias("key")).agg(F.max_by(whole, F.struct(*order)).alias("row")).select("row.*")


def plan_ids(rows: DataFrame, listed: str = "source_plan_image_ids") -> DataFrame:
    """Distinct image_id of the plan rows that catalog rows stand for."""
    ids = F.explode(F.transform(F.split(listed, "\\|"), lambda x: F.trim(x)))
    return rows.select(ids.alias("image_id")).filter("image_id <> ''").distinct()


def with_files(rows: DataFrame, files: DataFrame, path: str, missing: bool = False) -> DataFrame:
    """Rows whose path is among the files' (or, if missing is set, is not)."""
    listed = files.select(F.col("path").alias(path)).distinct()
    return rows.join(listed, path, "left_anti" if missing else "left_semi")


def distinct_files(rows: DataFrame, path: str) -> DataFrame:
    """The paths that rows name, each once; blanks name none."""
    return rows.select(path).filter(F.coalesce(F.trim(path), F.lit("")) != "").distinct()


def resume(plan: DataFrame, fragments: DataFrame, files: DataFrame, *order: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What a stopped run goes on with: (catalog, todo, next_id).

    The fragments' latest rows stay in the catalog if their image is there; plan rows that such a row stands for are done; next_id is one
    more than the largest number of the catalog, 1 if it is empty. Nothing comes to the driver.
    """
    catalog = with_files(latest_rows(fragments, *order), files, "image_file_name")
    todo = plan.join(plan_ids(catalog), "image_id", "left_anti")
    return catalog, todo, catalog.agg((F.coalesce(F.max("sequence"), F.lit(0)) + 1).alias("next_id"))


def output_number(image_id: Column, running: Column) -> Column:
    """The plan's own number wins over the running one."""
    return F.coalesce(F.when(F.trim(image_id).rlike("^[+-]?[0-9]+$"), F.trim(image_id).try_cast("long")), running)


def content_pages(page_map: DataFrame) -> DataFrame:
    """render_id, first_page, content_pages: the first page with lines (else the first page) of each text, and how many have lines."""
    filled = F.col("line_count") > 0
    return page_map.filter("render_id <> ''").groupBy("render_id").agg(
        F.min_by("physical_page", F.struct(F.when(filled, 0).otherwise(1), "at")).alias("first_page"),
        F.count_if(filled).alias("content_pages"),
    )


def marker_lines(units: Column, ends: Column) -> Column:
    """Lines of marker units: each list of ids ends a line at its largest id; lists that are empty or reach no further give none.

    A list gives a line from where the lists before it have reached, so the running maximum is all that is carried.
    """
    reached = lambda m: F.transform(ends, lambda ids: F.least(F.coalesce(F.array_max(ids), F.lit(0)), F.size(m["units"])))
    running = lambda reach: F.aggregate(reach, F.array(F.lit(0)), lambda seen, x: F.concat(seen, F.array(F.greatest(F.element_at(seen, -1), x))))

    def lines(m, upto):
        many = F.size(upto) - 1
        spans = F.zip_with(F.slice(upto, F.lit(1), many), F.slice(upto, F.lit(2), many), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return F.transform(F.filter(spans, lambda s: s["b"] > s["a"]), lambda s: strip(F.array_join(F.slice(m["units"], s["a"] + 1, s["b"] - s["a"]), "")))

    # a text is cut into its units once, not for each line
    return let(lambda m: let(lambda r: F.filter(lines(m, r["upto"]), lambda x: x != ""), upto=running(reached(m))), units=units)


def strip_lines(text: Column) -> Column:
    return strip(F.array_join(F.transform(F.split(text, "\n"), strip), "\n"))


def transcriptions(rows: DataFrame, page_map: DataFrame, line_map: DataFrame, p: Profile = TIBETAN) -> DataFrame:
    """render_id, first_page, transcription: a text as its first content page broke it into lines; the text as it is where no line is known.

    page_map: physical_page, render_id, line_count, at. line_map: physical_page, render_id, line_index, marker_ids (array), at.
    """
    first = content_pages(page_map)
    listed = line_map.filter("render_id <> ''").groupBy("render_id", F.col("physical_page").alias("first_page")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "marker_ids"))), lambda x: x["marker_ids"]).alias("ends"))
    both = rows.select("render_id", "text").join(first, "render_id", "left").join(listed, ["render_id", "first_page"], "left")
    built = strip_lines(F.array_join(marker_lines(split_marker_units(F.col("text"), p), F.col("ends")), "\n"))
    return both.select("render_id", "first_page", first_filled(built, strip_lines(F.col("text"))).alias("transcription"))


def batch_ids(rows: DataFrame, by: list[str], order: str, size: int) -> DataFrame:
    """Adds batch_id (the group's columns, first and last order of the batch) and page_in_batch, from 1.

    Numbers come from prefix counts over ranges of the order, so a large group is not one task's sort.
    """
    from ..plans.numbering import numbered_within

    placed = numbered_within(rows, by, [order]).withColumn("batch", F.floor((F.col("place") - 1) / size))
    ends = placed.groupBy(*by, "batch").agg(F.min(order).alias("first"), F.max(order).alias("last"))
    name = F.regexp_replace(F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by], F.format_string("%08d", "first"), F.format_string("%08d", "last")), "/", "_")
    return placed.join(ends.select(*by, "batch", name.alias("batch_id")), [*by, "batch"]).withColumn("page_in_batch", (F.col("place") - 1) % size + 1).drop("batch", "place")


def with_metadata(rows: DataFrame, volumes: DataFrame, fields: list[str]) -> DataFrame:
    """Alignment rows with the fields of their image volume, else of their text volume, else empty. Of volumes of one id the last one counts.

    volumes: vol_id, at and the fields; a few rows per thousand pages.
    """
    last = volumes.groupBy("vol_id").agg(F.max_by(F.struct(*fields), "at").alias("v"))
    found = rows.join(last.select(F.col("vol_id").alias("i_id"), F.col("v").alias("i")), "i_id", "left").join(last.select(F.col("vol_id").alias("ve_id"), F.col("v").alias("ve")), "ve_id", "left")
    kept = [c for c in rows.columns if c not in fields]
    own = {f: [F.col(f)] if f in rows.columns else [] for f in fields}
    return found.select(*kept, *[first_filled(*own[f], F.col(f"i.{f}"), F.col(f"ve.{f}")).alias(f) for f in fields])


def subset_rows(rows: DataFrame, version: str, dataset: str) -> DataFrame:
    """Rows with the id version:dataset:ve_id:file of a subset, their split (data where none is told) and their estimated bytes.

    An estimate is a string's UTF-8 length, 16 for a number or a truth value, 1 for null.
    """
    made = F.concat_ws(":", F.lit(version), F.lit(dataset), F.col("ve_id"), F.col("img_file_name"))
    out = rows.withColumns({"id": made, "split": first_filled(F.col("suggested_split"), F.lit("data"))})
    total = F.lit(0)
    for f in out.schema.fields:
        size = F.octet_length(f.name) if f.dataType.typeName() in ("string", "binary") else F.lit(16)
        total = total + F.when(F.col(f.name).isNull(), 1).otherwise(size)
    return out.withColumn("bytes", total.cast("long"))
