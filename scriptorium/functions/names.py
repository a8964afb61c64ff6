"""Names, identifiers and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import page_of, volume_of

#: Fixed value: what marks a unit that a font without Sanskrit stacks can't show.
SANSKRIT = ["ཱ", "ཻ", "ཽ", "ྃ", "ཱུ", "ྰ", "ཛྲ", "དྡྷ", "ཅྖ"]
#: Punctuation, marks and digits that are no syllables but valid by themselves.
MARKS_AND_DIGITS = "\\u0F04-\\u0F08\\u0F0B-\\u0F14\\u0F20-\\u0F29\\u0F34\\u0F39\\u0F3C\\u0F3D"


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def script_kind(name: Column) -> Column:
    """ume for names of ume and transitional scripts, else uchen, for blanks and nulls too."""
    return F.when(F.lower(name).rlike("ume|transitional"), "ume").otherwise("uchen")


def font_name(ps_name: Column, basename: Column, file: Column) -> Column:
    return first_filled(ps_name, basename, file)


def image_id(prefix: str, number: Column, size: int = 1000) -> Column:
    """prefix_0001 of the volume that a number falls in."""
    return F.format_string(f"{prefix}_%04d", volume_of(number, size))


def image_path(root: str, prefix: str, version: str, number: Column, size: int = 1000) -> Column:
    return F.concat_ws("/", F.lit(root), image_id(prefix, number, size), F.lit(version), F.format_string("%04d.jpg", page_of(number, size)))


def without_controls(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x00-\\x1F\\x7F-\\x9F]", "")


def _with(value: Column, then) -> Column:
    """then(value), the value being computed once however often then names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _underscored(text: Column) -> Column:
    """Runs of what is no ASCII letter, digit, dot or hyphen as one underscore. Java tests a named class several times faster than a union of ranges."""
    return F.regexp_replace(text, "[^\\p{Alnum}.-]+", "_")


def safe_basename(name: Column) -> Column:
    """ASCII letters, digits, dots, hyphens and single underscores from the first letter on, which is a capital, without underscores and dots at the end; Font where no letter is left.

    Long texts are names too, so the passes over a name are few and each is linear.
    """
    kept = F.regexp_replace(_underscored(F.regexp_replace(name, "[^\\x00-\\x7F]+", "")), "^[^A-Za-z]+", "")
    begun = F.rtrim(kept, F.lit("_."))
    return _with(begun, lambda x: F.when(F.coalesce(x, F.lit("")) == "", "Font").otherwise(F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, F.lit(2), F.length(x)))))


def folded_slug(name: Column) -> Column:
    """Decomposed, without marks, ASCII only; other characters as single underscores; x where nothing is left.

    Spark has no normal forms, so the decomposition is a vectorised function; only names that aren't ASCII go through it.
    """
    import unicodedata

    import pandas as pd

    def fold(names):
        return names.map(lambda s: None if s is None else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii"))

    fold.__annotations__ = {"names": pd.Series, "return": pd.Series}
    folded = F.pandas_udf(fold, "string")(F.when(F.octet_length(name) != F.length(name), name))
    slug = F.trim(_underscored(F.coalesce(folded, name)), F.lit("_"))
    return _with(slug, lambda x: F.when(x == "", "x").otherwise(x))


def short_hash(text: Column, digits: int = 8) -> Column:
    return F.substring(F.sha1(text), 1, digits)


def has_sanskrit(text: Column) -> Column:
    return text.rlike("|".join(SANSKRIT))


def only_marks_or_digits(text: Column) -> Column:
    return text.rlike(f"^[{MARKS_AND_DIGITS}]+$")


def etext_source(row: Column, start: Column, end: Column) -> Column:
    return F.concat_ws(":", F.lit("bocorpus"), row.cast("string"), start.cast("string"), end.cast("string"))


def finite(text: Column, default: Column | None = None) -> Column:
    """The finite number that a text spells, else default."""
    value = text.try_cast("double")
    ok = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(ok, value).otherwise(F.lit(None).cast("double") if default is None else default)


def fragment_name(batch: Column, plan_ids: Column) -> Column:
    """File name of a batch's checkpoint: the batch, made safe, and a digest of its sorted distinct plan ids."""
    ids = F.array_join(F.array_sort(F.array_distinct(plan_ids)), ",")
    return F.concat(F.regexp_replace(batch, "[^A-Za-z0-9_.-]+", "_"), F.lit("_"), short_hash(ids, 12), F.lit(".csv"))
