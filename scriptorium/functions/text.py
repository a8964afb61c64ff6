"""Scalar functions over text: profiles of a script, cleaning, splitting, profiles of characters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Profile:
    """What text functions need to know of a script. Patterns are Java's."""

    block: str  # character class of the script, without brackets
    token: str  # pattern of an orthographic unit
    stop: str  # character that ends a sentence-like unit
    gap: str  # character between syllables or words
    toc: str  # a run of it marks a table of contents


#: Units approximate a segmentation that needs an outside library: a base letter with what is attached to it.
TIBETAN = Profile("\\u0F00-\\u0FFF", "[\\u0F40-\\u0F6C][\\u0F71-\\u0F84\\u0F90-\\u0FBC]*|[\\u0F00-\\u0FFF]", "།", "་", "་་་་་")
LATIN = Profile("A-Za-z\\u00C0-\\u024F", "\\p{L}+", ".", " ", ".....")


def only_script(text: Column, p: Profile, spaces: bool = False) -> Column:
    """Whether all characters are of the script; with spaces allowed, the empty text is too."""
    return text.rlike(f"^[{p.block} ]*$" if spaces else f"^[{p.block}]+$")


def contains_script(text: Column, p: Profile) -> Column:
    return text.rlike(f"[{p.block}]")


def has_letter(text: Column) -> Column:
    return text.rlike("\\p{L}")


def lowered(text: Column) -> Column:
    """Lower case of each character by itself, as DuckDB has it. F.lower makes two characters of İ, and another sigma at the end of a word."""
    return F.lower(F.replace(F.replace(text, F.lit("İ"), F.lit("i")), F.lit("Σ"), F.lit("σ")))


def tokens(text: Column, p: Profile) -> Column:
    return F.regexp_extract_all(lowered(text) if p.token == LATIN.token else text, F.lit(p.token), F.lit(0))


def code_points(text: Column) -> Column:
    """"U+0F40 U+0FB2" of a text."""
    return F.array_join(F.transform(F.split(text, ""), lambda c: F.concat(F.lit("U+"), F.lpad(F.hex(F.ascii(c)), 4, "0"))), " ")


#: White space as Unicode has it, and the four separators that Java leaves out. Begins a pattern, as it sets Unicode classes.
SPACE = "(?U)[\\s\\x1C-\\x1F]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}+$|^{SPACE}+", "")


def clean(text: Column, p: Profile = LATIN) -> Column:
    """Page markers, wherever they stand and in any case, and line ends to spaces, white space after a syllable mark out, runs to one, ends trimmed."""
    return one_line(F.regexp_replace(text, f"(?i){PAGE_MARKER}", " "), p)


def one_line(text: Column, p: Profile = LATIN) -> Column:
    """Line ends to spaces, white space after a syllable mark out, runs to one, ends trimmed."""
    t = F.regexp_replace(text, "[\\r\\n]", " ")
    if p.gap != " ":
        t = F.regexp_replace(t, f"{p.gap}{SPACE}+", p.gap)
    return F.regexp_replace(F.regexp_replace(t, f"{SPACE}+", " "), "^ | $", "")


#: A page marker; begins like SPACE.
PAGE_MARKER = f"--{SPACE}*page{SPACE}+\\d+{SPACE}*--"


def split_units(text: Column, p: Profile = LATIN, shortest: int = 8) -> Column:
    """Units cut behind each stop, the tail too, trimmed; short ones dropped."""
    stop = f"[{p.stop}]"
    cut = F.regexp_extract_all(text, F.lit(f"[^{p.stop}]*{stop}|[^{p.stop}]+$"), F.lit(0))
    return F.filter(F.transform(cut, strip), lambda u: F.length(u) >= shortest)


def later_units(text: Column, p: Profile = TIBETAN, opening: str | None = None) -> Column:
    """Units behind the first stop, trimmed, each with a stop, the tail too; blank ones dropped. Lines that are a page marker and the opening (a pattern) are left out before."""
    t = F.regexp_replace(F.regexp_replace(text, "\\r\\n?", "\n"), opening or "(?!)", "")
    blank = "[^\\S\\n]"
    t = F.regexp_replace(t, f"(?imdU)^{blank}*--{blank}*page{blank}+\\d+{blank}*--{blank}*$\n?", "")
    parts = F.split(t, f"[{p.stop}]")
    later = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), strip)
    return F.transform(F.filter(later, lambda u: u != ""), lambda u: F.concat(u, F.lit(p.stop)))


def usable_units(units: DataFrame, unit: str, least: int = 20, most: int = 220, p: Profile = LATIN, foreign: str | None = None, without: list[str] | None = None) -> DataFrame:
    """Units of least to most characters without a doubled gap, without characters of the foreign class, and without any of the substrings."""
    text = F.col(unit)
    kept = units.filter(F.length(text).between(least, most) & ~text.contains(p.gap * 2))
    kept = kept.filter(~text.rlike(f"[{foreign}]")) if foreign else kept
    for part in without or []:
        kept = kept.filter(~text.contains(part))
    return kept


def split_marker_units(text: Column, p: Profile = TIBETAN) -> Column:
    """Units cut behind a syllable mark that no stop follows, or behind a space."""
    return F.regexp_extract_all(text, F.lit(f"(?s).*?(?:{p.gap}(?!{p.stop})| )|.+$"), F.lit(0))


def break_points(text: Column, put: str, p: Profile = TIBETAN) -> Column:
    return F.regexp_replace(text, f"{p.gap}(?!{p.stop})", f"{p.gap}{put}")


def stable_id(row: Column, start: Column, text: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws(":", row.cast("string"), start.cast("string"), text)), 1, 16)


def tex_escape(text: Column) -> Column:
    return F.translate(text, "\\%$&#_{}", "")


def slug(text: Column) -> Column:
    """ASCII letters and digits with single underscores; a digest where none is left."""
    s = F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), "^_|_$", "")
    return F.when(s == "", F.substring(F.sha1(text), 1, 12)).otherwise(s)


def rounded(x: Column, digits: int) -> Column:
    """A double to so many digits, half away from zero, by its product with a power of ten, as DuckDB's round and C's do.

    F.round goes by the shortest decimal that names the double instead: 0.5069575 gives 0.506958, while its product with a million is below 506957.5.
    """
    scale = F.lit(10.0**digits)
    return F.round(x * scale) / scale


def trimmed_number(x: Column, digits: int = 3) -> Column:
    s = F.format_string(f"%.{digits}f", x)
    return F.regexp_replace(F.regexp_replace(s, "0+$", ""), "\\.$", "")


def natural_key(text: Column) -> Column:
    """array<string> by which a2 sorts before a10: other characters and numbers in turn, the former first. A number is its count of digits and its digits, of any length."""
    parts = F.regexp_extract_all(F.lower(text), F.lit("[0-9]+|[^0-9]+"), F.lit(0))
    number = lambda x: F.regexp_replace(x, "^0+(?=.)", "")
    keys = F.transform(parts, lambda x: F.when(x.rlike("^[0-9]"), F.concat(F.lpad(F.length(number(x)).cast("string"), 10, "0"), number(x))).otherwise(x))
    return F.when(F.lower(text).rlike("^[0-9]"), F.concat(F.array(F.lit("")), keys)).otherwise(keys)


def odd_prefix(number: Column, text: Column, prefix: str, mark: str) -> tuple[Column, Column]:
    """page and page_prefix_added: the prefix before whole texts of odd numbers, unless the mark is in their first five characters."""
    odd = F.coalesce((number % 2 == 1) & ~F.substring(text, 1, 5).contains(mark), F.lit(False))
    return F.when(odd, F.concat(F.lit(prefix), text)).otherwise(text).alias("page"), odd.cast("int").alias("page_prefix_added")


def parse_int_strict(text: Column, default: int = 0) -> Column:
    """Blank gives the default, "12.0" gives 12, junk raises (ANSI)."""
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", F.lit(default)).otherwise(F.trim(text).cast("double")).cast("bigint")


def parse_int_lenient(text: Column, default: int = 0) -> Column:
    """Anything but an integer gives the default, "12.0" too."""
    return F.when(F.trim(text).rlike("^[+-]?[0-9]+$"), F.trim(text).try_cast("bigint")).otherwise(F.lit(default))


def volume_of(number: Column, size: int) -> Column:
    return F.floor((number - 1) / size) + 1


def page_of(number: Column, size: int) -> Column:
    return (number - 1) % size + 1


def row_bytes(*columns: Column) -> Column:
    """Estimate: a string's UTF-8 length, 1 for null; numbers are added by the caller at 16 each."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(F.octet_length(c), F.lit(1))
    return total
