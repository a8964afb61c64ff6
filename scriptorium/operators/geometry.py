"""Placement warnings over arrays of glyph boxes: predicates of higher-order functions, no Python on the executors.

A box has gid, name, x0, ytop, x1, ybot; y grows upward. Computed indexes go through get(), and a ratio over something that is not
positive is null, which no rule takes for true.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Character classes that the rules speak of.
TOP_MARKS = "\\u0F72\\u0F7A-\\u0F7E\\u0F80\\u0F82\\u0F83"
TOP_DIACRITICS = "\\u0F7E\\u0F82\\u0F83"
BOTTOM_VOWELS = "\\u0F71\\u0F73-\\u0F77\\u0F80\\u0F81"
LINE_MARKS = "\\u0F35\\u0F37"
BASE_LETTERS = "\\u0F40-\\u0F6C"
SUBJOINED = "\\u0F90-\\u0FBC"
VOWELS = "\\u0F71-\\u0F84\\u0F86\\u0F87\\u0FC6"
#: The warnings in the order in which they are told; of the last three only the first that holds is.
WARNINGS = [
    "top_diacritic_collision", "top_mark_overlap", "top_mark_horizontal_misalignment", "mark_horizontal_misalignment", "floating_bottom_vowel",
    "subscript_layer_collision", "subscript_horizontal_misalignment", "subscript_containment", "subscript_overlap", "subscript_insufficient_descent",
]


def count_of(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]", ""))


def height(b: Column) -> Column:
    return b["ytop"] - b["ybot"]


def width(b: Column) -> Column:
    return b["x1"] - b["x0"]


def centre(b: Column) -> Column:
    return (b["x0"] + b["x1"]) / 2.0


def overlap_y(p: Column, c: Column) -> Column:
    return F.least(p["ytop"], c["ytop"]) - F.greatest(p["ybot"], c["ybot"])


def overlap_x(p: Column, c: Column) -> Column:
    return F.greatest(F.lit(0), F.least(p["x1"], c["x1"]) - F.greatest(p["x0"], c["x0"]))


def ratio(a: Column, b: Column) -> Column:
    """a / b where b is positive."""
    return F.when(b > 0, a / b.cast("double"))


def outside(c: Column, x0: Column, x1: Column, room: Column) -> Column:
    """Whether the centre lies beyond the span x0 to x1 by more than a tenth of room."""
    return (centre(c) < x0 - 0.10 * room) | (centre(c) > x1 + 0.10 * room)


def adjacent(b: Column) -> Column:
    """array<struct<p, c>> of neighbouring boxes, empty below two."""
    n = F.size(b)
    return F.zip_with(F.slice(b, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(b, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda p, c: F.struct(p.alias("p"), c.alias("c")))


def let(f, **values: Column) -> Column:
    """f of the named values, each of which is worked out once however often f looks at it."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), f), F.lit(0))


def spread(a: Column, f) -> Column:
    return let(lambda m: F.array_max(m["v"]) - F.array_min(m["v"]), v=F.transform(a, f))


def mean_size(a: Column, f) -> Column:
    return F.aggregate(F.transform(a, f), F.lit(0.0), lambda s, x: s + F.abs(x)) / F.nullif(F.size(a), F.lit(0))


def rules(text: Column, boxes: Column) -> dict[str, Column]:
    """Each warning's own condition, without the common ones (two boxes, a stack height, a subjoined letter for those of subscripts)."""

    def one(name):
        return let(lambda m: _rules(text, boxes, m)[name], **_measures(text, boxes))

    return {name: one(name) for name in WARNINGS}


def _measures(text: Column, boxes: Column) -> dict[str, Column]:
    """What several rules look at. end: how many boxes come before the trailing top marks; with more marks than boxes, as many are taken from the end twice."""
    n, marks = F.size(boxes), F.length(F.regexp_extract(text, f"[{TOP_MARKS}]*$", 0))
    return {
        "n": n,
        "stack": F.get(boxes, F.lit(0))["ytop"] - F.array_min(F.transform(boxes, lambda x: x["ybot"])),
        "subjoined": count_of(text, SUBJOINED),
        "last_mark": text.rlike(f"[{TOP_MARKS}]\\z"),
        "end": let(lambda x: F.when(n >= x["marks"], n - x["marks"]).otherwise(F.greatest(2 * n - x["marks"], F.lit(0))), marks=marks),
        "pairs": adjacent(boxes),
    }


def _rules(text: Column, boxes: Column, m: Column) -> dict[str, Column]:
    """The rules from the measures, of which each is looked at where a rule's cheaper conditions hold."""
    n, stack, subjoined, last_mark = m["n"], m["stack"], m["subjoined"], m["last_mark"]
    base, last, before_last = F.get(boxes, F.lit(0)), F.get(boxes, n - 1), F.get(boxes, n - 2)
    others = F.slice(boxes, F.lit(1), F.greatest(n - 1, F.lit(0)))
    upper = F.slice(boxes, F.lit(2), F.greatest(n - 1, F.lit(0)))

    key = lambda x: F.struct(x["name"], x["x0"], x["ytop"], x["x1"], x["ybot"])
    same = F.size(F.array_distinct(F.transform(upper, key))) < F.size(upper)
    scale = F.when(base["ytop"] == 0, F.lit(1)).otherwise(F.abs(base["ytop"]))

    def close(h):
        high = h["high"]
        return (F.size(high) >= 2) & (spread(high, centre) <= 0.08 * mean_size(high, width)) & (spread(high, lambda x: (x["ytop"] + x["ybot"]) / 2.0) <= 0.08 * mean_size(high, height))

    near = let(close, high=F.filter(upper, lambda x: x["ybot"] >= base["ytop"] - 0.05 * scale))

    covers = (ratio(overlap_y(before_last, last), height(last)) >= 0.65) & (last["ybot"] < before_last["ytop"])
    swallowed = F.exists(others, lambda x: (height(x) > 0) & (ratio(overlap_y(x, last), height(last)) >= 0.75) & (last["ytop"] <= x["ytop"]))

    def beside(rule):
        """rule of the share of the last box's width that lies beside the others' span, and of whether its centre is astray."""

        def told(s):
            share = ratio(F.greatest(F.lit(0), F.least(last["x1"], s["x1"]) - F.greatest(last["x0"], s["x0"])), width(last))
            return let(lambda w: rule(w["share"], outside(last, s["x0"], s["x1"], F.greatest(F.lit(1), s["x1"] - s["x0"]))), share=share)

        return let(told, x0=F.array_min(F.transform(others, lambda x: x["x0"])), x1=F.array_max(F.transform(others, lambda x: x["x1"])))

    def floats(v):
        vowel, prev, share = v["vowel"], v["prev"], ratio(overlap_y(v["prev"], v["vowel"]), height(v["vowel"]))
        found = [
            vowel["ytop"] > prev["ytop"] - 0.10 * stack,
            (height(prev) > 0) & (vowel["ybot"] > prev["ybot"] + 0.10 * height(prev)),
            (share >= 0.85) & (vowel["ybot"] > prev["ybot"] - 0.08 * stack),
            (share >= 0.45) & (vowel["ytop"] > prev["ybot"] + 0.20 * height(vowel)),
        ]
        return F.greatest(*[F.coalesce(f, F.lit(False)) for f in found])

    at = F.when(last_mark, n - 2).otherwise(n - 1)
    floating = let(floats, vowel=F.get(boxes, F.greatest(at, F.lit(0))), prev=F.get(boxes, F.greatest(at - 1, F.lit(0))))

    inner = F.slice(boxes, F.lit(2), F.greatest(m["end"] - 1, F.lit(0)))
    flat = let(lambda i: (F.size(i["inner"]) >= 4) & (spread(i["inner"], lambda x: x["ytop"]) <= 0.18 * stack) & (F.size(F.array_distinct(F.transform(i["inner"], lambda x: x["name"]))) >= 4), inner=inner)

    def sideways(x):
        p, c = x["p"], x["c"]
        gap = c["ytop"] - p["ybot"]
        level = (ratio(F.greatest(F.lit(0), overlap_y(p, c)), height(c)) >= 0.35) | ((gap >= 0) & (gap <= 0.08 * F.greatest(F.lit(1), height(p))))
        return (width(p) > 0) & (height(c) > 0) & (ratio(overlap_x(p, c), width(c)) < 0.25) & level & outside(c, p["x0"], p["x1"], width(p))

    def contained(x):
        p, c = x["p"], x["c"]
        return (c["ybot"] > p["ybot"]) & (ratio(overlap_y(p, c), height(c)) >= 0.85) & (c["ybot"] > p["ybot"] - 0.05 * height(p)) & (height(p) > 0) & (height(c) <= 0.80 * height(p))

    def laid_over(x):
        p, c = x["p"], x["c"]
        return (c["ybot"] < p["ybot"]) & (overlap_y(p, c) > 0) & (ratio(overlap_y(p, c), height(c)) >= 0.35)

    def hardly_lower(x):
        return (height(x["p"]) > 0) & (x["c"]["ytop"] > x["p"]["ytop"] - 0.20 * height(x["p"]))

    # without the trailing marks, the pairs are the first ones
    some = lambda rule: F.exists(F.slice(m["pairs"], F.lit(1), F.greatest(m["end"] - 1, F.lit(0))), rule)
    found = {
        "top_diacritic_collision": (count_of(text, TOP_DIACRITICS) >= 2) & (same | near),
        "top_mark_overlap": last_mark & (F.coalesce(covers, F.lit(False)) | F.coalesce(swallowed, F.lit(False))),
        "top_mark_horizontal_misalignment": last_mark & beside(lambda share, astray: (share < 0.25) & astray),
        "mark_horizontal_misalignment": text.rlike(f"[{LINE_MARKS}]") & beside(lambda share, astray: (share < 0.40) | (share.isNotNull() & astray)),
        "floating_bottom_vowel": text.rlike(f"[{BOTTOM_VOWELS}]") & (at > 0) & floating,
        "subscript_layer_collision": (subjoined >= 4) & (n >= 5) & flat,
        "subscript_horizontal_misalignment": F.exists(m["pairs"], sideways),
        "subscript_containment": (subjoined >= 2) & some(contained),
        "subscript_overlap": (subjoined >= 2) & (n >= 3) & some(laid_over),
        "subscript_insufficient_descent": (subjoined >= 2) & (n >= 3) & (m["end"] >= 3) & some(hardly_lower),
    }
    return {name: F.coalesce(when, F.lit(False)) for name, when in found.items()}


def placement_warnings(text: Column, boxes: Column) -> Column:
    """Names of the warnings, in their order. Fewer than two boxes or no stack height give none."""

    def told(m):
        own, lower, none = _rules(text, boxes, m), WARNINGS[-3:], F.array().cast("array<string>")
        below = F.when(own[lower[0]], lower[0]).when(own[lower[1]], lower[1]).when(own[lower[2]], lower[2])
        upper = F.array(*[F.when(own[name], F.lit(name)) for name in WARNINGS[:5]])
        under = F.when(m["subjoined"] >= 1, F.array(*[F.when(own[name], F.lit(name)) for name in WARNINGS[5:7]], below)).otherwise(none)
        return F.when((m["n"] >= 2) & (m["stack"] > 0), F.array_compact(F.concat(upper, under))).otherwise(none)

    return let(told, **_measures(text, boxes))


def script_tags(text: Column) -> Column:
    """struct<script, language> under which a text is shaped."""
    return F.when(text.rlike("[\\u0F00-\\u0FFF]"), F.struct(F.lit("tibt").alias("script"), F.lit("bo").alias("language"))).otherwise(F.struct(F.lit("latn").alias("script"), F.lit("en").alias("language")))


def verdict(text: Column, boxes: Column, error: Column | None = None) -> Column:
    """struct<ok, support_class, reason, notdef_count, has_dotted_circle, glyph_count, bbox, ink_area, placement_warnings, placement_warning_count>.

    Missing glyphs, dotted circles, empty shapes and no ink come before the placement warnings; without any, reason is "ok". bbox is the least x0
    and ytop and the greatest x1 and ybot. Where the shaper told an error, that is all there is. Null boxes count as none.
    """
    none = boxes.isNull() | (F.size(boxes) == 0)
    glyphs = F.when(none, 0).otherwise(F.size(boxes))
    missing = F.when(none, 0).otherwise(F.size(F.filter(boxes, lambda x: (x["gid"] == 0) | (x["name"] == ".notdef"))))
    dotted = F.coalesce(F.exists(boxes, lambda x: F.lower(x["name"]).rlike("dotted|25cc")), F.lit(False))
    ink = F.coalesce(F.aggregate(boxes, F.lit(0).cast("long"), lambda s, x: s + F.abs(width(x) * height(x)).cast("long")), F.lit(0))
    edge = lambda f, c: f(F.transform(boxes, lambda x: x[c])).cast("string")
    bbox = F.when(none, "").otherwise(F.concat_ws(",", edge(F.array_min, "x0"), edge(F.array_min, "ytop"), edge(F.array_max, "x1"), edge(F.array_max, "ybot")))

    def told(m):
        missing, dotted, ink, placed = m["missing"], m["dotted"], m["ink"], m["placed"]
        first = F.array(F.when(missing > 0, "notdef"), F.when(dotted, "dotted_circle"), F.when(none, "empty_shape"), F.when(~none & (ink == 0), "zero_ink"))

        def listed(r):
            ok = F.size(r["reasons"]) == 0
            return _told(ok, F.when(ok, "ok").otherwise("fail"), F.when(ok, "ok").otherwise(F.array_join(r["reasons"], ";")), missing, dotted, glyphs, bbox, ink, F.array_join(placed, ";"), F.size(placed))

        return let(listed, reasons=F.concat(F.array_compact(first), placed))

    shaped = let(told, missing=missing, dotted=dotted, ink=ink, placed=placement_warnings(text, boxes))
    return shaped if error is None else F.when(error.isNull(), shaped).otherwise(failed("shape_error", F.concat(F.lit("shape_error:"), error)))


def _told(ok, kind, reason, missing, dotted, glyphs, bbox, ink, warnings, count) -> Column:
    names = ["ok", "support_class", "reason", "notdef_count", "has_dotted_circle", "glyph_count", "bbox", "ink_area", "placement_warnings", "placement_warning_count"]
    types = ["boolean", "string", "string", "long", "boolean", "long", "string", "long", "string", "long"]
    return F.struct(*[c.cast(t).alias(n) for c, t, n in zip((ok, kind, reason, missing, dotted, glyphs, bbox, ink, warnings, count), types, names)])


def failed(kind: str, reason: Column) -> Column:
    """The verdict of what was not shaped."""
    zero, blank = F.lit(0), F.lit("")
    return _told(F.lit(False), F.lit(kind), reason, zero, F.lit(False), zero, blank, zero, blank, zero)


def final_verdict(kind: Column, skt_ok: Column, is_standard: Column, font_error: Column, shaped: Column) -> Column:
    """The verdict of a renderer and a probe: an unreadable renderer comes first, then stacks that are not standard for a renderer that isn't meant to
    have them, then what was shaped, with the class named after the kind of test where it is ok."""
    passed = F.when(kind == "normal", "normal_tibetan_ok").when(kind == "latin", "latin_digit_punct_ok").otherwise("complex_stack_ok")
    out = F.when(font_error.isNotNull(), failed("font_error", F.concat(F.lit("font_error:"), font_error)))
    out = out.when((kind == "stack") & (skt_ok == 0) & (is_standard == 0), failed("non_standard_for_skt0", F.lit("non_standard_tibetan_for_skt0")))
    return out.otherwise(shaped.withField("support_class", F.when(shaped["ok"], passed).otherwise(shaped["support_class"])))


def stack_metrics(text: Column) -> Column:
    """struct of a stack's length, code points, counts of base letters, subjoined letters and vowels, and its complexity."""
    base, below, vowels = (count_of(text, c).cast("long") for c in (BASE_LETTERS, SUBJOINED, VOWELS))
    return F.struct(
        F.length(text).cast("long").alias("stack_len"),
        base.alias("base_count"),
        below.alias("subjoined_count"),
        vowels.alias("vowel_diacritic_count"),
        (below > 0).alias("has_subjoined"),
        (vowels > 0).alias("has_vowel_diacritic"),
        (below + vowels + F.greatest(F.lit(0), base - 1)).alias("complexity"),
    )
