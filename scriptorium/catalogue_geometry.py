"""Queries of the geometric rules, over boxes and texts made from whole orders, and the SQL that states each rule over rows instead of arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import geometry
from .registered import query, table

#: What a line adds to the text of its order: subjoined letters, vowels and marks.
PARTS = ["ྐ", "ྲ", "ྱ", "ི", "ུ", "ཾ", "ྂ", "༷", "ྔ", "ཱ", "ྲ", "ཾ"]

#: The character classes of the rules as RE2 writes them.
BELOW, DIACRITICS, SIDE = r"\x{F90}-\x{FBC}", r"\x{F7E}\x{F82}\x{F83}", r"\x{F35}\x{F37}"
MARKS, VOWELS = r"\x{F72}\x{F7A}-\x{F7E}\x{F80}\x{F82}\x{F83}", r"\x{F71}\x{F73}-\x{F77}\x{F80}\x{F81}"

SHAPES = f"""
    l AS (SELECT l_orderkey AS o, l_suppkey AS s, l_partkey AS p, l_quantity::BIGINT AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS i FROM lineitem),
    b AS (SELECT o, i, p % 31 AS gid, CASE WHEN p % 97 = 0 THEN 'uni25CC' ELSE 'g' || p % 7 END AS name, (s * (o % 3)) % 5 * 30 AS x0, (s * (o % 3)) % 5 * 30 + q % 6 * 20 AS x1,
        CASE WHEN o % 2 = 0 THEN 100 - (i - 1) * (o % 5 * 12) ELSE 100 - p % 90 END AS ytop,
        CASE WHEN o % 2 = 0 THEN 100 - (i - 1) * (o % 5 * 12) ELSE 100 - p % 90 END - q * 3 % 70 + 4 AS ybot FROM l),
    t AS (SELECT o, string_agg(CASE WHEN i = 1 THEN 'ཀ' ELSE {PARTS}[((p * 7 + i * (o % 4)) % 12)::INT + 1] END, '' ORDER BY i) AS text, count(*) AS n FROM l GROUP BY o),
    m AS (SELECT o, text, n, length(regexp_replace(text, '[^{BELOW}]', '', 'g')) AS sub, length(regexp_replace(text, '[^{DIACRITICS}]', '', 'g')) AS tops, regexp_matches(text, '[{MARKS}]$') AS marked,
        length(regexp_extract(text, '[{MARKS}]*$')) AS trail FROM t),
    e AS (SELECT m.*, f.ytop AS top, f.ytop - (SELECT min(ybot) FROM b WHERE b.o = m.o) AS stack, z.x0 AS zx0, z.x1 AS zx1, z.ytop AS ztop, z.ybot AS zbot, y.ytop AS ptop, y.ybot AS pbot,
        (SELECT min(x0) FROM b WHERE b.o = m.o AND i < n) AS ox0, (SELECT max(x1) FROM b WHERE b.o = m.o AND i < n) AS ox1
        FROM m JOIN b f ON f.o = m.o AND f.i = 1 JOIN b z ON z.o = m.o AND z.i = n LEFT JOIN b y ON y.o = m.o AND y.i = n - 1),
    pairs AS (SELECT p.o, p.i, p.x0 AS px0, p.x1 AS px1, p.ytop AS pt, p.ybot AS pb, c.x0 AS cx0, c.x1 AS cx1, c.ytop AS ct, c.ybot AS cb, c.ytop - c.ybot AS ch, p.ytop - p.ybot AS ph,
        least(p.ytop, c.ytop) - greatest(p.ybot, c.ybot) AS oy, greatest(0, least(p.x1, c.x1) - greatest(p.x0, c.x0)) AS ox,
        c.i <= CASE WHEN n >= trail THEN n - trail ELSE greatest(2 * n - trail, 0) END AS body
        FROM b p JOIN b c ON c.o = p.o AND c.i = p.i + 1 JOIN m ON m.o = p.o),
    g1 AS (SELECT o, max(ct) >= 2 AS same FROM (SELECT o, count(*) AS ct FROM b WHERE i > 1 GROUP BY o, name, x0, ytop, x1, ybot) GROUP BY o),
    h1 AS (SELECT b.o, count(*) >= 2 AND max((x0 + x1) / 2.0) - min((x0 + x1) / 2.0) <= .08 * avg(abs(x1 - x0)) AND max((ytop + ybot) / 2.0) - min((ytop + ybot) / 2.0) <= .08 * avg(abs(ytop - ybot)) AS near
        FROM b JOIN e USING (o) WHERE i > 1 AND ybot >= top - .05 * CASE WHEN top = 0 THEN 1 ELSE abs(top) END GROUP BY b.o),
    g6 AS (SELECT b.o, count(*) >= 4 AND max(ytop) - min(ytop) <= .18 * any_value(stack) AND count(DISTINCT name) >= 4 AS flat FROM b JOIN e USING (o)
        WHERE i > 1 AND i <= CASE WHEN n >= trail THEN n - trail ELSE greatest(2 * n - trail, 0) END GROUP BY b.o),
    g2 AS (SELECT b.o, bool_or(b.ytop > b.ybot AND ztop > zbot AND (least(ztop, b.ytop) - greatest(zbot, b.ybot)) >= .75 * (ztop - zbot) AND ztop <= b.ytop) AS swallowed FROM b JOIN e USING (o) WHERE i < n GROUP BY b.o),
    side AS (SELECT *, CASE WHEN zx1 > zx0 THEN greatest(0, least(zx1, ox1) - greatest(zx0, ox0)) / (zx1 - zx0)::DOUBLE END AS beside,
        (zx0 + zx1) / 2.0 < ox0 - .1 * greatest(1, ox1 - ox0) OR (zx0 + zx1) / 2.0 > ox1 + .1 * greatest(1, ox1 - ox0) AS astray FROM e),
    v AS (SELECT e.o, a.ytop AS vt, a.ybot AS vb, a.ytop - a.ybot AS vh, c.ytop AS qt, c.ybot AS qb, c.ytop - c.ybot AS qh, least(a.ytop, c.ytop) - greatest(a.ybot, c.ybot) AS oy, stack
        FROM e JOIN b a ON a.o = e.o AND a.i = n - marked::INT JOIN b c ON c.o = e.o AND c.i = a.i - 1),
    pr AS (SELECT o, bool_or(px1 > px0 AND cx1 > cx0 AND ch > 0 AND ox < .25 * (cx1 - cx0) AND (greatest(0, oy) >= .35 * ch OR (ct - pb >= 0 AND ct - pb <= .08 * greatest(1, ph)))
            AND ((cx0 + cx1) / 2.0 < px0 - .1 * (px1 - px0) OR (cx0 + cx1) / 2.0 > px1 + .1 * (px1 - px0))) AS sideways,
        bool_or(body AND cb > pb AND ph > 0 AND ch > 0 AND oy >= .85 * ch AND cb > pb - .05 * ph AND ch <= .8 * ph) AS contained,
        bool_or(body AND cb < pb AND ch > 0 AND oy > 0 AND oy >= .35 * ch) AS laid,
        bool_or(body AND ph > 0 AND ct > pt - .2 * ph) AS hardly FROM pairs GROUP BY o),
    r AS (SELECT side.o AS l_orderkey, side.text, side.n, side.stack, sub,
        tops >= 2 AND (coalesce(same, false) OR coalesce(near, false)) AS top_diacritic_collision,
        marked AND n >= 2 AND ztop > zbot AND ((least(ztop, ptop) - greatest(zbot, pbot) >= .65 * (ztop - zbot) AND zbot < ptop) OR coalesce(swallowed, false)) AS top_mark_overlap,
        coalesce(marked AND beside < .25 AND astray, false) AS top_mark_horizontal_misalignment,
        regexp_matches(text, '[{SIDE}]') AND coalesce(beside < .4 OR (beside IS NOT NULL AND astray), false) AS mark_horizontal_misalignment,
        regexp_matches(text, '[{VOWELS}]') AND coalesce(vt > qt - .1 * v.stack OR (qh > 0 AND vb > qb + .1 * qh) OR (vh > 0 AND oy >= .85 * vh AND vb > qb - .08 * v.stack) OR (vh > 0 AND oy >= .45 * vh AND vt > qb + .2 * vh), false) AS floating_bottom_vowel,
        sub >= 4 AND n >= 5 AND coalesce(flat, false) AS subscript_layer_collision,
        coalesce(sideways, false) AS subscript_horizontal_misalignment,
        sub >= 2 AND coalesce(contained, false) AS subscript_containment,
        sub >= 2 AND n >= 3 AND coalesce(laid, false) AS subscript_overlap,
        sub >= 2 AND n >= 3 AND CASE WHEN n >= trail THEN n - trail ELSE greatest(2 * n - trail, 0) END >= 3 AND coalesce(hardly, false) AS subscript_insufficient_descent
        FROM side LEFT JOIN g1 USING (o) LEFT JOIN h1 USING (o) LEFT JOIN g2 USING (o) LEFT JOIN g6 USING (o) LEFT JOIN pr USING (o) LEFT JOIN v USING (o))"""


def shapes(spark, d):
    """o, text, boxes of every order: a line is a glyph."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    o = F.col("o")

    def box(x, i):
        p, s, q = x["l_partkey"], x["l_suppkey"], x["l_quantity"].cast("long")
        x0 = (s * (o % 3)) % 5 * 30
        top = F.when(o % 2 == 0, 100 - i * (o % 5 * 12)).otherwise(100 - p % 90)
        name = F.when(p % 97 == 0, "uni25CC").otherwise(F.concat(F.lit("g"), (p % 7).cast("string")))
        return F.struct((p % 31).alias("gid"), name.alias("name"), x0.alias("x0"), top.alias("ytop"), (x0 + q % 6 * 20).alias("x1"), (top - q * 3 % 70 + 4).alias("ybot"))

    char = lambda x, i: F.when(i == 0, "ཀ").otherwise(F.get(F.array(*map(F.lit, PARTS)), ((x["l_partkey"] * 7 + (i + 1) * (o % 4)) % 12).cast("int")))
    return lines.select("o", F.array_join(F.transform("lines", char), "").alias("text"), F.transform("lines", box).alias("boxes"))


def _rule(name):
    @query(f"WITH {SHAPES} SELECT l_orderkey, n >= 2 AND {name} AS flagged FROM r", name=f"geometry_{name}")
    def flagged(spark, d):
        return shapes(spark, d).select(F.col("o").alias("l_orderkey"), ((F.size("boxes") >= 2) & geometry.rules(F.col("text"), F.col("boxes"))[name]).alias("flagged"))


for _name in geometry.WARNINGS:
    _rule(_name)

_TOLD = ", ".join(f"CASE WHEN {w} THEN '{w}' END" for w in geometry.WARNINGS[:5])
_BELOW = ", ".join(f"CASE WHEN {w} THEN '{w}' END" for w in geometry.WARNINGS[5:7])
_LOW = " ".join(f"WHEN {w} THEN '{w}'" for w in geometry.WARNINGS[7:])
VERDICTS = f"""{SHAPES},
    w AS (SELECT l_orderkey, CASE WHEN n >= 2 AND stack > 0 THEN concat_ws(';', {_TOLD}, CASE WHEN sub >= 1 THEN nullif(concat_ws(';', {_BELOW}, CASE {_LOW} END), '') END) ELSE '' END AS warned FROM r),
    k AS (SELECT o AS l_orderkey, sum((gid = 0)::INT)::BIGINT AS notdef_count, bool_or(name = 'uni25CC') AS dotted, count(*) AS glyph_count, min(x0) || ',' || min(ytop) || ',' || max(x1) || ',' || max(ybot) AS bbox,
        sum(abs((x1 - x0) * (ytop - ybot)))::BIGINT AS ink_area FROM b GROUP BY o),
    s AS (SELECT *, concat_ws(';', CASE WHEN notdef_count > 0 THEN 'notdef' END, CASE WHEN dotted THEN 'dotted_circle' END, CASE WHEN ink_area = 0 THEN 'zero_ink' END, nullif(warned, '')) AS why FROM k JOIN w USING (l_orderkey))"""


@query(f"""
    WITH {VERDICTS}
    SELECT l_orderkey, CASE WHEN l_orderkey % 50 = 7 THEN false ELSE why = '' END AS ok, CASE WHEN l_orderkey % 50 = 7 THEN 'shape_error' WHEN why = '' THEN 'ok' ELSE 'fail' END AS support_class,
      CASE WHEN l_orderkey % 50 = 7 THEN 'shape_error:out of memory' WHEN why = '' THEN 'ok' ELSE why END AS reason, CASE WHEN l_orderkey % 50 = 7 THEN 0 ELSE notdef_count END AS notdef_count,
      CASE WHEN l_orderkey % 50 = 7 THEN '' ELSE bbox END AS bbox, CASE WHEN l_orderkey % 50 = 7 THEN 0 ELSE ink_area END AS ink_area, CASE WHEN l_orderkey % 50 = 7 THEN '' ELSE warned END AS placement_warnings FROM s""")
def geometry_verdicts(spark, d):
    error = F.when(F.col("o") % 50 == 7, "out of memory")
    rows = shapes(spark, d).select("o", geometry.verdict(F.col("text"), F.col("boxes"), error).alias("v"))
    return rows.select(F.col("o").alias("l_orderkey"), "v.ok", "v.support_class", "v.reason", "v.notdef_count", "v.bbox", "v.ink_area", "v.placement_warnings")


@query(f"""
    WITH {VERDICTS}, c AS (SELECT *, ['normal', 'latin', 'stack'][(l_orderkey % 3)::INT + 1] AS kind, [0, 1, NULL][(l_orderkey // 3 % 3)::INT + 1] AS skt, l_orderkey // 9 % 2 AS standard, l_orderkey % 41 = 3 AS bad FROM s)
    SELECT l_orderkey, NOT bad AND NOT coalesce(kind = 'stack' AND skt = 0 AND standard = 0, false) AND why = '' AS ok,
      CASE WHEN bad THEN 'font_error' WHEN kind = 'stack' AND skt = 0 AND standard = 0 THEN 'non_standard_for_skt0' WHEN why <> '' THEN 'fail' WHEN kind = 'normal' THEN 'normal_tibetan_ok' WHEN kind = 'latin' THEN 'latin_digit_punct_ok' ELSE 'complex_stack_ok' END AS support_class,
      CASE WHEN bad THEN 'font_error:unreadable' WHEN kind = 'stack' AND skt = 0 AND standard = 0 THEN 'non_standard_tibetan_for_skt0' WHEN why = '' THEN 'ok' ELSE why END AS reason FROM c""")
def geometry_final_verdicts(spark, d):
    o = F.col("o")
    kind = F.get(F.array(*map(F.lit, ("normal", "latin", "stack"))), (o % 3).cast("int"))
    skt = F.get(F.array(F.lit(0), F.lit(1), F.lit(None)), (F.floor(o / 3) % 3).cast("int"))
    bad = F.when(o % 41 == 3, "unreadable")
    shaped = shapes(spark, d).select("o", geometry.verdict(F.col("text"), F.col("boxes")).alias("shaped"))
    rows = shaped.select("o", geometry.final_verdict(kind, skt, F.floor(o / 9) % 2, bad, F.col("shaped")).alias("v"))
    return rows.select(F.col("o").alias("l_orderkey"), "v.ok", "v.support_class", "v.reason")
