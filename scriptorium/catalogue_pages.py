"""Queries of pages and their characters: random page text, layout in passes, metrics of stacks, names passed over; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import characters
from .functions import text as tx
from .plans import layout, numbering
from .registered import query, table

SPACES = "[\\s\\p{Z}]"
PIECE = "Vox clamantis in deserto: quid est. 0123456789"


@query(f"""
    WITH t AS (SELECT doc_id, regexp_replace(replace(text, chr(10), chr(10) || '-- Page 3 --' || chr(10) || '§ '), '§ ?', '', 'g') AS t FROM documents),
      l AS (SELECT doc_id, string_split(array_to_string(list_filter(string_split(t, chr(10)), lambda x: NOT regexp_full_match(x, '\\s*--\\s*page\\s+[0-9]+\\s*--\\s*', 'i')), chr(10)), '.') AS parts FROM t),
      u AS (SELECT doc_id, i - 2 AS i, regexp_replace(parts[i], '^{SPACES}+|{SPACES}+$', '', 'g') || '.' AS u FROM l, unnest(range(2, len(parts) + 1)) AS r(i)),
      k AS (SELECT * FROM u WHERE u <> '.' AND length(u) BETWEEN 20 AND 220 AND NOT contains(u, '  ') AND NOT regexp_matches(u, '[0-9]')),
      pool AS (SELECT *, false AS plain FROM k UNION ALL SELECT *, true FROM k WHERE NOT contains(u, 'th') AND NOT contains(u, 'qu')),
      n AS (SELECT *, row_number() OVER (PARTITION BY plain ORDER BY sha1('7:unit:' || doc_id || ':' || i)) - 1 AS number, count(*) OVER (PARTITION BY plain) AS many FROM pool),
      p AS (SELECT s_suppkey AS s, s_suppkey % 3 = 0 AS plain, 60 + ('0x' || substr(sha1('7:many:' || s_suppkey), 1, 15))::BIGINT % 31 AS wanted FROM supplier),
      d AS (SELECT s, p.plain, wanted, a, ('0x' || substr(sha1('7:draw:' || s || ':' || a), 1, 15))::BIGINT % m.many AS number FROM p JOIN (SELECT plain, count(*) AS many FROM pool GROUP BY plain) m ON m.plain = p.plain, range(0, 215) AS r(a)),
      g AS (SELECT s, d.plain, wanted, a, u FROM d JOIN n ON n.plain = d.plain AND n.number = d.number),
      b AS (SELECT s, string_agg(u, ' ' ORDER BY sha1('7:place:' || s || ':' || a)) AS body FROM (SELECT s, a, u FROM g WHERE a < wanted UNION ALL SELECT DISTINCT s, -1, '{PIECE}' FROM g WHERE NOT plain) GROUP BY s),
      x AS (SELECT g.s, a, u, length(body) + coalesce(sum(length(u) + 1) OVER (PARTITION BY g.s ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g JOIN b ON b.s = g.s WHERE a >= wanted),
      e AS (SELECT s, string_agg(' ' || u, '' ORDER BY a) AS more FROM x WHERE before < 4500 GROUP BY s)
    SELECT b.s AS s_suppkey, '¶ ' || regexp_replace(regexp_replace(left(body || coalesce(more, ''), 6000), '{SPACES}+', ' ', 'g'), '^ | $', '', 'g') AS text FROM b LEFT JOIN e ON e.s = b.s""")
def random_pages(spark, d):
    """Whole pages; every third supplier can't show two of the substrings, one of which is in the mandatory piece."""
    marked = F.replace("text", F.lit("\n"), F.lit("\n-- Page 3 --\n§ "))
    units = table(spark, d, "documents").select("doc_id", F.posexplode(tx.later_units(marked, tx.LATIN, "§ ?")).alias("i", "unit"))
    usable = tx.usable_units(units, "unit", foreign="0-9")
    pages = table(spark, d, "supplier").select("s_suppkey")
    return layout.random_pages(pages, usable, "s_suppkey", "unit", ["doc_id", "i"], tx.LATIN, F.col("s_suppkey") % 3 == 0, ["th", "qu"], PIECE, "¶ ", seed=7)


def _merged(k: int) -> str:
    """SQL of a pass: r{k} to r{k + 1}."""
    return f"""
      a{k} AS (SELECT *, {SHORT} AND lead(doc_id) OVER (PARTITION BY batch ORDER BY doc_id) IS NOT NULL AS able FROM r{k}),
      b{k} AS (SELECT *, sum((NOT able)::INT) OVER (PARTITION BY batch ORDER BY doc_id) AS run FROM a{k}),
      t{k} AS (SELECT *, able AND sum(able::INT) OVER (PARTITION BY batch, run ORDER BY doc_id) % 2 = 1 AS takes FROM b{k}),
      f{k} AS (SELECT *, CASE WHEN coalesce(lag(takes) OVER w, false) THEN lag(doc_id) OVER w ELSE doc_id END AS head, max(able::INT) OVER (PARTITION BY batch) AS more FROM t{k} WINDOW w AS (PARTITION BY batch ORDER BY doc_id)),
      r{k + 1} AS (SELECT batch, head AS doc_id, string_agg(text, ' ' ORDER BY doc_id) AS text, sum(n_chars)::BIGINT AS n_chars, max(longest) AS longest, string_agg(ids, '|' ORDER BY doc_id) AS ids, max(passes + more)::INT AS passes FROM f{k} GROUP BY batch, head)"""


#: A page holds 50 lines of 90 characters; one of up to 40 lines is short.
SHORT = "ceil(length(text) / 90.0) <= 40"


@query(f"""
    WITH r0 AS (SELECT doc_id // 100 AS batch, doc_id, coalesce(regexp_replace(text, '^{SPACES}+|{SPACES}+$', '', 'g'), '') AS text, coalesce(n_chars, 0) AS n_chars, coalesce(n_chars, 0) AS longest, doc_id::VARCHAR AS ids, 0 AS passes FROM documents), {",".join(_merged(k) for k in range(3))}
    SELECT batch, doc_id, sha1(text) AS text_sha1, n_chars, longest, ids, {SHORT} AS short, passes FROM r3""")
def settled_pages(spark, d):
    """Short pages joined until their batch is settled, for at most three passes."""
    docs = table(spark, d, "documents").select(F.floor(F.col("doc_id") / 100).alias("batch"), "doc_id", "text", F.col("n_chars").cast("long").alias("n_chars"), F.col("n_chars").cast("long").alias("longest"), F.col("doc_id").alias("ids"))
    found = layout.merge_until_settled(docs, lambda: F.ceil(F.length("text") / 90) <= 40, "batch", "doc_id", "text", ["n_chars"], ["longest"], ["ids"], passes=3)
    return found.withColumn("text", F.sha1("text")).withColumnRenamed("text", "text_sha1")


#: Letters from U+0F40 on, and subjoined ones from U+0F90 on; fixed values. The ninth is no character.
LETTERS = "KA KHA GA GHA NGA CA CHA JA ? NYA TTA TTHA DDA DDHA NNA TA THA DA DHA NA PA PHA BA BHA MA TSA TSHA DZA DZHA WA ZHA ZA -A YA RA LA SHA SSA SA HA A KSSA"


@query(f"""
    WITH k AS (SELECT p_partkey % 42 AS o, p_size % 42 AS s, p_partkey % 3 > 0 AS subjoined, p_partkey % 6 AS v, p_partkey % 4 = 0 AS latin, string_split('{LETTERS}', ' ') AS l FROM part),
      c AS (SELECT list_filter([
          {{'c': 3904 + o, 'n': CASE WHEN o = 8 THEN 'UNKNOWN' ELSE 'TIBETAN LETTER ' || l[o + 1] END, 'k': 'base', 'm': 0}},
          CASE WHEN subjoined THEN {{'c': 3984 + s, 'n': CASE WHEN s = 8 THEN 'UNKNOWN' ELSE 'TIBETAN SUBJOINED LETTER ' || l[s + 1] END, 'k': 'subjoined', 'm': 0}} END,
          CASE WHEN v > 0 THEN {{'c': [3953, 3954, 3956, 3962, 3966][v], 'n': 'TIBETAN ' || ['VOWEL SIGN AA', 'VOWEL SIGN I', 'VOWEL SIGN U', 'VOWEL SIGN E', 'SIGN RJES SU NGA RO'][v], 'k': 'vowel', 'm': (v < 5)::INT}} END,
          CASE WHEN latin THEN {{'c': 97 + s % 26, 'n': 'LATIN SMALL LETTER ' || chr((65 + s % 26)::INT), 'k': 'other', 'm': 0}} END], lambda x: x IS NOT NULL) AS c, v FROM k),
      f AS (SELECT array_to_string(list_transform(c, lambda x: chr(x.c::INT)), '') AS stack, c, v, len(list_filter(c, lambda x: x.k = 'subjoined')) AS b, len(list_filter(c, lambda x: x.k = 'vowel')) AS w FROM c)
    SELECT stack, count(*) AS occurrences, len(c) AS stack_len, array_to_string(list_transform(c, lambda x: CASE WHEN x.c < 256 THEN printf('U+00%X', x.c::INT) ELSE printf('U+0%X', x.c::INT) END), ' ') AS codepoints, array_to_string(list_transform(c, lambda x: x.n), ' | ') AS unicode_names,
      1::BIGINT AS base_count, b AS subjoined_count, w AS vowel_diacritic_count, list_sum(list_transform(c, lambda x: x.m))::BIGINT AS combining_count, b > 0 AS has_subjoined, w > 0 AS has_vowel_diacritic, v IN (1, 3) AS has_bottom_vowel, b + w AS complexity
    FROM f GROUP BY ALL""")
def stack_metrics(spark, d):
    """Stacks from the keys of parts: letters that aren't assigned, subjoined ones, vowels below and above, Latin among them."""
    k, s = F.col("p_partkey"), F.col("p_size")
    # chr stops at 255, so the block's characters come from their UTF-8 bytes
    point = lambda n: F.decode(F.unhex(F.concat(F.lit("E0"), F.hex(F.lit(0x80) + F.shiftright(n, 6) % 64), F.hex(F.lit(0x80) + n % 64))), "UTF-8")
    vowels = F.array(*map(F.lit, ("", "ཱ", "ི", "ུ", "ེ", "ཾ")))
    below = F.when(k % 3 > 0, point((F.lit(0x0F90) + s % 42).cast("int"))).otherwise("")
    latin = F.when(k % 4 == 0, F.chr(F.lit(97) + s % 42 % 26)).otherwise("")
    stack = F.concat(point((F.lit(0x0F40) + k % 42).cast("int")), below, F.get(vowels, (k % 6).cast("int")), latin)
    return characters.stack_table(table(spark, d, "part").select(stack.alias("stack")), "stack")


@query("""
    WITH w AS (SELECT p_partkey, p_brand AS name, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part)
    SELECT p_partkey, name, CASE WHEN k = 1 THEN name ELSE name || '_' || k END AS unique_name FROM w
    UNION ALL SELECT -max(p_size), p_brand || '_1', p_brand || '_1' FROM part GROUP BY p_brand""")
def passed_over_names(spark, d):
    """Every made name, where one number of each brand is taken by a name by nature."""
    part = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("name"))
    taken = table(spark, d, "part").groupBy("p_brand").agg((-F.max("p_size")).cast("long").alias("p_partkey")).select("p_partkey", F.concat("p_brand", F.lit("_1")).alias("name"))
    return numbering.unique_names(part.unionByName(taken), [], "name", ["p_partkey"])
