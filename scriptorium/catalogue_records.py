"""Queries of readers, writers, fonts, page maps, resuming, subsets and audits, over the driver tables, and their SQL.

Readers are tried on files that a query first writes to the shared folder from whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import names, text as tx
from .operators import audit, fonts, records
from .plans import numbering, quotas
from .registered import query, table
from .sources import sinks, tables
from .sources.shared import new_folder


def _lines(spark, frame, label):
    """Writes the column value as text to the shared folder."""
    path = f"{new_folder(spark, label)}.txt"
    frame.select("value").write.text(path)
    return path


@query("""
    SELECT s_name AS basename, CASE WHEN s_suppkey % 2 = 0 THEN '/fonts/' ELSE '/base/fonts/' END || s_suppkey || '.ttf' AS font_path, (s_suppkey % 3)::BIGINT AS ttc_face_index,
      CASE WHEN s_suppkey % 4 = 0 THEN 24.0 ELSE s_nationkey + 0.5 END AS font_size_pt, CASE WHEN s_suppkey % 5 = 0 THEN 300 ELSE 100 + s_nationkey END::BIGINT AS dpi, CASE s_suppkey % 3 WHEN 2 THEN NULL ELSE s_suppkey % 3 END::INT AS skt_ok
    FROM supplier WHERE s_suppkey % 11 <> 0""")
def font_csv_scan(spark, d):
    k, blank = F.col("s_suppkey"), F.lit("")
    path = new_folder(spark, "fonts")
    table(spark, d, "supplier").select(
        F.when(k % 11 == 0, blank).otherwise(F.concat(F.lit(" "), "s_name", F.lit(" "))).alias("basename"),
        F.concat(F.when(k % 2 == 0, "/fonts/").otherwise("fonts/"), k.cast("string"), F.lit(".ttf")).alias("font_path"),
        F.concat((k % 3).cast("string"), F.when(k % 2 == 0, ".0").otherwise("")).alias("ttc_face_index"),
        F.when(k % 4 == 0, blank).otherwise((F.col("s_nationkey") + 0.5).cast("string")).alias("font_size_pt"),
        F.when(k % 5 == 0, blank).otherwise((100 + F.col("s_nationkey")).cast("string")).alias("dpi"),
        F.when(k % 3 == 2, "maybe").otherwise((k % 3).cast("string")).alias("skt_ok"),
    ).write.option("header", True).csv(path)
    return tables.font_csv(spark, path, "/base").select("basename", "font_path", "ttc_face_index", "font_size_pt", "dpi", "skt_ok")


@query("SELECT p_type AS stack, (min(p_partkey) % 3 <> 1)::INT AS is_standard, min_by(p_size, p_partkey)::BIGINT AS n FROM part GROUP BY p_type")
def stack_csv_scan(spark, d):
    """Types of parts as stacks; the first line of a type counts."""
    path = f"{new_folder(spark, 'stacks')}.csv"
    flag = F.when(F.col("p_partkey") % 3 == 0, "1").when(F.col("p_partkey") % 3 == 1, "0").otherwise("")
    rows = table(spark, d, "part").repartitionByRange(5, "p_partkey").sortWithinPartitions("p_partkey")
    rows = rows.select(F.concat(F.lit(" "), "p_type").alias("stack"), flag.alias("hunspell_bo"), F.col("p_size").alias("nb_occurences"))
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("emptyValue", "").csv(path)
    latin = tx.Profile("A-Za-z ", tx.LATIN.token, ".", " ", ".....")
    return tables.stacks(spark, path, p=latin)


@query("SELECT DISTINCT word AS stack FROM (SELECT unnest(string_split(p_name || ' ' || p_type || ' ' || p_brand, ' ')) AS word FROM part) WHERE regexp_full_match(word, '[A-Za-z]+')")
def stack_list_scan(spark, d):
    both = table(spark, d, "part").select(F.explode(F.split(F.concat_ws(" ", "p_name", "p_type", "p_brand"), " ")).alias("word")).select(F.concat(F.lit(" "), "word").alias("value"))
    return tables.stacks(spark, _lines(spark, both.union(both), "list"), p=tx.LATIN).select("stack")


@query("SELECT r_name AS probe, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey)::BIGINT AS nations FROM region WHERE r_regionkey <> 2")
def membership_list_scan(spark, d):
    """A list file with comments and blanks, joined as a set."""
    rows = table(spark, d, "region").select(F.when(F.col("r_regionkey") == 2, F.concat(F.lit("# "), "r_name")).otherwise(F.concat(F.lit(" "), "r_name", F.lit("\t"))).alias("value"))
    listed = tables.probe_lines(spark, _lines(spark, rows.select(F.trim(F.translate("value", "\t", " ")).alias("value")).union(spark.range(2).select(F.lit("").alias("value"))), "members"))
    nations = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return nations.join(listed, F.col("r_name") == F.col("probe")).groupBy("probe").agg(F.count("*").alias("nations"))


PROBE_LISTS = f"(SELECT 'normal' AS test_kind, unnest({tables.NORMAL_PROBES}) AS probe UNION ALL SELECT 'latin', unnest({tables.LATIN_PROBES}))"


@query(f"SELECT s_suppkey, test_kind, count(*) AS tested, sum(length(probe))::BIGINT AS points, string_agg(probe, '' ORDER BY probe) AS probes FROM supplier, {PROBE_LISTS} WHERE test_kind = 'latin' OR s_suppkey % 3 <> 0 GROUP BY ALL")
def inline_probe_jobs(spark, d):
    """Every font with the probes that need no file; each third font with the Latin ones alone."""
    jobs = table(spark, d, "supplier").select("s_suppkey").crossJoin(F.broadcast(tables.inline_probes(spark)))  # a fixed list of 62
    jobs = jobs.filter((F.col("test_kind") == "latin") | (F.col("s_suppkey") % 3 != 0))
    return jobs.groupBy("s_suppkey", "test_kind").agg(F.count("*").alias("tested"), F.sum(F.length("probe")).alias("points"), F.array_join(F.array_sort(F.collect_list("probe")), "").alias("probes"))


NULLED = "CASE WHEN doc_id % 7 = 3 THEN NULL ELSE text END"


@query(f"SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS row_index, sha1(text) AS digest FROM (SELECT doc_id, {NULLED} AS text FROM documents) QUALIFY text IS NOT NULL")
def numbered_with_nulls(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 7 != 3, F.col("text")).alias("text"))
    return tables.numbered_texts(docs, "text", "doc_id").select("row_index", F.sha1("text").alias("digest"))


@query(f"SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS row_index, sha1(text) AS digest FROM (SELECT doc_id, {NULLED} AS text FROM documents) WHERE text IS NOT NULL")
def numbered_without_nulls(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 7 != 3, F.col("text")).alias("text"))
    return tables.numbered_texts(docs, "text", "doc_id", nulls_count=False).select("row_index", F.sha1("text").alias("digest"))


@query("SELECT o_orderpriority AS i_id, 'VE' || o_orderstatus AS ve_id, 'm' AS mode, count(*) AS n, sum(o_orderkey)::BIGINT AS total FROM orders GROUP BY ALL")
def alignment_files(spark, d):
    """Rows written as a file per volume and read back with the ids of the files' names."""
    path = new_folder(spark, "alignments")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    sinks.write_parquet(orders.repartition("o_orderpriority", "o_orderstatus"), path, ["o_orderpriority", "o_orderstatus"])
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    files = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    flat = new_folder(spark, "named")
    files.mkdirs(fs_path(flat))
    for first in files.listStatus(fs_path(path)):  # a file per volume
        for second in files.listStatus(first.getPath()) if first.isDirectory() else []:
            i, ve = (x.getPath().getName().split("=")[1].replace("%20", " ") for x in (first, second))
            for part in files.listStatus(second.getPath()):
                if part.getPath().getName().endswith(".parquet"):
                    files.rename(part.getPath(), fs_path(f"{flat}/{i.replace('-', '_')}-VE{ve}-m.parquet"))
    rows = tables.alignments(spark, flat, "o_orderkey long")
    return rows.groupBy(F.replace(F.replace("i_id", F.lit("_"), F.lit("-")), F.lit("%20"), F.lit(" ")).alias("i_id"), "ve_id", "mode").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("total"))


@query("SELECT c_mktsegment || '.ttf' AS file, n_name AS family, array_to_string(list_sort(list_distinct([c_mktsegment, n_name])), ', ') AS names FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def catalog_table_round_trip(spark, d):
    """A catalog written as markdown lines and read back."""
    rows = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat("c_mktsegment", F.lit(".ttf")).alias("file"), F.col("n_name").alias("family"), F.array("n_name", "c_mktsegment").alias("names")).distinct()
    return tables.markdown_table(spark, _lines(spark, sinks.markdown_rows(rows), "catalog"))


@query("""
    SELECT n_name AS file, CASE WHEN n_nationkey % 6 = 0 THEN 'Error' ELSE r_name END AS family,
      CASE WHEN n_nationkey % 6 = 0 THEN 'Error' ELSE array_to_string(list_sort(list_distinct([n_name || ' Bold', r_name, 'PS' || n_nationkey])), ';') END AS names FROM nation JOIN region ON n_regionkey = r_regionkey""")
def scanned_font_faces(spark, d):
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    line = F.concat("r_name", F.lit(" | "), "n_name", F.lit(" Bold, "), "r_name", F.lit("|PS"), F.col("n_nationkey").cast("string"), F.when(F.col("n_nationkey") % 6 == 0, "|more").otherwise(""))
    return fonts.scanned_faces(rows.select(F.col("n_name").alias("file"), line.alias("line"))).withColumn("names", F.array_join("names", ";"))


@query("""
    SELECT r_name || CASE WHEN n > 1 THEN '_ttc_' || (row_number() OVER (PARTITION BY r_regionkey ORDER BY n_name) - 1) ELSE '' END AS basename, CASE WHEN n > 1 THEN row_number() OVER (PARTITION BY r_regionkey ORDER BY n_name) - 1 END::INT AS ttc_face_index, n_name AS face
    FROM nation JOIN region ON n_regionkey = r_regionkey JOIN (SELECT n_regionkey AS k, count(*) AS n FROM nation GROUP BY k) ON k = r_regionkey""")
def collection_faces(spark, d):
    listed = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("faces"))
    files = listed.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat(F.lit("a/b/"), "r_name", F.lit(".ttc")).alias("path"), "faces")
    return fonts.faces(files).drop("path")


@query("""
    WITH c AS (SELECT l_suppkey AS s, list(DISTINCT 3800 + l_partkey % 400) AS cmap, list(DISTINCT l_shipdate::DATE) AS x, bool_or(l_linenumber = 1) AS mark, bool_or(l_quantity = 50) AS mkmk FROM lineitem GROUP BY l_suppkey)
    SELECT s AS basename, len(list_filter(cmap, lambda x: x BETWEEN 3840 AND 4095))::BIGINT AS cmap_count, round(len(list_filter(cmap, lambda x: x BETWEEN 3840 AND 4095)) / 256.0, 6) AS cmap_coverage, mark AS has_mark_positioning, mkmk AS has_mark_to_mark FROM c""")
def font_features(spark, d):
    tag = F.when(F.col("l_linenumber") == 1, "mark").when(F.col("l_quantity") == 50, "mkmk")
    second = F.when(F.col("l_quantity") == 50, "mkmk")
    rows = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("basename")).agg(F.collect_set((3800 + F.col("l_partkey") % 400).cast("int")).alias("cmap"), F.array_union(F.collect_set(tag), F.collect_set(second)).alias("gpos"))
    found = fonts.features(rows.select("*", F.array().cast("array<string>").alias("gsub"), F.lit(None).cast("string").alias("read_error")))
    return found.select("basename", "cmap_count", F.round("cmap_coverage", 6).alias("cmap_coverage"), "has_mark_positioning", "has_mark_to_mark")


@query("SELECT s_suppkey FROM supplier WHERE s_nationkey IN (1, 2, 3, 5, 8, 13) AND CASE s_suppkey % 3 WHEN 2 THEN NULL ELSE s_suppkey % 3 END = 1 ORDER BY s_suppkey LIMIT 20")
def selected_fonts(spark, d):
    rows = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("basename"), F.when(F.col("s_suppkey") % 3 != 2, F.col("s_suppkey") % 3).alias("skt_ok"))
    return fonts.select_fonts(rows, ["1", "2", "3", "5", "8", "13"], 1, 20, "s_suppkey").select("s_suppkey")


@query("""
    SELECT s_suppkey, (n_regionkey = 1)::INT AS skt_ok, CASE WHEN s_nationkey < 10 THEN s_nationkey * 2.0 ELSE 24.0 END AS font_size_pt FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def flagged_fonts(spark, d):
    """Flags from a list, sizes from a table in which the last of two counts; nothing is dropped."""
    nation = table(spark, d, "nation")
    sizes = nation.filter("n_nationkey < 10").select(F.col("n_nationkey").alias("basename"), F.explode(F.array(F.struct(F.lit(1).alias("at"), F.lit(7.0).alias("font_size_pt")), F.struct(F.lit(2).alias("at"), (F.col("n_nationkey") * 2.0).alias("font_size_pt")))).alias("x")).select("basename", "x.*")
    rows = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("basename"), F.lit(24.0).alias("font_size_pt"))
    return fonts.flagged(rows, nation.filter("n_regionkey = 1").select(F.col("n_nationkey").alias("basename")), sizes).select("s_suppkey", "skt_ok", "font_size_pt")


@query("SELECT c_custkey, n_name AS ps_name, CASE WHEN n_nationkey IS NULL THEN 'font row not found' END AS error FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 2")
def font_rows_by_name(spark, d):
    known = table(spark, d, "nation").filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("basename"), F.col("n_name").alias("ps_name"))
    return fonts.font_of(table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("basename")), known, ["ps_name"]).select("c_custkey", "ps_name", "error")


EVIDENCE = "(SELECT l_suppkey AS renderer, l_partkey AS unit, l_returnflag <> 'R' AS ok, l_linenumber - 3 AS warns, CASE WHEN l_linestatus = 'O' THEN 'stack' ELSE 'normal' END AS kind FROM lineitem)"


def _evidence(spark, d):
    kind = F.when(F.col("l_linestatus") == "O", "stack").otherwise("normal")
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("renderer"), F.col("l_partkey").alias("unit"), (F.col("l_returnflag") != "R").alias("ok"), F.when(F.col("l_linenumber") > 1, F.greatest(F.lit(0), F.col("l_linenumber") - 3)).alias("placement_warning_count"), kind.alias("test_kind"))


@query(f"SELECT DISTINCT renderer, unit FROM {EVIDENCE} WHERE kind = 'stack' AND ok AND warns <= 0")
def supported_unit_sets(spark, d):
    return fonts.supported_units(_evidence(spark, d), "renderer", "unit")


@query(f"""
    WITH u AS (SELECT renderer, count(DISTINCT unit) AS n FROM {EVIDENCE} WHERE kind = 'stack' AND ok AND warns <= 0 GROUP BY renderer)
    SELECT s_nationkey AS name, coalesce(max(n), 0) AS capacity FROM supplier LEFT JOIN u ON renderer = s_suppkey GROUP BY s_nationkey""")
def renderer_capacities(spark, d):
    faces = table(spark, d, "supplier").select(F.col("s_suppkey").alias("renderer"), F.col("s_nationkey").alias("name"))
    return fonts.capacities(fonts.supported_units(_evidence(spark, d), "renderer", "unit"), faces, "renderer", "name")


@query("""
    WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[^ ]+')) AS unit FROM documents), v AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[^ ]+')) AS unit FROM benchmark)
    SELECT unit, (unit IN (SELECT unit FROM v) OR regexp_full_match(unit, '[\\x{F04}-\\x{F08}\\x{F0B}-\\x{F14}\\x{F20}-\\x{F29}\\x{F34}\\x{F39}\\x{F3C}\\x{F3D}]+'))::INT AS is_valid FROM w
    UNION ALL SELECT '༠༡།', 1 UNION ALL SELECT 'ཀ༡', 0""")
def valid_unit_flags(spark, d):
    words = lambda t: table(spark, d, t).select(F.explode(F.regexp_extract_all("text", F.lit("[^ ]+"), F.lit(0))).alias("unit")).distinct()
    more = spark.createDataFrame([("༠༡།",), ("ཀ༡",)], "unit string")
    return fonts.valid_units(words("documents").unionByName(more), words("benchmark"), "unit")


@query("""
    SELECT s_suppkey, coalesce(n_name, '') AS n_name, coalesce(p::VARCHAR, '') AS font_size_pt, s_suppkey || '.ttf' AS font_file
    FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_regionkey <> 4 LEFT JOIN (SELECT ps_suppkey, count(*) AS p FROM (SELECT DISTINCT l_suppkey AS ps_suppkey, l_partkey FROM lineitem WHERE l_linenumber = 7) GROUP BY 1) ON ps_suppkey = s_suppkey WHERE s_nationkey <> 3""")
def font_catalog(spark, d):
    rows = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("script_id"), F.concat(F.lit("x/"), F.col("s_suppkey").cast("string"), F.lit(".ttf")).alias("font_path"))
    scripts = table(spark, d, "nation").filter("n_regionkey <> 4").select(F.col("n_nationkey").alias("script_id"), "n_name", F.lit(1).alias("at"))
    sizes = table(spark, d, "lineitem").filter("l_linenumber = 7").select("l_suppkey", "l_partkey").distinct().groupBy("l_suppkey").agg(F.count("*").alias("font_size_pt"))
    told = sizes.select(F.concat(F.lit("x/"), F.col("l_suppkey").cast("string"), F.lit(".ttf")).alias("font_path"), "font_size_pt", F.lit(None).cast("int").alias("skt_ok"), F.lit(1).alias("at"))
    return fonts.catalog(rows, scripts, told, ["n_name"], [3]).select("s_suppkey", "n_name", "font_size_pt", "font_file")


@query("SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey % 2 = 0)")
def missing_font_keys(spark, d):
    return fonts.missing_keys(table(spark, d, "lineitem"), table(spark, d, "supplier").filter("s_nationkey % 2 = 0").select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey")


@query("""
    SELECT p_partkey, CASE WHEN lower(p_type) LIKE '%steel%' OR lower(p_type) LIKE '%ume%' THEN 'ume' ELSE 'uchen' END AS script, coalesce(nullif(CASE WHEN p_size > 25 THEN p_name ELSE '' END, ''), p_brand) AS font_name,
      'IE_' || lpad((floor((p_partkey - 1) / 1000.0)::BIGINT + 1)::VARCHAR, 4, '0') AS image_id, 'images/IE_' || lpad((floor((p_partkey - 1) / 1000.0)::BIGINT + 1)::VARCHAR, 4, '0') || '/v001/' || lpad(((p_partkey - 1) % 1000 + 1)::VARCHAR, 4, '0') || '.jpg' AS path,
      'bocorpus:' || p_partkey || ':0:' || p_size AS etext, substr(sha1(p_name), 1, 8) AS short FROM part""")
def identifiers(spark, d):
    k = F.col("p_partkey")
    kind = names.script_kind(F.regexp_replace(F.lower("p_type"), "steel", "Transitional"))
    return table(spark, d, "part").select("p_partkey", kind.alias("script"), names.font_name(F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(""), F.col("p_brand"), F.lit("x")).alias("font_name"), names.image_id("IE", k).alias("image_id"), names.image_path("images", "IE", "v001", k).alias("path"), names.etext_source(k, F.lit(0), F.col("p_size")).alias("etext"), names.short_hash(F.col("p_name")).alias("short"))


@query("""
    WITH s AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'), '[^A-Za-z0-9._-]', '_', 'g'), '_+', '_', 'g') AS k,
        regexp_replace(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g'), '[^A-Za-z0-9._-]+', '_', 'g') AS f FROM documents),
      b AS (SELECT doc_id, regexp_extract(regexp_replace(k, '^[_.]+|[_.]+$', '', 'g'), '[A-Za-z].*$') AS k, regexp_replace(regexp_replace(f, '_+', '_', 'g'), '^_|_$', '', 'g') AS f FROM s)
    SELECT doc_id, CASE WHEN k = '' THEN 'Font' ELSE upper(k[1]) || k[2:] END AS basename, CASE WHEN f = '' THEN 'x' ELSE f END AS slug FROM b""")
def safe_names(spark, d):
    """Whole texts as names."""
    text = F.col("text")
    return table(spark, d, "documents").select("doc_id", names.safe_basename(text).alias("basename"), names.folded_slug(text).alias("slug"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN -1.0 ELSE o_totalprice END AS number, CASE WHEN o_orderkey % 5 IN (0, 1) THEN -1 ELSE o_custkey END AS lenient FROM orders")
def tolerant_numbers(spark, d):
    k = F.col("o_orderkey")
    odd = F.get(F.array(*map(F.lit, ("", "nan", "x", "Infinity", "1e999"))), ((k / 5).cast("long") % 5).cast("int"))
    shown = F.when(k % 5 == 0, odd).otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("string")))
    whole = F.when(k % 5 == 0, odd).when(k % 5 == 1, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string")))
    return table(spark, d, "orders").select("o_orderkey", names.finite(shown, F.lit(-1.0)).alias("number"), tx.parse_int_lenient(whole, -1).cast("long").alias("lenient"))


@query("""
    SELECT page_id, regexp_matches(html, '[A-Za-zÀ-ɏ]') AS has_script, (length(html) - length(regexp_replace(html, '[^a-z]', '', 'g')))::BIGINT AS others, regexp_replace(html, '[ .]', '', 'g') = '' AS bare FROM pages""")
def script_tests(spark, d):
    html = F.col("html")
    return table(spark, d, "pages").select("page_id", tx.contains_script(html, tx.LATIN).alias("has_script"), (F.length(html) - F.length(F.regexp_replace(html, "[^a-z]", ""))).cast("long").alias("others"), html.rlike("^[ .]*$").alias("bare"))


@query("""
    WITH p AS (SELECT unnest(regexp_extract_all(text, '[^.]*[.]|[^.]+$')) AS u FROM documents), t AS (SELECT regexp_replace(u, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS u FROM p)
    SELECT u AS unit, count(*) AS n FROM t WHERE length(u) BETWEEN 20 AND 220 AND NOT contains(u, '  ') AND NOT contains(u, 'th') AND NOT contains(u, 'qu') GROUP BY u""")
def corpus_units(spark, d):
    """Length bounds, no doubled gap, none of the substrings that a font can't show."""
    units = table(spark, d, "documents").select(F.explode(tx.split_units(F.col("text"))).alias("unit"))
    return tx.usable_units(units, "unit", without=["th", "qu"]).groupBy("unit").agg(F.count("*").alias("n"))


PAGES = """
    pm AS (SELECT l_partkey % 5 + l_linenumber AS page, 'r' || l_orderkey AS r, (l_quantity::INT % 4) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS pos FROM lineitem),
    fp AS (SELECT r, arg_min(page, (n = 0)::INT * 1000 + pos) AS first_page, sum((n > 0)::INT)::BIGINT AS content_pages FROM pm GROUP BY r)"""


IN_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def _files(spark, least):
    """How many files a table in order is written to, by a task each: no fewer than least, and as many as the session's shuffles have parts."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _page_map(spark, d):
    """Seven files or more of lines in order."""
    path = new_folder(spark, "pages")
    rows = table(spark, d, "lineitem").repartitionByRange(_files(spark, 7), *IN_ORDER).sortWithinPartitions(*IN_ORDER).select((F.col("l_partkey") % 5 + F.col("l_linenumber")).cast("int"), F.concat(F.lit("r"), F.col("l_orderkey").cast("string")), F.col("l_quantity").cast("int") % 4)
    rows.write.csv(path)
    return tables.page_map(spark, path)


@query(f"WITH {PAGES} SELECT r AS render_id, first_page::INT AS first_page, content_pages FROM fp")
def first_content_pages(spark, d):
    return records.content_pages(_page_map(spark, d))


@query("""
    WITH RECURSIVE u AS (SELECT conv_id, turn, regexp_extract_all(text, '[^ ]* |[^ ]+$') AS units FROM conversations),
      e AS (SELECT conv_id, turn, k, least(CASE WHEN k % 4 = 2 THEN 0 ELSE (k * 3 + turn + CASE WHEN k % 3 = 0 THEN -5 ELSE 0 END) END, len(units)) AS reach, units FROM u, range(1, 9) t(k)),
      m AS (SELECT *, max(greatest(reach, 0)) OVER (PARTITION BY conv_id, turn ORDER BY k) AS upto FROM e),
      l AS (SELECT *, coalesce(lag(upto) OVER (PARTITION BY conv_id, turn ORDER BY k), 0) AS was FROM m),
      x AS (SELECT conv_id, turn, k, trim(array_to_string(units[was + 1 : upto], '')) AS line FROM l WHERE upto > was)
    SELECT c.conv_id, c.turn, coalesce((SELECT string_agg(line, chr(10) ORDER BY k) FROM x WHERE x.conv_id = c.conv_id AND x.turn = c.turn AND line <> ''), '') AS page FROM conversations c""")
def marker_line_rebuild(spark, d):
    """Lines of running slices of a text's units, by the largest marker of each line; some lines hold none."""
    units = F.regexp_extract_all("text", F.lit("[^ ]* |[^ ]+$"), F.lit(0))
    reach = lambda k: (k * 3 + F.col("turn") - F.when(k % 3 == 0, 5).otherwise(0)).cast("int")
    ends = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda k: F.when(k % 4 == 2, F.array().cast("array<int>")).otherwise(F.array(F.lit(1), reach(k))))
    lines = records.marker_lines(units, F.transform(ends, lambda ids: F.when(F.size(ids) == 0, ids).otherwise(F.slice(ids, 2, 1))))
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(F.transform(lines, lambda x: F.trim(x)), "\n").alias("page"))


@query(f"""
    WITH {PAGES}, t AS (SELECT 'r' || o_orderkey AS r, array_to_string(list_transform(range(1, 13), lambda i: 'w' || i || ' '), '') || o_orderpriority AS text FROM orders),
      lm AS (SELECT r, page, pos, n * 4 AS reach FROM pm),
      j AS (SELECT r, pos, least(reach, 14) AS reach FROM lm JOIN fp USING (r) WHERE page = first_page),
      m AS (SELECT *, max(reach) OVER (PARTITION BY r ORDER BY pos) AS upto FROM j), l AS (SELECT *, coalesce(lag(upto) OVER (PARTITION BY r ORDER BY pos), 0) AS was FROM m),
      x AS (SELECT r, string_agg(trim(array_to_string(string_split(text, ' ')[was + 1 : upto], ' ')), chr(10) ORDER BY pos) AS built FROM l JOIN t USING (r) WHERE upto > was GROUP BY r)
    SELECT t.r AS render_id, fp.first_page::INT AS first_page, coalesce(built, trim(text)) AS transcription FROM t LEFT JOIN fp USING (r) LEFT JOIN x USING (r)""")
def page_transcriptions(spark, d):
    """Texts joined with both maps, as files without headers give them."""
    path = new_folder(spark, "lines")
    lines = table(spark, d, "lineitem").repartitionByRange(_files(spark, 5), *IN_ORDER).sortWithinPartitions(*IN_ORDER)
    markers = F.when(F.col("l_quantity").cast("int") % 4 == 0, "x").otherwise(F.concat(F.lit("1 "), (F.col("l_quantity").cast("int") % 4 * 4).cast("string")))
    lines.select((F.col("l_partkey") % 5 + F.col("l_linenumber")).cast("int"), F.concat(F.lit("r"), F.col("l_orderkey").cast("string")), "l_linenumber", markers).write.csv(path)
    text = F.concat(F.lit("".join(f"w{i} " for i in range(1, 13))), "o_orderpriority")
    texts = table(spark, d, "orders").select(F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("render_id"), text.alias("text"))
    return records.transcriptions(texts, _page_map(spark, d), tables.line_map(spark, path), tx.LATIN)


RESUMED = """
    f AS (SELECT *, event_id % 900 AS seq, event_id % 900 || '|' || (event_id % 900 + 1) AS ids, user_id % 4 AS file FROM events),
    last AS (SELECT * FROM f WHERE seq <> 0 QUALIFY row_number() OVER (PARTITION BY seq ORDER BY file DESC, event_id DESC) = 1),
    cat AS (SELECT * FROM last WHERE seq % 5 <> 2)"""


def _resumed(spark, d):
    """Fragments as four committed batches of events, of which later rows replace earlier ones, two of them with a column more; each fifth image is missing; the plan are orders."""
    path = new_folder(spark, "fragments")
    seq = F.col("event_id") % 900
    rows = table(spark, d, "events").select((F.col("user_id") % 4).alias("k"), F.when(F.col("event_id") % 2 == 0, seq.cast("string")).otherwise("x").alias("output_sequence"), F.concat(F.lit("i/"), F.format_string("%04d", seq), F.lit(".jpg")).alias("image_file_name"), F.concat_ws("|", seq, seq + 1).alias("source_plan_image_ids"), "event_id", "event_type")
    sinks.commit_fragments(rows.filter("k % 2 = 0"), path, "k", ["event_id"])
    sinks.commit_fragments(rows.filter("k % 2 = 1").withColumn("more", F.lit('a "quoted",\nline')), path, "k", ["event_id"])
    files = spark.range(1, 900).filter("id % 5 <> 2").select(F.concat(F.lit("i/"), F.format_string("%04d", F.col("id")), F.lit(".jpg")).alias("path"))
    plan = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("image_id"))
    return records.resume(plan, tables.fragments(spark, path).drop("file", "fragment", "line"), files, "at")


@query(f"WITH {RESUMED} SELECT seq AS sequence, event_id, event_type FROM cat")
def resumed_catalog(spark, d):
    return _resumed(spark, d)[0].select("sequence", F.col("event_id").cast("long").alias("event_id"), "event_type")


@query(f"WITH {RESUMED} SELECT o_orderkey::VARCHAR AS image_id FROM orders WHERE o_orderkey::VARCHAR NOT IN (SELECT unnest(string_split(ids, '|')) FROM cat)")
def resumed_plan(spark, d):
    return _resumed(spark, d)[1]


@query(f"WITH {RESUMED} SELECT max(seq) + 1 AS next_id FROM cat")
def resumed_next_id(spark, d):
    return _resumed(spark, d)[2]


@query("""
    SELECT o_custkey, regexp_replace('b/' || o_custkey, '[^A-Za-z0-9_.-]+', '_', 'g') || '_' || substr(sha1(string_agg(DISTINCT o_orderkey::VARCHAR, ',' ORDER BY o_orderkey::VARCHAR)), 1, 12) || '.csv' AS fragment FROM orders GROUP BY o_custkey""")
def fragment_names(spark, d):
    rows = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set(F.col("o_orderkey").cast("string")).alias("ids"))
    return rows.select("o_custkey", names.fragment_name(F.concat(F.lit("b/"), F.col("o_custkey").cast("string")), F.col("ids")).alias("fragment"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey ELSE o_orderkey + 5 END AS output_id FROM orders")
def output_numbers(spark, d):
    given = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"))).when(F.col("o_orderkey") % 3 == 1, "none")
    return table(spark, d, "orders").select("o_orderkey", records.output_number(given, F.col("o_orderkey") + 5).alias("output_id"))


@query("""
    WITH p AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS n FROM orders), b AS (SELECT *, n // 4 AS b FROM p)
    SELECT o_orderkey, o_custkey || '_' || lpad((min(o_orderkey) OVER w)::VARCHAR, 8, '0') || '_' || lpad((max(o_orderkey) OVER w)::VARCHAR, 8, '0') AS batch_id, (n % 4 + 1)::BIGINT AS page_in_batch FROM b WINDOW w AS (PARTITION BY o_custkey, b)""")
def named_batches(spark, d):
    return records.batch_ids(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey", 4).select("o_orderkey", "batch_id", "page_in_batch")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, coalesce(nullif(CASE WHEN l_linenumber = 1 THEN l_shipdate::DATE::VARCHAR ELSE '' END, ''), CASE WHEN n_nationkey <> 6 THEN n_name END, r_name, '') AS script
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey AND n_nationkey % 3 = 0 LEFT JOIN region ON r_regionkey = l_suppkey % 7""")
def alignment_metadata(spark, d):
    """Each line with what its image volume tells, else its text volume, else nothing; its own field wins."""
    nation = table(spark, d, "nation").filter("n_nationkey % 3 = 0").select(F.concat(F.lit("i"), F.col("n_nationkey").cast("string")).alias("vol_id"), F.when(F.col("n_nationkey") == 6, "").otherwise(F.col("n_name")).alias("script"), F.lit(1).alias("at"))
    region = table(spark, d, "region").select(F.concat(F.lit("v"), F.col("r_regionkey").cast("string")).alias("vol_id"), F.col("r_name").alias("script"), F.lit(1).alias("at"))
    own = F.when(F.col("l_linenumber") == 1, F.col("l_shipdate").cast("date").cast("string")).otherwise("")
    rows = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.concat(F.lit("i"), F.col("s_nationkey").cast("string")).alias("i_id"), F.concat(F.lit("v"), (F.col("l_suppkey") % 7).cast("string")).alias("ve_id"), own.alias("script"))
    return records.with_metadata(rows, nation.unionByName(region), ["script"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "script")


@query("""
    WITH r AS (SELECT doc_id || '.jpg' AS img, 've' || source AS ve_id, text, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS suggested_split, n_chars FROM documents)
    SELECT '1:D:' || ve_id || ':' || img AS id, coalesce(suggested_split, 'data') AS split,
      (strlen(ve_id) + strlen(img) + strlen(text) + coalesce(strlen(suggested_split), 1) + 16 + strlen('1:D:' || ve_id || ':' || img) + strlen(coalesce(suggested_split, 'data')))::BIGINT AS bytes FROM r""")
def subset_row_ids(spark, d):
    rows = table(spark, d, "documents").select(F.concat(F.lit("ve"), "source").alias("ve_id"), F.concat(F.col("doc_id").cast("string"), F.lit(".jpg")).alias("img_file_name"), "text", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("suggested_split"), "n_chars")
    return records.subset_rows(rows, "1", "D").select("id", "split", "bytes")


@query("""
    WITH RECURSIVE o AS (SELECT doc_id, lang, strlen(text) AS b, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i FROM documents),
      f AS (SELECT doc_id, lang, i, 0::BIGINT AS shard, b AS filled FROM o WHERE i = 1
        UNION ALL SELECT o.doc_id, o.lang, o.i, CASE WHEN filled + b > 200000 THEN shard + 1 ELSE shard END, CASE WHEN filled + b > 200000 THEN b ELSE filled + b END FROM f JOIN o ON o.lang = f.lang AND o.i = f.i + 1),
      n AS (SELECT lang, max(shard) + 1 AS many FROM f GROUP BY lang)
    SELECT lang || '-' || lpad(shard::VARCHAR, 5, '0') || '-of-' || lpad(many::VARCHAR, 5, '0') AS shard, count(*) AS n, min(doc_id) AS first FROM f JOIN n USING (lang) GROUP BY ALL""")
def written_shards(spark, d):
    """Documents packed into shards of a size, written under the shards' names and read back."""
    path = new_folder(spark, "shards")
    rows = table(spark, d, "documents").select("doc_id", F.col("lang").alias("split"), F.octet_length("text").cast("long").alias("bytes"))
    sinks.write_shards(quotas.next_fit_shards(rows, "split", "bytes", ["doc_id"], 200_000), path)
    return spark.read.parquet(path).groupBy("shard").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))


@query("""
    SELECT o_orderstatus AS split, sum(a)::BIGINT AS rows FROM (SELECT o_orderstatus, count(*) AS a FROM orders GROUP BY ALL) GROUP BY ALL""")
def subset_counts(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("split"), (F.col("o_orderkey") % 7).alias("shard"), F.lit(1).alias("bytes"))
    return sinks.subset_info(rows).select("split", "rows")


@query("SELECT '.png' AS ending, count(*) FILTER (p_partkey % 3 = 0) AS copied, count(*) FILTER (p_partkey % 3 <> 0) AS missing FROM part UNION ALL SELECT '.txt', count(*) FILTER (p_partkey % 2 = 0), count(*) FILTER (p_partkey % 2 <> 0) FROM part")
def export_counters(spark, d):
    part = table(spark, d, "part").withColumn("base", F.concat(F.lit(" p"), F.col("p_partkey").cast("string")))
    there = part.filter("p_partkey % 3 = 0").select(F.concat(F.trim("base"), F.lit(".png")).alias("path")).union(part.filter("p_partkey % 2 = 0").select(F.concat(F.trim("base"), F.lit(".txt"))))
    return audit.export_counts(part, there, F.col("base"), [".png", ".txt"])


@query("SELECT measure, value, count(*) AS n FROM (SELECT unnest([{'measure': 'p_size', 'value': p_size::VARCHAR}, {'measure': 'p_brand', 'value': p_brand}], recursive := true) FROM (SELECT * FROM part ORDER BY p_partkey LIMIT 500)) GROUP BY ALL")
def sampled_histograms(spark, d):
    return audit.histogram(table(spark, d, "part"), ["p_size", "p_brand"], 500, "p_partkey")


@query("""
    WITH u AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY ALL), t AS (SELECT sum(n)::BIGINT AS rows, count(*) AS kinds, count(*) FILTER (n > 1) AS reused FROM u)
    SELECT 'summary' AS grp, 'total_rows' AS value, rows::VARCHAR AS count FROM t UNION ALL SELECT 'summary', 'unique_chunks', kinds::VARCHAR FROM t UNION ALL SELECT 'summary', 'reused_chunks', reused::VARCHAR FROM t
    UNION ALL SELECT 'summary', 'reused_chunk_percent', printf('%.4f%%', 100.0 * reused / kinds) FROM t
    UNION ALL SELECT 'flag', l_returnflag, count(*)::VARCHAR FROM lineitem GROUP BY l_returnflag UNION ALL SELECT 'both', l_returnflag || '|' || l_linestatus, count(*)::VARCHAR FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def plan_totals(spark, d):
    groups = {"flag": F.col("l_returnflag"), "both": F.concat_ws("|", "l_returnflag", "l_linestatus")}
    return audit.plan_totals(table(spark, d, "lineitem"), groups, "l_partkey")


AUDITED = """(SELECT doc_id, source, ['stack', 'normal', 'latin'][(doc_id % 3)::INT + 1] AS kind, quality = 1 AS ok, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE (doc_id % 8 = 1)::INT END AS warns, doc_id % 5 AS sub, doc_id % 2 AS vowels,
    doc_id % 9 AS complexity, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE toxic END AS skt, quality = 1 AND coalesce(CASE WHEN doc_id % 4 = 0 THEN NULL ELSE (doc_id % 8 = 1)::INT END, 0) = 0 AS good FROM documents JOIN labels USING (doc_id))"""


def _audited(spark, d):
    k = F.col("doc_id")
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    kind = F.get(F.array(*map(F.lit, ("stack", "normal", "latin"))), (k % 3).cast("int"))
    return rows.select("doc_id", "source", kind.alias("test_kind"), (F.col("quality") == 1).alias("ok"), F.when(k % 4 != 0, (k % 8 == 1).cast("int")).alias("placement_warning_count"), (k % 5).alias("subjoined_count"), (k % 2).alias("vowel_diacritic_count"), (k % 9).alias("complexity"), F.when(k % 7 != 0, F.col("toxic")).alias("skt_ok"))


@query(f"""
    WITH a AS (SELECT * FROM {AUDITED})
    SELECT doc_id, 'complex-pass' AS audit FROM a WHERE kind = 'stack' AND good AND sub >= 2 AND vowels >= 1
    UNION ALL SELECT doc_id, 'placement-warning' FROM a WHERE warns > 0 UNION ALL SELECT doc_id, 'false-positive' FROM a WHERE kind = 'stack' AND good AND (skt = 0 OR complexity >= 3 OR vowels >= 1)
    UNION ALL SELECT doc_id, 'false-negative' FROM a WHERE NOT good AND skt = 1 UNION ALL SELECT doc_id, 'normal-fail' FROM a WHERE kind = 'normal' AND NOT good
    UNION ALL SELECT doc_id, 'disagreement' FROM a WHERE kind = 'stack' AND good::INT <> coalesce(skt, -1) UNION ALL SELECT doc_id, 'mixed' FROM a""")
def audit_kinds(spark, d):
    """All seven filters, each row once for every audit that looks at it."""
    hits = F.array(*[F.when(audit.audit_filter(k), k) for k in audit.KINDS])
    return _audited(spark, d).select("doc_id", F.explode(F.array_compact(hits)).alias("audit"))


@query(f"""
    WITH a AS (SELECT *, sha1('13:' || doc_id) AS h, 2 * good::INT + (vowels >= 1)::INT + least(complexity, 6) AS rank FROM {AUDITED}),
      b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY source ORDER BY rank DESC, h) <= 40), t AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h) AS turn FROM b)
    SELECT doc_id FROM t ORDER BY turn, source LIMIT 40""")
def audit_sample(spark, d):
    return audit.audit_sample(_audited(spark, d), "source", "doc_id", 40, 13).select("doc_id")


@query("""
    WITH n AS (SELECT p_partkey, p_brand AS name FROM part UNION ALL SELECT -p_size, p_brand || '_1' FROM (SELECT p_brand, max(p_size) AS p_size FROM part GROUP BY p_brand)),
      w AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY p_partkey) AS k FROM n)
    SELECT name, count(*) AS n, count(*) AS distinct_names, bool_or(k = 1) AS keeps FROM w GROUP BY name""")
def colliding_names(spark, d):
    """Each brand as a name with many rows, and brand_1 as a name by nature, over which the made ones pass."""
    part = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("name"))
    taken = table(spark, d, "part").groupBy("p_brand").agg((-F.max("p_size")).cast("long").alias("p_partkey")).select("p_partkey", F.concat("p_brand", F.lit("_1")).alias("name"))
    rows = part.unionByName(taken)
    found = numbering.unique_names(rows, [], "name", ["p_partkey"])
    whole = found.groupBy("unique_name").agg(F.min("name").alias("name"), F.count("*").alias("k"))
    named = whole.groupBy("name").agg(F.sum("k").alias("n"), F.count("*").alias("distinct_names"))
    kept = found.filter("name = unique_name").select("name", F.lit(True).alias("keeps"))
    return named.join(kept, "name")
