"""Queries of what depends on the order of rows: files in order, sorted output, committed checkpoints, summaries, seeded shards and bundles; with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalogue import TOKENS
from .functions import names
from .functions import text as tx
from .operators import chunks, fonts, records, relations, stacks
from .plans import numbering, quotas
from .registered import query, table
from .sources import ordered, sinks, tables
from .sources.shared import new_folder


@query("""
    SELECT c_nationkey::BIGINT AS nation, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS line, row_number() OVER (ORDER BY c_nationkey::VARCHAR, c_custkey) - 1 AS at, c_name AS value FROM customer""")
def ordered_file_lines(spark, d):
    """A file for each nation, of different sizes, in folders whose names don't sort as numbers."""
    path = new_folder(spark, "lines")
    rows = table(spark, d, "customer").select("c_nationkey", "c_custkey", F.col("c_name").alias("value"))
    rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("c_nationkey", "value").write.partitionBy("c_nationkey").text(path)
    read = ordered.lines(spark, path)
    return read.select(F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("long").alias("nation"), "line", "at", "value")


def _read_back(spark, rows, order, columns):
    """The rows as ordered files tell them, with their number in the files' order."""
    path = new_folder(spark, "sorted")
    sinks.write_ordered(rows, path, order)
    read = ordered.in_file_order(spark.read.option("header", True).schema(rows.schema).csv(path))
    return read.select(*columns, (F.col("at") + 1).alias("place"))


@query(f"SELECT token, n, row_number() OVER (ORDER BY n DESC, token) AS place FROM (SELECT token, count(*) AS n FROM {TOKENS} GROUP BY token)")
def ordered_frequency(spark, d):
    return _read_back(spark, stacks.frequency(table(spark, d, "documents")), [F.desc("n"), "token"], ["token", "n"])


@query("SELECT s_suppkey, name, row_number() OVER (ORDER BY lower(name), s_suppkey) AS place FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN lower(s_name) ELSE s_name END || s_nationkey AS name FROM supplier)")
def ordered_fonts(spark, d):
    """Fonts by lower-cased name."""
    name = F.concat(F.when(F.col("s_suppkey") % 2 == 0, F.lower("s_name")).otherwise(F.col("s_name")), F.col("s_nationkey").cast("string"))
    return _read_back(spark, table(spark, d, "supplier").select("s_suppkey", name.alias("name")), [F.lower("name"), "s_suppkey"], ["s_suppkey", "name"])


@query("SELECT o_orderkey, sequence, row_number() OVER (ORDER BY sequence, o_orderkey) AS place FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 1000 ELSE o_custkey END AS sequence FROM orders)")
def ordered_catalog(spark, d):
    """Catalog rows by output sequence, of their own or of their file's name."""
    own = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey").cast("string")).otherwise("none")
    file = F.concat(F.lit("x/"), F.format_string("%04d", F.col("o_orderkey") % 1000), F.lit(".jpg"))
    rows = table(spark, d, "orders").select("o_orderkey", records.sequence_of(own, file).alias("sequence"))
    return _read_back(spark, rows, ["sequence", "o_orderkey"], ["o_orderkey", "sequence"])


TESTS = """(SELECT CASE l_linestatus WHEN 'O' THEN 'stack' ELSE 'normal' END AS test_kind, 'f' || l_suppkey AS basename, CASE l_linenumber % 3 WHEN 2 THEN NULL ELSE l_linenumber % 3 END::INT AS skt_ok, l_returnflag <> 'R' AS ok,
    CASE WHEN l_returnflag <> 'R' THEN '' WHEN l_linenumber > 4 THEN 'a "é"' || chr(10) || 'b' ELSE 'notdef;' || l_linenumber END AS reason, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS complexity,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity) AS pos FROM lineitem)"""
SUMMARY = f"""
    m AS (SELECT test_kind, basename, arg_min_null(skt_ok, pos) AS skt_ok, count(*) AS tested, count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok) AS failed, coalesce(max(complexity) FILTER (NOT ok), 0)::BIGINT AS max_failed_complexity FROM {TESTS} GROUP BY ALL),
    k AS (SELECT test_kind, basename, reason, count(*) AS n FROM {TESTS} WHERE NOT ok GROUP BY ALL),
    j AS (SELECT test_kind, basename, '{{' || string_agg(to_json(reason)::VARCHAR || ': ' || n, ', ' ORDER BY reason) || '}}' AS reasons FROM k GROUP BY ALL),
    s AS (SELECT m.*, coalesce(reasons, '{{}}') AS reasons, ok / tested AS ok_rate, round(100 * (ok / tested), 4) AS supported_percent FROM m LEFT JOIN j USING (test_kind, basename))"""


def _font_summary(spark, d):
    flag = F.when(F.col("l_linenumber") % 3 != 2, (F.col("l_linenumber") % 3).cast("int"))
    reason = F.when(F.col("l_returnflag") != "R", "").when(F.col("l_linenumber") > 4, 'a "é"\nb').otherwise(F.concat(F.lit("notdef;"), F.col("l_linenumber").cast("string")))
    rows = table(spark, d, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", "stack").otherwise("normal").alias("test_kind"), F.concat(F.lit("f"), F.col("l_suppkey").cast("string")).alias("basename"), flag.alias("skt_ok"), (F.col("l_returnflag") != "R").alias("ok"),
        reason.alias("reason"), F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("complexity"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").alias("at"),
    )
    return relations.font_summary(rows)


@query(f"WITH {SUMMARY} SELECT *, CASE WHEN test_kind = 'stack' THEN supported_percent ELSE NULL END AS stacks_percent FROM s")
def font_summaries(spark, d):
    """Every column of a font's summary; skt_ok is the first row's."""
    found = _font_summary(spark, d)
    return found.withColumn("stacks_percent", F.nullif("supported_stacks_percent", F.lit("")).cast("double")).drop("supported_stacks_percent")


@query(f"WITH {SUMMARY} SELECT test_kind, basename, row_number() OVER (ORDER BY test_kind, ok_rate, basename) AS place FROM s")
def ordered_summary(spark, d):
    rows = _font_summary(spark, d).select("test_kind", "basename", "ok_rate")
    return _read_back(spark, rows, ["test_kind", "ok_rate", "basename"], ["test_kind", "basename"])


@query("""
    SELECT test_kind, probe, row_number() OVER (ORDER BY job, pos) AS job_id FROM (
      SELECT 1 AS job, 'normal' AS test_kind, s_name AS probe, s_suppkey AS pos FROM supplier UNION ALL SELECT 2, 'latin', n_name, n_nationkey FROM nation UNION ALL SELECT 3, 'stack', p_name, p_partkey FROM part)""")
def appended_jobs(spark, d):
    """Three lists of probes as one table of jobs, in the lists' order."""
    of = lambda name, probe, at: table(spark, d, name).select(F.col(probe).alias("probe"), F.col(at).alias("at"))
    jobs = sinks.append_jobs([("normal", of("supplier", "s_name", "s_suppkey")), ("latin", of("nation", "n_name", "n_nationkey")), ("stack", of("part", "p_name", "p_partkey"))])
    return jobs.select("test_kind", "probe", "job_id")


@query("SELECT DISTINCT 'fonts/' || p_type || '.ttf' AS font_path FROM part WHERE p_size > 5")
def distinct_font_files(spark, d):
    rows = table(spark, d, "part").filter("p_size > 5").select(F.concat(F.lit("fonts/"), "p_type", F.lit(".ttf")).alias("font_path"), "p_size")
    return records.distinct_files(rows.unionByName(rows.limit(0)), "font_path")


FRAGMENTS = "(SELECT user_id % 7 AS batch, event_id, event_id % 5000 AS seq, event_id % 5000 || '|' || event_type AS ids, CASE WHEN user_id % 7 > 3 THEN event_type END AS kind FROM events)"


@query(f"""
    WITH f AS (SELECT * FROM {FRAGMENTS}), n AS (SELECT batch, substr(sha1(string_agg(DISTINCT id, ',' ORDER BY id)), 1, 12) AS digest FROM (SELECT batch, unnest(string_split(ids, '|')) AS id FROM f) GROUP BY batch)
    SELECT seq, event_id, kind, batch || '_' || digest AS fragment FROM f JOIN n USING (batch) WHERE seq <> 0 QUALIFY row_number() OVER (PARTITION BY seq ORDER BY batch DESC, event_id DESC) = 1""")
def interrupted_run(spark, d):
    """A run of seven batches that stops in its sixth and is resumed: its catalog equals that of a run that didn't stop."""
    path = new_folder(spark, "checkpoints")
    rows = table(spark, d, "events").select((F.col("user_id") % 7).alias("batch"), "event_id", (F.col("event_id") % 5000).cast("string").alias("output_sequence"), F.concat_ws("|", F.col("event_id") % 5000, "event_type").alias("source_plan_image_ids"), F.lit("i/0.jpg").alias("image_file_name"), "event_type")
    first, late = rows.filter("batch <= 3").drop("event_type"), rows.filter("batch > 3").withColumnRenamed("event_type", "kind")
    sinks.commit_fragments(first, path, "batch", ["event_id"])
    sinks.commit_fragments(late.filter("batch = 4"), path, "batch", ["event_id"])
    # what a job leaves that dies before its rename
    late.filter("batch = 5").limit(3).write.option("header", True).csv(f"{path}/_staged/5_0")
    done = tables.fragments(spark, path).select(F.col("batch").cast("long").alias("batch")).distinct()
    sinks.commit_fragments(late.withColumn("batch", F.col("batch").cast("long")).join(done, "batch", "left_anti"), path, "batch", ["event_id"])
    last = records.latest_rows(tables.fragments(spark, path), "at")
    return last.select(F.col("sequence").alias("seq"), F.col("event_id").cast("long").alias("event_id"), "kind", "fragment")


SEEDED = """
    r AS (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'data' ELSE lang END AS split, strlen(text) AS bytes FROM documents),
    o AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY sha1('20260430:' || split || ':' || doc_id), doc_id) AS i FROM r),
    f AS (SELECT doc_id, split, bytes, i, 0::BIGINT AS shard, bytes AS filled FROM o WHERE i = 1
      UNION ALL SELECT o.doc_id, o.split, o.bytes, o.i, CASE WHEN filled + o.bytes > 200000 THEN shard + 1 ELSE shard END, CASE WHEN filled + o.bytes > 200000 THEN o.bytes ELSE filled + o.bytes END FROM f JOIN o ON o.split = f.split AND o.i = f.i + 1)"""


def _seeded(spark, d):
    split = F.when(F.col("doc_id") % 9 != 0, F.col("lang"))
    rows = table(spark, d, "documents").select("doc_id", split.alias("split"), F.octet_length("text").cast("long").alias("bytes"))
    placed = quotas.seeded_order(rows, "split", "doc_id", 20260430)
    return quotas.next_fit_shards(placed, "split", "bytes", ["place"], 200_000)


@query(f"WITH RECURSIVE {SEEDED} SELECT doc_id, split, i AS place, shard FROM f")
def seeded_shards(spark, d):
    """Each split in a seeded order of its own, then packed."""
    return _seeded(spark, d).select("doc_id", "split", "place", "shard")


@query(f"""
    WITH RECURSIVE {SEEDED}, s AS (SELECT split, count(*) AS rows, max(shard) + 1 AS shards, sum(bytes)::BIGINT AS bytes FROM f GROUP BY split), n AS (SELECT f.*, shards FROM f JOIN s USING (split))
    SELECT split || '-' || lpad(shard::VARCHAR, 5, '0') || '-of-' || lpad(shards::VARCHAR, 5, '0') AS shard, count(*) AS n, min(doc_id) AS first, (SELECT sum(rows) FROM s)::BIGINT AS nb_images, (SELECT sum(bytes) FROM s)::BIGINT AS total,
      (SELECT string_agg(split, '|' ORDER BY split) FROM s) AS splits FROM n GROUP BY ALL""")
def written_bundle(spark, d):
    """A subset with its shards, information, description and catalog, all read back."""
    folder = new_folder(spark, "subsets")
    sinks.write_bundle(_seeded(spark, d), folder, "s1", {"author": "x"}, "2026-01-01")
    data = spark.read.parquet(f"{folder}/s1/data").groupBy("shard").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    info = spark.read.text(f"{folder}/s1/subset_info.json", wholetext=True).select(F.from_json("value", "nb_images long, parquet_total_size long, data_files map<string,string>").alias("x"))
    listed = spark.read.option("header", True).csv(f"{folder}/catalog.csv").filter("subset_id = 's1'")
    told = info.crossJoin(F.broadcast(listed))  # one row each
    return data.crossJoin(F.broadcast(told.select(F.col("x.nb_images").alias("nb_images"), F.col("x.parquet_total_size").alias("total"), F.array_join(F.array_sort(F.map_keys("x.data_files")), "|").alias("splits"))))
