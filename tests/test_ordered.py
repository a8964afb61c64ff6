"""Order over files and splits, committed checkpoints, text rules, shards and division, against plain rules."""

import os
import random

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import text as tx
from scriptorium.operators import records, relations
from scriptorium.plans import quotas
from scriptorium.sources import ordered, sinks, tables


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_lines_of_uneven_files_and_splits(spark, tmp_path):
    folder = str(tmp_path / "in put+é")
    files = {"a.txt": ["first"], "b.txt": [f"line {i} é" for i in range(3000)], "b0/c.txt": ["x", "", "y"], "z.txt": []}
    for name, rows in files.items():
        put(folder, name, "".join(r + "\n" for r in rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = ordered.lines(spark, folder).orderBy("at").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    wanted = [(n, i, v) for n in sorted(files) for i, v in enumerate(files[n])]
    assert [(r["path"].split("in put+é/")[1], r["line"], r["value"]) for r in found] == wanted
    assert [r["at"] for r in found] == list(range(len(wanted)))


def test_page_maps_of_several_files_keep_path_order(spark, tmp_path):
    put(str(tmp_path), "a.csv", "1,r1,0\n2,r1,5\n")
    put(str(tmp_path), "b.csv", "".join(f"{i},r{i},1\n" for i in range(3, 500)) + "9,,1\n7,r1,3\n")
    rows = tables.page_map(spark, str(tmp_path)).orderBy("at").collect()
    assert [r["physical_page"] for r in rows] == [1, 2, *range(3, 500), 7]
    lines = tables.line_map(spark, str(tmp_path)).orderBy("at")
    assert [r["physical_page"] for r in lines.limit(2).collect()] == [1, 2]


def test_fragments_of_any_header_and_of_no_file(spark, tmp_path):
    folder = str(tmp_path / "f")
    assert tables.fragments(spark, folder).count() == 0
    os.makedirs(folder)
    assert tables.fragments(spark, folder).count() == 0
    put(folder, "b2.csv", 'n,text\n1,"two\nlines, ""quoted"""\n2,plain\n')
    put(folder, "b10.csv", "﻿n,more\n3,m\n")
    put(folder, "b3.csv", "")
    put(folder, "_half/b1.csv", "n,text\n9,never\n")
    rows = tables.fragments(spark, folder).orderBy("at").collect()
    assert [(r["file"], r["line"], r["n"], r["text"], r["more"]) for r in rows] == [("b10.csv", 0, "3", None, "m"), ("b2.csv", 0, "1", 'two\nlines, "quoted"', None), ("b2.csv", 1, "2", "plain", None)]


def test_a_batch_that_is_committed_again_replaces_itself(spark, tmp_path):
    folder = str(tmp_path / "f")
    rows = spark.createDataFrame([("a/1", 1, "7|8", "x"), ("a/1", 2, "7", "y"), ("b", 1, "", "z")], "batch string, n int, source_plan_image_ids string, v string")
    names = sinks.commit_fragments(rows, folder, "batch", ["n"])
    assert sorted(n[:4] for n in names) == ["a_1_", "b_da"]
    sinks.commit_fragments(rows.withColumn("v", F.upper("v")), folder, "batch", ["n"])
    found = tables.fragments(spark, folder).orderBy("at").collect()
    assert [(r["n"], r["v"]) for r in found] == [("1", "X"), ("2", "Y"), ("1", "Z")]
    assert all(not n.startswith("_") for n in os.listdir(folder))


def test_markers_white_space_and_numbers(spark):
    texts = ["x -- page 3 -- y", "--PAGE 12--", "a\r\n\r\nb\x1c c", "--  page x --", "  -- Page ٣ --\x1f", None, "tib་ \nx"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r[0] for r in rows.orderBy("i").select(tx.clean(F.col("t"))).collect()]
    assert found == ["x y", "", "a b c", "-- page x --", "", None, "tib་ x"]
    assert rows.filter("i = 6").select(tx.clean(F.col("t"), tx.TIBETAN)).first()[0] == "tib་x"
    names = ["a10", "a2", "a02b", "10", "9", "a" + "9" * 25, "a1" + "0" * 25, "a b", "B1", ""]
    keyed = spark.createDataFrame([(n,) for n in names], "n string").select("n", tx.natural_key(F.col("n")).alias("k"))
    assert [r["n"] for r in keyed.orderBy("k").collect()] == ["", "9", "10", "a2", "a02b", "a10", "a" + "9" * 25, "a1" + "0" * 25, "a b", "B1"]


@pytest.mark.parametrize("seed", range(3))
def test_shards_equal_a_fold(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([0, 0, 1, 5, 30, 99, 100, 101, 400, None])) for i in range(600)]
    rows += [(1000 + i, "hot", 7) for i in range(700)] + [(5000, "one", 1000), (5001, "zero", 0)]
    frame = spark.createDataFrame(rows, "i long, split string, n long").withColumns({"place": F.lit("x"), "own": F.lit(1)})
    found = {r["i"]: r["shard"] for r in quotas.next_fit_shards(frame, "split", "n", ["i"], 100).collect()}
    wanted, state = {}, {}
    for i, split, n in rows:
        shard, filled = state.get(split, (0, None))
        if filled is not None and filled + (n or 0) > 100:
            shard, filled = shard + 1, 0
        state[split] = shard, (filled or 0) + (n or 0)
        wanted[i] = shard
    assert found == wanted
    assert quotas.next_fit_shards(frame.filter("false"), "split", "n", ["i"], 100).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_division_equals_sets(spark, seed):
    rng = random.Random(seed)
    held = {h: set(rng.sample(range(200), rng.randrange(1, 190))) for h in range(30)}
    items = {i: set(rng.sample(range(200), rng.randrange(1, 5))) for i in range(60)} | {100: {1, 999}, 101: set(held[3])}
    wanted = {(i, h) for i, units in items.items() for h, has in held.items() if units <= has}
    a = spark.createDataFrame([(i, f"u{u}") for i, s in items.items() for u in s] + [(7, None), (None, "u1")], "item long, unit string")
    b = spark.createDataFrame([(h, f"u{u}") for h, s in held.items() for u in s] + [(None, "u1")], "holder long, unit string")
    found = relations.supported_by(a.union(a), "item", "unit", b, "holder").collect()
    assert len(found) == len(wanted) and {(r["item"], r["holder"]) for r in found} == wanted
    assert relations.supported_by(a, "item", "unit", b.filter("false"), "holder").count() == 0


def test_division_of_equal_sets_is_spread(spark):
    """Items of one set and holders of several blocks: all pairs, and no task has most of them."""
    held = {f"h{h}": {u for u in range(40) if (h * 7 + u * u) % 11} for h in range(1100)}
    items = {i: {3, 5} for i in range(900)} | {1000 + i: {i, i + 1, 2 * i} for i in range(20)} | {2000: set(range(40)), 2001: {41}}
    wanted = sum(units <= has for units in items.values() for has in held.values())
    a = spark.createDataFrame([(i, u) for i, s in items.items() for u in s], "units int, unit int")
    b = spark.createDataFrame([(h, u) for h, s in held.items() for u in s], "ids string, unit int")
    found = relations.supported_by(a, "units", "unit", b, "ids").withColumn("part", F.spark_partition_id())
    parts = [r["n"] for r in found.groupBy("part").agg(F.count("*").alias("n")).collect()]
    assert sum(parts) == wanted and max(parts) < wanted / 2
    got = {(r["units"], r["ids"]) for r in found.collect()}
    assert got == {(i, h) for i, units in items.items() for h, has in held.items() if units <= has}


def test_division_without_broadcasts(spark):
    """The same pairs where Spark may broadcast neither blocks nor sets."""
    a = spark.createDataFrame([(i, u) for i in range(300) for u in {i % 2, i % 3}], "item int, unit int")
    b = spark.createDataFrame([(h, u) for h in range(1000) for u in range(3) if (h + u) % 4], "holder int, unit int")
    wanted = {(i, h) for i in range(300) for h in range(1000) if all((h + u) % 4 for u in {i % 2, i % 3})}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = relations.supported_by(a, "item", "unit", b, "holder").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(found) == len(wanted) and {(r["item"], r["holder"]) for r in found} == wanted


def test_summary_of_fonts(spark):
    rows = [("stack", "f", None, True, "", 3, 1), ("stack", "f", 1, False, "b", None, 2), ("stack", "f", 0, False, 'a"', 4, 3), ("stack", "f", 0, None, None, 1, 4), ("latin", "f", 0, True, "", 1, 1)]
    frame = spark.createDataFrame(rows, "test_kind string, basename string, skt_ok int, ok boolean, reason string, complexity int, at int")
    stack, latin = (r.asDict() for r in relations.font_summary(frame).orderBy(F.desc("test_kind")).collect())
    assert stack == {"test_kind": "stack", "basename": "f", "skt_ok": None, "tested": 4, "ok": 1, "failed": 3, "max_failed_complexity": 4, "reasons": '{"a\\"": 1, "b": 1, "null": 1}', "ok_rate": 0.25, "supported_percent": 25.0, "supported_stacks_percent": "25.0"}
    assert (latin["skt_ok"], latin["reasons"], latin["supported_stacks_percent"]) == (0, "{}", "")


def test_a_large_batch_is_written_by_several_tasks(spark, tmp_path):
    """Its files in path order are its rows in order."""
    rows = spark.range(2000).select((F.col("id") % 2).alias("batch"), F.col("id").alias("event"), F.lit("1|2").alias("source_plan_image_ids"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.commit_fragments(rows, f"{tmp_path}/c", "batch", ["event"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = tables.fragments(spark, f"{tmp_path}/c").orderBy("at").collect()
    assert [int(r.event) for r in read] == [*range(0, 2000, 2), *range(1, 2000, 2)]
    assert all(len({r.file for r in read if r.batch == b}) > 1 for b in "01")


def test_rows_of_files_are_numbered_where_they_are(spark, tmp_path):
    """Counts of splits are broadcast whatever the session's threshold, so a file's rows aren't shuffled by its path."""
    spark.range(100).selectExpr("cast(id AS string)").repartition(3).write.text(str(tmp_path / "f"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ordered.lines(spark, str(tmp_path / "f"))
        told = str(found._jdf.queryExecution().executedPlan())
        assert "BroadcastHashJoin" in told and "SortMergeJoin" not in told
        assert sorted(r["at"] for r in found.collect()) == list(range(100))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_lines_cut_their_text_once(spark):
    rows = spark.createDataFrame([("a b c d e", [[1, 2], [], [9]]), ("a b", None), (None, [[1]])], "t string, e array<array<int>>")
    found = rows.select(records.marker_lines(tx.split_marker_units(F.col("t"), tx.LATIN), F.col("e")).alias("x"))
    assert [r.x for r in found.collect()] == [["a b", "c d e"], None, []]
    assert str(found._jdf.queryExecution().analyzed()).count("regexp_extract_all(") == 1
