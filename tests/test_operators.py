"""Operators that SQL doesn't express, against plain Python on small inputs."""

import random
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium import catalogue
from scriptorium.functions import names, text as tx
from scriptorium.operators import chunks, fonts, geometry, records, relations, stacks
from scriptorium.plans import quotas
from scriptorium.sources import sinks, tables


def test_chunks_end_where_they_must(spark):
    """Each chunk is a run of units; it ends at the first one that fills it, or before one that would overfill it, and the tail is long enough."""
    rng = random.Random(3)
    target, least, most = 60, 30, 80
    cases = [(i, ["x" * rng.randint(1, 40) for _ in range(rng.randint(0, 25))]) for i in range(60)]
    df = spark.createDataFrame(cases, "id int, units array<string>")
    found = {r.id: [(c.text, c.start) for c in r.c] for r in df.select("id", chunks.pack(F.col("units"), target, least, most).alias("c")).collect()}
    for i, units in cases:
        places = np.concatenate([[0], np.cumsum([len(u) + 1 for u in units])]).astype(int)
        long = lambda a, b: int(places[b] - places[a]) - 1  # noqa: E731  characters of units a to b - 1, joined
        at = 0
        for text, start in found[i]:
            assert start == places[at]
            end = at + text.count(" ") + 1
            assert text == " ".join(units[at:end]) and long(at, end) == len(text) >= least
            assert all(long(at, k) < target for k in range(at + 1, end))
            overfilled = end < len(units) and long(at, end + 1) > most
            assert len(text) >= target or overfilled or end == len(units)
            assert not any(long(at, k) >= least and long(at, k + 1) > most for k in range(at + 1, end))
            at = end
        assert at == len(units) or long(at, len(units)) < least


def test_tibetan_units(spark):
    df = spark.createDataFrame([("བོད་ཡིག། སྐྱེས་ཆེན།",)], "t string")
    row = df.select(tx.split_marker_units(F.col("t")).alias("m"), tx.split_units(F.col("t"), tx.TIBETAN, 2).alias("u"), tx.tokens(F.col("t"), tx.TIBETAN).alias("k")).first()
    assert "".join(row.m) == "བོད་ཡིག། སྐྱེས་ཆེན།" and row.u == ["བོད་ཡིག།", "སྐྱེས་ཆེན།"] and "སྐྱེ" in row.k


def test_next_fit(spark):
    rows = [("a", i, s) for i, s in enumerate([5, 5, 3, 20, 1, 9])] + [("b", 9, 4)]
    df = spark.createDataFrame(rows, "split string, id int, size long")
    found = {r.id: r.shard for r in quotas.next_fit_shards(df, "split", "size", ["id"], 10).collect()}
    assert found == {0: 0, 1: 0, 2: 1, 3: 2, 4: 3, 5: 3, 9: 0}


def test_no_boxes_give_no_warning(spark):
    df = spark.createDataFrame([("ཀ", [])], "t string, b array<struct<gid:int,name:string,x0:int,ytop:int,x1:int,ybot:int>>")
    assert df.select(geometry.placement_warnings(F.col("t"), F.col("b")).alias("w")).first().w == []
    assert df.select(geometry.verdict(F.col("t"), F.col("b")).alias("v")).first().v.reason == "empty_shape"


def test_empty_documents(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    rare = stacks.rarity(stacks.frequency(df))
    assert {r.difficulty for r in stacks.difficulty(df, rare).collect()} == {0.0}


def test_division_needs_every_unit(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "item int, unit string")
    fonts = spark.createDataFrame([("x", "a"), ("y", "a"), ("y", "b")], "font string, unit string")
    assert {(r.item, r.font) for r in relations.supported_by(docs, "item", "unit", fonts, "font").collect()} == {(1, "y"), (2, "x"), (2, "y")}


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "f.csv").write_text("basename,font_path,skt_ok,dpi,font_size_pt\nA,/a.ttf,1,,\n,/b.ttf,0,1,1\nB,/b.ttf,x,12.0,7.5\n")
    assert [(r.basename, r.skt_ok, r.dpi, r.font_size_pt) for r in tables.font_csv(spark, str(tmp_path / "f.csv")).collect()] == [("A", 1, 300, 24.0), ("B", None, 12, 7.5)]
    (tmp_path / "s.txt").write_text("ཀ\nx\nཀྲ\nཀ\nཁ\n")
    assert [r.stack for r in tables.stack_list(spark, str(tmp_path / "s.txt"), 2).collect()] == ["ཀ", "ཀྲ"]
    (tmp_path / "p.txt").write_text("# no\n\n a \n")
    assert [r.probe for r in tables.probe_lines(spark, str(tmp_path / "p.txt")).collect()] == ["a"]
    df = spark.createDataFrame([("a|b.ttf", "Fam", ["z", "y"])], "file string, family string, names array<string>")
    lines = [r.value for r in sinks.markdown_rows(df).collect()]
    assert lines == ["| a\\|b.ttf | Fam | y, z |"]
    (tmp_path / "c.md").write_text("| File | Family | Names |\n|:--|--|--|\n<<<<<<< HEAD\n" + lines[0] + "\n")
    assert [tuple(r) for r in tables.markdown_table(spark, str(tmp_path / "c.md")).collect()] == [("a|b.ttf", "Fam", "y, z")]
    sinks.write_parquet(df, str(tmp_path / "out"), ["family"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_edges_of_readers(spark, tmp_path):
    (tmp_path / "s.csv").write_text("stack,hunspell_bo,nb_occurences\nཀ,,5\nཀ,0,9\nཁ, ,\nx,1,1\nག,0,2.0\n")
    assert [tuple(r) for r in tables.stacks(spark, str(tmp_path / "s.csv")).collect()] == [("ཀ", 1, 5), ("ཁ", 0, 0), ("ག", 0, 2)]
    (tmp_path / "t.csv").write_text("word\na\n")
    with pytest.raises(ValueError):
        tables.stacks(spark, str(tmp_path / "t.csv"))
    (tmp_path / "fonts" / "deep").mkdir(parents=True)
    (tmp_path / "fonts" / "deep" / "a.ttf").write_bytes(b"abc")
    (tmp_path / "fonts" / "b.txt").write_bytes(b"x")
    files = tables.files_by_extension(spark, str(tmp_path / "fonts")).collect()
    assert len(files) == 1 and files[0].length == 3 and files[0].sha256.startswith("ba7816bf")
    there = spark.createDataFrame([("b/1",), ("c/1",), ("c/2",)], "path string")
    rows = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    found = tables.first_existing(rows, "id", [F.concat(F.lit(x), F.col("id").cast("string")) for x in ("a/", "b/", "c/")], there)
    assert dict(found.collect()) == {1: "b/1", 2: "c/2", 3: None}
    last = spark.createDataFrame([("k", 1), ("k", 3), ("m", 2)], "k string, at int")
    assert sorted(map(tuple, tables.last_per_key(last, "k", "at").collect())) == [("k", 3), ("m", 2)]
    for i, text in ((1, "a,n\n1,2\n"), (2, "n,b\n3,4\n")):
        (tmp_path / "frag").mkdir(exist_ok=True)
        (tmp_path / "frag" / f"f{i}.csv").write_text(text)
    assert [(r.file, r.a, r.n, r.b) for r in tables.fragments(spark, str(tmp_path / "frag")).orderBy("file", "at").collect()] == [("f1.csv", "1", "2", None), ("f2.csv", None, "3", "4")]


def test_writers(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2, 0.5)], "i int, d double")
    sinks.write_union([a, b], str(tmp_path / "u"))
    assert sorted(tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "u")).select("i", "s", "d").collect()) == [("1", "x", None), ("2", None, "0.5")]
    sinks.write_csv(a.filter("false"), str(tmp_path / "none"))
    assert "".join(p.read_text() for p in (tmp_path / "none").glob("*.csv")) in ("", "i,s\n")
    support = spark.createDataFrame([("p", "f2", True, 1), ("p", "f1", True, 1), ("p", "f1", False, 2), ("q", "f2", True, 1)], "probe string, font string, ok boolean, at int")
    sinks.write_matrix(relations.support_matrix(support, "probe", "font", "ok", "at"), str(tmp_path / "m"), "probe")
    assert "".join(p.read_text() for p in (tmp_path / "m").glob("*.csv")) == "probe,f1,f2\np,0,1\nq,,1\n"
    errors = spark.createDataFrame([("bad|.ttf", None, None)], "file string, family string, names array<string>")
    assert [r.value for r in sinks.markdown_rows(errors).collect()] == ["| bad\\|.ttf | Error | Error |"]


def test_small_functions(spark):
    df = spark.createDataFrame([("་ཀ་།་", " 7", "x\x00y\x85", "ཀཱ", "ཀ྾")], "t string, n string, c string, s string, b string")
    row = df.select(tx.break_points(F.col("t"), "|").alias("t"), tx.parse_int_lenient(F.col("n")).alias("n"), tx.parse_int_lenient(F.lit("7.0"), 3).alias("m"), names.without_controls(F.col("c")).alias("c"), names.has_sanskrit(F.col("s")).alias("s"), geometry.stack_metrics(F.lit("ཀྲུཀ")).alias("k")).first()
    assert (row.t, row.n, row.m, row.c, row.s) == ("་|ཀ་།་|", 7, 3, "xy", True)
    assert row.k.asDict() == {"stack_len": 4, "base_count": 2, "subjoined_count": 1, "vowel_diacritic_count": 1, "has_subjoined": True, "has_vowel_diacritic": True, "complexity": 3}
    df = spark.createDataFrame([("7", "x/9.jpg"), ("b", "x/9.jpg"), (None, "x/y.jpg"), (None, None)], "s string, f string")
    assert [r[0] for r in df.select(records.sequence_of(F.col("s"), F.col("f"))).collect()] == [7, 9, 0, 0]


def test_renderers_without_boxes_or_units(spark):
    df = spark.createDataFrame([("ཀ",)], "t string")
    none = F.lit(None).cast("array<struct<gid:int,name:string,x0:int,ytop:int,x1:int,ybot:int>>")
    assert df.select(geometry.verdict(F.col("t"), none).alias("v")).first().v.reason == "empty_shape"
    support = spark.createDataFrame([("f", "a", "stack", True, None), ("f", "b", "stack", True, 1), ("f", "c", "latin", True, 0)], "font string, unit string, test_kind string, ok boolean, placement_warning_count int")
    assert [tuple(r) for r in fonts.supported_units(support, "font", "unit").collect()] == [("f", "a")]
    faces = spark.createDataFrame([("f", "n"), ("g", "m")], "font string, name string")
    assert dict(fonts.capacities(fonts.supported_units(support, "font", "unit"), faces, "font", "name").collect()) == {"n": 1, "m": 0}


def test_long_names_take_linear_time(spark):
    """A run of dots within a long text isn't looked at again from each of its dots."""
    began = time.monotonic()
    texts = spark.createDataFrame([("é a" + "." * 300_000 + "b _é.",), ("_" * 300_000 + "1",), (None,)], "t string")
    found = [tuple(r) for r in texts.select(names.safe_basename(F.col("t")), names.folded_slug(F.col("t"))).collect()]
    assert found == [("A" + "." * 300_000 + "b", "e_a" + "." * 300_000 + "b_e."), ("Font", "1"), ("Font", None)]
    assert time.monotonic() - began < 30


def test_a_verdict_looks_at_its_text_once(spark):
    """Values that several rules share are worked out once a text: trailing marks, subjoined letters, neighbours."""
    df = spark.createDataFrame([("x", [])], "t string, b array<struct<gid:long,name:string,x0:long,ytop:long,x1:long,ybot:long>>")
    told = str(df.select(geometry.verdict(F.col("t"), F.col("b")).alias("v"))._jdf.queryExecution().optimizedPlan())
    assert [told.count(x) for x in ("regexp_extract(", "regexp_replace(", "zip_with(")] == [1, 2, 1]


def test_difficulty_cuts_texts_once(spark):
    """Counts of tokens are made once and used twice, and give what the texts give."""
    told = str(catalogue.QUERIES["doc_difficulty"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan())
    assert "regexp_extract_all" not in told
    docs = spark.createDataFrame([(1, "a b b c zz"), (2, "a a a"), (3, None), (4, "new words")], "doc_id long, text string")
    rare = stacks.rarity(stacks.frequency(docs.filter("doc_id < 4")))
    assert stacks.difficulty(docs, rare, counts=stacks.counted(docs)).collect() == stacks.difficulty(docs, rare).collect()


def test_ties_and_letters_are_as_in_sql(spark, tmp_path):
    """Queries round as their SQL does where a double is named like a tie, lower letters one by one, and score texts without tokens as it does."""
    texts = ["common word", "common word two", "İstanbul ΟΔΟΣ Σ", "straße ẞ ß", "123 ...", "", None, "a b c d e f g h i j k l"]
    docs = spark.createDataFrame([(i, "a" if i % 2 else None, t) for i, t in enumerate(texts * 2)], "doc_id long, source string, text string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("token_frequency", "token_rarity", "doc_difficulty"):
        assert sorted(map(tuple, catalogue.QUERIES[name](spark, str(tmp_path)).collect()), key=repr) == sorted(con.sql(catalogue.ORACLES[name]).fetchall(), key=repr), name
    values = [0.5 + 0.3 * (0.034375 / 3) + 0.2 * 0.0176, 0.5069575, 0.0000005, 0.9999995, 1.0, 0.0, -0.5069575, None]
    found = spark.createDataFrame([(v,) for v in values], "x double").select(tx.rounded(F.col("x"), 6).alias("y")).collect()
    assert [r.y for r in found] == [con.execute("select round(?::double, 6)", [v]).fetchone()[0] for v in values] and found[1].y == 0.506957
