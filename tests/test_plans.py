"""Assignment, numbering and merging, against plain Python and stated invariants."""

import hashlib
import os
import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium import catalogue
from scriptorium.functions import characters
from scriptorium.functions import text as tx
from scriptorium.plans import assignment, closure, greedy, layout, numbering, trees
from scriptorium.sources import affixes


def test_numbers_are_consecutive_and_repeat(spark):
    df = spark.createDataFrame([(f"k{i % 700}",) for i in range(1500)], "k string")
    a, b = (dict(numbering.numbered(d, "k", 4).collect()) for d in (df, df.repartition(7)))
    assert a == b and sorted(a.values()) == list(range(700))


def test_unique_names(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a")], "i int, name string")
    assert {r.i: r.unique_name for r in numbering.unique_names(df, [], "name", ["i"]).collect()} == {1: "a", 2: "a_1", 3: "b", 4: "a_2"}
    tail = F.concat(F.lit("x"), F.col("i"))
    assert {r.i: r.unique_name for r in numbering.unique_names(df, [], "name", ["i"], tail).collect()} == {1: "a", 2: "a_x2", 3: "b", 4: "a_x4"}
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a_1"), (4, "a"), (5, "a_1")], "i int, name string")
    found = {r.i: r.unique_name for r in numbering.unique_names(df, [], "name", ["i"]).collect()}
    assert found[1] == "a" and found[3] == "a_1" and len(set(found.values())) == 5


def test_splits_stay_balanced(spark):
    """The three largest names of a category go one to each split; a further one goes where its split was the least full of its share."""
    rng = random.Random(1)
    caps = rng.sample(range(1, 1000), 35)  # no ties, so the order is plain
    fonts = [("abc"[i % 3], f"n{i}", k) for i, k in enumerate(caps)]
    rows = fonts + [(c, n, k // 2) for c, n, k in fonts] + [(None, "z", 1), ("a", None, 1)]
    df = spark.createDataFrame(rows, "category string, name string, capacity int")
    found = dict(assignment.assign_splits(df, "category", "name", "capacity").collect())
    assert set(found) == {n for _, n, _ in fonts}
    share = dict(zip(assignment.SPLITS, assignment.RATIOS))
    for category in "abc":
        own = sorted(((k, n) for c, n, k in fonts if c == category), reverse=True)
        assert [found[n] for _, n in own[:3]] == list(assignment.SPLITS)
        held = np.array([[k if found[n] == s else 0 for s in assignment.SPLITS] for k, n in own]).cumsum(axis=0) / np.array(list(share.values()))
        for before, (_, n) in zip(held[2:], own[3:]):
            assert before[assignment.SPLITS.index(found[n])] <= before.min() + 1e-9


def test_closure_of_many_rounds(spark):
    kind = "flag string, strip string, add string, flags array<string>, condition string"
    table = spark.createDataFrame([(f"F{i}", "", chr(97 + i), [f"F{i + 1}"], ".$") for i in range(20)], kind)
    stems = spark.createDataFrame([("w", ["F0"]), ("w", ["F0", "F0"]), (None, ["F0"]), ("v", None)], "word string, flags array<string>")
    found = closure.suffix_closure(stems, table).collect()
    assert {r.word for r in found} == {"v", *("w" + "".join(chr(97 + i) for i in range(k)) for k in range(21))} and len(found) == 22
    assert not any(r.cut for r in found)
    endless = spark.createDataFrame([("F0", "", "a", ["F0"], "w"), ("F0", "", "b", ["F0"], "x")], kind)
    found = closure.suffix_closure(stems, endless, max_states=5).collect()
    assert sorted(r.word for r in found) == ["v", "w", "wa", "waa", "waaa"]
    assert {r.word for r in closure.suffix_closure(stems, table, without=["F3"]).collect()} == {"v", "w", "wa", "wab", "wabc"}


def test_a_cut_closure_says_so(spark):
    rules = spark.createDataFrame([("A", "", c, ["A"], ".$") for c in "xyz"], "flag string, strip string, add string, flags array<string>, condition string")
    found = closure.suffix_closure(spark.createDataFrame([("w", ["A"])], "word string, flags array<string>"), rules, max_states=3).collect()
    assert sorted(r.word for r in found) == ["w", "wx", "wy"] and all(r.cut for r in found)


def test_a_closure_without_a_bound_is_whole(spark):
    stems = spark.range(2_000_001).select(F.col("id").cast("string").alias("word"), F.when(F.col("id") == 7, F.array(F.lit("A"))).alias("flags"))
    rules = spark.createDataFrame([("A", "", "x", [], ".$")], "flag string, strip string, add string, flags array<string>, condition string")
    found = closure.suffix_closure(stems, rules).groupBy("steps", "cut").count().collect()
    assert sorted(map(tuple, found)) == [(0, False, 2_000_001), (1, False, 1)]


def test_affix_files(spark, tmp_path):
    (tmp_path / "a.aff").write_text("SFX A Y 2\nSFX A e ing/BC [^e]e\nSFX A 0 0\n# SFX A x y .\nPFX B 0 un .\n")
    (tmp_path / "a.dic").write_text("2\nmake/AB\ntea\n\n7\n")
    rules = affixes.suffix_rules(spark, str(tmp_path / "a.aff")).collect()
    assert [tuple(r) for r in rules] == [("A", "e", "ing", ["B", "C"], "[^e]e$"), ("A", "", "", [], ".$")]
    assert sorted(tuple(r) for r in affixes.dictionary_stems(spark, str(tmp_path / "a.dic")).collect()) == [("7", []), ("make", ["A", "B"]), ("tea", [])]


def plain_tree(paths):
    slug = lambda s: re.sub("_+", "_", re.sub(r"[^A-Za-z0-9._-]+", "_", unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode())).strip("_") or "x"
    digest = lambda s: hashlib.sha1(s.encode()).hexdigest()[:8]
    used, files, dirs, out = {}, {}, {}, {}
    for p in sorted(paths):
        *parts, file = p.split("/")
        if tuple(parts) not in dirs:
            at = ""
            for part in parts:
                name = slug(part)
                if name in used.setdefault(at, set()):
                    name = f"{name}_{digest(at + '/' + part)}"
                used[at].add(name)
                at = f"{at}/{name}" if at else name
            dirs[tuple(parts)] = at
        at = dirs[tuple(parts)]
        stem, ending = os.path.splitext(file)
        name = slug(stem) + ending.lower()
        if name in files.setdefault(at, set()):
            name = f"{slug(stem)}_{digest(p)}{ending.lower()}"
        files[at].add(name)
        out[p] = (at, name)
    return out


def test_tree_equals_a_walk(spark):
    made = "b_" + hashlib.sha1(b"a/b").hexdigest()[:8]
    paths = ["x.ttf", "X.TTF", "x .ttf", "a/b/1.ttf", "a/c/1.ttf", "a/c!/1.ttf", "a/c /é.otf", "á/b/1.ttf", "a/1.ttf", "b/ü/v/w.ttc", "b/u/v/w.ttc", "b/u/v/W.ttc", "!/1.ttf", "a/b/1.TTF"]
    paths += [f"a/b/{n}/1.ttf" for n in ("p", "q", "r")] + [f"a/{made}/z.ttf", f"{made}/z.ttf", f"b/deep/{'x/' * 6}f.ttf"]
    frame = spark.createDataFrame([(p, 1) for p in paths] + [(None, 1)], "path string, safe int")
    found = {r["path"]: (r["normalized_dir"], r["normalized_name"]) for r in trees.renamed_tree(frame).collect()}
    assert found == plain_tree(paths)


def plain_plan(fonts, pairs, quotas, cap, seed=0):
    """The rows of a sequential pass."""
    hard = {}
    for f, c, d in pairs:
        hard.setdefault(f, {})[c] = max(d, hard.get(f, {}).get(c, d))
    owner, uses, shared, used, out = {}, {}, set(), set(), []
    cells = sorted(quotas, key=lambda q: (q[0], assignment.SPLITS.index(q[2]), ("uchen", "ume").index(q[1])))
    for category, script, split, quota in cells:
        order = sorted((f for f in fonts if f[1:] == (category, script, split)), key=lambda f: (hashlib.sha1(f"{seed}:{f[0]}".encode()).hexdigest(), f[0]))
        moved = True
        while quota > 0 and moved:
            moved = False
            for f, *_ in order:
                if quota <= 0:
                    break
                chunks = sorted(hard.get(f, {}), key=lambda c: (-hard[f][c], c))
                took = next((c for c in chunks if c not in owner), None)
                again = took is None
                if again:
                    took = next((c for c in chunks if owner.get(c) == split and (f, c) not in used and (uses[c] > 1 or len(shared) < cap)), None)
                if took is None:
                    continue
                owner.setdefault(took, split)
                used.add((f, took))
                uses[took] = uses.get(took, 0) + 1
                shared |= {took} if uses[took] > 1 else set()
                out.append((f, took, category, script, split, hard[f][took], again, len(out) + 1))
                quota, moved = quota - 1, True
    return out


@pytest.mark.parametrize("seed", range(3))
def test_greedy_plan_equals_a_sequential_pass(spark, monkeypatch, seed):
    monkeypatch.setattr(greedy, "LEAST_LOOK", 1)
    monkeypatch.setattr(greedy, "FIRST_LOOK", 1)
    rng = random.Random(seed)
    fonts = [(f, rng.choice("ab"), rng.choice(["uchen", "ume"]), rng.choice(assignment.SPLITS[:2])) for f in range(14)]
    pairs = [(f[0], c, float(c * 7 % 5)) for f in fonts for c in range(30) if rng.random() < 0.5]
    quotas = [(c, s, p, rng.choice([3, 9, 40])) for c, s, p in sorted({f[1:] for f in fonts})]
    found = greedy.greedy_plan(
        spark.createDataFrame(fonts, "renderer long, category string, script string, split string"),
        spark.createDataFrame(pairs + pairs[:5], "renderer long, chunk long, difficulty double"),
        spark.createDataFrame(quotas, "category string, script string, split string, quota long"), reusable=4,
    )
    assert sorted((tuple(r) for r in found.collect()), key=lambda r: r[-1]) == plain_plan(fonts, pairs, quotas, 4)


def test_places_within_hot_groups(spark):
    rows = [("a", i) for i in range(500)] + [(None, i) for i in range(40)] + [("b", 1)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int")
    assert all(r.place == r.i + (1 if r.g != "b" else 0) for r in numbering.numbered_within(df, ["g"], ["i"]).collect())


@pytest.fixture(scope="module")
def plan(spark):
    rng = random.Random(2)
    fonts = [(f"f{i}", "ab"[i % 2], "xy"[i // 2 % 2], assignment.SPLITS[i % 3]) for i in range(24)]
    pairs = [(f[0], f"c{c}", float(c % 50)) for c in range(300) for f in fonts if rng.random() < 0.4] + [(None, "c1", 1.0), ("f1", None, 1.0)]
    quotas = [(a, b, s, {"train": 30, "val": 9, "test": 5}[s]) for a in "ab" for b in "xy" for s in assignment.SPLITS]
    frames = (
        spark.createDataFrame(fonts, "renderer string, category string, script string, split string"),
        spark.createDataFrame(pairs + pairs[:50], "renderer string, chunk string, difficulty double"),
        spark.createDataFrame(quotas, "category string, script string, split string, quota long"),
    )
    rows = [assignment.assign_chunks(*frames, reusable=12, seed=3).collect() for _ in range(2)]
    return {f[0]: f[1:] for f in fonts}, {p[:2] for p in pairs}, {q[:3]: q[3] for q in quotas}, rows


def test_assignment_keeps_its_rules(plan):
    fonts, pairs, quotas, (rows, again) = plan
    assert sorted(rows) == sorted(again)
    assert all((r.renderer, r.chunk) in pairs and fonts[r.renderer] == (r.category, r.script, r.split) for r in rows)
    assert len({(r.renderer, r.chunk) for r in rows}) == len(rows)
    splits, uses = defaultdict(set), Counter(r.chunk for r in rows)
    for r in rows:
        splits[r.chunk].add(r.split)
    assert all(len(s) == 1 for s in splits.values())
    assert sum(n > 1 for n in uses.values()) <= 12
    got = Counter((r.category, r.script, r.split) for r in rows)
    assert all(n <= quotas[cell] for cell, n in got.items())


def test_short_cells_have_nothing_left(plan):
    fonts, pairs, quotas, (rows, _) = plan
    got, used = Counter((r.category, r.script, r.split) for r in rows), {r.chunk: r.split for r in rows}
    for (renderer, chunk) in pairs:
        if renderer is None or chunk is None or chunk in used:
            continue
        cell = fonts[renderer]
        open_ = got[cell] < quotas[cell]
        # an unused chunk of this split would have been taken
        assert not open_ or chunk_split(chunk) != cell[2]


def chunk_split(chunk):
    from pyspark.sql import SparkSession

    if chunk not in chunk_split.known:
        s = SparkSession.getActiveSession()
        df = s.createDataFrame([(f"c{i}",) for i in range(300)], "c string")
        chunk_split.known = {r.c: r.s for r in df.select("c", assignment.owner(F.col("c"), 3).alias("s")).collect()}
    return chunk_split.known[chunk]


chunk_split.known = {}


def test_no_pairs_give_no_plan(plan, spark):
    fonts = spark.createDataFrame([], "renderer string, category string, script string, split string")
    pairs = spark.createDataFrame([], "renderer string, chunk string, difficulty double")
    quotas = spark.createDataFrame([], "category string, script string, split string, quota long")
    assert assignment.assign_chunks(fonts, pairs, quotas, 3).count() == 0


def test_merging_matches_a_loop(spark):
    rng = random.Random(5)
    rows = [(b, i, f" t{i} " if i % 7 else None, rng.randint(1, 9), rng.random() < 0.6) for b in range(12) for i in range(rng.randint(1, 20))]
    df = spark.createDataFrame(rows, "batch int, at int, text string, n int, short boolean")
    found = layout.merge_short(df.withColumn("ids", F.col("at")), "batch", "at", F.col("short"), "text", ["n"], [], ["ids"])
    wanted = []
    for b in range(12):
        own, i = [r for r in rows if r[0] == b], 0
        while i < len(own):
            part = own[i : i + 2] if own[i][4] and i + 1 < len(own) else own[i : i + 1]
            i += len(part)
            wanted.append((b, part[0][1], " ".join((r[2] or "").strip() for r in part).strip(), sum(r[3] for r in part), "|".join(str(r[1]) for r in part)))
    assert sorted((r.batch, r["at"], r.text, r.n, r.ids) for r in found.collect()) == sorted(wanted)


def test_random_pages(spark):
    texts = [f"unit number {i} ".ljust(25, "x") for i in range(50)]
    units = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(98, " "), (99, None)], "i int, u string")
    pages = spark.createDataFrame([(i, i % 2 == 0) for i in range(8)], "page int, plain boolean")
    told = dict(page="page", unit="u", key=["i"], p=tx.LATIN, plain=F.col("plain"), special=["7", "9x"], mandatory=" piece 7 ", heading="# ", least=5, most=9, pad=400, cut=450)
    found = {r.page: r.text for r in layout.random_pages(pages, units, **told).collect()}
    assert set(found) == set(range(8)) and len(set(found.values())) == 8 and all(402 <= len(t) <= 452 and t.startswith("# ") for t in found.values())
    assert all(("piece 7" in t) == (i % 2 == 1) for i, t in found.items()) and not any(x in t for i, t in found.items() if i % 2 == 0 for x in ("7", "9x"))
    # the piece doesn't keep one place
    assert len({t.index("piece 7") for i, t in found.items() if i % 2}) > 1
    assert found == {r.page: r.text for r in layout.random_pages(pages.repartition(3), units.repartition(5), **told).collect()}
    assert layout.random_pages(pages, units.limit(0), **told).count() == 0
    # a unit that occurs often is drawn often
    many = spark.createDataFrame([(i, "often" if i < 90 else "seldom") for i in range(100)], "i int, u string")
    text = " ".join(r.text for r in layout.random_pages(pages, many, "page", "u", ["i"], tx.LATIN, least=60, most=60, pad=1).collect())
    assert 0.8 < text.count("often") / 480 < 0.97 and "#" not in text


def test_units_behind_the_first_stop(spark):
    text = "§ first. second one \r\n -- PAGE\t12 -- \n§third..  . tail"
    row = spark.createDataFrame([(text,), ("no stop",), ("",), (None,)], "t string").select(tx.later_units(F.col("t"), tx.LATIN, "§ ?").alias("u")).collect()
    assert [r.u for r in row] == [["second one \nthird.", "tail."], [], [], None]


def test_layout_passes_match_a_loop(spark):
    rng = random.Random(6)
    rows = [(b, i, ["x" * rng.randint(1, 30), " y ", None][min(2, i % 9)], rng.randint(1, 9), rng.randint(1, 9)) for b in range(10) for i in range(rng.randint(1, 25))]
    df = spark.createDataFrame(rows, "batch int, at int, text string, n int, most int").withColumn("ids", F.col("at")).withColumn("short", F.lit("clash"))
    for passes in (0, 2, 5):
        found = layout.merge_until_settled(df, lambda: F.length("text") <= 40, "batch", "at", "text", ["n"], ["most"], ["ids"], passes)
        wanted = []
        for b in range(10):
            own, merges = [[r[1], (r[2] or "").strip(), r[3], r[4], str(r[1])] for r in rows if r[0] == b], 0
            for _ in range(passes):
                i, out = 0, []
                while i < len(own):
                    if len(own[i][1]) <= 40 and i + 1 < len(own):
                        x, y = own[i], own[i + 1]
                        out.append([x[0], f"{x[1]} {y[1]}".strip(), x[2] + y[2], max(x[3], y[3]), f"{x[4]}|{y[4]}"])
                        i += 2
                    else:
                        out.append(own[i])
                        i += 1
                if len(out) == len(own):
                    break
                own, merges = out, merges + 1
            wanted += [(b, *r, len(r[1]) <= 40, merges) for r in own]
        assert sorted((r.batch, r["at"], r.text, r.n, r.most, r.ids, r.short, r.passes) for r in found.collect()) == sorted(wanted)
    assert layout.merge_until_settled(df.limit(0), lambda: F.lit(None).cast("boolean"), "batch", "at", "text", ["n"], ["most"], ["ids"]).count() == 0


def test_stack_table(spark):
    stacks = ["ཀྲི", "ཀྲི", "", None, "aé", "e\u0301😀", "\u0f48", "ཧཱུྃ" * 300]
    found = {r.stack: r for r in characters.stack_table(spark.createDataFrame([(s, 1) for s in stacks], "stack string, name int"), "stack").collect()}
    assert set(found) == {s for s in stacks if s is not None} and found["ཀྲི"].occurrences == 2
    within = lambda s, *ranges: sum(any(a <= ord(c) <= b for a, b in ranges) for c in s)
    for s, r in found.items():
        base, below, vowels = within(s, (0x0F40, 0x0F6C)), within(s, (0x0F90, 0x0FBC)), within(s, (0x0F71, 0x0F84), (0x0F86, 0x0F87), (0x0FC6, 0x0FC6))
        assert (r.stack_len, r.base_count, r.subjoined_count, r.vowel_diacritic_count) == (len(s), base, below, vowels)
        assert r.combining_count == sum(unicodedata.combining(c) > 0 for c in s) and r.complexity == below + vowels + max(0, base - 1)
        assert r.unicode_names == " | ".join(unicodedata.name(c, "UNKNOWN") for c in s) and r.codepoints == " ".join(f"U+{ord(c):04X}" for c in s)
        assert (r.has_subjoined, r.has_vowel_diacritic, r.has_bottom_vowel) == (below > 0, vowels > 0, any(c in "\u0f71\u0f73\u0f74\u0f75\u0f76\u0f77\u0f80\u0f81" for c in s))
    assert characters.stack_table(spark.createDataFrame([], "stack string"), "stack").count() == 0


def test_a_hot_name_and_names_that_are_taken(spark):
    rows = [(i, "hot") for i in range(400)] + [(1000 + i, f"hot_{i}") for i in (1, 2, 7)] + [(2000, None), (2001, None), (2002, "hot_7"), (2003, "hot_7_1")]
    found = {r.id: r.unique_name for r in numbering.unique_names(spark.createDataFrame(rows, "id int, name string").repartition(7), [], "name", ["id"]).collect()}
    made = [found[i] for i in range(400)]
    assert made[:3] == ["hot", "hot_3", "hot_4"] and len(set(made)) == 400 and made[-1] == "hot_402"
    assert [found[i] for i in (1001, 1002, 1007, 2003)] == ["hot_1", "hot_2", "hot_7", "hot_7_1"] and found[2002] == "hot_7_2"


def test_pages_draw_little_more_than_they_need(spark, monkeypatch):
    """One short unit doesn't make every page draw as many units as it would take of that one."""
    made, real = [], layout.saved
    monkeypatch.setattr(layout, "saved", lambda frame: made.append(real(frame)) or made[-1])
    units = spark.createDataFrame([(i, "x" if i == 0 else f"{i:04}" * 10) for i in range(2000)], "i long, u string")
    pages = spark.range(40).withColumnRenamed("id", "page")
    found = layout.random_pages(pages, units, "page", "u", ["i"], tx.LATIN, least=10, most=20, pad=2000).collect()
    assert len(found) == 40 and all(2000 <= len(r.text) <= 2041 for r in found)
    assert max(r.next for frame in made if "next" in frame.columns for r in frame.collect()) < 100


def test_pairs_of_renderers_are_made_once(spark):
    """Distinct pairs and the renderers' splits are read again, not made again by each use."""
    pairs, _, splits = catalogue._renderers(spark, "/root/testdata/sf0.001")
    assert not any("Aggregate" in str(x._jdf.queryExecution().optimizedPlan()) for x in (pairs, splits))
    assert pairs.count() == pairs.distinct().count()


def test_many_draws_are_not_broadcast(spark, monkeypatch):
    """Spark takes draws for as small as the pages that make them; more than a few are joined by a shuffle, with the same pages."""
    units = spark.createDataFrame([(i, f"unit number {i} ".ljust(25, "x")) for i in range(300)], "i int, u string")
    pages = spark.range(30).withColumnRenamed("id", "page")
    plans, real = [], layout.saved

    def noted(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return real(frame)

    monkeypatch.setattr(layout, "saved", noted)
    told = dict(page="page", unit="u", key=["i"], p=tx.LATIN, least=5, most=9, pad=400, cut=450)
    wanted = sorted(layout.random_pages(pages, units, **told).collect())
    plans.clear()
    monkeypatch.setattr(layout, "SENT_DRAWS", 10, raising=False)
    assert sorted(layout.random_pages(pages, units, **told).collect()) == wanted and len(wanted) == 30
    drawing = [p for p in plans if "explode(sequence(" in p]
    assert drawing and all("SortMergeJoin [plain" in p for p in drawing)
