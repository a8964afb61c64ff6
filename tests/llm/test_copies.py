"""Exact and near copies, and the mix."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from scriptorium.llm import common, exact_dedup, mixing, near_dedup, registry
from scriptorium.llm.components import connected_components

from . import brute
from .conftest import EDGES, SF


def test_exact_copies(spark, texts):
    groups = defaultdict(list)
    for i, t in texts.items():
        groups[(t or "").translate(brute.UPPER)].append(i)
    expected = {i: (max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids}
    found = {r["doc_id"]: tuple(r)[1:] for r in registry.op7_exact_dedup(spark, SF).collect()}
    assert found == expected


def test_exact_edges(edges, no_rows):
    rows = exact_dedup.exact_dedup(edges).collect()
    assert len(rows) == len(EDGES)
    keep = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in rows}
    assert keep[1] == (2, 2, False) and keep[2] == (2, 2, True)  # null counts as empty
    assert keep[4] == (5, 2, False) and keep[6] == (7, 2, False)
    assert keep[8] == (8, 2, True) and keep[9] == (9, 1, True)
    assert exact_dedup.drop_exact_copies(edges).columns == edges.columns
    assert exact_dedup.exact_dedup(no_rows).count() == 0


def test_rows_without_an_id(spark):
    rows = [(1, "A"), (None, "a"), (None, "b"), (None, "B"), (2, "c"), (2, "c"), (2, "other"), (None, None), (3, ""), (None, "lone text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r["doc_id"] or 0, r["text_sha256"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(docs, digest=True).collect()), key=str)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    a, b, c, none = sha("a"), sha("b"), sha("c"), sha("")
    wanted = [(0, a, 1, 2, False), (1, a, 1, 2, True), (0, b, None, 2, True), (0, b, None, 2, True), (2, c, 2, 2, True), (2, c, 2, 2, True), (2, sha("other"), 2, 1, True), (0, none, 3, 2, False), (3, none, 3, 2, True), (0, sha("lone text"), None, 1, True)]
    assert found == sorted(wanted, key=str)
    kept = [tuple(r) for r in exact_dedup.drop_exact_copies(docs).collect()]
    assert sorted(kept, key=str) == sorted([r for r in rows if r not in ((None, "a"), (None, None))], key=str)

    rows = [(5, "a b c"), (None, "a b c"), (7, "A b c"), (None, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {tuple(r) for r in near_dedup.near_duplicates(docs, words=2).collect()}
    assert found == {(5, 2, 5, True), (7, 2, 5, False), (None, 2, None, True), (None, 1, None, True)}
    assert near_dedup.drop_near_copies(docs, words=2).count() == 3

    rows = [(1, "a b c"), (None, "d e"), (2, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s"))
    found = {r["doc_id"]: (r["size"], r["source_size"], r["taken"]) for r in mixing.mix_sources(docs, F.array("source")).collect()}
    assert found[None][:2] == (2, 6) and found[None][2] == 2  # 9 of 6 words: all once, the rest without the one that has no id


def test_hot_keys_join_alike(spark, documents, texts, monkeypatch):
    """With every key hot, results are those of the plain version."""
    monkeypatch.setattr(common, "HOT_ROWS", 1)
    rows = near_dedup.near_duplicates(documents, words=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute.components(texts, 2)
    assert {r["doc_id"]: r["kept"] for r in exact_dedup.exact_dedup(documents).collect()} == {r["doc_id"]: r["kept"] for r in registry.op7_exact_dedup(spark, SF).collect()}


@pytest.mark.parametrize("words", [2, 5])
def test_near_copies(documents, texts, words):
    expected = brute.components(texts, words)
    rows = near_dedup.near_duplicates(documents, words=words).collect()
    assert len(rows) == len(texts)
    for r in rows:
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(brute.shingles(texts[i], words)), expected[i], i == expected[i]), i


@pytest.mark.parametrize("bound, most", [("BLOCK", 16), ("BLOCK_SHINGLES", 1600)])
def test_near_chain_and_large_bucket(spark, monkeypatch, bound, most):
    """Links through others, at the threshold, and buckets that are cut into blocks."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows, text = {}, list(base)
    for i in range(40):  # a chain: neighbours are similar, the ends are not
        rows[i] = " ".join(text)
        text[rng.randrange(60)] = f"x{i}"
    for i in range(150):  # many variants of one text
        other = [f"v{k}" for k in range(80)]
        for _ in range(rng.randrange(6)):
            other[rng.randrange(80)] = f"y{rng.randrange(1000)}"
        rows[1000 + i] = " ".join(other)
    monkeypatch.setattr(near_dedup, bound, most)
    monkeypatch.setattr(near_dedup, "PIECE", 20)
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, words=2).collect()}
    assert found == brute.components(rows, 2)


def test_bayes_survivors_keep_similar_pairs():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**16, (2000, near_dedup.HASHES), dtype=np.uint16)
    same = rng.random(x.shape) < 0.8
    assert len(near_dedup.bayes_survivors(x, np.where(same, x, x + 1), 80)) >= 1990
    same = rng.random(x.shape) < 0.4
    assert len(near_dedup.bayes_survivors(x, np.where(same, x, x + 1), 80)) == 0


def test_near_edges(edges, no_rows):
    rows = near_dedup.near_duplicates(edges, words=2).collect()
    assert len(rows) == len(EDGES)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert found[1] == (0, 1, True) and found[2] == (0, 2, True) and found[3] == (0, 3, True)
    assert found[4] == (1, 4, True) and found[5] == (1, 4, False)
    assert found[7][1:] == (6, False) and found[8] == (7, 8, True)
    assert near_dedup.near_duplicates(no_rows).count() == 0
    assert near_dedup.drop_near_copies(edges).columns == edges.columns


def test_components_of_a_long_path(spark):
    ids = list(range(60))
    random.Random(2).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    assert {r["component"] for r in connected_components(links).collect()} == {0}
    assert connected_components(links.filter("false")).count() == 0


def level_targets(total, weights, caps):
    """Targets by the level to which all sources fill: min(cap, level * weight), the level found by bisection."""
    low, high = 0.0, 2.0 * total
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(caps[s], mid * w) for s, w in weights.items()) < total else (low, mid)
    return {s: min(caps[s], high * w) for s, w in weights.items()}


def test_mix(spark):
    sf = SF.replace("0.001", "0.01")
    documents = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = registry.op8_mix_sources(spark, sf).collect()
    source = {r["doc_id"]: r["source"] for r in documents}
    size = {r["doc_id"]: len(brute.WORD.findall(r["text"] or "")) for r in documents}
    assert {r["doc_id"]: r["size"] for r in rows} == size
    whole = defaultdict(int)
    for i, n in size.items():
        whole[source[i]] += n
    ordered = sorted(whole, key=lambda s: (s is None, s))
    target = level_targets(1.5 * sum(size.values()), {s: (5, 2, 1)[i % 3] for i, s in enumerate(ordered)}, {s: 2 * n for s, n in whole.items()})
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == whole[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[source[r["doc_id"]]] += r["taken"]
    for s, t in target.items():  # whole documents only
        assert taken[s] == pytest.approx(t, rel=0.005, abs=50)
    again = registry.op8_mix_sources(spark, sf).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def most_words(supply, quota, uses):
    """The largest flow by its smallest cut: for each set of sources that are cut, their quotas and what the others' patterns hold."""
    sources, best = sorted(quota), None
    for bits in range(1 << len(sources)):
        cut = {s for i, s in enumerate(sources) if bits >> i & 1}
        value = sum(quota[s] for s in cut) + sum(uses * n for own, n in supply if set(own) - cut)
        best = value if best is None else min(best, value)
    return best


def test_flow_over_overlapping_sources():
    """As much as the smallest cut lets through, and as many first uses as there can be, on random patterns."""
    rng = random.Random(9)
    for _ in range(300):
        names = "abcde"[: rng.randrange(1, 6)]
        supply = [(own, rng.randrange(40)) for own in {tuple(sorted(rng.sample(names, rng.randrange(1, len(names) + 1)))) for _ in range(rng.randrange(1, 9))}]
        quota = {s: rng.randrange(120) for s in {s for own, _ in supply for s in own}}
        sent = mixing.min_cost_flow(supply, quota)
        for (own, words), x in zip(supply, sent):
            assert set(x) == set(own) and all(n >= 0 for n in x.values()) and sum(x.values()) <= 2 * words
        for s, q in quota.items():
            assert sum(x.get(s, 0) for x in sent) <= q
        assert sum(sum(x.values()) for x in sent) == most_words(supply, quota, 2)
        assert sum(min(sum(x.values()), n) for (_, n), x in zip(supply, sent)) == most_words(supply, quota, 1)
    with pytest.raises(ValueError):
        mixing.min_cost_flow([(("a",), 1)], {"a": 1}, costs=(3, 1))
    chain = [((f"s{i:04d}", f"s{i + 1:04d}"), 1) for i in range(1500)]
    sent = mixing.min_cost_flow(chain, {"s0000": 1500} | {f"s{i:04d}": 0 for i in range(1, 1501)})
    assert sum(sum(x.values()) for x in sent) == 2


def test_mix_of_overlapping_sources(spark):
    """Shared documents fill the source that lacks words, and no document is taken more than twice."""
    rng = random.Random(10)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 9)), ["a"] if i % 4 == 0 else ["a", "b"] if i % 4 == 1 else ["b", None] if i % 4 == 2 else []) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, member array<string>")
    found = mixing.mix_sources(docs, F.col("member")).collect()
    size = {i: len(t.split()) for i, t, _ in rows}
    assert all(r["size"] == size[r["doc_id"]] and r["taken"] in (0, r["size"], 2 * r["size"]) for r in found)
    supply = defaultdict(int)
    for i, _, own in rows:
        supply[tuple(sorted(own, key=lambda s: (s is not None, s or "")))] += size[i]
    whole = {s: sum(n for own, n in supply.items() if s in own) for s in ("a", "b", None)}
    target = level_targets(1.5 * sum(size.values()), {"a": 5, "b": 2, None: 1}, {s: 2 * n for s, n in whole.items()})
    assert sum(r["taken"] for r in found) == pytest.approx(sum(min(t, 2 * whole[s]) for s, t in target.items()), rel=0.02)
    assert all(r["taken"] == 0 and r["target"] == 0 for r in found if not rows[r["doc_id"]][2])


def test_water_fill():
    assert mixing.water_fill(100, {"a": 5, "b": 2, "c": 1}, {"a": 20, "b": 1000, "c": 1000}) == pytest.approx({"a": 20, "b": 160 / 3, "c": 80 / 3})
    assert mixing.cycled_weights(["b", None, "a", "Z"]) == {"Z": 5, "a": 2, "b": 1, None: 5}


def test_mix_edges(edges, no_rows):
    rows = mixing.mix_sources(edges, F.array("source")).collect()
    assert len(rows) == len(EDGES)
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert all(r["taken"] == 0 for r in rows if r["doc_id"] in (1, 2, 3))
    assert mixing.mix_sources(no_rows, F.array("source")).count() == 0
    kept = mixing.take_mix(edges, F.array("source"))
    assert kept.columns == edges.columns and kept.filter("doc_id = 1").count() == 1
