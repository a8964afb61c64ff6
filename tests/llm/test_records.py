"""Nearest neighbours, personal data, conversations, archives, and the whole pipeline."""

import base64
import hashlib
import math
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import chat, nearest, private_data, registry, warc

from . import brute
from .conftest import EDGES, SF


def exact_neighbours(vectors, queries, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], np.float64)
    out = {}
    for q in queries:
        score = x @ np.asarray(vectors[q], np.float64)
        score[ids == q] = -np.inf
        out[q] = [int(ids[j]) for j in np.lexsort((ids, -score))[: min(k, len(ids) - 1)]]
    return out


def test_neighbours_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    vectors = {r["vec_id"]: r["embedding"] for r in rows if r["embedding"] and all(v is not None and np.isfinite(v) for v in r["embedding"]) and any(r["embedding"])}
    expected = exact_neighbours(vectors, [i for i in vectors if i % 20 == 0], 20)
    found = defaultdict(dict)
    for r in registry.op2_nearest_neighbours(spark, "/root/testdata/sf0.01").collect():
        found[r["query_id"]][r["rank"]] = r["vec_id"]
        exact = float(np.dot(np.array(vectors[r["query_id"]], np.float64), np.array(vectors[r["vec_id"]], np.float64)))
        assert r["score"] == pytest.approx(exact, rel=1e-12, abs=1e-12)
    assert all(sorted(x) == list(range(1, 21)) for x in found.values()) and set(found) == set(expected)
    assert np.mean([len(set(found[q].values()) & set(expected[q])) / 20 for q in expected]) >= 0.9


def test_neighbours_over_shards(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD_ROWS", 300)
    rng = np.random.default_rng(4)
    vectors = {i: [float(x) for x in rng.normal(size=16).astype(np.float32)] for i in range(1200)}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>")
    expected = exact_neighbours(vectors, range(0, 1200, 20), 20)
    found = defaultdict(set)
    for r in nearest.nearest_neighbours(frame, frame.filter("vec_id % 20 = 0")).collect():
        found[r["query_id"]].add(r["vec_id"])
    assert np.mean([len(found[q] & set(expected[q])) / 20 for q in expected]) >= 0.9


def test_more_neighbours_than_the_usual_beam(spark):
    rng = np.random.default_rng(5)
    vectors = {i: [float(x) for x in rng.normal(size=8).astype(np.float32)] for i in range(250)}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>")
    found = nearest.nearest_neighbours(frame, frame.filter("vec_id = 0"), k=200).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == exact_neighbours(vectors, [0], 200)[0]


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (20, [1.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (6, [1.0, 1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("shard", F.lit("x"))
    found = [tuple(r) for r in nearest.nearest_neighbours(frame, frame.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 6, 1.0), (0, 2, 7, 1.0), (0, 3, 20, 1.0), (20, 1, 6, 2.0), (20, 2, 7, 2.0), (20, 3, 0, 1.0)]
    none = frame.filter("false")
    assert nearest.nearest_neighbours(none, none).count() == 0


def test_base_spans(spark, texts):
    rng = random.Random(6)
    made = {10**6 + i: "".join(rng.choice(["1", "25", "4", ".", "@", "+", " ", "-", "a", "b.c", "(", ")", "é", "😀", "4111 1111 1111 1111", "_"]) for _ in range(rng.randrange(40))) for i in range(1500)}
    every = texts | made
    docs = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    rows = private_data.span_digests(private_data.find_spans(docs)).collect()
    assert len(rows) == len(every)
    for r in rows:
        expected = brute.base_spans(every[r["doc_id"]])
        base = [s for s in r["spans"].split(",") if s and not s.startswith("term:")]
        assert base == expected, every[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s.startswith(k) for s in expected) for k in brute.BASE]


def test_revealing_terms(spark):
    """A nickname that stands only near one address reveals it; common words don't."""
    rows = [(i, f"note {i} from the office zorblax writes to ann@example.org about paper {i}") for i in range(5)]
    rows += [(100 + i, f"note {i} from the office about paper and writes {i} more") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in private_data.find_spans(docs).collect()}
    for i, text in rows:
        terms = {text[t["start"] : t["end"]] for t in found[i]["terms"]}
        assert ("zorblax" in terms) == (i < 5) and not terms & {"note", "from", "about", "paper", "writes", "office"}
    clean = {r["doc_id"]: r["sanitised"] for r in private_data.sanitise(docs).collect()}
    assert "ann@" not in clean[0] and "[email]" in clean[0] and "zorblax" not in clean[0]
    assert clean[100] == rows[5][1]


def test_terms_of_a_rare_entity(spark):
    """An address that stands in one text is revealed by the name beside it; two texts tell more than one."""
    rows = [(0, "the office writes that zorblax has bob@example.org here")]
    rows += [(i, f"the office writes that quuxly has ann@example.org here and more of {i}") for i in (1, 2)]
    rows += [(100 + i, f"the office writes that nobody has more of {i} here and there") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["terms"] for r in private_data.find_spans(docs).collect()}
    for i, text in rows:
        terms = {text[t["start"] : t["end"]] for t in found[i]}
        assert terms == ({"zorblax"} if i == 0 else {"quuxly"} if i < 3 else set())


def test_terms_stand_anywhere(spark):
    """Far from the address, again in its text, in texts without it, with digits, of two letters, and in an unspaced script."""
    far = "the office writes here and more of it " * 10
    names = ["zorb_42", "qo", "張大明"]
    rows = [(i, f"ann@example.org {far} {name} {far} x{name}x {name}") for i, name in enumerate(names)]
    rows += [(10 + i, f"{far} {name} {far}") for i, name in enumerate(names)]
    rows += [(100 + i, f"{far} {i}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in private_data.find_spans(docs).collect():
        text = dict(rows)[r["doc_id"]]
        found = [text[t["start"] : t["end"]] for t in r["terms"]]
        i = r["doc_id"]
        if i >= 100:
            assert found == []
        elif i >= 10:
            assert found == [names[i - 10]]
        else:
            assert found == ([names[i]] * 3 if i == 2 else [names[i], f"x{names[i]}x", names[i]])


def plain_terms(texts):
    """Spans of the revealing terms of each text (words of letters only), from the definition: plain counts over distinct texts."""
    kept = sorted(set(texts))
    spans, words, entities = {}, {}, {}
    for t in kept:
        found = [(m.start(), m.end(), f"{k}:{re.sub('[^0-9]', '', m[0]) if k in ('card', 'phone') else m[0].lower()}") for k, m in brute.base_matches(t)]
        entities[t] = {e for _, _, e in found}
        clear = list(t)
        for a, b, _ in found:
            clear[a:b] = " " * (b - a)
        spans[t] = [(m.start(), m.end(), m[0].lower()) for m in re.finditer("[A-Za-z0-9_]{2,}", "".join(clear))]
        words[t] = {w for _, _, w in spans[t]}
    n, c_t, c_e = len(kept), Counter(w for t in kept for w in words[t]), Counter(e for t in kept for e in entities[t])
    c_te = Counter((w, e) for t in kept for w in words[t] for e in entities[t])
    most = defaultdict(float)
    for (w, e), x in c_te.items():
        if c_e[e] < n:
            p = (x + private_data.PRIOR_TEXTS * c_e[e] / n) / (c_t[w] + private_data.PRIOR_TEXTS)
            most[w] = max(most[w], math.log2(p * n / c_e[e]) / math.log2(n / c_e[e]))
    told = {w: x >= private_data.REMOVE for w, x in most.items() if x >= private_data.GENERALISE}
    return [[(a, b, told[w]) for a, b, w in spans[t] if w in told] for t in texts], c_t


def test_terms_equal_the_plain_counts(spark):
    rng = random.Random(12)
    common, rare = [f"common{i}" for i in range(30)], [f"rare{i}" for i in range(200)]
    texts = []
    for i in range(400):
        said = [rng.choice(common) for _ in range(12)] + [rng.choice(rare) for _ in range(rng.randrange(3))]
        if rng.random() < 0.15:
            k = rng.randrange(20)
            said += [f"p{k}@example.org", f"nick{k}", f"shared{k // 4}"][: rng.randrange(1, 4)]
        rng.shuffle(said)
        texts.append(" ".join(said))
    texts += texts[:40]
    wanted, c_t = plain_terms(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    puts = set()
    for r in private_data.sanitise(docs).collect():
        found = [(t["start"], t["end"], t["put"] == "") for t in r["terms"]]
        text = texts[r["doc_id"]]
        assert found == wanted[r["doc_id"]], text
        base = [(m.start(), m.end(), f"[{k}]") for k, m in brute.base_matches(text)]
        clean, at = "", 0
        for a, b, put in sorted([*base, *((t["start"], t["end"], t["put"]) for t in r["terms"])]):
            clean, at = clean + text[at:a] + put, b
        assert r["sanitised"] == clean + text[at:]
        puts |= {(text[t["start"] : t["end"]], t["put"]) for t in r["terms"] if t["put"]}
    assert puts
    for word, put in puts:  # a prefix that many texts have, or the kind
        assert put == "[term]" or word.startswith(put[:-1]) and put.endswith("*") and max(n for w, n in c_t.items() if w.startswith(put[:-1])) > c_t[word]


def test_private_edges(edges, no_rows):
    rows = private_data.span_digests(private_data.find_spans(edges)).collect()
    assert len(rows) == len(EDGES) and {r["spans"] for r in rows} == {""}
    assert private_data.find_spans(no_rows).count() == 0


def chat_expected(rows):
    turns = defaultdict(list)
    for r in rows:
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    turns[-7] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    out = {}
    for c, said in turns.items():
        said.sort()
        loss = "".join(t for _, role, t in said if role == "assistant")
        out[c] = (len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in said).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_conversations(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    found = {r["conv_id"]: tuple(r)[1:5] for r in registry.op5_chat_format(spark, SF).collect()}
    assert found == chat_expected(rows)


def test_hard_texts_read_back(spark):
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[SAYS]", "\\", "<", "[", "\\\\<", " ", "x", "$1", "\n", "😀"]
    rng = random.Random(8)
    rows = [(i // 4, i % 4, rng.choice(["user", "assistant", "system", "<s>\\", ""]), "".join(rng.choice(bits) for _ in range(rng.randrange(12)))) for i in range(800)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat.read_back(chat.format_trees(chat.linear_replies(frame))).collect():
        said = rows[4 * r["tree"] : 4 * r["tree"] + 4]
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(role, text) for _, _, role, text in said]
        assert r["loss_text"] == "".join(text for _, _, role, text in said if role == "assistant")


def test_branches_rank_by_score(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 2.0), (1, 4, 3, "user", "more", None), (1, 5, 2, "user", "thanks", 0.5), (2, 9, 8, None, None, None)]
    frame = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double").fillna("", ["role", "text"])
    best = {r["tree"]: r for r in chat.read_back(chat.format_trees(frame)).collect()}
    assert [t["text"] for t in best[1]["turns"]] == ["q", "good", "more"] and best[1]["loss_text"] == "good"
    assert best[2]["leaf"] == 9 and chat.format_trees(frame, per_tree=2).count() == 3
    assert chat.format_trees(frame.filter("false")).count() == 0


def test_archives(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    groups = defaultdict(list)
    for i, html in pages.items():
        groups[(html or "").encode()].append(i)
    expected = {}
    for payload, ids in groups.items():
        for i in ids:
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            expected[i] = (len(payload), digest, "response" if i == max(ids) else "revisit", None if i == max(ids) else max(ids))
    found = {r["page_id"]: tuple(r)[1:] for r in registry.op6_warc(spark, SF).collect()}
    assert found == expected


def test_page_edges(spark):
    rows = [(1, None, None), (2, "http://x/ y\n", ""), (3, "", "WARC/1.1\r\n\r\nfiledesc: x"), (4, "http://z", "é😀\r\n\r\n\x00"), (5, "http://z", "é😀\r\n\r\n\x00"), (None, "http://n", "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("x"))
    found = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive_pages(pages).collect()}
    assert found == {1: (0, "revisit", 2), 2: (0, "response", None), 3: (23, "response", None), 4: (11, "revisit", 5), 5: (11, "response", None), None: (1, "response", None)}
    assert warc.archive_pages(pages.filter("false")).count() == 0


def test_hot_payload_and_repeated_pages(spark):
    rows = [(i, None, "same") for i in range(1100)] + [(7, None, "other"), (2000, None, "other"), (2001, None, "alone"), (2001, None, "alone too")]
    found = sorted(tuple(r) for r in warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).select("page_id", "payload_bytes", "record_type", F.coalesce("refers_to", F.lit(-1))).collect())
    expected = [(i, 4, "revisit", 1099) for i in range(1099)] + [(1099, 4, "response", -1), (7, 5, "revisit", 2000), (2000, 5, "response", -1), (2001, 5, "response", -1), (2001, 9, "response", -1)]
    assert found == sorted(expected)


@pytest.mark.parametrize("version", [1, 2])
def test_arc_files_become_warc(spark, version):
    contents = [warc.page_content(i, "<p>\n\nhttp://a 1 2 text/html 3\n" * i) for i in range(4)]
    data, at = warc.arc_opening(version, "old.arc"), 0
    for i, c in enumerate(contents):
        data += warc.arc_record(version, f"http://h/{i}", c, "old.arc", at, "20010203040506")
    read = list(warc.read_arc(data))
    assert [r["content"] for r in read[1:]] == contents and read[0]["url"] == "filedesc://old.arc"
    out = warc.convert_archives(spark.createDataFrame([("old.arc", bytearray(data))], "path string, content binary")).first()["warc"]
    records = list(warc.read_warc(bytes(out)))
    assert [h["warc-type"] for h, _ in records] == ["warcinfo"] + ["response"] * 4
    assert records[1][0]["warc-date"] == "2001-02-03T04:05:06Z" and len({h["warc-record-id"] for h, _ in records}) == 5
    assert [b for _, b in records[1:]] == contents
    with pytest.raises(ValueError):
        list(warc.read_arc(data[:-10]))


def test_odd_arc_records(spark):
    """A URL with spaces is read; a bad record costs itself alone."""
    data = warc.arc_opening(1, "old.arc") + warc.arc_record(1, "http://h/a b c", warc.page_content(1, "x"), "old.arc", 0)
    data += b"no header at all 7\nabcdefg\n" + warc.arc_record(1, "http://h/d", warc.page_content(2, "y"), "old.arc", 0) + b"rubbish"
    with pytest.raises(ValueError):
        list(warc.read_arc(data))
    files = spark.createDataFrame([("old.arc", bytearray(data)), (None, None)], "path string, content binary")
    found = {r["name"]: r for r in warc.convert_archives(files).collect()}
    assert found[None]["warc"] == b"" and found[None]["rejected"] == []
    assert [h.get("warc-target-uri") for h, _ in warc.read_warc(bytes(found["old.arc"]["warc"]))] == [None, "http://h/a%20b%20c", "http://h/d"]
    assert len(found["old.arc"]["rejected"]) == 2


def test_every_node_can_be_reached():
    rng = np.random.default_rng(3)
    for _ in range(40):
        middles = rng.normal(size=(8, 6)) * 50
        x = np.concatenate([m + rng.normal(size=(40, 6)) * 0.01 for m in middles]).astype(np.float32)
        graph = nearest.build_graph(x)
        assert nearest.reached(graph, np.zeros(len(x), bool), np.array([0])).all()
    alone = np.full((50, 4), -1, np.int32)
    assert nearest.reached(nearest.connect(rng.normal(size=(50, 3)).astype(np.float32), alone), np.zeros(50, bool), np.array([0])).all()


def test_equal_scores_go_to_smaller_ids(spark):
    rows = [(i, [1.0, float(i) + 0.1]) for i in range(400)] + [(1000, [3.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest.nearest_neighbours(frame, frame.filter("vec_id = 1000"), k=150).orderBy("rank").collect()
    assert len(found) == 150 and {r["score"] for r in found} == {3.0}
    few = nearest.nearest_neighbours(frame.filter("vec_id < 150 or vec_id = 1000"), frame.filter("vec_id = 1000"), k=20).orderBy("rank").collect()
    assert [r["vec_id"] for r in few] == list(range(20))


def test_odd_conversations(spark):
    """Null ids, turns and roles, repeated rows, a cycle, other columns, and no rows."""
    rows = [(None, None, "user", "b"), (None, 1, None, "a"), (1, 1, "assistant", "x"), (1, 1, "assistant", "x"), (1, None, "user", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("total", F.lit("x")).withColumn("leaf", F.lit("x"))
    found = {r["tree"]: [tuple(t) for t in r["turns"]] for r in chat.read_back(chat.format_trees(chat.linear_replies(frame))).collect()}
    assert found == {None: [("user", "b"), ("", "a")], 1: [("user", ""), ("assistant", "x"), ("assistant", "x")]}
    assert chat.format_trees(chat.linear_replies(frame.filter("false"))).count() == 0
    circle = [(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0), (1, 3, 2, "user", "c", 0.0), (2, 1, None, "user", "d", None)]
    circle = spark.createDataFrame(circle, "tree long, node long, parent long, role string, text string, score double")
    assert [r["tree"] for r in chat.format_trees(circle).collect()] == [2]


def test_deep_and_wide_trees(spark):
    """A tree of 200 levels with a branch at each: the best three paths, as a walk finds them."""
    rng = random.Random(11)
    parent = {1: None} | {i: rng.randrange(max(1, i - 4), i) for i in range(2, 400)}
    score = {i: rng.random() - 0.5 for i in parent}
    rows = [(7, i, p, "user", str(i), score[i]) for i, p in parent.items()]
    frame = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    ways = {}
    for leaf in set(parent) - set(parent.values()):
        way = [leaf]
        while parent[way[-1]]:
            way.append(parent[way[-1]])
        ways[leaf] = way[::-1]
    best = sorted(ways, key=lambda leaf: -sum(score[i] for i in ways[leaf]))[:3]
    found = {r["leaf"]: [int(t["text"]) for t in r["turns"]] for r in chat.read_back(chat.format_trees(frame, per_tree=3)).collect()}
    assert found == {leaf: ways[leaf] for leaf in best}


def test_pipeline_on_odd_rows(spark, edges, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows, further columns; and an empty table."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 1000)
    none = spark.createDataFrame([(None, "the same words of a lost row", None, None, None), (None, None, None, None, None)], docs.schema)
    clash = [c for c in edges.columns if c not in docs.columns]
    every = edges.unionByName(docs.unionByName(none), allowMissingColumns=True).select(*docs.columns, *clash)
    for rows in (every, every.filter("false")):
        before = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, before, "").cache()
            assert after.columns == before.columns, name
            before = after
        last = corpus_pipeline.STAGES[-1][1](spark, before, "")
        assert last.count() == before.count()
    ids = {r["doc_id"] for r in before.collect()}
    assert ids == set()


def test_pipeline(spark):
    import corpus_pipeline
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = docs
        docs = stage(spark, before, SF).cache()
        assert docs.columns == before.columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(corpus_pipeline.STAGES) == 5
    first = {}
    for i, t in kept["language_id"].items():
        key = t.translate(brute.UPPER)
        first[key] = max(first.get(key, i), i)
    assert set(kept["exact_dedup"]) == set(first.values())
    groups = brute.components(kept["exact_dedup"], 5)
    assert set(kept["near_dedup"]) == set(groups.values())
    path = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    expected = sorted((r["doc_id"], hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()) for r in docs.collect() for ids in [library.encode(r["text"], add_special_tokens=False).ids])
    found = sorted((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert found == expected


def test_a_text_of_very_many_matches_takes_no_square_of_them(spark):
    import time

    rng = random.Random(5)
    text = " ".join(f"{rng.randrange(10, 99)}" + rng.choice(["x", " a@b.co", " é 1.2.3.4", " +1 234 567 890"]) for _ in range(30_000))
    frame = spark.createDataFrame([(text,)], "t string").withColumn("s", private_data.base_spans(F.col("t"))).withColumn("m", private_data.masked(F.col("t"), F.col("s")))
    frame.limit(0).collect()
    began = time.time()
    row = frame.collect()[0]
    assert time.time() - began < 30  # the square of it is many minutes
    assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in row["s"]] == brute.base_spans(text)
    letters = list(text)
    for s in row["s"]:
        letters[s["start"] : s["end"]] = " " * (s["end"] - s["start"])
    assert "".join(letters) == row["m"]
