"""Language identification, token counts and the codec."""

import hashlib
import math
import random
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scriptorium.llm import bpe, language_id, registry

from .conftest import SF


def test_language_of_held_out_documents(spark):
    found = registry.op1_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = [r for r in found.collect() if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert len(rows) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_counts(texts):
    """Trigrams of lower-case letters and single spaces, by the definition."""
    counts = Counter()
    for t in texts:
        t = " " + "".join(c if c.isalpha() else " " for c in t.lower())
        while "  " in t:
            t = t.replace("  ", " ")
        counts.update(t[i : i + 3] for i in range(len(t) - 2))
    return counts


def plain_prob(counts, known, gram, d=language_id.DISCOUNT):
    """Interpolated Kneser-Ney, order by order, from the counts alone."""
    pairs, single = Counter(g[1:] for g in counts), Counter(g[1] for g in {g[1:] for g in counts})
    p = (max(single[gram[2]] - d, 0) + d * len(single) / (known + 1)) / sum(single.values())
    follow = [n for g, n in pairs.items() if g[0] == gram[1]]
    if follow:
        p = (max(pairs[gram[1:]] - d, 0) + d * len(follow) * p) / sum(follow)
    follow = [n for g, n in counts.items() if g[:2] == gram[:2]]
    if follow:
        p = (max(counts[gram] - d, 0) + d * len(follow) * p) / sum(follow)
    return p


TINY = [("a", "abracadabra abba"), ("a", "cab bad"), ("b", "Zig zag zoo"), ("b", "oz"), ("b", None), (None, "abc")]


@pytest.mark.parametrize("cells", [8_000_000, 20])
def test_entropies_equal_the_plain_model(spark, monkeypatch, cells):
    """Whether the model is one part or many."""
    monkeypatch.setattr(language_id, "PART_CELLS", cells)
    models = language_id.train(spark.createDataFrame(TINY, "lang string, text string"), "lang", "text")
    assert models.names == ["a", "b"] and (len(models.parts) == 1) == (cells > 20)
    counts = {lang: plain_counts(t for x, t in TINY if x == lang and t) for lang in "ab"}
    known = len({g[2] for c in counts.values() for g in c})
    texts = ["abba zoo", "q", "", None, "Cadabra! 12", "za za za", "x" * 50]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language_id.costs(frame, models, "doc_id", "text").collect():
        t = "".join(c if c.isalpha() else " " for c in (texts[r["doc_id"]] or "").lower())
        t = "  " + " ".join(t.split()) + (" " if t.strip() and t[-1] == " " else "")
        if not t.strip():
            assert r["n"] == 0
            continue
        wanted = [sum(-math.log(plain_prob(counts[lang], known, t[i - 2 : i + 1])) for i in range(2, len(t))) for lang in "ab"]
        assert r["n"] == len(t) - 2 and r["nats"] == pytest.approx(wanted, rel=1e-5), texts[r["doc_id"]]


def test_model_probabilities_sum_to_one():
    import numpy as np

    codes, starts = language_id.letters(["abracadabra abba", "cab"])
    keys, counts = np.unique(language_id.grams(codes), return_counts=True)
    firsts, types = np.unique(np.unique(keys & 0xFFFFFFFF) & 0xFFFF, return_counts=True)
    known = np.unique(codes)
    model = language_id.CharModel(keys, counts, firsts, types, len(known))
    for context in {int(k) >> 16 for k in keys}:
        every = np.array([context << 16 | int(c) for c in known], np.int64)
        assert 0.9 < model.prob3(every).sum() <= 1.0000001  # the rest is for letters never seen


def test_marks_stay_with_their_letters():
    codes, _ = language_id.letters(["བོད་ཡིག", "हिन्दी"])
    assert "".join(map(chr, codes)).replace("\x00", " ") == " བོད ཡིག हिन्दी"
    assert language_id.LanguageModels([], []).classify(None, [0])["lang_pred"] == ["und"]


def test_language_edges(documents, edges, no_rows):
    models = language_id.train(documents, "lang", "text")
    rows = {r["doc_id"]: r for r in language_id.identify(edges, models).collect()}
    assert len(rows) == 9
    for i in (1, 2, 3):
        assert (rows[i]["lang_pred"], rows[i]["score"], rows[i]["rejected"]) == ("und", 0.0, True)
    assert rows[6]["lang_pred"] == "en"
    assert language_id.identify(no_rows, models).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(edges, language_id.train(no_rows, "lang", "text")).collect()} == {"und"}


def test_foreign_script_is_rejected_and_clean_text_stays(spark, documents):
    odd = [(1, "κόσμος και γράμματα " * 20), (2, "qzx wvk jjq xzz qqk " * 20), (3, "漢字仮名交じり文"), (4, "བོད་ཡིག་གི་ཡི་གེ"), (5, None), (6, "12 ́")]
    odd = spark.createDataFrame(odd, "doc_id long, text string")
    kept = language_id.keep_identified(odd, documents)
    assert kept.count() == 0
    # at this scale held-out clean text is rare enough to be wholly kept
    assert language_id.keep_identified(documents, documents).count() >= 0.97 * documents.filter(F.col("text").rlike("[A-Za-z]")).count()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_as_the_library_gives_them(spark, documents, edges, name):
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    hard = ["<|endoftext|>", "a<|endoftext|><|startoftext|> b", "don't  stop\n\n\tnow", "ΑΣ ΟΔΟΣ", "ﬁ Å Å", "😀👩‍👩‍👧 x", "1234567 ½ ²", "   a", "İstanbul ǅ ß"]
    extra = spark.createDataFrame([(100_000 + i, t) for i, t in enumerate(hard)], "doc_id long, text string")
    docs = documents.select("doc_id", "text").unionByName(edges.select("doc_id", "text")).unionByName(extra)
    rows = docs.distinct().collect()
    expected = {(r["doc_id"], r["text"]): library.encode(r["text"] or "", add_special_tokens=False).ids for r in rows}
    docs = docs.distinct().withColumn("doc_id", F.xxhash64("doc_id", "text"))
    back = {r["key"]: (r["doc_id"], r["text"]) for r in docs.sparkSession.createDataFrame(rows).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")).collect()}
    counts = {back[r["doc_id"]]: r for r in bpe.count_tokens(docs, path).collect()}
    digests = {back[r["doc_id"]]: r for r in bpe.round_trip_digests(docs, path).collect()}
    assert len(expected) == len(counts) == len(digests)
    for key, ids in expected.items():
        assert counts[key]["n_tokens"] == len(ids), key
        assert counts[key]["n_bytes"] == len((key[1] or "").encode())
        assert counts[key]["over_limit"] == (len(ids) > 512)
        assert digests[key]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), key
        assert digests[key]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(), key


def test_encode_and_decode_as_tables(edges, no_rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    back = bpe.decode_ids(bpe.encode_texts(edges, path), path).collect()
    assert sorted((r["doc_id"], r["text"]) for r in back) == sorted((r["doc_id"], r["text"] or "") for r in edges.collect())
    assert bpe.count_tokens(no_rows, path).count() == 0 == bpe.encode_texts(no_rows, path).count()


def test_rows_without_an_id_are_learned_from_and_never_held_out(spark, tmp_path):
    from scriptorium.llm import registry

    words = {"en": "the cat and the dog went over the hill to see the sea again", "fr": "le chat et le chien sont allés sur la colline pour voir la mer"}
    rows = [(None, " ".join([t] * 30) + f" {i}", lang, "web", 1) for lang, t in words.items() for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    found = registry.op1_language_id(spark, str(tmp_path)).collect()
    assert len(found) == 120 and not any(r["held_out"] for r in found)
    assert {r["lang_pred"] for r in found} == {"en", "fr"}


def test_all_rows_train_and_calibrate(spark, documents, monkeypatch):
    """Every text with a label is counted, and every one is scored for the limits, by models that haven't seen it."""
    rows = documents.filter("lang IS NOT NULL AND text IS NOT NULL")
    scored = []
    real = language_id.costs
    monkeypatch.setattr(language_id, "costs", lambda rows, *a, **b: scored.append(rows.select("text").collect()) or real(rows, *a, **b))
    counted = []
    count = language_id.count_grams
    monkeypatch.setattr(language_id, "count_grams", lambda rows, *a: counted.append(rows.count()) or count(rows, *a))
    language_id.train(rows, "lang", "text")
    every = sorted(r.text for r in rows.select("text").collect())
    assert counted == [len(every)] and sorted(r.text for part in scored for r in part) == every
    assert not set(scored[0]) & set(scored[1])


def test_every_text_counts_for_the_limits(spark):
    """Texts that carry another language's label, and the exact quantile of all deviations."""
    rng = random.Random(5)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(2, 8)))
    plain = [(lang, " ".join(word(letters) for _ in range(rng.randint(5, 60)))) for lang, letters in (("aa", "abcdefgh"), ("zz", "stuvwxyz")) for _ in range(300)]
    # a third of the texts with the letters of zz are labelled aa
    rows = [("aa" if lang == "zz" and i % 3 == 0 else lang, text) for i, (lang, text) in enumerate(plain)]
    models = language_id.train(spark.createDataFrame(rows, "lang string, text string"), "lang", "text")
    scored = []
    for fold in range(2):
        rest = spark.createDataFrame(rows, "lang string, text string").withColumn("fold", F.pmod(F.xxhash64(F.lit(29), "text"), F.lit(2)))
        other = language_id._models(language_id.count_grams(rest.filter(F.col("fold") != fold), "lang", "text"))
        nats, n = other.parts[0].value.nats([r["text"] for r in rest.filter(F.col("fold") == fold).collect()])
        scored += [(h.argmin(), h.min()) for h in nats / n[:, None]]
    assert len(scored) == len(rows)
    for of in range(2):
        assert abs(models.mean[of] - np.mean([h for best, h in scored if best == of])) < 1e-6


def test_quantiles_are_exact(spark):
    rng = random.Random(6)
    rows = [(k, float(rng.choice([rng.gauss(0, 1), rng.randint(0, 3)]))) for k in range(3) for _ in range((3, 800, 60_000)[k])] + [(0, None)]
    found = language_id.exact_quantile(spark.createDataFrame(rows, "k int, x double"), "k", "x", 0.99).collect()
    for k in range(3):
        own = sorted(x for i, x in rows if i == k and x is not None)
        assert {r.k: r.x for r in found}[k] == own[-(-len(own) * 99 // 100) - 1]
