"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation, components."""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, join_salted, map_texts, small, staged, text_slices
from .components import connected_components

#: Bands and hashes in each: a pair of similarity 0.8 shares no band with probability (1 - 0.8**6)**36 < 2e-5.
BANDS, BAND_HASHES = 36, 6
HASHES = BANDS * BAND_HASHES
#: Hashes compared at a time, and the posterior probability below which a pair is given up.
BATCH, MISS = 24, 1e-5
#: Rows of a bucket that are compared with each other at once.
BLOCK = 2048
#: A block also holds about so many shingles at most (8 bytes each), but one text at least.
BLOCK_SHINGLES = 2_000_000
#: Pairs in one row of a group.
PIECE = 250_000
#: Rows of small buckets that go to one call.
GROUP_ROWS = 20_000
#: Distinct words whose hash a worker remembers.
REMEMBERED = 200_000


class _WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


@lru_cache(maxsize=1)
def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, words: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; A-Z lower-cased, split at ASCII white space.

    With fewer words, the whole sequence is one shingle; without a word there is none.
    """
    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_word_hashes().__getitem__, found), np.uint64, len(found))
    n = max(len(h) - words + 1, 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(words, len(h))):
        out = _mixed(out + h[i : i + n] + np.uint64(i + 1))
    return np.unique(out if len(h) >= words else out + np.uint64(len(h)))


def signature(hashes: np.ndarray) -> np.ndarray:
    a, b = _functions()
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(least, (x[at : at + 1024, None] * a + b).min(0), out=least)
    return least


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_key, sig (16 bits a hash), bands and their bytes."""

    def sign(texts):
        out = {"n_shingles": [], "set_key": [], "sig": [], "bands": [], "band_bytes": []}
        salt = _mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
        for text in texts:
            own = shingle_set(text, words)
            out["n_shingles"].append(len(own))
            if not len(own):
                for k in ("set_key", "sig", "bands", "band_bytes"):
                    out[k].append(None)
                continue
            sig = signature(own)
            key = salt
            for part in sig.reshape(BANDS, BAND_HASHES).T:
                key = _mixed(key + part)
            out["set_key"].append(xxhash.xxh3_128_hexdigest(own.tobytes()))
            out["sig"].append(sig.astype(np.uint16).tobytes())
            out["bands"].append(key.view(np.int64))
            out["band_bytes"].append(key.tobytes())
        return out

    return map_texts(docs, "doc_id", "text", "n_shingles long, set_key string, sig binary, bands array<long>, band_bytes binary", sign)


@lru_cache(maxsize=8)
def fewest_matches(percent: int, miss: float) -> np.ndarray:
    """By hashes compared: the fewest matches with which the similarity may still reach percent with probability miss.

    With a uniform prior, after m matches of n the posterior is Beta(m + 1, n - m + 1), whose upper tail beyond t
    is the probability that a binomial of n + 1 trials at t has at most m successes.
    """
    t, out = percent / 100, []
    for n in range(0, HASHES + 1, BATCH):
        tail = np.cumsum([comb(n + 1, k) * t**k * (1 - t) ** (n + 1 - k) for k in range(n + 2)])
        out.append(int(np.searchsorted(tail, miss)))
    return np.array(out)


def bayes_survivors(x: np.ndarray, y: np.ndarray, percent: int, miss: float = MISS) -> np.ndarray:
    """Which rows of two signature arrays stay after every batch of hashes."""
    least = fewest_matches(percent, miss)
    alive, matches = np.arange(len(x)), np.zeros(len(x), int)
    for step in range(1, HASHES // BATCH + 1):
        cut = slice((step - 1) * BATCH, step * BATCH)
        matches = matches + (x[alive, cut] == y[alive, cut]).sum(1)
        on = matches >= least[step]
        alive, matches = alive[on], matches[on]
        if not len(alive):
            break
    return alive


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, HASHES)


def _met(ends: DataFrame, pairs: DataFrame) -> DataFrame:
    """The first ends of pairs with met: how many pairs each begins. A center begins as many as its buckets have members."""
    return ends.join(pairs.groupBy("a").agg(F.count("*").alias("met")), "a")


def _pruned(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sequential verification doesn't give up."""
    import pyarrow as pa

    x = _met(reps.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a"), F.col("n_shingles").alias("n_a")), pairs)
    y = reps.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b"), F.col("n_shingles").alias("n_b"))
    sized = join_salted(pairs, x, "a", "met", "b").join(y, "b").filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)

    def batches(source):
        for batch in source:
            if len(batch):
                on = bayes_survivors(_signatures(batch.column(2).to_pylist()), _signatures(batch.column(3).to_pylist()), percent)
                yield batch.select(["a", "b"]).take(pa.array(on))

    return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(batches, sized.select("a", "b").schema)


def _sets(ids: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """doc_id and hashes of the documents asked for. Texts go through a shuffle only if the ids are too many to broadcast."""
    texts = docs.join(small(staged(ids.distinct(), "near-ids")), "doc_id", "left_semi")
    sets = map_texts(texts, "doc_id", "text", "hashes binary", lambda rows: {"hashes": [shingle_set(t, words).tobytes() for t in rows]})
    return staged(sets, "near-sets").dropDuplicates(["doc_id"])


def _linked(x: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """For each of the others whether it and x have 100 * intersection >= percent * union; sorted distinct hashes."""
    sizes = np.array([len(y) for y in others])
    every = np.concatenate(others)
    shared = np.add.reduceat(x[np.minimum(np.searchsorted(x, every), len(x) - 1)] == every, np.cumsum(sizes) - sizes, dtype=np.int64)
    return 100 * shared >= percent * (len(x) + sizes - shared)


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    import pyarrow as pa

    sets = _sets(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))), docs, words)
    firsts = staged(_met(sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("set_a")), pairs), "near-firsts")
    both = join_salted(pairs, firsts, "a", "met", "b").join(sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("set_b")), "b")

    def batches(source):
        for batch in source:
            for part in text_slices(batch, 2):
                on = []
                for i, (x, y) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                    if _linked(np.frombuffer(x, np.uint64), [np.frombuffer(y, np.uint64)], percent)[0]:
                        on.append(i)
                yield part.select(["a", "b"]).take(pa.array(on, pa.int64()))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(batches, pairs.select("a", "b").schema)


def _others(labelled: DataFrame, reps: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Confirmed links between members of a bucket that don't hang together yet: labelled has key, band, n, n_shingles, center, rep, label.

    Pairs of one label could not change the result, so only the members outside of their bucket's commonest label (minor ones) meet the
    others: an unsettled member costs one row per member, not a row per pair. Both sides are dealt by hash into blocks of so many rows and so many
    shingles, and each pair of blocks is a group of its own, so no task holds a whole bucket, nor many very long texts. A pair is compared in the first band that it shares only. Pairs
    are never rows: a group hands on the members of its surviving pairs, once each, and the list of pairs with one of them; these
    meet their full sets in a second grouping.
    """
    import pandas as pd

    piece = PIECE
    borne = labelled.groupBy("band", "key", "label").agg(F.count("*").alias("many"), F.first("n").alias("n"), F.sum("n_shingles").alias("load"))
    tops = borne.groupBy("band", "key").agg(F.max(F.struct("many", "label", "load")).alias("top"), F.first("n").alias("n"), F.sum("load").alias("load")).filter("top.many < n")
    blocks = lambda rows, load: F.greatest(F.ceil(rows / BLOCK), F.ceil(load / BLOCK_SHINGLES)).cast("int")
    tall = blocks(F.col("n") - F.col("top.many"), F.col("load") - F.col("top.load"))
    tops = staged(tops.select("band", "key", F.col("top.label").alias("top"), tall.alias("tall"), blocks(F.col("n"), F.col("load")).alias("wide"), F.col("n").alias("met")), "near-tops")
    members = staged(join_counted(labelled, tops, ["band", "key"], "met"), "near-open")
    groups = max(1, members.count() // GROUP_ROWS)
    in_block = lambda salt, of: F.pmod(F.xxhash64(F.lit(salt), "rep"), of).cast("int")
    first = members.filter("label != top").select("*", in_block(1, F.col("tall")).alias("x"), F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("y"), F.lit(True).alias("minor_side"))
    second = members.select("*", F.explode(F.sequence(F.lit(0), F.col("tall") - 1)).alias("x"), in_block(2, F.col("wide")).alias("y"), F.lit(False).alias("minor_side"))
    dealt = first.unionByName(second)
    whole = F.col("wide") == 1
    group = F.when(whole, F.pmod(F.xxhash64("key"), F.lit(groups))).otherwise(F.xxhash64("key", "x", "y"))
    part = F.xxhash64("key", "band", "x", "y")
    dealt = dealt.select(whole.alias("whole"), group.alias("group"), part.alias("part"), "band", "rep", "label", (F.col("label") != F.col("top")).alias("is_minor"), (F.col("rep") == F.col("center")).alias("tried"), "minor_side")
    signed = dealt.join(reps.select(F.col("doc_id").alias("rep"), "sig", "band_bytes", "n_shingles"), "rep")

    def compare(pdf):
        out = []
        for part, g in pdf.groupby("part", sort=False):
            sig, bands = _signatures(g["sig"]), np.frombuffer(b"".join(g["band_bytes"]), np.uint64).reshape(-1, BANDS)
            label, size, rep, tried, minor = (g[c].to_numpy() for c in ("label", "n_shingles", "rep", "tried", "is_minor"))
            side = g["minor_side"].to_numpy()
            rows, cols, band, found = np.flatnonzero(side), np.flatnonzero(~side), g["band"].iloc[0], []
            for at in range(0, len(rows), 256):
                r = rows[at : at + 256]
                open_ = (label[r][:, None] != label[cols][None, :]) & ~tried[r][:, None] & ~tried[cols][None, :]
                open_ &= 100 * np.minimum(size[r][:, None], size[cols][None, :]) >= percent * np.maximum(size[r][:, None], size[cols][None, :])
                open_ &= ~minor[cols][None, :] | (rep[r][:, None] < rep[cols][None, :])  # two minor ones meet twice
                x, y = np.nonzero(open_)
                for cut in range(0, len(x), 50_000):
                    px, py = r[x[cut : cut + 50_000]], cols[y[cut : cut + 50_000]]
                    on = bayes_survivors(sig[px], sig[py], percent)
                    on = on[(bands[px[on]] == bands[py[on]]).argmax(1) == band] if len(on) else on
                    found.append(np.stack([rep[px[on]], rep[py[on]]], 1))
            pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
            used = np.unique(pairs)
            if len(used):
                listed = np.searchsorted(used, pairs).astype(np.int32)
                pieces = [listed[i : i + piece].tobytes() for i in range(0, len(listed), piece)]  # fewer than members
                out.append(pd.DataFrame({"part": part, "place": np.arange(len(used)), "rep": used, "pairs": pieces + [None] * (len(used) - len(pieces))}))
        return pd.concat(out) if out else pd.DataFrame({"part": [], "place": [], "rep": [], "pairs": []})

    kept = staged(signed.groupBy("whole", "group").applyInPandas(compare, "part long, place int, rep long, pairs binary"), "near-others")
    sets = _sets(kept.select(F.col("rep").alias("doc_id")), docs, words)

    def verify(pdf):
        pdf = pdf.sort_values("place")
        rep, sets = pdf["rep"].to_numpy(), [np.frombuffer(h, np.uint64) for h in pdf["hashes"]]
        pairs = np.frombuffer(b"".join(pdf["pairs"].dropna()), np.int32).reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        a, b = [], []
        for x, start, many in zip(*np.unique(pairs[:, 0], return_index=True, return_counts=True)):
            ys = pairs[start : start + many, 1]
            ys = ys[_linked(sets[x], [sets[y] for y in ys], percent)]
            a.append(np.minimum(rep[x], rep[ys]))
            b.append(np.maximum(rep[x], rep[ys]))
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    full = kept.join(sets.select(F.col("doc_id").alias("rep"), "hashes"), "rep")
    return full.groupBy("part").applyInPandas(verify, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents linked by 100 * intersection >= percent * union of their shingle sets.

    Documents with equal sets collapse to one representative first, so copies are never paired. Representatives
    that share a band are candidates: first each with its bucket's smallest, verified by batches of signature hashes (a
    pair is given up once the posterior probability of reaching the threshold is below MISS), then on the full
    sets of 64-bit hashes. Then the members of a bucket that the links found so far don't hold together are compared
    block by block, verified the same way; pairs already in one component could not change the result and
    are skipped. Components by joins. No candidate or partner is capped. Classes and buckets that very many rows are in
    meet their rows by broadcast.

    Ids are long; a row that repeats id and text repeats its result. A row without an id takes part in nothing: it gets its
    n_shingles, no component_id, and is kept. Null, empty and wordless texts have an empty set, are linked with nothing and kept. Texts
    shorter than a shingle are one shingle. Of documents in one component the smallest id is kept. Other columns are ignored; an
    empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    signed = staged(_signed(docs, words), "near-signed")
    sets = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = sets.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = staged(classes, "near-classes")
    firsts = classes.select(F.col("rep").alias("doc_id"), "set_key")
    reps = staged(sets.join(firsts, ["doc_id", "set_key"], "left_semi").dropDuplicates(["doc_id"]), "near-reps")
    banded = staged(reps.select(F.col("doc_id").alias("rep"), "n_shingles", F.posexplode("bands").alias("band", "key")), "near-banded")
    shared = staged(banded.groupBy("band", "key").agg(F.min("rep").alias("center"), F.count("*").alias("n")).filter("n > 1"), "near-shared")
    buckets = staged(join_counted(banded, shared, ["band", "key"], "n"), "near-buckets")

    first = staged(buckets.filter("rep != center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct(), "near-pairs")
    links = staged(_confirmed(staged(_pruned(first, reps, percent), "near-survivors"), docs, words, percent), "near-links")

    found = connected_components(links)
    labelled = staged(buckets.filter("n > 2").join(found, F.col("rep") == F.col("node"), "left").select("key", "band", "n", "n_shingles", "center", "rep", F.coalesce("component", "rep").alias("label")), "near-labelled")
    second = staged(_others(labelled, reps, docs, words, percent), "near-links")
    found = connected_components(links.unionByName(second))

    copied = classes.filter("copies > 1").join(found, F.col("rep") == F.col("node"), "left").select("set_key", "rep", "component", "copies")
    members = signed.filter("doc_id is not null").select("doc_id", "n_shingles", "set_key")
    named = join_counted(members.filter("set_key is not null"), staged(copied, "near-copied"), ["set_key"], "copies", "left").drop("copies")
    named = named.unionByName(members.filter("set_key is null"), allowMissingColumns=True)
    out = named.join(found.select(F.col("node").alias("doc_id"), F.col("component").alias("own")), "doc_id", "left")
    component = F.coalesce("component", "rep", "own", "doc_id")
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
    none = F.lit(None).cast(docs.schema["doc_id"].dataType)
    return out.unionByName(signed.filter("doc_id is null").select("doc_id", "n_shingles", none.alias("component_id"), F.lit(True).alias("kept")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay (one document of each group), with all their columns; rows without an id all stay."""
    dropped = near_duplicates(docs, id_col, text_col, words, percent).filter(~F.col("kept")).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(dropped, id_col, "left_anti").select(docs.columns)
