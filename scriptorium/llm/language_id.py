"""Language identification: interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

import copy
import unicodedata
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import bounded_batches, small, staged, text_slices

#: Most languages; more raise an error.
MAX_LANGUAGES = 512
#: Numbers (trigrams times languages) of a part of the model. Parts are sent out and scored one after the other, so
#: that a model of any size needs no more memory than this (or than the trigrams around one letter) at once.
PART_CELLS = 8_000_000
#: Parts of the texts, by their hashes: each calibrates models that learned from the others.
FOLDS = 2
#: Texts that a language needs for limits of its own.
LEAST_ROWS = 100
#: A text is rejected beyond REJECT_SLACK times this quantile of the calibration texts' deviations (in standard errors, at least LEAST_DEVIATION).
REJECT_QUANTILE, REJECT_SLACK, LEAST_DEVIATION = 0.99, 2.0, 2.0
SHARPNESS = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
DISCOUNT = 0.75
SPACE = 32
#: Costs (characters times languages) that are held at once.
SCORED_CELLS = 2_000_000


@lru_cache(maxsize=1)
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Each 16-bit code point as its lower-case letter or mark, anything else as a space; and which codes are letters."""
    out, is_letter = np.full(0x10000, SPACE, np.uint16), np.zeros(0x10000, bool)
    is_letter[0xE000:0xF800] = True  # where letters beyond 16 bits go
    for c in range(0x10000):
        x = chr(c)
        kind = unicodedata.category(x)[0]
        if kind in "LM":
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 and ord(low) < 0x10000 else c
            is_letter[out[c]] |= kind == "L"
    return out, is_letter


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """One array of 16-bit codes for all texts, with the start of each: a space, letters with their marks, and single spaces between.

    Letters beyond 16 bits fold into the private-use area. Nulls and texts without a letter become one space.
    """
    joined = "\x00".join(["", *((t or "").replace("\x00", " ") for t in texts)])
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    codes = _classes()[0][np.minimum(points, 0xFFFF)]
    for p in np.unique(points[points > 0xFFFF]):
        codes[points == p] = 0xE000 + int(p) % 0x1800 if unicodedata.category(chr(p))[0] in "LM" else SPACE
    mark = points == 0
    keep = (codes != SPACE) | mark
    keep[1:] |= codes[:-1] != SPACE
    starts = np.flatnonzero(mark[keep])
    return codes[keep], starts


def grams(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes (here exact: 16 bits a letter) of the trigram that ends at each place from the third on."""
    wide = codes.astype(np.int64)
    return wide[:-2] << 32 | wide[1:-1] << 16 | wide[2:]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, n = np.concatenate(keys), np.concatenate(counts)
    found, at = np.unique(every, return_inverse=True)
    return found, np.bincount(at, weights=n, minlength=len(found)).astype(np.int64)


def count_grams(rows: DataFrame, label_col: str, text_col: str) -> DataFrame:
    """lang, gram, n over all rows. Each task sums what it read before the shuffle."""
    import pyarrow as pa

    def summed(found):
        for lang, (keys, counts) in found.items():
            if keys:
                k, n = _merged(keys, counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k), pa.array(n)], names=["lang", "gram", "n"])

    def batches(source):
        found: dict[str, tuple[list, list]] = {}
        for batch in source:
            for part in text_slices(batch, 1):
                by: dict[str, list] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    by.setdefault(lang, []).append(text)
                for lang, texts in by.items():
                    codes, starts = letters(texts)
                    if len(codes) < 3:
                        continue
                    key = grams(codes)
                    inside = np.ones(len(key), bool)  # a trigram doesn't reach into the next text
                    for back in (1, 2):
                        at = starts - back
                        inside[at[(at >= 0) & (at < len(key))]] = False
                    k, n = np.unique(key[inside], return_counts=True)
                    keys, counts = found.setdefault(lang, ([], []))
                    keys.append(k)
                    counts.append(n)
                    if len(keys) > 16:
                        k, n = _merged(keys, counts)
                        found[lang] = ([k], [n])
            if sum(len(k) for keys, _ in found.values() for k in keys) > PART_CELLS:  # hand on and begin anew
                yield from summed(found)
                found = {}
        yield from summed(found)

    parts = rows.select(label_col, text_col).mapInArrow(batches, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class CharModel:
    """Interpolated Kneser-Ney trigrams of one language: sorted hash arrays per order, with their probabilities.

    keys, counts: trigrams, all those around some middle letters. firsts, types: how many different letters come before each letter, over the
    whole language. A trigram, both its pairs and the context of the second share the middle letter, so such a part is exact by itself.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, firsts: np.ndarray, types: np.ndarray, letters_known: int):
        order = np.argsort(keys)
        self.keys3, n3 = keys[order], counts[order].astype(float)
        self.base = 1.0 / (letters_known + 1)
        order = np.argsort(firsts)
        self.keys1, types1 = firsts[order], types[order]
        total1 = types1.sum()
        self.gamma0 = DISCOUNT * len(self.keys1) / max(total1, 1)
        self.p1 = np.maximum(types1 - DISCOUNT, 0) / max(total1, 1) + self.gamma0 * self.base
        # pairs by continuation too: how many different letters come before
        self.keys2, types2 = np.unique(self.keys3 & 0xFFFFFFFF, return_counts=True)
        self.context1, at, follow = np.unique(self.keys2 >> 16, return_inverse=True, return_counts=True)
        sum2 = np.bincount(at, weights=types2)
        self.gamma1 = DISCOUNT * follow / sum2
        self.p2 = np.maximum(types2 - DISCOUNT, 0) / sum2[at] + self.gamma1[at] * self.prob1(self.keys2 & 0xFFFF)
        self.context2, at, follow = np.unique(self.keys3 >> 16, return_inverse=True, return_counts=True)
        sum3 = np.bincount(at, weights=n3)
        self.gamma2 = DISCOUNT * follow / sum3
        self.p3 = np.maximum(n3 - DISCOUNT, 0) / sum3[at] + self.gamma2[at] * self.prob2(self.keys3 & 0xFFFFFFFF)

    def prob1(self, keys):
        return find(self.keys1, self.p1, keys, self.gamma0 * self.base)

    def prob2(self, keys):
        p = find(self.keys2, self.p2, keys, -1.0)
        low = find(self.context1, self.gamma1, keys >> 16, 1.0) * self.prob1(keys & 0xFFFF)
        return np.where(p < 0, low, p)

    def prob3(self, keys):
        p = find(self.keys3, self.p3, keys, -1.0)
        out = p < 0
        p[out] = find(self.context2, self.gamma2, keys[out] >> 16, 1.0) * self.prob2(keys[out] & 0xFFFFFFFF)
        return p


def find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    """values at the wanted keys of a sorted hash array."""
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


class ModelPart:
    """All languages' models around the middle letters low to high, joined in one sorted hash array for scoring."""

    def __init__(self, low: int, high: int, models: list[CharModel]):
        self.low, self.high, self.models = low, high, models
        self.keys = np.unique(np.concatenate([m.keys3 for m in models]))
        self.logs = self._costs(self.keys)

    def _costs(self, keys):
        return np.stack([-np.log(m.prob3(keys)) for m in self.models], 1).astype(np.float32)

    def nats(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Nats that this part's characters of each text (rows) cost under each language (columns), and the characters of the whole text.

        Every character but the first space is predicted from the two before it, the start counting as a space; it belongs to the part
        of the letter before it. Texts without a letter have no characters.
        """
        codes, starts = letters(texts)
        wide = codes.astype(np.int64)
        one = np.concatenate([[SPACE], wide[:-1]])
        two = np.concatenate([[SPACE], one[:-1]])
        one[starts] = two[starts] = SPACE
        after = starts + 1
        two[after[after < len(two)]] = SPACE
        place = np.zeros(len(codes), np.int32)
        place[starts] = 1
        place = np.cumsum(place) - 1
        mine = (one >= self.low) & (one <= self.high)
        mine[starts] = False
        at = np.flatnonzero(mine)
        out = np.zeros((len(texts), len(self.models)))
        step = max(1, SCORED_CELLS // len(self.models))
        for cut in range(0, len(at), step):
            own = at[cut : cut + step]
            key = two[own] << 32 | one[own] << 16 | wide[own]
            found = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            known = self.keys[found] == key if len(self.keys) else np.zeros(len(key), bool)
            cost = np.empty((len(key), len(self.models)), np.float32)
            cost[known] = self.logs[found[known]]
            if not known.all():
                rare, back = np.unique(key[~known], return_inverse=True)
                cost[~known] = self._costs(rare)[back]
            of = place[own]
            first = np.flatnonzero(np.diff(of, prepend=-1))
            out[of[first]] += np.add.reduceat(cost, first, axis=0, dtype=np.float64)
        n = np.diff(np.append(starts, len(codes))) - 1
        has = np.add.reduceat(_classes()[1][codes].astype(np.int64), starts) > 0
        return out, np.where(has, n, 0)


class LanguageModels:
    """The models of all languages in parts, and what calibration found: by language, the mean cross-entropy of its texts, the variance
    between texts (spread) and per character (noise), and the largest deviation that isn't rejected."""

    def __init__(self, names: list[str], parts: list):
        self.names, self.parts = names, parts  # parts: broadcasts of ModelPart
        many = len(names)
        self.mean, self.spread, self.noise, self.most = np.zeros(many), np.ones(many), np.zeros(many), np.full(many, np.inf)
        self.sharpness = SHARPNESS[0]

    def without_parts(self) -> LanguageModels:
        """What classify needs."""
        out = copy.copy(self)
        out.parts = []
        return out

    def classify(self, nats: np.ndarray, n: np.ndarray) -> dict:
        """lang_pred, score, entropy and rejected of each text from its nats under each language and its characters."""
        many = len(n)
        if not self.names:
            return {"lang_pred": ["und"] * many, "score": [0.0] * many, "entropy": [None] * many, "rejected": [True] * many}
        h = nats / np.maximum(n, 1)[:, None]
        best, least, none = h.argmin(1), h.min(1), n == 0
        score = 1 / np.exp(-self.sharpness * (h - least[:, None])).sum(1)
        limit = self.mean[best] + self.most[best] * np.sqrt(self.spread[best] + self.noise[best] / np.maximum(n, 1))
        return {
            "lang_pred": ["und" if e else self.names[b] for b, e in zip(best, none)],
            "score": np.where(none, 0.0, score).tolist(),
            "entropy": [None if e else float(x) for x, e in zip(least, none)],
            "rejected": (none | (least > limit)).tolist(),
        }


def train(rows: DataFrame, label_col: str, text_col: str) -> LanguageModels:
    """Models from every row with a label and a text, calibrated on every such row.

    Counts cover all rows and every trigram stays. Models mustn't have seen what they are calibrated on: so each of FOLDS parts of the rows is scored by
    models from the counts of the other parts, and all those scores together give the limits. Languages of under LEAST_ROWS texts have the limits of all
    languages together. Labels and texts that are null tell nothing; copies of a text are in the same part.
    """
    bounded_batches(rows.sparkSession)
    rows = rows.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(label_col).alias("lang"), F.col(text_col).alias("text"))
    texts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(texts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    fold = F.pmod(F.xxhash64(F.lit(29), "text"), F.lit(FOLDS)).cast("int")
    counts = staged(count_grams(rows.select(F.concat(fold.cast("string"), F.lit(":"), "lang").alias("lang"), "text"), "lang", "text"), "lang-grams")
    counts = counts.select(F.substring_index("lang", ":", 1).cast("int").alias("fold"), F.expr("substring(lang, instr(lang, ':') + 1)").alias("lang"), "gram", "n")
    merged = lambda of: of.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    models = _models(merged(counts))
    if models.names:
        _calibrate(models, [(_models(merged(counts.filter(F.col("fold") != k))), rows.filter(fold == k)) for k in range(FOLDS)], texts)
    return models


def _models(counts: DataFrame) -> LanguageModels:
    """Models of the languages that the counts (lang, gram, n) know, not calibrated.

    Letters' continuation counts come from a Spark aggregation; the trigrams come to the driver part by part, each the trigrams around a range of middle
    letters (at most PART_CELLS numbers, or one letter's trigrams), and go out as one broadcast each.
    """
    spark = counts.sparkSession
    names = sorted(r[0] for r in counts.select("lang").distinct().collect())
    if not names:
        return LanguageModels([], [])
    number = F.create_map(*[F.lit(x) for i, name in enumerate(names) for x in (name, i)])
    counts = staged(counts.select(number[F.col("lang")].alias("of"), "gram", "n"), "lang-model")
    middle, last = F.shiftrightunsigned("gram", 16).bitwiseAND(0xFFFF), F.col("gram").bitwiseAND(0xFFFF)
    # at most 65,536 letters for each language
    firsts = counts.select("of", middle.alias("b"), last.alias("c")).distinct().groupBy("of", "c").agg(F.count("*").alias("types")).toPandas()
    around = sorted(tuple(r) for r in counts.select("gram").distinct().groupBy(middle.alias("b")).count().collect())
    known, parts, low, size = firsts["c"].nunique(), [], 0, 0
    cuts = []
    for b, n in around:
        if size and (size + n) * len(names) > PART_CELLS:
            cuts.append((low, b - 1))
            low, size = b, 0
        size += n
    for low, high in [*cuts, (low, 0xFFFF)]:
        table = counts.filter(middle.between(low, high)).toPandas()
        own = [table[table["of"] == i] for i in range(len(names))]
        ones = [firsts[firsts["of"] == i] for i in range(len(names))]
        models = [CharModel(g["gram"].to_numpy(np.int64), g["n"].to_numpy(np.int64), f["c"].to_numpy(np.int64), f["types"].to_numpy(np.int64), known) for g, f in zip(own, ones)]
        parts.append(spark.sparkContext.broadcast(ModelPart(low, high, models)))
    return LanguageModels(names, parts)


def costs(rows: DataFrame, models: LanguageModels, id_col: str, text_col: str, finish=None, schema: str = "nats array<double>, n long") -> DataFrame:
    """doc_id, nats (of each language), n (characters) of every row, whatever its id; or what finish(nats, n) makes of them, a list of Arrow arrays.

    With several parts of a model, the sums are staged after each. Each pass is one Python worker a task.
    """
    import pyarrow as pa

    def sums(nats, n):
        return [pa.array(list(nats), pa.list_(pa.float64())), pa.array(n, pa.int64())]

    def adder(sent, first, last, names):
        def batches(source):
            for batch in source:
                for part in text_slices(batch, 1):
                    nats, n = sent.value.nats(part.column(1).to_pylist())
                    if not first:
                        nats = nats + np.array(part.column(2).to_pylist())
                    made = (finish or sums)(nats, n) if last else [part.column(1), *sums(nats, n)]
                    yield pa.RecordBatch.from_arrays([part.column(0), *made], names=names)

        return batches

    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    for i, sent in enumerate(models.parts):
        last = i + 1 == len(models.parts)
        out = f"doc_id {kind}, {schema}" if last else f"doc_id {kind}, text string, nats array<double>, n long"
        rows = rows.mapInArrow(adder(sent, i == 0, last, StructType.fromDDL(out).fieldNames()), out)
        rows = rows if last else staged(rows, "lang-costs")
    return rows


def exact_quantile(rows: DataFrame, by: str, value: str, q: float) -> DataFrame:
    """by and value: of each group the value that ceil(q * n) of its n values don't exceed (nulls aside). rows should be cheap to read again (staged).

    A sketch only says where to look: values between two sketched quantiles are counted one by one, all below them are summed up. Should the place lie beyond
    them, the group's values all count.
    """
    sketch = F.percentile_approx(value, F.array(F.lit(max(0.0, q - 0.001)), F.lit(min(1.0, q + 0.001))), 10_000)
    rows = rows.filter(F.col(value).isNotNull())
    around = rows.groupBy(by).agg(sketch.alias("_at"), F.count("*").alias("_all")).select(by, "_at", F.greatest(F.ceil(F.col("_all") * q), F.lit(1)).alias("_place"))
    placed = rows.join(F.broadcast(around), by)
    below, upto = F.col(value) < F.col("_at")[0], F.col(value) <= F.col("_at")[1]
    sums = staged(placed.groupBy(by, "_at", "_place").agg(F.count_if(below).alias("_below"), F.count_if(upto).alias("_upto")), "quantile-counts")
    hit = (F.col("_below") < F.col("_place")) & (F.col("_place") <= F.col("_upto"))
    sums = sums.select(by, "_place", F.when(hit, F.col("_at")[0]).alias("_low"), F.when(hit, F.col("_at")[1]).alias("_high"), F.when(hit, F.col("_below")).otherwise(0).alias("_before"))
    near = rows.join(F.broadcast(sums), by).filter(F.col("_low").isNull() | F.col(value).between(F.col("_low"), F.col("_high")))
    counted = near.groupBy(by, value, "_place", "_before").agg(F.count("*").alias("_n"))
    along = F.sum("_n").over(Window.partitionBy(by).orderBy(value))
    return counted.withColumn("_reached", F.col("_before") + along).filter("_reached >= _place").groupBy(by).agg(F.min(value).alias(value))


def _calibrate(models: LanguageModels, folds: list[tuple[LanguageModels, DataFrame]], texts: dict) -> None:
    """Limits by language and the score's sharpness, from all texts of the folds, each scored by its fold's models, which haven't seen it.

    As in identify, a text counts for the language of the least cross-entropy, whatever its label. One of n characters deviates from that language's mean with
    variance spread + noise / n, fitted by least squares. Only the sharpness looks at labels; it leaves out those that the fold's models don't know.
    """
    place = {name: i for i, name in enumerate(models.names)}
    scored = None
    for other, rows in folds:
        if not other.names:
            continue
        column = F.coalesce(F.create_map(*[F.lit(x) for i, name in enumerate(other.names) for x in (name, i)])[F.col("lang")], F.lit(-1))
        of = F.array(*[F.lit(place[name]) for name in other.names])
        found = costs(rows.withColumn("column", column), other, "column", "text").filter("n > 0")
        found = found.select(F.when(F.col("doc_id") >= 0, F.col("doc_id")).alias("column"), "n", F.transform("nats", lambda x: x / F.col("n")).alias("h")).withColumn("least", F.array_min("h"))
        told = F.get(of, F.array_position("h", F.col("least")).cast("int") - 1)
        found = staged(found.select(told.alias("of"), "n", "h", F.get("h", "column").alias("own"), "least"), "lang-calibration")
        scored = found if scored is None else scored.unionByName(found)
        for sent in other.parts:
            sent.destroy()
    if scored is None:
        return
    told = scored.select("of", "n", "least")
    told = told.unionByName(told.withColumn("of", F.lit(-1)))  # all languages together, for those without texts of their own
    means = told.groupBy("of").agg(F.avg("least").alias("mean"))
    off = told.join(F.broadcast(means), "of").select("of", "mean", (F.col("least") - F.col("mean")).alias("d"), (1 / F.col("n")).alias("x"))
    fits = off.groupBy("of", "mean").agg(
        F.greatest(F.coalesce(F.regr_slope(F.col("d") * F.col("d"), F.col("x")), F.lit(0.0)), F.lit(0.0)).alias("noise"),
        F.greatest(F.coalesce(F.regr_intercept(F.col("d") * F.col("d"), F.col("x")), F.lit(0.0)), F.lit(1e-3)).alias("spread"),
    )
    fits = staged(fits, "lang-fits")
    deviation = F.col("d") / F.sqrt(F.col("spread") + F.col("noise") * F.col("x"))
    most = exact_quantile(staged(off.join(F.broadcast(fits.drop("mean")), "of").select("of", deviation.alias("deviation")), "lang-deviations"), "of", "deviation", REJECT_QUANTILE).withColumnRenamed("deviation", "most")
    found = {r["of"]: r for r in fits.join(most, "of").collect()}  # a row per language
    for i in range(len(models.names)):
        if r := found.get(i if texts[models.names[i]] >= LEAST_ROWS else -1, found.get(-1)):
            models.mean[i], models.spread[i], models.noise[i] = r["mean"], r["spread"], r["noise"]
            models.most[i] = REJECT_SLACK * max(r["most"], LEAST_DEVIATION)

    def loss(t):
        return F.log(F.aggregate("h", F.lit(0.0), lambda s, x: s + F.exp(-t * (x - F.col("least"))))) + t * (F.col("own") - F.col("least"))

    losses = scored.filter("own is not null").agg(*[F.avg(loss(t)) for t in SHARPNESS]).first()
    models.sharpness = SHARPNESS[int(np.argmin([np.inf if x is None else x for x in losses]))]


def identify(docs: DataFrame, models: LanguageModels, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, entropy, rejected of every whole text, from the text alone.

    The language of the least cross-entropy per character wins (the first by name among equals); score is its share
    of the calibrated soft maximum. Null texts and those without a letter are "und", score 0, rejected; rejected are also texts, of
    any length, whose least cross-entropy lies further above their language's mean than its limit, in standard errors for texts of
    that length. Without any model all is "und". One pass for each part of the model, no shuffle.
    Repeated rows repeat, null ids stay null, other columns are ignored, an empty table gives none.
    """
    import pyarrow as pa

    if not models.names:
        return docs.select(F.col(id_col).alias("doc_id"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("entropy"), F.lit(True).alias("rejected"))
    told = models.without_parts()

    def finish(nats, n):
        found = told.classify(nats, n)
        return [pa.array(found["lang_pred"], pa.string()), pa.array(found["score"], pa.float64()), pa.array(found["entropy"], pa.float64()), pa.array(found["rejected"], pa.bool_())]

    return costs(docs, models, id_col, text_col, finish, "lang_pred string, score double, entropy double, rejected boolean")


def keep_identified(docs: DataFrame, training: DataFrame, label_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows of docs that language identification doesn't reject, with all their columns.

    Only texts and their hashes go through Python; the hashes of rejected texts come back. Nulls, empty texts, ties and
    repeated rows as in identify; ids take no part.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.xxhash64(text).alias("text_key"), text.alias("text"))
    found = identify(keyed, train(training, label_col, text_col), "text_key", "text")
    rejected = staged(found.filter("rejected").select("doc_id").distinct(), "lang-rejected").alias("r")
    return docs.join(small(rejected), F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col("r.doc_id"), "left_anti")
