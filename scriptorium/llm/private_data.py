"""Personal data: spans by pattern, and terms that reveal them by corpus co-occurrence. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, small, staged

#: Kinds in order, with patterns that match as the plain ones do but never scan a run twice: a match begins where
#: its run does (or where the last match ended) and takes what it can without going back.
KINDS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Blocks of scripts that put no space between words: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han.
UNSPACED = r"\x{E00}-\x{109F}\x{1780}-\x{17FF}\x{3005}-\x{3007}\x{3040}-\x{30FF}\x{31F0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{A9E0}-\x{A9FF}\x{AA60}-\x{AA7F}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{1B000}-\x{1B16F}\x{20000}-\x{3FFFF}"
#: A term: a run of at least two letters, marks, digits or low lines; in unspaced scripts each two neighbours of a run.
WORD_CHAR = rf"[A-Za-z0-9_[\p{{L}}\p{{M}}\p{{Nd}}&&[^{UNSPACED}]]]"
WORDS = rf"{WORD_CHAR}{{2,}}+"
RUNS = rf"[{UNSPACED}&&[\p{{L}}\p{{M}}]]{{2,}}+"
PAIRS = rf"(?=([{UNSPACED}&&[\p{{L}}\p{{M}}]]{{2}}))"
#: Texts by which the corpus-wide share of an entity weighs in on a term's own counts, so that small counts tell less.
PRIOR_TEXTS = 1.0
#: Share of the entity's information that a term must give to be generalised, and to be removed.
GENERALISE, REMOVE = 0.8, 0.95
TERM_KIND = "term"
#: A term is generalised to so many of its first letters, the most that disclose no more than GENERALISE, else to its kind.
LEVELS = (4, 3, 2, 1)


def let(value: Column, body) -> Column:
    """body(value), with value worked out once however often body names it: a list of one list is walked through."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, join) -> Column:
    """array<bigint>: join (a sum or a maximum) of each value and all before it.

    A list that grows by one is copied at each step. So it is done within blocks of the square root of the size, then over the blocks: n ** 1.5 steps
    of a copy in place of n ** 2.
    """
    none = F.array().cast("array<bigint>")
    grow = lambda acc, x: F.concat(acc, F.array(F.coalesce(join(F.try_element_at(acc, F.lit(-1)), x), x)))

    def of(v):
        size = F.ceil(F.sqrt(F.greatest(F.lit(1), F.size(v)))).cast("int")
        blocks = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(v)), size), lambda i: F.aggregate(F.slice(v, i, size), none, grow))
        upto = lambda b: F.aggregate(F.transform(b, lambda x: F.element_at(x, -1)), none, grow)
        shifted = lambda b, so_far: F.flatten(F.transform(b, lambda x, i: F.when(i == 0, x).otherwise(F.transform(x, lambda y: join(F.get(so_far, i - 1), y)))))
        return F.when(F.size(v) == 0, none).otherwise(let(blocks, lambda b: let(upto(b), lambda so_far: shifted(b, so_far))))

    return let(values, of)


def summed(values: Column) -> Column:
    return running(values, lambda a, x: a + x)


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the leftmost matches that don't overlap; code points, end exclusive."""
    lengths = lambda found: F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda gap, value: (F.length(gap) + F.length(value)).cast("long"))
    spans = lambda found, ends: F.zip_with(found, ends, lambda value, end: F.struct((end - F.length(value)).alias("start"), end.alias("end"), value.alias("value")))
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: spans(found, summed(lengths(found))))


#: Pieces from which on a text is cut as a list of code points, as taking a substring goes through the text from its beginning.
MANY_PIECES = 64


def put_together(text: Column, pieces: Column, tail: Column) -> Column:
    """For each piece (struct<at, to, put>) the text from at to to and what is put behind it, then the text from tail on. pieces and tail are cheap to name."""
    one = lambda p: F.concat(F.substring(text, (p["at"] + 1).cast("int"), F.greatest(F.lit(0), p["to"] - p["at"]).cast("int")), p["put"])
    few = F.concat(F.array_join(F.transform(pieces, one), ""), F.substring(text, (tail + 1).cast("int"), F.length(text)))
    cut_out = lambda c, at, to: F.array_join(F.slice(c, (at + 1).cast("int"), F.greatest(F.lit(0), to - at).cast("int")), "")
    many = let(F.split(text, ""), lambda c: F.concat(F.array_join(F.transform(pieces, lambda p: F.concat(cut_out(c, p["at"], p["to"]), p["put"])), ""), cut_out(c, tail, F.size(c))))
    return F.when(F.size(pieces) == 0, text).when(F.size(pieces) < MANY_PIECES, few).otherwise(many)


def _reach(spans: Column) -> Column:
    """How far each span and those before it have reached."""
    return running(F.transform(spans, lambda s: s["end"]), F.greatest)


def _before(reach: Column, i: Column) -> Column:
    return F.coalesce(F.get(reach, i - 1), F.lit(0))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass: from the right, each second one doubled, with 9 taken off above 9."""
    doubled = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        number = digits(value)
        return F.when(F.length(number).between(16, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end, entity>> by kind as listed, then start. entity: kind and the value in one spelling."""
    hints = {"email": text.contains("@"), "ip": text.contains("."), "card": F.lit(True), "phone": text.contains("+")}
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,entity:string>>")
    return F.concat(*[F.when(hints[kind], _spans_of(kind, text)).otherwise(none) for kind in KINDS])


def _spans_of(kind: str, text: Column) -> Column:
    spelled = ascii_lower if kind in ("email", "ip") else digits
    ok = F.filter(located(text, KINDS[kind]), lambda s: passes(kind, s["value"]))
    return F.transform(ok, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit(f"{kind}:"), spelled(s["value"])).alias("entity")))


def masked(text: Column, spans: Column) -> Column:
    """The text with a space for each code point of a span."""
    blank = lambda s, at: F.repeat(F.lit(" "), F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], at)).cast("int"))
    piece = lambda s, at: F.struct(at.alias("at"), s["start"].alias("to"), blank(s, at).alias("put"))
    pieces = lambda order, reach: F.transform(order, lambda s, i: piece(s, _before(reach, i)))
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    built = let(order, lambda o: let(_reach(o), lambda r: let(pieces(o, r), lambda p: put_together(text, p, F.coalesce(F.try_element_at(r, F.lit(-1)), F.lit(0))))))
    return F.when(F.size(spans) > 0, built).otherwise(text)


def terms_of(text: Column) -> Column:
    """The distinct terms of a text."""
    words, pairs = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)), F.regexp_extract_all(text, F.lit(PAIRS), F.lit(1))
    words = F.transform(F.array_distinct(words), ascii_lower)
    return F.array_distinct(F.when(text.rlike(f"[{UNSPACED}]"), F.concat(words, pairs)).otherwise(words))


def _marked(text: Column, told: Column) -> Column:
    """array<struct<start, end, put>> of the occurrences of the terms of the map told (term to what is put in its place), by start; those that overlap are one."""
    kind = "array<struct<start:bigint,end:bigint,put:string>>"
    empty = F.array().cast(kind)
    place = lambda start, end, put: F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), put.alias("put"))

    def occurrences(pattern, hits_of):
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        pairs = F.zip_with(F.split(text, F.lit(pattern), -1), found, lambda gap, value: F.struct(F.coalesce(F.length(gap), F.lit(0)).cast("long").alias("gap"), F.coalesce(F.length(value), F.lit(0)).alias("size"), hits_of(value).alias("hits")))
        placed = lambda p, ends: F.zip_with(p, ends, lambda x, end: F.struct(x.alias("p"), (end - x["size"]).alias("at")))
        told = let(pairs, lambda p: placed(p, summed(F.transform(p, lambda x: x["gap"] + x["size"]))))
        return F.flatten(F.transform(F.filter(told, lambda x: x["p"]["hits"].isNotNull()), lambda x: F.transform(x["p"]["hits"], lambda h: place(x["at"] + h["start"], x["at"] + h["end"], h["put"]))))

    def of_word(value):
        word = F.array(place(F.lit(0), F.length(value), told[ascii_lower(value)]))
        return F.when(value.isNotNull(), word)

    def of_run(value):
        letters = F.split(value, "")
        one = F.slice(letters, F.lit(1), F.size(letters) - 1)
        two = F.slice(letters, F.lit(2), F.size(letters) - 1)
        every = F.transform(F.zip_with(one, two, lambda a, b: told[F.concat(a, b)]), lambda put, i: place(i, i + 2, put))
        return F.when(value.isNotNull(), F.filter(every, lambda s: s["put"].isNotNull()))

    def merged(spans):
        """Spans by start, each of two letters; those that overlap are one."""
        begins = lambda s, i: (i == 0) | (F.get(spans, i - 1)["end"] <= s["start"])
        marks = F.transform(spans, lambda s, i: F.struct(i.alias("i"), begins(s, i).alias("first"), F.coalesce(begins(F.get(spans, i + 1), i + 1), F.lit(True)).alias("last")))
        where = lambda c: F.transform(F.filter(marks, lambda m: m[c]), lambda m: m["i"])
        gone = lambda removed, a, b: F.get(removed, b) - F.when(a == 0, F.lit(0).cast("long")).otherwise(F.get(removed, a - 1))
        put = lambda removed, a, b: F.when(gone(removed, a, b) > 0, "").when(a == b, F.get(spans, a)["put"]).otherwise(f"[{TERM_KIND}]")
        one = lambda removed: lambda a, b: place(F.get(spans, a)["start"], F.get(spans, b)["end"], put(removed, a, b))
        return let(summed(F.transform(spans, lambda s: F.when(s["put"] == "", 1).otherwise(0).cast("long"))), lambda removed: F.zip_with(where("first"), where("last"), one(removed)))

    # a regular expression of the row's own few terms finds them far faster than a look at each word
    paired = lambda t: t.rlike(f"[{UNSPACED}]")
    spaced = F.filter(F.map_keys(told), lambda t: ~paired(t))
    one_of = F.concat(F.lit(f"(?<!{WORD_CHAR})(?i:"), F.array_join(spaced, "|"), F.lit(f")(?!{WORD_CHAR})"))
    words = F.when(F.size(spaced) > 0, occurrences(one_of, of_word)).otherwise(empty)
    runs = F.when(F.exists(F.map_keys(told), paired), let(occurrences(RUNS, of_run), merged)).otherwise(empty)
    return F.sort_array(F.concat(words, runs))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sanitised: str | None = None) -> DataFrame:
    """doc_id, base and terms of every whole text: arrays of struct<kind, start, end> and struct<start, end, put>.

    base: the patterns' matches that pass their test, all kinds. terms: words outside of base spans that reveal an entity,
    wherever they stand in any text, one without the entity too: over distinct texts, c(t, e) counts those that have term t and
    entity e, c(t) and c(e) those with each, N all. The disclosure of e by t is its pointwise mutual information over the
    information of e, log2(P N / c(e)) / log2(N / c(e)), where P = (c(t, e) + m c(e) / N) / (c(t) + m), m = PRIOR_TEXTS, estimates
    how many texts with t have e: small counts are drawn to the corpus' share, none is left out. Terms from GENERALISE on
    are generalised and from REMOVE on removed: put is what stands in their place, empty for removed ones. A generalised term
    becomes its longest prefix of LEVELS letters (and a *) that discloses less than GENERALISE whatever entity it stood with; a prefix stands in
    at least as many texts as its commonest term, so its disclosure has that bound. Without such a prefix it becomes [term].

    sanitised adds the text after cut(), or its sha256: "text" or "digest".

    Entities that stand in the same texts have the same disclosures and are counted as one; pairs that can't reach GENERALISE with
    any c(t, e) are not made. Null counts as empty. Copies count once in the statistics. Repeated rows repeat, other
    columns are ignored, an empty table gives none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    found = rows.withColumn("spans", base_spans(F.col("text")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,put:string>>")
    shown = {None: [], "text": [F.col("clean").alias("sanitised")], "digest": [F.sha2("clean", 256).alias("sanitised_sha256")]}[sanitised]
    plain = [cut(F.col("text"), F.col("spans"), none).alias("clean")] if sanitised else []
    found = found.select("doc_id", "text_key", "spans", terms_of(masked(F.col("text"), F.col("spans"))).alias("words"), *plain)
    found = found.select("doc_id", "text_key", "spans", "words", *shown)
    found = staged(found, "private-spans")

    keys = staged(found.groupBy("text_key").agg(F.count("*").alias("n")), "private-texts")
    every = float(keys.count() or 1)
    # of a text that stands once only the number goes on; copies keep their key until they count once
    copies = keys.filter("n > 1").select("text_key", F.col("text_key").alias("copy_key"))
    words = found.select("text_key", "words").join(small(copies), "text_key", "left").select(F.explode("words").alias("term"), "copy_key")
    counts = words.groupBy("term", "copy_key").agg(F.count("*").alias("n")).groupBy("term").agg(F.sum(F.when(F.col("copy_key").isNull(), F.col("n")).otherwise(1)).alias("c_t"))
    counts = staged(counts, "private-vocabulary")

    held = staged(found.filter(F.size("spans") > 0).select("text_key", F.explode("spans.entity").alias("entity")).distinct(), "private-held")
    entities = held.groupBy("entity").agg(F.count("*").alias("c_e"), F.bit_xor(F.xxhash64(F.lit(1), "text_key")).alias("x"), F.bit_xor(F.xxhash64(F.lit(2), "text_key")).alias("y"))
    groups = staged(held.join(small(staged(entities, "private-entities")), "entity").select("text_key", "c_e", "x", "y").distinct(), "private-groups")
    most = groups.agg(F.max("c_e")).first()[0] or 0

    def disclosure(c_te, c_t, c_e):
        share = c_e / F.lit(every)
        pmi = F.log2((c_te + PRIOR_TEXTS * share) / (c_t + PRIOR_TEXTS) / share)
        return F.when(share < 1, pmi / -F.log2(share)).otherwise(0.0)

    # what can't reach GENERALISE with the largest c(t, e) that there can be; at a given c(t) that grows with c(e) up to c(t)
    def may(c_t, c_e):
        return disclosure(F.least(c_t, c_e), c_t, c_e) >= GENERALISE - 1e-9

    c_t, c_e = F.col("c_t"), F.col("c_e")
    rare = staged(counts.filter((c_t <= most) | may(c_t, F.lit(most))), "private-counts")
    beside = found.filter(F.size("spans") > 0).select("text_key", F.explode("words").alias("term")).distinct().join(small(rare), "term")
    groups = groups.withColumnRenamed("text_key", "group_key")
    pairs = beside.join(small(groups), (F.col("text_key") == F.col("group_key")) & may(c_t, c_e))
    joint = pairs.groupBy("x", "y", "term").agg(F.count("*").alias("c_te"), F.first("c_t").alias("c_t"), F.first("c_e").alias("c_e"))
    told = joint.groupBy("term").agg(F.max(disclosure(F.col("c_te"), c_t, c_e)).alias("most")).filter(F.col("most") >= GENERALISE)
    # c(prefix) is at least that of its commonest term; with the rarest entity that would be told most
    parts = lambda rows: rows.select("*", F.explode(F.array(*[F.struct(F.lit(n).alias("letters"), F.substring("term", 1, n).alias("prefix")) for n in LEVELS])).alias("x")).select("*", "x.letters", "x.prefix").filter(F.length("term") > F.col("letters"))
    told = staged(told, "private-terms")
    wanted = parts(told.filter(F.col("most") < REMOVE).select("term"))
    common = staged(parts(counts.select("term", "c_t")).groupBy("prefix").agg(F.max("c_t").alias("c_p")).filter(~may(F.col("c_p"), F.lit(most))), "private-prefixes")
    coarse = wanted.join(small(common), "prefix").groupBy("term").agg(F.max_by("prefix", "letters").alias("prefix"))
    put = F.when(F.col("most") >= REMOVE, "").otherwise(F.coalesce(F.concat("prefix", F.lit("*")), F.lit(f"[{TERM_KIND}]")))
    told = staged(told.join(coarse, "term", "left").select("term", put.alias("put")), "private-told")

    hit = found.select("text_key", F.explode("words").alias("term")).join(small(told), "term").groupBy("text_key")
    hit = staged(hit.agg(F.map_from_entries(F.collect_set(F.struct("term", "put"))).alias("told")), "private-hits")
    marked = rows.join(small(hit), "text_key").select("text_key", "text", "told", base_spans(F.col("text")).alias("spans"))
    marked = marked.select("text_key", "text", "spans", _marked(masked(F.col("text"), F.col("spans")), F.col("told")).alias("terms"))
    plain = [cut(F.col("text"), F.col("spans"), F.col("terms")).alias("clean")] if sanitised else []
    marked = marked.select("text_key", "terms", *plain).select("text_key", "terms", *shown)
    extra = found.columns[4:]
    marked = marked.groupBy("text_key").agg(F.first("terms").alias("terms"), *[F.first(c).alias(f"new_{c}") for c in extra])
    out = found.join(small(staged(marked, "private-marked")), "text_key", "left")
    base = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return out.select("doc_id", base.alias("base"), F.coalesce("terms", none).alias("terms"), *[F.coalesce(f"new_{c}", c).alias(c) for c in extra])


def joined(spans: Column, kind=None) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"] if kind is None else F.lit(kind), s["start"], s["end"])), ",")


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def span_digests(found: DataFrame) -> DataFrame:
    """doc_id, the count of each kind and of all, base_sha256, spans with the method's own after the base ones, and n_terms; found may carry further columns."""
    counts = [F.size(F.filter("base", _of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    base, terms = joined(F.col("base")), joined(F.col("terms"), TERM_KIND)
    more = [c for c in found.columns if c not in ("doc_id", "base", "terms")]
    spans = F.concat_ws(",", F.when(base != "", base), F.when(terms != "", terms))
    return found.select("doc_id", *counts, F.size("base").cast("long").alias("n_private"), F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"), F.size("terms").cast("long").alias("n_terms"), *more)


def cut(text: Column, base: Column, terms: Column) -> Column:
    """The text with base spans replaced by their kind in brackets and terms by what is put in their place. Of spans that overlap, the one that begins first stays."""
    base = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), s["kind"], F.lit("]")).alias("put")))
    every = F.array_sort(F.concat(base, F.transform(terms, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["put"].alias("put")))))
    piece = lambda s, at: F.struct(at.alias("at"), s["start"].alias("to"), s["put"].alias("put"))
    kept = lambda e, reach: F.filter(F.transform(e, lambda s, i: piece(s, _before(reach, i))), lambda x: x["to"] >= x["at"])
    built = let(every, lambda e: let(_reach(e), lambda r: let(kept(e, r), lambda p: put_together(text, p, F.coalesce(F.try_element_at(r, F.lit(-1)), F.lit(0))))))
    return F.when(F.size(every) > 0, built).otherwise(text)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base, terms and sanitised: the text with base spans replaced by their kind and revealing terms generalised or removed.

    One row per row of docs, whatever its id; null texts give the empty text. Other columns are ignored.
    """
    return find_spans(docs, id_col, text_col, sanitised="text")
