"""Mixing overlapping sources to target weights: a min-cost flow over membership patterns, then seeded selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, staged

#: Buckets of the seeded order within a pattern; running sums are exact within one and carried between them.
BUCKETS = 4096
#: Most membership patterns (and sources) that the driver takes; more raise an error rather than being cut.
MAX_PATTERNS, MAX_SOURCES = 200_000, 10_000
#: Rounds that fill what the flow leaves to whole documents: seeded prefixes first, then single best fits.
PREFIX_ROUNDS, FIT_ROUNDS = 3, 2
#: Cost of a word's first and second use, and so the most uses. Convex: every first use comes before any second.
REPEAT_COSTS = (1, 3)


def cycled_weights(names: list, weights=(5, 2, 1)) -> dict:
    """Names in code-point order, None last, get the weights in turn."""
    ordered = sorted(n for n in names if n is not None) + ([None] if None in names else [])
    return {n: weights[i % len(weights)] for i, n in enumerate(ordered)}


def water_fill(total: float, weights: dict, caps: dict) -> dict:
    """Shares total by weight; a share stops at its cap and the excess is shared again among the others."""
    share, left, open_names = dict.fromkeys(weights, 0.0), float(total), set(weights)
    while open_names:
        weight = sum(weights[n] for n in open_names)
        over = {n for n in open_names if left * weights[n] / weight > caps[n]}
        if not over:
            return share | {n: left * weights[n] / weight for n in open_names}
        share |= {n: float(caps[n]) for n in over}
        left -= sum(caps[n] for n in over)
        open_names -= over
    return share


def min_cost_flow(supply: list[tuple[tuple, int]], quota: dict, costs: tuple = REPEAT_COSTS) -> list[dict]:
    """Words that each pattern sends to each of its sources: as many as quotas allow, at the least cost, whole words.

    supply: (sources of the pattern, its words). The u-th use of a word costs costs[u]; costs must rise (be convex), else an error.
    A cost depends on the use alone, so the total is least if as many words as can be are in their first use, then in their second
    and so on. An augmenting path never takes words away from a pattern, it only moves them between its sources. So a largest flow
    with one use each, augmented to a largest flow with two uses, keeps as many first uses as there can be: the uses are laid
    on in the order of their costs, and each layer is one largest flow.

    A layer runs in phases: distances by breadth, then augmenting along shortest paths until none is left. A source that a phase has
    found shut isn't tried again in it, so a phase looks at each arc (pattern, source) a bounded number of times for each path that
    fills up something; there are at most 2 * sources phases, as each lengthens the shortest path by two arcs.
    """
    if any(x >= y for x, y in zip(costs, costs[1:])):
        raise ValueError("costs of repeated use must rise")
    sent = [dict.fromkeys(sources, 0) for sources, _ in supply]
    holders: dict = {}
    for i, (sources, _) in enumerate(supply):
        for s in sources:
            holders.setdefault(s, []).append(i)
    need = {s: int(quota.get(s, 0)) for s in holders}
    for _ in costs:
        spare = [words for _, words in supply]
        while _phase(supply, holders, spare, need, sent):
            pass
    return sent


def _phase(supply: list, holders: dict, spare: list, need: dict, sent: list) -> bool:
    """Augments along all shortest paths from patterns with words to spare to sources in need; false if there is none."""
    level: dict = {}
    front = []
    for i, (sources, _) in enumerate(supply):
        if spare[i] > 0:
            for s in sources:
                if s not in level:
                    level[s] = 0
                    front.append(s)
    depth = 0
    while front and not any(need[s] > 0 for s in front):
        after = []
        for s in front:  # a pattern that sends words to s may send them to its other sources instead
            for i in holders[s]:
                if sent[i][s] > 0:
                    for other in supply[i][0]:
                        if other not in level:
                            level[other] = depth + 1
                            after.append(other)
        front, depth = after, depth + 1
    if not front:
        return False
    at = {s: 0 for s in level}  # the pattern of each source that is tried next

    def push(s, amount):
        """Words, at most amount, that s takes in or hands on one level deeper."""
        if level[s] == depth:
            x = min(amount, need[s])
            need[s] -= x
            return x
        done = 0
        while done < amount and at[s] < len(holders[s]):
            i = holders[s][at[s]]
            for other in supply[i][0]:
                if level.get(other) == level[s] + 1:
                    while done < amount and sent[i][s] > 0 and (x := push(other, min(amount - done, sent[i][s]))):
                        sent[i][s] -= x
                        sent[i][other] += x
                        done += x
            if done < amount:
                at[s] += 1
        return done

    for i, (sources, _) in enumerate(supply):
        for s in sources:
            if spare[i] > 0 and level.get(s) == 0:
                x = push(s, spare[i])
                spare[i] -= x
                sent[i][s] += x
    return True


def word_count(text):
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mix_sources(docs: DataFrame, membership, id_col: str = "doc_id", text_col: str = "text", weights=(5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: int = 17) -> DataFrame:
    """How many words of each document the mix takes, so that each source nears its target.

    membership: column of an array of source names (a null name is a source of its own). Documents are summed
    by membership pattern; the flow routes each pattern's words to its sources' quotas, first uses before
    repeats; then each pattern's documents are taken whole in the order of a seeded hash while they fit into its flow,
    and last rounds add the document that fits best into what is left (the last one may go over or use one again, if that is nearer). No document is taken more
    than len(REPEAT_COSTS) times. Returns doc_id, pattern, size, source_size, target, taken; source_size and
    target are those of the pattern's first source. Reruns agree: nothing depends on the row order.

    Null and wordless texts have size 0 and are never taken. Repeated rows count each. Rows without an id count in the sizes and are
    taken as often as their whole pattern is, but not singled out to fill the rest, as they can't be told apart. Empty membership belongs
    to no source and gets target 0. Empty tables give no rows; other columns are ignored. A hot source is cut into
    BUCKETS by hash, so running sums never bring a whole source to one task.
    """
    spark = docs.sparkSession
    key = F.xxhash64(F.lit(seed), F.col("doc_id"))
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.array_sort(F.array_distinct(membership)), F.array().cast("array<string>")).alias("pattern"), word_count(F.col(text_col)).alias("size"))
    sizes = staged(sizes.select("*", key.alias("key"), F.pmod(key, F.lit(BUCKETS)).alias("bucket")), "mix-sizes")
    patterns = sizes.groupBy("pattern").agg(F.sum("size").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    in_order = lambda x: [(s is None, s or "") for s in x[0]]
    supply = sorted(((tuple(r["pattern"] or ()), int(r["words"])) for r in patterns), key=in_order)
    source_size: dict = {}
    for sources, words in supply:
        for s in sources:
            source_size[s] = source_size.get(s, 0) + words
    if len(source_size) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    weight = cycled_weights(list(source_size), weights)
    target = water_fill(share * sum(w for _, w in supply), weight, {s: cap * w for s, w in source_size.items()})
    sent = min_cost_flow(supply, {s: round(t) for s, t in target.items()})
    told = spark.createDataFrame(
        [(list(sources), words, sum(flow.values()), source_size.get(sources[0], 0) if sources else 0, float(target.get(sources[0], 0.0)) if sources else 0.0) for (sources, words), flow in zip(supply, sent)],
        "pattern array<string>, words long, flow long, source_size long, target double",
    )
    told = told.select("*", F.when(F.col("words") > 0, F.floor(F.col("flow") / F.col("words"))).otherwise(0).alias("turns"))
    told = told.withColumn("rest", F.col("flow") - F.col("turns") * F.col("words"))

    # Whole documents for the rest of each pattern's flow: seeded prefixes, each among what still fits, then best fits.
    budget, chosen, free = told.filter(F.col("turns") < len(REPEAT_COSTS)).select("pattern", "rest", "turns"), None, sizes.filter("size > 0 and doc_id is not null").withColumn("used", F.lit(0))
    for step in range(PREFIX_ROUNDS + FIT_ROUNDS):
        if step < PREFIX_ROUNDS:
            took = _seeded_prefix(free, budget)
        elif step < PREFIX_ROUNDS + FIT_ROUNDS - 1:
            took = _best_fit(free, budget, over=False)
        else:
            again = chosen.withColumn("used", F.lit(1))
            took = _best_fit(free.select(again.columns).unionByName(again), budget, over=True)
        took = staged(took, "mix-chosen")
        spent = took.groupBy("pattern").agg(F.sum("size").alias("spent")).alias("s")
        budget = budget.alias("b").join(F.broadcast(spent), F.col("b.pattern").eqNullSafe(F.col("s.pattern")), "left")
        budget = staged(budget.select("b.pattern", (F.col("rest") - F.coalesce("spent", F.lit(0))).alias("rest"), "turns"), "mix-budget")
        once = took.distinct()
        chosen = once if chosen is None else chosen.unionByName(once)
        free = free.join(took.select("doc_id"), "doc_id", "left_anti")
    extra = chosen.groupBy("doc_id").agg(F.count("*").alias("extra"))
    out = sizes.alias("d").join(F.broadcast(told).alias("t"), F.col("d.pattern").eqNullSafe(F.col("t.pattern"))).join(extra, "doc_id", "left")
    times = F.least(F.col("turns") + F.coalesce("extra", F.lit(0)), F.lit(len(REPEAT_COSTS)))
    return out.select("doc_id", "d.pattern", "size", "source_size", "target", (times * F.col("size")).cast("long").alias("taken"))


def _seeded_prefix(free: DataFrame, budget: DataFrame) -> DataFrame:
    """The documents, in seeded order, whose running size stays within their pattern's budget; larger ones are passed over.

    Running sums are taken within hash buckets and carried between buckets, so no task holds a whole pattern.
    """
    fits = F.col("a.pattern").eqNullSafe(F.col("b.pattern")) & (F.col("a.size") <= F.col("b.rest"))
    rows = free.alias("a").join(F.broadcast(budget).alias("b"), fits).select("a.*", "b.rest")
    sums = rows.groupBy("pattern", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("pattern", "bucket", F.coalesce(F.sum("words").over(upto), F.lit(0)).alias("offset"))
    within = Window.partitionBy("pattern", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("running", F.sum("size").over(within)).alias("r")
    same = F.col("r.pattern").eqNullSafe(F.col("o.pattern")) & (F.col("r.bucket") == F.col("o.bucket"))
    return placed.join(offsets.alias("o"), same).filter("offset + running <= rest").select("doc_id", "r.pattern", "size")


def _best_fit(rows: DataFrame, budget: DataFrame, over: bool) -> DataFrame:
    """Of each pattern, the document whose size comes nearest to the budget, unused ones first, then by id; larger ones only if over is set."""
    fits = F.col("a.pattern").eqNullSafe(F.col("b.pattern")) & (F.col("a.size") < 2 * F.col("b.rest") if over else F.col("a.size") <= F.col("b.rest"))
    usable = F.col("a.used") + F.col("b.turns") < len(REPEAT_COSTS)
    rows = rows.alias("a").join(F.broadcast(budget).alias("b"), fits & usable).select("a.pattern", "a.used", "a.size", "a.doc_id", F.abs(F.col("b.rest") - F.col("a.size")).alias("gap"))
    best = rows.groupBy("pattern").agg(F.min(F.struct("gap", "used", "doc_id", "size")).alias("x"))
    return best.select("x.doc_id", "pattern", "x.size")


def take_mix(docs: DataFrame, membership, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that the mix takes, each as many times as it is taken, with all their columns.

    Documents without words carry no weight in a mix and stay once. Rows without an id can't be told apart and go.
    """
    mix = mix_sources(docs, membership, id_col, **options)
    times = mix.select(F.col("doc_id").alias(id_col), F.when(F.col("size") == 0, F.lit(1)).otherwise((F.col("taken") / F.col("size")).cast("int")).alias("mix_times"))
    times = times.filter("mix_times > 0").distinct().select(id_col, F.explode(F.array_repeat(F.lit(1), F.col("mix_times"))).alias("mix_copy")).select(id_col)
    return docs.join(times, id_col).select(docs.columns)
