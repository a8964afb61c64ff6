"""A Merkle manifest of a dataset: sorted runs of leaves, a node store in Parquet by level, proofs by merging on coordinates."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, small, staged

#: Levels that one pass builds; a run is 2 ** PASS_LEVELS consecutive nodes.
PASS_LEVELS = 10
RUN = 1 << PASS_LEVELS
PROOF = "array<struct<hash:string,right:boolean>>"


def framed(values: list[Column]) -> Column:
    """H of values, each as - if null, else its UTF-8 byte count, a colon and itself."""
    told = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*told), 256)


def ranked(rows: DataFrame, by: list[str], order: list[str], label: str) -> DataFrame:
    """Adds place, from 0, in each group's order, and size, the group's rows. Nulls come first, as values and as groups.

    Rows are sorted into runs, a task each, and written; a row's place is its own in the run and what its group has in the runs before. Only a
    count for each run and group meets, so that no task gets a whole group.
    """
    keys = list(dict.fromkeys([*by, *order]))
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    laid = staged(laid.withColumn("_run", F.shiftright("_at", 33)), f"{label}-runs")
    counts = staged(laid.groupBy(*by, "_run").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")), f"{label}-counts")
    sums = counts.groupBy(*by).agg(F.sum("_n").alias("_size"), F.array_sort(F.collect_list(F.struct("_run", "_first", "_n"))).alias("_parts"))
    # a group has at most one part a run
    before = F.transform("_parts", lambda p, i: F.struct(p["_run"].alias("run"), p["_first"].alias("first"), F.aggregate(F.slice("_parts", F.lit(1), i), F.lit(0).cast("long"), lambda n, x: n + x["_n"]).alias("before")))
    told = small(staged(sums.select(*[F.col(c).alias(f"_{c}") for c in by], "_size", F.explode(before).alias("_x")), f"{label}-offsets"))
    same = F.col("_run") == F.col("_x.run")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return laid.join(told, same).select(*rows.columns, (F.col("_at") - F.col("_x.first") + F.col("_x.before")).alias("place"), F.col("_size").alias("size"))


def _paired(nodes: Column) -> Column:
    """The next level: every two consecutive nodes, or the last one alone, as their H."""
    return F.transform(F.sequence(F.lit(1), F.size(nodes), F.lit(2)), lambda i: F.sha2(F.concat(nodes[i - 1], F.coalesce(F.get(nodes, i), F.lit(""))), 256))


def _height(size: Column, done: int) -> Column:
    """Levels that a pass builds in a tree of size leaves of which done levels are built: to its root, PASS_LEVELS at most."""
    left = F.shiftright(size + ((1 << done) - 1), done)
    return F.when(left > RUN, PASS_LEVELS).when(left <= 1, 0).otherwise(F.length(F.bin(left - 1)))


def build_trees(nodes: DataFrame, store: str) -> tuple[int, DataFrame]:
    """Writes every level of the trees below store and returns the number of passes and (tree, size, hash) of the roots.

    nodes: tree, size (of the tree), place (from 0), hash. store gets level=k folders with a row per run: tree, size, run (its number),
    hashes (of consecutive nodes). A pass reads a level run by run, builds the next from it, and that one's next, PASS_LEVELS in all; the
    tops of runs, a RUN-th as many, are what the next pass reads. A run is at most RUN hashes, so memory doesn't depend on the tree. One number
    for each pass reaches the driver.
    """
    spark = nodes.sparkSession
    roots, done, now = None, 0, nodes
    while True:
        run = F.shiftright("place", PASS_LEVELS)
        runs = now.groupBy("tree", "size", run.alias("run")).agg(F.array_sort(F.collect_list(F.struct("place", "hash"))).alias("nodes"))
        first = F.array(F.transform("nodes", lambda n: n["hash"]))
        # levels of a run, each from the one before; a run of a tree of one leaf has that leaf alone
        built = F.aggregate(F.sequence(F.lit(1), F.lit(PASS_LEVELS)), first, lambda levels, k: F.when(k > F.col("height"), levels).otherwise(F.concat(levels, F.array(_paired(F.element_at(levels, -1))))))
        levels = runs.withColumn("height", _height(F.col("size"), done)).withColumn("levels", built)
        levels = levels.select("tree", "size", "run", "height", F.posexplode("levels").alias("up", "hashes"))
        path = f"{store}/pass-{done // PASS_LEVELS}"
        levels.withColumn("level", F.col("up") + done).write.partitionBy("level").parquet(path)
        written = spark.read.schema("tree string, size long, run long, height int, up int, hashes array<string>, level int").parquet(path)
        tops = staged(written.filter("up = height").select("tree", "size", F.col("run").alias("place"), F.get("hashes", F.lit(0)).alias("hash")), "merkle-tops")
        done += PASS_LEVELS
        whole = F.shiftright(F.col("size") + ((1 << done) - 1), done) <= 1
        found = tops.filter(whole).select("tree", "size", "hash")
        roots = found if roots is None else roots.unionByName(found)
        now = tops.filter(~whole)
        if now.isEmpty():
            return done // PASS_LEVELS, roots


def run_proofs(spark, store: str, passes: int, above: DataFrame) -> DataFrame:
    """tree, run, levels, above, and the further columns of above, for each run of leaves: a leaf's siblings are levels[k][(place >> k) ^ 1], then those of above.

    above: tree, above (the proof of the tree's root) and further columns. From the top pass down, each run meets the proof of its top, which is a
    node of the pass above: a join of sorted runs by coordinate, one row with one row.
    """
    more = [c for c in above.columns if c not in ("tree", "above")]
    upper = above.withColumn("place", F.lit(0).cast("long"))
    for p in reversed(range(passes)):
        path, done = f"{store}/pass-{p}", p * PASS_LEVELS
        stored = spark.read.schema("tree string, size long, run long, height int, up int, hashes array<string>, level int").parquet(path)
        runs = stored.filter("up < height or height = 0").groupBy("tree", "size", "run").agg(F.array_sort(F.collect_list(F.struct("up", "hashes"))).alias("levels"), F.max("height").alias("height"))
        # up to its height: a run that is one leaf has no siblings
        runs = runs.select(F.col("tree").alias("_tree"), "size", "run", F.slice(F.transform("levels", lambda x: x["hashes"]), F.lit(1), F.col("height")).alias("levels"))
        met = runs.join(upper, F.col("_tree").eqNullSafe(F.col("tree")) & (F.col("run") == F.col("place"))).select("tree", "run", "levels", "above", *more)
        if p == 0:
            return met
        # the nodes of this pass's lowest level are the tops of the runs below, together with the roots of trees that end there
        lowest = met.select("tree", "run", F.posexplode(F.get("levels", F.lit(0))).alias("at", "_hash"), "levels", "above", *more)
        place = F.shiftleft(F.col("run"), PASS_LEVELS) + F.col("at")
        upper = above.withColumn("place", F.lit(0).cast("long")).join(met.select("tree").distinct().withColumnRenamed("tree", "_tree"), F.col("_tree").eqNullSafe(F.col("tree")), "left_anti")
        upper = upper.unionByName(lowest.select("tree", place.alias("place"), F.concat(siblings(F.col("levels"), F.col("at")), F.col("above")).alias("above"), *more))
        upper = staged(upper, f"merkle-above-{done}")
    raise ValueError("no pass was built")


def siblings(levels: Column, place: Column) -> Column:
    """hash (null where a run's last node is alone) and whether the node itself stands right of it, from the lowest of the run's levels up."""
    at = lambda k: F.call_function("shiftright", place.cast("int"), k)
    return F.transform(levels, lambda nodes, k: F.struct(F.get(nodes, at(k).bitwiseXOR(F.lit(1))).alias("hash"), (at(k) % 2 == 1).alias("right")))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf gives with its siblings."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.when(s["right"], F.concat(s["hash"], h)).otherwise(F.concat(h, F.coalesce(s["hash"], F.lit("")))), 256))


def proof_digest(proof: Column) -> Column:
    """H of the siblings from the leaf's up."""
    return F.sha2(F.array_join(F.transform(F.filter(proof, lambda s: s["hash"].isNotNull()), lambda s: s["hash"]), ""), 256)


def manifest(docs: DataFrame, fields: list[str], group_col: str, id_col: str = "doc_id", keep: dict[str, Column] | None = None, text_col: str | None = "text") -> tuple[str, DataFrame]:
    """The folder of the node store, and doc_id, leaf, subroot, root, proof and the kept columns of every row.

    A row's leaf is framed() of its fields. The leaves of a group (a value of group_col, null too) ascend by id (null first), then by leaf; each
    level has every two consecutive nodes, or the last one alone, as their H, until one is left: the group's subroot. Subroots by group (null first,
    else by UTF-8 bytes) make the root likewise. proof: array<struct<hash, right>> of the siblings from leaf to root; hash is null where there is none.
    keep names further columns of docs that come with each leaf, by expressions.

    Texts are read once and only hashes go on. Rows are sorted over all tasks, so a group of any size is no hot task; runs of 2 ** 10 hashes are
    the largest thing in memory besides. Rows that repeat in all fields are leaves side by side. An empty table gives no rows and no root.
    """
    spark = docs.sparkSession
    store = f"{shared_dir(spark)}/staged/merkle-{uuid.uuid4().hex}"
    kept = {f"_k_{c}": e for c, e in (keep or {}).items()}
    leaves = docs.select(F.col(group_col).cast("string").alias("tree"), F.col(id_col).alias("doc_id"), framed([F.col(c) for c in fields]).alias("hash"), *[e.alias(c) for c, e in kept.items()])
    # the last key parts leaves that are equal, so that many equal rows aren't one task's
    leaves = ranked(staged(leaves.withColumn("_tie", F.monotonically_increasing_id()), "merkle-leaves"), ["tree"], ["doc_id", "hash", "_tie"], "merkle-leaves").drop("_tie")
    passes, subroots = build_trees(leaves.select("tree", "size", "place", "hash"), f"{store}/groups")
    tops = ranked(staged(subroots.select("tree", "hash"), "merkle-subroots"), [], ["tree"], "merkle-subroots")
    of_group = staged(tops.select(F.col("tree").alias("group"), "place", F.col("hash").alias("subroot"), F.lit(None).cast("string").alias("tree"), "size", "hash"), "merkle-groups")
    top_passes, root = build_trees(of_group.select("tree", "size", "place", "hash"), f"{store}/root")
    told = root.first()
    if told is None:
        return store, leaves.select("doc_id", F.col("hash").alias("leaf"), *[F.lit(None).cast("string").alias(c) for c in ("subroot", "root")], F.array().cast(PROOF).alias("proof"), *[F.col(k).alias(c) for k, c in zip(kept, keep or {})])
    ends = spark.createDataFrame([(None,)], "tree string").withColumn("above", F.array().cast(PROOF))
    tops = _proofs(of_group, run_proofs(spark, f"{store}/root", top_passes, ends))
    above = staged(tops.select(F.col("group").alias("tree"), F.col("proof").alias("above"), "subroot"), "merkle-roots")
    found = _proofs(leaves, run_proofs(spark, f"{store}/groups", passes, above))
    return store, found.select("doc_id", F.col("hash").alias("leaf"), "subroot", F.lit(told["hash"]).alias("root"), "proof", *[F.col(k).alias(c) for k, c in zip(kept, keep or {})])


def _proofs(leaves: DataFrame, runs: DataFrame) -> DataFrame:
    """leaves with their proof and the further columns of runs: sorted leaves and runs merge by coordinate, at most RUN leaves to a run."""
    more = [c for c in runs.columns if c not in ("tree", "run", "levels", "above", *leaves.columns)]
    told = runs.select(F.col("tree").alias("_tree"), F.col("run").alias("_run"), "levels", "above", *more)
    met = leaves.join(told, F.col("tree").eqNullSafe(F.col("_tree")) & (F.shiftright("place", PASS_LEVELS) == F.col("_run")))
    at = F.col("place").bitwiseAND(F.lit(RUN - 1))
    return met.select(*leaves.columns, F.concat(siblings(F.col("levels"), at), F.col("above")).alias("proof"), *more)


def verified(found: DataFrame, leaf: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (of the column leaf with the row's own siblings) and verified."""
    root = folded(F.col(leaf), F.col("proof"))
    out = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
