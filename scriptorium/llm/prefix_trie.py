"""A trie of conversation prefixes by Patricia construction: sorted sequences, points where they part or end, compressed edges, then expansion."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, join_counted, small, staged, text_slices
from .merkle import ranked

#: Hexadecimal digits of a prefix's key.
KEY = 32
#: Sorted sequences that one stack goes through.
BLOCK = 4096
#: Characters of a piece of a list of ids.
PIECE = 200_000
EMPTY_SHA256 = hashlib.sha256().hexdigest()


def turn_key(role: Column, text: Column) -> Column:
    """A digest of role and text that tells where one ends."""
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, KEY)


def turn_lists(rows: DataFrame) -> DataFrame:
    """conv_id and turns, array<struct<key, size>> in the order of turn (null first), role and text; texts themselves stay behind."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    one = F.struct(F.col("turn").isNotNull().alias("told"), F.col("turn").alias("turn"), role.alias("role"), turn_key(role, text).alias("key"), F.length(text).cast("long").alias("size"))
    listed = rows.filter(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("turns"))


def with_shared_beginnings(lists: DataFrame, span: int, most: int) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % span in place of its own first h; h is the crc32 of its number, modulo most.

    A missing one gives no turns, a short one all that it has. A first conversation meets the span's own ones only, with most - 1 turns.
    """
    heads = lists.filter(F.col("conv_id") % span == 0).select(F.col("conv_id").alias("first"), F.slice("turns", 1, most - 1).alias("head"))
    both = lists.withColumn("first", F.col("conv_id") - F.col("conv_id") % span).join(heads, "first", "left")
    both = both.withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % most).cast("int"))
    shared = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    return both.select("conv_id", F.concat(shared, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def sequences(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences: keys (one a turn), sizes, n_convs (conversations that are it) and conv_id (their smallest); and key, conv_id of every conversation's end.

    A prefix's key is a digest of the key before it and of its last turn. Equal keys mean equal prefixes, and lists of keys in order put what shares a prefix together.
    """
    last = lambda keys: F.coalesce(F.try_element_at(keys, F.lit(-1)), F.lit(""))
    chain = F.aggregate("turns", F.array().cast("array<string>"), lambda keys, t: F.concat(keys, F.array(F.substring(F.sha2(F.concat(last(keys), t["key"]), 256), 1, KEY))))
    rows = lists.select("conv_id", chain.alias("keys"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    rows = staged(rows.withColumn("key", last(F.col("keys"))), "trie-sequences")
    found = rows.groupBy("key").agg(F.min_by(F.struct("keys", "sizes"), "conv_id").alias("x"), F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    return found.select("x.keys", "x.sizes", "n_convs", "conv_id"), rows.select("key", "conv_id")


class _Stack:
    """The open points of a block of sorted sequences: a point is a prefix at which sequences part or one ends.

    What a point counts is the difference of running sums between its last sequence and its first. Prefixes that the block's first
    sequence shares with the one before the block, or its last with the one after it, go on in other blocks. What this block has of them is given
    out as a part at every such depth, as another block may know of a point where this one has none; parts of a key are summed later.
    """

    def __init__(self, block, give):
        self.block, self.give, self.any = block, give, False
        self.keys, self.sums = [], [0]  # of the last sequence; sums of its sizes
        self.n = self.leaves = self.read = self.new = 0
        self.least = self.shared = None
        self.open = []  # [depth, n, leaves, read, new before it, turns its first sequence shares with the one before, least conversation]

    def common(self, keys):
        """Turns that keys share with the last sequence."""
        low, high = 0, min(len(keys), len(self.keys))
        while low < high:  # a key holds all before it
            mid = (low + high + 1) // 2
            low, high = (mid, high) if keys[mid - 1] == self.keys[mid - 1] else (low, mid - 1)
        return low

    def remember(self, keys, sizes):
        self.keys, self.sums = keys, [0]
        for s in sizes:
            self.sums.append(self.sums[-1] + s)

    def counted(self, depth, start, shared):
        """n_convs, n_leaves, read and kept sizes of a prefix of the last sequence since start."""
        up = self.sums[max(depth - 1, 0)]
        n = self.n - start[0]
        # turns above the prefix that its first sequence was the first to have are no part of it
        above = max(0, up - self.sums[shared]) if shared < depth else 0
        return n, self.leaves - start[1], self.read - start[2] - n * up, self.new - start[3] - above

    def key(self, depth):
        return self.keys[depth - 1] if depth else ""

    def part(self, depth, real, counts, least):
        self.give("part", self.key(depth), depth, real, *counts, least, None, None, None, None, None)

    def close(self, shared):
        """Ends all points deeper than shared, and sees to it that there is one at shared."""
        real, child = set(), None
        while self.open and self.open[-1][0] > shared:
            depth, *start, before, least = self.open.pop()
            if child is not None:
                least = min(least, child[-1])
            child = [shared, *start, before, least]
            if start[0] == 0 and depth <= self.left:
                real.add(depth)
                continue
            up = max(shared, self.open[-1][0])
            self.give("point", self.key(depth), depth, True, *self.counted(depth, start, before), least, self.key(up), self.keys[up:depth], self.sums[up:depth], None, None)
            if self.open[-1][0] >= shared:
                self.open[-1][-1] = min(self.open[-1][-1], least)
                child = None
        if child is not None:
            if self.open[-1][0] < shared:
                self.open.append(child)
            else:
                self.open[-1][-1] = min(self.open[-1][-1], child[-1])
        for depth in range(shared + 1, self.going + 1):
            self.part(depth, depth in real, self.counted(depth, (0, 0, 0, 0), self.left), self.least)
        self.going = min(self.going, shared)

    def add(self, keys, sizes, n, conv_id):
        """A sequence of the block."""
        shared = self.common(keys)
        if self.any:
            self.leaves += shared < len(self.keys)
            self.close(shared)
        self.remember(keys, sizes)
        if not self.any:
            self.left = self.going = shared
            self.outer(shared, 0)
            self.open = [[0, 0, 0, 0, 0, shared, conv_id]]
            if shared:
                self.open.append([shared, 0, 0, 0, 0, shared, conv_id])
        if self.open[-1][0] < len(keys):
            self.open.append([len(keys), self.n, self.leaves, self.read, self.new, shared, conv_id])
        else:
            self.open[-1][-1] = min(self.open[-1][-1], conv_id)
        self.n += n
        self.read += n * self.sums[-1]
        self.new += self.sums[-1] - self.sums[shared]
        self.least = conv_id if self.least is None else min(self.least, conv_id)
        self.any = True

    def outer(self, shared, side):
        """The path that goes on in the block before (side 0) or after (side 1)."""
        self.give("path", "", 0, False, 0, 0, 0, 0, None, None, self.keys[:shared], self.sums[:shared], self.block, side)

    def end(self, keys):
        """The block ends; keys are those of the sequence behind it, null if there is none."""
        shared = 0 if keys is None else self.common(keys)
        self.leaves += keys is None or shared < len(self.keys)
        self.close(shared)
        self.outer(shared, 1)
        least = self.open[-1][-1]
        at = len(self.open) - 1
        for depth in range(shared, -1, -1):
            while at > 0 and self.open[at - 1][0] >= depth:
                at -= 1
                least = min(least, self.open[at][-1])
            top, *start, before, _ = self.open[at]
            self.part(depth, top == depth, self.counted(depth, start, before), least)


FOUND = "what string, key string, depth int, real boolean, n_convs long, n_leaves long, read long, kept long, conv_id long, parent_key string, keys array<string>, sums array<long>, block long, side int"


def points(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """key, depth, n_convs, conv_id, n_leaves, saved, parent_key, keys, sums: the points of the compressed tree, each with the turns of the edge to it and the sizes summed up to each.

    Sequences are sorted over all tasks and cut into blocks; a stack goes through each. A block also sees the sequence before and after it. Prefixes that
    go on from block to block, which a hot beginning does through many, are parts: a row for each depth and block, summed by key.
    A part is a point if any block says so; its parent is the next point above it on the block's own outer path.
    """
    import pyarrow as pa

    placed = ranked(staged(distinct, "trie-distinct"), [], ["keys"], "trie").drop("size")
    own = F.floor(F.col("place") / block).cast("long")
    at = F.col("place") % block
    blocks = F.array_compact(F.array(own, F.when((at == 0) & (own > 0), own - 1), F.when(at == block - 1, own + 1)))
    spread = placed.select(F.explode(blocks).alias("block"), "place", "keys", "sizes", "n_convs", "conv_id")
    spread = spread.repartition("block").sortWithinPartitions("block", "place")
    names = [c.split()[0] for c in FOUND.split(", ")]
    bounded_batches(distinct.sparkSession)

    def run(batches):
        out, now = [], None

        def give(*row):
            out.append(row)

        def batch_of():
            kinds = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "long": pa.int64(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}
            columns = list(zip(*out)) or [()] * len(names)
            made = pa.RecordBatch.from_arrays([pa.array(c, kinds[t.split()[1]]) for c, t in zip(columns, FOUND.split(", "))], names=names)
            out.clear()
            return made

        def ended(stack, keys=None):
            if stack is not None and stack.any:
                stack.end(keys)
                stack.any = False

        for batch in batches:
            for piece in text_slices(batch, 2):
                for b, place, keys, sizes, n, conv_id in zip(*(c.to_pylist() for c in piece.columns)):
                    if now is None or now.block != b:
                        ended(now)
                        now = _Stack(b, give)
                    if place < b * block:
                        now.remember(keys, sizes)
                    elif place >= (b + 1) * block:
                        ended(now, keys)
                    else:
                        now.add(keys, sizes, n, conv_id)
                yield batch_of()
        ended(now)
        yield batch_of()

    found = staged(spread.mapInArrow(run, FOUND), "trie-points")
    saved = (F.col("read") - F.col("kept")).alias("saved")
    whole = found.filter("what = 'point'").select("key", "depth", "n_convs", "conv_id", "n_leaves", saved, "parent_key", "keys", "sums")
    sums = found.filter("what = 'part'").groupBy("key", "depth").agg(F.max("real").alias("real"), *[F.sum(c).alias(c) for c in ("n_convs", "n_leaves", "read", "kept")], F.min("conv_id").alias("conv_id"))
    outer = staged(sums.filter(F.col("real") | (F.col("depth") == 0)).select("key", "depth", "n_convs", "conv_id", "n_leaves", saved), "trie-outer")
    paths = found.filter("what = 'path'")
    steps = paths.select("block", "side", F.posexplode("keys").alias("at", "key")).join(small(outer.select("key")), "key")
    steps = steps.groupBy("block", "side").agg(F.array_sort(F.collect_list(F.col("at") + 1)).alias("depths"))
    edge = lambda up, down: F.struct(
        F.get("keys", down - 1).alias("key"), F.coalesce(F.get("keys", up - 1), F.lit("")).alias("parent_key"), F.slice("keys", up + 1, down - up).alias("keys"), F.slice("sums", up + 1, down - up).alias("sums")
    )
    edges = F.zip_with(F.concat(F.array(F.lit(0)), F.slice("depths", F.lit(1), F.size("depths") - 1)), F.col("depths"), edge)
    edges = paths.join(steps, ["block", "side"]).select(F.explode(edges).alias("x")).groupBy("x.key").agg(F.first("x").alias("x"))
    root = F.array(F.lit("")), F.array(F.lit(0).cast("long"))
    told = outer.join(edges.select("key", "x.parent_key", F.col("x.keys").alias("keys"), F.col("x.sums").alias("sums")), "key", "left")
    told = told.withColumns({"keys": F.coalesce("keys", root[0]), "sums": F.coalesce("sums", root[1])})
    return whole.unionByName(told)


def ends_digests(ends: DataFrame) -> DataFrame:
    """key and ends_sha256: the digest of its conversations' numbers, ascending, with commas between. ends: key, conv_id.

    A digest has to be taken in order, but the list needn't be in one place for that: sorted runs make pieces of text, and one task streams a key's
    pieces, of which it holds one. A prefix at which a third of all conversations end is a few pieces.
    """
    import pandas as pd

    bounded_batches(ends.sparkSession)

    def pieces(frames):
        key, text, size, n = None, [], 0, 0
        for pdf in frames:
            rows = []
            for k, c in zip(pdf["key"], pdf["conv_id"]):
                if key is not None and (k != key or size >= PIECE):
                    rows.append((key, n, ",".join(text)))
                    text, size, n = [], 0, n + 1
                key = k
                text.append(str(c))
                size += len(text[-1]) + 1
            yield pd.DataFrame(rows, columns=["key", "n", "text"])
        if text:
            yield pd.DataFrame([(key, n, ",".join(text))], columns=["key", "n", "text"])

    def digests(frames):
        key, digest = None, None
        for pdf in frames:
            rows = []
            for k, text in zip(pdf["key"], pdf["text"]):
                if k == key:
                    digest.update(b"," + text.encode())
                    continue
                if key is not None:
                    rows.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(text.encode())
            yield pd.DataFrame(rows, columns=["key", "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "ends_sha256"])

    laid = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInPandas(pieces, "key string, n long, text string")
    laid = laid.withColumn("run", F.spark_partition_id())
    return laid.repartition("key").sortWithinPartitions("key", "run", "n").select("key", "text").mapInPandas(digests, "key string, ends_sha256 string")


def prefix_trie(rows: DataFrame, span: int | None = None, most: int = 6) -> DataFrame:
    """A row for each distinct prefix of the conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    rows: conv_id, turn, role, text. Turns go by turn (null first; equal ones by role, then text); null roles and texts are empty. With span, beginnings
    are shared first as in with_shared_beginnings. conv_id is a node's smallest member, parent_conv_id its parent's (root: null); n_leaves and saved_tokens
    are over its subtree: nodes without children, and (n_convs - 1) times the code points of each node's last text. ends_sha256 is that of the members that end there.

    The compressed tree has points only where sequences part or end, and every aggregate is taken there. Then the turns of an edge become
    nodes of their own, each with its point's members and what the suffix of the edge saves.
    Rows without a conv_id belong to no conversation; repeated rows are turns of their own; other columns are ignored; an empty table has no root.
    A conversation is one row of about 40 bytes a turn.
    """
    lists = turn_lists(rows)
    distinct, ends = sequences(lists if span is None else with_shared_beginnings(staged(lists, "trie-turns"), span, most))
    found = staged(points(distinct), "trie-tree")
    kids = found.filter(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("n_children"))
    heads = staged(found.select("key", "conv_id").join(kids, "key", "left").select("key", "conv_id", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children")), "trie-heads")
    above = heads.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up_conv_id"), F.col("n_children").alias("many"))
    told = join_counted(found, above, ["parent_key"], "many", "left").drop("many").join(heads.select("key", "n_children"), "key").join(ends_digests(ends), "key", "left")
    many = F.size("keys")
    nodes = told.select("*", F.posexplode("sums").alias("at", "upto"), many.alias("long"))
    last = F.col("at") == F.col("long") - 1
    behind = F.element_at("sums", -1) - F.col("upto")
    return nodes.select(
        "conv_id",
        (F.col("depth") - F.col("long") + 1 + F.col("at")).cast("long").alias("depth"),
        F.when(F.col("at") == 0, F.col("up_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * behind).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(EMPTY_SHA256))).otherwise(EMPTY_SHA256).alias("ends_sha256"),
    )
