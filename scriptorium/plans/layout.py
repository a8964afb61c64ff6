"""Merging of short pages, and pages assembled from random units."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sources.shared import saved
from .numbering import numbered_by_digest


def merge_short(rows: DataFrame, batch: str, order: str, short: Column, text: str, total: list[str], most: list[str], listed: list[str]) -> DataFrame:
    """One pass that joins each short row with the next one of its batch: batch, order of the first, text, and the rest.

    Goes from the first row on; a row that was joined to the one before isn't looked at again, and the last row has no next. So in a run of
    short rows every other one takes its neighbour, which is a matter of the row's place in its run, not of a loop. Texts are trimmed
    and joined by a space; total columns are summed, most ones take the larger value, listed ones become lists in order.
    order is unique within a batch and not null; null texts count as empty, null numbers as 0.
    """
    along = Window.partitionBy(batch).orderBy(order)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    able = F.coalesce(short, F.lit(False)) & F.lead(order).over(along).isNotNull()
    marked = rows.withColumn("_able", able).withColumn("_run", F.sum(F.when(F.col("_able"), 0).otherwise(1)).over(upto))
    in_run = Window.partitionBy(batch, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = marked.withColumn("_takes", F.col("_able") & (F.sum(F.col("_able").cast("int")).over(in_run) % 2 == 1))
    given = F.coalesce(F.lag("_takes").over(along), F.lit(False))
    marked = marked.withColumn("_first", F.when(given, F.lag(order).over(along)).otherwise(F.col(order)))
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), c.alias("x")))), lambda p: p["x"])
    merged = marked.groupBy(batch, F.col("_first").alias(order)).agg(
        F.trim(F.array_join(in_order(F.trim(F.coalesce(F.col(text), F.lit("")))), " ")).alias(text),
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in total],
        *[F.max(F.coalesce(c, F.lit(0))).alias(c) for c in most],
        *[F.array_join(in_order(F.col(c).cast("string")), "|").alias(c) for c in listed],
    )
    return merged


def merge_until_settled(rows: DataFrame, lay: Callable[[], Column], batch: str, order: str, text: str, total: list[str], most: list[str], listed: list[str], passes: int = 5) -> DataFrame:
    """Lays pages out, joins the short ones with their next, and lays them out again, for at most so many passes: merged rows with short, as laid out last, and passes, how often their batch was merged.

    lay takes the rows (batch, order, text, total, most and listed columns) and tells by an expression over them whether a row is laid out as a short page; null is no. Only batches that changed
    are laid out again. A batch that has had all its passes is laid out a last time and stays as it is. Texts are trimmed, null ones are empty. Batches are not null; an empty table gives none.
    """
    kept = [batch, order, text, *total, *most, *listed]
    active = rows.select(*[F.coalesce(tx.strip(F.col(c)), F.lit("")).alias(c) if c == text else F.col(c).cast("string").alias(c) if c in listed else c for c in kept])
    done = None
    for made in range(passes + 1):
        laid = saved(active.select(*kept).withColumn("short", F.coalesce(lay(), F.lit(False))))
        changes = F.coalesce(F.min(F.when(F.col("short"), F.col(order))) < F.max(order), F.lit(False))
        batches = saved(laid.groupBy(batch).agg(changes.alias("_changes")))
        ended = laid if made == passes else laid.join(batches.filter("NOT _changes"), batch, "left_semi")
        ended = ended.withColumn("passes", F.lit(made))
        done = ended if done is None else done.unionByName(ended)
        if made == passes or batches.filter("_changes").isEmpty():
            break
        active = merge_short(laid.join(batches.filter("_changes"), batch, "left_semi"), batch, order, F.col("short"), text, total, most, listed)
    return done


#: Units drawn at once to fill a page up, as a multiple of those that it lacks by their mean length; draws that are broadcast at most.
SPARE, SENT_DRAWS = 1.25, 100_000


def drawn(*key: Column) -> Column:
    """A whole number below 2 ** 60 from the SHA-1 of the key."""
    return F.conv(F.substring(F.sha1(F.concat_ws(":", *key)), 1, 15), 16, 10).cast("long")


def random_pages(
    pages: DataFrame, units: DataFrame, page: str, unit: str, key: list[str], p: tx.Profile = tx.TIBETAN, plain: Column | None = None, special: list[str] | None = None, mandatory: str | None = None, heading: str = "",
    least: int = 60, most: int = 90, pad: int = 4500, cut: int = 6000, seed: int = 0,
) -> DataFrame:
    """page and text: random units with a mandatory piece among them, in one line below a heading.

    A page draws least to most units, with replacement and as often as they occur; the mandatory piece joins them, and all are shuffled. Units follow until the text is pad long, then it is cut. A text
    that doesn't begin with the heading's first character gets the heading. Pages that are plain draw only units without any of the special substrings, and go without a mandatory piece that has one.
    All draws are digests of seed, page and place, so reruns agree. key names the columns that are unique for a unit; blank and null units are left out. Units are numbered without a global sort and
    joined by number; a page collects no more than its draws. A page whose units are all left out isn't there.
    """
    has_special = lambda c: F.exists(F.array(*[F.lit(x) for x in special or []]).cast("array<string>"), lambda x: F.contains(c, x))
    known = units.filter(tx.strip(F.col(unit)) != "").select(*key, unit, F.explode(F.when(has_special(F.col(unit)), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))).alias("plain"))
    known = numbered_by_digest(known, "plain", F.sha1(F.concat_ws(":", F.lit(seed), F.lit("unit"), *key)), ["plain", unit])
    sizes = saved(known.groupBy("plain").agg(F.count("*").alias("many"), F.min(F.length(unit)).alias("shortest"), F.avg(F.length(unit)).alias("mean")))  # two rows
    shortest = sizes.agg(F.min("shortest")).first()[0]
    if shortest is None:
        return pages.select(page, F.lit("").alias("text")).limit(0)
    draws = max(most, -(-pad // (shortest + 1)))
    of = lambda tag, *at: (F.lit(seed), F.lit(tag), F.col(page), *at)
    told = pages.select(page, F.coalesce(F.lit(False) if plain is None else plain, F.lit(False)).alias("plain")).join(F.broadcast(sizes), "plain")
    told = saved(told.withColumn("wanted", F.lit(least) + drawn(*of("many")) % (most - least + 1)))

    def joined(rows, begin, end):
        """The rows' own columns, and as got the units of a page's draws from begin to before end; those before wanted have a place."""
        at = F.explode(F.sequence(begin, end - F.lit(1)))
        place = F.when(F.col("at") < F.col("wanted"), F.sha1(F.concat_ws(":", *of("place", F.col("at")))))
        draw = rows.withColumn("at", at).withColumn("number", drawn(*of("draw", F.col("at"))) % F.col("many"))
        own = [F.first(c).alias(c) for c in ("plain", "wanted", "many", "mean")]
        # Spark takes exploded draws for as small as their pages and would collect any number of them to broadcast them, so they are counted
        many = rows.agg(F.sum(end - begin)).first()[0] or 0
        draw = F.broadcast(draw) if many <= SENT_DRAWS else draw.hint("merge")
        return draw.join(known, ["plain", "number"]).withColumn("place", place).groupBy(page).agg(*own, F.collect_list(F.struct("place", "at", unit)).alias("got"))

    def filled(body):
        return F.aggregate(F.array_sort("got"), body, lambda t, x: F.when(F.length(t) < pad, F.concat(t, F.lit(" "), x[unit])).otherwise(t))

    # first the draws that every page has; pages that they leave short draw on, at first as many as units of the mean length fill
    found, first = joined(told, F.lit(0).cast("long"), F.col("wanted")), F.col("got")
    if mandatory is not None:
        piece = F.struct(F.sha1(F.concat_ws(":", *of("place", F.lit(-1)))).alias("place"), F.lit(-1).alias("at"), tx.strip(F.lit(mandatory)).alias(unit))
        first = F.when(F.col("plain") & has_special(F.lit(mandatory)), first).otherwise(F.concat(first, F.array(piece)))
    joint = F.array_join(F.transform(F.array_sort(first), lambda x: x[unit]), " ")
    found = saved(found.select(page, "plain", "wanted", "many", "mean", F.col("wanted").alias("next"), tx.strip(joint).alias("body")))
    ended = []
    for whole in (False, True):
        lacks = F.ceil((pad - F.length("body")) / (F.col("mean") + 1) * SPARE) + 4
        end = F.lit(draws).cast("long") if whole else F.least(F.lit(draws).cast("long"), F.col("next") + lacks)
        is_short = (F.length("body") < pad) & (F.col("next") < draws)
        short = found.filter(is_short).withColumn("end", end)
        if short.isEmpty():
            break
        ended.append(found.filter(~is_short))
        more = joined(short, F.col("next"), F.col("end")).select(page, "got").join(short.select(page, "body", "end"), page).select(page, "end", filled(F.col("body")).alias("more"))
        found = short.drop("end").join(more, page, "left").withColumns({"body": F.coalesce("more", "body"), "next": F.coalesce("end", "next")}).drop("more", "end")
        found = saved(found)
    for part in ended:
        found = found.unionByName(part)
    body = F.col("body")
    body = tx.one_line(F.substring(body, 1, cut), p)
    return found.select(page, (F.when(F.startswith(body, F.lit(heading[:1])), body).otherwise(F.concat(F.lit(heading), body)) if heading else body).alias("text"))
