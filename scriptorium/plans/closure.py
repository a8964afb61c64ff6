"""Closure of stems under suffix rules: breadth-first joins until nothing new appears."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import LATIN, Profile, tokens
from ..sources.shared import saved

#: Rules that may be sent to all tasks; more are joined by a shuffle.
BROADCAST_RULES = 100_000


def suffix_closure(stems: DataFrame, rules: DataFrame, without: list[str] | None = None, max_rounds: int = 200, max_states: int | None = None) -> DataFrame:
    """word, flags (sorted), steps, cut of all forms that can be reached: a rule applies to a form that has its flag, ends in strip and matches its condition, and gives the form its own flags.

    stems: word, flags (array). rules: flag, strip, add, flags (array), condition (a pattern). Rules of the flags in without are left out. A form is a word
    with its flags; it is told once, with the fewest steps. Each round joins the newest forms only with the rules and drops those seen before; it is
    saved, so a round costs what is new in it. Rules under which forms grow without end need a bound: a closure of more than max_states forms then stops there, the first of a
    round by word and flags staying, and cut is true in every row. Without max_states all forms are told. Null words are none; null flags are no flags.
    """
    flags = F.array_sort(F.array_distinct(F.coalesce("flags", F.array().cast("array<string>"))))
    # flags are sorted once for each different stem, not for each time that it occurs
    given = stems.filter(F.col("word").isNotNull()).select("word", "flags").distinct()
    seen = newest = saved(given.select("word", flags.alias("flags")).distinct().withColumn("steps", F.lit(0)))
    many, cut = seen.count(), False
    rules = saved(rules.filter(~F.col("flag").isin(without)) if without else rules).select("flag", "strip", "add", F.array_sort("flags").alias("next_flags"), "condition")
    rules = F.broadcast(rules) if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else rules
    parts = [seen]
    for step in range(1, max_rounds + 1):
        base = F.expr("substring(word, 1, length(word) - length(strip))")
        made = newest.select("word", F.explode("flags").alias("flag")).join(rules, "flag").filter(F.col("word").endswith(F.col("strip")) & F.expr("word rlike condition"))
        made = made.select(F.concat(base, "add").alias("word"), F.col("next_flags").alias("flags")).distinct()
        newest = saved(made.join(seen.select("word", "flags"), ["word", "flags"], "left_anti").withColumn("steps", F.lit(step)))
        found = newest.count()
        full = max_states is not None and many + found >= max_states
        if full:
            newest, cut = newest.orderBy("word", "flags").limit(max(0, max_states - many)), many + found > max_states
        parts.append(newest)
        if found == 0 or full:
            break
        many += found
        seen = seen.unionByName(newest)
    else:
        raise RuntimeError("the closure did not end")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("cut", F.lit(cut))


def valid_unit_set(forms: DataFrame, p: Profile = LATIN, lookup: DataFrame | None = None) -> DataFrame:
    """Distinct units of the words of forms; with lookup (word), of those that it has."""
    words = forms.select("word").distinct()
    words = words.join(lookup.select("word"), "word", "left_semi") if lookup is not None else words
    return words.select(F.explode(tokens(F.col("word"), p)).alias("unit")).distinct()
