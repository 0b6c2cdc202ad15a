"""Mixing sources to target weights by a subset-sum fit of word budgets.

Every source gets a weight by its place in the code point order (null last); together they share a multiple of
all sizes. A target never passes ``most`` times the size of its source: what is beyond is shared again among the
others by weight until none is above. A document is taken ``floor(target / source size)`` times in any
case. For the rest of the budget the documents of a source are counted by their exact length: of every
length the same share is taken, rounded down, then long ones as long as they fit, and a
bounded-knapsack dynamic programme over the counts left closes the gap that remains. Which
documents of a length are taken is a seeded choice.

Edge cases: a null or empty text has size 0 and costs nothing; an empty table gives an empty result; a source whose
documents are all empty has target 0; repeated rows are separate documents, ties in the seeded order are
settled by id, and equal rows are interchangeable. The dynamic programme handles one row per source and
length: documents are counted before any of them meet, and a crowded length is cut into
buckets of the seeded order.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import as_row, stored, with_word_counts

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BUCKETS = 1024
SEED = 17
GAP = 1 << 15  # words that are left for the dynamic programme


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` from rows ``source, size``.

    Targets are ``min(most * size, level * weight)`` with one level for all. In the order of size by weight
    the sources that stop at their limit come first, so running sums find the level. There is one row per source here.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighed = totals.withColumn("weight", F.element_at(listed, (place % len(weights) + 1).cast("int")))
    by_level = Window.orderBy(most * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stopped = F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0.0))
    level = (share * F.sum("source_size").over(everything) - stopped) / F.sum("weight").over(onward)
    levels = weighed.withColumn("level", level).withColumn("limit", most * F.col("source_size") / F.col("weight"))
    # The first source in this order that stays below its limit tells the level; if none does, all stop.
    free = F.min(F.when(F.col("level") <= F.col("limit"), F.struct("limit", "level"))).over(everything)["level"]
    return levels.withColumn("free", free).select(
        "source", "source_size",
        F.least(most * F.col("source_size").cast("double"), F.coalesce(F.col("free"), F.col("limit")) * F.col("weight")).alias("target"),
    )


def knapsack(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many pieces of each length bring the sum as near to ``budget`` as it goes without passing it.

    The set of reachable sums is one big integer; pieces of a length are added in powers of two. Walking back
    through the stages tells the counts.
    """
    stages, reachable, mask = [], 1, (1 << (budget + 1)) - 1
    for length, count in sorted(counts.items()):
        if not 0 < length <= budget:
            continue
        left, step = min(count, budget // length), 1
        while left > 0:
            step = min(step, left)
            stages.append((length, step, reachable))
            reachable |= (reachable << (length * step)) & mask
            left -= step
            step *= 2
        if reachable == mask:
            break
    at, taken = reachable.bit_length() - 1, {}
    for length, step, before in reversed(stages):
        if not before >> at & 1:
            at -= length * step
            taken[length] = taken.get(length, 0) + step
    return taken


def fit(counts: dict[int, int], budget: int) -> dict[int, int]:
    """Pieces per length with a sum close to ``budget``: an even share of each, long ones while they fit, then the
    dynamic programme over what is left of the budget. Only pieces longer than ``GAP`` can leave it more than that."""
    total = sum(length * count for length, count in counts.items())
    if total <= budget:
        return dict(counts)
    taken = {length: count * budget // total for length, count in counts.items()}
    gap = budget - sum(length * count for length, count in taken.items())
    for length in sorted((x for x in counts if x), reverse=True):
        # One more piece at most per length keeps the mix even; the programme gets the others.
        more = min(gap // length, counts[length] - taken[length], 1)
        taken[length] += more
        gap -= more * length
    for length in sorted((x for x in counts if x), reverse=True):
        more = max(0, min((gap - GAP) // length, counts[length] - taken[length]))
        taken[length] += more
        gap -= more * length
    for length, more in knapsack({x: counts[x] - taken[x] for x in counts}, gap).items():
        taken[length] += more
    return taken


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    target, size = rows["target"].iloc[0], int(rows["source_size"].iloc[0])
    times = int(target // size) if size else 0
    counts = dict(zip(rows["size"].tolist(), rows["held"].tolist()))
    taken = fit(counts, round(target) - times * size) if size else {}
    return rows.assign(times=times, more=[taken.get(x, 0) for x in rows["size"].tolist()]).drop(columns="held")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """``doc_id, source, text_key, size, source_size, target, copies, taken`` for every row of ``docs``.

    ``docs`` needs ``doc_id``, ``source`` and ``text``; ``copies`` says how often the mix takes the document.
    """
    counted = with_word_counts(docs).select("doc_id", "source", "text_key", F.col("n_words").alias("size"))
    sized = stored(counted, "sizes")
    drawn = F.xxhash64(F.lit(seed), "doc_id", "text_key")
    spread = sized.withColumn("drawn", drawn).withColumn("bucket", F.pmod("drawn", F.lit(BUCKETS)))
    held = spread.groupBy("source", "size", "bucket").agg(F.count("*").alias("held"))
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = stored(held.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0))), "buckets")

    targets = source_targets(sized, weights, share, most)
    lengths = placed.groupBy("source", "size").agg(F.sum("held").alias("held"))
    same = lengths["source"].eqNullSafe(targets["source"])
    known = lengths.join(targets, same).select(lengths["source"], "size", "held", "source_size", "target")
    plan = known.groupBy("source").applyInPandas(
        _fit_source, "source string, size long, source_size long, target double, times long, more long")

    p, q = plan.alias("p"), placed.alias("q")
    cut = q.join(p, F.expr("p.source <=> q.source and p.size = q.size")).select(
        "q.source", "q.size", "q.bucket", F.expr("least(greatest(more - before, 0), held)").alias("more"), "times",
        "source_size", "target")
    # Rows meet the share of their bucket.
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("drawn", "doc_id"))
    s, c = spread.withColumn("rank", rank).alias("s"), cut.alias("c")
    joined = s.join(c, F.expr("s.source <=> c.source and s.size = c.size and s.bucket = c.bucket"))
    return joined.withColumn("copies", F.expr("times + if(rank <= more, 1, 0)")).select(
        "s.doc_id", "s.source", "s.text_key", "s.size", "source_size", "target", "copies",
        (F.col("copies") * F.col("s.size")).alias("taken"))


def take(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them; ``mixed`` is the stored result of :func:`mix` on them."""
    kinds = ["doc_id", "source", "text_key"]
    shares = mixed.groupBy(*kinds).agg(
        F.min("copies").alias("times"), F.max("copies").alias("most"), F.count("*").alias("alike"), F.sum("copies").alias("all"))
    keyed = docs.select(as_row(docs), "doc_id", "source", F.xxhash64("doc_id", "text").alias("text_key")).alias("d")
    s = shares.where("most > 0").alias("s")
    met = keyed.join(s, F.expr("d.text_key = s.text_key and d.doc_id <=> s.doc_id and d.source <=> s.source"))
    single = met.where("alike = 1").select("row", F.col("times").alias("copies"))
    # Rows that look alike to the mix share its choice by number.
    turn = F.row_number().over(Window.partitionBy("d.text_key").orderBy("d.text_key"))
    several = met.where("alike > 1").withColumn("turn", turn).select(
        "row", F.expr("times + if(turn <= all - times * alike, 1, 0)").alias("copies"))
    every = F.explode(F.expr("if(copies > 0, sequence(1L, copies), array())")).alias("copy")
    return single.union(several).select("row", every).select("row.*")
