"""Documents linked by the Jaccard similarity of their word shingles: a grouped prefix join.

Two documents link when ``100 * intersection >= percent * union`` of their sets of distinct
shingles. The result is the connected components of all links, without writing all pairs.

1. Each text becomes a set of 64-bit shingle hashes. Documents with equal sets are one class.
2. Shingles are ordered by the number of classes that hold them, counted over all classes, then by hash. Any
   two linked sets share a shingle among the first ``n - ceil(percent% of n) + 1`` (the prefix) of each. A
   class whose prefix is filled by shingles that no other class holds has no link at all and leaves. This
   is done twice: first with counts for the shingles in the lowest quarter of the hash range, placed first in
   the order, which lets most classes leave at a quarter of the cost; then for all shingles of the rest.
3. Classes with the same size and the same prefix form a group. Groups that share a prefix shingle meet;
   the sizes filter them, and then the members are expanded and verified on their full sets.
   First every group meets one chosen group per shingle and size band, and every member the first member
   of its group; outsiders then try further members of the largest component. These pairs grow with the rows.
   What is linked by then needs no further pairs. Afterwards all remaining pairs of groups of different
   components meet, so no link that matters to a component is lost. Per shingle, the largest component only
   meets the others.

Edge cases: a null or empty text has the empty set and links with nothing; fewer words than a shingle
give one shingle of the whole sequence; repeated rows and equal texts share a class and so a component; a
null id takes part, and a component shows the smallest id that is not null (null if there is none).
Hashes have 64 bits: two different classes or shingles may be taken for one with a chance of about
(number of them)^2 / 2^65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import (
    WordHashes, as_row, components, few, lower_words, run_batches, stored, windows_hash,
)

COUNTED = np.uint64(1 << 62)  # a quarter of the number range
EMPTY_CLASS = 0
TURNS = 2  # rounds of single partners before the rest meets in full


def shingle_set(text: str | None, words: int, memory: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; of the whole text if it has fewer."""
    hashes = memory.array(lower_words(text))
    if len(hashes) == 0:
        return hashes
    return np.unique(windows_hash(hashes, min(words, len(hashes))))


def class_of(members: np.ndarray) -> int:
    """Signed 64-bit name of a set; 0 is kept for the empty set."""
    if len(members) == 0:
        return EMPTY_CLASS
    value = xxhash.xxh3_64_intdigest(members.tobytes()) | 1
    return value - (1 << 64) if value >= 1 << 63 else value


def _read_sets(words: int):
    """Row function: size, class and counted part of each set."""

    def rows(batches):
        memory = WordHashes()
        for batch in batches:
            out = {"doc_id": batch["doc_id"], "text_key": batch["text_key"], "n": [], "c": [], "counted": []}
            for text in batch["text"]:
                found = shingle_set(text, words, memory)
                out["n"].append(len(found))
                out["c"].append(class_of(found))
                out["counted"].append(found[: np.searchsorted(found, COUNTED)].view(np.int64))
            yield out

    return rows


def _read_full_sets(words: int):
    """Row function: the full set of each text."""

    def rows(batches):
        memory = WordHashes()
        for batch in batches:
            yield {
                "c": batch["c"], "alike": batch["alike"],
                "members": [shingle_set(text, words, memory).view(np.int64) for text in batch["text"]],
            }

    return rows


def _verify(percent: int):
    """Arrow function: the pairs whose full sets link."""

    def rows(batches):
        for batch in batches:
            sets = []
            for name in ("x", "y"):
                column = batch.column(name)
                sets.append((column.values.to_numpy(), column.offsets.to_numpy()))
            (x, i), (y, j) = sets
            keep = []
            for row in range(batch.num_rows):
                one, other = x[i[row] : i[row + 1]], y[j[row] : j[row + 1]]
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct (a, b) pairs that link, stored."""
    left = sets.select(F.col("c").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("c").alias("b"), F.col("members").alias("y"))
    met = right.join(few(stored(pairs.select("a", "b").where("a <> b").distinct(), "pairs"), 24), "b").join(left, "a")
    return stored(met.select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long"), "links")


def _fits(percent: int) -> str:
    """Sizes that can reach the similarity, with enough shingles left from the shared one on.

    At the first shingle that two sets share, all others they share come later in both. So a pair that links passes
    here at its first shared shingle.
    """
    return (
        f"100 * least(n1, n) >= {percent} * greatest(n1, n)"
        f" and (100 + {percent}) * (1 + least(n1 - at1, n - at)) >= {percent} * (n1 + n)"
    )


def _shared(held: DataFrame, name: str) -> DataFrame:
    """Rows ``c, s, df`` of the shingles that several classes hold, with their number of classes."""
    counts = held.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    return stored(held.join(counts, "s").select("c", "s", "df"), name)


def _left(sizes: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Classes whose prefix reaches a shared shingle: ``c, n``, how many unshared ones stand first
    (``alone``) and how many shared ones the prefix takes (``want``)."""
    hits = shared.groupBy("c").agg(F.count("*").alias("hits"))
    return (
        sizes.join(hits, "c", "left")
        .withColumn("alone", F.expr("size - coalesce(hits, 0)"))
        .withColumn("want", F.expr(f"n - cast(ceil({percent} * n / 100) as int) + 1 - alone"))
        .where("want > 0").select("c", "n", "alone", "want")
    )


def link_classes(docs: DataFrame, words: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, text_key, n, c`` and components ``node, label`` of the classes that have links.

    ``docs`` needs ``doc_id`` and ``text``.
    """
    own = docs.select("doc_id", "text", F.md5("text").alias("text_key"))
    read = stored(run_batches(own, _read_sets(words),
                              "doc_id long, text_key string, n long, c long, counted array<bigint>"), "sets")
    rows = read.select("doc_id", "text_key", "n", "c")

    # One row per class, with its counted shingles; copies leave before anything is counted.
    copies = read.where("n > 0").groupBy("c").agg(F.count("*").alias("k"))
    several = few(stored(copies.where("k > 1").select("c"), "copied"), 16)
    once = read.where("n > 0").join(several, "c", "left_anti").select("c", "n", "counted")
    others = (
        read.where("n > 0").join(several, "c", "left_semi")
        .groupBy("c").agg(F.max("n").alias("n"), F.max("counted").alias("counted"))
    )
    classes = once.union(others)
    shared = _shared(classes.select("c", F.explode("counted").alias("s")), "counted")
    near = stored(_left(classes.select("c", "n", F.size("counted").alias("size")), shared, percent), "near")

    # The same over the full sets of the classes that are left, each read from one of its texts.
    texts = (
        rows.where("n > 0").join(near.select("c"), "c", "left_semi")
        .groupBy("c", "text_key").agg(F.count("*").alias("alike"))
        .groupBy("c").agg(F.min_by(F.struct("text_key", "alike"), "text_key").alias("one"))
    )
    wanted = few(stored(texts.select("c", "one.*"), "wanted"), 80)
    full = own.select("text", "text_key").join(wanted, "text_key")
    read_again = stored(
        run_batches(full.select("c", "text", "alike"), _read_full_sets(words),
                    "c long, members array<bigint>, alike long"), "full")
    sets = read_again.where("alike = 1").union(
        read_again.where("alike > 1").dropDuplicates(["c"])).select("c", "members")
    shared = stored(_shared(sets.select("c", F.explode("members").alias("s")), "members"), "shared")
    sizes = sets.select("c", F.size("members").cast("long").alias("n"), F.size("members").alias("size"))
    left = stored(_left(sizes, shared, percent), "left")

    # Prefix shingles with their 1-based places in the global order; those that nobody shares stand first.
    order = Window.partitionBy("c").orderBy("df", "s")
    tokens = stored(
        shared.join(left, "c")
        .withColumn("at", F.row_number().over(order)).where("at <= want")
        .select("c", "s", "n", "alone", (F.col("at") + F.col("alone")).alias("at")), "tokens")
    groups = tokens.groupBy("c", "n").agg(F.sort_array(F.collect_list("s")).alias("prefix"))
    members = stored(groups.select("c", "n", F.xxhash64("prefix", "n").alias("g")), "groups")
    prefixes = stored(tokens.join(members.select("c", "g"), "c"), "prefixes")
    full_sets = sets.join(few(members.select("c"), 16), "c", "left_semi")

    # First pairs, in proportion to the rows: members with the first of their group, groups with one per shingle.
    band = F.floor(F.log(F.col("n")) / F.lit(float(np.log(100 / percent)))).cast("long")
    prefixes = prefixes.withColumn("band", band)
    first = members.groupBy("g").agg(F.min("c").alias("a"))
    leaders = prefixes.groupBy("s", "g", "band", "alone").agg(F.min("c").alias("b"))
    # A text with few shingles of its own is likely the source of the others.
    chosen = leaders.groupBy("s", "band").agg(F.min_by("b", F.struct("alone", F.xxhash64("g"))).alias("a"))
    stars = members.join(first, "g").select("a", F.col("c").alias("b")).union(
        leaders.join(chosen, ["s", "band"]).select("a", "b"))
    edges = _linked(stars, full_sets, percent)
    labels = stored(components(edges), "labels")

    # Pairs of different components that still meet. Each class outside the largest component of a shingle
    # first tries other members of that component, again in proportion to the rows.
    for turn in range(1, TURNS + 1):
        meeting = _meeting(prefixes, labels)
        partner = meeting.where("label = main").groupBy("s", "band").agg(
            F.min_by("c", F.struct("alone", F.xxhash64("g", F.lit(turn)))).alias("a"))
        tries = meeting.where("label <> main").select(
            "s", F.explode(F.expr("array(band - 1, band, band + 1)")).alias("band"), F.col("c").alias("b"))
        edges = edges.union(_linked(tries.join(partner, ["s", "band"]), full_sets, percent))
        labels = stored(components(edges), "labels")
    meeting = _meeting(prefixes, labels)

    # All that is left, exactly: groups are filtered, then their members verified.
    small = meeting.where("label <> main").select("s", *[F.col(x).alias(f"{x}1") for x in ("g", "n", "at", "label")])
    pairs = (
        small.join(meeting.drop("main"), "s")
        .where(f"label1 <> label and {_fits(percent)}")
        .select("g1", "label1", "g", "label").distinct()
    )
    whole = members.join(labels.withColumnRenamed("node", "c"), "c", "left").select(
        "c", "g", F.coalesce("label", "c").alias("label"))
    expanded = (
        pairs.join(whole, ["g", "label"]).withColumnRenamed("c", "b").drop("g", "label")
        .join(whole.select(F.col("g").alias("g1"), F.col("label").alias("label1"), F.col("c").alias("a")), ["g1", "label1"])
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    # Members of one group whose component differs share their whole prefix and so are among the pairs.
    more = _linked(expanded, full_sets, percent)
    return rows, (stored(components(edges.union(more)), "final") if more.limit(1).count() else labels)


def _meeting(prefixes: DataFrame, labels: DataFrame) -> DataFrame:
    """Groups and components per prefix shingle that joins several components, with its largest one (``main``)."""
    known = prefixes.join(labels.withColumnRenamed("node", "c"), "c", "left").withColumn(
        "label", F.coalesce("label", "c"))
    blocks = known.groupBy("s", "g", "n", "at", "band", "alone", "label").agg(F.count("*").alias("k"), F.min("c").alias("c"))
    sides = blocks.groupBy("s", "label").agg(F.sum("k").alias("k"))
    largest = (
        sides.groupBy("s")
        .agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.count("*").alias("sides"))
        .where("sides > 1").drop("sides")
    )
    return stored(blocks.join(largest, "s"), "meeting")


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """One row per document: ``doc_id, text_key, n_shingles, component, component_id``.

    ``component`` names the group (null for texts without words, which link with nothing);
    ``component_id`` is its smallest id.
    """
    rows, labels = link_classes(docs, words, percent)
    named = (
        rows.join(labels.withColumnRenamed("node", "c"), "c", "left")
        .withColumn("component", F.expr(f"if(c = {EMPTY_CLASS}, null, coalesce(label, c))"))
    )
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("least")).where("component is not null")
    return named.join(smallest, "component", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"), "component",
        F.expr("if(component is null, doc_id, least)").alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` of which each stands for its group of near duplicates; columns stay as they are.

    The row with the smallest id stays (then the smallest text digest; null ids last). Rows without
    words link with nothing and all stay. Of repeated rows one stays.
    """
    found = stored(near_duplicates(docs, words, percent), "grouped")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("text_key").alias("c"))
    grouped = found.where("component is not null").withColumn("rank", order)
    best = grouped.groupBy("component").agg(
        F.min("rank").alias("best"), F.count("*").alias("size")).where("size > 1")
    marked = grouped.join(best, "component").select(
        "doc_id", "text_key", F.col("rank").eqNullSafe(F.col("best")).alias("stays"))
    # One entry per (id, text): dropped, or staying with how many rows look alike.
    keys = marked.groupBy("doc_id", "text_key").agg(F.max("stays").alias("stays"), F.count("*").alias("rows"))
    acted = few(stored(keys.where("not stays or rows > 1").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "stays"), "acted"), 80)
    named = docs.select(as_row(docs), "doc_id", F.md5("text").alias("text_key"))
    same = named["doc_id"].eqNullSafe(acted["_id"]) & (named["text_key"] == acted["_key"])
    untouched = named.join(acted, same, "left_anti").select("row.*")
    alike = named.join(acted.where("stays"), same, "left_semi")
    one = alike.dropDuplicates(["doc_id", "text_key"]).select("row.*")
    return untouched.union(one)
