"""Connected components of a graph given as pairs of longs, and links among members of shared buckets."""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gustline.sources.shared import write_stage


def _written(pairs: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct pairs as a written table, and their number and sum of hashes, taken on the way."""
    seen = Observation()
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("total")
    table = write_stage(pairs.distinct().observe(seen, F.count("*").alias("n"), total), "edges")
    return table, (seen.get["n"], seen.get["total"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of `edges` (a, b); component is the smallest id reachable.

    Large-star and small-star steps in turn (each node's neighbours are tied to the least of
    them) until the edges stay as they are, which are then stars around the components' least
    ids. Every step is an aggregation, combined before its shuffle, and a join whose hot keys
    adaptive execution can split; the number of edges never grows. Each round is written to the
    shared folder, which cuts the lineage. Edges with a null or with equal ends are left out; no
    edges give no rows.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    pairs = pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    (pairs, mark), before = _written(pairs), None
    while mark[0] and mark != before:
        before = mark
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs, mark = _written(small.union(least.select("a", F.col("m").alias("b"))))
    stars = pairs.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.union(pairs.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


#: Longs of a map of bits, and so most rows of it.
MAP_SLOTS = 2**18


def marked(frame: DataFrame, used: DataFrame, *keys: str) -> DataFrame:
    """The rows whose keys may be among those of `used`: all that are, and few others while `used` is
    small. The map of 16 million bits that tells is sent to all tasks; it has one size for every input."""
    place = F.xxhash64(*keys)
    slot, bit = F.shiftright(place, 6).bitwiseAND(F.lit(MAP_SLOTS - 1)), place.bitwiseAND(F.lit(63)).cast("int")
    marks = used.select(slot.alias("__slot"), bit.alias("__bit")).distinct()
    marks = marks.groupBy("__slot").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__marks"))
    likely = frame.withColumn("__slot", slot).withColumn("__bit", bit).join(F.broadcast(marks), "__slot")
    return likely.where(F.expr("(shiftright(__marks, __bit) & 1L) = 1L")).drop("__slot", "__bit", "__marks")


def bucket_components(members: DataFrame, near: Column, check=None, details=None, nearer: Column | None = None, every: DataFrame | None = None) -> DataFrame:
    """(id, component) of the members that some link ties to another member.

    `members` has a row (key, id, bits) for each bucket a member is in; it may have it more than once. Two members are linked if
    they share a bucket, `near` holds for the bits `x` and `y`, and `check`, which filters pairs
    (a, b), lets the pair through. A bucket's pairs are not all looked at: first each member meets the least
    member of its bucket only, then those of one bucket meet that are not in one component
    yet and were not checked before. So a bucket of copies costs its size, and no link that changes a component is lost.
    `every` (id, bits, keys) has all buckets of each member, where `members` has some of them only: the first part takes those of
    `members`, the second part all. `details` (id, detail; rows with one id are alike), or what it returns for a table of ids, is
    fetched for those of the second part only. `nearer`, which must hold for
    the bits and the details `p` and `q` of all pairs that `check` lets through, then leaves out most other pairs in the join, each
    pair in one of the buckets it shares; `near` must then be the same for x and y as for y and x.
    """
    # Most buckets hold one member. They are told by keys and ids alone, before whole rows are shuffled.
    shared = members.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    shared = write_stage(shared.select("key"), "shared-keys")
    members = write_stage(marked(members, shared, "key").join(shared, "key").distinct(), "members")
    heads = members.groupBy("key").agg(F.min(F.struct("id", "bits")).alias("head"))
    met = members.join(heads, "key").select(
        F.col("id").alias("a"), F.col("head.id").alias("b"), F.col("bits").alias("x"), F.col("head.bits").alias("y")
    )
    met = met.where((F.col("a") != F.col("b")) & near).select("a", "b").distinct()
    tried = write_stage(met, "tried") if check else None
    first = write_stage(components(check(tried) if check else met), "components")

    known = (members if every is None else every).join(first, "id", "left").withColumn("c", F.coalesce("component", "id"))
    known = known.select("key" if every is None else F.explode("keys").alias("key"), "id", "bits", "c")
    mixed = known.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("key")
    if every is None:
        left = known.join(mixed, "key", "left_semi")
    else:
        mixed = write_stage(mixed, "mixed-keys")
        left = write_stage(marked(known, mixed, "key").join(mixed, "key").distinct(), "mixed")
    pair = (F.col("c") < F.col("d")) & near
    if details is not None:
        # Rows that are near no other of their bucket need no details; a semi join tells them without making pairs.
        other = left.select(F.col("key").alias("other"), F.col("bits").alias("y"), F.col("c").alias("d"))
        own = left.select("key", "id", F.col("bits").alias("x"), "c")
        own = own.join(other, (F.col("key") == F.col("other")) & (F.col("c") != F.col("d")) & near, "left_semi")
        left = write_stage(own.select("key", "id", F.col("x").alias("bits"), "c"), "unlinked")
        told = details(left.select("id").distinct()) if callable(details) else marked(details, left, "id")
        told = told.groupBy("id").agg(F.first("detail").alias("detail"))
        left = left.join(left.groupBy("id").agg(F.collect_set("key").alias("keys")).join(told, "id"), "id")
        pair = pair & (F.col("key") == F.array_min(F.array_intersect("keys", "others")))
    else:
        left = left.withColumns({"detail": F.lit(None), "keys": F.lit(None)})
    if check:
        # What a least member met without a link is not checked again.
        again = tried.groupBy(F.col("a").alias("id")).agg(F.collect_set("b").alias("met"))
        left = left.join(again, "id", "left").withColumn("met", F.coalesce("met", F.array().cast("array<long>")))
        pair = pair & ~F.array_contains("met", F.col("b")) & ~F.array_contains("met_by", F.col("a"))
    else:
        left = left.withColumn("met", F.lit(None))
    if details is not None:
        pair = pair & nearer
    right = left.select("key", F.col("id").alias("b"), F.col("bits").alias("y"), F.col("c").alias("d"), F.col("detail").alias("q"), F.col("keys").alias("others"), F.col("met").alias("met_by"))
    left = left.select("key", F.col("id").alias("a"), F.col("bits").alias("x"), "c", F.col("detail").alias("p"), "keys", "met")
    met = left.join(right, "key").where(pair).select("a", "b", "c", "d").distinct()
    met = write_stage(met, "pairs")
    kept = check(met.select("a", "b")) if check else met.select("a", "b")
    merged = components(met.join(kept, ["a", "b"], "left_semi").select(F.col("c").alias("a"), F.col("d").alias("b")))
    merged = merged.select(F.col("id").alias("component"), F.col("component").alias("root"))
    nodes = first.select("id", "component").union(
        merged.join(first, merged.component == first.id, "left_anti").select("component", F.col("component").alias("c"))
    )
    return nodes.join(merged, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
