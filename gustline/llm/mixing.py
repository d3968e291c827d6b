"""Mixtures of sources with target weights, dealt to output shards by a splitting tree."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gustline.llm.text import record, spaced_words, texts
from gustline.sources.shared import write_stage

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source's target is at most so many times its size, and so often is a document taken at most.
MOST_COPIES = 3
#: Documents of a block, about, and most blocks of a source (more documents make larger blocks). Blocks are what the tree deals.
BLOCK_DOCS, MOST_BLOCKS = 200, 65_536
#: The table of sources (name, size, target) goes through the driver and to all tasks, up to so many.
MOST_SOURCES = 200_000
#: Words of a shard, about; least number of shards; parts of a shard that are sorted apart.
SHARD_WORDS, LEAST_SHARDS, SHARD_PIECES = 100_000_000, 16, 16
SEED = 17
#: Stands for a null id in joins.
NO_ID = -(2**63)


def word_sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, digest, source, size): words [^\\x20\\x09-\\x0D]+ of each whole text, 0 for null."""
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("source", pa.string()), ("size", pa.int64())])

    def each(batches):
        for batch in batches:
            sizes = [len(spaced_words(t)) for t in batch.column(1).to_pylist()]
            yield record(schema, batch.column(0), batch.column(3), batch.column(2), sizes)

    read = texts(docs, id_col, text_col, F.col(source_col).cast("string").alias("source"), F.xxhash64(F.col(text_col).cast("string")))
    return read.mapInArrow(each, "doc_id long, digest long, source string, size long")


def targets(sizes: list[int], weights: list[float], most: int = MOST_COPIES) -> list[float]:
    """Shares of the total size by weight; what is over `most` times a source's size goes to the others."""
    found, free, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / total > most * sizes[i]]
        if not full:
            for i in free:
                found[i] = left * weights[i] / total
            break
        for i in full:
            found[i] = float(most * sizes[i])
        left -= sum(found[i] for i in full)
        free = sorted(set(free) - set(full))
    return found


def split_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Numbers of blocks by shard and source.

    A node holds a number of each source's blocks and splits it between its two halves of the shards: the left
    half gets its share of the node's blocks, and of which sources they are is a multivariate
    hypergeometric draw. So the leaves hold all blocks exactly, and each is a fair sample.
    """
    out = np.zeros((shards, len(quotas)), np.int64)
    nodes = [(0, shards, np.asarray(quotas, np.int64))]
    while nodes:
        first, last, pool = nodes.pop()
        if last - first == 1:
            out[first] = pool
            continue
        middle = (first + last) // 2
        take = int(pool.sum()) * (middle - first) // (last - first)
        draw = np.random.default_rng([seed, first, last])
        left = draw.multivariate_hypergeometric(pool, take, method="marginals") if take else np.zeros_like(pool)
        nodes += [(first, middle, left), (middle, last, pool - left)]
    return out


def _sources(rows: list[tuple], weights) -> list[tuple]:
    """Of (source, size, n): source, size, target, blocks, whole rounds and the words that the last round is to take."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or ""))
    goals = targets([r[1] for r in rows], [float(weights[i % len(weights)]) for i in range(len(rows))])
    known = []
    for (source, size, n), goal in zip(rows, goals):
        rounds = int(goal // size) if size else 0
        known.append((source, size, goal, min(MOST_BLOCKS, -(-n // BLOCK_DOCS)), rounds, goal - rounds * size))
    return known


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=WEIGHTS, shards: int | None = None, seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, digest, size, source_size, target and places, the (round, shard) of each time it is taken.

    Each source's documents fall, by hashes, into blocks and into an order within their block; the
    blocks are put in order by another hash. A round takes a source's blocks in that order; the
    last round stops where the target is reached, in one block, whose documents are taken while the
    running sum of their words, to the middle of a document, is below what is missing. So a source
    misses its target by less than a document. The blocks of all rounds, in their order, are cut among the
    shards by the exact quotas of `split_tree`. Sums run over blocks and within single blocks, so no task
    holds the documents of a source.

    Sources are in order of code points, null last and a source of its own. An empty table gives no
    rows. Reruns agree. Rows with equal id and text are drawn alike, but for the block where the last round stops.
    Starts jobs while it is built.
    """
    spark = docs.sparkSession
    name = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    sized = write_stage(word_sizes(docs, id_col, text_col, source_col).withColumn("name", name), "sizes")
    rows = [tuple(r) for r in sized.groupBy("source").agg(F.sum("size"), F.count("*")).limit(MOST_SOURCES + 1).collect()]
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    known = _sources(rows, weights)
    named = [("n" if k[0] is None else f"s{k[0]}", *k[1:]) for k in known]
    table = spark.createDataFrame(named, "name string, source_size long, target double, blocks long, rounds int, rest double")

    def drawn(salt: int, *columns):
        return F.xxhash64(F.lit(seed * 10 + salt), *columns)

    placed = sized.join(F.broadcast(table.select("name", "blocks")), "name").select(
        "doc_id", "digest", "size", "name",
        F.pmod(drawn(1, "name", "doc_id", "digest"), "blocks").alias("block"), drawn(2, "name", "doc_id", "digest").alias("draw"),
    )
    order = Window.partitionBy("name").orderBy(drawn(3, "name", "block"), "block")
    blocks = placed.groupBy("name", "block").agg(F.sum("size").alias("words")).join(F.broadcast(table), "name")
    blocks = blocks.withColumn("rank", F.row_number().over(order) - 1).withColumn("before", F.sum("words").over(order) - F.col("words"))
    blocks = blocks.withColumn("extra", F.col("before") < F.col("rest"))
    blocks = write_stage(blocks, "blocks")

    found = {r[0]: (r[1], r[2]) for r in blocks.groupBy("name").agg(F.count("*"), F.count_if("extra")).collect()}
    total = sum(k[1] for k in known)
    shards = shards or max(LEAST_SHARDS, -(-total // SHARD_WORDS))
    quotas = [n[4] * found[n[0]][0] + found[n[0]][1] for n in named]
    ends = np.cumsum(split_tree(np.array(quotas, np.int64), shards, seed), axis=0) if quotas else None
    cuts = [(n[0], found[n[0]][0], [int(x) for x in ends[:, s]]) for s, n in enumerate(named)]
    blocks = blocks.join(spark.createDataFrame(cuts, "name string, filled long, ends array<long>"), "name")

    def place(round_):
        at = round_ * F.col("filled") + F.col("rank")
        return F.struct(round_.cast("int").alias("round"), F.size(F.filter("ends", lambda e: e <= at)).alias("shard"))

    whole = F.when(F.col("rounds") > 0, F.transform(F.sequence(F.lit(0), F.col("rounds") - 1), place))
    blocks = blocks.select(
        "name", "block", "source_size", "target", "extra", (F.col("rest") - F.col("before")).alias("missing"),
        F.coalesce(whole, F.array().cast("array<struct<round:int,shard:int>>")).alias("whole"), place(F.col("rounds")).alias("last"),
    )
    inside = Window.partitionBy("name", "block").orderBy("draw", "doc_id", "digest").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.sum("size").over(inside) - F.col("size") / 2
    joined = placed.join(blocks, ["name", "block"]).withColumn("middle", middle)
    taken = F.col("extra") & (F.col("middle") < F.col("missing"))
    return joined.select(
        "doc_id", "digest", "size", "source_size", "target",
        F.when(taken, F.array_append("whole", F.col("last"))).otherwise(F.col("whole")).alias("places"),
    )


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, and the words that the mix takes of it, repeats counted."""
    taken = (F.col("size") * F.size("places")).alias("taken")
    return mix_plan(docs, **options).select("doc_id", "size", "source_size", "target", taken)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, **options) -> DataFrame:
    """The mix: all columns of each document as often as it is taken, with mix_shard, mix_round and mix_order.

    Read by mix_order, a shard is in random order; pieces of shards are sorted so where they lie. Rows with equal id and
    text are taken in equal numbers, those of the one drawn most.
    """
    plan = mix_plan(docs, id_col, text_col, source_col, seed=seed, **options)
    plan = plan.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.col("digest").alias("__digest")).agg(
        F.max_by("places", F.size("places")).alias("__places")
    )
    keyed = docs.withColumn("__id", F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)))
    keyed = keyed.withColumn("__digest", F.xxhash64(F.col(text_col).cast("string")))
    copies = keyed.join(plan, ["__id", "__digest"]).withColumn("__place", F.explode("__places"))
    order = F.xxhash64(F.lit(seed), "__place", "__id", "__digest")
    mixed = copies.select(
        *docs.columns, F.col("__place.shard").alias("mix_shard"), F.col("__place.round").alias("mix_round"), order.alias("mix_order")
    )
    piece = F.pmod("mix_order", F.lit(SHARD_PIECES))
    return mixed.repartition("mix_shard", piece).sortWithinPartitions("mix_shard", "mix_order")
