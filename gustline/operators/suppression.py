"""Repeat suppression: after an emission a key stays silent for a retention time.

Which rows are emitted depends on the previous emission, so the rule is a chain through the
whole history of a key. It is made parallel within a key by cutting time into blocks:

1. the distinct times of each key and block are gathered with a map-side combine,
2. each block reports where a chain would leave it, for every way a chain can enter it,
3. those short reports are passed through in time order, giving each block its entry,
4. each block replays its own chain from that entry.

Times are exact, in microseconds. A block is six hours long; where a key has more different
times in six hours than one task should hold, those six hours are cut into shorter blocks, for
the steps hold for any cut of time. Only step 3 runs in order over a key. It streams one pair
per block where alerts pause for a retention time, and never more than the times of a retention.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from gustline.sources.shared import write_stage

# What identifies a repeat, and for how many seconds it is silenced.
KEYS = ("city", "alert_type", "anomaly")
RETENTION_SECONDS = 1800
ORDER = ("country", "id", "alert_uid")

BLOCK_SECONDS = 6 * 3600
# Different times of a key that one block holds, about; denser stretches get shorter blocks.
BLOCK_TIMES = 1_000_000
SECOND = 1_000_000
NEVER = np.iinfo(np.int64).min // 2


def next_free(times: np.ndarray, retention: int) -> np.ndarray:
    """For each time, the position of the first one that is no repeat of it."""
    return np.searchsorted(times, times + retention, side="left")


def block_exits(times: np.ndarray, block_start: int, retention: int):
    """(until, exit) pairs: a chain free again at or before `until` leaves with `exit`.

    `times` is sorted and distinct. Entries with the same exit share one pair.
    """
    n = len(times)
    jump = np.append(next_free(times, retention), n)
    last = np.where(jump[:-1] < n, jump[:-1], np.arange(n))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    entries = min(int(np.searchsorted(times, block_start + retention, side="left")) + 1, n)
    until, exits = times[:entries], times[last[:entries]]
    keep = np.append(exits[1:] != exits[:-1], True)
    return until[keep], exits[keep]


def replay(times: np.ndarray, free_from: int, retention: int) -> np.ndarray:
    """The emitted times of one block for a chain that is free from `free_from` on."""
    kept = []
    at = int(np.searchsorted(times, free_from, side="left"))
    while at < len(times):
        kept.append(times[at])
        at = int(np.searchsorted(times, times[at] + retention, side="left"))
    return np.array(kept, dtype=np.int64)


def _lengths(keyed: DataFrame, key_names: list[str], block_length: int, block_times: int) -> DataFrame:
    """Add `block`, the start of the block each time lies in."""
    coarse = F.col("at") - F.pmod("at", F.lit(block_length))
    keyed = keyed.withColumn("coarse", coarse)
    counted = keyed.groupBy(*key_names, "coarse").agg(F.approx_count_distinct("at").alias("n"))
    parts = F.pow(F.lit(2), F.ceil(F.log2(F.col("n") / block_times))).cast("bigint")
    cut = F.greatest(F.lit(1), F.floor(F.lit(block_length) / parts)).cast("bigint").alias("cut")
    dense = write_stage(counted.filter(F.col("n") > block_times).select(*key_names, "coarse", cut), "dense")
    if dense.isEmpty():
        return keyed.withColumnRenamed("coarse", "block")
    within = F.pmod(F.col("at") - F.col("coarse"), F.coalesce("cut", F.lit(block_length)))
    joined = keyed.join(dense, [*key_names, "coarse"], "left")
    return joined.withColumn("block", F.col("at") - within).drop("coarse", "cut")


def suppress_repeats(
    rows: DataFrame,
    keys: tuple[str, ...] = KEYS,
    time: str = "alert_time",
    order: tuple[str, ...] = ORDER,
    retention_seconds: int = RETENTION_SECONDS,
    block_seconds: int = BLOCK_SECONDS,
    block_times: int = BLOCK_TIMES,
) -> DataFrame:
    """The rows that are emitted: the first of a key, then the first one at least
    `retention_seconds` after the last emitted one, and so on.

    Of several rows of a key with one time the first by `order` is emitted. Every row without a
    time is emitted, as nothing tells what it repeats. `rows` is read three times; give a written
    table or a cheap plan. Jobs start while the result is built: dense stretches and the emitted
    times are written to the shared folder, so that Spark knows their size before it chooses how
    to join them to the rows.
    """
    block_length = max(block_seconds, retention_seconds) * SECOND
    retention = retention_seconds * SECOND
    key_names = [f"_key{i}" for i in range(len(keys))]
    # Keys as texts that are never null, so that the join and the grouping share one shuffle.
    key_texts = [F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")) for key in keys]
    key_fields = [StructField(name, StringType()) for name in key_names]
    kept_fields = [*key_fields, StructField("_kept_at", LongType())]

    at = F.unix_micros(F.col(time).cast("timestamp"))
    keyed = rows.filter(F.col(time).isNotNull()).select(
        *[text.alias(name) for name, text in zip(key_names, key_texts)], at.alias("at")
    )
    blocks = (
        _lengths(keyed, key_names, block_length, block_times)
        .groupBy(*key_names, "block")
        .agg(F.sort_array(F.collect_set("at")).alias("times"))
    )

    def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            reports = [
                block_exits(np.asarray(times), block, retention)
                for times, block in zip(batch["times"], batch["block"])
            ]
            batch = batch.drop(columns="times")
            yield batch.assign(until=[r[0] for r in reports], exits=[r[1] for r in reports])

    def pass_through(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, last = None, NEVER
        for batch in batches:
            entries = np.empty(len(batch), dtype=np.int64)
            columns = [batch[name] for name in [*key_names, "until", "exits"]]
            for i, (*row_key, until, exits) in enumerate(zip(*columns)):
                if row_key != key:
                    key, last = row_key, NEVER
                entries[i] = last + retention
                found = np.searchsorted(until, last + retention, side="left")
                if found < len(until):
                    last = int(exits[found])
            yield batch.drop(columns=["until", "exits"]).assign(free_from=entries)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = [
                replay(np.asarray(times), free_from, retention)
                for times, free_from in zip(batch["times"], batch["free_from"])
            ]
            emitted = batch[key_names].assign(_kept_at=kept).explode("_kept_at")
            yield emitted.dropna(subset="_kept_at")

    block_fields = [*key_fields, StructField("block", LongType())]
    moments = ArrayType(LongType())
    pairs = StructType([*block_fields]).add("until", moments).add("exits", moments)
    entries = (
        blocks.mapInPandas(report, pairs)
        .repartition(*key_names)
        .sortWithinPartitions(*key_names, "block")
        .mapInPandas(pass_through, StructType([*block_fields, StructField("free_from", LongType())]))
    )
    entered = blocks.join(entries, [*key_names, "block"]).select(*key_names, "times", "free_from")
    kept = write_stage(entered.mapInPandas(emit, StructType(kept_fields)), "kept")

    timed = rows.filter(F.col(time).isNotNull()).withColumns(
        {**dict(zip(key_names, key_texts)), "_kept_at": at}
    )
    # One row per time, by an aggregate with a map-side combine instead of a ranking.
    first_columns = [*order, *[c for c in rows.columns if c not in order]]
    chosen = (
        timed.join(kept, [*key_names, "_kept_at"])
        .groupBy(*key_names, "_kept_at")
        .agg(F.min(F.struct(*first_columns)).alias("first"))
        .select("first.*")
        .select(rows.columns)
    )
    return chosen.unionByName(rows.filter(F.col(time).isNull()))


def last_emissions(kept: DataFrame, keys: tuple[str, ...] = KEYS, time: str = "alert_time") -> DataFrame:
    """The keys of emitted rows and `at`, the time of each one's last emission in microseconds: what a later run must know of them."""
    timed = kept.filter(F.col(time).isNotNull())
    return timed.groupBy(*keys).agg(F.max(F.unix_micros(F.col(time).cast("timestamp"))).alias("at"))
