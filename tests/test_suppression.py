from datetime import datetime, timedelta

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gustline.operators.suppression import NEVER, block_exits, replay, suppress_repeats

DAY = datetime(2024, 3, 1)
LAYOUT = ("city STRING, country STRING, alert_type STRING, anomaly STRING, alert_time TIMESTAMP, "
          "id BIGINT, alert_uid BIGINT")


def chain(seconds, retention):
    kept, last = [], None
    for t in sorted(seconds):
        if last is None or t >= last + retention:
            kept.append(t)
            last = t
    return kept


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(-500, 4000), min_size=1, max_size=200), st.integers(1, 120),
       st.integers(0, 300))
def test_blocks_compose_to_the_chain(seconds, retention, extra):
    """Entering each block with what the blocks before report gives the naive chain."""
    length = retention + extra
    last, kept = NEVER, []
    for start in range(-600 // length * length, 4001, length):
        times = np.array(sorted(t for t in seconds if start <= t < start + length), dtype=np.int64)
        if not len(times):
            continue
        kept.extend(replay(times, last + retention, retention).tolist())
        until, exits = block_exits(times, start, retention)
        assert len(until) <= retention + 1
        found = np.searchsorted(until, last + retention)
        if found < len(until):
            last = int(exits[found])
    assert kept == chain(seconds, retention)


def rows(spark, items):
    """Items are (second, changes to the default key)."""
    default = dict(city="Ha Noi", country="VN", alert_type="threshold", anomaly="temp_anomaly", id=1)
    made = []
    for second, changes in items:
        r = {**default, **changes}
        at = None if second is None else DAY + timedelta(seconds=second)
        made.append((r["city"], r["country"], r["alert_type"], r["anomaly"], at, r["id"], r["id"]))
    return spark.createDataFrame(made, LAYOUT)


def seconds_of(frame):
    return sorted(int((r.alert_time - DAY).total_seconds()) for r in frame.collect())


def test_retention_edges(spark):
    for gap, kept in [(1799, [0]), (1800, [0, 1800]), (1801, [0, 1801])]:
        assert seconds_of(suppress_repeats(rows(spark, [(0, {}), (gap, {})]))) == kept


def test_fractions_of_a_second_count(spark):
    for first, second, n in [(0.9, 1800.2, 1), (0.2, 1800.2, 2), (0.2, 1800.199999, 1), (0.0, 1799.3, 1)]:
        assert suppress_repeats(rows(spark, [(first, {}), (second, {})])).count() == n


def test_dense_stretches_get_shorter_blocks(spark):
    """The same result when a block may hold few times, and for each way to cut them."""
    times = [i * 37.5 + (i % 7) / 10 for i in range(900)]
    frame = rows(spark, [(t, dict(id=i)) for i, t in enumerate(times)])
    whole = sorted(r.id for r in suppress_repeats(frame).collect())
    assert whole == [times.index(t) for t in chain(times, 1800)]
    for block_times in (2, 50):
        assert sorted(r.id for r in suppress_repeats(frame, block_times=block_times).collect()) == whole


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rows_are_shuffled_once(spark):
    """Without broadcasts the wide rows meet what is kept by an inner join, whose shuffle the grouping uses too."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(suppress_repeats(rows(spark, [(0, {}), (10, {})])))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "LeftOuter" not in plan and "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_repeat_does_not_extend_the_silence(spark):
    assert seconds_of(suppress_repeats(rows(spark, [(0, {}), (1700, {}), (1900, {})]))) == [0, 1900]


def test_the_key_leaves_the_country_out(spark):
    items = [(0, dict(country="VN", id=5)), (10, dict(country="US", id=4)),
             (0, dict(anomaly="wind_anomaly")), (0, dict(alert_type="change"))]
    kept = suppress_repeats(rows(spark, items))
    assert kept.count() == 3
    assert kept.filter("country = 'US'").count() == 0


def test_one_row_of_equal_times(spark):
    items = [(0, dict(country="VN", id=9)), (0, dict(country="US", id=9)), (0, dict(country="US", id=2))]
    kept = suppress_repeats(rows(spark, items)).collect()
    assert [(r.country, r.id) for r in kept] == [("US", 2)]


def test_null_city_is_a_key_and_null_time_is_kept(spark):
    items = [(0, dict(city=None)), (5, dict(city=None)), (0, {}), (None, dict(id=7)), (None, dict(id=8))]
    kept = suppress_repeats(rows(spark, items)).collect()
    assert sorted((r.city or "", r.alert_time is None, r.id) for r in kept) == [
        ("", False, 1), ("Ha Noi", False, 1), ("Ha Noi", True, 7), ("Ha Noi", True, 8)]


def test_hot_key_over_many_blocks(spark):
    """One key holds most rows, without a pause; the others are sparse."""
    hot = spark.range(200_000).select(
        F.lit("hot").alias("city"), F.pmod(F.xxhash64("id"), F.lit(400_000)).alias("second"))
    sparse = spark.range(3_000).select(
        F.concat(F.lit("c"), F.col("id") % 7).alias("city"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(400_000)).alias("second"))
    frame = hot.unionByName(sparse).select(
        "city", F.lit("VN").alias("country"), F.lit("threshold").alias("alert_type"),
        F.lit("temp_anomaly").alias("anomaly"), F.timestamp_seconds("second").alias("alert_time"),
        F.lit(1).cast("bigint").alias("id"), F.lit(1).cast("bigint").alias("alert_uid"))
    given_seconds, kept_seconds = {}, {}
    for r in frame.select("city", F.unix_seconds("alert_time").alias("s")).collect():
        given_seconds.setdefault(r.city, set()).add(r.s)
    kept = suppress_repeats(frame)
    for r in kept.select("city", F.unix_seconds("alert_time").alias("s")).collect():
        kept_seconds.setdefault(r.city, []).append(r.s)
    assert {c: sorted(s) for c, s in kept_seconds.items()} == {
        c: chain(s, 1800) for c, s in given_seconds.items()}
    assert suppress_repeats(kept).count() == kept.count()
