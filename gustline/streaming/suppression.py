"""Repeat suppression as keyed state."""

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructType

from gustline.operators.suppression import KEYS, NEVER, ORDER, RETENTION_SECONDS, SECOND, replay

CLOCKS = ("event", "processing")


# Microseconds since the epoch, made by Spark: pandas has times as clocks of the session's zone show them.
# (Names with a leading underscore do not reach the state processor.)
AT = "suppression_at"
# The same time for the watermark, which wants a timestamp.
MARK = "suppression_time"
OWN = [AT, MARK]
# Where state expires, keys are held in so many buckets by hash; a checkpoint keeps its number for life.
BUCKET, BUCKETS = "suppression_bucket", 1024


def _key_names(keys: list[str]) -> list[str]:
    return [f"suppression_key{i}" for i in range(len(keys))]


def first_per_time(rows: pd.DataFrame, keys: list[str], order: list[str]) -> pd.DataFrame:
    """Timed rows in order, without those that repeat a key at its time."""
    timed = rows[rows[AT].notna()].sort_values([AT, *order], ignore_index=True)
    return timed[~timed[[*keys, AT]].duplicated()]


def timed_rows(rows: Iterator[pd.DataFrame], keys: list[str], order: list[str], own: list[str]):
    """Yields the rows without a time, and returns the others in order, one per key and time.

    What is held grows with the distinct times of the trigger, not with its rows.
    """
    held, waiting, n_waiting = pd.DataFrame(), [], 0

    def compact() -> pd.DataFrame:
        if not waiting:
            return held
        together = pd.concat([held, *waiting] if len(held) else waiting, ignore_index=True)
        return first_per_time(together, keys, order)

    for batch in rows:
        untimed = batch[batch[AT].isna()]
        if len(untimed):
            yield untimed.drop(columns=own)
        waiting.append(batch)
        n_waiting += len(batch)
        if n_waiting >= len(held):
            held = compact()
            waiting, n_waiting = [], 0
    return compact()


class _Repeats(StatefulProcessor):
    """Keeps one number per key: the time of its last emission in microseconds."""

    def __init__(self, order: list[str], retention_seconds: int, clock: str):
        self.order, self.retention_seconds, self.clock = order, retention_seconds, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = self.retention_seconds * 1000 if self.clock == "processing" else None
        self.last = handle.getValueState("last", StructType().add("at", LongType()), ttl)

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        self.last.update((int(initialState["at"].max()),))

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        if self.clock == "processing":
            # Spark drops the state when its time to live has passed.
            free = not self.last.exists()
            for batch in rows:
                if free and len(batch):
                    self.last.update((timerValues.getCurrentProcessingTimeInMs(),))
                    yield batch.head(1).drop(columns=OWN)
                    free = False
            return
        held = yield from timed_rows(rows, [], self.order, OWN)
        if not len(held):
            return
        times, retention = held[AT].astype("int64").to_numpy(), self.retention_seconds * SECOND
        free_from = self.last.get()[0] + retention if self.last.exists() else NEVER
        kept = replay(times, free_from, retention)
        if len(kept):
            self.last.update((int(kept[-1]),))
            yield held.iloc[times.searchsorted(kept, side="left")].drop(columns=OWN)

    def close(self) -> None:
        pass


class _ExpiringRepeats(StatefulProcessor):
    """Keeps a list per bucket of keys: the texts of each live key and the time of its last emission in microseconds.

    Calls to the state cost far more than rows do, so there are some for each bucket of a trigger and none for each key.
    """

    def __init__(self, keys: list[str], order: list[str], retention_seconds: int):
        self.keys, self.names = keys, _key_names(keys)
        self.order, self.retention = order, retention_seconds * SECOND

    def init(self, handle: StatefulProcessorHandle) -> None:
        layout = StructType()
        for key in self.keys:
            layout = layout.add(key, StringType())
        self.handle = handle
        self.last = handle.getListState("last", layout.add(AT, LongType()))

    def _held(self) -> dict[tuple, int]:
        return {tuple(key): at for *key, at in self.last.get()}

    def _free(self, at: int) -> int:
        """The first millisecond at which the key is free again."""
        return -(-(at + self.retention) // 1000)

    def _hold(self, held: dict[tuple, int], timerValues: Any) -> None:
        """Keep what the watermark has not passed, and a timer for the first of it that ends."""
        mark = timerValues.getCurrentWatermarkInMs()
        live = [(*key, at) for key, at in held.items() if self._free(at) > mark]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if live:
            self.last.put(live)
            self.handle.registerTimer(self._free(min(at for *_, at in live)))
        else:
            self.last.clear()

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        held = self._held()
        for name, at in zip(self._keys(initialState), initialState["at"].tolist()):
            held[name] = max(at, held.get(name, at))
        self._hold(held, timerValues)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self._hold(self._held(), timerValues)
        return iter([])

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        own = [*OWN, BUCKET, *self.names]
        timed = yield from timed_rows(rows, self.names, self.order, own)
        if not len(timed):
            return
        held, emitted = self._held(), []
        for name, at in zip(self._keys(timed), timed[AT].astype("int64").tolist()):
            free = name not in held or at >= held[name] + self.retention
            if free:
                held[name] = at
            emitted.append(free)
        if any(emitted):
            self._hold(held, timerValues)
            yield timed[emitted].drop(columns=own)

    def _keys(self, rows: pd.DataFrame) -> list[tuple]:
        columns = ([None if value is None or value is pd.NA or value != value else value for value in rows[name]] for name in self.names)
        return list(zip(*columns))

    def close(self) -> None:
        pass


def suppress_repeats_stream(
    rows: DataFrame,
    keys: tuple[str, ...] = KEYS,
    time: str = "alert_time",
    order: tuple[str, ...] = ORDER,
    retention_seconds: int = RETENTION_SECONDS,
    clock: str = "event",
    late: str | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """The streaming form of `operators.suppression.suppress_repeats`.

    With the event clock it decides by `time`, so input in time order gives the batch result.
    A row that arrives behind the last emission of its key is a repeat. Rows without a time are all emitted. State is
    one number per key.

    Without `late` nothing is dropped as late, and a key's state stays as long as the checkpoint lives. With `late`, a
    duration such as "10 minutes", Spark drops rows that come so far behind the latest time seen, and a key's state ends
    by a timer when the watermark has passed its last emission by the retention time: no row that may still
    come would be its repeat. What is held then is the keys that were emitted lately, as texts, in 1,024 buckets by hash:
    a bucket of a trigger is one group with one list as its state, however many keys it has.

    With the processing clock the first row of a key is emitted and its state
    lives for the retention time; such a query keeps running empty batches to watch the clock, so
    it does not end by itself when the data available now is read.

    `history` hands over from a batch run: the keys and `at`, from `operators.suppression.last_emissions`, with which the
    state of a new checkpoint begins. Give it again at every start; Spark uses it at the first one only.

    Before the shuffle each Arrow batch is reduced to one row per key and time (or per key, with
    the processing clock), so a key that holds most rows does not send them all to one task. A task
    holds the distinct times of a key in one trigger; the limits of `read_topic` bound that.
    Start the query under `jobs.state_settings`.
    """
    if clock not in CLOCKS:
        raise ValueError(f"clock must be one of {CLOCKS}")
    if clock == "processing" and (late or history is not None):
        raise ValueError("late rows and history go with the event clock")
    names, ranked = list(keys), list(order)

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if clock == "processing":
                yield batch[~batch[names].duplicated()]
            else:
                yield first_per_time(batch, names, ranked)
                yield batch[batch[AT].isna()]

    instant = F.col(time).cast("timestamp")
    stamped = rows.withColumns({AT: F.unix_micros(instant), MARK: instant})
    combined = stamped.mapInPandas(combine, stamped.schema)
    if not late:
        return combined.groupBy(*keys).transformWithStateInPandas(
            _Repeats(ranked, retention_seconds, clock),
            outputStructType=rows.schema,
            outputMode="append",
            timeMode="processingTime" if clock == "processing" else "none",
            initialState=None if history is None else history.groupBy(*keys),
        )
    texts = dict(zip(_key_names(names), (F.col(key).cast("string") for key in keys)))
    bucket = {BUCKET: F.pmod(F.xxhash64(*texts.values()), F.lit(BUCKETS)), **texts}
    past = None if history is None else history.select(*[column.alias(name) for name, column in bucket.items()], "at")
    return combined.withWatermark(MARK, late).withColumns(bucket).groupBy(BUCKET).transformWithStateInPandas(
        _ExpiringRepeats(names, ranked, retention_seconds),
        outputStructType=rows.schema,
        outputMode="append",
        timeMode="eventTime",
        initialState=None if past is None else past.groupBy(BUCKET),
    )
