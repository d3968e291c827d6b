"""Sliding-window statistics of a stream, from panes in keyed state."""

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gustline.operators.windows import (
    EARLIEST_MINIMA, EVENT_TIME, LATEST_MAXIMA, MEANS, PLAIN_MINIMA, SLIDE_MINUTES, WATERMARK, WINDOW_MINUTES,
)

PLACE = ["city", "country"]
#: Milliseconds, as watermarks and timers count.
SLIDE, LENGTH = SLIDE_MINUTES * 60_000, WINDOW_MINUTES * 60_000
TIMED = {**LATEST_MAXIMA, **EARLIEST_MINIMA}
METRICS = list(dict.fromkeys([*MEANS.values(), *TIMED.values(), *PLAIN_MINIMA.values()]))
#: What a pane is: sums and counts, extremes with their times in microseconds, plain minima.
FIELDS = (
    [(f"{name}_{part}", kind) for name in MEANS for part, kind in (("sum", "double"), ("n", "long"))]
    + [(f"{name}_{part}", kind) for name in TIMED for part, kind in (("value", "double"), ("at", "long"))]
    + [(name, "double") for name in PLAIN_MINIMA]
)
PANE = ", ".join(f"{name} {kind}" for name, kind in FIELDS)
PARTIAL = f"city string, country string, pane long, {PANE}"
WINDOW = f"city string, country string, window_end long, {PANE}"
RESULT = [*PLACE, "window_end", *(name for name, _ in FIELDS)]
#: Panes of one place that wait to be written to its state.
MOST_WAITING = 10_000


def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per place and pane of each batch: an empty reading is the least, as in Spark's order of structs."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        codes = np.zeros(n, np.int64)
        for name in PLACE:
            coded = pc.dictionary_encode(batch.column(name), null_encoding="encode")
            codes = codes * len(coded.dictionary) + coded.indices.to_numpy()
        pane, at = batch.column("pane").to_numpy(), batch.column("at").to_numpy()
        order = np.lexsort((pane, codes))
        new = np.r_[True, (np.diff(codes[order]) != 0) | (np.diff(pane[order]) != 0)]
        starts = np.flatnonzero(new)
        ends = np.r_[starts[1:], n]
        group = np.empty(n, np.int64)
        group[order] = np.cumsum(new) - 1

        valid = {m: batch.column(m).is_valid().to_numpy(zero_copy_only=False) for m in METRICS}
        value = {m: batch.column(m).fill_null(0.0).to_numpy() for m in METRICS}
        ranked = {m: np.lexsort((at, value[m], valid[m], group)) for m in METRICS}

        def taken(metric: str, rows: np.ndarray, known: np.ndarray) -> pa.Array:
            return pa.array(value[metric][rows], mask=~known)

        columns = [batch.column(name).take(pa.array(order[starts])) for name in PLACE] + [pa.array(pane[order[starts]])]
        for metric in MEANS.values():
            columns.append(pa.array(np.add.reduceat((value[metric] * valid[metric])[order], starts)))
            columns.append(pa.array(np.add.reduceat(valid[metric][order].astype(np.int64), starts)))
        for name, metric in TIMED.items():
            rows = ranked[metric][ends - 1 if name in LATEST_MAXIMA else starts]
            columns += [taken(metric, rows, valid[metric][rows]), pa.array(at[rows])]
        for metric in PLAIN_MINIMA.values():
            # Empty readings stand first in their group.
            known = np.add.reduceat(valid[metric][order].astype(np.int64), starts)
            columns.append(taken(metric, ranked[metric][np.minimum(ends - known, n - 1)], known > 0))
        yield pa.RecordBatch.from_arrays(columns, names=["city", "country", "pane", *(name for name, _ in FIELDS)])


def _rank(value: float | None) -> tuple[int, float]:
    # Spark's order: nothing, numbers, not a number.
    return (0, 0.0) if value is None else (2, 0.0) if value != value else (1, value)


def _timed_rank(pair: tuple) -> tuple:
    return _rank(pair[0]), pair[1]


def merge(a: tuple, b: tuple) -> tuple:
    """Two panes' values, or two parts of one, together."""
    out, at = [], 2 * len(MEANS)
    out.extend(x + y for x, y in zip(a[:at], b[:at]))
    for name in TIMED:
        pick = max if name in LATEST_MAXIMA else min
        out.extend(pick(a[at : at + 2], b[at : at + 2], key=_timed_rank))
        at += 2
    for x, y in zip(a[at:], b[at:]):
        out.append(min((v for v in (x, y) if v is not None), key=_rank, default=None))
    return tuple(out)


class _Panes(StatefulProcessor):
    """Keeps the open panes of one place, and one timer: the end of the next window that has any."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane long", PANE)
        self.closed = handle.getValueState("closed", "mark long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        yield from self._close(key, mark)
        waiting: dict[int, tuple] = {}
        for row in rows:
            if row.pane + LENGTH <= mark:
                continue
            part = tuple(row[name] for name, _ in FIELDS)
            waiting[row.pane] = merge(waiting[row.pane], part) if row.pane in waiting else part
            if len(waiting) >= MOST_WAITING:
                self._keep(waiting)
                waiting = {}
        self._keep(waiting)
        self._wait(mark)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        yield from self._close(key, mark)
        self._wait(mark)

    def _keep(self, waiting: dict[int, tuple]) -> None:
        for pane, part in waiting.items():
            held = self.panes.getValue((pane,))
            self.panes.updateValue((pane,), part if held is None else merge(tuple(held), part))

    def _close(self, key: Any, mark: int) -> Iterator[Row]:
        """The windows that the watermark has passed since the last time; panes that no later window needs go."""
        if not self.closed.exists():
            return
        done, held = self.closed.get()[0], sorted(pane for (pane,) in self.panes.keys())
        ends = sorted({end for pane in held for end in range(pane + SLIDE, pane + LENGTH + 1, SLIDE) if done < end <= mark})
        present, near = set(held), {}
        for end in ends:
            for pane in [p for p in near if p < end - LENGTH]:
                del near[pane]
            for pane in range(end - LENGTH, end, SLIDE):
                if pane in present and pane not in near:
                    near[pane] = tuple(self.panes.getValue((pane,)))
            whole = None
            for pane in sorted(near):
                whole = near[pane] if whole is None else merge(whole, near[pane])
            yield Row(**dict(zip(RESULT, (*key, end, *whole))))
        for pane in held:
            if pane + LENGTH <= mark:
                self.panes.removeKey((pane,))

    def _wait(self, mark: int) -> None:
        first = min((pane for (pane,) in self.panes.keys()), default=None)
        # A timer ends when the watermark is beyond it, a window when the watermark is at its end.
        wanted = None if first is None else max(first + SLIDE, (mark // SLIDE + 1) * SLIDE) - 1
        timers = set(self.handle.listTimers())
        for timer in timers - {wanted}:
            self.handle.deleteTimer(timer)
        if wanted is None:
            self.closed.clear()
            return
        if wanted not in timers:
            self.handle.registerTimer(wanted)
        self.closed.update((mark,))

    def close(self) -> None:
        pass


def pane_stats_stream(readings: DataFrame, late: str = WATERMARK) -> DataFrame:
    """`operators.windows.window_stats` of a stream, with each reading in one pane of state instead of six windows.

    Readings are combined into slide-long panes before the shuffle, batch by batch, so a place with most of the readings sends
    few rows. A place's state is its open panes, the watermark it was last seen at, and one timer. A window is emitted once, when the
    watermark has passed its end, from the six panes it covers; a pane goes when the last of its windows has.

    A reading is late for each window by itself: it counts in those of its windows that the trigger's watermark has not
    passed. The plain form compares with the watermark of the trigger before; both keep whatever is not further behind the
    latest time of earlier triggers than `late`. Readings without a time are left out; places without a name are places too. Metrics are held as doubles, so whole numbers
    beyond 2^53 are rounded. Start the query under `jobs.state_settings`.
    """
    micros = F.unix_micros(EVENT_TIME)
    pane = F.expr(f"(unix_micros({EVENT_TIME}) - pmod(unix_micros({EVENT_TIME}), {SLIDE * 1000}L)) div 1000")
    # The time goes as a number: Spark would drop whole readings behind the watermark by a time column.
    cut = readings.withWatermark(EVENT_TIME, late).filter(F.col(EVENT_TIME).isNotNull()).select(
        *PLACE, pane.alias("pane"), micros.alias("at"), *(F.col(m).cast("double").alias(m) for m in METRICS)
    )
    windows = cut.mapInArrow(combine, PARTIAL).groupBy(*PLACE).transformWithState(
        _Panes(), outputStructType=WINDOW, outputMode="append", timeMode="eventTime"
    )
    kind = {m: readings.schema[m].dataType for m in METRICS}
    start, end = F.timestamp_millis(F.col("window_end") - LENGTH), F.timestamp_millis("window_end")
    means = [F.try_divide(f"{name}_sum", f"{name}_n").alias(name) for name in MEANS]
    timed = [
        F.struct(F.col(f"{name}_value").cast(kind[m]).alias(m), F.timestamp_micros(f"{name}_at").alias(EVENT_TIME)).alias(name)
        for name, m in TIMED.items()
    ]
    plain = [F.col(name).cast(kind[m]).alias(name) for name, m in PLAIN_MINIMA.items()]
    return windows.select(*PLACE, F.struct(start.alias("start"), end.alias("end")).alias("time_window"), *means, *timed, *plain)
