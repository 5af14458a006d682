"""Alerts from timers in the state store: they fire without a further batch of data and without a call.

One keyed state per station holds what can still change, and timers hold when to look at it. ``silence_by_clock`` uses the
clock: a query with a processing-time trigger goes on with empty batches, so a station, or the whole source, that stops
sending is reported while nothing arrives. ``silences`` and ``sustained_runs`` use event time: what lies behind the
watermark is final, whatever order files came in, and equals the batch operators over the same readings.

Stations are unequal, so rows are combined before they are dealt by station: per Arrow batch only the first and last
reading of each bucket of the limit is sent on (no silence fits inside a bucket), and for runs, per task, one row per
instant outside the first and last unflagged ones of each bucket (no run long enough fits between them). State per station
is pruned in the same way, is bounded by the watermark's delay and is dropped when the station has been gone for ``forget_s``: so long a pause ends a run, and what comes
after it begins anew, so that a silence of this length has no end.

Output is appended: a silence or run that goes on is told again with its later end. ``silence_table`` and
``run_table`` keep the newest.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.alerts import EXTREME_HOLD_S, SILENCE_S, extreme_temperature
from ..sinks.merged import MergedTable
from .alerts import LATENESS_S

FORGET_S = 7 * 86400
# Readings of a run are looked at in steps of event time.
STEP_S = 10
# Rows that a task combines at a time, and hands on in one batch.
HELD_ROWS, SENT_ROWS = 2_000_000, 50_000
# The key under which the whole source is watched.
WHOLE_SOURCE = "*"

_M = 1_000_000


def _bounds(limit_s: int, whole_source: bool):
    """Per Arrow batch: first and last instant of every station and bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us = batch.column(1)
            table = pa.table({"station": batch.column(0), "bucket": pc.floor(pc.divide(pc.cast(us, pa.float64()), float(limit_s * _M))).cast(pa.int64()), "us": us})
            found = table.group_by(["station", "bucket"]).aggregate([("us", "min"), ("us", "max")])
            if whole_source:
                both = found.group_by("bucket").aggregate([("us_min", "min"), ("us_max", "max")])
                both = pa.table({"station": pa.array([WHOLE_SOURCE] * len(both)), "bucket": both["bucket"],
                                 "us_min": both["us_min_min"], "us_max": both["us_max_max"]})
                found = pa.concat_tables([found.select(["station", "bucket", "us_min", "us_max"]), both])
            yield from found.select(["station", "bucket", "us_min", "us_max"]).rename_columns(["station", "bucket", "lo", "hi"]).combine_chunks().to_batches()

    return run


def _bucket_bounds(readings: DataFrame, limit_s: int, whole_source: bool = False) -> DataFrame:
    slim = readings.where(F.col("station").isNotNull() & F.col("ts").isNotNull())
    slim = slim.select("station", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    return slim.mapInArrow(_bounds(limit_s, whole_source), "station string, bucket bigint, lo bigint, hi bigint")


class _Silences(StatefulProcessor):
    """Event time. ``last`` is the newest reading whose bucket is behind the watermark; first and last instants of later
    buckets wait. All of it is one value, as each access to the state is a call, and one timer waits for the next bucket."""

    def __init__(self, limit_s: int, forget_s: int):
        self.limit, self.forget = limit_s * _M, forget_s * _M

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(
            "state", "last bigint, told boolean, due bigint, buckets array<bigint>, lows array<bigint>, highs array<bigint>")

    def _load(self) -> tuple:
        if not self.state.exists():
            return None, False, None, {}
        last, told, due, buckets, lows, highs = self.state.get()
        return last, told, due, {b: (lo, hi) for b, lo, hi in zip(buckets, lows, highs)}

    def _store(self, last, told, due, waiting: dict) -> None:
        if last is None and not waiting:
            self.state.clear()
            return
        self.state.update((last, told, due, list(waiting), [lo for lo, _ in waiting.values()], [hi for _, hi in waiting.values()]))

    def _call_at(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last, told, due, waiting = self._load()
        for row in rows:
            lo, hi = waiting.get(row.bucket, (row.lo, row.hi))
            waiting[row.bucket] = min(lo, row.lo), max(hi, row.hi)
        end = (min(waiting) + 1) * self.limit
        if due is None or end < due:
            due = end
            self._call_at(due)
        self._store(last, told, due, waiting)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # A timer that is set now fires with the next batch, so each one looks as far as the watermark.
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        last, told, due, waiting = self._load()
        settled = sorted(b for b in waiting if (b + 1) * self.limit <= now)
        for b in settled:
            lo, hi = waiting.pop(b)
            if last is not None and self.limit < lo - last < self.forget:
                yield Row(station=key[0], silent_from=last, silent_to=lo)
            if last is None or hi > last:
                last, told = hi, False
        if settled:
            # The first whole millisecond after the limit, and much later.
            self._call_at(last + self.limit + 1000)
            self._call_at(last + self.forget)
        if due is not None and due <= now:
            due = (min(waiting) + 1) * self.limit if waiting else None
            if due is not None:
                self._call_at(due)
        # All readings up to now have come; one of them in a bucket that is not over will end the silence soon.
        if last is not None and not told and now > last + self.limit and not any(lo <= now for lo, _ in waiting.values()):
            yield Row(station=key[0], silent_from=last, silent_to=None)
            told = True
        if last is not None and now >= last + self.forget:
            last, told = None, False
        self._store(last, told, due, waiting)


class _ClockSilences(StatefulProcessor):
    """Processing time. ``seen`` is the newest reading; a timer runs from the last batch that brought one."""

    def __init__(self, limit_s: float, forget_s: int):
        self.limit_ms, self.forget_ms = int(limit_s * 1000), forget_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "us bigint, told boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before, told = self.seen.get() if self.seen.exists() else (None, False)
        lows, newest = [], before
        for row in rows:
            lows.append(row.lo if before is None or row.lo > before else row.hi)
            newest = row.hi if newest is None else max(newest, row.hi)
        if told and newest > before:
            yield Row(station=key[0], silent_from=before, silent_to=min(x for x in lows if x > before))
        # A reading that is older than those seen is a sign of life as well.
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.limit_ms)
        self.seen.update((newest, False))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        newest, told = self.seen.get()
        if told:
            self.seen.clear()
            return
        yield Row(station=key[0], silent_from=newest, silent_to=None)
        self.seen.update((newest, True))
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.forget_ms)


def _as_times(found: DataFrame, columns: list[str]) -> DataFrame:
    return found.withColumns({c: F.timestamp_micros(c) for c in columns})


def silences(readings: DataFrame, limit_s: int = SILENCE_S, delay: str = f"{LATENESS_S} seconds", forget_s: int = FORGET_S) -> DataFrame:
    """Stream of silences by event time: one row when one has begun (``silent_to`` null), one when it has ended.

    Readings may come up to ``delay`` after later ones.
    """
    bounds = _bucket_bounds(readings, limit_s).withColumn("at", F.timestamp_micros("hi")).withWatermark("at", delay)
    found = bounds.groupBy("station").transformWithState(
        _Silences(limit_s, forget_s), "station string, silent_from bigint, silent_to bigint", "append", "EventTime")
    return _as_times(found, ["silent_from", "silent_to"])


def silence_by_clock(readings: DataFrame, limit_s: float = SILENCE_S, forget_s: int = FORGET_S, whole_source: bool = True) -> DataFrame:
    """Stream of stations, and of the whole source as station ``*``, from which nothing has come for ``limit_s`` of the clock."""
    bounds = _bucket_bounds(readings, max(1, int(limit_s)), whole_source)
    found = bounds.groupBy("station").transformWithState(
        _ClockSilences(limit_s, forget_s), "station string, silent_from bigint, silent_to bigint", "append", "ProcessingTime")
    return _as_times(found, ["silent_from", "silent_to"])


# Sustained conditions ---------------------------------------------------------------------------------------------

def _pruned(station: np.ndarray, us: np.ndarray, flag: np.ndarray, hold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct instants per station, in order, without those between the first and the last unflagged one of a bucket of
    the hold: a run that is long enough cannot lie there, whatever else there is. An instant is flagged if all its rows are."""
    order = np.lexsort((flag, us, station))
    station, us, flag = station[order], us[order], flag[order]
    new = np.ones(len(us), bool)
    new[1:] = (station[1:] != station[:-1]) | (us[1:] != us[:-1])
    station, us, flag = station[new], us[new], flag[new]
    if not len(us):
        return station, us, flag
    bucket = us // hold
    begins = np.ones(len(us), bool)
    begins[1:] = (station[1:] != station[:-1]) | (bucket[1:] != bucket[:-1])
    first, group = np.flatnonzero(begins), np.cumsum(begins) - 1
    whole = np.iinfo(np.int64)
    low = np.minimum.reduceat(np.where(flag, whole.max, us), first)[group]
    high = np.maximum.reduceat(np.where(flag, whole.min, us), first)[group]
    keep = (us <= low) | (us >= high) | (low > high)
    return station[keep], us[keep], flag[keep]


def _instants(hold_s: int):
    """Per task: one row per station and instant that can begin, end or break a run that is long enough.

    Batches are combined as long as little is left of them.
    """
    hold = hold_s * _M

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        held, size = [], 0

        def combined():
            return _pruned(*(np.concatenate(x) for x in zip(*held)), hold)

        def sent(station, us, flag) -> Iterator[pa.RecordBatch]:
            stations = pa.array(list(names), pa.string())
            for lo in range(0, len(us), SENT_ROWS):
                some = slice(lo, lo + SENT_ROWS)
                yield pa.record_batch([stations.take(pa.array(station[some])), pa.array(us[some]), pa.array(flag[some])], names=["station", "us", "flag"])

        for batch in batches:
            if not batch.num_rows:
                continue
            stations = batch.column(0).dictionary_encode()
            code = np.array([names.setdefault(x, len(names)) for x in stations.dictionary.to_pylist()], np.int64)
            held.append((code[stations.indices.to_numpy()], batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)))
            size += batch.num_rows
            if size >= HELD_ROWS:
                held = [combined()]
                size = len(held[0][1])
                if size > HELD_ROWS // 2:
                    yield from sent(*held[0])
                    held, size = [], 0
        if held:
            yield from sent(*combined())

    return run


class _Runs(StatefulProcessor):
    """``samples`` are those not yet behind the watermark, packed as they came; ``run`` is the flagged run that reaches up to
    it, the newest sample behind it, and the end of the step that a timer waits for."""

    def __init__(self, hold_s: int, forget_s: int, step_s: int):
        self.hold, self.forget, self.step = hold_s * _M, forget_s * _M, step_s * _M

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.samples = handle.getListState("samples", "us binary, flag binary")
        self.run = handle.getValueState("run", "started bigint, ended bigint, newest bigint, due bigint")

    def _wait_for(self, first: int, due: int | None) -> int | None:
        """A timer at the end of the first step that has samples, unless an earlier one is set."""
        end = (first // self.step + 1) * self.step
        if due is None or end < due:
            due = end
            self.handle.registerTimer(due // 1000)
        return due

    @staticmethod
    def _packed(us: np.ndarray, flag: np.ndarray) -> list[tuple[bytes, bytes]]:
        cuts = range(0, len(us), SENT_ROWS)
        return [(us[k:k + SENT_ROWS].astype(np.int64).tobytes(), flag[k:k + SENT_ROWS].astype(bool).tobytes()) for k in cuts]

    def _held(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [(np.frombuffer(us, np.int64), np.frombuffer(flag, bool)) for us, flag in self.samples.get()]
        us, flag = (np.concatenate([np.zeros(0, kind), *(p[i] for p in parts)]) for i, kind in enumerate((np.int64, bool)))
        return _pruned(np.zeros(len(us), np.int8), us, flag, self.hold)[1:]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found = [(row.us, row.flag) for row in rows]
        us, flag = np.array([x for x, _ in found], np.int64), np.array([x for _, x in found], bool)
        self.samples.appendList(self._packed(us, flag))
        started, ended, newest, due = self.run.get() if self.run.exists() else (None,) * 4
        self.run.update((started, ended, newest, self._wait_for(int(us.min()), due)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) // (self.step // 1000) * self.step
        if not self.run.exists():
            return
        started, ended, newest, due = self.run.get()
        grown, settled = False, 0
        if due is not None and due <= now:
            held, flags = self._held()
            settled = int(np.searchsorted(held, now))
        if settled:
            us, flag = held[:settled], flags[:settled]
            # Stretches of one flag without a long gap; the first may go on with the run that reaches up to it.
            begins = np.ones(settled, bool)
            begins[1:] = (flag[1:] != flag[:-1]) | (us[1:] - us[:-1] >= self.forget)
            first = np.flatnonzero(begins)
            last = np.append(first[1:], settled) - 1
            firsts, lasts, hot = us[first], us[last], flag[first]
            if started is not None and hot[0] and firsts[0] - newest < self.forget:
                firsts[0] = started
            elif started is not None and ended - started >= self.hold:
                yield self._row(key, started, ended, True)
            for k in np.flatnonzero(hot[:-1] & (lasts[:-1] - firsts[:-1] >= self.hold)):
                yield self._row(key, int(firsts[k]), int(lasts[k]), True)
            grown = bool(hot[-1])
            started, ended = (int(firsts[-1]), int(lasts[-1])) if grown else (None, None)
            newest = int(us[-1])
            if settled < len(held):
                self.samples.put(self._packed(held[settled:], flags[settled:]))
                due = self._wait_for(int(held[settled]), None)
            else:
                self.samples.clear()
                due = None
            self.handle.registerTimer(-(-(newest + self.forget) // self.step) * self.step // 1000)
        gone = newest is not None and now >= newest + self.forget
        if started is not None and (grown or gone) and ended - started >= self.hold:
            yield self._row(key, started, ended, gone)
        if gone:
            started, ended, newest = None, None, None
        if newest is None and due is None:
            self.run.clear()
        else:
            self.run.update((started, ended, newest, due))

    @staticmethod
    def _row(key, started: int, ended: int, final: bool) -> Row:
        return Row(station=key[0], started=started, ended=ended, held_s=(ended - started) / _M, final=final)


def sustained_runs(readings: DataFrame, flagged: Column | None = None, hold_s: int = EXTREME_HOLD_S,
                   delay: str = f"{LATENESS_S} seconds", forget_s: int = FORGET_S, step_s: int = STEP_S) -> DataFrame:
    """Stream of runs of flagged readings that last at least ``hold_s``: told when they reach it, as they grow, and as final."""
    flag = extreme_temperature(F.col("temp")) if flagged is None else flagged
    slim = readings.select("station", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), flag.alias("flag"))
    slim = slim.where(F.col("station").isNotNull() & F.col("us").isNotNull() & F.col("flag").isNotNull())
    one = slim.mapInArrow(_instants(hold_s), "station string, us bigint, flag boolean")
    timed = one.withColumn("at", F.timestamp_micros("us")).withWatermark("at", delay)
    found = timed.groupBy("station").transformWithState(
        _Runs(hold_s, forget_s, step_s), "station string, started bigint, ended bigint, held_s double, final boolean", "append", "EventTime")
    return _as_times(found, ["started", "ended"])


def wait_for(done: Callable[[], bool], query: StreamingQuery, seconds: float = 120) -> None:
    """Look twice a second until ``done``; raises what the query raised, or when the time is over."""
    until = time.monotonic() + seconds
    while not done():
        if query.exception():
            raise query.exception()
        if time.monotonic() > until:
            raise TimeoutError(f"not done after {seconds} s")
        time.sleep(0.5)


def silence_table(root: str) -> MergedTable:
    """Silences, each with its end once it has one."""
    return MergedTable(root, ["station", "silent_from"], ("silent_to",))


def run_table(root: str) -> MergedTable:
    """Runs, each as far as it was last told."""
    return MergedTable(root, ["station", "started"], ("held_s", "final"))
