"""Responses with nearly the same start and duration: a band self-join that only counts.

Pairs are never formed. Equal (start, duration) points are merged first. Then
every point asks how much weight lies in the box around it, and the box is split
at the borders of *slices* of the points:

- slices by start hold consecutive points in the order (start, duration);
- slices by duration hold consecutive points in the order (duration, start).

The part of a box inside the two start slices where it begins and ends is counted
there. Start slices wholly between them are covered in start, so for their
points only the duration matters: they are counted in the two duration slices
where the box begins and ends, which also know how much weight each start slice
has in all earlier duration slices. Each point therefore meets at most four
slices. Slices with many questions are copied. There are at most ``MAX_SLICES``
slices by either axis, since their borders go to every task; where the data are
so many that slices outgrow their bound, each is parted by a hash of its points,
and its questions are asked in every part. So what a task holds is bounded even if
all points share one start or one duration.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveysieve.functions.box_counts import box_weights, reach
from surveysieve.functions.columns import col_, naive_micros
from surveysieve.operators.skew import HOT_ROWS, join_per_key, task_partitions
from surveysieve.sources.sinks import stage_table

SLICE_ROWS = 100_000
MAX_SLICES = 65_536
# Points of a slice, in multiples of SLICE_ROWS, from which it is parted.
PART_SLICES = 4
SAMPLE_PER_SLICE = 32
EARLIEST, LATEST = -(2**62), 2**62

_START, _DURATION = 0, 1
# A point (amount: its weight) or a question for the box x .. x_high, y .. y_high
# (amount: the sign of the answer) asked by the point (t, d), in the bin where it belongs.
_RECORD = "bin long, asks boolean, x long, x_high long, y double, y_high double, amount long, t long, d double"
_NAMES = [field.split()[0] for field in _RECORD.split(", ")]


def _micros(seconds: float) -> int:
    """Largest difference in microseconds that is at most ``seconds``."""
    if math.isinf(seconds):
        return LATEST
    micros = int(seconds * 1e6) + 2
    while micros / 1e6 > seconds:
        micros -= 1
    return micros


@dataclass(frozen=True)
class _Radius:
    micros: int
    duration: float
    sign: int


@dataclass(frozen=True)
class _Borders:
    """First points of the slices 1, 2, ... of one axis, in order of (major, minor)."""

    major: np.ndarray
    minor: np.ndarray
    copies: np.ndarray

    def slice_of(self, major, minor):
        count = len(self.major)
        keys = (
            np.concatenate([np.zeros(count, bool), np.ones(len(major), bool)]),
            np.concatenate([self.minor, minor]),
            np.concatenate([self.major, major]),
        )
        order = np.lexsort(keys)
        passed = np.cumsum(order < count)
        slices = np.empty(len(order), dtype=np.int64)
        slices[order] = passed
        return slices[count:]

    def first_slice(self, low):
        return np.searchsorted(self.major, low, side="left")

    def last_slice(self, high):
        return np.searchsorted(self.major, high, side="right")


@dataclass(frozen=True)
class _Layout:
    starts: _Borders
    durations: _Borders
    radii: tuple[_Radius, ...]
    parts: tuple[int, int] = (1, 1)

    def axis(self, number: int) -> _Borders:
        return self.starts if number == _START else self.durations

    @property
    def coverable(self):
        """Start slices short enough to lie wholly inside some box."""
        inner = np.diff(self.starts.major) <= 2 * max(r.micros for r in self.radii)
        return np.concatenate([[False], inner, [False]])[: len(self.starts.major) + 1]


def burst_counts(
    df: DataFrame,
    key: str,
    column_start_time: str,
    column_duration: str,
    max_start_time_difference: float,
    max_duration_difference: float,
    unflag_start_time_difference: float | None = None,
    unflag_duration_difference: float | None = None,
    name: str = "burst_count",
    slice_rows: int = SLICE_ROWS,
    hot_rows: int = HOT_ROWS,
    start_time_format: str | None = None,
) -> DataFrame:
    """(key, number of other responses in the outer radii minus those in the unflag radii).

    Responses without start or duration are left out. ``start_time_format`` is
    that of start times given as text, see ``wall_clock``.
    """
    radii = _radii(
        (max_start_time_difference, max_duration_difference, 1),
        (unflag_start_time_difference, unflag_duration_difference, -1),
    )
    timed = df.select(
        col_(key).alias(key),
        wall_clock(df, column_start_time, start_time_format).alias("__start"),
        col_(column_duration).cast("double").alias("d"),
    )
    if radii and _is_text(df, column_start_time):
        # Texts are parsed once, not by each of the steps that use the times.
        timed = stage_table(timed, "start-times")
    rows = timed.select(col_(key), naive_micros(F.col("__start")).alias("t"), "d").where(
        "t IS NOT NULL AND d IS NOT NULL AND NOT isnan(d)"
    )
    if not radii:
        return rows.select(key, F.lit(0).cast("long").alias(name))
    # + 0.0 gives both zeros the same bits, as equality does.
    rows = rows.withColumn("d", F.col("d") + F.lit(0.0))
    layout = _lay_out(rows, radii, slice_rows)
    points = rows.groupBy("t", "d").agg(F.count("*").alias("weight"))
    records = points.mapInArrow(partial(_records, layout=layout), _RECORD)
    if layout.coverable.any():
        records = records.unionByName(_earlier_weight(points, layout))
    bins = int(sum(layout.axis(axis).copies.sum() * layout.parts[axis] for axis in (_START, _DURATION)))
    records = records.repartition(task_partitions(df.sparkSession, bins), "bin")
    answers = records.groupBy("bin").applyInArrow(_answer, "t long, d double, n long")
    itself = sum(r.sign for r in radii)
    counts = answers.groupBy("t", "d").agg((F.sum("n") - itself).alias(name))
    return join_per_key(rows, counts, ["t", "d"], "weight", F.col(key), hot_rows, sizes=points).select(key, name)


# Spellings of start times that need no format: month/day/year, on a clock of 24 or of 12 hours.
# A text fits at most one: they differ in the number of colons and in having a half of the day.
US_FORMATS = ("M/d/y H:m", "M/d/y H:m:s", "M/d/y h:m a", "M/d/y h:m:s a", "M/d/y")


def _is_text(df: DataFrame, column: str) -> bool:
    return df.select(col_(column)).schema[0].dataType.simpleString() == "string"


def wall_clock(df: DataFrame, column: str, start_time_format: str | None = None) -> Column:
    """Start time as a timestamp without zone.

    Text must have ``start_time_format`` (a Spark pattern), or without one be ISO
    or one of ``US_FORMATS``. Blank text is a missing time, any other that does not
    fit is refused with an error.
    """
    value = col_(column)
    if not _is_text(df, column):
        return value.try_cast("timestamp_ntz")
    text = F.nullif(F.trim(value), F.lit(""))
    if start_time_format is not None:
        known = [_by_format(text, start_time_format)]
    else:
        known = [text.try_cast("timestamp_ntz"), _by_us_format(F.upper(text))]
    refused = F.raise_error(F.concat(F.lit(f"{column}: not a start time: "), text)).cast("timestamp_ntz")
    return F.when(text.isNotNull(), F.coalesce(*known, refused))


def _by_us_format(text: Column) -> Column:
    """By the one of ``US_FORMATS`` that the text may fit, since an attempt that fails costs much more than one that does not."""
    colons = F.length(text) - F.length(F.replace(text, F.lit(":"), F.lit("")))
    halves = text.contains("M")
    found = F.lit(None).cast("timestamp_ntz")
    for pattern in US_FORMATS:
        of_half = halves if pattern.endswith("a") else ~halves
        found = F.when((colons == pattern.count(":")) & of_half, _by_format(text, pattern)).otherwise(found)
    return found


def _by_format(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")


def _radii(outer, unflag) -> tuple[_Radius, ...]:
    wanted = [outer]
    if unflag[0] and unflag[1]:
        wanted.append(unflag)
    return tuple(_Radius(_micros(s), float(d), sign) for s, d, sign in wanted if s >= 0 and d >= 0)


def _lay_out(rows: DataFrame, radii: tuple[_Radius, ...], slice_rows: int) -> _Layout:
    """Slice borders from a sample of bounded size; they steer the work, not the result."""
    total = rows.count()
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    slices = max(math.ceil(total / slice_rows), min(4 * parallel, total // 5_000), 1)
    slices = min(slices, MAX_SLICES)
    fraction = min(1.0, slices * SAMPLE_PER_SLICE / max(total, 1))
    t, d = np.zeros(0, np.int64), np.zeros(0)
    if slices > 1:
        sample = rows.select("t", "d").sample(fraction, seed=7).toArrow()
        t, d = sample["t"].to_numpy(), sample["d"].to_numpy()
    starts = _borders(t, d, slices)
    layout = _Layout(starts, _borders(d[:0], t[:0], 1), radii)
    # Only points in start slices that a box can cover are counted by duration.
    inside = layout.coverable[starts.slice_of(t, d)]
    by_duration = max(round(slices * inside.mean()) if len(t) else 1, 1)
    durations = _borders(d[inside], t[inside], by_duration)
    # The sample holds all slices alike, so a slice has about as many points as another.
    covered = total * inside.mean() if len(t) else 0
    held = (total / len(starts.copies), covered / len(durations.copies))
    parts = tuple(max(1, math.ceil(points / (PART_SLICES * slice_rows))) for points in held)
    layout = _Layout(starts, durations, radii, parts)
    asked = {axis: np.zeros(len(layout.axis(axis).copies)) for axis in (_START, _DURATION)}
    for axis, slices_asked, *_ in _asks(t, d, layout):
        asked[axis] += np.bincount(slices_asked, minlength=len(asked[axis])) / fraction
    for axis, counts in asked.items():
        # A copy answers a few questions for each of the points that it may hold.
        room = 4 * max(slice_rows, held[axis] / parts[axis])
        layout.axis(axis).copies[:] = np.maximum(np.ceil(counts / room), 1)
    return layout


def _borders(major, minor, slices) -> _Borders:
    order = np.lexsort((minor, major))
    at = order[(np.arange(1, slices) * len(order)) // slices] if len(order) else order
    first = pd.DataFrame({"major": major[at], "minor": minor[at]}).drop_duplicates()
    return _Borders(
        first["major"].to_numpy(), first["minor"].to_numpy(), np.ones(len(first) + 1, dtype=np.int64)
    )


def _asks(t, d, layout: _Layout):
    """The questions of the points: (axis, slices, who asks, x, x_high, y, y_high, sign)."""
    for radius in layout.radii:
        t_low, t_high = np.maximum(t, EARLIEST + radius.micros) - radius.micros, t + radius.micros
        d_low, d_high = reach(d, radius.duration)
        left, right = layout.starts.first_slice(t_low), layout.starts.last_slice(t_high)
        yield _START, left, np.arange(len(t)), t_low, t_high, d_low, d_high, radius.sign
        who = np.flatnonzero(right > left)
        yield _START, right[who], who, t_low[who], t_high[who], d_low[who], d_high[who], radius.sign
        # Slices wholly between: all durations up to d_high, less all before d_low.
        inner = right - left >= 2
        upper, lower = np.flatnonzero(inner), np.flatnonzero(inner & (d_low > -np.inf))
        for who, slices, high, sign in (
            (upper, layout.durations.last_slice(d_high[upper]), d_high[upper], radius.sign),
            (lower, layout.durations.first_slice(d_low[lower]), np.nextafter(d_low[lower], -np.inf), -radius.sign),
        ):
            yield _DURATION, slices, who, left[who] + 1, right[who] - 1, np.full(len(who), -np.inf), high, sign


def _bin(axis: int, slices, copy):
    return ((2 * np.asarray(slices, dtype=np.int64) + axis) << 32) + copy


def _batch(bins, asks, x, x_high, y, y_high, amount, t, d) -> pa.RecordBatch:
    """Records from arrays, or single values that hold for all of them."""
    columns = (bins, asks, x, x_high, y, y_high, amount, t, d)
    kinds = (np.int64, bool, np.int64, np.int64, np.float64, np.float64, np.int64, np.int64, np.float64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.ascontiguousarray(np.broadcast_to(np.asarray(c, dtype=kind), len(bins))))
            for c, kind in zip(columns, kinds, strict=True)
        ],
        names=_NAMES,
    )


def _points(layout: _Layout, axis: int, slices, x, y, weight) -> pa.RecordBatch:
    """Points in every copy of their slice, there in the part that their hash tells."""
    times = layout.axis(axis).copies[slices]
    at = np.repeat(np.arange(len(slices)), times)
    copy = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    parts = layout.parts[axis]
    part = ((pd.util.hash_array(np.ascontiguousarray(x)) ^ pd.util.hash_array(np.ascontiguousarray(y))) % np.uint64(parts))
    bins = _bin(axis, slices[at], copy * parts + part.astype(np.int64)[at])
    return _batch(bins, False, x[at], 0, y[at], 0.0, weight[at], 0, 0.0)


def _records(batches, layout: _Layout):
    """Points and questions, each in the bin where it is needed."""
    coverable = layout.coverable
    for batch in batches:
        t, d, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "d", "weight"))
        at_start = layout.starts.slice_of(t, d)
        yield _points(layout, _START, at_start, t, d, weight)
        who = np.flatnonzero(coverable[at_start])
        at_duration = layout.durations.slice_of(d[who], t[who])
        yield _points(layout, _DURATION, at_duration, at_start[who], d[who], weight[who])
        # The same question always goes to the same copy, also when a task is repeated.
        lane = pd.util.hash_array(t) ^ pd.util.hash_array(d)
        for axis, slices, who, x, x_high, y, y_high, sign in _asks(t, d, layout):
            copies = layout.axis(axis).copies[slices].astype(np.uint64)
            copy = (lane[who] % copies).astype(np.int64)
            for part in range(layout.parts[axis]):
                bins = _bin(axis, slices, copy * layout.parts[axis] + part)
                yield _batch(bins, True, x, x_high, y, y_high, sign, t[who], d[who])


def _earlier_weight(points: DataFrame, layout: _Layout) -> DataFrame:
    """For each duration slice the weight of each coverable start slice in the slices before.

    The numbers of slices on both axes are bounded, and with them the cells and windows.
    """
    last = len(layout.durations.major)
    coverable = layout.coverable

    def cells(batches):
        for batch in batches:
            t, d, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "d", "weight"))
            at_start = layout.starts.slice_of(t, d)
            who = coverable[at_start]
            frame = pd.DataFrame(
                {"x": at_start[who], "slice": layout.durations.slice_of(d[who], t[who]), "weight": weight[who]}
            )
            sums = frame.groupby(["x", "slice"], as_index=False).sum()
            yield pa.RecordBatch.from_pandas(sums, preserve_index=False)

    weights = (
        points.mapInArrow(cells, "x long, slice long, weight long")
        .groupBy("x", "slice")
        .agg(F.sum("weight").alias("weight"))
    )
    along = Window.partitionBy("x").orderBy("slice")
    until = F.coalesce(F.lead("slice").over(along), F.lit(last))
    totals = weights.select("x", "slice", F.sum("weight").over(along).alias("weight"), until.alias("until"))
    earlier = totals.where("slice < until").select(
        F.explode(F.sequence(F.col("slice") + 1, F.col("until"))).alias("slice"), "x", "weight"
    )

    def below_all(batches):
        for batch in batches:
            slices, x, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("slice", "x", "weight"))
            yield _points(layout, _DURATION, slices, x, np.full(len(x), -np.inf), weight)

    return earlier.mapInArrow(below_all, _RECORD)


def _answer(group: pa.Table) -> pa.Table:
    values = {name: group.column(name).to_numpy() for name in _NAMES}
    asks = values["asks"]
    points = [values[c][~asks] for c in ("x", "y", "amount")]
    boxes = [values[c][asks] for c in ("x", "x_high", "y", "y_high")]
    found = box_weights(*points, *boxes)
    return pa.table({"t": values["t"][asks], "d": values["d"][asks], "n": found * values["amount"][asks]})
