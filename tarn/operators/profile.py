"""Elevation profiles of tracks: figures, smoothing, peaks with prominence, merging of near peaks, parameter sweeps.

Peaks are found in one pass over tracks in order (see tracks): a moving mean, maxima, prominence by a stack of falling heights,
and merging by grid cells, all linear in a track's points. A task holds the arrays of one track at a time (24 bytes a point).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tarn.functions.geo import haversine_m, haversine_np
from tarn.operators.nearby import pairs_within
from tarn.operators.tracks import groups, numbers
from tarn.session import tasks


def once(df: DataFrame, *key: str) -> DataFrame:
    """One row per key, for tables whose re-delivered rows are copies."""
    return df.dropDuplicates(list(key))


def by_track(points: DataFrame, track: str) -> DataFrame:
    """Points shuffled once by track, into a number of partitions that is not cut down for few bytes: the folds cost more than bytes tell."""
    spark = points.sparkSession
    return points.repartition(max(tasks(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))), track)


def valid_points(points: DataFrame, track: str, order: list[str], value: str) -> DataFrame:
    """Points with a value (neither null nor NaN), with their index i from 0 and their number n in the track."""
    per = Window.partitionBy(track)
    known = by_track(points.where(F.col(value).isNotNull() & ~F.isnan(value)), track)
    return known.withColumns({"i": F.row_number().over(per.orderBy(*order)) - 1, "n": F.count("*").over(per)})


def smoothed(points: DataFrame, track: str, value: str, window: int) -> DataFrame:
    """With s, the centred mean of value over window // 2 points to both sides, cut off at the ends."""
    half = window // 2
    return points.withColumn("s", F.avg(value).over(Window.partitionBy(track).orderBy("i").rowsBetween(-half, half)))


def moving_mean(v: np.ndarray, window: int) -> np.ndarray:
    """Centred mean over window // 2 values to both sides, cut off at the ends; summed from left to right."""
    half = window // 2
    padded, total = np.r_[np.zeros(half), v, np.zeros(half)], np.zeros(len(v))
    for k in range(2 * half + 1):
        total = total + padded[k : k + len(v)]
    i = np.arange(len(v))
    return total / (np.minimum(i + half, len(v) - 1) - np.maximum(i - half, 0) + 1)


def maxima(s: np.ndarray, radius: int) -> np.ndarray:
    """Places of strict maxima of s within min(radius, n // 3) to both sides, and of the first highest value.

    Plateaus are no maxima; the highest place is added unless a maximum lies within the radius. Fewer than three values have none.
    """
    n = len(s)
    if n < 3:
        return np.zeros(0, np.int64)
    r = min(radius, n // 3)
    beside = np.full(n, -np.inf)
    for j in range(1, r + 1):
        beside[j:] = np.maximum(beside[j:], s[:-j])
        beside[:-j] = np.maximum(beside[:-j], s[j:])
    found = np.flatnonzero(s > beside)
    found = found[(found >= r) & (found < n - r)]
    top = int(np.argmax(s))
    return found if len(found) and np.abs(found - top).min() < r else np.sort(np.r_[found, top])


def lowest_before(s: list[float]) -> list[float]:
    """For each place the lowest value from it back to the last strictly higher one, itself included, that one not; the start is a wall."""
    stack: list[tuple[float, float]] = []
    out = []
    for v in s:
        low = v
        while stack and stack[-1][0] <= v:
            low = min(low, stack.pop()[1])
        stack.append((v, low))
        out.append(low)
    return out


def prominence(s: np.ndarray, peaks: np.ndarray) -> np.ndarray:
    """Of each peak its height above the higher of the lowest values to either side, up to a strictly higher place."""
    left, right = np.array(lowest_before(s.tolist())), np.array(lowest_before(s[::-1].tolist()))[::-1]
    return s[peaks] - np.maximum(left[peaks], right[peaks])


def kept_peaks(value: np.ndarray, i: np.ndarray, lat: np.ndarray, lon: np.ndarray, distance_m: float) -> np.ndarray:
    """Places of peaks that stay by greedy suppression: from the highest (ties by i) a peak goes if one that stays is nearer than distance_m.

    Those that stay are looked up in cells no narrower than the distance. Null and non-finite places are near nothing.
    """
    placed = np.isfinite(lat) & np.isfinite(lon)
    step = max(distance_m, 1.0) / 111_000.0
    wide = step / max(0.01, float(np.cos(np.radians(min(89.0, np.abs(lat[placed]).max(initial=0.0) + step)))))
    cells: dict[tuple[int, int], list[int]] = {}
    out = []
    for k in np.lexsort((i, -value)).tolist():
        if placed[k]:
            y, x = int(lat[k] // step), int(lon[k] // wide)
            near = [m for a in (-1, 0, 1) for b in (-1, 0, 1) for m in cells.get((y + a, x + b), ())]
            if near and (haversine_np(lat[near], lon[near], lat[k], lon[k]) < distance_m).any():
                continue
            cells.setdefault((y, x), []).append(k)
        out.append(k)
    return np.sort(np.array(out, np.int64))


def _by_track(rows: DataFrame, keys: list[str], order: list[str], peaks_of: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """peaks_of(rows of one track, in order) of all tracks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in groups(batches, tuple(keys)):
            found = peaks_of(group)
            if len(found):
                held.append(found)
                size += len(found)
            if size > 20_000:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    spark = rows.sparkSession
    placed = rows.repartition(max(tasks(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)
    return placed.sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def raw_peaks(points: DataFrame, track: str, order: list[str], value: str, window: int, radius: int) -> DataFrame:
    """Peaks with i (place among the points with a value), s (smoothed value), prominence and the other columns of points."""
    return _peaks(points, track, order, value, window, radius, None, None)


def detect_peaks(points: DataFrame, track: str, order: list[str], value: str, window: int = 5, radius: int = 10, least: float = 30, merge_m: float = 100) -> DataFrame:
    """Peaks of tracks: smoothing, maxima, prominence and merging in turn. points: track, order columns, value, lat, lon.

    Columns as in raw_peaks. Points without a value (null or NaN) are passed over; null tracks too; an empty table gives none.
    """
    return _peaks(points, track, order, value, window, radius, least, merge_m)


def _peaks(points: DataFrame, track: str, order: list[str], value: str, window: int, radius: int, least: float | None, merge_m: float | None) -> DataFrame:
    rest = [c for c in points.columns if c not in (track, "i", "s", "prominence")]
    kinds = dict(points.dtypes)

    def peaks_of(group: pa.Table) -> pa.Table:
        (v,) = numbers(group, value)
        s = moving_mean(v, window)
        at = maxima(s, radius)
        high = prominence(s, at) if len(at) else np.zeros(0)
        if least is not None:
            at, high = at[high >= least], high[high >= least]
        if merge_m is not None and len(at):
            kept = kept_peaks(v[at], at, *(c[at] for c in numbers(group, "lat", "lon")), merge_m)
            at, high = at[kept], high[kept]
        own = group.take(pa.array(at)).select([track, *rest])
        return own.append_column("i", pa.array(at.astype(np.int32))).append_column("s", pa.array(s[at])).append_column("prominence", pa.array(high))

    known = points.where(F.col(track).isNotNull() & F.col(value).isNotNull() & ~F.isnan(value)).select(track, *rest)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (track, *rest)) + ", i int, s double, prominence double"
    return _by_track(known, [track], order, peaks_of, schema)


def merged_peaks(peaks: DataFrame, keys: list[str], value: str, distance_m: float) -> DataFrame:
    """Greedy suppression of near peaks per keys (see kept_peaks), of peaks with i, lat, lon. Null keys are passed over."""

    def kept(group: pa.Table) -> pa.Table:
        v, i, lat, lon = numbers(group, value, "i", "lat", "lon")
        return group.take(pa.array(kept_peaks(v, i, lat, lon, distance_m)))

    rows = peaks.where(reduce(and_, (F.col(k).isNotNull() for k in keys)))
    return _by_track(rows, keys, ["i"], kept, ", ".join(f"`{c}` {t}" for c, t in rows.dtypes))


#: The usual parameters and four variations of them.
VARIANTS = (("baseline", 5, 10, 30.0, 100.0), ("lower_prominence", 5, 10, 20.0, 100.0), ("higher_prominence", 5, 10, 50.0, 100.0), ("smaller_merge", 5, 10, 30.0, 50.0), ("larger_merge", 5, 10, 30.0, 200.0))


def sweep(points: DataFrame, track: str, order: list[str], value: str, variants=VARIANTS) -> DataFrame:
    """Per variant: tracks, peaks, tracks with none, one and several, median and maximum per track. All variants in one pass over each track."""

    def counts(group: pa.Table) -> pa.Table:
        every, lat, lon = numbers(group, value, "lat", "lon")
        known = ~np.isnan(every)
        v, lat, lon = every[known], lat[known], lon[known]
        smooth = {w: moving_mean(v, w) for w in {x[1] for x in variants}}
        raw = {}
        for w, r in {x[1:3] for x in variants}:
            at = maxima(smooth[w], r)
            raw[w, r] = at, prominence(smooth[w], at) if len(at) else np.zeros(0)
        found = []
        for _, w, r, least, near in variants:
            at, high = raw[w, r]
            at = at[high >= least]
            found.append(len(kept_peaks(v[at], at, lat[at], lon[at], near)))
        return pa.table({"variant_id": pa.array([x[0] for x in variants], pa.string()), "c": pa.array(found, pa.int64())})

    per = _by_track(points.where(F.col(track).isNotNull()).select(track, *order, "lat", "lon", F.col(value).cast("double").alias(value)), [track], order, counts, "variant_id string, c bigint")
    return per.groupBy("variant_id").agg(
        F.count("*").alias("gpx_files_scanned"), F.sum("c").alias("total_candidates"), F.count_if(F.col("c") == 0).alias("files_with_zero_candidates"), F.count_if(F.col("c") == 1).alias("files_with_one_candidate"),
        F.count_if(F.col("c") > 1).alias("files_with_multiple_candidates"), F.median("c").alias("median_candidates_per_file"), F.max("c").alias("max_candidates_per_file"),
    )


def track_profile(points: DataFrame, track: str, order: list[str]) -> DataFrame:
    """Per track: points, points with elevation, first and last written time, highest, lowest and range of elevation."""
    at, known = F.struct(*order), ~F.isnan("ele")
    ele = F.when(known, F.col("ele"))
    return points.groupBy(track).agg(
        F.count("*").alias("trackpoint_count"), F.count(ele).alias("valid_elevation_point_count"), F.min_by("time", at).alias("first_time"), F.max_by("time", at).alias("last_time"),
        F.round(F.max(ele), 2).alias("max_elevation"), F.round(F.min(ele), 2).alias("min_elevation"), F.round(F.max(ele) - F.min(ele), 2).alias("elevation_range"), (F.count(ele) < F.count("*")).alias("has_missing_elevation"),
    )


def around_nearest(points: DataFrame, anchors: DataFrame, track: str, max_m: float = 300.0, steps: int = 10, reach_m: float = 100.0) -> DataFrame:
    """Nearest point of the own track to each anchor (anchor, track, a_lat, a_lon), and how much of a peak it is.

    peak_like is one less the share of the local height range (points of the same segment within steps and reach_m) that lies
    above it; one if the range is nothing. points: track, seg_idx, pt_idx, lat, lon, ele, and trk_idx where a file holds
    several tracks, all of which are searched; equal distances go to the first in document order. Anchors farther than max_m
    from their file give no row.
    """
    part = [c for c in ("trk_idx", "seg_idx") if c in points.columns]
    at = [*part, "pt_idx"]
    pairs = pairs_within(points, anchors, track, max_m).withColumnRenamed("distance_m", "d")
    best = pairs.groupBy("anchor", track).agg(F.min_by(F.struct(*at, "lat", "lon", "ele", "d"), F.struct("d", *at)).alias("b"))
    same = reduce(and_, (F.col(f"q.{c}") == F.col(f"b.{c}") for c in part))
    part_of = lambda c: F.floor(F.col(c) / (2 * steps + 1))  # noqa: E731 - neighbours by index lie in the same stretch or the next
    best = best.withColumn("_s", F.explode(F.sequence(part_of("b.pt_idx") - 1, part_of("b.pt_idx") + 1)))
    near = points.withColumn("_s", part_of("pt_idx")).alias("q").join(best.alias("k"), [track, "_s"]).where(same & (F.abs(F.col("q.pt_idx") - F.col("b.pt_idx")) <= steps))
    near = near.where(haversine_m(F.col("q.lat"), F.col("q.lon"), F.col("b.lat"), F.col("b.lon")) <= reach_m)
    local = near.groupBy("anchor", track, "b").agg(F.count("*").alias("points"), F.max("q.ele").alias("high"), F.min("q.ele").alias("low"))
    like = F.when(F.col("high") > F.col("low"), 1 - (F.col("high") - F.col("b.ele")) / (F.col("high") - F.col("low"))).otherwise(1.0)
    return local.select("anchor", track, *(F.col(f"b.{c}").alias(c) for c in at), F.col("b.d").alias("distance_m"), "points", (F.col("high") - F.col("low")).alias("local_range"), F.least(F.greatest(like, F.lit(0.0)), F.lit(1.0)).alias("peak_like"))
