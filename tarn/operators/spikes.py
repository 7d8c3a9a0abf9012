"""Implausible readings of a source, relative to that source's own behaviour.

A robust autoregression of order one is fitted to the steps between a source's sound readings: the scale is the 95th
percentile of the steps, and the coefficient the lag-one autocorrelation of the steps clipped at it. A residual beyond the
limit opens a test of one to four readings: taken out as additive outliers, is what comes behind them still a level shift
against the course the model foretells? If it is, for every length, the residual is a level shift and no reading is flagged;
else the readings are outliers if each stands off from the course by the limit. The model is fitted anew each time readings
were set aside, until none is found. Stuck runs and physical limits are flagged apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tarn.functions.geo import finite, haversine_np
from tarn.operators.tracks import groups, hot_tracks, in_track_order, numbers, over_blocks, seconds_of, split_hot
from tarn.session import cut_lineage

KEY = ("trk_idx", "seg_idx", "pt_idx")


@dataclass(frozen=True)
class SpikeParameters:
    low: float = -50.0
    high: float = 2600.0
    min_jump: float = 30.0
    step_times: float = 9.0
    step_quantile: float = 0.95
    longest: int = 4
    stuck_run: int = 20
    stuck_distance_m: float = 200.0
    range_tolerance: float = 60.0


def stuck_readings(ele: np.ndarray, lat: np.ndarray, lon: np.ndarray, p: SpikeParameters) -> np.ndarray:
    """Mask of readings in long runs of equal values whose first and last fix are far apart; fixes without a position are passed over."""
    flag = np.zeros(len(ele), bool)
    cuts = np.r_[0, np.flatnonzero(np.diff(ele) != 0) + 1, len(ele)]
    for k in np.flatnonzero(np.diff(cuts) >= p.stuck_run):
        a, b = cuts[k], cuts[k + 1]
        placed = np.flatnonzero(np.isfinite(lat[a:b]) & np.isfinite(lon[a:b]) & (lat[a:b] != 0) & (lon[a:b] != 0)) + a
        if len(placed) > 1:
            first, last = _placed_ends(lat, lon, placed)
            flag[a:b] = haversine_np(lat[first], lon[first], lat[last], lon[last]) > p.stuck_distance_m
    return flag


def _placed_ends(lat: np.ndarray, lon: np.ndarray, placed: np.ndarray) -> tuple[int, int]:
    """First and last fix that are not stray: within 300 m of the median of the five fixes nearest to them in the run."""

    def sound(order: np.ndarray) -> int:
        near = order[:5]
        far = haversine_np(np.median(lat[near]), np.median(lon[near]), lat[near], lon[near])
        fit = near[far <= 300]
        return int(fit[0] if len(fit) else order[0])

    return sound(placed), sound(placed[::-1])


@dataclass(frozen=True)
class StepModel:
    """Autoregression of a source's steps: scale is their quantile, phi their coefficient, limit what a residual may reach."""

    scale: float
    phi: float
    limit: float


def fitted(step: np.ndarray, p: SpikeParameters) -> StepModel:
    scale = float(np.quantile(np.abs(step), p.step_quantile))
    clipped = np.clip(step, -scale, scale)
    return StepModel(scale, coefficient(float(clipped[1:] @ clipped[:-1]), float(clipped[:-1] @ clipped[:-1])), limit_of(scale, p))


def coefficient(lagged: float, square: float) -> float:
    """Of the sums of products of neighbours and of squares; within 0.95, rounded so that the order of summing doesn't matter."""
    return round(min(0.95, max(-0.95, lagged / square)), 9) if square > 0 else 0.0


def limit_of(scale: float, p: SpikeParameters) -> float:
    return max(p.min_jump, p.step_times * scale)


def outliers(t: np.ndarray, v: np.ndarray, p: SpikeParameters) -> np.ndarray:
    """Mask of additive outliers of one to p.longest readings; values finite, t ascending."""
    flag = np.zeros(len(v), bool)
    while (kept := np.flatnonzero(~flag)).size > 2:
        step = np.diff(v[kept])
        new = additive(t[kept], v[kept], step, fitted(step, p), p.longest)
        if not new:
            break
        flag[kept[new]] = True
    return flag


def additive(t: np.ndarray, v: np.ndarray, step: np.ndarray, model: StepModel, longest: int) -> list[int]:
    """Readings of one round that are additive outliers; step[i] leads from reading i to the next.

    A step is foretold as phi times the clipped step before it. A residual of over 0.38 limits opens a test: as a jump over
    half the limit has one, no outlier is passed over.
    """
    found: list[int] = []
    taken = -1
    usual = np.clip(step, -model.scale, model.scale)
    residual = np.abs(step - model.phi * np.r_[0.0, usual[:-1]])
    for i in np.flatnonzero(residual > 0.38 * model.limit).tolist():
        if i < taken:
            continue
        before = v[i]
        slope, course = usual[i - 1] if i else 0.0, before
        for size in range(1, longest + 1):
            j = i + size + 1
            if j >= len(v):
                break
            slope *= model.phi
            course += slope
            after = v[j]
            if min(abs(after - before), abs(after - course - slope * model.phi)) > model.limit:  # a level shift, or still within the spike
                continue
            span = t[j] - t[i]
            share = (t[i + 1 : j] - t[i]) / span if span > 0 else np.arange(1, size + 1) / (size + 1)
            off = np.abs(v[i + 1 : j] - (before + share * (after - before)))
            if off.min() > model.limit:
                found += range(i + 1, j)
                taken = j
                break
    return found


def judge(t: np.ndarray, ele: np.ndarray, lat: np.ndarray, lon: np.ndarray, p: SpikeParameters) -> np.ndarray:
    """Mask of implausible readings, in time order; null readings are left out by the caller."""
    with np.errstate(invalid="ignore"):
        flag = ~np.isfinite(ele) | (ele < p.low) | (ele > p.high)
    sound = np.flatnonzero(~flag)
    stuck = stuck_readings(ele[sound], lat[sound], lon[sound], p)
    flag[sound[stuck]] = True
    rest = sound[~stuck]
    flag[rest[outliers(t[rest], ele[rest], p)]] = True
    return flag


FOUND = "gpx_path string, trk_idx int, seg_idx int, pt_idx int"


def _flags(p: SpikeParameters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths: list[str] = []
        keys: list[np.ndarray] = []
        for group in groups(batches, ("gpx_path",)):
            path = group["gpx_path"][0].as_py()
            has, kind = np.array(group["has_ele"].to_numpy(zero_copy_only=False), bool), np.array(group["summary"].to_numpy(zero_copy_only=False), bool)
            t, ele, lat, lon, *key = numbers(group, "t", "ele", "lat", "lon", *KEY)
            key = np.stack(key, 1)
            fix = np.flatnonzero(~kind)
            order = fix[np.lexsort((key[fix, 2], key[fix, 1], key[fix, 0]))]
            order = order[np.r_[True, (np.diff(key[order], axis=0) != 0).any(1)]] if len(order) else order
            at = _filled(t[order])
            order = order[np.argsort(at, kind="stable")]
            at = np.sort(at, kind="stable")
            read = has[order]
            order, at = order[read], at[read]
            flag = judge(at, ele[order], lat[order], lon[order], p)
            own = order[flag]
            sound = ele[order[~flag]]
            out = [key[own]]
            if kind.any() and len(sound):
                shown = ele[kind & has]
                with np.errstate(invalid="ignore"):
                    if (~(np.abs(shown - (sound.max() - sound.min())) <= p.range_tolerance)).any():
                        out.append(np.full((1, 3), -1.0))
            out = np.concatenate(out)
            if len(out):
                keys.append(out)
                paths += [path] * len(out)
            if len(paths) > 20_000:
                yield _batch(paths, keys)
                paths, keys = [], []
        yield _batch(paths, keys)

    return run


def _filled(t: np.ndarray) -> np.ndarray:
    """Times in document order, each missing one taken from the fix before it (the first ones from the fix after)."""
    known = np.flatnonzero(~np.isnan(t))
    if len(known) in (0, len(t)):
        return np.arange(len(t), dtype=float) if not len(known) else t
    return t[known[np.maximum(np.searchsorted(known, np.arange(len(t)), side="right") - 1, 0)]]


def _batch(paths: list[str], keys: list[np.ndarray]) -> pa.RecordBatch:
    key = np.concatenate(keys).astype(np.int32) if keys else np.zeros((0, 3), np.int32)
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), *(pa.array(key[:, i]) for i in range(3))], ["gpx_path", *KEY])


def implausible(fixes: DataFrame, summaries: DataFrame, p: SpikeParameters = SpikeParameters()) -> DataFrame:
    """(gpx_path, trk_idx, seg_idx, pt_idx) of implausible readings, and -1 in the indices for an implausible elevation_range.

    Null readings are none, NaN and infinite ones are flagged; rows without a time take their place in document order;
    re-delivered rows count once; rows with a null key are passed over; a summary of a track without sound readings, or
    without a figure, is not flagged. Either table may be empty. A hot track (see tracks) is judged by the same rules, as a
    whole, but by distributed steps over its blocks instead of in one task.
    """
    keys = [F.coalesce(F.col(k), F.lit(0)).cast("int").alias(k) for k in KEY]
    rows = fixes.where("gpx_path is not null and trk_idx is not null and seg_idx is not null and pt_idx is not null").select(
        "gpx_path", *keys, F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.col("ele").cast("double").alias("ele"), seconds_of(F.col("time")).alias("t"), F.lit(False).alias("summary")
    )
    null = F.lit(None).cast("double")
    heads = summaries.where("gpx_path is not null").select(
        "gpx_path", *(F.lit(-1).alias(k) for k in KEY), null.alias("lat"), null.alias("lon"), F.col("elevation_range").cast("double").alias("ele"), null.alias("t"), F.lit(True).alias("summary")
    )
    found_hot = hot_tracks(fixes, "gpx_path")
    usual, hot, heads_of_hot = rows, None, None
    if found_hot is not None:
        usual, hot = split_hot(rows, "gpx_path", found_hot)
        hot = cut_lineage(hot)
        names = hot.select("gpx_path").distinct()
        heads, heads_of_hot = heads.join(names, "gpx_path", "left_anti"), heads.join(names, "gpx_path", "left_semi")
    rows = usual.unionByName(heads).withColumn("has_ele", F.col("ele").isNotNull())
    found = in_track_order(rows, "gpx_path", order=()).mapInArrow(_flags(p), FOUND)
    return found if hot is None else found.unionByName(_of_hot(hot, heads_of_hot, p))


#: Points of a segment in a block of document order, and blocks of time order of a track.
DOCUMENT_BLOCK, TIME_BLOCKS = 50_000, 256


def _of_hot(rows: DataFrame, heads: DataFrame, p: SpikeParameters) -> DataFrame:
    """As _flags, of tracks too long for one task: block by block (see over_blocks), only what lies round jumps goes to Python."""
    rows = rows.drop("summary").dropDuplicates(["gpx_path", *KEY]).withColumn("t", F.when(~F.isnan("t"), F.col("t")))
    first = rows.where("t is not null").groupBy("gpx_path").agg(F.min_by("t", F.struct(*KEY)).alias("_first"))
    rows = rows.withColumn("block", F.struct("trk_idx", "seg_idx", F.floor(F.col("pt_idx") / DOCUMENT_BLOCK).alias("part")))
    rows = over_blocks(rows, "gpx_path", "block", KEY, last={"_known": "t"}, total={"_n": F.lit(1)})
    rows = rows.join(first, "gpx_path", "left").withColumn("t", F.coalesce("_known", "_first", F.col("_n").cast("double"))).where("ele is not null")
    wild = ~finite(F.col("ele")) | (F.col("ele") < p.low) | (F.col("ele") > p.high)
    rows = cut_lineage(rows.select("gpx_path", *KEY, "lat", "lon", "ele", "t", wild.alias("wild")))
    shares = [k / TIME_BLOCKS for k in range(1, TIME_BLOCKS)]
    cuts = rows.groupBy("gpx_path").agg(F.array_distinct(F.percentile_approx("t", shares, 10 * TIME_BLOCKS)).alias("_cuts"))
    sound = rows.where("not wild").drop("wild").join(F.broadcast(cuts), "gpx_path").withColumn("block", F.size(F.filter("_cuts", lambda c: c <= F.col("t")))).drop("_cuts")  # a row for each hot track
    in_time = ("t", *KEY)
    sound = over_blocks(sound, "gpx_path", "block", in_time, lag={"_before": "ele"}, total={"_n": F.lit(1)})
    sound = sound.withColumn("_start", F.when(F.col("_before").isNull() | (F.col("ele") != F.col("_before")), F.col("_n")))
    sound = cut_lineage(over_blocks(sound, "gpx_path", "block", in_time, last={"run": "_start"}).drop("_before", "_n", "_start"))
    stuck = _stuck_runs(sound, p)
    rest = cut_lineage(sound.join(stuck, ["gpx_path", "run"], "left_anti").select("gpx_path", *KEY, "ele", "t", "block"))
    more = True
    while more:
        rest, more = _without_outliers(rest, p)
    flagged = rows.select("gpx_path", *KEY).join(rest.select("gpx_path", *KEY), ["gpx_path", *KEY], "left_anti")
    width = rest.groupBy("gpx_path").agg((F.max("ele") - F.min("ele")).alias("_w"))
    wrong = heads.where(F.col("ele").isNotNull()).join(width, "gpx_path").where(~F.coalesce(F.abs(F.col("ele") - F.col("_w")) <= p.range_tolerance, F.lit(False)))
    return flagged.unionByName(wrong.select("gpx_path", *KEY).distinct())


def _stuck_runs(sound: DataFrame, p: SpikeParameters) -> DataFrame:
    """(gpx_path, run) of stuck runs: of the long ones the five placed fixes at either end are enough."""
    long = sound.groupBy("gpx_path", "run").count().where(F.col("count") >= p.stuck_run).drop("count")
    placed = finite(F.col("lat")) & finite(F.col("lon")) & (F.col("lat") != 0) & (F.col("lon") != 0)
    own = sound.join(long, ["gpx_path", "run"]).where(placed)
    at, run = ("t", *KEY), Window.partitionBy("gpx_path", "run")
    ends = [own.withColumn("_a", F.row_number().over(run.orderBy(*(way(c) for c in at)))).where("_a <= 5").drop("_a") for way in (F.asc, F.desc)]  # limited before the shuffle
    ends = ends[0].unionByName(ends[1]).distinct()

    def far(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([*at])
        lat, lon = group["lat"].to_numpy(), group["lon"].to_numpy()
        apart = 0.0
        if len(group) > 1:
            a, b = _placed_ends(lat, lon, np.arange(len(group)))
            apart = haversine_np(lat[a], lon[a], lat[b], lon[b])
        return group[["gpx_path", "run"]].head(1 if apart > p.stuck_distance_m else 0)

    return ends.select("gpx_path", "run", "lat", "lon", *at).groupBy("gpx_path", "run").applyInPandas(far, "gpx_path string, run bigint")


def _without_outliers(rest: DataFrame, p: SpikeParameters) -> tuple[DataFrame, bool]:
    """One round of outliers() for each track: (rows without its outliers, whether any was found)."""
    at = ("t", *KEY)
    rows = over_blocks(rest, "gpx_path", "block", at, lag={"_before": "ele"}, lead={"_after": "ele"}, total={"n": F.lit(1)})
    rows = cut_lineage(rows.withColumns({"step": F.col("_after") - F.col("ele"), "last": F.col("ele") - F.col("_before")}).drop("_before", "_after"))
    models = _models(rows, p)
    clip = lambda c: F.greatest(F.least(F.col(c), F.col("scale")), -F.col("scale"))
    rows = rows.join(F.broadcast(models), "gpx_path")  # a row for each hot track
    # a jump reaches over longest + 1 readings behind it and one before; those of jumps that meet are judged together, in order
    residual = F.abs(F.col("step") - F.col("phi") * F.coalesce(clip("last"), F.lit(0.0)))
    rows = rows.withColumn("_j", F.when(residual > 0.37 * F.col("limit"), F.col("n")))
    rows = over_blocks(rows, "gpx_path", "block", at, lead={"_next": "_j"}, last={"_jump": "_j"})
    near = F.coalesce(F.col("n") - F.col("_jump") <= p.longest + 1, F.lit(False)) | F.col("_next").isNotNull()
    rows = over_blocks(rows.withColumn("_near", near), "gpx_path", "block", at, lag={"_was": "_near"})
    rows = over_blocks(rows.withColumn("_start", F.when(F.col("_near") & ~F.coalesce("_was", F.lit(False)), F.col("n"))), "gpx_path", "block", at, last={"part": "_start"})

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths: list[str] = []
        keys: list[np.ndarray] = []
        for group in groups(batches, ("gpx_path", "part")):
            t, ele, step, scale, phi, limit, *key = numbers(group, "t", "ele", "step", "scale", "phi", "limit", *KEY)
            end = len(t) - 1  # a last step leads out of the part
            found = additive(t, ele, step[:end], StepModel(float(scale[0]), float(phi[0]), float(limit[0])), p.longest)
            if found:
                keys.append(np.stack(key, 1)[found])
                paths += [group["gpx_path"][0].as_py()] * len(found)
            if len(paths) > 20_000:
                yield _batch(paths, keys)
                paths, keys = [], []
        yield _batch(paths, keys)

    spread = in_track_order(rows.where("_near").select("gpx_path", "part", "n", "t", "ele", "step", "scale", "phi", "limit", *KEY), "gpx_path", "part", order=("n",))
    new = cut_lineage(spread.mapInArrow(judged, FOUND))
    if new.isEmpty():
        return rest, False
    return cut_lineage(rest.join(new, ["gpx_path", *KEY], "left_anti")), True


def _models(rows: DataFrame, p: SpikeParameters) -> DataFrame:
    """(gpx_path, scale, phi, limit) of tracks: fitted(), with the quantile found among counted steps, in blocks of their size."""
    steps = rows.where("step is not null").groupBy("gpx_path", F.abs("step").alias("size")).count()
    steps = steps.withColumn("block", F.least(F.floor(F.col("size") * 20), F.lit(20_000)))
    ranks = over_blocks(steps, "gpx_path", "block", ("size",), total={"upto": F.col("count")})
    ranks = ranks.join(F.broadcast(steps.groupBy("gpx_path").agg(((F.sum("count") - 1) * p.step_quantile).alias("at"))), "gpx_path")
    at = lambda k: F.min(F.when(F.col("upto") > k, F.col("size")))
    values = ranks.groupBy("gpx_path").agg(at(F.floor("at")).alias("lo"), at(F.ceil("at")).alias("hi"), F.first("at").alias("at"))
    scales = values.select("gpx_path", (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - F.floor("at"))).alias("scale"))
    clip = lambda c: F.greatest(F.least(F.col(c), F.col("scale")), -F.col("scale"))
    sums = rows.where("step is not null and last is not null").join(F.broadcast(scales), "gpx_path").groupBy("gpx_path").agg(F.sum(clip("step") * clip("last")).alias("lagged"), F.sum(clip("last") * clip("last")).alias("square"))
    phi = F.coalesce(F.when(F.col("square") > 0, F.round(F.greatest(F.lit(-0.95), F.least(F.lit(0.95), F.col("lagged") / F.col("square"))), 9)), F.lit(0.0))
    return scales.join(sums, "gpx_path", "left").select("gpx_path", "scale", phi.alias("phi"), F.greatest(F.lit(p.min_jump), p.step_times * F.col("scale")).alias("limit"))
