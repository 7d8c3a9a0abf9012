"""Candidate links by several kinds of evidence, anchored searches with fallback, duplicates between pools, clusters, rollups."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarn.functions.geo import finite, haversine_m, haversine_np
from tarn.operators.linkage import last_wins, names_in_texts
from tarn.operators.nearby import within_radius
from tarn.operators.tracks import groups, in_track_order, numbers
from tarn.session import broadcast_if_small, cut_lineage


def within_band(regions: DataFrame, points: DataFrame, value: str, width: float) -> DataFrame:
    """(region, id) of regions (region, value) and points (id, value) whose values differ by at most width: an equi-join on bands."""
    band = lambda c: F.floor(F.col(c) / width)
    a = regions.where(finite(F.col(value))).select("region", F.col(value).alias("_a")).withColumn("_band", F.explode(F.sequence(band("_a") - 1, band("_a") + 1)))
    b = points.where(finite(F.col(value))).select("id", F.col(value).alias("_b")).withColumn("_band", band("_b"))
    return b.join(broadcast_if_small(a, 300_000), "_band").where(F.abs(F.col("_a") - F.col("_b")) <= width).select("region", "id")


def evidence_links(regions: DataFrame, points: DataFrame, height_m: float, radius_m: float) -> DataFrame:
    """(region, id, by_name, by_height, by_place) of all pairs that some evidence links; each kind is an equi-join of its own.

    regions: region, name, height, lat, lon; points: id, text, height, lat, lon; each row once, any column may be null.
    """
    names = names_in_texts(regions.select(F.col("region").alias("number"), "name"), points.select("id", "text")).select(F.col("number").alias("region"), "id")
    near = within_radius(regions.select("region", "lat", "lon"), points.select("id", "lat", "lon"), radius_m).select("region", "id")
    kinds = {"by_name": names, "by_height": within_band(regions, points, "height", height_m), "by_place": near}
    parts = [df.select("region", "id", *(F.lit(k == kind).alias(k) for k in kinds)) for kind, df in kinds.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("region", "id").agg(*(F.bool_or(k).alias(k) for k in kinds))


def with_fallback(first: DataFrame, second: DataFrame, points: DataFrame, first_m: float, second_m: float) -> DataFrame:
    """Points near the first anchors (region, lat, lon), and for regions without any near the second ones; anchor says which: first or second."""
    found = within_radius(first, points, first_m).withColumn("anchor", F.lit("first"))
    rest = second.join(found.select("region").distinct(), "region", "left_anti")
    return found.unionByName(within_radius(rest, points, second_m).withColumn("anchor", F.lit("second")))


def uncontested(pairs: DataFrame, strict: Column, apart_m: float) -> DataFrame:
    """Of pairs (region, id, p_lat, p_lon) those that hold strictly, and whose region has no other point farther than apart_m from theirs.

    Regions whose points spread over more than a box of twice apart_m can have none; only the points of the others are compared.
    """
    span = lambda c: F.max(c) - F.min(c)
    wide = 2.02 * apart_m / 111_000.0
    box = pairs.groupBy("region").agg(span("p_lat").alias("_h"), (span("p_lon") * F.cos(F.radians(F.max(F.abs("p_lat"))))).alias("_w"))
    tight = pairs.join(box.where((F.col("_h") <= wide) & (F.col("_w") <= wide)).select("region"), "region")
    places = tight.select("region", F.col("p_lat").alias("_y"), F.col("p_lon").alias("_x")).distinct()
    held = tight.where(strict)
    contested = held.join(places, "region").where(haversine_m(F.col("p_lat"), F.col("p_lon"), F.col("_y"), F.col("_x")) > apart_m)
    return held.join(contested.select("region", "id").distinct(), ["region", "id"], "left_anti")


def resolved_pools(canonical: DataFrame, supplemental: DataFrame, radius_m: float) -> DataFrame:
    """(pool, id, role, duplicate_of) of two pools (id, lat, lon): a supplemental point within radius_m of a canonical one is a fallback for the nearest of them.

    Every row of either pool comes out once; points without coordinates are near nothing.
    """
    near = within_radius(canonical.select(F.col("id").alias("region"), "lat", "lon"), supplemental.select("id", "lat", "lon"), radius_m)
    d = haversine_m(F.col("r_lat"), F.col("r_lon"), F.col("p_lat"), F.col("p_lon"))
    best = near.groupBy("id").agg(F.min_by("region", F.struct(d.alias("d"), F.col("region"))).alias("duplicate_of"))
    own = canonical.select(F.lit("canonical").alias("pool"), "id", F.lit("canonical").alias("role"), F.lit(None).cast(dict(canonical.dtypes)["id"]).alias("duplicate_of"))
    other = supplemental.join(best, "id", "left")
    return own.unionByName(other.select(F.lit("supplemental").alias("pool"), "id", F.when(F.col("duplicate_of").isNull(), "supplemental").otherwise("fallback").alias("role"), "duplicate_of"))


def with_lookups(rows: DataFrame, *lookups: tuple[DataFrame, str, str]) -> DataFrame:
    """rows left-joined to lookup tables (table, key, order): of equal keys the last by order counts, so rows stay as many as they are."""
    for table, key, order in lookups:
        rows = rows.join(last_wins(table.where(F.col(key).isNotNull()), key, order).drop(order), key, "left")
    return rows


def split_covers(every: DataFrame, *parts: DataFrame) -> DataFrame:
    """One row: rows, rows of all parts, those missing and those too many; passed if the parts are exactly all rows, as bags."""
    union = reduce(DataFrame.unionByName, parts)
    marked = every.withColumn("_n", F.lit(1)).unionByName(union.withColumn("_n", F.lit(-1))).groupBy(*every.columns).agg(F.sum("_n").alias("_n"), F.count_if(F.col("_n") > 0).alias("_all"), F.count_if(F.col("_n") < 0).alias("_parts"))
    row = marked.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in ((F.col("_all"), "rows"), (F.col("_parts"), "in_parts"), (F.greatest(F.col("_n"), F.lit(0)), "missing"), (F.greatest(-F.col("_n"), F.lit(0)), "too_many"))))
    return row.withColumn("passed", (F.col("missing") == 0) & (F.col("too_many") == 0))


def supported_names(df: DataFrame, key: str, levels: dict[str, Column]) -> DataFrame:
    """(key, level, name, support, place): distinct names of each level per key with how many rows have them, by support, then name."""
    pairs = F.array(*(F.struct(F.lit(k).alias("level"), F.trim(v).alias("name")) for k, v in levels.items()))
    counts = df.select(key, F.explode(pairs).alias("p")).select(key, "p.*").where("name <> ''").groupBy(key, "level", "name").agg(F.count("*").alias("support"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy(key, "level").orderBy(F.desc("support"), "name")))


def _linked(lat: np.ndarray, lon: np.ndarray, reach_m: float) -> np.ndarray:
    """Number of the cluster of each point: points within reach_m of each other are linked, however many between. Cells are compared with the next ones only."""
    step = reach_m / 111_000.0
    wide = step / max(0.01, float(np.cos(np.radians(min(89.0, np.abs(lat).max() + step)))))
    cells: dict[tuple[int, int], list[int]] = {}
    for k, cell in enumerate(zip((lat // step).astype(int).tolist(), (lon // wide).astype(int).tolist())):
        cells.setdefault(cell, []).append(k)
    parent = list(range(len(lat)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    for (y, x), own in cells.items():
        near = np.array([m for a, b in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1)) for m in cells.get((y + a, x + b), ())])
        for k in own:
            for m in near[haversine_np(lat[k], lon[k], lat[near], lon[near]) <= reach_m].tolist():
                parent[root(m)] = root(k)
    return np.unique([root(k) for k in range(len(lat))], return_inverse=True)[1]


def clusters(df: DataFrame, key: str, lat: str, lon: str, reach_m: float) -> DataFrame:
    """(key, clusters, points, largest, consensus) of the places of each key: single, conflict if clusters lie apart, weak if the largest holds no more than half.

    Places are counted before the shuffle, to a tenth of a metre; a task holds the distinct places of one key. Rows without
    finite coordinates or key count nowhere.
    """
    places = df.where(F.col(key).isNotNull() & finite(F.col(lat)) & finite(F.col(lon))).groupBy(key, F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon")).agg(F.count("*").alias("n"))
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, (key,)):
            y, x, n = numbers(group, "lat", "lon", "n")
            sizes = np.bincount(_linked(y, x, reach_m), n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([group[key].slice(0, 1).combine_chunks(), *(pa.array([int(v)], pa.int64()) for v in (len(sizes), sizes.sum(), sizes.max()))], [key, "clusters", "points", "largest"])

    found = in_track_order(places, key, order=("lat", "lon")).mapInArrow(run, f"`{key}` {kind}, clusters bigint, points bigint, largest bigint")
    consensus = F.when(F.col("clusters") == 1, "single").when(F.col("largest") * 2 > F.col("points"), "conflict").otherwise("weak")
    return found.withColumn("consensus", consensus)


def compared(before: DataFrame, after: DataFrame, dimension: str) -> DataFrame:
    """(dimension, before, after, change) of row counts per value; null as empty text; values of either side."""
    count = lambda df, n: df.groupBy(F.coalesce(F.col(dimension).cast("string"), F.lit("")).alias("value")).agg(F.count("*").alias(n))
    both = count(before, "before").join(count(after, "after"), "value", "full").na.fill(0)
    return both.select(F.lit(dimension).alias("dimension"), "value", "before", "after", (F.col("after") - F.col("before")).alias("change"))


def direct_first(tracks: DataFrame, activities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(track, activity) of tracks (track, direct, ...) whose direct id is an activity's, and the tracks that have none, for all other matching."""
    known = activities.select("activity").distinct()
    found = tracks.where("direct is not null").join(known, F.col("direct") == F.col("activity")).groupBy("track").agg(F.min("activity").alias("activity"))
    found = cut_lineage(found)
    return found, tracks.join(found.select("track"), "track", "left_anti").drop("direct")
