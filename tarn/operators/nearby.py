"""Points near other points or in regions, by an adaptive cover of grid cells.

Every region is covered by quadtree cells of several levels. A cell wholly inside is an interior cell, and a point in it is
accepted by the equi-join alone; only points in boundary cells get an exact test. Cells at level L are 180 / 2^L degrees wide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tarn.functions.geo import EARTH_M, finite, haversine_m, haversine_np
from tarn.session import cut_lineage, scatter

COVER = "level int, cell bigint, interior boolean"
#: Rows of a cover, and edges in them, that may be broadcast (about 40 bytes each); a larger one is joined by shuffle, with salt.
BROADCAST_CELLS = 200_000
SALT = 16


def _disc_state(lat: float, lon: float, radius: float, south, west, size) -> np.ndarray:
    """2 inside, 1 boundary, 0 outside, of cells of one size; margins make boundary out of what is close."""
    north, east = south + size, west + size
    far = np.maximum.reduce([haversine_np(lat, lon, a, b) for a in (south, north) for b in (west, east)])
    near = haversine_np(lat, lon, np.clip(lat, south, north), np.clip(lon, west, east))
    inside = (far * 1.001 <= radius) & (np.abs(south) < 88) & (size < 5)
    return np.where(inside, 2, np.where(near * 0.99 - 1 > radius, 0, 1))


def _cover(south: float, west: float, north: float, east: float, state: Callable, depth: int) -> list[tuple[int, int, bool]]:
    """Cells of a box: from the finest level at which the box spans few cells, boundary cells are split depth times."""
    span = max(north - south, east - west, 1e-7)
    level = max(1, int(np.floor(np.log2(180 / span))))
    size = 180 / 2**level
    iy, ix = np.arange(int((south + 90) // size), int((north + 90) // size) + 1), np.arange(int((west + 180) // size), int((east + 180) // size) + 1)
    ix, iy = (a.ravel() for a in np.meshgrid(ix, iy))
    found = []
    for step in range(depth + 1):
        is_in = state(iy * size - 90, ix * size - 180, size)
        wrap = 2 ** (level + 1)
        keep = [(level, int(x % wrap) << 30 | int(y), bool(s == 2)) for x, y, s in zip(ix, iy, is_in) if s == 2 or (s == 1 and step == depth)]
        found += keep
        ix, iy = ix[is_in == 1], iy[is_in == 1]
        ix, iy = np.concatenate([2 * ix + a for a in (0, 1, 0, 1)]), np.concatenate([2 * iy + b for b in (0, 0, 1, 1)])
        level, size = level + 1, size / 2
    return found


def _covered(df: DataFrame, schema: str, cells_of: Callable[[tuple], list]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(*row, *cell) for row in batch.itertuples(index=False) for cell in cells_of(row)]
            yield pd.DataFrame(rows, columns=[*batch.columns, "level", "cell", "interior"])

    return cut_lineage(scatter(df).mapInPandas(run, f"{schema}, {COVER}"))


def cover_discs(regions: DataFrame, radius_m: float, depth: int = 4) -> DataFrame:
    """Cover of discs of radius_m round (region, lat, lon); rows without finite coordinates give none."""
    rows = regions.select("region", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).where(finite(F.col("lat")) & finite(F.col("lon")))
    lat, lon = canonical(F.col("lat"), F.col("lon"))
    kind = dict(rows.dtypes)["region"]
    rows = rows.distinct().select("region", lat.alias("lat"), lon.alias("lon"))

    def cells(row: tuple) -> list:
        _, lat, lon = row
        dlat = np.degrees(radius_m / EARTH_M) * 1.01
        ratio = np.sin(min(radius_m / EARTH_M, np.pi / 2)) / max(np.cos(np.radians(lat)), 1e-12)
        dlon = 180.0 if ratio >= 1 or abs(lat) + dlat >= 90 else np.degrees(np.arcsin(ratio)) * 1.01
        return _cover(max(-90, lat - dlat), lon - dlon, min(90, lat + dlat), lon + dlon, lambda s, w, z: _disc_state(lat, lon, radius_m, s, w, z), depth)

    return _covered(rows, f"region {kind}, lat double, lon double", cells)


#: Edges in a boundary cell from which it is split further, and the most splits of a polygon's first cells.
CELL_EDGES, POLYGON_DEPTH = 24, 12
EDGE = "x1: double, y1: double, x2: double, y2: double"
POLYGON_COVER = f"{COVER}, centre_in boolean, edges array<struct<{EDGE}>>"


def _edges_of(rings: pa.ListScalar) -> np.ndarray:
    """(x1, y1, x2, y2) of the sides of rings, holes alike."""
    parts = [np.zeros((0, 4))]
    for ring in rings.values or ():
        if ring.is_valid:
            points = ring.values.drop_null()
            points = np.stack([points.field(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("x", "y")], 1)
            if len(points) > 2:
                parts.append(np.hstack([points, np.roll(points, -1, 0)]))
    edges = np.concatenate(parts)
    return edges[np.isfinite(edges).all(1)]


def _parity_change(edges: np.ndarray, x: float, y: float, to_x: float, to_y: float) -> bool:
    """Whether the even-odd state of (to_x, to_y) differs from that of (x, y): crossings on the way along x, then along y."""
    x1, y1, x2, y2 = edges.T
    with np.errstate(divide="ignore", invalid="ignore"):
        at = (x2 - x1) * (y - y1) / (y2 - y1) + x1
        along = ((y1 > y) != (y2 > y)) & ((x < at) != (to_x < at))
        at = (y2 - y1) * (to_x - x1) / (x2 - x1) + y1
        up = ((x1 > to_x) != (x2 > to_x)) & ((y < at) != (to_y < at))
    return bool((along.sum() + up.sum()) % 2)


def _touching(edges: np.ndarray, west: float, south: float, size: float) -> np.ndarray:
    """Edges that touch a cell, or come near it."""
    margin = size * 1e-9 + 1e-12
    w, e, s, n = west - margin, west + size + margin, south - margin, south + size + margin
    x1, y1, x2, y2 = edges.T
    near = (np.maximum(x1, x2) >= w) & (np.minimum(x1, x2) <= e) & (np.maximum(y1, y2) >= s) & (np.minimum(y1, y2) <= n)
    edges = edges[near]
    x1, y1, x2, y2 = edges.T
    side = np.stack([(x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) for x in (w, e) for y in (s, n)])
    return edges[(side.min(0) <= 0) & (side.max(0) >= 0)]


def _polygon_cells(edges: np.ndarray) -> Iterator[tuple]:
    """(level, cell, interior, centre_in, edges) of the cells of a polygon; a cell hands only its own edges to its quarters."""
    low, high = edges[:, :2].min(0), edges[:, :2].max(0)
    level = max(1, int(np.floor(np.log2(180 / max(*(high - low), 1e-7)))))
    size = 180 / 2**level
    first, last = ((low + (180, 90)) // size).astype(int), ((high + (180, 90)) // size).astype(int)
    outside = low[0] - 1.0, low[1] - 1.0
    todo = []
    for ix in range(first[0], last[0] + 1):
        for iy in range(first[1], last[1] + 1):
            middle = (ix + 0.5) * size - 180, (iy + 0.5) * size - 90
            todo.append((level, ix, iy, _parity_change(edges, *outside, *middle), edges))
    end = level + POLYGON_DEPTH
    while todo:
        level, ix, iy, inside, near = todo.pop()
        size = 180 / 2**level
        west, south = ix * size - 180, iy * size - 90
        near = _touching(near, west, south, size)
        cell = int(ix % 2 ** (level + 1)) << 30 | int(iy)
        if not len(near):
            if inside:
                yield level, cell, True, True, []
            continue
        if len(near) <= CELL_EDGES or level == end:
            yield level, cell, False, inside, [dict(zip(("x1", "y1", "x2", "y2"), map(float, e))) for e in near]
            continue
        x, y = west + size / 2, south + size / 2
        for a in (0, 1):
            for b in (0, 1):
                todo.append((level + 1, 2 * ix + a, 2 * iy + b, inside ^ _parity_change(near, x, y, west + (a + 0.5) * size / 2, south + (b + 0.5) * size / 2), near))


def cover_polygons(regions: DataFrame) -> DataFrame:
    """Cover of polygons (region, rings array<array<struct<x, y>>>), holes by even-odd; null or empty rings give none.

    A boundary cell holds what an exact test of a point in it needs: the state of its centre and the few edges that touch it.
    The polygon itself is not copied. Columns of regions other than these two are not read.
    """
    rows = regions.select("region", "rings").where("region is not null and rings is not null")
    kind = dict(rows.dtypes)["region"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, names = [], batch.column("region")
            kinds = [names.type, pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")]))]
            table = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["region", "level", "cell", "interior", "centre_in", "edges"])  # noqa: B023, E731
            for region, rings in zip(names, batch.column("rings")):
                edges = _edges_of(rings)
                for cell in _polygon_cells(edges) if len(edges) else ():
                    out.append((region.as_py(), *cell))
                    if len(out) == 5000:
                        yield table(out)
                        out = []
            yield table(out)

    return cut_lineage(scatter(rows).mapInArrow(run, f"region {kind}, {POLYGON_COVER}"))


def canonical(lat: Column, lon: Column) -> tuple[Column, Column]:
    """The same point with latitude within 90 and longitude within 180 degrees; the haversine is the same for both."""
    y = F.when(F.abs(lat) <= 90, lat).otherwise(F.degrees(F.asin(F.sin(F.radians(lat)))))
    x = F.when(F.abs(lat) <= 90, lon).otherwise(lon + F.when(F.cos(F.radians(lat)) < 0, 180.0).otherwise(0.0))
    return y, F.when(F.abs(x) <= 180, x).otherwise(F.pmod(x + 180, F.lit(360.0)) - 180)


def cell_of(lat: Column, lon: Column, level: int) -> Column:
    size = 180 / 2**level
    x = F.pmod(F.floor((lon + 180) / size), F.lit(2 ** (level + 1)))
    return F.shiftleft(x, 30).bitwiseOR(F.floor((lat + 90) / size))


def match_points(points: DataFrame, cover: DataFrame, exact: Column) -> DataFrame:
    """Rows of points (with lat, lon, and other columns than those of the cover) joined to the regions that hold them.

    exact is the test for points in boundary cells, over columns of points and of the cover, and _y and _x, a point's latitude
    and longitude within 90 and 180 degrees. Points without finite
    coordinates match nothing. One point is one row for each region that holds it, as often as it stands in points; cells
    don't overlap within a region. Columns of points that are named like some of the cover get the prefix p_. The cover is broadcast if its counted rows are few; else both sides are shuffled by
    cell, points salted, the cover copied to each salt, so that a cell with a third of all points is spread.
    """
    for clash in {*cover.columns} & {*points.columns}:
        points = points.withColumnRenamed(clash, f"p_{clash}")
    levels = sorted(r[0] for r in cover.select("level").distinct().collect())  # at most 60 values
    rows = points.where(finite(F.col("lat")) & finite(F.col("lon")))
    if not levels:
        return rows.withColumnRenamed("lat", "p_lat").withColumnRenamed("lon", "p_lon").join(cover, F.lit(False))
    y, x = canonical(F.col("lat").cast("double"), F.col("lon").cast("double"))
    rows = rows.withColumns({"_y": y, "_x": x})
    keys = F.array(*(F.struct(F.lit(level).alias("level"), cell_of(F.col("_y"), F.col("_x"), level).alias("cell")) for level in levels))
    rows = rows.withColumn("_k", F.explode(keys)).withColumnsRenamed({"lat": "p_lat", "lon": "p_lon"}).withColumns({"_level": F.col("_k.level"), "_cell": F.col("_k.cell")}).drop("_k")
    on = (F.col("_level") == F.col("level")) & (F.col("_cell") == F.col("cell"))
    weight = F.sum(1 + F.size("edges")) if "edges" in cover.columns else F.count("*")
    if cover.agg(weight).first()[0] <= BROADCAST_CELLS:
        joined = rows.join(F.broadcast(cover), on)
    else:
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("p_lat", "p_lon"), F.lit(SALT)))
        joined = rows.join(cover.withColumn("_copy", F.explode(F.array(*map(F.lit, range(SALT))))), on & (F.col("_salt") == F.col("_copy"))).drop("_salt", "_copy")
    return joined.where(F.col("interior") | exact).drop("_level", "_cell", "_y", "_x", "level", "cell", "interior")


def within_radius(regions: DataFrame, points: DataFrame, radius_m: float) -> DataFrame:
    """Points (lat, lon, ...) within radius_m of each region (region, lat, lon), by haversine, the border included.

    Null and non-finite coordinates match nothing; repeated rows of points give repeated rows; either table may be empty.
    """
    cover = cover_discs(regions, radius_m).withColumnsRenamed({"lat": "r_lat", "lon": "r_lon"})
    exact = haversine_m(F.col("r_lat"), F.col("r_lon"), F.col("p_lat"), F.col("p_lon")) <= radius_m
    return match_points(points, cover, exact)


def in_cell(x: Column, y: Column, level: Column, cell: Column, centre_in: Column, edges: Column) -> Column:
    """Even-odd containment of a point of a boundary cell: the centre's state and the crossings on the way to it, along x, then along y."""
    size = 180 / F.pow(F.lit(2.0), level)
    column = F.shiftrightunsigned(cell, 30)
    to_x = (column + 0.5) * size - 180
    to_y = (cell.bitwiseAND(F.lit((1 << 30) - 1)) + 0.5) * size - 90

    def crossed(e: Column) -> Column:
        at = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
        along = ((e["y1"] > y) != (e["y2"] > y)) & ((x < at) != (to_x < at))
        up_at = (e["y2"] - e["y1"]) * (to_x - e["x1"]) / F.nullif(e["x2"] - e["x1"], F.lit(0.0)) + e["y1"]
        up = ((e["x1"] > to_x) != (e["x2"] > to_x)) & ((y < up_at) != (to_y < up_at))
        one = lambda c: F.coalesce(c.cast("int"), F.lit(0))
        return one(along) + one(up)

    return (F.aggregate(edges, centre_in.cast("int"), lambda s, e: s + crossed(e)) % 2) == 1


def in_polygons(regions: DataFrame, points: DataFrame) -> DataFrame:
    """Points (lat, lon, ...) joined to the polygons (region, rings) that hold them; borders by the even-odd rule."""
    exact = in_cell(F.col("_x"), F.col("_y"), F.col("level"), F.col("cell"), F.col("centre_in"), F.col("edges"))
    return match_points(points, cover_polygons(regions), exact).drop("centre_in", "edges")


def pairs_within(points: DataFrame, anchors: DataFrame, group: str, max_m: float) -> DataFrame:
    """Points (group, lat, lon, ...) with the anchors (group, a_lat, a_lon, ...) of their own group within max_m of them, and distance_m.

    An equi-join on group and grid cell: cells lie in bands of latitude and are no narrower than max_m, and an anchor stands in
    its own and those round it. So a group with many of both is not compared pair by pair. Null and non-finite places and null
    groups match nothing; coordinates out of range do not either. Other columns must have different names.
    """
    size = max_m * 1.01 / 111_194.0
    on_earth = lambda y, x: finite(F.col(y)) & finite(F.col(x)) & F.col(y).between(-90, 90) & F.col(x).between(-180, 180)
    band = lambda v: F.floor(v / size)
    cy = F.col("_cy")
    width = F.least(size / F.greatest(F.cos(F.radians(F.least(F.greatest(F.abs(cy * size), F.abs((cy + 1) * size)), F.lit(90.0)))), F.lit(1e-9)), F.lit(360.0))
    around = F.floor(F.lit(360.0) / width)  # the last cell before 180 degrees east is the widest
    cell = lambda x: F.least(F.floor((x + 180) / width), around - 1).cast("bigint")
    own = points.where(on_earth("lat", "lon")).withColumn("_cy", band(F.col("lat"))).withColumn("_cx", F.pmod(cell(F.col("lon")), F.greatest(around, F.lit(1)).cast("bigint")))
    near = anchors.where(on_earth("a_lat", "a_lon")).withColumn("_cy", F.explode(F.sequence(band(F.col("a_lat")) - 1, band(F.col("a_lat")) + 1)))
    beside = F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.pmod(cell(F.col("a_lon")) + k, F.greatest(around, F.lit(1)).cast("bigint"))))
    near = near.withColumn("_cx", F.explode(beside))
    d = haversine_m(F.col("a_lat"), F.col("a_lon"), F.col("lat"), F.col("lon"))
    return own.join(near, [group, "_cy", "_cx"]).drop("_cy", "_cx").withColumn("distance_m", d).where(F.col("distance_m") <= max_m)
