"""Polygons: lookup of points, offsets, boundary distance, adjacency by shared edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarn.functions.geo import planar_offset
from tarn.operators.nearby import SALT, in_polygons


def offsets(points: DataFrame, lat: str, lon: str, metres: float) -> DataFrame:
    """Each point five times: itself and moved to the north, south, east and west (offset)."""
    moves = {"centre": (0, 0), "north": (metres, 0), "south": (-metres, 0), "east": (0, metres), "west": (0, -metres)}
    places = [F.struct(F.lit(n).alias("offset"), *(c.alias(k) for c, k in zip(planar_offset(F.col(lat), F.col(lon), *m), ("lat", "lon")))) for n, m in moves.items()]
    rest = [c for c in points.columns if c not in (lat, lon)]
    return points.select(*rest, F.explode(F.array(*places)).alias("o")).select(*rest, "o.*")


def stability(points: DataFrame, regions: DataFrame, key: str, metres: float = 1000.0) -> DataFrame:
    """Per point the region of its centre and whether all four places metres away lie in the same one."""
    found = in_polygons(regions, offsets(points, "lat", "lon", metres)).groupBy(key).agg(F.min(F.when(F.col("offset") == "centre", F.col("region"))).alias("region"), F.collect_set("region").alias("_all"), F.count("*").alias("_n"))
    every = points.select(key).distinct().join(found, key, "left")
    return every.select(key, "region", F.coalesce(F.col("region").isNotNull() & (F.size("_all") == 1) & (F.col("_n") == 5), F.lit(False)).alias("all_same"))


def edges(regions: DataFrame) -> DataFrame:
    """(region, x1, y1, x2, y2) of rings array<array<struct<x, y>>>, the ends in order and rounded to 7 decimals."""
    point = lambda p: F.struct(F.round(p["x"], 7).alias("x"), F.round(p["y"], 7).alias("y"))
    after = lambda ring: F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    sides = F.flatten(F.transform("rings", lambda ring: F.zip_with(ring, after(ring), lambda a, b: F.struct(F.least(point(a), point(b)).alias("a"), F.greatest(point(a), point(b)).alias("b")))))
    rows = regions.select("region", F.explode(sides).alias("e")).where("e.a <> e.b")
    return rows.select("region", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


def adjacent(regions: DataFrame) -> DataFrame:
    """(region_a, region_b, shared_edges), region_a below region_b: regions that share a side of some length."""
    e = edges(regions).distinct()
    side = ["x1", "y1", "x2", "y2"]
    pairs = e.withColumnRenamed("region", "region_a").join(e.withColumnRenamed("region", "region_b"), side).where("region_a < region_b")
    return pairs.groupBy("region_a", "region_b").agg(F.count("*").alias("shared_edges"))


def related(regions: DataFrame) -> DataFrame:
    """(region_a, region_b, relation) of all pairs that touch: shared_side, or point_contact if they share corners only. Other pairs are apart."""
    e = edges(regions).distinct()
    corners = e.select("region", F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("c")).distinct()
    touch = corners.withColumnRenamed("region", "region_a").join(corners.withColumnRenamed("region", "region_b"), "c").where("region_a < region_b").select("region_a", "region_b").distinct()
    sides = adjacent(regions).select("region_a", "region_b", F.lit("shared_side").alias("relation"))
    return touch.join(sides, ["region_a", "region_b"], "left").withColumn("relation", F.coalesce("relation", F.lit("point_contact")))


def compatibility(rows: DataFrame, region: str, wanted: str, neighbours: DataFrame) -> DataFrame:
    """rows with compatibility: exact, adjacent (by neighbours of adjacent) or incompatible; missing if either side is null."""
    pairs = neighbours.select(F.col("region_a").alias(region), F.col("region_b").alias(wanted))
    both = pairs.unionByName(pairs.select(F.col(wanted).alias(region), F.col(region).alias(wanted))).withColumn("_n", F.lit(True))
    label = F.when(F.col(region).isNull() | F.col(wanted).isNull(), "missing").when(F.col(region) == F.col(wanted), "exact").when(F.col("_n"), "adjacent").otherwise("incompatible")
    return rows.join(both, [region, wanted], "left").withColumn("compatibility", label).drop("_n")


def boundary_distance(points: DataFrame, regions: DataFrame, key: str, near_m: float) -> DataFrame:
    """(key, region, distance_m) of points within near_m of a region's boundary: grid cells join points and sides.

    Distances are planar at the point's latitude. Cells lie in bands of latitude and are so much wider in degrees as the band is
    nearer to a pole, so that none is narrower than near_m. A side is put into every cell of its box, grown by one cell.
    """
    size = max(near_m, 200.0) / 90_000.0
    band = lambda v: F.floor(v / size)
    width = size / F.greatest(F.cos(F.radians(F.greatest(F.abs(F.col("cy") * size), F.abs((F.col("cy") + 1) * size)))), F.lit(1e-6))
    cell = lambda v: F.floor(v / width)
    sides = edges(regions).withColumn("cy", F.explode(F.sequence(band(F.least("y1", "y2") - size), band(F.greatest("y1", "y2") + size))))
    sides = sides.withColumn("cx", F.explode(F.sequence(cell(F.least("x1", "x2") - width), cell(F.greatest("x1", "x2") + width))))
    placed = points.withColumn("cy", band(F.col("lat"))).withColumn("cx", cell(F.col("lon")))
    kx = F.cos(F.radians("lat")) * 111_194.93
    ax, ay = (F.col("x1") - F.col("lon")) * kx, (F.col("y1") - F.col("lat")) * 111_194.93
    dx, dy = (F.col("x2") - F.col("x1")) * kx, (F.col("y2") - F.col("y1")) * 111_194.93
    along = F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(ax * dx + ay * dy) / (dx * dx + dy * dy)))
    distance: Column = F.hypot(ax + along * dx, ay + along * dy)
    spread = F.pmod(F.xxhash64("lat", "lon"), F.lit(SALT))  # a cell may hold a third of all points
    placed, sides = placed.withColumn("_s", spread), sides.withColumn("_s", F.explode(F.array(*map(F.lit, range(SALT)))))
    return placed.join(sides, ["cx", "cy", "_s"]).withColumn("d", distance).where(F.col("d") <= near_m).groupBy(key, "region").agg(F.min("d").alias("distance_m"))
