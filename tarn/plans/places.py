"""Queries of places and regions, with the same in SQL.

There is no table of regions, so they come from a rule: a grid of fields with wavy sides, which neighbours share corner by corner,
and round every third field's middle a hole that a region of its own fills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarn.functions.geo import finite, haversine_m
from tarn.operators import areas, evidence, linkage, profile, summary
from tarn.operators.nearby import in_polygons, pairs_within, within_radius
from tarn.session import table

POINT = ["trk_idx", "seg_idx", "pt_idx"]
#: The grid: fields to the east and north, degrees of a side, corners of a side and of a hole, south-west corner.
EAST, NORTH, SIDE, STEPS, ROUND, WEST, SOUTH = 8, 6, 0.25, 24, 16, 132.0, 32.5


def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "summit_candidates").select("summit_candidate_id", "source_gpx_path", "lat", "lon", "ele_m", "track_name")
    return profile.once(rows, "summit_candidate_id")


def _mountains(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ehime_mountain_source_rows")
    return rows.select("mountain_no", "mountain_name", "elevation_m", F.col("location.municipality").alias("municipality"), F.col("location.island").alias("island"), F.col("coordinates.lat").alias("m_lat"), F.col("coordinates.lon").alias("m_lon"))


def _places(spark: SparkSession, folder: str) -> DataFrame:
    return _mountains(spark, folder).select(F.col("mountain_no").alias("region"), F.col("m_lat").alias("lat"), F.col("m_lon").alias("lon"))


def regions(spark: SparkSession) -> DataFrame:
    """(region, rings) of the grid."""
    pi = F.lit(3.141592653589793)
    wave = lambda k, phase: 0.02 * F.sin(pi * k / STEPS) * F.sin(phase + 0.9 * k)
    point = lambda x, y: F.struct(F.round(x, 7).alias("x"), F.round(y, 7).alias("y"))
    along = lambda i, j, k: point(WEST + (i + k / STEPS) * SIDE, SOUTH + j * SIDE + wave(k, 2.1 * i + 3.7 * j))
    up = lambda i, j, k: point(WEST + i * SIDE + wave(k, 1.3 * i + 2.9 * j), SOUTH + (j + k / STEPS) * SIDE)
    i, j = F.col("id") % EAST, F.floor(F.col("id") / EAST)
    on, back = F.sequence(F.lit(0), F.lit(STEPS - 1)), F.sequence(F.lit(STEPS), F.lit(1), F.lit(-1))
    outer = F.concat(F.transform(on, lambda k: along(i, j, k)), F.transform(on, lambda k: up(i + 1, j, k)), F.transform(back, lambda k: along(i, j + 1, k)), F.transform(back, lambda k: up(i, j, k)))

    def rim(k: Column) -> Column:
        turn = 2 * pi * k / ROUND
        far = 0.05 * (1 + 0.3 * F.sin(3 * turn))
        return point(WEST + (i + 0.5) * SIDE + far * F.cos(turn), SOUTH + (j + 0.5) * SIDE + far * F.sin(turn))

    hole = F.transform(F.sequence(F.lit(0), F.lit(ROUND - 1)), rim)
    holed = (i + j) % 3 == 0
    fields = spark.range(EAST * NORTH)
    name = F.concat_ws("/", i.cast("string"), j.cast("string"))
    own = fields.select(F.concat(F.lit("field "), name).alias("region"), F.when(holed, F.array(outer, hole)).otherwise(F.array(outer)).alias("rings"))
    return own.unionByName(fields.where(holed).select(F.concat(F.lit("inner "), name).alias("region"), F.array(hole).alias("rings")))


def place_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """Nearest mountain within 1 km, and all in order of distance."""
    near = within_radius(_places(spark, folder), _candidates(spark, folder).select("summit_candidate_id", "lat", "lon"), 1000.0)
    d = F.round(haversine_m(F.col("r_lat"), F.col("r_lon"), F.col("p_lat"), F.col("p_lon")), 3)
    own = near.withColumn("d", d).groupBy("summit_candidate_id").agg(F.array_sort(F.collect_list(F.struct("d", "region"))).alias("all"))
    return own.select("summit_candidate_id", F.col("all")[0]["region"].alias("nearest"), F.col("all")[0]["d"].alias("distance_m"), F.size("all").cast("bigint").alias("near"), F.concat_ws(";", F.transform("all", lambda a: a["region"].cast("string"))).alias("by_distance"))


def place_nearest_trackpoint(spark: SparkSession, folder: str) -> DataFrame:
    points = profile.once(table(spark, folder, "trkpt").select("gpx_path", *POINT, "lat", "lon"), "gpx_path", *POINT).where("lat is not null and lon is not null")
    anchors = _candidates(spark, folder).where("lat is not null and lon is not null").select("summit_candidate_id", F.col("source_gpx_path").alias("gpx_path"), F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"))
    pairs = pairs_within(points.select("gpx_path", "lat", "lon"), anchors, "gpx_path", 300.0)
    return pairs.groupBy("summit_candidate_id").agg(F.round(F.min("distance_m"), 3).alias("distance_m"))


def place_in_polygons(spark: SparkSession, folder: str) -> DataFrame:
    return in_polygons(regions(spark), _candidates(spark, folder).select("summit_candidate_id", "lat", "lon")).select("summit_candidate_id", "region")


def place_adjacent(spark: SparkSession, folder: str) -> DataFrame:
    return areas.adjacent(regions(spark))


def place_relations(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of regions with a shared side or only a point in common; all other pairs are apart."""
    return areas.related(regions(spark))


def place_stability(spark: SparkSession, folder: str) -> DataFrame:
    points = _candidates(spark, folder).where(finite(F.col("lat")) & finite(F.col("lon"))).select("summit_candidate_id", "lat", "lon")
    return areas.stability(points, regions(spark), "summit_candidate_id")


def place_boundary(spark: SparkSession, folder: str) -> DataFrame:
    points = _candidates(spark, folder).where(finite(F.col("lat")) & finite(F.col("lon"))).select("summit_candidate_id", "lat", "lon")
    return areas.boundary_distance(points, regions(spark), "summit_candidate_id", 500.0).withColumn("distance_m", F.round("distance_m", 2))


def place_compatibility(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the region of an assignment's mountain is that of its candidate, a neighbour's, or another."""
    rows = linkage.last_wins(table(spark, folder, "proposed_summit_assignments"), "assignment_id", "loaded_at").select("assignment_id", "mountain_no", F.col("proposed_summit_candidate_id").alias("summit_candidate_id"))
    own = in_polygons(regions(spark), _candidates(spark, folder).select("summit_candidate_id", "lat", "lon")).groupBy("summit_candidate_id").agg(F.min("region").alias("candidate_region"))
    wanted = in_polygons(regions(spark), _mountains(spark, folder).select("mountain_no", F.col("m_lat").alias("lat"), F.col("m_lon").alias("lon"))).groupBy("mountain_no").agg(F.min("region").alias("mountain_region"))
    both = rows.join(own, "summit_candidate_id", "left").join(wanted, "mountain_no", "left").select("assignment_id", "candidate_region", "mountain_region")
    return areas.compatibility(both, "candidate_region", "mountain_region", areas.adjacent(regions(spark)))


def summary_extent(spark: SparkSession, folder: str) -> DataFrame:
    found = within_radius(_places(spark, folder), _candidates(spark, folder), 1000.0)
    return summary.spread_of(found, "region", "p_lat", "p_lon").withColumn("conflict", F.col("extent_m") > 250)


def place_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of the candidates within 1 km of each mountain, linked at 250 m."""
    found = within_radius(_places(spark, folder), _candidates(spark, folder).select("summit_candidate_id", "lat", "lon"), 1000.0)
    return evidence.clusters(found, "region", "p_lat", "p_lon", 250.0)


def place_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates within 300 m of a mountain; for mountains without, those within 150 m of where its candidates were proposed."""
    proposed = linkage.last_wins(table(spark, folder, "proposed_summit_assignments"), "assignment_id", "loaded_at").where("mountain_no is not null")
    points = _candidates(spark, folder).select("summit_candidate_id", "lat", "lon")
    second = proposed.join(points, F.col("proposed_summit_candidate_id") == F.col("summit_candidate_id")).groupBy(F.col("mountain_no").alias("region")).agg(F.min_by("lat", "assignment_id").alias("lat"), F.min_by("lon", "assignment_id").alias("lon"))
    return evidence.with_fallback(_places(spark, folder), second, points, 300.0, 150.0).select("region", "summit_candidate_id", "anchor")


def place_uncontested(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates within 100 m and 50 m of height of a mountain that has no other within 300 m but those within 20 m of it."""
    near = within_radius(_places(spark, folder), _candidates(spark, folder).select(F.col("summit_candidate_id").alias("id"), "lat", "lon", "ele_m"), 300.0)
    near = near.join(_mountains(spark, folder).select(F.col("mountain_no").alias("region"), "elevation_m"), "region")
    strict = (haversine_m(F.col("r_lat"), F.col("r_lon"), F.col("p_lat"), F.col("p_lon")) <= 100) & (F.abs(F.col("ele_m") - F.col("elevation_m")) <= 50)
    return evidence.uncontested(near, strict, 20.0).select("region", "id")


def place_pools(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates as the canonical pool and mountains as the supplemental one, of which those within 30 m of a candidate are duplicates."""
    canonical = _candidates(spark, folder).select(F.col("summit_candidate_id").alias("id"), "lat", "lon")
    supplemental = _places(spark, folder).select(F.concat(F.lit("mountain:"), F.col("region").cast("string")).alias("id"), "lat", "lon")
    return evidence.resolved_pools(canonical, supplemental, 30.0)


def place_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names of municipalities and islands of the mountains within 2 km of each candidate, with their support."""
    near = within_radius(_places(spark, folder), _candidates(spark, folder).select("summit_candidate_id", "lat", "lon"), 2000.0)
    rows = near.join(_mountains(spark, folder).select(F.col("mountain_no").alias("region"), "municipality", "island"), "region")
    return evidence.supported_names(rows, "summit_candidate_id", {"municipality": F.col("municipality"), "island": F.col("island")})


QUERIES = {f.__name__: f for f in (
    place_nearest, place_nearest_trackpoint, place_in_polygons, place_adjacent, place_relations, place_stability, place_boundary, place_compatibility, summary_extent, place_clusters, place_fallback, place_uncontested,
    place_pools, place_names,
)}

_C = "SELECT DISTINCT summit_candidate_id, lat, lon, ele_m FROM summit_candidates"
_F = f"SELECT * FROM ({_C}) WHERE lat IS NOT NULL AND lon IS NOT NULL AND isfinite(lat) AND isfinite(lon)"
_M = "SELECT mountain_no AS region, coordinates.lat AS lat, coordinates.lon AS lon, elevation_m, location.municipality AS municipality, location.island AS island FROM ehime_mountain_source_rows"
_A = "SELECT DISTINCT ON (assignment_id) * FROM proposed_summit_assignments ORDER BY assignment_id, loaded_at DESC"
_D = lambda a, b: f"2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"
_NEAR = lambda r: f"SELECT m.region, c.*, {_D('m', 'c')} AS d FROM ({_M}) m JOIN ({_F}) c ON m.lat IS NOT NULL AND m.lon IS NOT NULL AND abs(m.lat - c.lat) < 0.1 WHERE {_D('m', 'c')} <= {r}"
_RINGS = f"""g AS (SELECT i, j, i || '/' || j AS name, (i + j) % 3 = 0 AS holed FROM range({EAST}) a(i), range({NORTH}) b(j)), k AS (SELECT k FROM range({STEPS}) t(k)),
    v AS (SELECT name, 'field ' || name AS region, 0 AS ring, k AS n, {WEST} + (i + k / {STEPS}) * {SIDE} AS x, {SOUTH} + j * {SIDE} + 0.02 * sin(pi() * k / {STEPS}) * sin(2.1 * i + 3.7 * j + 0.9 * k) AS y FROM g, k
      UNION ALL SELECT name, 'field ' || name, 0, 100 + k, {WEST} + (i + 1) * {SIDE} + 0.02 * sin(pi() * k / {STEPS}) * sin(1.3 * (i + 1) + 2.9 * j + 0.9 * k), {SOUTH} + (j + k / {STEPS}) * {SIDE} FROM g, k
      UNION ALL SELECT name, 'field ' || name, 0, 300 - (k + 1), {WEST} + (i + (k + 1) / {STEPS}) * {SIDE}, {SOUTH} + (j + 1) * {SIDE} + 0.02 * sin(pi() * (k + 1) / {STEPS}) * sin(2.1 * i + 3.7 * (j + 1) + 0.9 * (k + 1)) FROM g, k
      UNION ALL SELECT name, 'field ' || name, 0, 400 - (k + 1), {WEST} + i * {SIDE} + 0.02 * sin(pi() * (k + 1) / {STEPS}) * sin(1.3 * i + 2.9 * j + 0.9 * (k + 1)), {SOUTH} + (j + (k + 1) / {STEPS}) * {SIDE} FROM g, k
      UNION ALL SELECT name, u.pre || name, u.ring, h, {WEST} + (i + 0.5) * {SIDE} + 0.05 * (1 + 0.3 * sin(6 * pi() * h / {ROUND})) * cos(2 * pi() * h / {ROUND}), {SOUTH} + (j + 0.5) * {SIDE} + 0.05 * (1 + 0.3 * sin(6 * pi() * h / {ROUND})) * sin(2 * pi() * h / {ROUND})
      FROM g, range({ROUND}) t(h), (VALUES ('field ', 1), ('inner ', 0)) u(pre, ring) WHERE holed),
    p AS (SELECT region, ring, n, round(x, 7) AS x, round(y, 7) AS y FROM v),
    e AS (SELECT region, x AS x1, y AS y1, coalesce(lead(x) OVER w, first(x) OVER w) AS x2, coalesce(lead(y) OVER w, first(y) OVER w) AS y2 FROM p WINDOW w AS (PARTITION BY region, ring ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    box AS (SELECT region, min(x1) AS w, max(x1) AS o, min(y1) AS s, max(y1) AS n FROM e GROUP BY 1)"""
_IN = lambda points, keys: f"""SELECT {keys}, region FROM (SELECT {keys}, e.region, count(*) FILTER (WHERE (y1 > q.lat) <> (y2 > q.lat) AND q.lon < (x2 - x1) * (q.lat - y1) / nullif(y2 - y1, 0) + x1) AS crossed
    FROM {points} q JOIN box ON q.lat BETWEEN s AND box.n AND q.lon BETWEEN w AND o JOIN e ON e.region = box.region GROUP BY ALL) WHERE crossed % 2 = 1"""  # noqa: E731
_SIDES = "s AS (SELECT DISTINCT region, least((x1, y1), (x2, y2)) AS a, greatest((x1, y1), (x2, y2)) AS b FROM e)"
_ADJ = "SELECT r.region AS region_a, t.region AS region_b, count(*) AS shared_edges FROM s r JOIN s t ON r.a = t.a AND r.b = t.b AND r.region < t.region GROUP BY 1, 2"

ORACLES = {
    "place_nearest": f"""SELECT summit_candidate_id, first(region ORDER BY d, region) AS nearest, min(d) AS distance_m, count(*) AS near, string_agg(CAST(region AS VARCHAR), ';' ORDER BY d, region) AS by_distance
        FROM (SELECT * REPLACE (round(d, 3) AS d) FROM ({_NEAR(1000)})) GROUP BY 1""",
    "place_nearest_trackpoint": f"""SELECT summit_candidate_id, round(min({_D('c', 'p')}), 3) AS distance_m FROM (SELECT DISTINCT summit_candidate_id, source_gpx_path, lat, lon FROM summit_candidates) c
        JOIN (SELECT DISTINCT gpx_path, lat, lon FROM trkpt) p ON p.gpx_path = c.source_gpx_path WHERE c.lat IS NOT NULL AND c.lon IS NOT NULL AND p.lat IS NOT NULL AND p.lon IS NOT NULL GROUP BY 1 HAVING min({_D('c', 'p')}) <= 300""",
    "place_in_polygons": f"WITH {_RINGS} {_IN(f'({_F})', 'summit_candidate_id')}",
    "place_adjacent": f"WITH {_RINGS}, {_SIDES} {_ADJ}",
    "place_relations": f"""WITH {_RINGS}, {_SIDES}, adj AS ({_ADJ}), c AS (SELECT DISTINCT region, x1, y1 FROM e), touch AS (SELECT DISTINCT a.region AS region_a, b.region AS region_b FROM c a JOIN c b ON a.x1 = b.x1 AND a.y1 = b.y1 AND a.region < b.region)
        SELECT region_a, region_b, CASE WHEN adj.shared_edges > 0 THEN 'shared_side' ELSE 'point_contact' END AS relation FROM touch LEFT JOIN adj USING (region_a, region_b)""",
    "place_stability": f"""WITH {_RINGS}, o AS (SELECT summit_candidate_id, m.way, lat + m.dy / 111320.0 AS lat, lon + m.dx / (cos(radians(lat)) * 111320.0) AS lon FROM ({_F}), (VALUES ('centre', 0, 0), ('north', 1000, 0), ('south', -1000, 0), ('east', 0, 1000), ('west', 0, -1000)) m(way, dy, dx)),
        f AS ({_IN('o', 'summit_candidate_id, way')}) SELECT c.summit_candidate_id, min(f.region) FILTER (WHERE f.way = 'centre') AS region, coalesce(count(f.region) = 5 AND count(DISTINCT f.region) = 1 AND count(*) FILTER (WHERE f.way = 'centre') = 1, false) AS all_same
        FROM ({_F}) c LEFT JOIN f USING (summit_candidate_id) GROUP BY 1""",
    "place_boundary": f"""WITH {_RINGS}, d AS (SELECT summit_candidate_id, region, (x1 - lon) * cos(radians(lat)) * 111194.93 AS ax, (y1 - lat) * 111194.93 AS ay, (x2 - x1) * cos(radians(lat)) * 111194.93 AS dx, (y2 - y1) * 111194.93 AS dy
        FROM ({_F}) JOIN e ON least(y1, y2) - lat < 0.01 AND lat - greatest(y1, y2) < 0.01), t AS (SELECT *, greatest(0.0, least(1.0, -(ax * dx + ay * dy) / (dx * dx + dy * dy))) AS along FROM d)
        SELECT summit_candidate_id, region, round(min(sqrt(pow(ax + along * dx, 2) + pow(ay + along * dy, 2))), 2) AS distance_m FROM t WHERE sqrt(pow(ax + along * dx, 2) + pow(ay + along * dy, 2)) <= 500 GROUP BY 1, 2""",
    "place_compatibility": f"""WITH {_RINGS}, {_SIDES}, adj AS ({_ADJ}), both_ AS (SELECT region_a AS a, region_b AS b FROM adj UNION ALL SELECT region_b, region_a FROM adj),
        own AS (SELECT summit_candidate_id, min(region) AS candidate_region FROM ({_IN(f'({_F})', 'summit_candidate_id')}) GROUP BY 1), want AS (SELECT mountain_no, min(region) AS mountain_region FROM ({_IN('(SELECT mountain_no, coordinates.lat AS lat, coordinates.lon AS lon FROM ehime_mountain_source_rows)', 'mountain_no')}) GROUP BY 1)
        SELECT assignment_id, candidate_region, mountain_region, CASE WHEN candidate_region IS NULL OR mountain_region IS NULL THEN 'missing' WHEN candidate_region = mountain_region THEN 'exact' WHEN both_.a IS NOT NULL THEN 'adjacent' ELSE 'incompatible' END AS compatibility
        FROM ({_A}) r LEFT JOIN own ON own.summit_candidate_id = r.proposed_summit_candidate_id LEFT JOIN want USING (mountain_no) LEFT JOIN both_ ON both_.a = candidate_region AND both_.b = mountain_region""",
    "summary_extent": f"""SELECT *, extent_m > 250 AS conflict FROM (SELECT region, count(lat) AS points, round(sqrt(pow((max(lat) - min(lat)) * 111320.0, 2) + pow((max(lon) - min(lon)) * 111320.0 * cos(radians(avg(lat))), 2)), 1) AS extent_m FROM ({_NEAR(1000)}) GROUP BY 1)""",
    "place_clusters": f"""WITH RECURSIVE n AS MATERIALIZED (SELECT region, summit_candidate_id AS id, lat, lon FROM ({_NEAR(1000)})), l AS MATERIALIZED (SELECT a.region, a.id AS a, b.id AS b FROM n a JOIN n b ON a.region = b.region WHERE {_D('a', 'b')} <= 250),
        reach(region, a, b) AS (SELECT region, a, b FROM l UNION SELECT r.region, r.a, l.b FROM reach r JOIN l ON l.region = r.region AND l.a = r.b), heads AS (SELECT region, a, min(b) AS head FROM reach GROUP BY 1, 2), sizes AS (SELECT region, head, count(*) AS n FROM heads GROUP BY 1, 2)
        SELECT *, CASE WHEN clusters = 1 THEN 'single' WHEN largest * 2 > points THEN 'conflict' ELSE 'weak' END AS consensus FROM (SELECT region, count(*) AS clusters, CAST(sum(n) AS BIGINT) AS points, max(n) AS largest FROM sizes GROUP BY 1)""",
    "place_fallback": f"""WITH f AS (SELECT region, summit_candidate_id FROM ({_NEAR(300)})), s AS (SELECT mountain_no AS region, arg_min(c.lat, assignment_id) AS lat, arg_min(c.lon, assignment_id) AS lon FROM ({_A}) a JOIN ({_C}) c ON c.summit_candidate_id = a.proposed_summit_candidate_id WHERE mountain_no IS NOT NULL GROUP BY 1)
        SELECT *, 'first' AS anchor FROM f UNION ALL SELECT m.region, c.summit_candidate_id, 'second' FROM s m JOIN ({_F}) c ON m.lat IS NOT NULL AND m.lon IS NOT NULL AND abs(m.lat - c.lat) < 0.01 WHERE m.region NOT IN (SELECT region FROM f) AND {_D('m', 'c')} <= 150""",
    "place_uncontested": f"""WITH n AS (SELECT * FROM ({_NEAR(300)})), h AS (SELECT n.* FROM n JOIN ({_M}) m USING (region) WHERE d <= 100 AND abs(ele_m - elevation_m) <= 50)
        SELECT region, summit_candidate_id AS id FROM h WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.region = h.region AND {_D('n', 'h')} > 20)""",
    "place_pools": f"""SELECT 'canonical' AS pool, summit_candidate_id AS id, 'canonical' AS role, NULL AS duplicate_of FROM ({_C}) UNION ALL SELECT 'supplemental', 'mountain:' || m.region, CASE WHEN c IS NULL THEN 'supplemental' ELSE 'fallback' END, c
        FROM ({_M}) m LEFT JOIN (SELECT region, first(summit_candidate_id ORDER BY d, summit_candidate_id) AS c FROM ({_NEAR(30)}) GROUP BY 1) USING (region)""",
    "place_names": f"""SELECT *, CAST(row_number() OVER (PARTITION BY summit_candidate_id, level ORDER BY support DESC, name) AS INT) AS place FROM (SELECT summit_candidate_id, level, trim(name) AS name, count(*) AS support
        FROM (SELECT summit_candidate_id, u.level, CASE u.level WHEN 'island' THEN island ELSE municipality END AS name FROM ({_NEAR(2000)}) JOIN (SELECT region, municipality, island FROM ({_M})) USING (region), (VALUES ('municipality'), ('island')) u(level)) WHERE trim(name) <> '' GROUP BY 1, 2, 3)""",
}
