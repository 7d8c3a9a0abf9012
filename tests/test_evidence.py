"""Links by several kinds of evidence, pools, clusters, rollups, checks between tables, and the text functions around them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarn.functions import text
from tarn.functions.geo import haversine_np
from tarn.operators import areas, evidence, quality, ranking

NORTH = 1 / 111_194.92664455873  # a metre in degrees of latitude


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def places(spark, data, name="id"):
    return spark.createDataFrame(data, f"{name} string, lat double, lon double")


def test_bands(spark):
    rng = np.random.default_rng(1)
    a, b = rng.uniform(-50, 50, 60), rng.uniform(-50, 50, 300)
    left = spark.createDataFrame([(i, float(v)) for i, v in enumerate(a)] + [(99, None), (98, float("nan"))], "region int, h double")
    right = spark.createDataFrame([(i, float(v)) for i, v in enumerate(b)] + [(999, None)], "id int, h double")
    got = rows(evidence.within_band(left, right, "h", 3.0))
    assert got == sorted([(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if abs(x - y) <= 3.0], key=str)


def test_links_by_any_evidence(spark):
    regions = spark.createDataFrame([(1, "石鎚山", 1982.0, 33.0, 132.0), (2, "瓶ヶ森", None, None, None)], "region int, name string, height double, lat double, lon double")
    points = spark.createDataFrame([("n", "石鎚山縦走", None, None, None), ("h", None, 1990.0, 10.0, 10.0), ("p", "", 0.0, 33.0 + 200 * NORTH, 132.0), ("none", "x", 1.0, 0.0, 0.0), ("all", "石鎚山", 1980.0, 33.0, 132.0)], "id string, text string, height double, lat double, lon double")
    want = [(1, "all", True, True, True), (1, "h", False, True, False), (1, "n", True, False, False), (1, "p", False, False, True)]
    assert rows(evidence.evidence_links(regions, points, 10.0, 300.0)) == want
    assert evidence.evidence_links(regions.limit(0), points, 10.0, 300.0).collect() == []


def test_fallback_and_uncontested(spark):
    first = places(spark, [("a", 33.0, 132.0), ("b", 34.0, 132.0), ("none", None, 1.0)], "region")
    second = places(spark, [("a", 35.0, 132.0), ("b", 34.1, 132.0)], "region")
    points = places(spark, [("x", 33.0 + 90 * NORTH, 132.0), ("y", 34.1, 132.0), ("z", 35.0, 132.0)])
    assert rows(evidence.with_fallback(first, second, points, 100.0, 50.0).select("region", "id", "anchor")) == [("a", "x", "first"), ("b", "y", "second")]
    near = spark.createDataFrame([("a", "1", 33.0, 132.0), ("a", "2", 33.0 + 4 * NORTH, 132.0), ("b", "3", 33.0, 132.0), ("b", "4", 33.0 + 9 * NORTH, 132.0), ("c", "5", 33.0, 132.0)], "region string, id string, p_lat double, p_lon double")
    assert rows(evidence.uncontested(near, F.col("id") != "2", 5.0).select("region", "id")) == [("a", "1"), ("c", "5")]


def test_pools(spark):
    canonical = places(spark, [("c1", 33.0, 132.0), ("c2", 33.0 + 50 * NORTH, 132.0), ("c3", None, None)])
    supplemental = places(spark, [("s1", 33.0 + 30 * NORTH, 132.0), ("s2", 33.0 - 31 * NORTH, 132.0), ("s3", None, None)])
    got = rows(evidence.resolved_pools(canonical, supplemental, 30.0))
    assert got == [("canonical", "c1", "canonical", None), ("canonical", "c2", "canonical", None), ("canonical", "c3", "canonical", None), ("supplemental", "s1", "fallback", "c2"), ("supplemental", "s2", "supplemental", None), ("supplemental", "s3", "supplemental", None)]


def test_clusters_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    data = [(k, float(33 + rng.uniform(0, 0.02)), float(132 + rng.uniform(0, 0.02))) for k in range(3) for _ in range(40)] + [(7, 33.0, 132.0)] * 3 + [(8, None, 1.0), (None, 1.0, 1.0)]
    got = {r.k: (r.clusters, r.points, r.largest, r.consensus) for r in evidence.clusters(spark.createDataFrame(data, "k int, lat double, lon double"), "k", "lat", "lon", 250.0).collect()}
    for k in range(3):
        own = [(round(a, 6), round(b, 6)) for key, a, b in data if key == k]
        group = list(range(len(own)))
        for _ in own:
            for i, p in enumerate(own):
                for j, q in enumerate(own):
                    if haversine_np(*p, *q) <= 250:
                        group[i] = group[j] = min(group[i], group[j])
        sizes = [group.count(g) for g in set(group)]
        assert got[k][:3] == (len(sizes), 40, max(sizes))
    assert got[7] == (1, 3, 3, "single") and set(got) == {0, 1, 2, 7}


def test_rollups_and_comparisons(spark):
    df = spark.createDataFrame([(1, "甲", "x"), (1, "甲", None), (1, "乙", " "), (2, None, "y")], "k int, a string, b string")
    assert rows(evidence.supported_names(df, "k", {"a": F.col("a"), "b": F.col("b")})) == sorted([(1, "a", "甲", 2, 1), (1, "a", "乙", 1, 2), (1, "b", "x", 1, 1), (2, "b", "y", 1, 1)], key=str)
    assert rows(evidence.compared(df, df.where("k = 1"), "a")) == sorted([("a", "", 1, 0, -1), ("a", "甲", 2, 2, 0), ("a", "乙", 1, 1, 0)], key=str)
    part = df.where("k = 1")
    assert rows(evidence.split_covers(df, part, df.where("k = 2"))) == [(4, 4, 0, 0, True)]
    assert rows(evidence.split_covers(df, part, part)) == [(4, 6, 1, 3, False)]
    assert rows(quality.counts_match({"a": df, "b": part}, spark.createDataFrame([("a", 4), ("c", 1)], "name string, stated long"))) == sorted([("a", 4, 4, True), ("b", None, 3, False), ("c", 1, None, False)], key=str)
    joined = evidence.with_lookups(df, (spark.createDataFrame([(1, "old", 1), (1, "new", 2), (None, "no", 9)], "k int, v string, o int"), "k", "o"))
    assert rows(joined.select("k", "v")) == sorted([(1, "new")] * 3 + [(2, None)], key=str)


def test_direct_ids_come_first(spark):
    tracks = spark.createDataFrame([("g1", "x1"), ("g2", "gone"), ("g3", None)], "track string, direct string")
    found, rest = evidence.direct_first(tracks, spark.createDataFrame([("x1",), ("x2",)], "activity string"))
    assert rows(found) == [("g1", "x1")] and rows(rest) == [("g2",), ("g3",)]


def test_relations_of_regions(spark):
    box = lambda x, y: [[(x, y), (x + 1.0, y), (x + 1.0, y + 1.0), (x, y + 1.0)]]
    regions = spark.createDataFrame([("a", box(0.0, 0.0)), ("b", box(1.0, 0.0)), ("c", box(2.0, 1.0)), ("d", box(9.0, 9.0))], "region string, rings array<array<struct<x: double, y: double>>>")
    assert rows(areas.related(regions)) == [("a", "b", "shared_side"), ("b", "c", "point_contact")]
    df = spark.createDataFrame([(1, "a", "a"), (2, "b", "a"), (3, "a", "c"), (4, None, "a")], "id int, own string, want string")
    assert rows(areas.compatibility(df, "own", "want", areas.adjacent(regions)).select("id", "compatibility")) == [(1, "exact"), (2, "adjacent"), (3, "incompatible"), (4, "missing")]


def test_numbers_of_many_blanks(spark):
    df = spark.createDataFrame([(None, i) for i in range(500, 0, -1)] + [(7, 0)], "no int, row int").repartition(7)
    assert rows(ranking.filled_sequence(df, "no", "row").where("filled").select("row", "no")) == sorted([(i, 7 + i) for i in range(1, 501)], key=str)


def one(spark, *columns):
    return tuple(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def test_names_and_titles(spark):
    names = lambda *n: F.array(*map(F.lit, n)).cast("array<string>")
    assert one(spark, text.is_alias(names("石鎚", "石鎚山", None)), text.is_alias(names("a", "a")), text.is_alias(names("a", "b")), text.is_alias(F.lit(None).cast("array<string>"))) == (True, False, False, False)
    assert one(spark, text.title_list(F.lit("b"), names("a", "b", "", None, "a")), text.title_list(F.lit(None), F.lit(None).cast("array<string>"))) == (["b", "a"], [])
    none = F.lit(None).cast("string")
    assert one(spark, text.name_score(F.lit("甲山"), F.lit("朝の甲山"), none, names()), text.name_score(F.lit("甲 乙"), none, F.lit("x"), names("甲・丙")), text.name_score(none, none, none, F.lit(None).cast("array<string>"))) == (1.0, pytest.approx(1 / 3), 0.0)


def test_times_and_places(spark):
    ntz = lambda t: F.lit(t).try_cast("timestamp_ntz")
    assert one(spark, text.seconds_into_day(ntz("2022-02-15 10:36:05"), F.lit("2022-02-15")), text.seconds_into_day(ntz("2022-02-14 23:59:59"), F.lit("2022-02-15")), text.seconds_into_day(ntz("x"), F.lit("2022-02-15")), text.seconds_into_day(ntz("2022-02-15 10:36:05"), F.lit("?"))) == (38165, -1, None, None)
    assert tuple(one(spark, text.time_forms(F.lit("2022-02-14T16:00:00Z").cast("timestamp")))[0]) == ("2022-02-14 16:00", "2022-02-14T16:00:00Z", "2022-02-15T01:00:00+0900")
    got = [c and tuple(c) for c in one(spark, *(text.lat_lon(F.lit(t)) for t in ("33.5, 132.25", "N33.5 E132.25", "-1,-2", "91,0", "x", None)))]
    assert got == [(33.5, 132.25), (33.5, 132.25), (-1.0, -2.0), None, None, None]
    assert [tuple(p) for p in one(spark, *(text.place_parts(F.lit(t)) for t in ("甲市", "乙島 ", " ", None)))] == [("甲市", None), (None, "乙島"), (None, None), (None, None)]


def test_marks(spark):
    assert one(spark, text.plain_markup(F.lit("key: `a<b>` & \"c\""), "key: "), text.plain_markup(F.lit(None).cast("string"))) == ("a&lt;b&gt; &amp; &quot;c&quot;", None)
    assert one(spark, text.one_of(F.lit(None).cast("string"), "none", "none", "weak"), text.one_of(F.lit("strong"), "none", "none")) == (True, False)
    assert one(spark, text.flags({"a": F.lit(True), "b": F.lit(None).cast("boolean"), "c": F.lit(True)})) == (["a", "c"],)
