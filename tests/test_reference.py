"""Profiles, links, ranks, summaries, areas and checks on small cases."""

import math
import statistics

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tarn.functions.geo import haversine_np
from tarn.functions import text
from tarn.operators import areas, linkage, profile, quality, ranking, summary
from tarn.plans import places, reference


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def brute_peaks(ele, lat, lon, window, radius, least, merge):
    """The rules of detection, one after the other."""
    v = [i for i, e in enumerate(ele) if e is not None and not math.isnan(e)]
    n = len(v)
    if n < 3:
        return []
    e = [ele[i] for i in v]
    h = window // 2
    s = [statistics.fmean(e[max(0, i - h) : i + h + 1]) for i in range(n)]
    r = min(radius, n // 3)
    found = [i for i in range(r, n - r) if all(s[i] > s[i - j] and s[i] > s[i + j] for j in range(1, r + 1))]
    top = s.index(max(s))
    if not any(abs(i - top) < r for i in found):
        found.append(top)
    out = []
    for i in found:
        sides = []
        for step in (-1, 1):
            low, j = s[i], i + step
            while 0 <= j < n and s[j] <= s[i]:
                low = min(low, s[j])
                j += step
            sides.append(low)
        if s[i] - max(sides) >= least:
            out.append(i)
    kept = []
    for i in sorted(out, key=lambda i: (-e[i], i)):
        if all(haversine_np(lat[v[i]], lon[v[i]], lat[v[k]], lon[v[k]]) >= merge for k in kept):
            kept.append(i)
    return sorted(kept)


def tracks(spark, seed=0, sizes=(2, 3, 29, 30, 31, 120, 400)):
    rng = np.random.default_rng(seed)
    parts = []
    for k, n in enumerate(sizes):
        ele = np.round(200 + np.cumsum(rng.normal(0, 8, n)), 0)
        ele[rng.random(n) < 0.05] = np.nan
        parts.append(pd.DataFrame({"gpx_path": f"t{k}", "trk_idx": 0, "seg_idx": 0, "pt_idx": np.arange(n), "lat": 33 + np.cumsum(rng.normal(0, 2e-4, n)), "lon": 132 + np.cumsum(rng.normal(0, 2e-4, n)), "ele": ele, "time": [f"{i:05d}" for i in range(n)]}))
    data = pd.concat(parts)
    return data, spark.createDataFrame(data)


ORDER = ["trk_idx", "seg_idx", "pt_idx"]


def test_peaks_against_the_rules(spark):
    data, df = tracks(spark)
    for window, radius, least, merge in ((5, 10, 30.0, 100.0), (4, 6, 10.0, 50.0), (1, 3, 5.0, 20.0)):
        found = profile.detect_peaks(df, "gpx_path", ORDER, "ele", window, radius, least, merge)
        got = {(r.gpx_path, r.i) for r in found.collect()}
        want = {(k, i) for k, g in data.groupby("gpx_path") for i in brute_peaks(g.ele.tolist(), g.lat.values, g.lon.values, window, radius, least, merge)}
        assert got == want


def test_peaks_of_odd_tracks(spark):
    schema = "gpx_path string, trk_idx int, seg_idx int, pt_idx int, lat double, lon double, ele double, time string"
    flat = [("flat", 0, 0, i, 33.0, 132.0, 5.0, None) for i in range(40)]
    none = [("none", 0, 0, i, None, None, None, None) for i in range(5)]
    rising = [("rising", 0, 0, i, 33.0, 132.0, float(i), None) for i in range(50)]
    df = spark.createDataFrame(flat + none + rising, schema)
    assert profile.detect_peaks(df, "gpx_path", ORDER, "ele").collect() == []  # the end of a track is a wall
    assert profile.detect_peaks(df.limit(0), "gpx_path", ORDER, "ele").collect() == []
    found = {r.gpx_path: r for r in profile.track_profile(df, "gpx_path", ORDER).collect()}
    assert (found["none"].valid_elevation_point_count, found["none"].max_elevation, found["none"].has_missing_elevation) == (0, None, True)
    assert found["rising"].elevation_range == 49.0


def test_merge_is_strict(spark):
    a, b = 33.0, 33.0 + 100 / 111_194.92664455873
    d = float(haversine_np(a, 132.0, b, 132.0))
    df = spark.createDataFrame([("t", 1, a, 132.0, 10.0), ("t", 2, b, 132.0, 20.0)], "t string, i int, lat double, lon double, ele double")
    assert profile.merged_peaks(df, ["t"], "ele", d).count() == 2
    assert [r.i for r in profile.merged_peaks(df, ["t"], "ele", d + 0.01).collect()] == [2]


def test_sweep(spark):
    data, df = tracks(spark, 3)
    for r in profile.sweep(df, "gpx_path", ORDER, "ele").collect():
        _, w, radius, p, d = next(v for v in profile.VARIANTS if v[0] == r.variant_id)
        counts = [len(brute_peaks(g.ele.tolist(), g.lat.values, g.lon.values, w, radius, p, d)) for _, g in data.groupby("gpx_path")]
        assert (r.gpx_files_scanned, r.total_candidates, r.files_with_zero_candidates, r.files_with_one_candidate, r.max_candidates_per_file) == (len(counts), sum(counts), counts.count(0), counts.count(1), max(counts))
        assert r.median_candidates_per_file == statistics.median(counts)


def test_links(spark):
    t = spark.createDataFrame([("g1", "2022-01-01", "a"), ("g2", "2022-01-01", "b"), ("g3", "2022-01-05", "c"), ("g4", None, "a"), ("g5", "2022-02-01", ""), ("g6", "2022-03-01", "d")], "track string, t_date string, t_title string")
    a = spark.createDataFrame([("x1", "2022-01-01", "a"), ("x2", "2022-01-06", "c"), ("x3", "2022-03-01", "d"), ("x4", "2022-03-01", "d"), ("x5", None, None), ("x6", "no date", "c")], "activity string, a_date string, a_title string")
    got = rows(linkage.link_by_date_and_title(t, a))
    assert got == sorted([
        ("g1", "x1", "single_high_confidence_candidate", None), ("g2", "x1", "needs_review", "date match, title mismatch"), ("g3", "x2", "needs_review", "title match, date off by 1 day"),
        ("g4", None, "no_candidate", None), ("g5", None, "no_candidate", None), ("g6", "x3", "multiple_candidates", None), ("g6", "x4", "multiple_candidates", None),
    ], key=str)
    assert linkage.link_by_date_and_title(t.limit(0), a).collect() == []
    assert {r.match_status for r in linkage.link_by_date_and_title(t, a.limit(0)).collect()} == {"no_candidate"}


def test_names_in_texts(spark):
    names = spark.createDataFrame([(1, "石鎚山"), (2, "瓶"), (3, ""), (4, None), (5, "長" * 60)], "number int, name string")
    texts = spark.createDataFrame([("a", "石鎚山縦走"), ("b", "瓶・石鎚"), ("c", "花瓶など"), ("d", None), ("e", ""), ("f", "瓶山＋x"), ("g", "い" + "長" * 60), ("h", "長" * 50)], "id string, text string")
    assert rows(linkage.names_in_texts(names, texts)) == sorted([(1, "a"), (2, "b"), (2, "f"), (5, "g")], key=str)
    assert linkage.names_in_texts(names.limit(0), texts).collect() == []


def test_text_functions(spark):
    df = spark.createDataFrame([("Ａ　山 ",), (None,), ("",), ("松山市",)], "t string")
    got = [tuple(r) for r in df.select(text.title_form(F.col("t")), text.name_form(F.col("t")), text.place_forms(F.col("t"))).collect()]
    assert got == [("A山", "a 山", ["A 山"]), (None, "", [""]), ("", "", [""]), ("松山市", "松山市", ["松山市", "松山"])]
    one = df.limit(1).select(
        text.written_date(F.lit("2022年01月15日(土)")), text.written_date(F.lit("2022/01/15")), text.written_date(F.lit("?")), text.number(F.lit(" 1,234.5 ")), text.number(F.lit("x")), text.marked(F.lit("〇")), text.basename(F.lit("a/b/c.gpx")), text.jaccard(F.array(F.lit("a")), F.array().cast("array<string>")),
        text.title_parts(F.lit("a・ ・b")), text.is_traverse(F.lit(None).cast("string")), text.content_id("p", F.lit("x")),
    ).collect()[0]
    assert tuple(one)[:10] == ("2022-01-15", "2022-01-15", "?", 1234.5, None, True, "c.gpx", 0.0, 2, False)
    assert one[10].startswith("p:") and len(one[10]) == 18


def test_ranks_with_ties(spark):
    df = spark.createDataFrame([("m1", "c2", 0.5), ("m1", "c1", 0.5), ("m2", "c1", 0.9), ("m2", "c3", None)], "m string, c string, s double")
    got = {(r.m, r.c): r for r in ranking.ranked_links(df, "m", "c", "s").collect()}
    assert got["m1", "c1"].rank_left == 1 and got["m1", "c2"].rank_left == 2 and got["m2", "c1"].mutual_top1 and not got["m1", "c1"].mutual_top1
    assert got["m1", "c1"].shared_top and got["m2", "c3"].rank_left == 2
    assert rows(ranking.top_links(df, "m", "c", "s", 1).select("m", "c")) == [("m1", "c1"), ("m2", "c1")]


def test_sequence_and_headings(spark):
    df = spark.createDataFrame([(3, 1), (None, 2), (1, 3), (None, 4)], "no int, row int")
    assert rows(ranking.filled_sequence(df, "no", "row")) == rows(spark.createDataFrame([(3, 1, False), (4, 2, True), (1, 3, False), (5, 4, True)]))
    assert rows(ranking.filled_sequence(df.where("no is null"), "no", "row"))[0][0] == 1
    lines = spark.createDataFrame([("d", 0, None), ("d", 1, "A"), ("d", 2, None), ("d", 3, "B")], "doc string, n int, h string")
    assert [r.section for r in ranking.carried_heading(lines, "doc", "n", "h").orderBy("n").collect()] == [None, "A", "A", "B"]


def test_summaries(spark):
    df = spark.createDataFrame([(1, "a", "k", 5.0), (2, None, "k", None), (3, "a", "j", 1.0), (4, "b", "", 2.0)], "id int, c string, k string, d double")
    assert rows(summary.stacked_counts(df, {"c": F.col("c")})) == [("c", "", 1, 25.0), ("c", "a", 2, 50.0), ("c", "b", 1, 25.0)]
    assert rows(summary.exploded_counts(df, F.when(F.col("c") == "a", F.array(F.lit("x"), F.lit("y"))).otherwise(F.array().cast("array<string>")))) == [("none", 2, 50.0), ("x", 2, 50.0), ("y", 2, 50.0)]
    assert [tuple(r) for r in summary.shared(df, "k", "id", {"ids": "id", "cs": "c"}, "d").collect()] == [("k", 2, "1;2", "a", 5.0, 5.0)]
    assert dict(rows(summary.metrics(df, n=F.count("*"), most=F.max("d")))) == {"n": 4.0, "most": 5.0}
    assert summary.stacked_counts(df.limit(0), {"c": F.col("c")}).collect() == []
    assert summary.first_examples(df.where("c = 'a'"), "c", "id", 1).select("id").collect()[0][0] == 1
    assert rows(summary.json_keys(spark.createDataFrame([('{"a":1}',), ('{"b":1,"a":2}',), (None,), ("no",)], "j string"), "j")) == [("a", 2), ("b", 1)]


def test_checks(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (2, 50.0)], "no int, v double")
    assert {r.check: r.bad for r in quality.checks(df, {"small": F.col("v") < 10, "numbered": F.col("no") > 0}).collect()} == {"small": 2, "numbered": 0}
    assert quality.contiguous(df, "no").collect()[0].passed is False
    assert rows(quality.duplicates(df, "no")) == [(2, 2)]
    assert quality.difference(df, df).collect() == [] and quality.difference(df, df.limit(2)).count() == 1
    files = spark.createDataFrame([("b (1).gpx", "x"), ("b.gpx", "x"), ("c.gpx", "y")], "name string, content string")
    assert sorted(r.name for r in quality.newest_content(files, "content", "name").collect()) == ["b.gpx", "c.gpx"]


def test_areas(spark):
    box = lambda x, y: [[(x, y), (x + 1.0, y), (x + 1.0, y + 1.0), (x, y + 1.0)]]
    regions = spark.createDataFrame([("a", box(0.0, 0.0)), ("b", box(1.0, 0.0)), ("c", box(2.0, 1.0))], "region string, rings array<array<struct<x: double, y: double>>>")
    assert rows(areas.adjacent(regions)) == [("a", "b", 1)]  # b and c touch in a point only
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 0.5, 0.9999), (3, 9.0, 9.0)], "id int, lat double, lon double")
    assert rows(areas.stability(points, regions, "id")) == [(1, "a", True), (2, "a", False), (3, None, False)]
    near = {(r.id, r.region): r.distance_m for r in areas.boundary_distance(points, regions, "id", 200.0).collect()}
    assert set(near) == {(2, "a"), (2, "b")} and abs(near[2, "a"] - 11.12) < 0.1


def test_boundary_distance_against_brute_force_at_all_latitudes(spark):
    rng = np.random.default_rng(2)
    regions = [(f"r{y}", [[(10.0, y), (10.02, y), (10.02, y + 0.02), (10.0, y + 0.02)]]) for y in (-75.0, 0.0, 33.0, 60.0, 80.0, 89.0)]
    points = [(f"{name}/{i}", float(ring[0][0][1] + rng.uniform(-0.01, 0.03)), float(10.01 + rng.uniform(-0.02, 0.02) / np.cos(np.radians(ring[0][0][1])))) for name, ring in regions for i in range(60)]
    want = []
    for key, lat, lon in points:
        k = 111_194.93 * np.cos(np.radians(lat))
        for name, ring in regions:
            ends = [((x - lon) * k, (y - lat) * 111_194.93) for x, y in ring[0]]
            far = []
            for (ax, ay), (bx, by) in zip(ends, ends[1:] + ends[:1]):
                dx, dy = bx - ax, by - ay
                along = min(1, max(0, -(ax * dx + ay * dy) / (dx * dx + dy * dy)))
                far.append(np.hypot(ax + along * dx, ay + along * dy))
            if min(far) <= 500:
                want.append((key, name, round(float(min(far)), 3)))
    found = areas.boundary_distance(spark.createDataFrame(points, "id string, lat double, lon double"), spark.createDataFrame(regions, "region string, rings array<array<struct<x: double, y: double>>>"), "id", 500.0)
    assert rows(found.withColumn("distance_m", F.round("distance_m", 3))) == sorted(want, key=str)
    assert {w[1] for w in want} == {r[0] for r in regions}


def test_the_query_of_boundaries_takes_points_outside(spark, tmp_path):
    point = [("out", "t", 34.0003, 133.0), ("in", "t", 33.999, 133.0), ("far", "t", 34.05, 133.1), ("none", "t", None, 133.0), ("nan", "t", math.nan, 133.0)]
    df = spark.createDataFrame(point, "summit_candidate_id string, source_gpx_path string, lat double, lon double")
    df.withColumns({"ele_m": F.lit(1.0), "track_name": F.lit("")}).write.parquet(f"{tmp_path}/summit_candidates.parquet")
    assert {r.summit_candidate_id for r in places.place_boundary(spark, str(tmp_path)).collect()} == {"out", "in"}


def test_around_nearest(spark):
    points = spark.createDataFrame([("t", 0, i, 33 + i * 1e-4, 132.0, float(e)) for i, e in enumerate([1, 2, 3, 9, 3, 2])], "gpx_path string, seg_idx int, pt_idx int, lat double, lon double, ele double")
    anchors = spark.createDataFrame([("p", "t", 33.0003, 132.0005), ("far", "t", 35.0, 132.0)], "anchor string, gpx_path string, a_lat double, a_lon double")
    found = profile.around_nearest(points, anchors, "gpx_path").collect()
    assert [(r.anchor, r.pt_idx, r.points, r.peak_like) for r in found] == [("p", 3, 6, 1.0)]


def test_around_nearest_of_two_tracks_against_brute_force(spark):
    rng = np.random.default_rng(5)
    fixes = [("t", trk, seg, i, 33 + trk * 0.01 + i * 2e-4, 132 + seg * 1e-4, float(rng.integers(100, 200))) for trk in (0, 1) for seg in (0, 1) for i in range(30)]
    fixes += [("t", 2, 0, i, 33 + i * 2e-4, 132.0, 50.0) for i in range(30)]  # a copy of the first track's course: equal distances
    anchors = [(f"a{k}", "t", 33 + float(rng.uniform(0, 0.016)), 132 + float(rng.uniform(-1e-3, 1e-3))) for k in range(20)] + [("far", "t", 35.0, 132.0)]
    want = []
    for name, track, lat, lon in anchors:
        d, trk, seg, pt = min((float(haversine_np(lat, lon, f[4], f[5])), *f[1:4]) for f in fixes)
        if d > 300:
            continue
        own = next(f for f in fixes if f[1:4] == (trk, seg, pt))
        ele = [f[6] for f in fixes if f[1:3] == (trk, seg) and abs(f[3] - pt) <= 10 and haversine_np(f[4], f[5], own[4], own[5]) <= 100]
        wide = max(ele) - min(ele)
        want.append((name, track, trk, seg, pt, round(d, 4), len(ele), wide, round(1 - (max(ele) - own[6]) / wide if wide else 1.0, 6)))
    points = spark.createDataFrame(fixes, "gpx_path string, trk_idx int, seg_idx int, pt_idx int, lat double, lon double, ele double")
    found = profile.around_nearest(points, spark.createDataFrame(anchors, "anchor string, gpx_path string, a_lat double, a_lon double"), "gpx_path")
    assert rows(found.withColumns({"distance_m": F.round("distance_m", 4), "peak_like": F.round("peak_like", 6)})) == sorted(want, key=str)
    assert {w[2] for w in want} == {0, 1}


def test_the_query_near_anchors_takes_all_tracks(spark, tmp_path):
    point = [("t", trk, 0, i, 33 + trk * 0.1 + i * 1e-4, 132.0, 100.0 + i, None) for trk in (0, 1) for i in range(5)]
    spark.createDataFrame(point, "gpx_path string, trk_idx int, seg_idx int, pt_idx int, lat double, lon double, ele double, time string").write.parquet(f"{tmp_path}/trkpt.parquet")
    anchor = [("s", "t", 33.1002, 132.0, None, None)]
    spark.createDataFrame(anchor, "summit_candidate_id string, source_gpx_path string, lat double, lon double, ele_m double, track_name string").write.parquet(f"{tmp_path}/summit_candidates.parquet")
    assert [(r.anchor, r.trk_idx, r.pt_idx) for r in reference.peaks_near_anchors(spark, str(tmp_path)).collect()] == [("s", 1, 2)]


def test_last_wins(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", None)], "k int, v string, o int")
    assert rows(linkage.last_wins(df, "k", "o").select("k", "v")) == [(1, "b"), (2, "c")]


def test_indexes_and_lookups(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, None, 1), (None, "x", 1)], "k int, v string, o int")
    assert rows(linkage.indexed(df, "k", "o").select("k", "place", "v", "n")) == [(1, 1, "a", 2), (1, 2, "b", 2), (2, 1, None, 1)]
    found, missing = linkage.looked_up(df, spark.createDataFrame([(1, "one")], "k int, name string"), "k")
    assert rows(found.select("v", "name")) == [("a", "one"), ("b", "one")] and rows(missing.select("k")) == sorted([(2,), (None,)], key=str)
    assert rows(summary.pass_counts(df, {"a": F.col("o") == 1, "b": F.col("v") == "a"})) == [("a", 3, 75.0), ("b", 1, 25.0)]
    assert rows(summary.pass_counts(df.limit(0), {"a": F.col("o") == 1})) == [("a", 0, 0.0)]
