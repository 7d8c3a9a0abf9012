"""Operators of the general problems on small cases and against brute force."""

import os
import time
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tarn.functions.geo import haversine_np
from tarn.functions.zones import database_version, local_to_utc
from tarn.operators.nearby import in_polygons, pairs_within, within_radius
from tarn.operators.packed import explode_packed, tokenize
from tarn.operators.spikes import SpikeParameters, implausible, judge
from tarn.operators.stays import StayParameters, segments, stays_of
from tarn.operators.timestamps import normalise_fields, normalise_values, shape_mask
from tarn.operators import stays, tracks
from tarn.plans import problems

TOKYO = "Asia/Tokyo"
TABLES = "/root/testdata/sf0.01"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize(
    "text, utc",
    [
        ("2022-04-28 10:57", "2022-04-28T01:57:00Z"), ("20170524T0453", "2017-05-23T19:54:00Z"[:11] + "19:53:00Z"), ("yamap_2009-04-25_07_46.gpx", "2009-04-24T22:46:00Z"), ("２０１７-１０-２０ ０６:０６", "2017-10-19T21:06:00Z"),
        ("2017-10-04 23:22 Asia/Kathmandu", "2017-10-04T17:37:00Z"), ("2018-09-06 00:37 -06:00", "2018-09-06T06:37:00Z"), ("12 Feb 2011 04:54", "2011-02-11T19:54:00Z"), ("2006-05-21 12:10 AM", "2006-05-20T15:10:00Z"),
        ("1290646609595", "2010-11-25T00:56:49Z"), ("1345783586", "2012-08-24T04:46:26Z"), ("2015-06-09T23:27:13,999Z", "2015-06-09T23:27:13Z"), ("Tue, 27 Jul 2010 23:14:17 GMT", "2010-07-27T23:14:17Z"),
        ("2017-05-23T02:23:58[Europe/Zurich]", "2017-05-23T00:23:58Z"), ("2021-02-30 09:15", None), ("2020-06-31 25:61", None), ("0000-00-00 00:00", None), ("不明", None), ("", None), (None, None), ("x" * 5000, None),
        ("2024-10-27 02:30 Europe/Zurich", "2024-10-27T00:30:00Z"), ("2024-03-31 02:30 Europe/Zurich", "2024-03-31T01:30:00Z"), ("2020-01-01 10:00 Nowhere/Land", None), ("2020年01月02日 03時04分", "2020-01-01T18:04:00Z"),
    ],
)
def test_instants(text, utc):
    assert normalise_values(pd.Series([text]), TOKYO, False, database_version())[0] == utc


@pytest.mark.parametrize(
    "text, day",
    [
        ("2022年01月15日(土)", "2022-01-15"), ("2012.4.27", "2012-04-27"), ("'12/04/06", "2012-04-06"), ("平成25年1月6日", "2013-01-06"), ("R1.9.13", "2019-09-13"), ("令和元年10月11日", "2019-10-11"), ("H29.2.12", "2017-02-12"),
        ("Jan 29, 2017", "2017-01-29"), ("29 Sep 2021", "2021-09-29"), ("2021／4／17（土）", "2021-04-17"), ("2024-02-03T23:24:00Z", "2024-02-04"), ("20110925", "2011-09-25"), ("2006年8月31日 08:11", "2006-08-31"),
        ("110925", "2011-09-25"), ("2018年02月30日", None), ("2021年13月40日", None), ("----", None), ("日付なし", None), ("昭和64年1月7日", "1989-01-07"),
    ],
)
def test_dates(text, day):
    assert normalise_values(pd.Series([text]), TOKYO, True, database_version())[0] == day


@settings(max_examples=200, deadline=None)
@given(st.datetimes(min_value=pd.Timestamp("1975-01-01").to_pydatetime(), max_value=pd.Timestamp("2037-01-01").to_pydatetime()), st.sampled_from(["Europe/Zurich", "America/Denver", "Australia/Lord_Howe", "Asia/Kathmandu"]))
def test_zone_tables_agree_with_the_standard_library(local, zone):
    from zoneinfo import ZoneInfo

    second = int((local.replace(microsecond=0) - pd.Timestamp("1970-01-01").to_pydatetime()).total_seconds())
    expected = int(local.replace(microsecond=0, tzinfo=ZoneInfo(zone)).timestamp())
    assert local_to_utc(np.array([second]), zone, database_version())[0] == expected


def test_zone_versions_must_agree():
    with pytest.raises(RuntimeError):
        local_to_utc(np.array([0]), "Europe/Zurich", "of another machine")


def test_masks_keep_their_length():
    for text in ("12 Feb 2011 04:54", "2017-10-04 23:22 Asia/Kathmandu", "H29.2.12"):
        assert len(shape_mask(text)) == len(text)


def test_normalised_fields(spark):
    df = spark.createDataFrame([(1, "2022-04-28 10:57", None, "field"), (1, "2022-04-28 10:57", None, "field"), (2, " ", "R1.9.13", "x"), (None, "2022-04-28 10:57", None, "x")], "k long, a string, b string, field_name string")
    found = normalise_fields(df, "k", {"a": TOKYO}, {"b": TOKYO})
    assert rows(found) == [(1, "a", "2022-04-28T01:57:00Z"), (2, "b", "2019-09-13")]
    assert normalise_fields(df.limit(0), "k", {"a": TOKYO}, {"b": TOKYO}).collect() == []


@pytest.mark.parametrize(
    "text, items",
    [
        ('a;"b;c";d', ["a", "b;c", "d"]), ("a|a", ["a", "a"]), (";a;;b; ", ["a", "b"]), ("['a', 'b, c']", ["a", "b, c"]), ('["say \\"x\\"","y"]', ['say "x"', "y"]), ('"name: ""old"" form"\nb', ['name: "old" form', "b"]),
        ("甲山（雨、風）・乙岳", ["甲山（雨、風）", "乙岳"]), ("「雨、のち晴れ」 ・ 丙", ["雨、のち晴れ", "丙"]), ("A->B→C", ["A", "B", "C"]), ("Mt. X-yama・Y's", ["Mt. X-yama", "Y's"]), ("a_b c.d", ["a_b c.d"]), ("", []), (None, []), (" 　", []),
        ('5" deep', ['5" deep']), ("(open; b", ["(open", "b"]), ('""', []), ("[]", []), ("甲〜乙＆丙", ["甲", "乙", "丙"]), ("x" * 50_000, ["x" * 50_000]), ("'a;b';c", ["a;b", "c"]),
    ],
)
def test_tokenizer(text, items):
    assert tokenize(text) == items


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet='ab ;",|', min_size=1, max_size=6).filter(lambda x: x.strip()), min_size=1, max_size=6))
def test_quoted_items_come_back(items):
    assert tokenize(";".join('"' + i.replace('"', '""') + '"' for i in items)) == items


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab\"'()[]【】「」;,\\ \n->", max_size=30))
def test_tokenizer_never_fails(text):
    assert all(x.strip() for x in tokenize(text))


def test_exploded(spark):
    df = spark.createDataFrame([(1, "a;b", 0), (1, "a;b", 0), (2, None, 0), (3, "", 0), (None, "x", 0)], "row_id int, f string, item int")
    assert rows(explode_packed(df, "row_id", "f")) == [("f", 1, 1, "a"), ("f", 1, 2, "b")]


def test_within_radius_against_brute_force(spark):
    rng = np.random.default_rng(1)
    regions = pd.DataFrame({"region": range(40), "lat": rng.uniform(33, 33.02, 40), "lon": rng.uniform(132, 132.02, 40)})
    points = pd.DataFrame({"id": range(800), "lat": rng.uniform(32.99, 33.03, 800), "lon": rng.uniform(131.99, 132.03, 800), "level": 1, "region": "x"})
    extra = pd.DataFrame({"region": [90, 91, 92], "lat": [None, float("nan"), -89.999], "lon": [132.0, 132.0, 0.0]})
    odd = pd.DataFrame({"id": [900, 901, 902, 903], "lat": [None, float("inf"), -89.9995, 33.01], "lon": [1.0, 2.0, 180.0, 492.01], "level": 1, "region": "x"})
    found = within_radius(spark.createDataFrame(pd.concat([regions, extra])), spark.createDataFrame(pd.concat([points, odd])), 300.0)
    got = {(r.region, r.id) for r in found.select("region", "id").collect()}
    d = haversine_np(regions.lat.values[:, None], regions.lon.values[:, None], points.lat.values, points.lon.values)
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(d <= 300))}
    far = haversine_np(regions.lat.values, regions.lon.values, 33.01, 132.01) <= 300
    assert got == want | {(92, 902)} | {(int(a), 903) for a in np.flatnonzero(far)}
    assert found.where("id < 900").count() == len(want)


def test_within_radius_by_shuffle_and_of_nothing(spark, monkeypatch):
    import tarn.operators.nearby as nearby

    a = spark.createDataFrame([(1, 33.0, 132.0)], "region int, lat double, lon double")
    b = spark.createDataFrame([(5, 33.0, 132.0), (5, 33.0, 132.0), (6, 34.0, 132.0)], "id int, lat double, lon double")
    monkeypatch.setattr(nearby, "BROADCAST_CELLS", 0)
    assert rows(within_radius(a, b, 300.0).select("region", "id")) == [(1, 5), (1, 5)]
    assert within_radius(a.limit(0), b, 300.0).collect() == []
    assert within_radius(a, b.limit(0), 300.0).collect() == []


def test_pairs_in_groups_against_brute_force(spark):
    rng = np.random.default_rng(6)
    spots = [(0.0, 0.0), (33.0, 132.0), (60.0, 179.9999), (-75.0, -179.9999), (89.99, 10.0)]
    scatter = lambda n: [(rng.choice(["a", "b"]), float(min(90, y + rng.uniform(-0.004, 0.004))), float((x + 180 + rng.uniform(-0.004, 0.004) / max(0.01, np.cos(np.radians(y)))) % 360 - 180)) for y, x in spots for _ in range(n)]
    points, anchors = scatter(60), scatter(12)
    want = sorted((i, j) for i, (g, y, x) in enumerate(points) for j, (h, v, u) in enumerate(anchors) if g == h and haversine_np(y, x, v, u) <= 300)
    df = spark.createDataFrame([(i, str(g), y, x) for i, (g, y, x) in enumerate(points)] + [(999, "a", None, 1.0), (998, None, 0.0, 0.0)], "id int, g string, lat double, lon double")
    at = spark.createDataFrame([(j, str(g), y, x) for j, (g, y, x) in enumerate(anchors)] + [(99, "a", float("nan"), 1.0), (98, None, 0.0, 0.0)], "anchor int, g string, a_lat double, a_lon double")
    assert rows(pairs_within(df, at, "g", 300.0).select("id", "anchor")) == want and len(want) > 100


def test_polygons_of_many_sides_against_brute_force(spark):
    rng = np.random.default_rng(0)

    def star(x, y, r, n):
        turn = np.sort(rng.uniform(0, 2 * np.pi, n))
        far = r * (0.4 + 0.6 * rng.random(n))
        return [(float(x + a), float(y + b)) for a, b in zip(far * np.cos(turn), far * np.sin(turn))]

    regions = [("a", [star(10, 10, 5, 1500), star(10, 10, 1.5, 200)]), ("b", [star(12, 11, 3, 50)]), ("square", [[(9.0, 9.0), (11.0, 9.0), (11.0, 11.0), (9.0, 11.0)]])]
    p = pd.DataFrame({"id": range(1500), "lat": rng.uniform(4, 16, 1500), "lon": rng.uniform(4, 16, 1500)})
    p.loc[:200, "lat"], p.loc[100:300, "lon"] = np.round(p.lat[:201] * 4) / 4, np.round(p.lon[100:301] * 4) / 4  # on the lines of cells
    want = []
    for name, rings in regions:
        inside = np.zeros(len(p), bool)
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                if y1 != y2:
                    inside ^= ((y1 > p.lat.values) != (y2 > p.lat.values)) & (p.lon.values < (x2 - x1) * (p.lat.values - y1) / (y2 - y1) + x1)
        want += [(name, int(i)) for i in p.id[inside]]
    found = in_polygons(spark.createDataFrame(regions, "region string, rings array<array<struct<x: double, y: double>>>"), spark.createDataFrame(p))
    assert rows(found.select("region", "id")) == sorted(want)


@pytest.mark.parametrize("mark", ["(", "\"a'", "“", "['a", "x' y", "a'b"])
def test_tokenizer_is_linear_in_marks(mark):
    def took(n):
        start = time.perf_counter()
        tokenize(mark * n)
        return time.perf_counter() - start

    assert min(took(16_000) for _ in range(3)) < 40 * min(took(2_000) for _ in range(3))


def test_polygons_with_a_hole(spark):
    rings = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)]]
    regions = spark.createDataFrame([("a", rings), ("none", None), ("empty", [])], "region string, rings array<array<struct<x: double, y: double>>>")
    rng = np.random.default_rng(2)
    p = pd.DataFrame({"id": range(2000), "lat": rng.uniform(-1, 5, 2000), "lon": rng.uniform(-1, 5, 2000)})
    got = {r.id for r in in_polygons(regions, spark.createDataFrame(p)).collect()}
    inside = (p.lat > 0) & (p.lat < 4) & (p.lon > 0) & (p.lon < 4) & ~((p.lat > 1) & (p.lat < 3) & (p.lon > 1) & (p.lon < 3))
    assert got == set(p.id[inside])


def walk(rng, plan, interval=15, noise=4.0):
    """Fixes (t, x, y) of a plan of ('stay', seconds) and ('go', metres); stays with their true middle."""
    t, x, fixes, middles = 0.0, 0.0, [], []
    for kind, size in plan:
        if kind == "stay":
            middles.append(t + size / 2)
            for s in np.arange(0, size, interval):
                fixes.append((t + s, x, 0.0))
            t += size
        elif kind == "silence":
            middles.append(t + size / 2)
            fixes += [(t, x, 0.0), (t + size, x, 0.0)]
            t += size + 1
        elif kind == "gap":
            t, x = t + size, x + size * 0.8
        else:
            for s in np.arange(0, size, interval):
                fixes.append((t + s, x + s * 0.9, 0.0))
            t, x = t + size, x + size * 0.9
    f = np.array(fixes)
    f[:, 1:] += rng.normal(0, noise, (len(f), 2))
    return f, middles


def test_stays_of_made_walks():
    for seed in range(12):
        rng = np.random.default_rng(seed)
        f, middles = walk(rng, [("stay", 900), ("go", 1500), ("stay", 240), ("go", 1200), ("silence", 1500), ("go", 900), ("gap", 1200), ("go", 600), ("stay", 1200)])
        stray = rng.choice(len(f), 4, replace=False)
        f[stray, 1:] += rng.choice([-1, 1], (4, 2)) * rng.uniform(800, 3000, (4, 2))
        lat, lon = 33 + f[:, 2] / 111_195, 132 + f[:, 1] / (111_195 * np.cos(np.radians(33)))
        stays, keep, way = stays_of(f[:, 0], lat, lon)
        t = f[keep, 0]
        found = [(t[a] + t[b]) / 2 for a, b in stays]
        assert len(found) == 3, (seed, found, middles)
        assert max(abs(a - b) for a, b in zip(found, [middles[0], middles[2], middles[3]])) < 90
        assert (np.diff(way) >= 0).all()


def fixes_table(spark, f, path="a"):
    stamps = pd.to_datetime(f[:, 0] + 1.6e9, unit="s", utc=True).strftime("%Y-%m-%dT%H:%M:%SZ")
    p = pd.DataFrame({"gpx_path": path, "trk_idx": 0, "seg_idx": 0, "pt_idx": range(len(f)), "lat": 33 + f[:, 2] / 111_195, "lon": 132 + f[:, 1] / (111_195 * np.cos(np.radians(33))), "ele": 100.0, "time": stamps, "slab": "clash"})
    return spark.createDataFrame(p)


def test_segments_of_dirty_tables(spark):
    f, _ = walk(np.random.default_rng(0), [("go", 900), ("stay", 1200), ("go", 900)])
    df = fixes_table(spark, f)
    dirty = df.unionByName(df.limit(50)).unionByName(spark.createDataFrame([("a", 0, 0, 900, None, 132.0, None, "2020-09-13T12:30:00Z", ""), ("a", 0, 0, 901, 0.0, 0.0, None, "2020-09-13T12:30:00Z", ""), ("a", 0, 0, 902, 33.0, 132.0, None, " ", ""), (None, 0, 0, 1, 33.0, 132.0, None, "x", ""), ("b", 0, 0, 1, 33.0, 132.0, None, "2020-09-13T12:30:00Z", "")], df.schema))
    clean, found = segments(df).collect(), segments(dirty).collect()
    assert sorted(map(str, clean)) == sorted(map(str, found))
    assert [r.kind for r in sorted(found, key=lambda r: r.start_s)] == ["trip", "stay", "trip"]
    assert segments(df.limit(0)).collect() == []


def test_spikes():
    p = SpikeParameters()
    n = 200
    rng = np.random.default_rng(0)
    t, base = np.arange(n) * 10.0, 300 + np.cumsum(rng.normal(0.5, 1.0, n))
    lat, lon = 33 + np.arange(n) * 1e-4, np.full(n, 132.0)
    ele = base.copy()
    ele[20] += 120  # one
    ele[50:54] -= 90  # four
    ele[80:85] += 150  # five are no spike
    ele[120:] += 200  # a lasting change
    ele[140] = np.nan
    ele[150], ele[151] = 9000.0, -60.0
    ele[160:185] = 777.25  # stuck, 277 m
    want = {20, 50, 51, 52, 53, 140, 150, 151, *range(160, 185)}
    assert set(np.flatnonzero(judge(t, ele, lat, lon, p))) == want
    still = ele.copy()
    assert 170 not in np.flatnonzero(judge(t, still, np.full(n, 33.0), lon, p))  # at rest equal values are right
    assert not judge(t[:0], ele[:0], lat[:0], lon[:0], p).any()


def test_implausible_rows(spark):
    f, _ = walk(np.random.default_rng(0), [("go", 1500)])
    df = fixes_table(spark, f)
    df = df.selectExpr("gpx_path", "trk_idx", "seg_idx", "pt_idx", "lat", "lon", "CASE pt_idx WHEN 7 THEN 500D WHEN 9 THEN NULL WHEN 11 THEN double('NaN') ELSE ele + pt_idx END AS ele", "CASE WHEN pt_idx = 30 THEN NULL ELSE time END AS time", "'x' AS summary")
    df = df.unionByName(df.limit(20))
    heads = spark.createDataFrame([("a", 99.0), ("a", 99.0)], "gpx_path string, elevation_range double")
    assert rows(implausible(df, heads)) == [("a", 0, 0, 7), ("a", 0, 0, 11)]
    heads = spark.createDataFrame([("a", 460.0), ("a", 460.0), ("a", None), ("nowhere", 5.0), (None, 1.0)], "gpx_path string, elevation_range double")
    assert rows(implausible(df, heads)) == [("a", -1, -1, -1), ("a", 0, 0, 7), ("a", 0, 0, 11)]
    assert implausible(df.limit(0), heads).collect() == []


def test_a_hot_track_has_the_same_implausible_readings(spark, monkeypatch):
    rng = np.random.default_rng(4)
    n = 900
    ele = np.round(300 + np.cumsum(np.r_[rng.normal(0, 1.0, n // 2), rng.normal(0, 12.0, n - n // 2)]), 1)  # two halves of unlike steps
    ele[rng.choice(n, 20, replace=False)] += rng.choice([-1, 1], 20) * rng.uniform(40, 900, 20)
    ele[300:304] += 150
    ele[500:540] = 777.25
    ele[[40, 41, 620]] = [9000.0, -60.0, np.nan]
    df = pd.DataFrame({"gpx_path": "a", "trk_idx": 0, "seg_idx": np.arange(n) // 400, "pt_idx": range(n), "lat": 33 + np.arange(n) * 1e-4, "lon": 132.0, "ele": ele, "time": pd.to_datetime(1.6e9 + np.arange(n) * 60, unit="s", utc=True).strftime("%Y-%m-%dT%H:%M:%SZ")})
    df.loc[rng.choice(n, 30, replace=False), "time"] = None
    df.loc[[0, 1, 303], "time"] = None  # a spike is part of what has no time
    points = spark.createDataFrame(df).withColumn("ele", F.expr("CASE WHEN pt_idx % 97 = 5 THEN NULL ELSE ele END"))
    points = points.unionByName(points.limit(50)).unionByName(points.where("pt_idx < 90").withColumn("gpx_path", F.lit("b")))
    points = points.unionByName(points.where("pt_idx < 300 and gpx_path = 'a'").withColumns({"gpx_path": F.lit("c"), "time": F.lit("").cast("string")}))
    sound = points.where("gpx_path = 'a'").join(implausible(points, spark.createDataFrame([], "gpx_path string, elevation_range double")), ["gpx_path", "trk_idx", "seg_idx", "pt_idx"], "left_anti").agg(F.max("ele") - F.min("ele")).first()[0]
    for shift in (0.0, 100.0):
        heads = spark.createDataFrame([("a", sound + shift), ("b", 5000.0), ("c", float("nan")), ("d", 1.0)], "gpx_path string, elevation_range double")
        monkeypatch.setattr(tracks, "HOT_FIXES", 1_000_000)
        whole = rows(implausible(points, heads))
        monkeypatch.setattr(tracks, "HOT_FIXES", 100)
        assert rows(implausible(points, heads)) == whole
        assert (("a", -1, -1, -1) in whole) == (shift > 0) and ("b", -1, -1, -1) in whole and ("c", -1, -1, -1) in whole and len(whole) > 40


def test_windows_over_blocks(spark):
    rng = np.random.default_rng(7)
    data = pd.DataFrame({"k": rng.choice(["a", "b"], 200), "n": range(200), "v": rng.choice([1.0, 2.0, 3.0, None], 200), "block": np.arange(200) // 7})
    df = spark.createDataFrame(data).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = tracks.over_blocks(df, "k", "block", ("n",), lag={"a": "v"}, lead={"b": "v"}, last={"c": "v"}, total={"d": F.lit(1), "e": F.col("n")})
    along = "OVER (PARTITION BY k ORDER BY n"
    want = df.selectExpr("*", f"lag(v) {along}) a", f"lead(v) {along}) b", f"last(v, true) {along} ROWS UNBOUNDED PRECEDING) c", f"count(*) {along} ROWS UNBOUNDED PRECEDING) d", f"sum(n) {along} ROWS UNBOUNDED PRECEDING) e")
    assert rows(got.select(want.columns)) == rows(want) and len(rows(want)) == 200


def even(table):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in table]


def test_a_hot_track_has_the_same_segments(spark, monkeypatch):
    plan = [("go", 2400), ("stay", 300), ("silence", 9000), ("stay", 300), ("go", 2400), ("gap", 7200), ("go", 2400), ("stay", 1500), ("go", 5000), ("stay", 36_000), ("go", 9000), ("gap", 40_000), ("go", 4000)]
    parts = []
    for seed, interval in ((8, 15), (9, 40), (10, 5)):
        f, _ = walk(np.random.default_rng(seed), plan, interval)
        stray = np.random.default_rng(seed).choice(len(f), 6, replace=False)
        f[stray, 1:] += 2500
        parts.append(fixes_table(spark, f, str(seed)))
    df = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[0].limit(90))
    for size in (1800, 3600, 6 * 3600):
        p = StayParameters(slab_s=size)
        monkeypatch.setattr(tracks, "HOT_FIXES", 1_000_000)
        whole = rows(segments(df, p))
        monkeypatch.setattr(tracks, "HOT_FIXES", 100)
        assert even(rows(segments(df, p))) == even(whole)
        assert sum(r[1] == "stay" for r in whole) == 9


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no tables")
@pytest.mark.parametrize("name", ["p2_segments", "p5_found"])
def test_whole_tables_do_not_depend_on_what_counts_as_hot(spark, monkeypatch, name):
    whole = rows(problems.QUERIES[name](spark, TABLES))
    monkeypatch.setattr(tracks, "HOT_FIXES", 100)
    assert even(rows(problems.QUERIES[name](spark, TABLES))) == even(whole) and len(whole) > 300


def test_a_stay_is_measured_without_the_rest_of_the_track():
    n = 400_000
    t, place = np.arange(n) * 10.0, (np.arange(n) // 60) % 2
    x, y = place * 80.0, np.zeros(n)
    tracemalloc.start()
    found = [stays.measure(t, x, y, a + 5, a + 40, 0, n - 1, 30.0) for a in (0, 60 * 1000, 60 * 6000)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(a, a + 59) for a in (0, 60 * 1000, 60 * 6000)] and peak < 500_000
    whole = np.zeros(n)
    assert stays.measure(t, whole, whole, 200_000, 200_010, 0, n - 1, 30.0) == (0, n - 1)
