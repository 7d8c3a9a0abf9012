"""Readers, writers, streams and the driver's entry, on files made here."""

import json
import zipfile

import pytest

from tarn.operators import profile
from tarn.sources import sinks, tabular, tracks
from tarn.streaming import windows

GPX = """<?xml version="1.0"?><gpx version="1.1" creator="maker" xmlns="http://www.topografix.com/GPX/1/1"><metadata><name></name></metadata>
<trk><name>甲山 &amp; 乙</name><trkseg><trkpt lat="33.1" lon="132.1"><ele>10.5</ele><time>2022-02-15T01:36:00Z</time></trkpt><trkpt lat="33.2" lon="132.2"><ele>x</ele></trkpt></trkseg><trkseg><trkpt lat="33.3"><ele>12</ele></trkpt></trkseg></trk></gpx>"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "gpx").mkdir()
    (tmp_path / "gpx/yamap_2022-02-15_10_36.gpx").write_text(GPX, encoding="utf8")
    return tmp_path


def test_tracks(spark, folder):
    files = tracks.read_tracks(spark, f"{folder}/gpx/*.gpx")
    points = tracks.trackpoints(files)
    got = [(r.seg_idx, r.pt_idx, r.lat, r.lon, r.ele) for r in points.orderBy("seg_idx", "pt_idx").collect()]
    assert got == [(0, 0, 33.1, 132.1, 10.5), (0, 1, 33.2, 132.2, None), (1, 0, 33.3, 0.0, 12.0)]
    head = tracks.header(files, points).collect()[0]
    assert (head["name"], head["creator"], head["points"], str(head["filename_timestamp"])) == ("甲山 & 乙", "maker", 3, "2022-02-15 10:36:00")
    assert tracks.waypoints(files).collect() == []


def test_annotated_tracks_come_back(spark, folder):
    files = tracks.read_tracks(spark, f"{folder}/gpx/*.gpx")
    points = tracks.trackpoints(files)
    peaks = spark.createDataFrame([(files.first().gpx_path, 1, 33.2, 132.2, 11.0, 40.0)], "gpx_path string, i int, lat double, lon double, ele double, prominence double")
    out = sinks.annotated_tracks(points, peaks, files.select("gpx_path", "name"))
    assert sinks.write_files(out.withColumn("gpx_path", out.gpx_path.substr(-9, 5)), str(folder / "out"), "gpx_path", "content", ".gpx").count() == 1
    again = tracks.read_tracks(spark, f"{folder}/out/*.gpx")
    key = ["seg_idx", "pt_idx", "lat", "lon", "ele", "time"]
    assert points.select(key).exceptAll(tracks.trackpoints(again).select(key)).collect() == []
    assert [(r.candidate_index, r.lat) for r in tracks.waypoints(again).collect()] == [(1, 33.2)]


def test_activities(spark, tmp_path):
    (tmp_path / "123.md").write_text("# x\n- **Title**: first\n- **Title**: 石鎚山 \n- **Date**: 2022年01月15日\r\n", encoding="utf8")
    (tmp_path / "124.md").write_text("nothing", encoding="utf8")
    got = {r.activity_id: (r.title, r.date, r.distance) for r in tabular.read_activities(spark, f"{tmp_path}/*.md").collect()}
    assert got == {"123": ("石鎚山", "2022年01月15日", ""), "124": ("", "", "")}


def test_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,n,x\n1,"a, b",2.5\n2,c,bad\n')
    got = tabular.read_csv(spark, f"{tmp_path}/a.csv", {"k": ("int", 0), "x": ("double", 0.0)}, ["k", "n", "x"]).collect()
    assert [tuple(r) for r in got] == [(1, "a, b", 2.5), (2, "c", 0.0)]
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert tabular.read_json_lines(spark, f"{tmp_path}/b.jsonl", "a int").where("a is not null").count() == 2
    (tmp_path / "c.json").write_text('[{"a": 1}, {"a": 5}]')
    assert [(r.pos, r.a) for r in tabular.read_json_array(spark, f"{tmp_path}/c.json", "a: int").collect()] == [(0, 1), (1, 5)]
    assert tabular.missing_inputs(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/none"]) == [f"{tmp_path}/none"]
    shape = {"type": "FeatureCollection", "features": [{"properties": {"n": "r"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}}, {"properties": {"n": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1]]], [[[5, 5], [6, 5], [6, 6]]]]}}]}
    (tmp_path / "d.json").write_text(json.dumps(shape))
    assert {r.region: len(r.rings) for r in tabular.read_polygons(spark, f"{tmp_path}/d.json", "n").collect()} == {"r": 1, "m": 2}


def test_archive(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("a/x.gpx", GPX)
        z.writestr("b/x.gpx", GPX)
        z.writestr("note.txt", "no")
    members = tabular.read_archive(spark, f"{tmp_path}/z.zip")
    assert sorted(r.member for r in members.collect()) == ["a/x.gpx", "b/x.gpx"]
    assert [tuple(r) for r in tabular.archive_collisions(members).collect()] == [("x.gpx", 2)]


def test_outputs(spark, tmp_path):
    df = spark.createDataFrame([("g", 2, True, None), ("g", 1, False, "x|y")], "k string, n int, b boolean, t string")
    sinks.write_csv(df, f"{tmp_path}/out", ["n", "b", "t"])
    assert sorted(tuple(r) for r in spark.read.csv(f"{tmp_path}/out", header=True).fillna("").collect()) == [("1", "false", "x|y"), ("2", "true", "")]
    with pytest.raises(Exception):
        sinks.write_csv(df, f"{tmp_path}/out", ["n"])
    assert "x\\|y" in sinks.markdown_table(df)
    import pyspark.sql.functions as F

    text = sinks.group_files(df, "k", F.concat(F.lit("- "), F.col("n").cast("string")), "n", F.lit("# g")).collect()[0].content
    assert text == "# g\n- 1\n- 2"
    files = spark.createDataFrame([("p", bytearray(b"abc"))], "path string, content binary")
    assert json.loads(sinks.manifest("s", "now", {"p": 1}, files))["outputs"][0]["sha256"].startswith("ba7816bf")


def test_streams(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:10", 1.0), ("a", "2024-01-01 00:00:20", 2.0), ("a", "2024-01-01 02:00:00", 5.0)], "u string, ts string, value double").selectExpr("u", "cast(ts as timestamp) ts", "value")
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    for name, out in (("w", windows.windowed(stream, "ts", "1 minute", "10 minutes", "u")), ("s", windows.sessions(stream, "ts", "5 minutes", "10 minutes", "u"))):
        query = out.writeStream.format("memory").queryName(name).outputMode("complete" if name == "w" else "append").option("checkpointLocation", f"{tmp_path}/{name}").start()
        query.processAllAvailable()
        query.stop()
    assert sorted(r.n for r in spark.table("w").collect()) == [1, 2]


def test_entry(spark):
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 40
    assert entry.entry(spark).columns[:2] == ["gpx_path", "i"]
    assert profile.VARIANTS[0][0] == "baseline"


def test_a_report_is_never_cut(spark):
    assert sinks.markdown_table(spark.range(3), 3).count("\n") == 5
    with pytest.raises(ValueError):
        sinks.markdown_table(spark.range(4), 3)


def test_archive_with_a_name_twice_is_refused(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("x/one.gpx", "1")
        archive.writestr("y/one.gpx", "2")
    with pytest.raises(ValueError, match="one.gpx"):
        tabular.checked_archive(tabular.read_archive(spark, f"{tmp_path}/*.zip"))


def test_workbook(spark, tmp_path):
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook {space} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="甲" sheetId="1" r:id="rId1"/><sheet name="空" sheetId="2" r:id="rId2"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f"<sst {space}><si><t>名前</t></si><si><r><t>石</t></r><r><t>鎚山</t></r></si></sst>")
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet {space}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1"><v>2.5</v></c></row><row r="3"><c r="B3" t="s"><v>1</v></c><c r="AA3" t="b"><v>1</v></c><c r="AB3" t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>')
        book.writestr("xl/worksheets/sheet2.xml", f"<worksheet {space}><sheetData/></worksheet>")
    got = [(r.sheet, r.row_no, r.cells) for r in tabular.read_workbook(spark, f"{tmp_path}/*.xlsx").collect()]
    assert got == [("甲", 1, ["名前", "", "2.5"]), ("甲", 3, ["", "石鎚山", *[""] * 24, "true", "x"])]


def test_documents_line_by_line(spark, tmp_path):
    text = "# top\n- **Key**: a\n- key two: b: c\n## next\n- Key：d\n- Key: e\n| x | y\\|z |\n|---|:-:|\n| 1 |  |\nno - bullet: here"
    lines = spark.createDataFrame([("d", i, line) for i, line in enumerate(text.split("\n"))], "doc string, n int, line string")
    got = sorted((r.section, r.key, r.value) for r in tabular.bullets(lines, "doc", "n", "line").collect())
    assert got == [("next", "Key", "e"), ("top", "Key", "a"), ("top", "key two", "b: c")]
    assert [(r.n, r.cells) for r in tabular.table_rows(lines, "doc", "n", "line").orderBy("n").collect()] == [(6, ["x", "y|z"]), (8, ["1", ""])]


def test_small_readers(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"summary": {"total_records": 7}}')
    (tmp_path / "n.json").write_text("{}")
    assert sorted((r.path[-6:], r.total_records) for r in tabular.stated_total(spark, f"{tmp_path}/*.json").collect()) == [("m.json", 7), ("n.json", None)]
    rows = spark.createDataFrame([({"state": "愛媛県", "road": "r"},), ({"province": "", "prefecture": "高知県"},), (None,)], "address map<string, string>")
    assert [(r.prefecture, r.local) for r in tabular.geocoded(rows).collect()] == [("愛媛県", "r"), ("高知県", None), (None, None)]
    shape = '{"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}'
    (tmp_path / "g.geojson").write_text('{"features": [{"properties": {"n": "a", "p": "x"}, "geometry": %s}, {"properties": {"n": "b", "p": "y"}, "geometry": %s}]}' % (shape, shape))
    assert [r.region for r in tabular.read_polygons(spark, f"{tmp_path}/g.geojson", "n", ("p", "y")).collect()] == ["b"]


def test_broken_tracks_keep_a_row(spark, folder):
    (folder / "gpx/bad.gpx").write_text("<gpx><trk></gpx>")
    files = tracks.read_tracks(spark, f"{folder}/gpx/*.gpx")
    got = {r.gpx_path[-7:]: (r.points, r.error, r.notes) for r in tracks.header(files, tracks.trackpoints(files)).collect()}
    assert got["_36.gpx"] == (3, False, None) and got["bad.gpx"][:2] == (0, True) and got["bad.gpx"][2].startswith("Parse error: ")


def test_files_are_written_whole_and_once(spark, tmp_path):
    df = spark.createDataFrame([("a/b", "1"), ("a_b", "2"), ("甲", None)], "n string, c string")
    out = f"{tmp_path}/out"
    got = {r.name: (r.file, r.bytes) for r in sinks.write_files(df, out, "n", "c", ".txt").collect()}
    assert len({f for f, _ in got.values()}) == 3 and {n: (tmp_path / "out" / f).read_text() for n, (f, _) in got.items()} == {"a/b": "1", "a_b": "2", "甲": ""}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]
    with pytest.raises(FileExistsError):
        sinks.write_files(df, out, "n", "c", ".txt")
    with pytest.raises(ValueError):
        sinks.write_files(df.unionByName(df), f"{tmp_path}/again", "n", "c", ".txt")


def test_tracks_of_a_year(spark, folder):
    point = [(p, 0, 0, i, 33.0 + i, 132.0, None, None) for p in ("a", "b", "c") for i in range(2)]
    points = spark.createDataFrame(point, "gpx_path string, trk_idx int, seg_idx int, pt_idx int, lat double, lon double, ele double, time string")
    names = spark.createDataFrame([("a", "A & B")], "gpx_path string, name string")
    years = spark.createDataFrame([("a", 2020), ("b", 2020), ("c", 2021)], "gpx_path string, year int")
    out = sinks.yearly_tracks(points, names, years, 1)
    assert sorted(r.name for r in out.collect()) == ["2020-000", "2020-001", "2021-000"]
    sinks.write_files(sinks.yearly_tracks(points, names, years), f"{folder}/years", "name", "content", ".gpx")
    again = tracks.read_tracks(spark, f"{folder}/years/*.gpx")
    assert tracks.trackpoints(again).count() == 6 and sorted(r.name for r in again.collect()) == ["", "A & B"]


def test_graphs_and_waypoints(spark, folder):
    from xml.etree import ElementTree

    edges = spark.createDataFrame([("a", 'b "x" <1>', "l & m"), ("a", "c", None), ("a", "c", None), (None, "c", "")], "source string, target string, label string")
    lines = {kind: [r.line for r in sinks.graph_lines(edges, kind).orderBy("place").collect()] for kind in ("dot", "graphml")}
    assert lines["dot"][0] == "digraph lineage {" and lines["dot"][-1] == "}" and '"a" -> "c" [label=""];' in lines["dot"] and len(lines["dot"]) == 7
    graph = ElementTree.fromstring("".join(lines["graphml"]))
    assert sorted(e.get("target") for e in graph.iter("{http://graphml.graphdrawing.org/xmlns}edge")) == ['b "x" <1>', "c"]
    marks = spark.createDataFrame([("g", "A<", 33.0, 132.0, None), ("g", "B", 34.0, 132.0, 5.0), ("g", "no", None, 1.0, 1.0)], "g string, name string, lat double, lon double, ele double")
    sinks.write_files(sinks.waypoint_file(marks, "g"), f"{folder}/marks", "g", "content", ".gpx")
    found = tracks.waypoints(tracks.read_tracks(spark, f"{folder}/marks/*.gpx")).orderBy("candidate_index").collect()
    assert [(r.candidate_id, r.lat, r.ele) for r in found] == [("A<", 33.0, None), ("B", 34.0, 5.0)]


def test_times_and_links_of_files(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("2022-02-15T01:36:00Z",), ("2022-02-15T01:36:00.5Z",), ("2022-02-15T10:36:00+09:00",), ("x",), (None,)], "t string")
    got = [r.t and str(r.t) for r in df.select(F.date_format(tracks.point_time(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("t")).collect()]
    assert got == ["2022-02-15 01:36:00", None, "2022-02-15 01:36:00", None, None]
    (tmp_path / "a.gpx").write_text('<gpx><link href="https://yamap.com/activities/15239274"/></gpx>')
    (tmp_path / "b.gpx").write_text("<gpx/>")
    found = {r.gpx_path[-5:]: (r.activity_id, r.has_site) for r in tracks.activity_links(spark, f"{tmp_path}/*.gpx").collect()}
    assert found == {"a.gpx": ("15239274", True), "b.gpx": (None, False)}
