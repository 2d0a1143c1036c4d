"""Readers on small files written by the tests: headers, zip members, NMEA, framed binary, glued lines, file lists."""

import zipfile

import numpy as np
import pandas as pd

from hydroframe.operators import derived, sections
from hydroframe.sources import files, sinks


def test_header_language():
    schema, used, repeated = files.header_schema("yyyy(text),mm(text),,Ax,T01+", {"Ax": "i2"})
    assert [f.dataType.simpleString() for f in schema] == ["string", "string", "double", "smallint", "double"]
    assert used == ["yyyy", "mm", "Ax", "T01"] and repeated == ["T01"]


def test_zip_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("one.csv", "1,2\n3,4\n")
        z.writestr("other.txt", "no")
    rows = files.read_zip_members(spark, str(tmp_path / "*.zip")).orderBy("line_no").collect()
    assert [(r["member"], r["line_no"], r["line"]) for r in rows] == [("one.csv", 1, "1,2"), ("one.csv", 2, "3,4")]


def test_nmea(spark, tmp_path):
    (tmp_path / "n.txt").write_text("$GPRMC,101112,A,5443.196,N,02031.532,E,4.5,90.0,160221,,*00\n$SDDBT,1,f,33.5,M,2,F*00\n$GPRMC,101113,A,5443.200,N,02031.532,W,4.6,91.0,160221,,*00\nnoise\n")
    rows = files.read_nmea(spark, str(tmp_path / "n.txt")).orderBy("Time").collect()
    assert [r["DepEcho"] for r in rows] == [33.5, None]
    assert abs(rows[0]["Lat"] - (54 + 43.196 / 60)) < 1e-9 and rows[1]["Lon"] < 0
    assert str(rows[0]["Time"]) == "2021-02-16 10:11:12"


def test_nmea_dates_and_seconds(spark, tmp_path):
    (tmp_path / "n.txt").write_text("$GPRMC,101112.70,A,5443.196,N,02031.532,E,4.5,90.0,160221,,*00\n$GPRMC,101114.20,A,5443.2,N,02031.5,E,4.6,91.0,991399,,*00\n")
    for rounded, first in ((False, "12"), (True, "13")):
        rows = files.read_nmea(spark, str(tmp_path / "n.txt"), round_seconds=rounded).orderBy("Time").collect()
        assert [str(r["Time"]) for r in rows] == [f"2021-02-16 10:11:{first}", "2021-02-16 10:11:14"]


def test_framed_binary(spark, tmp_path):
    body = np.array([[1, 2, 3], [4, 5, 6]], "<i2")
    (tmp_path / "x.bin").write_bytes(b"junk" + b"".join(b"\xff\x00\xff" + r.tobytes() for r in body) + b"\xff\x00\xff\x01")
    rows = files.read_framed_binary(spark, str(tmp_path / "x.bin"), b"\xff\x00\xff", ["a", "b", "c"]).orderBy("frame").collect()
    assert [(r["a"], r["b"], r["c"]) for r in rows] == [(1, 2, 3), (4, 5, 6)]


def test_glued_records_are_split(spark):
    line = "2018,4,30,23,59,45,-1584,-1168,-15568,-3,92,547,7.83,9.09,25.002018,7,25,10,11,12,-3,4,5,6,7,8"
    good, bad = files.device_line_rules(spark.createDataFrame([(line,), ("Start datalog",)], "line string"), "line", "inclinometer_text")
    assert sorted(r["line"][:9] for r in good.collect()) == ["2018,4,30", "2018,7,25"]
    assert bad.count() == 1


def test_integers_out_of_range_become_minus_one(spark):
    values = ["127", "126", "-128", "-127", "5", "text", None]
    rows = files.coerce_to_type(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, v string"), "v", "tinyint").orderBy("n").collect()
    assert [r["v"] for r in rows] == [-1, 126, -1, -127, 5, -1, -1]


def test_waypoint_names(spark):
    df = spark.createDataFrame([(i, "a" if i < 30 else "b") for i in range(31)], "t int, name string")
    names = [r["name"] for r in sinks.unique_names(df, "name", "t").orderBy("t").collect()]
    assert names[:3] == ["a", "aA", "aB"] and names[26:28] == ["aZ", "aAA"] and names[30] == "b"


def test_pchip_keeps_shape(spark):
    t = np.array([0, 1, 2, 3, 5, 6]) * 1_000_000
    series = spark.createDataFrame(pd.DataFrame({"k": 1, "us": t, "v": [0.0, 0.0, 1.0, 1.0, 4.0, 3.0]}))
    points = spark.createDataFrame(pd.DataFrame({"k": 1, "us": np.arange(0, 6_000_001, 250_000)}))
    out = derived.nav_columns_for_samples(points, series, ["k"], "us", ["v"]).orderBy("us").toPandas()
    held = out.set_index("us").nav_v
    assert all(held[x] == v for x, v in zip(t, [0.0, 0.0, 1.0, 1.0, 4.0, 3.0], strict=True))
    assert (held.loc[:2_000_000].diff().dropna() >= -1e-12).all() and held.max() <= 4 and held[500_000] == 0 and held[2_500_000] == 1


def test_simplified_track():
    line = np.stack([np.arange(50.0), np.zeros(50)], axis=1)
    line[25, 1] = 10
    assert np.flatnonzero(sections.simplify(line, 1.0)).tolist() == [0, 24, 25, 26, 49]


def test_long_tracks_are_split_like_the_whole(spark):
    rng = np.random.default_rng(5)
    turn = np.linspace(0, 30, 900)
    lat, lon = 55 + turn * np.cos(turn) / 400 + rng.normal(0, 1e-4, 900), 20 + turn * np.sin(turn) / 400
    tracks = {"spiral": (lat, lon), "line": (np.linspace(50, 51, 300), np.full(300, 20.0)), "two": (np.array([1.0, 2.0]), np.array([1.0, 2.0])), "one": (np.array([1.0]), np.array([1.0]))}
    df = spark.createDataFrame([(k, i, float(a), float(b)) for k, (la, lo) in tracks.items() for i, (a, b) in enumerate(zip(la, lo, strict=True))], "k string, n bigint, lat double, lon double")
    got = {r: sections.simplify_track(df, ["k"], "n", "lat", "lon", 300.0, r, 100).toPandas() for r in (40, 1 << 17)}
    for k, (la, lo) in tracks.items():
        y, x = np.radians(la), np.radians(lo)
        want = np.flatnonzero(sections.simplify(np.stack([x * np.cos(y.mean()), y], axis=1) * 6371000.0, 300.0)).tolist() if len(la) > 2 else list(range(len(la)))
        for r in got:
            assert sorted(got[r][got[r].k == k].n) == want, (k, r)


def test_grid_of_a_plane_is_the_plane(spark):
    rows = [(1, float(x), float(z), 2.0 * x + 3 * z) for x in (0, 4, 10) for z in (0, 2, 6)]
    df = spark.createDataFrame(rows, "section int, x double, z double, v double")
    out = sections.grid_section(df, ["section"], "x", "z", "v", 1.0, 1.0).toPandas()
    assert len(out) == 11 * 7 and np.allclose(out.v, 2 * out.x + 3 * out.z)


def test_section_distance_signs(spark):
    df = spark.createDataFrame([(1, i, 55.0, 20.0 + i * 0.1, 55.0, 20.0 + i * 0.1 + d) for i, d in enumerate((0.01, -0.01, 0.0))], "s int, n int, lat double, lon double, lat_en double, lon_en double")
    out = sections.section_distance(df, ["s"], "n", "lat", "lon", "lat_en", "lon_en").orderBy("n").toPandas()
    step = np.radians(0.1) * 6371 * np.cos(np.radians(55))
    assert np.allclose(out.distance, [0, step, 2 * step]) and np.allclose(out.distance_en, [step / 10, step * 0.9, 2 * step], atol=1e-4)


def test_log_is_shortened(spark):
    log = spark.createDataFrame([("a", 0, 10), ("a", 11, 20), ("b", 0, 30)], "k string, Time_st bigint, Time_en bigint")
    fresh = spark.createDataFrame([("a", 8)], "k string, us bigint")
    rows = sinks.shorten_log(log, fresh, ["k"], "us").orderBy("k").collect()
    assert [(r["k"], r["Time_st"], r["Time_en"]) for r in rows] == [("a", 0, 7), ("b", 0, 30)]


def test_files_are_loaded_once(spark):
    listing = spark.createDataFrame([("x", 5), ("y", 5), ("z", 5)], "fileName string, fileChangeTime int")
    log = spark.createDataFrame([("x", 5), ("y", 4)], "fileName string, fileChangeTime int")
    assert sorted(r["fileName"] for r in sinks.files_to_load(listing, log).collect()) == ["y", "z"]
