"""Files read in byte ranges give what the whole file gives, wherever the cuts lie; loader plug-ins by name."""

import io
import random
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hydroframe.sources import files, loaders, ranges


def whole_frames(content, sync, width):
    """Bytes of the frames by the plain rule: one search after another."""
    out, at = [], content.find(sync)
    while at >= 0 and at + len(sync) + width <= len(content):
        out.append((at, content[at + len(sync) : at + len(sync) + width]))
        at = content.find(sync, at + len(sync) + width)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_frames_resynchronise(seed):
    rng = random.Random(seed)
    sync, words = [(b"\xff\x7f\xff\x7f", 3), (b"\x01", 2), (b"\x01\x01", 1)][seed % 3]
    parts = []
    for _ in range(300):
        body = bytes(rng.choice(sync + b"\x00\x05") for _ in range(2 * words))
        parts += [sync, body] if rng.random() < 0.9 else [body[: rng.randrange(2 * words)], sync[:-1]]
    content = b"".join(parts) + sync + b"\x00"
    expected = whole_frames(content, sync, 2 * words)
    for size in (1, 7, 64, 1000, len(content)):
        for read_bytes in (16, 1 << 20):
            found = []
            for begin in range(0, len(content), size):
                for places, rows in ranges.frames_of(io.BytesIO(content), begin, min(begin + size, len(content)), len(content), sync, words, "<i2", read_bytes):
                    found += [(p, r.tobytes()) for p, r in zip(places.tolist(), rows, strict=True)]
            assert found == expected, (size, read_bytes)


@pytest.mark.parametrize("content", [b"", b"\n", b"a", b"a\nbb\r\n\nccc\n\n", b"long " * 40 + b"\nend", b"\n\n\nx"])
def test_lines_belong_to_the_range_they_begin_in(content):
    expected, at = [], 0
    for line in content.split(b"\n")[: None if not content.endswith(b"\n") and content else -1]:
        expected.append((at, line.removesuffix(b"\r")))
        at += len(line) + 1
    for size in range(1, len(content) + 2):
        for read_bytes in (1, 5, 1000):
            found = [x for begin in range(0, len(content), size) for x in ranges.lines_of(io.BytesIO(content), begin, min(begin + size, len(content)), len(content), read_bytes)]
            assert found == expected


def test_framed_file_in_ranges_of_64_bytes(spark, tmp_path):
    rng = random.Random(9)
    sync = b"\xff\x00\xff"
    for name in "ab":
        content = b"junk" + b"".join(sync + rng.randbytes(6) + b"x" * rng.randrange(3) for _ in range(500)) + sync + b"\x01"
        (tmp_path / f"{name}.bin").write_bytes(content)
    whole = files.read_framed_binary(spark, str(tmp_path / "*.bin"), sync, ["a", "b", "c"]).orderBy("file", "frame").collect()
    cut = files.read_framed_binary(spark, str(tmp_path), sync, ["a", "b", "c"], range_bytes=64).orderBy("file", "frame").collect()
    assert len(whole) == 1000 and whole == cut and [r["frame"] for r in cut[:500]] == list(range(500))
    small = spark.read.format("frame_ranges").options(sync="ff00ff", columns="a,b,c", rangeBytes=64).load(str(tmp_path))
    assert small.select("file", "range").distinct().count() > 100 and small.rdd.getNumPartitions() > 50
    with pytest.raises(Exception, match="columns"):
        spark.read.format("frame_ranges").options(sync="ff").load(str(tmp_path)).count()


def test_seven_bit_words(spark, tmp_path):
    (tmp_path / "s.bin").write_bytes(b"\xff\xff" + bytes([0x85, 0x81]) + b"\xff\xff" + bytes([0x7F, 0x7F]))
    rows = files.read_framed_binary(spark, str(tmp_path / "s.bin"), b"\xff\xff", ["a"], seven_bit=True).orderBy("frame").collect()
    assert [r["a"] for r in rows] == [5 + (1 << 7), (1 << 14) - 1]


def test_members_are_dealt_by_ranges(spark, tmp_path):
    rng = random.Random(2)
    expected = []
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(40):
            lines = [f"{i},{rng.random()}" for _ in range(rng.randrange(30))]
            z.writestr(f"d/m{i}.csv", "\r\n".join(lines))
            z.writestr(f"d/m{i}.txt", "no")
            expected += [(f"d/m{i}.csv", n, x) for n, x in enumerate(lines, 1)]
    df = files.read_zip_members(spark, str(tmp_path / "big.zip"), range_bytes=500)
    assert df.rdd.getNumPartitions() > 10
    assert sorted((r["member"], r["line_no"], r["line"]) for r in df.collect()) == sorted(expected)


def nmea_by_hand(text, step_after=15):
    """(seconds of the day, last depth) of rows by the plain rule, walking the lines."""
    rows, time, count, date = {}, None, 0, None
    for line in text.split("\n"):
        if not line.startswith("$"):
            continue
        p = line.split("*")[0].split(",")
        kind = p[0][3:6]
        if kind == "RMC" and pd.notna(pd.to_datetime(p[9], format="%d%m%y", errors="coerce")):
            date = p[9]
        stamp = pd.to_datetime(f"{date} {p[1][:6]}", format="%d%m%y %H%M%S", errors="coerce") if kind in ("RMC", "GGA") and date else pd.NaT
        if pd.notna(stamp):
            time, count = stamp, 0
        elif time is not None:
            count += 1
        if time is None:
            continue
        row = rows.setdefault(time + pd.Timedelta(seconds=count // (step_after + 1)), {})
        if kind == "DBT":
            row["DepEcho"] = float(p[3])
        if kind == "RMC":
            row["Speed"] = float(p[7])
    return {k: (v.get("Speed"), v.get("DepEcho")) for k, v in rows.items()}


def test_nmea_cut_at_every_line(spark, tmp_path):
    rng = random.Random(4)
    lines, second = ["$SDDBT,1,f,1.5,M,2,F*00", "noise", "$GPGGA,101010,5443.2,N,02031.5,E*00"], 0
    for _ in range(150):
        second += rng.randrange(3)
        stamp = f"{10 + second // 3600:02d}{second // 60 % 60:02d}{second % 60:02d}"
        what = rng.random()
        if what < 0.4:
            lines.append(f"$GPRMC,{stamp},A,5443.196,N,02031.532,E,{rng.randrange(90) / 10},90.0,{rng.choice(['160221', '160221', '991399', ''])},,*00")
        elif what < 0.5:
            lines.append(f"$GPGGA,{stamp},5443.2,N,02031.5,E*00")
        else:
            lines += [f"$SDDBT,1,f,{rng.randrange(500) / 10},M,2,F*00"] * rng.choice([1, 1, 2, 20, 40])
    text = "\n".join(lines)
    (tmp_path / "n.txt").write_text(text)
    expected = nmea_by_hand(text)
    names = {"spark.sql.files.maxPartitionBytes": "60", "spark.sql.files.openCostInBytes": "1"}
    was = {k: spark.conf.get(k, None) for k in names}
    got = []
    try:
        for cut in (False, True):
            for k, v in names.items():
                spark.conf.set(k, v) if cut else None
            df = files.read_nmea(spark, str(tmp_path / "n.txt"))
            got.append({pd.Timestamp(r["Time"]): (r["Speed"], r["DepEcho"]) for r in df.collect()})
            if cut:
                assert spark.read.text(str(tmp_path / "n.txt")).rdd.getNumPartitions() > 100
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got[0] == got[1] == expected and len(expected) > 60


def test_loaders_are_found_by_name():
    assert loaders.find("csv_inclin_iso_time#old").name == "iso_time"
    assert loaders.find("IdrRedas").name == "IdrRedas"
    with pytest.raises(ValueError, match="no loader 'csv_none'; there are: .*IdrRedas, inclinometer, iso_time, pressure_tab"):
        loaders.find("csv_none")


def test_own_loader(spark, tmp_path):
    @loaders.loader("own_pairs", "a bigint, b string")
    def own_pairs(lines):
        f = loaders.numbers(lines, "=", ["a", "b"])
        return f.assign(a=pd.to_numeric(f["a"], errors="coerce")).dropna()

    try:
        (tmp_path / "x.txt").write_text("1=one\nnothing\n2=two\nx=bad\n" + "3=three\n" * 50)
        df = loaders.read(spark, str(tmp_path), "cfg_own_pairs", range_bytes=20)
        rows = df.orderBy("place").collect()
        assert [(r["a"], r["b"], r["place"]) for r in rows[:3]] == [(1, "one", 0), (2, "two", 14), (3, "three", 26)] and len(rows) == 52
        assert df.columns == ["a", "b", "file", "place"] and df.rdd.getNumPartitions() > 5
    finally:
        loaders._LOADERS.pop("own_pairs")


def test_built_in_loaders(spark, tmp_path):
    texts = {
        "inclinometer": "2018,4,30,23,59,45,-1,-2,-3,-3,92,547,7.83,9.092018,7,25,10,11,12,1,2,3,4,5,6,7,8.25\nStart\n2018,13,1,0,0,0,1,2,3,4,5,6,7,8\n",
        "iso_time": "21,2,16,10,11,12,7,5.5,20\n21,2,16,10,11,99,7,5.5,20\n",
        "pressure_tab": "2021-02-16 10:11:12\t\t5.5\tx\nbad\t1\t2\n",
    }
    found = {}
    for name, text in texts.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.txt").write_text(text)
        found[name] = [tuple(r) for r in loaders.read(spark, str(tmp_path / name), name).select(F.unix_micros("Time").alias("us"), "*").drop("Time", "file").orderBy("us").collect()]
    assert [(r[1], r[-2], r[-1]) for r in found["inclinometer"]] == [(-1.0, 9.09, 0), (1.0, 8.25, 0)]
    assert [(r[0] % 1_000_000, *r[1:3]) for r in found["iso_time"]] == [(70000, 5.5, 20.0)]
    assert [r[1:3] for r in found["pressure_tab"]] == [(5.5, None)]
