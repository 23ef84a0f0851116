"""ZIP members, dBase records and shapes as splits: partitions, exact values, pruning, damage."""

import struct
import zipfile

import numpy as np
import pytest

from citymotion.sources import dbase
from citymotion.sources.archives import pack_archives, read_zip_csv
from citymotion.sources.members import Bytes, locate, spans
from citymotion.sources.shape_sink import write_shapefiles
from tests.shapes import dbf_bytes, shp_bytes, write_zip


def test_one_task_per_member(spark, tmp_path):
    write_zip(tmp_path / "a.zip", {"x/1.csv": "k,v\n1,a\n2,\n", "x/2.csv": 'v,k\n"q,\n""z""",3\n', "3.csv": "k,v\n", "__MACOSX/._1.csv": "junk", "read.me": "no"})
    write_zip(tmp_path / "b.zip", {"only.csv": "k,v,more\n4,d,e\n"})
    df = read_zip_csv(spark, str(tmp_path), "*.zip", ["k", "v"])
    assert df.rdd.getNumPartitions() == 4
    rows = sorted((r["path"][-5:], r["member"], r["pos"], r["k"], r["v"]) for r in df.collect())
    assert rows == [("a.zip", "x/1.csv", 0, "1", "a"), ("a.zip", "x/1.csv", 1, "2", ""), ("a.zip", "x/2.csv", 0, "3", 'q,\n"z"'), ("b.zip", "only.csv", 0, "4", "d")]
    write_zip(tmp_path / "c.zip", {"read.me": "no"})
    with pytest.raises(Exception, match="No CSV member"):
        read_zip_csv(spark, str(tmp_path), "c.zip", ["k"]).collect()
    with pytest.raises(Exception, match="missing columns"):
        read_zip_csv(spark, str(tmp_path), "b.zip", ["k", "lacking"]).collect()


@pytest.mark.parametrize("stored", [False, True])
def test_packed_archives_hold_the_bytes(spark, tmp_path, stored):
    parts = []
    for i in range(5):
        p = tmp_path / f"part-{i}.csv"
        p.write_bytes(bytes([65 + i]) * (1 << (5 * i)))
        parts.append((str(tmp_path / f"z{i % 2}.zip"), str(p), f"m{i}.csv"))
    done = pack_archives(spark.createDataFrame(parts, "archive string, path string, member string"), stored).collect()
    assert sorted(r["members"] for r in done) == [2, 3]
    for i in range(5):
        with zipfile.ZipFile(tmp_path / f"z{i % 2}.zip") as zf:
            assert zf.read(f"m{i}.csv") == bytes([65 + i]) * (1 << (5 * i))
    member = next(m for m in locate(str(tmp_path / "z0.zip"), (".csv",)) if m.name == "m2.csv")
    assert (member.offset is not None) == stored
    with Bytes(member) as source:
        assert source.read(1000, 10) == b"C" * 10 and source.read(1020, 100) == b"C" * 4
        if not stored:
            with pytest.raises(ValueError, match="forwards"):
                source.read(0, 1)
    assert list(spans(7, 3)) == [(0, 3), (3, 3), (6, 1)] and list(spans(0, 3)) == []


FIELDS = [("resultId", "C", 12, 0), ("n", "N", 8, 0), ("f", "F", 12, 3), ("note", "C", 6, 0)]


def dbf_rows(n):
    return [(f"id {i}", "" if i % 5 == 0 else str(i - 3), "x" if i % 7 == 0 else f"{i / 8:.3f}", "" if i % 2 else "é") for i in range(n)]


@pytest.mark.parametrize("kind", ["plain", "stored", "deflated"])
def test_dbf_record_ranges(spark, tmp_path, kind):
    rows, gone = dbf_rows(1000), {0, 17, 999}
    data = dbf_bytes(FIELDS, rows, deleted=gone)
    if kind == "plain":
        path = tmp_path / "t.dbf"
        path.write_bytes(data)
    else:
        path = tmp_path / "t.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED if kind == "stored" else zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("folder/t.dbf", data)
    columns = {"resultId": "string", "n": "long", "f": "double", "note": "string", "absent": "double"}
    df = dbase.read_dbf(spark, [str(path)], columns, split_bytes=39 * 100)
    assert df.rdd.getNumPartitions() == (1 if kind == "deflated" else 10)
    got = sorted((r["record"], r["resultId"], r["n"], r["f"], r["note"], r["absent"]) for r in df.collect())
    want = [(i, a, int(b) if b else None, None if c == "x" else float(c), d or None, None) for i, (a, b, c, d) in enumerate(rows) if i not in gone]
    assert got == want


def test_dbf_text_of_numbers_and_cut_files(spark, tmp_path):
    data = dbf_bytes([("id", "N", 8, 0)], [("007",), ("-0",), ("2.50",), ("1e2",), ("?",), ("",)])
    (tmp_path / "n.dbf").write_bytes(data)
    read = lambda: [r["id"] for r in dbase.read_dbf(spark, [str(tmp_path / "n.dbf")], {"id": "string"}).orderBy("record").collect()]
    assert read() == ["7", "-0", "2.5", "100", None, None]
    (tmp_path / "n.dbf").write_bytes(data[:-12])
    with pytest.raises(Exception, match="ends before"):
        read()
    (tmp_path / "n.dbf").write_bytes(b"short")
    with pytest.raises(Exception, match="at least 32 bytes"):
        read()


def lines(n):
    rnd = np.random.default_rng(2)
    return [[tuple(p) for p in np.round(rnd.normal(i % 10, 0.2, (int(k), 2)), 6).tolist()] for i, k in enumerate(rnd.integers(0, 9, n))]


def index_of(shp):
    at, rows = 100, b""
    while at < len(shp):
        words = struct.unpack_from(">i", shp, at + 4)[0]
        rows += struct.pack(">2i", at // 2, words)
        at += 8 + 2 * words
    return shp[:100] + rows


@pytest.mark.parametrize("kind", ["plain", "stored", "deflated", "no index"])
def test_shapes_by_index(spark, tmp_path, kind, monkeypatch):
    shapes = lines(300)
    shp = shp_bytes(shapes)
    shx = b"" if kind == "no index" else index_of(shp)
    if kind == "plain":
        (tmp_path / "s.shp").write_bytes(shp)
        (tmp_path / "s.shx").write_bytes(shx)
        path = tmp_path / "s.shp"
    else:
        path = tmp_path / "s.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED if kind == "stored" else zipfile.ZIP_DEFLATED) as zf:
            zf.writestr("s.shx", shx)
            zf.writestr("s.shp", shp)
    df = dbase.read_shapes(spark, [str(path)], split_bytes=len(shp) // 6)
    assert (df.rdd.getNumPartitions() > 4) == (kind in ("plain", "stored"))
    got = sorted((r["record"], r["seq"], r["lon"], r["lat"]) for r in df.collect())
    assert got == [(i, k, x, y) for i, pts in enumerate(shapes) for k, (x, y) in enumerate(pts)]
    box = (2.5, 2.5, 4.5, 4.5)
    touching = [i for i, p in enumerate(shapes) if p and max(x for x, _ in p) >= 2.5 and min(x for x, _ in p) <= 4.5 and max(y for _, y in p) >= 2.5 and min(y for _, y in p) <= 4.5]
    near = dbase.read_shapes(spark, [str(path)], box)
    assert sorted({r["record"] for r in near.collect()}) == touching and 0 < len(touching) < 100


def test_other_shape_kinds():
    contents = [
        struct.pack("<i2d", 1, 7.0, 8.0),  # point
        struct.pack("<i4di4d", 8, 0, 0, 1, 1, 2, 0.0, 0.0, 1.0, 1.0),  # point set
        struct.pack("<i4d2i2i6d", 5, 0, 0, 2, 2, 2, 3, 0, 2, 0.0, 0.0, 1.0, 1.0, 2.0, 2.0),  # two parts
        struct.pack("<i", 0),
    ]
    data, starts, at = b"".join(contents) + bytes(64), [], 0
    for c in contents:
        starts.append(at)
        at += len(c)
    shape, seq, x, y = dbase.decode_shapes(data, np.array(starts))
    assert list(zip(shape.tolist(), seq.tolist(), x.tolist())) == [(0, 0, 7.0), (1, 0, 0.0), (1, 1, 1.0), (2, 0, 0.0), (2, 1, 1.0), (2, 2, 2.0)]
    assert y.tolist() == [8.0, 0.0, 1.0, 0.0, 1.0, 2.0]
    assert dbase.decode_shapes(data, np.array(starts), (5.0, 5.0, 9.0, 9.0))[0].tolist() == [0]


def test_written_shapefiles_come_back(spark, tmp_path):
    shapes = lines(90)
    rows = [(f" R{i % 80} ", float(i) / 7 if i % 9 else None, p) for i, p in enumerate(shapes)]
    df = spark.createDataFrame(rows, "resultId string, length_m double, points array<struct<lon:double,lat:double>>").coalesce(1)
    stem = write_shapefiles(df, str(tmp_path / "out")).collect()[0]["stem"]
    with zipfile.ZipFile(tmp_path / "bluetooth-routes.zip", "w") as zf:
        for s in (".shp", ".shx", ".dbf"):
            zf.write(stem + s, "r" + s)
    back = dbase.read_route_vertices(spark, str(tmp_path), "bluetooth*.zip", split_bytes=1 << 10)
    last = {f"R{i % 80}": p for i, (_, _, p) in enumerate(rows) if p}
    got = sorted(tuple(r) for r in back.collect())
    assert got == sorted((k, s, x, y) for k, p in last.items() for s, (x, y) in enumerate(p))
    lengths = dbase.read_dbf_zip(spark, str(tmp_path), "bluetooth*.zip", {"length_m": "double"}).orderBy("record").collect()
    assert [r["length_m"] for r in lengths] == [r[1] for r in rows]
    with zipfile.ZipFile(tmp_path / "lacks.zip", "w") as zf:
        zf.write(stem + ".dbf", "r.dbf")
    with pytest.raises(Exception, match="lacks"):
        dbase.read_route_vertices(spark, str(tmp_path), "lacks.zip").collect()
    assert sum(r["records"] for r in write_shapefiles(df.where("resultId = 'no'"), str(tmp_path / "none")).collect()) == 0


def test_surrogate_ids_follow_file_order(spark, tmp_path):
    from citymotion.sources.common import with_ordinal
    from citymotion.sources.text_formats import read_collisions_csv

    for k, n in enumerate((3, 400, 1, 50)):
        (tmp_path / f"f{k}.csv").write_text("a,b\n" + "".join(f'{k},"line\n{i}"\n' for i in range(n)))
    rows = with_ordinal(read_collisions_csv(spark, str(tmp_path)), "ord", ["path"]).orderBy("ord").collect()
    assert [r["ord"] for r in rows] == list(range(454))
    assert [(int(r["a"]), r["b"]) for r in rows] == [(k, f"line\n{i}") for k, n in enumerate((3, 400, 1, 50)) for i in range(n)]
