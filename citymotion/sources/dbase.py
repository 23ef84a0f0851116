"""dBase (.dbf) attributes and ESRI shapefile polylines as splittable scans.

Both formats are fixed layouts documented publicly (dBase III table file; ESRI Shapefile
Technical Description).

* ``spark.read.format("dbf")``: records have one width, so record ranges are byte ranges
  (header length + n x width).  Each partition reads its range and decodes it column by
  column.
* ``spark.read.format("shp")``: the ``.shx`` index holds each shape's offset and length, so ranges of
  the index are byte ranges of the ``.shp``.  A partition reads its part of the index, then its
  shapes in blocks; all vertices of a block are gathered at once.  With a bounding box,
  shapes are dropped by the boxes in their record headers before vertices are touched.

Plain files and stored members of archives split; a deflated member is one partition that
is inflated as a stream.  A partition holds one block of ``BLOCK`` bytes (or one shape, if that
is larger).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from citymotion.operators.normalize import keep_last
from citymotion.session import measured_side
from citymotion.sources.common import list_files, paths_of, ship_package
from citymotion.sources.members import Bytes, Member, locate, spans

SPLIT_BYTES = 32 << 20
BLOCK = 8 << 20

# fixed values: layout of a dBase III header and field descriptor
HEAD = np.dtype([("version", "u1"), ("date", "u1", 3), ("records", "<u4"), ("header", "<u2"), ("width", "<u2"), ("rest", "V20")])
FIELD = np.dtype([("name", "S11"), ("kind", "S1"), ("address", "V4"), ("width", "u1"), ("decimals", "u1"), ("rest", "V14")])


# ---------------------------------------------------------------- dBase


def dbf_layout(data: bytes) -> tuple[np.void, np.ndarray]:
    """The header and the field descriptors of a DBF, from its first bytes."""
    if len(data) < HEAD.itemsize:
        raise ValueError("a DBF has at least 32 bytes")
    head = np.frombuffer(data, HEAD, 1)[0]
    room = (min(int(head["header"]), len(data)) - HEAD.itemsize) // FIELD.itemsize
    fields = np.frombuffer(data, FIELD, max(0, room), HEAD.itemsize)
    return head, fields[fields["name"] != b"\r"][: int(np.argmax(np.append(fields["name"], b"\r") == b"\r"))]


def dbf_names(fields: np.ndarray) -> list[str]:
    return [n.split(b"\0")[0].decode("ascii", "replace") for n in fields["name"]]


def dbf_summary_of(read) -> dict:
    """Field names and record count, from ``read(n)`` of a DBF's beginning only."""
    start = read(HEAD.itemsize)
    size = int(np.frombuffer(start, HEAD, 1)[0]["header"])
    head, fields = dbf_layout(start + read(size - HEAD.itemsize))
    return {"fields": dbf_names(fields), "n_records": int(head["records"])}


def _header(source: Bytes) -> bytes:
    start = source.read(0, HEAD.itemsize)
    if len(start) < HEAD.itemsize:
        raise ValueError("a DBF has at least 32 bytes")
    return start + source.read(HEAD.itemsize, int(np.frombuffer(start, HEAD, 1)[0]["header"]) - HEAD.itemsize)


def _column(texts: np.ndarray, kind: bytes, to: pa.DataType) -> pa.Array:
    """A field's trimmed texts as ``to``: blank is null; numeric fields (N, F) that hold no
    number are null and read as strings are written as whole numbers or floats."""
    text = pa.array(np.char.strip(np.char.decode(texts, "latin-1")).astype(object), pa.string())
    text = pc.if_else(pc.equal(text, ""), pa.scalar(None, pa.string()), text)
    if kind in (b"N", b"F") or not pa.types.is_string(to):
        number = pc.match_substring_regex(text, r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$")
        text = pc.replace_substring_regex(pc.if_else(number, text, pa.scalar(None, pa.string())), r"^\+", "")
        if pa.types.is_string(to):
            whole = pc.match_substring_regex(text, r"^-?[0-9]+$")
            floats = pc.cast(pc.cast(text, pa.float64()), pa.string())
            return pc.if_else(whole, pc.replace_substring_regex(text, r"^(-?)0*([0-9])", r"\1\2"), floats)
        value = pc.cast(text, pa.float64())
        return pc.cast(value, to, safe=False) if to != pa.float64() else value
    return text


def decode_records(data: bytes, fields: np.ndarray, width: int, first: int, kinds: dict[str, pa.DataType]) -> tuple[np.ndarray, list[pa.Array]]:
    """Positions (deleted records left out, but counted) and columns of whole records."""
    names = dbf_names(fields)
    row = np.dtype({
        "names": ["_flag", *[f"f{i}" for i in range(len(names))]],
        "formats": ["S1", *[f"S{w}" for w in fields["width"]]],
        "offsets": np.concatenate(([0], 1 + np.cumsum(fields["width"], dtype=int) - fields["width"])).tolist(),
        "itemsize": width,
    })
    rows = np.frombuffer(data, row, len(data) // width)
    keep = np.flatnonzero(rows["_flag"] != b"*")
    place = {n: i for i, n in enumerate(names)}
    out = []
    for name, kind in kinds.items():
        i = place.get(name)
        out.append(pa.nulls(len(keep), kind) if i is None else _column(rows[f"f{i}"][keep], bytes(fields["kind"][i]), kind))
    return keep + first, out


def decode_dbf(data: bytes) -> pa.Table:
    """All live records of a small DBF: ``record`` and its fields, numeric ones as doubles."""
    head, fields = dbf_layout(data)
    kinds = {n: pa.float64() if f["kind"] in (b"N", b"F") else pa.string() for n, f in zip(dbf_names(fields), fields)}
    start, width = int(head["header"]), int(head["width"])
    place, columns = decode_records(data[start : start + int(head["records"]) * width], fields, width, 0, kinds)
    return pa.table({"record": place, **dict(zip(kinds, columns))})


@dataclass
class RecordRange(InputPartition):
    member: Member
    first: int
    count: int


ARROW = {"string": pa.string(), "double": pa.float64(), "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32()}


class DbfSource(DataSource):
    """Options (JSON): ``paths``, ``columns`` (field -> Spark type; absent fields are NULL), ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "dbf"

    def schema(self) -> str:
        return "path string, record long, " + ", ".join(f"`{c}` {t}" for c, t in json.loads(self.options["columns"]).items())

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return DbfReader({k: json.loads(self.options[k]) for k in ("paths", "columns", "split_bytes")})


class DbfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = options

    def partitions(self) -> Sequence[InputPartition]:
        out = []
        for path in self.o["paths"]:
            found = locate(path, (".dbf",))
            if not found:
                raise FileNotFoundError(f"{path} holds no .dbf")
            member = found[0]
            with Bytes(member) as source:
                head, _ = dbf_layout(_header(source))
            n = int(head["records"])
            per = max(1, self.o["split_bytes"] // max(1, int(head["width"]))) if member.offset is not None else max(1, n)
            out += [RecordRange(member, first, count) for first, count in spans(n, per)]
        return out

    def read(self, partition: RecordRange) -> Iterator[pa.RecordBatch]:
        kinds = {c: ARROW[t] for c, t in self.o["columns"].items()}
        with Bytes(partition.member) as source:
            head, fields = dbf_layout(_header(source))
            start, width = int(head["header"]), int(head["width"])
            for first, count in spans(partition.count, max(1, BLOCK // width)):
                data = source.read(start + (partition.first + first) * width, count * width)
                if len(data) < count * width:
                    raise ValueError(f"{partition.member.path} ends before its {int(head['records'])} records")
                place, columns = decode_records(data, fields, width, partition.first + first, kinds)
                own = [pa.array([partition.member.path] * len(place), pa.string()), pa.array(place, pa.int64())]
                yield pa.RecordBatch.from_arrays(own + columns, names=["path", "record", *kinds])


def read_dbf(spark: SparkSession, paths: Sequence[str], columns: dict[str, str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, record, columns) of plain ``.dbf`` files or the first ``.dbf`` of archives."""
    ship_package(spark)
    spark.dataSource.register(DbfSource)
    options = {"paths": list(paths), "columns": columns, "split_bytes": split_bytes}
    return spark.read.format("dbf").options(**{k: json.dumps(v) for k, v in options.items()}).load()


def read_dbf_zip(spark: SparkSession, folder: str, glob: str, columns: dict[str, str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Attributes of the first ``.dbf`` member of each archive.

    ``columns`` maps DBF field -> Spark type; absent fields come back NULL.
    """
    return read_dbf(spark, paths_of(list_files(spark, folder, glob)), columns, split_bytes)


# ---------------------------------------------------------------- shapefiles

# fixed values: shape types with parts, point sets, and single points
LINES, SETS, POINTS = (3, 13, 23, 5, 15, 25), (8, 18, 28), (1, 11, 21)
INDEX_HEAD = 100
INDEX_ROW = np.dtype([("at", ">i4"), ("words", ">i4")])


def _at(data: bytes, kind: str) -> np.ndarray:
    """``data`` as values of ``kind`` that start at every byte."""
    size = np.dtype(kind).itemsize
    return np.ndarray((max(0, len(data) - size + 1),), kind, data, 0, (1,))


def decode_shapes(data: bytes, starts: np.ndarray, bbox: Sequence[float] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shape's index in ``starts``, seq, x, y) of all vertices of the shapes whose contents
    start at ``starts`` in ``data``; null shapes, and shapes outside ``bbox``, have none."""
    ints, floats = _at(data, "<i4"), _at(data, "<f8")
    kind = ints[starts]
    n, first = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    one, lines, sets = np.isin(kind, POINTS), np.isin(kind, LINES), np.isin(kind, SETS)
    n[one], first[one] = 1, starts[one] + 4
    n[lines], first[lines] = ints[starts[lines] + 40], starts[lines] + 44 + 4 * ints[starts[lines] + 36].astype(np.int64)
    n[sets], first[sets] = ints[starts[sets] + 36], starts[sets] + 40
    if bbox is not None:
        low_x, low_y, high_x, high_y = bbox
        boxed = np.flatnonzero(lines | sets)
        box = [floats[starts[boxed] + 4 + 8 * k] for k in range(4)]
        n[boxed[(box[2] < low_x) | (box[0] > high_x) | (box[3] < low_y) | (box[1] > high_y)]] = 0
        single = np.flatnonzero(one)
        x, y = floats[first[single]], floats[first[single] + 8]
        n[single[(x < low_x) | (x > high_x) | (y < low_y) | (y > high_y)]] = 0
    shape = np.repeat(np.arange(len(starts)), n)
    seq = np.arange(len(shape)) - np.repeat(np.cumsum(n) - n, n)
    place = first[shape] + 16 * seq
    return shape, seq, floats[place], floats[place + 8]


@dataclass
class ShapeRange(InputPartition):
    shp: Member
    shx: Member
    first: int
    count: int


class ShpSource(DataSource):
    """Options (JSON): ``paths`` (archives, or plain ``.shp`` files beside their ``.shx``), ``bbox``, ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "shp"

    def schema(self) -> str:
        return "path string, record long, seq long, lon double, lat double"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ShpReader({k: json.loads(self.options[k]) for k in ("paths", "bbox", "split_bytes")})


class ShpReader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = options

    def partitions(self) -> Sequence[InputPartition]:
        out = []
        for path in self.o["paths"]:
            found = {s: locate(path if path.lower().endswith(".zip") else path[: -len(".shp")] + s, (s,)) for s in (".shp", ".shx")}
            missing = sorted(s for s, v in found.items() if not v)
            if missing:
                raise FileNotFoundError(f"{path} lacks {missing}")
            shp, shx = found[".shp"][0], found[".shx"][0]
            if shx.size < INDEX_HEAD:  # an empty index: the shapes' own headers are followed, in one task
                out.append(ShapeRange(shp, shx, 0, -1))
                continue
            n = (shx.size - INDEX_HEAD) // INDEX_ROW.itemsize
            split = shp.offset is not None and shx.offset is not None
            per = max(1, n * self.o["split_bytes"] // max(1, shp.size)) if split else max(1, n)
            out += [ShapeRange(shp, shx, first, count) for first, count in spans(n, per)]
        return out

    def read(self, partition: ShapeRange) -> Iterator[pa.RecordBatch]:
        with Bytes(partition.shp) as shapes:
            for record, at, size in _indexed(partition) if partition.count >= 0 else _followed(partition.shp):
                order = np.argsort(at, kind="stable")  # a deflated member is read forwards
                at, size, record = at[order], size[order], record[order]
                cut = np.flatnonzero(np.diff((at - at[0]) // BLOCK)) + 1 if len(at) else []
                for a, n, r in zip(np.split(at, cut), np.split(size, cut), np.split(record, cut)):
                    if not len(a):
                        continue
                    data = shapes.read(int(a[0]), int(a[-1] + 8 + n[-1] - a[0])) + bytes(64)
                    shape, seq, x, y = decode_shapes(data, a + 8 - a[0], self.o["bbox"])
                    path = pa.array([partition.shp.path] * len(shape), pa.string())
                    yield pa.RecordBatch.from_arrays([path, pa.array(r[shape]), pa.array(seq), pa.array(x), pa.array(y)], names=["path", "record", "seq", "lon", "lat"])


def _indexed(partition: ShapeRange) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(record, offset of its header, bytes of its content) of blocks of the index."""
    with Bytes(partition.shx) as index:
        for first, count in spans(partition.count, BLOCK // INDEX_ROW.itemsize):
            first += partition.first
            rows = np.frombuffer(index.read(INDEX_HEAD + first * INDEX_ROW.itemsize, count * INDEX_ROW.itemsize), INDEX_ROW)
            yield first + np.arange(len(rows)), 2 * rows["at"].astype(np.int64), 2 * rows["words"].astype(np.int64)


def _followed(shp: Member, many: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same from the shapes' own headers."""
    with Bytes(shp) as shapes:
        at, record, rows = INDEX_HEAD, 0, []
        while at + 8 <= shp.size:
            size = 2 * int(np.frombuffer(shapes.read(at, 8), ">i4")[1])
            rows.append((record, at, size))
            at, record = at + 8 + size, record + 1
            if len(rows) == many or at + 8 > shp.size:
                yield tuple(np.array(c, np.int64) for c in zip(*rows))
                rows = []


def read_shapes(spark: SparkSession, paths: Sequence[str], bbox: Sequence[float] | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, record, seq, lon, lat) of every vertex of the shapes that touch ``bbox``."""
    ship_package(spark)
    spark.dataSource.register(ShpSource)
    options = {"paths": list(paths), "bbox": list(bbox) if bbox else None, "split_bytes": split_bytes}
    return spark.read.format("shp").options(**{k: json.dumps(v) for k, v in options.items()}).load()


def read_route_vertices(
    spark: SparkSession, folder: str, glob: str, id_field: str = "resultId", bbox: Sequence[float] | None = None, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Polyline vertices keyed by the DBF id (S7): ``route_id, seq, lon, lat``.

    Needs .shp, .dbf and .shx members; ids are trimmed; empty shapes are dropped; a
    duplicated id keeps its last record with vertices.  Ids and shapes are joined on their record;
    the id table (a row per corridor) is broadcast when its measured bytes allow it.
    """
    paths = paths_of(list_files(spark, folder, glob))
    vertices = read_shapes(spark, paths, bbox, split_bytes)
    ids = read_dbf(spark, paths, {id_field: "string"}, split_bytes).select("path", "record", F.trim(id_field).alias("route_id")).where("route_id IS NOT NULL")
    whole = read_shapes(spark, paths, None, split_bytes) if bbox else vertices
    shaped = ids.join(whole.where("seq = 0").select("path", "record"), ["path", "record"], "left_semi")
    last = keep_last(shaped, ["route_id"], ["path", "record"], ["path", "record"])
    return vertices.join(measured_side(last, "route-ids"), ["path", "record"]).select("route_id", "seq", "lon", "lat")
