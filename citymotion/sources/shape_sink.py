"""Corridor polylines and attributes as shapefiles (.shp, .shx, .dbf), one triple per partition.

A record has one polyline; attributes are text (C) or numbers (N) wide enough to be read back
unchanged.  A partition's records are held as bytes until the file's length, which the
headers state, is known, so partitions should hold less than memory; a repeated task writes
the same files again.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from citymotion.sources.common import open_output, ship_package
from citymotion.sources.dbase import FIELD, HEAD

NUMBER_WIDTH = 25
DECIMALS = 17


def _dbf(names: list[str], numeric: list[bool], rows: list[tuple]) -> bytes:
    cells = [["" if v is None else repr(float(v)) if n else str(v) for v, n in zip(r, numeric)] for r in rows]
    widths = [NUMBER_WIDTH if n else max([1, *(len(c[i].encode("latin-1", "replace")) for c in cells)]) for i, n in enumerate(numeric)]
    head = np.zeros(1, HEAD)
    head["version"], head["records"], head["header"], head["width"] = 3, len(rows), HEAD.itemsize + FIELD.itemsize * len(names) + 1, 1 + sum(widths)
    fields = np.zeros(len(names), FIELD)
    for f, name, number, width in zip(fields, names, numeric, widths):
        f["name"], f["kind"], f["width"], f["decimals"] = name.encode("ascii")[:10], b"N" if number else b"C", width, DECIMALS if number else 0
    body = b"".join(b" " + b"".join(c.encode("latin-1", "replace").rjust(w) if n else c.encode("latin-1", "replace").ljust(w) for c, w, n in zip(r, widths, numeric)) for r in cells)
    return head.tobytes() + fields.tobytes() + b"\r" + body + b"\x1a"


def _shape(points: np.ndarray) -> bytes:
    """Content of a polyline's record; a null shape without points."""
    if not len(points):
        return struct.pack("<i", 0)
    box = [*points.min(axis=0), *points.max(axis=0)]
    return struct.pack("<i4d3i", 3, *box, 1, len(points), 0) + points.astype("<f8").tobytes()


def _header(words: int, box: list[float]) -> bytes:
    return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, words) + struct.pack("<2i8d", 1000, 3, *box, 0, 0, 0, 0)


def write_shapefiles(routes: DataFrame, path: str, points: str = "points") -> DataFrame:
    """Write ``routes`` (attribute columns and ``points``: array of (lon, lat)) below ``path``;
    returns (stem, records) of the files that were written."""
    ship_package(routes.sparkSession)
    kinds = {f.name: f.dataType.simpleString() != "string" for f in routes.schema.fields if f.name != points}
    names, numeric = list(kinds), list(kinds.values())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contents, rows, boxes = [], [], []
        for b in batches:
            lists = b.column(points)
            flat = lists.flatten()
            xy = np.stack([flat.field(0).to_numpy(zero_copy_only=False), flat.field(1).to_numpy(zero_copy_only=False)], axis=1)
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            for one in np.split(xy, ends[:-1]) if b.num_rows else ():
                contents.append(_shape(one))
                boxes += [[*one.min(axis=0), *one.max(axis=0)]] if len(one) else []
            rows += list(zip(*[b.column(n).to_pylist() for n in names]))
        stem = f"{path.rstrip('/')}/part-{TaskContext.get().partitionId():05d}"
        all_boxes = np.array(boxes).reshape(-1, 4)
        box = [*all_boxes[:, :2].min(axis=0), *all_boxes[:, 2:].max(axis=0)] if len(all_boxes) else [0.0] * 4
        sizes = np.array([len(c) for c in contents], np.int64)
        at = 100 + np.cumsum(sizes + 8) - (sizes + 8)
        if len(at) and at[-1] + sizes[-1] >= 1 << 31:
            raise ValueError("a shapefile holds 2 GB at most: use more partitions")
        index = np.zeros(len(contents), [("at", ">i4"), ("words", ">i4")])
        index["at"], index["words"] = at // 2, sizes // 2
        with open_output(stem + ".shp") as out:
            out.write(_header((100 + int((sizes + 8).sum())) // 2, box))
            for i, c in enumerate(contents):
                out.write(struct.pack(">2i", i + 1, len(c) // 2) + c)
        with open_output(stem + ".shx") as out:
            out.write(_header((100 + 8 * len(contents)) // 2, box) + index.tobytes())
        with open_output(stem + ".dbf") as out:
            out.write(_dbf(names, numeric, rows))
        yield pa.RecordBatch.from_pydict({"stem": [stem], "records": pa.array([len(contents)], pa.int64())})

    return routes.mapInArrow(write, "stem string, records long")
