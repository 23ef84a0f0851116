"""Test-only writers for small dBase / shapefile fixtures (public format layouts)."""

from __future__ import annotations

import struct
import zipfile


def dbf_bytes(fields, records, deleted=()):
    """fields: [(name, type, width, decimals)], records: list of tuples of str."""
    header_len = 32 + 32 * len(fields) + 1
    rec_len = 1 + sum(f[2] for f in fields)
    out = bytearray(struct.pack("<BBBBIHH20x", 3, 124, 1, 1, len(records), header_len, rec_len))
    for name, ftype, width, dec in fields:
        out += struct.pack("<11sc4xBB14x", name.encode(), ftype.encode(), width, dec)
    out += b"\x0d"
    for i, rec in enumerate(records):
        out += b"*" if i in deleted else b" "
        for (name, ftype, width, dec), val in zip(fields, rec):
            text = str(val)
            cell = text.rjust(width) if ftype in "NF" else text.ljust(width)
            out += cell.encode("latin-1")[:width]
    out += b"\x1a"
    return bytes(out)


def shp_bytes(polylines):
    """polylines: list of vertex lists [(x, y), ...] (empty list = null shape)."""
    recs = bytearray()
    for i, pts in enumerate(polylines, start=1):
        if not pts:
            content = struct.pack("<i", 0)
        else:
            xs = [p[0] for p in pts]
            ys = [p[1] for p in pts]
            content = struct.pack("<i4d2i", 3, min(xs), min(ys), max(xs), max(ys), 1, len(pts)) + struct.pack("<i", 0)
            for x, y in pts:
                content += struct.pack("<2d", x, y)
        recs += struct.pack(">2i", i, len(content) // 2) + content
    total = (100 + len(recs)) // 2
    header = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, total) + struct.pack("<2i4d4d", 1000, 3, 0, 0, 0, 0, 0, 0, 0, 0)
    return header + bytes(recs)


def write_zip(path, members):
    with zipfile.ZipFile(path, "w") as zf:
        for name, data in members.items():
            zf.writestr(name, data)
    return path
