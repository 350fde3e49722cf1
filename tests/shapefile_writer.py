"""Test helper: write small Shapefile sets (points, polygons) with struct."""
import struct


def _shp(records, shape_type, bbox):
    body = b""
    for i, content in enumerate(records, 1):
        body += struct.pack(">2i", i, len(content) // 2) + content
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2)
    head += struct.pack("<2i", 1000, shape_type) + struct.pack("<8d", *bbox, 0, 0, 0, 0)
    return head + body


def point_rec(x, y):
    return struct.pack("<i2d", 1, x, y)


def polygon_rec(rings):
    pts = [p for r in rings for p in r]
    xs, ys = [p[0] for p in pts], [p[1] for p in pts]
    starts, k = [], 0
    for r in rings:
        starts.append(k)
        k += len(r)
    out = struct.pack("<i4d2i", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(pts))
    out += struct.pack(f"<{len(rings)}i", *starts)
    for x, y in pts:
        out += struct.pack("<2d", x, y)
    return out


def _dbf(fields, rows, deleted=()):
    # fields: (name, type, length, decimals)
    hlen = 32 + 32 * len(fields) + 1
    rlen = 1 + sum(f[2] for f in fields)
    head = struct.pack("<B3BIHH20x", 3, 124, 1, 1, len(rows), hlen, rlen)
    for name, t, ln, dec in fields:
        head += name.encode().ljust(11, b"\x00") + t.encode() + b"\x00" * 4 + bytes([ln, dec]) + b"\x00" * 14
    head += b"\x0d"
    body = b""
    for i, row in enumerate(rows):
        body += b"*" if i in deleted else b" "
        for (name, t, ln, dec), v in zip(fields, row):
            s = "" if v is None else str(v)
            body += (s.rjust(ln) if t in "NF" else s.ljust(ln)).encode("latin-1")[:ln]
    return head + body


def write_set(folder, stem, shape_type, records, bbox, fields, rows, deleted=()):
    (folder / f"{stem}.shp").write_bytes(_shp(records, shape_type, bbox))
    (folder / f"{stem}.dbf").write_bytes(_dbf(fields, rows, deleted))
