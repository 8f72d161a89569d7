import struct

import pytest
from pyspark.sql import functions as F

from tripweave import schemas
from tripweave.functions import geometry as geo
from tripweave.plans import jobs
from tripweave.sources import shapefile
from tests.test_geometry import ZONE_30

CODES = list(schemas.BOUNDARY_CODES)


def write_layer(folder, name, shapes, fields, rows, kind=5, encoding="utf-8"):
    """``shapes``: rings of each record as in the file (shells clockwise), or None."""
    body = b""
    for number, rings in enumerate(shapes, 1):
        if rings is None:
            record = struct.pack("<i", 0)
        else:
            points = [p for r in rings for p in r]
            starts = [sum(map(len, rings[:i])) for i in range(len(rings))]
            xs, ys = zip(*points)
            record = struct.pack("<i4d2i", kind, min(xs), min(ys), max(xs), max(ys), len(rings), len(points))
            record += struct.pack(f"<{len(starts)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
            if kind == 15:
                record += struct.pack(f"<{len(points) + 2}d", *[0.0] * (len(points) + 2))
        body += struct.pack(">2i", number, len(record) // 2) + record
    header = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<2i8d", 1000, kind, *[0.0] * 8)
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.shp").write_bytes(header + body)
    width = 12
    described = b"".join(f.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([width, 0]) + b"\0" * 14 for f in fields)
    table = b"".join(b" " + b"".join((v or "").encode(encoding).ljust(width) for v in row) for row in rows)
    size = 32 + len(described) + 1
    (folder / f"{name}.dbf").write_bytes(bytes([3, 24, 1, 1]) + struct.pack("<IHH", len(rows), size, 1 + width * len(fields)) + b"\0" * 20 + described + b"\r" + table)


def clockwise(x, y, size):
    return [(x, y), (x, y + size), (x + size, y + size), (x + size, y), (x, y)]


def test_shapes_and_attributes(spark, tmp_path):
    shell, hole, other = clockwise(0.0, 0.0, 4.0), clockwise(1.0, 1.0, 1.0)[::-1], clockwise(9.0, 9.0, 1.0)
    for kind in (5, 15):
        folder = tmp_path / str(kind)
        write_layer(folder, "one", [[shell, hole, other], None], ["NOTE", "cusec"], [("x", "4600101001"), ("", None)], kind)
        write_layer(folder, "two", [[other]], ["CUSEC"], [("añb",)], kind, "latin-1")
        got = shapefile.scan_shapefile(spark, str(folder), ["CUSEC"], "latin-1")
        area = F.round(F.expr(geo.area("geom")), 9)
        rings = F.expr("transform(geom, p -> size(p))")
        assert {(r.CUSEC, r.a, tuple(r.n or ())) for r in got.select("CUSEC", area.alias("a"), rings.alias("n")).collect()} == {
            ("4600101001", 16.0, (1, 2)), (None, None, ()), ("añb", 1.0, (1,))}
    with pytest.raises(Exception, match="CUDIS"):
        shapefile.scan_shapefile(spark, str(folder), ["CUDIS"]).collect()


def test_zones_from_a_layer_in_metres(spark, store, tmp_path):
    """As from GeoJSON, with the projection that lies beside the layer."""
    rows = [(f"46001010{i:02}", "4600101", "46001", "46", "10") for i in range(3)]
    shapes = [[clockwise(700000.0 + 2000 * i, 4350000.0, 1500.0)] for i in range(3)]
    write_layer(tmp_path / "layer", "zones", shapes, CODES, rows)
    (tmp_path / "layer" / "zones.prj").write_text(ZONE_30)
    lines = tmp_path / "zones.geojsonl"
    feature = '{{"type":"Feature","geometry":{{"type":"Polygon","coordinates":[{}]}},"properties":{{{}}}}}'
    text = [feature.format([list(p) for p in reversed(r[0])], ",".join(f'"{c}":"{v}"' for c, v in zip(CODES, row))) for r, row in zip(shapes, rows)]
    lines.write_text("\n".join(text) + "\n")
    ours = jobs.geometry_job(store, str(tmp_path / "layer"), 2022, form="shapefile")
    theirs = jobs.geometry_job(store, str(lines), 2023)
    one, two = ([(r.census_section_id, round(r.xmin, 9), round(r.ymax, 9), round(r.centroid.x, 9)) for r in t.where(f"year = {y}").orderBy("census_section_id").collect()] for t, y in ((ours, 2022), (theirs, 2023)))
    assert one == two and len(one) == 3
