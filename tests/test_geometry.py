import math
import random

import pytest
from pyspark.sql import functions as F

from tripweave.functions import formats, geometry as geo, predicates, projections
from tripweave.functions.geodesy import GRS80, TransverseMercator, ellipsoid_distance
from tripweave.functions.lambdas import num
from tripweave.operators import outline, validity, zones as zone_ops
from tripweave.operators.validity import with_validity
from tripweave.plans import jobs
from tripweave.sources import boundaries

BOX = "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0))"
HOLED = "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"

# a, b, intersects, within, contains, overlaps
CASES = [
    ("POLYGON((1 1,2 1,2 2,1 2,1 1))", BOX, 1, 1, 0, 0),
    ("POLYGON((0 0,2 0,2 2,0 2,0 0))", BOX, 1, 1, 0, 0),
    ("POLYGON((0 0,0 2,2 2,2 0,0 0))", BOX, 1, 1, 0, 0),
    (BOX, BOX, 1, 1, 1, 0),
    ("POLYGON((4 0,5 0,5 4,4 4,4 0))", BOX, 1, 0, 0, 0),
    ("POLYGON((4 4,5 4,5 5,4 5,4 4))", BOX, 1, 0, 0, 0),
    ("POLYGON((3 3,5 3,5 5,3 5,3 3))", BOX, 1, 0, 0, 1),
    ("POLYGON((0 0,2 0,2 6,0 6,0 0))", BOX, 1, 0, 0, 1),
    ("POLYGON((-1 -1,5 -1,5 5,-1 5,-1 -1))", BOX, 1, 0, 1, 0),
    ("POLYGON((1.2 1.2,1.8 1.2,1.8 1.8,1.2 1.8,1.2 1.2))", HOLED, 0, 0, 0, 0),
    ("POLYGON((1 1,2 1,2 2,1 2,1 1))", HOLED, 1, 0, 0, 0),
    ("POLYGON((0.5 0.5,3 0.5,3 3,0.5 3,0.5 0.5))", HOLED, 1, 0, 0, 1),
    ("POLYGON((9 9,10 9,10 10,9 9))", BOX, 0, 0, 0, 0),
    ("MULTIPOLYGON(((1 1,2 1,2 2,1 2,1 1)),((9 9,10 9,10 10,9 9)))", BOX, 1, 0, 0, 1),
    ("POLYGON((2 -1,5 2,2 5,-1 2,2 -1))", BOX, 1, 0, 0, 1),
    ("POLYGON((2 0,4 2,2 4,0 2,2 0))", BOX, 1, 1, 0, 0),
]


def shapes(spark, *texts):
    names = [f"t{i}" for i in range(len(texts[0]))]
    rows = spark.createDataFrame(list(texts), ", ".join(f"{n} string" for n in names))
    return rows.select("*", *[F.expr(formats.from_wkt(n)).alias(f"g{n[1:]}") for n in names])


def test_predicates(spark):
    table = shapes(spark, *[c[:2] for c in CASES])
    checks = [F.expr(f("g0", "g1")).cast("int") for f in predicates.PREDICATES.values()]
    found = {(r[0], r[1]): tuple(r[2:]) for r in table.select("t0", "t1", *checks).collect()}
    assert found == {(a, b): tuple(flags) for a, b, *flags in CASES}


def test_unknown_predicate(spark):
    with pytest.raises(ValueError):
        predicates.predicate("near")
    with pytest.raises(ValueError):
        zone_ops.zones_in_area(shapes(spark, (BOX,)), BOX, "overlaps")


def test_random_boxes_against_intervals(spark):
    """Boxes on a small whole-number grid, so that borders and corners often coincide."""
    rng = random.Random(5)

    def box():
        x, y = rng.randint(0, 5), rng.randint(0, 5)
        return x, y, x + rng.randint(1, 4), y + rng.randint(1, 4)

    pairs = [box() + box() for _ in range(300)]
    names = ["ax", "ay", "au", "av", "bx", "by_", "bu", "bv"]
    table = spark.createDataFrame([tuple(map(float, p)) for p in pairs], ", ".join(f"{n} double" for n in names))
    table = table.select(
        "*",
        F.expr(geo.rectangle("ax", "ay", "au", "av")).alias("a"),
        F.expr(geo.rectangle("bx", "by_", "bu", "bv")).alias("b"),
    )
    checks = [F.expr(f("a", "b")).alias(name) for name, f in predicates.PREDICATES.items()]
    for r in table.select(*names, *checks).collect():
        meet = r.ax <= r.bu and r.bx <= r.au and r.ay <= r.bv and r.by_ <= r.av
        inner = r.ax < r.bu and r.bx < r.au and r.ay < r.bv and r.by_ < r.av
        inside = r.ax >= r.bx and r.au <= r.bu and r.ay >= r.by_ and r.av <= r.bv
        around = r.bx >= r.ax and r.bu <= r.au and r.by_ >= r.ay and r.bv <= r.av
        assert (r.intersects, r.within, r.contains, r.overlaps) == (
            meet, inside, around, inner and not inside and not around,
        ), r


def test_measures(spark):
    table = shapes(spark, (HOLED,))
    r = table.select(
        F.expr(geo.area("g0")).alias("area"),
        F.expr(geo.centroid("g0")).alias("c"),
        *[F.expr(e).alias(n) for n, e in geo.envelope("g0").items()],
    ).first()
    assert r.area == pytest.approx(15)
    assert (r.c.x, r.c.y) == (pytest.approx((16 * 2 - 1.5) / 15), pytest.approx((16 * 2 - 1.5) / 15))
    assert (r.xmin, r.ymin, r.xmax, r.ymax) == (0, 0, 4, 4)


def test_validity(spark):
    good = [BOX, HOLED]
    bad = [
        "POLYGON((0 0, 2 2, 2 0, 0 2, 0 0))",  # bow tie
        "POLYGON((0 0, 4 0, 4 4, 0 4))",  # open
        "POLYGON((0 0, 1 0, 0 0))",  # no area
        "POLYGON((0 0, 4 0, 4 4, 4 -1, 4 4, 0 4, 0 0))",  # folds back
        "POLYGON((0 0, 4 0, 4 4, 2 0, 0 4, 0 0))",  # touches itself
        "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (3 3, 5 3, 5 5, 3 5, 3 3))",  # a hole across the shell
        "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (6 6, 7 6, 7 7, 6 7, 6 6))",  # a hole outside
        "MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5, 7 7, 7 5, 5 7, 5 5)))",  # one part is a bow tie
    ]
    good += ["POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (0 2, 1 1, 1 3, 0 2))", "MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))"]
    table = shapes(spark, *[(t,) for t in good + bad], (None,)).withColumnRenamed("g0", "geometry")
    found = {r.t0: r.valid for r in with_validity(table).collect()}
    assert found == {**dict.fromkeys(good, True), **dict.fromkeys(bad, False), None: False}


def test_validity_compares_few_edges(spark, monkeypatch):
    """Rings of 500 and 2,000 corners: the work grows with the corners, not their square."""
    seen = []
    monkeypatch.setattr(validity, "written", lambda table, name: seen.append((name, table)) or table)

    def ring(n):
        turns = [2 * math.pi * i / n for i in range(n)]
        at = [(round((5 + math.sin(9 * t)) * math.cos(t), 9), round((5 + math.sin(9 * t)) * math.sin(t), 9)) for t in turns]
        return "POLYGON((" + ",".join(f"{x} {y}" for x, y in [*at, at[0]]) + "))"

    pairs = {}
    for n in (500, 2000):
        seen.clear()
        table = shapes(spark, (ring(n),)).withColumnRenamed("g0", "geometry")
        assert validity.with_validity(table).first().valid
        laid = dict(seen)["validity-slabs"].groupBy("slab").count()
        pairs[n] = laid.agg(F.sum(F.expr("count * count"))).first()[0]
    assert pairs[2000] < 2 * 4 * pairs[500]


def test_text_forms(spark):
    two = "MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))"
    table = shapes(spark, (BOX,), (HOLED,), (two,), ("POLYGON((-1.5e-3 +2.25, 1 .5, 3. 4, -1.5e-3 +2.25))",))
    back = table.select(
        (F.expr(formats.from_wkt(formats.to_wkt("g0"))) == F.col("g0")).alias("w"),
        (F.expr(formats.geojson_text(formats.to_geojson("g0"))) == F.col("g0")).alias("j"),
    ).collect()
    assert all(r.w and r.j for r in back)
    assert shapes(spark, ("LINESTRING(0 0, 1 1)",), ("rubbish",), (None,)).where("g0 is not null").count() == 0
    p = spark.range(1).select(F.expr(formats.point_from_wkt("'POINT (-0.4 39.5)'")).alias("p")).first().p
    assert (p.x, p.y) == (-0.4, 39.5)


def test_distance(spark):
    def km(*c, **k):
        return spark.range(1).select(F.expr(ellipsoid_distance(*map(num, c), **k)).alias("m")).first().m

    assert km(-0.3763, 39.4699, -3.7038, 40.4168) == pytest.approx(303170.5378, abs=1e-3)
    assert km(1, 2, 1, 2) == 0
    # A published survey line: Flinders Peak to Buninyong.
    line = (144 + 25 / 60 + 29.5244 / 3600, -(37 + 57 / 60 + 3.7203 / 3600))
    line += (143 + 55 / 60 + 35.3839 / 3600, -(37 + 39 / 60 + 10.1561 / 3600))
    assert km(*line, ellipsoid=GRS80) == pytest.approx(54972.271, abs=1e-3)
    # Along the equator the ellipsoid is a circle.
    assert km(0, 0, 1, 0) == pytest.approx(111319.4908, abs=1e-3)


def test_projection_round_trip(spark):
    plane = TransverseMercator()
    grid = spark.sql("select -9 + i * 0.75D as lon, 27.5 + j * 1.1D as lat from range(17) a(i), range(16) b(j)")
    there = grid.withColumn("p", F.expr(plane.from_lonlat("lon", "lat")))
    back = there.withColumn("q", F.expr(plane.to_lonlat("p.x", "p.y")))
    worst = back.selectExpr("max(greatest(abs(q.x - lon), abs(q.y - lat)))").first()[0]
    assert worst < 1e-9
    known = spark.range(1).select(F.expr(plane.from_lonlat("-0.3763D", "39.4699D")).alias("p")).first().p
    assert (known.x, known.y) == (pytest.approx(725695.71, abs=0.01), pytest.approx(4372210.14, abs=0.01))
    middle = spark.range(1).select(F.expr(plane.from_lonlat("-3D", "0D")).alias("p")).first().p
    assert (middle.x, middle.y) == (pytest.approx(500000), pytest.approx(0, abs=1e-6))


TEXAS = (
    'PROJCS["NAD27 / Texas South Central",GEOGCS["NAD27",DATUM["North_American_Datum_1927",SPHEROID["Clarke 1866",6378206.4,294.978698213898]],'
    'PRIMEM["Greenwich",0],UNIT["degree",0.0174532925199433]],PROJECTION["Lambert_Conformal_Conic_2SP"],'
    'PARAMETER["standard_parallel_1",28.3833333333333],PARAMETER["standard_parallel_2",30.2833333333333],'
    'PARAMETER["latitude_of_origin",27.8333333333333],PARAMETER["central_meridian",-99],'
    'PARAMETER["false_easting",2000000],PARAMETER["false_northing",0],UNIT["US survey foot",0.304800609601219]]'
)
ZONE_30 = (
    'PROJCS["UTM 30N",GEOGCS["ETRS",DATUM["D",SPHEROID["GRS_1980",6378137.0,298.257222101]],PRIMEM["Greenwich",0.0],'
    'UNIT["Degree",0.0174532925199433]],PROJECTION["Transverse_Mercator"],PARAMETER["False_Easting",500000.0],'
    'PARAMETER["False_Northing",0.0],PARAMETER["Central_Meridian",-3.0],PARAMETER["Scale_Factor",0.9996],'
    'PARAMETER["Latitude_Of_Origin",0.0],UNIT["Meter",1.0]]'
)


def test_projections_by_description(spark):
    def at(text):
        return spark.range(1).select(F.expr(text).alias("p")).first().p

    # A published example: 28 30 N, 96 W lies at 2963503.91, 254759.80 feet.
    p = at(projections.from_description(TEXAS).to_lonlat("2963503.91D", "254759.80D"))
    assert (p.x, p.y) == (pytest.approx(-96, abs=1e-7), pytest.approx(28.5, abs=1e-7))
    read = projections.from_description(ZONE_30)
    plane = TransverseMercator()
    assert read.unit == 1 and (read.plane.meridian, read.plane.radius) == (plane.meridian, pytest.approx(plane.radius))
    assert projections.from_description(TEXAS[TEXAS.index("GEOGCS") : TEXAS.index(",PROJECTION")]).plane is None
    assert at(projections.from_description(ZONE_30.replace('Origin",0.0', 'Origin",40.0')).plane.from_lonlat("-3D", "40D")).y == pytest.approx(0, abs=1e-6)
    for wrong in (ZONE_30.replace("Transverse_Mercator", "Robinson"), "PROJCS[]"):
        with pytest.raises(ValueError):
            projections.from_description(wrong)
    for cone in (projections.from_description(TEXAS).plane, projections.LambertConic((-30.0, -30.0), (20.0, -30.0), scale=0.999)):
        south = cone.origin[1] < 0
        grid = spark.sql(f"select {cone.origin[0]} + i * 2D as lon, {-50 if south else 20} + j * 2.5D as lat from range(-5, 6) a(i), range(9) b(j)")
        there = grid.withColumn("p", F.expr(cone.from_lonlat("lon", "lat")))
        back = there.withColumn("q", F.expr(cone.to_lonlat("p.x", "p.y")))
        assert back.selectExpr("max(greatest(abs(q.x - lon), abs(q.y - lat)))").first()[0] < 1e-9


def test_area_of_a_layer_in_metres(spark):
    zones = zone_table(spark, [square(-3, 40), square(-1, 40)])
    plane = [f"POLYGON(({','.join(f'{x} {y}' for x, y in [(480000, 4400000), (600000, 4400000), (600000, 4600000), (480000, 4600000), (480000, 4400000)])}))"]
    got = picked(jobs.extract_area(zones, plane, "intersects", ZONE_30))
    assert got == {square(-3, 40)} == picked(jobs.extract_area(zones, plane[0], "intersects", ZONE_30))


def merged(spark, texts):
    table = shapes(spark, *[(t,) for t in texts]).select(F.lit("m").alias("municipality_id"), F.col("g0").alias("geometry"))
    r = outline.merged_shapes(table).select("geometry", F.expr(geo.area("geometry")).alias("area")).first()
    return r.geometry, r.area


def square(x, y, size=1):
    return f"POLYGON(({x} {y},{x + size} {y},{x + size} {y + size},{x} {y + size},{x} {y}))"


def test_merged_block(spark):
    shape, area = merged(spark, [square(x, y) for x in range(3) for y in range(2)])
    assert area == pytest.approx(6) and len(shape) == 1 and len(shape[0]) == 1 and len(shape[0][0]) == 11


def test_merged_ring_keeps_its_hole(spark):
    shape, area = merged(spark, [square(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)])
    assert area == pytest.approx(8) and len(shape) == 1 and len(shape[0]) == 2


def test_merged_corner_touch_and_repeats(spark):
    shape, area = merged(spark, [square(0, 0), square(1, 1)])
    assert area == pytest.approx(2) and len(shape) == 2
    shape, area = merged(spark, [square(0, 0), square(1, 0)] * 2)
    assert area == pytest.approx(2) and len(shape) == 1


def zone_table(spark, texts):
    rows = shapes(spark, *[(t,) for t in texts])
    codes = {c: F.lit("1") for c in ("district_id", "municipality_id", "province_id", "autonomous_community_id")}
    named = rows.select(F.col("g0").alias("geometry"), F.col("t0").alias("census_section_id"), F.lit(2023).alias("year"))
    return boundaries.with_measures(named.withColumns(codes))


def picked(table):
    return {r.census_section_id for r in table.collect()}


def test_zones_in_area(spark):
    texts = [square(0, 0), square(3, 3), square(4, 4), square(3.5, 0), square(9, 9)]
    zones = zone_table(spark, texts)
    assert picked(zone_ops.zones_in_area(zones, BOX)) == set(texts[:4])
    inside = {texts[0], texts[1]}
    assert picked(zone_ops.zones_in_area(zones, BOX, "within")) == inside
    assert picked(zone_ops.zones_in_area(zones, BOX, "contains")) == inside


def test_layer_answers_for_the_union(spark):
    """Two layer halves share the border x = 2."""
    halves = ["POLYGON((0 0,2 0,2 4,0 4,0 0))", "POLYGON((2 0,4 0,4 4,2 4,2 0))"]
    across, left, out = square(1, 1, 2), square(0, 0), square(3, 3, 2)
    around, touching, far = square(-1, -1, 6), square(4, 1), square(8, 8)
    two = "MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)),((3 3,4 3,4 4,3 4,3 3)))"
    half_out = "MULTIPOLYGON(((0 2,1 2,1 3,0 3,0 2)),((7 7,8 7,8 8,7 8,7 7)))"
    zones = zone_table(spark, [across, left, out, around, touching, far, two, half_out, BOX])
    layer = zone_ops.layer_from_wkt(zones, halves)
    got = {name: picked(zone_ops.zones_by_layer(zones, layer, name)) for name in predicates.PREDICATES}
    assert got["intersects"] == {across, left, out, around, touching, two, half_out, BOX}
    assert got["within"] == {across, left, two, BOX}
    assert got["contains"] == {around, BOX}
    assert got["overlaps"] == {out, half_out}


def test_layer_agrees_with_single_polygon(spark):
    rng = random.Random(9)
    texts = [square(rng.randint(-2, 6), rng.randint(-2, 6), rng.randint(1, 3)) for _ in range(40)]
    zones = zone_table(spark, sorted(set(texts)))
    layer = zone_ops.layer_from_wkt(zones, [HOLED])
    area = shapes(spark, (HOLED,)).select(F.col("g0").alias("b"))
    for name, f in predicates.PREDICATES.items():
        direct = zones.join(area, F.expr(f("geometry", "b")), "inner")
        assert picked(zone_ops.zones_by_layer(zones, layer, name)) == picked(direct), name
