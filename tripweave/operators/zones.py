"""Zone extraction by polygon, and counts, extents and centres of zones."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tripweave.functions import formats, geometry as geo, predicates
from tripweave.operators.cover import polygon_facts
from tripweave.operators.outline import outline_edges
from tripweave.operators.overlay import union_border
from tripweave.session import written

# Fixed value: the default study polygon, in degrees.
DEFAULT_AREA = (
    "POLYGON((-0.5663 39.5765, -0.2295 39.5765, -0.2295 39.3073, "
    "-0.5663 39.3073, -0.5663 39.5765))"
)

ZONE_KEY = ["census_section_id", "year"]


def require_rows(table: DataFrame, name: str) -> DataFrame:
    if table.isEmpty():
        raise ValueError(f"{name} has no rows")
    return table


def _bounds(wkt: str) -> tuple[float, float, float, float]:
    numbers = [float(n) for n in re.findall(r"[-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?", wkt)]
    xs, ys = numbers[0::2], numbers[1::2]
    if len(xs) < 3 or len(xs) != len(ys):
        raise ValueError(f"not a polygon: {wkt[:80]}")
    return min(xs), min(ys), max(xs), max(ys)


def _with_area(zones: DataFrame, wkt: str) -> DataFrame:
    """Add the polygon as ``_area``; a scalar subquery, so the text is read once per query."""
    area = zones.sparkSession.range(1).select(F.lit(wkt).alias("t")).select(F.expr(formats.from_wkt("t")).alias("v"))
    return zones.withColumn("_area", area.scalar())


def zones_in_area(zones: DataFrame, wkt: str = DEFAULT_AREA, name: str = "intersects") -> DataFrame:
    """Zones that meet one polygon (``intersects``) or lie in it (``within``, ``contains``).

    Both of the latter ask that the polygon contains the zone. The box test comes
    first, on plain columns: it reaches the Parquet scan and skips files and row groups.
    """
    if name not in ("intersects", "within", "contains"):
        raise ValueError(f"unknown predicate {name!r}; known: intersects, within, contains")
    xmin, ymin, xmax, ymax = _bounds(wkt)
    if name == "intersects":
        near = zones.where(
            (F.col("xmax") >= xmin)
            & (F.col("xmin") <= xmax)
            & (F.col("ymax") >= ymin)
            & (F.col("ymin") <= ymax)
        )
        return _with_area(near, wkt).where(F.expr(predicates.intersects("geometry", "_area"))).drop("_area")
    inside = zones.where(
        (F.col("xmin") >= xmin)
        & (F.col("xmax") <= xmax)
        & (F.col("ymin") >= ymin)
        & (F.col("ymax") <= ymax)
    )
    return _with_area(inside, wkt).where(F.expr(predicates.within("geometry", "_area"))).drop("_area")


# A shape reaches over at most this many grid cells in each direction.
CELLS_ACROSS = 4
# Zones of one cell are spread over this many tasks.
SALTS = 8


def _boxed(table: DataFrame, shape: str) -> DataFrame:
    return table.withColumns({c: F.expr(e) for c, e in geo.envelope(shape).items()})


def _extent(table: DataFrame) -> DataFrame:
    return table.select(F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")).alias("d"))


def _cells(low: str, high: str, size: Column) -> Column:
    first = F.floor(F.col(low) / size)
    return F.explode(F.sequence(first, F.greatest(first, F.floor(F.col(high) / size))))


def _gridded(table: DataFrame, size: Column) -> DataFrame:
    across = table.withColumn("_cx", _cells("xmin", "xmax", size))
    return across.withColumn("_cy", _cells("ymin", "ymax", size))


def _meet_on_grid(polygons: DataFrame, shapes: DataFrame, size: Column) -> DataFrame:
    """Pairs of polygons and shapes whose boxes meet, each pair once.

    Both sides are laid on a grid and joined on the cell. A pair that meets in
    several cells is kept in the one that holds the low corner of the common box.
    Cells full of zones are split: zones take one of several salts, the few shapes
    of a cell are copied to each.
    """
    left = _gridded(polygons, size).withColumn("_salt", F.pmod(F.xxhash64(*ZONE_KEY), F.lit(SALTS)).cast("int"))
    names = {c: f"s_{c}" for c in ("xmin", "ymin", "xmax", "ymax")}
    right = _gridded(shapes, size).withColumnsRenamed(names)
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    corner_x = F.floor(F.greatest("xmin", "s_xmin") / size)
    corner_y = F.floor(F.greatest("ymin", "s_ymin") / size)
    return left.join(right.hint("merge"), ["_cx", "_cy", "_salt"]).where(
        (F.col("xmin") <= F.col("s_xmax"))
        & (F.col("s_xmin") <= F.col("xmax"))
        & (F.col("ymin") <= F.col("s_ymax"))
        & (F.col("s_ymin") <= F.col("ymax"))
        & (F.col("_cx") == corner_x)
        & (F.col("_cy") == corner_y)
    )


def zones_by_layer(zones: DataFrame, layer: DataFrame, name: str = "intersects") -> DataFrame:
    """Zones that stand in a relation to the union of a polygon layer.

    ``contains`` here asks that the zone contains the whole layer. ``layer`` has a
    ``geometry`` column in degrees; its polygons may overlap, and their common borders may
    be cut unevenly. Zones are told apart by ZONE_KEY.

    Nothing is broadcast, as shapes are many times their size in a file, by which Spark
    would choose: all joins sort and merge. Of the union just the border is made (see
    ``cover``): each polygon of a zone meets the border's edges near it, and one point of
    it is asked for. Only zones whose box holds the layer's box can contain the layer; each
    polygon of the layer is then tested with them.
    """
    predicates.predicate(name)
    numbered = written(zones.select(*ZONE_KEY, "geometry"), "layer-zones")
    single = numbered.select(*ZONE_KEY, F.posexplode("geometry").alias("piece", "p")).select(
        *ZONE_KEY, F.array("p").alias("shape"), F.xxhash64(*ZONE_KEY, "piece").alias("id")
    )
    wanted = zones.select(*ZONE_KEY).distinct()
    if name != "contains":
        border = union_border(layer.select(F.expr(geo.oriented("geometry")).alias("geometry")), [])
        facts = single.join(polygon_facts(single.select("id", "shape").dropDuplicates(["id"]), border).hint("merge"), "id").groupBy(*ZONE_KEY).agg(
            F.bool_or("touch").alias("touch"), F.bool_or("meets").alias("meets"), F.bool_and("inside").alias("inside")
        )
        truth = {"intersects": "touch", "within": "inside", "overlaps": "meets and not inside"}[name]
        wanted = facts.where(truth).select(*ZONE_KEY)
    if name in ("contains", "overlaps"):
        holding = _holding(zones, layer)
        wanted = wanted.join(holding.hint("merge"), ZONE_KEY, "left_anti" if name == "overlaps" else "left_semi")
    return zones.join(wanted.hint("merge"), ZONE_KEY, "left_semi")


def _holding(zones: DataFrame, layer: DataFrame) -> DataFrame:
    """The keys of the zones that contain each polygon of the layer."""
    polygon = layer.select(F.explode("geometry").alias("p")).select(F.array("p").alias("s_geometry"))
    parts = _boxed(polygon.distinct().withColumn("part", F.xxhash64("s_geometry")), "s_geometry")
    whole = parts.agg(*[f(c).alias(f"_{c}") for f, c in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))]).first()
    if whole._xmin is None:
        return zones.select(*ZONE_KEY).limit(0)
    around = zones.where(
        (F.col("xmin") <= whole._xmin) & (F.col("ymin") <= whole._ymin) & (F.col("xmax") >= whole._xmax) & (F.col("ymax") >= whole._ymax)
    )
    single = around.select(*ZONE_KEY, F.explode("geometry").alias("p")).select(*ZONE_KEY, F.array("p").alias("shape"))
    size = _extent(parts).unionAll(_extent(around)).agg((F.max("d") / CELLS_ACROSS).alias("d")).scalar()
    pairs = _meet_on_grid(_boxed(single, "shape"), parts, size)
    held = pairs.where(predicates.within("s_geometry", "shape")).groupBy(*ZONE_KEY).agg(F.count_distinct("part").alias("n"))
    total = parts.agg(F.count_distinct("part").alias("n")).first().n
    return held.where(F.col("n") == total).select(*ZONE_KEY)


def layer_from_wkt(zones: DataFrame, texts: list[str]) -> DataFrame:
    """A polygon layer from WKT texts given as parameters."""
    rows = zones.sparkSession.createDataFrame([(t,) for t in texts], "wkt string")
    return rows.select(F.expr(formats.from_wkt("wkt")).alias("geometry"))


def district_list(zones: DataFrame) -> DataFrame:
    return zones.where("district_id is not null").select("district_id").distinct().orderBy("district_id")


def sections_per_municipality(zones: DataFrame) -> DataFrame:
    counted = zones.groupBy("municipality_id").agg(F.count(F.lit(1)).alias("sections"))
    return counted.orderBy(F.desc("sections"), "municipality_id")


def sections_per_district(zones: DataFrame) -> DataFrame:
    counted = zones.groupBy("district_id").agg(F.count(F.lit(1)).alias("num_sections"))
    return counted.orderBy("district_id")


def extraction_share(zones: DataFrame, kept: DataFrame) -> DataFrame:
    """Row counts before and after an extraction, and the share kept in percent."""
    before = zones.select(F.lit(1).alias("all"), F.lit(0).alias("kept"))
    after = kept.select(F.lit(0).alias("all"), F.lit(1).alias("kept"))
    counts = before.unionByName(after).agg(
        F.coalesce(F.sum("all"), F.lit(0)).alias("silver_count"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("gold_count"),
    )
    share = F.try_divide(F.col("gold_count") * 100.0, F.col("silver_count"))
    return counts.withColumn("kept_percent", share)


def municipality_extent(zones: DataFrame, municipality: str) -> DataFrame:
    chosen = zones.where(F.col("municipality_id") == municipality)
    return chosen.agg(
        F.min("xmin").alias("min_x"),
        F.max("xmax").alias("max_x"),
        F.min("ymin").alias("min_y"),
        F.max("ymax").alias("max_y"),
    )


def municipality_centroids(zones: DataFrame) -> DataFrame:
    """Per municipality the mean of its distinct zone centres."""
    spots = zones.select("municipality_id", "centroid.x", "centroid.y").distinct()
    return spots.groupBy(F.col("municipality_id").alias("municipality_code")).agg(
        F.expr(geo.point("avg(x)", "avg(y)")).alias("centroid")
    )


def _of_year(zones: DataFrame, year: int | None) -> DataFrame:
    return zones if year is None else zones.where(F.col("year") == year)


def municipality_area_centroids(zones: DataFrame, year: int | None = None) -> DataFrame:
    """Per municipality the centre of its merged zones.

    The centres of the zones weighted with their areas: the same point, as zones do
    not overlap, without merging any geometry.
    """
    measured = _of_year(zones, year).select("municipality_id", F.expr(geo.moments("geometry")).alias("m"))
    x = "sum(m.area * m.ox + m.mx) / sum(m.area)"
    y = "sum(m.area * m.oy + m.my) / sum(m.area)"
    sized = measured.where("m.area <> 0").groupBy("municipality_id")
    return sized.agg(F.expr(geo.point(x, y)).alias("centroid"))


def municipality_mean_centroids(zones: DataFrame, year: int | None = None) -> DataFrame:
    """Per municipality the mean of its zone centres, for tables without shapes."""
    return _of_year(zones, year).groupBy("municipality_id").agg(
        F.expr(geo.point("avg(centroid.x)", "avg(centroid.y)")).alias("centroid")
    )


def municipality_centres(zones: DataFrame, year: int | None = None) -> DataFrame:
    """Per municipality its centre, from what the zone table has: shapes, or else centres.

    The code may be named ``municipality_id`` or ``zone_id``. A table without years holds
    one year only.
    """
    code = next((c for c in ("municipality_id", "zone_id") if c in zones.columns), None)
    if code is None or not {"geometry", "centroid"} & set(zones.columns):
        raise ValueError(f"zones need municipality_id or zone_id, and geometry or centroid; the table has {', '.join(zones.columns)}")
    named = zones.withColumn("municipality_id", F.col(code).cast("string"))
    of = municipality_area_centroids if "geometry" in zones.columns else municipality_mean_centroids
    return of(named, year if "year" in zones.columns else None)
