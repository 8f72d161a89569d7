"""The fixture tables as DataFrames over one driver folder."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave import schemas
from tripweave.functions import calendar, geometry as geo
from tripweave.operators import gravity, longtrip, mobility, zones as zone_ops
from tripweave.plans import fixtures as fx
from tripweave.session import scratch_path, written
from tripweave.sources import boundaries, census, trips
from tripweave.sources.store import Store

# Shapes of so many zones are made by one task.
ZONES_A_TASK = 1 << 13


def once(build):
    """Build a table's plan once per ``Inputs``; uses of it share the plan."""
    name = build.__name__

    @wraps(build)
    def method(self) -> DataFrame:
        if name not in self._built:
            self._built[name] = build(self)
        return self._built[name]

    return method


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @once
    def trip_rows(self) -> DataFrame:
        columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"]
        return self.table("lineitem").select(*columns)

    def store(self, name: str) -> Store:
        return Store(self.spark, scratch_path(self.spark, name))

    def _of(self, source: DataFrame, expressions: list[str], dialect=fx.SPARK) -> DataFrame:
        return source.selectExpr(*fx.render(expressions, dialect))

    # trips

    def bronze(self) -> DataFrame:
        """The five bronze columns that hold data."""
        return self._of(self.trip_rows(), fx.TRIPS, {**fx.SPARK, "D": fx.DAYS["spark"]})

    @once
    def stored_bronze(self) -> DataFrame:
        """The same as a table, which the jobs read: parsing then starts from columns, not
        from the expressions that make the fixture."""
        return written(self.bronze(), "bronze")

    def raw_trips(self) -> DataFrame:
        """All fifteen columns under the names of the daily files."""
        five = self.bronze()
        columns = [
            F.col(new).alias(old) if new in five.columns else F.lit(None).cast("string").alias(old)
            for old, new in schemas.TRIP_COLUMNS.items()
        ]
        return five.select(*columns)

    def full_bronze(self) -> DataFrame:
        return trips.to_bronze(self.raw_trips())

    @once
    def holidays(self) -> DataFrame:
        return calendar.holidays_between(self.spark, *fx.YEARS)

    @once
    def silver(self) -> DataFrame:
        return mobility.silver_trips(self.stored_bronze(), self.holidays())

    @once
    def stored_silver(self) -> DataFrame:
        """Stored, as in the job: patterns read it twice."""
        return written(self.silver(), "silver")

    @once
    def patterns(self) -> DataFrame:
        return mobility.typical_patterns(self.stored_silver())

    @once
    def od_trips(self) -> DataFrame:
        return mobility.by_municipality(self.patterns())

    def file_paths(self) -> DataFrame:
        days = self.bronze().select("date").distinct().where(fx.DELIVERED)
        paths = self._of(days, fx.FILE_PATHS)
        other = self.spark.range(1).select(F.lit("/data/readme.txt").alias("path"))
        return paths.unionByName(other)

    # census

    @once
    def raw_population(self) -> DataFrame:
        rows = self._of(self.table("customer"), fx.POPULATION)
        return rows.withColumnRenamed("age_group", "Edad (grandes grupos)")

    @once
    def raw_income(self) -> DataFrame:
        return self._of(self.table("part"), fx.INCOME)

    @once
    def population(self) -> DataFrame:
        """Silver population: the rows of 2022 stored as 2023."""
        return census.population_by_municipality(census.period_rows(self.raw_population(), 2022), 2023)

    @once
    def income(self) -> DataFrame:
        return census.income_by_section(self.raw_income())

    @once
    def income_2023(self) -> DataFrame:
        return census.income_by_municipality(self.income(), 2023)

    # zones

    def _boxes(self, box: list[str]) -> DataFrame:
        part = self.table("part").select("p_partkey")
        # Two numbers, from the file statistics; as a subquery the first would be copied
        # into every expression over the corners.
        facts = part.selectExpr(fx.STRIPS.format(**fx.SPARK) + " as strips", "count(1) as rows").first()
        # A file of keys is small and so is read by few tasks; a shape is much work.
        keys = part.repartition(1 + facts.rows // ZONES_A_TASK)
        grid = self._of(keys.withColumn("strips", F.lit(facts.strips)), fx.GRID)
        return self._of(self._of(grid, box), ["*", *fx.ZONE_CODES])

    @once
    def zones(self) -> DataFrame:
        """Stored, as in the job: what is asked of boxes and shapes then reads columns, and
        is not worked out from the expressions that make the fixture."""
        box = F.expr(geo.rectangle("xmin", "ymin", "xmax", "ymax"))
        shaped = self._boxes(fx.ZONE_BOX).withColumns({"geometry": box, "year": F.lit(fx.ZONE_YEAR)})
        return written(boundaries.with_measures(shaped.drop("xmin", "ymin", "xmax", "ymax")), "zones")

    def plane_boxes(self) -> DataFrame:
        """The bronze boundary table in metres: geom and the five codes."""
        box = F.expr(geo.rectangle("xmin", "ymin", "xmax", "ymax"))
        boxes = self._boxes(fx.PLANE_BOX).withColumn("geom", box)
        codes = [F.col(new).alias(old) for old, new in schemas.BOUNDARY_CODES.items()]
        return boxes.select("geom", *codes)

    @once
    def area_zones(self) -> DataFrame:
        return zone_ops.zones_in_area(self.zones())

    # models

    @once
    def centroids(self) -> DataFrame:
        return zone_ops.municipality_centroids(self.area_zones())

    @once
    def gravity_inputs(self) -> DataFrame:
        """Stored, as in the job: calibration and prediction read them."""
        inputs = gravity.gravity_inputs(
            self.centroids(), self.population(), self.income_2023(), self.od_trips(), 2023
        )
        store = self.store("gravity")
        store.refresh(inputs, "gold_gravity_inputs")
        return store.read("gold_gravity_inputs", inputs.schema)

    @once
    def ranking(self) -> DataFrame:
        return gravity.infrastructure_ranking(gravity.predict(self.gravity_inputs()))

    @once
    def dependency(self) -> DataFrame:
        points = zone_ops.municipality_area_centroids(self.area_zones(), 2023)
        return longtrip.long_trip_dependency(self.silver(), points, 2023)
