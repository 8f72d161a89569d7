"""The driver contract, and some queries against their SQL twins on the smallest data.
``check.py`` compares all of them."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import canonical, duckdb_on
from tripweave.plans import inputs
from tripweave.plans.oracles import ORACLES
from tripweave.plans.queries import QUERIES
from tripweave.sources.store import Store

FOLDER = "/root/testdata/sf0.001"
CHOSEN = [
    "bronze_trips",
    "silver_population",
    "silver_income",
    "typical_patterns",
    "district_profile",
    "zones_overlap_layer",
    "municipality_distances",
    "infrastructure_map_frame",
    "long_trip_dependency",
]

needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no driver tables")


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert len(entry.queries()) >= 58


@needs_data
def test_entry(spark):
    assert entry.entry(spark).columns[:4] == ["day_type", "hour_period", "origin_zone", "destination_zone"]


@needs_data
@pytest.mark.parametrize("name", CHOSEN)
def test_against_sql(spark, name):
    ours = entry.queries()[name](spark, FOLDER).toPandas()
    theirs = duckdb_on(FOLDER).execute(entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


def lone_file(table, path):
    table.coalesce(1).write.parquet(str(path))


def test_shapes_are_made_by_many_tasks(spark, tmp_path):
    """A file of keys, as small as it is, is spread out before shapes are made; they are made once."""
    keys = spark.range(3 * inputs.ZONES_A_TASK).union(spark.range(5)).withColumnRenamed("id", "p_partkey")
    lone_file(keys, tmp_path / "part.parquet")
    zones = inputs.Inputs(spark, str(tmp_path)).zones()
    assert len(zones.inputFiles()) >= 4
    assert not [f for f in zones.inputFiles() if "part.parquet" in f]
    assert zones.count() == 3 * inputs.ZONES_A_TASK + 5


def test_holidays_are_worked_out_once_a_year(spark, tmp_path, monkeypatch):
    """Easter is worked out from the years seen, not again from every row."""
    days = spark.range(400).selectExpr("timestamp'1997-06-01' + make_dt_interval(cast(id * 4 as int)) as l_shipdate")
    lone_file(days.union(days), tmp_path / "lineitem.parquet")
    given = []
    append = Store.append_new
    monkeypatch.setattr(Store, "append_new", lambda self, rows, *more: (given.append(rows), append(self, rows, *more)))
    found = QUERIES["holiday_calendar"](spark, str(tmp_path))
    assert found.count() == 10 * 5
    assert given and not [f for rows in given for f in rows.inputFiles() if "lineitem.parquet" in f]


def test_distances_do_not_hang_on_trips(spark, tmp_path):
    """Trips between two municipalities only; the eight of the area make 8 x 7 pairs all the same."""
    lone_file(spark.range(400).withColumnRenamed("id", "p_partkey"), tmp_path / "part.parquet")
    trip = "1L as l_orderkey, 4L as l_partkey, 2L as l_suppkey, 1 as l_linenumber, 5D as l_quantity, timestamp'1997-06-04' as l_shipdate"
    lone_file(spark.range(3).selectExpr(*trip.split(", ")), tmp_path / "lineitem.parquet")
    ours = QUERIES["municipality_distances"](spark, str(tmp_path)).toPandas()
    codes = [str(c) for c in range(46002, 46010)]
    pairs = sorted(zip(ours.origin_municipality, ours.dest_municipality, strict=True))
    assert pairs == [(a, b) for a in codes for b in codes if a != b]
    connection = duckdb.connect()
    for table in ("part", "lineitem"):
        connection.execute(f"create view {table} as select * from read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    assert canonical(ours) == canonical(connection.execute(ORACLES["municipality_distances"]).df())
