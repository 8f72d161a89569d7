"""Mobility inputs made from the driver tables, as SQL that Spark and DuckDB both run.

Each recipe is a list of select expressions over one table. {S} is the text type,
{D} the compact text of the ship date, {DIV} integer division; all else is the same
text in both dialects. See FIXTURES.md.
"""

from __future__ import annotations

SPARK = {"S": "string", "DIV": "div"}
DUCKDB = {"S": "varchar", "DIV": "//"}

# The day of a trip.
DAYS = {
    "spark": "date_format(l_shipdate, 'yyyyMMdd')",
    "duckdb": "strftime(l_shipdate, '%Y%m%d')",
}

TRIPS = [
    "{D} as date",
    "case when l_orderkey % 97 = 0 then 'xx'"
    " else lpad(cast(l_linenumber * 3 % 24 as {S}), 2, '0') end as hour_period",
    "case when l_orderkey % 53 = 0 then 'PT170' when l_orderkey % 59 = 0 then 'FR101'"
    " when l_orderkey % 61 = 0 then 'externo'"
    " when l_suppkey % 2 = 0 then concat(cast(46001 + l_suppkey % 10 as {S}), '_AM')"
    " else concat(cast(46001 + l_suppkey % 10 as {S}),"
    " case when l_suppkey % 20 < 10 then '01_AD' else '02' end) end as origin_zone",
    "case when l_orderkey % 67 = 0 then 'PT170' when l_orderkey % 71 = 0 then 'externo'"
    " when l_partkey % 2 = 0 then concat(cast(46001 + l_partkey % 10 as {S}), '_AM')"
    " else concat(cast(46001 + l_partkey % 10 as {S}), '01_AD') end as destination_zone",
    "case when l_orderkey % 101 = 0 then 'N/A' else cast(cast(l_quantity as int)"
    " * (case when l_orderkey % 211 = 0 then 50 else 1 end) as {S}) end as trips",
]

POPULATION = [
    "concat(cast(46001 + c_custkey % 10 as {S}), ' Town ', cast(c_custkey % 10 as {S})) as Municipios",
    "case c_custkey % 3 when 0 then 'Total' when 1 then 'Hombres' else 'Mujeres' end as Sexo",
    "case c_custkey % 4 when 0 then 'Todas las edades' when 1 then '0-15' when 2 then '16-64'"
    " else '65 y mas' end as age_group",
    "concat('1 de enero de 202', cast(2 + (c_custkey % 7) % 2 as {S})) as Periodo",
    "case when c_custkey % 41 = 0 then '' when c_custkey % 43 = 0 then '..'"
    " else concat(cast(1 + c_custkey % 9 as {S}), '.',"
    " lpad(cast(c_custkey * 37 % 1000 as {S}), 3, '0')) end as Total",
]

INCOME = [
    "concat(cast(46001 + p_partkey % 10 as {S}), ' Town') as Municipios",
    "case when p_partkey % 29 = 0 then null"
    " else concat(cast(46001 + p_partkey % 10 as {S}), '01 distrito 01') end as Distritos",
    "case when p_partkey % 29 = 0 then null else concat(cast(46001 + p_partkey % 10 as {S}), '01',"
    " lpad(cast(1 + p_partkey % 50 as {S}), 3, '0'), ' seccion') end as Secciones",
    "case when p_partkey % 2 = 0 then '2023' else '2022' end as Periodo",
    "case when p_partkey % 37 = 0 then '.' when p_partkey % 31 = 0 then ''"
    " else concat(cast(10 + p_partkey % 9 as {S}), '.', lpad(cast(p_partkey * 13 % 1000 as {S}), 3, '0'),"
    " ',', cast(p_partkey % 10 as {S})) end as Total",
]

# Zones: 400 squares in 20 columns, each cut into as many upright strips as the part
# table has full rounds of 400, so that there is one zone per part. `strips` is that number.
STRIPS = "max(p_partkey) {DIV} 400 + 1"
GRID = [
    "cast(p_partkey % 400 as int) as i",
    "cast(p_partkey {DIV} 400 as int) as j",
    "cast(strips as int) as strips",
]
ZONE_BOX = [
    "i",
    "j",
    "round(cast(-0.6 as double) + cast((i % 20) * strips + j as double)"
    " * cast(0.02 as double) / strips, 9) as xmin",
    "round(cast(39.25 as double) + cast(i {DIV} 20 as double) * cast(0.02 as double), 9) as ymin",
    "round(cast(-0.6 as double) + cast((i % 20) * strips + j + 1 as double)"
    " * cast(0.02 as double) / strips, 9) as xmax",
    "round(cast(39.25 as double) + cast(i {DIV} 20 + 1 as double) * cast(0.02 as double), 9) as ymax",
]
PLANE_BOX = [
    "i",
    "j",
    "cast(700000 + (i % 20) * 1700 as double) + cast(j as double) * 1500 / strips as xmin",
    "cast(4350000 + (i {DIV} 20) * 2200 as double) as ymin",
    "cast(700000 + (i % 20) * 1700 as double) + cast(j + 1 as double) * 1500 / strips as xmax",
    "cast(4350000 + (i {DIV} 20) * 2200 + 1500 as double) as ymax",
]
ZONE_CODES = [
    "concat(cast(46001 + i {DIV} 40 as {S}), case when i % 2 = 0 then '01' else '02' end,"
    " lpad(cast(i % 40 as {S}), 3, '0'), '.', cast(j as {S})) as census_section_id",
    "concat(cast(46001 + i {DIV} 40 as {S}), case when i % 2 = 0 then '01' else '02' end) as district_id",
    "cast(46001 + i {DIV} 40 as {S}) as municipality_id",
    "'46' as province_id",
    "'10' as autonomous_community_id",
]
ZONE_YEAR = 2023

# A day and a file per distinct date; days that fall on a 13th did not come.
FILE_PATHS = ["concat('/data/', date, '_Viajes_distritos.csv.gz') as path"]
DELIVERED = "substring(date, 7, 2) <> '13'"

# The study layer: two boxes that share a border and together are the default area.
LAYER = [
    "POLYGON((-0.5663 39.3073, -0.401 39.3073, -0.401 39.5765, -0.5663 39.5765, -0.5663 39.3073))",
    "POLYGON((-0.401 39.3073, -0.2295 39.3073, -0.2295 39.5765, -0.401 39.5765, -0.401 39.3073))",
]
# The same area from boxes with a T border, boxes that overlap and one that comes twice.
CUT_LAYER = [
    "POLYGON((-0.5663 39.3073, -0.401 39.3073, -0.401 39.5765, -0.5663 39.5765, -0.5663 39.3073))",
    "POLYGON((-0.401 39.3073, -0.2295 39.3073, -0.2295 39.4431, -0.401 39.4431, -0.401 39.3073))",
    "POLYGON((-0.401 39.4431, -0.2295 39.4431, -0.2295 39.5765, -0.401 39.5765, -0.401 39.4431))",
    "POLYGON((-0.5 39.35, -0.3 39.35, -0.3 39.5, -0.5 39.5, -0.5 39.35))",
    "POLYGON((-0.5 39.35, -0.3 39.35, -0.3 39.5, -0.5 39.5, -0.5 39.35))",
]
# A conic plane of Europe as a description.
CONIC = (
    'PROJCS["Conic of Europe",GEOGCS["GCS_ETRS_1989",DATUM["D_ETRS_1989",SPHEROID["GRS_1980",6378137.0,'
    '298.257222101]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]],'
    'PROJECTION["Lambert_Conformal_Conic_2SP"],PARAMETER["Standard_Parallel_1",35.0],'
    'PARAMETER["Standard_Parallel_2",65.0],PARAMETER["Latitude_Of_Origin",52.0],'
    'PARAMETER["Central_Meridian",10.0],PARAMETER["False_Easting",4000000.0],'
    'PARAMETER["False_Northing",2800000.0],UNIT["Meter",1.0]]'
)
# By how much the boxes of grown zones reach over their neighbours.
GROWN = 0.0007
# A box small enough to lie inside one strip.
SPOT = (
    "POLYGON((-0.3899 39.3551, -0.3898 39.3551, -0.3898 39.3552, -0.3899 39.3552, -0.3899 39.3551))"
)

# Days before SECOND are stored first; days from FIRST on are delivered then, so the
# days between come twice.
FIRST, SECOND = "19980301", "19980901"
# The years the trips span.
YEARS = (1995, 2001)
MANIFEST = ("1995-01-01", "2001-12-31")


def render(expressions: list[str], dialect: dict[str, str]) -> list[str]:
    return [e.format(**dialect) for e in expressions]


def duckdb_select(expressions: list[str], source: str) -> str:
    return f"select {', '.join(render(expressions, {**DUCKDB, 'D': DAYS['duckdb']}))} from {source}"
