"""The same questions in DuckDB SQL over the driver tables.

Written apart from the operators: rows repeated by joins are really repeated here,
outliers are found with window functions, polygons are compared as intervals (all
fixture polygons are boxes), Easter comes from another formula.
"""

from __future__ import annotations

import re

from tripweave.functions.geodesy import WGS84
from tripweave.plans import fixtures as fx
from tripweave.plans.queries import TABLES
from tripweave.schemas import TRIP_COLUMNS

AREA = dict(x1=-0.5663, y1=39.3073, x2=-0.2295, y2=39.5765)


def _vincenty(source: str, x1: str, y1: str, x2: str, y2: str, out: str, rounds: int = 8) -> str:
    """Select everything from source plus metres between two points."""
    a, f = WGS84
    sql = (
        f"select *, radians({x2} - {x1}) as vl, radians({x2} - {x1}) as lam0,"
        f" atan({1 - f!r} * tan(radians({y1}))) as u1, atan({1 - f!r} * tan(radians({y2}))) as u2 from {source}"
    )
    for k in range(rounds):
        sql = (
            f"select *, sqrt(pow(cos(u2) * sin(lam{k}), 2)"
            f" + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam{k}), 2)) as ss{k},"
            f" sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam{k}) as cs{k} from ({sql})"
        )
        sql = (
            f"select *, atan2(ss{k}, cs{k}) as sg{k},"
            f" coalesce(cos(u1) * cos(u2) * sin(lam{k}) / nullif(ss{k}, 0), 0) as sa{k} from ({sql})"
        )
        sql = (
            f"select *, 1 - sa{k} * sa{k} as ca{k},"
            f" cs{k} - coalesce(2 * sin(u1) * sin(u2) / nullif(1 - sa{k} * sa{k}, 0), 0) as cm{k} from ({sql})"
        )
        c = f"({f!r} / 16 * ca{k} * (4 + {f!r} * (4 - 3 * ca{k})))"
        sql = (
            f"select *, vl + (1 - {c}) * {f!r} * sa{k} * (sg{k} + {c} * ss{k} * (cm{k} + {c} * cs{k}"
            f" * (2 * cm{k} * cm{k} - 1))) as lam{k + 1} from ({sql})"
        )
    k = rounds - 1
    b = a * (1 - f)
    sql = f"select *, ca{k} * {(a * a - b * b) / (b * b)!r} as uu from ({sql})"
    sql = (
        "select *, 1 + uu / 16384 * (4096 + uu * (uu * (320 - 175 * uu) - 768)) as va,"
        f" uu / 1024 * (256 + uu * (uu * (74 - 47 * uu) - 128)) as vb from ({sql})"
    )
    delta = (
        f"vb * ss{k} * (cm{k} + vb / 4 * (cs{k} * (2 * cm{k} * cm{k} - 1)"
        f" - vb / 6 * cm{k} * (4 * ss{k} * ss{k} - 3) * (4 * cm{k} * cm{k} - 3)))"
    )
    return f"select *, {b!r} * va * (sg{k} - {delta}) as {out} from ({sql})"


def _meets(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"xmax >= {x1} and xmin <= {x2} and ymax >= {y1} and ymin <= {y2}"


def _inside(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"xmin >= {x1} and xmax <= {x2} and ymin >= {y1} and ymax <= {y2}"


# Named parts; a query takes in those it mentions, and those they mention.
PARTS: dict[str, str] = {
    "bronze": fx.duckdb_select(fx.TRIPS, "lineitem"),
    "trip_years": "select distinct year(l_shipdate) as y from lineitem",
    "easter": (
        "select y, make_date(y, 3, 22) + cast(case when d = 29 and e = 6 then 28"
        " when d = 28 and e = 6 and y % 19 > 10 then 27 else d + e end as int) as sunday"
        " from (select y, d, (2 * (y % 4) + 4 * (y % 7) + 6 * d + 5) % 7 as e"
        " from (select y, (19 * (y % 19) + 24) % 30 as d from trip_years))"
    ),
    "feasts": (
        "select cast(sunday - 2 as date) as feast from easter union"
        " select make_date(y, cast(left(md, 2) as int), cast(right(md, 2) as int)) from trip_years,"
        " (select unnest(['0101', '0106', '0501', '0815', '1012', '1101', '1206', '1208', '1225']) as md)"
    ),
    "silver": (
        "select day as date, hour_period, origin_zone, destination_zone, trips,"
        " cast(case when feast is not null then 8 else ([1, 2, 2, 2, 5, 6, 0])[isodow(day)] end as int)"
        " as day_type from (select cast(try_strptime(date, '%Y%m%d') as date) as day,"
        " try_cast(hour_period as int) as hour_period,"
        " regexp_replace(origin_zone, '_A[MD]', '', 'g') as origin_zone,"
        " regexp_replace(destination_zone, '_A[MD]', '', 'g') as destination_zone,"
        " try_cast(trips as double) as trips from bronze"
        " where not regexp_matches(origin_zone, '^(PT|FR|externo$)')"
        " and not regexp_matches(destination_zone, '^(PT|FR|externo$)'))"
        " left join feasts on feast = day"
        " where day is not null and hour_period is not null and trips is not null"
    ),
    "patterns": (
        "select day_type, hour_period, origin_zone, destination_zone, sum(trips) as total_trips,"
        " avg(trips) as avg_trips, coalesce(stddev_samp(trips), 0) as std_trips,"
        " count(distinct date) as num_days_observed from (select *, avg(trips) over g as centre,"
        " stddev_samp(trips) over g as width from silver"
        " window g as (partition by day_type, hour_period, origin_zone, destination_zone))"
        " where width is null or width = 0 or abs(trips - centre) <= 3 * width group by all"
    ),
    "od": (
        "select substring(origin_zone, 1, 5) as o, substring(destination_zone, 1, 5) as d,"
        " sum(avg_trips) as mean_trips, avg(std_trips) as std_trips from patterns group by all"
    ),
    "raw_population": fx.duckdb_select(fx.POPULATION, "customer"),
    "raw_income": fx.duckdb_select(fx.INCOME, "part"),
    "people": (
        "select string_split(Municipios, ' ')[1] as municipality_code, 2023 as year,"
        " cast(sum(n) as bigint) as population from (select *, try_cast(array_to_string("
        "regexp_extract_all(Total, '[0-9]+'), '') as bigint) as n from raw_population"
        " where Periodo like '%2022' and Sexo <> 'Total' and age_group <> 'Todas las edades')"
        " where n is not null group by all"
    ),
    "income": (
        "select string_split(Municipios, ' ')[1] as municipality_code,"
        " string_split(Distritos, ' ')[1] as district_code, string_split(Secciones, ' ')[1] as section_code,"
        " cast(right(Periodo, 4) as int) as year, avg(v) as avg_income from (select *,"
        " try_cast(array_to_string(string_split(array_to_string(string_split(trim(Total), '.'), ''), ','), '.') as double) as v from raw_income)"
        " where v is not null and Distritos is not null and Secciones is not null group by all"
    ),
    "money": (
        "select municipality_code, avg(avg_income) as avg_income from income where year = 2023"
        " group by municipality_code"
    ),
    "grid": fx.duckdb_select(
        fx.GRID, f"part, (select {fx.STRIPS.format(**fx.DUCKDB)} as strips from part)"
    ),
    "boxes": fx.duckdb_select(fx.ZONE_BOX, "grid"),
    "zones": fx.duckdb_select(["*", *fx.ZONE_CODES], "boxes").replace(
        " from boxes",
        ", 2023 as year, (xmin + xmax) / 2 as cx, (ymin + ymax) / 2 as cy from boxes",
    ),
    "kept": "select * from zones where " + _meets(**{k: repr(v) for k, v in AREA.items()}),
    "plane_boxes": fx.duckdb_select(fx.PLANE_BOX, "grid"),
    "plane_zones": fx.duckdb_select(["*", *fx.ZONE_CODES], "plane_boxes"),
    "spots": (
        "select municipality_id, avg(cx) as x, avg(cy) as y from"
        " (select distinct municipality_id, cx, cy from kept) group by 1"
    ),
    "area_spots": (
        "select municipality_id, sum(w * cx) / sum(w) as x, sum(w * cy) / sum(w) as y from"
        " (select *, (xmax - xmin) * (ymax - ymin) as w from kept) group by 1"
    ),
    "mean_spots": "select municipality_id, avg(cx) as x, avg(cy) as y from kept group by 1",
    "pairs": (
        "select a.municipality_id as o, b.municipality_id as d, a.x as ax, a.y as ay, b.x as bx, b.y as by_"
        " from spots a join od on od.o = a.municipality_id join spots b on b.municipality_id = od.d"
        " where a.municipality_id <> b.municipality_id"
    ),
    "distances": (
        "select o, d, m / 1000 as km from ("
        + _vincenty("pairs", "ax", "ay", "bx", "by_", "m")
        + ") where m > 100"
    ),
    "every_pair": (
        "select a.municipality_id as o, b.municipality_id as d, a.x as ax, a.y as ay, b.x as bx, b.y as by_"
        " from spots a, spots b where a.municipality_id <> b.municipality_id"
    ),
    "every_distance": (
        "select o, d, m / 1000 as km from ("
        + _vincenty("every_pair", "ax", "ay", "bx", "by_", "m")
        + ") where m > 100"
    ),
    "mass": (
        "select o, d, km, population, avg_income, mean_trips, std_trips from distances"
        " left join people p on p.municipality_code = o and p.year = 2023"
        " left join money m on m.municipality_code = d join od using (o, d)"
        " where coalesce(population, 0) > 0 and coalesce(avg_income, 0) > 0"
    ),
    "factor": (
        "select coalesce(nullif(sum(mean_trips * km * km) / nullif(sum(population * avg_income), 0), 0), 1)"
        " as k from mass where mean_trips is not null"
    ),
    "model": (
        "select *, case when predicted > 0 then mean_trips / predicted end as ratio from"
        " (select *, k * population * avg_income / (km * km) as predicted from mass, factor)"
    ),
    "ranking": (
        "select o, avg(ratio) as r, max(population) as population, count(*) as n,"
        " sum(mean_trips) as actual, sum(predicted) as expected,"
        " case when avg(ratio) < 0.5 then 'Well-served' when avg(ratio) > 1.5 then 'Underserved'"
        " else 'Adequately-served' end as status from model where ratio is not null group by o"
    ),
    "area_pairs": (
        "select a.municipality_id as o, b.municipality_id as d, a.x as ax, a.y as ay, b.x as bx, b.y as by_"
        " from area_spots a, area_spots b"
    ),
    "area_meters": "select o, d, m from (" + _vincenty("area_pairs", "ax", "ay", "bx", "by_", "m") + ")",
    "legs": (
        "select t.origin_zone as o, trips, m from silver t"
        " join area_spots a on a.municipality_id = t.origin_zone"
        " left join area_meters on o = t.origin_zone and d = t.destination_zone"
    ),
    "dependency": (
        "select 2023 as year, o as municipality_id, sum(trips) as total_trips,"
        " sum(case when m > 15000 then trips else 0 end) as long_trips,"
        " sum(case when m is not null then trips else 0 end) as trips_with_distance,"
        " avg(m / 1000) as avg_trip_km from legs group by o"
    ),
    "profile": (
        "select day_type, hour_period, sum(total_trips) as total_trips, avg(total_trips) as avg_trips,"
        " stddev_samp(total_trips) as std_trips, avg(num_days_observed) as num_days_observed"
        " from patterns join kept on census_section_id = origin_zone or district_id = origin_zone"
        " group by all"
    ),
    "sides": (
        "select municipality_id, unnest([{'x1': xmin, 'y1': ymin, 'x2': xmax, 'y2': ymin},"
        " {'x1': xmin, 'y1': ymax, 'x2': xmax, 'y2': ymax}, {'x1': xmin, 'y1': ymin, 'x2': xmin, 'y2': ymax},"
        " {'x1': xmax, 'y1': ymin, 'x2': xmax, 'y2': ymax}]) as s from kept"
    ),
    "outline": (
        "select municipality_id, s.x1 as x1, s.y1 as y1, s.x2 as x2, s.y2 as y2 from sides"
        " group by municipality_id, s having count(*) = 1"
    ),
    "shapes": (
        "select municipality_id, outline_area, outline_corners from (select municipality_id,"
        " round(sum((xmax - xmin) * (ymax - ymin)), 9) as outline_area from kept group by 1)"
        " join (select municipality_id, cast(count(*) as int) as outline_corners from outline group by 1)"
        " using (municipality_id)"
    ),
    "paths": (
        "select concat('/data/', date, '_Viajes_distritos.csv.gz') as path from"
        " (select distinct date from bronze) where substring(date, 7, 2) <> '13'"
        " union all select '/data/readme.txt'"
    ),
}

ORACLES: dict[str, str] = {}


def _needed(sql: str, found: set[str]) -> set[str]:
    for name, body in PARTS.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            found.add(name)
            _needed(body, found)
    return found


def oracle(name: str, sql: str, skip: tuple[str, ...] = ()) -> None:
    """Register a query, with the parts it mentions put in front."""
    used = _needed(sql, set(skip)) - set(skip)
    parts = ", ".join(f"{part} as materialized ({PARTS[part]})" for part in PARTS if part in used)
    ORACLES[name] = f"with {parts} {sql}" if parts else sql


def _r(*columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) as {c}" for c in columns)


# Sources and sinks

oracle(
    "bronze_trips",
    "select "
    + ", ".join(
        new if new in ("date", "hour_period", "origin_zone", "destination_zone", "trips")
        else f"cast(null as varchar) as {new}"
        for new in TRIP_COLUMNS.values()
    )
    + " from bronze",
)
oracle(
    "bronze_incremental_append",
    "select date, count(*) as row_count, count(distinct (origin_zone, trips)) as kinds from bronze group by date",
)
oracle(  # an empty field of a file is no value
    "bronze_economy_year",
    "select * replace (nullif(Total, '') as Total) from raw_income where Periodo = '2023'",
)
oracle(
    "bronze_population_remap",
    "select *, case right(Periodo, 4) when '2022' then 2023 else 2022 end as year from raw_population",
)
oracle("silver_append_new_years", f"select * exclude (avg_income), {_r('avg_income')} from income")
oracle("silver_trips", "select * from silver")
oracle("stream_daily_trips", "select * from silver")
oracle(
    "silver_replace_day",
    f"select * from silver where strftime(date, '%Y%m%d') < '{fx.FIRST}' or isodow(date) <> 7",
)
oracle(
    "trip_file_scan",
    "select date as fecha, count(*) as narrow_rows, count(*) as row_count,"
    " count(distinct (origin_zone, trips)) as kinds from bronze where trips <> '7' group by date",
)
oracle(
    "profile_csv_roundtrip",
    "select day_type, hour_period, round(sum(total_trips), 6) as total_trips,"
    " round(avg(total_trips), 6) as avg_trips, round(stddev_samp(total_trips), 6) as std_trips,"
    " round(avg(num_days_observed), 6) as num_days_observed from patterns"
    " where origin_zone in ('46001', '46003', '46005') group by all",
)
oracle(
    "daily_file_manifest",
    "select day as date, file as path, path is not null as delivered from (select cast(d as date) as day,"
    " '/data/' || strftime(d, '%Y%m%d') || '_Viajes_distritos.csv.gz' as file from"
    f" generate_series(date '{fx.MANIFEST[0]}', date '{fx.MANIFEST[1]}', interval 1 day) t(d))"
    " left join paths on path = file",
)
oracle(
    "date_from_path",
    "select path, cast(try_strptime(regexp_extract(path, '([0-9]{8})_V', 1), '%Y%m%d') as date) as date"
    " from paths",
)
oracle("holiday_calendar", "select feast as date, true as is_holiday from feasts")
oracle(
    "column_profile",
    " union all ".join(
        f"select '{t}' as table_name, column_name, column_type as data_type, n as row_count,"
        f" n - filled as null_count from (from (unpivot (select count(columns('(.*)')) as '\\1' from {t})"
        f" on columns(*) into name column_name value filled)) join (select column_name, column_type"
        f" from (describe {t})) using (column_name), (select count(*) as n from {t})"
        for t in TABLES
    ),
)

# Projections and parsing

oracle(
    "day_type_calendar",
    "select day as date, code as day_type, case code when 8 then 'Holiday' when 0 then 'Sunday'"
    " when 1 then 'Monday' when 2 then 'Tue-Thu (Standard)' when 5 then 'Friday' else 'Saturday' end"
    " as day_name from (select day, cast(case when feast is not null then 8"
    " else ([1, 2, 2, 2, 5, 6, 0])[isodow(day)] end as int) as code from"
    " (select distinct cast(strptime(date, '%Y%m%d') as date) as day from bronze)"
    " left join feasts on feast = day)",
)
oracle(
    "parse_decimal_comma",
    "select Municipios, Secciones, Total, round(try_cast(array_to_string(string_split(array_to_string(string_split(trim(Total), '.'), ''), ','), '.') as double), 6)"
    " as value from raw_income",
)
oracle(
    "parse_thousands_int",
    "select Municipios, Sexo, Total, try_cast(array_to_string(regexp_extract_all(Total, '[0-9]+'), '')"
    " as bigint) as value from raw_population",
)
oracle(
    "trips_any_schema",
    "select table_name, origin_zone, count(*) as row_count, sum(trips) as total_trips from silver,"
    " (select unnest(['zones', 'zone_ids']) as table_name) group by all",
    skip=("zones",),
)

# Mobility

oracle(
    "typical_patterns_raw",
    "select day_type, hour_period, origin_zone, destination_zone, round(sum(trips), 6) as total_trips,"
    " round(avg(trips), 6) as avg_trips, round(coalesce(stddev_samp(trips), 0), 6) as std_trips,"
    " count(distinct date) as num_days_observed from silver group by all",
)
for key in ("typical_patterns", "typical_patterns_by_day", "typical_patterns_by_day_type"):
    oracle(
        key,
        "select day_type, hour_period, origin_zone, destination_zone,"
        f" {_r('total_trips', 'avg_trips', 'std_trips')}, num_days_observed from patterns",
    )
oracle(
    "origin_profile",
    "select day_type, hour_period, round(sum(total_trips), 6) as total_trips,"
    " round(avg(total_trips), 6) as avg_trips, round(stddev_samp(total_trips), 6) as std_trips,"
    " round(avg(num_days_observed), 6) as num_days_observed from patterns"
    " where origin_zone in ('46001', '4600201', '46003') group by all",
)
oracle(
    "district_profile",
    "select day_type, hour_period,"
    f" {_r('total_trips', 'avg_trips', 'std_trips', 'num_days_observed')} from profile",
)
oracle(
    "day_type_summary",
    "select day_type, case day_type when 8 then 'Holiday' when 0 then 'Sunday' when 1 then 'Monday'"
    " when 2 then 'Tue-Thu (Standard)' when 5 then 'Friday' else 'Saturday' end as day_name,"
    " round(sum(total_trips), 6) as total_volume,"
    " first(hour_period order by total_trips desc, hour_period) as peak_hour,"
    " round(max(total_trips), 6) as peak_trips, round(avg(std_trips), 6) as avg_volatility,"
    " cast(floor(avg(num_days_observed)) as int) as avg_days_observed from profile group by day_type",
)
oracle(
    "od_by_municipality",
    f"select o as origin_municipality, d as dest_municipality, {_r('mean_trips', 'std_trips')} from od",
)

# Census

oracle("silver_income", f"select * exclude (avg_income), {_r('avg_income')} from income")
oracle("income_by_municipality", f"select municipality_code, {_r('avg_income')} from money")
oracle("silver_population", "select * from people")

# Zones

_ZONE = "select census_section_id, municipality_id, year from"
_X = {k: repr(v) for k, v in AREA.items()}
oracle("zones_in_polygon", f"{_ZONE} kept")
oracle("zones_intersecting_layer", f"{_ZONE} kept")
for key in ("zones_within_polygon", "zones_within_layer", "zones_within_cut_layer", "zones_within_slanted_layer"):
    oracle(key, f"{_ZONE} zones where {_inside(**_X)}")
for key in ("zones_overlap_layer", "zones_overlap_cut_layer", "zones_overlap_slanted_layer"):
    oracle(
        key,
        f"{_ZONE} zones where xmax > {_X['x1']} and xmin < {_X['x2']} and ymax > {_X['y1']}"
        f" and ymin < {_X['y2']} and not ({_inside(**_X)})",
    )
oracle(
    "zones_containing_polygon",
    f"{_ZONE} zones where xmin <= -0.3899 and xmax >= -0.3898 and ymin <= 39.3551 and ymax >= 39.3552",
)
oracle("district_list", "select distinct district_id from kept")
oracle("sections_per_municipality", "select municipality_id, count(*) as sections from kept group by 1")
oracle("sections_per_district", "select district_id, count(*) as num_sections from kept group by 1")
oracle(
    "extraction_share",
    "select n as silver_count, m as gold_count, round(100 * m / n, 6) as kept_percent from"
    " (select count(*) as n from zones), (select count(*) as m from kept)",
)
oracle(
    "municipality_extent",
    "select round(min(xmin), 9) as min_x, round(max(xmax), 9) as max_x, round(min(ymin), 9) as min_y,"
    " round(max(ymax), 9) as max_y from zones where municipality_id = '46003'",
)
oracle("zone_centroids", "select census_section_id, round(cx, 9) as x, round(cy, 9) as y from zones")
oracle(
    "municipality_centroids",
    f"select municipality_id as municipality_code, {_r('x', 'y', digits=9)} from spots",
)
oracle("municipality_area_centroids", f"select municipality_id, {_r('x', 'y', digits=9)} from area_spots")
oracle(
    "municipality_mean_centroids",
    "select municipality_id, round(avg(cx), 9) as x, round(avg(cy), 9) as y from kept group by 1",
)
oracle(
    "wkt_roundtrip",
    "select census_section_id, true as same_shape, true as same_point,"
    " round((xmax - xmin) * (ymax - ymin) * 0.46875e6, 6) as area, 8 as corners from zones",
)
oracle("dissolved_outline", "select * from outline")
# Walks along the outline from every corner, given up at a corner smaller than the first.
# A corner where two rings meet would need an angle; the fixture has none.
oracle(
    "dissolved_rings",
    "select municipality_id, x, y, corners, round(abs(turn) / 2, 9) as area from (with recursive ways as ("
    "select municipality_id, x1 as ax, y1 as ay, x2 as qx, y2 as qy from outline"
    " union all select municipality_id, x2, y2, x1, y1 from outline), walk as ("
    "select municipality_id, ax as x, ay as y, ax, ay, qx, qy, cast(1 as bigint) as corners,"
    " (ax + 0.4) * (qy - 39.4) - (qx + 0.4) * (ay - 39.4) as turn from ways where (ax, ay) < (qx, qy)"
    " union all select k.municipality_id, k.x, k.y, w.ax, w.ay, w.qx, w.qy, k.corners + 1,"
    " k.turn + (w.ax + 0.4) * (w.qy - 39.4) - (w.qx + 0.4) * (w.ay - 39.4) from walk k join ways w"
    " on w.municipality_id = k.municipality_id and w.ax = k.qx and w.ay = k.qy and (w.qx <> k.ax or w.qy <> k.ay)"
    " where (k.qx, k.qy) <> (k.x, k.y) and (w.qx, w.qy) >= (k.x, k.y))"
    " select * from walk where qx = x and qy = y and turn > 0)",
)
oracle(
    "union_of_overlaps",
    "select * from (with grown as (select municipality_id, xmin as a, round(xmax + {g}, 9) as b, ymin as c,"
    " round(ymax + {g}, 9) as d from kept), cuts as (select municipality_id, x, lead(x) over"
    " (partition by municipality_id order by x) as u from (select municipality_id, a as x from grown"
    " union select municipality_id, b from grown)), strips as (select g.municipality_id, x, u, c, d,"
    " max(d) over (partition by g.municipality_id, x order by c, d rows between unbounded preceding and 1 preceding)"
    " as reached from grown g join cuts k on k.municipality_id = g.municipality_id and a <= x and b >= u)"
    " select municipality_id, round(sum((u - x) * greatest(d - greatest(c, coalesce(reached, c)), 0)), 9) as area"
    " from strips group by 1)".replace("{g}", repr(fx.GROWN)),
)


def _to_degrees(source: str) -> str:
    """Longitude and latitude from e, n: the latitude by rounds on the isometric latitude."""
    # Zone 30 north, written out: scaled radius, eccentricity, coefficients.
    radius, ecc = 6364902.16611274, 0.0818191910428158
    beta = [8.37732168164e-4, 5.905869626e-8, 1.6734889e-10, 2.167738e-13]
    xi, eta = f"n / {radius!r}", f"(e - 500000) / {radius!r}"
    sql = f"select *, {xi} as xi, {eta} as eta from {source}"
    bent_xi = "".join(
        f" - {b!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, b in enumerate(beta, 1)
    )
    bent_eta = "".join(
        f" - {b!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, b in enumerate(beta, 1)
    )
    sql = f"select *, xi{bent_xi} as bx, eta{bent_eta} as be from ({sql})"
    sql = f"select *, atan2(sinh(be), cos(bx)) as lam, asinh(sin(bx) / sqrt(pow(sinh(be), 2) + pow(cos(bx), 2))) as psi from ({sql})"
    sql = f"select *, atan(sinh(psi)) as p0 from ({sql})"
    for k in range(7):
        sql = f"select *, atan(sinh(psi + {ecc!r} * atanh({ecc!r} * sin(p{k})))) as p{k + 1} from ({sql})"
    return f"select *, degrees(lam) - 3 as lon, degrees(p7) as lat from ({sql})"


def _from_cone(source: str) -> str:
    """Longitude and latitude from e, n on the fixture's conic plane, from its literal
    parallels, origin and ellipsoid: the latitude by rounds."""
    ecc, axis = "sqrt(2 / 298.257222101 - pow(1 / 298.257222101, 2))", "6378137"
    small = lambda d: f"tan(pi() / 4 - radians({d}) / 2) * pow((1 + k * sin(radians({d}))) / (1 - k * sin(radians({d}))), k / 2)"
    wide = lambda d: f"cos(radians({d})) / sqrt(1 - pow(k * sin(radians({d})), 2))"
    sql = f"select *, {ecc} as k from {source}"
    sql = f"select *, ln(({wide(35)}) / ({wide(65)})) / ln(({small(35)}) / ({small(65)})) as cone from ({sql})"
    sql = f"select *, {axis} * ({wide(35)}) / (cone * pow({small(35)}, cone)) as reach from ({sql})"
    sql = f"select *, reach * pow({small(52)}, cone) - (n - 2800000) as dy, e - 4000000 as dx from ({sql})"
    sql = f"select *, pow(sqrt(dx * dx + dy * dy) / reach, 1 / cone) as t, atan2(dx, dy) / cone as lam from ({sql})"
    sql = f"select *, pi() / 2 - 2 * atan(t) as p0 from ({sql})"
    for j in range(8):
        sql = f"select *, pi() / 2 - 2 * atan(t * pow((1 - k * sin(p{j})) / (1 + k * sin(p{j})), k / 2)) as p{j + 1} from ({sql})"
    return f"select *, 10 + degrees(lam) as lon, degrees(p8) as lat from ({sql})"


_CORNERS = (
    "(select census_section_id, c.k as corner, c.e as e, c.n as n from (select census_section_id, unnest(["
    "{'k': 0, 'e': xmin, 'n': ymin}, {'k': 1, 'e': xmax, 'n': ymin}, {'k': 2, 'e': xmax, 'n': ymax},"
    " {'k': 3, 'e': xmin, 'n': ymax}, {'k': 4, 'e': xmin, 'n': ymin}]) as c from plane_zones))"
)
oracle(
    "reproject_zones",
    "select census_section_id, corner, round(lon, 7) as x, round(lat, 7) as y from"
    f" ({_to_degrees(_CORNERS)})",
)
oracle(
    "reproject_layer",
    "select census_section_id, corner, round(lon, 7) as x, round(lat, 7) as y from"
    f" ({_from_cone(_CORNERS)})",
)
oracle(
    "boundary_ingest",
    "select census_section_id, district_id, municipality_id, province_id, autonomous_community_id,"
    " 2023 as year, round(min(lon), 7) as xmin, round(min(lat), 7) as ymin, round(max(lon), 7) as xmax,"
    f" round(max(lat), 7) as ymax from ({_to_degrees(_CORNERS)}) join plane_zones using (census_section_id)"
    " group by all",
)

# Gravity model

oracle(
    "municipality_distances",
    "select o as origin_municipality, d as dest_municipality, round(km, 6) as distance_km from every_distance",
)
_INPUTS = (
    "o as origin_municipality, d as dest_municipality, round(km, 6) as distance_km,"
    " population as origin_population, round(avg_income, 6) as dest_economic_activity,"
    " round(mean_trips, 6) as actual_mean_trips, round(std_trips, 6) as std_trips"
)
oracle("gravity_inputs", f"select {_INPUTS} from mass")
oracle(
    "gravity_model",
    f"select {_INPUTS}, round(predicted, 3) as predicted_trips, round(ratio, 6) as mismatch_ratio,"
    " round(k, 12) as calibration_constant from model",
)
_RANK = (
    "round(r, 6) as avg_mismatch_ratio, population, n as num_connections,"
    " round(actual, 6) as total_actual_trips, round(expected, 3) as total_predicted_trips,"
    " status as infrastructure_status"
)
oracle("infrastructure_ranking", f"select o as origin_municipality, {_RANK} from ranking")
oracle(
    "infrastructure_summary",
    "select status as infrastructure_status, count(*) as municipalities,"
    " cast(sum(population) as bigint) as total_population from ranking group by 1",
)
oracle(
    "infrastructure_map_frame",
    f"select o as municipality_id, {_RANK}, case status when 'Well-served' then 1"
    " when 'Adequately-served' then 2 else 3 end as status_code, outline_area, outline_corners"
    " from ranking join shapes on municipality_id = o",
)
_LONG = f"{_r('total_trips', 'long_trips', 'trips_with_distance')}, round(long_trips / nullif(total_trips, 0), 6) as long_trip_ratio"
oracle(
    "long_trip_dependency",
    f"select year, municipality_id, {_LONG}, round(avg_trip_km, 6) as avg_trip_km from dependency",
)
# The same over plain means of centres: the parts under other names.
for _name in ("area_pairs", "area_meters", "legs", "dependency"):
    if _name in PARTS:
        _body = re.sub(r"\barea_spots\b", "mean_spots", PARTS[_name])
        PARTS[f"plain_{_name}"] = re.sub(r"\b(area_pairs|area_meters|legs)\b", r"plain_\1", _body)
oracle(
    "long_trip_plain_zones",
    f"select year, municipality_id, {_LONG}, round(avg_trip_km, 6) as avg_trip_km from plain_dependency",
)
oracle(
    "dependency_map_frame",
    f"select year, municipality_id, {_LONG}, round(coalesce(avg_trip_km, 0), 6) as avg_trip_km,"
    " case when nullif(total_trips, 0) is null then 0 when long_trips / total_trips < 0.2 then 1"
    " when long_trips / total_trips < 0.4 then 2 else 3 end as dependency_code, outline_area,"
    " outline_corners from dependency join shapes using (municipality_id)",
)

# Data quality

oracle(
    "dq_rows_by_year",
    "select 'income' as table_name, year, count(*) as row_count from income group by year"
    " union all select 'population', year, count(*) from people group by year"
    " union all select 'zones', year, count(*) from zones group by year",
)
oracle(
    "dq_null_keys",
    "select 'income' as table_name, count(*) - count(municipality_code || district_code || section_code"
    " || year || avg_income) as null_rows, count(*) as row_count from income"
    " union all select 'population', count(*) - count(municipality_code || year || population), count(*)"
    " from people union all select 'raw_income', count(*) - count(Distritos || Secciones), count(*)"
    " from raw_income",
)
oracle(
    "dq_negatives",
    "select 'income' as table_name, count(*) filter (avg_income < 0) as negative_rows,"
    " count(*) as row_count from income union all select 'population',"
    " count(*) filter (population < 0), count(*) from people union all select 'customer',"
    " count(*) filter (c_acctbal < 0), count(*) from customer",
)
oracle(
    "dq_duplicate_keys",
    "select 'income' as table_name, count(*) as duplicate_keys from (select 1 from income group by"
    " municipality_code, district_code, section_code, year having count(*) > 1) union all"
    " select 'population', count(*) from (select 1 from people group by municipality_code, year"
    " having count(*) > 1) union all select 'raw_income', count(*) from (select 1 from raw_income"
    " group by Secciones, Periodo having count(*) > 1)",
)
oracle(  # of the seven kinds of shapes the whole ones and those with a hole are valid
    "dq_valid_geometry",
    "select count(*) filter (cast(census_section_id[8:10] as int) % 7 in (0, 5)) as valid_rows,"
    " count(*) as row_count from zones",
)
oracle(
    "dq_sample",
    f"select * exclude (avg_income), {_r('avg_income')} from income"
    " order by municipality_code, district_code, section_code, year limit 5",
)
