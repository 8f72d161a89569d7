"""WKT and GeoJSON text to geometry columns and back; functions give Spark SQL text."""

from __future__ import annotations

from collections.abc import Callable

from tripweave.functions.geometry import oriented, point
from tripweave.functions.lambdas import each, let

_NUMBER = r"([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)"


def _each_point(geometry: str, make: Callable[[str], str]) -> str:
    return each(geometry, lambda polygon: each(polygon, lambda ring: each(ring, make)))


def from_wkt(text: str) -> str:
    """POLYGON or MULTIPOLYGON text to a geometry; NULL for anything else.

    Points and brackets become those of a JSON list, which Spark then parses. Heights and
    measures are left out. A coordinate that is no number makes the whole text NULL.
    """

    def parse(t: str) -> str:
        body = rf"regexp_replace({t}, r'^(MULTI)?POLYGON\s*(Z|M|ZM)?\s*', '')"
        quoted = rf"""regexp_replace({body}, r'{_NUMBER}\s+{_NUMBER}(?:\s+{_NUMBER}){{0,2}}', '["$1","$2"]')"""
        lists = f"translate({quoted}, '()', '[]')"
        nested = f"if(startswith({t}, 'MULTI'), {lists}, concat('[', {lists}, ']'))"
        parsed = f"from_json({nested}, 'array<array<array<array<string>>>>')"
        shape = _each_point(parsed, lambda p: point(f"try_cast({p}[0] as double)", f"try_cast({p}[1] as double)"))
        whole = let(shape, lambda s: f"if(exists(flatten(flatten({s})), p -> p.x is null or p.y is null), null, {oriented(s)})")
        return rf"if(rlike({t}, r'^(MULTI)?POLYGON\s*(Z|M|ZM)?\s*\(\('), {whole}, null)"

    return let(f"upper(trim({text}))", parse)


def point_from_wkt(text: str) -> str:
    found = rf"r'^\s*POINT\s*\(\s*{_NUMBER}\s+{_NUMBER}\s*\)\s*$'"
    x, y = (f"try_cast(regexp_extract(upper({text}), {found}, {i}) as double)" for i in (1, 2))
    return f"if(rlike(upper({text}), {found}), {point(x, y)}, null)"


def _joined(items: str) -> str:
    return f"concat('(', array_join({items}, ', '), ')')"


def to_wkt(geometry: str) -> str:
    """POLYGON text for one polygon, else MULTIPOLYGON text."""

    def text(polygon: str) -> str:
        return _joined(each(polygon, lambda ring: _joined(each(ring, lambda p: f"concat_ws(' ', {p}.x, {p}.y)"))))

    return let(
        each(geometry, text),
        lambda t: f"if(size({t}) = 1, concat('POLYGON ', {t}[0]), concat('MULTIPOLYGON ', {_joined(t)}))",
    )


def point_to_wkt(p: str) -> str:
    return f"concat('POINT (', {p}.x, ' ', {p}.y, ')')"


def to_geojson(geometry: str) -> str:
    lists = _each_point(geometry, lambda p: f"array({p}.x, {p}.y)")
    return f"to_json(named_struct('type', 'MultiPolygon', 'coordinates', {lists}))"


def from_geojson(kind: str, coordinates: str) -> str:
    """The ``type`` and raw ``coordinates`` text of a GeoJSON geometry to a geometry."""
    lists = (
        f"case {kind} when 'MultiPolygon' then"
        f" from_json({coordinates}, 'array<array<array<array<double>>>>')"
        f" when 'Polygon' then array(from_json({coordinates}, 'array<array<array<double>>>')) end"
    )
    return let(_each_point(lists, lambda p: point(f"{p}[0]", f"{p}[1]")), oriented)


def geojson_text(text: str) -> str:
    """A whole GeoJSON geometry text to a geometry."""
    return let(
        f"from_json({text}, 'type string, coordinates string')",
        lambda g: from_geojson(f"{g}.type", f"{g}.coordinates"),
    )
