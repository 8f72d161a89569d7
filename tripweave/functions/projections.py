"""Projections: a conic plane, and planes read from the description that comes with a layer."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, replace

from tripweave.functions.geodesy import GRS80, TransverseMercator
from tripweave.functions.geometry import point
from tripweave.functions.lambdas import each, let, num, row


@dataclass(frozen=True)
class LambertConic:
    """A Lambert conformal conic plane with two standard parallels, or one and a scale."""

    parallels: tuple[float, float]
    origin: tuple[float, float]  # longitude and latitude of the plane's origin, degrees
    false_easting: float = 0.0
    false_northing: float = 0.0
    scale: float = 1.0
    ellipsoid: tuple[float, float] = GRS80

    def _small(self, latitude: float) -> float:
        """exp(-q) with the isometric latitude q."""
        s = math.sin(math.radians(latitude))
        e = math.sqrt(self.ellipsoid[1] * (2 - self.ellipsoid[1]))
        return math.exp(-(math.atanh(s) - e * math.atanh(e * s)))

    def _wide(self, latitude: float) -> float:
        s, f = math.sin(math.radians(latitude)), self.ellipsoid[1]
        return math.cos(math.radians(latitude)) / math.sqrt(1 - f * (2 - f) * s * s)

    @property
    def cone(self) -> float:
        one, two = self.parallels
        if one == two:
            return math.sin(math.radians(one))
        return math.log(self._wide(one) / self._wide(two)) / math.log(self._small(one) / self._small(two))

    @property
    def reach(self) -> float:
        """The radius on the plane at which exp(-q) is 1."""
        one = self.parallels[0]
        return self.ellipsoid[0] * self.scale * self._wide(one) / (self.cone * self._small(one) ** self.cone)

    @property
    def apex(self) -> float:
        return self.reach * self._small(self.origin[1]) ** self.cone

    def to_lonlat(self, easting: str, northing: str) -> str:
        """Plane metres to struct<x: longitude, y: latitude> in degrees."""
        sign = num(math.copysign(1.0, self.cone))
        series = TransverseMercator(ellipsoid=self.ellipsoid).delta

        def turned(v: str) -> str:
            small = f"pow(sqrt({v}.dx * {v}.dx + {v}.dy * {v}.dy) / {num(abs(self.reach))}, {num(1 / self.cone)})"
            return row(chi=f"pi() / 2 - 2 * atan({small})", lam=f"atan2({v}.dx, {v}.dy) / {num(self.cone)}")

        def degrees(v: str) -> str:
            phi = f"{v}.chi" + "".join(f" + {num(d)} * sin({2 * j} * {v}.chi)" for j, d in enumerate(series, 1))
            return point(f"{num(self.origin[0])} + degrees({v}.lam)", f"degrees({phi})")

        plane = row(
            dx=f"{sign} * ({easting} - {num(self.false_easting)})",
            dy=f"{sign} * ({num(self.apex + self.false_northing)} - {northing})",
        )
        return let(plane, lambda v: let(turned(v), degrees))

    def from_lonlat(self, lon: str, lat: str) -> str:
        """Degrees to struct<x: easting, y: northing> in metres."""
        ecc = num(math.sqrt(self.ellipsoid[1] * (2 - self.ellipsoid[1])))

        def plane(v: str) -> str:
            radius = f"({num(self.reach)} * exp({num(-self.cone)} * (atanh({v}.s) - {ecc} * atanh({ecc} * {v}.s))))"
            return point(
                f"{num(self.false_easting)} + {radius} * sin({v}.turn)",
                f"{num(self.apex + self.false_northing)} - {radius} * cos({v}.turn)",
            )

        start = row(s=f"sin(radians({lat}))", turn=f"{num(self.cone)} * radians({lon} - {num(self.origin[0])})")
        return let(start, plane)


@dataclass(frozen=True)
class Layer:
    """How a layer's coordinates become degrees: a plane and its unit in metres, or degrees
    times a factor."""

    plane: TransverseMercator | LambertConic | None
    unit: float = 1.0
    meridian: float = 0.0  # of the degrees' zero, east of Greenwich

    def to_lonlat(self, x: str, y: str) -> str:
        x, y = (f"{v} * {num(self.unit)}" if self.unit != 1 else v for v in (x, y))
        if self.plane is None:
            return point(f"{x} + {num(self.meridian)}", y)
        return self.plane.to_lonlat(x, y)

    def reproject(self, geometry: str) -> str:
        """A geometry of the layer to one in degrees."""
        return each(geometry, lambda polygon: each(polygon, lambda ring: each(ring, lambda p: self.to_lonlat(f"{p}.x", f"{p}.y"))))


_NUMBER = r"\s*,\s*([-+0-9.eE]+)"


def _first(pattern: str, text: str, what: str) -> tuple[str, ...]:
    found = re.search(pattern, text, re.I)
    if not found:
        raise ValueError(f"the description names no {what}: {text[:80]}")
    return found.groups()


def from_description(text: str) -> Layer:
    """A layer's projection from the text that comes with it (well-known text, first form).

    Known families: transverse Mercator and Lambert conformal conic with one or two standard
    parallels; other ones raise. Without a projection the coordinates are degrees. Lengths
    may be in any unit and angles too; a shift between datums is taken as zero.
    """
    axis, inverse = (float(v) for v in _first(rf'SPHEROID\s*\[\s*"[^"]*"{_NUMBER}{_NUMBER}', text, "ellipsoid"))
    ellipsoid = (axis, 1 / inverse if inverse else 0.0)
    units = [float(v) for v in re.findall(rf'\bUNIT\s*\[\s*"[^"]*"{_NUMBER}', text, re.I)]
    if not units:
        raise ValueError(f"the description names no unit: {text[:80]}")
    angle = math.degrees(units[0])
    angle = 1.0 if abs(angle - 1) < 1e-9 else angle  # degrees, written with some digits
    prime = re.search(rf'PRIMEM\s*\[\s*"[^"]*"{_NUMBER}', text, re.I)
    zero = float(prime[1]) * angle if prime else 0.0
    if not re.match(r"\s*PROJCS", text, re.I):
        return Layer(None, angle, zero)
    (family,) = _first(r'PROJECTION\s*\[\s*"([^"]*)"', text, "projection")
    given = {k.lower(): float(v) for k, v in re.findall(rf'PARAMETER\s*\[\s*"([^"]*)"{_NUMBER}', text, re.I)}
    unit = units[-1]
    turn = lambda name, other=0.0: given.get(name, other) * angle if name in given else other
    east, north = (given.get(f"false_{c}", 0.0) * unit for c in ("easting", "northing"))
    name = family.lower()
    latitude = turn("latitude_of_origin", turn("latitude_of_center"))
    if name in ("transverse_mercator", "gauss_kruger"):
        plane = TransverseMercator(turn("central_meridian") + zero, given.get("scale_factor", 1.0), east, north, ellipsoid)
        if latitude:
            plane = replace(plane, false_northing=north - _meridian_length(plane, latitude))
        return Layer(plane, unit)
    if name.startswith("lambert_conformal_conic"):
        one = turn("standard_parallel_1", latitude)
        origin = (turn("central_meridian", turn("longitude_of_center")) + zero, latitude)
        return Layer(LambertConic((one, turn("standard_parallel_2", one)), origin, east, north, given.get("scale_factor", 1.0), ellipsoid), unit)
    raise ValueError(f"unknown projection {family!r}; known: transverse Mercator, Lambert conformal conic")


def _meridian_length(plane: TransverseMercator, latitude: float) -> float:
    """From the equator to a latitude along the central meridian, on the plane."""
    e = math.sqrt(plane.ellipsoid[1] * (2 - plane.ellipsoid[1]))
    s = math.sin(math.radians(latitude))
    chi = math.atan(math.sinh(math.atanh(s) - e * math.atanh(e * s)))
    return plane.radius * (chi + sum(a * math.sin(2 * j * chi) for j, a in enumerate(plane.alpha, 1)))
