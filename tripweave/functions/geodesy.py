"""Distance on the ellipsoid and the transverse Mercator projection, as Spark SQL text."""

from __future__ import annotations

import math
from dataclasses import dataclass

from tripweave.functions.geometry import point
from tripweave.functions.lambdas import each, fold, let, num, row

# WGS84 and GRS80 semi-major axis (m) and flattening.
WGS84 = (6378137.0, 1 / 298.257223563)
GRS80 = (6378137.0, 1 / 298.257222101)

# Each round of Vincenty's inverse formula shrinks the error by about the flattening.
ROUNDS = 6


def ellipsoid_distance(lon1: str, lat1: str, lon2: str, lat2: str, ellipsoid=WGS84) -> str:
    """Metres along the ellipsoid (Vincenty's inverse formula); 0 for equal points."""
    axis, flat = ellipsoid
    minor = axis * (1 - flat)
    f = num(flat)

    def reduced(lat: str, sin: str, cos: str) -> dict[str, str]:
        """Sine and cosine of the latitude on the auxiliary sphere."""
        s, c = f"({num(1 - flat)} * sin(radians({lat})))", f"cos(radians({lat}))"
        norm = f"sqrt({s} * {s} + {c} * {c})"
        return {sin: f"{s} / {norm}", cos: f"{c} / {norm}"}

    start = row(
        L=f"radians({lon2} - {lon1})", **reduced(lat1, "s1", "c1"), **reduced(lat2, "s2", "c2")
    )

    def improve(u: str, lam: str) -> str:
        def arc(v: str) -> str:
            across = f"({u}.c2 * {v}.sin)"
            along = f"({u}.c1 * {u}.s2 - {u}.s1 * {u}.c2 * {v}.cos)"
            return row(
                sin=f"{v}.sin",
                ss=f"sqrt({across} * {across} + {along} * {along})",
                cs=f"{u}.s1 * {u}.s2 + {u}.c1 * {u}.c2 * {v}.cos",
            )

        def azimuth(v: str) -> str:
            sin_a = f"coalesce(try_divide({u}.c1 * {u}.c2 * {v}.sin, {v}.ss), 0D)"
            return row(
                ss=f"{v}.ss", cs=f"{v}.cs", sigma=f"atan2({v}.ss, {v}.cs)", sa=sin_a, c2a=f"1 - {sin_a} * {sin_a}"
            )

        def middle(v: str) -> str:
            return row(
                **{name: f"{v}.{name}" for name in ("ss", "cs", "sigma", "sa", "c2a")},
                c2m=f"{v}.cs - coalesce(try_divide(2 * {u}.s1 * {u}.s2, {v}.c2a), 0D)",
                c=f"{f} / 16 * {v}.c2a * (4 + {f} * (4 - 3 * {v}.c2a))",
            )

        def finish(v: str) -> str:
            inner = f"({v}.c2m + {v}.c * {v}.cs * (-1 + 2 * {v}.c2m * {v}.c2m))"
            return row(
                lam=f"{u}.L + (1 - {v}.c) * {f} * {v}.sa * ({v}.sigma + {v}.c * {v}.ss * {inner})",
                **{name: f"{v}.{name}" for name in ("ss", "cs", "sigma", "c2a", "c2m")},
            )

        turn = row(sin=f"sin({lam})", cos=f"cos({lam})")
        return let(turn, lambda v: let(arc(v), lambda w: let(azimuth(w), lambda x: let(middle(x), finish))))

    def length(v: str) -> str:
        u2 = f"({v}.c2a * {num((axis * axis - minor * minor) / (minor * minor))})"
        a = f"(1 + {u2} / 16384 * (4096 + {u2} * (-768 + {u2} * (320 - 175 * {u2}))))"
        b = f"({u2} / 1024 * (256 + {u2} * (-128 + {u2} * (74 - 47 * {u2}))))"
        near = f"{v}.cs * (-1 + 2 * {v}.c2m * {v}.c2m)"
        far = f"{b} / 6 * {v}.c2m * (-3 + 4 * {v}.ss * {v}.ss) * (-3 + 4 * {v}.c2m * {v}.c2m)"
        return f"{num(minor)} * {a} * ({v}.sigma - {b} * {v}.ss * ({v}.c2m + {b} / 4 * ({near} - {far})))"

    def solve(u: str) -> str:
        first = row(lam=f"{u}.L", **dict.fromkeys(("ss", "cs", "sigma", "c2a", "c2m"), "0D"))
        return let(fold(f"sequence(1, {ROUNDS})", first, lambda acc, i: improve(u, f"{acc}.lam")), length)

    known = " and ".join(f"{c} is not null" for c in (lon1, lat1, lon2, lat2))
    return f"if({known}, {let(start, solve)}, null)"


@dataclass(frozen=True)
class TransverseMercator:
    """A transverse Mercator plane; the defaults are UTM zone 30 north on GRS80.

    Krueger's series in the third flattening, good to well below a millimetre across a zone.
    """

    meridian: float = -3.0
    scale: float = 0.9996
    false_easting: float = 500000.0
    false_northing: float = 0.0
    ellipsoid: tuple[float, float] = GRS80

    @property
    def _n(self) -> float:
        return self.ellipsoid[1] / (2 - self.ellipsoid[1])

    @property
    def radius(self) -> float:
        n = self._n
        return self.scale * self.ellipsoid[0] / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)

    # Published series coefficients.
    @property
    def alpha(self) -> list[float]:
        n = self._n
        return [
            n / 2 - 2 / 3 * n**2 + 5 / 16 * n**3 + 41 / 180 * n**4,
            13 / 48 * n**2 - 3 / 5 * n**3 + 557 / 1440 * n**4,
            61 / 240 * n**3 - 103 / 140 * n**4,
            49561 / 161280 * n**4,
        ]

    @property
    def beta(self) -> list[float]:
        n = self._n
        return [
            n / 2 - 2 / 3 * n**2 + 37 / 96 * n**3 - 1 / 360 * n**4,
            1 / 48 * n**2 + 1 / 15 * n**3 - 437 / 1440 * n**4,
            17 / 480 * n**3 - 37 / 840 * n**4,
            4397 / 161280 * n**4,
        ]

    @property
    def delta(self) -> list[float]:
        n = self._n
        return [
            2 * n - 2 / 3 * n**2 - 2 * n**3 + 116 / 45 * n**4 + 26 / 45 * n**5 - 2854 / 675 * n**6,
            7 / 3 * n**2 - 8 / 5 * n**3 - 227 / 45 * n**4 + 2704 / 315 * n**5 + 2323 / 945 * n**6,
            56 / 15 * n**3 - 136 / 35 * n**4 - 1262 / 105 * n**5 + 73814 / 2835 * n**6,
            4279 / 630 * n**4 - 332 / 35 * n**5 - 399572 / 14175 * n**6,
            4174 / 315 * n**5 - 144838 / 6237 * n**6,
            601676 / 22275 * n**6,
        ]

    def to_lonlat(self, easting: str, northing: str) -> str:
        """Plane metres to struct<x: longitude, y: latitude> in degrees."""

        def unbend(v: str) -> str:
            xi, eta = f"{v}.xi", f"{v}.eta"
            for j, b in enumerate(self.beta, 1):
                xi += f" - {num(b)} * sin({2 * j} * {v}.xi) * cosh({2 * j} * {v}.eta)"
                eta += f" - {num(b)} * cos({2 * j} * {v}.xi) * sinh({2 * j} * {v}.eta)"
            return row(xi=xi, eta=eta)

        def sphere(v: str) -> str:
            return row(
                chi=f"asin(sin({v}.xi) / cosh({v}.eta))", lam=f"atan2(sinh({v}.eta), cos({v}.xi))"
            )

        def degrees(v: str) -> str:
            phi = f"{v}.chi"
            for j, d in enumerate(self.delta, 1):
                phi += f" + {num(d)} * sin({2 * j} * {v}.chi)"
            return point(f"{num(self.meridian)} + degrees({v}.lam)", f"degrees({phi})")

        plane = row(
            xi=f"({northing} - {num(self.false_northing)}) / {num(self.radius)}",
            eta=f"({easting} - {num(self.false_easting)}) / {num(self.radius)}",
        )
        return let(plane, lambda v: let(unbend(v), lambda w: let(sphere(w), degrees)))

    def from_lonlat(self, lon: str, lat: str) -> str:
        """Degrees to struct<x: easting, y: northing> in metres."""
        flat = self.ellipsoid[1]
        ecc = num(math.sqrt(flat * (2 - flat)))

        def sphere(v: str) -> str:
            return row(t=f"sinh(atanh({v}.s) - {ecc} * atanh({ecc} * {v}.s))", lam=f"{v}.lam")

        def bend(v: str) -> str:
            wide = f"sqrt({v}.t * {v}.t + cos({v}.lam) * cos({v}.lam))"
            return row(xi=f"atan2({v}.t, cos({v}.lam))", eta=f"asinh(sin({v}.lam) / {wide})")

        def plane(v: str) -> str:
            xi, eta = f"{v}.xi", f"{v}.eta"
            for j, a in enumerate(self.alpha, 1):
                xi += f" + {num(a)} * sin({2 * j} * {v}.xi) * cosh({2 * j} * {v}.eta)"
                eta += f" + {num(a)} * cos({2 * j} * {v}.xi) * sinh({2 * j} * {v}.eta)"
            return point(
                f"{num(self.false_easting)} + {num(self.radius)} * ({eta})",
                f"{num(self.false_northing)} + {num(self.radius)} * ({xi})",
            )

        start = row(s=f"sin(radians({lat}))", lam=f"radians({lon} - {num(self.meridian)})")
        return let(start, lambda v: let(sphere(v), lambda w: let(bend(w), plane)))

    def reproject(self, geometry: str) -> str:
        """A geometry in plane metres to one in degrees."""
        return each(
            geometry,
            lambda polygon: each(
                polygon, lambda ring: each(ring, lambda p: self.to_lonlat(f"{p}.x", f"{p}.y"))
            ),
        )
