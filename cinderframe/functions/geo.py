"""Map projections and grids as SQL expressions: closed forms, so no UDF is needed.

Albers equal-area follows Snyder (USGS Professional Paper 1395), UTM the Krueger series to order four (Karney 2011).
Each function takes SQL texts for its arguments and returns SQL texts.
"""

from __future__ import annotations

import math


def num(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


class Albers:
    """EPSG:5070: GRS80, standard parallels 29.5 and 45.5, origin 23 N 96 W."""

    A, F = 6378137.0, 1 / 298.257222101
    PARALLELS, LAT0, LON0 = (29.5, 45.5), 23.0, -96.0

    def __init__(self):
        self.e2 = 2 * self.F - self.F**2
        self.e = math.sqrt(self.e2)
        q = lambda deg: self._q(math.sin(math.radians(deg)))
        m = [math.cos(math.radians(p)) / math.sqrt(1 - self.e2 * math.sin(math.radians(p)) ** 2) for p in self.PARALLELS]
        q1, q2 = map(q, self.PARALLELS)
        self.n = (m[0] ** 2 - m[1] ** 2) / (q2 - q1)
        self.c = m[0] ** 2 + self.n * q1
        self.rho0 = self.A * math.sqrt(self.c - self.n * q(self.LAT0)) / self.n
        self.qp = q(90.0)

    def _q(self, s: float) -> float:
        return (1 - self.e2) * (s / (1 - self.e2 * s * s) - math.log((1 - self.e * s) / (1 + self.e * s)) / (2 * self.e))

    def forward(self, lon: str, lat: str) -> tuple[str, str]:
        s = f"sin(radians({lat}))"
        q = f"({num(1 - self.e2)} * ({s} / (1 - {num(self.e2)} * {s} * {s}) - ln((1 - {num(self.e)} * {s}) / (1 + {num(self.e)} * {s})) / {num(2 * self.e)}))"
        rho = f"({num(self.A / self.n)} * sqrt({num(self.c)} - {num(self.n)} * {q}))"
        theta = f"({num(self.n)} * radians(({lon}) - ({num(self.LON0)})))"
        return f"({rho} * sin({theta}))", f"({num(self.rho0)} - {rho} * cos({theta}))"

    def inverse(self, x: str, y: str) -> tuple[str, str]:
        dy = f"({num(self.rho0)} - ({y}))"
        rho2 = f"(({x}) * ({x}) + {dy} * {dy})"
        beta = f"asin(({num(self.c)} - {rho2} * {num((self.n / self.A) ** 2)}) / {num(self.n * self.qp)})"
        e2, e4, e6 = self.e2, self.e2**2, self.e2**3
        a2, a4, a6 = e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040, 23 * e4 / 360 + 251 * e6 / 3780, 761 * e6 / 45360
        lat = f"degrees({beta} + {num(a2)} * sin(2 * {beta}) + {num(a4)} * sin(4 * {beta}) + {num(a6)} * sin(6 * {beta}))"
        lon = f"({num(self.LON0)} + degrees(atan2({x}, {dy})) / {num(self.n)})"
        return lon, lat


class Utm:
    """WGS84, scale 0.9996, false easting 500 km, false northing 10 000 km in the south."""

    A, F, K0, E0 = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0

    def __init__(self):
        n = self.F / (2 - self.F)
        self.radius = self.A / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * self.K0
        self.e = math.sqrt(2 * self.F - self.F**2)
        self.alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)
        self.beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)
        self.delta = (2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630)

    @staticmethod
    def epsg(lon: str, lat: str) -> str:
        return f"(CASE WHEN ({lat}) >= 0 THEN 32600 ELSE 32700 END + CAST(floor((({lon}) + 180) / 6) AS INT) + 1)"

    @staticmethod
    def central(zone: str) -> str:
        return f"(({zone}) * 6 - 183)"

    def forward(self, lon: str, lat: str, zone: str) -> tuple[str, str]:
        """Easting and northing in a northern zone."""
        s, lam = f"sin(radians({lat}))", f"radians(({lon}) - {self.central(zone)})"
        t = f"sinh(atanh({s}) - {num(self.e)} * atanh({num(self.e)} * {s}))"
        xi, eta = f"atan2({t}, cos({lam}))", f"atanh(sin({lam}) / sqrt(1 + {t} * {t}))"
        east = " + ".join([eta, *(f"{num(a)} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, a in enumerate(self.alpha, 1))])
        north = " + ".join([xi, *(f"{num(a)} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, a in enumerate(self.alpha, 1))])
        return f"({num(self.E0)} + {num(self.radius)} * ({east}))", f"({num(self.radius)} * ({north}))"

    def inverse(self, east: str, north: str, zone: str) -> tuple[str, str]:
        """Longitude and latitude from a northern zone."""
        xi, eta = f"(({north}) / {num(self.radius)})", f"((({east}) - {num(self.E0)}) / {num(self.radius)})"
        xi1 = "(" + " - ".join([xi, *(f"{num(b)} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, b in enumerate(self.beta, 1))]) + ")"
        eta1 = "(" + " - ".join([eta, *(f"{num(b)} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, b in enumerate(self.beta, 1))]) + ")"
        chi = f"asin(sin({xi1}) / cosh({eta1}))"
        lat = " + ".join([chi, *(f"{num(d)} * sin({2 * j} * {chi})" for j, d in enumerate(self.delta, 1))])
        return f"({self.central(zone)} + degrees(atan2(sinh({eta1}), cos({xi1}))))", f"degrees({lat})"


#: Pixel size, and the corner that the land-cover grid snaps to (EPSG:5070).
PIXEL = 30.0
SNAP = (-2493045.0, 3310005.0)


def snapped(minx: str, miny: str, maxx: str, maxy: str) -> dict[str, str]:
    """left, bottom, right, top, width, height of the snapped grid around bounds."""
    ox, oy, p = num(SNAP[0]), f"({num(SNAP[1])})", num(PIXEL)
    ox = f"({ox})"
    left, right = f"({ox} + floor((({minx}) - {ox}) / {p}) * {p})", f"({ox} + ceil((({maxx}) - {ox}) / {p}) * {p})"
    top, bottom = f"({oy} - floor(({oy} - ({maxy})) / {p}) * {p})", f"({oy} - ceil(({oy} - ({miny})) / {p}) * {p})"
    return {"left": left, "bottom": bottom, "right": right, "top": top, "width": f"CAST(round(({right} - {left}) / {p}) AS INT)", "height": f"CAST(round(({top} - {bottom}) / {p}) AS INT)"}
