"""Affine grids and transverse Mercator as column arithmetic."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """x = a * col + b * row + c, y = d * col + e * row + f, of a pixel's upper left corner."""

    width: int
    height: int
    a: float = 1.0
    b: float = 0.0
    c: float = 0.0
    d: float = 0.0
    e: float = 1.0
    f: float = 0.0
    epsg: int = 32635

    def to_ground(self, row: Column, col: Column) -> tuple[Column, Column]:
        """Ground coordinates of a pixel's centre."""
        i, j = row + 0.5, col + 0.5
        return j * self.a + i * self.b + self.c, j * self.d + i * self.e + self.f

    def to_pixel(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Fractional (row, col); whole numbers are pixel centres."""
        det = self.a * self.e - self.b * self.d
        u, v = x - self.c, y - self.f
        return (u * (-self.d) + v * self.a) / det - 0.5, (u * self.e + v * (-self.b)) / det - 0.5

    def same_as(self, other: Grid) -> bool:
        return self == other


# WGS 84 and the Krueger series in the third flattening, to its sixth power.
_F = 1 / 298.257223563
_N = _F / (2 - _F)
_A = 6378137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_E = math.sqrt(_F * (2 - _F))
_K0 = 0.9996


def utm_forward(lon: Column, lat: Column, zone: int, north: bool = True) -> tuple[Column, Column]:
    """Easting and northing in metres of degrees."""
    phi, lam = F.radians(lat), F.radians(lon - (6 * zone - 183))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - _E * F.atanh(s * _E))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(F.lit(1.0) + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500000 + _K0 * _A * x, (0 if north else 10_000_000) + _K0 * _A * y


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it many times: a lambda's variable does not copy its expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def utm_inverse(x: Column, y: Column, zone: int, north: bool = True) -> tuple[Column, Column]:
    """Longitude and latitude in degrees; the inverse of :func:`utm_forward` to well below a millimetre."""

    def conformal(v: Column) -> Column:
        p, q = v["xi"], v["eta"]
        for j, b in enumerate(_BETA, 1):
            p = p - b * F.sin(2 * j * v["xi"]) * F.cosh(2 * j * v["eta"])
            q = q - b * F.cos(2 * j * v["xi"]) * F.sinh(2 * j * v["eta"])
        return F.struct(p.alias("p"), q.alias("q"))

    def tangent(v: Column) -> Column:
        return F.struct((F.sin(v["p"]) / F.sqrt(F.sinh(v["q"]) * F.sinh(v["q"]) + F.cos(v["p"]) * F.cos(v["p"]))).alias("tau"), F.atan2(F.sinh(v["q"]), F.cos(v["p"])).alias("lam"))

    def newton(tau: Column):
        """One step from the conformal to the geodetic latitude."""

        def step(t: Column, _: Column) -> Column:
            r = F.sqrt(F.lit(1.0) + t * t)

            def move(sigma: Column) -> Column:
                ti = t * F.sqrt(F.lit(1.0) + sigma * sigma) - sigma * r
                return t + (tau - ti) / F.sqrt(F.lit(1.0) + ti * ti) * (F.lit(1.0) + (1 - _E**2) * t * t) / ((1 - _E**2) * r)

            return _bind(F.sinh(_E * F.atanh(_E * t / r)), move)

        return step

    start = F.struct(((y - (0 if north else 10_000_000)) / (_K0 * _A)).alias("xi"), ((x - 500000) / (_K0 * _A)).alias("eta"))
    both = _bind(_bind(start, conformal), tangent)
    lat = _bind(both, lambda v: F.degrees(F.atan(F.aggregate(F.sequence(F.lit(1), F.lit(4)), v["tau"], newton(v["tau"])))))
    return F.degrees(both["lam"]) + (6 * zone - 183), lat


def utm_zone(lon: float) -> int:
    return int((lon + 180) // 6) % 60 + 1


def transform(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    """Coordinates from one EPSG code to another: degrees (4326) and UTM zones north (326zz) and south (327zz)."""

    def zone(code: int) -> tuple[int, bool]:
        if code // 100 not in (326, 327):
            raise ValueError(f"EPSG {code} is neither 4326 nor a UTM zone")
        return code % 100, code // 100 == 326

    if source == target:
        return x, y
    lon, lat = (x, y) if source == 4326 else utm_inverse(x, y, *zone(source))
    return (lon, lat) if target == 4326 else utm_forward(lon, lat, *zone(target))
