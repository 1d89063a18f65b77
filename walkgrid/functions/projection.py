"""Transverse Mercator, forward and inverse, as Column expressions: Krueger's series to the fourth power of the third flattening,
which is below a thousandth of a millimetre over a zone and some metres' width beyond.

A coordinate system is a row of parameters (``system``), by rule where systems come in zones. Datums that differ from WGS 84 by less
than two metres (NAD 83) are taken as equal to it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Semi-major axis in metres and inverse flattening.
WGS84 = (6378137.0, 298.257223563)
GRS80 = (6378137.0, 298.257222101)


@dataclass(frozen=True)
class TransverseMercator:
    """Central meridian (degrees), scale on it, false easting and northing (metres), ellipsoid; the origin is on the equator."""

    meridian: float
    scale: float
    easting: float
    northing: float = 0.0
    ellipsoid: tuple[float, float] = WGS84

    @property
    def _n(self) -> float:
        f = 1 / self.ellipsoid[1]
        return f / (2 - f)

    @property
    def _e(self) -> float:
        f = 1 / self.ellipsoid[1]
        return math.sqrt(f * (2 - f))

    @property
    def _radius(self) -> float:
        """Metres of a radian along the central meridian, in the projection."""
        n = self._n
        return self.scale * self.ellipsoid[0] / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    def _forward(self) -> list[float]:
        n = self._n
        return [
            n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
            13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
            61 * n**3 / 240 - 103 * n**4 / 140,
            49561 * n**4 / 161280,
        ]

    def _backward(self) -> list[float]:
        n = self._n
        return [
            n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
            n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
            17 * n**3 / 480 - 37 * n**4 / 840,
            4397 * n**4 / 161280,
        ]

    def _latitude(self) -> list[float]:
        """From conformal to geographic latitude."""
        n = self._n
        return [
            2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
            7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
            56 * n**3 / 15 - 136 * n**4 / 35,
            4279 * n**4 / 630,
        ]

    @staticmethod
    def _waves(along: Column, across: Column, terms: list[float]) -> tuple[Column, Column]:
        """Sums of a double series in both coordinates."""
        k = range(1, len(terms) + 1)
        first = sum((F.sin(along * (2 * j)) * F.cosh(across * (2 * j)) * c for j, c in zip(k, terms, strict=True)), F.lit(0.0))
        second = sum((F.cos(along * (2 * j)) * F.sinh(across * (2 * j)) * c for j, c in zip(k, terms, strict=True)), F.lit(0.0))
        return first, second

    def project(self, lng: Column, lat: Column) -> tuple[Column, Column]:
        """(x, y) in metres of degrees."""
        turn, sine = F.radians(lng - self.meridian), F.sin(F.radians(lat))
        conformal = F.sinh(F.atanh(sine) - F.atanh(sine * self._e) * self._e)  # tangent of the conformal latitude
        along = F.atan2(conformal, F.cos(turn))
        across = F.asinh(F.sin(turn) / F.sqrt(conformal * conformal + F.cos(turn) * F.cos(turn)))
        up, right = self._waves(along, across, self._forward())
        return (across + right) * self._radius + self.easting, (along + up) * self._radius + self.northing

    def unproject(self, x: Column, y: Column) -> tuple[Column, Column]:
        """(lng, lat) in degrees of metres."""
        along, across = (y - self.northing) / self._radius, (x - self.easting) / self._radius
        up, right = self._waves(along, across, self._backward())
        along, across = along - up, across - right
        turn = F.atan2(F.sinh(across), F.cos(along))
        conformal = F.asin(F.sin(along) / F.cosh(across))
        series = sum((F.sin(conformal * (2 * j)) * c for j, c in enumerate(self._latitude(), 1)), F.lit(0.0))
        return F.degrees(turn) + self.meridian, F.degrees(conformal + series)


def system(srid: int) -> TransverseMercator | None:
    """Parameters of a projected system by its EPSG number; None if it is none of these families.

    UTM north and south on WGS 84 (326zz, 327zz), UTM north on NAD 83 (269zz, zones 1 to 23), and the three-degree zones 3 to 10 of
    eastern Canada on NAD 83 (32183 to 32190) and its 1998 adjustment (2945 to 2952).
    """
    family, zone = divmod(srid, 100)
    utm = lambda south, ellipsoid: TransverseMercator(6.0 * zone - 183, 0.9996, 500_000.0, 10_000_000.0 if south else 0.0, ellipsoid)
    if family in (326, 327) and 1 <= zone <= 60:
        return utm(family == 327, WGS84)
    if family == 269 and 1 <= zone <= 23:
        return utm(False, GRS80)
    for first in (32183, 2945):
        if first <= srid <= first + 7:
            return TransverseMercator(-58.5 - 3.0 * (srid - first), 0.9999, 304_800.0, 0.0, GRS80)
    return None
