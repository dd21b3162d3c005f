"""Map projection and distances.

The Lambert conformal conic (two standard parallels) is written as column
expressions: the ellipsoid constants are computed once on the driver, each
row needs only ``sin``, ``tan``, ``pow``, ``cos``. The datum shift between
the input (WGS84) and NAD83 is taken as identity.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

METERS_PER_MILE = 1609.344


def _dms(d: float, m: float = 0.0) -> float:
    return d + m / 60.0 if d >= 0 else d - m / 60.0


@dataclass(frozen=True)
class LambertConic2SP:
    a: float
    inv_f: float
    lat0: float          # latitude of false origin, degrees
    lon0: float          # longitude of false origin, degrees
    lat1: float          # standard parallels, degrees
    lat2: float
    false_easting: float
    false_northing: float

    @property
    def e(self) -> float:
        f = 1.0 / self.inv_f
        return math.sqrt(2 * f - f * f)

    def _m(self, phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - (self.e * math.sin(phi)) ** 2)

    def _t(self, phi: float) -> float:
        es = self.e * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (self.e / 2)

    def constants(self) -> tuple[float, float, float]:
        """``(n, a*F, rF)``."""
        p1, p2, p0 = (math.radians(v) for v in (self.lat1, self.lat2, self.lat0))
        m1, m2 = self._m(p1), self._m(p2)
        t1, t2, t0 = self._t(p1), self._t(p2), self._t(p0)
        n = (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
        big_f = m1 / (n * t1 ** n)
        return n, self.a * big_f, self.a * big_f * t0 ** n

    def forward(self, lat: float, lon: float) -> tuple[float, float]:
        """Plain-Python reference of the same formula (tests, driver checks)."""
        n, af, rf = self.constants()
        t = self._t(math.radians(lat))
        r = af * t ** n
        theta = n * math.radians(lon - self.lon0)
        return self.false_easting + r * math.sin(theta), self.false_northing + rf - r * math.cos(theta)


# Fixed parameters of the projections (EPSG definitions).
PROJECTIONS = {
    32140: LambertConic2SP(a=6378137.0, inv_f=298.257222101, lat0=_dms(27, 50), lon0=-99.0,
                           lat1=_dms(30, 17), lat2=_dms(28, 23),
                           false_easting=600000.0, false_northing=4000000.0),
}


def projection(epsg: int) -> LambertConic2SP:
    try:
        return PROJECTIONS[epsg]
    except KeyError:
        raise ValueError(f"EPSG:{epsg} is not a supported projection; "
                         f"supported: {sorted(PROJECTIONS)}") from None


def project(lon, lat, epsg: int = 32140) -> tuple[Column, Column]:
    """M1: (easting, northing) in metres of WGS84 lon/lat columns."""
    p = projection(epsg)
    n, af, rf = p.constants()
    e = p.e
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat = F.col(lat) if isinstance(lat, str) else lat
    phi = F.radians(lat)
    es = F.lit(e) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - es) / (F.lit(1.0) + es), F.lit(e / 2))
    r = F.lit(af) * F.pow(t, F.lit(n))
    theta = F.lit(n) * F.radians(lon - F.lit(p.lon0))
    return (F.lit(p.false_easting) + r * F.sin(theta),
            F.lit(p.false_northing + rf) - r * F.cos(theta))


def manhattan_miles(x0, y0, x1, y1) -> Column:
    """M2: ``(|dx| + |dy|) / 1609.344`` of projected metres."""
    return (F.abs(x1 - x0) + F.abs(y1 - y0)) / F.lit(METERS_PER_MILE)


def euclidean_miles(x0, y0, x1, y1) -> Column:
    """M3: ``sqrt(dx^2 + dy^2) / 1609.344`` of projected metres."""
    dx, dy = x1 - x0, y1 - y0
    return F.sqrt(dx * dx + dy * dy) / F.lit(METERS_PER_MILE)


def leg_distances(start_lon, start_lat, end_lon, end_lat, epsg: int = 32140) -> tuple[Column, Column]:
    """(manhattan, euclidean) miles between a leg's start and end."""
    x0, y0 = project(start_lon, start_lat, epsg)
    x1, y1 = project(end_lon, end_lat, epsg)
    return manhattan_miles(x0, y0, x1, y1), euclidean_miles(x0, y0, x1, y1)
