"""GEO1-3, GEO5 as pure Column math.

Lambert conformal conic with two standard parallels (Snyder, USGS
Professional Paper 1395, eqs. 15-1 .. 15-10; EPSG method 9802). The
constants that depend only on the coordinate system are computed once on
the driver; per-row work is a handful of ``sin / tan / pow`` calls inside
whole-stage codegen, with no Python worker and no per-row library.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LambertConic:
    a: float          # semi-major axis (m)
    inv_f: float      # inverse flattening
    lat0: float       # latitude of false origin (deg)
    lon0: float       # longitude of false origin (deg)
    lat1: float       # first standard parallel (deg)
    lat2: float       # second standard parallel (deg)
    false_e: float    # false easting (m)
    false_n: float    # false northing (m)
    unit: float       # metres per output unit
    srid: int

    def constants(self):
        f = 1.0 / self.inv_f
        e = math.sqrt(2 * f - f * f)
        r = math.radians

        def m(phi):
            return math.cos(phi) / math.sqrt(1 - (e * math.sin(phi)) ** 2)

        def t(phi):
            return math.tan(math.pi / 4 - phi / 2) / ((1 - e * math.sin(phi)) / (1 + e * math.sin(phi))) ** (e / 2)

        m1, m2 = m(r(self.lat1)), m(r(self.lat2))
        t0, t1, t2 = t(r(self.lat0)), t(r(self.lat1)), t(r(self.lat2))
        n = (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
        big_f = m1 / (n * t1 ** n)
        rho0 = self.a * big_f * t0 ** n
        return e, n, big_f, rho0


# EPSG:2230, NAD83 / California zone 6 (US survey feet), from
# the public EPSG registry. GRS80 ellipsoid; false origin 32°10'N 116°15'W;
# standard parallels 33°53'N and 32°47'N; false easting 2,000,000 m, false
# northing 500,000 m; US survey foot = 1200/3937 m. The source coordinates
# are WGS84 longitude/latitude, taken as identical to NAD83.
CA_ZONE6_FT = LambertConic(a=6378137.0, inv_f=298.257222101,
                           lat0=32 + 10 / 60, lon0=-(116 + 15 / 60),
                           lat1=33 + 53 / 60, lat2=32 + 47 / 60,
                           false_e=2000000.0, false_n=500000.0,
                           unit=1200.0 / 3937.0, srid=2230)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c) -> Column:
    """True when ``c`` is a finite, non-null double."""
    x = _c(c).cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def project_xy(lng, lat, crs: LambertConic = CA_ZONE6_FT) -> tuple[Column, Column]:
    """(x, y) in the projected system for longitude / latitude in degrees."""
    e, n, big_f, rho0 = crs.constants()
    phi = F.radians(_c(lat).cast("double"))
    lam = F.radians(_c(lng).cast("double"))
    esin = F.lit(e) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((F.lit(1.0) - esin) / (F.lit(1.0) + esin), F.lit(e / 2))
    rho = F.lit(crs.a * big_f) * F.pow(t, F.lit(n))
    theta = F.lit(n) * (lam - F.lit(math.radians(crs.lon0)))
    x = (F.lit(crs.false_e) + rho * F.sin(theta)) / F.lit(crs.unit)
    y = (F.lit(crs.false_n) + F.lit(rho0) - rho * F.cos(theta)) / F.lit(crs.unit)
    return x, y


def fmt_num(c: Column, decimals: int) -> Column:
    """Fixed-decimal text of a double (stable across engines)."""
    return F.format_string(f"%.{decimals}f", c)


def point_wkt(lng, lat, decimals: int = 3, crs: LambertConic = CA_ZONE6_FT) -> Column:
    """GEO1/GEO3: ``POINT (x y)`` in the projected system; null when invalid."""
    x, y = project_xy(lng, lat, crs)
    ok = finite(lng) & finite(lat)
    return F.when(ok, F.concat(F.lit("POINT ("), fmt_num(x, decimals), F.lit(" "), fmt_num(y, decimals), F.lit(")")))


def projected_struct(lng, lat, crs: LambertConic = CA_ZONE6_FT) -> Column:
    """struct<x, y> in the projected system; null when invalid."""
    x, y = project_xy(lng, lat, crs)
    return F.when(finite(lng) & finite(lat), F.struct(x.alias("x"), y.alias("y")))


def vertex_text(lng, lat, decimals: int = 3, crs: LambertConic = CA_ZONE6_FT) -> Column:
    """``"x y"`` text of one projected vertex (used inside ``transform``)."""
    x, y = project_xy(lng, lat, crs)
    return F.concat(fmt_num(x, decimals), F.lit(" "), fmt_num(y, decimals))


def wkt_rings(wkt) -> Column:
    """GEO5: POLYGON / MULTIPOLYGON WKT -> array<array<struct<x, y>>>.

    Every innermost parenthesised list is one ring (outer shells and holes
    alike); containment is decided by even-odd parity over all rings, which
    handles holes and multi-part zones without tracking ring roles.
    """
    rings = F.regexp_extract_all(_c(wkt), F.lit(r"\(([^()]+)\)"), 1)
    return F.transform(rings, lambda r: F.transform(
        F.split(F.trim(r), r"\s*,\s*"),
        lambda p: F.struct(F.split(F.trim(p), r"\s+").getItem(0).cast("double").alias("x"),
                           F.split(F.trim(p), r"\s+").getItem(1).cast("double").alias("y"))))
