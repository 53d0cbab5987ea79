"""Transverse Mercator for EPSG:2180 as column expressions: no UDF, so it stays in the engine.

Krueger series to the sixth order in the third flattening, on GRS80 (public geodesy literature).
Following the catalogue's axis order, x is the northing and y the easting.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from fractions import Fraction as R

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# GRS80 and the parameters of EPSG:2180.
SEMI_MAJOR, INVERSE_FLATTENING = 6378137.0, 298.257222101
ORIGIN_LON, SCALE, FALSE_EASTING, FALSE_NORTHING = 19.0, 0.9993, 500000.0, -5300000.0
# Series in n, one row for each multiple of the angle; entry k of row j belongs to n^(j + k).
FORWARD = [
    [R(1, 2), R(-2, 3), R(5, 16), R(41, 180), R(-127, 288), R(7891, 37800)],
    [R(13, 48), R(-3, 5), R(557, 1440), R(281, 630), R(-1983433, 1935360)],
    [R(61, 240), R(-103, 140), R(15061, 26880), R(167603, 181440)],
    [R(49561, 161280), R(-179, 168), R(6601661, 7257600)],
    [R(34729, 80640), R(-3418889, 1995840)],
    [R(212378941, 319334400)],
]
INVERSE = [
    [R(1, 2), R(-2, 3), R(37, 96), R(-1, 360), R(-81, 512), R(96199, 604800)],
    [R(1, 48), R(1, 15), R(-437, 1440), R(46, 105), R(-1118711, 3870720)],
    [R(17, 480), R(-37, 840), R(-209, 4480), R(5569, 90720)],
    [R(4397, 161280), R(-11, 504), R(-830251, 7257600)],
    [R(4583, 161280), R(-108847, 3991680)],
    [R(20648693, 638668800)],
]
LATITUDE = [
    [R(2), R(-2, 3), R(-2), R(116, 45), R(26, 45), R(-2854, 675)],
    [R(7, 3), R(-8, 5), R(-227, 45), R(2704, 315), R(2323, 945)],
    [R(56, 15), R(-136, 35), R(-1262, 105), R(73814, 2835)],
    [R(4279, 630), R(-332, 35), R(-399572, 14175)],
    [R(4174, 315), R(-144838, 6237)],
    [R(601676, 22275)],
]
N = 1 / (2 * INVERSE_FLATTENING - 1)
RADIUS = SCALE * SEMI_MAJOR / (1 + N) * (1 + N**2 / 4 + N**4 / 64 + N**6 / 256)
#: Eccentricity.
ECC = 2 * math.sqrt(N) / (1 + N)


def series(rows: list[list[R]]) -> list[float]:
    return [sum(float(c) * N ** (j + k) for k, c in enumerate(row)) for j, row in enumerate(rows, 1)]


def atanh(x: Column) -> Column:
    """The inverse hyperbolic tangent by one logarithm, as C libraries compute it; Spark's difference of two loses the last digits."""
    a = F.abs(x)
    u = a + a
    return F.signum(x) * 0.5 * F.log1p(F.when(a < 0.5, u + u * a / (1.0 - a)).otherwise(u / (1.0 - a)))


#: Quarter of a half turn, as a double and what it lacks; z up to which a series gives the rest of an angle.
QUARTER, QUARTER_REST, NEAR = math.pi / 4, 3.061616997868383e-17, 0.1
#: Splits a double into two of 26 bits, whose products are exact.
SPLIT = 134217729.0


def _angle(v: dict[str, Column]) -> Column:
    """atan2(t, c); about the latitudes 39 to 51, where northings leave no digit to spare, right to the last bit but for near ties.

    There it is a quarter and the angle of z = (t - c) / (t + c), with what quotient and sums leave over.
    """
    z, z2, whole = v["z"], v["z2"], v["whole"]
    over = ((v["zh"] * v["sh"] - v["p"]) + v["zh"] * v["sl"] + v["zl"] * v["sh"]) + v["zl"] * v["sl"]
    low = ((v["d"] - v["p"]) - over - z * v["rest"]) / v["sum"]
    tail = F.lit(1 / 17)
    for k in range(15, 1, -2):
        tail = (1 / k if k % 4 == 1 else -1 / k) + z2 * tail
    near = whole + ((z - (whole - QUARTER)) + (QUARTER_REST + low + z * z2 * tail))
    return F.when((v["c"] > 0) & (v["t"] > 0) & (F.abs(z) < NEAR), near).otherwise(F.atan2(v["t"], v["c"]))


def _sums(v: dict[str, Column]) -> dict[str, Column]:
    north, east = v["xi"], v["eta"]
    for j, a in enumerate(series(FORWARD), 1):
        north = north + a * F.sin(2 * j * v["xi"]) * F.cosh(2 * j * v["eta"])
        east = east + a * F.cos(2 * j * v["xi"]) * F.sinh(2 * j * v["eta"])
    return {"n": FALSE_NORTHING + RADIUS * north, "e": FALSE_EASTING + RADIUS * east}


#: The steps from lat and lon to n and e; each gives the values that later ones may use, so that none is written out twice.
STEPS: list[Callable[[dict[str, Column]], dict[str, Column]]] = [
    lambda v: {"s": F.sin(F.radians(v["lat"])), "dl": F.radians(v["lon"] - ORIGIN_LON)},
    lambda v: {"t": F.sinh(atanh(v["s"]) - ECC * atanh(ECC * v["s"])), "c": F.cos(v["dl"])},
    lambda v: {"d": v["t"] - v["c"], "sum": v["t"] + v["c"], "w": F.sin(v["dl"]) / F.sqrt(1 + v["t"] * v["t"])},
    lambda v: {"z": v["d"] / F.nullif(v["sum"], F.lit(0.0)), "back": v["sum"] - v["t"], "eta": atanh(v["w"])},
    lambda v: {"rest": (v["t"] - (v["sum"] - v["back"])) + (v["c"] - v["back"]), "z2": v["z"] * v["z"], "p": v["z"] * v["sum"], "zh": v["z"] * SPLIT - (v["z"] * SPLIT - v["z"]), "sh": v["sum"] * SPLIT - (v["sum"] * SPLIT - v["sum"]), "whole": QUARTER + v["z"]},
    lambda v: {"zl": v["z"] - v["zh"], "sl": v["sum"] - v["sh"]},
    lambda v: {"xi": _angle(v)},
    _sums,
]


def plane(lat: Column, lon: Column) -> Column:
    """struct<n, e>: northing and easting of degrees, null where a coordinate is null; each step's values lie in a list of one."""

    def then(k: int, v: dict[str, Column]) -> Column:
        new = STEPS[k](v)
        if k == len(STEPS) - 1:
            return F.struct(*(c.alias(name) for name, c in new.items()))
        kept = v | new
        one = F.array(F.struct(*(c.alias(name) for name, c in kept.items())))
        return F.get(F.transform(one, lambda s: then(k + 1, {name: s[name] for name in kept})), F.lit(0))

    return then(0, {"lat": lat, "lon": lon})


def with_plane(rows: DataFrame, lat: str, lon: str, north: str, east: str) -> DataFrame:
    """Rows with two more columns, northing and easting; the steps are columns, so they are generated code.

    They end in a generator of one row, below which no filter on the coordinates is pushed: Spark would
    write the steps out in it, and place each point once more for each coordinate.
    """
    own = [F.col(f"`{name}`") for name in rows.columns]
    v = {"lat": F.col(f"`{lat}`"), "lon": F.col(f"`{lon}`")}
    out = rows
    for step in STEPS[:-1]:
        new = step(v)
        out = out.withColumns({f"__plane_{name}": c for name, c in new.items()})
        v |= {name: F.col(f"__plane_{name}") for name in new}
    last = STEPS[-1](v)
    return out.select(*own, F.inline(F.array(F.struct(last["n"], last["e"]))).alias(north, east))


def to_plane(lat: Column, lon: Column) -> tuple[Column, Column]:
    """(x_1992 northing, y_1992 easting) of degrees; null where a coordinate is null."""
    p = plane(lat, lon)
    return p["n"], p["e"]


def to_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    """(lat, lon) of northing and easting."""
    xi0, eta0 = (x - FALSE_NORTHING) / RADIUS, (y - FALSE_EASTING) / RADIUS
    xi, eta = xi0, eta0
    for j, b in enumerate(series(INVERSE), 1):
        xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lat = chi
    for j, d in enumerate(series(LATITUDE), 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.degrees(lat), ORIGIN_LON + F.degrees(F.atan2(F.sinh(eta), F.cos(xi)))


def consistency_error(lat: Column, lon: Column, x: Column, y: Column) -> Column:
    """Metres between the projected point and the stored plane coordinates."""
    north, east = to_plane(lat, lon)
    return F.hypot(north - x, east - y)


#: Stored and projected coordinates may differ by so many metres.
MAX_ERROR_M = 0.5


def is_consistent(lat: Column, lon: Column, x: Column, y: Column) -> Column:
    return consistency_error(lat, lon, x, y) <= MAX_ERROR_M


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Planar metres, null if a coordinate is."""
    return F.hypot(x1 - x2, y1 - y2)


def plane_sql(lat: str, lon: str) -> tuple[str, str]:
    """The same as `to_plane` in SQL text, for engines with hyperbolic functions."""
    s, dl = f"sin(radians({lat}))", f"radians({lon} - {ORIGIN_LON!r})"
    t = f"sinh(atanh({s}) - {ECC!r} * atanh({ECC!r} * {s}))"
    xi, eta = f"atan2({t}, cos({dl}))", f"atanh(sin({dl}) / sqrt(1 + ({t}) * ({t})))"
    north = " + ".join([xi, *(f"{a!r} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, a in enumerate(series(FORWARD), 1))])
    east = " + ".join([eta, *(f"{a!r} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, a in enumerate(series(FORWARD), 1))])
    return f"({FALSE_NORTHING!r} + {RADIUS!r} * ({north}))", f"({FALSE_EASTING!r} + {RADIUS!r} * ({east}))"


def degrees_sql(x: str, y: str) -> tuple[str, str]:
    """The same as `to_degrees` in SQL text."""
    xi0, eta0 = f"(({x} - {FALSE_NORTHING!r}) / {RADIUS!r})", f"(({y} - {FALSE_EASTING!r}) / {RADIUS!r})"
    xi = "(" + " - ".join([xi0, *(f"{b!r} * sin({2 * j} * {xi0}) * cosh({2 * j} * {eta0})" for j, b in enumerate(series(INVERSE), 1))]) + ")"
    eta = "(" + " - ".join([eta0, *(f"{b!r} * cos({2 * j} * {xi0}) * sinh({2 * j} * {eta0})" for j, b in enumerate(series(INVERSE), 1))]) + ")"
    chi = f"asin(sin({xi}) / cosh({eta}))"
    lat = " + ".join([chi, *(f"{d!r} * sin({2 * j} * {chi})" for j, d in enumerate(series(LATITUDE), 1))])
    return f"degrees({lat})", f"({ORIGIN_LON!r} + degrees(atan2(sinh({eta}), cos({xi}))))"
