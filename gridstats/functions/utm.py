"""Longitude / latitude to UTM and back: sixth-order Krüger series (Krüger 1912, Karney 2011).

Each formula is written once, as a list of steps over named values. The column form binds the values of
every step with a lambda (a one-element ``transform``), so the expression grows by one level per step and
stays small however often a value is used: plain nesting would repeat it, and Catalyst would copy the
repeated tree into every pushed-down filter. ``utm_forward_point`` runs the same steps on plain numbers
for the two corners of a box.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from types import ModuleType
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridstats.constants import (
    UTM_FALSE_EASTING,
    UTM_FALSE_NORTHING_SOUTH,
    UTM_SCALE,
    WGS84_A,
    WGS84_INVERSE_F,
)
from gridstats.functions.binding import let

_F = 1.0 / WGS84_INVERSE_F
_N = _F / (2.0 - _F)
_E2 = _F * (2.0 - _F)
_E = math.sqrt(_E2)

# Coefficients of n^j, n^(j+1), ... n^6 for j = 1..6.
_ALPHA_TERMS = (
    (1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800),
    (13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360),
    (61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440),
    (49561 / 161280, -179 / 168, 6601661 / 7257600),
    (34729 / 80640, -3418889 / 1995840),
    (212378941 / 319334400,),
)
_BETA_TERMS = (
    (1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800),
    (1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720),
    (17 / 480, -37 / 840, -209 / 4480, 5569 / 90720),
    (4397 / 161280, -11 / 504, -830251 / 7257600),
    (4583 / 161280, -108847 / 3991680),
    (20648693 / 638668800,),
)


def _series(rows: tuple[tuple[float, ...], ...]) -> tuple[float, ...]:
    return tuple(sum(c * _N ** (j + k) for k, c in enumerate(row)) for j, row in enumerate(rows, start=1))


ALPHA = _series(_ALPHA_TERMS)
BETA = _series(_BETA_TERMS)
RECTIFYING_RADIUS = WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
SCALED_RADIUS = UTM_SCALE * RECTIFYING_RADIUS
ECCENTRICITY = _E

# A step: the names it adds, and their values from those known so far (``m``: ``math`` or Spark functions).
_Step = tuple[tuple[str, ...], Callable[[ModuleType, dict[str, Any]], tuple]]


def _wave(m: ModuleType, xi: Any, eta: Any, terms: tuple[float, ...]) -> tuple[Any, Any]:
    dx = sum(c * m.sin(2 * j * xi) * m.cosh(2 * j * eta) for j, c in enumerate(terms, start=1))
    dy = sum(c * m.cos(2 * j * xi) * m.sinh(2 * j * eta) for j, c in enumerate(terms, start=1))
    return dx, dy


def _conformal(m: ModuleType, tau: Any, sigma: Any) -> Any:
    return tau * m.sqrt(1 + sigma * sigma) - sigma * m.sqrt(1 + tau * tau)


def _sigma(m: ModuleType, tau: Any) -> Any:
    return m.sinh(_E * m.atanh(_E * tau / m.sqrt(1 + tau * tau)))


_FORWARD: list[_Step] = [
    (("tau", "lam"), lambda m, v: (m.tan(m.radians(v["lat"])), m.radians(v["lon"] - v["meridian"]))),
    (("sigma",), lambda m, v: (_sigma(m, v["tau"]),)),
    (("conf", "cos", "sin"), lambda m, v: (_conformal(m, v["tau"], v["sigma"]), m.cos(v["lam"]), m.sin(v["lam"]))),
    (
        ("xi", "eta"),
        lambda m, v: (
            m.atan2(v["conf"], v["cos"]),
            m.asinh(v["sin"] / m.sqrt(v["conf"] * v["conf"] + v["cos"] * v["cos"])),
        ),
    ),
    (("dxi", "deta"), lambda m, v: _wave(m, v["xi"], v["eta"], ALPHA)),
    (
        ("x", "y"),
        lambda m, v: (
            UTM_FALSE_EASTING + SCALED_RADIUS * (v["eta"] + v["deta"]),
            v["shift"] + SCALED_RADIUS * (v["xi"] + v["dxi"]),
        ),
    ),
]


def _newton(source: str, target: str) -> list[_Step]:
    """One Newton step from the conformal back to the geographic latitude (both as tangents)."""

    def refine(m: ModuleType, v: dict[str, Any]) -> tuple:
        tau, guess = v[source], v["guess_" + source]
        slope = (1 + (1 - _E2) * tau * tau) / ((1 - _E2) * m.sqrt(1 + tau * tau))
        return (tau + (v["conf"] - guess) / m.sqrt(1 + guess * guess) * slope,)

    return [
        (("sigma_" + source,), lambda m, v: (_sigma(m, v[source]),)),
        (("guess_" + source,), lambda m, v: (_conformal(m, v[source], v["sigma_" + source]),)),
        ((target,), refine),
    ]


_INVERSE: list[_Step] = [
    (
        ("xi", "eta"),
        lambda m, v: ((v["y"] - v["shift"]) / SCALED_RADIUS, (v["x"] - UTM_FALSE_EASTING) / SCALED_RADIUS),
    ),
    (("dxi", "deta"), lambda m, v: _wave(m, v["xi"], v["eta"], BETA)),
    (
        ("sh", "cx", "sx"),
        lambda m, v: (m.sinh(v["eta"] - v["deta"]), m.cos(v["xi"] - v["dxi"]), m.sin(v["xi"] - v["dxi"])),
    ),
    (("conf",), lambda m, v: (v["sx"] / m.sqrt(v["sh"] * v["sh"] + v["cx"] * v["cx"]),)),
    (("t0",), lambda m, v: (v["conf"] / (1 - _E2),)),
    *_newton("t0", "t1"),
    *_newton("t1", "t2"),
    *_newton("t2", "t3"),
    (
        ("lon", "lat"),
        lambda m, v: (v["meridian"] + m.degrees(m.atan2(v["sh"], v["cx"])), m.degrees(m.atan(v["t3"]))),
    ),
]


class _Seen(dict):
    """Values that note which names are read."""

    def __init__(self, names: list[str]) -> None:
        super().__init__(dict.fromkeys(names, 0.1))
        self.read: set[str] = set()

    def __getitem__(self, name: str) -> float:
        self.read.add(name)
        return super().__getitem__(name)


def _reads(steps: list[_Step], inputs: list[str]) -> list[set[str]]:
    """The names each step reads."""
    reads, known = [], list(inputs)
    for names, values in steps:
        seen = _Seen(known)
        values(math, seen)
        reads.append(seen.read)
        known += names
    return reads


def _bound(steps: list[_Step], inputs: dict[str, Column]) -> Column:
    """The steps as one column: a struct of the values of the last step."""
    reads = _reads(steps, list(inputs))

    def after(number: int, known: list[str]) -> tuple[list[str], Callable[[Column], Column]]:
        names, values = steps[number]
        later = set().union(*reads[number + 1 :])
        kept = [k for k in known if k in later]

        def body(s: Column) -> Column:
            fresh = dict(zip(names, values(F, {k: s[k] for k in reads[number]})))
            return F.struct(*[s[k].alias(k) for k in kept], *[e.alias(k) for k, e in fresh.items()])

        return [*kept, *names], body

    known = list(inputs)
    value = F.struct(*[e.alias(k) for k, e in inputs.items()])
    for number in range(len(steps)):
        known, body = after(number, known)
        value = let(value, body)
    return value


def _on_frame(df: DataFrame, steps: list[_Step], inputs: dict[str, Column], outputs: dict[str, str]) -> DataFrame:
    keep = [F.col(f"`{c}`") for c in df.columns if c not in outputs.values()]
    bound = df.withColumn("_utm", _bound(steps, inputs))
    return bound.select(*keep, *[F.col(f"_utm.{k}").alias(c) for k, c in outputs.items()])


def utm_zone(lon: Column) -> Column:
    """Zone number 1..60 (61 at exactly 180°E, which callers refuse)."""
    return ((lon + 180.0) / 6.0).cast("int") + 1


def utm_zone_point(lon: float, lat: float) -> tuple[int, bool]:
    """(zone, south) of a point; refuses longitudes outside the sixty zones."""
    zone = int((lon + 180.0) / 6.0) + 1
    if not 1 <= zone <= 60:
        raise ValueError(f"no UTM zone for longitude {lon}")
    return zone, lat < 0


def _frame_of(zone: Column | int, south: Column | bool) -> dict[str, Column]:
    zone = F.lit(zone) if isinstance(zone, int) else zone
    south = F.lit(south) if isinstance(south, bool) else south
    return {
        "meridian": (zone * 6 - 183).cast("double"),
        "shift": F.when(south, F.lit(UTM_FALSE_NORTHING_SOUTH)).otherwise(F.lit(0.0)),
    }


def utm_forward(
    df: DataFrame,
    zone: Column | int,
    south: Column | bool = False,
    lon: str = "lon",
    lat: str = "lat",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Add UTM metres ``x``, ``y`` in the given zone; no shuffle."""
    inputs = {"lon": F.col(lon), "lat": F.col(lat)} | _frame_of(zone, south)
    return _on_frame(df, _FORWARD, inputs, {"x": x, "y": y})


def utm_inverse(
    df: DataFrame,
    zone: Column | int,
    south: Column | bool = False,
    x: str = "x",
    y: str = "y",
    lon: str = "lon",
    lat: str = "lat",
) -> DataFrame:
    """Add ``lon``, ``lat`` degrees from UTM metres in the given zone."""
    inputs = {"x": F.col(x), "y": F.col(y)} | _frame_of(zone, south)
    return _on_frame(df, _INVERSE, inputs, {"lon": lon, "lat": lat})


def utm_forward_point(lon: float, lat: float, zone: int, south: bool) -> tuple[float, float]:
    """UTM metres of one position, on the driver."""
    values: dict[str, Any] = {
        "lon": lon,
        "lat": lat,
        "meridian": zone * 6 - 183.0,
        "shift": UTM_FALSE_NORTHING_SOUTH if south else 0.0,
    }
    for names, step in _FORWARD:
        values |= zip(names, step(math, values))
    return values["x"], values["y"]
