"""Distances between coordinate rows as Column expressions, all inside code generation.

Rows are arrays of doubles, x first. Every distance is an int.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayframe.schemas import FormatError, UnsupportedFeatureError

Distance = Callable[[Column, Column], Column]
#: The value of pi that the format prescribes.
PI, EARTH = 3.141592, 6378.388


def nint_trunc(x: Column) -> Column:
    """x + 0.5 without its fraction (toward zero, as for costs)."""
    return (x + F.lit(0.5)).cast("int")


def nint_floor(x: Column) -> Column:
    """The floor of x + 0.5 (as for stored matrices); differs below zero."""
    return F.floor(x + F.lit(0.5)).cast("int")


def _d(a: Column, b: Column, i: int) -> Column:
    return F.get(a, F.lit(i)) - F.get(b, F.lit(i))


def _euclid(n: int) -> Distance:
    return lambda a, b: F.sqrt(sum((_d(a, b, i) * _d(a, b, i) for i in range(1, n)), _d(a, b, 0) * _d(a, b, 0)))


def euc(n: int) -> Distance:
    return lambda a, b: nint_trunc(_euclid(n)(a, b))


def euc_real(n: int) -> Distance:
    """The unrounded distance, which some libraries of instances use."""
    return _euclid(n)


def ceil_2d(a: Column, b: Column) -> Column:
    return F.ceil(_euclid(2)(a, b)).cast("int")


def man(n: int) -> Distance:
    return lambda a, b: nint_trunc(sum((F.abs(_d(a, b, i)) for i in range(1, n)), F.abs(_d(a, b, 0))))


def max_(n: int) -> Distance:
    return lambda a, b: F.greatest(*(nint_trunc(F.abs(_d(a, b, i))) for i in range(n)))


def radians(v: Column, compat: bool = False) -> Column:
    """Degrees and minutes (ddd.mm) to radians.

    The format cuts the degrees toward zero; compat rounds them, as some
    programs do, which moves published optima.
    """
    degrees = nint_trunc(v) if compat else v.cast("int")
    return F.lit(PI) * (degrees + F.lit(5.0) * (v - degrees) / F.lit(3.0)) / F.lit(180.0)


def geo(mode: str = "spec") -> Distance:
    def distance(a: Column, b: Column) -> Column:
        compat = mode == "compat"
        (la, oa), (lb, ob) = ((radians(F.get(p, F.lit(0)), compat), radians(F.get(p, F.lit(1)), compat)) for p in (a, b))
        q1, q2, q3 = F.cos(oa - ob), F.cos(la - lb), F.cos(la + lb)
        inner = F.lit(0.5) * ((F.lit(1.0) + q1) * q2 - (F.lit(1.0) - q1) * q3)
        return (F.lit(EARTH) * F.acos(F.least(F.greatest(inner, F.lit(-1.0)), F.lit(1.0))) + F.lit(1.0)).cast("int")

    return distance


def att(a: Column, b: Column) -> Column:
    dx, dy = _d(a, b, 0), _d(a, b, 1)
    r = F.sqrt((dx * dx + dy * dy) / F.lit(10.0))
    t = nint_trunc(r)
    return F.when(t < r, t + 1).otherwise(t)


def xray(sx: float, sy: float, sz: float) -> Distance:
    """Crystallography: the slowest of three motors, the first on a circle of 360 degrees."""

    def distance(a: Column, b: Column) -> Column:
        dx, dy, dz = (F.abs(_d(a, b, i)) for i in range(3))
        turn = F.least(dx, F.abs(dx - F.lit(360.0)))
        return nint_trunc(F.lit(100.0) * F.greatest(turn / F.lit(sx), dy / F.lit(sy), dz / F.lit(sz)))

    return distance


DISTANCES: dict[str, Distance] = {
    "EUC_2D": euc(2),
    "EUC_3D": euc(3),
    "CEIL_2D": ceil_2d,
    "MAN_2D": man(2),
    "MAN_3D": man(3),
    "MAX_2D": max_(2),
    "MAX_3D": max_(3),
    "GEO": geo(),
    "ATT": att,
    "XRAY1": xray(1.0, 1.0, 1.0),
    "XRAY2": xray(1.25, 1.5, 1.15),
}


def supported_weight_types() -> frozenset[str]:
    return frozenset(DISTANCES) | {"EXPLICIT"}


def distance_for(weight_type: str | None, special: Distance | None = None, geo_mode: str = "spec") -> Distance:
    """The distance of a weight type named on the driver, in any case of letters."""
    weight_type = weight_type.upper() if weight_type else weight_type
    if weight_type == "SPECIAL":
        if special is None:
            raise UnsupportedFeatureError("SPECIAL weights need a distance of the caller's")
        return special
    if special is not None:
        raise ValueError("a distance of the caller's only goes with SPECIAL weights")
    if weight_type == "GEO":
        return geo(geo_mode)
    if weight_type not in DISTANCES:
        raise FormatError(f"unknown weight type {weight_type!r}")
    return DISTANCES[weight_type]


def distance_by(weight_type: Column, a: Column, b: Column, geo_mode: str = "spec") -> Column:
    """The distance whose weight type is a column; null for types without one."""
    out = F.lit(None).cast("int")
    for name in DISTANCES:
        out = F.when(F.upper(weight_type) == name, distance_for(name, None, geo_mode)(a, b)).otherwise(out)
    return out


def route_cost(route: Column, cost: Callable[[Column, Column], Column], depot: int | None = None, close: bool = True) -> Column:
    """Sum over consecutive nodes and, unless the last is the first, back to the first; 0 below two nodes. With depot, legs from and to it are included."""
    nodes = route if depot is None else F.concat(F.array(F.lit(depot)), route)
    first = F.slice(nodes, 1, 1)
    if close:
        nodes = F.when(F.get(nodes, F.lit(0)) != F.element_at(nodes, -1), F.concat(nodes, first)).otherwise(nodes)
    n = F.greatest(F.size(nodes) - 1, F.lit(0))
    legs = F.zip_with(F.slice(nodes, 1, n), F.slice(nodes, 2, n), lambda i, j: cost(i, j).cast("double"))
    return F.when(n > 0, F.aggregate(legs, F.lit(0.0), lambda s, x: s + x)).otherwise(F.lit(0.0))


def routes_cost(routes: Column, coords: Column | None, matrix: Column | Callable[[Column, Column], Column] | None, weight_type: str | Column | None, special: Distance | None = None, depot: int | None = None, rounded: bool = True, geo_mode: str = "spec") -> Column:
    """Total cost of 0-based routes. A matrix goes before coordinates; null where there is neither. It may be given by its cells, as a function of (i, j)."""
    if isinstance(weight_type, str):
        weight_type = weight_type.upper()
    by_matrix = matrix if not isinstance(matrix, Column) else lambda i, j: F.get(F.get(matrix, i), j)

    def by_coords(i: Column, j: Column) -> Column:
        a, b = F.get(coords, i), F.get(coords, j)
        if isinstance(weight_type, Column):
            return distance_by(weight_type, a, b, geo_mode)
        if not rounded and weight_type in ("EUC_2D", "EUC_3D"):
            return euc_real(int(weight_type[4]))(a, b)
        return distance_for(weight_type, special, geo_mode)(a, b)

    total = lambda cost: F.aggregate(F.transform(routes, lambda r: route_cost(r, cost, depot)), F.lit(0.0), lambda s, x: s + x)
    out = F.lit(None).cast("double")
    if coords is not None and weight_type is not None and not (isinstance(weight_type, str) and weight_type == "EXPLICIT"):
        out = F.when(coords.isNotNull(), total(by_coords))
    if isinstance(matrix, Column):
        out = F.when(matrix.isNotNull(), total(by_matrix)).otherwise(out)
    elif matrix is not None:
        out = F.coalesce(total(by_matrix), out)
    return out
