"""Which region a point lies in: first match by polygon order, then country polygons, else an error.

A few polygons (their number and points are checked) stay on every executor, and each point is tested
against all. Any larger number is indexed by cells: each polygon is covered by cells of a width that
fits its size, points meet polygons by an equi-join on cells, and only cells that an edge touches need
a test of the rings. Points meet very many polygons in rounds, in the order of the polygons: a point that
has found one leaves, and only polygons near the points that are left are written down and covered. A resolver is any function from points to points with the resolution columns, so
callers can pass another one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import rings_contain
from ..functions.projection import with_plane
from . import materialize
from .materialize import broadcast_if_few, cut_lineage

Resolver = Callable[[DataFrame], DataFrame]
POLYGON_SCHEMA = "tier int, ordinal int, name string, prefix string, xmin double, ymin double, xmax double, ymax double, rings array<array<struct<x:double,y:double>>>"
ORDER = ["tier", "ordinal", "name", "prefix"]
#: Tiers of polygons, in the order in which they are tried.
VALLEY, POLAND, SLOVAKIA = 0, 1, 2
#: Polygons, and points of their rings, up to which each point is tested against all polygons.
FEW_POLYGONS, FEW_POINTS = 32, 100_000
#: Points of rings that may be broadcast to the candidates (some 32 MB).
BROADCAST_POINTS = 1_000_000
#: Polygons that points meet in the first round, and how many times more each further round takes.
ROUND_POLYGONS, ROUND_GROWTH = 100_000, 8
#: Cells along the longer side of a polygon; their width is a power of two within these exponents.
CELLS_A_SIDE, LEVELS = 8, (-20, 40)
#: Distance from an edge within which a point is never taken for inside or outside without the rings.
MARGIN = 1e-3


#: What holds of the bounds of polygons that can hold a point.
BOUNDED = "xmin <= xmax and ymin <= ymax and abs(xmin) < 1e15 and abs(ymin) < 1e15 and abs(xmax) < 1e15 and abs(ymax) < 1e15"


def longer_side() -> Column:
    return F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), F.lit(2.0 ** LEVELS[0]))


def bounds_hold(x: Column, y: Column) -> Column:
    return (x >= F.col("xmin")) & (x <= F.col("xmax")) & (y >= F.col("ymin")) & (y <= F.col("ymax"))


def ring_points(rings: Column) -> Column:
    return F.aggregate(F.transform(rings, F.size), F.lit(0).cast("long"), lambda s, v: s + v)


@dataclass
class PolygonIndex:
    """Polygons as `first_polygon` asks them: all of a few, or cells of many (`cells` is then set)."""

    polygons: DataFrame
    cells: DataFrame | None = None
    levels: tuple[int, ...] = ()
    bounds: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)


def index_polygons(polygons: DataFrame, few: int = FEW_POLYGONS, asked: DataFrame | None = None) -> PolygonIndex:
    """The index of polygons (POLYGON_SCHEMA); those without bounds or rings hold no point.

    With `asked` points (__x, __y) it serves these only, and cells without any of them are left out where that takes no shuffle.
    """
    sized = polygons.where(BOUNDED).withColumn("points", ring_points(F.col("rings"))).where("points > 0")
    level = F.least(F.greatest(F.ceil(F.log2(longer_side() / CELLS_A_SIDE)), F.lit(LEVELS[0])), F.lit(LEVELS[1])).cast("int")
    rows = cut_lineage(sized.withColumn("pid", F.monotonically_increasing_id()).withColumn("level", level))
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("points"), F.lit(0)).alias("points"), F.collect_set("level").alias("levels"), F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
    if not size.n or size.n <= few and size.points <= FEW_POINTS:
        return PolygonIndex(rows)
    kept = shuffled(rows) if size.points > BROADCAST_POINTS else F.broadcast(rows)
    known = None if asked is None else few_cells(asked, size.levels)
    return PolygonIndex(kept, broadcast_if_few(cell_cover(rows, known), shuffled), tuple(sorted(size.levels)), tuple(size[3:7]))


def shuffled(rows: DataFrame) -> DataFrame:
    """For joins that must not broadcast these rows: sizes that Spark derives from files know nothing of rings and cells made since."""
    return rows.hint("merge")


def few_cells(points: DataFrame, levels: list[int], reach: tuple[int, ...] = (0,)) -> DataFrame | None:
    """(__n, __i, __j) of the cells of each level in which points (__x, __y) lie, or that many cells before them; none if they are more than may be broadcast."""
    if points.count() > materialize.BROADCAST_ROWS:
        return None
    at = lambda v, n, d: F.floor(F.col(v) / 2.0**n - d).cast("long")
    cells = F.array(*(F.struct(F.lit(n).alias("__n"), at("__x", n, di).alias("__i"), at("__y", n, dj).alias("__j")) for n in levels for di in reach for dj in reach))
    known = cut_lineage(points.select(F.explode(cells).alias("c")).select("c.*").distinct().limit(materialize.BROADCAST_ROWS + 1))
    return F.broadcast(known) if known.count() <= materialize.BROADCAST_ROWS else None


def cell_cover(polygons: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(level, i, j, pid, tier, ordinal, name, prefix, whole) for the cells that polygons lie in; `whole` cells lie inside.

    Of `known` cells (__n, __i, __j) only, if they are given. A cell's polygons come down to the first that holds it whole, and those before it with an edge there.
    """
    side = F.pow(F.lit(2.0), F.col("level"))
    cell = lambda v: F.floor(v / F.col("side")).cast("long")
    own = polygons.withColumn("side", side).select("*", cell(F.col("xmin")).alias("i0"), cell(F.col("xmax")).alias("i1"), cell(F.col("ymin")).alias("j0"), cell(F.col("ymax")).alias("j1"))
    held = lambda d: d if known is None else d.join(known, (F.col("level") == F.col("__n")) & (F.col("i") == F.col("__i")) & (F.col("j") == F.col("__j")), "left_semi")

    # Edges meet the cells that they may touch.
    ring = F.explode("rings").alias("ring")
    edges = own.select("pid", "level", "side", "i0", "i1", "j0", "j1", ring).where("size(ring) > 0").select("*", F.posexplode("ring").alias("k", "a"))
    before = F.get("ring", F.when(F.col("k") == 0, F.size("ring") - 1).otherwise(F.col("k") - 1))
    edges = edges.select("pid", "level", "side", "i0", "i1", "j0", "j1", "a.x", "a.y", before["x"].alias("x2"), before["y"].alias("y2")).where("abs(x) < 1e15 and abs(y) < 1e15 and abs(x2) < 1e15 and abs(y2) < 1e15")
    low = lambda a, b, lo: F.greatest(cell(F.least(a, b) - MARGIN), F.col(lo))
    high = lambda a, b, hi: F.least(cell(F.greatest(a, b) + MARGIN), F.col(hi))
    spans = edges.select("*", low("x", "x2", "i0").alias("ei0"), high("x", "x2", "i1").alias("ei1"), low("y", "y2", "j0").alias("ej0"), high("y", "y2", "j1").alias("ej1")).where("ej0 <= ej1")
    met = held(spans.where("ei0 <= ei1").withColumn("i", F.explode(F.sequence("ei0", "ei1"))).withColumn("j", F.explode(F.sequence("ej0", "ej1"))))
    half = F.col("side") / 2 + MARGIN
    dx, dy = (F.col("x2") - F.col("x")) / 2, (F.col("y2") - F.col("y")) / 2
    mx, my = (F.col("x") + F.col("x2")) / 2 - (F.col("i") + 0.5) * F.col("side"), (F.col("y") + F.col("y2")) / 2 - (F.col("j") + 0.5) * F.col("side")
    touched = met.where(F.abs(mx * dy - my * dx) <= half * (F.abs(dx) + F.abs(dy)) + MARGIN).select("pid", "i", "j").distinct()

    cells = held(own.withColumn("i", F.explode(F.sequence("i0", "i1"))).withColumn("j", F.explode(F.sequence("j0", "j1"))))
    left, bottom = F.col("i") * F.col("side"), F.col("j") * F.col("side")
    within = (left >= F.col("xmin")) & (left + F.col("side") <= F.col("xmax")) & (bottom >= F.col("ymin")) & (bottom + F.col("side") <= F.col("ymax"))
    # A free cell is inside if its centre is: by the parity of the edges that cross the row of centres to the right of it.
    at = (F.col("j") + 0.5) * F.col("side")
    crossing = spans.withColumn("j", F.explode(F.sequence("ej0", "ej1"))).where((F.col("y") > at) != (F.col("y2") > at))
    crossing = crossing.select("pid", "j", ((F.col("x2") - F.col("x")) * (at - F.col("y")) / (F.col("y2") - F.col("y")) + F.col("x")).alias("cross"))
    keep = ["pid", "i", "j", "level", *ORDER, "within"]
    free = cells.withColumn("within", within).withColumn("centre", left + F.col("side") / 2).select(*keep, "centre").join(shuffled(touched), ["pid", "i", "j"], "left_anti")
    inside = shuffled(free).join(crossing, ["pid", "j"]).groupBy(*keep).agg(F.count_if(F.col("cross") > F.col("centre")).alias("n")).where("n % 2 = 1")
    whole = inside.select("level", "i", "j", "pid", *ORDER, F.col("within").alias("whole"))
    partly = shuffled(polygons.select("pid", "level", *ORDER)).join(touched, "pid").select("level", "i", "j", "pid", *ORDER, F.lit(False).alias("whole"))
    cover = cut_lineage(whole.unionByName(partly))
    first = cover.where("whole").groupBy("level", "i", "j").agg(F.min(F.struct(*ORDER)).alias("first"))
    asked = cover.where("not whole").join(shuffled(first), ["level", "i", "j"], "left").where(F.col("first").isNull() | (F.struct(*ORDER) < F.col("first"))).drop("first")
    return asked.unionByName(first.select("level", "i", "j", F.lit(None).cast("long").alias("pid"), "first.*", F.lit(True).alias("whole")))


def first_polygon(points: DataFrame, polygons: DataFrame | PolygonIndex, key: str, x: str, y: str) -> DataFrame:
    """(key, tier, ordinal, name, prefix) of the first polygon in order that holds each point; points in none have no row.

    Points without two finite coordinates lie in none, a point on an edge lies inside, and rows that
    share a key count as one.
    """
    asked = points.select(key, F.col(x).alias("__x"), F.col(y).alias("__y"))
    return first_of_index(asked, polygons, key) if isinstance(polygons, PolygonIndex) else first_in_rounds(asked, polygons, key)


def first_of_index(asked: DataFrame, index: PolygonIndex, key: str) -> DataFrame:
    """`first_polygon` of points (key, __x, __y) among the polygons of an index."""
    inside = bounds_hold(F.col("__x"), F.col("__y")) & rings_contain(F.col("rings"), F.col("__x"), F.col("__y"))
    if index.cells is None:
        hit = asked.join(F.broadcast(index.polygons), inside).select(key, *ORDER)
    else:
        xmin, ymin, xmax, ymax = index.bounds
        levels = F.array(*(F.struct(F.lit(n).alias("level"), F.floor(F.col("__x") / 2.0**n).cast("long").alias("i"), F.floor(F.col("__y") / 2.0**n).cast("long").alias("j")) for n in index.levels))
        probes = asked.where(F.col("__x").between(xmin, xmax) & F.col("__y").between(ymin, ymax)).withColumn("p", F.explode(levels)).select(key, "__x", "__y", "p.*")
        met = probes.join(index.cells, ["level", "i", "j"])
        tested = met.where("not whole").select(key, "__x", "__y", "pid").join(index.polygons, "pid").where(inside)
        hit = met.where("whole").select(key, *ORDER).unionByName(tested.select(key, *ORDER))
    best = hit.groupBy(key).agg(F.min(F.struct(*ORDER)).alias("p"))
    return best.select(key, "p.tier", "p.ordinal", "p.name", "p.prefix")


def first_in_rounds(asked: DataFrame, polygons: DataFrame, key: str) -> DataFrame:
    """`first_polygon` of points (key, __x, __y) among polygons that are read once a round.

    Rounds part the polygons by tier and ordinal, so a polygon of an earlier round comes before all of a later
    one, and a point that has found one needs no other. Where points left are few, so are the polygons near them.
    """
    least = F.lit(-(2**31)).cast("long")
    place = F.coalesce(F.col("tier").cast("long"), least) * 2**32 + (F.coalesce(F.col("ordinal").cast("long"), least) + 2**31)
    # A polygon's bounds reach over two of these cells each way, the slack being for roundings of its width.
    wide = F.ceil(F.log2(longer_side() * 1.000001)).cast("int")
    bounded = polygons.where(BOUNDED)
    size = bounded.agg(F.count("*").alias("n"), F.collect_set(wide).alias("levels"), F.min("xmin"), F.min("ymin"), F.max("xmax"), F.max("ymax")).first()
    if size.n <= ROUND_POLYGONS:
        return first_of_index(asked, index_polygons(polygons), key)
    shares, taken = [], ROUND_POLYGONS
    while taken < size.n:
        shares.append(taken / size.n)
        taken *= ROUND_GROWTH
    ends = [*sorted(set(bounded.agg(F.percentile_approx(place, shares).alias("at")).first().at)), None]
    xmin, ymin, xmax, ymax = size[2:6]
    left = cut_lineage(asked.where(F.col("__x").between(xmin, xmax) & F.col("__y").between(ymin, ymax)))
    found, before = [], None
    for end in ends:
        some = bounded if before is None else bounded.where(place > before)
        some = some if end is None else some.where(place <= end)
        hit = cut_lineage(first_of_index(left, index_polygons(near_points(some, left, wide, size.levels), asked=left), key))
        found.append(hit)
        left = cut_lineage(left.join(shuffled(hit.select(F.col(key).alias("__found"))), F.col(key).eqNullSafe(F.col("__found")), "left_anti"))
        if left.isEmpty():
            break
        before = end
    return reduce(DataFrame.unionByName, found)


def near_points(polygons: DataFrame, points: DataFrame, wide: Column, levels: list[int]) -> DataFrame:
    """The polygons that may hold one of the points, if these lie in few cells; else all, as no polygon is shuffled for this."""
    known = few_cells(points, levels, (0, 1))
    if known is None:
        return polygons
    side = F.pow(F.lit(2.0), wide)
    meets = (wide == F.col("__n")) & (F.floor(F.col("xmin") / side) == F.col("__i")) & (F.floor(F.col("ymin") / side) == F.col("__j"))
    return polygons.join(known, meets, "left_semi")


def on_plane(points: DataFrame) -> DataFrame:
    """Points with x_1992 and y_1992, which they may have already."""
    return points if {"x_1992", "y_1992"} <= set(points.columns) else with_plane(points, "lat", "lon", "x_1992", "y_1992")


def polygon_resolver(polygons: DataFrame) -> Resolver:
    """Resolves (point_id, lat, lon) to the same rows with status, area, prefix, code, message, x_1992, y_1992 and valley.

    Points that come with x_1992 and y_1992 are not placed again. The polygons are indexed once, when they are first asked for.
    """
    known: list[PolygonIndex] = []

    def resolve(points: DataFrame) -> DataFrame:
        placed = on_plane(points)
        if not known:
            known.append(index_polygons(polygons))
        found = first_polygon(placed, known[0], "point_id", "y_1992", "x_1992")
        out = placed.join(found.select("point_id", "tier", "name", F.col("prefix").alias("__prefix")), "point_id", "left")
        tier = F.col("tier")
        return out.select(
            *placed.columns,
            F.when(tier == VALLEY, "ok").when(tier.isNotNull(), "warning").otherwise("error").alias("status"),
            F.when(tier == VALLEY, "valley").when(tier == POLAND, "poland").when(tier == SLOVAKIA, "slovakia").otherwise("outside_pl_sk").alias("area"),
            F.col("__prefix").alias("prefix"),
            F.when(tier == VALLEY, None).when(tier.isNotNull(), "POINT_OUTSIDE_VALLEYS").otherwise("POINT_OUTSIDE_PL_SK").alias("code"),
            F.when(tier == VALLEY, None).when(tier.isNotNull(), "point is in no valley; the country's prefix is used").otherwise("point is in neither country").alias("message"),
            F.when(tier == VALLEY, F.col("name")).alias("valley"),
        )

    return resolve


def constant_resolver(prefix: str = "KSW", valley: str = "Test") -> Resolver:
    """Puts every point into one valley; for tests and for data without polygons."""

    def resolve(points: DataFrame) -> DataFrame:
        none = F.lit(None).cast("string")
        return on_plane(points).select("*", F.lit("ok").alias("status"), F.lit("valley").alias("area"), F.lit(prefix).alias("prefix"), none.alias("code"), none.alias("message"), F.lit(valley).alias("valley"))

    return resolve
