"""Points, polygons and their text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Slack for points on an edge.
EDGE = 1e-9


def wkt_point(x: Column, y: Column) -> Column:
    """POINT(x y); null if a coordinate is."""
    return F.when(x.isNotNull() & y.isNotNull(), F.concat(F.lit("POINT("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")")))


def ring_contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether a ring, array<struct<x, y>>, holds a point: on an edge counts as inside, else by parity of crossings."""
    n = F.size(ring)

    def edge(a: Column, b: Column) -> Column:
        ax, ay, bx, by = a["x"], a["y"], b["x"], b["y"]
        cross = (x - ax) * (by - ay) - (y - ay) * (bx - ax)
        on = (F.abs(cross) <= EDGE) & (x >= F.least(ax, bx) - EDGE) & (x <= F.greatest(ax, bx) + EDGE) & (y >= F.least(ay, by) - EDGE) & (y <= F.greatest(ay, by) + EDGE)
        span = F.when(by == ay, F.lit(None).cast("double")).otherwise(by - ay)
        crosses = ((ay > y) != (by > y)) & F.coalesce(x < (bx - ax) * (y - ay) / span + ax, F.lit(False))
        return F.when(on, F.lit(1000000)).otherwise(crosses.cast("int"))

    # Each point meets the one before it; values that a lambda names are computed once, not once a use.
    before = F.concat(F.slice(ring, -1, 1), F.slice(ring, F.lit(1), F.greatest(n - 1, F.lit(0))))
    inside = F.aggregate(F.zip_with(ring, before, edge), F.lit(0), lambda s, v: s + v, lambda t: (t >= 1000000) | (t % 2 == 1))
    return F.when(n < 3, F.lit(False)).otherwise(inside)


def rings_contain(rings: Column, x: Column, y: Column) -> Column:
    """Even-odd over rings, so a hole takes away what its outer ring holds, its edge included."""
    inside = F.aggregate(F.transform(rings, lambda r: ring_contains(r, x, y).cast("int")), F.lit(0), lambda s, v: s + v)
    return inside % 2 == 1
