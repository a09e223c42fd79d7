"""The zone layer: polygons as edges, and an adaptive quadtree over them.

A layer may have rings of any number of vertices. Its edges stay rows; a square that holds more
than a few of them is split, two levels of a quadtree at a time, until every leaf holds at most that
many. A point finds its leaf by equal keys and tests the leaf's own edges only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Different edges in a leaf, at most.
MOST_EDGES = 8
#: Squares along a side of a split one.
FAN = 4
#: Splits at most: with 10, leaves are a millionth of the layer wide. Edges closer than that stay together.
MOST_LEVELS = 10
EDGE = ["x1", "y1", "x2", "y2"]
NODE = ["ix", "iy"]
BOUNDS = ["left", "right", "low", "high"]


def zones_from_vertices(vertices: DataFrame) -> DataFrame:
    """``(zone_id, ring_id, seq, x, y)`` to edges ``(zone_id, x1, y1, x2, y2)``; rings are closed if they are not.

    Holes and separate parts follow from the even-odd rule over all rings of a zone. An edge
    between equal points bounds nothing and is left out.
    """
    ring = Window.partitionBy("zone_id", "ring_id").orderBy("seq")
    following = lambda c: F.coalesce(F.lead(c).over(ring), F.first(c).over(ring))
    return (
        vertices.select("zone_id", F.col("x").alias("x1"), F.col("y").alias("y1"), following("x").alias("x2"), following("y").alias("y2"))
        .where("x1 <> x2 or y1 <> y2")
    )


def crosses(edge, x: Column, y: Column) -> Column:
    """The ray from (x, y) towards +x crosses the edge."""
    at_y = (edge["x2"] - edge["x1"]) * (y - edge["y1"]) / (edge["y2"] - edge["y1"]) + edge["x1"]
    return ((edge["y1"] > y) != (edge["y2"] > y)) & (x < at_y)


def _turns(edge, right, x: Column, y: Column) -> Column:
    """Whether the edge changes the parity at (x, y) of a square that ends at ``right``.

    Behind the square the ray meets edges that the square doesn't hold. How many of them it meets,
    odd or even, changes with y only where one of them joins an edge that the square holds, that is
    at the ends which those have beyond ``right``: each counts if it lies above y.
    """
    beyond = lambda k: (edge[f"x{k}"] > right) & (edge[f"y{k}"] > y)
    return crosses(edge, x, y) != (beyond(1) != beyond(2))


@dataclass(frozen=True)
class ZoneIndex:
    """``leaves``: ``(level, ix, iy, candidates)``, tiling a square with its lower left corner at (``x``, ``y``).

    A candidate is a zone with its edges in the leaf, and ``odd``: what to add to their turns. A
    leaf wholly inside a zone has no edge of it and is odd.
    """

    x: float
    y: float
    side: float
    levels: tuple[int, ...]
    leaves: DataFrame

    def keys(self, lon: str, lat: str) -> Column:
        """The squares that hold a position, one of each level that has leaves; one null outside the layer."""
        along, up = (F.col(lon) - self.x) / self.side, (F.col(lat) - self.y) / self.side
        at = lambda t, level: F.floor(t * float(FAN**level)).alias("i")
        squares = F.array(*[F.struct(F.lit(n).alias("level"), at(along, n).alias("ix"), at(up, n).alias("iy")) for n in self.levels])
        within = (along >= 0) & (along < 1) & (up >= 0) & (up < 1)
        return F.when(within, squares).otherwise(F.array(F.lit(None)))

    def right_of(self, level: Column, ix: Column) -> Column:
        """Where a square ends, padded."""
        width = self.side / F.pow(F.lit(float(FAN)), level)
        return self.x + (ix + 1) * width + width * PAD


#: Part of a square's width by which it is padded against rounding; the test itself is exact.
PAD = 1e-6


def inside(candidate: Column, right: Column, x: Column, y: Column) -> Column:
    """The position, in the leaf ending at ``right``, is in the candidate zone."""
    above = lambda e: (e["y1"] > y) | (e["y2"] > y)  # noqa: E731  # other edges never turn
    turns = F.size(F.filter(candidate["edges"], lambda e: above(e) & _turns(e, right, x, y))) % 2 == 1
    return candidate["odd"] != turns


def _meets(square: Column) -> Column:
    """The row's edge meets the square; an edge a little outside may count too."""
    low_x, high_x, low_y, high_y = (square[c] for c in BOUNDS)
    boxes = (
        (F.greatest("x1", "x2") >= low_x) & (F.least("x1", "x2") <= high_x)
        & (F.greatest("y1", "y2") >= low_y) & (F.least("y1", "y2") <= high_y)
    )
    side_of = lambda cx, cy: (F.col("x2") - F.col("x1")) * (cy - F.col("y1")) - (F.col("y2") - F.col("y1")) * (cx - F.col("x1"))
    corners = [side_of(cx, cy) for cx in (low_x, high_x) for cy in (low_y, high_y)]
    return boxes & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)


def _overfull(nodes: DataFrame, most: int) -> DataFrame:
    """Nodes with more than ``most`` different edges, unless all of them end in one point, which no split parts."""
    inner = lambda k: (F.col(f"x{k}") >= F.col("left")) & (F.col(f"x{k}") <= F.col("right")) & (F.col(f"y{k}") >= F.col("low")) & (F.col(f"y{k}") <= F.col("high"))
    first, second = [F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in (1, 2)]
    ends = F.filter(F.array(F.when(inner(1), first), F.when(inner(2), second)), lambda p: p.isNotNull())
    edge = F.struct(F.least(first, second).alias("a"), F.greatest(first, second).alias("b"))
    counted = (
        nodes.where("x1 is not null").withColumns({"ends": ends, "edge": F.xxhash64(edge)})
        .groupBy(*NODE).agg(
            F.count_distinct("edge").alias("n"), F.min(F.size("ends")).alias("fewest"),
            F.min(F.array_min("ends")).alias("first"), F.max(F.array_max("ends")).alias("last"))
    )
    one_point = (F.col("fewest") == 1) & (F.col("first") == F.col("last"))
    return counted.where((F.col("n") > most) & ~one_point).select(*NODE)


def _children(nodes: DataFrame, x0: float, y0: float, width: float) -> DataFrame:
    """The next level's squares of ``width``: a row per zone and edge in them; squares without any have one row with neither."""
    pad = width * PAD

    def square(step: Column) -> Column:
        ix, iy = F.col("ix") * FAN + step % FAN, F.col("iy") * FAN + F.floor(step / FAN)
        left, low = x0 + ix * width, y0 + iy * width
        parts = {"ix": ix, "iy": iy, "left": left - pad, "right": left + width + pad, "low": low - pad, "high": low + width + pad,
                 "x": left + width / 2, "y": low + width / 2}
        return F.struct(*[v.alias(c) for c, v in parts.items()])

    squares = F.explode(F.transform(F.sequence(F.lit(0), F.lit(FAN * FAN - 1)), square)).alias("s")
    split = nodes.select("zone_id", "odd", *EDGE, F.col("right").alias("parent_right"), squares)
    split = split.withColumn("met", F.col("x1").isNotNull() & _meets(F.col("s")))
    here = [F.col(f"s.{c}").alias(c) for c in (*NODE, *BOUNDS)]
    edge = {c: F.col(c) for c in EDGE}
    # the parity at the centre by the parent's edges, less the turns of the square's own
    turn = lambda right: _turns(edge, right, F.col("s.x"), F.col("s.y")).cast("int")
    both = F.when(F.col("met"), turn(F.col("s.right"))).otherwise(0) + turn(F.col("parent_right"))
    turns = F.coalesce(F.sum(F.when(F.col("x1").isNotNull(), both)), F.lit(0)) % 2 == 1
    zones = split.groupBy(*here[:2], "zone_id").agg((F.max("odd") != turns).alias("odd"), F.bool_or("met").alias("holds"))
    zones = zones.where(F.col("zone_id").isNotNull() & (F.col("holds") | F.col("odd"))).drop("holds")
    held = split.where("met").select(*here[:2], "zone_id", *EDGE)
    whole = nodes.groupBy(*NODE).agg(F.lit(1)).select(squares).select(*here)
    return whole.join(zones.join(held, [*NODE, "zone_id"], "left"), NODE, "left").select(*NODE, "zone_id", "odd", *EDGE, *BOUNDS)


def zone_index(zones: DataFrame, most_edges: int = MOST_EDGES) -> ZoneIndex:
    """The quadtree over ``zones``, the edges of :func:`zones_from_vertices`; each level and the leaves are written.

    A square is split while it holds more than ``most_edges`` different edges. Whether a leaf's
    centre is in a zone follows, level by level, from the parent's edges alone; no edge is ever
    compared with all squares. The driver sees one row per level.
    """
    box = zones.agg(*[f(F.least(f"{a}1", f"{a}2") if f is F.min else F.greatest(f"{a}1", f"{a}2")) for a in "xy" for f in (F.min, F.max)], F.count("*")).first()
    low_x, high_x, low_y, high_y = (0.0 if v is None else v for v in box[:4])
    side = max(high_x - low_x, high_y - low_y, 1e-6) * 1.001
    x0, y0 = low_x - side / 4096, low_y - side / 4096
    corner = {"left": x0, "right": x0 + side, "low": y0, "high": y0 + side}
    level = zones.select(
        F.lit(0).cast("bigint").alias("ix"), F.lit(0).cast("bigint").alias("iy"), "zone_id", F.lit(False).alias("odd"), *EDGE,
        *[F.lit(v).alias(c) for c, v in corner.items()])
    leaves = []
    for n in range(MOST_LEVELS + 1):
        at_level = F.lit(n).alias("level")
        if n == MOST_LEVELS or box[4] <= most_edges:
            leaves.append(level.select("*", at_level))
            break
        level = materialize(level, "zone-level")
        full = materialize(_overfull(level, most_edges), "zone-split")
        leaves.append(level.join(full, NODE, "left_anti").select("*", at_level))
        if full.isEmpty():
            break
        level = _children(level.join(full, NODE, "left_semi"), x0, y0, side / FAN ** (n + 1))
    rows = reduce(DataFrame.unionByName, leaves)
    per_zone = rows.groupBy("level", *NODE, "zone_id").agg(
        F.first("odd").alias("odd"), F.collect_list(F.when(F.col("x1").isNotNull(), F.struct(*EDGE))).alias("edges"))
    candidates = F.collect_list(F.when(F.col("zone_id").isNotNull(), F.struct("zone_id", "odd", "edges"))).alias("candidates")
    index = materialize(per_zone.groupBy("level", *NODE).agg(candidates), "zone-index")
    return ZoneIndex(x0, y0, side, tuple(sorted(r["level"] for r in index.select("level").distinct().collect())) or (0,), index)
