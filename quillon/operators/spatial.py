"""Point-in-area join on grids whose cells follow the areas, with built-in expressions only.

An area's cells are as large as its shorter side (a sixteenth of the longer one at least), halved as often as its number of edges
asks for, so that a cell of a border with very many edges has few of them. A cell without an edge is inside the area or not as a whole: a point there needs no
polygon test. A point looks up one cell per cell size in use, which makes the join an equi-join. Cells whose total size is found to
be small are broadcast; others are shuffled, and a cell crowded with points is spread over as many tasks as it needs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions import column
from quillon.operators.params import skew_join
from quillon.session import materialize

BROADCAST_BYTES = 64 * 1024 * 1024
BYTES_PER_EDGE, BYTES_PER_CELL = 40, 200
# Cells along the longer side of an area are halved until there are as many as a quarter of the root of its edges.
EDGES_PER_CELL, MOST_HALVINGS = 4, 10
# Cells are squares; a long and narrow area has at most about so many of them along its longer side before halving.
MOST_ALONG = 16

RING_TYPE = "array<array<struct<x:double,y:double>>>"


def with_bounds(areas: DataFrame, geometry: str = "the_geom") -> DataFrame:
    """Append the bounding box ``min_x, min_y, max_x, max_y`` of a ring array."""
    points = F.flatten(column(geometry))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return areas.select(
        "*", F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"),
        F.array_max(ys).alias("max_y"))


def edges_of(rings: Column) -> Column:
    """All edges of all rings as one array; a ring need not repeat its first point."""
    def ring_edges(ring: Column) -> Column:
        closing = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(ring, closing, lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))

    return F.flatten(F.transform(rings, ring_edges))


def strictly_within(x: Column, y: Column, edges: Column) -> Column:
    """Inside by the even-odd rule and on no edge; holes and several parts need no extra care."""
    def turn(e: Column) -> Column:
        return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])

    def on_edge(e: Column) -> Column:
        return (
            (turn(e) == 0.0)
            & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    def crossed(e: Column) -> Column:
        # the ray to the right crosses when the edge spans y and the point lies to its left
        upward = e["y2"] > e["y1"]
        return ((e["y1"] > y) != (e["y2"] > y)) & F.when(upward, turn(e) > 0.0).otherwise(turn(e) < 0.0)

    return (F.size(F.filter(edges, crossed)) % 2 == 1) & ~F.exists(edges, on_edge)


def area_cells(areas: DataFrame, geometry: str = "the_geom") -> DataFrame:
    """The cells of each area: ``__level, __cx, __cy`` (cells of side 2**level), ``__inner``, ``__edges`` and the other columns.

    An inner cell lies within the area and has no edges. A border cell has the edges of its row of cells that do not lie
    to its left: those that a ray from a point of the cell to the right can cross, or that can hold the point.
    """
    wide, high = F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")
    size = F.greatest(F.least(wide, high), F.greatest(wide, high) / MOST_ALONG)
    halvings = F.greatest(F.lit(0), F.least(F.lit(MOST_HALVINGS), F.ceil(F.log2(F.sqrt(F.size("__all")) / EDGES_PER_CELL))))
    level = F.when(size > 0, F.ceil(F.log2(size)) - halvings).cast("int")  # a flat area holds no point at all
    carried = [column(c) for c in areas.columns if c != geometry]
    at, side = F.col("__level"), F.pow(F.lit(2.0), F.col("__level"))
    prepared = with_bounds(areas, geometry).withColumn("__all", edges_of(column(geometry))).withColumn("__level", level).where(at.isNotNull())

    def span(e: Column, axis: str) -> tuple[Column, Column]:
        return F.least(e[f"{axis}1"], e[f"{axis}2"]), F.greatest(e[f"{axis}1"], e[f"{axis}2"])

    bottom, left = F.col("__cy") * side, F.col("__cx") * side
    rows = prepared.withColumn("__cy", F.explode(F.sequence(_cell(F.col("min_y"), at), _cell(F.col("max_y"), at)))).withColumn(
        "__row", F.filter("__all", lambda e: (span(e, "y")[1] >= bottom) & (span(e, "y")[0] <= bottom + side))).drop("__all", geometry)
    cells = rows.withColumn("__cx", F.explode(F.sequence(_cell(F.col("min_x"), at), _cell(F.col("max_x"), at))))
    touched = F.exists("__row", lambda e: (span(e, "x")[1] >= left) & (span(e, "x")[0] <= left + side))
    marked = cells.withColumn("__touched", touched).withColumn(
        "__inner", ~F.col("__touched") & strictly_within(left + side / 2, bottom + side / 2, F.col("__row")))
    edges = F.when(F.col("__touched"), F.filter("__row", lambda e: span(e, "x")[1] >= left)).otherwise(F.slice("__row", 1, 0))
    return marked.where(F.col("__touched") | F.col("__inner")).select("__level", "__cx", "__cy", "__inner", edges.alias("__edges"), *carried)


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("bigint")


def link_points_areas(
    points: DataFrame, areas: DataFrame, x: str = "longitude", y: str = "latitude", geometry: str = "the_geom",
    key: str | None = None, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join every point to every area it lies strictly within.

    Points without coordinates and points in no area drop out; a point on a boundary is in neither
    area. The columns of ``areas`` other than the geometry are appended. ``key`` is accepted and not needed:
    points at one place are spread by their place in the input.
    """
    placed = materialize(area_cells(areas, geometry))
    found = placed.agg(F.sum(BYTES_PER_CELL + BYTES_PER_EDGE * F.size("__edges")).alias("bytes"), F.collect_set("__level").alias("levels")).first()
    levels = sorted(found["levels"])  # exponents of doubles: two thousand at most
    px, py = column(x), column(y)
    looked_up = F.array(*[F.lit(v) for v in levels]) if levels else F.array().cast("array<int>")
    located = points.where(px.isNotNull() & py.isNotNull()).withColumn("__level", F.explode(looked_up))
    located = located.withColumns({"__cx": _cell(px, F.col("__level")), "__cy": _cell(py, F.col("__level"))})
    keys = ["__level", "__cx", "__cy"]
    few = (found["bytes"] or 0) <= broadcast_bytes
    candidates = located.join(F.broadcast(placed), keys) if few else skew_join(located, placed, keys, "inner")
    return candidates.where(F.col("__inner") | strictly_within(px, py, F.col("__edges"))).select(
        *[column(c) for c in points.columns], *[column(c) for c in areas.columns if c != geometry])


def numbered_shapes(areas: DataFrame, geometry: str = "the_geom") -> DataFrame:
    """The different geometries of the areas, each with a number ``__shape``."""
    different = areas.select(column(geometry)).where(column(geometry).isNotNull()).distinct()
    return materialize(different.withColumn("__shape", F.monotonically_increasing_id()))


def aggregate_in_areas(
    points: DataFrame, areas: DataFrame, measures: Mapping[str, tuple[Column, Callable[[str], Column]]], x: str = "longitude",
    y: str = "latitude", geometry: str = "the_geom",
) -> DataFrame:
    """Aggregates of the points strictly within each area, for areas with one at least; areas keep their other columns.

    ``measures`` has, for each column, an aggregate of points and the function that merges its values. Points at one place are
    one row in the join, and so are areas of one shape: the work follows the different places and shapes.
    """
    shapes = numbered_shapes(areas, geometry)
    known = points.where(column(x).isNotNull() & column(y).isNotNull())
    places = known.groupBy(column(x).alias("__x"), column(y).alias("__y")).agg(*[part.alias(name) for name, (part, _) in measures.items()])
    linked = link_points_areas(places, shapes, "__x", "__y", geometry)
    found = linked.groupBy("__shape").agg(*[merge(name).alias(name) for name, (_, merge) in measures.items()])
    return areas.join(shapes, geometry).drop(geometry).join(found, "__shape").drop("__shape")


def groups_in_areas(
    points: DataFrame, areas: DataFrame, groups: Sequence[str], key: str, x: str = "longitude", y: str = "latitude",
    geometry: str = "the_geom",
) -> DataFrame:
    """How many different ``groups`` values have a point strictly within the areas of each key: ``key, groups[1:]..., n``.

    ``n`` counts the values of the first column for each combination of the others; rows with a missing key or group are left out.
    Keys with the same shapes are one row in the join.
    """
    named = areas.dropna(subset=[key])
    shapes = numbered_shapes(named, geometry)
    owned = named.join(shapes, geometry).select(column(key), "__shape").distinct().groupBy(column(key)).agg(F.sort_array(F.collect_list("__shape")).alias("__shapes"))
    owned = materialize(owned)
    units = materialize(owned.select("__shapes").distinct().withColumn("__unit", F.monotonically_increasing_id()))
    drawn = units.select("__unit", F.explode("__shapes").alias("__shape")).join(shapes, "__shape").select("__unit", column(geometry))
    known = points.dropna(subset=list(groups)).where(column(x).isNotNull() & column(y).isNotNull())
    places = known.select(column(x).alias("__x"), column(y).alias("__y"), *map(column, groups)).distinct()
    linked = link_points_areas(places, drawn, "__x", "__y", geometry)
    others = [column(c) for c in groups[1:]]
    counts = linked.select("__unit", *map(column, groups)).distinct().groupBy("__unit", *others).agg(F.count(F.lit(1)).alias("n"))
    # one row per unit, and as many more per key as it has combinations of the other columns
    return owned.join(units, "__shapes").select(column(key), "__unit").join(counts, "__unit").select(column(key), *others, "n")
