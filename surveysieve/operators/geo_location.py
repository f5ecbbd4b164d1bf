"""Country of a coordinate: a point-in-polygon join over classified grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveysieve.functions.columns import col_
from surveysieve.operators.skew import HOT_ROWS, SMALL_ROWS, is_small, join_lookup, join_per_key
from surveysieve.sources.polygons import polygon_edges
from surveysieve.sources.sinks import stage_table

# Countries tried first where borders overlap.
FIRST_COUNTRIES = ("United States of America", "China", "India")

CELL_DEGREES = 1.0
# Border segments near a cell beyond which it is cut into four, and how often; so a cell may hold more
# only where so many segments come within a thousandth of its width.
CELL_SEGMENTS, CELL_LEVELS = 256, 10


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size)).cast("int")


def _span(low: Column, high: Column, size: float) -> Column:
    return F.explode(F.sequence(_cell(low, size), _cell(high, size)))


def _grid(edges: DataFrame, country: list[str], size: float) -> tuple[DataFrame, DataFrame]:
    """Border segments under each latitude band they touch, and the cells a border spans in each band."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    banded = edges.select(*country, "x1", "y1", "x2", "y2", _span(low, high, size).alias("cell_y"))
    extent = banded.groupBy(*country, "cell_y").agg(
        F.min(F.least("x1", "x2")).alias("west"), F.max(F.greatest("x1", "x2")).alias("east")
    )
    return banded, extent.select(*country, "cell_y", _span(F.col("west"), F.col("east"), size).alias("cell_x"))


def classified_cells(banded: DataFrame, covered: DataFrame, size: float) -> DataFrame:
    """What a point needs to know of each cell that a country may cover: near, parity, steps.

    ``near`` are the border segments that reach the cell's longitudes within its
    band. Of those wholly to the right only the number of crossings counts, which
    a latitude alone decides: ``parity`` at the cell's southern edge, and the
    latitudes ``steps`` where it changes on the way north. Inside the border both
    are the same all over the cell, so cells without near segments are inside or
    outside as a whole; the latter are left out.
    """
    # Cells overlap a little, so that rounding never parts a point from its segments.
    slack = size * 1e-6
    cell = ["country", "cell_y", "cell_x"]
    west, east = F.col("cell_x") * size - slack, (F.col("cell_x") + 1) * size + slack
    south, north = F.col("cell_y") * size - slack, (F.col("cell_y") + 1) * size + slack
    low, high = F.least("x1", "x2"), F.greatest("x1", "x2")
    placed = covered.join(banded, ["country", "cell_y"]).where(high >= west)
    right = low >= east
    crosses_south = right & ((F.col("y1") > south) != (F.col("y2") > south))
    cells = placed.groupBy(*cell).agg(
        F.collect_list(F.when(~right, F.struct("x1", "y1", "x2", "y2"))).alias("near"),
        (F.count_if(crosses_south) % 2).alias("parity"),
    )
    steps = (
        placed.where(right)
        .select(*cell, F.explode(F.array("y1", "y2")).alias("y"))
        .where((F.col("y") > south) & (F.col("y") <= north))
        .groupBy(*cell, "y")
        .agg(F.count("*").alias("n"))
        .where("n % 2 = 1")
        .groupBy(*cell)
        .agg(F.collect_list("y").alias("steps"))
    )
    joined = cells.join(steps, cell, "left").withColumn("steps", F.coalesce("steps", F.array().cast("array<double>")))
    return joined.where("parity = 1 OR size(near) > 0 OR size(steps) > 0")


def adaptive_cells(edges: DataFrame, size: float, most: int = CELL_SEGMENTS, levels: int = CELL_LEVELS) -> DataFrame:
    """``classified_cells`` of all sizes that are needed: level, country, cell_y, cell_x, near, parity, steps.

    Cells of the next level are half as wide and high. Segments are counted first, and only
    collected for cells near which there are at most ``most``; the others are cut into four.
    """
    cell = ["country", "cell_y", "cell_x"]
    banded, covered = _grid(edges, ["country"], size)
    found = []
    for level in range(levels + 1):
        dense = None
        if level < levels and (level or edges.limit(most + 1).count() > most):
            west, east = F.col("cell_x") * size, (F.col("cell_x") + 1) * size
            reach = (F.greatest("x1", "x2") >= west) & (F.least("x1", "x2") <= east)
            near = covered.join(banded, ["country", "cell_y"]).where(reach).groupBy(*cell).agg(F.count("*").alias("n"))
            dense = stage_table(near.where(F.col("n") > most).select(*cell), "dense-cells")
            dense = None if dense.isEmpty() else dense
        settled = covered if dense is None else covered.join(dense, cell, "left_anti")
        found.append(classified_cells(banded, settled, size).withColumn("level", F.lit(level)))
        if dense is None:
            break
        size /= 2
        halves = F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y in (0, 1) for x in (0, 1)])
        covered = dense.withColumn("half", F.explode(halves)).select(
            "country", (F.col("cell_y") * 2 + F.col("half.y")).alias("cell_y"), (F.col("cell_x") * 2 + F.col("half.x")).alias("cell_x")
        )
        banded = _grid(edges, ["country"], size)[0].join(covered.select("country", "cell_y").distinct(), ["country", "cell_y"], "left_semi")
    cells = found[0]
    for more in found[1:]:
        cells = cells.unionByName(more)
    return cells


def locate_points(
    points: DataFrame,
    polygons: DataFrame,
    cell_degrees: float = CELL_DEGREES,
    small_rows: int = SMALL_ROWS,
    most_segments: int = CELL_SEGMENTS,
) -> DataFrame:
    """(lat, lon, name) of the distinct points strictly inside a polygon.

    A point is inside if a line to the east crosses an odd number of border
    segments and it lies on none. Parity covers holes and countries in several
    parts. Cells are classified once, in a staged table, smaller ones where borders are
    dense; a point then meets the cells of its place,
    and tests only the segments near it, none in a cell that is wholly inside.
    """
    first = F.coalesce(
        *[F.when(F.col("name") == c, F.lit(i)) for i, c in enumerate(FIRST_COUNTRIES)], F.lit(len(FIRST_COUNTRIES))
    )
    # A territory without a code is a country of its own name.
    polygons = polygons.withColumn("iso3", F.coalesce("iso3", F.lit("")))
    # One row per country, numbered in the order in which they are tried.
    numbers = (
        polygons.select("name", "iso3")
        .distinct()
        .select("name", "iso3", F.row_number().over(Window.orderBy(first, "name", "iso3")).alias("country"))
    )
    edges = polygon_edges(polygons).join(numbers, ["name", "iso3"])
    cells = stage_table(adaptive_cells(edges, cell_degrees, most_segments), "cells")
    small = is_small(cells.select(F.explode_outer("near")), small_rows)
    # A point is in one cell of each level, and a country has at most one of these.
    places = [
        F.struct(
            F.lit(level).alias("level"),
            _cell(F.col("lat"), cell_degrees / 2**level).alias("cell_y"),
            _cell(F.col("lon"), cell_degrees / 2**level).alias("cell_x"),
        )
        for level in sorted(row["level"] for row in cells.select("level").distinct().collect()) or [0]
    ]
    placed = points.select("lat", "lon", F.inline(F.array(*places)))
    point = F.struct("lat", "lon")
    met = join_lookup(placed, cells, ["level", "cell_y", "cell_x"], point, small)
    px, py = F.col("lon"), F.col("lat")

    def crosses(s: Column) -> Column:
        crossing_at = (s.x2 - s.x1) * (py - s.y1) / F.nullif(s.y2 - s.y1, F.lit(0.0)) + s.x1
        return F.coalesce(((s.y1 > py) != (s.y2 > py)) & (px < crossing_at), F.lit(False))

    def touches(s: Column) -> Column:
        on_line = (s.x2 - s.x1) * (py - s.y1) == (s.y2 - s.y1) * (px - s.x1)
        return on_line & px.between(F.least(s.x1, s.x2), F.greatest(s.x1, s.x2)) & py.between(F.least(s.y1, s.y2), F.greatest(s.y1, s.y2))

    crossings = F.col("parity") + F.size(F.filter("steps", lambda y: y <= py)) + F.size(F.filter("near", crosses))
    inside = met.where((crossings % 2 == 1) & ~F.exists("near", touches))
    located = inside.groupBy("lat", "lon").agg(F.min("country").alias("country"))
    return join_lookup(located, numbers.select("country", "name"), ["country"], point, small).select("lat", "lon", "name")


def countries(
    df: DataFrame,
    key: str,
    column_latitude: str,
    column_longitude: str,
    polygons: DataFrame,
    name: str = "LatLongLocation",
    cell_degrees: float = CELL_DEGREES,
    hot_rows: int = HOT_ROWS,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """(key, country) of the responses whose coordinate is inside a country.

    Only distinct coordinates are located.
    """
    rows = df.select(
        col_(key).alias(key),
        (col_(column_latitude).cast("double") + F.lit(0.0)).alias("lat"),
        (col_(column_longitude).cast("double") + F.lit(0.0)).alias("lon"),
    ).where("lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)")
    sizes = rows.groupBy("lat", "lon").agg(F.count("*").alias("__rows"))
    # Always true; with the count in use, the plan aggregates once for both uses.
    points = sizes.where("__rows > 0")
    located = locate_points(points, polygons, cell_degrees, small_rows).withColumnRenamed("name", name)
    return join_per_key(rows, located, ["lat", "lon"], "__rows", F.col(key), hot_rows, sizes=sizes).select(key, name)
