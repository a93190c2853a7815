"""Points in a ring of very many edges: a raster index and a hash join.

The ring's bounding box is cut into cells. A ray from a point to the east crosses
some edges whatever the point's place in its cell, and others only for some
places: the first are a parity that the cell holds, the second are its list of
edges, which are tested by the plain rule. Cells that are wholly inside have no
list, cells wholly outside no row. The index is made from the ring alone and has
a bounded number of cells, so it is broadcast.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Ring = list[tuple[float, float]]

#: Cells across; edges that a row of cells has on average, and rows at most.
COLUMNS, EDGES_PER_ROW, MOST_ROWS = 32, 8, 1000

_SCHEMA = "_cell long, _odd boolean, _edges array<struct<y1:double,y2:double,slope:double,shift:double>>"


@dataclass(frozen=True)
class Raster:
    west: float
    south: float
    width: float
    height: float
    columns: int
    rows: int

    @classmethod
    def over(cls, ring: Ring) -> "Raster":
        lons, lats = [x for x, _ in ring], [y for _, y in ring]
        rows = min(MOST_ROWS, max(1, len(ring) // EDGES_PER_ROW))
        return cls(min(lons), min(lats), max(lons) - min(lons), max(lats) - min(lats), COLUMNS, rows)

    def cell(self, lon: Column, lat: Column) -> Column:
        """Null outside the bounding box."""
        row = F.least(F.floor((lat - self.south) * self.rows / self.height), F.lit(self.rows - 1))
        column = F.least(F.floor((lon - self.west) * self.columns / self.width), F.lit(self.columns - 1))
        inside = lon.between(self.west, self.west + self.width) & lat.between(self.south, self.south + self.height)
        return F.when(inside, row * self.columns + column)


def cells(ring: Ring, raster: Raster) -> list[tuple]:
    """Rows of _SCHEMA for the cells that are not wholly outside."""
    step, tall, margin = raster.width / raster.columns, raster.height / raster.rows, 1e-9
    by_row: list[list[tuple]] = [[] for _ in range(raster.rows)]
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if y1 == y2:
            continue
        slope = (x2 - x1) / (y2 - y1)
        edge = (y1, y2, slope, x1 - y1 * slope)
        low, high = min(y1, y2), max(y1, y2)
        first = max(0, math.floor((low - raster.south - margin) / tall))
        last = min(raster.rows - 1, math.floor((high - raster.south + margin) / tall))
        for row in range(first, last + 1):
            bottom, top = raster.south + row * tall - margin, raster.south + (row + 1) * tall + margin
            ends = [slope * y + edge[3] for y in (max(low, bottom), min(high, top))]
            # whether every latitude of the row lies between the edge's ends
            by_row[row].append((min(ends) - margin, max(ends) + margin, low < bottom and high > top, edge))
    found = []
    for row, edges in enumerate(by_row):
        for column in range(raster.columns):
            left, right = raster.west + column * step - margin, raster.west + (column + 1) * step + margin
            odd, tested = False, []
            for near, far, spans, edge in edges:
                if far < left:
                    continue
                if near > right and spans:
                    odd = not odd
                else:
                    tested.append(edge)
            if odd or tested:
                found.append((row * raster.columns + column, odd, tested))
    return found


def index(spark: SparkSession, ring: Ring) -> tuple[Raster, DataFrame]:
    raster = Raster.over(ring)
    return raster, spark.createDataFrame(cells(ring, raster), _SCHEMA)


def inside(points: DataFrame, ring: Ring) -> DataFrame:
    """The points in the ring by the rule of ``geo.in_polygon``, for a ring of any number of edges."""
    raster, table = index(points.sparkSession, ring)
    lon, lat = F.col("LON"), F.col("LAT")
    crossed = F.filter("_edges", lambda e: ((e["y1"] > lat) != (e["y2"] > lat)) & (lon < lat * e["slope"] + e["shift"]))
    odd = F.col("_odd") != (F.size(crossed) % 2 == 1)
    keyed = points.withColumn("_at", raster.cell(lon, lat))
    return keyed.join(F.broadcast(table), F.col("_at") == F.col("_cell")).where(odd).select(*points.columns)


def refined(ring: Ring, parts: int) -> Ring:
    """Every edge in so many parts, whose ends lie a little beside it by a fixed rule: a ring with more edges to test and to measure."""
    out = []
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        for k in range(parts):
            aside = (k * 37 % 101 - 50) / 5000.0 if k else 0.0
            out.append((x1 + (x2 - x1) * k / parts + aside, y1 + (y2 - y1) * k / parts - aside))
    return [*out, ring[-1]]
