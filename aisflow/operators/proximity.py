"""Ports within a radius of a ping, and the nearest of them.

Ports are laid on a global grid whose cell edge is about the radius. Each port
is listed in every cell its radius can touch, each ping has exactly one cell,
so the spatial join is a hash join on one long plus the exact distance test.
No ping is ever compared with a port elsewhere.
"""

from dataclasses import dataclass
from math import floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisflow.functions import geo
from aisflow.storage import written

DEFAULT_RADIUS_M = 3500.0

# The smallest radius of curvature on WGS84, so that a box is never too narrow, and some slack.
_SMALLEST_RADIUS_M = 6_335_000.0
_SLACK = 1.01
_METRES_PER_DEGREE = 111_000.0
_SMALLEST_EDGE_DEG = 0.01

# A choice of plan, which no result depends on: up to this many rows (some ten a port, more near a
# pole) the ports' cell table is broadcast.
BROADCAST_CELLS = 300_000

# Beyond it the join shuffles, and cells with more pings than this are cut into parts of about as many.
CELL_ROWS = 2_000_000

# Where only the nearest port is looked for, cells with more ports than this are divided again, by so much and so often.
CELL_PORTS = 64
SPLIT = 4
LEVELS = 6

# Places of pings and ports on the auxiliary sphere.
_HERE = ["_x", "_y", "_z"]
_THERE = ["_port_x", "_port_y", "_port_z"]


@dataclass(frozen=True)
class Grid:
    """``columns`` x ``rows`` cells over the globe; longitudes wrap, latitudes do not."""

    columns: int
    rows: int

    @classmethod
    def for_radius(cls, radius_m: float) -> "Grid":
        edge = max(radius_m / _METRES_PER_DEGREE, _SMALLEST_EDGE_DEG)
        return cls(max(1, floor(360 / edge)), max(1, floor(180 / edge)))

    def finer(self, level: int) -> "Grid":
        """Every cell in SPLIT x SPLIT cells, ``level`` times; a power of two, so cells nest to the last bit."""
        return Grid(self.columns * SPLIT**level, self.rows * SPLIT**level)

    def centre(self, cell: Column) -> tuple[Column, Column]:
        """Longitude and latitude."""
        column, row = cell % self.columns, F.floor(cell / self.columns)
        return (column + 0.5) * (360 / self.columns) - 180, (row + 0.5) * (180 / self.rows) - 90

    def half_diagonal_m(self, lat: Column) -> Column:
        """No point of a cell whose centre has this latitude is farther from the centre."""
        tall, wide = 90 / self.rows, 180 / self.columns
        nearest_equator = F.greatest(F.abs(lat) - tall, F.lit(0.0))
        return F.hypot(F.lit(tall * 111_700.0), wide * 111_400.0 * F.cos(F.radians(nearest_equator))) * 1.01 + 1.0

    def _row(self, lat: Column) -> Column:
        return F.least(F.floor((lat + 90) * self.rows / 180), F.lit(self.rows - 1))

    def _column(self, lon: Column) -> Column:
        """Not wrapped yet."""
        return F.floor((lon + 180) * self.columns / 360)

    def _wrap(self, column: Column) -> Column:
        return F.pmod(column, F.lit(self.columns))

    def cell(self, lon: Column, lat: Column) -> Column:
        return self._row(lat) * self.columns + self._wrap(self._column(lon))

    def cells_within(self, lon: Column, lat: Column, radius_m: float) -> Column:
        """Array of all cells that a circle around the point may touch."""
        angle = F.lit(radius_m * _SLACK / _SMALLEST_RADIUS_M)
        reach = F.degrees(angle)
        # Near a pole the circle meets every meridian.
        polar = F.abs(lat) + reach >= 89.999
        half_width = F.degrees(F.asin(F.sin(angle) / F.cos(F.radians(lat))))
        west = self._column(lon - half_width)
        east = F.least(self._column(lon + half_width), west + (self.columns - 1))
        columns = F.when(polar, F.sequence(F.lit(0).cast("long"), F.lit(self.columns - 1).cast("long")))
        columns = columns.otherwise(F.transform(F.sequence(west, east), self._wrap))
        rows = F.sequence(
            self._row(F.greatest(lat - reach, F.lit(-90.0))),
            self._row(F.least(lat + reach, F.lit(90.0))),
        )
        return F.flatten(F.transform(rows, lambda y: F.transform(columns, lambda x: y * self.columns + x)))


def few_enough(rows: DataFrame, bound: int) -> bool:
    """Counts no further than the bound."""
    return rows.limit(bound + 1).count() <= bound


def can_broadcast(ports: DataFrame, radius_m: float, bound: int = BROADCAST_CELLS) -> bool:
    cells = Grid.for_radius(radius_m).cells_within(F.col("LON"), F.col("LAT"), radius_m)
    return few_enough(ports.select(F.explode(cells)), bound)


def crowding(ports: DataFrame, radius_m: float) -> tuple[int, int]:
    """How many pairs of port and cell there are, and how many ports the fullest cell has."""
    cells = Grid.for_radius(radius_m).cells_within(F.col("LON"), F.col("LAT"), radius_m)
    sizes = ports.select(F.explode(cells).alias("_cell")).groupBy("_cell").agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.sum("n"), F.max("n")).first()
    return row[0] or 0, row[1] or 0


def port_cells(ports: DataFrame, grid: Grid, radius_m: float, globe: geo.Globe) -> DataFrame:
    """One row per port and cell, with the port's place."""
    lon, lat = F.col("LON"), F.col("LAT")
    place = globe.place(lon, lat)
    return ports.select(
        F.explode(grid.cells_within(lon, lat, radius_m)).alias("_cell"),
        "UNLOCODE",
        *[axis.alias(name) for name, axis in zip(_THERE, place)],
    )


@dataclass(frozen=True)
class Cells:
    """Ports by the cells in which a ping looks for them, and how a ping finds its cell."""

    ports: DataFrame
    grid: Grid
    globe: geo.Globe
    #: For each level, from the coarsest, the cells that are divided again.
    divided: tuple[DataFrame, ...] = ()

    def keyed(self, pings: DataFrame) -> DataFrame:
        """Pings with their cell: a long, which holds the level in its last digits."""
        lon, lat = F.col("LON"), F.col("LAT")
        if not self.divided:
            return pings.withColumn("_cell", self.grid.cell(lon, lat))
        found = pings.withColumn("_cell", _named_cell(self.grid.cell(lon, lat), 0))
        for level, divided in enumerate(self.divided):
            finer = _named_cell(self.grid.finer(level + 1).cell(lon, lat), level + 1)
            found = found.join(F.broadcast(divided), F.col("_cell") == F.col("_divided"), "left")
            found = found.withColumn("_cell", F.when(F.col("_divided").isNotNull(), finer).otherwise(F.col("_cell"))).drop("_divided")
        return found

    def located(self, pings: DataFrame) -> DataFrame:
        """Pings with their cell and place: trigonometry once per ping, before the join."""
        places = dict(zip(_HERE, self.globe.place(F.col("LON"), F.col("LAT"))))
        return self.keyed(pings).withColumns(places)


def _named_cell(cell: Column, level: int) -> Column:
    return cell * (LEVELS + 1) + level


def all_cells(ports: DataFrame, radius_m: float, globe: geo.Globe) -> Cells:
    """Every port in every cell it may reach."""
    grid = Grid.for_radius(radius_m)
    return Cells(port_cells(ports, grid, radius_m, globe), grid, globe)


def nearest_cells(ports: DataFrame, radius_m: float, globe: geo.Globe, most: int = CELL_PORTS) -> Cells:
    """The same for the nearest port alone, with few ports in a cell wherever they lie.

    A cell with more than ``most`` ports is divided, and so are its parts. A port
    stays in a part only if it may be the nearest one somewhere in it: the part
    lies in a circle around its centre, so a port cannot be if it is farther from
    the circle than another port is from its far side, or than the radius.
    """
    if crowding(ports, radius_m)[1] <= most:
        return all_cells(ports, radius_m, globe)
    # of several ports at one place the smallest code is the nearest to any ping
    single = ports.groupBy("LON", "LAT").agg(F.min("UNLOCODE").alias("UNLOCODE"))
    whole = all_cells(single, radius_m, globe)
    grid = whole.grid
    entries = whole.ports.withColumn("_cell", _named_cell(F.col("_cell"), 0))
    done, divided = [], []
    for level in range(LEVELS):
        entries = written(entries, "cell-ports")
        crowded = entries.groupBy("_cell").count().where(F.col("count") > most).select(F.col("_cell").alias("_divided"))
        crowded = written(crowded, "divided-cells")
        if crowded.isEmpty():
            break
        own = F.col("_cell") == F.col("_divided")
        done.append(entries.join(F.broadcast(crowded), own, "left_anti"))
        divided.append(crowded)
        entries = _divide(entries.join(F.broadcast(crowded), own, "left_semi"), grid, level, radius_m, globe)
    for other in done:
        entries = entries.unionByName(other)
    return Cells(written(entries, "cell-ports"), grid, globe, tuple(divided))


def _divide(entries: DataFrame, grid: Grid, level: int, radius_m: float, globe: geo.Globe) -> DataFrame:
    """Ports of crowded cells in the parts of these cells."""
    coarse, fine = grid.finer(level), grid.finer(level + 1)
    cell = F.floor(F.col("_cell") / (LEVELS + 1))
    row, column = F.floor(cell / coarse.columns) * SPLIT, cell % coarse.columns * SPLIT
    parts = F.array(*[((row + i) * fine.columns + column + j) for i in range(SPLIT) for j in range(SPLIT)])
    each = entries.withColumn("_part", F.explode(parts))
    lon, lat = fine.centre(F.col("_part"))
    centre = dict(zip(("_cx", "_cy", "_cz"), globe.place(lon, lat)))
    each = each.withColumns({**centre, "_around": fine.half_diagonal_m(lat)})
    away = globe.metres(tuple(map(F.col, centre)), tuple(map(F.col, _THERE)))
    each = each.withColumn("_away", F.explode(F.array(away)))
    best = F.min(F.col("_away") + F.col("_around")).over(Window.partitionBy("_part"))
    near = F.col("_away") - F.col("_around")
    kept = each.withColumn("_best", F.least(best, F.lit(radius_m * _SLACK))).where(near <= F.col("_best"))
    return kept.select(_named_cell(F.col("_part"), level + 1).alias("_cell"), "UNLOCODE", *_THERE)


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with a number of their own in ``_row``, stored: whoever draws parts by it draws
    the same ones again, also after an executor is lost."""
    return written(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def _in_parts(left: DataFrame, right: DataFrame, parts: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Joins by ``keys``. ``parts`` names busy keys with their ``_parts``: rows of ``left`` that hold
    one are dealt over so many by ``_row``, and those of ``right`` are copied to each."""
    if few_enough(parts, BROADCAST_CELLS):
        parts = F.broadcast(parts)
    count = F.coalesce("_parts", F.lit(1).cast("long"))
    cut = left.join(parts, keys, "left").withColumn("_part", F.pmod("_row", count)).drop("_parts", "_row")
    copied = right.join(parts, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), count - 1))).drop("_parts")
    return cut.join(copied, [*keys, "_part"], how).drop("_part")


def _salted(pings: DataFrame, cells: Cells, cell_rows: int) -> DataFrame:
    """Joins by cell in a shuffle. A busy cell is cut into as many parts as its rows ask for, and
    its ports are copied to each; cells that are not busy stay whole. Equal pings are spread as well."""
    sizes = cells.keyed(pings.select("LON", "LAT")).groupBy("_cell").agg(F.count("*").alias("_rows")).where(F.col("_rows") > cell_rows)
    parts = written(sizes.select("_cell", F.ceil(F.col("_rows") / cell_rows).alias("_parts")), "busy-cells")
    if parts.isEmpty():
        return cells.located(pings).join(cells.ports, "_cell")
    return _in_parts(cells.located(_numbered(pings)), cells.ports, parts, ["_cell"], "inner")


def port_hits(
    pings: DataFrame,
    ports: DataFrame,
    radius_m: float = DEFAULT_RADIUS_M,
    globe: geo.Globe = geo.WGS84,
    inclusive: bool = False,
    broadcast_cells: int = BROADCAST_CELLS,
    cell_rows: int = CELL_ROWS,
    cells: Cells | None = None,
) -> DataFrame:
    """Inner join: every (ping, port) pair closer than the radius, with its distance ``d`` in metres.

    With ``nearest_cells`` as ``cells``, of the pairs of a ping at least that of its nearest port.
    """
    cells = cells or all_cells(ports, radius_m, globe)
    here, there = tuple(map(F.col, _HERE)), tuple(map(F.col, _THERE))
    if can_broadcast(ports, radius_m, broadcast_cells):
        pairs = cells.located(pings).join(F.broadcast(cells.ports), "_cell")
    else:
        pairs = _salted(pings, cells, cell_rows)
    chord = globe.chord(here, there)
    near = F.col("d") <= radius_m if inclusive else F.col("d") < radius_m
    # Plain arithmetic decides about most pairs within the join. The value for the others comes
    # out of an explode, or Spark would write the exact test in terms of places into the join
    # condition, which then grows too large for the JVM to compile.
    likely = pairs.where(chord <= globe.chord_bound(radius_m)).withColumn("_h", F.explode(F.array(chord)))
    d = globe.metres_of(F.col("_h"), here[2], there[2])
    return likely.select(*pings.columns, "UNLOCODE", d.alias("d")).where(near)


def nearest_port(hits: DataFrame) -> DataFrame:
    """The closest port per (MMSI, BaseDateTime); equal distances go to the smaller code.

    Spark prunes each group to one row before the shuffle (WindowGroupLimit),
    so a key with very many hits sends one row per task.
    """
    closest_first = Window.partitionBy("MMSI", "BaseDateTime").orderBy("d", "UNLOCODE")
    return (
        hits.select("MMSI", "BaseDateTime", "UNLOCODE", "d")
        .withColumn("_rank", F.row_number().over(closest_first))
        .where("_rank = 1")
        .drop("_rank")
    )


INSTANT = ["MMSI", "BaseDateTime"]

# A choice of plan, which no result depends on: instants of a ship with more pings than this are cut into parts of about as many.
KEY_ROWS = 1_000_000


def _busy_instants(pings: DataFrame, key_rows: int) -> DataFrame | None:
    """(MMSI, BaseDateTime, _parts) of instants with more than ``key_rows`` pings, or None.

    Ships are counted first, which is narrow after the map side; instants only of ships that have so many pings at all.
    """
    ships = pings.where("MMSI IS NOT NULL").groupBy(F.col("MMSI").alias("_ship")).agg(F.count("*").alias("_rows"))
    ships = written(ships.where(F.col("_rows") > key_rows).select("_ship"), "busy-ships")
    if ships.isEmpty():
        return None
    if few_enough(ships, BROADCAST_CELLS):
        ships = F.broadcast(ships)
    theirs = pings.where("BaseDateTime IS NOT NULL").join(ships, F.col("MMSI") == F.col("_ship"), "left_semi")
    sizes = theirs.groupBy(*INSTANT).agg(F.count("*").alias("_rows")).where(F.col("_rows") > key_rows)
    parts = written(sizes.select(*INSTANT, F.ceil(F.col("_rows") / key_rows).alias("_parts")), "busy-instants")
    return None if parts.isEmpty() else parts


def join_ports(pings: DataFrame, nearest: DataFrame, key_rows: int | None = None) -> DataFrame:
    """Left join of the nearest port on (MMSI, BaseDateTime): equal keys share one port, null keys get none.

    With ``key_rows`` busy instants are counted, and those with more pings are spread over tasks.
    """
    named = nearest.select(*INSTANT, "UNLOCODE")
    parts = _busy_instants(pings, key_rows) if key_rows is not None else None
    if parts is None:
        return pings.join(named, INSTANT, "left")
    return _in_parts(_numbered(pings), named, parts, INSTANT, "left")


def _own_port(pings: DataFrame, cells: Cells, radius_m: float, globe: geo.Globe, inclusive: bool) -> DataFrame:
    """Adds ``port``: struct(d, UNLOCODE) of the port nearest to each single ping, or null.

    Each cell carries its ports, CELL_PORTS or so at most, as one array, so a ping meets
    at most one row of the broadcast side and keeps its place: no shuffle, no window, no
    second scan of the pings. For cells that are few enough to be broadcast.
    """
    lists = (
        cells.ports.groupBy("_cell")
        .agg(F.collect_list(F.struct(*_THERE, "UNLOCODE")).alias("_ports"))
    )
    here = tuple(map(F.col, _HERE))

    def place(port: Column) -> geo.Place:
        return tuple(port[name] for name in _THERE)

    def measured(port: Column) -> Column:
        h = globe.chord(here, place(port)).alias("h")
        return F.struct(h, port["_port_z"].alias("z"), port["UNLOCODE"].alias("UNLOCODE"))

    def reach(port: Column) -> Column:
        d = globe.metres_of(port["h"], here[2], port["z"]).alias("d")
        return F.struct(d, port["UNLOCODE"].alias("UNLOCODE"))

    def near(port: Column) -> Column:
        return port["d"] <= radius_m if inclusive else port["d"] < radius_m

    bound = globe.chord_bound(radius_m)
    likely = F.filter(F.transform("_ports", measured), lambda port: port["h"] <= bound)
    return (
        cells.located(pings)
        .join(F.broadcast(lists), "_cell", "left")
        .select(*pings.columns, F.array_min(F.filter(F.transform(likely, reach), near)).alias("port"))
    )


def own_port(
    pings: DataFrame,
    ports: DataFrame,
    radius_m: float = DEFAULT_RADIUS_M,
    globe: geo.Globe = geo.WGS84,
    inclusive: bool = False,
    broadcast_cells: int = BROADCAST_CELLS,
) -> DataFrame | None:
    """``_own_port`` where the ports are few enough to be broadcast, else None."""
    rows, most = crowding(ports, radius_m)
    if rows > broadcast_cells:
        return None
    cells = all_cells(ports, radius_m, globe) if most <= CELL_PORTS else nearest_cells(ports, radius_m, globe)
    if cells.divided and not few_enough(cells.ports, SPLIT * broadcast_cells):
        return None
    return _own_port(pings, cells, radius_m, globe, inclusive)


def shared_port(pings: DataFrame, name: str = "UNLOCODE") -> DataFrame:
    """Replaces ``port`` by its code as ``name``, of the nearest port that any ping of the ship at that
    instant has; without ship or time there is none. One shuffle, or none after a window by ship."""
    same_instant = Window.partitionBy("MMSI", "BaseDateTime")
    known = F.col("MMSI").isNotNull() & F.col("BaseDateTime").isNotNull()
    code = F.when(known, F.min("port").over(same_instant)["UNLOCODE"])
    return pings.withColumn(name, code).drop("port")


def pings_with_port(
    pings: DataFrame,
    ports: DataFrame,
    radius_m: float = DEFAULT_RADIUS_M,
    globe: geo.Globe = geo.WGS84,
    inclusive: bool = False,
    broadcast_cells: int = BROADCAST_CELLS,
) -> DataFrame:
    """Every ping with the code of its nearest port in ``UNLOCODE``, or null.

    Pings of one ship at one instant share the nearest port found for any of
    them; without ship or time there is none. With a port list that can be
    broadcast the pings are read and shuffled once.
    """
    own = own_port(pings, ports, radius_m, globe, inclusive, broadcast_cells)
    if own is not None:
        return shared_port(own)
    return pings_with_port_by_join(pings, ports, radius_m, globe, inclusive, broadcast_cells)


def pings_with_port_by_join(
    pings: DataFrame,
    ports: DataFrame,
    radius_m: float = DEFAULT_RADIUS_M,
    globe: geo.Globe = geo.WGS84,
    inclusive: bool = False,
    broadcast_cells: int = BROADCAST_CELLS,
    key_rows: int | None = KEY_ROWS,
) -> DataFrame:
    """The same by joins, for any number of ports. ``key_rows`` is that of ``join_ports``; None
    where the caller knows that no ship has more pings than a task should."""
    cells = nearest_cells(ports, radius_m, globe)
    hits = port_hits(pings, ports, radius_m, globe, inclusive, broadcast_cells, cells=cells)
    return join_ports(pings, nearest_port(hits), key_rows).select(*pings.columns, "UNLOCODE")
