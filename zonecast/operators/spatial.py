"""Zone adjacency from polygons, and demand of neighbouring zones.

Two polygons touch when their boundaries meet and their interiors do not. For simple rings that
meet at all this is a local question: the interiors overlap exactly if, at some meeting point, the
two open angles that the interiors fill there overlap. So the whole test is one equi join of edges
on grid cells with arithmetic per edge pair, and one aggregate per zone pair. There is no
polygon-against-polygon scan, and long boundaries are spread over many cells. Zones of several rings
are judged as a whole; only a ring that meets no edge of a zone which its own zone touches elsewhere
needs one more test, whether it lies within that zone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.numeric import zero_filled
from zonecast.schemas import BIN, TARGETS, ZONE
from zonecast.session import small, stage

NO_NEIGHBOR = -1
FULL_TURN = 2 * math.pi
ANGLE_TOLERANCE = 1e-9
CELL = ("_size", "_cx", "_cy")


def _turn(angle: Column) -> Column:
    """Angle in [0, 2 pi), with values a hair below a full turn taken as 0."""
    turned = F.pmod(angle, F.lit(FULL_TURN))
    return F.when(turned > FULL_TURN - ANGLE_TOLERANCE, F.lit(0.0)).otherwise(turned)


def polygon_edges(polygons: DataFrame, *keys: str, snap: float = 1e-9) -> DataFrame:
    """Edges of each ring with the interior on their left: counter-clockwise, clockwise where ``hole``.

    ``ax, ay -> bx, by`` is the edge, ``heading`` its direction and ``opening`` the angle the
    interior fills at its first vertex, counted counter-clockwise from ``heading``.
    """
    point = lambda p: F.struct(
        (F.rint(p["x"] / F.lit(snap)) * F.lit(snap)).alias("x"),
        (F.rint(p["y"] / F.lit(snap)) * F.lit(snap)).alias("y"),
    )
    ring = polygons.select(*keys, "hole", F.transform("ring", point).alias("_all"))
    # Drop each point that repeats its predecessor; the closing point repeats the first.
    ring = ring.select(
        *keys, "hole",
        F.filter(
            F.arrays_zip(
                F.col("_all").alias("p"),
                F.concat(F.slice("_all", -1, 1), F.col("_all")).alias("q"),
            ),
            lambda v: v["p"].isNotNull() & (v["p"] != v["q"]),
        )["p"].alias("_open"),
    ).where(F.size("_open") >= 3)
    nexts = lambda name: F.concat(F.slice(name, 2, F.size(name)), F.slice(name, 1, 1))
    area = F.aggregate(
        F.arrays_zip(F.col("_open").alias("p"), nexts("_open").alias("q")),
        F.lit(0.0),
        lambda acc, v: acc + v["p"]["x"] * v["q"]["y"] - v["q"]["x"] * v["p"]["y"],
    )
    ring = ring.select(
        *keys, F.when((area < 0) != F.col("hole"), F.reverse("_open")).otherwise(F.col("_open")).alias("_ring")
    )
    previous = F.concat(F.slice("_ring", -1, 1), F.slice("_ring", 1, F.size("_ring") - 1))
    edges = ring.select(
        *keys,
        F.inline(
            F.arrays_zip(
                previous.alias("c"), F.col("_ring").alias("a"), nexts("_ring").alias("b")
            )
        ),
    ).select(
        *keys,
        F.col("a.x").alias("ax"), F.col("a.y").alias("ay"),
        F.col("b.x").alias("bx"), F.col("b.y").alias("by"),
        F.atan2(F.col("b.y") - F.col("a.y"), F.col("b.x") - F.col("a.x")).alias("heading"),
        F.atan2(F.col("c.y") - F.col("a.y"), F.col("c.x") - F.col("a.x")).alias("_back"),
    )
    return edges.withColumn("opening", _turn(F.col("_back") - F.col("heading"))).drop("_back")


@dataclass(frozen=True)
class _Edge:
    """Columns of one side of an edge pair."""

    side: str

    def __getattr__(self, name: str) -> Column:
        return F.col(f"{self.side}.{name}")

    def offset(self, x: Column, y: Column) -> Column:
        """Cross product of the edge with the way to a point: positive on its left."""
        return (self.bx - self.ax) * (y - self.ay) - (self.by - self.ay) * (x - self.ax)

    def dot(self, x: Column, y: Column) -> Column:
        return (self.bx - self.ax) * (x - self.ax) + (self.by - self.ay) * (y - self.ay)

    def length(self) -> Column:
        return F.hypot(self.bx - self.ax, self.by - self.ay)


def _measures() -> list[Column]:
    """Numbers of an edge pair ``l``, ``r`` that the test needs, each computed once.

    ``la``/``lb`` are the offsets of l's ends from r, ``lpos`` the place of l's first end along r;
    ``ra``, ``rb``, ``rpos`` the reverse. ``turn`` leads from l's direction to r's.
    """
    l, r = _Edge("l"), _Edge("r")
    return [
        l.opening.alias("lopen"), r.opening.alias("ropen"),
        l.length().alias("llen"), r.length().alias("rlen"),
        r.offset(l.ax, l.ay).alias("la"), r.offset(l.bx, l.by).alias("lb"),
        l.offset(r.ax, r.ay).alias("ra"), l.offset(r.bx, r.by).alias("rb"),
        r.dot(l.ax, l.ay).alias("lpos"), l.dot(r.ax, r.ay).alias("rpos"),
        F.greatest(F.abs(l.ax - r.ax), F.abs(l.ay - r.ay)).alias("starts"),
        _turn(r.heading - l.heading).alias("turn"),
    ]


def _contacts(tolerance: float) -> dict[str, Column]:
    """How a measured pair meets: at both first ends, one's first end within the other, crossing."""

    def within(offset: str, position: str, length: str) -> Column:
        margin = F.col(length) * tolerance
        return (
            (F.abs(offset) <= margin)
            & (F.col(position) > margin)
            & (F.col(position) < F.col(length) * F.col(length) - margin)
        )

    def split(first: str, second: str, length: str) -> Column:
        margin = F.col(length) * tolerance
        return (
            (F.least(first, second) < -margin) & (F.greatest(first, second) > margin)
        )

    return {
        "starts_meet": F.col("starts") <= tolerance,
        "l_on_r": within("la", "lpos", "rlen"),
        "r_on_l": within("ra", "rpos", "llen"),
        "crossing": split("la", "lb", "rlen") & split("ra", "rb", "llen"),
    }


def _angles_overlap(width1: Column, width2: Column) -> Column:
    """Whether two open angles, the second ``turn`` after the first, share a direction.

    They do if one starts within the other.
    """
    back = F.when(F.col("turn") == 0, F.lit(0.0)).otherwise(F.lit(FULL_TURN) - F.col("turn"))
    return (F.col("turn") < width1 - ANGLE_TOLERANCE) | (back < width2 - ANGLE_TOLERANCE)


def _interiors_overlap() -> Column:
    """Whether the interiors overlap where a pair meets; along an edge the interior fills a half turn."""
    half = F.lit(math.pi)
    return (
        F.col("crossing")
        | (F.col("starts_meet") & _angles_overlap(F.col("lopen"), F.col("ropen")))
        | (F.col("l_on_r") & _angles_overlap(F.col("lopen"), half))
        | (F.col("r_on_l") & _angles_overlap(half, F.col("ropen")))
    )


def _boxes_meet(tolerance: float) -> Column:
    """Cheap test that comes before the exact one."""
    l, r = _Edge("l"), _Edge("r")
    apart = lambda la, lb, ra, rb: (F.greatest(la, lb) < F.least(ra, rb) - tolerance) | (
        F.greatest(ra, rb) < F.least(la, lb) - tolerance
    )
    return ~apart(l.ax, l.bx, r.ax, r.bx) & ~apart(l.ay, l.by, r.ay, r.by)


def _columns(size: Column, tolerance: float) -> tuple[Column, Column]:
    """First and last column of square cells that an edge's (slightly widened) box covers."""
    left, right = F.least("ax", "bx"), F.greatest("ax", "bx")
    return F.floor((left - tolerance) / size), F.floor((right + tolerance) / size)


def _rows(column: Column, size: Column, tolerance: float) -> tuple[Column, Column]:
    """First and last row of cells that an edge crosses within a column of cells.

    Following the edge column by column, a long edge takes cells along its length only.
    """
    ax, ay, bx, by = F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")
    low, high = F.least(ay, by), F.greatest(ay, by)
    steep = F.abs(bx - ax) * 1000 <= high - low

    def height(x: Column) -> Column:
        inside = F.least(F.greatest(x, F.least(ax, bx)), F.greatest(ax, bx))
        return ay + (by - ay) * F.try_divide(inside - ax, bx - ax)

    entry, exit = height(column * size), height((column + 1) * size)
    bottom = F.when(steep, low).otherwise(F.greatest(low, F.least(entry, exit)))
    top = F.when(steep, high).otherwise(F.least(high, F.greatest(entry, exit)))
    # Slack for the rounding of heights, whose error is bounded as steep edges take their full range.
    slack = F.lit(tolerance) + size * F.lit(1e-6)
    return F.floor((bottom - slack) / size), F.floor((top + slack) / size)


def _cells(edges: DataFrame, tolerance: float) -> DataFrame:
    """Repeat each edge for every cell it crosses."""
    size = F.col("_size")
    columns = F.sequence(*_columns(size, tolerance))
    placed = edges.withColumn("_cx", F.explode(columns))
    low, high = _rows(F.col("_cx"), size, tolerance)
    return placed.withColumn("_cy", F.explode(F.sequence(low, high)))


def _fine_cells(cells: DataFrame, tolerance: float) -> DataFrame:
    """Repeat each edge for the sub-cells it crosses; each cell has ``_parts`` of them each way."""
    parts = F.col("_parts")
    step = F.col("_size") / parts

    def within(first: Column, last: Column, cell: str) -> Column:
        low = F.greatest(first, F.col(cell) * parts)
        high = F.least(last, F.col(cell) * parts + parts - 1)
        return F.when(low <= high, F.sequence(low, high))

    placed = cells.withColumn("_fx", F.explode(within(*_columns(step, tolerance), "_cx")))
    return placed.withColumn(
        "_fy", F.explode(within(*_rows(F.col("_fx"), step, tolerance), "_cy"))
    )


def _spread(edges: DataFrame, size: Column, tolerance: float, crowded: int) -> DataFrame:
    """Every edge once per cell it crosses, cells cut finer until none is crowded.

    A cell of more than ``crowded`` edges is cut unless that spares less than half of its pairs, as
    where its edges run through one point or along each other; cells that are wide for their edges
    are cut down to their length in any case. Cells that no cut helps stay as they are.
    """
    # Pairs cost far more than rows, so rows are written spread by cell, however few files held them.
    width = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = stage(_cells(edges.withColumn("_size", size), tolerance).repartition(width, "_cx", "_cy"), "edge_cells")
    settled = []
    while True:
        extent = F.least(F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay"))), "_size")
        load = cells.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_load"), F.avg(extent).alias("_extent"))
        wide = F.floor(F.col("_size") / F.col("_extent"))
        busy = stage(
            load.where(F.col("_load") > crowded).select(
                *CELL, "_load", (wide >= 4).alias("_wide"),
                F.greatest(F.lit(2), F.ceil(F.sqrt(F.col("_load") / F.lit(float(crowded)))), F.least(F.lit(1024), wide)).alias("_parts"),
            ),
            "busy_cells",
        )
        if busy.isEmpty():
            return reduce(DataFrame.unionByName, [*settled, cells])
        fine = stage(_fine_cells(cells.join(busy, list(CELL)), tolerance), "fine_cells")
        pairs = (
            fine.groupBy(*CELL, "_fx", "_fy", "_load", "_wide").agg(F.count(F.lit(1)).cast("double").alias("_many"))
            .groupBy(*CELL, "_load", "_wide").agg(F.sum(F.col("_many") * F.col("_many")).alias("_pairs"))
        )
        spares = F.col("_pairs") * 2 <= F.col("_load").cast("double") * F.col("_load")
        cut = stage(pairs.where(F.col("_wide") | spares).select(*CELL), "cut_cells")
        settled.append(cells.join(cut, list(CELL), "left_anti"))
        parts = (F.col("_size") / F.col("_parts")).alias("_size"), F.col("_fx").alias("_cx"), F.col("_fy").alias("_cy")
        kept = [name for name in cells.columns if name not in CELL]
        cells = fine.join(cut, list(CELL), "left_semi").select(*kept, *parts)


def _shapes(rings: DataFrame) -> DataFrame:
    """Each zone's ``shape``, a hash of its distinct rings in whatever order, and their number."""
    hashes = [F.xxhash64(F.lit(seed), "part").cast("decimal(38,0)") for seed in range(2)]
    return (
        rings.select(ZONE, "part").distinct().groupBy(ZONE)
        .agg(F.concat_ws(" ", F.count(F.lit(1)), *[F.sum(h) for h in hashes]).alias("shape"), F.count(F.lit(1)).alias("parts"))
    )


def _hidden(touching: DataFrame, met: DataFrame, edges: DataFrame) -> DataFrame:
    """The touching pairs of which one has a ring within the other, away from all its edges.

    Rings that meet an edge of the other zone were judged there, so zones of one ring need no test.
    A ring's point lies within a zone if the zone's edges wind around it.
    """
    points = edges.groupBy("shape", "part").agg(F.min(F.struct("ax", "ay")).alias("point"))
    several = points.groupBy("shape").agg(F.count(F.lit(1)).alias("rings")).where("rings > 1").select("shape")
    both = lambda df, *names: reduce(
        DataFrame.unionByName,
        [
            df.select(F.col(a).alias("shape"), F.col(b).alias("other"), *[F.col(f"{a}_{n}").alias(n) for n in names])
            for a, b in (("one", "two"), ("two", "one"))
        ],
    )
    away = (
        both(touching).join(several, "shape", "left_semi").join(points, "shape")
        .join(both(met, "part").distinct(), ["shape", "other", "part"], "left_anti")
    )
    sides = away.join(edges.select(F.col("shape").alias("other"), "ax", "ay", "bx", "by"), "other")
    px, py = F.col("point.ax"), F.col("point.ay")
    left = (F.col("bx") - F.col("ax")) * (py - F.col("ay")) - (F.col("by") - F.col("ay")) * (px - F.col("ax"))
    up, down = (F.col("ay") <= py) & (F.col("by") > py), (F.col("ay") > py) & (F.col("by") <= py)
    turns = F.sum(F.when(up & (left > 0), 1).when(down & (left < 0), -1).otherwise(0))
    within = sides.groupBy("shape", "other", "part").agg(turns.alias("turns")).where("turns <> 0")
    return within.select(F.least("shape", "other").alias("one"), F.greatest("shape", "other").alias("two")).distinct()


def zone_adjacency(
    polygons: DataFrame,
    cell_size: float | None = None,
    zone: str = ZONE,
    tolerance: float = 1e-9,
    crowded: int = 256,
) -> DataFrame:
    """Edge table ``(zone_id, neighbor_id)`` of zones that touch, in both directions.

    A zone may have several rings, one per row; rows whose column ``hole`` (where there is one) is
    true are cut out of it. Zones touch if their boundaries meet somewhere and their interiors
    overlap nowhere, so a zone that fills another's hole is its neighbour, and one that touches a
    part and overlaps another is not. Rows without a ring are ignored, as is a ring given twice.

    ``cell_size`` defaults to the median edge extent; cells of more than ``crowded`` edges are cut
    finer before pairs are formed. Zones of equal rings are tested once: they overlap each other, and
    all of them touch what one touches.
    """
    hole = F.coalesce("hole", F.lit(False)) if "hole" in polygons.columns else F.lit(False)
    rings = polygons.where(F.col("ring").isNotNull()).select(F.col(zone).alias(ZONE), hole.alias("hole"), "ring")
    rings = stage(rings.withColumn("part", F.unhex(F.sha2(F.to_json(F.struct("ring", "hole")), 256))), "rings")
    owners = stage(_shapes(rings), "shapes")
    one_each = owners.groupBy("shape").agg(F.min(ZONE).alias(ZONE), F.any_value("parts").alias("parts"))
    outlines = rings.join(one_each, ZONE).groupBy("shape", "part").agg(
        F.any_value("ring").alias("ring"), F.any_value("hole").alias("hole"), F.any_value("parts").alias("parts")
    )
    edges = stage(polygon_edges(outlines, "shape", "part", "parts", snap=tolerance), "edges")
    extent = F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay")))
    typical, parts = edges.agg(F.percentile_approx(extent, 0.5), F.max("parts")).first()
    if typical is None:
        return owners.select(ZONE, F.col(ZONE).alias("neighbor_id")).where("false")
    size, edges = F.lit(float(cell_size or typical)), edges.drop("parts")

    placed = _spread(edges, size, tolerance, crowded)
    left, right = placed.alias("l"), placed.alias("r")
    same_cell = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in CELL]
    contacts = _contacts(tolerance)
    met = (
        left.join(right, same_cell + [_boxes_meet(tolerance), F.col("l.shape") < F.col("r.shape")])
        # Inlining an array fixes the measures: a plain projection would be repeated for each use
        # when the filter below is pushed into the join.
        .select(
            F.col("l.shape").alias("one"), F.col("l.part").alias("one_part"),
            F.col("r.shape").alias("two"), F.col("r.part").alias("two_part"),
            F.inline(F.array(F.struct(*_measures()))),
        )
        .withColumns(contacts)
        .where(reduce(lambda a, b: a | b, [F.col(name) for name in contacts]))
        .groupBy("one", "two", "one_part", "two_part")
        .agg(F.bool_or(_interiors_overlap()).alias("_overlap"))
    )
    met = stage(met, "met") if parts > 1 else met
    touching = met.groupBy("one", "two").agg(F.bool_or("_overlap").alias("_overlap")).where(~F.col("_overlap"))
    if parts > 1:
        touching = touching.join(_hidden(touching, met, edges), ["one", "two"], "left_anti")
    one = owners.select(F.col(ZONE).alias("_first"), F.col("shape").alias("one"))
    two = owners.select(F.col(ZONE).alias("_second"), F.col("shape").alias("two"))
    pairs = touching.join(one, "one").join(two, "two").where(F.col("_first") != F.col("_second"))
    both = F.array(
        F.struct(F.col("_first").alias(ZONE), F.col("_second").alias("neighbor_id")),
        F.struct(F.col("_second").alias(ZONE), F.col("_first").alias("neighbor_id")),
    )
    return pairs.select(F.inline(both)).distinct()


def neighbor_lists(edges: DataFrame, zones: DataFrame | None = None, zone: str = ZONE) -> DataFrame:
    """Sorted distinct neighbours per zone; with ``zones``, one without any gets the list [-1]."""
    lists = edges.groupBy(zone).agg(F.sort_array(F.collect_set("neighbor_id")).alias("neighbors"))
    if zones is None:
        return lists
    none = F.array(F.lit(NO_NEIGHBOR))
    return zones.select(zone).distinct().join(lists, zone, "left").withColumn(
        "neighbors", F.coalesce("neighbors", none)
    )


def load_or_build_adjacency(polygons: DataFrame, path: str, cell_size: float | None = None) -> DataFrame:
    """Read the edge table at ``path``; build and write it where there is none yet."""
    spark = polygons.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        zone_adjacency(polygons, cell_size).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def neighbor_sums(
    cells: DataFrame, edges: DataFrame, targets: Sequence[str] = TARGETS, zone: str = ZONE, bin: str = BIN, width: int | None = None
) -> DataFrame:
    """Pickups of the zones beside each zone, per hour; empty hours send nothing.

    Summed on (zone, hour), so a zone with very many neighbours is spread over its hours, in ``width``
    partitions where the session has fewer.
    """
    any_pickup = reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(0)) != 0 for t in targets])
    busy = cells.where(F.col(bin).isNotNull() & any_pickup)
    pairs = (
        busy.select(F.col(zone).alias("neighbor_id"), bin, *targets)
        .join(small(edges.select(zone, "neighbor_id"), "edges"), "neighbor_id")
    )
    if width is not None and width > int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        pairs = pairs.repartition(width, zone, bin)
    return pairs.groupBy(zone, bin).agg(*[F.sum(t).alias(f"neighbor_pickups_{t}") for t in targets])


def neighbor_demand(
    panel: DataFrame, edges: DataFrame, targets: Sequence[str] = TARGETS, zone: str = ZONE, bin: str = BIN
) -> DataFrame:
    """Add the neighbours' pickups of the same hour, 0 where there are none."""
    sums = neighbor_sums(panel, edges, targets, zone, bin)
    return zero_filled(
        panel.join(sums, [zone, bin], "left"), [f"neighbor_pickups_{t}" for t in targets]
    )
