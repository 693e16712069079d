from __future__ import annotations

import random
from itertools import combinations, permutations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from zonecast.operators.spatial import (
    _spread, load_or_build_adjacency, neighbor_demand, neighbor_lists, polygon_edges, zone_adjacency,
)

SCHEMA = "zone_id int, ring array<struct<x: double, y: double>>"


def polygons(spark, *shapes):
    data = [(zone, [(float(x), float(y)) for x, y in points]) for zone, points in shapes]
    return spark.createDataFrame(data, SCHEMA)


def box(x, y, w=1, h=1):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def touch(spark, *shapes, **options):
    return rows(zone_adjacency(polygons(spark, *shapes), **options), "zone_id", "neighbor_id")


NOTCHED = [(0, 0), (3, 0), (3, 3), (2, 3), (2, 1), (1, 1), (1, 3), (0, 3)]
CASES = {
    "shared edge": (box(0, 0), box(1, 0), True),
    "corner": (box(0, 0), box(1, 1), True),
    "end of one edge within another": (box(0, 0), box(1, 0.25, 1, 0.5), True),
    "partly shared edge": (box(0, 0), box(1, 0.5), True),
    "crossing": (box(0, 0), box(0.5, 0.5), False),
    "cross": (box(0, 1, 3, 1), box(1, 0, 1, 3), False),
    "within": (box(0, 0, 3, 3), box(1, 1), False),
    "within, sharing an edge": (box(0, 0, 3, 3), box(0, 1), False),
    "within, sharing a corner": (box(0, 0, 3, 3), box(0, 0), False),
    "same": (box(0, 0), box(0, 0), False),
    "same, other start": (box(0, 0)[:4], [(1, 1), (0, 1), (0, 0), (1, 0)], False),
    "apart": (box(0, 0), box(2, 0), False),
    "fills a notch": (NOTCHED, box(1, 1, 1, 2), True),
    "stands in a notch": (NOTCHED, box(1.25, 1, 0.5, 1), True),
    "hovers in a notch": (NOTCHED, box(1.25, 1.25, 0.5, 0.5), False),
    "breaks a notch": (NOTCHED, box(1, 0.5, 1, 2), False),
    "corner on an edge": (box(0, 0, 2, 2), [(1, 2), (2, 3), (0, 3)], True),
    "corner through an edge": (box(0, 0, 2, 2), [(1, 1), (2, 3), (0, 3)], False),
    "thirds": ([(0, 0), (1, 0), (0, 1)], [(1 / 3, 2 / 3), (1, 1), (0, 2)], True),
}


def moved(points, step):
    return [(x + 20 * step, y) for x, y in points]


@pytest.mark.parametrize("turned,swapped,size", [(0, 0, None), (1, 0, 0.7), (2, 1, 5)])
def test_pairs(spark, turned, swapped, size):
    """All cases side by side, in either turn and order, on cells of several sizes."""
    shapes, expected = [], []
    for step, (first, second, touching) in enumerate(CASES.values()):
        pair = [moved(first, step), moved(second, step)]
        pair = [p[::-1] if turned > i else p for i, p in enumerate(pair)][:: -1 if swapped else 1]
        one, two = 2 * step, 2 * step + 1
        shapes += [(one, pair[0]), (two, pair[1])]
        expected += [(one, two), (two, one)] if touching else []
    got = touch(spark, *shapes, cell_size=size)
    names = list(CASES)
    assert {names[z // 2] for z, _ in set(got) ^ set(expected)} == set()


def test_grid_of_squares_with_an_island(spark):
    shapes = [(i, box(i % 5, i // 5)) for i in range(24)] + [(24, box(100, 100))]
    edges = zone_adjacency(polygons(spark, *shapes)).cache()
    assert edges.count() == 138
    assert edges.where("zone_id = neighbor_id").count() == 0
    lists = dict(rows(neighbor_lists(edges, polygons(spark, *shapes))))
    assert lists[0] == [1, 5, 6] and lists[24] == [-1]


def test_copies_and_parts_of_a_zone(spark):
    shapes = [(1, box(0, 0)), (2, box(1, 0)), (3, box(0, 0)), (1, box(9, 9)), (4, box(9, 10))]
    expected = [(1, 2), (1, 4), (2, 1), (2, 3), (3, 2), (4, 1)]
    assert touch(spark, *shapes) == expected


def _projection(points, axis):
    values = [x * axis[0] + y * axis[1] for x, y in points]
    return min(values), max(values)


def touching_triangles(a, b):
    """Exact test on whole numbers: closed triangles meet, open ones do not (separating axes)."""
    meet, overlap = True, True
    for t in (a, b):
        for (x1, y1), (x2, y2) in combinations(t, 2):
            axis = (y1 - y2, x2 - x1)
            (lo1, hi1), (lo2, hi2) = _projection(a, axis), _projection(b, axis)
            meet &= lo1 <= hi2 and lo2 <= hi1
            overlap &= lo1 < hi2 and lo2 < hi1
    return meet and not overlap


@pytest.mark.parametrize("crowded", [256, 4])
def test_random_triangles_against_brute_force(spark, crowded):
    source = random.Random(7)
    shapes = []
    while len(shapes) < 220:
        t = [(source.randint(0, 14), source.randint(0, 14)) for _ in range(3)]
        (x1, y1), (x2, y2), (x3, y3) = t
        area = (x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)
        if 0 < abs(area) <= 12:
            shapes.append((len(shapes), t))
    expected = sorted(
        (i, j) for (i, a), (j, b) in permutations(shapes, 2) if touching_triangles(a, b)
    )
    assert len(expected) > 100
    assert touch(spark, *shapes, crowded=crowded) == expected


def zones_of_parts(seed):
    """Zones of boxes and frames on whole numbers: (zone, pieces that fill it, rings with their hole mark)."""
    draw, zones = random.Random(seed), []
    for zone in range(70):
        pieces, rings, parts = [], [], draw.choice([1, 1, 2, 3])
        for _ in range(parts):
            x, y, w, h = draw.randrange(24), draw.randrange(24), draw.randint(1, 5), draw.randint(1, 5)
            spread = [(x, y, w, h)]
            rings.append((box(x, y, w, h), False))
            if w > 2 and h > 2:
                spread = [(x, y, 1, h), (x + w - 1, y, 1, h), (x, y, w, 1), (x, y + h - 1, w, 1)]
                rings.append((box(x + 1, y + 1, w - 2, h - 2)[:: draw.choice([1, -1])], True))
            if any(overlapping(a, b) for a in spread for b in pieces):
                rings = rings[: -1 if len(spread) == 1 else -2]
                continue
            pieces += spread
        zones.append((zone, pieces, rings))
    return zones


def overlapping(a, b):
    return all(a[k] < b[k] + b[k + 2] and b[k] < a[k] + a[k + 2] for k in range(2))


def meeting(a, b):
    return all(a[k] <= b[k] + b[k + 2] and b[k] <= a[k] + a[k + 2] for k in range(2))


@pytest.mark.parametrize("seed,crowded", [(1, 256), (2, 6)])
def test_zones_of_several_parts_and_holes_against_brute_force(spark, seed, crowded):
    zones = zones_of_parts(seed)
    data = [(z, hole, [(float(x), float(y)) for x, y in ring]) for z, _, rings in zones for ring, hole in rings]
    shapes = spark.createDataFrame(data, "zone_id int, hole boolean, ring array<struct<x: double, y: double>>")
    expected = sorted(
        (i, j) for (i, a, _), (j, b, _) in permutations(zones, 2)
        if any(meeting(x, y) for x in a for y in b) and not any(overlapping(x, y) for x in a for y in b)
    )
    assert len(expected) > 40
    got = rows(zone_adjacency(shapes, crowded=crowded), "zone_id", "neighbor_id")
    assert got == expected


def test_a_ring_within_another_zone_that_meets_no_edge(spark):
    big, hole = box(0, 0, 9, 9), box(6, 6, 2, 2)
    data = [
        (1, False, big), (1, True, hole), (2, False, box(9, 0)), (2, False, box(2, 2)), (3, False, box(9, 2)),
        (3, None, box(6.5, 6.5, 1, 1)), (4, False, hole), (5, False, box(6, 6, 1, 1)), (5, False, None),
    ]
    data = [(z, h, r and [(float(x), float(y)) for x, y in r]) for z, h, r in data]
    shapes = spark.createDataFrame(data, "zone_id int, hole boolean, ring array<struct<x: double, y: double>>")
    assert rows(zone_adjacency(shapes), "zone_id", "neighbor_id") == [(1, 3), (1, 4), (1, 5), (3, 1), (4, 1), (5, 1)]


def test_cells_are_cut_until_none_is_crowded(spark):
    """Two far clusters of small boxes in one cell are told apart; a fan of triangles stays one cell."""
    clusters = [(i, box(1000 * (i % 2) + i // 2 % 20 * 0.01, i // 40 * 0.01, 0.01, 0.01)) for i in range(800)]
    rings = polygons(spark, *clusters).selectExpr("zone_id", "ring", "false AS hole")
    made = polygon_edges(rings, "zone_id")
    cells = _spread(made, F.lit(5000.0), 1e-9, 32)
    load = cells.groupBy("_size", "_cx", "_cy").count().agg(F.max("count"), F.sum("count")).first()
    assert load[0] <= 32 and load[1] < 10 * 3200
    fan = [(i, [(0, 0), (100 + i, 100), (100, 101 + i)]) for i in range(60)]
    made = polygon_edges(polygons(spark, *fan).selectExpr("zone_id", "ring", "false AS hole"), "zone_id")
    cells = _spread(made, F.lit(200.0), 1e-9, 32)
    assert cells.count() < 20 * 180


def test_crowded_cell_of_copies(spark):
    shapes = [(i, box(0, 0)) for i in range(400)] + [(1000, box(1, 0))]
    edges = zone_adjacency(polygons(spark, *shapes), crowded=4)
    assert edges.count() == 800


def test_adjacency_is_kept_on_disk(spark, tmp_path):
    path = str(tmp_path / "edges")
    first = load_or_build_adjacency(polygons(spark, (1, box(0, 0)), (2, box(1, 0))), path)
    again = load_or_build_adjacency(polygons(spark, (1, box(0, 0)), (2, box(5, 0))), path)
    assert rows(first) == rows(again) == [(1, 2), (2, 1)]


def test_neighbor_demand_counts_the_same_hour_only(spark):
    panel = spark.createDataFrame(
        [("00", 1, 5, 0, 1), ("00", 2, 7, 0, 0), ("01", 1, 1, 2, 3), ("01", 2, 0, 0, 0), ("01", 3, 4, 4, 4)],
        "bin string, zone_id int, target_yellow int, target_green int, target_hvfhv int",
    )
    edges = spark.createDataFrame([(1, 2), (2, 1), (3, 9)], "zone_id int, neighbor_id int")
    got = rows(neighbor_demand(panel, edges), "bin", "zone_id", "neighbor_pickups_target_yellow")
    assert got == [("00", 1, 7), ("00", 2, 5), ("01", 1, 0), ("01", 2, 1), ("01", 3, 0)]
