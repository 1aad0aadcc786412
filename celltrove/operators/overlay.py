"""Polygons of several parts with holes: cut to boxes, and repaired where rings cross themselves.

A polygon is a list of rings under the even-odd rule; a result is a list of parts, each its outer
ring (counter-clockwise) and then its holes (clockwise).  The helpers work on one polygon's points;
Spark deals the polygons, and a polygon is one row.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..workers import ship

Point = tuple[float, float]
Ring = list[Point]

_PARTS = "array<array<array<struct<x: double, y: double>>>>"
#: Points nearer than this share of a polygon's size are one.
SNAP = 1e-10


def turn(ring: Ring) -> float:
    """Signed area: above 0 if the ring runs counter-clockwise."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def odd_inside(x: float, y: float, ring: Ring) -> bool:
    return sum((a[1] > y) != (b[1] > y) and x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) % 2 == 1


def half_plane(rings: list[Ring], axis: int, limit: float, sign: int) -> list[Ring]:
    """The rings' area on one side of a line along an axis; a ring that the line cuts twice or more falls apart.

    Chains of points inside run from where a ring enters to where it leaves.  Sorted along the line, the
    first crossing and the second have the area between them, so do the third and fourth; chains are
    joined there.  Points on the line count as outside, so an edge along it joins nothing.
    """
    whole, chains = [], []
    for ring in rings:
        depth = [sign * (p[axis] - limit) for p in ring]
        if min(depth) >= 0:
            whole.append(ring)
        elif max(depth) > 0:
            start = next(i for i, d in enumerate(depth) if d < 0)
            chain: Ring | None = None
            for i in range(start, start + len(ring)):
                (a, da), (b, db) = ((ring[j % len(ring)], depth[j % len(ring)]) for j in (i, i + 1))
                if (da > 0) != (db > 0):
                    t = da / (da - db)
                    cut = [a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])]
                    cut[axis] = limit
                    if db > 0:
                        chain = [tuple(cut)]
                    else:
                        chains.append([*chain, tuple(cut)])
                        chain = None
                if db > 0:
                    chain.append(b)
    ends = sorted((c[-1 if last else 0][1 - axis], n, last) for n, c in enumerate(chains) for last in (False, True))
    partner = {}
    for (_, n, a), (_, m, b) in zip(ends[::2], ends[1::2], strict=True):
        partner[n, a], partner[m, b] = (m, b), (n, a)
    used = set()
    for n in range(len(chains)):
        if n in used:
            continue
        ring, at, forward = [], n, True
        while at not in used:
            used.add(at)
            ring += chains[at] if forward else chains[at][::-1]
            at, last = partner[at, forward]
            forward = not last
        whole.append(ring)
    return [r for r in (tidy(r) for r in whole) if len(r) >= 3 and turn(r) != 0]


def tidy(ring: Ring) -> Ring:
    """Without points that repeat the one before."""
    return [p for i, p in enumerate(ring) if p != ring[i - 1]] if len(ring) > 1 else ring


def in_parts(rings: list[Ring]) -> list[list[Ring]]:
    """Rings that do not cross as parts with their holes: a ring inside an odd number of others is a hole of the smallest of them."""
    size = [abs(turn(r)) for r in rings]

    def within(a: int, b: int) -> bool:
        # A place just inside the first ring's boundary, by its longest side.
        ring = rings[a]
        p, q = max(zip(ring, ring[1:] + ring[:1], strict=True), key=lambda e: math.dist(*e))
        d = math.dist(p, q)
        step = math.copysign(min(1e-7 * d, size[a] / d / 4), turn(ring)) / d
        return odd_inside((p[0] + q[0]) / 2 - step * (q[1] - p[1]), (p[1] + q[1]) / 2 + step * (q[0] - p[0]), rings[b])

    around = [[b for b in range(len(rings)) if b != a and size[b] >= size[a] and within(a, b)] for a in range(len(rings))]
    parts = {a: [rings[a] if turn(rings[a]) > 0 else rings[a][::-1]] for a in range(len(rings)) if len(around[a]) % 2 == 0}
    for a in range(len(rings)):
        if a not in parts:
            outer = min((b for b in around[a] if b in parts), key=lambda b: size[b])
            parts[outer].append(rings[a] if turn(rings[a]) < 0 else rings[a][::-1])
    return [parts[a] for a in sorted(parts, key=lambda a: (min(rings[a]), -size[a]))]


def box_parts(rings: list[Ring], box: tuple[float, float, float, float]) -> list[list[Ring]]:
    """The parts of a polygon inside a box."""
    xmin, ymin, xmax, ymax = box
    for axis, limit, sign in ((0, xmin, 1), (0, xmax, -1), (1, ymin, 1), (1, ymax, -1)):
        rings = half_plane(rings, axis, limit, sign)
    return in_parts(rings)


def _crossings(segments: list[tuple[Point, Point]], snap: float) -> list[tuple[Point, Point]]:
    """The segments cut wherever they meet, on points that are one if nearer than ``snap``."""
    known: dict[tuple[int, int], Point] = {}

    def node(p: Point) -> Point:
        i, j = round(p[0] / snap), round(p[1] / snap)
        for key in ((i + a, j + b) for a in (0, -1, 1) for b in (0, -1, 1)):
            if key in known:
                return known[key]
        known[i, j] = p
        return p

    segments = [(node(a), node(b)) for a, b in segments]
    on: list[list[tuple[float, Point]]] = [[(0.0, a), (1.0, b)] for a, b in segments]
    for i, (a, b) in enumerate(segments):
        for j in range(i + 1, len(segments)):
            c, d = segments[j]
            r, s, w = (b[0] - a[0], b[1] - a[1]), (d[0] - c[0], d[1] - c[1]), (c[0] - a[0], c[1] - a[1])
            cross = r[0] * s[1] - r[1] * s[0]
            if abs(cross) > 1e-14 * math.hypot(*r) * math.hypot(*s):
                t, u = (w[0] * s[1] - w[1] * s[0]) / cross, (w[0] * r[1] - w[1] * r[0]) / cross
                if -1e-12 <= t <= 1 + 1e-12 and -1e-12 <= u <= 1 + 1e-12:
                    p = node((a[0] + t * r[0], a[1] + t * r[1]))
                    on[i].append((t, p))
                    on[j].append((u, p))
            else:  # along each other: the ends that lie on the other
                for k, (p, q), ends in ((i, (a, b), (c, d)), (j, (c, d), (a, b))):
                    length = math.dist(p, q)
                    for e in ends:
                        if length and abs((q[0] - p[0]) * (e[1] - p[1]) - (q[1] - p[1]) * (e[0] - p[0])) <= snap * length:
                            t = ((e[0] - p[0]) * (q[0] - p[0]) + (e[1] - p[1]) * (q[1] - p[1])) / length**2
                            if 0 < t < 1:
                                on[k].append((t, e))
    return [(p, q) for points in map(sorted, on) for (_, p), (_, q) in itertools.pairwise(points) if p != q]


def repaired(rings: list[Ring]) -> list[list[Ring]]:
    """The even-odd area of rings that may cross or touch themselves and each other, as parts of simple rings.

    Segments are cut where they meet, pieces that lie on each other in pairs cancel out, and every
    other piece borders the area.  Directed to have it on the left, pieces are followed from point to
    point by the sharpest left turn, so that rings which touch in a point stay apart.
    """
    rings = [tidy(r) for r in rings if len(r) >= 3]
    points = [p for r in rings for p in r]
    if not points:
        return []
    reach = max(max(p[0] for p in points) - min(p[0] for p in points), max(p[1] for p in points) - min(p[1] for p in points))
    if not reach:
        return []
    count: dict[tuple[Point, Point], int] = {}
    for p, q in _crossings([(a, b) for r in rings for a, b in zip(r, r[1:] + r[:1], strict=True) if a != b], SNAP * reach):
        count[min((p, q), (q, p))] = count.get(min((p, q), (q, p)), 0) + 1
    after: dict[Point, list[Point]] = {}
    for (p, q), n in count.items():
        if n % 2:
            d = math.dist(p, q)
            step = min(1e-6 * reach, d / 8) / d
            left = ((p[0] + q[0]) / 2 - step * (q[1] - p[1]), (p[1] + q[1]) / 2 + step * (q[0] - p[0]))
            a, b = (p, q) if sum(odd_inside(*left, r) for r in rings) % 2 else (q, p)
            after.setdefault(a, []).append(b)
    done = []
    while after:
        start = min(after)
        ring, before, here = [], None, start
        while True:
            ways = after[here]
            if before is None or len(ways) == 1:
                there = ways[0]
            else:
                back = math.atan2(before[1] - here[1], before[0] - here[0])
                # From the way back clockwise: the first one met is the sharpest left turn.
                there = min(ways, key=lambda w: (back - math.atan2(w[1] - here[1], w[0] - here[0])) % (2 * math.pi) or 2 * math.pi)
            ways.remove(there)
            if not ways:
                del after[here]
            ring.append(here)
            before, here = here, there
            if here in ring:  # a ring is closed; what led to it goes on from here
                at = ring.index(here)
                done.append(ring[at:])
                ring = ring[:at]
                before = ring[-1] if ring else None
                if not ring:
                    break
        # Every piece that leads to a point has one that leads away, so the walk ends where it began.
    return in_parts([r for r in done if len(r) >= 3 and abs(turn(r)) > SNAP * reach * reach])


def _polygon(value: list | None, nested: bool) -> list[Ring]:
    rings = (value if nested else [value]) if value else []
    return [[(float(p["x"]), float(p["y"])) for p in r] for r in rings if r and all(p and p["x"] is not None and p["y"] is not None for p in r)]


def _shaped(parts: list[list[Ring]]) -> list:
    return [[[{"x": x, "y": y} for x, y in ring] for ring in part] for part in parts]


def _over_polygons(df: DataFrame, out: str, columns: tuple[str, ...], work) -> DataFrame:
    from .spatial import spread_rows

    ship(df.sparkSession)
    # Much work for a small row: the few splits of a small file would be as few tasks.
    df = spread_rows(df)
    nested = isinstance(df.schema["ring"].dataType.elementType, ArrayType)
    point = pa.struct([("x", pa.float64()), ("y", pa.float64())])

    @F.arrow_udf(_PARTS)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            done = [_shaped(work(_polygon(row["ring"], nested), *(row[c] for c in columns))) for row in batch.to_pylist()]
            yield pa.array(done, pa.list_(pa.list_(pa.list_(point))))

    return df.withColumn(out, run(F.struct("ring", *[F.col(c).cast("double").alias(c) for c in columns])))


def clip_parts(pairs: DataFrame, out: str = "parts") -> DataFrame:
    """Add the parts of ``ring`` (one ring, or rings under the even-odd rule) inside the box xmin..ymax; pairs without any go.

    Rings with a missing point or fewer than three are left out of their polygon.
    """
    return _over_polygons(pairs, out, ("xmin", "ymin", "xmax", "ymax"), lambda rings, *box: box_parts([r for r in rings if len(r) >= 3], box)).filter(F.size(out) > 0)


def repair(df: DataFrame, out: str = "parts") -> DataFrame:
    """Add the parts of simple rings that ``ring`` makes by the even-odd rule; none for a polygon without area."""
    return _over_polygons(df, out, (), lambda rings, *_: repaired(rings))


def parts_area(parts: str):
    """Area of parts: outer rings less holes."""
    from .spatial import signed_area

    return F.aggregate(F.transform(F.flatten(parts), signed_area), F.lit(0.0), lambda a, x: a + x)
