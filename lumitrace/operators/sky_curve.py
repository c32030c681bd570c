"""A space-filling key of sky positions, and the key ranges of a cone.

The sphere is projected onto the six faces of a cube. A face is a quadtree of
DEPTH levels, and the key is the face number followed by the interleaved bits
of both face coordinates, so every cell of the quadtree is one range of keys.
Tables sorted by the key keep neighbours on the sky together at the poles and
at RA 0 as anywhere else.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumitrace.functions.sky import unit_vector

# Quadtree levels of a face: the smallest cells are about 0.3 arcsec wide.
DEPTH = 20
# Ranges of a cone at most; more of them follow its edge more closely.
RANGES = 64
KEY = "sky_key"

# Interleaving doubles the distance of bits step by step: shift, and the bits that stay.
_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _spread(place: Column) -> Column:
    """The bits of a number, each followed by a free one."""
    for shift, mask in _SPREAD:
        place = F.shiftleft(place, shift).bitwiseOR(place).bitwiseAND(F.lit(mask))
    return place


def sky_key(ra: str | Column, dec: str | Column) -> Column:
    """Key of a position; NULL where a coordinate is."""
    axes = F.array(*unit_vector(ra, dec))

    def key(v: Column) -> Column:
        x, y, z = v[0], v[1], v[2]
        ax, ay, az = F.abs(x), F.abs(y), F.abs(z)
        # The axis that is longest, and the other two in the order x, y, z.
        on_x, on_y = (ax >= ay) & (ax >= az), ay >= az
        main = F.when(on_x, x).when(on_y, y).otherwise(z)
        u = F.when(on_x, y).otherwise(x)
        w = F.when(on_x, z).when(on_y, z).otherwise(y)
        face = F.when(on_x, 0).when(on_y, 2).otherwise(4) + F.when(main < 0, 1).otherwise(0)
        return F.struct(face.cast("long").alias("face"), _place(u / F.abs(main)).alias("i"), _place(w / F.abs(main)).alias("j"))

    # Each step is a lambda over one value, so its parts are worked out once.
    cell = F.get(F.transform(F.array(axes), key), 0)
    bits = F.transform(F.array(cell), lambda c: F.shiftleft(c["face"], 2 * DEPTH) + F.shiftleft(_spread(c["i"]), 1) + _spread(c["j"]))
    return F.get(bits, 0)


def _place(slope: Column) -> Column:
    """Place of a face coordinate (-1 to 1) among 2**DEPTH; the arc tangent makes cells about equally wide."""
    share = (F.atan(slope) * (4 / math.pi) + 1.0) / 2
    # Only the far end of a face is past its last cell.
    return F.floor(F.when(share < 1.0, share).otherwise(share * (1 - 0.5 ** (DEPTH + 1))) * 2**DEPTH).cast("long")


def _direction(face: int, s: float, t: float) -> tuple[float, float, float]:
    """Unit vector at the shares s, t of a face."""
    u, w = math.tan((2 * s - 1) * math.pi / 4), math.tan((2 * t - 1) * math.pi / 4)
    main = -1.0 if face % 2 else 1.0
    x = {0: (main, u, w), 1: (u, main, w), 2: (u, w, main)}[face // 2]
    norm = math.sqrt(sum(c * c for c in x))
    return tuple(c / norm for c in x)


def _angle(a, b) -> float:
    """Angle of two unit vectors, exact for small ones as well."""
    return 2 * math.asin(min(1.0, math.dist(a, b) / 2))


def cone_ranges(ra_deg: float, dec_deg: float, radius_deg: float, limit: int = RANGES) -> list[tuple[int, int]]:
    """Ranges of keys, ends included, that hold every position of a cone: `limit` of them at most, in order.

    Cells at the edge of the cone are divided, the widest first, until they
    are small against the cone or there are enough of them. A cell of a face
    is a convex polygon of great circles, so the circle around its middle
    that holds its corners holds all of it.
    """
    a, d = math.radians(ra_deg), math.radians(dec_deg)
    centre = (math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d))
    radius = math.radians(min(max(radius_deg, 0.0), 180.0)) + 1e-9

    def look(face: int, level: int, i: int, j: int):
        """(-circle, face, level, i, j, inside), None if the cone does not meet the cell."""
        width = 0.5**level
        middle = _direction(face, (i + 0.5) * width, (j + 0.5) * width)
        circle = max(_angle(middle, _direction(face, (i + p) * width, (j + q) * width)) for p in (0, 1) for q in (0, 1)) * (1 + 1e-9) + 1e-9
        away = _angle(middle, centre)
        return None if away > radius + circle else (-circle, face, level, i, j, away + circle <= radius)

    edge = [c for c in (look(face, 0, 0, 0) for face in range(6)) if c]
    heapq.heapify(edge)
    done = []
    while edge:
        cell = heapq.heappop(edge)
        circle, face, level, i, j, inside = cell
        if inside or level == DEPTH or -circle < radius / 16 or len(edge) + len(done) + 4 > limit:
            done.append(cell)
            continue
        for p in (0, 1):
            for q in (0, 1):
                if part := look(face, level + 1, 2 * i + p, 2 * j + q):
                    heapq.heappush(edge, part)
    ranges = []
    for _, face, level, i, j, _ in done:
        bits = face
        for k in reversed(range(level)):
            bits = bits << 2 | (i >> k & 1) << 1 | (j >> k & 1)
        below = 2 * (DEPTH - level)
        ranges.append((bits << below, (bits + 1 << below) - 1))
    merged = []
    for low, high in sorted(ranges):
        if merged and low <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def in_ranges(ranges: list[tuple[int, int]], low: str = KEY, high: str = KEY) -> Column:
    """Whether a key, or a stretch of keys from `low` to `high`, meets one of the ranges."""
    tests = [(F.col(high) >= F.lit(a)) & (F.col(low) <= F.lit(b)) for a, b in ranges]
    out = F.lit(False)
    for test in tests:
        out = out | test
    return out
