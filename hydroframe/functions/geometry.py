"""Extent predicates and clipping.

Geometry is plain nested data: a ring is ``array<struct<x: double, y: double>>`` and a
polygon is ``array<ring>``. Clipping a ring to a rectangle is Sutherland-Hodgman written
with Spark higher-order functions (``transform``/``flatten``/``aggregate``), so it runs in
the JVM next to the scan instead of in a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hydroframe.params import Extent


def box_meets_extent(ext: Extent, xmin="xmin", ymin="ymin", xmax="xmax", ymax="ymax") -> Column:
    """C1 for features with a bounding box: keep boxes that meet the rectangle (edges count)."""
    return ((F.col(xmax) >= F.lit(ext.west)) & (F.col(xmin) <= F.lit(ext.east))
            & (F.col(ymax) >= F.lit(ext.south)) & (F.col(ymin) <= F.lit(ext.north)))


def point_in_extent(ext: Extent, lat="lat", lon="lon") -> Column:
    """C1 for points/cells: both ends in (``between``). Pushes down to parquet on raw columns."""
    return (F.col(lat).between(F.lit(ext.south), F.lit(ext.north))
            & F.col(lon).between(F.lit(ext.west), F.lit(ext.east)))


def clip_box(ext: Extent, xmin="xmin", ymin="ymin", xmax="xmax", ymax="ymax") -> dict[str, Column]:
    """C2 for boxes: the intersection rectangle, as replacement columns."""
    return {
        xmin: F.greatest(F.col(xmin), F.lit(ext.west)),
        xmax: F.least(F.col(xmax), F.lit(ext.east)),
        ymin: F.greatest(F.col(ymin), F.lit(ext.south)),
        ymax: F.least(F.col(ymax), F.lit(ext.north)),
    }


def box_not_empty(xmin="xmin", ymin="ymin", xmax="xmax", ymax="ymax") -> Column:
    """A clipped box with positive area (a box that only touches the edge is dropped)."""
    return (F.col(xmin) < F.col(xmax)) & (F.col(ymin) < F.col(ymax))


def extent_struct(ext: Extent) -> Column:
    """The (buffered) rectangle as a per-row struct."""
    return F.struct(F.lit(ext.west).alias("west"), F.lit(ext.south).alias("south"),
                    F.lit(ext.east).alias("east"), F.lit(ext.north).alias("north"))


# --- rings ---------------------------------------------------------------------------------

_names = iter(range(10**9))


def let(expr: str, body) -> str:
    """Bind ``expr`` to a fresh lambda name once: ``body(name)`` sees the value, the
    expression is evaluated a single time however often ``body`` refers to it."""
    v = f"_v{next(_names)}"
    return f"element_at(transform(array({expr}), {v} -> {body(v)}), 1)"


def open_ring_sql(ring: str) -> str:
    """GeoJSON ring ``array<array<double>>`` (closed) -> open ``array<struct<x,y>>``."""
    def body(r):
        pts = f"transform({r}, p -> named_struct('x', CAST(p[0] AS DOUBLE), 'y', CAST(p[1] AS DOUBLE)))"
        return (f"CASE WHEN size({r}) > 1 AND {r}[0][0] = {r}[size({r})-1][0] "
                f"AND {r}[0][1] = {r}[size({r})-1][1] "
                f"THEN slice({pts}, 1, size({r}) - 1) ELSE {pts} END")
    return let(ring, body)


def _half_plane_sql(pts: str, axis: str, bound: float, keep_ge: bool) -> str:
    """One Sutherland-Hodgman pass: keep the side ``axis >= bound`` (or ``<=``)."""
    other = "y" if axis == "x" else "x"
    op = ">=" if keep_ge else "<="
    b = repr(float(bound))

    def inside(p):
        return f"({p}.{axis} {op} {b})"

    def cut(a, c):
        t = f"(({b} - {a}.{axis}) / ({c}.{axis} - {a}.{axis}))"
        return (f"named_struct('{axis}', {b}, '{other}', {a}.{other} + {t} * ({c}.{other} - {a}.{other}))"
                if axis == "x" else
                f"named_struct('x', {a}.x + {t} * ({c}.x - {a}.x), 'y', {b})")

    def body(ps):
        i = f"{ps}_i"
        cur = f"element_at({ps}, {i} + 1)"
        prev = f"element_at({ps}, CASE WHEN {i} = 0 THEN size({ps}) ELSE {i} END)"
        step = (f"CASE WHEN {inside(cur)} AND {inside(prev)} THEN array({cur}) "
                f"WHEN {inside(cur)} THEN array({cut(prev, cur)}, {cur}) "
                f"WHEN {inside(prev)} THEN array({cut(prev, cur)}) "
                f"ELSE CAST(array() AS array<struct<x: double, y: double>>) END")
        return (f"CASE WHEN size({ps}) = 0 THEN {ps} "
                f"ELSE flatten(transform(sequence(0, size({ps}) - 1), {i} -> {step})) END")
    return let(pts, body)


def clip_ring_sql(pts: str, ext: Extent) -> str:
    """An open ring clipped to the rectangle by four half-plane passes."""
    out = pts
    for axis, bound, ge in (("x", ext.west, True), ("x", ext.east, False),
                            ("y", ext.south, True), ("y", ext.north, False)):
        out = _half_plane_sql(out, axis, bound, ge)
    return out


def ring_area_sql(pts: str) -> str:
    """Shoelace area of an open ring (absolute value)."""
    def body(p):
        i = f"{p}_i"
        nxt = f"element_at({p}, CASE WHEN {i} + 1 = size({p}) THEN 1 ELSE {i} + 2 END)"
        cur = f"element_at({p}, {i} + 1)"
        return (f"CASE WHEN size({p}) < 3 THEN CAST(0 AS DOUBLE) ELSE abs(aggregate(sequence(0, size({p}) - 1), "
                f"CAST(0 AS DOUBLE), (acc, {i}) -> acc + {cur}.x * {nxt}.y - {nxt}.x * {cur}.y) / 2) END")
    return let(pts, body)


def clip_polygon_sql(rings: str, ext: Extent) -> str:
    """C2+C3 for polygons: clip every ring, drop rings that vanished."""
    return f"filter(transform({rings}, r -> {clip_ring_sql('r', ext)}), r -> size(r) > 2)"


def clip_polygon(rings_col: str, ext: Extent) -> Column:
    """C2+C3 for polygons: ``array<array<struct<x,y>>>`` (open rings) clipped to the rectangle."""
    return F.expr(clip_polygon_sql(rings_col, ext))


# --- lines ---------------------------------------------------------------------------------

def _segment_clip_sql(a: str, b: str, ext: Extent) -> str:
    """Liang-Barsky: the part of segment a->b inside the rectangle, as
    ``named_struct('t0', …, 't1', …)``; kept when t0 < t1 (a positive length)."""
    W, S, E, N = (repr(float(v)) for v in (ext.west, ext.south, ext.east, ext.north))
    dx, dy = f"({b}.x - {a}.x)", f"({b}.y - {a}.y)"
    # (p, q) per boundary: entering when p < 0, leaving when p > 0, t = q / p
    pq = [(f"(-{dx})", f"({a}.x - {W})"), (dx, f"({E} - {a}.x)"),
          (f"(-{dy})", f"({a}.y - {S})"), (dy, f"({N} - {a}.y)")]
    enter = ", ".join(f"CASE WHEN {p} < 0 THEN {q} / {p} END" for p, q in pq)
    leave = ", ".join(f"CASE WHEN {p} > 0 THEN {q} / {p} END" for p, q in pq)
    outside_parallel = " OR ".join(f"({p} = 0 AND {q} < 0)" for p, q in pq)
    return (f"CASE WHEN {outside_parallel} THEN named_struct('t0', 1D, 't1', 0D) "
            f"ELSE named_struct('t0', greatest(0D, {enter}), 't1', least(1D, {leave})) END")


def clip_line_sql(line: str, ext: Extent) -> str:
    """C2 for a polyline: the pieces inside the rectangle, consecutive pieces merged back
    into polylines (an ``array<array<struct<x, y>>>``, empty when nothing is inside)."""
    pt_t = "struct<x: double, y: double>"

    def body(ln):
        i = f"{ln}_i"
        a, b = f"element_at({ln}, {i} + 1)", f"element_at({ln}, {i} + 2)"

        def seg(t):
            def piece(tt):
                return (f"CASE WHEN {tt}.t0 < {tt}.t1 THEN array(named_struct("
                        f"'a', named_struct('x', {a}.x + {tt}.t0 * ({b}.x - {a}.x), 'y', {a}.y + {tt}.t0 * ({b}.y - {a}.y)), "
                        f"'b', named_struct('x', {a}.x + {tt}.t1 * ({b}.x - {a}.x), 'y', {a}.y + {tt}.t1 * ({b}.y - {a}.y)))) "
                        f"ELSE CAST(array() AS array<struct<a: {pt_t}, b: {pt_t}>>) END")
            return let(t, piece)
        pieces = (f"flatten(transform(sequence(0, size({ln}) - 2), {i} -> "
                  f"{seg(_segment_clip_sql(a, b, ext))}))")
        merged = (f"aggregate({pieces}, CAST(array() AS array<array<{pt_t}>>), (acc, s) -> "
                  f"CASE WHEN size(acc) > 0 AND element_at(element_at(acc, -1), -1) = s.a "
                  f"THEN concat(slice(acc, 1, size(acc) - 1), array(concat(element_at(acc, -1), array(s.b)))) "
                  f"ELSE concat(acc, array(array(s.a, s.b))) END)")
        return f"CASE WHEN size({ln}) < 2 THEN CAST(array() AS array<array<{pt_t}>>) ELSE {merged} END"
    return let(line, body)


def line_length_sql(line: str) -> str:
    """Planar length of a polyline (sum of segment lengths)."""
    def body(ln):
        i = f"{ln}_i"
        a, b = f"element_at({ln}, {i} + 1)", f"element_at({ln}, {i} + 2)"
        return (f"CASE WHEN size({ln}) < 2 THEN 0D ELSE aggregate(sequence(0, size({ln}) - 2), 0D, "
                f"(acc, {i}) -> acc + sqrt(pow({b}.x - {a}.x, 2) + pow({b}.y - {a}.y, 2))) END")
    return let(line, body)
