"""Local regression trend of a series (LOESS, degree 2, tricube weights).

`loess` fits directly at every observed point. `loess_curve` fits at few vertices and blends
between them, as plotting libraries do: the points of a series are halved at their middle until a
cell holds at most `floor(n * span * cell)` of them; the ends, widened a little, and the cuts are
the vertices. Each vertex gets the value and the slope of its own fit, and a point between two
vertices the cubic that takes on both values and both slopes. The number of vertices follows from
span and cell alone, so that the time is linear in the length of a series.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 0.75
#: Share of the span that a cell may hold, and share of the range added at both ends.
CELL, MARGIN = 0.2, 0.005
#: Points of a plotted curve.
CURVE_POINTS = 80
#: Longest series: four centuries of months.
MAX_POINTS = 5_000
_MOMENTS = ("n", "s0", "s1", "s2", "s3", "s4", "m0", "m1", "m2")


def loess(df: DataFrame, key: str, x: str, y: str, name: str = "tendencia",
          span: float = SPAN) -> DataFrame:
    """Fitted value at every observed point of each series; points with null y are left out.

    Each point is fitted directly on its `floor(span * n)` nearest neighbours.
    A series travels as one array of its points, so no pair of points ever
    becomes a row; its length is the number of months, not of registry rows.
    The fit takes time in the square of that length: a series of more than
    MAX_POINTS is an error.
    """
    point = F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    lists = (df.filter(F.col(y).isNotNull() & F.col(x).isNotNull())
             .groupBy(key).agg(F.sort_array(F.collect_list(point)).alias("pts")))
    near = F.floor(F.size("pts") * F.lit(span) + F.lit(1e-5)).cast("int")
    long = F.concat(F.lit(f"more than {MAX_POINTS} points in series "), F.col(key).cast("string"))
    lists = lists.withColumn("pts", F.when(F.size("pts") <= MAX_POINTS, F.col("pts")).otherwise(
        F.raise_error(long).cast(lists.schema["pts"].dataType)))
    sized = lists.withColumn("k", F.greatest(near, F.lit(1)))
    pts, k = F.col("pts"), F.col("k")
    # The bandwidth becomes a field of the point, so that it is sorted out once per point.
    wide = F.transform(pts, lambda p: F.struct(
        p["x"].alias("x"), p["y"].alias("y"), _bandwidth(pts, p["x"], k).alias("h")))
    fitted = F.transform(wide, lambda p: F.struct(
        p["x"].alias("x"), p["y"].alias("y"), _fit(pts, p["x"], p["h"]).alias("fit")))
    points = sized.select(key, F.explode(fitted).alias("p"))
    return points.select(key, F.col("p.x").alias(x), F.col("p.y").alias(y),
                         F.col("p.fit").alias(name))


def _bandwidth(pts: Column, x0: Column, k: Column) -> Column:
    """Distance to the k-th nearest point."""
    return F.try_element_at(
        F.array_sort(F.transform(pts, lambda p: F.abs(p["x"] - x0))), k)


def _fit(pts: Column, x0: Column, width: Column) -> Column:
    zero = F.struct(*[F.lit(0.0).alias(m) for m in _MOMENTS])
    return F.aggregate(pts, zero, lambda acc, p: _add(acc, p, x0, width), _solve)


def _add(acc: Column, p: Column, x0: Column, width: Column) -> Column:
    t = F.try_divide(p["x"] - x0, width)
    d = F.abs(t)
    fade = 1 - d * d * d
    weight = F.when(d < 1, fade * fade * fade).otherwise(0.0)
    powers = [F.lit(1.0), t, t * t, t * t * t, t * t * t * t]
    terms = {f"s{i}": weight * p_ for i, p_ in enumerate(powers)}
    terms |= {f"m{i}": weight * p_ * p["y"] for i, p_ in enumerate(powers[:3])}
    terms["n"] = F.when(d < 1, 1.0).otherwise(0.0)
    return F.struct(*[(acc[m] + F.coalesce(terms[m], F.lit(0.0))).alias(m) for m in _MOMENTS])


def _solve(s: Column) -> Column:
    """Intercept of the weighted quadratic, i.e. the fit at the point; null below three points."""
    _, s0, s1, s2, s3, s4, m0, m1, m2 = (s[m] for m in _MOMENTS)
    a = s2 * s4 - s3 * s3
    fit = F.try_divide(m0 * a - s1 * (m1 * s4 - s3 * m2) + s2 * (m1 * s3 - s2 * m2),
                       _determinant(s))
    return F.when(s["n"] >= 3, fit)


def _determinant(s: Column) -> Column:
    _, s0, s1, s2, s3, s4, *_ = (s[m] for m in _MOMENTS)
    return s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2)


def _slope(s: Column) -> Column:
    """Slope of the weighted quadratic at the point, in bandwidths; null below three points."""
    _, s0, s1, s2, s3, s4, m0, m1, m2 = (s[m] for m in _MOMENTS)
    top = s0 * (m1 * s4 - s3 * m2) - m0 * (s1 * s4 - s2 * s3) + s2 * (s1 * m2 - m1 * s2)
    return F.when(s["n"] >= 3, F.try_divide(top, _determinant(s)))


def loess_curve(df: DataFrame, key: str, x: str, y: str, name: str = "tendencia",
                span: float = SPAN, points: int | None = CURVE_POINTS) -> DataFrame:
    """The blended curve of each series at `points` equal steps from its first to its last x.

    Without `points` it is given at the observed x. A series travels as one array; a series with
    less than two x has null fits.
    """
    point = F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    lists = (df.filter(F.col(y).isNotNull() & F.col(x).isNotNull())
             .groupBy(key).agg(F.sort_array(F.collect_list(point)).alias("pts")))
    n, pts = F.size("pts"), F.col("pts")
    sized = lists.withColumns({
        "k": F.greatest(F.floor(n * F.lit(span) + F.lit(1e-5)).cast("int"), F.lit(1)),
        "most": F.greatest(F.floor(n * F.lit(span * CELL)).cast("int"), F.lit(1)),
        "lo": F.element_at("pts", 1)["x"], "hi": F.element_at("pts", -1)["x"],
        "cells": F.array(F.struct(F.lit(1).alias("a"), n.alias("b"))),
        "cuts": F.array().cast("array<double>")})
    # Halving until every cell is small enough takes so many steps for a series of any length.
    for _ in range(math.ceil(math.log2(1 / (span * CELL))) + 2):
        wide = lambda c: c["b"] - c["a"] + 1 > F.col("most")
        middle = lambda c: F.floor((c["a"] + c["b"]) / 2).cast("int")
        sized = sized.withColumns({
            "cuts": F.concat("cuts", F.transform(F.filter("cells", wide), lambda c: (
                F.element_at(pts, middle(c))["x"] + F.element_at(pts, middle(c) + 1)["x"]) / 2)),
            "cells": F.flatten(F.transform("cells", lambda c: F.when(wide(c), F.array(
                F.struct(c["a"].alias("a"), middle(c).alias("b")),
                F.struct((middle(c) + 1).alias("a"), c["b"].alias("b")))).otherwise(
                F.array(F.struct(c["a"].alias("a"), c["b"].alias("b"))))))})
    wider = MARGIN * F.greatest(F.col("hi") - F.col("lo"), F.greatest(
        F.abs("lo"), F.abs("hi")) * 1e-3 + 1e-30)
    ends = F.array(F.col("lo") - wider, F.col("hi") + wider)
    vertices = F.array_sort(F.array_distinct(F.concat(ends, "cuts")))
    placed = sized.select(key, "pts", "k", "lo", "hi", vertices.alias("vertices"))
    banded = placed.withColumn("vertices", F.transform("vertices", lambda v: F.struct(
        v.alias("x"), _bandwidth(pts, v, F.col("k")).alias("h"))))
    zero = F.struct(*[F.lit(0.0).alias(m) for m in _MOMENTS])
    summed = banded.withColumn("vertices", F.transform("vertices", lambda v: F.struct(
        v["x"].alias("x"), v["h"].alias("h"), F.aggregate(
            pts, zero, lambda acc, p: _add(acc, p, v["x"], v["h"])).alias("s"))))
    fitted = summed.withColumn("vertices", F.transform("vertices", lambda v: F.struct(
        v["x"].alias("x"), _solve(v["s"]).alias("f"),
        F.try_divide(_slope(v["s"]), v["h"]).alias("d"))))
    step = (F.col("hi") - F.col("lo")) / F.lit(max(1, (points or 2) - 1))
    grid = F.transform("pts", lambda p: p["x"]) if points is None else F.transform(
        F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.col("lo") + i * step)
    rows = fitted.select(key, "vertices", F.explode(grid).alias(x))
    left = F.element_at(F.filter("vertices", lambda v: v["x"] <= F.col(x)), -1)
    right = F.element_at(F.filter("vertices", lambda v: v["x"] > F.col(x)), 1)
    return rows.select(key, x, _blend(left, right, F.col(x)).alias(name))


def _blend(a: Column, b: Column, x: Column) -> Column:
    """The cubic through both vertices with their slopes."""
    width = b["x"] - a["x"]
    h = F.try_divide(x - a["x"], width)
    return ((1 - h) * (1 - h) * (1 + 2 * h) * a["f"] + h * h * (3 - 2 * h) * b["f"]
            + (h * (1 - h) * (1 - h) * a["d"] - h * h * (1 - h) * b["d"]) * width)
