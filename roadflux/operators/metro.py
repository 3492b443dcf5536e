"""Metro course between two points along the line nearest to the start.

Optional: the route chain draws metro trips on the road graph and does not call it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadflux.functions.geo import along_segment, segment_distance
from roadflux.operators.proximity import nearest_line


def metro_course(trips: DataFrame, segments: DataFrame, points: int) -> DataFrame:
    """(trip_id, n, x, y): ``points`` places at even distance along the line, from start to end.

    trips(trip_id, x1, y1, x2, y2) and segments(line_id, seq, ...) are planar.
    The line is the one nearest to the start, found by grid cells; both ends are projected onto it; a
    course of no length repeats the projected start.  A trip meets the pieces of its own line only.
    """
    pieces = segments.select("line_id", "seq", *[F.col(c).alias(f"s{c}") for c in ("x1", "y1", "x2", "y2")])
    length = F.sqrt((F.col("sx2") - F.col("sx1")) ** 2 + (F.col("sy2") - F.col("sy1")) ** 2)
    along = Window.partitionBy("line_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("len", length).withColumn("before", F.coalesce(F.sum("len").over(along), F.lit(0.0)))
    sides = [F.col(c) for c in ("sx1", "sy1", "sx2", "sy2")]
    near = lambda x, y: segment_distance(F.col(x), F.col(y), *sides)
    place = lambda x, y: F.col("before") + along_segment(F.col(x), F.col(y), *sides) * F.col("len")
    line = nearest_line(trips.select("trip_id", F.col("x1").alias("x"), F.col("y1").alias("y")), segments, "trip_id").select("trip_id", "line_id")
    met = trips.join(line, "trip_id").join(pieces, "line_id")
    start = met.groupBy("trip_id", "line_id", "x2", "y2").agg(F.min(F.struct(near("x1", "y1").alias("d"), F.col("seq"), place("x1", "y1").alias("at"))).alias("a"))
    start = start.select("trip_id", "x2", "y2", "line_id", F.col("a.at").alias("from"))
    own = start.join(pieces, "line_id")
    ends = own.groupBy("trip_id", "line_id", "from").agg(F.min(F.struct(near("x2", "y2").alias("d"), F.col("seq"), place("x2", "y2").alias("at"))).alias("b"))
    ends = ends.select("trip_id", "line_id", "from", F.col("b.at").alias("to"))
    share = F.when(F.lit(points) > 1, F.col("n") / F.lit(max(points - 1, 1))).otherwise(0.0)
    stops = ends.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("at", F.col("from") + (F.col("to") - F.col("from")) * share)
    drawn = stops.join(pieces, "line_id").where((F.col("at") >= F.col("before")) & (F.col("at") <= F.col("before") + F.col("len")))
    t = F.when(F.col("len") > 0, (F.col("at") - F.col("before")) / F.when(F.col("len") > 0, F.col("len"))).otherwise(0.0)
    drawn = drawn.withColumns({"x": F.col("sx1") + t * (F.col("sx2") - F.col("sx1")), "y": F.col("sy1") + t * (F.col("sy2") - F.col("sy1"))})
    return drawn.groupBy("trip_id", "n").agg(F.min_by(F.struct("x", "y"), "seq").alias("p")).select("trip_id", "n", "p.x", "p.y")
