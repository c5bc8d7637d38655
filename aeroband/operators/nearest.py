"""Nearest match within a bucket: for each left row, the closest right row of the same bucket.

In plain terms this is a left join on the bucket, then a rank by distance. Doing just that multiplies every left row
by the right rows of its bucket. Instead the right rows of a bucket become arrays of at most ``per_chunk``, and the closest
is picked inside the row:

* A bucket whose rows fit one array is joined once to each left row.
* A crowded bucket has several, each a stretch of its positions in order. They are joined to the distinct left positions
  of that bucket, each gives its closest, and the least of those, combined before the exchange, goes back to the left
  rows. Positions meet ceil(n / per_chunk) arrays, and one more for each task that a bucket's positions are spread over.

One crowded bucket does not change how the others are matched. Both ways are exact and have no limit on either side.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroband.functions.geo import degree_distance_sq
from aeroband.functions.numbers import finite_or_null
from aeroband.operators.joins import BROADCAST_BYTES, join_on_bucket, row_bytes


@dataclass(frozen=True)
class NearestLimits:
    """Right rows in an array, and the measured size up to which the right side is broadcast."""

    per_chunk: int = 64
    broadcast_bytes: int = BROADCAST_BYTES


@dataclass(frozen=True)
class RightShape:
    """What is measured of the right side."""

    total_bytes: int
    crowded_buckets: int


def right_shape(right: DataFrame, bucket: str, per_chunk: int = NearestLimits.per_chunk) -> RightShape:
    """An upper estimate of all bytes, and the number of buckets beyond one array. One aggregation, one row to the
    driver."""
    per_bucket = right.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(right)).alias("bytes"))
    crowded = F.count_if((F.col("n") > per_chunk) & F.col(bucket).isNotNull())
    total, buckets = per_bucket.agg(F.sum("bytes"), crowded).first()
    return RightShape(total or 0, buckets)


def nearest_match(
    left: DataFrame,
    right: DataFrame,
    *,
    bucket: str,
    left_xy: tuple[str, str],
    right_xy: tuple[str, str],
    carry: list[str],
    ties: list[str],
    limits: NearestLimits = NearestLimits(),
    shape: RightShape | None = None,
) -> DataFrame:
    """``left`` with the ``carry`` columns and ``distance_sq`` of its nearest right row in the same ``bucket``.

    Nearest *available in that bucket*: a position without a right row there does not matter. Left rows without
    any, or with a null bucket, keep nulls. An unknown distance ranks last; equal distances are told apart by
    ``ties``, nulls last, then by the carried values. ``shape`` is that of the right side if it is known already.
    """
    tie_fields = [field for t in ties for field in (F.col(t).isNull().alias(f"no_{t}"), F.col(t).alias(f"tie_{t}"))]
    packed = right.filter(F.col(bucket).isNotNull()).select(
        bucket,
        finite_or_null(F.col(right_xy[0])).alias("_px"),
        finite_or_null(F.col(right_xy[1])).alias("_py"),
        F.struct(*tie_fields, *carry).alias("_row"),
    )
    shape = shape or right_shape(right, bucket, limits.per_chunk)
    small = shape.total_bytes <= limits.broadcast_bytes
    # Unknown coordinates become NaN, which joins with itself.
    nan = F.lit(float("nan"))
    placed = left.withColumns({f"_{axis}": F.coalesce(finite_or_null(F.col(c)), nan) for axis, c in zip("xy", left_xy)})
    if not shape.crowded_buckets:
        found = _by_lists(placed, packed, bucket, small)
    else:
        crowded = packed.groupBy(bucket).count().filter(F.col("count") > limits.per_chunk).select(bucket)
        few = shape.crowded_buckets * BUCKET_BYTES <= BROADCAST_BYTES
        others, theirs = [[_apart(df, crowded, bucket, how, few) for df in (placed, packed)] for how in ("left_anti", "left_semi")]
        found = _by_lists(*others, bucket, small).unionByName(_by_chunks(*theirs, bucket, limits.per_chunk, small))
    return found.select(
        *left.columns,
        *[F.col(f"_row.{c}").alias(c) for c in carry],
        finite_or_null(F.col("_distance")).alias("distance_sq"),
    )


BUCKET_BYTES = 64


def _apart(df, crowded, bucket, how, few):
    """The rows in crowded buckets (``how`` is "left_semi") or the others."""
    if few:
        return df.join(F.broadcast(crowded), bucket, how)
    flagged = join_on_bucket(df, crowded.withColumn("_crowded", F.lit(True)), [bucket])
    return flagged.filter(F.col("_crowded").isNotNull() if how == "left_semi" else F.col("_crowded").isNull()).drop("_crowded")


def _distance(x: Column, y: Column, px: Column, py: Column) -> Column:
    """Distance to rank by: coordinates are finite or null, and an unknown distance is behind all others."""
    return F.coalesce(degree_distance_sq(x, y, px, py), F.lit(float("inf")))


def _arrays(rows, keys):
    """The right rows of each key. Sorted by preference among equally near rows, so that the first one at the least
    distance is the winner. One array of plain numbers per coordinate: distances are then computed and searched without
    building a struct per candidate."""
    gathered = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_row", "_px", "_py"))).alias("_list"))
    return gathered.select(
        *keys, F.col("_list._px").alias("_pxs"), F.col("_list._py").alias("_pys"), F.col("_list._row").alias("_rows")
    )


def _closest(joined):
    """Adds ``_distance`` and ``_row`` of the closest entry of the arrays."""
    x, y = finite_or_null(F.col("_x")), finite_or_null(F.col("_y"))
    measured = joined.withColumns({"_fx": x, "_fy": y}).withColumn(
        "_distances", F.zip_with("_pxs", "_pys", lambda px, py: _distance(F.col("_fx"), F.col("_fy"), px, py))
    ).withColumn("_distance", F.array_min("_distances"))
    first = F.array_position("_distances", F.col("_distance")).cast("int") - F.lit(1)
    return measured.withColumn("_row", F.get("_rows", first)).drop("_fx", "_fy", "_distances", "_pxs", "_pys", "_rows")


def _by_lists(left, packed, bucket, small):
    return _closest(join_on_bucket(left, _arrays(packed, [bucket]), [bucket], small=small))


def _by_chunks(left, packed, bucket, per_chunk, small):
    # Of right rows at one position only the first by ties can win: drops copies before any site sees them.
    points = packed.groupBy(bucket, "_px", "_py").agg(F.min("_row").alias("_row"))
    # In order of position over all tasks, so that a bucket of any size is spread; numbered within each.
    spread = points.repartitionByRange(bucket, "_px", "_py").withColumn("_part", F.spark_partition_id())
    place = F.row_number().over(Window.partitionBy(bucket, "_part").orderBy("_px", "_py")) - 1
    chunks = _arrays(spread.withColumn("_chunk", (place / per_chunk).cast("int")), [bucket, "_part", "_chunk"])
    sites = left.select(bucket, "_x", "_y").distinct()
    candidates = join_on_bucket(sites, chunks.drop("_part", "_chunk"), [bucket], how="inner", small=small)
    # The order of the struct is the order of preference.
    nearest = F.min(F.struct("_distance", "_row"))
    best = _closest(candidates).groupBy(bucket, "_x", "_y").agg(nearest.alias("_best"))
    # One row per site on the right; a site with very many left rows is split by AQE's skew join.
    found = left.join(best, [bucket, "_x", "_y"], "left")
    return found.withColumns({"_distance": F.col("_best._distance"), "_row": F.col("_best._row")}).drop("_best")
