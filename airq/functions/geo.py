"""Distance on the WGS84 ellipsoid, from native expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# WGS84 equatorial radius in metres and flattening; mean radius.
EQUATOR_M = 6378137.0
FLATTENING = 1 / 298.257223563
MEAN_RADIUS_M = 6371008.8


def with_distance_m(
    df: DataFrame, name: str, from_lat: str, from_lon: str, to_lat: str, to_lon: str, method: str = "ellipsoid"
) -> DataFrame:
    """Add the metres between two points given in degrees.

    ``ellipsoid`` corrects the great circle between reduced latitudes by the
    first and second power of the flattening (Thomas' closed formula, within
    millimetres up to 1000 km); ``haversine`` is the plain sphere. Identical
    points give 0; for antipodes, where the corrections have no limit, the
    uncorrected great circle stands.

    The steps are aliases that refer to one another within one select, since
    each is used several times: Spark then computes it once per row. ``$``
    stands for a prefix that keeps them apart from the columns of ``df``.
    """
    if method not in ("ellipsoid", "haversine"):
        raise ValueError(f"unknown distance method {method!r}")
    flat = f"cast({FLATTENING!r} as double)"

    def latitude(column: str) -> str:
        return f"atan((1 - {flat}) * tan(radians({column})))" if method == "ellipsoid" else f"radians({column})"

    steps = {
        "$b1": latitude(from_lat),
        "$b2": latitude(to_lat),
        "$mid": "pow(sin(($b1 + $b2) / 2), 2)",
        "$half": "pow(sin(($b2 - $b1) / 2), 2)",
        "$h": f"least(greatest($half + (1 - $mid - $half) * pow(sin((radians({to_lon}) - radians({from_lon})) / 2), 2), 0D), 1D)",
        "$arc": "2 * asin(sqrt($h))",
    }
    metres = f"{MEAN_RADIUS_M!r}D * $arc"
    if method == "ellipsoid":
        # The corrections are missing at h = 0 and h = 1, where they would divide by zero.
        steps |= {
            "$sin": "nullif(2 * sqrt($h * (1 - $h)), 0D)",
            "$t": "$arc / $sin",
            "$u": "2 * $mid * (1 - $half) / nullif(1 - $h, 0D)",
            "$v": "2 * $half * (1 - $mid) / nullif($h, 0D)",
            "$x": "$u + $v",
            "$y": "$u - $v",
            "$e": "2 - 4 * $h",
            "$d": "4 * $t * $t",
            "$first": f"($t * $x - $y) * ({flat} / 4)",
            "$second": f"($x * ($d * $e + ($t - ($d * $e - $e) / 2) * $x) - $y * (2 * $d + $e * $y) + $d * $x * $y) * ({flat} * {flat} / 64)",
        }
        metres = f"coalesce({EQUATOR_M!r}D * $sin * ($t - $first + $second), {EQUATOR_M!r}D * $arc)"
    own = f"_{name}_"
    steps["$metres"] = metres
    chain = df.select("*", *[F.expr(text.replace("$", own)).alias(step.replace("$", own)) for step, text in steps.items()])
    return chain.select(*df.columns, F.col(f"{own}metres").alias(name))
