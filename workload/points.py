"""Point observations, grids and nodes derived from the given tables by plain arithmetic.

The SQL side (``oracle.py``) uses the same arithmetic, so both engines see the same doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.functions.wkb import point_wkb

# Fixed point of the projected statistics.
POINT_LAT, POINT_LON = 40.4168, -3.7038


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rowid, lon, lat, timestamp (day), speed, dir, temp, station`` over the whole table."""
    n = F.col("event_id")
    return events(spark, sf_dir).select(
        n.alias("rowid"),
        (F.lit(-9.5) + ((n * 7919) % 10007) / F.lit(10007.0)).alias("lon"),
        (F.lit(42.0) + ((n * 104729) % 10009) / F.lit(10009.0)).alias("lat"),
        F.to_date("ts").alias("timestamp"),
        F.col("ts"),
        # scaled off two decimals, so that no mean lies on a rounding border, and never zero
        (F.col("value") * F.lit(1.00001234567891) + F.lit(0.0137)).alias("speed"),
        (((n * 37) % 360) + ((n * 7) % 997) / F.lit(997.0) * F.lit(0.9) + F.lit(0.05)).alias("dir"),
        F.when(n % 17 != 0, F.col("value") * 2 - 5).alias("temp"),
        F.col("event_type").alias("station"),
    )


def wkb_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a WKB ``geometry`` instead of lon / lat."""
    located = points(spark, sf_dir)
    return located.withColumn("geometry", point_wkb("lon", "lat")).drop("lon", "lat")


def scattered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rowid, lon, lat, station`` moved off the regular pattern by the value, so that no three are in line."""
    shift = F.col("speed")
    return points(spark, sf_dir).select(
        "rowid",
        "station",
        (F.col("lon") + shift * F.lit(1.7e-5)).alias("lon"),
        (F.col("lat") + shift * F.lit(0.9e-5)).alias("lat"),
    )


def global_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions over the whole globe, poles and ±180° included."""
    n = F.col("event_id")
    return events(spark, sf_dir).select(
        n.alias("rowid"),
        (F.lit(-180.0) + ((n * 7919) % 10007) * F.lit(360.0) / F.lit(10006.0)).alias("lon"),
        (F.lit(-90.0) + ((n * 104729) % 10009) * F.lit(180.0) / F.lit(10008.0)).alias("lat"),
    )


def grid(spark: SparkSession) -> DataFrame:
    """110 nodes, a tenth of a degree apart."""
    i = F.col("id")
    return spark.range(110).select(
        F.concat(F.lit("G"), (i + 1).cast("string")).alias("node_id"),
        (F.lit(-9.5) + (i % 10) * F.lit(0.1)).alias("lon"),
        (F.lit(42.0) + F.floor(i / 10) * F.lit(0.1)).alias("lat"),
    )


def global_nodes(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    return spark.range(1990).select(
        F.concat(F.lit("W"), i.cast("string")).alias("node_id"),
        (F.lit(-180.0) + ((i * 449) % 1997) * F.lit(360.0) / F.lit(1996.0)).alias("lon"),
        (F.lit(-90.0) + ((i * 613) % 1999) * F.lit(180.0) / F.lit(1998.0)).alias("lat"),
    )


def supplier_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manual nodes, one per supplier; every third shares its id with a generated node."""
    n = F.col("s_suppkey").cast("long")
    name = F.when(n % 3 == 0, F.concat(F.lit("G"), n.cast("string"))).otherwise(F.concat(F.lit("M"), n.cast("string")))
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        name.alias("node_id"),
        (F.lit(-9.4) + ((n * 31) % 101) / F.lit(131.0)).alias("lon"),
        (F.lit(42.1) + ((n * 57) % 103) / F.lit(137.0)).alias("lat"),
    )


def customer_nodes(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Manual nodes with repeated ids, several customers each."""
    n = F.col("c_custkey").cast("long")
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        *keep,
        F.concat(F.lit("M"), (n % 251).cast("string")).alias("node_id"),
        (F.lit(-9.4) + ((n * 131) % 1009) / F.lit(1301.0)).alias("lon"),
        (F.lit(42.1) + ((n * 157) % 1013) / F.lit(1307.0)).alias("lat"),
    )


def box_of(df: DataFrame) -> tuple[float, float, float, float]:
    from gridstats.operators.extent import extent

    return tuple(extent(df).first())


def triangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A triangular footprint spanned by the extent of the points."""
    west, south, east, north = box_of(points(spark, sf_dir))
    w, h = east - west, north - south
    ring = [(west + 0.1 * w, south), (east, south + 0.3 * h), (west + 0.4 * w, north), (west + 0.1 * w, south)]
    return spark.createDataFrame([([[{"x": x, "y": y} for x, y in ring]],)], "rings array<array<struct<x:double,y:double>>>")
