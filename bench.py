"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8) choose input and cores.
Each query runs once to warm up and once timed, into the no-op sink. ``naive`` holds the straightforward plans
for two of the results: the theta join, and medians joined back to the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridstats.functions.geo import great_circle_m, window_lat, window_lon  # noqa: E402
from workload.points import grid, points  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "link_within_radius",
    "link_shuffled_cells",
    "link_global",
    "agg_grid_exact",
    "agg_grid_fused",
    "agg_grid_partitioned",
    "agg_grid_hot_split",
    "agg_grid_approx",
    "agg_direction_weighted",
    "agg_projection",
    "wkb_decode",
    "extent_by_group",
    "hull_vertices",
    "points_in_triangle",
    "grid_in_hull",
    "consolidated_files",
    "stac_items",
    "footprint_to_statistics",
)


def naive_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point with every node, then the conditions."""
    p = points(spark, sf_dir)
    g = grid(spark).select("node_id", F.col("lon").alias("glon"), F.col("lat").alias("glat"))
    half = window_lon(10.0, p["lat"])
    near = (
        g["glat"].between(p["lat"] - window_lat(10.0), p["lat"] + window_lat(10.0))
        & g["glon"].between(p["lon"] - half, p["lon"] + half)
        & (great_circle_m(p["lat"], p["lon"], g["glat"], g["glon"]) <= 10000.0)
    )
    return p.join(g, near).select("rowid", "node_id")


def naive_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians in one aggregate, joined back to the rows for the deviations."""
    links = QUERIES["link_within_radius"](spark, sf_dir)
    rows = points(spark, sf_dir).join(links, "rowid")
    keys, columns = ["timestamp", "node_id"], ["speed", "temp"]
    stats = rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[f(F.col(c)).alias(f"{c}_{f.__name__}") for c in columns for f in (F.avg, F.stddev_samp, F.min, F.max, F.count)],
        *[F.percentile(F.col(c), F.lit(0.5)).alias(f"{c}_median") for c in columns],
    )
    gaps = rows.join(stats, keys).groupBy(*keys).agg(
        *[F.percentile(F.abs(F.col(c) - F.col(f"{c}_median")), F.lit(0.5)).alias(f"{c}_mad") for c in columns]
    )
    return stats.join(gaps, keys)


def timed(run: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf_dir: str) -> float:
    seconds = 0.0
    for _ in range(2):
        start = time.perf_counter()
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
    return round(seconds, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: timed(QUERIES[name], spark, sf_dir) for name in HEADLINE}
    naive = {f.__name__: timed(f, spark, sf_dir) for f in (naive_links, naive_statistics)}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "naive": naive,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
