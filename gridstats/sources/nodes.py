"""Manual grid nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.operators.dedupe import ROW_ORDER


def read_nodes_csv(spark: SparkSession, path: str) -> DataFrame:
    """``node_id, lon, lat`` from a CSV with columns ``node_id, longitude, latitude`` (others ignored).

    ``_order`` is the place of the row: its file, the block of the file, and the row within the task that reads the block.
    Of rows that repeat a ``node_id`` the grid operators keep the first by it.
    """
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).csv(path)
    missing = [c for c in ("node_id", "longitude", "latitude") if c not in raw.columns]
    if missing:
        raise ValueError(f"node file lacks columns: {', '.join(missing)}")
    return raw.select(
        F.col("node_id").cast("string"),
        F.col("longitude").cast("double").alias("lon"),
        F.col("latitude").cast("double").alias("lat"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(ROW_ORDER),
    )
