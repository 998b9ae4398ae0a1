"""Catalog tables and path sources: reading, checking, publishing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.functions.wkb import decode_points
from gridstats.operators.grid import encode_grid


def resolve_table(name: str, default_db: str | None = None) -> str:
    """``db.table`` as it is, a bare name in the default database."""
    name = name.strip()
    if not name:
        raise ValueError("empty table name")
    return name if "." in name or not default_db else f"{default_db}.{name}"


def _is_path(source: str) -> bool:
    return "/" in source


def read_source(spark: SparkSession, source: str, default_db: str | None = None) -> DataFrame:
    """A Parquet path (anything with a slash) or a table."""
    return spark.read.parquet(source) if _is_path(source) else spark.table(resolve_table(source, default_db))


def valid_points(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Rows with a readable point; adds ``lon`` and ``lat``."""
    located = decode_points(df, geometry)
    return located.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())


def read_points(
    spark: SparkSession,
    source: str,
    columns: Sequence[str] | None = None,
    geometry: str = "geometry",
    default_db: str | None = None,
    engine: str = "arrow",
) -> DataFrame:
    """Point table with ``lon`` and ``lat`` decoded once; only the named columns are scanned when given."""
    df = read_source(spark, source, default_db)
    if columns is not None:
        wanted = dict.fromkeys([c for c in ("rowid", geometry, "lon", "lat") if c in df.columns] + list(columns))
        df = df.select(*[F.col(f"`{c}`") for c in wanted])
    return decode_points(df, geometry, engine=engine)


def read_tables(spark: SparkSession, sources: Sequence[str], geometry: str = "geometry", default_db: str | None = None) -> DataFrame:
    """Positions of several tables in one frame: ``source, lon, lat``. Input of the per-table hulls."""
    frames = [
        read_points(spark, s, [], geometry, default_db).select(F.lit(s.strip()).alias("source"), "lon", "lat")
        for s in sources
    ]
    if not frames:
        raise ValueError("no tables given")
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def require_tables(spark: SparkSession, *names: str, default_db: str | None = None) -> None:
    missing = [n for n in names if not spark.catalog.tableExists(resolve_table(n, default_db))]
    if missing:
        raise ValueError(f"missing tables: {', '.join(missing)}")


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def require_partitions(spark: SparkSession, name: str, requested: Sequence[str], default_db: str | None = None) -> None:
    """Every requested partition column must be a partition key of the source table."""
    known = partition_columns(spark, resolve_table(name, default_db))
    unknown = [c for c in requested if c not in known]
    if unknown:
        raise ValueError(f"unknown partition columns: {', '.join(unknown)}")


def guard_target(path: str) -> str:
    """Refuse an empty or root location as the target of an overwrite."""
    bare = path.strip()
    without_scheme = bare.split("://", 1)[-1] if "://" in bare else bare.removeprefix("file:")
    parts = [p for p in without_scheme.split("/") if p]
    if "://" in bare and not bare.startswith("file://"):
        parts = parts[1:]  # the bucket or host alone is a root, too
    if not parts or parts in (["."], [".."]):
        raise ValueError("refusing to write to an empty or root location")
    return bare.rstrip("/")


def write_table(
    df: DataFrame,
    name: str | None,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    bucket_by: Sequence[str] = (),
    buckets: int | None = None,
) -> None:
    """Write Parquet at ``path`` and register it as table ``name`` (``None``: files only).

    ``overwrite`` replaces both the files and the table entry. With ``bucket_by`` the rows are dealt by a hash of these columns
    into ``buckets`` files (of each partition), sorted by them: tables with the same columns and number join on them without
    an exchange. Take as many buckets as give files of some hundred megabytes.
    """
    if bool(bucket_by) != bool(buckets) or (bucket_by and name is None):
        raise ValueError("buckets need columns, a number and a table name")
    target = guard_target(path)
    spark = df.sparkSession
    if name is not None and mode == "overwrite":
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if bucket_by:
        # the exchange hashes as buckets do, so that each bucket is one task's and one file
        df = df.repartition(buckets, *[F.col(f"`{c}`") for c in bucket_by])
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if name is None:
        writer.save(target)
    else:
        writer.option("path", target).saveAsTable(name)


def write_grid(grid: DataFrame, name: str | None, path: str, mode: str = "overwrite") -> None:
    """Publish a grid as ``node_id, geometry``; ``append`` keeps the nodes that are there."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    published = grid if set(grid.columns) == {"node_id", "geometry"} else encode_grid(grid)
    write_table(published.select("node_id", "geometry"), name, path, mode=mode)


def repair(spark: SparkSession, name: str) -> None:
    """Pick up partition folders that changed on disk."""
    if partition_columns(spark, name):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
