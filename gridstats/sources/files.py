"""Parquet files of a dataset: listing, footers and file-level jobs, all on the executors."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.constants import RESULT_FOLDERS
from gridstats.functions.text import arrow_type_name, partition_segments
from gridstats.functions.wkb import geometry_bounds
from gridstats.plans.sizing import pin

PARQUET_MARK = b"PAR1"

FOOTER = (
    "path string, uri string, rel string, length bigint, num_rows bigint, geo string, "
    "columns array<struct<name:string,type:string>>"
)


def qualified(spark: SparkSession, path: str) -> str:
    """Full location of ``path`` as Spark's file sources spell it."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(location).toString().rstrip("/")


def open_location(location: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a location, usable on any node that reaches the storage."""
    if location.startswith("file:"):
        return fs.LocalFileSystem(), "/" + location.removeprefix("file:").lstrip("/")
    if "://" in location:
        return fs.FileSystem.from_uri(store_uri(location))
    return fs.LocalFileSystem(), location


def store_uri(location: str) -> str:
    """The location in the spelling of the Arrow file systems, for the schemes that Hadoop spells in another way."""
    scheme, rest = location.split("://", 1)
    if scheme in ("s3a", "s3n"):
        return f"s3://{rest}"
    if scheme in ("wasb", "wasbs"):
        # container@account.host/path: Arrow names the account as host and the container as user
        scheme = "abfss" if scheme == "wasbs" else "abfs"
        return f"{scheme}://{rest.replace('.blob.', '.dfs.', 1)}"
    return location


def whole_on_close(system: fs.FileSystem) -> bool:
    """Whether a file appears under its name only when it is closed, as objects of a store do."""
    return system.type_name in ("s3", "gcs", "abfs")


def in_result_folder(relative: Column, exclude: Sequence[str] = RESULT_FOLDERS) -> Column:
    hit = F.lit(False)
    for pattern in exclude:
        hit = hit | relative.rlike(pattern)
    return hit


def list_files(spark: SparkSession, root: str, exclude: Sequence[str] = RESULT_FOLDERS) -> DataFrame:
    """``path, uri, rel, length`` of the data files under ``root``; names only, no content is read.

    Hidden and marker files, empty files and files in query-result folders are left out.
    """
    base = qualified(spark, root)
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", F.col("_metadata.file_path").alias("uri"), "length")
    )
    relative = F.substring("path", len(base) + 2, 1 << 30)
    files = found.withColumn("rel", relative)
    name = F.element_at(F.split("rel", "/"), -1)
    kept = (F.col("length") > 0) & ~name.rlike(r"^[._]") & (name != "SUCCESS") & ~in_result_folder(F.col("rel"), exclude)
    return files.where(kept).select("path", "uri", "rel", "length")


def is_parquet(handle) -> bool:
    """Whether a file begins and ends with the marks of the format. Errors of reading, and of a broken footer, are raised."""
    size = handle.size()
    return size >= 12 and handle.read_at(4, 0) == PARQUET_MARK == handle.read_at(4, size - 4)


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, uri, rel, length in batch.itertuples(index=False):
            system, where = open_location(path)
            with system.open_input_file(where) as handle:
                if not is_parquet(handle):
                    continue
                file = pq.ParquetFile(handle)
                schema, count = file.schema_arrow, file.metadata.num_rows
            geo = (schema.metadata or {}).get(b"geo")
            columns = [{"name": f.name, "type": arrow_type_name(f.type)} for f in schema]
            rows.append((path, uri, rel, length, count, geo.decode() if geo else None, columns))
        yield pd.DataFrame(rows, columns=["path", "uri", "rel", "length", "num_rows", "geo", "columns"])


def parquet_inventory(spark: SparkSession, root: str, exclude: Sequence[str] = RESULT_FOLDERS) -> DataFrame:
    """Valid Parquet files under ``root`` by their footers, whatever their extension.

    ``path, uri, rel, length, num_rows, geo, columns``: one row per file, footers read in parallel.
    """
    files = list_files(spark, root, exclude)
    spread = max(spark.sparkContext.defaultParallelism, 1)
    return files.repartition(spread, "path").mapInPandas(_read_footers, FOOTER)


def require_files(inventory: DataFrame, root: str) -> DataFrame:
    """The inventory, computed once; ``ValueError`` when it is empty."""
    pinned = pin(inventory)
    if pinned.isEmpty():
        raise ValueError(f"no Parquet files found under {root}")
    return pinned


def geo_footers(spark: SparkSession, root: str, exclude: Sequence[str] = RESULT_FOLDERS) -> DataFrame:
    """``rel, primary_column, bbox, encoding, geometry_types, version`` per file.

    The box of the primary column, else a top-level box; NULL when there is none of length four.
    """
    return with_footer_fields(parquet_inventory(spark, root, exclude)).select(
        "rel", "primary_column", "bbox", "encoding", "geometry_types", "version"
    )


def with_footer_fields(inventory: DataFrame) -> DataFrame:
    column = "struct<encoding:string,geometry_types:array<string>,bbox:array<double>>"
    schema = f"struct<version:string,primary_column:string,bbox:array<double>,columns:map<string,{column}>>"
    footer = inventory.withColumn("_g", F.from_json("geo", schema))
    primary = F.try_element_at(F.col("_g.columns"), F.col("_g.primary_column"))
    boxes = [F.when(F.size(b) == 4, b) for b in (primary["bbox"], F.col("_g.bbox"))]
    return footer.withColumns(
        {
            "primary_column": F.col("_g.primary_column"),
            "bbox": F.coalesce(*boxes),
            "encoding": primary["encoding"],
            "geometry_types": primary["geometry_types"],
            "version": F.col("_g.version"),
        }
    ).drop("_g")


def read_geoparquet(spark: SparkSession, path: str, bbox: Sequence[float] | None = None, geometry: str = "geometry") -> DataFrame:
    """The rows of a GeoParquet dataset, partition columns included.

    With ``bbox`` (west, south, east, north) those whose geometry's box meets it, borders included. Where the files have a
    ``bbox`` covering column the conditions go to the scan, which leaves out the row groups whose statistics exclude them;
    else boxes are worked out from the geometry. Rows without a readable geometry have no box and are left out.
    """
    rows = spark.read.parquet(path)
    if bbox is None:
        return rows
    west, south, east, north = (float(v) for v in bbox)
    if not (west <= east and south <= north):
        raise ValueError("bbox must be west, south, east, north")
    sides = ("xmin", "ymin", "xmax", "ymax")
    kind = rows.schema["bbox"].dataType if "bbox" in rows.columns else None
    if isinstance(kind, T.StructType) and set(sides) <= set(kind.names):
        xmin, ymin, xmax, ymax = (F.col(f"bbox.{side}") for side in sides)
        return rows.where((xmin <= east) & (xmax >= west) & (ymin <= north) & (ymax >= south))
    boxed = geometry_bounds(rows, geometry, "_box")
    minx, miny, maxx, maxy = (F.col(f"_box.{side}") for side in ("minx", "miny", "maxx", "maxy"))
    return boxed.where((minx <= east) & (maxx >= west) & (miny <= north) & (maxy >= south)).drop("_box")


def read_stored(spark: SparkSession, root: str, inventory: DataFrame, schema: str | None = None) -> DataFrame:
    """Rows of the files in ``inventory`` as stored, without partition columns, plus their file as ``_uri``.

    Reads the whole folder when it holds nothing else; else (stray or excluded files) the listed files only.
    """
    everything = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    paths = [root]
    if everything.count() != inventory.count():
        paths = [row["uri"] for row in inventory.select("uri").collect()]
    reader = spark.read.option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths).select("*", F.col("_metadata.file_path").alias("_uri"))


def _copy_streams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for source, target in zip(batch["path"], batch["target"]):
            system, where = open_location(source)
            with system.open_input_stream(where) as reader:
                write_whole(target, lambda sink, reader=reader: _pump(reader, sink))
        yield batch[["target"]]


def _pump(reader, sink) -> None:
    while chunk := reader.read(8 << 20):
        sink.write(chunk)


def write_whole(location: str, fill: Callable) -> None:
    """Write a file so that a repeated task leaves a whole one: where objects appear whole, in place; else by a move."""
    import uuid

    system, where = open_location(location)
    if whole_on_close(system):
        with system.open_output_stream(where) as sink:
            fill(sink)
        return
    folder, name = where.rsplit("/", 1)
    system.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(temporary) as sink:
        fill(sink)
    system.move(temporary, where)


def copy_files(files: DataFrame, target_root: str) -> int:
    """Copy ``path`` to ``target_root/rel``, one file at a time per task; returns the number of files."""
    spark = files.sparkSession
    base = qualified(spark, target_root)
    jobs = files.select("path", F.concat(F.lit(base + "/"), "rel").alias("target"))
    spread = max(spark.sparkContext.defaultParallelism, 1)
    return jobs.repartition(spread, "path").mapInPandas(_copy_streams, "target string").count()


def asset_inventory(spark: SparkSession, root: str, exclude: Sequence[str] = RESULT_FOLDERS) -> DataFrame:
    """``rel, partitions, row_count, columns`` per file, from the footers."""
    files = parquet_inventory(spark, root, exclude)
    return files.select("rel", partition_segments(F.col("rel")).alias("partitions"), F.col("num_rows").alias("row_count"), "columns")


def footer_json(column: str, encoding: str, types: Sequence[str], bbox: Sequence[float], extra: dict | None = None) -> str:
    from gridstats.constants import CRS84

    entry = {"encoding": encoding, "geometry_types": list(types), "crs": CRS84, "bbox": list(bbox)} | (extra or {})
    return json.dumps({"version": "1.1.0", "primary_column": column, "columns": {column: entry}})
