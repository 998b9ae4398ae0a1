"""Finish a dataset: one file per partition folder, with the GeoParquet footer.

Spark writes the rows in balanced pieces; a file-level job then streams the pieces of each folder, a few thousand
rows at a time, into the final file and adds the ``geo`` footer in the same pass. Nothing is patched in place:
results go to a new folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridstats.functions.curve import hilbert_key
from gridstats.functions.wkb import geometry_bounds, is_finite
from gridstats.operators.extent import BOX, box_columns
from gridstats.plans.sizing import pin
from gridstats.sources.files import (
    footer_json,
    open_location,
    parquet_inventory,
    qualified,
    read_stored,
    require_files,
    write_whole,
)
from gridstats.sources.tables import guard_target

# The column that holds each row's box, and the footer member that names it to readers.
COVERING = "bbox"
COVERING_EXTRA = {"covering": {"bbox": {side: [COVERING, side] for side in ("xmin", "ymin", "xmax", "ymax")}}}
# Rows of a row group in files that are ordered in space, so that a box meets few groups.
SPATIAL_GROUP_ROWS = 50_000
# Bytes of decoded rows that a row group is written from, and so what a task holds, whatever the row groups of its sources.
GROUP_BYTES = 16 << 20
# Rows decoded at once, and bytes of each column that are read ahead for them.
DECODED_ROWS = 4096
READ_AHEAD = 256 << 10
# Footer members that describe how grid edges are to be read.
GRID_EXTRA = {"orientation": "counterclockwise", "edges": "spherical"}


def _boxes(spark: SparkSession, root: str, files: DataFrame, geometry: str, kind: str) -> DataFrame:
    """``uri, minx..maxy, types`` per file, over readable and finite geometries."""
    stored = read_stored(spark, root, files, schema=f"`{geometry}` {kind}")
    boxed = geometry_bounds(stored.select(F.col("_uri").alias("uri"), F.col(f"`{geometry}`").alias("_geometry")), "_geometry", "_box")
    sides = []
    for side in BOX:
        value = F.col(f"_box.{side}")
        finite = is_finite(F.col("_box.minx")) & is_finite(F.col("_box.miny"))
        finite = finite & is_finite(F.col("_box.maxx")) & is_finite(F.col("_box.maxy"))
        sides.append(F.when(finite, value))
    return boxed.groupBy("uri").agg(*box_columns(*sides), F.collect_set("_box.kind").alias("types"))


def _geometry_column(files: DataFrame, geometry: str) -> str | None:
    """Type of the geometry column in the first file that has it: ``binary``, ``string`` or ``None``."""
    found = (
        files.select("rel", F.filter("columns", lambda c: c["name"] == geometry).alias("c"))
        .where(F.size("c") > 0)
        .agg(F.min_by(F.col("c")[0]["type"], "rel"))
        .first()[0]
    )
    return found if found in ("binary", "string") else None


def _with_footers(
    spark: SparkSession, root: str, files: DataFrame, geometry: str, bbox_scope: str, extra: dict | None
) -> DataFrame:
    """``files`` (with ``target``) plus the ``geo`` footer each target gets."""
    if bbox_scope not in ("dataset", "file"):
        raise ValueError("bbox_scope must be 'dataset' or 'file'")
    kind = _geometry_column(files, geometry)
    encoding = "WKT" if kind == "string" else "WKB"
    jobs = files.withColumnRenamed("geo", "_old").drop("_old")
    if kind is None:
        return jobs.withColumn("geo", F.lit(footer_json(geometry, encoding, [], [0.0] * 4, extra)))
    boxes = pin(files.join(_boxes(spark, root, files, geometry, kind), "uri").select("uri", "target", *BOX, "types"))
    over = [*box_columns(*[F.col(s) for s in BOX]), F.array_sort(F.array_distinct(F.flatten(F.collect_set("types")))).alias("types")]
    whole = boxes.agg(*over).first()
    sides = [0.0 if whole[s] is None else whole[s] for s in BOX]
    if bbox_scope == "dataset":
        return jobs.withColumn("geo", F.lit(footer_json(geometry, encoding, whole["types"] or [], sides, extra)))
    # the same document with the box and types of the file put in
    marks = ["@minx", "@miny", "@maxx", "@maxy"]
    text = F.lit(footer_json(geometry, encoding, ["@types"], marks, extra))
    per_target = boxes.groupBy("target").agg(*over)
    for mark, side in zip(marks, BOX):
        text = F.replace(text, F.lit(f'"{mark}"'), F.coalesce(F.col(side), F.lit(0.0)).cast("string"))
    text = F.replace(text, F.lit('["@types"]'), F.to_json("types"))
    blank = footer_json(geometry, encoding, [], [0.0] * 4, extra)
    footers = per_target.select("target", text.alias("geo"))
    return jobs.join(footers, "target", "left").withColumn("geo", F.coalesce("geo", F.lit(blank)))


def _open_parquet(handle) -> tuple[pq.ParquetFile, pa.Schema]:
    """File and the schema its rows get: INT96 instants become microseconds in UTC, which Spark reads back."""
    file = pq.ParquetFile(handle, coerce_int96_timestamp_unit="us", buffer_size=READ_AHEAD)
    schema = file.schema_arrow
    for i in range(len(file.schema)):
        column = file.schema.column(i)
        if column.physical_type == "INT96" and column.path in schema.names:
            at = schema.get_field_index(column.path)
            schema = schema.set(at, schema.field(at).with_type(pa.timestamp("us", tz="UTC")))
    return file, schema


def _pieces(file: pq.ParquetFile, group: int, group_rows: int | None) -> Iterator[pa.Table]:
    """A row group in pieces of at most ``group_rows`` rows and ``GROUP_BYTES``, or one decoded batch if that has more."""
    held, rows, size = [], 0, 0
    for batch in file.iter_batches(min(DECODED_ROWS, group_rows or DECODED_ROWS), [group], use_threads=False):
        full = size + batch.nbytes > GROUP_BYTES or (group_rows and rows + batch.num_rows > group_rows)
        if held and full:
            yield pa.Table.from_batches(held)
            held, rows, size = [], 0, 0
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def _merge_task(batches: Iterator[pd.DataFrame], group_rows: int | None = None) -> Iterator[pd.DataFrame]:
    """Stream the sources of each target into it, in pieces of their row groups.

    A target has the columns of all its sources, in the order they first occur, each with the type it has there; a source
    without a column gives NULL. Row groups have at most ``group_rows`` rows, else those of the sources; larger ones than
    ``GROUP_BYTES`` are split.
    """
    for batch in batches:
        rows = []
        for target, sources, geo in zip(batch["target"], batch["sources"], batch["geo"]):
            count = 0

            def fill(sink, sources=sources, geo=geo) -> None:
                nonlocal count
                count, writer, schema = 0, None, None
                for source in sources:
                    system, where = open_location(source)
                    with system.open_input_file(where) as handle:
                        stored = _open_parquet(handle)[1]
                        if schema is None:
                            schema = stored.with_metadata({**(stored.metadata or {}), b"geo": geo.encode()})
                        for field in stored:
                            if field.name not in schema.names:
                                schema = schema.append(field.with_nullable(True))
                for source in sources:
                    system, where = open_location(source)
                    with system.open_input_file(where) as handle:
                        file, _ = _open_parquet(handle)
                        if writer is None:
                            writer = pq.ParquetWriter(sink, schema, compression="snappy")
                        for group in range(file.num_row_groups):
                            for table in _pieces(file, group, group_rows):
                                if not table.schema.equals(schema, check_metadata=False):
                                    for field in schema:
                                        if field.name not in table.schema.names:
                                            table = table.append_column(field, pa.nulls(table.num_rows, field.type))
                                    table = table.select(schema.names).cast(schema)
                                writer.write_table(table.replace_schema_metadata(schema.metadata))
                                count += table.num_rows
                writer.close()

            write_whole(target, fill)
            rows.append((target, len(sources), count))
            # idle workers stay beside the tasks that follow
            pa.default_memory_pool().release_unused()
        yield pd.DataFrame(rows, columns=["target", "sources", "rows"])


def _run(jobs: DataFrame, group_rows: int | None = None) -> DataFrame:
    """Do the file-level job once; ``target, sources, rows`` per written file."""
    spark = jobs.sparkSession
    merged = jobs.groupBy("target").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rel", "path"))), lambda s: s["path"]).alias("sources"),
        F.first("geo").alias("geo"),
    )
    spread = max(spark.sparkContext.defaultParallelism, 1)
    done = merged.repartition(spread, "target").mapInPandas(lambda batches: _merge_task(batches, group_rows), "target string, sources int, rows bigint")
    return pin(done)


def _folder_targets(files: DataFrame, base: str, max_rows: int | None) -> DataFrame:
    """One final file per folder: ``<value>.parquet`` under ``key=value``, else ``data.parquet``.

    With ``max_rows``, a folder with more rows continues in ``<name>-1.parquet`` and so on, split at file borders.
    """
    folder = F.regexp_replace(F.regexp_extract("rel", r"^(.*/)?[^/]*$", 1), "/$", "")
    value = F.regexp_extract(F.element_at(F.split(folder, "/"), -1), r"^[^=]*=(.+)$", 1)
    stem = F.when(value != "", value).otherwise(F.lit("data"))
    order = Window.partitionBy("_folder").orderBy("rel").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("num_rows").over(order), F.lit(0))
    number = F.floor(before / max_rows) if max_rows else F.lit(0)
    suffix = F.when(number > 0, F.concat(F.lit("-"), number.cast("string"))).otherwise(F.lit(""))
    path = F.concat(
        F.lit(base + "/"),
        F.when(F.col("_folder") != "", F.concat("_folder", F.lit("/"))).otherwise(F.lit("")),
        F.col("_stem"),
        F.col("_suffix"),
        F.lit(".parquet"),
    )
    named = files.withColumn("_folder", folder).withColumn("_stem", stem).withColumn("_suffix", suffix)
    return named.withColumn("target", path).drop("_folder", "_stem", "_suffix")


def consolidate_files(
    spark: SparkSession,
    source: str,
    target: str,
    geometry: str = "geometry",
    bbox_scope: str = "dataset",
    max_rows_per_file: int | None = None,
    extra: dict | None = None,
    group_rows: int | None = None,
) -> DataFrame:
    """Rewrite an existing dataset to one file per folder with the ``geo`` footer. Files keep their own columns.

    Row groups stay as they are, or have at most ``group_rows`` rows; those of more than ``GROUP_BYTES`` are split.
    """
    base = qualified(spark, guard_target(target))
    files = require_files(parquet_inventory(spark, source), source)
    jobs = _with_footers(spark, source, _folder_targets(files, base, max_rows_per_file), geometry, bbox_scope, extra)
    return _run(jobs, group_rows)


def add_geo_metadata(
    spark: SparkSession,
    source: str,
    target: str,
    geometry: str = "geometry",
    bbox_scope: str = "dataset",
    extra: dict | None = None,
) -> DataFrame:
    """Copy a dataset file by file into a new folder, adding the ``geo`` footer; names stay."""
    base = qualified(spark, guard_target(target))
    files = require_files(parquet_inventory(spark, source), source)
    named = files.withColumn("target", F.concat(F.lit(base + "/"), "rel"))
    return _run(_with_footers(spark, source, named, geometry, bbox_scope, extra))


def with_covering(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """``df`` with a column ``bbox`` (xmin, ymin, xmax, ymax) of each geometry; NULL where there is none that is readable and
    finite. A column of that name in ``df`` is replaced."""
    given = df.drop(COVERING)
    boxed = geometry_bounds(given, geometry, "_box")
    sides = [F.col(f"_box.{side}") for side in BOX]
    finite = is_finite(sides[0]) & is_finite(sides[1]) & is_finite(sides[2]) & is_finite(sides[3])
    box = F.struct(*[side.alias(name) for side, name in zip(sides, ("xmin", "ymin", "xmax", "ymax"), strict=True)])
    return boxed.select(*[F.col(f"`{c}`") for c in given.columns], F.when(finite, box).alias(COVERING))


def ordered_in_space(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` (with ``bbox``) ranged and sorted by partition values and then along a Hilbert curve through the boxes' centres.

    The ranges come from a sample of the keys, so a folder that holds most rows is many ranges. Rows without a box come first.
    """
    x, y = ((F.col(f"{COVERING}.{a}") + F.col(f"{COVERING}.{b}")) / 2 for a, b in (("xmin", "xmax"), ("ymin", "ymax")))
    keys = [*[F.col(f"`{c}`") for c in partition_by], F.col("_curve")]
    placed = df.withColumn("_curve", hilbert_key(x, y))
    return placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_curve")


def consolidate(
    df: DataFrame,
    target: str,
    staging: str,
    partition_by: Sequence[str] = (),
    geometry: str = "geometry",
    bbox_scope: str = "dataset",
    max_rows_per_file: int | None = None,
    extra: dict | None = None,
    spatial: bool = False,
    group_rows: int | None = None,
) -> DataFrame:
    """Write ``df`` as one GeoParquet file per partition folder under ``target``.

    Rows go to ``staging`` first, rebalanced by partition value: a folder that holds most rows is written by
    many tasks, small folders by one. Returns ``target, sources, rows`` per final file.

    ``spatial``: rows get a ``bbox`` column that the footer names as covering, and each file is ordered along a Hilbert curve
    in row groups of ``group_rows`` (by default 50,000), so that ``read_geoparquet`` with a box reads few of them.
    """
    spark = df.sparkSession
    guard_target(target)
    if spatial:
        balanced = ordered_in_space(with_covering(df, geometry), partition_by)
        extra = {**COVERING_EXTRA, **(extra or {})}
        group_rows = group_rows or SPATIAL_GROUP_ROWS
    else:
        balanced = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    writer = balanced.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(guard_target(staging))
    return consolidate_files(spark, staging, target, geometry, bbox_scope, max_rows_per_file, extra, group_rows)


def write_grid_file(grid: DataFrame, target: str, staging: str) -> DataFrame:
    """Publish a grid as a single GeoParquet file whose footer declares orientation and spherical edges."""
    from gridstats.operators.grid import encode_grid

    published = grid if set(grid.columns) == {"node_id", "geometry"} else encode_grid(grid)
    return consolidate(published.select("node_id", "geometry"), target, staging, extra=GRID_EXTRA)

