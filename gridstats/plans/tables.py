"""The stages as table-to-table runs: names in, checks, the operator, a written and registered table out."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridstats.constants import DEFAULT_RADIUS_KM
from gridstats.operators.aggregate import aggregate_direction, aggregate_grid, aggregate_projection
from gridstats.operators.link import link_to_grid
from gridstats.plans.sizing import pin
from gridstats.sources.changes import (
    changed_partitions,
    drop_stale,
    files_within,
    noted_marks,
    overwrite_partitions,
    partition_marks,
    table_mark,
    within_partitions,
)
from gridstats.sources.finalise import consolidate_files
from gridstats.sources.tables import (
    guard_target,
    partition_columns,
    read_points,
    repair,
    require_partitions,
    require_tables,
    resolve_table,
    write_table,
)


def link_tables(
    spark: SparkSession,
    data: str,
    grid: str,
    output: str,
    path: str,
    radius_km: float = DEFAULT_RADIUS_KM,
    default_db: str | None = None,
    buckets: int | None = None,
    **layout,
) -> DataFrame:
    """Table ``output`` of ``rowid, node_id`` at ``path`` from the tables ``data`` and ``grid``.

    With ``buckets`` it is bucketed on ``rowid``; if ``data`` is, by the same number, statistics join both without an exchange.
    """
    guard_target(path)
    require_tables(spark, data, grid, default_db=default_db)
    points = read_points(spark, data, [], default_db=default_db)
    links = link_to_grid(points, spark.table(resolve_table(grid, default_db)), radius_km, **layout)
    name = resolve_table(output, default_db)
    write_table(links, name, path, bucket_by=["rowid"] if buckets else (), buckets=buckets)
    return spark.table(name)


def _statistics(
    spark: SparkSession,
    data: str,
    links: str | None,
    grid: str,
    columns: Sequence[str],
    time: str,
    partition_by: Sequence[str],
    directions: Sequence[str],
    magnitudes: Sequence[str] | None,
    projection: tuple[str, float, float] | None,
    default_db: str | None,
    only: DataFrame | None = None,
    **options,
) -> DataFrame:
    """The statistics frame of tables, partition columns last; ``only`` holds the partition values to read."""
    if directions and projection:
        raise ValueError("directions and a projection are separate runs")
    require_tables(spark, data, grid, *([links] if links else []), default_db=default_db)
    require_partitions(spark, data, list(partition_by), default_db)
    angles = [*directions, *[m for m in magnitudes or [] if m.lower() != "skip"]]
    wanted = list(dict.fromkeys([time, *columns, *angles, *partition_by]))
    points = read_points(spark, data, wanted, default_db=default_db)
    if only is not None:
        points = within_partitions(points, only)
    pairs = spark.table(resolve_table(links, default_db)) if links else None
    nodes = spark.table(resolve_table(grid, default_db))
    common = {"time": time, "partition_by": list(partition_by), **options}
    if directions:
        stats = aggregate_direction(points, pairs, nodes, list(columns), list(directions), magnitudes, **common)
    elif projection:
        stats = aggregate_projection(points, pairs, nodes, list(columns), *projection, **common)
    else:
        stats = aggregate_grid(points, pairs, nodes, list(columns), **common)
    ordered = [c for c in stats.columns if c not in partition_by] + list(partition_by)
    return stats.select(*[F.col(f"`{c}`") for c in ordered])


def statistics_tables(
    spark: SparkSession,
    data: str,
    links: str | None,
    grid: str,
    output: str,
    path: str,
    columns: Sequence[str],
    time: str = "timestamp",
    partition_by: Sequence[str] = (),
    directions: Sequence[str] = (),
    magnitudes: Sequence[str] | None = None,
    projection: tuple[str, float, float] | None = None,
    default_db: str | None = None,
    **options,
) -> DataFrame:
    """Table ``output`` of statistics at ``path``, partitioned by ``partition_by``.

    Plain statistics; with ``directions`` (and ``magnitudes``) circular ones too; with ``projection`` (column, latitude,
    longitude) that column is first turned toward the point. ``links=None`` pairs points and nodes on the fly. Partition
    columns must be partition keys of ``data`` and come last. Pass an ``Observation`` as ``dropped`` to learn how many rows
    were read and why others were left out; its counts come from the same pass.
    """
    guard_target(path)
    stats = _statistics(spark, data, links, grid, columns, time, partition_by, directions, magnitudes, projection, default_db, **options)
    name = resolve_table(output, default_db)
    write_table(stats, name, path, partition_by)
    return spark.table(name)


def refresh_statistics(
    spark: SparkSession,
    data: str,
    links: str | None,
    grid: str,
    output: str,
    path: str,
    columns: Sequence[str],
    partition_by: Sequence[str],
    time: str = "timestamp",
    directions: Sequence[str] = (),
    magnitudes: Sequence[str] | None = None,
    projection: tuple[str, float, float] | None = None,
    default_db: str | None = None,
    **options,
) -> DataFrame:
    """``statistics_tables`` for partitions of ``data`` that changed since the last such run; the others' files stay as they are.

    A partition has changed when names, sizes or times of its files are others than those noted at ``<path>/_state``. The
    first run makes everything, as does one with other settings, with a grid or link table that changed, or after the table
    was moved. A run that did not end is taken up by the next. Partitions that ``data`` no longer has, or whose rows now meet
    no node, go. The result is that of a full run.
    """
    if not partition_by:
        raise ValueError("only partitioned statistics can be refreshed")
    parts, target = list(partition_by), guard_target(path)
    source, name = resolve_table(data, default_db), resolve_table(output, default_db)
    require_tables(spark, data, grid, *([links] if links else []), default_db=default_db)
    require_partitions(spark, data, parts, default_db)
    repair(spark, source)
    settings = repr((source, list(columns), parts, time, list(directions), magnitudes, projection, sorted(options.items(), key=str)))
    others = [table_mark(spark, resolve_table(t, default_db)) for t in (grid, links) if t]
    # noted before any row is read: files that come during the run count as changed in the next
    now = pin(partition_marks(spark, source, parts, settings, others))
    args = (spark, data, links, grid, columns, time, parts, directions, magnitudes, projection, default_db)
    before = noted_marks(spark, name, target, now)
    if before is None:
        write_table(_statistics(*args, **options), name, target, parts)
    else:
        changed = pin(changed_partitions(before, now, parts))
        if changed.isEmpty():
            return spark.table(name)
        held = pin(files_within(spark, target, name, changed))
        todo = pin(changed.join(now.select(*[F.col(f"`{c}`") for c in parts]), parts, "left_semi"))
        overwrite_partitions(_statistics(*args, only=todo, **options), target, parts)
        drop_stale(spark, name, files_within(spark, target, name, changed).join(held, "path", "left_semi"), parts)
        repair(spark, name)
    now.write.mode("overwrite").parquet(f"{target}/_state")
    return spark.table(name)


def finalise_table(spark: SparkSession, name: str, target: str, default_db: str | None = None, **options) -> DataFrame:
    """Consolidate the files of a table into ``target``, one GeoParquet file per folder, and let the table read them.

    A failure before the new table is whole leaves the old one as it was.
    """
    name = resolve_table(name, default_db)
    require_tables(spark, name)
    parts = partition_columns(spark, name)
    schema = spark.table(name).schema
    location = next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Location")
    consolidate_files(spark, location, target, **options)
    # whole under a name of its own before the old entry goes; the files of the old location stay until someone removes them
    made = f"{name}_{uuid.uuid4().hex[:8]}"
    options_sql = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else ""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {made} ({fields}) USING parquet{options_sql} LOCATION '{guard_target(target)}'")
    repair(spark, made)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {made} RENAME TO {name}")
    return spark.table(name)
