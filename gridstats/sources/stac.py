"""A portable STAC catalog of a GeoParquet dataset.

Items, sub-catalogs and extents are DataFrames; the JSON documents are written by the tasks that hold the
rows. Layout: ``collection.json``, ``items/<partition>/catalog.json`` per partition level (nested the same
way), items beside their catalog under ``items/``, data under ``assets/``. All links are relative.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from datetime import date
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pyarrow.types as pt
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.constants import (
    DEFAULT_LICENSE,
    PARQUET_MEDIA_TYPE,
    STAC_VERSION,
    TABLE_EXTENSION,
    TIME_CANDIDATES,
    TIME_PAIR,
)
from gridstats.functions.text import item_id, partition_segments, rfc3339, safe_id, utc_time
from gridstats.plans.sizing import pin
from gridstats.sources.files import (
    copy_files,
    open_location,
    parquet_inventory,
    qualified,
    require_files,
    with_footer_fields,
    write_whole,
)

_DESCRIPTION = "Statistics of point observations per grid node, as GeoParquet files."


def asset_times(df: DataFrame, by: Sequence[str], candidates: Sequence[str] = TIME_CANDIDATES) -> DataFrame:
    """``by``, ``start_time``, ``end_time`` per group of rows (UTC, zoneless).

    The pair (first, last measurement) counts when both have values; else the first candidate column, in
    the given order, that has any readable value.
    """
    group = [F.col(f"`{c}`") for c in by]
    present = [c for c in candidates if c in df.columns and c not in by]
    if not present:
        empty = F.lit(None).cast("timestamp_ntz")
        return df.select(*group).distinct().withColumns({"start_time": empty, "end_time": empty})
    moments = df.select(*group, *[utc_time(F.col(f"`{c}`"), df.schema[c].dataType).alias(f"_t{i}") for i, c in enumerate(present)])
    return _first_range(moments, by, present)


def _first_range(moments: DataFrame, by: Sequence[str], present: Sequence[str]) -> DataFrame:
    """``by``, ``start_time``, ``end_time`` from the zoneless moments ``_t0, _t1, ...`` of the candidates ``present``."""
    group = [F.col(f"`{c}`") for c in by]
    ranges = moments.groupBy(*group).agg(
        *[f(f"_t{i}").alias(f"_{f.__name__}{i}") for i in range(len(present)) for f in (F.min, F.max)]
    )
    starts = [F.col(f"_min{i}") for i in range(len(present))]
    ends = [F.col(f"_max{i}") for i in range(len(present))]
    if all(c in present for c in TIME_PAIR):
        first, last = (present.index(c) for c in TIME_PAIR)
        both = starts[first].isNotNull() & ends[last].isNotNull()
        starts.insert(0, F.when(both, starts[first]))
        ends.insert(0, F.when(both, ends[last]))
    return ranges.select(*group, F.coalesce(*starts).alias("start_time"), F.coalesce(*ends).alias("end_time"))


_STORED_TIMES = "uri string, candidate int, moment timestamp_ntz, text string"


def _is_time(kind: pa.DataType) -> bool:
    return pt.is_timestamp(kind) or pt.is_date(kind)


def _footer_ends(file: pq.ParquetFile, group: int, name: str) -> pa.Array | None:
    """First and last value of a time column in a row group by the footer's statistics, none if it has only NULLs.

    ``None`` when the footer does not tell.
    """
    stored = file.metadata.row_group(group)
    for k in range(stored.num_columns):
        column = stored.column(k)
        if column.path_in_schema != name:
            continue
        known = column.statistics
        if known is None:
            return None
        if known.has_null_count and known.null_count == stored.num_rows:
            return pa.array([], pa.timestamp("us"))
        if known.has_min_max and isinstance(known.min, date):
            return pa.array([known.min, known.max])
    return None


def _stored_times(candidates: Sequence[str]):
    """Per file, row group and candidate column: first and last moment, or the distinct texts of a text column.

    Moments come from the footer; a column is read where its statistics are missing, and texts always are.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, uri in zip(batch.column("path").to_pylist(), batch.column("uri").to_pylist(), strict=True):
                system, where = open_location(path)
                with system.open_input_file(where) as handle:
                    file = pq.ParquetFile(handle, coerce_int96_timestamp_unit="us")
                    for k, name in enumerate(candidates):
                        if name not in file.schema_arrow.names:
                            continue
                        kind = file.schema_arrow.field(name).type
                        for group in range(file.num_row_groups):
                            moments, texts = [], []
                            if pt.is_string(kind) or pt.is_large_string(kind):
                                texts = file.read_row_group(group, columns=[name]).column(0).unique().drop_null().to_pylist()
                            elif _is_time(kind):
                                column = _footer_ends(file, group, name)
                                if column is None:
                                    column = file.read_row_group(group, columns=[name]).column(0)
                                ends = pc.min_max(column.cast(pa.timestamp("us", getattr(column.type, "tz", None)), safe=False))
                                # a zoned column tells its wall clock; moments are UTC
                                moments = [v.cast(pa.timestamp("us")).as_py() for v in ends.values() if v.is_valid]
                            n = len(moments) + len(texts)
                            yield pa.record_batch(
                                {
                                    "uri": pa.array([uri] * n, pa.string()),
                                    "candidate": pa.array([k] * n, pa.int32()),
                                    "moment": pa.array([*moments, *[None] * len(texts)], pa.timestamp("us")),
                                    "text": pa.array([*[None] * len(moments), *texts], pa.string()),
                                }
                            )

    return read


def file_times(files: DataFrame, candidates: Sequence[str] = TIME_CANDIDATES) -> DataFrame:
    """``_uri``, ``start_time``, ``end_time`` of the files in an inventory, each with the types it has itself; from footers where they tell."""
    spread = max(files.sparkSession.sparkContext.defaultParallelism, 1)
    rows = files.select("path", "uri").repartition(spread, "path").mapInArrow(_stored_times(candidates), _STORED_TIMES)
    moment = F.coalesce("moment", utc_time(F.col("text"), T.StringType()))
    moments = rows.select(F.col("uri").alias("_uri"), *[F.when(F.col("candidate") == k, moment).alias(f"_t{k}") for k in range(len(candidates))])
    return _first_range(moments, ["_uri"], list(candidates))


def read_assets(spark: SparkSession, root: str, candidates: Sequence[str] = TIME_CANDIDATES) -> DataFrame:
    """One row per file: ``rel, partitions, bbox, start_time, end_time, row_count, columns, primary_column``."""
    files = require_files(with_footer_fields(parquet_inventory(spark, root)), root)
    times = file_times(files, candidates)
    return files.join(times, files["uri"] == times["_uri"], "left").select(
        "rel",
        partition_segments(F.col("rel")).alias("partitions"),
        "bbox",
        "start_time",
        "end_time",
        F.col("num_rows").alias("row_count"),
        "columns",
        "primary_column",
    )


def _catalog_folder(partitions: Column) -> Column:
    """Folder of the (sub-)catalog of a partition prefix, relative to the root, '' for the root itself."""
    return F.array_join(F.transform(partitions, lambda p: F.concat(F.lit("items/"), safe_id(p))), "/")


def _under(folder: Column, name: Column) -> Column:
    return F.when(folder == "", name).otherwise(F.concat(folder, F.lit("/"), name))


def _catalog_file(partitions: Column) -> Column:
    name = F.when(F.size(partitions) == 0, F.lit("collection.json")).otherwise(F.lit("catalog.json"))
    return _under(_catalog_folder(partitions), name)


def stac_items(assets: DataFrame) -> DataFrame:
    """Catalog entries: ``id, self_path, asset_href, rel, partitions, bbox, ring, start, end, row_count, ...``.

    ``ring`` is the closed outline of the box; ``start`` / ``end`` are RFC 3339 text.
    """
    box = F.col("bbox")
    corners = ((2, 1), (2, 3), (0, 3), (0, 1), (2, 1))
    ring = F.array(*[F.array(box[x], box[y]) for x, y in corners])
    folder = _catalog_folder(F.col("partitions"))
    identifier = item_id(F.col("rel"))
    up = F.expr("repeat('../', 1 + 2 * size(partitions))")
    return assets.select(
        identifier.alias("id"),
        _under(folder, F.concat(F.lit("items/"), identifier, F.lit(".json"))).alias("self_path"),
        F.concat(up, F.lit("assets/"), "rel").alias("asset_href"),
        "rel",
        "partitions",
        "bbox",
        F.when(box.isNotNull(), ring).alias("ring"),
        rfc3339(F.col("start_time")).alias("start"),
        rfc3339(F.col("end_time")).alias("end"),
        "row_count",
        "columns",
        "primary_column",
    )


def stac_catalogs(items: DataFrame) -> DataFrame:
    """``partitions, self_path, children, items``: one row per partition prefix, the collection being ``[]``.

    ``children`` are sub-catalog files and ``items`` item files, relative to the root and sorted.
    """
    depths = F.sequence(F.lit(0), F.size("partitions"))
    prefixes = items.select(F.explode(F.transform(depths, lambda n: F.slice("partitions", 1, n))).alias("prefix")).distinct()
    entries = prefixes.where(F.size("prefix") > 0).select(
        F.slice("prefix", 1, F.size("prefix") - 1).alias("prefix"),
        F.struct(F.element_at("prefix", -1).alias("key"), _catalog_file(F.col("prefix")).alias("file")).alias("child"),
        F.lit(None).cast("struct<key:string,file:string>").alias("item"),
    )
    leaves = items.select(
        F.col("partitions").alias("prefix"),
        F.lit(None).cast("struct<key:string,file:string>").alias("child"),
        F.struct(F.col("rel").alias("key"), F.col("self_path").alias("file")).alias("item"),
    )
    both = entries.unionByName(leaves).groupBy("prefix").agg(
        F.transform(F.array_sort(F.collect_list("child")), lambda e: e["file"]).alias("children"),
        F.transform(F.array_sort(F.collect_list("item")), lambda e: e["file"]).alias("items"),
    )
    return both.select(F.col("prefix").alias("partitions"), _catalog_file(F.col("prefix")).alias("self_path"), "children", "items")


def stac_extent(assets: DataFrame) -> DataFrame:
    """One row: ``bbox, start, end, row_count, columns`` over all assets (columns of the first by path)."""
    sides = [f(F.col("bbox")[k]) for k, f in enumerate((F.min, F.min, F.max, F.max))]
    return assets.agg(
        F.when(F.count("bbox") > 0, F.array(*sides)).alias("bbox"),
        rfc3339(F.min("start_time")).alias("start"),
        rfc3339(F.max("end_time")).alias("end"),
        F.sum("row_count").alias("row_count"),
        F.min_by("columns", "rel").alias("columns"),
    )


# ---------------------------------------------------------------- documents


def _link(rel: str, own: str, other: str) -> dict[str, str]:
    """Relative link between two files given relative to the catalog root."""
    here, there = own.split("/")[:-1], other.split("/")
    common = 0
    while common < min(len(here), len(there) - 1) and here[common] == there[common]:
        common += 1
    steps = [".."] * (len(here) - common) + there[common:]
    href = "/".join(steps)
    kind = "application/geo+json" if rel == "item" else "application/json"
    return {"rel": rel, "href": href if href.startswith("..") else "./" + href, "type": kind}


def _parent(partitions: Sequence[str], own: str) -> str:
    """File of the catalog that lists ``own``."""
    folder = own.split("/")[:-2]
    return "/".join([*folder, "catalog.json"]) if len(partitions) else "collection.json"


def _item_document(row: Any, collection_id: str, extra: Mapping[str, Any]) -> dict[str, Any]:
    properties = dict(extra)
    properties["datetime"] = row.start
    properties["start_datetime"] = row.start
    if row.end is not None:
        properties["end_datetime"] = row.end
    properties["table:columns"] = [{"name": c["name"], "type": c["type"]} for c in row.columns]
    properties["table:row_count"] = int(row.row_count)
    if row.primary_column:
        properties["table:primary_geometry"] = row.primary_column
    boxed = row.bbox is not None
    parent = _parent(row.partitions, row.self_path)
    document = {
        "type": "Feature",
        "stac_version": STAC_VERSION,
        "stac_extensions": [TABLE_EXTENSION],
        "id": row.id,
        "geometry": {"type": "Polygon", "coordinates": [[[float(v) for v in p] for p in row.ring]]} if boxed else None,
        "properties": properties,
        "links": [
            _link("root", row.self_path, "collection.json"),
            _link("collection", row.self_path, "collection.json"),
            _link("parent", row.self_path, parent),
        ],
        "assets": {"data": {"href": row.asset_href, "type": PARQUET_MEDIA_TYPE, "roles": ["data"]}},
        "collection": collection_id,
    }
    if boxed:
        document["bbox"] = [float(v) for v in row.bbox]
    return document


def _catalog_document(row: Any, base: Mapping[str, Any]) -> dict[str, Any]:
    own = row.self_path
    links = [_link("root", own, "collection.json")]
    links += [_link("child", own, c) for c in row.children] + [_link("item", own, i) for i in row.items]
    if not len(row.partitions):
        return {**base, "links": links}
    folder = own.split("/")[:-3]
    parent = "/".join([*folder, "catalog.json"]) if len(row.partitions) > 1 else "collection.json"
    segment = row.partitions[-1]
    return {
        "type": "Catalog",
        "id": own.split("/")[-2],
        "stac_version": STAC_VERSION,
        "description": f"Files of {segment}",
        "links": [*links, _link("parent", own, parent)],
    }


def _writer(root: str, document):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                text = json.dumps(document(row), indent=2).encode()
                write_whole(f"{root}/{row.self_path}", lambda sink, text=text: sink.write(text))
            yield batch[["self_path"]]

    return write


def _delete_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            system, where = open_location(path)
            if system.get_file_info(where).is_file:
                system.delete_file(where)
        yield batch[["path"]]


def write_stac(
    spark: SparkSession,
    root: str,
    collection_id: str,
    source: str | None = None,
    move: bool = False,
    item_properties: Mapping[str, Any] | None = None,
    collection_properties: Mapping[str, Any] | None = None,
    candidates: Sequence[str] = TIME_CANDIDATES,
) -> DataFrame:
    """Write the catalog of the data under ``root/assets``; returns the item rows.

    ``source`` is copied there first, partition folders kept (``move=True`` deletes each source file after
    everything has been copied). Raises ``ValueError`` when there are no assets, when an asset has no time,
    or when two files would share one item.
    """
    base = qualified(spark, root)
    if source is not None:
        incoming = require_files(parquet_inventory(spark, source), source)
        copy_files(incoming, f"{base}/assets")
        if move:
            incoming.select("path").mapInPandas(_delete_task, "path string").count()
    assets = pin(read_assets(spark, f"{base}/assets", candidates))
    timeless = assets.where("start_time is null").agg(F.min("rel")).first()[0]
    if timeless is not None:
        raise ValueError(f"no time found in {timeless}")
    items = stac_items(assets)
    window = Window.partitionBy("self_path")
    clash = items.withColumn("_n", F.count("*").over(window)).where("_n > 1").agg(F.min("self_path")).first()[0]
    if clash is not None:
        raise ValueError(f"two files share the item {clash}")

    overall = stac_extent(assets).first()
    properties = dict(collection_properties or {})
    collection = {
        "type": "Collection",
        "id": collection_id,
        "stac_version": STAC_VERSION,
        "description": properties.pop("description", _DESCRIPTION),
        "license": properties.pop("license", DEFAULT_LICENSE),
        "extent": {
            "spatial": {"bbox": [list(overall["bbox"] or [0, 0, 0, 0])]},
            "temporal": {"interval": [[overall["start"], overall["end"]]]},
        },
        "stac_extensions": [TABLE_EXTENSION],
        "table:tables": [
            {
                "name": collection_id,
                "description": "Aggregated GeoParquet table",
                "columns": [{"name": c["name"], "type": c["type"]} for c in overall["columns"]],
                "row_count": overall["row_count"],
            }
        ],
        **properties,
    }
    spread = max(spark.sparkContext.defaultParallelism, 1)
    extra = dict(item_properties or {})
    write_items = _writer(base, lambda row: _item_document(row, collection_id, extra))
    items.repartition(spread, "self_path").mapInPandas(write_items, "self_path string").count()
    write_catalogs = _writer(base, lambda row: _catalog_document(row, collection))
    catalogs = stac_catalogs(items)
    catalogs.repartition(spread, "self_path").mapInPandas(write_catalogs, "self_path string").count()
    return items.orderBy("rel")

