"""Files ordered in space with a covering column, and scans that a box prunes."""

import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridstats.functions.curve import hilbert_key
from gridstats.functions.wkb import point_wkb
from gridstats.sources import files, finalise


def test_curve_visits_every_cell_and_moves_by_one(spark):
    side = 16
    cells = spark.range(side * side).select((F.col("id") % side).cast("double").alias("x"), F.floor(F.col("id") / side).cast("double").alias("y"))
    rows = cells.select("x", "y", hilbert_key(F.col("x"), F.col("y"), 0.0, 0.0, float(side), float(side), 4).alias("k")).orderBy("k").collect()
    assert [r["k"] for r in rows] == list(range(side * side))
    assert all(abs(a["x"] - b["x"]) + abs(a["y"] - b["y"]) == 1 for a, b in zip(rows, rows[1:], strict=False))


def test_curve_of_odd_positions(spark):
    rows = [(None, 1.0), (float("nan"), 1.0), (-999.0, -999.0), (999.0, -999.0), (-180.0, -90.0), (180.0, -90.0)]
    found = [r[0] for r in spark.createDataFrame(rows, "x double, y double").coalesce(1).select(hilbert_key(F.col("x"), F.col("y"))).collect()]
    assert found[:2] == [None, None] and found[2] == found[4] == 0 and found[3] == found[5] == (1 << 32) - 1


@pytest.fixture(scope="module")
def scattered(spark):
    n = F.col("id")
    lon, lat = -10 + ((n * 7919) % 10007) / 1000.7, 35 + ((n * 104729) % 10009) / 1000.9
    placed = spark.range(20_000).select(n.alias("rowid"), lon.alias("lon"), lat.alias("lat"), F.when(n % 3 > 0, "a").otherwise("b").alias("part"))
    n = F.col("rowid")
    broken = F.when(n % 1000 == 7, F.unhex(F.lit("0101"))).when(n % 1000 == 8, F.lit(None)).otherwise(point_wkb("lon", "lat"))
    return placed.withColumn("geometry", broken).repartition(6)


def groups_of(root):
    found = []
    for folder, _, names in os.walk(root):
        for name in names:
            meta = pq.ParquetFile(os.path.join(folder, name)).metadata
            paths = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
            for g in range(meta.num_row_groups):
                boxes = [meta.row_group(g).column(paths[f"bbox.{s}"]).statistics for s in ("xmin", "ymin", "xmax", "ymax")]
                found.append((meta.row_group(g).num_rows, *[getattr(b, k) for b, k in zip(boxes, ("min", "min", "max", "max"), strict=True)]))
    return found


def meets(group, box):
    return group[1] <= box[2] and group[3] >= box[0] and group[2] <= box[3] and group[4] >= box[1]


def test_box_reads_few_row_groups(spark, scattered, tmp_path):
    out = str(tmp_path / "out")
    done = finalise.consolidate(scattered, out, str(tmp_path / "stage"), ["part"], spatial=True, group_rows=500)
    assert done.agg(F.sum("rows")).first()[0] == 20_000
    geo = json.loads(pq.read_schema(f"{out}/part=a/a.parquet").metadata[b"geo"])
    assert geo["columns"]["geometry"]["covering"]["bbox"]["xmin"] == ["bbox", "xmin"]
    groups = groups_of(out)
    assert len(groups) >= 40 and max(g[0] for g in groups) <= 500
    area = sum((g[3] - g[1]) * (g[4] - g[2]) for g in groups if g[1] is not None)
    assert area < 8 * 100  # the range is 10 by 10; unordered groups would each cover nearly all of it, twice 20 times

    box = (-6.5, 38.0, -5.5, 39.25)
    back = files.read_geoparquet(spark, out, box)
    rows = {tuple(r) for r in back.select("rowid", "part").collect()}
    sound = (F.col("rowid") % 1000 != 7) & (F.col("rowid") % 1000 != 8)
    inside = scattered.where(F.col("lon").between(box[0], box[2]) & F.col("lat").between(box[1], box[3]) & sound)
    assert rows == {tuple(r) for r in inside.select("rowid", "part").collect()} and rows

    query = back.select("rowid", "part")
    query.collect()
    read = query._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    hit = sum(g[0] for g in groups if g[1] is not None and meets(g, box))
    assert read <= hit < 20_000 / 4


def test_box_without_covering_and_wrong_boxes(spark, scattered, tmp_path):
    scattered.write.parquet(str(tmp_path / "plain"))
    plain = files.read_geoparquet(spark, str(tmp_path / "plain"), (-6.5, 38.0, -5.5, 39.25))
    assert plain.columns == scattered.columns and 0 < plain.count() < 1000
    with pytest.raises(ValueError, match="west, south"):
        files.read_geoparquet(spark, str(tmp_path / "plain"), (1, 0, 0, 1))


def test_own_box_column_is_replaced(spark, tmp_path):
    df = spark.range(5).select(point_wkb(F.col("id").cast("double"), F.lit(1.0)).alias("geometry"), F.lit("x").alias("bbox"))
    finalise.consolidate(df, str(tmp_path / "out"), str(tmp_path / "stage"), spatial=True)
    assert [r["bbox"]["xmin"] for r in files.read_geoparquet(spark, str(tmp_path / "out"), (1.5, 0, 9, 2)).orderBy("bbox.xmin").collect()] == [2, 3, 4]
