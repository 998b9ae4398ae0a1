"""Refreshing the partitions that changed, and counts of rows that drop out."""

import os
import struct

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gridstats.functions.wkb import point_wkb
from gridstats.operators.faults import FAULTS, count_faults, observe_faults
from gridstats.plans.tables import finalise_table, refresh_statistics, statistics_tables
from gridstats.sources.changes import changed_partitions, drop_stale, overwrite_partitions, within_partitions
from gridstats.sources.tables import write_grid, write_table


def point(x, y, order="<", srid=None):
    code = 1 if srid is None else 1 | 0x20000000
    head = struct.pack(f"{order}BI", 1 if order == "<" else 0, code)
    return head + (b"" if srid is None else struct.pack(f"{order}I", srid)) + struct.pack(f"{order}2d", x, y)


NAN = float("nan")
GEOMETRIES = [
    (None, FAULTS[0]),
    (b"", FAULTS[1]),
    (b"\x01", FAULTS[1]),
    (point(1, 2)[:12], FAULTS[1]),
    (point(1, 2, srid=4326)[:21], FAULTS[1]),
    (b"\x07" + point(1, 2)[1:], FAULTS[1]),
    (struct.pack("<BII", 1, 2, 0), FAULTS[1]),
    (point(NAN, NAN), FAULTS[2]),
    (point(1, float("inf"), ">"), FAULTS[2]),
    (point(NAN, 2, srid=4326), FAULTS[2]),
    (point(1, 2), None),
    (point(1, 2, ">", 4326), None),
]


@pytest.mark.parametrize("k", range(len(GEOMETRIES)))
def test_fault_of_a_geometry(spark, k):
    geometry, fault = GEOMETRIES[k]
    df = spark.createDataFrame([(geometry, 1), (geometry, None)], "geometry binary, day int")
    found = count_faults(df, ["day"]).first().asDict()
    expected = dict.fromkeys(FAULTS, 0) | {"rows": 2, fault or "missing_key": 2 if fault else 1}
    assert found == expected


def test_faults_of_text_and_coordinates(spark):
    text = spark.createDataFrame([("POINT (1 2)",), ("POINT EMPTY",), ("LINESTRING (0 0, 1 1)",), (None,), ("POINT (1e999 2)",)], "geometry string")
    assert count_faults(text).first().asDict() == {"rows": 5, FAULTS[0]: 1, FAULTS[1]: 2, FAULTS[2]: 1, FAULTS[3]: 0}
    plain = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (NAN, 2.0), (1.0, float("-inf"))], "lon double, lat double")
    assert count_faults(plain).first().asDict() == {"rows": 4, FAULTS[0]: 1, FAULTS[1]: 0, FAULTS[2]: 2, FAULTS[3]: 0}
    assert count_faults(plain.limit(0)).first()["rows"] == 0


def test_observed_faults_cost_no_job_of_their_own(spark, tmp_path):
    df = spark.createDataFrame([(g, 1) for g, _ in GEOMETRIES], "geometry binary, day int").repartition(3)
    seen = Observation("faults")
    group = "observed faults"
    spark.sparkContext.setJobGroup(group, "")
    observe_faults(df, seen, ["day"]).where("lon > 0").write.parquet(str(tmp_path / "out"))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    counts = seen.get
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == jobs
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts == count_faults(df, ["day"]).first().asDict()


@pytest.fixture
def station(spark, tmp_path):
    """Tables of points by day and hour, and a grid; (make(day, hour, rows), run(**options), paths)."""
    base = str(tmp_path)
    made = []

    def rows(day, hour, n, shift=0.0):
        lon, lat = (F.col("id") % 7) * F.lit(0.01), (F.col("id") % 5) * F.lit(0.01)
        where = [point_wkb(lon, lat).alias("geometry"), F.lit("2024-05-01 00:00:00").cast("timestamp").alias("timestamp")]
        value = (F.col("id") * F.lit(1.5) + F.lit(shift)).alias("speed")
        day, hour = F.lit(day).cast("date").alias("day"), F.lit(hour).alias("hour")
        return spark.range(n).select(F.col("id").alias("rowid"), *where, value, day, hour)

    first = rows("2024-05-01", "a/b", 40).union(rows("2024-05-01", "c+ d", 30)).union(rows("2024-05-02", "a/b", 20))
    write_table(first, "refresh_points", f"{base}/points", ["day", "hour"])
    nodes = spark.createDataFrame([("N1", 0.0, 0.0), ("N2", 0.03, 0.02)], "node_id string, lon double, lat double")
    write_grid(nodes, "refresh_grid", f"{base}/grid")

    def refresh(parts=("day", "hour"), **options):
        made.append(refresh_statistics(spark, "refresh_points", None, "refresh_grid", "refresh_stats", f"{base}/stats", ["speed"], parts, **options))
        return made[-1]

    def whole(parts=("day", "hour")):
        args = ("refresh_points", None, "refresh_grid", "refresh_whole", f"{base}/whole", ["speed"])
        return sorted(map(str, statistics_tables(spark, *args, partition_by=parts).collect()))

    def files():
        found = {}
        for folder, _, names in os.walk(f"{base}/stats"):
            for name in names:
                if name.endswith(".parquet") and "_state" not in folder:
                    found.setdefault(os.path.relpath(folder, f"{base}/stats"), set()).add(name)
        return found

    yield rows, refresh, whole, files, base
    for name in ("refresh_points", "refresh_grid", "refresh_stats", "refresh_whole"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_only_changed_partitions_are_written(spark, station):
    rows, refresh, whole, files, base = station
    assert sorted(map(str, refresh().collect())) == whole()
    first = files()
    assert len(first) == 3
    assert sorted(map(str, refresh().collect())) == whole() and files() == first

    rows("2024-05-02", "a/b", 5, 100.0).write.mode("append").partitionBy("day", "hour").parquet(f"{base}/points")
    assert sorted(map(str, refresh().collect())) == whole()
    second = files()
    assert {k for k in first if second[k] != first[k]} == {k for k in first if k.startswith("day=2024-05-02")}

    # a new one, and one whose points move away from all nodes
    rows("2024-05-03", "x'y", 9).write.mode("append").partitionBy("day", "hour").parquet(f"{base}/points")
    far = rows("2024-05-01", "c+ d", 6).withColumn("geometry", point_wkb(F.lit(50.0), F.lit(50.0)))
    overwrite_partitions(far, f"{base}/points", ["day", "hour"])
    assert sorted(map(str, refresh().collect())) == whole()
    third = files()
    kept = {k for k in first if "a%2Fb" in k}
    assert len(kept) == 2 and {k: third[k] for k in kept} == {k: second[k] for k in kept} and len(third) == 3

    # a partition that goes, alone
    gone = spark.sql("SELECT DATE'2024-05-03' AS day, 'x\\'y' AS hour")
    drop_stale(spark, "refresh_points", gone, ["day", "hour"])
    assert sorted(map(str, refresh().collect())) == whole() and len(files()) == 2


def test_other_settings_or_grid_make_everything(spark, station):
    rows, refresh, whole, files, base = station
    refresh()
    first = files()
    refresh(median="disc")
    second = files()
    assert all(second[k] != first[k] for k in first)
    write_grid(spark.createDataFrame([("N3", 0.01, 0.01)], "node_id string, lon double, lat double"), "refresh_grid", f"{base}/grid")
    assert {r["node_id"] for r in refresh(median="disc").collect()} == {"N3"}
    # fewer partition columns: another layout
    assert sorted(map(str, refresh(parts=["day"]).collect())) == whole(["day"])
    with pytest.raises(ValueError, match="only partitioned"):
        refresh(parts=[])


def test_a_run_that_did_not_end_is_taken_up(spark, station, monkeypatch):
    rows, refresh, whole, files, base = station
    refresh()
    rows("2024-05-02", "a/b", 5, 7.0).write.mode("append").partitionBy("day", "hour").parquet(f"{base}/points")
    import gridstats.plans.tables as plans

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(plans, "overwrite_partitions", broken)
        with pytest.raises(OSError, match="lost"):
            refresh()
    assert sorted(map(str, refresh().collect())) == whole()


def test_changed_partitions(spark):
    schema = "day string, _files long, _mark long, _settings string"
    before = spark.createDataFrame([("a", 1, 5, "s"), ("b", 1, 6, "s"), ("c", 2, 7, "s")], schema)
    now = spark.createDataFrame([("a", 1, 5, "s"), ("b", 1, 9, "s"), ("d", 2, 7, "s")], schema)
    assert {r[0] for r in changed_partitions(before, now, ["day"]).collect()} == {"b", "c", "d"}
    values = spark.createDataFrame([("b",)], "day string")
    assert within_partitions(now, values).count() == 1 and within_partitions(now, values.limit(0)).count() == 0


def test_table_stays_until_its_consolidated_files_are_registered(spark, station, monkeypatch):
    rows, refresh, whole, files, base = station
    expected = sorted(map(str, refresh().collect()))
    import gridstats.plans.tables as plans

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(plans, "repair", broken)
        with pytest.raises(OSError, match="lost"):
            finalise_table(spark, "refresh_stats", f"{base}/lost")
    assert sorted(map(str, spark.table("refresh_stats").collect())) == expected
    assert sorted(map(str, finalise_table(spark, "refresh_stats", f"{base}/final").collect())) == expected
    assert all("/final/" in f for f in spark.table("refresh_stats").inputFiles())
    # the table has moved, so what was noted beside the old files no longer counts
    assert sorted(map(str, refresh().collect())) == whole()
    for table in spark.catalog.listTables():
        if table.name.startswith("refresh_stats_"):
            spark.sql(f"DROP TABLE {table.name}")
