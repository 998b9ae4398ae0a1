"""Which partitions of a table changed since a run, and writing just these."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.functions.text import partition_segments
from gridstats.plans.sizing import broadcast_if_small
from gridstats.sources.files import qualified
from gridstats.sources.tables import partition_columns

# What the folder of a NULL partition value is called.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return described.first()["data_type"]


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """``path, rel, length, modificationTime`` of the files below ``root``, hidden ones left out; names only are read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    found = found.select("path", "length", "modificationTime")
    relative = F.substring("path", len(qualified(spark, root)) + 2, 1 << 30)
    return found.withColumn("rel", relative).where(~F.col("rel").rlike(r"(^|/)[._][^/=]*(/|$)"))


def _folder_value(column: str) -> Column:
    """What the folder of a partition column is named after, as it stands in the path."""
    own = F.filter(partition_segments(F.col("rel")), lambda s: F.lower(F.substring_index(s, "=", 1)) == column.lower())
    return F.regexp_replace(F.try_element_at(own, F.lit(1)), "^[^=]*=", "")


def _with_values(files: DataFrame, parts: Sequence[str], schema: T.StructType) -> DataFrame:
    """Partition values of files from the names of their folders; files of NULL partitions are left out."""
    for c in parts:
        raw = _folder_value(c)
        # folder names escape bytes as %XX and use + for itself
        value = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
        files = files.withColumn(c, F.when(raw != NULL_FOLDER, value).try_cast(schema[c].dataType))
    for c in parts:
        files = files.where(F.col(f"`{c}`").isNotNull())
    return files


def _mark() -> list[Column]:
    """Changes with any file that comes, goes, or is written anew, whatever the order of files."""
    return [F.count(F.lit(1)).alias("_files"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("_mark")]


def table_mark(spark: SparkSession, name: str) -> str:
    row = _listed(spark, table_location(spark, name)).agg(*_mark()).first()
    return f"{name} {row['_files']} {row['_mark']}"


def partition_marks(
    spark: SparkSession, name: str, parts: Sequence[str], settings: str, others: Sequence[str] = ()
) -> DataFrame:
    """``parts, _files, _mark, _settings``: one row for each combination of values that the table has files for."""
    files = _with_values(_listed(spark, table_location(spark, name)), parts, spark.table(name).schema)
    marks = files.groupBy(*[F.col(f"`{c}`") for c in parts]).agg(*_mark())
    return marks.withColumn("_settings", F.sha2(F.lit("\n".join([settings, *others])), 256))


def noted_marks(spark: SparkSession, name: str, target: str, now: DataFrame) -> DataFrame | None:
    """The marks that an earlier run noted beside the files of table ``name`` at ``target``.

    ``None`` if there are none, if they belong to other settings than those of ``now``, or if the table has its files elsewhere.
    """
    if not spark.catalog.tableExists(name) or table_location(spark, name).rstrip("/") != qualified(spark, target):
        return None
    try:
        noted = spark.read.parquet(f"{target}/_state")
    except AnalysisException:
        return None
    if set(noted.columns) != set(now.columns):
        return None
    both = noted.select("_settings").union(now.select("_settings")).distinct()
    return noted if both.count() == 1 else None


def changed_partitions(before: DataFrame, now: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Values of partitions that are new, gone or other than ``before``."""
    columns = [F.col(f"`{c}`") for c in [*parts, "_files", "_mark"]]
    both = before.select(*columns).unionByName(now.select(*columns))
    # each side has one row for a partition, so an unchanged one has the same row twice
    times = both.groupBy(*columns).agg(F.count(F.lit(1)).alias("_times"))
    return times.where("_times = 1").select(*[F.col(f"`{c}`") for c in parts]).distinct()


def within_partitions(df: DataFrame, values: DataFrame) -> DataFrame:
    """Rows of ``df`` whose partition values are a row of ``values``; folders of other values are not scanned.

    The values of one column go into the plan: they are as many as the partitions that the catalog lists.
    """
    parts = values.columns
    for c in parts:
        listed = [r[0] for r in values.select(F.col(f"`{c}`")).distinct().collect()]
        df = df.where(F.col(f"`{c}`").isin(listed) if listed else F.lit(False))
    return df if len(parts) == 1 else df.join(broadcast_if_small(values), parts, "left_semi").select(*df.columns)


def overwrite_partitions(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows for; others stay. Files appear when all are written."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def files_within(spark: SparkSession, root: str, name: str, values: DataFrame) -> DataFrame:
    """``path`` and partition values of the files below ``root`` that belong to one of ``values``."""
    files = _with_values(_listed(spark, root), values.columns, spark.table(name).schema)
    return files.join(broadcast_if_small(values), values.columns, "left_semi").select("path", *values.columns)


def drop_stale(spark: SparkSession, name: str, files: DataFrame, parts: Sequence[str]) -> None:
    """Remove from table ``name`` the partitions that ``files`` are in, with their files."""
    fields = [f for f in spark.table(name).schema if f.name not in partition_columns(spark, name)]
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
    for row in files.select(*[F.col(f"`{c}`").cast("string") for c in parts]).distinct().collect():
        texts = [row[c].replace("\\", "\\\\").replace("'", "\\'") for c in parts]
        spec = ", ".join(f"`{c}` = '{v}'" for c, v in zip(parts, texts, strict=True))
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec})")
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({spec}) SELECT {nothing} WHERE false")
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
