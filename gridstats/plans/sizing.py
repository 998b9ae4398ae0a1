"""Size checks in front of every broadcast, and results that are computed once."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast side may hold at most this many rows and bytes; beyond either the join shuffles.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is provably small. Reads at most ``max_rows + 1`` rows per partition."""
    width = F.lit(16)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            width = width + F.octet_length(F.to_json(F.struct(column)))
        else:
            width = width + 8
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.sum(width.cast("long"))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when it is provably small, else without any hint."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session. Where none is set, a session whose tasks all run on this machine gets
    a local one; any other is refused, because its executors would not see it."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current is None:
            if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            current = tempfile.mkdtemp(prefix="gridstats-")
        context.setCheckpointDir(current)
    return current


def spill(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    For rows that several passes need: they then scan only their columns instead of repeating the joins, and
    a lost executor costs a re-read.
    """
    spark = df.sparkSession
    folder = f"{checkpoint_folder(spark).rstrip('/')}/gridstats-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def pin(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Compute ``df`` once, now, whatever its size: it is written, and a provably short result becomes a local relation.

    Meant for footprints, file listings and the results of file jobs. The plan of ``df`` runs a single time.
    """
    written = spill(df)
    if not fits_broadcast(written, max_rows, max_bytes):
        return written
    return df.sparkSession.createDataFrame(written.collect(), df.schema)
