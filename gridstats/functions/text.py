"""Times, paths, identifiers and type names for catalogs."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The accepted ISO forms (offset with or without colon, optional fraction; plain date).
_ISO_FORMS = (
    "yyyy-M-d'T'H:m:s[.SSSSSS]XXX",
    "yyyy-M-d'T'H:m:s[.SSSSSS]xx",
    "yyyy-M-d",
)

_DAY_MICROS = 86_400_000_000

# What makes a folder a partition, and the characters that ids cannot hold.
PARTITION_SEGMENT = r"^[^=]+=.+$"
_NOT_ID = r"[^A-Za-z0-9_\-]+"


def _utc_clock(instant: Column) -> Column:
    """UTC wall clock of an instant, counted from the epoch: no session zone and no clock changes involved."""
    micros = F.unix_micros(instant)
    rest = F.pmod(micros, F.lit(_DAY_MICROS))
    midnight = F.date_add(F.lit("1970-01-01").cast("date"), ((micros - rest) / _DAY_MICROS).cast("int"))
    none = F.lit(0)
    return midnight.cast("timestamp_ntz") + F.make_dt_interval(none, none, none, (rest / 1e6).cast("decimal(18,6)"))


def utc_time(column: Column, kind: T.DataType) -> Column:
    """A time value as a zoneless timestamp in UTC; NULL for text in none of the ISO forms.

    Zoneless input counts as UTC, a date as its midnight. Independent of the session time zone.
    """
    if isinstance(kind, T.TimestampNTZType):
        return column
    if isinstance(kind, T.DateType):
        return column.cast("timestamp_ntz")
    if isinstance(kind, T.TimestampType):
        return _utc_clock(column)
    if isinstance(kind, T.StringType):
        text = F.trim(column)
        *zoned, day = _ISO_FORMS
        moments = [utc_time(F.try_to_timestamp(text, F.lit(f)), T.TimestampType()) for f in zoned]
        plain = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, day).cast("timestamp_ntz"))
        return F.coalesce(*moments, plain)
    return F.lit(None).cast("timestamp_ntz")


def rfc3339(moment: Column) -> Column:
    """UTC timestamp as ``2024-01-01T00:00:00Z``, with six decimals when there is a fraction."""
    text = moment.cast("timestamp_ntz").cast("string")  # 2024-01-01 00:00:00[.fraction], whatever the session zone
    whole = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))
    fraction = F.when(F.length(text) > 19, F.concat(F.lit("."), F.rpad(F.substring(text, 21, 6), 6, "0")))
    return F.concat(whole, F.coalesce(fraction, F.lit("")), F.lit("Z"))


def partition_segments(relative_path: Column) -> Column:
    """The ``name=value`` folders of a relative file path."""
    folders = F.slice(F.split(relative_path, "/"), 1, F.size(F.split(relative_path, "/")) - 1)
    return F.filter(folders, lambda s: s.rlike(PARTITION_SEGMENT))


def safe_id(text: Column) -> Column:
    return F.regexp_replace(text, _NOT_ID, "_")


def item_id(relative_path: Column) -> Column:
    """Folders and file stem joined by ``_``, other characters than ``A-Za-z0-9_-`` replaced."""
    stem = F.regexp_replace(relative_path, r"(?<=[^/])\.[^./]*$", "")
    return safe_id(F.replace(stem, F.lit("/"), F.lit("_")))


# Catalog names by the leading word of an Arrow type's text, such as ``timestamp[us, tz=UTC]``; others are strings.
_STORED_NAMES = {
    "bool": "boolean",
    "binary": "binary",
    "large_binary": "binary",
    "date": "date",
    "timestamp": "datetime",
    "int": "integer",
    "uint": "integer",
    "halffloat": "number",
    "float": "number",
    "double": "number",
}


def arrow_type_name(kind) -> str:
    """Catalog name of a column type as stored in a file."""
    return _STORED_NAMES.get(re.match("[a-z_]*", str(kind))[0], "string")
