"""Times of files from the statistics in their footers."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from gridstats.sources.files import parquet_inventory
from gridstats.sources.stac import _footer_ends, file_times

UTC = dt.timezone.utc
DAYS = [dt.datetime(2024, 3, 1, 6, 0, 0, 123456) + dt.timedelta(days=k) for k in range(40)]
KINDS = {
    "micro": pa.timestamp("us"),
    "milli": pa.timestamp("ms"),
    "second": pa.timestamp("s"),
    "nano": pa.timestamp("ns"),
    "zoned": pa.timestamp("us", "UTC"),
    "abroad": pa.timestamp("us", "Europe/Madrid"),
    "date": pa.date32(),
}


def column(kind, values):
    if pa.types.is_timestamp(kind) and kind.tz:
        values = [v and v.replace(tzinfo=UTC) for v in values]
    return pa.array(values, pa.date32()) if pa.types.is_date(kind) else pa.array(values, pa.timestamp("us", kind.tz if pa.types.is_timestamp(kind) else None)).cast(kind, safe=False)


def write(path, kind, values, **options):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"time": column(kind, values), "x": list(range(len(values)))}), path, row_group_size=10, **options)


def times(spark, root):
    rows = file_times(parquet_inventory(spark, str(root)), ["time"]).collect()
    return {r["_uri"].rsplit("/", 2)[1]: (r["start_time"], r["end_time"]) for r in rows}


def test_statistics_say_what_the_column_says(spark, tmp_path):
    """Every type, with and without statistics, NULLs in front, a row group of NULLs only, and a file of them."""
    values = [None, *DAYS[::-1][:18], None, *[None] * 10, *DAYS]
    for name, kind in KINDS.items():
        write(tmp_path / f"with_{name}" / "a.parquet", kind, values)
        write(tmp_path / f"without_{name}" / "a.parquet", kind, values, write_statistics=False)
    write(tmp_path / "nothing" / "a.parquet", KINDS["micro"], [None] * 12)
    found = times(spark, tmp_path)
    for name in KINDS:
        assert found[f"with_{name}"] == found[f"without_{name}"], name
        assert found[f"with_{name}"][0].date() == DAYS[0].date() and found[f"with_{name}"][1].date() == DAYS[-1].date()
    assert found["with_micro"] == (DAYS[0], DAYS[-1])
    assert found.get("nothing", (None, None)) == (None, None)


@pytest.mark.parametrize("known", [True, False])
def test_columns_with_statistics_are_not_read(spark, tmp_path, known):
    """The pages of the time column are overwritten: only who reads them notices."""
    path = tmp_path / "data" / "a.parquet"
    write(path, KINDS["micro"], DAYS, write_statistics=known, compression="zstd", use_dictionary=False)
    stored = pq.ParquetFile(path)
    content = bytearray(path.read_bytes())
    for group in range(stored.num_row_groups):
        assert (_footer_ends(stored, group, "time") is not None) == known
        pages = stored.metadata.row_group(group).column(0)
        start = pages.data_page_offset
        content[start : start + pages.total_compressed_size] = b"\xff" * pages.total_compressed_size
    path.write_bytes(content)
    if known:
        assert times(spark, tmp_path) == {"data": (DAYS[0], DAYS[-1])}
    else:
        with pytest.raises(Exception, match="(?i)thrift|page|parquet|deserialize"):
            times(spark, tmp_path)
