"""What a vendor would answer, captured from a table: a folder a day, its items in the order of a key.

Spark reads and sorts the table once.  A page is then cut from the one or two files that hold it,
so that the cost of a page does not grow with its day.
"""

from __future__ import annotations

from bisect import bisect_right
from datetime import date
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import opened

#: About so many items a file.
ITEMS = 50_000


def capture(rows: DataFrame, day: str, key: str, path: str, items: int = ITEMS) -> str:
    """Write ``rows`` below ``path``, a folder without files: files of a day follow each other in the order of the key."""
    files = max(1, -(-rows.count() // items))
    rows.withColumn("day", F.col(day).cast("date")).where("day is not null").repartitionByRange(files, "day", key).sortWithinPartitions("day", key).write.partitionBy("day").mode("append").parquet(path)
    return path


@lru_cache(maxsize=64)
def _files(source: str, day: date) -> tuple[list[str], list[int]]:
    """Files of a day and where each begins, then the number of all items; a capture is never changed."""
    files, folder = opened(source)
    found = files.get_file_info(fs.FileSelector(f"{folder}/day={day}", allow_not_found=True))
    # Spark numbers the files of a write by partition, and a partition writes one of a day.
    paths = sorted(f.path for f in found if f.base_name.startswith("part-"))
    sizes = []
    for path in paths:
        with files.open_input_file(path) as f:
            sizes.append(pq.read_metadata(f).num_rows)
    return paths, list(accumulate(sizes, initial=0))


@lru_cache(maxsize=1)
def _table(source: str, path: str) -> pa.Table:
    files, _ = opened(source)
    with files.open_input_file(path) as f:
        return pq.ParquetFile(f).read()


def head(source: str, day: date) -> int:
    """How many items a day has."""
    return _files(source, day)[1][-1]


def fetch(start: int, limit: int, day: date, source: str) -> list[dict]:
    """A page of one day from a cursor on."""
    paths, begins = _files(source, day)
    out: list[dict] = []
    while len(out) < limit and start + len(out) < begins[-1]:
        k = bisect_right(begins, start + len(out)) - 1
        out += _table(source, paths[k]).slice(start + len(out) - begins[k], limit - len(out)).to_pylist()
    return out
