"""A paged vendor interface as a Spark data source: ``spark.read.format("paged")``, and as a stream.

The fetcher is a function named by ``module:function``, so that tests and captured data need
no network: ``fetch(start, limit)`` returns the items from a cursor on, or JSON text of them.
Retries wait ``wait`` seconds.  How a read is dealt to tasks depends on its options:

* ``first`` and ``last`` (days, both included): a task a day.  The fetcher also gets ``day``;
  rows have a column of that name, and a filter on it leaves out the days' fetches.  With
  ``head`` too, which gets ``day``, tasks get ranges of the cursor of a day.
* ``head``: a function that tells how many items there are.  Tasks get ranges of the cursor,
  ``pages_a_task`` pages each.
* neither: one task follows the cursor until a page is empty or short, as a vendor that tells
  nothing about its size demands.

A stream needs ``head``.  Its offsets are vendor cursors, so one that is started again goes on
where its last committed batch ended.  ``source`` is handed to the functions if it is given.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds

PAGE = 200
RETRIES = 10
WAIT = 10.0
PAGES_A_TASK = 10


def pages(fetch: Callable[..., object], limit: int = PAGE, retries: int = RETRIES, wait: float = WAIT, start: int = 0, end: int | None = None) -> Iterator[list[dict]]:
    """Pages from a cursor until ``end``, or until an empty or short one; each is tried ``retries`` times."""
    while end is None or start < end:
        size = limit if end is None else min(limit, end - start)
        for attempt in range(retries):
            try:
                got = fetch(start, size)
                break
            except Exception:
                if attempt + 1 == retries:
                    raise
                time.sleep(wait)
        while isinstance(got, str):  # a body may be JSON, or JSON in a JSON text
            got = json.loads(got)
        if not got:
            return
        yield list(got)
        if len(got) < size:
            return
        start += size


@dataclass
class Part(ds.InputPartition):
    """What one task fetches: a range of the cursor, of one day if there is one."""

    start: int = 0
    end: int | None = None
    day: date | None = None


class _Options:
    def __init__(self, options):
        self.all = dict(options)
        self.limit, self.retries = int(self.all.get("limit", PAGE)), int(self.all.get("retries", RETRIES))
        self.wait, self.task_pages = float(self.all.get("wait", WAIT)), int(self.all.get("pages_a_task", PAGES_A_TASK))
        self.more = {"source": self.all["source"]} if "source" in self.all else {}

    def function(self, name: str) -> Callable[..., object]:
        module, _, function = self.all[name].partition(":")
        return getattr(importlib.import_module(module), function)

    def head(self, **more) -> int:
        return int(self.function("head")(**self.more, **more))

    def ranges(self, start: int, end: int, day: date | None = None) -> list[Part]:
        step = self.limit * self.task_pages
        return [Part(a, min(a + step, end), day) for a in range(start, end, step)]

    def rows(self, part: Part, names: list[str]) -> Iterator[tuple]:
        fetch, more = self.function("fetch"), self.more | ({"day": part.day} if part.day else {})
        for page in pages(lambda a, n: fetch(a, n, **more), self.limit, self.retries, self.wait, part.start, part.end):
            for item in page:
                yield tuple(part.day if n == "day" and part.day else None if item.get(n) is None else str(item[n]) for n in names)


def register(spark: SparkSession) -> None:
    """Make the source known, and let it have filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSource)


class PagedSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        own = self.options.get("schema", "id string, url string, content string, title string, created_at string, source string, summary string")
        return f"{own}, day date" if "first" in self.options else own

    def reader(self, schema) -> ds.DataSourceReader:
        return DayReader(schema, self.options) if "first" in self.options else Reader(schema, self.options)

    def streamReader(self, schema) -> ds.DataSourceStreamReader:  # noqa: N802  Spark's name
        return StreamReader(schema, self.options)


_COMPARED = {ds.EqualTo: lambda d, v: d == v, ds.GreaterThan: lambda d, v: d > v, ds.GreaterThanOrEqual: lambda d, v: d >= v, ds.LessThan: lambda d, v: d < v, ds.LessThanOrEqual: lambda d, v: d <= v, ds.In: lambda d, v: d in v}


class Reader(ds.DataSourceReader):
    def __init__(self, schema, options):
        self.names, self.options = schema.fieldNames(), _Options(options)

    def partitions(self) -> list[Part]:
        return self.options.ranges(0, self.options.head()) if "head" in self.options.all else [Part()]

    def read(self, partition) -> Iterator[tuple]:
        return self.options.rows(partition, self.names)


class DayReader(Reader):
    def __init__(self, schema, options):
        super().__init__(schema, options)
        self.wanted: list[tuple[type, object]] = []

    def pushFilters(self, filters):  # noqa: N802  Spark's name
        """Comparisons of the day decide which days are fetched; all others are left to Spark."""
        for f in filters:
            if getattr(f, "attribute", None) == ("day",) and type(f) in _COMPARED:
                self.wanted.append((type(f), f.value))
            elif not (getattr(f, "attribute", None) == ("day",) and isinstance(f, ds.IsNotNull)):
                yield f

    def partitions(self) -> list[Part]:
        first, last = (date.fromisoformat(self.options.all[k]) for k in ("first", "last"))
        days = [first + timedelta(days=k) for k in range((last - first).days + 1)]
        days = [d for d in days if all(_COMPARED[kind](d, value) for kind, value in self.wanted)]
        if "head" in self.options.all:
            return [p for d in days for p in self.options.ranges(0, self.options.head(day=d), d)]
        return [Part(day=d) for d in days]


class StreamReader(ds.DataSourceStreamReader):
    def __init__(self, schema, options):
        self.names, self.options = schema.fieldNames(), _Options(options)

    def initialOffset(self) -> dict:  # noqa: N802  Spark's name
        return {"start": int(self.options.all.get("from", 0))}

    def latestOffset(self) -> dict:  # noqa: N802  Spark's name
        return {"start": self.options.head()}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return self.options.ranges(start["start"], end["start"])

    def read(self, partition) -> Iterator[tuple]:
        return self.options.rows(partition, self.names)

    def commit(self, end: dict) -> None:
        """The vendor keeps no state of its readers."""
