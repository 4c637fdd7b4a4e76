"""Sources that are fetched page by page, or by ranges: planned on the driver, read by tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def split_ranges(first: date, last: date, count: Callable[[date, date], int], most: int = 9000, depth: int = 6) -> Iterator[tuple[date, date, int]]:
    """Ranges of days whose counts are at most most: halved until they are, so many times at the utmost, when
    what is left counts as most. Empty ranges are left out."""
    n = count(first, last)
    if n == 0:
        return
    if n <= most or depth < 0 or first == last:
        yield first, last, min(n, most)
        return
    middle = date.fromordinal((first.toordinal() + last.toordinal()) // 2)
    yield from split_ranges(first, middle, count, most, depth - 1)
    yield from split_ranges(middle + timedelta(days=1), last, count, most, depth - 1)


class _Page(InputPartition):
    def __init__(self, token):
        self.token = token


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.pages, self.fetch = options["_pages"], options["_fetch"]

    def partitions(self):
        return [_Page(p) for p in self.pages]

    def read(self, partition):
        yield from self.fetch(partition.token)


def read_pages(spark: SparkSession, name: str, pages: list, fetch: Callable[[object], Iterator[tuple]], schema: str) -> DataFrame:
    """A table of all pages' rows, each page read by a task of its own; a page that fails is read again like any
    task. fetch runs on the workers."""
    plan = {"_pages": pages, "_fetch": fetch}

    class Pages(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return _Reader(plan)

    spark.dataSource.register(Pages)
    return spark.read.format(name).load()


def walk_categories(edges: DataFrame, roots: list[str], depth: int = 4) -> DataFrame:
    """Categories below the roots, each with its least depth: by levels, so that one first met on a long path is
    still opened from a short one. edges: parent, child."""
    spark = edges.sparkSession
    seen = spark.createDataFrame([(r, 0) for r in sorted(set(roots))], "category string, depth int")
    front = seen
    for level in range(1, depth + 1):
        found = edges.join(front.select(F.col("category").alias("parent")), "parent").select(F.col("child").alias("category")).distinct()
        front = found.join(seen.select("category"), "category", "left_anti").withColumn("depth", F.lit(level))
        seen = seen.unionByName(front)
    return seen


def not_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key an earlier run has not written."""
    return rows.join(done.select(key).distinct(), key, "left_anti")
