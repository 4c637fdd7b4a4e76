"""What the operators of this subpackage share: table reading, lineage cuts, literal lookups."""

from __future__ import annotations

import atexit
import json
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import bounded_batches, ship  # noqa: F401

LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1

#: Tables written to the shared folder by this process: (session, path). Removed at exit.
_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; one of our own only where that is unset and driver and executors
    are one process, as in tests."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="marlstone-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/marlstone/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def save(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them again. Lost executors then cost
    no more than the step at hand, and later readers fetch only the columns that they need."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables saved within are deleted at the end, but for those that the given function saves."""
    before, kept = list(_written), []

    def keep(df: DataFrame, name: str) -> DataFrame:
        out = save(df, name)
        kept.append(_written[-1])
        return out

    try:
        yield keep
    finally:
        _delete([x for x in _written if x not in before and x not in kept])


def last_saved() -> tuple[SparkSession, str]:
    """What discard() takes, of the table saved last."""
    return _written[-1]


def discard(item: tuple[SparkSession, str] | None) -> None:
    """Delete a saved table that nothing will read again."""
    if item in _written:
        _delete([item])


def drop_shuffles(spark: SparkSession) -> None:
    """Shuffle files of jobs that have ended stay on the executors' disks until the driver collects its garbage, which
    with its small plans may be never."""
    spark._jvm.System.gc()


def release(spark: SparkSession | None = None) -> None:
    """Delete the tables that save() has written (of one session, or all). Results that still read them
    must have been consumed."""
    _delete([x for x in _written if spark is None or x[0] is spark])


def _delete(items: list[tuple[SparkSession, str]]) -> None:
    for item in items:
        _written.remove(item)
        try:
            at = item[0]._jvm.org.apache.hadoop.fs.Path(item[1])
            at.getFileSystem(item[0]._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session has ended: its shared folder is the cluster's to clean
            pass


atexit.register(release)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these which df does not have yet in any case."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name = f"_{name}"
        have.add(name.lower())
        out.append(name)
    return out


def array_literal(values: Iterable, of: str) -> Column:
    """A constant array, folded to one literal when the plan is optimised. of: a DDL type."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{of}>")


def seeded_unit(*parts: Column) -> Column:
    """A number in [0, 1) with 52 random bits that follow from the parts alone; DuckDB's md5 gives the same."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(2**52))
