"""The package on the executors: sent along once per context, where workers may not have it installed."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add this package as a file to the session's context. Workers that have it installed use that."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    _sent.add(context.applicationId)
    top = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="marlstone-")  # code, served to the executors from here until the end
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "marlstone.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, where the session has Spark's own bounds: a worker holds a few at a time,
    with their texts as Python strings beside them."""
    ship(spark)
    for key, usual, ours in (("maxRecordsPerBatch", "10000", "2000"), ("maxBytesPerBatch", "67108864b", "8m")):
        key = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(key, usual) == usual:
            spark.conf.set(key, ours)
