"""What the last ingest of each month of a partitioned table brought, beside its partitions.

Replacing partitions that have new rows leaves alone a partition that has none any more. So each
ingest also notes how many rows every month brought; a month with none is empty whatever its folder
still holds. One small text file, replaced as a whole by a rename, that partition discovery does not see.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import SparkSession

_NAME = "_months.json"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def read_manifest(spark: SparkSession, root: str) -> dict[str, dict[str, int]]:
    """``rows`` and ``quarantined`` of each month that was ingested; empty without a manifest."""
    place, fs = _place(spark, f"{root}/{_NAME}")
    if not fs.exists(place):
        return {}
    stream = fs.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def update_manifest(spark: SparkSession, root: str, months: Mapping[str, Mapping[str, int]]) -> None:
    """Note what ``months`` brought; others keep what is noted of them."""
    text = json.dumps(read_manifest(spark, root) | {m: dict(n) for m, n in months.items()}, indent=1, sort_keys=True)
    place, fs = _place(spark, f"{root}/{_NAME}")
    fresh, _ = _place(spark, f"{root}/{_NAME}.{uuid.uuid4().hex}")
    stream = fs.create(fresh, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.delete(place, False)
    if not fs.rename(fresh, place):
        raise OSError(f"could not replace the manifest of {root}")


def clear_months(spark: SparkSession, root: str, column: str, months: set[str]) -> None:
    """Remove the partitions of some months, whose names may be escaped."""
    place, fs = _place(spark, root)
    for status in fs.listStatus(place) if months and fs.exists(place) else ():
        name, _, value = status.getPath().getName().partition("=")
        if status.isDirectory() and name == column and unquote(value) in months:
            fs.delete(status.getPath(), True)
