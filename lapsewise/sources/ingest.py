"""Monthly CSV extracts to Parquet, under fixed layouts."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lapsewise.sources.catalog import CORRUPT_TEXT, Catalog
from lapsewise.sources.manifest import clear_months, update_manifest
from lapsewise.sources.schemas import schema_for


class IngestCount(NamedTuple):
    """What one (table, month) brought."""

    key: str
    month: str
    rows: int
    quarantined: int


def validate_schema(df: DataFrame, expected: StructType) -> None:
    """``ValueError`` unless ``df`` has exactly the expected columns and types, in any order."""
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if want != have:
        raise ValueError(f"schema mismatch: expected {want}, actual {have}")


def check_header(
    header: Sequence[str], expected: StructType, aliases: Mapping[str, str] | None = None
) -> None:
    """``ValueError`` unless a file's header names the expected columns in their order.

    Spark binds a forced schema by position, so a header in another order would put values
    under wrong names without an error. ``aliases`` maps names used in files to ours.
    """
    names = [(aliases or {}).get(h, h) for h in header]
    if names != expected.names:
        raise ValueError(f"CSV header mismatch: expected {expected.names}, actual {names}")


def read_csv(
    catalog: Catalog, key: str, month: str, aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """A month's extract with ``_corrupt_record``: null for good rows, else the line itself.

    The first file's header is checked now, every other file's when it is read. Rows with a
    bad number, too few or too many fields are marked, not dropped.
    """
    spark, path, expected = catalog.spark, catalog.csv_path(key, month), schema_for(key)
    header = spark.read.csv(path, header=True).columns
    check_header(header, expected, aliases)
    in_file = StructType(
        [StructField(h, f.dataType, True) for h, f in zip(header, expected.fields)]
    ).add(CORRUPT_TEXT, StringType())
    rows = spark.read.csv(
        path,
        schema=in_file,
        header=True,
        enforceSchema=False,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT_TEXT,
    )
    return rows.toDF(*expected.names, CORRUPT_TEXT)


def ingest_month(
    catalog: Catalog, key: str, month: str, aliases: Mapping[str, str] | None = None
) -> IngestCount:
    """Read, check and store one (table, month), replacing what its folder held.

    One pass over the text and no shuffle or sort: a bad row is stored next to the good ones
    with its line in ``_corrupt_record``, which is null (and so all but free) for these. Both
    are counted on the way.
    """
    rows = read_csv(catalog, key, month, aliases)
    validate_schema(rows.drop(CORRUPT_TEXT), schema_for(key))
    seen = Observation(f"{key} {month}")
    counted = rows.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count(CORRUPT_TEXT).alias("bad")
    )
    counted.write.mode("overwrite").parquet(catalog.parquet_path(key, month))
    return IngestCount(key, month, seen.get["rows"] - seen.get["bad"], seen.get["bad"])


def ingest_table(
    catalog: Catalog, key: str, months: Sequence[str], aliases: Mapping[str, str] | None = None
) -> list[IngestCount]:
    """Read, check and store some months of a partitioned table in one job.

    Partitions that get rows are replaced, others are left alone; months that brought none are noted
    in the table's manifest and cleared. If a month's extract is missing or has a wrong header,
    nothing is stored. One pass over the text and no shuffle.
    """
    root, column = catalog.partitioned(key)
    extracts = []
    for month in months:
        rows = read_csv(catalog, key, month, aliases)
        validate_schema(rows.drop(CORRUPT_TEXT), schema_for(key))
        extracts.append(rows.withColumn(column, F.lit(month)))
    seen, each = Observation(key), []
    for i, month in enumerate(months):
        here = F.col(column) == month
        each += [F.count(F.when(here, 1)).alias(f"rows{i}"), F.count(F.when(here, F.col(CORRUPT_TEXT))).alias(f"bad{i}")]
    counted = reduce(DataFrame.unionAll, extracts).observe(seen, *each)
    counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(root)
    found = seen.get
    counts = [IngestCount(key, m, found[f"rows{i}"] - found[f"bad{i}"], found[f"bad{i}"]) for i, m in enumerate(months)]
    update_manifest(catalog.spark, root, {c.month: {"rows": c.rows, "quarantined": c.quarantined} for c in counts})
    clear_months(catalog.spark, root, column, {c.month for c in counts if not c.rows + c.quarantined})
    return counts


@contextmanager
def _unsorted_partitions(spark: SparkSession, most: int) -> Iterator[None]:
    """A task may keep ``most`` partitions' files open, instead of sorting its rows by partition."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def ingest(
    catalog: Catalog,
    keys: Sequence[str] | None = None,
    months: Sequence[str] | None = None,
    aliases: Mapping[str, Mapping[str, str]] | None = None,
    parallel: int = 4,
) -> list[IngestCount]:
    """Store every wanted (table, month): a partitioned table in one job over all its months, any
    other by a job for each month, ``parallel`` at a time so that small tables do not wait for
    the last task of a large one.

    After a failure no further one is started and the failure is raised; what was stored
    stays, and what was not reached keeps its old state.
    """
    wanted = list(catalog.months if months is None else months)
    units = []
    for key in catalog.keys if keys is None else keys:
        known = (aliases or {}).get(key)
        if catalog.partitioned(key):
            units.append((ingest_table, key, wanted, known))
        else:
            units += [(_one_month, key, [month], known) for month in wanted]
    with _unsorted_partitions(catalog.spark, 8), ThreadPoolExecutor(max_workers=parallel) as pool:
        jobs = [pool.submit(way, catalog, key, some, known) for way, key, some, known in units]
        try:
            return [count for job in jobs for count in job.result()]
        finally:
            for job in jobs:
                job.cancel()


def _one_month(
    catalog: Catalog, key: str, months: Sequence[str], aliases: Mapping[str, str] | None
) -> list[IngestCount]:
    return [ingest_month(catalog, key, month, aliases) for month in months]
