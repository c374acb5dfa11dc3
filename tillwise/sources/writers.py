"""Parquet, CSV and JDBC targets."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.config import JdbcConf
from tillwise.sources import folders

# rows of a compressed CSV file, which cannot be split
ROWS_PER_FILE = 250_000
BYTE_ORDER_MARK = "﻿"


def write_table(frame: DataFrame, path: str) -> None:
    """Replace a whole unpartitioned table."""
    frame.write.mode("overwrite").parquet(path)


def write_by_month(detail: DataFrame, path: str, *, full: bool = False) -> int:
    """Write the detail fact by month, replacing only the months that occur.

    Without clustering every task would open a file in every month.  REBALANCE brings the
    rows of a month together and lets adaptive execution cut large months into several
    tasks and join small ones, so neither file counts nor the biggest month get out of
    hand.  ``full`` also drops months that no longer occur.  Returns the number of rows,
    counted by the writing tasks rather than by another pass.
    """
    mode = "static" if full else "dynamic"
    written = Observation()
    (
        detail.hint("rebalance", "dt")
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy("dt")
        .parquet(path)
    )
    return written.get["rows"]


def write_wide_by_month(
    frame: DataFrame, path: str, then: Callable[[DataFrame], DataFrame], *, full: bool = False
) -> int:
    """Like ``write_by_month`` for wide rows of many tasks.

    Every task first writes its own rows of every month to a folder beside ``path``; then each
    month is read again by a few tasks, which write files near the advisory size.  So rows that
    are as wide as these cross no network.  ``then`` gives the rows their stored form on the way
    from one to the other, row by row, so that columns it derives are written once.
    """
    spark = frame.sparkSession
    mode = "static" if full else "dynamic"
    parts = f"{path.rstrip('/')}-parts-{uuid.uuid4().hex[:8]}"
    written = Observation()
    try:
        counted = frame.observe(written, F.count(F.lit(1)).alias("rows"))
        counted.write.option("compression", "zstd").partitionBy("dt").parquet(parts)
        months = _by_month(spark, parts, frame.schema)
        stored = then(months).write.mode("overwrite").option("partitionOverwriteMode", mode)
        stored.partitionBy("dt").parquet(path)
    finally:
        folders.remove(spark, parts)
    return written.get["rows"]


def _bytes(text: str) -> int:
    """Bytes of a Spark size such as ``64MB`` or ``1m``."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def _by_month(spark: SparkSession, parts: str, schema: T.StructType) -> DataFrame:
    """Stored parts, each partition with rows of one month, as many as its bytes ask for."""
    size = _bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    reader = spark.read.schema(schema).option("basePath", parts)
    months = [
        # two at least, since a union of single partitions would be a single one
        reader.parquet(folder).coalesce(max(2, math.ceil(sum(folders.sizes(spark, folder)) / size)))
        for name, folder in sorted(folders.children(spark, parts).items())
        if name.startswith("dt=")
    ]
    return reduce(DataFrame.union, months) if months else spark.createDataFrame([], schema)


def write_raw_csv(sheet: DataFrame, path: str) -> None:
    """Raw sheet as compressed CSV with header; a file is read by one task, so rows are bounded."""
    writer = sheet.write.option("header", True).option("compression", "gzip")
    writer.option("maxRecordsPerFile", ROWS_PER_FILE).csv(path)


def write_clean_csv(frame: DataFrame, path: str, compression: str = "none") -> None:
    """CSV with header and byte order mark, so spreadsheets read it as UTF-8.

    A compressed file is read by one task, so its rows are bounded.
    """
    first, *rest = frame.columns
    marked = frame.select(F.col(first).alias(BYTE_ORDER_MARK + first), *rest)
    writer = marked.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd")
    if compression != "none":
        writer = writer.option("compression", compression).option("maxRecordsPerFile", ROWS_PER_FILE)
    writer.csv(path)


def write_clean_parquet(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("compression", "snappy").parquet(path)


def jdbc_options(conf: JdbcConf, table: str) -> dict[str, str]:
    """Overwrite by TRUNCATE, which keeps column types, keys and indexes of the target."""
    return {
        "url": conf.url,
        "driver": conf.driver,
        "user": conf.user,
        "password": conf.password,
        "dbtable": table,
        "truncate": "true",
        "batchsize": str(conf.batch_size),
        "numPartitions": str(conf.max_connections),
    }


def write_jdbc(frame: DataFrame, conf: JdbcConf, table: str) -> None:
    """Mirror a result table; ``numPartitions`` bounds the parallel connections."""
    frame.write.format("jdbc").options(**jdbc_options(conf, table)).mode("overwrite").save()
