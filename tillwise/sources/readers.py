"""Raw sheet, prepared fact and live messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillwise import schemas
from tillwise.config import KafkaConf


def raw_sheet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV export of the raw sheet with every column as text.

    ``columns`` in file order saves the job that reads the header and checks it instead.
    """
    reader = spark.read.option("header", True)
    if columns is not None:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def prepared_fact(spark: SparkSession, path: str) -> DataFrame:
    """Prepared fact with its declared schema."""
    return spark.read.schema(schemas.ODS).parquet(path)


def refresh_and_count(spark: SparkSession, path: str) -> int:
    """Drop cached file listings and count; Parquet answers from the file footers."""
    spark.catalog.refreshByPath(path)
    return prepared_fact(spark, path).count()


def kafka_options(conf: KafkaConf) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": conf.bootstrap_servers,
        "subscribe": conf.raw_topic,
        "startingOffsets": conf.starting_offsets,
        "kafka.group.id": conf.group_id,
        "failOnDataLoss": "false",
    }
    if conf.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(conf.max_offsets_per_trigger)
    return options


def kafka_messages(spark: SparkSession, conf: KafkaConf) -> DataFrame:
    """Live messages of the raw topic (needs the Kafka connector on the class path)."""
    return spark.readStream.format("kafka").options(**kafka_options(conf)).load()


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Live messages from text files, one JSON event per line in ``value``."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
