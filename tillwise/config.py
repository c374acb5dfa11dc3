"""Settings that change results or layout, and the session that carries them."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class ResultParams:
    """Parameters of the result tables."""

    anomaly_threshold: float = 0.3
    window_days: int = 30
    top_n: int = 10
    min_orders: int = 5
    opportunity_weights: tuple[float, float, float, float] = (0.4, 0.3, 0.2, 0.1)
    potential_weights: tuple[float, float, float] = (0.5, 0.3, 0.2)
    potential_groups: int = 5
    potential_rounds: int = 20


@dataclass(frozen=True)
class Thresholds:
    """Limits of the live alert rules."""

    margin_low: float = 0.05
    margin_high: float = 0.60
    big_loss: float = -1000.0
    marketing_ratio_cap: float = 0.40
    price_low: int = 500
    price_high: int = 12000
    qty_spike: int = 50


@dataclass(frozen=True)
class WarehouseConf:
    """Databases, fact table names and the folder of the raw Parquet files."""

    ods_db: str = "sales_ods"
    dwd_db: str = "sales_dwd"
    dws_db: str = "sales_dws"
    ads_db: str = "sales_ads"
    ods_table: str = "ods_sales"
    dwd_table: str = "dwd_sales"

    def database(self, layer: str) -> str:
        return {"ods": self.ods_db, "dwd": self.dwd_db, "dws": self.dws_db, "ads": self.ads_db}[layer]


@dataclass(frozen=True)
class JdbcConf:
    """Target of the result mirror."""

    url: str
    driver: str
    user: str
    password: str = field(repr=False, default="")
    batch_size: int = 1000
    # upper bound on parallel connections to the serving database
    max_connections: int = 8


@dataclass(frozen=True)
class KafkaConf:
    """Broker, topics and group of the live job."""

    bootstrap_servers: str
    raw_topic: str
    alert_topic: str
    group_id: str
    starting_offsets: str = "latest"
    metric_topic: str = "sales_metric"
    # bounds a micro-batch, for example after the job was down for long
    max_offsets_per_trigger: int | None = None


@dataclass(frozen=True)
class StreamConf:
    """Timing and state of the live job."""

    checkpoint: str
    trigger_seconds: int = 10
    watermark_minutes: int = 5
    query_name: str = "raw-to-alert"
    available_now: bool = False


def build_session(
    app_name: str,
    *,
    master: str | None = None,
    timezone: str = "Asia/Shanghai",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with adaptive execution, skew splitting and per-partition overwrite.

    ``shuffle_partitions`` is left to the cluster unless given: on a large cluster set
    it well above the core count and let adaptive coalescing shrink what is small.
    """
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": timezone,
        "spark.sql.parquet.compression.codec": "snappy",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session without that setting falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        shared = tempfile.mkdtemp(prefix="tillwise-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
