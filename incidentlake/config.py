"""Layer locations, object-store settings and session helpers."""

from __future__ import annotations

import atexit
import logging
import os
import tempfile
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Default locations of the source file and the three layers.
DEFAULT_RAW_CSV = "data/cybersecurity_attacks.csv"
DEFAULT_RAW_CSV_FALLBACK = "data/cyber attacks/cybersecurity_attacks.csv"
DEFAULT_BRONZE = "s3a://bronze/cyber_attacks_raw"
DEFAULT_SILVER = "s3a://silver/cyber_attacks_clean"
DEFAULT_GOLD = "s3a://gold/fact_incident_summary"

# Rows per Parquet row group for Bronze and Silver (Gold keeps the writer default).
ROW_GROUP_ROWS = 100_000


@dataclass(frozen=True)
class LayerConfig:
    """Where each layer lives. Layers are coupled only through these paths, so
    any one of them can be re-run alone from its predecessor's stored output."""

    raw_csv: tuple[str, ...]
    bronze: str
    silver: str
    gold: str
    multiline_csv: bool = True
    columns_from_header: bool = True
    row_group_rows: int = ROW_GROUP_ROWS
    partition_by: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    # Columns by which a layer's rows are sorted within each file, for pruned
    # reads, e.g. {"silver": ("attack_type", "severity_level")}; and columns with
    # Bloom filters, e.g. {"silver": ("source_ip_masked",)}.
    cluster_by: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    bloom_columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def gold_state(self) -> str:
        """Where the mergeable state behind an incremental Gold lives."""
        return f"{self.gold.rstrip('/')}_state"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> LayerConfig:
        env = os.environ if env is None else env
        raw = env.get("RAW_CSV_PATH", DEFAULT_RAW_CSV)
        candidates = (raw, DEFAULT_RAW_CSV_FALLBACK) if raw == DEFAULT_RAW_CSV else (raw,)
        return cls(
            raw_csv=candidates,
            bronze=env.get("BRONZE_PATH", DEFAULT_BRONZE),
            silver=env.get("SILVER_PATH", DEFAULT_SILVER),
            gold=env.get("GOLD_PATH", DEFAULT_GOLD),
            multiline_csv=env.get("RAW_CSV_MULTILINE", "true").lower() == "true",
        )

    @classmethod
    def under(cls, base: str, raw_csv: str | tuple[str, ...], **kw) -> LayerConfig:
        """All three layers below one base directory (tests, benchmarks)."""
        raw = (raw_csv,) if isinstance(raw_csv, str) else tuple(raw_csv)
        base = base.rstrip("/")
        return cls(
            raw_csv=raw,
            bronze=f"{base}/bronze",
            silver=f"{base}/silver",
            gold=f"{base}/gold",
            **kw,
        )


def object_store_conf(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Hadoop S3A settings for an S3-compatible object store.

    Endpoint, keys and region come from the environment; TLS follows the
    endpoint's scheme; path-style addressing is on (needed by most self-hosted
    stores). Pass the result to ``SparkSession.builder.config(map=...)``.
    """
    env = os.environ if env is None else env
    endpoint = env.get("S3_ENDPOINT", env.get("MINIO_ENDPOINT", "http://localhost:9000"))
    conf = {
        # s3:// locations are served by the same connector
        "spark.hadoop.fs.s3.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.AbstractFileSystem.s3.impl": "org.apache.hadoop.fs.s3a.S3A",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https://")).lower(),
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.endpoint.region": env.get(
            "S3_REGION", env.get("MINIO_REGION", "us-east-1")
        ),
    }
    key = env.get("S3_ACCESS_KEY", env.get("MINIO_ACCESS_KEY"))
    secret = env.get("S3_SECRET_KEY", env.get("MINIO_SECRET_KEY"))
    if key and secret:
        conf["spark.hadoop.fs.s3a.access.key"] = key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret
    return conf


def shared_scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach, so there
    is no fallback: without it, this raises. Only a local session, where driver
    and executors are one process, gets a folder of its own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="incidentlake-ckpt-")
    log.warning("spark.checkpoint.dir is unset; using local folder %s", local)
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


_scratch_of: dict[str, SparkSession] = {}


def scratch_root(spark: SparkSession) -> str:
    """This application's own part of the shared folder. It is removed when the
    Python process ends, or by ``remove_scratch``."""
    root = f"{shared_scratch_dir(spark)}/incidentlake-{spark.sparkContext.applicationId}"
    if root not in _scratch_of:
        _scratch_of[root] = spark
        atexit.register(remove_scratch, root)
    return root


def remove_scratch(root: str) -> None:
    """Delete a scratch folder; results that still read from it end with it."""
    spark = _scratch_of.pop(root, None)
    if spark is None:
        return
    try:
        context = spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    except Exception as e:  # the session may have ended before
        log.debug("scratch folder %s stays: %s", root, e)


def local_session(
    app: str = "incidentlake",
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and benchmarks: UI off, UTC, ANSI on, AQE on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_scratch_dir(spark)
    return spark
