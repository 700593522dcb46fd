"""Layer locations from the environment, object-store settings, scratch dir."""

import pytest

from incidentlake.config import (
    DEFAULT_RAW_CSV,
    DEFAULT_RAW_CSV_FALLBACK,
    LayerConfig,
    object_store_conf,
    remove_scratch,
    scratch_root,
    shared_scratch_dir,
)
from incidentlake.sources import path_exists


def test_from_env_defaults_and_fallback():
    cfg = LayerConfig.from_env({})
    assert cfg.raw_csv == (DEFAULT_RAW_CSV, DEFAULT_RAW_CSV_FALLBACK)
    assert cfg.bronze.startswith("s3a://bronze/") and cfg.gold.startswith("s3a://gold/")
    assert cfg.multiline_csv is True and cfg.row_group_rows == 100_000


def test_from_env_overrides():
    env = {"RAW_CSV_PATH": "/in/x.csv", "BRONZE_PATH": "/b", "SILVER_PATH": "/s",
           "GOLD_PATH": "/g", "RAW_CSV_MULTILINE": "false"}
    cfg = LayerConfig.from_env(env)
    assert (cfg.raw_csv, cfg.bronze, cfg.silver, cfg.gold) == (("/in/x.csv",), "/b", "/s", "/g")
    assert cfg.multiline_csv is False


def test_under_base():
    cfg = LayerConfig.under("/lake/", "/raw")
    assert (cfg.bronze, cfg.silver, cfg.gold, cfg.raw_csv) == ("/lake/bronze", "/lake/silver", "/lake/gold", ("/raw",))


def test_object_store_conf():
    conf = object_store_conf({"S3_ENDPOINT": "https://store:9000", "S3_ACCESS_KEY": "k",
                              "S3_SECRET_KEY": "s", "S3_REGION": "eu-west-1"})
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "https://store:9000"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.endpoint.region"] == "eu-west-1"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "k"
    plain = object_store_conf({"S3_ENDPOINT": "http://localhost:9000"})
    assert plain["spark.hadoop.fs.s3.impl"].endswith("S3AFileSystem")  # s3:// is served too
    assert plain["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert "spark.hadoop.fs.s3a.access.key" not in plain


def test_shared_scratch_dir_reads_session(spark):
    assert shared_scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


class _Session:
    """A session of a cluster without a shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_no_shared_folder_on_a_cluster_raises():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_scratch_dir(_Session)


def test_scratch_is_removed(spark):
    root = scratch_root(spark)
    assert root.startswith(shared_scratch_dir(spark))
    spark.range(3).write.parquet(f"{root}/t")
    remove_scratch(root)
    assert not path_exists(spark, f"{root}/t")
