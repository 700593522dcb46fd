"""Post-write validation queries over stored layers (each returns a small
DataFrame; only these finished aggregates are ever collected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlake.functions import mean_by, sql_round


# Silver columns whose unparsed values the profile counts.
PROFILED: tuple[str, ...] = ("timestamp", "source_port", "destination_port", "anomaly_score")


def layer_count(df: DataFrame) -> DataFrame:
    """One row: number of rows in a layer."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def top_attacks(silver: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent attack types (ties broken by name)."""
    return (
        silver.groupBy("attack_type")
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.desc("total"), F.asc_nulls_last("attack_type"))
        .limit(k)
    )


def silver_profile(silver: DataFrame) -> DataFrame:
    """One row: Silver rows and how many kept rows have unparsed values."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in PROFILED]
    return silver.agg(F.count(F.lit(1)).alias("rows"), *nulls)


def gold_summary(gold: DataFrame) -> DataFrame:
    """One row: fact rows, incidents, distinct attack types and protocols, and
    the mean of the group mean anomaly scores (unweighted)."""
    mean = mean_by(gold, [], "avg_anomaly_score", "mean", {}, {}).scalar()
    summary = gold.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum("total_incidents").cast("bigint").alias("total_incidents"),
        F.count_distinct("attack_type").alias("distinct_attack_types"),
        F.count_distinct("protocol").alias("distinct_protocols"),
    )
    return summary.withColumn("overall_avg_anomaly", sql_round(mean, 3))
