"""Plain-language names of columns, as a small table to join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The labels that reports must show.
LABELS = {
    "computer_id": "Computer",
    "anchor_day": "As-of day",
    "window_days": "Days covered",
    "auth_out_event_count": "Outgoing sign-ins",
    "auth_in_event_count": "Incoming sign-ins",
    "auth_out_distinct_targets": "Different systems contacted for sign-in",
    "auth_in_distinct_sources": "Different systems signing in here",
    "auth_out_distinct_users": "Different accounts signing out",
    "auth_in_distinct_users": "Different accounts signing in",
    "auth_out_distinct_human_users": "Different people signing out",
    "auth_in_distinct_human_users": "Different people signing in",
    "auth_out_failed_count": "Failed outgoing sign-ins",
    "auth_in_failed_count": "Failed incoming sign-ins",
    "auth_out_failure_rate": "Outgoing sign-in failure rate",
    "auth_in_failure_rate": "Incoming sign-in failure rate",
    "proc_start_count": "Programs started",
    "proc_distinct_process_names": "Different programs used",
    "proc_distinct_users": "Different accounts running programs",
    "proc_distinct_human_users": "Different people running programs",
    "flows_out_count_distinct": "Outgoing network connections",
    "flows_in_count_distinct": "Incoming network connections",
    "flows_out_distinct_targets": "Different destinations contacted",
    "flows_in_distinct_sources": "Different sources connecting in",
    "flows_out_bytes_sum_distinct": "Data sent",
    "flows_in_bytes_sum_distinct": "Data received",
    "flows_out_packets_sum_distinct": "Network packets sent",
    "flows_in_packets_sum_distinct": "Network packets received",
    "flows_out_anonymized_port_count_distinct": "Different outgoing network ports",
    "flows_in_anonymized_port_count_distinct": "Different incoming network ports",
    "dns_lookup_count": "Website lookups",
    "dns_distinct_resolved_hosts": "Different websites looked up",
    "source_present_auth": "Authentication events",
    "source_present_proc": "Process starts",
    "source_present_flows": "Network traffic",
    "source_present_dns": "DNS lookups",
    "anomaly_score": "Unusual activity score",
}
FAMILIES = {"auth": "Authentication events", "proc": "Process starts", "flows": "Network traffic", "dns": "DNS lookups"}


def label_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LABELS.items()), "feature string, label string")


def labelled(df: DataFrame, column: str = "feature") -> DataFrame:
    """df with a column label; a name without one has its underscores softened."""
    names = F.broadcast(label_table(df.sparkSession).withColumnRenamed("feature", "label_of"))  # a fixed dimension
    joined = df.join(names, df[column] == F.col("label_of"), "left")
    return joined.withColumn("label", F.coalesce("label", F.trim(F.replace(F.col(column), F.lit("_"), F.lit(" "))))).drop("label_of")


def family_of(feature: Column) -> Column:
    """auth, proc, flows or dns by the feature's prefix; null otherwise."""
    prefix = F.split_part(feature, F.lit("_"), F.lit(1))
    return F.when(prefix.isin(*FAMILIES) & F.contains(feature, F.lit("_")), prefix)
