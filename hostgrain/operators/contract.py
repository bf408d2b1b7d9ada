"""The contract of a delivered feature table, and how a delivery differs from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names and order are binding.
KEYS = ("computer_id", "anchor_day", "window_days")
FEATURES = (
    "auth_out_event_count",
    "auth_in_event_count",
    "auth_out_distinct_targets",
    "auth_in_distinct_sources",
    "auth_out_distinct_users",
    "auth_in_distinct_users",
    "auth_out_distinct_human_users",
    "auth_in_distinct_human_users",
    "auth_out_failed_count",
    "auth_in_failed_count",
    "auth_out_failure_rate",
    "auth_in_failure_rate",
    "proc_start_count",
    "proc_distinct_process_names",
    "proc_distinct_users",
    "proc_distinct_human_users",
    "flows_out_count_distinct",
    "flows_in_count_distinct",
    "flows_out_distinct_targets",
    "flows_in_distinct_sources",
    "flows_out_bytes_sum_distinct",
    "flows_in_bytes_sum_distinct",
    "flows_out_packets_sum_distinct",
    "flows_in_packets_sum_distinct",
    "flows_out_anonymized_port_count_distinct",
    "flows_in_anonymized_port_count_distinct",
    "dns_lookup_count",
    "dns_distinct_resolved_hosts",
)
FLAGS = ("source_present_auth", "source_present_proc", "source_present_flows", "source_present_dns")
RATES = ("auth_out_failure_rate", "auth_in_failure_rate")
COLUMNS = (*KEYS, *FEATURES, *FLAGS)


def _expected():
    return F.array(*[F.lit(c) for c in COLUMNS])


def schema_diff(manifests: DataFrame) -> DataFrame:
    """For each manifest (with columns, an array of names): how its columns differ from the contract."""
    actual = F.coalesce("columns", F.array().cast("array<string>"))
    expected = _expected()
    first = F.filter(
        F.sequence(F.lit(0), F.lit(len(COLUMNS) - 1)), lambda i: ~F.get(expected, i).eqNullSafe(F.get(F.col("actual"), i))
    )
    rows = manifests.withColumn("actual", actual)
    missing, unexpected = F.array_except(expected, F.col("actual")), F.array_except(F.col("actual"), expected)
    reordered = (F.size(missing) == 0) & (F.size(unexpected) == 0) & (F.col("actual") != expected)
    return rows.select(
        "window_days",
        "anchor_day",
        (F.col("actual") == expected).alias("ok"),
        F.lit(len(COLUMNS)).alias("expected_count"),
        F.size("actual").alias("actual_count"),
        F.array_join(missing, ",").alias("missing"),
        F.array_join(unexpected, ",").alias("unexpected"),
        reordered.alias("order_mismatch"),
        F.when(reordered, F.get(first, F.lit(0))).alias("first_order_diff"),
    )


def schema_column_status(manifests: DataFrame) -> DataFrame:
    """A row per manifest and column of the contract or the delivery: ok, missing, unexpected or wrong order."""
    keys = ["window_days", "anchor_day"]
    rows = manifests.select(*keys, F.coalesce("columns", F.array().cast("array<string>")).alias("actual"))
    wanted = rows.select(*keys, "actual", F.posexplode(_expected()).alias("at", "column")).select(
        *keys,
        (F.col("at") + 1).alias("position"),
        "column",
        F.when(~F.array_contains("actual", F.col("column")), "missing")
        .when(F.get("actual", F.col("at")).eqNullSafe(F.col("column")), "ok")
        .otherwise("wrong order")
        .alias("status"),
    )
    more = rows.select(*keys, F.explode(F.array_except("actual", _expected())).alias("column")).select(
        *keys, F.lit(None).cast("int").alias("position"), "column", F.lit("unexpected").alias("status")
    )
    return wanted.unionByName(more)
